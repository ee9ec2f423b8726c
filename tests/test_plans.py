"""Physical-plan shapes the scale design relies on, checked on small inputs."""

from pyspark.sql import functions as F

from flatland.operators.profile import distinct_values, profile_columns
from flatland.operators.publish import VersionedTable, upsert
from flatland.operators.stage import dedup_latest
from flatland.sources.quoted import quoted_records

from .conftest import SF_SMALL, write


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _below_first_exchange(plan: str) -> str:
    """The part of a plan tree printed below (i.e. before) its first exchange."""
    return plan[plan.index("Exchange"):]


def test_dedup_combines_a_hot_key_before_the_shuffle(spark):
    # A third of the rows share one key.
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
                                    F.col("id").alias("t"), (F.col("id") * 2).alias("v"))
    out = dedup_latest(rows, ["k"], ["t"])
    plan = _executed(out)
    assert "partial_max" in _below_first_exchange(plan)
    hot = out.filter(F.col("k") == -1).collect()
    assert [(r["t"], r["v"]) for r in hot] == [(2997, 5994)]
    assert out.count() == 2001


def test_profile_is_one_partial_aggregate(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        *[F.col(c).cast("string") for c in ["l_orderkey", "l_quantity", "l_shipdate", "l_returnflag"]])
    plan = _executed(profile_columns(li))
    assert plan.count("Exchange") == 1
    assert "partial_count" in _below_first_exchange(plan)


def test_top_values_limit_runs_before_the_shuffle(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select(
        F.col("l_suppkey").cast("string"), F.col("l_returnflag"))
    df = distinct_values(li, ["l_suppkey", "l_returnflag"], top_n=3)
    plan = _executed(df)
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert any("Partial" in line for line in limits)
    assert "WindowGroupLimit" in _below_first_exchange(plan[plan.index("Final"):])


def test_bucketed_publish_does_not_shuffle_the_target(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # as for a large stage
    try:
        base = spark.range(2000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
        t = VersionedTable(spark, str(tmp_path / "t"), ["k"], 8)
        t.write(base)
        stage = spark.range(1500, 2500).select(F.col("id").alias("k"), F.lit("new").alias("v")).repartition(8, "k")
        plan = _executed(upsert(t.read(), stage, ["k"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("SortMergeJoin"):]
    target_side = join[:join.index("FileScan")]
    assert "Exchange" not in target_side                              # bucketed scan, no shuffle


def test_one_big_quoted_file_is_read_in_many_splits(spark, tmp_path):
    rows = ['"h1","h2"'] + [f'"{i}","line\nnext {i}"' for i in range(3000)]
    write(tmp_path / "big.csv", "\n".join(rows) + "\n")
    out = str(tmp_path / "out")
    recs = quoted_records(spark, [str(tmp_path / "big.csv")], out, split_bytes=4096)
    assert recs.count() == 3000
    assert spark.read.parquet(f"{out}/splits").count() > 10            # many tasks, not one


def test_file_verdict_broadcasts_the_bad_file_list(spark, tmp_path):
    from flatland.operators.land import LandingField, land_feed
    from flatland.plans.feed import Feed
    feed_dir = tmp_path / "feed"
    write(feed_dir / "good.txt", "k\tv\n" + "".join(f"{i}\tx\n" for i in range(500)))
    write(feed_dir / "bad.txt", "k\tv\n1\tx\nnope\ty\n")
    res = land_feed(spark, Feed("f", str(feed_dir)), [LandingField("k", "float64")], "2024-01-01 00:00:00")
    plan = _executed(res.rows)
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "SortMergeJoin" not in plan
    assert res.rows.count() == 500


def test_partitioned_publish_reads_only_touched_partitions(spark, tmp_path):
    from flatland.operators.publish import PartitionedTable
    t = PartitionedTable(spark, str(tmp_path / "t"), ["k"], part_expr=F.floor(F.col("k") / 10))
    t.write(spark.range(100).select(F.col("id").alias("k"), F.lit("v").alias("v")))
    hit = t._folders(t.commit(), {"2", "7"})
    assert {f.split("/_folder=")[1].split("/")[0] for f in hit.inputFiles()} == {"2", "7"}           # only two partition folders read
    assert sorted(r["k"] // 10 for r in hit.collect()) == [2] * 10 + [7] * 10
