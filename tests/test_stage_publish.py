"""Stage and publish: latest row per key, fix-up steps, delete-insert publish."""

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from flatland.operators.publish import VersionedTable, assert_unique_keys, publish, upsert
from flatland.operators.stage import ColumnMap, Step, dedup_latest, map_columns, run_steps

T = dt.datetime
SCHEMA = "k long, load_timestamp timestamp_ntz, load_file_name string, v string"


def test_dedup_latest_nulls_first_and_total_tie_break(spark):
    rows = [(1, T(2024, 1, 1), "a.txt", "old"), (1, T(2024, 1, 2), "a.txt", "new"),
            (2, T(2024, 1, 1), "a.txt", "x"), (2, None, "a.txt", "null-ts wins"),
            (3, T(2024, 1, 1), "b.txt", "tie-1"), (3, T(2024, 1, 1), "b.txt", "tie-2"),
            (None, T(2024, 1, 1), "a.txt", "n1"), (None, T(2024, 1, 3), "a.txt", "n2")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["k"]: r["v"] for r in dedup_latest(df, ["k"]).collect()}
    assert got == {1: "new", 2: "null-ts wins", 3: "tie-2", None: "n2"}


def test_dedup_independent_of_partitioning(spark):
    rows = [(i % 17, T(2024, 1, 1 + i % 5), f"f{i % 3}.txt", str(i)) for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    a = sorted(tuple(r) for r in dedup_latest(df, ["k"]).collect())
    b = sorted(tuple(r) for r in dedup_latest(df.repartition(11), ["k"]).collect())
    assert a == b and len(a) == 17


def test_dedup_hot_key(spark):
    # One key holds most rows; the aggregate combines it map-side, result is one row.
    rows = [(0 if i % 3 else i, T(2024, 1, 1), "f.txt", f"{i:05d}") for i in range(3000)]
    out = dedup_latest(spark.createDataFrame(rows, SCHEMA).repartition(8), ["k"])
    assert out.filter("k = 0").first()["v"] == "02999"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_steps_null_predicates_and_counts(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 50.0)], "id long, x double")
    steps = [Step("bump", "update", pred=F.col("x") > 10, assignments={"x": 99.0}),
             Step("drop", "delete", pred=F.col("x") < 10),
             Step("add", "insert", rows=spark.createDataFrame([(4, 1.0)], "id long, x double"))]
    out, counts = run_steps(df, steps)
    assert sorted(tuple(r) for r in out.collect()) == [(2, None), (3, 99.0), (4, 1.0)]
    assert [(r["step"], r["rows"]) for r in counts.orderBy("step_no").collect()] == [("bump", 1), ("drop", 1), ("add", 1)]


def test_template_steps(spark):
    """wrk->stg copy, stage fix-up, publish, two target fix-ups (the sample scripts)."""
    wrk = spark.createDataFrame([("123", 1.1, "f.txt"), ("ABC", 2.2, "f.txt"), ("A2C", 3.3, "f.txt")],
                                "record_id string, float_field_01 double, load_file_name string")
    stg = map_columns(wrk, [ColumnMap("record_id", "record_id", "varchar(10)"),
                            ColumnMap("float_field_01", "float_field_01", "decimal(6,2)"),
                            ColumnMap("load_file_name", "load_file_name", "varchar(255)")])
    stg, c1 = run_steps(stg, [Step("stage post-load 01", "update", pred=F.col("float_field_01") == 1.1,
                                   assignments={"float_field_01": 11.11})], "stage")
    tgt, c2 = run_steps(stg, [Step("target post-load 01", "update", pred=F.col("float_field_01") == 1.1,
                                   assignments={"float_field_01": 11.11}),
                              Step("target post-load 02", "update", pred=F.col("float_field_01") == 2.2,
                                   assignments={"float_field_01": 22.22})], "target")
    vals = sorted(float(r["float_field_01"]) for r in tgt.collect())
    assert vals == [3.3, 11.11, 22.22]
    assert [r["rows"] for r in c1.collect()] == [1]
    assert [r["rows"] for r in c2.orderBy("step_no").collect()] == [0, 1]


def test_upsert_null_keys(spark):
    tgt = spark.createDataFrame([(1, "t1"), (2, "t2"), (None, "tnull")], "k long, v string")
    stg = spark.createDataFrame([(2, "s2"), (3, "s3"), (None, "snull")], "k long, v string")
    got = Counter(tuple(r) for r in upsert(tgt, stg, ["k"]).collect())
    assert got == Counter([(1, "t1"), (None, "tnull"), (2, "s2"), (3, "s3")])


def test_publish_versions_and_idempotent_replay(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "tgt"))
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    table.write(base)
    stg = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    v2 = publish(spark, stg, table, ["k"])
    once = sorted(tuple(r) for r in table.read(v2).collect())
    v2_again = publish(spark, stg, table, ["k"], version=v2)      # replay of the same batch
    assert v2_again == v2 and sorted(tuple(r) for r in table.read(v2).collect()) == once
    v3 = publish(spark, stg, table, ["k"])                         # publish twice = once
    assert sorted(tuple(r) for r in table.read(v3).collect()) == once == [(1, "a"), (2, "B"), (3, "C")]
    assert table.versions() == [1, 2, 3]
    assert table.expire(keep_last=1) == [1, 2] and table.versions() == [3]


def test_assert_unique_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    try:
        assert_unique_keys(df, ["k"])
    except ValueError:
        return
    raise AssertionError("duplicate keys not reported")


def test_versioned_table_is_read_again_by_a_new_session(spark, tmp_path):
    from flatland.operators.publish import VersionedTable, publish
    df = spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.5)], "k long, v string, x double")
    t = VersionedTable(spark, str(tmp_path / "t"), ["k"], 4)
    v = t.write(df)
    spark.sql(f"DROP TABLE {t.table_name(v)}")             # as a new session's catalog would be
    again = VersionedTable(spark, str(tmp_path / "t"), ["k"], 4)
    assert sorted(r["k"] for r in again.read().collect()) == [1, 2]
    publish(spark, spark.createDataFrame([(2, "B", 0.0)], "k long, v string, x double"), again, ["k"])
    assert {r["k"]: r["v"] for r in again.read().collect()} == {1: "a", 2: "B"}


def test_duplicate_keys_are_refused_in_the_publish_itself(spark, tmp_path):
    import pytest

    from flatland.operators.publish import VersionedTable, publish
    t = VersionedTable(spark, str(tmp_path / "t"), ["k"], 4)
    publish(spark, spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), t, ["k"])
    for rows in ([(1, "x"), (1, "y")], [(9, "x"), (9, "x")]):
        with pytest.raises(ValueError, match="duplicate keys"):
            publish(spark, spark.createDataFrame(rows, "k long, v string"), t, ["k"])
    publish(spark, spark.createDataFrame([(None, "x"), (None, "y"), (2, "c")], "k long, v string"), t, ["k"])     # null keys are not published
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "a"), (2, "c")]
