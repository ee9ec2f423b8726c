"""Profiler, type inference, spec building and spec-driven plans."""

from pyspark.sql import functions as F

from flatland.operators.profile import distinct_values, infer_types, profile_columns
from flatland.operators.validate import key_check
from flatland.plans.run import run_feed
from flatland.plans.spec import build_spec, plan_from_spec, read_spec, spec_layers, write_spec
from flatland.operators.publish import VersionedTable
from flatland.plans.feed import Feed
from tests.conftest import write

NAMES = {"wrk_schema": "w", "wrk_table": "wrk_t", "stg_schema": "s", "stg_table": "stg_t",
         "tgt_schema": "g", "tgt_table": "t"}


def infer(spark, cols: dict):
    n = max(len(v) for v in cols.values())
    rows = [tuple(cols[c][i] if i < len(cols[c]) else None for c in cols) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))
    return {r["column_name"]: (r["landing_type"], r["db_type"]) for r in infer_types(profile_columns(df)).collect()}


def test_inference_rules(spark):
    got = infer(spark, {
        "ints": ["1", "2", "2147483647"],
        "bigs": ["1", "2147483648"],
        "negs": ["-2147483649", "5"],
        "huge": ["1e19", "3"],
        "decs": ["0.5", "12.25", "-1.5"],
        "dates": ["01/21/2001", "2001-02-03"],
        "stamps": ["2001-02-03 04:05:06", "2001-02-03"],
        "text": ["a", "bb", "ccc"],
        "one": ["x", "y"],
        "empty": [None, None],
        "sizes": ["x" * 77],
    })
    assert got["ints"] == ("float64", "integer")
    assert got["bigs"] == ("float64", "bigint")
    assert got["negs"] == ("float64", "bigint")
    assert got["huge"] == ("float64", "decimal(38,0)")
    assert got["decs"] == ("float64", "decimal(7,3)")      # left 3 ('-1', '12'), right 2 -> s=3, p=2+3+2
    assert got["dates"] == ("date", "date")
    assert got["stamps"] == ("timestamp", "timestamp(0)")
    assert got["text"] == ("string", "varchar(10)")
    assert got["one"] == ("string", "varchar(1)")
    assert got["empty"] == ("string", "varchar(?)")
    assert got["sizes"] == ("string", "varchar(255)")      # floor(77*1.3)=100 -> first size above is 255


def test_text_past_the_ladder_is_unbounded(spark, feed_dir, tmp_path):
    assert infer(spark, {"long": ["x" * 4001]})["long"] == ("string", "text")
    write(feed_dir / "a.txt", "id\tbody\n1\t" + "w " * 4999 + "end\n")
    rows = spark.createDataFrame([("1", "w " * 4999 + "end")], "id string, body string")
    spec = build_spec(spark, infer_types(profile_columns(rows)), NAMES)
    spec = spec.withColumn("pk", F.when((F.col("layer") == "tgt") & (F.col("target_field") == "id"), "x"))
    target = VersionedTable(spark, str(tmp_path / "t"), ["id"], 4)
    run_feed(spark, Feed("a", str(feed_dir)), plan_from_spec(spec), target, "2024-01-01 00:00:00")
    assert target.read().first()["body"] == "w " * 4999 + "end"


def test_varchar_ladder_edges(spark):
    got = infer(spark, {"l7": ["x" * 7], "l8": ["x" * 8], "l4000": ["x" * 4000]})
    assert got["l7"][1] == "varchar(10)" and got["l8"][1] == "varchar(20)" and got["l4000"][1] == "varchar(4000)"


def test_distinct_values_top_n(spark):
    df = spark.createDataFrame([(v,) for v in "aaabbc"], "c string")
    rows = [(r["value"], r["frequency"], r["rank"], r["n_distinct"]) for r in
            distinct_values(df, ["c"], top_n=2).orderBy("rank").collect()]
    assert rows == [("a", 3, 1, 3), ("b", 2, 2, 3)]


def test_key_check(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 3), (2, 2), (2, 2)], "a long, b long")
    r = key_check(df, ["a", "b"], "t").first()
    assert (r["is_unique"], r["no_nulls"], r["duplicate_keys"], r["null_key_rows"], r["sample"]) == \
        (False, False, 2, 1, "1|1,2|2")


def test_spec_roundtrip_and_plan(spark, tmp_path):
    df = spark.createDataFrame([("1", "Widget", "2.50", "2024-01-02"), ("2", "Gadget", "10.25", "2024-02-03")],
                               "`Product ID` string, `Name` string, `Unit Price` string, `Order Date` string")
    spec = build_spec(spark, infer_types(profile_columns(df)), NAMES)
    layers = [(r["layer"], r["target_table"]) for r in spec_layers(spec).collect()]
    assert layers == [("wrk", "wrk_t"), ("stg", "stg_t"), ("tgt", "t")]
    spec = spec.withColumn("pk", F.when((F.col("layer") == "tgt") & (F.col("target_field") == "product_id"),
                                        F.lit("Y")).otherwise(F.col("pk")))
    write_spec(spec, str(tmp_path / "spec"))
    plan = plan_from_spec(read_spec(spark, str(tmp_path / "spec")))
    assert [f.source for f in plan.landing] == ["product_id", "name", "unit_price", "order_date",
                                                "load_file_name", "load_timestamp"]
    assert [m.target for m in plan.stage] == ["product_id", "name", "unit_price", "order_date",
                                              "load_file_name", "load_timestamp"]
    assert plan.keys == ["product_id"]
    assert [(f.name, f.nullable) for f in plan.target_schema.fields][0] == ("product_id", False)
    # Run the plan over a file with that layout.
    feed = tmp_path / "feed"
    write(feed / "p.txt", "Product ID\tName\tUnit Price\tOrder Date\n1\tWidget\t2.50\t2024-01-02\n"
                          "2\tGadget\t10.25\t2024-02-03\n1\tWidget v2\t2.75\t2024-01-05\n")
    target = VersionedTable(spark, str(tmp_path / "tgt"))
    run = run_feed(spark, Feed("p", str(feed)), plan, target, "2024-03-01 00:00:00")
    out = {r["product_id"]: (r["name"], float(r["unit_price"])) for r in target.read(run.target_version).collect()}
    # Both rows of key 1 come from one file and one job: the tie-breaker picks the larger remaining values.
    assert out == {1: ("Widget v2", 2.75), 2: ("Gadget", 10.25)}
