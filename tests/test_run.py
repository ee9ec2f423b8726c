"""Feed sweep and required settings."""

import pytest
from pyspark.sql import functions as F

from flatland.operators.land import LandingField
from flatland.operators.publish import VersionedTable
from flatland.operators.stage import ColumnMap, Step
from flatland.plans.feed import Feed
from flatland.plans.run import run_all, run_feed
from flatland.plans.spec import SpecPlan, build_spec
from pyspark.sql import types as T
from tests.conftest import write


def plan(keys=("k",)):
    return SpecPlan(
        landing=[LandingField("k", "float64")],
        stage=[ColumnMap("k", "k", "bigint"), ColumnMap("v", "v", "varchar(5)"),
               ColumnMap("load_file_name", "load_file_name", "varchar(255)"),
               ColumnMap("load_timestamp", "load_timestamp", "timestamp(0)")],
        target=[ColumnMap("k", "k", "bigint"), ColumnMap("v", "v", "varchar(5)"),
                ColumnMap("load_file_name", "load_file_name", "varchar(255)"),
                ColumnMap("load_timestamp", "load_timestamp", "timestamp(0)")],
        keys=list(keys),
        stage_schema=T.StructType([]),
        target_schema=T.StructType.fromDDL("k long, v string, modify_date_time timestamp_ntz, load_file_name string, "
                                           "load_timestamp timestamp_ntz"),
        tables={})


def test_sweep_skips_ignored_and_isolates_failures(spark, tmp_path):
    for name in ("good", "broken", "skipped"):
        write(tmp_path / name / "a.txt", "k\tv\n1\tone\n2\ttwo\n1\tuno\n")
    feeds = [Feed("good", str(tmp_path / "good")), Feed("broken", str(tmp_path / "broken")),
             Feed("skipped", str(tmp_path / "skipped"), ignore=True)]
    plans = {"good": plan(), "broken": plan(keys=()), "skipped": plan()}
    targets = {n: VersionedTable(spark, str(tmp_path / f"tgt_{n}"), ["k"], 4) for n in plans}
    runs = {r.feed: r for r in run_all(spark, feeds, plans, targets, "2024-01-01 00:00:00")}
    assert set(runs) == {"good", "broken"}
    assert runs["broken"].error and "key" in runs["broken"].error
    out = {r["k"]: r["v"] for r in targets["good"].read().collect()}
    assert out == {1: "uno", 2: "two"}
    assert runs["good"].target_version == 1


def test_steps_run_only_when_rows_loaded(spark, tmp_path):
    write(tmp_path / "f" / "a.txt", "k\tv\n")
    target = VersionedTable(spark, str(tmp_path / "t"), ["k"], 4)
    run = run_feed(spark, Feed("f", str(tmp_path / "f")), plan(), target, "2024-01-01 00:00:00",
                   stage_steps=[Step("never", "delete", pred=F.lit(True))])
    assert run.stage_path is None and run.target_version is None and target.versions() == []


def test_cut_cells_are_in_the_file_report(spark, tmp_path):
    write(tmp_path / "f" / "a.txt", "k\tv\n1\tabcde\n2\tabcdef\n3\tabcdefg\n")
    write(tmp_path / "f" / "b.txt", "k\tv\n4\tabc\n")
    target = VersionedTable(spark, str(tmp_path / "t"), ["k"], 4)
    run = run_feed(spark, Feed("f", str(tmp_path / "f")), plan(), target, "2024-01-01 00:00:00")
    cut = {r["load_file_name"]: r["cells_cut"] for r in spark.read.parquet(run.files_path).collect()}
    assert cut == {"a.txt": {"v": 2, "load_file_name": 0}, "b.txt": {"v": 0, "load_file_name": 0}}


def test_required_settings(spark):
    df = spark.createDataFrame([("c", 1, "string", "varchar(10)")], "column_name string, position int, "
                                                                     "landing_type string, db_type string")
    with pytest.raises(ValueError, match="stg_table"):
        build_spec(spark, df, {"wrk_schema": "w", "wrk_table": "w", "stg_schema": "s", "stg_table": "",
                               "tgt_schema": "t", "tgt_table": "t"})


def test_feed_into_partitioned_target(spark, tmp_path):
    from flatland.operators.publish import PartitionedTable
    target = PartitionedTable(spark, str(tmp_path / "t"), ["k"], part_expr=F.floor(F.col("k") / 10))
    write(tmp_path / "f1" / "a.txt", "k\tv\n1\tone\n2\ttwo\n15\tfif\n")
    run_feed(spark, Feed("f", str(tmp_path / "f1")), plan(), target, "2024-01-01 00:00:00")
    assert target.partitions() == ["_key_part=0", "_key_part=1"]
    write(tmp_path / "f2" / "b.txt", "k\tv\n2\tdos\n31\tthirt\n")
    run_feed(spark, Feed("f", str(tmp_path / "f2")), plan(), target, "2024-01-02 00:00:00",
             target_steps=[Step("shout", "update", pred=F.col("k") == 1, assignments={"v": "ONE"})])
    out = {r["k"]: r["v"] for r in target.read().collect()}
    assert out == {1: "ONE", 2: "dos", 15: "fif", 31: "thirt"}


def test_run_keeps_file_counters_and_quarantine(spark, tmp_path):
    write(tmp_path / "q" / "a.txt", "k\tv\n1\tone\n")
    write(tmp_path / "q" / "b.txt", "k\tv\nx\tbad\n")
    target = VersionedTable(spark, str(tmp_path / "t"), ["k"], 4)
    run = run_feed(spark, Feed("q", str(tmp_path / "q")), plan(), target, "2024-01-01 00:00:00")
    files = {r["load_file_name"]: r["status"] for r in spark.read.parquet(run.files_path).collect()}
    assert files == {"a.txt": "loaded", "b.txt": "bad"}
    q = spark.read.parquet(run.quarantine_path).collect()
    assert [(r["load_file_name"], r["reason"]) for r in q] == [("b.txt", "bad number in k")]


def test_expiry_takes_only_the_feeds_own_run_folders(spark, tmp_path):
    import os
    import time

    from flatland.operators.metrics import expire_runs
    from flatland.session import run_name
    names = ["feed-sales-0123456789ab", "feed-sales-eu-0123456789ab", "feed-sales-0123456789ab-0123456789ab", "feed-salesx-0123456789ab"]
    old = time.time() - 9 * 86_400
    for n in names:
        (tmp_path / n).mkdir()
        os.utime(tmp_path / n, (old, old))
    gone = expire_runs(spark, str(tmp_path), int(time.time() * 1000), 5, name=run_name("feed-sales"))
    assert [g.rsplit("/", 1)[-1] for g in gone] == names[:1]
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(names[1:])


def test_a_file_replaced_while_it_loads_is_loaded_again(spark, tmp_path):
    import os

    folder = tmp_path / "f"
    write(folder / "a.txt", "k\tv\n1\tone\n")
    os.utime(folder / "a.txt", (1_700_000_000, 1_700_000_000))
    target = VersionedTable(spark, str(tmp_path / "t"), ["k"], 4)

    def replace_it(df):
        if "dos" not in (folder / "a.txt").read_text():
            write(folder / "a.txt", "k\tv\n1\tone\n2\tdos\n")
        return df
    step = Step("a new delivery", "transform", fn=replace_it)
    manifest = str(tmp_path / "manifest")
    run_feed(spark, Feed("f", str(folder)), plan(), target, "2024-01-01 00:00:00", stage_steps=[step], manifest=manifest)
    assert {r["k"] for r in target.read().collect()} == {1}
    run_feed(spark, Feed("f", str(folder)), plan(), target, "2024-01-02 00:00:00", manifest=manifest)
    assert {r["k"] for r in target.read().collect()} == {1, 2}
    again = run_feed(spark, Feed("f", str(folder)), plan(), target, "2024-01-03 00:00:00", manifest=manifest)
    assert again.stage_path is None


def test_files_of_one_stem_are_subjects_of_their_own(spark, tmp_path):
    from flatland.plans.analyze import analyze_folder, profile_folder, subjects
    write(tmp_path / "in" / "sales.csv", "id,amount\n1,2.5\n")
    write(tmp_path / "in" / "sales.txt", "id\tname\n1\tx\n")
    write(tmp_path / "in" / "Sales Csv.tab", "id\tother\n7\ty\n")
    got = {(r["subject"], r["column_name"], r["position"]) for r in profile_folder(spark, str(tmp_path / "in")).collect()}
    assert got == {("sales_csv_2", "id", 1), ("sales_csv_2", "amount", 2), ("sales_txt", "id", 1), ("sales_txt", "name", 2),
                   ("sales_csv", "id", 1), ("sales_csv", "other", 2)}
    assert subjects(["x/a.csv", "x/b.csv.gz"]) == {"a.csv": "a", "b.csv.gz": "b"}
    analyze_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "settings")).count() == 3
    assert {r["subject"] for r in spark.read.option("header", True).csv(str(tmp_path / "out" / "profile")).collect()} == {"sales_csv", "sales_txt", "sales_csv_2"}
    distinct = spark.read.option("header", True).csv(str(tmp_path / "out" / "distinct")).collect()
    assert ("sales_txt", "name", "x", "1", "1") in {(r["subject"], r["column_name"], r["value"], r["frequency"], r["n_distinct"]) for r in distinct}


def test_analyzer_writes_a_spec_for_each_subject_and_needs_its_settings(spark, tmp_path):
    from flatland.plans.analyze import analyze_folder
    from flatland.plans.spec import plan_from_spec, read_spec
    write(tmp_path / "in" / "sales.csv", "id,day\n1,13/01/2024\n2,01/02/2024\n")
    with pytest.raises(ValueError, match="stg"):
        analyze_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"), schemas={"wrk": "w", "tgt": "t"})
    analyze_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"), schemas={"wrk": "w", "stg": "s", "tgt": "t"})
    plan_ = plan_from_spec(read_spec(spark, str(tmp_path / "out" / "specs" / "sales")))
    assert [(f.source, f.type, f.layout) for f in plan_.landing if f.source in ("id", "day")] == [("id", "number", None), ("day", "date", "d/M/yyyy")]
    assert plan_.tables["tgt"] == "t.sales"
