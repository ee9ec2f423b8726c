"""Counters, summary, retention, manifest and incremental landing."""

import datetime as dt

from pyspark.sql import functions as F

from flatland.operators.metrics import (flatten_summary, load_counters, load_summary, new_files, reconcile,
                                        retention, retention_report)
from flatland.operators.land import LandingField
from flatland.plans.feed import Feed
from flatland.streaming.incremental import incremental_land, read_counters, read_landed
from tests.conftest import write

T = dt.datetime


def test_counters_three_levels(spark):
    rows = [("f1", "a.txt"), ("f1", "a.txt"), ("f1", "b.txt"), ("f2", "c.txt")]
    df = spark.createDataFrame(rows, "feed string, load_file_name string")
    got = {(r["level"], r["feed"], r["load_file_name"]): (r["records"], r["records_text"])
           for r in load_counters(df).collect()}
    assert got[("job", None, None)] == (4, "4")
    assert got[("folder", "f1", None)] == (3, "3")
    assert got[("file", "f1", "a.txt")] == (2, "2")


def test_summary_nesting_and_reconcile(spark):
    files = spark.createDataFrame(
        [("f1", "a.txt", 1200, 1200, "loaded", None, T(2024, 1, 1, 0, 0, 0), T(2024, 1, 1, 0, 0, 9)),
         ("f1", "b.txt", 5, 3, "loaded", None, T(2024, 1, 1, 0, 0, 1), T(2024, 1, 1, 0, 0, 2)),
         ("f2", "c.txt", 2, 0, "bad", "bad number in x", T(2024, 1, 1), T(2024, 1, 1))],
        "feed string, load_file_name string, raw_records long, records_loaded long, status string, reason string, "
        "file_start timestamp_ntz, file_end timestamp_ntz")
    s = load_summary(files, "job").first()
    assert (s["jobFoldersProcessed"], s["jobFilesLoaded"], s["jobRecordsLoaded"], s["jobBadFiles"]) == (2, 2, 1203, 1)
    assert s["jobTotalDuration"] == "9 seconds"
    flat = {r["fileName"]: r["fileRecordsLoaded"] for r in flatten_summary(load_summary(files, "job")).collect()}
    assert flat == {"a.txt": 1200, "b.txt": 3, "c.txt": 0}
    warn = {r["load_file_name"]: r["load_warning"] for r in reconcile(files).collect()}
    assert warn["b.txt"] == "3 records loaded of 5 in source file (2 records difference)"
    assert warn["a.txt"] is None and warn["c.txt"] is None


def test_retention_whole_days(spark):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    df = spark.createDataFrame([(T(2024, 1, 22, 0, 0, 1),), (T(2024, 1, 22, 0, 0, 0),), (T(2024, 1, 21, 23, 59),),
                                (T(2024, 1, 20, 23, 59),)], "ts timestamp_ntz")
    kept, expired = retention(df, "ts", now, 10)
    # Age is whole days, floored; only an age strictly above the limit expires.
    assert sorted(r["age_days"] for r in kept.collect()) == [9, 10, 10]
    assert [r["age_days"] for r in expired.collect()] == [11]
    rep = retention_report(df.withColumn("g", F.lit("x")), "ts", now, 9, "g").first()
    assert (rep["kept_rows"], rep["expired_rows"], rep["oldest_kept_age_days"]) == (1, 3, 9)


def test_manifest(spark):
    listing = spark.createDataFrame([("a.txt",), ("b.txt",), ("c.txt",)], "load_file_name string")
    manifest = spark.createDataFrame([("a.txt",)], "load_file_name string")
    assert sorted(r[0] for r in new_files(listing, manifest, manifest_rows=1).collect()) == ["b.txt", "c.txt"]


def test_incremental_landing_loads_each_file_once(spark, tmp_path):
    incoming, sink = tmp_path / "in", str(tmp_path / "sink")
    ckpt, archive = str(tmp_path / "ckpt"), str(tmp_path / "archive")
    head = "k\tv"
    feed = Feed("s", str(incoming))
    write(incoming / "a.txt", head + "\n1\tx\n2\ty\n")
    write(incoming / "b.txt", head + "\n3\tz\n")
    incremental_land(spark, feed, [LandingField("k", "float64")], sink, ckpt, "2024-01-01 00:00:00",
                     archive_dir=archive)
    write(incoming / "c.txt", head + "\n4\tw\n5\tbad\n")
    write(incoming / "d.txt", head + "\nnot-a-number\tq\n")
    incremental_land(spark, feed, [LandingField("k", "float64")], sink, ckpt, "2024-01-01 00:00:00",
                     archive_dir=archive)
    incremental_land(spark, feed, [LandingField("k", "float64")], sink, ckpt, "2024-01-01 00:00:00",
                     archive_dir=archive)   # nothing new: no reload
    got = sorted(r["k"] for r in read_landed(spark, sink).collect())
    assert got == [1.0, 2.0, 3.0, 4.0, 5.0]   # d.txt is bad and lands nothing


def test_incremental_landing_binds_columns_by_name(spark, tmp_path):
    incoming, sink, ckpt = tmp_path / "in", str(tmp_path / "sink"), str(tmp_path / "ckpt")
    feed = Feed("s", str(incoming))
    write(incoming / "a.txt", "k\tv\n1\tx\n")
    write(incoming / "b.txt", "V\tK\ny\t2\n")          # other order, other spelling
    incremental_land(spark, feed, [LandingField("k", "float64")], sink, ckpt, "2024-01-01 00:00:00")
    got = sorted((r["k"], r["v"]) for r in read_landed(spark, sink).collect())
    assert got == [(1.0, "x"), (2.0, "y")]
    counters = {r["load_file_name"]: (r["records_loaded"], r["status"]) for r in read_counters(spark, sink).collect()}
    assert counters == {"a.txt": (1, "loaded"), "b.txt": (1, "loaded")}


def test_expire_runs_whole_days(spark, tmp_path):
    import os
    import time

    from flatland.operators.metrics import expire_runs
    day = 86_400_000
    now = int(time.time() * 1000)
    for name, age_days in [("r_new", 0), ("r_ten", 10), ("r_ten_and_half", 10.5), ("r_eleven", 11)]:
        d = tmp_path / "runs" / name
        d.mkdir(parents=True)
        stamp = (now - int(age_days * day)) / 1000
        os.utime(d, (stamp, stamp))
    root = f"file:{tmp_path / 'runs'}"
    assert [p.rsplit("/", 1)[-1] for p in expire_runs(spark, root, now, 10, dry_run=True)] == ["r_eleven"]
    expire_runs(spark, root, now, 10)
    assert sorted(os.listdir(tmp_path / "runs")) == ["r_new", "r_ten", "r_ten_and_half"]


def test_summary_without_file_times(spark):
    from flatland.operators.metrics import flatten_summary, load_summary
    files = spark.createDataFrame([("f", "a.txt", 3, 3, "loaded", None), ("f", "b.txt", 2, 0, "bad", "bad number in k")],
                                  "feed string, load_file_name string, raw_records long, records_loaded long, "
                                  "status string, reason string")
    summary = load_summary(files, "job")
    row = summary.collect()[0]
    assert (row["jobFilesLoaded"], row["jobRecordsLoaded"], row["jobBadFiles"]) == (1, 3, 1)
    assert sorted(r["fileName"] for r in flatten_summary(summary).collect()) == ["a.txt", "b.txt"]
