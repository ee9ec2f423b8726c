"""Publish into a key-partitioned target rewrites only the partitions the stage touches."""

import threading

import pytest
from pyspark.sql import functions as F

from flatland import storage
from flatland.operators import publish
from flatland.operators.publish import ConcurrentPublish, PartitionedTable, publish_partitions, upsert


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    base = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    root = str(tmp_path / "tgt")
    t = PartitionedTable(spark, root, ["k"], part_expr=F.floor(F.col("k") / 10))
    t.write(base)
    assert len(t.partitions()) == 10
    before = t.commit().folders
    stage = spark.createDataFrame([(5, -1), (15, -2), (205, -3), (None, -4)], "k long, v long")
    touched = publish_partitions(spark, stage, t)
    assert touched == [0, 1, 20]
    after = t.commit().folders
    assert {p for p in after if after[p] != before.get(p)} == {"0", "1", "20"}          # the others keep their files
    expected = upsert(base, stage, ["k"])
    got = t.read()
    assert got.count() == 101
    assert got.exceptAll(expected.select(*got.columns)).count() == 0
    rows = sorted(got.collect())
    publish_partitions(spark, stage, t)                    # a replay leaves the same table
    assert sorted(t.read().select(*got.columns).collect()) == rows


def test_first_publish_creates_the_table(spark, tmp_path):
    t = PartitionedTable(spark, str(tmp_path / "new"), ["k"], buckets=4)
    stage = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    publish_partitions(spark, stage, t)
    assert sorted(r["k"] for r in t.read().collect()) == [1, 2]


def _table(spark, root, rows=100):
    t = PartitionedTable(spark, root, ["k"], part_expr=F.floor(F.col("k") / 10))
    t.write(spark.range(rows).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")))
    return t


def _rows(df):
    return sorted((r["k"], r["v"]) for r in df.collect())


@pytest.mark.parametrize("fails", ["write_small_text", "create_new", "list_dir"])
def test_a_publish_that_fails_between_writes_leaves_the_old_table(spark, tmp_path, monkeypatch, fails):
    t = _table(spark, str(tmp_path / "t"))
    old = _rows(t.read())
    stage = spark.createDataFrame([(k, -k) for k in range(0, 300, 7)], "k long, v long")
    real = getattr(storage, fails)

    def broken(sp, path, *a):
        if "/manifests/" in path or "/commits/c" in path or "/data/" in path:
            raise OSError("injected")
        return real(sp, path, *a)
    monkeypatch.setattr(storage, fails, broken)
    with pytest.raises(OSError):
        publish_partitions(spark, stage, t)
    monkeypatch.undo()
    assert _rows(t.read()) == old and t.commits() == [1]
    publish_partitions(spark, stage, t)
    assert _rows(t.read()) == sorted({**dict(old), **{k: -k for k in range(0, 300, 7)}}.items())


def test_a_job_that_fails_while_writing_leaves_the_old_table(spark, tmp_path):
    t = _table(spark, str(tmp_path / "t"))
    old = _rows(t.read())
    stage = spark.range(50).select(F.col("id").alias("k"), F.when(F.col("id") == 44, F.raise_error(F.lit("injected"))).otherwise(F.col("id")).cast("long").alias("v"))
    with pytest.raises(Exception, match="injected"):
        publish_partitions(spark, stage, t)
    assert _rows(t.read()) == old


def test_readers_see_the_old_table_or_the_new_one(spark, tmp_path):
    t = _table(spark, str(tmp_path / "t"))
    held = t.read()
    seen, stop = [], threading.Event()

    def watch():
        while not stop.is_set():
            values = {r["v"] < 0 for r in t.read().where("k < 100").select("v").collect()}
            seen.append(values)
    watcher = threading.Thread(target=watch)
    watcher.start()
    for sign in (-1, 1, -1):
        publish_partitions(spark, spark.range(100).select(F.col("id").alias("k"), (sign * (F.col("id") + 1)).alias("v")), t)
    stop.set()
    watcher.join()
    assert seen and all(len(v) == 1 for v in seen)                             # never some partitions old, some new
    assert _rows(held) == [(k, k * 10) for k in range(100)]                    # a reader keeps what it began with
    assert _rows(t.read(1)) == _rows(held)
    assert t.expire(1) == [1, 2, 3] and t.commits() == [4]
    assert _rows(t.read()) == [(k, -k - 1) for k in range(100)]


def test_of_two_publishes_from_one_state_one_commits(spark, tmp_path):
    t = _table(spark, str(tmp_path / "t"))
    base = t.commit()
    rows = spark.createDataFrame([(1, 1)], "k long, v long")
    t.overwrite_partitions(t.with_part(rows), base)
    with pytest.raises(ConcurrentPublish):
        t.overwrite_partitions(t.with_part(rows), base)
    assert t.commits() == [1, 2]


def test_sql_reads_one_commit_through_a_view(spark, tmp_path):
    t = _table(spark, str(tmp_path / "t"))
    t.catalog_view("partitioned_target")
    assert _rows(spark.table("partitioned_target")) == _rows(t.read())
    publish_partitions(spark, spark.createDataFrame([(5, -5), (None, 1), (1000, 1)], "k long, v long"), t)
    assert spark.table("partitioned_target").count() == 100
    t.catalog_view("partitioned_target")
    assert _rows(spark.table("partitioned_target")) == _rows(t.read())
    spark.sql("DROP VIEW partitioned_target")


def test_a_load_is_published_once_and_new_columns_read_as_null(spark, tmp_path):
    t = PartitionedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    for batch in (0, 1, 1, 0):
        publish_partitions(spark, spark.createDataFrame([(batch, batch)], "k long, v long"), t, done=("s", batch))
    assert t.commits() == [1, 2] and _rows(t.read()) == [(0, 0), (1, 1)]
    t.overwrite_partitions(t.with_part(spark.createDataFrame([(9, 9, "x")], "k long, v long, w string")))
    assert t.read().columns == ["k", "v", "w"]


def _files(t):
    return {p for f in set(t.commit().folders.values()) for p, _ in storage.list_dir(t.spark, f"{t.root}/{f}") if p.endswith(".parquet")}


def test_files_follow_the_rows_not_the_partitions(spark, tmp_path):
    t = PartitionedTable(spark, str(tmp_path / "t"), ["k"], part_expr=F.floor(F.col("k") / 2))
    for sign in (1, -1):
        publish_partitions(spark, spark.range(600).select(F.col("id").alias("k"), (sign * F.col("id")).alias("v")), t)
        assert len(t.partitions()) == 300 and len(_files(t)) <= 16
    assert _rows(t.read()) == [(k, -k) for k in range(600)]


def test_replaced_partitions_stay_hidden_and_mostly_replaced_writes_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish, "OWN_FOLDERS", 1)
    t = _table(spark, str(tmp_path / "t"))
    want = {k: k * 10 for k in range(100)}
    first = t.commit().folders["0"]
    for parts in ((0, 1, 2), (2, 3), (4, 5, 11)):
        new = {p * 10 + d: -p for p in parts for d in (0, 10 // 2)}
        publish_partitions(spark, spark.createDataFrame(sorted(new.items()), "k long, v long"), t)
        want |= new
        assert _rows(t.read()) == sorted(want.items())
        t.catalog_view("mostly_replaced")
        assert _rows(spark.table("mostly_replaced")) == sorted(want.items())
    # Of the first write's ten partitions four were left: they have moved, and its folder goes with its commits.
    folders = t.commit().folders
    assert first not in folders.values() and folders["9"] == folders["4"]
    assert _rows(t.read(1)) == [(k, k * 10) for k in range(100)]
    t.expire(1)
    assert not storage.exists(spark, f"{t.root}/{first}") and _rows(t.read()) == sorted(want.items())
    spark.sql("DROP VIEW mostly_replaced")


def test_null_partitions_are_replaced_and_read_like_others(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish, "OWN_FOLDERS", 1)
    t = PartitionedTable(spark, str(tmp_path / "t"), ["k"], part_expr=F.when(F.col("k") >= 10, F.floor(F.col("k") / 10)))
    t.write(spark.createDataFrame([(k, k) for k in (1, 2, 15, 25, 35, 45)] + [(None, 7)], "k long, v long"))
    publish_partitions(spark, spark.createDataFrame([(2, -2), (15, -15)], "k long, v long"), t)
    want = [(1, 1), (2, -2), (15, -15), (25, 25), (35, 35), (45, 45)]
    assert _rows(t.read().dropna(subset=["k"])) == want and t.read().where("k IS NULL").count() == 1
    publish_partitions(spark, spark.createDataFrame([(25, -25)], "k long, v long"), t)
    want[3] = (25, -25)
    assert _rows(t.read().dropna(subset=["k"])) == want and t.read().where("k IS NULL").count() == 1


def test_own_and_shared_folders_of_one_table(spark, tmp_path, monkeypatch):
    t = _table(spark, str(tmp_path / "t"))
    assert t.commit().files == {}
    monkeypatch.setattr(publish, "OWN_FOLDERS", 1)
    publish_partitions(spark, spark.createDataFrame([(5, -5), (15, -15)], "k long, v long"), t)
    monkeypatch.undo()
    publish_partitions(spark, spark.createDataFrame([(16, -16)], "k long, v long"), t)
    want = [(k, -k if k in (5, 15, 16) else k * 10) for k in range(100)]
    assert len(t.commit().files) == 1 and _rows(t.read()) == want
    t.catalog_view("own_and_shared")
    assert _rows(spark.table("own_and_shared")) == want
    spark.sql("DROP VIEW own_and_shared")
