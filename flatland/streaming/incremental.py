"""Each arriving file is landed once.

A file-stream source over the feed folder tracks which files have arrived;
it is a ``binaryFile`` stream that selects only path and length, so it never
reads file contents. Run with ``availableNow``, every run takes what has
arrived and stops; the checkpoint is what keeps a file from being loaded
twice, and ``cleanSource=archive`` moves consumed files away (one batch late,
so tests must not expect the newest files moved).

Each micro-batch lands its new files exactly as a batch load does
(``land_feed``): header groups bound by name, archives, quoted files in
splits, strict casts and per-file verdicts. What a batch writes (parsed rows, bad
files, per-file counters) goes to a folder of its own for each attempt; then the batch is
published (``on_batch``); last, one small file ``_batches/b<id>`` names the attempt's folder. Readers
go by these files, so they see all of a batch or nothing, and a batch that failed between any two writes is
done again from the start and leaves one result. A batch that has its file is not done again.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatland import storage
from flatland.operators.joins import join_small
from flatland.operators.land import _PATH, _REASON, _SAMPLE, _SHAPE, AUDIT_FILE, LandingField, format_job_time, land_feed, read_parsed
from flatland.operators.publish import PartitionedTable, VersionedTable, publish, publish_partitions
from flatland.operators.stage import dedup_latest
from flatland.plans.feed import Feed
from flatland.session import new_run_dir
from flatland.sources.files import feed_name_glob


# The binaryFile source's own columns; only path and length are selected.
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def incremental_land(spark: SparkSession, feed: Feed, fields: list[LandingField],
                     sink: str, checkpoint: str, job_start: datetime | str,
                     archive_dir: str | None = None,
                     on_batch: Callable[[DataFrame, int], None] | None = None,
                     max_files_per_batch: int | None = None) -> None:
    """Land whatever has arrived in ``feed.path`` since the last run, then stop."""
    job_ts = format_job_time(job_start)
    sink = sink.rstrip("/")
    stream = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", feed_name_glob(feed)))
    if archive_dir:
        stream = stream.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_batch:
        stream = stream.option("maxFilesPerTrigger", max_files_per_batch)
    arrivals = stream.load(feed.path).select("path", "length")

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        marker = f"{sink}/_batches/b{batch_id:08d}"
        if storage.exists(spark, marker):
            return
        # The batch's new files: a listing (one row per file), not data.
        paths = sorted(r["path"] for r in batch.collect())
        if not paths:
            return
        # The batch's parsed rows are written once, in its run folder; its
        # landed rows are those minus its bad files, on read (no second copy).
        attempt = f"_runs/b{batch_id:08d}-{uuid.uuid4().hex[:12]}"
        res = land_feed(spark, feed, fields, job_ts, run_dir=f"{sink}/{attempt}", paths=paths)
        res.bad.write.parquet(f"{sink}/{attempt}/bad")
        batch_counters(res.files, batch_id).write.parquet(f"{sink}/{attempt}/counters")
        if on_batch is not None:
            on_batch(res.rows, batch_id)
        storage.mkdirs(spark, f"{sink}/_batches")
        storage.create_new(spark, marker, attempt)

    q = (arrivals.writeStream.foreachBatch(land_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def batch_counters(files: DataFrame, batch_id: int) -> DataFrame:
    """Per-file counters of one micro-batch (T3): lines, rows loaded, verdict."""
    return files.select(F.lit(batch_id).cast("long").alias("batch_id"), AUDIT_FILE, "raw_records",
                        "records_loaded", "status", "reason")


def finished_batches(spark: SparkSession, sink: str) -> list[str]:
    """Folders of the batches that are done, in order."""
    sink = sink.rstrip("/")
    marks = sorted(p for p, is_dir in storage.list_dir(spark, f"{sink}/_batches") if not is_dir and not p.endswith(".crc"))
    names = [(storage.read_small_text(spark, p) or "").strip() for p in marks]
    return [f"{sink}/{n}" for n in names if n]


def read_counters(spark: SparkSession, sink: str) -> DataFrame:
    """Counters of every landed micro-batch, one row per file."""
    folders = [f"{b}/counters" for b in finished_batches(spark, sink)]
    return spark.read.parquet(*folders) if folders else spark.createDataFrame([], COUNTERS_SCHEMA)


COUNTERS_SCHEMA = f"batch_id long, {AUDIT_FILE} string, raw_records long, records_loaded long, status string, reason string"


def read_landed(spark: SparkSession, sink: str) -> DataFrame:
    """Landed rows of every batch that is done: each batch's parsed rows minus its bad files."""
    batches = finished_batches(spark, sink)
    parsed_dirs = [f"{b}/parsed" for b in batches if storage.exists(spark, f"{b}/parsed/_SUCCESS")]
    if not parsed_dirs:
        return spark.createDataFrame([], f"{AUDIT_FILE} string, load_timestamp timestamp_ntz")
    bad = spark.read.parquet(*[f"{b}/bad" for b in batches]).select(_PATH)
    return join_small(read_parsed(spark, *parsed_dirs), bad, _PATH, "left_anti", bad.count()).drop(_PATH, _REASON, _SHAPE, _SAMPLE)


def publish_batches(spark: SparkSession, target: VersionedTable | PartitionedTable, keys: list[str],
                    order_desc: list[str],
                    transform: Callable[[DataFrame], DataFrame] | None = None, stream: str = "stream") -> Callable[[DataFrame, int], None]:
    """``on_batch`` hook: stage, keep the latest row per key, publish.

    Into a ``VersionedTable`` the batch id fixes the target version
    (batch + 1), and the base is the newest version below it, so a replayed
    batch rewrites the same version; its versions are this stream's batches,
    so such a table must be the stream's own. Into a ``PartitionedTable`` each batch
    rewrites only the partitions its keys fall in, by one commit that holds the
    batch id: a batch that is in the table already is not published again. Streams
    that share such a table have a ``stream`` name each.
    """
    def run(rows: DataFrame, batch_id: int) -> None:
        staged = transform(rows) if transform else rows
        # Written once: the publish reads it for its key check, its partitions and its rows.
        path = new_run_dir(spark, "stream-batch")
        dedup_latest(staged, keys, order_desc).write.parquet(path)
        latest = spark.read.parquet(path)
        if isinstance(target, PartitionedTable):
            publish_partitions(spark, latest, target, done=(stream, batch_id))
        else:
            publish(spark, latest, target, keys, version=batch_id + 1)
        storage.delete(spark, path)
    return run

