"""Run metrics, load summary, manifest and retention.

Records are counted per file first; counters for job, folder and file are then
one ``rollup`` with ``grouping_id`` over that small table (A1, A2, A11). The
load summary has one row per folder, with the job's totals, the folder's and
its files[] (K7): run metadata, never data rows, and never a whole job in one row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatland.functions.casts import age_days, duration_text
from flatland.operators.joins import join_small

LEVELS = {0: "file", 1: "folder", 3: "job"}


def load_counters(rows: DataFrame, feed_col: str = "feed", file_col: str = "load_file_name",
                  start_col: str | None = None, end_col: str | None = None) -> DataFrame:
    """Records per file, per folder and for the job in one pass.

    ``rows`` is one row per landed record (or per file with a ``records``
    column summed instead). Start/end columns give min/max times per level.
    """
    first = [F.count(F.lit(1)).alias("records")]
    aggs = [F.sum("records").alias("records"), F.count_distinct(file_col).alias("files")]
    if start_col:
        first += [F.min(start_col).alias("level_start"), F.max(end_col or start_col).alias("level_end")]
        aggs += [F.min("level_start").alias("level_start"), F.max("level_end").alias("level_end")]
    per_file = rows.groupBy(feed_col, file_col).agg(*first)
    out = per_file.rollup(feed_col, file_col).agg(*aggs, F.grouping_id().alias("gid"))
    out = out.withColumn("level", F.element_at(F.create_map(*[x for k, v in LEVELS.items()
                                                             for x in (F.lit(k), F.lit(v))]), F.col("gid")))
    out = out.withColumn("records_text", F.format_number(F.col("records"), 0))
    if start_col:
        secs = F.timestamp_diff("SECOND", F.col("level_start"), F.col("level_end"))
        out = out.withColumn("duration_seconds", secs).withColumn("duration_text", duration_text(secs))
    return out.drop("gid")


def error_counters(files: DataFrame) -> DataFrame:
    """Bad files and reconciliation warnings per feed and for the job."""
    warn = (F.col("status") == "loaded") & (F.col("records_loaded") != F.col("raw_records"))
    return (files.rollup("feed")
            .agg(F.count_if(F.col("status") == "bad").alias("bad_files"),
                 F.count_if(warn).alias("warnings"),
                 F.count_if(F.col("status") != "bad").alias("files_loaded"),
                 F.sum("records_loaded").alias("records_loaded")))


def reconcile(files: DataFrame) -> DataFrame:
    """Loaded vs physical lines per file; a difference is a warning when rows loaded (V6)."""
    diff = F.col("raw_records") - F.col("records_loaded")
    return files.withColumn(
        "load_warning",
        F.when((F.col("records_loaded") > 0) & (diff != 0),
               F.format_string("%s records loaded of %s in source file (%s records difference)",
                               F.format_number("records_loaded", 0), F.format_number("raw_records", 0),
                               F.format_number(diff, 0))))


def load_summary(files: DataFrame, job_name: str) -> DataFrame:
    """One row per folder: the job's totals, the folder's, and its files[] (K7).

    ``files`` has feed, load_file_name, raw_records, records_loaded, status,
    reason and, when known, file_start and file_end (else they are null).
    """
    for c in ("file_start", "file_end"):
        if c not in files.columns:
            files = files.withColumn(c, F.lit(None).cast("timestamp_ntz"))
    per_file = files.select(
        "feed",
        F.struct(F.col("load_file_name").alias("fileName"),
                 F.col("raw_records").alias("fileRawRecords"),
                 F.col("records_loaded").alias("fileRecordsLoaded"),
                 F.col("file_start").alias("fileStart"), F.col("file_end").alias("fileEnd"),
                 duration_text(F.timestamp_diff("SECOND", "file_start", "file_end")).alias("fileTotalDuration"),
                 F.col("reason").alias("fileLoadError")).alias("file"),
        "records_loaded", "status", "file_start", "file_end")
    folders = per_file.groupBy("feed").agg(
        F.count_if(F.col("status") != "bad").alias("folderFilesLoaded"),
        F.sum("records_loaded").alias("folderRecordsLoaded"),
        F.count_if(F.col("status") == "bad").alias("folderBadFiles"),
        F.min("file_start").alias("folderStart"), F.max("file_end").alias("folderEnd"),
        F.sort_array(F.collect_list("file")).alias("files"))
    folders = folders.withColumn("folderTotalDuration",
                                 duration_text(F.timestamp_diff("SECOND", "folderStart", "folderEnd")))
    folders = folders.withColumnRenamed("feed", "folderPath").withColumn("jobName", F.lit(job_name))
    job = folders.groupBy("jobName").agg(
        F.count(F.lit(1)).alias("jobFoldersProcessed"),
        F.sum("folderFilesLoaded").alias("jobFilesLoaded"),
        F.sum("folderRecordsLoaded").alias("jobRecordsLoaded"),
        F.sum("folderBadFiles").alias("jobBadFiles"),
        F.min("folderStart").alias("jobStart"), F.max("folderEnd").alias("jobEnd"))
    job = job.withColumn("jobTotalDuration", duration_text(F.timestamp_diff("SECOND", "jobStart", "jobEnd")))
    return folders.join(F.broadcast(job), "jobName")        # the job's totals are a single row


def flatten_summary(summary: DataFrame) -> DataFrame:
    """Back from the folders' rows to one row per file."""
    return summary.select("jobName", F.col("folderPath").alias("folder"), F.explode("files").alias("file")).select("jobName", "folder", "file.*")


def retention(df: DataFrame, ts_col: str, now: Column, keep_days: int) -> tuple[DataFrame, DataFrame]:
    """(kept, expired): rows whose age in whole days exceeds ``keep_days`` expire."""
    aged = df.withColumn("age_days", age_days(F.col(ts_col), now))
    return aged.filter(F.col("age_days") <= keep_days), aged.filter(F.col("age_days") > keep_days)


def retention_report(df: DataFrame, ts_col: str, now: Column, keep_days: int, by: str) -> DataFrame:
    """What expires, per group (R3): kept and expired counts in one pass."""
    aged = df.withColumn("age_days", age_days(F.col(ts_col), now))
    expired = F.col("age_days") > keep_days
    return aged.groupBy(by).agg(
        F.count_if(~expired).alias("kept_rows"),
        F.count_if(expired).alias("expired_rows"),
        F.max(F.when(~expired, F.col("age_days"))).alias("oldest_kept_age_days"))


def new_files(listing: DataFrame, manifest: DataFrame, on: str = "load_file_name",
              manifest_rows: int | None = None) -> DataFrame:
    """Files in the folder that the manifest has not recorded yet (K6)."""
    return join_small(listing, manifest.select(on), on, "left_anti", manifest_rows)


def expire_runs(spark, runs_root: str, now_ms: int, keep_days: int, dry_run: bool = False, name: str = ".*") -> list[str]:
    """Delete run folders older than ``keep_days`` whole days (R1, R2, K10), of those whose whole name matches ``name`` (a pattern).

    A run folder holds one run's parsed rows, stage, file counters and
    quarantine list: the archive and the logs of a load. Age is whole days
    since the folder was last modified, floored, and a folder expires when it
    is strictly older than ``keep_days`` (as ``retention``). Only folder
    metadata is listed; returns the folders removed (or that would be).
    """
    from flatland import storage
    gone = []
    for path, is_dir, modified_ms in storage.list_dir_times(spark, runs_root):
        mine = re.fullmatch(name, path.rstrip("/").rsplit("/", 1)[-1]) is not None
        if is_dir and mine and (now_ms - modified_ms) // 86_400_000 > keep_days:
            if not dry_run:
                storage.delete(spark, path)
            gone.append(path)
    return sorted(gone)
