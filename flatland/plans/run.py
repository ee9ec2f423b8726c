"""Run a feed end to end: land -> wrk -> (steps) stage -> dedup (+ steps) -> (steps) publish (+ steps).

Steps run only when at least one file loaded (D7). A failing step stops this
feed; other feeds of the sweep still run (D5). Every layer is written to the
run folder, so each stage reads a materialised input and a lost executor
costs a task retry rather than a recomputation from text.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatland import storage
from flatland.operators.land import LandResult, format_job_time, land_feed, quarantine_rows
from flatland.operators.metrics import expire_runs, load_summary
from flatland.operators.publish import PartitionedTable, VersionedTable, publish, publish_partitions
from flatland.operators.stage import Step, add_modify_stamp, cut_cells, dedup_latest, map_columns, run_steps
from flatland.plans.feed import Feed
from flatland.plans.spec import SpecPlan, enforce_schema
from flatland.session import new_run_dir, run_name, scratch_root
from flatland.sources.files import list_feed_files, listing_frame


@dataclass
class FeedRun:
    """What a feed run left behind. ``wrk_path`` holds the parsed rows of every
    file; the landing table itself is ``land.rows`` (those of good files)."""

    feed: str
    land: LandResult
    wrk_path: str
    stage_path: str | None = None
    target_version: int | None = None
    step_counts: list[DataFrame] = field(default_factory=list)
    error: str | None = None
    files_path: str | None = None
    quarantine_path: str | None = None


@dataclass(frozen=True)
class FeedSteps:
    """User steps of a feed at the four points of a load, each in order.

    ``load`` runs on the mapped rows before the latest row per key is taken,
    ``stage`` after it, ``publish`` on the rows about to be published and
    ``target`` on the whole target afterwards.
    """

    load: Sequence[Step] = ()
    stage: Sequence[Step] = ()
    publish: Sequence[Step] = ()
    target: Sequence[Step] = ()


MANIFEST_SCHEMA = ("feed string, load_file_name string, source_path string, modified_ms long, records_loaded long, "
                   "status string, load_timestamp timestamp_ntz")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Files that earlier runs have loaded (K6); empty before the first."""
    if not storage.exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def unloaded_files(spark: SparkSession, feed: Feed, manifest: str, listing: list[tuple[str, int, int]] | None = None) -> list[str]:
    """The feed's files that the manifest has not; a file delivered again (a later change) counts as new."""
    listing = list_feed_files(spark, feed) if listing is None else listing
    if not listing:
        return []
    frame = listing_frame(spark, listing).withColumn("feed", F.lit(feed.name))
    known = read_manifest(spark, manifest).select("feed", F.col("source_path").alias("path"), "modified_ms")
    # Paths only, one for each file of the folder.
    return sorted(r["path"] for r in frame.join(known, ["feed", "path", "modified_ms"], "left_anti").select("path").collect())


def run_feed(spark: SparkSession, feed: Feed, plan: SpecPlan, target: VersionedTable | PartitionedTable,
             job_start: datetime | str, stage_steps: Sequence[Step] = (),
             target_steps: Sequence[Step] = (), run_dir: str | None = None,
             steps: FeedSteps | None = None, manifest: str | None = None, keep_versions: int | None = None) -> FeedRun:
    """Load one feed.

    With ``manifest`` (a folder) files that an earlier run loaded are passed
    over, and this run's good files are added once they are published; bad
    files stay out of it and are tried again. ``feed.archive_expire_days``
    removes this feed's older run folders first. ``keep_versions`` drops all but so many
    versions of the target after the publish.
    """
    steps = steps or FeedSteps(stage=tuple(stage_steps), target=tuple(target_steps))
    if feed.archive_expire_days is not None:
        expire_runs(spark, f"{scratch_root(spark)}/runs", int(time.time() * 1000), feed.archive_expire_days, name=run_name(f"feed-{feed.name}"))   # R1
    run_dir = run_dir or new_run_dir(spark, f"feed-{feed.name}")
    job_ts = format_job_time(job_start)
    # Listed once, before anything is read: a file that is replaced while it loads has another time then, and is loaded again.
    listing = list_feed_files(spark, feed) if manifest else None
    paths = unloaded_files(spark, feed, manifest, listing) if manifest else None
    started = datetime.now()
    # Cells that the stage's varchar(n) types cut are counted per column with the files' rows.
    land = land_feed(spark, feed, plan.landing, job_ts, run_dir, paths=paths, cells_cut=lambda columns: cut_cells(plan.stage, columns))
    # K1: the landing table of this run is its parsed rows (already written
    # once) minus the bad files, a broadcast anti join on read; the landed
    # data is not copied a second time.
    wrk = land.rows
    # Per-file counters and the quarantine list of this run (K5, K7 inputs);
    # one row per file, kept with the run. Files of a feed are read together, so
    # a file's times are those of the feed's landing.
    times = {"file_start": F.lit(started).cast("timestamp_ntz"), "file_end": F.lit(datetime.now()).cast("timestamp_ntz")}
    report = land.files.withColumns(times)
    if "cells_cut" not in report.columns:
        report = report.withColumn("cells_cut", F.lit(None).cast("map<string,bigint>"))
    report.write.mode("overwrite").parquet(f"{run_dir}/files")
    files = spark.read.parquet(f"{run_dir}/files")
    quarantine_rows(files, job_ts).write.mode("overwrite").parquet(f"{run_dir}/quarantine")   # K5
    result = FeedRun(feed.name, land, land.parsed_path, files_path=f"{run_dir}/files",
                     quarantine_path=f"{run_dir}/quarantine")
    if not (files.agg(F.sum("records_loaded")).first()[0] or 0):               # D7, from the file report
        return result
    stage = _stepped(map_columns(wrk, plan.stage), steps.load, "load", result)
    if plan.keys:
        # The latest row per key first: a step that deletes it must not bring an older one back.
        stage = dedup_latest(stage, plan.keys)                                  # W1
    stage = _stepped(stage, steps.stage, "stage", result)
    stage_path = f"{run_dir}/stg"
    stage.write.mode("overwrite").parquet(stage_path)                           # K3
    result.stage_path = stage_path
    if plan.target:
        _publish(spark, feed, plan, target, job_ts, steps, result)
        if keep_versions and isinstance(target, VersionedTable):
            target.expire(keep_versions)
    if manifest:
        modified = listing_frame(spark, listing).select(F.col("path").alias("source_path"), "modified_ms")
        done = files.filter(F.col("status") != "bad").join(modified, "source_path").withColumn("load_timestamp", F.lit(job_ts).cast("timestamp_ntz"))
        done.select(*[f.name for f in T.StructType.fromDDL(MANIFEST_SCHEMA).fields]).coalesce(1).write.mode("append").parquet(manifest)   # K6
    return result


def _stepped(df: DataFrame, steps: Sequence[Step], point: str, result: FeedRun) -> DataFrame:
    out, counts = run_steps(df, steps, point)
    result.step_counts.append(counts)
    return out


def _publish(spark: SparkSession, feed: Feed, plan: SpecPlan, target: VersionedTable | PartitionedTable, job_ts: str,
             steps: FeedSteps, result: FeedRun) -> None:
    if not plan.keys:
        raise ValueError(f"feed {feed.name}: publishing needs key columns in the spec")  # D19
    tgt_keys = [m.target for m in plan.target if m.source in plan.keys]
    stamped = target_rows(plan, spark.read.parquet(result.stage_path), job_ts)
    if steps.publish:
        stamped = _stepped(stamped, steps.publish, "publish", result)
    stamped = enforce_schema(stamped.dropna(subset=tgt_keys), plan.target_schema)   # I9
    if isinstance(target, PartitionedTable):
        if list(target.keys) != tgt_keys:
            raise ValueError(f"feed {feed.name}: target keys {target.keys} differ from the spec's {tgt_keys}")
        publish_partitions(spark, stamped, target)                              # K4, touched partitions
        if steps.target:
            target.replace(_stepped(target.read(), steps.target, "target", result))
        return
    version = publish(spark, stamped, target, tgt_keys)                        # K4
    if steps.target:
        version = target.write(_stepped(target.read(version), steps.target, "target", result))
    result.target_version = version


def target_rows(plan: SpecPlan, stage: DataFrame, job_start: datetime | str) -> DataFrame:
    """Stage rows through the spec's target mapping, stamped with the job time."""
    names = [m.target for m in plan.target]
    stamped = add_modify_stamp(map_columns(stage, plan.target), format_job_time(job_start))
    order = [f.name for f in plan.target_schema.fields if f.name in names or f.name == "modify_date_time"]
    return stamped.select(*order)


def landed_to_target(plan: SpecPlan, landed: DataFrame, job_start: datetime | str) -> DataFrame:
    """Landed (wrk) rows through the stage and target mappings: the ``transform``
    of a streaming publish (``publish_batches``)."""
    return target_rows(plan, map_columns(landed, plan.stage), job_start)


#: Feeds of a sweep that run at the same time; each is a chain of Spark jobs that share the cluster.
FEEDS_AT_ONCE = 4


def run_all(spark: SparkSession, feeds: Sequence[Feed], plans: dict[str, SpecPlan],
            targets: dict[str, VersionedTable | PartitionedTable], job_start: datetime | str,
            only: str | None = None, steps: dict[str, FeedSteps] | None = None, manifest: str | None = None,
            summary: str | None = None, job_name: str = "load", at_once: int = FEEDS_AT_ONCE) -> list[FeedRun]:
    """Folder sweep (S6): every feed, or the one named; ignored feeds and feeds
    without a plan are skipped; a failing feed does not stop the others.

    ``steps`` are each feed's own, ``manifest`` is a folder for all feeds
    (a sub-folder each), and with ``summary`` the run's load summary is
    written there as JSON, a row per folder (K7), beside the errors of failed feeds.
    """
    chosen = [f for f in feeds if not f.ignore and (not only or f.name == only) and f.name in plans]

    def one(feed: Feed) -> FeedRun:
        try:
            return run_feed(spark, feed, plans[feed.name], targets[feed.name], job_start, steps=(steps or {}).get(feed.name),
                            manifest=f"{manifest.rstrip('/')}/{feed.name}" if manifest else None)
        except Exception as exc:  # noqa: BLE001 - reported per feed, the sweep goes on
            return FeedRun(feed.name, None, "", error=f"{type(exc).__name__}: {exc}")

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        runs = list(pool.map(one, chosen))
    if summary:
        write_summary(spark, runs, summary, job_name)
        days = [f.log_expire_days for f in chosen if f.log_expire_days is not None]
        if days:
            expire_runs(spark, summary, int(time.time() * 1000), min(days), name=r"run-[0-9-]+")   # R2
    return runs


def file_metrics(spark: SparkSession, runs: Sequence[FeedRun]) -> DataFrame | None:
    """Per-file rows of all runs, for counters and the summary."""
    paths = [r.files_path for r in runs if r.files_path]
    return spark.read.parquet(*paths) if paths else None


def write_summary(spark: SparkSession, runs: Sequence[FeedRun], root: str, job_name: str) -> str:
    """The load summary of a sweep (K7) and its failed feeds (A11) under a folder of its own; returns the folder."""
    out = f"{root.rstrip('/')}/run-{datetime.now():%Y%m%d-%H%M%S-%f}"
    files = file_metrics(spark, runs)
    if files is not None:
        load_summary(files, job_name).write.json(f"{out}/folders")
    failed = [(r.feed, r.error) for r in runs if r.error]
    spark.createDataFrame(failed, "feed string, error string").coalesce(1).write.json(f"{out}/failed")
    return out
