"""File analyzer: a folder of files in, one inferred spec per file out.

Files with the analyzer's extensions are listed (S11); each file's header
line gives its delimiter (S9). Files of one (header, delimiter) are read
together, as the profiler reads them, long rows skipped (S10); each file is a
subject of its own, named after its cleaned stem, and all are profiled in one
aggregate keyed by subject.
"""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatland import storage
from flatland.functions.names import landing_name
from flatland.operators.joins import join_small
from flatland.operators.land import land_feed, profile_rows, read_parsed
from flatland.operators.profile import distinct_long, infer_types, profile_long, unpivot
from flatland.plans.feed import Feed
from flatland.plans.spec import build_spec, write_spec
from flatland.session import new_run_dir
from flatland.sources.files import COMPRESSED_EXTENSIONS, PROFILE_EXTENSIONS, detect_delimiter, file_headers


def analyzer_files(spark: SparkSession, folder: str) -> list[str]:
    exts = PROFILE_EXTENSIONS + [f"{e}.{c}" for e in PROFILE_EXTENSIONS for c in COMPRESSED_EXTENSIONS]
    return [p for p, _, _ in storage.glob_files(spark, f"{folder.rstrip('/')}/*.{{{','.join(exts)}}}")]


def file_settings(spark: SparkSession, paths: list[str], encoding: str = "utf-8",
                  null_value: str | None = None) -> DataFrame:
    """Detected settings per file (K11): name, extension, delimiter, encoding, null marker."""
    heads = file_headers(spark, paths, encoding)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return heads.select(
        name.alias("file_name"),
        F.regexp_extract(name, r"^[^.]*\.(.*)$", 1).alias("extension"),
        detect_delimiter(F.coalesce(F.col("header"), F.lit(""))).alias("delimiter"),
        F.lit(encoding).alias("encoding"), F.lit(null_value).cast("string").alias("null_value"),
        "header", "path")


_STEM = (rf"^(.+?)(?:\.(?:{'|'.join(PROFILE_EXTENSIONS)}))?(?:\.(?:{'|'.join(COMPRESSED_EXTENSIONS)}))?$")
PROFILE_FOLDER_SCHEMA = "subject string, column_name string, position int, s string"


def subjects(paths: list[str]) -> dict[str, str]:
    """Subject of each file name: its cleaned stem, and where several files share one, the whole cleaned name (then a number)."""
    names = sorted({p.rstrip("/").rsplit("/", 1)[-1] for p in paths})
    stems = {n: landing_name(re.match(_STEM, n).group(1)) for n in names}
    out: dict[str, str] = {}
    for n in names:
        alone = sum(s == stems[n] for s in stems.values()) == 1
        own = stems[n] if alone else landing_name(n.replace(".", "_"))
        taken, k = set(out.values()), 2
        base = own
        while own in taken:
            own, k = f"{base}_{k}", k + 1
        out[n] = own
    return out


def profile_folder(spark: SparkSession, folder: str, encoding: str = "utf-8", null_value: str | None = None) -> DataFrame:
    """Inferred types per subject (file) and column: subject, column_name, position, landing_type, db_type, ..."""
    return profile_files(spark, analyzer_files(spark, folder), encoding, null_value)


def folder_cells(spark: SparkSession, paths: list[str], encoding: str = "utf-8", null_value: str | None = None) -> DataFrame:
    """Every cell of the files, as the profiler reads them: subject, column_name, position, s."""
    settings = file_settings(spark, paths, encoding, null_value).select("path", "header", "delimiter").collect() if paths else []
    groups: dict[tuple[str, str], list[str]] = defaultdict(list)
    for r in settings:
        if r["header"] is not None:
            groups[(r["header"], r["delimiter"])].append(r["path"])
    run = new_run_dir(spark, "analyze")
    named = spark.createDataFrame(sorted(subjects(paths).items()), "load_file_name string, subject string")
    long = spark.createDataFrame([], PROFILE_FOLDER_SCHEMA)
    for i, ((_, delim), group) in enumerate(sorted(groups.items(), key=lambda kv: min(kv[1]))):
        feed = Feed(f"analyze-{i}", group[0].rsplit("/", 1)[0], delimiter=delim, encoding=encoding, null_value=null_value, quoting=1)
        res = land_feed(spark, feed, [], "1970-01-01 00:00:00", run_dir=f"{run}/{i:04d}", paths=sorted(group))
        if not storage.exists(spark, f"{res.parsed_path}/_SUCCESS"):
            continue                        # no file of this layout could be read (duplicate columns)
        rows = profile_rows(read_parsed(spark, res.parsed_path)).drop("load_timestamp")
        columns = [c for c in rows.columns if c != "load_file_name"]
        rows = join_small(rows, named, "load_file_name", "inner", len(paths))
        long = long.unionByName(unpivot(rows, columns, subject=F.col("subject")))
    return long


_CELL_KEY = ("subject", "column_name", "position")


def profile_files(spark: SparkSession, paths: list[str], encoding: str = "utf-8", null_value: str | None = None) -> DataFrame:
    """As ``profile_folder``, of the given files; without any the frame is empty."""
    return infer_types(profile_long(folder_cells(spark, paths, encoding, null_value), by=_CELL_KEY))


def analyze_folder(spark: SparkSession, folder: str, out: str, encoding: str = "utf-8", null_value: str | None = None,
                   schemas: dict[str, str] | None = None, top_n: int = 10) -> None:
    """Write what the analyzer finds, as CSV under ``out``: detected settings (K11), inferred types, the distinct-values
    analysis (K8) and, with ``schemas`` (wrk, stg and tgt, all required: V12), each subject's spec (K9).
    """
    for layer in ("wrk", "stg", "tgt") if schemas is not None else ():
        if not schemas.get(layer):
            raise ValueError(f"setting {layer} is required before profiling")
    out, paths = out.rstrip("/"), analyzer_files(spark, folder)

    def save(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{out}/{name}")

    if paths:
        save(file_settings(spark, paths, encoding, null_value).drop("header", "path", "line_sep", "fault"), "settings")
    cells = folder_cells(spark, paths, encoding, null_value)
    stored = new_run_dir(spark, "analyze-profile")
    infer_types(profile_long(cells, by=_CELL_KEY)).write.parquet(stored)
    profile = spark.read.parquet(stored)
    save(profile, "profile")
    save(distinct_long(cells, _CELL_KEY, top_n), "distinct")
    if schemas is not None:
        for r in profile.select("subject").distinct().orderBy("subject").collect():         # a subject a file
            own, name = profile.where(F.col("subject") == r["subject"]), r["subject"]
            names = {f"{layer}_schema": schemas[layer] for layer in ("wrk", "stg", "tgt")}
            names |= {"wrk_table": f"wrk_{name}", "stg_table": f"stg_{name}", "tgt_table": name}
            write_spec(build_spec(spark, own, names), f"{out}/specs/{name}")
