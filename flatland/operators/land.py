"""Landing: delimited files -> cleaned, strictly cast rows; bad files set aside.

Plan per feed
1. list the files (driver metadata) and expand zip/xz archives (one task each);
2. read each file's header line (one small read per file) and group files by
   header text, so that columns bind by name even when files order them
   differently;
3. one CSV read per header group, every column a string, bound by position
   within the group, with the corrupt-record column kept for ragged rows;
   quoted files are cut into records first, in parallel splits
   (sources/quoted.py), which also yields their line counts and tells files that end inside a value;
4. clean cells (null markers, quotes), add lineage columns, strictly cast the
   spec's typed columns and record the first reason a row is bad;
5. write those parsed rows once to the run folder (parse once, cut lineage);
6. a file is bad if its header or any row is bad: the bad-file list is an
   aggregate over the parsed rows, and landed rows are an anti join against
   it. No window over the file, so a huge file is not one task.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field
from datetime import datetime
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatland import storage
from flatland.functions.casts import datetime_value, number_attempt, number_text, number_value, parse_by_layout, parse_datetime
from flatland.functions.names import landing_name
from flatland.functions.nulls import clean_cell
from flatland.operators.joins import BROADCAST_ROW_LIMIT, join_small
from flatland.plans.feed import Feed
from flatland.session import new_run_dir
from flatland.sources.archives import expand_archives
from flatland.sources.encodings import keeps_ascii, spark_charset
from flatland.sources.files import UNREADABLE, file_headers, list_feed_files, raw_line_counts, scanned, split_header
from flatland.sources.quoted import LineScan, invalid_bytes, parse_records, scan_lines, stitch

AUDIT_FILE = "load_file_name"
AUDIT_TS = "load_timestamp"
_PATH = "_path"
_REASON = "_reason"
_CORRUPT = "_corrupt_record"
_SHAPE = "_shape"
_SAMPLE = "_sample"
_PIECE = "_piece"
_FAULTS = f"{_PATH} string, reason string, sample string"


@dataclass(frozen=True)
class LandingField:
    """One 'Flat File' row of the spec: source column and landing type."""

    source: str
    type: str = "string"  # string | number (checked text, exact) | float64 | date | timestamp
    layout: str | None = None  # of a date or timestamp column that one layout reads


@dataclass
class LandResult:
    rows: DataFrame        # landed rows of good files
    files: DataFrame       # one row per listed file: counts, status, reason
    quarantine: DataFrame  # one row per bad file
    parsed_path: str       # run-scoped parquet of every parsed row, for read_parsed
    bad: DataFrame         # _path, reason, sample and bad_rows of the bad files, by the path that was read


def format_job_time(job_start: datetime | str) -> str:
    if isinstance(job_start, str):
        return job_start
    return job_start.strftime("%Y-%m-%d %H:%M:%S.%f")


def csv_options(feed: Feed) -> dict[str, str]:
    """Reader options for a feed: header row, PERMISSIVE with the corrupt
    record kept, no whitespace trimming; quoted feeds parse quotes (doubled
    quote as escape) across lines, unquoted feeds take quotes literally and
    stay splittable."""
    opts = {"header": "true", "enforceSchema": "true", "sep": feed.delimiter, "encoding": spark_charset(feed.encoding) or "UTF-8",
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT,
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    if feed.quoted:
        opts.update(quote='"', escape='"', multiLine="true")
    else:
        opts.update(quote="\u0000", escape="\u0000")
    return opts


def csv_reader(spark: SparkSession, feed: Feed, schema: T.StructType):
    return spark.read.schema(schema).options(**csv_options(feed))


def too_many_fields(corrupt: "F.Column", n_cols: int, feed: Feed) -> "F.Column":
    """A ragged row is 'long' when it has more tokens than header columns (V1).

    Tokens are counted on the raw record text after removing quoted spans, so
    delimiters inside quotes do not count.
    """
    # Doubled quotes go first, so that the pattern needs no group: Java's regex engine recurses for each turn of one.
    slim = F.replace(corrupt, F.lit('""'), F.lit(""))
    text = F.regexp_replace(slim, r'"[^"]*+"', "") if feed.quoted else corrupt
    n_tokens = F.size(F.split(text, "\\Q" + feed.delimiter + "\\E", -1))
    return corrupt.isNotNull() & (n_tokens > F.lit(n_cols))


def clean_cast(raw: DataFrame, names: list[str], feed: Feed, fields: dict[str, str], job_ts: str,
               load_file_name: "F.Column", path: "F.Column", keep: "F.Column | None" = None,
               layouts: dict[str, str] | None = None) -> DataFrame:
    """Positional string columns -> named, cleaned, strictly cast rows with lineage.

    ``raw`` holds ``_c0.._cN`` and the corrupt-record column. Adds the
    audit columns, ``_path``, the first reason the row is bad (or null) and
    the row shape (ok / short / long); ``keep`` is one column more that goes through.

    Two projections: the first cleans every cell and parses each typed cell
    once; the second derives value, bad flag and reason from those results.
    Catalyst keeps them apart because the parses are referenced more than
    once, so no parse runs twice for a cell.
    """
    positional = [f"_c{i}" for i in range(len(names))]
    first = [path.alias(_PATH), load_file_name.alias(AUDIT_FILE), F.col(_CORRUPT), *([keep] if keep is not None else [])]
    for i, (pos, name) in enumerate(zip(positional, names)):
        cell = clean_cell(F.col(pos), feed.null_value, feed.quoted)
        kind = fields.get(name, "string")
        first.append(cell.alias(f"_x{i}"))
        if kind in ("float64", "number"):
            first.append(number_attempt(cell).alias(f"_p{i}"))
        elif kind in ("date", "timestamp"):
            layout = (layouts or {}).get(name)
            attempt = parse_by_layout(cell, layout, feed.date_layouts) if layout else parse_datetime(cell, feed.date_layouts)
            first.append(attempt.alias(f"_p{i}"))
    parsed = raw.select(*first)

    cols = [F.col(_PATH)]
    long_row = too_many_fields(F.col(_CORRUPT), len(names), feed)
    reasons = [F.when(long_row, F.lit("too many fields"))]
    samples = [F.when(long_row, F.col(_CORRUPT))]          # the offending text, in the same order
    for i, name in enumerate(names):
        cell, attempt = F.col(f"_x{i}"), F.col(f"_p{i}")
        kind = fields.get(name, "string")
        if name in (AUDIT_FILE, AUDIT_TS):
            continue                    # a file's own columns of these names give way to the load's
        if kind in ("float64", "number"):
            value = number_value(attempt) if kind == "float64" else number_text(cell, attempt)
            reasons.append(F.when(cell.isNotNull() & attempt.isNull(), F.lit(f"bad number in {name}")))
            samples.append(F.when(cell.isNotNull() & attempt.isNull(), cell))
        elif kind in ("date", "timestamp"):
            value = datetime_value(attempt)
            reasons.append(F.when(cell.isNotNull() & attempt.isNull(), F.lit(f"bad date in {name}")))
            samples.append(F.when(cell.isNotNull() & attempt.isNull(), cell))
        else:
            value = cell
        cols.append(value.alias(name))
    cols.append(F.col(AUDIT_FILE))
    cols.append(F.lit(job_ts).cast("timestamp_ntz").alias(AUDIT_TS))
    cols.append(F.coalesce(*reasons).alias(_REASON))
    cols.append(F.coalesce(*samples).alias(_SAMPLE))
    cols.append(F.when(long_row, F.lit("long")).when(F.col(_CORRUPT).isNotNull(), F.lit("short"))
                .otherwise(F.lit("ok")).alias(_SHAPE))
    if keep is not None:
        cols.append(F.col(_PIECE))
    return parsed.select(*cols)


def positional_schema(n: int) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(n)]
                        + [T.StructField(_CORRUPT, T.StringType())])


def _load_file_name(file_name: "F.Column", file_path: "F.Column", expand_dir: str) -> "F.Column":
    """Base name of the file as delivered: an expanded archive copy is named after its archive."""
    bare_dir = expand_dir[5:] if expand_dir.startswith("file:") else expand_dir
    return F.when(file_path.contains(bare_dir.lstrip("/")),
                  F.regexp_extract(file_name, r"^[0-9]{6}-(.*)\.plain$", 1)).otherwise(file_name)


def reads_lines(feed: Feed) -> bool:
    """Whether the feed goes through the line reader: quoted files, and encodings Spark's readers do not know.

    Encodings of wider units (UTF-16, UTF-32) have no line ends in their bytes; their quoted files keep the multi-line reader.
    """
    return keeps_ascii(feed.encoding) and (feed.quoted or spark_charset(feed.encoding) is None)


@dataclass
class _Group:
    """The files of one header: how to make rows of their records."""

    number: int
    names: list[str]
    feed: Feed
    fields: dict[str, str]
    job_ts: str
    expand_dir: str
    layouts: dict[str, str] = field(default_factory=dict)
    scan: LineScan | None = None

    def rows(self, records: DataFrame, pieces: bool) -> DataFrame:
        """Parsed rows of records (path, name, text); with ``pieces`` those of ``records`` go along unparsed."""
        keep = ["piece"] if pieces else []
        raw = parse_records(records, positional_schema(len(self.names)), csv_options(self.feed), keep)
        piece = F.when(F.col("piece").isNotNull(), F.struct(F.lit(self.number).alias("group"), F.col("name"), F.col("piece"))) if pieces else F.lit(None).cast(_PIECE_TYPE)
        return clean_cast(raw, self.names, self.feed, self.fields, self.job_ts,
                          _load_file_name(F.col("name"), F.col("path"), self.expand_dir), F.col("path"), piece.alias(_PIECE), self.layouts)


_PIECE_TYPE = "struct<group:int,name:string,piece:struct<kind:string,block:bigint,first:boolean,text:string>>"


def _scan_group(spark: SparkSession, group: _Group, paths: list[str], line_sep: str, records_dir: str) -> DataFrame:
    """Parsed rows of one header group: by the line reader (sources/quoted.py), which also tells the files'
    line counts and faults, or by the CSV reader."""
    feed, names = group.feed, group.names
    if reads_lines(feed):
        group.scan = scan_lines(spark, paths, records_dir, feed.quoted_split_bytes, feed.delimiter if feed.quoted else None, feed.encoding, line_sep)
        return group.rows(group.scan.records, pieces=True)
    raw = csv_reader(spark, feed, positional_schema(len(names))).csv(paths)
    path = scanned("file_path")
    return clean_cast(raw, names, feed, group.fields, group.job_ts, _load_file_name(scanned("file_name"), path, group.expand_dir), path, layouts=group.layouts)


def read_parsed(spark: SparkSession, *paths: str) -> DataFrame:
    """Every parsed row of landings, good or bad; the text pieces of records over split boundaries are no rows."""
    parsed = spark.read.option("mergeSchema", len(paths) > 1).parquet(*paths)
    return parsed.where(F.col(_PIECE).isNull()).drop(_PIECE) if _PIECE in parsed.columns else parsed


def _write_parsed(spark: SparkSession, groups: list[tuple[_Group, DataFrame]], path: str) -> DataFrame:
    """Parse every record once, into ``path``; records over split boundaries are put together from there and added."""
    parsed = groups[0][1]
    for _, part in groups[1:]:
        parsed = parsed.unionByName(part, allowMissingColumns=True)
    parsed.write.mode("overwrite").parquet(path)
    if _PIECE not in parsed.columns:
        return spark.read.parquet(path)
    pieces = spark.read.parquet(path).where(F.col(_PIECE).isNotNull())
    numbers = {r["group"] for r in pieces.select(f"{_PIECE}.group").distinct().collect()}       # header groups
    seams = None
    for group, _ in groups:
        if group.number in numbers:
            own = pieces.where(F.col(f"{_PIECE}.group") == group.number).select(F.col(_PATH).alias("path"), f"{_PIECE}.name", f"{_PIECE}.piece")
            rows = group.rows(stitch(own), pieces=False)
            seams = rows if seams is None else seams.unionByName(rows, allowMissingColumns=True)
    if seams is not None:
        seams.write.mode("append").parquet(path)
    return read_parsed(spark, path)


def split_verdict(parsed: DataFrame, header_bad: DataFrame, n_files: int | None) -> tuple[DataFrame, DataFrame]:
    """(landed rows, bad files): a file that is bad as a whole (``header_bad``: path, reason, sample) or has any bad row lands nothing (V5)."""
    # Per bad file: what is wrong with it as a whole, else its smallest reason with that reason's smallest offending text.
    whole = header_bad.select(_PATH, F.lit(0).alias("of_row"), "reason", "sample")
    by_row = parsed.filter(F.col(_REASON).isNotNull()).select(_PATH, F.lit(1).alias("of_row"), F.col(_REASON).alias("reason"), F.col(_SAMPLE).alias("sample"))
    bad = (whole.unionByName(by_row).groupBy(_PATH).agg(F.min(F.struct("of_row", "reason", "sample")).alias("m"), F.sum("of_row").alias("n"))
           .select(_PATH, "m.reason", "m.sample", F.when(F.col("m.of_row") == 1, F.col("n")).alias("bad_rows")))
    bound = n_files
    if bound is None or bound > BROADCAST_ROW_LIMIT:
        # The file count does not bound the list small enough: count the bad
        # files themselves (a scan of two columns of the parsed rows), so the
        # usual short list is still broadcast and the rows are never shuffled.
        bound = bad.count()
    rows = join_small(parsed, bad.select(_PATH), _PATH, "left_anti", bound).drop(_REASON, _SHAPE, _SAMPLE)
    return rows, bad


def profile_rows(parsed: DataFrame) -> DataFrame:
    """Rows as the profiler reads them: long rows skipped, not failing."""
    return parsed.filter(F.col(_SHAPE) != "long").drop(_PATH, _REASON, _SHAPE, _SAMPLE)


def quarantine_rows(files: DataFrame, job_ts: str) -> DataFrame:
    """One row per bad file of a run, with its reason (K5)."""
    return (files.filter(F.col("status") == "bad")
            .select("feed", AUDIT_FILE, "source_path",
                    F.lit(job_ts).cast("timestamp_ntz").alias("run_ts"), "reason", "bad_rows", "sample"))


def land_feed(spark: SparkSession, feed: Feed, fields: list[LandingField],
              job_start: datetime | str, run_dir: str | None = None,
              paths: list[str] | None = None, cells_cut: Callable[[list[str]], Column | None] | None = None) -> LandResult:
    """Land every data file of ``feed`` (or the given ``paths``).

    ``cells_cut`` gives, for the landed columns, an aggregate that is taken with the count of each file's rows.
    """
    run_dir = run_dir or new_run_dir(spark, f"land-{feed.name}")
    job_ts = format_job_time(job_start)
    if paths is None:
        paths = [p for p, _, _ in list_feed_files(spark, feed)]
    expand_dir = storage.qualify(spark, f"{run_dir}/expanded")
    expanded = expand_archives(spark, paths, expand_dir)
    read_path = {p: expanded.get(p, p) for p in paths}
    field_types = {landing_name(f.source): f.type for f in fields}
    field_types.pop(AUDIT_TS, None)
    field_types.pop(AUDIT_FILE, None)
    layouts = {landing_name(f.source): f.layout for f in fields if f.layout}
    wanted = [landing_name(f.source) for f in fields]

    # Headers are read once; the driver gets each different header once, and a number of it for each file.
    heads = file_headers(spark, list(read_path.values()), feed.encoding, feed.delimiter if feed.quoted else None)
    number = F.when(F.col("header").isNotNull(), F.xxhash64("header", "line_sep"))
    heads.withColumn("number", number).write.mode("overwrite").parquet(f"{run_dir}/headers")
    heads = spark.read.parquet(f"{run_dir}/headers")
    texts = {r["number"]: (r["h"]["header"], r["h"]["line_sep"]) for r in heads.groupBy("number").agg(F.min(F.struct("header", "line_sep")).alias("h")).collect()}
    by_header: dict[tuple[str, str], list[str]] = defaultdict(list)
    header_bad: list[tuple[str, str, str | None]] = []
    for r in heads.select("path", "number", "fault").collect():
        if r["fault"] is not None:
            header_bad.append((r["path"], r["fault"], None))
        elif r["number"] is None:
            header_bad.append((r["path"], "empty file", None))
        else:
            by_header[texts[r["number"]]].append(r["path"])

    groups: list[tuple[_Group, DataFrame]] = []
    counted: set[str] = set()
    for gi, ((header, line_sep), group_paths) in enumerate(sorted(by_header.items(), key=lambda kv: min(kv[1]))):
        names = [landing_name(n, feed.quoted) for n in split_header(header, feed.delimiter, feed.quoted)]
        # A header's empty names (a trailing delimiter) are numbered by place.
        names = [n or f"column_{i + 1}" for i, n in enumerate(names)]
        dupes = sorted({n for n in names if names.count(n) > 1})
        missing = [w for w in wanted if w not in set(names) | {AUDIT_FILE, AUDIT_TS}]
        if dupes:
            header_bad += [(p, "duplicate column: " + ", ".join(dupes), None) for p in group_paths]
        elif missing:
            header_bad += [(p, "missing column: " + ", ".join(missing), None) for p in group_paths]
        else:
            group = _Group(gi, names, feed, field_types, job_ts, expand_dir, layouts)
            groups.append((group, _scan_group(spark, group, sorted(group_paths), line_sep, f"{run_dir}/records/g{gi:04d}")))
            if group.scan is not None:
                counted.update(group_paths)

    # Line counts: from the line reader's first pass where it read the file, else one text scan over the remaining
    # files, which also looks for bytes that Spark's reader would replace.
    unreadable = {p for p, reason, _ in header_bad if reason.startswith(UNREADABLE)}
    rest = [p for p in read_path.values() if p not in counted and p not in unreadable]
    raw_line_counts(spark, rest, feed.encoding).write.mode("overwrite").parquet(f"{run_dir}/lines")
    raw = spark.read.parquet(f"{run_dir}/lines")
    known_bad = [p for p, _, _ in header_bad]
    faults = (raw.where(F.col("invalid").isNotNull() & ~F.col("path").isin(known_bad))
              .select(F.col("path").alias(_PATH), F.lit(invalid_bytes(feed.encoding)).alias("reason"), F.col("invalid").alias("sample")))
    raw = raw.drop("invalid")
    header_bad_df = spark.createDataFrame(header_bad, _FAULTS).unionByName(faults)
    for group, _ in groups:
        if group.scan is not None:
            raw = raw.unionByName(group.scan.line_counts())
            header_bad_df = header_bad_df.unionByName(group.scan.faults.withColumnRenamed("path", _PATH))

    parsed_path = f"{run_dir}/parsed"
    n_files = len(paths)
    if groups:
        parsed = _write_parsed(spark, groups, parsed_path)
        rows, bad = split_verdict(parsed, header_bad_df, n_files)
        cut = cells_cut(rows.columns) if cells_cut else None
        loaded = rows.groupBy(_PATH).agg(F.count(F.lit(1)).alias("records_loaded"), *([cut.alias("cells_cut")] if cut is not None else []))
    else:
        bad = header_bad_df.withColumn("bad_rows", F.lit(None).cast("long"))
        rows = spark.createDataFrame([], f"{_PATH} string, {AUDIT_FILE} string")
        rows = rows.withColumn(AUDIT_TS, F.lit(job_ts).cast("timestamp_ntz"))
        loaded = spark.createDataFrame([], f"{_PATH} string, records_loaded long")

    listing_df = spark.createDataFrame(
        [(read_path[p], p, p.rstrip("/").rsplit("/", 1)[-1]) for p in paths],
        f"{_PATH} string, source_path string, {AUDIT_FILE} string")
    files = (listing_df
             .join(raw, listing_df[_PATH] == raw["path"], "left").drop("path")
             .join(loaded, _PATH, "left")
             .join(bad, _PATH, "left")
             .select(F.lit(feed.name).alias("feed"), AUDIT_FILE, "source_path",
                     F.coalesce("raw_records", F.lit(0)).alias("raw_records"),
                     F.when(F.col("reason").isNull(), F.coalesce("records_loaded", F.lit(0)))
                      .otherwise(F.lit(0)).cast("long").alias("records_loaded"),
                     F.when(F.col("reason").isNotNull(), F.lit("bad"))
                      .when(F.coalesce("records_loaded", F.lit(0)) == 0, F.lit("empty"))
                      .otherwise(F.lit("loaded")).alias("status"),
                     "reason", F.coalesce("bad_rows", F.lit(0)).alias("bad_rows"), "sample",
                     *([F.when(F.col("reason").isNull(), F.col("cells_cut")).alias("cells_cut")] if "cells_cut" in loaded.columns else [])))
    quarantine = quarantine_rows(files, job_ts)
    rows = rows.drop(_PATH) if _PATH in rows.columns else rows
    return LandResult(rows=rows, files=files, quarantine=quarantine, parsed_path=parsed_path, bad=bad)
