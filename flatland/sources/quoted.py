"""Delimited files read as lines, in parallel splits.

Spark's CSV reader can only follow a quoted value across line breaks with
``multiLine``, which reads each file in one task. A feed whose single file
holds a third of all rows would then be one task. Here every quoted file,
whatever its size, is read as lines of bytes, which split like any text
file, and records are put back together by one rule:

* a quote opens a value only at the start of a field (a quote elsewhere in an
  unquoted cell is text), two quotes in a row are one quote of the text, any other
  quote in a quoted value closes it; a line end outside a value ends the record.

Without the doubled quotes each quote is a step between the states outside
and inside: one at a field start turns the state over, any other one leaves it
outside whatever it was. So a run of text either sets the state or turns
it over or not, and runs can be put together in any grouping:

1. Pass A (``mapInArrow``): for each split, whether it sets the state, and the
   parity of the steps after that; a window over the splits of a file says
   which start inside a value, and whether the file ends inside one. The
   lines are decoded strictly, and a split tells the first line with bytes that
   the encoding does not have. A file that ends inside a value, or has such
   a line, is bad (``file_faults``), whatever its size, and is not read further.
2. Pass B (``mapInArrow``, no shuffle): each task walks its splits' lines in
   order. Records that start and end in the split come out whole; the piece
   before a split's first record start ("head") and an unfinished last record
   ("tail") come out as pieces.
3. Pieces (at most two per split) are tied to the record they belong to:
   a head belongs to the nearest earlier tail of its file. They are grouped
   per record and joined in order, so one group is one record.
4. ``from_csv`` parses every record with the reader's own options, corrupt
   record column included, so short and long rows are flagged exactly as by
   the file reader. Whole records are parsed in pass B's own job; only pieces are
   written as text.

Lines end at LF or CR LF, or, in a file whose header does, at CR alone. Every
encoding that keeps ASCII where it is can be read; gzip files are one split.
Unquoted feeds come here too if Spark's readers do not know their encoding: each line is a record.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatland.operators.joins import is_broadcast, join_small
from flatland.session import split_session
from flatland.sources.encodings import decode_lines
from flatland.sources.files import scanned

UNCLOSED = "file ends inside a quoted value"

PIECE = T.StructType([
    T.StructField("kind", T.StringType()),      # head | tail
    T.StructField("block", T.LongType()),
    T.StructField("first", T.BooleanType()),    # the file's first record: its header
    T.StructField("text", T.StringType()),
])
RECORD_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("text", T.StringType()),      # a whole record
    T.StructField("piece", PIECE),              # or a piece of one
])


def invalid_bytes(codec: str) -> str:
    return f"bytes that {codec} does not have"


#: Bytes of small splits that one task walks, and such tasks at least for each core.
TASK_BYTES = 32 << 20
TASKS_PER_CORE = 2


def _lines(spark: SparkSession, paths: list[str], line_sep: str, split_bytes: int | None = None) -> DataFrame:
    # In a file whose lines end CR LF the CR belongs to the line ending and is dropped in pass B (so a line break
    # inside a value reads as LF, as the multi-line reader has it); in an LF file it is data.
    lines = (spark.read.option("lineSep", line_sep).text(paths)
             .select(F.col("value").cast("binary").alias("value"), F.monotonically_increasing_id().alias("row"),
                     scanned("file_path").alias("path"),
                     scanned("file_name").alias("name"),
                     F.col("_metadata.file_block_start").alias("block")))
    if not split_bytes or split_bytes >= TASK_BYTES:
        return lines
    # A task walks many small splits, one after the other: their number does not become that of the tasks, files and workers.
    n_splits = lines.rdd.getNumPartitions()
    n_tasks = max(-(-n_splits * split_bytes // TASK_BYTES), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    return lines.coalesce(n_tasks) if n_tasks < n_splits else lines


def quote_steps(lines, delimiter: str | None):
    """(line of each quote, whether it is at a field start), doubled quotes left out; none without a delimiter (unquoted files)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    slim = pc.replace_substring(lines, '""', "").cast(pa.large_string())
    if len(slim) == 0 or delimiter is None:
        return np.empty(0, np.int64), np.empty(0, bool)
    _, offs, data = slim.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[slim.offset:slim.offset + len(slim) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    at = offsets[0] + np.flatnonzero(raw[offsets[0]:offsets[-1]] == 0x22)
    line = np.searchsorted(offsets, at, side="right") - 1
    sign = np.frombuffer(delimiter.encode(), dtype=np.uint8)
    start = at - offsets[line] >= len(sign)
    for k, byte in enumerate(sign):
        start &= raw[np.maximum(at - len(sign) + k, 0)] == byte
    return line, start | (at == offsets[line])


def states_before(line: np.ndarray, turns: np.ndarray, n: int, state: int) -> tuple[np.ndarray, int, bool]:
    """State before each of ``n`` lines, after all of them, and whether the run sets it.

    ``turns``: quotes at a field start; the others set the state to outside.
    """
    total = np.cumsum(turns)                                   # turns up to and with each quote
    sets = np.flatnonzero(~turns)
    last = np.full(len(turns), -1, dtype=np.int64)
    last[sets] = sets
    last = np.maximum.accumulate(last) if len(last) else last  # the setting quote at or before each
    base = np.where(last >= 0, total[np.maximum(last, 0)], 0) if len(last) else last
    after = np.where(last >= 0, 0, state) + total - base if len(last) else last
    upto = np.searchsorted(line, np.arange(n), side="left") - 1
    before = np.where(upto >= 0, after[np.maximum(upto, 0)], state) & 1 if len(after) else np.full(n, state)
    end = int(after[-1] & 1) if len(after) else state
    return before, end, len(sets) > 0


def _split_rows(delimiter: str | None, codec: str):
    """Pass A body: (path, block, sets, parity, n_lines, crlf, invalid) of every split."""
    import pyarrow as pa

    def run(batches):
        now = None

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([now[0]], pa.string()), pa.array([now[1]], pa.int64()), pa.array([now[2]], pa.bool_()), pa.array([now[3]], pa.int32()),
                 pa.array([now[4]], pa.int64()), pa.array([now[5]], pa.bool_()), pa.array([now[6]], pa.string())],
                names=["path", "block", "sets", "parity", "n_lines", "crlf", "invalid"])

        for batch in batches:
            for a, b in _runs_of_splits(batch):
                values, bad = decode_lines(batch.column("value").slice(a, b - a), codec)
                key = batch.column("path")[a].as_py(), batch.column("block")[a].as_py()
                if now is None or key != (now[0], now[1]):
                    if now is not None:
                        yield row()
                    now = [*key, False, 0, 0, values[0].as_py().endswith("\r"), None]
                line, turns = quote_steps(values, delimiter)
                _, now[3], sets = states_before(line, turns, b - a, now[3])
                now[2] |= sets
                now[4] += b - a
                if len(bad) and now[6] is None:
                    now[6] = values[int(bad[0])].as_py()[:SAMPLE_CHARS]
        if now is not None:
            yield row()

    return run


#: Characters of the sample that is kept of a line with invalid bytes.
SAMPLE_CHARS = 200


def _runs_of_splits(batch) -> list[tuple[int, int]]:
    """Bounds of the runs of lines of one split in a batch."""
    import pyarrow.compute as pc

    n = batch.num_rows
    if n == 0:
        return []
    paths, blocks = batch.column("path"), batch.column("block").to_numpy()
    new = np.ones(n, dtype=bool)
    if n > 1:
        same = pc.equal(paths.slice(1), paths.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[1:] = ~same | (blocks[1:] != blocks[:-1])
    bounds = [*np.flatnonzero(new).tolist(), n]
    return list(zip(bounds, bounds[1:]))


def split_table(lines: DataFrame, delimiter: str | None, codec: str) -> DataFrame:
    """Pass A: per split its line count, whether it starts and ends inside a quoted value, its first
    line with invalid bytes, and whether its file's lines end with CR LF (as its first line does)."""
    rows = lines.select("path", "block", "value").mapInArrow(
        _split_rows(delimiter, codec), "path string, block long, sets boolean, parity int, n_lines long, crlf boolean, invalid string")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    turned = F.coalesce(F.sum("parity").over(before), F.lit(0))
    rows = rows.withColumn("turned", turned)
    # Turns since the last split that sets the state, that one's own included.
    since = F.col("turned") - F.coalesce(F.last(F.when(F.col("sets"), F.col("turned")), ignorenulls=True).over(before), F.lit(0))
    rows = rows.withColumn("inside", since % 2 == 1)
    # A split that sets the state ends in it, whatever came before; its parity counts from there.
    ends = F.when(F.col("sets"), F.col("parity") % 2 == 1).otherwise((F.col("inside").cast("int") + F.col("parity")) % 2 == 1)
    return rows.select("path", "block", "n_lines", "inside", ends.alias("ends_inside"), "invalid", F.first("crlf").over(upto).alias("crlf"))


def _cut_records(delimiter: str | None, codec: str):
    """Pass B body: Arrow batches of whole splits' lines, in order -> records and pieces.

    States and record texts are Arrow/numpy kernels over the batch; Python
    only steps from one split (or batch) to the next, carrying the open
    record across batch boundaries.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    piece_type = pa.struct([("kind", pa.string()), ("block", pa.int64()), ("first", pa.bool_()), ("text", pa.string())])
    names = RECORD_SCHEMA.fieldNames()

    def joined(parts):
        lines = pa.concat_arrays(parts) if len(parts) > 1 else parts[0]
        return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines)], type=pa.int32()), lines), "\n")

    def run(batches):
        st = {"key": None}
        out: list[pa.RecordBatch] = []

        def emit(texts, first):
            """Whole records; the header and blank lines are none."""
            keep = pc.and_(pc.invert(pa.array(first)), pc.not_equal(texts, ""))
            texts = texts.filter(keep)
            m = len(texts)
            if m:
                out.append(pa.RecordBatch.from_arrays([
                    pa.array([st["key"][0]] * m, pa.string()), pa.array([st["name"]] * m, pa.string()), texts.cast(pa.string()), pa.nulls(m, piece_type)], names=names))

        def emit_piece(kind, texts, first=False):
            piece = {"kind": kind, "block": st["key"][1], "first": first, "text": texts[0].as_py()}
            out.append(pa.RecordBatch.from_arrays([
                pa.array([st["key"][0]], pa.string()), pa.array([st["name"]], pa.string()), pa.nulls(1, pa.string()), pa.array([piece], piece_type)], names=names))

        def flush():
            if st["key"] is None:
                return
            if st["head"]:
                emit_piece("head", joined(st["head"]))
            if st["rec"] is not None:
                if st["state"] == 0:
                    emit(joined(st["rec"]), [st["rec_first"]])
                else:
                    emit_piece("tail", joined(st["rec"]), st["rec_first"])
            st["key"] = None

        for batch in batches:
            for a, b in _runs_of_splits(batch):
                key = (batch.column("path")[a].as_py(), batch.column("block")[a].as_py())
                if key != st["key"]:
                    flush()
                    st.update(key=key, name=batch.column("name")[a].as_py(), state=int(batch.column("inside")[a].as_py() or 0),
                              head=[], rec=None, rec_first=False, seen_start=False)
                vals, _ = decode_lines(batch.column("value").slice(a, b - a), codec)
                if batch.column("crlf")[a].as_py():
                    vals = pc.replace_substring_regex(vals, "\r$", "")
                line, turns = quote_steps(vals, delimiter)
                before, st["state"], _ = states_before(line, turns, b - a, st["state"])
                starts = np.flatnonzero(before == 0)
                lead = int(starts[0]) if len(starts) else b - a
                if lead:
                    (st["rec"] if st["rec"] is not None else st["head"]).append(vals.slice(0, lead))
                if len(starts):
                    if st["rec"] is not None:
                        emit(joined(st["rec"]), [st["rec_first"]])
                    first = np.zeros(len(starts), dtype=bool)
                    if key[1] == 0 and not st["seen_start"]:
                        # The header is the file's first record that is not a blank line; what comes before it is dropped too.
                        for j, s0 in enumerate(starts):
                            if vals[int(s0)].as_py().lstrip("\ufeff").strip() != "":
                                first[:j + 1] = True
                                st["seen_start"] = True
                                break
                    if len(starts) > 1:
                        body = vals.slice(int(starts[0]), int(starts[-1] - starts[0]))
                        offsets = pa.array((starts - starts[0]).astype(np.int32))
                        emit(pc.binary_join(pa.ListArray.from_arrays(offsets, body), "\n"), first[:-1])
                    st["rec"] = [vals.slice(int(starts[-1]))]
                    st["rec_first"] = bool(first[-1])
            if out:
                yield from out
                out.clear()
        flush()
        yield from out
    return run


def stitch(pieces: DataFrame) -> DataFrame:
    """(path, name, text) of the records that cross split boundaries, from their pieces (step 3).

    The owner of each piece is found on the pieces' places only (no text), then
    their texts are grouped per owner: one group is one record.
    """
    flat = pieces.select("path", "name", "piece.*").withColumn("kind_ord", F.when(F.col("kind") == "head", F.lit(0)).otherwise(F.lit(1)))
    upto = Window.partitionBy("path").orderBy("block", "kind_ord").rowsBetween(Window.unboundedPreceding, 0)
    owners = flat.select("path", "block", "kind_ord", F.last(F.when(F.col("kind_ord") == 1, F.col("block")), ignorenulls=True).over(upto).alias("owner"))
    parts = F.sort_array(F.collect_list(F.struct("block", "kind_ord", "text")))
    whole = (flat.join(owners, ["path", "block", "kind_ord"]).groupBy("path", "owner")
             .agg(F.array_join(F.transform(parts, lambda x: x["text"]), "\n").alias("text"), F.max("first").alias("first"), F.first("name").alias("name")))
    return whole.where(~F.col("first") & (F.col("text") != "")).select("path", "name", "text")


@dataclass
class LineScan:
    """Files of one header read as lines: their splits, what is wrong with whole files, and their records.

    Making one runs pass A and writes the splits under ``out_dir``; ``records`` is pass B, not run yet.
    """

    splits: DataFrame       # path, block, n_lines, inside, ends_inside, invalid, crlf
    faults: DataFrame       # path, reason, sample
    records: DataFrame      # RECORD_SCHEMA

    def line_counts(self) -> DataFrame:
        """(path, raw_records): physical lines per file minus the header, never below 0."""
        return self.splits.groupBy("path").agg(F.greatest(F.sum("n_lines") - 1, F.lit(0)).alias("raw_records"))


def scan_lines(spark: SparkSession, paths: list[str], out_dir: str, split_bytes: int | None = None, delimiter: str | None = ",",
               codec: str = "utf-8", line_sep: str = "\n") -> LineScan:
    """Read files as lines of records; ``delimiter`` None: no quotes, each line is a record."""
    own = split_session(spark, split_bytes)
    lines = _lines(own, paths, line_sep, split_bytes)
    split_table(lines, delimiter, codec).write.mode("overwrite").parquet(f"{out_dir}/splits")
    splits = own.read.parquet(f"{out_dir}/splits")
    last = F.max(F.struct("block", "ends_inside"))["ends_inside"]
    invalid = F.min(F.when(F.col("invalid").isNotNull(), F.struct("block", "invalid")))["invalid"]
    faults = splits.groupBy("path").agg(last.alias("open"), invalid.alias("sample"))
    faults = faults.where(F.col("open") | F.col("sample").isNotNull()).select(
        "path", F.when(F.col("sample").isNotNull(), F.lit(invalid_bytes(codec))).otherwise(F.lit(UNCLOSED)).alias("reason"), "sample")
    # Only splits that do not start as a record of LF lines, or are of a bad file, are joined; few of them are broadcast,
    # else the lines are dealt by split and put in order again.
    odd = (splits.join(faults.select("path", F.lit(True).alias("bad")), "path", "left").where(F.col("inside") | F.col("crlf") | F.col("bad"))
           .select("path", "block", "inside", "crlf", "bad"))
    n_odd = odd.count()
    if n_odd:
        marked = join_small(lines, odd, ["path", "block"], "left", n_odd)
        if not is_broadcast(odd, n_odd):
            marked = marked.repartition("path", "block").sortWithinPartitions("path", "block", "row")
        marked = marked.where("bad IS NULL")
    else:
        marked = lines.withColumns({"inside": F.lit(False), "crlf": F.lit(False)})
    records = marked.select("path", "name", "block", "inside", "crlf", "value").mapInArrow(_cut_records(delimiter, codec), RECORD_SCHEMA)
    return LineScan(splits, faults, records)


def quoted_records(spark: SparkSession, paths: list[str], out_dir: str, split_bytes: int | None = None, delimiter: str = ",",
                   codec: str = "utf-8", line_sep: str = "\n") -> DataFrame:
    """(path, name, text): one row per data record of the files that are not bad, headers dropped; written under ``out_dir`` once."""
    scan = scan_lines(spark, paths, out_dir, split_bytes, delimiter, codec, line_sep)
    scan.records.write.mode("overwrite").parquet(f"{out_dir}/records")
    found = spark.read.parquet(f"{out_dir}/records")
    return found.where("piece IS NULL").select("path", "name", "text").unionByName(stitch(found.where("piece IS NOT NULL")))


def parse_records(records: DataFrame, schema: T.StructType, options: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """Records -> positional columns and the corrupt-record column, as the file reader gives, and the columns ``keep``."""
    parse_opts = {k: v for k, v in options.items()
                  if k not in ("header", "enforceSchema", "multiLine", "encoding")}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keep = ["path", "name", *(keep or [])]
    return records.select(*keep, F.from_csv("text", ddl, parse_opts).alias("r")).select("r.*", *keep)
