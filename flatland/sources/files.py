"""File discovery and the cheap per-file facts: header line, delimiter, line count.

The listing is metadata (one entry per file) and stays on the driver, as in
Spark's own file index. Everything that touches file contents runs on the
executors: the header of each file is read by a small per-file helper that
opens the file and reads one line (no block scan), and raw line counts are a
text scan aggregated per file.
"""

from __future__ import annotations

import codecs
import lzma
import zlib
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatland import storage
from flatland.plans.feed import Feed
from flatland.sources.encodings import codec_name

# Compressed forms accepted next to a feed's own extension.
COMPRESSED_EXTENSIONS = ["gz", "zip", "bz2", "xz"]
# The extensions the file analyzer picks up from a folder.
PROFILE_EXTENSIONS = ["csv", "txt", "tsv", "dat", "tab"]

LISTING_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("file_name", T.StringType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("modified_ms", T.LongType(), False),
])


def feed_name_glob(feed: Feed) -> str:
    """File-name glob of a feed's data files: its own extension, or compressed."""
    exts = [feed.extension] + [f"{feed.extension}.{c}" for c in COMPRESSED_EXTENSIONS] + COMPRESSED_EXTENSIONS
    return f"*.{{{','.join(dict.fromkeys(exts))}}}"


def feed_pattern(feed: Feed) -> str:
    return f"{feed.path.rstrip('/')}/{feed_name_glob(feed)}"


def list_feed_files(spark: SparkSession, feed: Feed) -> list[tuple[str, int, int]]:
    """Top-level data files of the feed folder (S3): own extension or compressed."""
    return storage.glob_files(spark, feed_pattern(feed))


def listing_frame(spark: SparkSession, files: list[tuple[str, int, int]]) -> DataFrame:
    rows = [(p, p.rstrip("/").rsplit("/", 1)[-1], ln, mt) for p, ln, mt in files]
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def _opener(path: str):
    """Open a (possibly compressed) file for reading bytes, from an executor."""
    import bz2
    import gzip
    import lzma
    import zipfile

    import pyarrow.fs as pafs

    local = path[5:] if path.startswith("file:") else path
    while local.startswith("//"):
        local = local[1:]
    if path.startswith("file:") or path.startswith("/"):
        raw = open(local, "rb")
    else:
        fs, inner = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://"))
        raw = fs.open_input_file(inner)         # seekable, as zip needs
    low = path.lower()
    if low.endswith(".gz"):
        return gzip.GzipFile(fileobj=raw)
    if low.endswith(".bz2"):
        return bz2.BZ2File(raw)
    if low.endswith(".xz"):
        return lzma.LZMAFile(raw)
    if low.endswith(".zip"):
        zf = zipfile.ZipFile(raw)
        names = zf.namelist()
        return zf.open(names[0]) if names else None
    return raw


HEADER_SCHEMA = "path string, header string, line_sep string, fault string"
#: Files opened at a time where the Python workers cannot open them.
OPEN_AT_ONCE = 32
#: Bytes read at first for a header, and at most; a longer header is a fault.
HEADER_STEP, HEADER_BYTES = 1 << 14, 1 << 22
UNREADABLE = "file cannot be read"


def python_can_open(path: str) -> bool:
    """Whether the per-file Python helpers can open ``path`` (local files, or a
    store pyarrow knows); others go through the JVM readers."""
    if path.startswith("file:") or path.startswith("/"):
        return True
    try:
        import pyarrow.fs as pafs
        pafs.FileSystem.from_uri(path.replace("s3a://", "s3://"))
        return True
    except Exception:  # noqa: BLE001 - any failure means: use the JVM path
        return False


def first_record(text: str, delimiter: str | None, at_end: bool) -> tuple[str | None, str] | None:
    """The first record that is not blank and what ends its lines; None if the text is too short to tell.

    Records end by the rule of the line reader (sources/quoted.py); ``delimiter`` None means that quotes are
    text. A line end is LF, CR LF or CR. Of a text without any record the record is None.
    """
    start, state, n = 0, "field", len(text)             # field: at the start of one; cell; inside
    i = 0
    while i < n:
        c = text[i]
        if state == "inside":
            if c == '"':
                if i + 1 == n and not at_end:
                    return None
                if text[i + 1:i + 2] == '"':
                    i += 1
                else:
                    state = "cell"
        elif c in "\r\n":
            if c == "\r" and i + 1 == n and not at_end:
                return None
            end = "\r\n" if text[i:i + 2] == "\r\n" else c
            if text[start:i].strip():
                return text[start:i], end
            i += len(end) - 1
            start, state = i + 1, "field"
        elif c == '"' and state == "field" and delimiter is not None:
            state = "inside"
        elif delimiter is not None and text.startswith(delimiter, i):
            i += len(delimiter) - 1
            state = "field"
        else:
            state = "cell"
        i += 1
    if not at_end:
        return None
    if state == "inside":
        raise ValueError("file ends inside a quoted value")
    return (text[start:] if text[start:].strip() else None), "\n"


def _header_row(path: str, read, codec: str, delimiter: str | None) -> tuple[str, str | None, str | None, str | None]:
    """(path, header, line separator, fault) from ``read(n)``: the first n bytes, fewer at the end of the file."""
    size = HEADER_STEP
    while True:
        data = read(size)
        at_end = len(data) < size
        whole = True
        try:
            text = codecs.getincrementaldecoder(codec)().decode(data, at_end)
        except UnicodeDecodeError as e:         # bytes behind the header are the scan's business
            text, whole = data[:e.start].decode(codec), False
        try:
            found = first_record(text.lstrip("\ufeff"), delimiter, at_end and whole)
            if not found and not whole:
                return path, None, None, f"bytes that {codec} does not have"
        except ValueError as e:
            return path, None, None, str(e)
        if found:
            # The header's own line breaks (in quoted names) do not make another layout.
            return path, found[0], "\r" if found[1] == "\r" else "\n", None
        if size >= HEADER_BYTES:
            return path, None, None, f"header of more than {HEADER_BYTES} bytes"
        size *= 4


def _jvm_headers(spark: SparkSession, paths: list[str], codec: str = "utf-8", delimiter: str | None = None) -> DataFrame:
    """Headers through the Hadoop file system (any store Spark reads).

    Each file is opened and read as far as its first record and no further, a bounded number at a time.
    """
    def one(path: str) -> tuple:
        return _header_row(path, lambda n: storage.read_prefix(spark, path, n), codec, delimiter)

    with ThreadPoolExecutor(max_workers=OPEN_AT_ONCE) as pool:
        return spark.createDataFrame(list(pool.map(one, paths)), HEADER_SCHEMA)


def file_headers(spark: SparkSession, paths: list[str], encoding: str = "utf-8", delimiter: str | None = None) -> DataFrame:
    """First non-blank record of each file (S8), read on the executors.

    Only the first bytes are read, so the cost per file is one small read, not
    a block scan. ``delimiter``: of quoted files, whose header may hold line ends in its
    names; without one it is the first line. A file without records has a null header; one whose header
    cannot be read has a fault. Where Python cannot open the files, Hadoop's file system reads them.
    """
    if not paths:
        return spark.createDataFrame([], HEADER_SCHEMA)
    codec = codec_name(encoding)
    if not python_can_open(paths[0]):
        return _jvm_headers(spark, paths, codec, delimiter)
    n = max(1, min(len(paths), spark.sparkContext.defaultParallelism * 4))
    listing = spark.createDataFrame([(p,) for p in paths], "path string").repartition(n)

    def read_headers(batches):
        for pdf in batches:
            out = []
            for p in pdf["path"]:
                fh = _opener(p)
                if fh is None:                  # an archive without members
                    out.append((p, None, None, None))
                    continue
                held = b""

                def read(size):
                    nonlocal held
                    while len(held) < size:
                        more = fh.read(size - len(held))
                        if not more:
                            break
                        held += more
                    return held[:size]

                try:
                    out.append(_header_row(p, read, codec, delimiter))
                except (OSError, EOFError, zlib.error, lzma.LZMAError) as e:
                    out.append((p, None, None, f"{UNREADABLE}: {e}"))
                finally:
                    fh.close()
            yield pd.DataFrame(out, columns=["path", "header", "line_sep", "fault"])

    return listing.mapInPandas(read_headers, HEADER_SCHEMA)


def detect_delimiter(header: "F.Column") -> "F.Column":
    """Tab, else pipe, else comma, from the header line."""
    return (F.when(header.contains("\t"), F.lit("\t"))
            .when(header.contains("|"), F.lit("|"))
            .otherwise(F.lit(",")))


def scanned(field: str) -> "F.Column":
    """``file_path`` or ``file_name`` of a scan as the listing has it: the scan's metadata is percent-encoded."""
    path = F.col(f"_metadata.{field}")
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def raw_line_counts(spark: SparkSession, paths: list[str], codec: str = "iso8859-1") -> DataFrame:
    """path, physical lines minus the header line, never below 0 (S7), and ``invalid``: a line with bytes
    that the encoding does not have (for those Spark's readers would replace: UTF-8, ASCII).

    One text scan over all files; blank lines and line breaks inside quoted
    values count, as they do for a plain line count. Files with no lines are
    absent here and must be filled in from the listing.
    """
    if not paths:
        return spark.createDataFrame([], "path string, raw_records long, invalid string")
    line = F.col("value")
    wrong = {"utf-8": ~F.is_valid_utf8(line), "utf-8-sig": ~F.is_valid_utf8(line),
             "ascii": F.octet_length(line) != F.octet_length(F.regexp_replace(F.make_valid_utf8(line), r"[^\x00-\x7F]", ""))}.get(codec)
    invalid = F.lit(None).cast("string") if wrong is None else F.min(F.when(wrong, F.substring(F.make_valid_utf8(line), 1, 200)))
    lines = spark.read.text(paths).select(scanned("file_path").alias("path"), "value")
    return lines.groupBy("path").agg(F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).alias("raw_records"), invalid.alias("invalid"))


def split_header(header: str, delimiter: str, quoted: bool) -> list[str]:
    """Header line -> raw column names."""
    if not quoted:
        return header.split(delimiter)
    import csv
    import io
    return next(csv.reader(io.StringIO(header, newline=""), delimiter=delimiter, quotechar='"', doublequote=True))
