"""WARC archives: written from rows, and read back in parallel byte ranges.

Writing: every record is a gzip member of its own. Of the rows with equal payloads (by SHA-1) of at least a given size
the one with the smallest id is a ``response``, the others are ``revisit`` records, which name it and hold its HTTP head but no
payload. Each task writes its own files and reports them; only the files of the reports that Spark kept are archives, so a task
that is run again leaves nothing twice.

Reading: files are dealt in byte ranges. A task looks for the gzip magic from its range's start, takes a place for a record only
if the member there decodes to a WARC head, and owns the records that start inside its range, to their ends wherever these are. After a
record the next one starts right behind it; if it does not, the task looks for the magic again, so a damaged member costs
only itself. A payload may hold an archive itself: such an inner record lies inside an outer one that starts in an earlier range, and is
told by that (``_nested``): the ends that each range reaches are compared along the file.

Members are decoded in steps of bounded size, and a payload's digest is taken on the way, so a record may be larger than memory; only
``read_payloads`` holds whole payloads, a record at a time.

Defined cases: a null payload is the empty one; a null address is written as an empty one; rows without an id are never the first of
equal payloads while another one has an id, and the row that repeats the first one's id and payload is a response too; a
table without rows gives no archives, and no archives give no records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flatland import storage
from flatland.operators.joins import join_small

MAGIC = b"\x1f\x8b\x08"
#: An archive is closed when it has this many bytes.
ARCHIVE_BYTES = 1 << 30
RANGE_BYTES = 32 << 20
#: Bytes read, or decoded, at a time; a record's heads must fit in HEAD_BYTES.
STEP = 1 << 20
HEAD_BYTES = 1 << 18
#: Copies of the table of repeated payloads, over which the rows of a very common payload are dealt.
SALTS = 16

_VERSION = "WARC/1.1"
_PROFILE = "http://netpreservation.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:flatland:row:"

INDEX = ("path string, range long, offset long, next long, warc_type string, record_id string, target_uri string, warc_date string, "
         "refers_to string, payload_bytes long, payload_digest string, intact boolean")


# Files -----------------------------------------------------------------------

def _filesystem(path: str):
    """A pyarrow file system and the path in it, for local and for object-store paths."""
    import pyarrow.fs as pafs

    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://"))


# Writing ---------------------------------------------------------------------

def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def record_id(row_id: str | None, payload_digest: str) -> str:
    return f"<{_URN}{quote(row_id or '', safe='')}:{payload_digest}>"


def row_id(record: Column) -> Column:
    """The row id in a record id that ``write_archives`` made, else null."""
    text = F.regexp_extract(record, f"^<{_URN}([^:>]*):", 1)
    return F.when(text != "", F.url_decode(text))


def _head(lines: list[tuple[str, str]], first: str) -> bytes:
    clean = ("".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in lines)).encode("utf-8")
    return first.encode("ascii") + b"\r\n" + clean + b"\r\n"


def record(row: str | None, uri: str | None, payload: bytes, date: str, first: tuple[str | None, str | None] | None = None) -> bytes:
    """One gzip member: a response with its payload, or a revisit of the row ``first`` (its id and address)."""
    own = digest(payload)
    http = _head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], "HTTP/1.1 200 OK")
    block = http if first else http + payload
    lines = [("WARC-Type", "revisit" if first else "response"), ("WARC-Record-ID", record_id(row, own)), ("WARC-Date", date),
             ("WARC-Target-URI", uri or ""), ("WARC-Payload-Digest", f"sha1:{own}"), ("WARC-Block-Digest", f"sha1:{digest(block)}")]
    if first:
        lines += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(first[0], own)), ("WARC-Refers-To-Target-URI", first[1] or ""),
                  ("WARC-Refers-To-Date", date)]
    lines += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return _member(_head(lines, _VERSION) + block + b"\r\n\r\n")


def _info(name: str, date: str) -> bytes:
    block = _head([("software", "flatland"), ("format", "WARC File Format 1.1")], "")[2:]
    return _member(_head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("WARC-Filename", name),
                          ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(block)))], _VERSION) + block + b"\r\n\r\n")


def _member(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def with_first(rows: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Columns row, uri and payload, and ``first`` (row, uri) where the payload is that of another row with a smaller id.

    ``rows``: id, uri, payload. The ids keep their type for the comparison, and are texts afterwards.
    """
    keyed = rows.withColumn("key", F.sha1("payload")).withColumn("salt", F.pmod(F.xxhash64("id", "uri"), F.lit(SALTS)).cast("int"))
    # Reduced in the tasks that read the rows; one row for each payload that comes up twice, in as many copies as there are salts.
    repeated = (keyed.where(F.octet_length("payload") >= least_bytes).groupBy("key")
                .agg(F.count("*").alias("n"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "uri"))).alias("least")).where("n > 1 AND least IS NOT NULL"))
    repeated = repeated.select("key", "least", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    first = F.when(F.col("least").isNotNull() & ~F.col("id").eqNullSafe(F.col("least.id")),
                   F.struct(F.col("least.id").cast("string").alias("row"), F.col("least.uri").alias("uri")))
    return keyed.join(repeated, ["key", "salt"], "left").select(F.col("id").cast("string").alias("row"), "uri", "payload", first.alias("first"))


def write_archives(rows: DataFrame, folder: str, row: str, uri: str, payload: str, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for every row; returns the archives: path, n_records, n_bytes.

    ``folder`` must be one that the tasks can write to through pyarrow: a shared or object-store folder on a cluster.
    """
    spark = rows.sparkSession
    where = storage.qualify(spark, folder).rstrip("/")
    storage.mkdirs(spark, where)
    plain = rows.select(F.col(f"`{row}`").alias("id"), F.col(f"`{uri}`").cast("string").alias("uri"),
                        F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, inner = _filesystem(where)
        out, number, done = None, 0, []

        def close() -> None:
            out.close()
            done.append((path, count, size))

        for batch in batches:
            for r, u, p, f in zip(*(batch.column(i) for i in range(4))):
                if out is None:
                    name = f"rows-{task.partitionId():06d}-{task.taskAttemptId()}-{number:04d}.warc.gz"
                    path, count, size, number = f"{where}/{name}", 0, 0, number + 1
                    out = fs.open_output_stream(f"{inner}/{name}", compression=None)
                    head = _info(name, date)
                    out.write(head)
                    size += len(head)
                first = f.as_py()
                data = record(r.as_py(), u.as_py(), p.as_py(), date, (first["row"], first["uri"]) if first else None)
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
                                          pa.array([d[2] for d in done], pa.int64())], names=["path", "n_records", "n_bytes"])

    written = with_first(plain, least_bytes).mapInArrow(run, "path string, n_records long, n_bytes long")
    # The list is the commit: an archive is in it once, that of the attempt which Spark kept.
    written.write.parquet(f"{where}/_archives")
    return spark.read.parquet(f"{where}/_archives")


# Reading ---------------------------------------------------------------------

class _File:
    """Bytes of a file from any offset, read in steps; only a window of it is held."""

    def __init__(self, path: str):
        fs, inner = _filesystem(path)
        self.raw = fs.open_input_file(inner)
        self.size = self.raw.size()
        self.start, self.data = 0, b""

    def at(self, offset: int, n: int = STEP) -> bytes:
        """Up to ``n`` bytes from ``offset``."""
        if not (self.start <= offset and offset + n <= self.start + len(self.data)):
            self.raw.seek(offset)
            self.start, self.data = offset, self.raw.read(max(n, STEP))
        a = offset - self.start
        return self.data[a:a + n]

    def find(self, needle: bytes, offset: int, end: int) -> int:
        """First place of ``needle`` that starts in [offset, end), else -1."""
        while offset < end:
            chunk = self.at(offset, STEP)
            hit = chunk.find(needle)
            if hit >= 0:
                return offset + hit if offset + hit < end else -1
            if len(chunk) < STEP:
                return -1
            offset += len(chunk) - len(needle) + 1
        return -1


def _decoded(file: _File, offset: int) -> Iterator[tuple[bytes, int]]:
    """Decoded bytes of the member at ``offset`` in bounded steps; with the last of them its end (else 0).

    Raises zlib.error if the bytes are no gzip member, and EOFError if the file ends within it.
    """
    unpack = zlib.decompressobj(31)
    while True:
        raw = file.at(offset, 1 << 16)
        if not raw:
            raise EOFError("the file ends within a member")
        offset += len(raw)
        while raw and not unpack.eof:
            out = unpack.decompress(raw, STEP)
            raw = unpack.unconsumed_tail
            if unpack.eof:
                yield out, offset - len(unpack.unused_data)
                return
            if out:
                yield out, 0


def _fields(head: bytes) -> dict[str, str]:
    """Names (lower case) and values of a head; folded lines belong to the one before."""
    out: dict[str, str] = {}
    name = None
    for line in head.split(b"\r\n")[1:]:
        if line[:1] in (b" ", b"\t") and name:
            out[name] += " " + line.strip().decode("utf-8", "replace")
        elif b":" in line:
            key, value = line.split(b":", 1)
            name = key.strip().decode("utf-8", "replace").lower()
            out[name] = value.strip().decode("utf-8", "replace")
    return out


class _Record:
    """One record, taken from its member piece by piece."""

    def __init__(self, file: _File, offset: int, keep: bool = False):
        self.offset, self.payload = offset, bytearray() if keep else None
        pieces = _decoded(file, offset)
        head, self.next = b"", 0
        while b"\r\n\r\n" not in head and not self.next:
            if len(head) > HEAD_BYTES or (len(head) >= 5 and not head.startswith(b"WARC/")):
                raise ValueError("no WARC head")
            piece, self.next = next(pieces)
            head += piece
        if not head.startswith(b"WARC/") or b"\r\n\r\n" not in head:
            raise ValueError("no WARC head")
        head, rest = head.split(b"\r\n\r\n", 1)
        self.warc = _fields(head)
        if not {"warc-type", "warc-record-id", "content-length"} <= set(self.warc) or not self.warc["content-length"].isdigit():
            raise ValueError("a WARC head without its fields")
        self.http: dict[str, str] = {}
        self._left, self._block, self._hash, self.bytes = int(self.warc["content-length"]), b"", hashlib.sha1(), 0
        self._in_http = self.warc.get("content-type", "").lower().startswith("application/http")
        self._take(rest)
        while not self.next:
            piece, self.next = next(pieces)
            self._take(piece)
        if self._left:
            raise ValueError("a block shorter than it says")
        if self._in_http:                      # an HTTP head that never ended
            self._give(self._block)

    def _take(self, data: bytes) -> None:
        data = data[:self._left]
        self._left -= len(data)
        if self._in_http:
            self._block += data
            if b"\r\n\r\n" not in self._block:
                if len(self._block) <= HEAD_BYTES:
                    return
                data, self._block, self._in_http = self._block, b"", False
            else:
                head, data = self._block.split(b"\r\n\r\n", 1)
                self.http, self._block, self._in_http = _fields(head), b"", False
        self._give(data)

    def _give(self, data: bytes) -> None:
        self._hash.update(data)
        self.bytes += len(data)
        if self.payload is not None:
            self.payload += data

    def row(self, path: str, start: int) -> tuple:
        kind = self.warc["warc-type"].lower()
        told = self.warc.get("warc-payload-digest", "")
        told = told.split(":", 1)[1] if told.lower().startswith("sha1:") else None
        own = base64.b32encode(self._hash.digest()).decode("ascii")
        if kind == "revisit":                  # of the payload it stands for
            length = self.http.get("content-length", "")
            size, name, intact = int(length) if length.isdigit() else None, told, None
        else:
            size, name, intact = self.bytes, own, None if told is None else told == own
        return (path, start, self.offset, self.next, kind, self.warc["warc-record-id"], self.warc.get("warc-target-uri"), self.warc.get("warc-date"),
                self.warc.get("warc-refers-to"), size, name, intact)


def records_in(path: str, start: int, end: int, keep: bool = False) -> Iterator[_Record]:
    """The records of a file that start in [start, end)."""
    file = _File(path)
    at = start
    while at < end:
        at = file.find(MAGIC, at, end)
        if at < 0:
            return
        try:
            found = _Record(file, at, keep)
        except (zlib.error, ValueError, EOFError):
            at += 1
            continue
        yield found
        at = found.next


def index_archives(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row for every record of the archives (path, n_bytes), with its place; see ``INDEX``."""
    ranges = archives.where("n_bytes > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start"),
                                                  F.col("n_bytes").alias("size"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, F.col("size")).alias("stop"))
    spark = archives.sparkSession
    # One task for each few ranges, so that a task is short and is soon done again elsewhere.
    ranges = ranges.repartition(max(1, min(ranges.count(), 8 * spark.sparkContext.defaultParallelism)), "path", "start")
    names = [f.split()[0] for f in INDEX.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for path, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
                for found in records_in(path, start, stop):
                    rows.append(found.row(path, start))
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    index = ranges.mapInArrow(run, INDEX).checkpoint()
    return _nested(index)


def _nested(index: DataFrame) -> DataFrame:
    """Without the records that lie inside one of an earlier range."""
    reach = index.groupBy("path", "range").agg(F.min("offset").alias("first"), F.max("next").alias("reach"))
    before = Window.partitionBy("path").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    odd = reach.withColumn("floor", F.max("reach").over(before)).where("first < floor").select("path", "range", "floor")
    odd = odd.checkpoint()
    n = odd.count()                            # 0 unless a payload holds an archive across a range's start
    if not n:
        return index
    return join_small(index, odd, ["path", "range"], "left", n).where("floor IS NULL OR offset >= floor").drop("floor")


def read_payloads(index: DataFrame) -> DataFrame:
    """path, offset and payload of the records of an index; each is read from its own place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict[str, _File] = {}
        for batch in batches:
            for path, offset in zip(*(c.to_pylist() for c in batch.columns)):
                if path not in files:
                    files = {path: _File(path)}
                body = bytes(_Record(files[path], offset, keep=True).payload)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([offset], pa.int64()), pa.array([body], pa.binary())], names=["path", "offset", "payload"])

    return index.select("path", "offset").sortWithinPartitions("path", "offset").mapInArrow(run, "path string, offset long, payload binary")


def archive_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Archives of any origin as ``index_archives`` takes them: path and n_bytes of the files that match."""
    return spark.createDataFrame([(p, n) for p, n, _ in storage.glob_files(spark, pattern)], "path string, n_bytes long")
