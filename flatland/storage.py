"""Small file-system helpers over the Hadoop FileSystem the session uses.

Listing, existence checks and renames go through the same FileSystem API that
Spark's own readers and writers use, so they work unchanged on HDFS, object
stores and local disks.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jpath.getFileSystem(conf), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return bool(fs.exists(jpath))


def list_dir(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(full path, is_directory) of the direct children of ``path``."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    return [(st.getPath().toString(), bool(st.isDirectory())) for st in fs.listStatus(jpath)]


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.mkdirs(jpath)


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, jsrc = _fs(spark, src)
    jvm = spark.sparkContext._jvm
    jdst = jvm.org.apache.hadoop.fs.Path(dst)
    fs.mkdirs(jdst.getParent())
    return bool(fs.rename(jsrc, jdst))


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, jpath = _fs(spark, path)
    return bool(fs.delete(jpath, recursive))


def write_small_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small text file (a pointer or marker) atomically enough."""
    fs, jpath = _fs(spark, path)
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small binary file (a zipped package, say)."""
    fs, jpath = _fs(spark, path)
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small text file that must not exist yet; False if it does. Of several writers one succeeds."""
    fs, jpath = _fs(spark, path)
    try:
        out = fs.create(jpath, False)
    except Exception as e:  # noqa: BLE001 - a Java exception of the file system's own kind
        if fs.exists(jpath):
            return False
        raise e
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def read_small_text(spark: SparkSession, path: str) -> str | None:
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(jpath)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def glob_files(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """(path, length, modification ms) of the files matching a glob, sorted by path.

    The glob covers the top level only, and extension matching is
    case-sensitive, as the folder sweep requires.
    """
    fs, jpath = _fs(spark, pattern)
    statuses = fs.globStatus(jpath)
    if statuses is None:
        return []
    out = [(st.getPath().toString(), int(st.getLen()), int(st.getModificationTime()))
           for st in statuses if st.isFile()]
    return sorted(out)


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified form of a path (scheme included), as Spark reports file paths."""
    fs, jpath = _fs(spark, path)
    return fs.makeQualified(jpath).toString()


def file_lengths(spark: SparkSession, paths: list[str]) -> dict[str, int]:
    """Length in bytes of each path, one directory listing per parent folder."""
    by_dir: dict[str, set[str]] = {}
    for p in paths:
        by_dir.setdefault(p.rstrip("/").rsplit("/", 1)[0], set()).add(p)
    out: dict[str, int] = {}
    for d, wanted in by_dir.items():
        fs, jpath = _fs(spark, d)
        if not fs.exists(jpath):
            continue
        for st in fs.listStatus(jpath):
            full = st.getPath().toString()
            bare = full[5:] if full.startswith("file:") else full
            for cand in (full, bare, "file:" + bare, "file://" + bare):
                if cand in wanted:
                    out[cand] = int(st.getLen())
    return out


def list_dir_times(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    """(full path, is_directory, modification ms) of the direct children of ``path``."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    return [(st.getPath().toString(), bool(st.isDirectory()), int(st.getModificationTime()))
            for st in fs.listStatus(jpath)]


def read_prefix(spark: SparkSession, path: str, size: int) -> bytes:
    """The first ``size`` bytes of a (possibly compressed) file, fewer if it is shorter."""
    jvm = spark.sparkContext._jvm
    fs, jpath = _fs(spark, path)
    stream = fs.open(jpath)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(jpath)
        source = codec.createInputStream(stream) if codec is not None else stream
        return bytes(source.readNBytes(size))
    finally:
        stream.close()
