"""zip (first member) and xz files, which Spark's text codecs do not read.

Each archive is expanded by one task into a plain copy in the run folder;
the plain copies are then read by the ordinary CSV reader, so quoting and
multi-line values behave exactly as for uncompressed files. The expansion
streams, so an archive never has to fit in memory.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession

from flatland.sources.files import _opener

ARCHIVE_SUFFIXES = (".zip", ".xz")


def needs_expansion(path: str) -> bool:
    return path.lower().endswith(ARCHIVE_SUFFIXES)


def expand_archives(spark: SparkSession, paths: list[str], out_dir: str) -> dict[str, str]:
    """Expand archives into ``out_dir``; returns {archive path: plain path}."""
    todo = [p for p in paths if needs_expansion(p)]
    if not todo:
        return {}
    from flatland.sources.files import python_can_open
    if not (python_can_open(todo[0]) and python_can_open(out_dir)):
        raise ValueError(f"zip/xz files need a file system the Python workers can open: {todo[0]}")
    targets = [(p, f"{out_dir.rstrip('/')}/{i:06d}-{p.rsplit('/', 1)[-1]}.plain") for i, p in enumerate(todo)]
    frame = spark.createDataFrame(targets, "src string, dst string").repartition(len(targets))

    def expand(batches):
        import os

        import pyarrow.fs as pafs
        for pdf in batches:
            done = []
            for src, dst in zip(pdf["src"], pdf["dst"]):
                fh = _opener(src)
                local = dst[5:] if dst.startswith("file:") else dst
                if dst.startswith("file:") or dst.startswith("/"):
                    while local.startswith("//"):
                        local = local[1:]
                    os.makedirs(os.path.dirname(local), exist_ok=True)
                    out = open(local, "wb")
                else:
                    fs, inner = pafs.FileSystem.from_uri(dst.replace("s3a://", "s3://"))
                    out = fs.open_output_stream(inner)
                n = 0
                try:
                    if fh is not None:
                        while True:
                            chunk = fh.read(1 << 20)
                            if not chunk:
                                break
                            out.write(chunk)
                            n += len(chunk)
                finally:
                    out.close()
                    if fh is not None:
                        fh.close()
                done.append((src, dst, n))
            yield pd.DataFrame(done, columns=["src", "dst", "bytes"])

    rows = frame.mapInPandas(expand, "src string, dst string, bytes long").collect()
    return {r["src"]: r["dst"] for r in rows}
