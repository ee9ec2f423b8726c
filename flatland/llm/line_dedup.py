"""Line dedup by overlapping three-line windows.

The consecutive lines of a text that are not blank form windows of three. Every window is hashed (128 bits); the first
occurrence of a window in the whole corpus, by document id and place, stays, all later ones are removed: the
positions that later windows cover are merged, and the lines in them (blank lines between them, too) go.

Windows are counted with a partial aggregate before the shuffle, so a window that a third of all documents
hold costs one row a task there. Only hashes and places are joined; texts move once, to meet their covered places.

Defined cases: a null text stays null and a text with fewer than three lines that are not blank stays as it is; lines are
compared without white space at their ends; within a text, too, later windows go, so of a line repeated many times
running the first stays; rows with the same id and text are one document and share its fate, rows with the same id
and another text are documents of their own, ordered by the text's hash; a null id comes first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatland.llm.common import whole_row, with_row

WINDOW = 3
_BLANK = " \t\r\x0b\x0c"


def windows_of(text: str | None, size: int = WINDOW) -> list[tuple[bytes, int]]:
    """Hash and number of each window: that of its first line among those not blank."""
    lines = [s for line in text.split("\n") if (s := line.strip(_BLANK))] if text else []
    return [(hashlib.blake2b("\n".join(lines[i:i + size]).encode("utf-8", "surrogatepass"), digest_size=16).digest(), i)
            for i in range(len(lines) - size + 1)]


def without(text: str, numbers: list[int], size: int = WINDOW) -> tuple[str, int]:
    """The text without the lines that the windows cover, and how many went."""
    lines = text.split("\n")
    place = [i for i, line in enumerate(lines) if line.strip(_BLANK)]
    edge = np.zeros(len(lines) + 1, dtype=np.int64)
    np.add.at(edge, [place[n] for n in numbers], 1)
    np.add.at(edge, [place[n + size - 1] + 1 for n in numbers], -1)
    covered = np.cumsum(edge)[:-1] > 0
    return "\n".join(line for line, gone in zip(lines, covered) if not gone), int(covered.sum())


def dedup_lines(documents: DataFrame, size: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its text deduplicated and n_removed, the number of lines that went."""
    others = [c for c in documents.columns if c not in (text, "n_removed")]
    docs = documents.select(whole_row(documents, others), F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    docs = docs.withColumn("version", F.xxhash64("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hashes, numbers = [], [], []
            for i, t in enumerate(batch.column(1)):
                for h, n in windows_of(t.as_py(), size):
                    rows.append(i)
                    hashes.append(h)
                    numbers.append(n)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at), pa.array(hashes, pa.binary()), pa.array(numbers, pa.int32())],
                                             names=["doc_id", "version", "hash", "number"])

    windows = docs.select("doc_id", "text", "version").mapInArrow(cut, "doc_id long, version long, hash binary, number int").checkpoint()
    place = F.struct("doc_id", "version", "number")
    first = windows.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("hash", "first")
    covered = (windows.join(first, "hash").where(place != F.col("first"))
               .groupBy("doc_id", "version").agg(F.collect_set("number").alias("numbers"))
               .select(F.col("doc_id").alias("id"), F.col("version").alias("v"), "numbers"))
    met = docs.join(covered, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("version") == F.col("v")), "left")
    met = met.select("row", "text", "numbers")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = [], []
            for t, numbers in zip(batch.column(1), batch.column(2)):
                numbers = numbers.as_py()
                left, n = without(t.as_py(), numbers, size) if numbers else (t.as_py(), 0)
                texts.append(left)
                gone.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(gone, pa.int32())], names=["row", "text", "n_removed"])

    out = met.mapInArrow(remove, with_row(met, "text string, n_removed int"))
    return out.select(*[(F.col("text") if c == text else F.col(f"row.`{c}`")).alias(c) for c in documents.columns if c != "n_removed"], "n_removed")
