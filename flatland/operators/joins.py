"""Join helper: broadcast only a side whose row count and width are known to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Most rows and bytes we ship to every executor. Sides of a checked count at or
# below both are broadcast; anything larger (or of unknown size) is joined by
# shuffle and left to AQE, which can still switch to broadcast at run time.
BROADCAST_ROW_LIMIT = 200_000
BROADCAST_BYTES = 32 << 20
# Bytes taken for a text (paths are the longest we join by) and for other values.
TEXT_BYTES, OTHER_BYTES = 200, 16


def row_bytes(df: DataFrame) -> int:
    """Bytes to allow for a row, from the column types."""
    return sum(TEXT_BYTES if isinstance(f.dataType, (T.StringType, T.BinaryType)) else OTHER_BYTES for f in df.schema.fields)


def is_broadcast(small: DataFrame, small_rows: int | None) -> bool:
    """Whether a side of so many rows is small enough to broadcast."""
    return small_rows is not None and small_rows <= BROADCAST_ROW_LIMIT and small_rows * row_bytes(small) <= BROADCAST_BYTES


def join_small(big: DataFrame, small: DataFrame, on, how: str, small_rows: int | None) -> DataFrame:
    if is_broadcast(small, small_rows):
        small = F.broadcast(small)
    return big.join(small, on, how)
