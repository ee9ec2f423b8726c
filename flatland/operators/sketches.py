"""Mergeable sketches of columns: distinct counts and frequent values without a second look at old files (A4, U4).

A sketch is made for each file once and kept with it. A folder's facts are its files' sketches put together, so a new file costs a
scan of that file alone. Distinct counts are HyperLogLog sketches (``lg_k`` 12: about 1.6 percent standard error), frequent
values are approximate top-k sketches; both are Spark's own aggregates, combined before the shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12
#: Values that a frequent-items sketch tracks: counts are exact while a column has no more different values.
TRACKED = 4096


def column_sketches(long: DataFrame, by: Sequence[str] = ("column_name",), lg_k: int = LG_K) -> DataFrame:
    """Sketches per group of an unpivoted frame (``s`` holds the cell text): rows, nulls, longest text, distinct values, frequent values."""
    return long.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("s").isNull()).alias("n_null"), F.max(F.length("s")).alias("max_len"),
        F.hll_sketch_agg("s", lg_k).alias("distinct_sketch"), F.expr(f"approx_top_k_accumulate(s, {TRACKED})").alias("frequent_sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ("column_name",)) -> DataFrame:
    """Sketches of larger groups from those of smaller ones (files of a folder)."""
    return sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.max("max_len").alias("max_len"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.expr(f"approx_top_k_combine(frequent_sketch, {TRACKED})").alias("frequent_sketch"))


def sketch_facts(sketches: DataFrame, top_n: int = 10) -> DataFrame:
    """What sketches tell: the approximate distinct count (``n_distinct``) and the most frequent values with their counts (``top``)."""
    keep = [c for c in sketches.columns if c not in ("distinct_sketch", "frequent_sketch")]
    return sketches.select(*keep, F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"), F.expr(f"approx_top_k_estimate(frequent_sketch, {top_n})").alias("top"))
