"""Null markers and quote stripping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that always mean "no value" (exact,
# case-sensitive match). A feed may add one more marker of its own.
NULL_MARKERS = [
    "", "#N/A", "NaN", "NULL", "null", "Null", "<NULL>", "[NULL]", "(NULL)",
    "#VALUE!", "#DIV/0!", "#REF!", "#NUM!", "#NAME?",
]


def marker_set(extra: str | None = None) -> list[str]:
    markers = list(NULL_MARKERS)
    if extra is not None and extra not in markers:
        markers.append(extra)
    return markers


def null_markers(c: Column, extra: str | None = None) -> Column:
    """Null when the cell equals one of the markers."""
    return F.when(~c.isin(*marker_set(extra)), c)


def strip_quotes(c: Column) -> Column:
    """Remove every double quote, then turn '' into null (P5)."""
    return F.nullif(F.replace(c, F.lit('"'), F.lit("")), F.lit(""))


def clean_cell(c: Column, extra_marker: str | None, quoted: bool) -> Column:
    """Markers first, then quote stripping when the feed is quoted."""
    c = null_markers(c, extra_marker)
    return strip_quotes(c) if quoted else c
