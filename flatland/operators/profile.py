"""Profiler: per-column facts in one aggregate pass, and the types they imply.

``profile_columns`` computes, for every string column at once, the counts and
extremes that type inference needs (A3, A5-A8) with partial aggregation, so
the pass is one scan and one tiny shuffle whatever the row count.
``infer_types`` turns those facts into a landing type and a database type
(I1-I6). ``distinct_values`` is the top-N value analysis (A4, O4).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flatland.functions.casts import VARCHAR_LADDER, first_layout, layout_mask, number_attempt, number_datetime, number_value, parse_datetime

PROFILE_FIELDS = [
    ("n_rows", "long"), ("n_nonnull", "long"), ("n_null", "long"), ("max_len", "int"),
    ("n_bad_number", "long"), ("n_bad_datetime", "long"), ("all_integral", "boolean"),
    ("min_number", "double"), ("max_number", "double"), ("max_left", "int"), ("max_right", "int"),
    ("has_time", "boolean"), ("date_layouts", "long"),
]


def _digits_left(text: Column) -> Column:
    """Digits left of the point, sign included (A8): '-12.5' -> 3, '0.5' -> 1."""
    t = F.trim(text)
    return F.greatest(F.length(F.split_part(t, F.lit("."), F.lit(1))), F.lit(1))


def _digits_right(text: Column) -> Column:
    """Digits right of the point, trailing zeros dropped (A8): '1.50' -> 1, '7' -> 0."""
    t = F.trim(text)
    frac = F.when(t.contains("."), F.split_part(t, F.lit("."), F.lit(2))).otherwise(F.lit(""))
    # The pattern's end is also that before a line end.
    return F.length(F.when(frac.contains("\n") | frac.contains("\r"), F.regexp_replace(frac, "0+$", "")).otherwise(F.rtrim(frac, F.lit("0"))))


def unpivot(df: DataFrame, columns: Sequence[str] | None = None, **extra: Column) -> DataFrame:
    """(extra..., column_name, position, s): one row per cell, as text."""
    columns = list(columns or df.columns)
    return df.select(*[v.alias(k) for k, v in extra.items()], F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(i + 1).alias("position"),
                 F.col(f"`{c}`").cast("string").alias("s"))
        for i, c in enumerate(columns)])))


def profile_long(long: DataFrame, by: Sequence[str] = ("column_name", "position")) -> DataFrame:
    """Profile facts per group of an unpivoted frame (``s`` holds the cell text)."""
    s = F.col("s")
    exponent = s.contains("e") | s.contains("E")
    # Each cell is cast once; a number is no date but for its eight digits.
    a = F.col("a")
    num, bad_num = number_value(a), s.isNotNull() & a.isNull()
    parsed = F.when(a.isNotNull(), number_datetime(s)).otherwise(parse_datetime(s))
    facts = long.withColumn("a", number_attempt(s)).select(*by, "s", num.alias("v"), bad_num.alias("b"), parsed.alias("t"),
                        F.when(num.isNotNull(), _digits_left(s)).alias("l"), F.when(num.isNotNull(), _digits_right(s)).alias("r"),
                        exponent.alias("e")).withColumn("m", layout_mask(s, F.col("t")))
    v, t = F.col("v"), F.col("t")
    finite = v.isNotNull() & (F.abs(v) != float("inf"))
    plain = finite & ~F.col("e")
    aggs = {
        "n_rows": F.count(F.lit(1)),
        "n_nonnull": F.count(s),
        "n_null": F.count_if(s.isNull()),
        "max_len": F.max(F.length(s)),
        "n_bad_number": F.count_if(F.col("b")),
        "n_bad_datetime": F.count_if(s.isNotNull() & t.isNull()),
        "all_integral": F.coalesce(F.bool_and(F.when(finite, v % 1 == 0)), F.lit(True)),
        "min_number": F.min(F.when(finite, v)),
        "max_number": F.max(F.when(finite, v)),
        "max_left": F.max(F.when(plain, F.col("l"))),
        "max_right": F.max(F.when(plain, F.col("r"))),
        # Layouts that read every value: the column's vote.
        "date_layouts": F.coalesce(F.bit_and(F.when(s.isNotNull(), F.col("m"))), F.lit(0)),
        "has_time": F.coalesce(F.bool_or(t != F.date_trunc("DAY", t).cast("timestamp_ntz")), F.lit(False)),
    }
    out = facts.groupBy(*by).agg(*[e.alias(k) for k, e in aggs.items()])
    return out.select(*by, *[F.col(k).cast(ty).alias(k) for k, ty in PROFILE_FIELDS])


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: ``column_name, position`` and the PROFILE_FIELDS.

    The rows are unpivoted to (column, value) inside the scan's pipeline,
    each cell is parsed once (number, date, digit counts), and one grouped
    aggregate per column combines map-side, so the shuffle carries one small
    row per column per task. Generated code stays the same size however wide
    the file is, and the input is scanned once.
    """
    return profile_long(unpivot(df, columns))


def varchar_size(max_len: Column) -> Column:
    """First ladder size above floor(1.3 * max_len), else 4000; 1 for one-char columns."""
    buffered = F.floor(max_len * F.lit(1.3))
    size = F.lit(VARCHAR_LADDER[-1])
    for n in reversed(VARCHAR_LADDER):
        size = F.when(F.lit(n) > buffered, F.lit(n)).otherwise(size)
    return F.when(max_len == 1, F.lit(1)).otherwise(size)


def landing_type(p: DataFrame | None = None) -> Column:
    """I1 + I2: float64 if every value is a number, else date/timestamp if every
    value is a date, else string; an all-null column stays string."""
    return (F.when(F.col("n_nonnull") == 0, F.lit("string"))
            .when(F.col("n_bad_number") == 0, F.lit("float64"))
            .when(F.col("n_bad_datetime") == 0,
                  F.when(F.col("has_time"), F.lit("timestamp")).otherwise(F.lit("date")))
            .otherwise(F.lit("string")))


def db_type() -> Column:
    """Database type from the profile facts and the landing type.

    A value longer than the ladder's last size makes its column unbounded text, where I5 would cut it.
    """
    lt = F.col("landing_type")
    scale = F.col("max_right") + 1
    precision = F.least(F.col("max_left") + scale + 2, F.lit(38))
    decimal = F.format_string("decimal(%d,%d)", precision, F.least(scale, precision))
    # Doubles near 2^63 stand for several integers: only what is surely below is a bigint.
    int_class = (F.when((F.col("max_number") >= 9223372036854775808.0) | (F.col("min_number") < -9223372036854775808.0),
                        F.lit("decimal(38,0)"))
                 .when((F.col("max_number") > 2147483647) | (F.col("min_number") < -2147483648), F.lit("bigint"))
                 .otherwise(F.lit("integer")))
    return (F.when(lt == "timestamp", F.lit("timestamp(0)"))
            .when(lt == "date", F.lit("date"))
            .when(lt == "float64", F.when(F.col("all_integral"), int_class).otherwise(decimal))
            .when(F.col("n_nonnull") == 0, F.lit("varchar(?)"))
            .when(F.col("max_len") > VARCHAR_LADDER[-1], F.lit("text"))
            .otherwise(F.format_string("varchar(%d)", varchar_size(F.col("max_len")))))


def infer_types(profile: DataFrame) -> DataFrame:
    """Profile rows + ``landing_type`` + ``db_type`` + ``date_layout`` (of date and timestamp columns that one layout reads)."""
    out = profile.withColumn("landing_type", landing_type()).withColumn("db_type", db_type())
    layout = F.when(F.col("landing_type").isin("date", "timestamp"), first_layout(F.col("date_layouts")))
    return out.withColumn("date_layout", layout)


def distinct_values(df: DataFrame, columns: Sequence[str], top_n: int = 10) -> DataFrame:
    """Top ``top_n`` values per column by frequency, ties by value (A4, U4, O4), and each column's exact distinct count."""
    return distinct_long(unpivot(df, columns), ["column_name"], top_n)


def distinct_long(long: DataFrame, by: Sequence[str], top_n: int = 10) -> DataFrame:
    """``distinct_values`` per group of an unpivoted frame (``s`` holds the cell text).

    Count per (group, value) with map-side combine, then a
    row_number limit per group; Spark runs that limit partially before the
    shuffle, so a column with billions of distinct values never gathers them
    in one task. Also returns each column's exact distinct count.
    """
    by = list(by)
    counts = long.groupBy(*by, F.col("s").alias("value")).agg(F.count(F.lit(1)).alias("frequency"))
    w = Window.partitionBy(*by).orderBy(F.col("frequency").desc(), F.col("value").asc_nulls_first())
    top = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n)
    # Reads ``frequency`` so that both branches share one (column, value)
    # aggregate and its shuffle is reused instead of scanning the input again.
    present = F.when(F.col("frequency") > 0, F.col("value"))
    n_distinct = counts.groupBy(*by).agg(F.count(present).alias("n_distinct"))
    return top.join(F.broadcast(n_distinct), by)                 # one row per given column
