"""Key checks (A10, O3)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def key_check(df: DataFrame, keys: Sequence[str], table_name: str, sample_size: int = 5) -> DataFrame:
    """Is the key unique and null-free? One row, with a sample of offenders.

    Duplicates are a grouped count (map-side combined, so a hot key is
    reduced before the shuffle); null-key rows are counted separately and do
    not form duplicate groups. The sample is the first ``sample_size``
    duplicated keys in key order: a bounded top-k, never a collected group.
    """
    keys = list(keys)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    full = df.filter(~any_null)
    dups = full.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    key_text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    sample = (dups.orderBy(*keys).limit(sample_size)
              .agg(F.sort_array(F.collect_list(F.struct(*[F.col(k) for k in keys], key_text.alias("t"))))
                   .alias("s"))
              .select(F.when(F.size("s") > 0, F.array_join(F.transform("s", lambda x: x["t"]), ","))
                      .alias("sample")))
    n_dup = dups.agg(F.count(F.lit(1)).alias("duplicate_keys"))
    n_null = df.agg(F.count_if(any_null).alias("null_key_rows"))
    parts = (n_dup.select("duplicate_keys", F.lit(None).cast("long").alias("null_key_rows"),
                          F.lit(None).cast("string").alias("sample"))
             .unionByName(n_null.select(F.lit(None).cast("long").alias("duplicate_keys"), "null_key_rows",
                                        F.lit(None).cast("string").alias("sample")))
             .unionByName(sample.select(F.lit(None).cast("long").alias("duplicate_keys"),
                                        F.lit(None).cast("long").alias("null_key_rows"), "sample")))
    one = parts.agg(F.max("duplicate_keys").alias("duplicate_keys"), F.max("null_key_rows").alias("null_key_rows"),
                    F.max("sample").alias("sample"))
    return one.select(F.lit(table_name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
                      (F.col("duplicate_keys") == 0).alias("is_unique"), (F.col("null_key_rows") == 0).alias("no_nulls"),
                      "duplicate_keys", "null_key_rows", "sample")


def key_offenders(df: DataFrame, keys: Sequence[str], n_keys: int = 5, n_rows: int = 5) -> DataFrame:
    """Whole rows that break a key: ``offence`` and the columns of ``df``.

    Up to ``n_rows`` rows of each of the first ``n_keys`` duplicated keys, in key order, and as many rows in all with a null in the
    key; rows are taken in the order of all their columns. The keys are a bounded top-k of a combinable count and are
    joined back to the table; the limit on rows (under Spark's threshold for it) is taken in every task before the shuffle,
    so a key that holds a third of all rows is never gathered.
    """
    keys = list(keys)
    if not 0 < n_keys * n_rows < 1000:
        raise ValueError("a sample of offenders is less than 1,000 rows")
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(f"`{k}`").isNull()
    columns = [F.col(f"`{c}`") for c in df.columns]
    order = [F.col(f"`{c}`").asc_nulls_first() for c in df.columns]
    dups = df.filter(~any_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").orderBy(*keys).limit(n_keys).drop("_n")
    rows = df.join(F.broadcast(dups), keys, "left_semi")                       # n_keys rows
    each = rows.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_place") <= n_rows)
    nulls = df.filter(any_null).orderBy(*order).limit(n_keys * n_rows)
    return (each.select(F.lit("duplicate").alias("offence"), *columns).unionByName(nulls.select(F.lit("null key").alias("offence"), *columns)))
