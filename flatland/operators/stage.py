"""Stage layer: typed mapping, latest row per key, ordered fix-up steps.

* ``map_columns`` is the wrk -> stg (and stg -> tgt) column mapping with
  relational cast semantics (P8-P10).
* ``dedup_latest`` keeps one row per key (W1). It is an aggregate, not a
  window: ``max`` over a struct that carries the ordering columns first, as
  (is_null, value) pairs so that nulls rank first under descending order,
  then every other column as a total tie-breaker. ``max`` is combined on the
  map side, so a key holding a third of all rows is reduced in every task
  before the shuffle instead of being sorted in a single task.
* Fix-up steps (X3) are an ordered list of DataFrame -> DataFrame functions;
  conditional update (P12) and delete (P13) are provided, each with its
  affected-row count (P15).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatland.functions.casts import db_cast, parse_db_type, pg_timestamp0

AUDIT_ORDER = ("load_timestamp", "load_file_name")


@dataclass(frozen=True)
class ColumnMap:
    source: str
    target: str
    type: str


def map_columns(df: DataFrame, mapping: Sequence[ColumnMap]) -> DataFrame:
    """SELECT CAST(src AS type) AS tgt, ...."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[db_cast(F.col(f"`{m.source}`"), m.type, kinds.get(m.source)).alias(m.target) for m in mapping])


def cut_cells(mapping: Sequence[ColumnMap], columns: Sequence[str]) -> Column | None:
    """Aggregate: how many cells of each varchar(n) column (by its target name) the mapping cuts (V9); None without such columns."""
    sizes = {m.target: (m.source, n) for m in mapping for base, n, _ in [parse_db_type(m.type)]
             if n and base in ("varchar", "character varying", "char") and m.source in columns}
    if not sizes:
        return None
    counts = {t: F.count_if(F.length(F.col(f"`{c}`").cast("string")) > n) for t, (c, n) in sizes.items()}
    return F.create_map(*[x for t, count in counts.items() for x in (F.lit(t), count)])


def add_modify_stamp(df: DataFrame, job_time: str | None = None, name: str = "modify_date_time") -> DataFrame:
    """modify_date_time = current timestamp kept to whole seconds.

    ``job_time`` pins the value (tests, replays); otherwise the statement's
    current timestamp is used, one value for the whole query.
    """
    now = F.lit(job_time).cast("timestamp_ntz") if job_time else F.localtimestamp()
    return df.withColumn(name, pg_timestamp0(now))


def dedup_latest(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str] = AUDIT_ORDER) -> DataFrame:
    """Latest row per key: ORDER BY order_desc DESC NULLS FIRST, then the rest.

    Ties on the ordering columns are broken by every remaining column (also
    descending, nulls first), so the survivor does not depend on partitioning.
    """
    keys = list(keys)
    order = [c for c in order_desc if c in df.columns and c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = order + rest
    parts = []
    for i, c in enumerate(ranked):
        parts.append(F.col(f"`{c}`").isNull().alias(f"n{i}"))
        parts.append(F.col(f"`{c}`").alias(f"v{i}"))
    best = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.max(F.struct(*parts)).alias("_best"))
    pick = {c: F.col(f"_best.v{i}").alias(c) for i, c in enumerate(ranked)}
    return best.select(*[F.col(f"`{c}`") if c in keys else pick[c] for c in df.columns])


def update_where(df: DataFrame, assignments: dict[str, Column | object], pred: Column) -> DataFrame:
    """UPDATE t SET c = v WHERE pred (P12). A null predicate leaves the row alone."""
    hit = F.coalesce(pred, F.lit(False))
    out = df
    for c, v in assignments.items():
        value = v if isinstance(v, Column) else F.lit(v)
        out = out.withColumn(c, F.when(hit, value.cast(df.schema[c].dataType)).otherwise(F.col(f"`{c}`")))
    return out


def delete_where(df: DataFrame, pred: Column | None = None) -> DataFrame:
    """DELETE FROM t [WHERE pred] (P13). A null predicate keeps the row."""
    if pred is None:
        return df.filter(F.lit(False))
    return df.filter(~F.coalesce(pred, F.lit(False)))


@dataclass
class Step:
    """One fix-up step. ``action`` is update, delete, insert or transform."""

    name: str
    action: str
    pred: Column | None = None
    assignments: dict = field(default_factory=dict)
    rows: DataFrame | None = None                      # insert: rows to append
    fn: Callable[[DataFrame], DataFrame] | None = None  # transform

    def apply(self, df: DataFrame) -> DataFrame:
        if self.action == "update":
            return update_where(df, self.assignments, self.pred)
        if self.action == "delete":
            return delete_where(df, self.pred)
        if self.action == "insert":
            return df.unionByName(self.rows, allowMissingColumns=True)
        if self.action == "transform":
            return self.fn(df)
        raise ValueError(f"unknown step action {self.action!r}")

    def affected(self, df: DataFrame) -> Column:
        """Aggregate expression counting the rows this step touches."""
        if self.action in ("update", "delete"):
            if self.pred is None:
                return F.count(F.lit(1))
            return F.count_if(F.coalesce(self.pred, F.lit(False)))
        return F.lit(None).cast("long")


def run_steps(df: DataFrame, steps: Sequence[Step], point: str = "stage") -> tuple[DataFrame, DataFrame]:
    """Apply steps in order; returns (result, per-step counts).

    Counts of update/delete steps are one aggregate per step over that step's
    input; insert counts are the inserted row counts. The counts frame is
    lazy: it runs only when read.
    """
    counts = []
    current = df
    for i, s in enumerate(steps):
        if s.action == "insert":
            n = s.rows.agg(F.count(F.lit(1)).alias("rows"))
        else:
            n = current.agg(s.affected(current).alias("rows"))
        counts.append(n.select(F.lit(point).alias("point"), F.lit(i + 1).alias("step_no"),
                               F.lit(s.name).alias("step"), F.lit(s.action).alias("action"),
                               F.col("rows").cast("long").alias("rows")))
        current = s.apply(current)
    if counts:
        out = counts[0]
        for c in counts[1:]:
            out = out.unionByName(c)
    else:
        out = df.sparkSession.createDataFrame([], "point string, step_no int, step string, action string, rows long")
    return current, out
