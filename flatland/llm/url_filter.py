"""URL filters as a sort-merge range join (DataFrame functions only).

A host is written with its labels reversed and a closing dot (``www.example.com``
becomes ``com.example.www.``), so a host and all its subdomains are one interval of the
sorted keys: ``com.example.`` up to ``com.example/`` (the byte after the dot; no host
holds a slash). Intervals of the rules of one path prefix nest or are disjoint. A sorted sweep
over urls and interval ends therefore sees a stack of open rules; each rule event carries the rule on
top of the stack after it, and a running ``last`` gives every url the innermost open rule.
Rules with another path prefix have a stack (a window column) of their own, all over the same sort.

The urls are salted over many sweeps so that one host with a third of all rows is shared out;
the few rule events are repeated in each. The rule table is a parameter of the
operator; its events are (2 x rules) rows a sweep, and it has one column for each distinct rule path.

Defined cases: a null url or one without ``://`` has empty host and path and fits
no rule; no fitting rule gives a null rule and the default verdict; of the rules that fit, the longest
(host and path together) wins; equal rows give equal rows; all columns of the input but the clashing
result names are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flatland.llm.common import shuffle_partitions

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PRIVATE = "_uf_"


@dataclass(frozen=True)
class Rule:
    """Verdict for a host, its subdomains, and urls whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z as a-z."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


def rule_events(rules: list[Rule]) -> list[tuple[str, int, int]]:
    """(key, path number, rule on top of that path's stack after the key; -1: none)."""
    paths = sorted({r.path for r in rules})
    events = []
    for n, path in enumerate(paths):
        # Of rules with the same host and path the first given counts.
        own: dict[str, int] = {}
        for i, r in enumerate(rules):
            if r.path == path:
                own.setdefault(".".join(reversed(r.host.split("."))) + ".", i)
        edges = sorted([(k, i) for k, i in own.items()] + [(k[:-1] + "/", -1) for k in own])
        stack: list[int] = []
        for key, opened in edges:
            if opened >= 0:
                stack.append(opened)
            else:
                stack.pop()
            events.append((key, n, stack[-1] if stack else -1))
    return events


def judge_urls(pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow",
               sweeps: int | None = None) -> DataFrame:
    """Add host, path, rule (text or null) and verdict to every row of ``pages``."""
    spark = pages.sparkSession
    sweeps = sweeps or max(64, 4 * shuffle_partitions(spark))
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    paths = sorted({r.path for r in rules})
    p = _PRIVATE
    rows = pages.select(
        F.struct(*[F.col(f"`{c}`").alias(c) for c in kept]).alias(p + "row"),
        host_of(F.col(url)).alias(p + "host"), path_of(F.col(url)).alias(p + "path"),
    ).select(
        # Rows are dealt by all their columns; equal rows beyond number are dealt by place, too.
        F.pmod(F.xxhash64(p + "row", F.monotonically_increasing_id()), F.lit(sweeps)).alias(p + "sweep"),
        host_key(F.col(p + "host")).alias(p + "key"), F.lit(1).alias(p + "order"), p + "row", p + "host", p + "path",
        *[F.lit(None).cast("int").alias(f"{p}open{n}") for n in range(len(paths))],
    )
    events = rule_events(rules)
    if events:
        listed = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(n).alias("n"), F.lit(top).alias("top")) for k, n, top in events])
        marks = spark.range(sweeps).select(F.col("id").alias(p + "sweep"), F.inline(listed))
        rows = rows.unionByName(marks.select(
            p + "sweep", F.col("k").alias(p + "key"), F.lit(0).alias(p + "order"),
            *[F.when(F.col("n") == n, F.col("top")).alias(f"{p}open{n}") for n in range(len(paths))],
        ), allowMissingColumns=True)
    sweep = Window.partitionBy(p + "sweep").orderBy(p + "key", p + "order").rowsBetween(Window.unboundedPreceding, 0)
    open_rules = [F.last(f"{p}open{n}", ignorenulls=True).over(sweep).alias(f"{p}open{n}") for n in range(len(paths))]
    swept = rows.select(p + "row", p + "order", p + "host", p + "path", *open_rules).where(F.col(p + "order") == 1)
    # The longest of the open rules whose path fits; equal lengths: the first given.
    texts = F.array(*[F.lit(r.text) for r in rules]) if rules else None
    verdicts = F.array(*[F.lit(r.verdict) for r in rules]) if rules else None
    best = F.lit(None).cast("struct<size:int,at:int>")
    for n, path in enumerate(paths):
        top = F.col(f"{p}open{n}")
        fits = (top >= 0) & F.col(p + "path").startswith(F.lit(path))
        mine = F.when(fits, F.struct(F.length(F.get(texts, top)).alias("size"), (-top).alias("at")))
        best = F.greatest(best, mine) if n else mine
    at = -best["at"]
    return swept.select(
        f"{p}row.*", F.col(p + "host").alias("host"), F.col(p + "path").alias("path"),
        (F.get(texts, at) if rules else F.lit(None).cast("string")).alias("rule"),
        (F.coalesce(F.get(verdicts, at), F.lit(default)) if rules else F.lit(default)).alias("verdict"),
    )
