"""Audit of quality filters that overlap, by the Hart-Mas-Colell potential of the removal game.

Five filters, each with a failure condition on a document. Of a document only the set of filters it fails matters: one
of 32 masks, so a part of the corpus is a histogram of masks. A coalition S of filters removes v(S) documents, those whose mask meets
S. The potential P of the game is defined by P(empty) = 0 and, recursively,

    P(S) = (v(S) + sum of P(S without i) over the filters i of S) / |S|

and the Shapley value of filter i is P(all) - P(all without i): its mean removals over all orders. To stay in integers
Q(S) = |S|! * P(S) is kept, so Q(S) = (|S| - 1)! * v(S) + sum of Q(S without i), and the removals of i summed
over all 120 orders are Q(all) - 5 * Q(all without i). What a step of an order removes, and what of
it was good or toxic, are differences of two coalitions.

Which documents are copies is decided over the whole table: rows are brought together by the SHA-256 of their text, each
group already reduced to a row for each (part, labels) in the tasks that read it, so a text that a third of all
rows share is no one task's work.

Defined cases: a null text is the empty text; a null part is the empty string; a document without an id is never a
copy and has no labels; rows that repeat id and text are documents of their own, and none is a copy of the
other; labels of an id on several rows count if any of them is 1; a table without rows has no parts and gives none.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
_ALL = (1 << len(FILTERS)) - 1
_WORD = r"[^\x20\x09-\x0D]+"


def failures(text: Column) -> list[Column]:
    """The four conditions on a text alone, in the order of the filters A to D."""
    words = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    # A code point of A to Z is one byte, so bytes tell how many of them there are.
    capitals = F.octet_length(text) - F.octet_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [n < 100, 100 * distinct < 80 * n, 100 * capitals.cast("long") > 10 * F.length(text), text.rlike(r"[#$%&*|]")]


def failure_masks(documents: DataFrame, labels: DataFrame, part: str = "lang", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """part, mask (bit i: fails filter i) and how many documents, good and toxic ones have it."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    docs = documents.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), body.alias("body"))
    bits = sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(failures(F.col("body")))), F.lit(0))
    docs = docs.select("id", "part", F.sha2("body", 256).alias("digest"), bits.alias("mask"))
    marks = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("label_id"))
             .agg(F.max(F.col("quality").eqNullSafe(1).cast("long")).alias("good"), F.max(F.col("toxic").eqNullSafe(1).cast("long")).alias("toxic")))
    rows = docs.join(marks, docs["id"] == marks["label_id"], "left").select(
        "id", "part", "digest", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    # Equal rows first: they already lie together by id, and a group's smallest id is then one row.
    rows = rows.groupBy("id", "part", "digest", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    groups = rows.groupBy("digest", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("no_id"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"))
    least = F.min(F.col("first.id")).over(Window.partitionBy("digest"))
    groups = groups.withColumn("least", least).withColumn(
        "unique", F.col("no_id") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0))
    copy = F.lit(1 << FILTERS.index("E"))
    each = groups.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("unique").alias("n")),
        F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - F.col("unique")).alias("n")))).alias("x"))
    # Groups without one sort of documents still name the part, so a part is never lost.
    return each.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic"))


def coalition_values(histogram: Column, field: str) -> Column:
    """Array of 32: how many documents of the mask histogram each coalition removes."""
    def removed(s: Column) -> Column:
        hit = F.filter(histogram, lambda h: h["mask"].bitwiseAND(s) != 0)
        return F.aggregate(hit, F.lit(0).cast("long"), lambda acc, h: acc + h[field])
    return F.transform(F.sequence(F.lit(0), F.lit(_ALL)), removed)


def potentials(values: Column) -> Column:
    """Array of 32: Q(S) = |S|! * P(S), by recursion from the smaller coalitions to the larger ones."""
    scale = F.array(*[F.lit(factorial(max(bin(s).count("1") - 1, 0))).cast("long") for s in range(_ALL + 1)])

    def step(q: Column, s: Column) -> Column:
        without = [F.when(s.bitwiseAND(1 << i) != 0, F.get(q, s - (1 << i))).otherwise(F.lit(0).cast("long")) for i in range(len(FILTERS))]
        return F.array_append(q, F.get(scale, s) * F.get(values, s) + sum(without[1:], without[0]))

    return F.aggregate(F.sequence(F.lit(1), F.lit(_ALL)), F.array(F.lit(0).cast("long")), step)


def audit_filters(documents: DataFrame, labels: DataFrame, part: str = "lang", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley: 600 rows a part."""
    masks = failure_masks(documents, labels, part, doc_id, text)
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("h"), F.sum("n").alias("total"))
    for name, field in (("v", "n"), ("g", "good"), ("t", "toxic")):
        parts = parts.withColumn(name, coalition_values(F.col("h"), field))
    parts = parts.withColumn("q", potentials(F.col("v")))

    steps = []
    for order in permutations(FILTERS):
        before = 0
        for n, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            steps.append({"filter_order": "".join(order), "step": n, "before": before, "after": before | bit, "bit": bit})
            before |= bit
    # 600 steps whatever the data; each part meets all of them, which is the result asked for.
    listed = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,before:int,after:int,bit:int>>")
    rows = parts.drop("h").withColumn("s", F.explode(listed))

    def gain(values: str) -> Column:
        return F.get(F.col(values), F.col("s.after")) - F.get(F.col(values), F.col("s.before"))

    rest = F.lit(_ALL) - F.col("s.bit")
    return rows.select(
        "part", "s.filter_order", "s.step", (F.col("total") - F.get("v", F.col("s.after"))).alias("kept"), gain("v").alias("removed"),
        (F.get("v", F.col("s.bit")) - gain("v")).alias("redundant"), (F.get("v", F.lit(_ALL)) - F.get("v", rest)).alias("unique_fails"),
        gain("g").alias("good_lost"), gain("t").alias("toxic_lost"), (F.get("q", F.lit(_ALL)) - len(FILTERS) * F.get("q", rest)).alias("shapley"))
