"""A training corpus from raw documents, in five stages of the training-data operators.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns of
``documents``; what a stage returns is written as Parquet and read again by the next.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatland.llm import decontaminate, line_dedup, ngram_join, packing, quality_zstd
from flatland.llm.common import prepare, table
from flatland.session import new_run_dir

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the compression classifier scores below 0.3.

    Null and empty texts have the curve's score of no difference, like any other; repeated rows have one score and stay or
    go together; a null id teaches nothing; without documents none are left.
    """
    prepare(spark)
    model = quality_zstd.train_quality(docs, table(spark, sf_dir, "labels"))
    return quality_zstd.keep_good(docs, model, threshold=0.3)


def line_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove later copies of three-line windows; a document of which no line is left goes.

    Null and empty texts, and those of one or two lines, hold no window and stay; rows that repeat an id with one text count as one document, so
    neither is a later copy of the other (the next stage keeps one of them); n_chars is that of what is left; without documents none are left.
    """
    prepare(spark)
    cut = line_dedup.dedup_lines(docs)
    left = cut.where((F.col("n_removed") == 0) | (F.col("text").rlike("[^ \\t\\r\\n\\x0b\\x0c]")))
    return left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group linked by five-word shingles at 0.8.

    Of rows that repeat an id and text one stays. Rows without an id take part under a hash of their text, above all
    ids that tables give, and stay without one; of copies without ids one stays. Null and empty texts link with nothing, but of
    rows that repeat them with one id one stays; without documents none are left.
    """
    prepare(spark)
    node = F.coalesce(F.col("doc_id"), F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit("")), F.lit("no id")), 2) + F.lit(1 << 62))
    rows = docs.withColumn("_node", node)
    # Ids that come up twice: usually none, and found without their texts.
    twice = rows.groupBy("_node").count().where("count > 1").select("_node").checkpoint()
    if not twice.isEmpty():
        again = rows.join(twice, "_node", "left_semi").dropDuplicates(["_node", "text"])
        rows = rows.join(twice, "_node", "left_anti").unionByName(again).select(*rows.columns).checkpoint()
    linked = ngram_join.link_documents(rows.select(F.col("_node").alias("doc_id"), "text"), size=5, percent=80)
    others = linked.where("component_id <> doc_id").select(F.col("doc_id").alias("other")).distinct()
    return rows.join(others, rows["_node"] == others["other"], "left_anti").select(*docs.columns)


def no_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item, exactly or nearly.

    Null and empty texts hold none and stay; repeated rows stay or go together; ids do not matter; without documents none are left.
    """
    prepare(spark)
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2048 tokens.

    A null text is the empty text, which is its end sign alone; repeated rows and rows without an id are packed as often as they are there;
    without documents there are no pieces.
    """
    prepare(spark)
    return packing.pack_documents(docs, VOCABULARY, capacity=2048, end_id=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("good_quality", good_quality), ("line_windows", line_windows), ("near_duplicates", near_duplicates),
    ("no_benchmarks", no_benchmarks), ("packed", packed),
]

#: SQL has no compression, tokenizer or components; tests compare each stage with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_run_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
