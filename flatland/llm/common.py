"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatland.session import ensure_checkpoint_dir

#: Rows and bytes of an Arrow batch sent to a Python worker, so that long texts fit.
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder and bounded Arrow batches for the Python operators."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_row(frame: DataFrame, keep: list[str] | None = None) -> Column:
    """The columns of a row as one struct ``row``, to pass through a Python operator under no other name."""
    return F.struct(*[F.col(f"`{c}`").alias(c) for c in (frame.columns if keep is None else keep)]).alias("row")


def with_row(frame: DataFrame, more: str) -> T.StructType:
    """Schema of the struct ``row`` of a frame and what is added to it."""
    return T.StructType([frame.schema["row"], *T.StructType.fromDDL(more).fields])


def smallest_by_hash(frame: DataFrame, group: list[str], draw: str, size: int | Column, ties: list[str]) -> DataFrame:
    """The ``size`` rows of each group with the smallest hash ``draw`` (a long), equal ones by ``ties``.

    A histogram of the hashes' upper bits tells the bucket that holds the last of them; what is below is taken as it is, and only that bucket
    is sorted: no group is sorted in one task.
    """
    cells = frame.withColumn("_bucket", F.shiftright(draw, 48))
    upto = F.sum("count").over(Window.partitionBy(*group).orderBy("_bucket"))
    edges = (cells.groupBy(*group, "_bucket").count().withColumn("_upto", upto).withColumn("_size", F.lit(size) if isinstance(size, int) else size)
             .where("_upto >= _size").groupBy(*group).agg(F.min(F.struct("_bucket", (F.col("_size") - (F.col("_upto") - F.col("count"))).alias("left"))).alias("_edge")))
    cells = cells.join(edges, group, "left")
    below = cells.where("_edge IS NULL OR _bucket < _edge._bucket")
    place = F.row_number().over(Window.partitionBy(*group).orderBy(draw, *ties))
    on_edge = cells.where("_bucket = _edge._bucket").withColumn("_place", place).where("_place <= _edge.left").drop("_place")
    return below.unionByName(on_edge).drop("_bucket", "_edge")
