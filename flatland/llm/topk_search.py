"""Exact top-k search by inner product through distributed histogram selection.

Candidates stay where they were read: every task scores its own rows against one block of queries
(a numpy product) and counts the scores in histograms. The histograms are added up over all tasks; the bin that holds
a query's k-th best score becomes the next, narrower range, until the k-th value itself is known. A
last pass keeps what lies above it and, of the scores equal to it, the smallest ids.

A task reports its histogram from the top down to the bin in which its own count reaches k: the
k-th best of all rows is never below the k-th best of one task, so the bins left out cannot matter. So no task
sends more than k bins a query, whatever the number of rows. The query set grows
with the data and is worked off in blocks of ``QUERY_BLOCK`` rows, the only thing the driver holds.

Components become floor(scale * x). Scores are exact integers: products are made in double precision
while all sums stay below 2^53, else with Python integers, held to the range of a long.

Defined cases: vectors that are null, empty or hold null or non-finite components, and rows
with a null id, take no part; vectors of different lengths have no score; equal scores go by the
smaller id; every row is a candidate of all queries with another id (rows that repeat an id
each count); a repeated query id is one query, with its smallest vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Queries scored at a time; bounds the driver's share to this many vectors.
QUERY_BLOCK = 4096
BINS = 2048
#: Scores held at once in a task (queries x candidates).
TILE = 1 << 21
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def _vectors(batch: pa.RecordBatch, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Usable rows of a batch by vector length: ids and floor(scale * x)."""
    ids, vecs = batch.column(0), batch.column(1)
    keep = np.asarray(ids.is_valid()) & np.asarray(vecs.is_valid())
    ids = np.asarray(ids.fill_null(0)).astype(np.int64)
    lens = np.asarray(vecs.value_lengths().fill_null(0)).astype(np.int64)
    flat = vecs.flatten()
    values = np.floor(scale * np.asarray(flat.cast(pa.float64()).fill_null(np.nan)))
    ends = np.cumsum(lens)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    keep &= (bad[ends] == bad[ends - lens]) & (lens > 0)
    out = {}
    for n in np.unique(lens[keep]):
        rows = np.flatnonzero(keep & (lens == n))
        out[int(n)] = ids[rows], values[(ends - lens)[rows, None] + np.arange(n)]
    return out


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    top = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1]
    if top < _EXACT:
        return (q @ c.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    return np.clip(exact(q) @ exact(c).T, -_LONG, _LONG).astype(np.int64)


def _tiles(batches: Iterator[pa.RecordBatch], block: dict, scale: float):
    """(rows of the block, ids, scores) with the query's own id marked by ``own``."""
    for batch in batches:
        for n, (ids, c) in _vectors(batch, scale).items():
            if n not in block:
                continue
            rows, qids, q = block[n]
            step = max(1, TILE // max(1, len(ids)))
            for at in range(0, len(rows), step):
                part = slice(at, at + step)
                yield rows[part], ids, _scores(q[part], c), qids[part][:, None] == ids[None, :]


def _below(lo: np.ndarray, width: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Bin of each score; the differences of longs are taken as unsigned, so they can't overflow."""
    return ((s.view(np.uint64) - lo.view(np.uint64)[:, None]) // width[:, None]).astype(np.int64)


def _prune(counts: np.ndarray, k: int) -> np.ndarray:
    """Bins of each row from the top until k scores are in them."""
    before = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
    return (counts > 0) & (before < k)


def _histograms(batches, block, scale, lo, width, k):
    total: dict[int, np.ndarray] = {}
    for rows, _, s, own in _tiles(batches, block, scale):
        low, wide = lo[rows], width[rows]
        inside = (s >= low[:, None]) & ~own
        bins = np.where(inside, _below(low, wide, np.maximum(s, low[:, None])), 0)
        # All that lies above the range is one bin more; it is counted once, by its number.
        bins = np.minimum(bins, BINS)
        flat = (np.arange(len(rows))[:, None] * (BINS + 1) + bins)[inside]
        counts = np.bincount(flat, minlength=len(rows) * (BINS + 1)).reshape(len(rows), BINS + 1)
        for i, r in enumerate(rows):
            have = total.get(int(r))
            total[int(r)] = counts[i] if have is None else have + counts[i]
    if not total:
        return
    rows = np.array(sorted(total))
    for at in range(0, len(rows), 256):
        part = rows[at:at + 256]
        counts = np.stack([total[int(r)] for r in part])
        i, b = np.nonzero(_prune(counts, k))
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[i], pa.int32()), pa.array(b, pa.int32()), pa.array(counts[i, b], pa.int64())], names=["q", "bin", "n"])


def _winners(batches, block, query_ids, scale, kth, k):
    """Scores above the k-th; of those equal to it, this task's k smallest ids."""
    ties: dict[int, np.ndarray] = {}
    names = ["query_id", "vec_id", "score"]
    for rows, ids, s, own in _tiles(batches, block, scale):
        floor = kth[rows][:, None]
        i, j = np.nonzero((s > floor) & ~own)
        if len(i):
            yield pa.RecordBatch.from_arrays([pa.array(query_ids[rows[i]]), pa.array(ids[j]), pa.array(s[i, j])], names=names)
        i, j = np.nonzero((s == floor) & ~own)
        for r in np.unique(i):
            mine = ids[j[i == r]]
            have = ties.get(int(rows[r]))
            mine = mine if have is None else np.concatenate((have, mine))
            ties[int(rows[r])] = np.sort(mine)[:k]
    for r, ids in ties.items():
        n = len(ids)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, query_ids[r])), pa.array(ids), pa.array(np.full(n, kth[r]))], names=names)


def _blocks(queries: DataFrame, size: int) -> Iterator[list[tuple[int, list[float]]]]:
    """The queries, ``size`` at a time; one partition of them is read at once."""
    block: list[tuple[int, list[float]]] = []
    for row in queries.toLocalIterator():
        block.append((row[0], row[1]))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def top_k(vectors: DataFrame, k: int, is_query, vec_id: str = "vec_id", embedding: str = "embedding",
          scale: float = 1024.0, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of every query's k best rows.

    ``is_query`` is a condition on the columns of ``vectors``.
    """
    spark = vectors.sparkSession
    cols = [F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("embedding")]
    c = F.col("embedding")
    usable = F.col("vec_id").isNotNull() & (F.size(c) > 0) & ~F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    queries = vectors.where(is_query).select(*cols).where(usable).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    source = vectors.select(*cols)
    norm = source.where(usable).select(F.max(F.aggregate(
        c, F.lit(0.0), lambda a, x: a + F.pow(F.floor(F.lit(scale) * x).cast("double"), 2)))).first()[0] or 0.0
    out = None
    for rows in _blocks(queries, query_block):
        found = _search_block(spark, source, rows, k, scale, norm ** 0.5)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return out


def _search_block(spark, source, rows, k, scale, norm) -> DataFrame:
    ids = np.array([r[0] for r in rows], dtype=np.int64)
    block: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    bound = np.zeros(len(rows))
    for n in {len(r[1]) for r in rows}:
        own = np.array([i for i, r in enumerate(rows) if len(r[1]) == n])
        q = np.floor(scale * np.array([rows[i][1] for i in own], dtype=np.float64))
        block[n] = own, ids[own], q
        bound[own] = np.sqrt((q * q).sum(axis=1)) * norm
    # No score lies outside +-(length of the query x greatest length); a little more for rounding.
    hi = np.array([min(int(b * 1.000001) + 2, _LONG) for b in bound], dtype=np.int64)
    lo = -hi
    shared = spark.sparkContext.broadcast(block)
    while True:
        width = np.array([max(1, -(-(int(h) - int(low) + 1) // BINS)) for h, low in zip(hi, lo)], dtype=np.uint64)
        low, wide = lo.copy(), width

        def count(batches, low=low, wide=wide):
            return _histograms(batches, shared.value, scale, low, wide, k)

        counted = source.mapInArrow(count, "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("q").orderBy(F.desc("bin"))
        reached = (counted.withColumn("above", F.sum("n").over(down)).where(F.col("above") >= k)
                   .groupBy("q").agg(F.max("bin").alias("bin")).toPandas())
        # Fewer than k scores in all: every score counts, the range's low end is the bound.
        found = np.full(len(rows), -1, dtype=np.int64)
        found[reached["q"].to_numpy(dtype=np.int64)] = reached["bin"].to_numpy(dtype=np.int64)
        new_lo = np.array([int(x) + int(f) * int(w) if f >= 0 else int(x) for x, f, w in zip(lo, found, width)], dtype=np.int64)
        hi = np.array([min(int(n) + int(w) - 1, int(h)) if f >= 0 else int(n) for n, f, w, h in zip(new_lo, found, width, hi)], dtype=np.int64)
        lo = new_lo
        if (lo == hi).all():
            break
    kth = lo

    def keep(batches):
        return _winners(batches, shared.value, ids, scale, kth, k)

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = (source.mapInArrow(keep, "query_id long, vec_id long, score long")
              .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
