"""Quality classifier by compression with dictionaries of good and bad text.

Two zstandard dictionaries are trained from labelled text, one of each class. A text is cut into pieces that
cover it whole; every piece is compressed with either dictionary. Text that the good
dictionary shortens more is like good text: the difference of the two sizes, divided by the bytes
of the text, becomes a probability through rising steps (isotonic regression) fitted on labelled rows that the dictionaries have
not seen, with a small share of a logistic curve so that no two differences tie. Steps follow texts that say little of either
class, such as one word repeated, where a curve alone is pulled about by far-off rows.

Learning uses a bounded sample: ``SAMPLE_PIECES`` pieces a class for the dictionaries and
``CALIBRATION_ROWS`` whole texts for the curve, those with the smallest hashes of id and place, so the sample does not depend
on how rows are stored. Lines that several pieces have (notices, licences) tell of no class and are left out of the dictionaries. Only the dictionaries (``DICTIONARY_BYTES`` each) and two numbers go to the tasks. Scoring is a
scan without a shuffle.

Defined cases: null and empty texts have difference 0 and so the curve's value there; repeated rows get
equal scores; null labels and labels without a document teach nothing, a document whose labels disagree teaches
both; without labels of both classes every score is the share of label 1 (0.5 if there is no label); a null id counts
as the empty text in the fold.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatland.llm.common import fold_of, smallest_by_hash, whole_row, with_row

PIECE_BYTES = 2048
DICTIONARY_BYTES = 256 << 10
LEVEL = 3
SAMPLE_CHARS = 4096
SAMPLE_PIECES = 2500
CALIBRATION_ROWS = 4000
#: Pulls the curve's slope towards 0 where calibration rows are few.
RIDGE = 1e-6
#: Groups of calibration rows of equal number, and at least so many rows in each.
GROUPS, GROUP_ROWS = 40, 4
#: Rows' worth of the logistic curve that count in each group, so a small sample still tells the classes apart.
CURVE_ROWS = 3
#: Share of the logistic curve in the score: it keeps apart texts that fall into one step.
CURVE_SHARE = 0.02


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries (None: no model), the curve 1 / (1 + exp(-(slope * x + offset))) and rising steps through (at, share)."""

    good: bytes | None
    bad: bytes | None
    slope: float = 0.0
    offset: float = 0.0
    at: tuple[float, ...] = ()
    share: tuple[float, ...] = ()


def train_dictionary(pieces: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; where there is too little text for one, the text itself."""
    total = sum(map(len, pieces))
    size = min(size, max(1024, total // 8))
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(pieces)[:size].ljust(8, b" ")


def distinct_lines(pieces: dict[int, list[str]]) -> dict[int, list[bytes]]:
    """The pieces of either class with those lines only that are in one piece of all.

    A class that has no such line keeps each of its lines that the other has not, once.
    """
    lines = {q: Counter(line for piece in pieces[q] for line in set(piece.split("\n"))) for q in (0, 1)}
    out: dict[int, list[bytes]] = {}
    for q in (0, 1):
        for most in (1, len(pieces[q])):
            seen = set(lines[1 - q])
            out[q] = []
            for piece in pieces[q]:
                own = [line for line in piece.split("\n") if line not in seen and lines[q][line] <= most]
                seen.update(own if most > 1 else ())
                if any(own):
                    out[q].append("\n".join(own).encode("utf-8", "surrogatepass"))
            if out[q]:
                break
    return out


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The dictionaries of the sample's pieces (quality, draw, text); none unless both classes are there."""
    pieces: dict[int, list[str]] = {0: [], 1: []}
    for batch in batches:
        for quality, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            pieces[quality].append(text)
    distinct = distinct_lines(pieces)
    if all(distinct.values()):
        yield pa.RecordBatch.from_arrays([pa.array([train_dictionary(distinct[q])], pa.binary()) for q in (1, 0)], names=["good", "bad"])


class Difference:
    """(size with the bad dictionary - size with the good one) / bytes, over all pieces of a text."""

    def __init__(self, model: QualityModel):
        self._pair = [self._compressor(d) for d in (model.good, model.bad)] if model.good is not None else None

    @staticmethod
    def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
        trained = dictionary[:4] == b"\x37\xa4\x30\xec"
        d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)

    def __call__(self, text: str | None) -> float:
        if self._pair is None or not text:
            return 0.0
        raw = text.encode("utf-8", "surrogatepass")
        good, bad = self._pair
        apart = 0
        for at in range(0, len(raw), PIECE_BYTES):
            piece = raw[at:at + PIECE_BYTES]
            apart += len(bad.compress(piece)) - len(good.compress(piece))
        return apart / len(raw)


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve (Newton's method, Platt's smoothed targets)."""
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    if not n1 or not n0:
        return 0.0, math.log((n1 + 1) / (n0 + 1))
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    unit = max(float(np.abs(x).mean()), 1e-9)
    z = np.column_stack((x / unit, np.ones(len(x))))
    w = np.array([0.0, math.log((n1 + 1) / (n0 + 1))])

    def loss(v):
        s = z @ v
        return float((np.logaddexp(0, s) - target * s).sum() + 0.5 * RIDGE * len(x) * v[0] ** 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        slope = z.T @ (p - target) + np.array([RIDGE * len(x) * w[0], 0.0])
        bend = (z * (p * (1 - p))[:, None]).T @ z + np.diag([RIDGE * len(x) + 1e-9, 1e-9])
        step = np.linalg.solve(bend, slope)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(w[0] / unit), float(w[1])


def fit_steps(x: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: np.ndarray) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Rising shares of label 1 along x (isotonic regression over groups of rows), at the groups' means; ``prior``: the curve's share."""
    order = np.argsort(x, kind="stable")
    groups = np.array_split(order, max(1, min(GROUPS, len(x) // GROUP_ROWS)))
    steps: list[list[float]] = []                   # weight, share, sum of x by weight
    for g in groups:
        w = float(weight[g].sum())
        steps.append([w, float((weight[g] * y[g]).sum() + CURVE_ROWS * prior[g].mean()) / (w + CURVE_ROWS), float((weight[g] * x[g]).sum())])
        while len(steps) > 1 and steps[-2][1] >= steps[-1][1]:
            w, share, moment = steps.pop()
            last = steps[-1]
            last[1] = (last[0] * last[1] + w * share) / (last[0] + w)
            last[0] += w
            last[2] += moment
    return tuple(m / w for w, _, m in steps), tuple(s for _, s, _ in steps)


def scores(x: np.ndarray, model: QualityModel) -> np.ndarray:
    """Calibrated scores of differences."""
    logistic = 1 / (1 + np.exp(-np.clip(model.slope * x + model.offset, -700, 700)))
    if not model.at:
        return logistic
    return (1 - CURVE_SHARE) * np.interp(x, model.at, model.share) + CURVE_SHARE * logistic


def curve(x: float, model: QualityModel) -> float:
    return float(scores(np.array([x]), model)[0])


def train_quality(documents: DataFrame, labels: DataFrame, learn: Column | None = None, doc_id: str = "doc_id", text: str = "text",
                  quality: str = "quality") -> QualityModel:
    """Learn from labelled documents; ``learn`` is a condition on doc_id (default: the folds but 0)."""
    learn = fold_of(F.col("doc_id")) != 0 if learn is None else learn
    marks = (labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{quality}`").cast("int").alias("quality"))
             .where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).where(learn).distinct())
    # A fifth of the labelled documents are for the curve, the others for the dictionaries.
    turn = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("turn")), F.lit(5))
    draw = F.xxhash64(F.col("doc_id").cast("string"), F.lit("draw"))
    size = F.when(F.col("curve"), CALIBRATION_ROWS // 2).otherwise(SAMPLE_PIECES)
    chosen = smallest_by_hash(marks.withColumns({"curve": turn == 0, "draw": draw}), ["quality", "curve"], "draw", size, ["doc_id"]).drop("draw")
    texts = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).where(F.col("text").isNotNull())
    # At most 2 * (SAMPLE_PIECES + CALIBRATION_ROWS / 2) ids: small enough to send to every task.
    sample = texts.join(F.broadcast(chosen), "doc_id")
    share = {r["quality"]: r["n"] for r in marks.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    n1, n0 = share.get(1, 0), share.get(0, 0)
    neutral = QualityModel(None, None, 0.0, math.log(n1 / n0) if n1 and n0 else 50.0 if n1 else -50.0 if n0 else 0.0)
    if not n1 or not n0:
        return neutral
    text_col = F.col("text")
    n_pieces = F.greatest(F.lit(1), F.ceil(F.length(text_col) / SAMPLE_CHARS)).cast("int")
    pieces = (sample.where(~F.col("curve"))
              .select("doc_id", "quality", "text", F.explode(F.sequence(F.lit(0), n_pieces - 1)).alias("piece"))
              .select("doc_id", "quality", "piece", F.substring(text_col, F.col("piece") * SAMPLE_CHARS + 1, F.lit(SAMPLE_CHARS)).alias("text"),
                      F.xxhash64(F.col("doc_id").cast("string"), "piece").alias("draw")))
    pieces = smallest_by_hash(pieces.where(F.length("text") > 0), ["quality"], "draw", SAMPLE_PIECES, ["doc_id", "piece", "text"])
    # At most 2 * SAMPLE_PIECES pieces meet in the one task that trains; the dictionaries come back.
    trained = (pieces.repartition(1).sortWithinPartitions("quality", "draw", "doc_id", "piece", "text")
               .select("quality", "draw", "text").mapInArrow(_train, "good binary, bad binary").first())
    if trained is None:
        return neutral
    model = QualityModel(bytes(trained["good"]), bytes(trained["bad"]))
    fit = measure(sample.where(F.col("curve")), model, keep=["quality"]).select("row.quality", "difference").toPandas()
    if fit["quality"].nunique() < 2:            # too few rows to set some aside: those of the dictionaries then, by their hashes
        every = sample.withColumn("draw", draw).orderBy("draw", "doc_id", "quality", "text").limit(CALIBRATION_ROWS)
        fit = measure(every, model, keep=["quality"]).select("row.quality", "difference").toPandas()
    fit = fit.sort_values(["quality", "difference"])
    slope, offset = fit_curve(fit["difference"].to_numpy(dtype=float), fit["quality"].to_numpy(dtype=float))
    # The curve saw as many rows of either class as there were, up to its bound; set the prior right beyond it.
    f1, f0 = int((fit["quality"] == 1).sum()), int((fit["quality"] == 0).sum())
    if not f1 or not f0:
        return QualityModel(model.good, model.bad, slope, offset)
    offset += math.log(n1 / n0) - math.log(f1 / f0)
    x, y = fit["difference"].to_numpy(dtype=float), fit["quality"].to_numpy(dtype=float)
    weight = np.where(y == 1, n1 / f1, n0 / f0)
    logistic = QualityModel(model.good, model.bad, slope, offset)
    at, share = fit_steps(x, y, weight * len(x) / weight.sum(), scores(x, logistic))
    return replace(logistic, at=at, share=share)


def measure(documents: DataFrame, model: QualityModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of every row in ``row``, with its difference and score."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    frame = documents.select(whole_row(documents, keep), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        difference = Difference(model)
        for batch in batches:
            x = np.array([difference(t.as_py()) for t in batch.column(1)], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x), pa.array(scores(x, model))],
                                             names=["row", "difference", "score"])

    return frame.mapInArrow(run, with_row(frame, "difference double, score double"))


def score_quality(documents: DataFrame, model: QualityModel, threshold: float = 0.3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted and difference of every row."""
    slim = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return measure(slim, model, keep=["doc_id"]).select("row.*", "difference", "score").select(
        "doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "difference")


def keep_good(documents: DataFrame, model: QualityModel, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``documents`` that score ``threshold`` or more, as they are."""
    return measure(documents, model, text).where(F.col("score") >= threshold).select("row.*")
