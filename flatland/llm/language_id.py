"""Language identification, words first, then ever shorter character n-grams.

A word seen in training scores its log frequency in every language. An unseen word falls back to its
character n-grams (with marks at both ends): the longest length of which the model knows any gives the word's score, the mean
of their log frequencies. A document's score is the sum over its words; the best language wins.

Training counts words of a bounded sample of labelled documents (``SAMPLE_ROWS`` rows with the smallest hash of the id,
whole texts) as Spark jobs, and keeps the ``MODEL_WORDS`` most frequent words and ``MODEL_GRAMS`` most frequent n-grams
a language; that bounds what is sent to the tasks. Prediction is a scan without a shuffle; a word's
scores are looked up once a task.

Defined cases: null texts and texts without a letter are ``und`` with score 0, and so is all text if there is no
labelled row; where no part of a text is known to the model, the most frequent language wins with its
share; equal scores go to the language first in the alphabet; rows whose lang is null teach nothing; repeated
rows count as often as they are there.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flatland.llm.common import fold_of

SAMPLE_ROWS = 20_000
MODEL_WORDS = 30_000
MODEL_GRAMS = 30_000
LONGEST_GRAM = 5
#: Words whose scores a task keeps; the store starts anew beyond.
CACHE_WORDS = 400_000
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    prior: list[float]
    words: dict[str, int]               # row of the scores
    word_scores: np.ndarray             # log frequency of each word (row) in each language
    grams: dict[str, int]
    gram_scores: np.ndarray


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    return _WORD.findall(text.lower())


def grams_of(word: str, size: int) -> list[str]:
    marked = f" {word} "
    return [marked[i:i + size] for i in range(len(marked) - size + 1)]


def _counted(frame: DataFrame, split) -> DataFrame:
    """(lang, item, n) of a frame (lang, item, n) after ``split`` has cut each item in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def out():
            for lang, c in counts.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()),
                                                  pa.array(list(c.values()), pa.int64())], names=["lang", "item", "n"])
            counts.clear()

        for batch in batches:
            for lang, item, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                own = counts.setdefault(lang, Counter())
                for part in split(item.as_py()):
                    own[part] += n
            if sum(map(len, counts.values())) > 300_000:
                yield from out()
        yield from out()

    return frame.mapInArrow(run, "lang string, item string, n long").groupBy("lang", "item").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, size: int, group: list[str]) -> DataFrame:
    """The ``size`` most frequent items of each group; of those with the last count the ones with the smallest hashes.

    The last count comes from a histogram of the counts, so the items of a language are never sorted in one task.
    """
    upto = F.sum("items").over(Window.partitionBy(*group).orderBy(F.desc("n")))
    last = (counts.groupBy(*group, "n").agg(F.count("*").alias("items")).withColumn("upto", upto).where(F.col("upto") >= size)
            .groupBy(*group).agg(F.max(F.struct("n", (F.lit(size) - (F.col("upto") - F.col("items"))).alias("left"))).alias("last")))
    marked = _with_edge(counts, last, group, "last")
    above = marked.where("last IS NULL OR n > last.n").select("lang", "item", "n")
    tied = marked.where("n = last.n").withColumn("draw", F.xxhash64("item"))
    # The same once more with the hashes of the tied items: a histogram of their upper bits, and places in its last bucket only.
    tied = tied.withColumn("bucket", F.shiftright("draw", 48))
    upto = F.sum("count").over(Window.partitionBy(*group).orderBy("bucket"))
    edge = (tied.groupBy(*group, "last", "bucket").count().withColumn("upto", upto).where("upto >= last.left")
            .groupBy(*group).agg(F.min(F.struct("bucket", (F.col("last.left") - (F.col("upto") - F.col("count"))).alias("left"))).alias("edge")))
    tied = _with_edge(tied, edge, group, "edge")
    place = F.row_number().over(Window.partitionBy(*group).orderBy("draw", "item"))
    on_edge = tied.where("bucket = edge.bucket").withColumn("place", place).where("place <= edge.left")
    return above.unionByName(tied.where("bucket < edge.bucket").select("lang", "item", "n")).unionByName(on_edge.select("lang", "item", "n"))


def _with_edge(frame: DataFrame, edges: DataFrame, group: list[str], name: str) -> DataFrame:
    """The frame with its group's edge (null: none), looked up in a map; there is one edge a group, of which there are as many as languages of the model
    (or that times the lengths of n-grams), and no join pairs rows by their counts."""
    kind = edges.schema[name].dataType.simpleString()
    key = F.to_json(F.struct(*group))
    found = edges.select(key.alias("key"), name).collect()
    if not found:
        return frame.withColumn(name, F.lit(None).cast(kind))
    pairs = [x for r in found for x in (F.lit(r["key"]), F.struct(*[F.lit(v).alias(k) for k, v in r[name].asDict().items()]).cast(kind))]
    return frame.withColumn(name, F.try_element_at(F.create_map(*pairs), key))


def _log_frequencies(rows: pa.Table, languages: list[str], group=lambda item: 0) -> tuple[dict[str, int], np.ndarray]:
    """Items by row, and their smoothed log frequencies in each language within their group (length of n-gram)."""
    at = {lang: i for i, lang in enumerate(languages)}
    items: dict[str, int] = {}
    row = np.array([items.setdefault(x, len(items)) for x in rows.column("item").to_pylist()], dtype=np.int64)
    lang = np.array([at[x] for x in rows.column("lang").to_pylist()], dtype=np.int64)
    counts = np.zeros((len(items), len(languages)))
    np.add.at(counts, (row, lang), rows.column("n").to_numpy())
    of = np.array([group(x) for x in items], dtype=np.int64)
    size = np.bincount(of)
    total = np.zeros((len(size), len(languages)))
    np.add.at(total, of, counts)
    return items, np.log((counts + 0.5) / (total[of] + 0.5 * size[of][:, None])).astype(np.float32)


def train_languages(documents: DataFrame, learn: Column | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from rows with text and lang; ``learn`` is a condition on doc_id (default: the folds but 0)."""
    learn = fold_of(F.col("doc_id")) != 0 if learn is None else learn
    rows = (documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
            .where(F.col("text").isNotNull() & F.col("lang").isNotNull()).where(learn)
            .withColumn("draw", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    shares = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not shares:
        return LanguageModel([], [], {}, np.zeros((0, 0)), {}, np.zeros((0, 0)))
    languages = sorted(shares)
    total = sum(shares.values())
    # The SAMPLE_ROWS-th smallest hash bounds the sample; a hash that many rows share is taken or left whole.
    last = None
    if total > SAMPLE_ROWS:
        last = rows.select("draw").orderBy("draw").limit(SAMPLE_ROWS).agg(F.max("draw")).first()[0]
    sample = rows if last is None else rows.where(F.col("draw") <= last)
    counts = _counted(sample.select("lang", F.col("text").alias("item"), F.lit(1).cast("long").alias("n")), words_of).checkpoint()
    words = _most_frequent(counts, MODEL_WORDS, ["lang"]).toArrow()
    grams = _counted(counts.withColumn("n", F.lit(1).cast("long") + F.floor(F.log2("n")).cast("long")),
                     lambda w: [g for size in range(1, LONGEST_GRAM + 1) for g in grams_of(w, size)])
    grams = _most_frequent(grams.withColumn("size", F.length("item")).checkpoint(), MODEL_GRAMS, ["lang", "size"]).toArrow()
    return LanguageModel(languages, [shares[x] / total for x in languages],
                         *_log_frequencies(words, languages), *_log_frequencies(grams, languages, len))


class Predictor:
    """Scores of texts; keeps the scores of the words it has met."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self._place: dict[str, int] = {}
        self._scores = np.zeros((1 << 12, max(1, len(model.languages))))

    def _word(self, word: str) -> np.ndarray | None:
        own = self.model.words.get(word)
        if own is not None:
            return self.model.word_scores[own]
        get = self.model.grams.get
        for size in range(min(LONGEST_GRAM, len(word) + 2), 0, -1):
            known = [g for g in map(get, grams_of(word, size)) if g is not None]
            if known:
                return self.model.gram_scores[known].mean(axis=0)
        return None

    def _places(self, words: list[str]) -> list[int]:
        try:
            return [self._place[w] for w in words]
        except KeyError:
            pass
        new = dict.fromkeys(w for w in words if w not in self._place)
        if len(self._place) + len(new) > CACHE_WORDS and self._place:
            self._place.clear()
            new = dict.fromkeys(words)
        if len(self._place) + len(new) > len(self._scores):
            more = np.zeros((2 * (len(self._place) + len(new)), self._scores.shape[1]))
            more[:len(self._scores)] = self._scores
            self._scores = more
        for w in new:
            at = self._place[w] = len(self._place)
            own = self._word(w)
            self._scores[at] = own if own is not None else 0.0
        return [self._place[w] for w in words]

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text else []
        # Signs like superscript digits are word signs, too, but no letters.
        if not self.model.languages or not any(c.isalpha() for w in words for c in w):
            return UNKNOWN, 0.0
        sums = self._scores_of(words)
        if not sums.any():
            best = int(np.argmax(self.model.prior))
            return self.model.languages[best], float(self.model.prior[best])
        best = int(np.argmax(sums))
        # Neighbouring words are not independent; the square root of their number tempers the odds.
        odds = (sums - sums[best]) / math.sqrt(len(words))
        return self.model.languages[best], float(1 / np.exp(odds).sum())

    def _scores_of(self, words: list[str]) -> np.ndarray:
        total = np.zeros(self._scores.shape[1])
        for at in range(0, len(words), CACHE_WORDS // 2):
            places = self._places(words[at:at + CACHE_WORDS // 2])
            total += self._scores[places].sum(axis=0)
        return total


def predict_languages(documents: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    frame = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), (fold_of(F.col(f"`{doc_id}`")) == 0).alias("held_out"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = Predictor(shared.value)
        for batch in batches:
            found = [predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.string()),
                                              pa.array([s for _, s in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return frame.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
