"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A document is contaminated by a benchmark item if some run of its words is within the word edit distance ``k = floor(edits * m)`` of
the item's m words (ASCII punctuation and case do not count).

1. Item-sized windows. With at most k edits an item keeps a run of ``ceil((m - k) / (k + 1))`` words, so every contaminated place shows one of the
   item's word n-grams of that length (at most ``LONGEST_GRAM``). Windows of m words are laid where that happens, so that the n-gram lies in the
   window as in the item; no contaminated place is without a window.
2. CGK random walk: position j of the embedding copies the word the walk stands on, and a random bit of (j, word) says whether it moves on;
   so edits become few differing positions. All windows of a batch walk together.
3. Bit-sampling LSH: the signature of an embedding is a few sampled positions; a window is a candidate if it
   agrees with the item in any of the repeated samples. The number of repeats is set so that items edited at random up to the limit
   (and shifted by as much) are found with the target recall.
4. Candidates are verified by the exact edit distance between the item and the best run within the window and k words around it.
5. Items too short for that (fewer than ``least_words`` words; a text in a script without spaces is a few words at any length) are looked up as they
   are, by one automaton over the texts: lower case, ASCII punctuation as spaces, and only between word boundaries, unless the script has none.

Documents are scanned where they are; the items (grams, embeddings) go to every task, at most ``BLOCK_ITEMS`` items and ``BLOCK_WORDS`` words at a
time, and a larger benchmark is worked off in blocks. The scan is repeatable, so lost executors cost only their tasks.

Defined cases: null and empty texts are clean; items with fewer than ``LEAST_EXACT`` words (letters of a script without spaces: ``LEAST_LETTERS``)
identify nothing and are passed over; a null item id is an item like others; of the places where a document has an item the one with the least distance counts, then the first; repeated rows give
repeated results, repeated items with one id count once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatland.llm.common import whole_row
from flatland.llm.words import PUNCTUATION, iter_words, mix, runs_of

EDITS = 0.2
RECALL = 0.99
LEAST_WORDS = 6
LEAST_EXACT, LEAST_LETTERS = 3, 6
LONGEST_GRAM = 4
BLOCK_ITEMS = 20_000
BLOCK_WORDS = 2_000_000
#: Sampled positions of a signature; walks; the greatest number of samples of each walk.
SAMPLED = 4
WALKS = 4
MOST_SAMPLES = 64
#: The embedding has this many positions for each word of the item.
STRETCH = 3
_FILTER_BITS = 22
_SPACES = re.compile(r"[^0-9a-z\x80-\U0010ffff]+")
#: Letters of scripts that put no spaces between words: Thai, Lao, Myanmar, Khmer, kana, Bopomofo, Han (Unicode blocks, fixed values).
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3105-\u312f\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_PAD = np.uint64(0x0123456789ABCDEF)


def kept_run(m: int, k: int) -> int:
    """Longest run of words that k edits of m words must leave."""
    return max(1, -(-(m - k) // (k + 1)))


def walk(words: np.ndarray, length: int, seed: int) -> np.ndarray:
    """CGK embeddings (rows) of windows (rows of words) by the random bits of ``seed``."""
    n, m = words.shape
    at = np.zeros(n, dtype=np.int64)
    rows = np.arange(n)
    padded = np.concatenate((words, np.full((n, 1), _PAD, dtype=np.uint64)), axis=1)
    turn = mix(np.arange(length, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)
    out = np.empty((n, length), dtype=np.uint64)
    for j in range(length):
        now = padded[rows, at]
        out[:, j] = now
        at += ((now * turn[j]) >> np.uint64(63)).astype(np.int64)
        np.minimum(at, m, out=at)
    return out


def edit_distance(item: np.ndarray, run: np.ndarray) -> tuple[int, int]:
    """Least word edit distance between the item and any part of the run, and where that part begins."""
    n = len(run)
    steps = np.arange(n + 1)
    cost = np.zeros(n + 1, dtype=np.int64)
    begin = steps.copy()
    for word in item:
        # Each cell: the item's word against a word of the run, or left out; then words of the run added.
        swap = cost[:-1] + (run != word)
        skip = cost[1:] + 1
        new = np.concatenate(([cost[0] + 1], np.minimum(swap, skip)))
        own = np.concatenate(([begin[0]], np.where(swap <= skip, begin[:-1], begin[1:])))
        # Adding run words costs 1 each: a running minimum of cost - place.
        slack = new - steps
        low = np.minimum.accumulate(slack)
        # The place from which the minimum comes is the last at which a new one is met.
        came = np.maximum.accumulate(np.where(slack == low, steps, 0))
        cost, begin = low + steps, own[came]
    end = int(np.argmin(cost))
    return int(cost[end]), int(begin[end])


@dataclass
class Items:
    """Items of a block in the form the scan needs."""

    ids: list
    words: list[np.ndarray]
    edits: list[int]
    grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]     # length: sorted gram, item, place
    filters: dict[int, np.ndarray]
    samples: dict[int, list[np.ndarray]]                            # words of item: positions for each walk
    signatures: list[list[np.ndarray]]                              # item: signatures for each walk
    short: list[tuple[object, str]]                                 # ids and plain texts of items that are looked up as they are


def _signature(embedded: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """(windows x samples) hashes of the sampled positions."""
    out = np.zeros((len(embedded), len(positions)), dtype=np.uint64)
    for k in range(positions.shape[1]):
        out = mix(out + embedded[:, positions[:, k]] * np.uint64(0x9E3779B97F4A7C15))
    return out


def _differing(words: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Shares of positions in which the embeddings of an item and of edited copies of it differ."""
    m, copies = len(words), []
    for _ in range(6):
        copy = words.tolist()
        for _ in range(k):
            at = int(rng.integers(len(copy))) if copy else 0
            kind = int(rng.integers(3))
            if kind and copy:
                del copy[at]
            if kind < 2:
                copy.insert(at, int(rng.integers(1 << 63)))
        copy = (copy + rng.integers(1 << 63, size=m).tolist())[:m]
        copies.append(copy)
    length = STRETCH * m
    own = walk(words[None, :], length, 0)
    return (walk(np.array(copies, dtype=np.uint64), length, 0) != own).mean(axis=1)


def prepare_items(rows: list[tuple[object, str | None]], edits: float = EDITS, recall: float = RECALL, least_words: int = LEAST_WORDS) -> Items:
    rows = [(i, t) for i, t in rows if t]
    ids, words, short = [], [], []
    if rows:
        column = pc.utf8_lower(pa.array([t for _, t in rows], pa.large_string()))
        for first, _, block in iter_words(column, PUNCTUATION):
            for i, (lo, hi) in enumerate(zip(block.bounds, block.bounds[1:])):
                if hi - lo >= least_words:
                    ids.append(rows[first + i][0])
                    words.append(block.hashes[lo:hi].copy())
                else:
                    plain = plain_text(column[first + i].as_py())
                    letters = len(_UNSPACED.findall(plain))
                    if hi - lo >= LEAST_EXACT or letters >= LEAST_LETTERS:
                        short.append((rows[first + i][0], plain))
    limits = [int(edits * len(w)) for w in words]
    rng = np.random.default_rng(7)
    by_length: dict[int, list[int]] = {}
    for n, w in enumerate(words):
        by_length.setdefault(len(w), []).append(n)
    samples: dict[int, list[np.ndarray]] = {}
    for m, own in by_length.items():
        apart = np.concatenate([_differing(words[n], limits[n], rng) for n in own[:20]])
        # Repeats so that the mean chance of an agreement in one of them is the target.
        agree = (1 - apart) ** SAMPLED
        repeats = WALKS
        while repeats < WALKS * MOST_SAMPLES and (1 - (1 - agree) ** repeats).mean() < recall:
            repeats += WALKS
        samples[m] = [rng.integers(STRETCH * m, size=(repeats // WALKS, SAMPLED)) for _ in range(WALKS)]
    signatures = [[_signature(walk(w[None, :], STRETCH * len(w), s), samples[len(w)][s])[0] for s in range(WALKS)] for w in words]
    by_gram: dict[int, list[tuple[np.ndarray, int]]] = {}
    for n, (w, k) in enumerate(zip(words, limits)):
        size = min(LONGEST_GRAM, kept_run(len(w), k))
        by_gram.setdefault(size, []).append((runs_of(w, size), n))
    grams, filters = {}, {}
    for size, own in by_gram.items():
        value = np.concatenate([g for g, _ in own])
        item = np.concatenate([np.full(len(g), n) for g, n in own])
        place = np.concatenate([np.arange(len(g)) for g, _ in own])
        order = np.argsort(value, kind="stable")
        grams[size] = value[order], item[order], place[order]
        filters[size] = np.zeros(1 << _FILTER_BITS, dtype=bool)
        filters[size][(value >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
    return Items(ids, words, limits, grams, filters, samples, signatures, short)


def plain_text(lower: str) -> str:
    """A text in lower case with one space for whatever ASCII signs lie between its words."""
    return _SPACES.sub(" ", lower).strip()


def _ends_itself(sign: str) -> bool:
    """Whether a word boundary is there whatever the next sign is."""
    return not sign.isalnum() or _UNSPACED.match(sign) is not None


class ShortItems:
    """The places at which texts hold short items word for word."""

    def __init__(self, short: list[tuple[object, str]]):
        import ahocorasick

        self._short = short
        self._find = ahocorasick.Automaton() if short else None
        by_text: dict[str, list[int]] = {}
        for n, (_, plain) in enumerate(short):
            by_text.setdefault(plain, []).append(n)
        for plain, numbers in by_text.items():
            self._find.add_word(plain, (plain, numbers))
        if short:
            self._find.make_automaton()

    def __call__(self, lower: str | None) -> dict[int, int]:
        """Number of each item found, and the word at which it first begins."""
        out: dict[int, int] = {}
        if not self._find or not lower:
            return out
        text = plain_text(lower)
        for end, (plain, numbers) in self._find.iter(text):
            start = end + 1 - len(plain)
            if (start == 0 or text[start - 1] == " " or _ends_itself(plain[0])) and (end + 1 == len(text) or text[end + 1] == " " or _ends_itself(plain[-1])):
                for n in numbers:
                    out.setdefault(n, text.count(" ", 0, start))
        return out


def _windows(items: Items, words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(item, text, first word of window) wherever a text shows one of the item's n-grams."""
    texts, numbers, starts = [], [], []
    for size, (values, item, place) in items.grams.items():
        runs = runs_of(words, size)
        at = np.flatnonzero(items.filters[size][(runs >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        lo, hi = np.searchsorted(values, runs[at], "left"), np.searchsorted(values, runs[at], "right")
        at, lo, hi = at[hi > lo], lo[hi > lo], hi[hi > lo]
        text = np.searchsorted(bounds, at, side="right") - 1
        inside = at + size <= bounds[text + 1]
        at, lo, hi, text = at[inside], lo[inside], hi[inside], text[inside]
        each = hi - lo
        which = np.repeat(lo, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        texts.append(np.repeat(text, each))
        numbers.append(item[which])
        starts.append(np.repeat(at - bounds[text], each) - place[which])
    if not texts:
        return
    all_rows = np.unique(np.column_stack((np.concatenate(numbers), np.concatenate(texts), np.concatenate(starts))), axis=0)
    for n in np.unique(all_rows[:, 0]):
        own = all_rows[all_rows[:, 0] == n]
        yield int(n), own[:, 1], own[:, 2]


def find_items(items: Items, words: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
    """(text, item): (distance, first word) of every contaminated text."""
    found: dict[tuple[int, int], tuple[int, int]] = {}
    for n, texts, starts in _windows(items, words, bounds):
        item, k = items.words[n], items.edits[n]
        m = len(item)
        # A window that begins before or ends after its text is moved in; a shorter text is filled up.
        sizes = bounds[texts + 1] - bounds[texts]
        starts = np.clip(starts, 0, np.maximum(0, sizes - m))
        keep = sizes >= m - k
        texts, starts = texts[keep], starts[keep]
        pairs = np.unique(np.column_stack((texts, starts)), axis=0)
        for at in range(0, len(pairs), 4096):
            own = pairs[at:at + 4096]
            place = bounds[own[:, 0], None] + own[:, 1, None] + np.arange(m)
            window = np.where(place < bounds[own[:, 0] + 1, None], words[np.minimum(place, len(words) - 1)], _PAD)
            near = np.zeros(len(own), dtype=bool)
            for s in range(WALKS):
                signs = _signature(walk(window, STRETCH * m, s), items.samples[m][s])
                near |= (signs == items.signatures[n][s]).any(axis=1)
            for text, start in own[near].tolist():
                lo = max(0, start - k)
                run = words[bounds[text] + lo:min(bounds[text + 1], bounds[text] + start + m + k)]
                distance, begin = edit_distance(item, run)
                if distance <= k:
                    best = (distance, lo + begin)
                    if found.get((text, n), best) >= best:
                        found[text, n] = best
    return found


def find_contamination(documents: DataFrame, benchmark: DataFrame, edits: float = EDITS, recall: float = RECALL, least_words: int = LEAST_WORDS,
                       doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, word (place of the passage), distance and similarity of each contaminated document and item."""
    docs = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    asked = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text")).distinct()
    out = None
    for block in _blocks(asked):
        found = _scan(docs, prepare_items(block, edits, recall, least_words))
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = documents.sparkSession.createDataFrame([], "doc_id long, item_id long, word long, distance int, similarity double")
    return out


def _blocks(asked: DataFrame) -> Iterator[list[tuple[object, str]]]:
    block, words = [], 0
    for row in asked.toLocalIterator():
        block.append((row[0], row[1]))
        words += len(row[1] or "") // 2
        if len(block) >= BLOCK_ITEMS or words >= BLOCK_WORDS:
            yield block
            block, words = [], 0
    if block:
        yield block


def _scan(docs: DataFrame, items: Items) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        short = ShortItems(items.short)
        for batch in batches:
            column = pc.utf8_lower(batch.column(1).cast(pa.large_string()))
            if items.short:
                hits = sorted({(t, items.short[n][0]): w for t, text in enumerate(column) for n, w in sorted(short(text.as_py()).items(), reverse=True)}.items(), key=lambda x: x[0][0])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array([t for (t, _), _ in hits], pa.int64())), pa.array([i for (_, i), _ in hits], pa.int64()),
                    pa.array([w for _, w in hits], pa.int64()), pa.array([0] * len(hits), pa.int32()), pa.array([1.0] * len(hits), pa.float64())],
                    names=["doc_id", "item_id", "word", "distance", "similarity"])
            for first, _, words in iter_words(column, PUNCTUATION):
                found = find_items(items, words.hashes, words.bounds)
                best: dict[tuple[int, object], tuple[int, int, int]] = {}
                for (t, n), (distance, word) in found.items():      # items of one id count once
                    key, own = (t, items.ids[n]), (distance, word, len(items.words[n]))
                    best[key] = min(best.get(key, own), own)
                if best:
                    keys, own = list(best), list(best.values())
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array([first + t for t, _ in keys], pa.int64())), pa.array([i for _, i in keys], pa.int64()),
                        pa.array([w for _, w, _ in own], pa.int64()), pa.array([d for d, _, _ in own], pa.int32()),
                        pa.array([1 - d / m for d, _, m in own], pa.float64())], names=["doc_id", "item_id", "word", "distance", "similarity"])

    return docs.mapInArrow(run, "doc_id long, item_id long, word long, distance int, similarity double")


def without_contaminated(documents: DataFrame, benchmark: DataFrame, edits: float = EDITS, recall: float = RECALL, least_words: int = LEAST_WORDS,
                         text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``documents`` whose text no item contaminates, as they are; no shuffle."""
    asked = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text")).distinct()
    for block in _blocks(asked):
        shared = documents.sparkSession.sparkContext.broadcast(prepare_items(block, edits, recall, least_words))
        frame = documents.select(whole_row(documents), F.col(f"`{text}`").cast("string").alias("text"))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            short = ShortItems(items.short)
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                column = pc.utf8_lower(batch.column(1).cast(pa.large_string()))
                if items.short:
                    clean &= np.array([not short(t.as_py()) for t in column], dtype=bool)
                for first, _, words in iter_words(column, PUNCTUATION):
                    for t, _ in find_items(items, words.hashes, words.bounds):
                        clean[first + t] = False
                yield batch.select([0]).filter(pa.array(clean))

        documents = frame.mapInArrow(run, frame.select("row").schema).select("row.*")
    return documents
