"""Packing of tokenised documents into sequences by bin completion.

Documents are tokenised once, in place; per piece only its length and a checksum go on. How pieces are
packed depends on nothing but the histogram of lengths (at most ``capacity`` numbers, whatever the data), so the
driver plans on that: it takes the longest length left, enumerates undominated
fillings around it and uses the chosen filling as often as the counts allow. Best-fit packing of the histogram
is the first incumbent. Branch and bound goes on from the fillings of least waste, while the waste so far leaves room for a better plan
than the incumbent, and ends when it meets a lower bound (``lower_bound``: volume, pairs, and dual feasible functions).

Fillings are found by sums, not by trial: bit k of a number says whether k tokens can be made from the lengths looked at so far, so one shift
and one ``or`` add a length. The first plan goes by the best filling at each step; later ones leave it at one step, then at two, and
so on, the earliest steps first (limited discrepancy). Packing is NP-hard, so the search is bounded by its work (``WORK`` lengths
looked at, the first plan aside), which is the same for every table.

Every use of a filling empties a length or a kind of sequence, so a plan has a few fillings for each of the ``capacity``
lengths, whatever the data; it is sent to the tasks as a table of runs: the pieces of length l with ranks a to b go into sequences s, s + 1 and so on. Ranks within a length come
from counts of (length, salt) groups of about ``RANK_GROUP`` pieces, so a length that very many pieces share is not one task's work.

Defined cases: a null text is the empty text; every document ends with the end id, so an empty one has
length 1; repeated rows are packed as often as they are there; a table without rows gives none.
"""

from __future__ import annotations

import heapq
import itertools
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Lengths the search may look at after its first plan.
WORK = 2_000_000
RANK_GROUP = 2000
#: Fillings tried at each node of the search.
WIDTH = 3

# The byte-level pre-tokenisation pattern of the vocabulary (fixed value).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteTokenizer:
    """Ids of a byte-level BPE vocabulary file of the ``tokenizers`` library.

    The file's vocabulary is its merge order, so tiktoken gives the same ids at a
    quarter of the time; where its pattern engine gives up (very long runs of white
    space) the tokenizers library itself encodes the text. Special tokens' strings are ordinary text.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", [])}
        unicode_of = self._byte_signs()
        byte_of = {u: b for b, u in unicode_of.items()}
        ranks = {bytes(byte_of[c] for c in token): n for token, n in spec["model"]["vocab"].items() if token not in special}
        self._path, self._whole = path, None
        self._fast = tiktoken.Encoding("vocabulary", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _byte_signs() -> dict[int, str]:
        """The printable sign by which byte-level vocabularies write each byte."""
        printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        others = [b for b in range(256) if b not in printable]
        return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self._fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
        except ValueError as e:
            if "regex" not in str(e).lower():
                raise
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self._path)
            self._whole.encode_special_tokens = True
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def tokenise(documents: DataFrame, vocabulary: str, capacity: int, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece; only longer documents are cut."""
    frame = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ByteTokenizer(vocabulary)
        for batch in batches:
            rows, pieces, starts, lengths, sums = [], [], [], [], []
            for i, t in enumerate(batch.column(1)):
                ids = np.append(encode(t.as_py() or "").astype("<u4"), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for n, (a, b) in enumerate(zip(edges, edges[1:])):
                    rows.append(i)
                    pieces.append(n)
                    starts.append(a)
                    lengths.append(b - a)
                    sums.append(zlib.crc32(ids[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return frame.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


@dataclass
class Plan:
    """Fillings as {length: number} with how many sequences use each."""

    capacity: int
    fillings: list[tuple[dict[int, int], int]] = field(default_factory=list)

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.fillings)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The largest of three kinds of bounds on the number of sequences.

    Volume; lengths over capacity - k stand alone and those from k on share with the others; and the dual feasible
    functions u_k, in which a length counts floor((k + 1) x / capacity) / k, or x / capacity where that division leaves no rest.
    """
    lengths = np.array(sorted(counts), dtype=np.int64)
    numbers = np.array([counts[x] for x in lengths.tolist()], dtype=np.int64)
    if not len(lengths):
        return 0
    best = -(-int((lengths * numbers).sum()) // capacity)
    for k in range(1, capacity // 2 + 1):
        alone = int(numbers[lengths > capacity - k].sum())
        large = (lengths <= capacity - k) & (lengths * 2 > capacity)
        small = (lengths >= k) & (lengths * 2 <= capacity)
        room = int(((capacity - lengths) * numbers)[large].sum())
        rest = int((lengths * numbers)[small].sum()) - room
        best = max(best, alone + int(numbers[large].sum()) + max(0, -(-rest // capacity)))
    for k in range(1, min(capacity, 100) + 1):
        # In units of 1 / (k * capacity), so that the sums are whole numbers.
        share, rest = np.divmod((k + 1) * lengths, capacity)
        units = np.where(rest == 0, k * lengths, share * capacity)
        best = max(best, -(-int((units * numbers).sum()) // (k * capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing on the histogram: equal sequences are filled together."""
    plan: dict[tuple[tuple[int, int], ...], int] = {}
    room: dict[int, dict[tuple, int]] = {}          # free space: fillings with it, and how many
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            space = min((s for s in room if s >= length), default=None)
            if space is None:
                take = min(capacity // length, left)
                used = left // take
                key = ((length, take),)
                free = capacity - take * length
                room.setdefault(free, {})
                room[free][key] = room[free].get(key, 0) + used
                left -= used * take
                continue
            key, number = next(iter(room[space].items()))
            each = min(space // length, left)
            used = min(number, left // each)
            new = (*key, (length, each))
            free = space - each * length
            if used == number:
                del room[space][key]
                if not room[space]:
                    del room[space]
            else:
                room[space][key] = number - used
            room.setdefault(free, {})
            room[free][new] = room[free].get(new, 0) + used
            left -= used * each
    for by in room.values():
        for key, number in by.items():
            plan[key] = plan.get(key, 0) + number
    return Plan(capacity, [(dict(key), n) for key, n in plan.items()])


def _sums(lengths: list[int], counts: dict[int, int], space: int, stop: bool) -> list[int]:
    """Reachable sums (as bits) from none, the first, the first two ... of the lengths; with ``stop`` up to the first that reaches ``space``."""
    mask, reach = (1 << (space + 1)) - 1, 1
    out = [reach]
    for x in lengths:
        n, step = min(counts[x], space // x), 1
        while n > 0:
            take = min(step, n)
            reach |= (reach << (x * take)) & mask
            n -= take
            step *= 2
        out.append(reach)
        if stop and reach >> space & 1:
            break
    return out


def _trace(lengths: list[int], counts: dict[int, int], sums: list[int], target: int) -> dict[int, int]:
    """Lengths that add up to ``target``: of each, from the last of the list on, as few as can be."""
    at = next(i for i, reach in enumerate(sums) if reach >> target & 1)
    out: dict[int, int] = {}
    while at:
        at -= 1
        x, n = lengths[at], 0
        while not (target >= 0 and sums[at] >> target & 1):
            target -= x
            n += 1
        if n:
            out[x] = n
    return out


def _dominated(filling: dict[int, int], counts: dict[int, int], available: int, waste: int) -> bool:
    """Whether some of the filling's lengths could be exchanged for one longer length left, or two for one as long.

    ``available``: the lengths left, as bits. The fillings have few lengths, so their sums are soon made.
    """
    once, many = 0, 0                       # sums of one length, of two and more
    for x, n in filling.items():
        for _ in range(n):
            many |= (many << x) | (once << x)
            once |= 1 << x
        if n == counts[x]:
            available &= ~(1 << x)          # all of them are in the filling
    # What can be put in their place: a sum of two and more, or what is 1 to ``waste`` longer than any sum.
    longer, span = (once | many) << 1 if waste else 0, 1
    while span < waste:
        step = min(span, waste - span)
        longer |= longer << step
        span += step
    return bool(available & (many | longer))


def completions(counts: dict[int, int], lengths: list[int], space: int, width: int, most_waste: int | None = None) -> tuple[list[dict[int, int]], int]:
    """Up to ``width`` undominated fillings of ``space`` with at most so much waste, least waste first, and the lengths looked at.

    ``lengths``: those left, longest first. The first filling is one of least waste that does without the shorter lengths
    as far as it can; the others use the shortest ones instead, or waste more.
    """
    most_waste = space if most_waste is None else min(most_waste, space)
    if space in counts:                     # one length fills it: every other filling is dominated
        return [{space: 1}], 1
    fit = [x for x in lengths if x <= space]
    if not fit:
        return ([{}] if space <= most_waste else []), 1
    sums = _sums(fit, counts, space, stop=True)
    work = len(lengths) + 2 * len(sums)
    top = sums[-1].bit_length() - 1
    if space - top > most_waste:
        return [], work
    out = [_trace(fit, counts, sums, top)]
    if width > 1:
        available = sum(1 << x for x in fit)
        rising = fit[::-1]
        all_sums = _sums(rising, counts, space, stop=False)
        work += 2 * len(all_sums)
        reach, target = all_sums[-1], top
        while len(out) < width and target >= 0 and space - target <= min(most_waste, space - top + TRIED_WASTE):
            other = _trace(rising, counts, all_sums, target)
            work += len(all_sums)
            if other not in out and not _dominated(other, counts, available, space - target):
                out.append(other)
            reach &= (1 << target) - 1
            target = reach.bit_length() - 1
    return out, work


#: How much more than the least waste the other fillings may have.
TRIED_WASTE = 32


def plan_packing(counts: dict[int, int], capacity: int, work: int = WORK) -> Plan:
    """Branch and bound over fillings of the histogram; never worse than best fit."""
    counts = {x: n for x, n in counts.items() if n > 0}
    incumbent = best_fit(counts, capacity)
    bound = lower_bound(counts, capacity)
    total = sum(x * n for x, n in counts.items())
    # A node: steps off the best fillings so far, its depth, the fillings so far as (earlier ones, filling, times), their waste, and
    # which of its own fillings is next. What is left is worked out again when a node is taken, so that the many nodes of a dive stay small.
    order = itertools.count()
    heap: list[tuple[int, int, int, tuple | None, int, int]] = [(0, 0, next(order), None, 0, 0)]
    spent, first = 0, True
    while heap and (first or spent < work) and incumbent.sequences > bound:
        off, depth, _, chosen, waste, nth = heapq.heappop(heap)
        left = _left(counts, chosen)
        lengths = sorted(left, reverse=True)
        # A dive goes on to its leaf unless its waste is more than that of a plan with one sequence less than the incumbent.
        while (room := (incumbent.sequences - 1) * capacity - total - waste) >= 0:
            if not left:
                incumbent = Plan(capacity, _fillings(chosen))
                break
            longest = lengths[0]
            left[longest] -= 1
            rest, others = (left, lengths) if left[longest] else ({x: n for x, n in left.items() if n}, lengths[1:])
            options, looked = completions(rest, others, capacity - longest, nth + 1, room)
            left[longest] += 1
            spent += looked
            if len(options) <= nth:
                break
            if nth + 1 < WIDTH:
                heapq.heappush(heap, (off + 1, depth, next(order), chosen, waste, nth + 1))
            filling = dict(options[nth])
            filling[longest] = filling.get(longest, 0) + 1
            times = min(left[x] // n for x, n in filling.items())
            waste += (capacity - sum(x * n for x, n in filling.items())) * times
            chosen = (chosen, filling, times)
            depth, nth = depth + 1, 0
            _take(left, filling, times)
            lengths = [x for x in lengths if x in left]
        first = False
    return incumbent


def _take(left: dict[int, int], filling: dict[int, int], times: int) -> None:
    for x, n in filling.items():
        left[x] -= n * times
        if not left[x]:
            del left[x]


def _fillings(chosen: tuple | None) -> list[tuple[dict[int, int], int]]:
    out = []
    while chosen:
        chosen, filling, times = chosen
        out.append((filling, times))
    return out[::-1]


def _left(counts: dict[int, int], chosen: tuple | None) -> dict[int, int]:
    left = dict(counts)
    for filling, times in _fillings(chosen):
        _take(left, filling, times)
    return left


def _runs(plan: Plan) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first ranks of runs, pieces in each sequence, first sequence and offset."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for filling, times in plan.fillings:
        offset = 0
        for x in sorted(filling, reverse=True):
            n = filling[x]
            runs.setdefault(x, []).append((taken.get(x, 0), n, sequence, offset))
            taken[x] = taken.get(x, 0) + n * times
            offset += n * x
        sequence += times
    return {x: tuple(np.array(c, dtype=np.int64) for c in zip(*r)) for x, r in runs.items()}


def pack_documents(documents: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    pieces = tokenise(documents, vocabulary, capacity, end_id, doc_id, text).checkpoint()
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_packing(counts, capacity)
    spark = documents.sparkSession
    runs = spark.sparkContext.broadcast(_runs(plan))
    # Groups of about RANK_GROUP pieces within each length; at most ``capacity`` numbers of groups.
    groups = F.create_map(*[F.lit(x) for length, n in sorted(counts.items()) for x in (length, -(-n // RANK_GROUP))]) if counts else F.lit(None).cast("map<bigint,int>")
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.greatest(groups[F.col("length")], F.lit(1))).cast("int"))
    salted = salted.checkpoint()
    base = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    base = base.withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n")
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (salted.withColumn("rank", F.row_number().over(within) - 1).join(base, ["length", "salt"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("rank")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = runs.value
        for batch in batches:
            length = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                own = np.flatnonzero(length == x)
                first, each, begin, shift = table[int(x)]
                run = np.searchsorted(first, rank[own], side="right") - 1
                k = rank[own] - first[run]
                sequence[own] = begin[run] + k // each[run]
                offset[own] = shift[run] + k % each[run] * x
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
