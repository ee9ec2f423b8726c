"""Vectorised word and shingle hashing over Arrow string columns.

A word is a run of bytes other than the ASCII white space 0x20 and 0x09-0x0D (or other than all
ASCII signs but letters and digits); A-Z count as a-z. Words are hashed straight from the column's UTF-8 buffer with a
few numpy passes, so no Python object is made per word. Hashes have 64 bits: within one pair of
documents of 10,000 words two different shingles meet with probability below 1e-11.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time; the temporary arrays take about 40 times as much.
BLOCK_BYTES = 2 << 20

_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: a bijection of unsigned 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_table() -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))
    codes[65:91] = codes[97:123]            # A-Z as a-z
    return codes


_CODES = _byte_table()
#: Bytes between words: ASCII white space; or all of ASCII but letters and digits.
WHITE_SPACE = np.zeros(256, dtype=bool)
WHITE_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[[b for b in range(128) if not chr(b).isalnum()]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        up = np.full(size, _MULT, dtype=np.uint64)
        up[0] = 1
        down = np.full(size, _INV & _MASK, dtype=np.uint64)
        down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.cumprod(up), np.cumprod(down)
    return _POWERS["up"][:n], _POWERS["down"][:n]


@dataclass
class Words:
    """The words of several texts, in order: text i owns words bounds[i]:bounds[i + 1]."""

    hashes: np.ndarray      # uint64 per word
    starts: np.ndarray      # byte offset of each word within its text
    ends: np.ndarray
    bounds: np.ndarray      # int64, one more than texts


def _hash_buffer(raw: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, starts and ends of one buffer."""
    inside = ~between[raw]
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends
    up, down = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_CODES[raw] * up[:-1], out=total[1:])
    value = (total[ends] - total[starts]) * down[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), starts, ends


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 buffer of a string column and its offsets; nulls are empty."""
    if pa.types.is_large_string(column.type) is False:
        column = column.cast(pa.large_string())
    column = column.fill_null("") if column.null_count else column
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, offsets


def iter_words(column: pa.Array, between: np.ndarray = WHITE_SPACE) -> Iterator[tuple[int, int, Words]]:
    """Yield (first, last, words) for runs of texts of about BLOCK_BYTES bytes.

    A text longer than that is a run of its own and is hashed whole.
    """
    raw, offsets = texts_of(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        lo, hi = int(offsets[first]), int(offsets[last])
        # One space after every text, so that no word crosses into the next.
        own = offsets[first:last + 1] - lo
        n = last - first
        buf = np.full(hi - lo + n, 0x20, dtype=np.uint8)
        shift = np.repeat(np.arange(n), np.diff(own))
        buf[np.arange(hi - lo) + shift] = raw[lo:hi]
        base = own + np.arange(n + 1)
        hashes, starts, ends = _hash_buffer(buf, between)
        bounds = np.searchsorted(starts, base)
        owner = np.repeat(np.arange(n), np.diff(bounds))
        yield first, last, Words(hashes, starts - base[owner], ends - base[owner], bounds)
        first = last


def runs_of(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; ``size`` counts, too."""
    out = np.full(max(0, len(words) - size + 1), np.uint64(size), dtype=np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(_MULT) + words[k:k + len(out)])
    return out


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of every text, and the texts' bounds in them.

    A shorter text is one run, a text without words has none.
    """
    counts = np.diff(words.bounds)
    runs = runs_of(words.hashes, size)
    own = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(own)))
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - words.bounds[:-1], own)
    out = np.empty(bounds[-1], dtype=np.uint64)
    whole = at < len(runs)
    out[whole] = runs[at[whole]]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        lo, hi = words.bounds[i], words.bounds[i + 1]
        out[bounds[i]] = runs_of(words.hashes[lo:hi], hi - lo)[0]
    return out, bounds


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of every text, ascending."""
    hashes, bounds = shingles(words, size)
    for lo, hi in zip(bounds, bounds[1:]):
        yield np.unique(hashes[lo:hi])
