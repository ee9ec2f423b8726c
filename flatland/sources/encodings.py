"""Text encodings of feeds: their usual spellings, and strict decoding of lines.

A feed names its encoding as users write it (``latin-1``, ``cp1252``, ``UTF8``, ``utf-8-sig``). Lines of
any encoding that keeps ASCII where it is can be split as bytes at their line ends and decoded afterwards, many
at a time; bytes that the encoding does not have are reported, never replaced without a word.
"""

from __future__ import annotations

import codecs

import numpy as np
import pyarrow as pa

#: Encodings that Spark's own text and CSV readers decode, under the names they know.
SPARK_CHARSETS = {
    "utf-8": "UTF-8", "utf-8-sig": "UTF-8", "ascii": "US-ASCII", "iso8859-1": "ISO-8859-1", "utf-16": "UTF-16", "utf-16-le": "UTF-16LE",
    "utf-16-be": "UTF-16BE", "utf-32": "UTF-32", "utf-32-le": "UTF-32LE", "utf-32-be": "UTF-32BE",
}
_ASCII = bytes(range(128))


def codec_name(encoding: str) -> str:
    """One name for each encoding, whatever its spelling; unknown ones raise ValueError."""
    try:
        return codecs.lookup(encoding.strip()).name
    except LookupError:
        raise ValueError(f"unknown encoding: {encoding}") from None


def keeps_ascii(codec: str) -> bool:
    """Whether bytes below 128 are ASCII signs in this encoding, so that line ends can be found in the bytes."""
    try:
        return _ASCII.decode(codec) == _ASCII.decode("ascii") and "\n".encode(codec)[-1:] == b"\n" and len("\n".encode(codec)) in (1, 4)
    except UnicodeError:
        return False


def spark_charset(codec: str) -> str | None:
    """The reader option for Spark's own readers; None if they do not know the encoding."""
    return SPARK_CHARSETS.get(codec)


def decode_lines(lines: pa.Array, codec: str) -> tuple[pa.Array, np.ndarray]:
    """Lines (binary) as text, and the numbers of those with bytes the encoding does not have (read with U+FFFD)."""
    codec = "utf-8" if codec == "utf-8-sig" else codec
    lines = lines.cast(pa.large_binary())
    _, offs, data = lines.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[lines.offset:lines.offset + len(lines) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None and len(lines) else np.empty(0, np.uint8)
    if not len(raw) or raw.max() < 128:
        return lines.cast(pa.string()), np.empty(0, np.int64)
    if codec == "utf-8":
        try:
            return lines.cast(pa.string()), np.empty(0, np.int64)
        except pa.ArrowInvalid:
            pass
    out, bad = [], []
    for i, line in enumerate(lines.to_pylist()):
        try:
            out.append(line.decode(codec))
        except UnicodeDecodeError:
            out.append(line.decode(codec, "replace"))
            bad.append(i)
    return pa.array(out, pa.string()), np.array(bad, dtype=np.int64)
