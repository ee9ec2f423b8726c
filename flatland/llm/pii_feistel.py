"""Format-preserving pseudonyms of personal data by a keyed Feistel permutation.

Values are found by pattern and kept only if they are valid: card numbers by the Luhn digit, IBANs by modulo 97,
IPv4 octets by range, dates by the calendar, telephone numbers by shape and length, social security numbers by their assigned
ranges, mail addresses by shape. A valid value is a number of a finite set (all card numbers of 16 digits, all days from 1900 to
2099, ...); an eight-round Feistel network, keyed, with the kind as tweak, permutes that set (walking on
until it is back in the set). So the result has the same format and is valid again, equal values get equal pseudonyms in all
documents, different values different ones, and who has the key can undo it.

What is permuted is the value, not its spelling: a number without its spaces, dots and dashes, a mail name or IBAN without its case, a
day whatever its layout; the result is written in the spelling found, so one value in several spellings stays linked. A day is permuted
among those whose month and day have as many digits and, above 12, stay above 12: so it fits every layout in which it was found.

A match that is not valid may have swallowed a neighbour (``... 7034 EUR 50``, a card number and its check code): its shorter forms, cut at its
separators, are tried, then other kinds, and then the search goes on within it. Text without a valid value is left as it
is, digit for digit. Each document is worked on by itself: no shuffle.

Defined cases: null stays null and empty stays empty; equal rows give equal rows; a value whose set is a single one stays.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lengths of the countries' IBANs (fixed values of the registry).
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28,
    "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18,
    "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32,
    "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15,
    "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25,
    "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
ROUNDS = 8
KINDS = ("email", "iban", "card", "phone", "ssn", "ip", "date")

_FIRST_DAY, _DAYS = datetime.date(1900, 1, 1).toordinal(), (datetime.date(2100, 1, 1) - datetime.date(1900, 1, 1)).days
# A value is no part of a longer word or number: what may stand before and after it.
_BEFORE, _AFTER = r"(?<!\w)(?<!\d[.,/-])", r"(?!\w)(?![.,/-]\d)"
_SHAPES = {
    "email": r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._+-]{0,63}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.){1,8}[A-Za-z]{2,24}(?![\w-])",
    "iban": _BEFORE + r"[A-Za-z]{2}\d{2}(?:(?: [A-Za-z0-9]{4}){2,7}(?: [A-Za-z0-9]{1,3})?|[A-Za-z0-9]{11,30})" + _AFTER,
    "ip": _BEFORE + r"\d{1,3}(?:\.\d{1,3}){3}" + _AFTER,
    "date": _BEFORE + r"(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?:(?!\w)|(?=[Tt]\d\d:))(?![./-]\d)",
    "ssn": _BEFORE + r"\d{3}-\d{2}-\d{4}" + _AFTER,
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\w)|" + _BEFORE + r"\d{3}(?P<p>[.-])\d{3}(?P=p)\d{4}" + _AFTER,
    "card": _BEFORE + r"(?:\d{13,19}|\d{4}(?P<c>[ -])\d{4}(?P=c)\d{4}(?P=c)\d{1,4}(?:(?P=c)\d{1,3})?|\d{4}(?P<a>[ -])\d{6}(?P=a)\d{5})" + _AFTER,
}
_FIND = re.compile("|".join(f"(?P<{kind}>{shape})" for kind, shape in _SHAPES.items()))
_EACH = {kind: re.compile(shape) for kind, shape in _SHAPES.items()}
#: What may stand behind a shorter form of a match, and how many of its last groups may be left out.
_CUT = re.compile(r"[ .-]")
_LEFT_OUT = 8
_SEEN = re.compile(r"[0-9@]")


def _day_classes() -> tuple[dict[tuple[int, int], list[int]], list[tuple[int, int]]]:
    """Days since the first by (digits of the month, 1 to 9, 10 to 12 or more for the day), and the class of each day."""
    classes: dict[tuple[int, int], list[int]] = {}
    of_day = []
    for n in range(_DAYS):
        d = datetime.date.fromordinal(_FIRST_DAY + n)
        own = (len(str(d.month)), 0 if d.day < 10 else 1 if d.day <= 12 else 2)
        classes.setdefault(own, []).append(n)
        of_day.append(own)
    return classes, of_day


_CLASSES, _CLASS_OF = _day_classes()
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Permutation:
    """Keyed permutation of 0 .. size - 1 without a fixed point, and its inverse.

    The Feistel network f walks until it is back in range; a number x goes to the one
    whose f is f(x) + shift (modulo size), with a keyed shift, so none stays what it is.
    """

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self._half = max(1, -(-max(1, (size - 1).bit_length()) // 2))
        self._mask = (1 << self._half) - 1
        self._bytes = -(-self._half // 8)
        self._base = hashlib.blake2b(f"{tweak}\x00{size}".encode(), key=key[:64], digest_size=min(64, max(16, self._bytes)))

    def _round(self, n: int, x: int) -> int:
        h = self._base.copy()
        h.update(n.to_bytes(1, "big") + x.to_bytes(self._bytes, "big"))
        out = h.digest()
        while len(out) < self._bytes:
            h.update(out[-16:])
            out += h.digest()
        return int.from_bytes(out[:self._bytes], "big") & self._mask

    def _walk(self, x: int, rounds: range, forward: bool) -> int:
        while True:
            left, right = x >> self._half, x & self._mask
            for n in rounds:
                if forward:
                    left, right = right, left ^ self._round(n, right)
                else:
                    left, right = right ^ self._round(n, left), left
            x = left << self._half | right
            if x < self.size:
                return x

    def __call__(self, x: int, undo: bool = False) -> int:
        if self.size < 2:
            return x
        shift = 1 + self._round(ROUNDS, 0) % (self.size - 1)
        inner = self._walk(x, range(ROUNDS), True)
        return self._walk((inner + (-shift if undo else shift)) % self.size, range(ROUNDS - 1, -1, -1), False)


def luhn_digit(digits: str) -> str:
    """The last digit that makes the number valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _is_card(digits: str) -> bool:
    return len(set(digits)) > 1 and luhn_digit(digits[:-1]) == digits[-1]


def _iban_check(country: str, rest: str) -> str:
    value = int("".join(str(int(c, 36)) for c in rest + country + "00"))
    return f"{98 - value % 97:02d}"


def _spread(shape: str, digits: str) -> str:
    """The signs of ``digits`` in the places of the letters and digits of ``shape``."""
    it = iter(digits)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def _mixed(value: str, spare: int, permute) -> str:
    """Permute the letters and digits of a text from place ``spare`` on, each within its own alphabet."""
    sets = [next((a for a in (_DIGITS, _LOWER, _UPPER) if c in a), c) if i >= spare else c for i, c in enumerate(value)]
    size, number = 1, 0
    for c, own in zip(value, sets):
        number = number * len(own) + own.index(c)
        size *= len(own)
    number = permute("".join("9" if s is _DIGITS else "a" if s is _LOWER else "A" if s is _UPPER else s for s in sets), size, number)
    out = []
    for own in reversed(sets):
        number, at = divmod(number, len(own))
        out.append(own[at])
    return "".join(reversed(out))


class Pseudonyms:
    """Replaces the personal data of texts, or puts them back."""

    def __init__(self, key: bytes, kinds: tuple[str, ...] = KINDS, undo: bool = False):
        if not key:
            raise ValueError("a key is needed")
        self._key, self._kinds, self._undo = key, frozenset(kinds), undo

    def _permute(self, kind: str):
        return lambda tweak, size, number: Permutation(self._key, f"{kind}\x00{tweak}", size)(number, self._undo)

    def value(self, kind: str, s: str) -> str | None:
        """The pseudonym of a valid value; None if it is not valid."""
        permute = self._permute(kind)
        if kind == "card":
            digits = re.sub(r"[ -]", "", s)
            if not _is_card(digits):
                return None
            # A longer number is permuted among those whose first 16 digits are a valid one, too, or are not.
            short = _is_card(digits[:16])
            while True:
                body = str(permute(str(len(digits)), 10 ** (len(digits) - 1), int(digits[:-1]))).zfill(len(digits) - 1)
                digits = body + luhn_digit(body)
                if len(set(digits)) > 1 and _is_card(digits[:16]) == short:
                    return _spread(s, digits)
        if kind == "ip":
            octets = s.split(".")
            if any(int(o) > 255 or len(o) > 1 and o[0] == "0" for o in octets):
                return None
            x = permute("", 1 << 32, int.from_bytes(bytes(map(int, octets)), "big"))
            return ".".join(map(str, x.to_bytes(4, "big")))
        if kind == "date":
            return self._date(s, permute)
        if kind == "ssn":
            area, group, serial = s.split("-")
            if area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000":
                return None
            # 898 areas, 99 groups, 9999 serial numbers.
            a = int(area) - 1 - (int(area) > 666)
            x = permute("", 898 * 99 * 9999, (a * 99 + int(group) - 1) * 9999 + int(serial) - 1)
            x, serial = divmod(x, 9999)
            a, group = divmod(x, 99)
            return f"{a + 1 + (a >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"
        if kind == "phone":
            digits = re.sub(r"\D", "", s)
            if not 8 <= len(digits) <= 15:
                return None
            # The country code's first digit stays, so the number is still one of that region.
            spare = 1 if s[0] == "+" else 0
            n = len(digits) - spare
            return _spread(s, digits[:spare] + str(permute(f"{n}{'+' * spare}{digits[:spare]}", 10 ** n, int(digits[spare:]))).zfill(n))
        if kind == "iban":
            plain = s.replace(" ", "")
            if plain != plain.upper() and plain != plain.lower():
                return None
            country, check, rest = plain[:2].upper(), plain[2:4], plain[4:].upper()
            if len(plain) != IBAN_LENGTHS.get(country, len(plain)) or not 15 <= len(plain) <= 34 or _iban_check(country, rest) != check:
                return None
            new = _mixed(country + rest, 2, permute)[2:]
            out = country + _iban_check(country, new) + new
            return _spread(s, out if plain == plain.upper() else out.lower())
        local, _, domain = s.rpartition("@")
        new = _mixed(local.lower(), 0, lambda tweak, size, number: permute(f"{tweak}@{domain.lower()}", size, number))
        return "".join(n.upper() if c.isupper() else n for n, c in zip(new, local)) + "@" + domain

    @staticmethod
    def _day(s: str) -> tuple[int, str, str] | None:
        sep = next(c for c in s if not c.isdigit())
        parts = s.split(sep)
        if sep == "-":
            order = "ymd"
        elif sep == "." or int(parts[0]) > 12:
            order = "dmy"
        else:
            order = "mdy"
        at = dict(zip(order, map(int, parts)))
        try:
            day = datetime.date(at["y"], at["m"], at["d"]).toordinal() - _FIRST_DAY
        except ValueError:
            return None
        return (day, order, sep + "".join(str(len(p)) for p in parts)) if 0 <= day < _DAYS else None

    @staticmethod
    def _written(day: int, order: str, form: str) -> str:
        d = datetime.date.fromordinal(day + _FIRST_DAY)
        parts = {"y": d.year, "m": d.month, "d": d.day}
        return form[0].join(str(parts[c]).zfill(int(width)) for c, width in zip(order, form[1:]))

    def _date(self, s: str, permute) -> str | None:
        found = self._day(s)
        if found is None:
            return None
        day, order, form = found
        own = _CLASSES[_CLASS_OF[day]]
        at = bisect.bisect_left(own, day)
        return self._written(own[permute(f"{_CLASS_OF[day]}", len(own), at)], order, form)

    def _valid(self, text: str, m: re.Match) -> tuple[int, str, str] | None:
        """End, kind and pseudonym of the longest valid value that starts where the match does."""
        start = m.start()
        first = next(k for k in KINDS if m[k] is not None)
        for kind in (first, *(k for k in KINDS if k != first)):
            found = m if kind == first else _EACH[kind].match(text, start)
            if found is None or kind not in self._kinds:
                continue
            # A mail address has no shorter form: its name may hold what separates the groups of numbers.
            end = found.end()
            cuts = [] if kind in ("email", "date", "ip") else [start + c.start() for c in _CUT.finditer(text[start:end])][:-_LEFT_OUT - 1:-1]
            # Of a card number the shortest form counts, so that what follows it, on the way back too, changes nothing.
            for stop in (*reversed(cuts), end) if kind == "card" else (end, *cuts):
                if stop != end and not _EACH[kind].fullmatch(text[start:stop]):
                    continue
                new = self.value(kind, text[start:stop])
                if new is not None:
                    return stop, kind, new
        return None

    def __call__(self, text: str | None) -> tuple[str | None, dict[str, int]]:
        counts: dict[str, int] = {}
        if not text or not _SEEN.search(text):
            return text, counts
        parts, at, begin = [], 0, 0
        while m := _FIND.search(text, begin):
            found = self._valid(text, m)
            if found is None:
                # Go on behind the first word of the match: what follows may be a value of its own.
                begin = _WORD_END.match(text, m.start()).end()
                continue
            end, kind, new = found
            parts += (text[at:m.start()], new)
            at = begin = end
            counts[kind] = counts.get(kind, 0) + 1
        return ("".join(parts) + text[at:] if parts else text), counts


_WORD_END = re.compile(r"\w+|.", re.S)


def pseudonymise(documents: DataFrame, key: bytes, kinds: tuple[str, ...] = KINDS, undo: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, n_replaced and kinds (name: count) of every row."""
    docs = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    shared = documents.sparkSession.sparkContext.broadcast((key, tuple(kinds), undo))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replace = Pseudonyms(*shared.value)
        for batch in batches:
            found = [replace(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([t for t, _ in found], pa.string()), pa.array([sum(c.values()) for _, c in found], pa.int32()),
                pa.array([sorted(c.items()) for _, c in found], pa.map_(pa.string(), pa.int32()))], names=["doc_id", "text", "n_replaced", "kinds"])

    return docs.mapInArrow(run, f"doc_id {kind}, text string, n_replaced int, kinds map<string,int>")
