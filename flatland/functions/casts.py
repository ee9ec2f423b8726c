"""Strict landing casts and PostgreSQL-semantics stage casts.

Landing (V3, V4): a cell that is present but does not parse makes its file
bad; the result is null for it. A ``number`` column lands as its checked text,
so integers beyond 2^53 and decimals keep every digit until the stage cast; a
``float64`` column lands as double. Stage (V7-V11): the conversions a relational
target applies on insert, restated with Spark built-ins: half-even integer
rounding, half-away decimal rounding, silent varchar truncation, timestamp(0)
rounding.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The date/time layouts accepted on landing, tried in this
# order (month first; day first only as the last resort).
DATETIME_FORMATS = [
    "yyyy-M-d H:mm[:ss][.SSSSSS]",
    "yyyy-M-d",
    "yyyy/M/d H:mm[:ss][.SSSSSS]",
    "yyyy/M/d",
    "M/d/yyyy H:mm[:ss][.SSSSSS]",
    "M/d/yyyy h:mm[:ss] a",
    "M/d/yyyy",
    "M/d/yy H:mm[:ss]",
    "M/d/yy",
    "yyyyMMdd",
    "yyyyMMdd HHmmss",
    "d-MMM-yyyy[ H:mm[:ss]]",
    "d-MMM-yy[ H:mm[:ss]]",
    "d MMMM yyyy[ H:mm[:ss]]",
    "d MMM yyyy[ H:mm[:ss]]",
    "MMMM d yyyy[ H:mm[:ss]]",
    "MMM d yyyy[ H:mm[:ss]]",
    "M-d-yyyy[ H:mm[:ss]]",
    "d/M/yyyy H:mm[:ss][.SSSSSS]",
    "d/M/yyyy",
    "d/M/yy",
    "d.M.yyyy[ H:mm[:ss]]",
    "yyyy-M-d h:mm[:ss][.SSSSSS] a",
    "M/d/yyyy h:mm[:ss][.SSSSSS] a",
    "M/d/yy h:mm[:ss] a",
    "MMMM d yyyy h:mm[:ss] a",
    "MMM d yyyy h:mm[:ss] a",
    "d/M/yyyy h:mm[:ss][.SSSSSS] a",
    "yyyy.M.d[ H:mm[:ss]]",
    "d-M-yyyy[ H:mm[:ss]]",
    "yyyy-M",
]
_SIGNS = {"yyyy": "[0-9]{4}", "yy": "[0-9]{2}", "M": "(?:0?[1-9]|1[0-2])", "MM": "(?:0[1-9]|1[0-2])", "MMM": "[A-Za-z]{3,4}", "MMMM": "[A-Za-z]{3,9}",
          "d": "(?:0?[1-9]|[12][0-9]|3[01])", "dd": "(?:0[1-9]|[12][0-9]|3[01])", "H": "[0-9]{1,2}", "HH": "[0-9]{2}", "h": "[0-9]{1,2}", "mm": "[0-9]{2}",
          "ss": "[0-9]{2}", "SSSSSS": "[0-9]{1,6}", "a": "[AaPp][Mm]", "[": "(?:", "]": ")?"}


def _shape(layout: str) -> str:
    """Pattern of the texts that a layout may read: cheap to test, where a parse that fails costs an exception."""
    tokens = re.findall(r"([A-Za-z])(\1*)|(.)", layout)
    return "^" + "".join(_SIGNS[a + b] if a else _SIGNS.get(c) or re.escape(c) for a, b, c in tokens) + "$"


def _try_layout(t: Column, layout: str) -> Column:
    return F.when(t.rlike(_SHAPES[layout]), F.try_to_timestamp(t, F.lit(layout)))


_SHAPES = {layout: _shape(layout) for layout in DATETIME_FORMATS}



def _by_sign(t: Column, each) -> Column:
    """``each`` of the layouts that a text may match by the signs it holds: those of one family, in their order.

    No text matches the shapes of two families, so the others need not be tried.
    """
    families: dict[str, list[str]] = {sign: [] for sign in ("/", "-", ".", "MMM", "")}
    for layout in DATETIME_FORMATS:
        required = re.sub(r"\[.*?\]+", "", layout)
        families[next(sign for sign in families if sign in required)].append(layout)
    return (F.when(t.contains("/"), each(families["/"])).when(t.contains("-"), each(families["-"])).when(t.contains("."), each(families["."]))
            .when(t.rlike("[A-Za-z]{3}"), each(families["MMM"])).otherwise(each(families[""])))


#: Layouts of dates with a time, whose bits tell of a column that they may be read from.
ISO_TIME, ISO_DATE = 0, 1

# The representable range of the landing timestamp (nanosecond
# precision in the original loader). Parsed values outside it become null
# without making the file bad.
TS_MIN = "1677-09-21 00:12:43.145225"
TS_MAX = "2262-04-11 23:47:16.854775"

# Varchar sizes offered by type inference, smallest first.
VARCHAR_LADDER = [10, 20, 40, 60, 80, 100, 255, 500, 2000, 4000]


# Texts that are no number by their first signs: digits before the sign of a date or time, letters that begin no inf or nan.
# A cast that fails costs an exception, this test next to nothing.
_NO_NUMBER = r"^(?:[0-9]+[-/:]|[A-HJ-MO-Za-hj-mo-z]|[iI](?![nN])|[nN](?![aA]))"


def number_attempt(c: Column) -> Column:
    """try_cast to double, refusing the d/f type suffix Spark would accept."""
    lettered = c.contains("d") | c.contains("D") | c.contains("f") | c.contains("F")
    return F.when(~(c.rlike(_NO_NUMBER) | (lettered & c.rlike(r"[0-9.][dDfF]\s*$"))), c.try_cast("double"))


def number_text(cell: Column, attempt: Column) -> Column:
    """The checked text of a number, without blanks around it; NaN lands as null."""
    return F.when(attempt.isNotNull() & ~F.isnan(attempt), F.trim(cell))


def number_value(attempt: Column) -> Column:
    """NaN parses but lands as null."""
    return F.when(~F.isnan(attempt), attempt)


def strict_double(c: Column) -> tuple[Column, Column]:
    """(value, is_bad) for a landing float64 column (V3).

    Surrounding blanks, exponents and inf are accepted; a present cell that
    does not parse is bad.
    """
    parsed = number_attempt(c)
    return number_value(parsed), c.isNotNull() & parsed.isNull()


# Cheap shape test: only texts that look like one of the layouts above (three
# parts of digits or a month's name; or eight digits) are handed to the
# parsers, so ordinary words cost one regex, not a parse for each layout.
_WEEKDAY = r"(?:(?:[Mm]on|[Tt]ues|[Ww]ednes|[Tt]hurs|[Ff]ri|[Ss]atur|[Ss]un)day|[Mm]on|[Tt]ue|[Ww]ed|[Tt]hu|[Ff]ri|[Ss]at|[Ss]un)[,.]? +"
_DATE_SHAPE = (rf"^\s*(?:{_WEEKDAY})?(?:[0-9]{{1,4}}[-/.][0-9A-Za-z]{{1,9}}[-/.][0-9]{{1,4}}|[0-9]{{8}}|[0-9]{{4}}-[0-9]{{1,2}}(?=\s*$)"
               r"|[0-9]{1,2} [A-Za-z]{3,9},? [0-9]{4}|[A-Za-z]{3,9} [0-9]{1,2},? [0-9]{4})(?![0-9A-SU-Za-z])")
_ISO_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?: [0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,6})?)?$"
# A time's zone (Z or an offset) and what Spark's microseconds cannot hold.
_ZONE = r"(?<=[0-9])\s*(?:Z|UTC|GMT|[+-][0-9]{2}(?::?[0-9]{2})?)$"
_HALF_DAY = r"(?i)(?<=[0-9])\s*([ap])\.?m\.?$"
_FRACTION = r"(:[0-9]{2}\.[0-9]{6})[0-9]+$"


def datetime_text(c: Column) -> Column:
    """The text in the spelling of the layouts: trimmed, without a weekday, a blank for ``T``, the comma after
    a day gone, the wall clock of its own zone, at most microseconds, a blank before AM or PM."""
    t = F.regexp_replace(F.trim(c), r"(?<=[0-9])T(?=[0-9])", " ")
    t = F.regexp_replace(t, rf"^{_WEEKDAY}", "")
    t = F.regexp_replace(t, r"(?<=[0-9A-Za-z]), ", " ")
    clock = F.regexp_replace(F.regexp_replace(t, _ZONE, ""), _FRACTION, "$1")
    half = F.concat(F.regexp_replace(clock, _HALF_DAY, " "), F.upper(F.regexp_extract(clock, _HALF_DAY, 1)), F.lit("M"))
    t = F.when(t.contains(":"), F.when(clock.rlike(_HALF_DAY), half).otherwise(clock)).otherwise(t)
    return t


def layout_mask(c: Column, parsed: Column) -> Column:
    """Bit i: the text can be read by layout i of ``DATETIME_FORMATS``; 0 if by none. ``parsed``: its ``parse_datetime``.

    The bits of a column, combined by ``bit_and``, are the layouts that read all of it.
    """
    iso = F.when(F.length(F.trim(c)) > 10, F.lit(1 << ISO_TIME)).otherwise(F.lit(1 << ISO_DATE)).cast("long")

    def bits(t: Column) -> Column:
        def of(layouts: list[str]) -> Column:
            each = [F.when(_try_layout(t, fmt).isNotNull(), F.lit(1 << DATETIME_FORMATS.index(fmt))).otherwise(F.lit(0)).cast("long") for fmt in layouts]
            return sum(each[1:], each[0])
        return _by_sign(t, of)

    # Within ``transform`` the rewritten text is made once.
    tried = F.get(F.transform(F.array(datetime_text(c)), bits), F.lit(0))
    return F.when(parsed.isNull(), F.lit(0).cast("long")).when(c.rlike(_ISO_SHAPE), iso).otherwise(tried)


def first_layout(mask: Column) -> Column:
    """The layout of the lowest bit of a mask; null without one."""
    return F.coalesce(*[F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.lit(fmt)) for i, fmt in enumerate(DATETIME_FORMATS)])


def parse_by_layout(c: Column, layout: str, layouts: list[str] | tuple[str, ...] = ()) -> Column:
    """A cell of a column whose layout is known: one parse; a text that it does not read is tried by the others."""
    text = F.trim(c) if layout in DATETIME_FORMATS[:2] else datetime_text(c)
    return F.coalesce(F.try_to_timestamp(text, F.lit(layout)).cast(T.TimestampNTZType()), parse_datetime(c, layouts))


def parse_datetime(c: Column, layouts: list[str] | tuple[str, ...] = ()) -> Column:
    """First layout that parses, as a wall-clock timestamp (no time zone).

    ``layouts`` are a feed's own, tried first on the trimmed text as it is.
    """
    own = [F.try_to_timestamp(F.trim(c), F.lit(fmt)) for fmt in layouts]
    # The commonest spelling needs no rewriting and is tried on the text as it is.
    # Of its two layouts only the one with or without a time is tried.
    with_time, date = [F.try_to_timestamp(c, F.lit(DATETIME_FORMATS[i])) for i in (ISO_TIME, ISO_DATE)]
    plain = F.when(c.rlike(_ISO_SHAPE), F.when(F.length(c) > 10, with_time).otherwise(date))
    # Within ``transform`` the rewritten text is made once, and the generated code stays small.
    tried = F.transform(F.array(datetime_text(c)), lambda t: _by_sign(t, lambda layouts: F.coalesce(*[_try_layout(t, fmt) for fmt in layouts])))
    known = F.when(c.rlike(_DATE_SHAPE), F.get(tried, F.lit(0)))
    return F.coalesce(*own, plain, known).cast(T.TimestampNTZType())


def number_datetime(c: Column) -> Column:
    """``parse_datetime`` of a text that is a number (``number_attempt``): eight digits are its only layout."""
    t = F.trim(c)
    return F.when(F.length(t) == 8, _try_layout(t, "yyyyMMdd")).cast(T.TimestampNTZType())


def datetime_value(attempt: Column) -> Column:
    """Parsed values outside the representable range land as null (not bad)."""
    lo, hi = F.lit(TS_MIN).cast("timestamp_ntz"), F.lit(TS_MAX).cast("timestamp_ntz")
    return F.when(attempt.between(lo, hi), attempt)


def strict_timestamp(c: Column) -> tuple[Column, Column]:
    """(value, is_bad) for a landing date/timestamp column (V4)."""
    parsed = parse_datetime(c)
    return datetime_value(parsed), c.isNotNull() & parsed.isNull()


_INTEGER_TEXT = r"^[+-]?[0-9]{1,38}(?:\.0*)?$"


def pg_integer(c: Column, bigint: bool = False, source: T.DataType | None = None) -> Column:
    """Number -> integer/bigint, rounding half to even (V7).

    Integers, decimals and integer texts are cast as they are, never through
    a double; ``source`` is the type of ``c`` where the caller knows it.
    """
    to = "bigint" if bigint else "int"
    if isinstance(source, T.IntegralType):
        return c.cast(to)
    if isinstance(source, T.DecimalType):
        return F.bround(c, 0).cast(to)
    if isinstance(source, T.StringType):
        t = F.trim(c)
        return F.when(t.rlike(_INTEGER_TEXT), t.cast("decimal(38,0)").cast(to)).otherwise(F.rint(t.cast("double")).cast(to))
    whole = F.typeof(c).isin("tinyint", "smallint", "int", "bigint")
    return F.when(whole, c.cast(to)).otherwise(F.rint(c).cast(to))


def pg_decimal(c: Column, precision: int, scale: int) -> Column:
    """Number -> decimal(p,s), half away from zero; overflow fails (V8)."""
    return c.cast(T.DecimalType(precision, scale))


def pg_varchar(c: Column, n: int) -> Column:
    """Text -> varchar(n): silently cut to n characters (V9)."""
    return F.substring(c.cast("string"), 1, n)


def pg_timestamp0(c: Column) -> Column:
    """Timestamp -> timestamp(0).

    Rounds to the nearest second; an exact half second rounds away from the
    relational epoch 2000-01-01, i.e. up after it and down before it.
    """
    ts = c.cast("timestamp_ntz")
    whole = F.date_trunc("second", ts).cast("timestamp_ntz")
    frac_us = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint") % 1_000_000
    up = (frac_us > 500_000) | ((frac_us == 500_000) & (ts >= F.lit("2000-01-01").cast("timestamp_ntz")))
    return F.when(up, whole + F.expr("INTERVAL 1 SECOND")).otherwise(whole)


def pg_date(c: Column) -> Column:
    """Timestamp -> date."""
    return c.cast("date")


def age_days(ts: Column, now: Column) -> Column:
    """Whole days between two instants, floored (F16); not midnight counting."""
    return F.floor(F.timestamp_diff("SECOND", ts, now) / F.lit(86400)).cast("bigint")


def duration_text(seconds: Column) -> Column:
    """'9 seconds' (F17)."""
    return F.concat(seconds.cast("bigint").cast("string"), F.lit(" seconds"))


_TYPE_RE = re.compile(r"^\s*([a-z][a-z0-9_ ]*?)\s*(?:\(\s*([0-9?]+)\s*(?:,\s*([0-9]+)\s*)?\))?\s*$")


def parse_db_type(type_text: str) -> tuple[str, int | None, int | None]:
    """'decimal(12,2)' -> ('decimal', 12, 2); 'varchar(?)' -> ('varchar', None, None)."""
    m = _TYPE_RE.match(type_text.strip().lower())
    if not m:
        raise ValueError(f"unsupported column type {type_text!r}")
    base, a, b = m.group(1), m.group(2), m.group(3)
    a_int = int(a) if a and a != "?" else None
    return base, a_int, int(b) if b else None


def spark_type(type_text: str) -> T.DataType:
    """Spark type that stores a stage/target column of the given DB type."""
    base, a, b = parse_db_type(type_text)
    if base in ("integer", "int", "int4"):
        return T.IntegerType()
    if base in ("bigint", "int8"):
        return T.LongType()
    if base in ("decimal", "numeric"):
        return T.DecimalType(a or 38, b or 0)
    if base in ("timestamp", "timestamp without time zone"):
        return T.TimestampNTZType()
    if base == "date":
        return T.DateType()
    if base in ("float64", "double precision", "float8", "double"):
        return T.DoubleType()
    if base in ("varchar", "string", "text", "character varying", "char"):
        return T.StringType()
    raise ValueError(f"unsupported column type {type_text!r}")


def db_cast(c: Column, type_text: str, source: T.DataType | None = None) -> Column:
    """CAST(c AS type) with relational semantics (P8/P9); ``source`` is the type of ``c`` where known."""
    base, a, b = parse_db_type(type_text)
    if base in ("integer", "int", "int4"):
        return pg_integer(c, source=source)
    if base in ("bigint", "int8"):
        return pg_integer(c, bigint=True, source=source)
    if base in ("decimal", "numeric"):
        return pg_decimal(c, a or 38, b or 0)
    if base in ("timestamp", "timestamp without time zone"):
        return pg_timestamp0(c) if a == 0 else c.cast("timestamp_ntz")
    if base == "date":
        return pg_date(c)
    if base in ("float64", "double precision", "float8", "double"):
        return c.cast("double")
    if base in ("varchar", "character varying", "char"):
        return pg_varchar(c, a) if a else c.cast("string")
    if base in ("string", "text"):
        return c.cast("string")
    raise ValueError(f"unsupported column type {type_text!r}")
