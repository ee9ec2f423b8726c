"""Scalar building blocks: names, null markers, strict and relational casts."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from flatland.functions.casts import (db_cast, parse_db_type, pg_timestamp0, spark_type, strict_double,
                                      strict_timestamp)
from flatland.functions.names import landing_name, landing_name_col, stage_name, stage_name_col
from flatland.functions.nulls import NULL_MARKERS, clean_cell

HEADERS = ["Amount (USD)", "ProductID", "record_id", "Order-Date", "[Qty]", "HTTPServerName", "paid",
           "Customer Name", "itemcode", "price", "unit_price", "x_desc", "Flag"]


def test_landing_name_rule():
    assert landing_name("Amount (USD)") == "amount_usd"
    assert landing_name("Order-Date") == "order_date"
    assert landing_name('"Quoted Col"', quoted=True) == "quoted_col"
    assert landing_name("[Qty]") == "qty"


def test_stage_name_rule():
    assert stage_name("ProductID") == "product_id"
    assert stage_name("Amount (USD)") == "amount_usd"
    assert stage_name("HTTPServerName") == "http_server_name"
    assert stage_name("itemcode") == "item_code"
    assert stage_name("price") == "price"          # keyword alone is left alone
    assert stage_name("unit_price") == "unit_price"
    assert stage_name("paid") == "pa_id"           # suffix rule is purely textual


def test_name_columns_match_python(spark):
    df = spark.createDataFrame([(h,) for h in HEADERS], "h string")
    got = {r[0]: (r[1], r[2]) for r in df.select("h", landing_name_col(F.col("h")), stage_name_col(F.col("h"))).collect()}
    for h in HEADERS:
        assert got[h] == (landing_name(h), stage_name(h)), h


def test_null_markers_exact_and_case_sensitive(spark):
    near = ["nan", "N/A", "null ", "NONE", " NULL", "none"]
    rows = [(m,) for m in NULL_MARKERS + ["MISSING"] + near]
    df = spark.createDataFrame(rows, "c string")
    out = [r[0] for r in df.select(clean_cell(F.col("c"), "MISSING", quoted=False)).collect()]
    assert out[: len(NULL_MARKERS) + 1] == [None] * (len(NULL_MARKERS) + 1)
    assert out[len(NULL_MARKERS) + 1:] == near


def test_quote_stripping_after_markers(spark):
    df = spark.createDataFrame([('"NULL"',), ('a"b',), ('""',)], "c string")
    out = [r[0] for r in df.select(clean_cell(F.col("c"), None, quoted=True)).collect()]
    # '"NULL"' is not a marker before stripping, so it survives as the text NULL.
    assert out == ["NULL", "ab", None]


def test_strict_number(spark):
    cells = ["abc", "1,5", "1.5d", " 1.5 ", "1e5", "inf", "-0.5", None, "2F", "NaN"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    v, bad = strict_double(F.col("c"))
    got = [(r[0], r[1]) for r in df.select(v, bad).collect()]
    assert got == [(None, True), (None, True), (None, True), (1.5, False), (100000.0, False),
                   (float("inf"), False), (-0.5, False), (None, False), (None, True), (None, False)]


def test_strict_timestamp_formats(spark):
    cells = ["2001-01-21 01:31:51", "01/21/2001 01:31:51", "01/21/2001", "1/2/2001 1:31 PM", "20010121",
             "21-Jan-2001", "13/02/2001", "9999-01-01", "x", "2001-01-21T01:02:03.5", "ABC"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    v, bad = strict_timestamp(F.col("c"))
    got = [(r[0], r[1]) for r in df.select(v, bad).collect()]
    T = dt.datetime
    assert got == [(T(2001, 1, 21, 1, 31, 51), False), (T(2001, 1, 21, 1, 31, 51), False),
                   (T(2001, 1, 21), False), (T(2001, 1, 2, 13, 31), False), (T(2001, 1, 21), False),
                   (T(2001, 1, 21), False), (T(2001, 2, 13), False), (None, False), (None, True),
                   (T(2001, 1, 21, 1, 2, 3, 500000), False), (None, True)]


def test_relational_rounding(spark):
    df = spark.createDataFrame([(x,) for x in [0.5, 1.5, 2.5, -2.5, 1.005, -1.7]], "x double")
    ints = [r[0] for r in df.select(db_cast(F.col("x"), "integer")).collect()]
    assert ints == [0, 2, 2, -2, 1, -2]
    decs = [r[0] for r in df.select(db_cast(F.col("x"), "decimal(10,2)")).collect()]
    assert decs[4] == decimal.Decimal("1.01")
    big = spark.createDataFrame([(2147483648.0,)], "x double").select(db_cast(F.col("x"), "bigint")).first()[0]
    assert big == 2147483648


def test_varchar_truncates(spark):
    df = spark.createDataFrame([("abcdef",)], "s string")
    assert df.select(db_cast(F.col("s"), "varchar(3)")).first()[0] == "abc"


def test_timestamp0_rounds(spark):
    rows = [("2024-01-01 10:00:00.499999",), ("2024-01-01 10:00:00.5",), ("1999-01-01 10:00:00.5",),
            ("2024-01-01 10:00:59.7",)]
    df = spark.createDataFrame(rows, "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
    got = [r[0] for r in df.select(pg_timestamp0(F.col("t"))).collect()]
    T = dt.datetime
    assert got == [T(2024, 1, 1, 10), T(2024, 1, 1, 10, 0, 1), T(1999, 1, 1, 10), T(2024, 1, 1, 10, 1)]


@pytest.mark.parametrize("text,expected", [("decimal(12,2)", ("decimal", 12, 2)), ("varchar(?)", ("varchar", None, None)),
                                           ("timestamp(0)", ("timestamp", 0, None)), ("float64", ("float64", None, None))])
def test_parse_db_type(text, expected):
    assert parse_db_type(text) == expected


def test_spark_types():
    assert spark_type("integer").simpleString() == "int"
    assert spark_type("decimal(7,2)").simpleString() == "decimal(7,2)"
    assert spark_type("timestamp(0)").simpleString() == "timestamp_ntz"


def test_more_date_layouts(spark):
    from datetime import datetime

    from flatland.functions.casts import strict_timestamp
    ten = datetime(2024, 1, 5, 22, 0)
    day = datetime(2024, 1, 5)
    cases = {"2024-01-05 10:00:00 PM": ten, "1/5/2024 10:00:00.123 PM": ten.replace(microsecond=123000), "1/5/2024 10:00PM": ten, "1/5/24 10:00 pm": ten,
             "Jan 5 2024 10:00 PM": ten, "2024.01.05": day, "Friday, January 5, 2024": day, "Fri 5 Jan 2024": day, "2024-01": datetime(2024, 1, 1),
             "2024-01-05T22:00:00+02": ten, "2024-01-05 22:00-05": ten, "13-01-2024": datetime(2024, 1, 13), "05.01.2024 22:00": ten, "Friday": None,
             "2024-13": None, "1/5/2024 25:00": None, "31/02/2024": None, "Sunny 5 2024": None}
    df = spark.createDataFrame([(k,) for k in cases], "s string").select("s", strict_timestamp(F.col("s"))[0].alias("t"))
    assert {r["s"]: r["t"] for r in df.collect()} == cases


def test_layout_vote_of_a_column(spark):
    from flatland.operators.profile import infer_types, profile_columns
    rows = [("01/02/2024", "1/2/2024", "2024-01-02", "01/02/2024", "1.2.2024", "x"), ("13/05/2024", "5/13/2024", "2024-05-13", "5/13/2024", "13.5.2024", "2024-01-02"),
            (None, "12/31/1999", None, "13/5/2024", "1.1.2000 10:30", None)]
    got = infer_types(profile_columns(spark.createDataFrame(rows, "df string, mf string, iso string, mixed string, dot string, text string")))
    assert {r["column_name"]: (r["landing_type"], r["date_layout"]) for r in got.collect()} == {
        "df": ("date", "d/M/yyyy"), "mf": ("date", "M/d/yyyy"), "iso": ("date", "yyyy-M-d"), "mixed": ("date", None),
        "dot": ("timestamp", "d.M.yyyy[ H:mm[:ss]]"), "text": ("string", None)}


def test_integer_texts_with_a_zero_fraction_keep_their_digits(spark):
    from pyspark.sql import types as T

    from flatland.functions.casts import pg_integer
    df = spark.createDataFrame([("9007199254740993.0",), ("-9007199254740993.",), ("2.5",)], "s string")
    assert [r[0] for r in df.select(pg_integer(F.col("s"), True, T.StringType())).collect()] == [9007199254740993, -9007199254740993, 2]


def test_numbers_and_layout_families_are_read_as_by_all_layouts(spark):
    """The tests that spare parses change no verdict: eight digits are a number's only date, one family of layouts a text's only one."""
    from flatland.functions import casts
    texts = ["19980304", " 19980304 ", "12345678", "1998.304", "1e5", "-5", "1.5f", "NaN", "inf", "Nation", "1998-03-04", "1998-03-04\n", "1998-03-04 05:06:07",
             "3/4/98", "13/4/1998", "4-Mar-98", "4 March 1998", "March 4, 1998 5:06 pm", "04.03.1998", "1998.3.4 5:06", "1998-3", "19980304 050607", "12:30", "", None]
    s = F.col("s")
    attempt = casts.number_attempt(s)
    plain = F.when(~s.rlike(r"[0-9.][dDfF]\s*$"), s.try_cast("double"))
    every = F.coalesce(*[casts._try_layout(casts.datetime_text(s), fmt) for fmt in casts.DATETIME_FORMATS]).cast("timestamp_ntz")
    rows = spark.createDataFrame([(t,) for t in texts], "s string").select(
        "s", attempt.cast("string").alias("a"), plain.cast("string").alias("p"), casts.parse_datetime(s).alias("t"), every.alias("e"),
        casts.number_datetime(s).alias("n")).collect()
    for r in rows:
        assert r["a"] == r["p"] and r["t"] == r["e"], r
        assert r["a"] is None or r["n"] == r["t"], r
