"""Landing: edge-case files (FIXTURES.md section 3) through the whole landing operator."""

import bz2
import datetime as dt
import gzip
import lzma
import zipfile

from pyspark.sql import functions as F

from flatland.operators.land import LandingField, land_feed
from flatland.plans.feed import Feed
from tests.conftest import write

JOB = "2023-03-24 10:00:00"

# The loader's sample feed: tab-delimited, unquoted, null marker <NULL>.
SAMPLE = ("record_id\tinteger_field\tfloat_field_01\tdate_field_01\ttimestamp_field_01\n"
          "123\t1\t1.1\t01/21/2001\t01/21/2001 01:31:51\n"
          "ABC\t2\t2.2\t02/22/2002\t02/22/2002 02:32:52\n"
          "A2C\t3\t3.3\t03/23/2003\t03/23/2003 03:33:53\n")
SAMPLE_SPEC = [LandingField("record_id"), LandingField("float_field_01", "float64"),
               LandingField("integer_field_01", "float64"), LandingField("date_field_01", "date"),
               LandingField("timestamp_field_01", "timestamp")]


def files_by_name(res):
    return {r["load_file_name"]: r.asDict() for r in res.files.collect()}


def test_sample_as_shipped_is_rejected(spark, feed_dir):
    write(feed_dir / "file_to_process_01.txt", SAMPLE)
    res = land_feed(spark, Feed("flat_files_01", str(feed_dir)), SAMPLE_SPEC, JOB)
    f = files_by_name(res)["file_to_process_01.txt"]
    assert f["status"] == "bad" and f["reason"] == "missing column: integer_field_01"
    assert res.rows.count() == 0


def test_sample_corrected_lands_three_rows(spark, feed_dir):
    write(feed_dir / "file_to_process_01.txt", SAMPLE.replace("integer_field\t", "integer_field_01\t", 1))
    res = land_feed(spark, Feed("flat_files_01", str(feed_dir)), SAMPLE_SPEC, JOB)
    rows = res.rows.orderBy("float_field_01").collect()
    assert [c for c in res.rows.columns] == ["record_id", "integer_field_01", "float_field_01", "date_field_01",
                                             "timestamp_field_01", "load_file_name", "load_timestamp"]
    assert [r["record_id"] for r in rows] == ["123", "ABC", "A2C"]
    assert rows[0]["integer_field_01"] == 1.0 and rows[0]["date_field_01"] == dt.datetime(2001, 1, 21)
    assert rows[2]["timestamp_field_01"] == dt.datetime(2003, 3, 23, 3, 33, 53)
    assert rows[0]["load_timestamp"] == dt.datetime(2023, 3, 24, 10)
    f = files_by_name(res)["file_to_process_01.txt"]
    assert (f["status"], f["raw_records"], f["records_loaded"]) == ("loaded", 3, 3)


def test_ragged_rows_fail_the_file_and_short_rows_pad(spark, feed_dir):
    write(feed_dir / "short.txt", "a\tb\tc\n1\t2\t3\n4\t5\n")
    write(feed_dir / "long.txt", "a\tb\tc\n1\t2\t3\n4\t5\t6\t7\n")
    write(feed_dir / "long_empty.txt", "a\tb\tc\n1\t2\t3\n4\t5\t6\t\n")
    res = land_feed(spark, Feed("r", str(feed_dir)), [LandingField("a", "float64")], JOB)
    f = files_by_name(res)
    assert f["short.txt"]["status"] == "loaded"
    assert f["long.txt"]["reason"] == "too many fields" and f["long_empty.txt"]["status"] == "bad"
    rows = sorted((r["a"], r["c"]) for r in res.rows.collect())
    assert rows == [(1.0, "3"), (4.0, None)]


def test_quoted_values(spark, feed_dir):
    text = ('id,note\n1,"has, comma"\n2,"doubled ""quote"""\n3,"two\nlines"\n4,""\n5,"NULL"\n6,NULL\n')
    write(feed_dir / "q.csv", text)
    res = land_feed(spark, Feed("q", str(feed_dir), extension="csv", delimiter=",", quoting=0),
                    [LandingField("id", "float64")], JOB)
    got = {r["id"]: r["note"] for r in res.rows.collect()}
    assert got == {1.0: "has, comma", 2.0: "doubled quote", 3.0: "two\nlines", 4.0: None, 5.0: None, 6.0: None}
    f = files_by_name(res)["q.csv"]
    assert (f["raw_records"], f["records_loaded"]) == (7, 6)   # the quoted line break is a physical line


def test_compressed_forms(spark, feed_dir):
    body = "k\tv\n1\tx\n2\ty\n"
    write(feed_dir / "plain.txt", body)
    (feed_dir / "g.txt.gz").write_bytes(gzip.compress(body.encode()))
    (feed_dir / "b.txt.bz2").write_bytes(bz2.compress(body.encode()))
    (feed_dir / "x.txt.xz").write_bytes(lzma.compress(body.encode()))
    with zipfile.ZipFile(feed_dir / "z.zip", "w", compression=zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("inner.txt", body)
    write(feed_dir / "ignored.TXT", body)
    write(feed_dir / "sub" / "nested.txt", body)
    res = land_feed(spark, Feed("c", str(feed_dir)), [LandingField("k", "float64")], JOB)
    per_file = {r[0]: r[1] for r in res.rows.groupBy("load_file_name").count().collect()}
    assert per_file == {"plain.txt": 2, "g.txt.gz": 2, "b.txt.bz2": 2, "x.txt.xz": 2, "z.zip": 2}
    assert {r["load_file_name"]: r["raw_records"] for r in res.files.collect()}["z.zip"] == 2


def test_header_variants(spark, feed_dir):
    write(feed_dir / "a.txt", "Key\tAmount (USD)\n1\t10\n")
    write(feed_dir / "b.txt", "amount_usd\tkey\textra\n20\t2\tE\n")
    write(feed_dir / "c.txt", "key\n3\n")
    write(feed_dir / "d.txt", "Key\tkey\tamount_usd\n4\t4\t40\n")
    res = land_feed(spark, Feed("h", str(feed_dir)), [LandingField("key", "float64"),
                                                       LandingField("Amount (USD)", "float64")], JOB)
    f = files_by_name(res)
    assert f["c.txt"]["reason"] == "missing column: amount_usd"
    assert f["d.txt"]["reason"] == "duplicate column: key"
    rows = sorted((r["key"], r["amount_usd"], r["extra"]) for r in res.rows.collect())
    assert rows == [(1.0, 10.0, None), (2.0, 20.0, "E")]


def test_bad_file_does_not_poison_later_files(spark, feed_dir):
    write(feed_dir / "a_bad.txt", "n\tv\n1\tabc\n2\t3\n")
    write(feed_dir / "b_good.txt", "n\tv\n3\t4\n")
    res = land_feed(spark, Feed("bg", str(feed_dir)), [LandingField("n", "float64"), LandingField("v", "float64")], JOB)
    f = files_by_name(res)
    assert f["a_bad.txt"]["status"] == "bad" and f["a_bad.txt"]["bad_rows"] == 1
    assert f["b_good.txt"]["status"] == "loaded"
    assert [r["n"] for r in res.rows.collect()] == [3.0]
    q = res.quarantine.collect()
    assert [(r["load_file_name"], r["reason"]) for r in q] == [("a_bad.txt", "bad number in v")]


def test_empty_files(spark, feed_dir):
    write(feed_dir / "header_only.txt", "n\tv\n")
    write(feed_dir / "zero.txt", "")
    res = land_feed(spark, Feed("e", str(feed_dir)), [LandingField("n", "float64")], JOB)
    f = files_by_name(res)
    assert f["header_only.txt"]["status"] == "empty" and f["header_only.txt"]["raw_records"] == 0
    assert f["zero.txt"]["status"] == "bad" and f["zero.txt"]["reason"] == "empty file"


def test_delimiters_and_encoding(spark, feed_dir):
    write(feed_dir / "p.txt", "id|name\n1|Zoë\n2|Çà\n", encoding="latin-1")
    res = land_feed(spark, Feed("p", str(feed_dir), delimiter="|", encoding="ISO-8859-1"),
                    [LandingField("id", "float64")], JOB)
    assert sorted(r["name"] for r in res.rows.collect()) == ["Zoë", "Çà"]


def test_result_independent_of_partitioning(spark, feed_dir):
    lines = "k\tv\n" + "".join(f"{i}\t{i * 2}\n" for i in range(2000))
    write(feed_dir / "big.txt", lines)
    res = land_feed(spark, Feed("p", str(feed_dir)), [LandingField("k", "float64")], JOB)
    a = sorted(tuple(r) for r in res.rows.drop("load_timestamp").collect())
    b = sorted(tuple(r) for r in res.rows.drop("load_timestamp").repartition(7).collect())
    assert a == b and len(a) == 2000
    assert res.rows.agg(F.sum("k")).first()[0] == sum(range(2000))


def test_header_readers_agree(spark, feed_dir):
    from flatland.sources.files import _jvm_headers, file_headers
    write(feed_dir / "plain.txt", "a\tb\n1\t2\n")
    write(feed_dir / "blank_first.txt", "\n\n  \na\tb\n1\t2\n")
    write(feed_dir / "bom.txt", "﻿a\tb\r\n1\t2\r\n")
    write(feed_dir / "empty.txt", "")
    paths = sorted(f"file:{p}" for p in map(str, feed_dir.iterdir()))
    py = {r["path"].rsplit("/", 1)[-1]: r["header"] for r in file_headers(spark, paths).collect()}
    jvm = {r["path"].rsplit("/", 1)[-1]: r["header"] for r in _jvm_headers(spark, paths).collect()}
    assert py == jvm == {"plain.txt": "a\tb", "blank_first.txt": "a\tb", "bom.txt": "a\tb", "empty.txt": None}


def test_quarantine_keeps_a_sample_of_the_offending_text(spark, feed_dir):
    write(feed_dir / "a.txt", "k\tv\n1\tx\n2\ty\n")
    write(feed_dir / "b.txt", "k\tv\n1\tx\nzz\ty\nyy\tw\n")          # two bad numbers: smallest sample kept
    write(feed_dir / "c.txt", "k\tv\n1\tx\textra\n")                # a long row: its raw text
    res = land_feed(spark, Feed("s", str(feed_dir)), [LandingField("k", "float64")], "2024-01-01 00:00:00")
    q = {r["load_file_name"]: (r["reason"], r["sample"], r["bad_rows"]) for r in res.quarantine.collect()}
    assert q == {"b.txt": ("bad number in k", "yy", 2), "c.txt": ("too many fields", "1\tx\textra", 1)}
    assert res.rows.count() == 2


def test_file_names_with_blanks_and_signs(spark, feed_dir):
    for quoting, folder in ((3, feed_dir / "plain"), (1, feed_dir / "quoted")):
        names = ["a b.csv", "ä+1%.csv", "c#d.csv"]
        for n in names:
            write(folder / n, "k,v\n1,2\n")
        write(folder / "bad %20.csv", "k,v\nx,2\n")
        res = land_feed(spark, Feed("s", str(folder), extension="csv", delimiter=",", quoting=quoting), [LandingField("k", "float64")], "2024-01-01 00:00:00")
        files = {r["load_file_name"]: (r["status"], r["raw_records"], r["records_loaded"]) for r in res.files.collect()}
        assert files == {**{n: ("loaded", 1, 1) for n in names}, "bad %20.csv": ("bad", 1, 0)}
        assert sorted(r["load_file_name"] for r in res.rows.collect()) == sorted(names)
