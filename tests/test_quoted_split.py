"""Quoted files read in parallel splits give the rows and verdicts of the one-task reader."""

from pyspark.sql import functions as F

from flatland.operators.land import LandingField, land_feed
from flatland.plans.feed import Feed
from flatland.sources.quoted import quoted_records

from .conftest import SF_SMALL, write

JOB = "2024-01-01 00:00:00"


def _both(spark, feed, fields):
    whole = land_feed(spark, feed, fields, JOB)
    split = land_feed(spark, feed.with_(quoted_split_bytes=256), fields, JOB)
    return whole, split


def _same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _doc_lines(n, eol="\n"):
    lines = ['"id","body","n"']
    for i in range(n):
        body = f"line one of {i}{eol}line two with ""quotes"" and, a comma"
        if i % 7 == 0:
            body = "x" * 900 + "\n" + "y" * 700           # one value spans several splits
        if i % 5 == 0:
            lines.append("")                                 # blank line between records
        lines.append(f'"{i}","{body}","{i * 3}"')
    return eol.join(lines) + eol


def test_split_reader_matches_multiline(spark, feed_dir):
    write(feed_dir / "docs_a.csv", _doc_lines(60))
    write(feed_dir / "docs_b.csv", _doc_lines(45, eol="\r\n"))
    feed = Feed("docs", str(feed_dir), extension="csv", delimiter=",", quoting=1)
    fields = [LandingField("id", "float64"), LandingField("n", "float64")]
    whole, split = _both(spark, feed, fields)
    _same(whole.rows, split.rows)
    _same(whole.files.drop("source_path"), split.files.drop("source_path"))
    assert split.rows.count() == 105
    crlf = split.rows.filter(F.col("load_file_name") == "docs_b.csv")
    assert crlf.filter(F.col("body").contains("\r")).count() == 0   # CRLF inside a value reads as LF
    assert crlf.filter(F.col("body").contains("\n")).count() == 45


def test_split_reader_flags_ragged_rows(spark, feed_dir):
    rows = ['"a","b","c"'] + [f'"{i}","v{i}","w{i}"' for i in range(80)]
    rows[30] = '"29","short"'                               # short row: padded, flagged
    rows[50] = '"49","x","y","extra"'                       # long row: makes the file bad
    write(feed_dir / "ragged.csv", "\n".join(rows) + "\n")
    write(feed_dir / "fine.csv", "\n".join(['"a","b","c"'] + [f'"{i}","p\nq","r"' for i in range(40)]) + "\n")
    feed = Feed("ragged", str(feed_dir), extension="csv", delimiter=",", quoting=1)
    whole, split = _both(spark, feed, [LandingField("a", "float64")])
    _same(whole.rows, split.rows)
    _same(whole.files.drop("source_path"), split.files.drop("source_path"))
    status = {r["load_file_name"]: r["status"] for r in split.files.collect()}
    assert status == {"ragged.csv": "bad", "fine.csv": "loaded"}


def test_records_cross_many_splits(spark, tmp_path):
    big = "z" * 5000
    write(tmp_path / "one.csv", f'"h1","h2"\n"1","{big}\n{big}"\n"2","end"\n')
    recs = quoted_records(spark, [str(tmp_path / "one.csv")], str(tmp_path / "out"), split_bytes=300)
    texts = sorted(r["text"] for r in recs.collect())
    assert texts == ['"1","' + big + "\n" + big + '"', '"2","end"']


def _random_csv(seed, n, eol):
    import csv
    import io
    import random
    rnd = random.Random(seed)
    alphabet = ['a', 'b', ' ', ',', '"', '\n', 'x', 'é', '1', '.']
    buf = io.StringIO()
    w = csv.writer(buf, delimiter=",", quotechar='"', doublequote=True, quoting=csv.QUOTE_MINIMAL,
                   lineterminator=eol)
    w.writerow(["id", "t1", "t2"])
    for i in range(n):
        if rnd.random() < 0.05:
            buf.write(eol)                                   # blank line
        cells = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(2)]
        w.writerow([str(i)] + [c.replace("\n", eol) for c in cells])
    return buf.getvalue()


def test_split_reader_any_split_size(spark, feed_dir):
    write(feed_dir / "r_lf.csv", _random_csv(7, 300, "\n"))
    write(feed_dir / "r_crlf.csv", _random_csv(11, 200, "\r\n"))
    feed = Feed("rand", str(feed_dir), extension="csv", delimiter=",", quoting=0)
    fields = [LandingField("id", "float64")]
    whole = land_feed(spark, feed, fields, JOB)
    assert whole.rows.count() == 500
    for size in (97, 333, 2048):
        split = land_feed(spark, feed.with_(quoted_split_bytes=size), fields, JOB)
        _same(whole.rows, split.rows)
        _same(whole.files.drop("source_path"), split.files.drop("source_path"))


def test_line_endings_inside_values_follow_the_file(spark, feed_dir):
    lf = b'"id","t"\n"1","a\r\nb"\n"2","c\nd"\n' + b"".join(f'"{i}","x"\n'.encode() for i in range(3, 200))
    (feed_dir / "lf.csv").write_bytes(lf)
    feed = Feed("m", str(feed_dir), extension="csv", delimiter=",", quoting=1)
    whole, split = _both(spark, feed, [LandingField("id", "float64")])
    _same(whole.rows, split.rows)
    got = [r["t"] for r in split.rows.filter("id < 3").orderBy("id").collect()]
    assert got == ["a\r\nb", "c\nd"]                           # an LF file keeps a CRLF inside a value


def test_every_order_passes_the_record_rule(spark):
    from __spark_entry__ import queries
    keys = [r[0] for r in spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey").collect()]
    got = queries()["quoted_whole_table"](spark, SF_SMALL).groupBy("split_bytes").agg(F.sort_array(F.collect_list("o_orderkey")).alias("keys")).collect()
    assert {r["split_bytes"]: r["keys"] for r in got} == {n: sorted(keys) for n in (32768, 262144, 0)}


def test_each_kind_of_cell_at_97_bytes(spark, feed_dir):
    kinds = [('5" pipe', "5 pipe"), ('"a\rb"', "a\rb"), ('"two\nlines, ""said"" he"', "two\nlines, said he"), ("plain", "plain"),
             ('"' + 'x""y' * 200 + '"', "xy" * 200)]
    write(feed_dir / "cells.csv", "id,cell\n" + "".join(f"{i},{kinds[i % 5][0]}\n" for i in range(100)))
    feed = Feed("cells", str(feed_dir), extension="csv", delimiter=",", quoting=0, quoted_split_bytes=97)
    rows = land_feed(spark, feed, [LandingField("id", "number")], JOB).rows.collect()
    assert sorted((int(r["id"]), r["cell"].replace('"', "")) for r in rows) == [(i, kinds[i % 5][1]) for i in range(100)]


# Whole-file faults, encodings and line ends --------------------------------

SIZES = (61, 1024, None)


def _land(spark, feed_dir, size, **kw):
    feed = Feed("f", str(feed_dir), extension="csv", delimiter=",", quoting=0, quoted_split_bytes=size, **kw)
    res = land_feed(spark, feed, [LandingField("id", "number")], JOB)
    files = {r["load_file_name"]: (r["status"], r["reason"], r["sample"], r["records_loaded"]) for r in res.files.collect()}
    return sorted((r["load_file_name"], int(r["id"]), r["t"]) for r in res.rows.collect()), files


def _body(n, cell='"x y"'):
    return "".join(f"{i},{cell}\n" for i in range(n))


def test_a_file_that_ends_inside_a_value_is_bad_at_any_size(spark, feed_dir):
    write(feed_dir / "good.csv", "id,t\n" + _body(40))
    write(feed_dir / "open.csv", 'id,t\n1,"open\n2,b\n3,c')
    write(feed_dir / "late.csv", "id,t\n" + _body(60) + '60,"open\n' + "".join(f"{i},plain\n" for i in range(61, 90)))
    write(feed_dir / "doubled.csv", 'id,t\n1,"a""\n')
    write(feed_dir / "closed.csv", 'id,t\n1,"open\n2,b\n3,"c\n')                # the third quote closes the first
    for size in SIZES:
        rows, files = _land(spark, feed_dir, size)
        bad = ("bad", "file ends inside a quoted value", None, 0)
        assert files == {"good.csv": ("loaded", None, None, 40), "open.csv": bad, "late.csv": bad, "doubled.csv": bad, "closed.csv": ("loaded", None, None, 1)}
        assert [r for r in rows if r[0] == "closed.csv"] == [("closed.csv", 1, "open\n2,b\n3,c")]


def test_bytes_that_the_encoding_has_not_make_the_file_bad(spark, feed_dir):
    (feed_dir / "bytes.csv").write_bytes(b"id,t\n" + _body(50).encode() + b'50,caf\xe9\n51,"\xff\xfe"\n')
    write(feed_dir / "good.csv", "id,t\n" + _body(20, '"é 漢字"'))
    for size in SIZES:
        rows, files = _land(spark, feed_dir, size)
        assert files == {"bytes.csv": ("bad", "bytes that utf-8 does not have", "50,caf�", 0), "good.csv": ("loaded", None, None, 20)}
        assert rows == [("good.csv", i, "é 漢字") for i in range(20)]


def test_unquoted_files_with_bytes_that_are_no_utf8_are_bad(spark, feed_dir):
    (feed_dir / "bytes.txt").write_bytes(b"id\tt\n1\tcaf\xe9\n2\tb\n")
    (feed_dir / "head.txt").write_bytes(b"id\tt\xe9\n1\ta\n")
    write(feed_dir / "good.txt", "id\tt\n1\té\n2\tb�\n")
    res = land_feed(spark, Feed("f", str(feed_dir)), [LandingField("id", "number")], JOB)
    files = {r["load_file_name"]: (r["status"], r["reason"], r["sample"]) for r in res.files.collect()}
    reason = "bytes that utf-8 does not have"
    assert files == {"bytes.txt": ("bad", reason, "1\tcaf�"), "head.txt": ("bad", reason, None), "good.txt": ("loaded", None, None)}
    assert sorted(r["t"] for r in res.rows.collect()) == ["b�", "é"]


def test_copies_in_several_encodings_give_equal_rows(spark, tmp_path):
    text = "id,t\n" + "".join(f'{i},"Käse, ""{i}""\nà la carte – €"\n' for i in range(60)).replace("– €", "§")
    want = None
    for name, spelt in (("utf-8", "UTF8"), ("latin-1", "latin-1"), ("cp1252", "CP1252"), ("utf-8-sig", "utf-8-sig"), ("iso8859-15", "latin9")):
        write(tmp_path / name / "a.csv", text, name)
        for size in SIZES:
            rows, files = _land(spark, tmp_path / name, size, encoding=spelt)
            want = want or rows
            assert rows == want and len(rows) == 60 and rows[7][2] == 'Käse, 7\nà la carte §'


def test_double_byte_and_unquoted_odd_encodings(spark, tmp_path):
    write(tmp_path / "sjis" / "a.csv", "id,t\n" + "".join(f'{i},"表示 | ソ"\n' for i in range(30)), "shift_jis")     # trail bytes of \ and |
    feed = Feed("s", str(tmp_path / "sjis"), extension="csv", delimiter=",", quoting=0, encoding="Shift_JIS", quoted_split_bytes=64)
    assert {r["t"] for r in land_feed(spark, feed, [], JOB).rows.collect()} == {"表示 | ソ"}
    write(tmp_path / "plain" / "a.txt", "id\tt\r\n" + "".join(f'{i}\t“{i}” 5" €\r\n' for i in range(30)), "cp1252")
    rows = land_feed(spark, Feed("p", str(tmp_path / "plain"), encoding="windows-1252"), [LandingField("id", "number")], JOB).rows.collect()
    assert sorted((int(r["id"]), r["t"]) for r in rows) == [(i, f'“{i}” 5" €') for i in range(30)]
    try:
        Feed("x", "/nowhere", encoding="no such encoding")
        raise AssertionError("taken")
    except ValueError as e:
        assert "no such encoding" in str(e)


def test_lines_that_end_with_cr_alone(spark, feed_dir):
    write(feed_dir / "mac.csv", 'id,t\r' + "".join(f'{i},"a\rb {i}"\r' for i in range(50)))
    write(feed_dir / "unix.csv", 'id,t\n' + "".join(f'{i},"a\nb {i}"\n' for i in range(50)))
    for size in SIZES:
        rows, files = _land(spark, feed_dir, size)
        assert {f: v[:2] for f, v in files.items()} == {"mac.csv": ("loaded", None), "unix.csv": ("loaded", None)}
        assert rows == [(f, i, f"a\nb {i}") for f in ("mac.csv", "unix.csv") for i in range(50)]


def test_header_faults_are_of_one_file(spark, feed_dir):
    write(feed_dir / "open.csv", 'id,"t\n1,a\n2,b\n')
    write(feed_dir / "two_lines.csv", 'id,"t\n"\n1,a\n')                         # a name over two lines: another column
    write(feed_dir / "good.csv", "\n  \nid,t\n1,a\n")
    (feed_dir / "broken.csv.gz").write_bytes(b"\x1f\x8b\x08\x00nonsense")
    rows, files = _land(spark, feed_dir, None)
    assert files["open.csv"][:2] == ("bad", "file ends inside a quoted value") and files["good.csv"][:2] == ("loaded", None)
    assert files["broken.csv.gz"][1].startswith("file cannot be read") and files["two_lines.csv"][0] == "loaded"
    assert [r for r in rows if r[0] == "good.csv"] == [("good.csv", 1, "a")]


def test_first_record_at_any_length_read(spark):
    import csv
    import random

    from flatland.sources.files import first_record
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice(['a', ',', '"', '""', '\n', '\r', '\r\n', ' ']) for _ in range(rng.randint(0, 12)))
        try:
            whole = first_record(text, ",", True)
        except ValueError:
            whole = "open"
        for n in range(len(text)):
            part = first_record(text[:n], ",", False)
            assert part is None or part == whole, (text, n)
        if whole != "open" and whole[0] is not None and '"' not in text:
            assert next(r for r in csv.reader(text.splitlines(keepends=True)) if "".join(r).strip() or len(r) > 1) == whole[0].split(",")


def test_small_splits_are_walked_by_few_tasks(spark, feed_dir):
    from flatland.sources.quoted import TASKS_PER_CORE, _lines, scan_lines
    from flatland.session import split_session
    path = write(feed_dir / "docs.csv", "id,text\n" + "".join(f'{i},"a{i}\nb"\n' for i in range(2000)))
    lines = _lines(split_session(spark, 64), [str(path)], "\n", 64)
    n = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert lines.rdd.getNumPartitions() == n
    assert lines.select("block").distinct().count() > 10 * n         # the splits stay as small as they were
    scan = scan_lines(spark, [str(path)], str(feed_dir / "out"), 64)
    assert scan.line_counts().first()["raw_records"] == 4000


def test_a_large_table_is_written_by_its_own_splits(spark, tmp_path):
    from flatland.sources.writers import write_delimited
    n = spark.sparkContext.defaultParallelism + 3
    many = write_delimited(spark, spark.range(0, 500, 1, n), str(tmp_path / "many"), "ids", n_files=2, at_least=True)
    few = write_delimited(spark, spark.range(0, 500, 1, 1), str(tmp_path / "few"), "ids", n_files=2, at_least=True)
    exact = write_delimited(spark, spark.range(0, 500, 1, n), str(tmp_path / "exact"), "ids", n_files=2)
    assert (len(many), len(few), len(exact)) == (n, 2, 2)
    for paths in (many, few, exact):
        assert sorted(int(r["id"]) for r in spark.read.option("header", True).csv(paths).collect()) == list(range(500))
