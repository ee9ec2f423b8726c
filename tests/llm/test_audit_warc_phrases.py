"""Filter audit, WARC archives and collocations: brute force, round trips and odd inputs."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from flatland.llm import collocations, filter_audit, warc
from flatland.session import new_run_dir

# Filter audit ----------------------------------------------------------------

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def fails(rows):
    out = []
    for i, text, _ in rows:
        text = text or ""
        words = WORDS.findall(text)
        out.append({f for f, bad in (
            ("A", len(words) < 100), ("B", 100 * len(set(words)) < 80 * len(words)),
            ("C", 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text)), ("D", any(c in "#$%&*|" for c in text)),
            ("E", i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows))) if bad})
    return out


def audit(rows, labels):
    """The contract, step by step, for every order."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    bad = fails(rows)
    out = {}
    for part in {p or "" for _, _, p in rows}:
        own = [(r[0], b) for r, b in zip(rows, bad) if (r[2] or "") == part]
        total = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = list(own)
            for n, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                failing = sum(f in b for _, b in own)
                left = [d for d in left if f not in d[1]]
                total[f] += len(gone)
                out[part, order, n] = [len(left), len(gone), failing - len(gone), sum(b == {f} for _, b in own),
                                       sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, order, n), row in out.items():
            if p == part:
                row.append(total[order[n - 1]])
    return out


def odd_documents(seed, n=120):
    rng = random.Random(seed)
    long = " ".join(f"w{i}" for i in range(120))
    texts = [None, "", " \t\n", "AB cd", long, long + " #", long.upper(), "same " * 150, "é" * 50 + " Ä", "a\x1cb " * 101, long + " w1" * 40, "x" * 300_000]
    rows = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice([None, "", "en", "de"])) for _ in range(n)]
    return rows + rows[:3]


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_every_order_step_by_step(spark, seed):
    rows = odd_documents(seed)
    rng = random.Random(seed)
    labels = [(rng.choice([None, *range(40)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(40)]
    documents = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, lang string, part string, mask int")
    got = filter_audit.audit_filters(documents, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    want = audit(rows, labels)
    assert len(got) == len(want) == 600 * len({r[2] or "" for r in rows})
    assert {(r.part, r.filter_order, r.step): list(r[3:]) for r in got} == want


def test_potentials_are_those_of_the_game(spark):
    rng = random.Random(4)
    values = [0, *(rng.randint(0, 50) for _ in range(31))]
    q = spark.range(1).select(filter_audit.potentials(F.array(*[F.lit(v).cast("long") for v in values])).alias("q")).first()["q"]
    total = Counter()
    for order in permutations(range(5)):
        before = 0
        for i in order:
            total[i] += values[before | 1 << i] - values[before]
            before |= 1 << i
    assert [q[31] - 5 * q[31 - (1 << i)] for i in range(5)] == [total[i] for i in range(5)]


def test_audit_of_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert filter_audit.audit_filters(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


# WARC ------------------------------------------------------------------------

def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, path string, offset int")


def read_back(archives, range_bytes=warc.RANGE_BYTES):
    index = warc.index_archives(archives, range_bytes).where("warc_type IN ('response', 'revisit')")
    return index.withColumns({"page": warc.row_id(F.col("record_id")).cast("long"), "first": warc.row_id(F.col("refers_to")).cast("long")})


def odd_pages():
    rng = random.Random(6)
    inner = gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:flatland:row:99:X>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n").decode("latin-1")
    texts = ["", "<p>a</p>", "é😀\r\n\r\n", "\x1f\x8b\x08" * 50, inner, "x" * 200_000, "".join(chr(rng.randint(32, 500)) for _ in range(70_000)), None]
    rows = [(i, rng.choice([None, f"http://x.org/{i}", "odd\r\nurl: 1"]), rng.choice(texts), "clash", 3) for i in range(60)]
    return rows + [rows[0], (None, "u", "only here", "c", 1), (None, "u", "<p>a</p>", "c", 1), (10**15, "", "<p>a</p>", "c", 1)]


@pytest.mark.parametrize("least, range_bytes", [(0, 1 << 20), (0, 700), (5, 4096), (1 << 30, 97)])
def test_round_trip(spark, least, range_bytes):
    rows = odd_pages()
    archives = warc.write_archives(pages(spark, rows).repartition(3), new_run_dir(spark, "t-warc"), "page_id", "url", "html", least, archive_bytes=60_000)
    index = read_back(archives, range_bytes)
    first = {}
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        if len(data) >= least and i is not None:
            first[data] = min(first.get(data, i), i)
    want = Counter()
    for i, url, html, *_ in rows:
        data = (html or "").encode()
        revisit = data in first and i != first[data] and len(data) >= least
        want[i, " ".join((url or "").split()), len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response",
             first[data] if revisit else None] += 1
    got = index.collect()
    assert Counter((r.page, r.target_uri, r.payload_bytes, r.payload_digest, r.warc_type, r["first"]) for r in got) == want
    assert all(r.intact for r in got if r.warc_type == "response")
    bodies = warc.read_payloads(index.where("warc_type = 'response'")).collect()
    assert Counter(hashlib.sha1(b.payload).hexdigest() for b in bodies) == Counter(hashlib.sha1((r[2] or "").encode()).hexdigest() for r in rows
                                                                                 if r[0] is None and (r[2] or "").encode() not in first or r[0] is not None and first.get((r[2] or "").encode(), r[0]) == r[0])


def test_archives_are_plain_gzip_of_records(spark):
    archives = warc.write_archives(pages(spark, odd_pages()), new_run_dir(spark, "t-warc"), "page_id", "url", "html").collect()
    for a in archives:
        data = gzip.open(a.path.removeprefix("file:")).read()
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and os.path.getsize(a.path.removeprefix("file:")) == a.n_bytes
        stream, n = io.BytesIO(data), 0
        while line := stream.readline():                    # read by the format alone
            assert line == b"WARC/1.1\r\n"
            head = {}
            while (line := stream.readline()) != b"\r\n":
                key, value = line.decode().split(": ", 1) if ": " in line.decode() else (line.decode().rstrip(":\r\n"), "")
                head[key] = value.strip()
            block = stream.read(int(head["Content-Length"]))
            assert stream.read(4) == b"\r\n\r\n"
            if head["WARC-Type"] != "warcinfo":
                n += 1
                assert head["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
        assert n == a.n_records


def test_an_archive_inside_a_payload_is_no_record(spark, tmp_path):
    """Stored bytes of an inner archive lie open in the outer member; ranges begin inside it."""
    import zlib

    inner = b"".join(warc.record(str(1000 + i), "http://inner/", os.urandom(300), "1970-01-01T00:00:00Z") for i in range(40))
    head = (b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:flatland:row:7:X>\r\nContent-Type: application/gzip\r\n"
            + f"Content-Length: {len(inner)}\r\n\r\n".encode())
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    member = stored.compress(head + inner + b"\r\n\r\n") + stored.flush()
    path = tmp_path / "outer.warc.gz"
    path.write_bytes(warc.record("1", "u", b"before", "d") + member + warc.record("2", "u", b"after", "d"))
    for size in (100, 1000, 5000, 1 << 20):
        index = warc.index_archives(warc.archive_files(spark, f"{tmp_path}/*.warc.gz"), size).orderBy("offset").collect()
        assert [(r.warc_type, r.record_id.split(":")[3]) for r in index] == [("response", "1"), ("resource", "7"), ("response", "2")]
        assert index[1].payload_bytes == len(inner)


def test_damaged_members_cost_only_themselves(spark, tmp_path):
    members = [warc.record(str(i), "u", os.urandom(2000), "d") for i in range(20)]
    members[5] = members[5][:50] + b"\x00" * 200 + members[5][250:]
    members[11] = members[11][:400]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(members)[:-30])
    for size in (333, 1 << 20):
        index = warc.index_archives(warc.archive_files(spark, str(path)), size).collect()
        assert {r.record_id.split(":")[3] for r in index} == {str(i) for i in range(19)} - {"5", "11"}


def test_no_rows_and_no_archives(spark):
    archives = warc.write_archives(pages(spark, []), new_run_dir(spark, "t-warc"), "page_id", "url", "html")
    assert archives.count() == 0 and warc.index_archives(archives).count() == 0


# Collocations ----------------------------------------------------------------

def brute(rows, least, longest, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if any(100 * b >= 80 * a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def texts(seed, n=300):
    rng = random.Random(seed)
    words = [chr(97 + i) for i in range(9)] + ["É", "A", "\xa0", "\x1c", "漢", "the"]
    rows = [(" ".join(rng.choice(words[:rng.randint(2, 15)]) + rng.choice(["", "", "", "", ".", "\n", ", ", "\t"]) for _ in range(rng.randint(0, 60))),
             rng.choice([None, "und", "", "en", "de"])) for _ in range(n)]
    return rows + [(None, "en"), ("", None), (". ! ?", "xx"), ("loop " * 5000, "en"), ("the the the", "de")] + rows[:5]


@pytest.mark.parametrize("seed, least, longest, top", [(1, 3, 4, 2000), (2, 30, 4, 50), (3, 8, 3, 7), (4, 2, 2, 2000)])
def test_collocations_equal_brute_force(spark, seed, least, longest, top):
    rows = texts(seed)
    documents = spark.createDataFrame([(*r, "clash", 1) for r in rows], "text string, lang string, phrase string, n int")
    got = collocations.mine_collocations(documents.repartition(5), least, longest, top)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, least, longest, top)


def test_collocations_in_many_rounds_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SHARD", 5)
    monkeypatch.setattr(collocations, "SHARDS_AT_ONCE", 3)
    rows = texts(7, 100)
    documents = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(tuple(r) for r in collocations.mine_collocations(documents, 3).collect()) == brute(rows, 3, 4, 2000)


def test_collocations_of_nothing(spark):
    assert collocations.mine_collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert collocations.mine_collocations(spark.createDataFrame([("a b c", "en")], "text string, lang string")).count() == 0


def test_double_array_counts_like_a_table():
    rng = np.random.default_rng(3)
    for size, n, v in ((2, 1, 1), (2, 400, 30), (3, 600, 12), (4, 900, 40)):
        codes = np.unique(rng.integers(-2**62, 2**62, v + 20))
        phrases = np.unique(codes[np.minimum(rng.zipf(1.4, (n, size)) - 1, v - 1)], axis=0)
        trie = collocations.DoubleArray.build(phrases)
        text = codes[np.minimum(rng.zipf(1.2, 3000) - 1, len(codes) - 1)]
        uniq, ids = np.unique(text, return_inverse=True)
        table = Counter(tuple(text[i:i + size].tolist()) for i in range(len(text) - size + 1))
        assert trie.count(uniq, ids.astype(np.int32), size, len(phrases)).tolist() == [table[tuple(p)] for p in phrases.tolist()]
