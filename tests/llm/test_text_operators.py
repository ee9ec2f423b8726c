"""Line dedup, pseudonyms, n-gram join and decontamination: brute force, round trips, odd inputs."""

from __future__ import annotations

import datetime
import os
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flatland.llm import components, decontaminate, line_dedup, ngram_join, pii_feistel, words

WORDS = [f"w{i}" for i in range(40)]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Line dedup ------------------------------------------------------------------------------------------------------------

def brute_lines(rows):
    """Texts after dedup; rows are (id, text) with ids of their own."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        if text is None:
            out[i] = (None, 0)
            continue
        lines = text.split("\n")
        place = [n for n, x in enumerate(lines) if x.strip(" \t\r\x0b\x0c")]
        gone = set()
        for a, _, c in zip(place, place[1:], place[2:]):
            key = tuple(lines[n].strip(" \t\r\x0b\x0c") for n in range(a, c + 1) if n in place)
            if key in seen:
                gone.update(range(a, c + 1))
            seen.add(key)
        out[i] = ("\n".join(x for n, x in enumerate(lines) if n not in gone), len(gone))
    return out


def test_line_dedup(spark):
    rng = random.Random(1)
    lines = [" ".join(rng.choice(WORDS) for _ in range(5)) for _ in range(30)]
    rows = [(0, None), (1, ""), (2, "\n\n"), (3, "a\nb"), (4, "x\n" * 50), (5, " x \r\nx\n\n\tx"), (6, "é\n日\n😀\né\n日\n😀"), (7, "l\n" * 30_000)]
    for i in range(60):
        at = rng.randrange(25)
        rows.append((10 + i, "\n".join([*lines[at:at + rng.randint(1, 5)], *(rng.choice(lines + ["", "  "]) for _ in range(rng.randint(0, 8)))])))
    frame = spark.createDataFrame([(i, t, "own", 3) for i, t in rows], "doc_id long, text string, version string, n_removed int").repartition(7)
    got = line_dedup.dedup_lines(frame)
    assert got.columns == ["doc_id", "text", "version", "n_removed"]
    assert {r.doc_id: (r.text, r.n_removed) for r in got.collect()} == brute_lines(rows)


def test_line_dedup_of_repeated_rows(spark):
    text = "one\ntwo\nthree"
    rows = [(None, text), (1, text), (1, text), (1, "other\n" + text), (2, text + "\nfour")]
    got = Counter((r.doc_id, r.text) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter({(None, text): 1, (1, ""): 2, (1, "other"): 1, (2, "four"): 1})
    same = spark.createDataFrame([(5, text)] * 4, "doc_id long, text string")
    assert {r.n_removed for r in line_dedup.dedup_lines(same).collect()} == {0}
    assert line_dedup.dedup_lines(same.limit(0)).count() == 0


# Pseudonyms ------------------------------------------------------------------------------------------------------------

KEY = b"k" * 16
PERSONAL = {
    "card": ["4111111111111111", "5500 0055 5555 5559", "378282246310005"], "ip": ["192.168.0.1", "8.8.8.8"], "ssn": ["123-45-6789"],
    "date": ["2024-02-29", "12/25/1999", "3/7/2001", "31.12.2050"], "phone": ["+1 (017) 555-7713", "+49 30 1234567", "(212) 555-0100", "212-555-0199"],
    "iban": ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"], "email": ["jane.doe42@mail7.example.com", "x@y.org"],
}
CLEAN = ["4111111111111112", "999.1.1.1", "1.2.3", "2024-02-30", "13/13/2000", "000-12-3456", "GB00 WEST 1234 5698 7654 32", "12345", "3.14159", "@home a@b",
         "token 24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "1,234,567.89", "v1.2.3.4.5", "0000000000000000"]


@pytest.mark.parametrize("kind", sorted(PERSONAL))
def test_pseudonyms_keep_format(kind):
    replace, undo = pii_feistel.Pseudonyms(KEY), pii_feistel.Pseudonyms(KEY, undo=True)
    for value in PERSONAL[kind]:
        text, counts = replace(f"Ünd {value}, then; {value}. end")
        assert counts == {kind: 2} and value not in text
        new = re.fullmatch(r"Ünd (.+), then; (.+)\. end", text)
        assert new[1] == new[2]                                         # equal values stay linked
        if kind != "ip":
            assert re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", new[1].split("@")[0]))) == re.sub(
                r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", value.split("@")[0])))
        assert replace(new[1])[1] == {kind: 1}                          # valid again
        assert undo(text)[0] == f"Ünd {value}, then; {value}. end"
        assert pii_feistel.Pseudonyms(b"other")(value)[0] != new[1]


SWALLOWED = ["BE68 5390 0754 7034 EUR 50", "BE68 5390 0754 7034 IBAN", "4111 1111 1111 1111 123", "2024-01-05T10:00:00", "de89370400440532013000",
             "12 4111 1111 1111 1111", "1234 5500-0055-5555-5559", "XX00 GB82 WEST 1234 5698 7654 32 99", "tel +49 30 1234567 8", "on 1.2.2024 10.0.0.1"]


@pytest.mark.parametrize("text", SWALLOWED)
def test_values_beside_others_are_found(text):
    replace, undo = pii_feistel.Pseudonyms(KEY), pii_feistel.Pseudonyms(KEY, undo=True)
    new, counts = replace(text)
    assert sum(counts.values()) >= 1 and undo(new)[0] == text
    # No part of the old text that is a valid value, by itself, is left in the new one where it stood.
    for a in range(len(text)):
        for b in range(a + 8, len(text) + 1):
            part = text[a:b]
            if (a and text[a - 1].isalnum()) or (b < len(text) and text[b].isalnum() and text[b] != "T"):
                continue
            if any(p.fullmatch(part) and replace.value(kind, part) for kind, p in pii_feistel._EACH.items()):
                assert new[a:b] != part


@pytest.mark.parametrize("spellings", [
    ["2024-01-05", "1/5/2024", "01/05/2024", "5.1.2024", "05.01.2024"], ["2024-03-25", "25/03/2024", "3/25/2024", "25.3.2024"],
    ["4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111"], ["+49 30 1234567", "+49-30-1234567", "+49.30.1234567", "+49301234567"],
    ["212-555-0199", "212.555.0199", "(212) 555-0199"], ["DE89370400440532013000", "de89370400440532013000", "DE89 3704 0044 0532 0130 00"],
    ["Jane.Doe@Mail.org", "jane.doe@mail.org", "JANE.DOE@mail.ORG"],
])
def test_one_value_in_several_spellings_stays_linked(spellings):
    replace, undo = pii_feistel.Pseudonyms(KEY), pii_feistel.Pseudonyms(KEY, undo=True)

    def plain(s):
        day = pii_feistel.Pseudonyms._day(s) if re.fullmatch(r"[\d./-]{8,10}", s) and re.search(r"\d{4}$|^\d{4}-\d\d-", s) and len(re.findall(r"\d", s)) <= 8 else None
        return day[0] if day else re.sub(r"[ .()-]", "", s).lower() if "@" not in s else s.lower()

    new = [replace(s)[0] for s in spellings]
    assert len({plain(n) for n in new}) == 1 and plain(new[0]) != plain(spellings[0])
    assert [undo(n)[0] for n in new] == spellings


def test_round_trip_of_random_texts():
    rng = random.Random(8)
    replace, undo = pii_feistel.Pseudonyms(KEY), pii_feistel.Pseudonyms(KEY, undo=True)
    values = [v for own in PERSONAL.values() for v in own] + CLEAN + SWALLOWED
    for _ in range(400):
        card = "".join(str(rng.randint(0, 9)) for _ in range(rng.choice([15, 16, 18])))
        card += pii_feistel.luhn_digit(card)
        text = rng.choice([" ", ", ", "\n", " - "]).join(rng.choice([*values, card, " ".join(card[i:i + 4] for i in range(0, len(card), 4))]) for _ in range(4))
        assert undo(replace(text)[0])[0] == text


def test_clean_text_stays():
    replace = pii_feistel.Pseudonyms(KEY)
    for text in [*CLEAN, " ".join(CLEAN), None, "", "no digits here", "1" * 100_000, "a@" * 50_000, "1.1." * 30_000]:
        assert replace(text) == (text, {})


@pytest.mark.parametrize("size", [1, 2, 3, 7, 10, 64, 100, 1000, 73_049 // 50])
def test_permutation_is_one(size):
    p = pii_feistel.Permutation(KEY, "t", size)
    image = [p(x) for x in range(size)]
    assert sorted(image) == list(range(size)) and [p(y, undo=True) for y in image] == list(range(size))
    assert size == 1 or all(x != y for x, y in enumerate(image))


def test_dates_are_permuted_within_their_format():
    replace = pii_feistel.Pseudonyms(KEY)
    days = [datetime.date(2000, 1, 1) + datetime.timedelta(n) for n in range(3000)]
    assert len({replace.value("date", d.isoformat()) for d in days}) == len(days)


def test_pseudonymise_rows(spark):
    rows = [(1, None), (1, "x 4111111111111111 y"), (None, "4111111111111111"), (2, ""), (3, "4111111111111111 " * 5000)]
    frame = spark.createDataFrame([(i, t, "own") for i, t in rows], "doc_id long, text string, kinds string")
    got = pii_feistel.pseudonymise(frame, KEY).collect()
    new = got[2].text
    assert [(r.doc_id, r.text, r.n_replaced) for r in got] == [(1, None, 0), (1, f"x {new} y", 1), (None, new, 1), (2, "", 0), (3, f"{new} " * 5000, 5000)]
    back = pii_feistel.pseudonymise(pii_feistel.pseudonymise(frame, KEY), KEY, undo=True).collect()
    assert [r.text for r in back] == [t for _, t in rows]
    assert pii_feistel.pseudonymise(frame.limit(0), KEY).count() == 0


# N-gram join -----------------------------------------------------------------------------------------------------------

def token_set(text, size):
    own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(own[i:i + size]) for i in range(max(1, len(own) - size + 1))) if own else frozenset()


def brute_components(rows, size, percent):
    sets = [(i, token_set(t, size)) for i, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return Counter((i, len(s), None if i is None else top(i)) for i, s in sets)


def families(rng, n, length, edits):
    """Copies of a few texts with random word edits, so similarities lie around the threshold."""
    bases = [[rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(length)] for _ in range(6)]
    rows = []
    for i in range(n):
        own = list(rng.choice(bases))
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(len(own))] = rng.choice(WORDS)
        if rng.random() < 0.3:
            own += ["common", "passage"] * rng.randint(1, 8)
        rows.append((i, rng.choice([" ", "\n", "  "]).join(own).replace("w1", rng.choice(["w1", "W1"]))))
    return rows


@pytest.mark.parametrize("size,percent,length,edits", [(3, 90, 60, 3), (5, 80, 40, 3), (1, 50, 12, 6), (3, 100, 20, 1), (2, 70, 8, 3)])
def test_components_equal_brute_force(spark, size, percent, length, edits):
    rng = random.Random(size * percent)
    rows = families(rng, 220, length, edits)
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "a"), (504, "A"), (505, "a b"), (3, rows[40][1]), (3, rows[40][1]), (7, rows[7][1]), (None, rows[7][1]), (None, None)]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n string").repartition(6)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.link_documents(frame, size, percent).collect())
    assert got == brute_components(rows, size, percent)


def test_large_groups_are_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 7)
    rows = families(random.Random(5), 150, 50, 4)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect())
    assert got == brute_components(rows, 3, 85)


def test_hot_tokens_are_kept_apart(spark, monkeypatch):
    rows = families(random.Random(9), 150, 50, 4)
    for threshold in (1, 40, 100):
        monkeypatch.setattr(ngram_join, "hot_count", lambda counts, t=threshold: t)
        got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect())
        assert got == brute_components(rows, 3, 85)


def test_join_of_nothing(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.link_documents(frame, 3, 90).count() == 0


def test_the_matrix_steps_plan_stays_small(spark, monkeypatch):
    """The driver holds each plan; what several steps use is in it once."""
    seen, by_block = [], ngram_join._by_block

    def counted(frame, *a):
        seen.append(frame._jdf.queryExecution().executedPlan().toString().count("Exchange "))
        return by_block(frame, *a)
    monkeypatch.setattr(ngram_join, "_by_block", counted)
    rows = [(k, " ".join(f"w{(k // 2) * 7 + i}" for i in range(30 + k % 2))) for k in range(20)]
    got = ngram_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == {k: k // 2 * 2 for k in range(20)}
    assert len(seen) == 2 and max(seen) <= 20, seen


def shuffle_files(spark) -> dict[str, int]:
    """Bytes of the shuffle files that this session's block manager holds."""
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f: os.path.getsize(f) for f in found if re.search(r"/shuffle_\d+_\d+_\d+[.]data$", f) and os.path.exists(f)}


def test_shuffle_files_of_the_ngram_join_go_with_their_step(spark):
    """Texts are shuffled several times; what is read no more is not left for the driver's garbage collection."""
    rows = families(random.Random(15), 1500, 200, 8)
    frame = spark.createDataFrame(rows, "doc_id long, text string").checkpoint()
    before = shuffle_files(spark)
    ngram_join.link_documents(frame, 3, 90)
    for _ in range(50):                 # files are deleted in the background
        left = sum(size for f, size in shuffle_files(spark).items() if f not in before)
        if left < 200_000:
            break
        time.sleep(0.1)
    assert left < 200_000 < sum(len(t) for _, t in rows) / 5, left


def test_copies_for_blocks_are_dealt_in_rounds(spark, monkeypatch):
    """Texts that go to several blocks each are not all shuffled at once."""
    frames, keep = {}, ngram_join._Scratch.keep

    def counted(self, name, *a):
        frames[name] = len(a)
        return keep(self, name, *a)
    monkeypatch.setattr(ngram_join._Scratch, "keep", counted)
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 7)
    rows = families(random.Random(5), 150, 50, 4) + [(3, "a b c d"), (None, "a b c d")]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect())
    assert got == brute_components(rows, 3, 85)
    assert frames["links"] == 3 and frames["more"] > 1 and frames["candidates"] == 1, frames


def test_words_of_random_bytes():
    rng = random.Random(8)
    texts = ["".join(rng.choice("aAbB é日\t\n\x0b\x00.,x") for _ in range(rng.randint(0, 50))) for _ in range(300)] + ["", "z" * 3_000_000]
    seen: dict[int, str] = {}
    for column in (pa.array(texts), pa.array(["skip", *texts, None]).slice(1)):
        for first, last, found in words.iter_words(column):
            for i in range(first, last):
                own = re.findall(r"[^\x20\x09-\x0D]+", ((column[i].as_py()) or "").translate(LOWER))
                lo, hi = found.bounds[i - first], found.bounds[i - first + 1]
                assert hi - lo == len(own)
                for w, h in zip(own, found.hashes[lo:hi].tolist()):
                    assert seen.setdefault(h, w) == w
    assert len(set(seen.values())) == len(seen)


def test_connected_components(spark):
    rng = random.Random(2)
    links = [(a, a + 1) for a in range(0, 60)] + [(100 + rng.randrange(80), 100 + rng.randrange(80)) for _ in range(50)] + [(500, 500 + i) for i in range(40)] + [(9, 9)]
    up = defaultdict(set)
    for a, b in links:
        up[a].add(b)
        up[b].add(a)
    want = {}
    for x in up:
        group, todo = {x}, [x]
        while todo:
            for y in up[todo.pop()] - group:
                group.add(y)
                todo.append(y)
        if len(group) > 1:
            want[x] = min(group)
    got = components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


# Decontamination -------------------------------------------------------------------------------------------------------

def norm(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower())


def brute_distance(item, text):
    """Least word edits between the item and any run of the text."""
    cost = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(text, 1):
            new.append(min(cost[j - 1] + (w != v), cost[j] + 1, new[-1] + 1))
        cost = new
    return min(cost)


def test_contamination_equals_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"{a}{b}" for a in ("than", "er", "ou", "été", "Straße", "to") for b in ("", "ing", "ed", "x", "7")]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(rng.randint(3, 45)))) for i in range(25)] + [(90, None), (91, ""), (92, "one two"), (3, "An item with the id of another one, it is."), (None, "Items without an id are items like all others are.")]
    rows = [(0, None), (1, ""), (2, "one two"), (3, "."), (4, "an ITEM with the id of another -- one it is")]
    for i in range(250):
        own = text(rng.randint(0, 60))
        if i % 2:
            item = norm(rng.choice(items[:25])[1])
            for _ in range(rng.randint(0, max(1, len(item) // 4))):
                at = rng.randrange(len(item) + 1)
                if rng.random() < 0.6 and at < len(item):
                    item[at] = "odd" + str(rng.randrange(99))
                elif rng.random() < 0.5 and at < len(item):
                    del item[at]
                else:
                    item.insert(at, "more")
            own[rng.randrange(len(own) + 1):0] = item
        rows.append((10 + i, " ".join(w.upper() if rng.random() < 0.1 else w + rng.choice(["", ",", ".", "!\n"]) for w in own)))
    rows += [rows[-1], (11, None)]
    got = decontaminate.find_contamination(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, distance string"),
                                           spark.createDataFrame(items, "item_id long, text string")).collect()
    want = Counter()
    for i, t in rows:
        best = {}
        for n, item in items:
            w = norm(item)
            if len(w) >= decontaminate.LEAST_WORDS:
                if (d := brute_distance(w, norm(t))) <= int(decontaminate.EDITS * len(w)):
                    best[n] = min(best.get(n, d), d)
            elif len(w) >= decontaminate.LEAST_EXACT and f" {' '.join(w)} " in f" {' '.join(norm(t))} ":
                best[n] = 0
        want.update((i, n, d) for n, d in best.items())
    mine = Counter((r.doc_id, r.item_id, r.distance) for r in got)
    assert not mine - want                                              # nothing clean is reported
    assert sum((mine & want).values()) >= 0.97 * sum(want.values())    # target recall of the sampling
    kept = decontaminate.without_contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    dirty = {(r.doc_id) for r in got}
    assert Counter(kept.collect()) == Counter(r for r in spark.createDataFrame(rows, "doc_id long, text string").collect()
                                              if r.doc_id not in dirty or r.text is None)


def test_contamination_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(docs, none).count() == 0
    assert decontaminate.without_contaminated(docs, none).count() == 1
    item = spark.createDataFrame([(1, "A b, c d: e f g h")], "item_id long, text string")
    assert decontaminate.find_contamination(docs.limit(0), item).count() == 0
    assert [(r.doc_id, r.item_id, r.word, r.distance) for r in decontaminate.find_contamination(docs, item).collect()] == [(1, 1, 0, 0)]


def test_benchmark_in_blocks(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    whole = Counter(decontaminate.find_contamination(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 7)
    assert Counter(decontaminate.find_contamination(docs, bench).collect()) == whole


def test_edit_distance_of_runs():
    rng = random.Random(3)
    for _ in range(300):
        item, run = ([rng.randrange(5) for _ in range(rng.randint(1, 8))] for _ in range(2))
        d, begin = decontaminate.edit_distance(np.array(item), np.array(run))
        assert d == brute_distance(item, run) and 0 <= begin <= len(run)
        assert brute_distance(item, run[begin:]) == d


def test_sampling_reaches_its_target():
    """Copies edited up to the limit are candidates with the target recall."""
    items = decontaminate.prepare_items([(i, " ".join(f"v{i}x{j}" for j in range(20 + i))) for i in range(20)])
    rng = np.random.default_rng(11)
    hit = total = 0
    for n, own in enumerate(items.words):
        for _ in range(20):
            copy = own.copy()
            copy[rng.choice(len(copy), items.edits[n], replace=False)] = rng.integers(1 << 62, size=items.edits[n])
            found = decontaminate.find_items(items, np.concatenate((copy, own[:0])), np.array([0, len(copy)]))
            hit += (0, n) in found
            total += 1
    assert hit >= 0.97 * total


def test_columns_with_clashing_names(spark):
    frame = spark.createDataFrame([(1, "a b c d e f g h i j", "x", "y", "z", 1)], "doc_id long, text string, row string, score string, component_id string, difference int")
    assert ngram_join.link_documents(frame, 3, 90).columns == ["doc_id", "n_shingles", "component_id"]
    assert line_dedup.dedup_lines(frame).columns == [*frame.columns, "n_removed"]
    bench = spark.createDataFrame([(1, "other words than those of the text")], "item_id long, text string").withColumn("row", F.lit(1))
    assert decontaminate.without_contaminated(frame, bench).collect() == frame.collect()


SHORT = [(1, "What is the capital city?"), (2, "\u6771\u4eac\u306f\u65e5\u672c\u306e\u9996\u90fd\u3067\u3059\u3002\u4eba\u53e3\u306f\u3044\u304f\u3064\u3067\u3059\u304b\u3002"), (3, "Yes"), (4, "two words"), (None, "Is it so?")]


def test_items_too_short_for_windows_are_looked_up(spark):
    ja = SHORT[1][1]
    texts = [(1, "He asked: what is -- the CAPITAL city... of it"), (2, "\u524d\u6587\u3002" + ja + "\u5f8c"), (3, "yes, two words of no item"), (4, "what is the capital cityscape"),
             (5, None), (6, ""), (None, "so is it so? is it so"), (8, ja[:-4])]
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(SHORT + SHORT[:1], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.word, r.distance) for r in decontaminate.find_contamination(docs, bench).collect()}
    assert got == {(1, 1): (2, 0), (2, 2): (0, 0), (None, None): (1, 0)}
    left = decontaminate.without_contaminated(docs, bench)
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 6, 8]


def test_sampling_reaches_its_target_on_long_items():
    """Inserts, deletes and replacements, spread and bunched, in items of up to 400 words."""
    rng = random.Random(12)
    found = total = 0
    for m in (60, 150, 400):
        item = [f"w{rng.randint(0, 10**6)}" for _ in range(m)]
        items = decontaminate.prepare_items([(1, " ".join(item))])
        for trial in range(12):
            copy, k = list(item), int(decontaminate.EDITS * m)
            at = rng.randint(0, m // 2)
            for _ in range(k):
                place = min(len(copy) - 1, at + rng.randint(0, 2 * k) if trial % 2 else rng.randint(0, len(copy) - 1))
                kind = rng.randint(0, 2)
                if kind == 0:
                    copy[place] = f"x{rng.randint(0, 10**9)}"
                elif kind == 1:
                    copy.insert(place, f"y{rng.randint(0, 10**9)}")
                else:
                    del copy[place]
            text = " ".join([f"b{i}" for i in range(30)] + copy + [f"a{i}" for i in range(30)])
            words = decontaminate.prepare_items([(1, text)], least_words=1).words[0]
            total += 1
            found += bool(decontaminate.find_items(items, words, np.array([0, len(words)])))
    assert found >= 0.97 * total
