"""Quality classifier, language ID and packing: held-out accuracy, brute force, odd inputs."""

from __future__ import annotations

import itertools
import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from flatland.llm import language_id, packing, quality_zstd

SF = "/root/testdata/sf0.01"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ODD = [(1, None), (2, ""), (None, "word"), (2, ""), (3, "1234 !?"), (4, "ab " * 200_000), (5, "\x00 \n\t" * 10), (6, "日本語")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in ODD], "doc_id long, text string, score string")


def test_quality_held_out(spark, odd):
    documents, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_zstd.train_quality(documents, labels)
    rows = quality_zstd.score_quality(documents, model).join(labels, "doc_id").where("held_out").toPandas()
    good, bad = rows[rows.quality == 1].score.to_numpy(), rows[rows.quality == 0].score.to_numpy()
    assert len(good) and len(bad) and (good[:, None] > bad).mean() > 0.9
    got = quality_zstd.score_quality(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got] == [zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 0 for i, _ in ODD]
    assert len({r.score for r in got if r.doc_id == 2 or r.doc_id == 1}) == 1


def test_quality_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1), (5, 1), (None, 0), (4, None), (99, 1)], "doc_id long, quality int")
    for labels, score in ((none, 0.5), (one, 1.0)):
        model = quality_zstd.train_quality(odd, labels)
        assert {round(r.score, 6) for r in quality_zstd.score_quality(odd, model).collect()} == {score}
    assert quality_zstd.score_quality(odd.limit(0), model).count() == 0


def test_curve_is_monotone():
    x = np.array([-0.2, -0.1, 0.0, 0.1, 0.2, 0.3])
    slope, offset = quality_zstd.fit_curve(x, np.array([0, 0, 1, 0, 1, 1]))
    assert slope > 0 and np.isfinite([slope, offset]).all()


def test_steps_rise():
    rng = np.random.default_rng(1)
    x = rng.normal(size=500)
    y = (rng.random(500) < 1 / (1 + np.exp(-8 * x))).astype(float)
    at, share = quality_zstd.fit_steps(x, y, np.ones(500), 1 / (1 + np.exp(-8 * x)))
    assert list(at) == sorted(at) and list(share) == sorted(share) and 0 < share[0] < 0.1 and 0.9 < share[-1] < 1
    model = quality_zstd.QualityModel(b"g", b"b", 1.0, 0.0, at, share)
    got = quality_zstd.scores(np.linspace(-5, 5, 1000), model)
    assert (np.diff(got) > 0).all() and got[0] > 0 and got[-1] < 1


def test_language_held_out(spark, odd):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train_languages(documents)
    rows = language_id.predict_languages(documents, model).join(documents, "doc_id").where("held_out").toPandas()
    assert (rows.lang == rows.lang_pred).mean() > 0.97
    got = language_id.predict_languages(odd, model).collect()
    assert [r.lang_pred == "und" for r in got] == [True, True, False, True, True, False, True, False]
    assert all(0 <= r.score <= 1 for r in got)


def test_language_backs_off_by_length():
    model = language_id.LanguageModel(["a", "b"], [0.5, 0.5], {"known": 0}, np.array([[-1.0, -2.0]]), {"xyz": 0, "y": 1}, np.array([[-9.0, -1.0], [-1.0, -9.0]]))
    predict = language_id.Predictor(model)
    assert predict("Known")[0] == "a"
    assert predict("qxyzq")[0] == "b"           # the longest known n-gram
    assert predict("ydd")[0] == "a"             # only a single sign is known
    assert predict("ööö") == ("a", 0.5)


def test_language_without_rows(spark, odd):
    model = language_id.train_languages(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in language_id.predict_languages(odd, model).collect()} == {("und", 0.0)}


def fewest(lengths, capacity):
    """Fewest sequences by trying all ways to put each piece."""
    best = len(lengths)

    def go(at, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if at == len(lengths):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + lengths[at] <= capacity:
                bins[i] += lengths[at]
                go(at + 1, bins)
                bins[i] -= lengths[at]
        go(at + 1, [*bins, lengths[at]])

    go(0, [])
    return best


def test_plan_is_optimal_on_small_sets():
    rng = random.Random(2)
    for _ in range(80):
        capacity = rng.randint(8, 40)
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        plan = packing.plan_packing(dict(Counter(lengths)), capacity)
        used = Counter()
        for filling, times in plan.fillings:
            assert sum(x * n for x, n in filling.items()) <= capacity
            for x, n in filling.items():
                used[x] += n * times
        assert used == Counter(lengths)
        assert packing.lower_bound(dict(Counter(lengths)), capacity) <= fewest(lengths, capacity) == plan.sequences


def test_plan_reaches_the_bound_with_every_length():
    capacity = 2048
    lengths = np.maximum(1, np.random.default_rng(1).lognormal(5.6, 1.1, 1_000_000).astype(int))
    first = np.where(lengths % capacity, lengths % capacity, capacity)
    counts = Counter(first.tolist()) + Counter({capacity: int(((lengths - first) // capacity).sum())})
    bound = packing.lower_bound(counts, capacity)
    assert len(counts) == capacity and packing.best_fit(counts, capacity).sequences > bound
    plan = packing.plan_packing(counts, capacity)
    used = Counter()
    for filling, times in plan.fillings:
        assert sum(x * n for x, n in filling.items()) <= capacity
        used.update({x: n * times for x, n in filling.items()})
    assert used == counts and plan.sequences == bound


def all_fillings(counts, space):
    lengths = sorted(counts)

    def go(at, left, have):
        if at == len(lengths):
            yield dict(have)
            return
        x = lengths[at]
        for n in range(min(counts[x], left // x) + 1):
            yield from go(at + 1, left - n * x, {**have, x: n} if n else have)
    return list(go(0, space, {}))


def test_completions_are_undominated_and_waste_least():
    rng = random.Random(9)

    def used(f):
        return sum(x * n for x, n in f.items())

    def better(f, counts, space):
        """An exchange of one length for one longer, or of some for one as long or longer, that still fits."""
        pieces = [x for x, n in f.items() for _ in range(n)]
        for k in range(1, len(pieces) + 1):
            for part in itertools.combinations(pieces, k):
                for y, n in counts.items():
                    if n > f.get(y, 0) and sum(part) <= y <= sum(part) + space - used(f) and (k > 1 or y > part[0]):
                        return True
        return False

    for _ in range(300):
        counts = dict(Counter(rng.randint(1, 14) for _ in range(rng.randint(1, 8))))
        space = rng.randint(0, 30)
        got, _ = packing.completions(counts, sorted(counts, reverse=True), space, 3)
        every = all_fillings(counts, space)
        assert all(f in every for f in got) and space - used(got[0]) == min(space - used(f) for f in every)
        for f in got:
            assert not better(f, counts, space), (counts, space, f)


@pytest.mark.parametrize("low, high, n, most", [(520, 689, 30_000, 10_000), (500, 759, 5_000, 1_645), (300, 700, 20_000, 4_900)])
def test_search_is_bounded_by_its_work(low, high, n, most):
    rng = random.Random(1)
    counts = Counter(rng.randint(low, high) for _ in range(n))
    start = time.process_time()
    plan = packing.plan_packing(dict(counts), 2048)
    assert time.process_time() - start < 10 and plan.sequences <= most
    used = Counter()
    for filling, times in plan.fillings:
        used.update({x: k * times for x, k in filling.items()})
    assert used == counts


def packed_ok(rows, capacity):
    for _, own in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in own:
            assert r.offset == at
            at += r.length
        assert at <= capacity


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pack(spark, odd, capacity):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(VOCABULARY)
    whole.encode_special_tokens = True
    rows = packing.pack_documents(odd, VOCABULARY, capacity).collect()
    packed_ok(rows, capacity)
    want = Counter()
    for i, t in ODD:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        for n, a in enumerate([0, *range(first, len(ids), capacity)]):
            b = first if n == 0 else a + capacity
            want[i, n, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert packing.pack_documents(odd.limit(0), VOCABULARY, capacity).count() == 0


def test_pack_documents_near_the_bound(spark):
    rows = packing.pack_documents(spark.read.parquet(f"{SF}/documents.parquet"), VOCABULARY).collect()
    packed_ok(rows, 2048)
    bound = packing.lower_bound(dict(Counter(r.length for r in rows)), 2048)
    assert len({r.sequence_id for r in rows}) <= bound + 2


def test_fast_ids_equal_the_tokenizers_library():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(VOCABULARY)
    whole.encode_special_tokens = True
    fast = packing.ByteTokenizer(VOCABULARY)
    rng = random.Random(4)
    signs = "ab  \n\t'sßé漢😀\x00\x7f<|endoftext|>0123‍ .-"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(400)] + ["", " " * 1_200_000, "a" * 50_000, "<|endoftext|>"]
    for t in texts:
        assert fast(t).tolist() == whole.encode(t, add_special_tokens=False).ids


def test_most_frequent_items_are_chosen_without_a_join(spark):
    """Of items with the last count those with the smallest hashes are taken; no join pairs rows by their counts."""
    rows = [(lang, f"w{i}", i % 3 + 1) for lang in ("de", 'x"y') for i in range(40)] + [("fr", "seul", 1)]
    counts = spark.createDataFrame(rows, "lang string, item string, n long")
    got = language_id._most_frequent(counts, 20, ["lang"])
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    draw = {r["item"]: r["h"] for r in counts.select("item", F.xxhash64("item").alias("h")).collect()}
    want = {r for lang in ("de", 'x"y', "fr") for r in sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[2], draw[r[1]]))[:20]}
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
