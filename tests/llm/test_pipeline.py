"""The pipeline against brute-force stages, and the queries with SQL against DuckDB."""

from __future__ import annotations

from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from flatland.llm import decontaminate, quality_zstd, queries
from tests.llm.test_models_and_packing import packed_ok
from tests.llm.test_text_operators import brute_components, brute_lines
from tests.test_queries import TABLES, norm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    at = [cols.index(c) for c in df.columns]
    assert Counter(tuple(norm(x) for x in r) for r in df.collect()) == Counter(tuple(norm(r[i]) for i in at) for r in res.fetchall())


def test_pipeline_equals_brute_force(spark):
    table = {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark")}
    docs, rows = table["documents"], {r.doc_id: r.text for r in table["documents"].collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == table["documents"].columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    model = quality_zstd.train_quality(table["documents"], table["labels"])
    difference = quality_zstd.Difference(model)
    want = {i: t for i, t in rows.items() if quality_zstd.curve(difference(t), model) >= 0.3}
    assert kept["good_quality"] == want     # too few labels at this size to reject much
    cut = brute_lines(list(want.items()))
    want = {i: t for i, (t, n) in cut.items() if not n or t.strip()}
    assert kept["line_windows"] == want
    want = {i: want[i] for i, _, c in brute_components(list(want.items()), 5, 80) if i == c}
    assert kept["near_duplicates"] == want
    items = decontaminate.prepare_items([tuple(r) for r in table["benchmark"].select("item_id", "text").collect()])
    clean = {}
    for i, t in want.items():
        own = decontaminate.prepare_items([(i, t)], least_words=1).words
        if not own or all(decontaminate.edit_distance(w, own[0])[0] > k for w, k in zip(items.words, items.edits)):
            clean[i] = t
    assert kept["no_benchmarks"] == clean
    out = corpus_pipeline.run(spark, SF).collect()
    packed_ok(out, 2048)
    assert {r.doc_id for r in out} == set(clean)
    assert Counter(r.doc_id for r in out if r.piece == 0) == Counter(list(clean))


def test_stages_of_odd_rows(spark):
    """Nulls, empty and repeated rows, extra columns and no rows at all go through every stage."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, label string, row int"
    rows = [(None, None, None, None, None, None, None, None), (1, "", "en", "s", 0, 1.0, "x", 1), (2, "a b", None, None, 3, None, None, None),
            (2, "a b", None, None, 3, None, None, None), (3, "\n \n", "en", "s", 3, 0.0, "y", 2)]
    for some in (rows, []):
        frame = spark.createDataFrame(some, schema)
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF)
            assert out.count() <= len(some)
            if stage is not corpus_pipeline.packed:
                assert out.columns == frame.columns


def test_quality_dictionaries_leave_shared_lines_out():
    got = quality_zstd.distinct_lines({0: ["spam\nnotice", "spam"], 1: ["prose\nnotice", "more"]})
    assert got == {0: [b"spam"], 1: [b"prose", b"more"]}
    assert np.isfinite(quality_zstd.Difference(quality_zstd.QualityModel(b"prose more" * 9, b"spam" * 9))("some text"))


def test_one_of_each_group_stays_whatever_its_ids(spark):
    """Rows that repeat id and text, copies without ids, and copies of rows with ids among those without."""
    long = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, long), (1, long), (1, other), (None, long), (None, long + " end"), (None, "alone here " + " ".join(f"u{i}" for i in range(50))),
            (None, "alone here " + " ".join(f"u{i}" for i in range(50))), (7, None), (7, None), (8, ""), (None, None), (9, other + " end")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert left.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in left.collect())
    assert max(got.values()) == 1 and sum(i is None and t is not None for i, t in got) == 1
    assert (None, rows[5][1]) in got and (7, None) in got and (8, "") in got and (None, long) not in got and (None, long + " end") not in got


def test_smallest_by_hash_is_the_sorted_head(spark):
    import random

    from pyspark.sql import functions as F

    from flatland.llm.common import smallest_by_hash
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.choice([rng.randint(-2**63, 2**63 - 1), 5]), i) for i in range(500)] + [("c", 1, 1)]
    frame = spark.createDataFrame(rows, "g string, draw long, i long")
    for size in (1, 17, 100, 10_000):
        got = smallest_by_hash(frame, ["g"], "draw", size, ["i"]).collect()
        want = [r for g in "abc" for r in sorted((x for x in rows if x[0] == g), key=lambda x: x[1:])[:size]]
        assert sorted((r.g, r.draw, r.i) for r in got) == sorted(want)
    by_group = smallest_by_hash(frame, ["g"], "draw", F.when(F.col("g") == "a", 3).otherwise(8), ["i"]).groupBy("g").count().collect()
    assert {r.g: r["count"] for r in by_group} == {"a": 3, "b": 8, "c": 1}
