"""Extraction, URL rules, top-k search: brute force and odd inputs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flatland.llm import html_extract, topk_search, url_filter

ARTICLE = "<p>" + "A long sentence of the article, with many words in it. " * 4 + "</p>"


def text_of(markup):
    return html_extract.main_text(markup)[0]


@pytest.mark.parametrize("noise", [
    "<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul></nav>", "<footer>&copy; site</footer>",
    "<div class='sidebar'><p>Most read stories of the week are listed here for you, dear reader.</p></div>",
    "<div class='cookie-notice'>We use cookies to make this site work better for everyone who reads it.</div>",
    "<div id=comments><div><p>I like this very much, it was a joy to read all of these words.</p></div></div>",
    "<form><label>Your mail address for our letter</label><input name=q><button>Send</button></form>",
    "<aside><p>Something else entirely that you may want to read after this, so they say.</p></aside>",
    "<script>var t = '<p>not a text</p>';</script><style>p{}</style>", "<div style='display: none'><p>A hidden text of some words here.</p></div>",
])
def test_boilerplate_goes(noise):
    body = " ".join(ARTICLE[3:-4].split())
    assert text_of(f"<html><head><title>T</title></head><body>{noise}<article><h1>The title</h1>{ARTICLE}</article></body>") == "The title " + body
    assert text_of(f"<body><div>{ARTICLE}{ARTICLE}</div>{noise}</body>") == f"{body} {body}"


def test_character_references_and_white_space():
    assert text_of("<article><p>" + "Many words are here for us. " * 5 + "Fish &amp; chips&nbsp;&#8212;  <b>bo</b>ld\n text.</p></article>").endswith(
        "Fish & chips — bold text.")


@pytest.mark.parametrize("markup", [None, "", " ", "<", "<!--", "<p", "</p></div>", "<script>", "<a href='", "<head>", "\x00", "<div>" * 3000, "&#xD800;"])
def test_broken_markup_gives_no_text(markup):
    assert text_of(markup).strip("<\x00��") == ""


def test_extract_handles_rows(spark):
    rows = [(1, None, None, 7), (1, "u", "<article>" + ARTICLE * 3 + "</article>", 7), (None, "u", "", 7)]
    got = html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert [(r.page_id, r.url, r.n_chars) for r in got] == [(1, None, 0), (1, "u", len(got[1].text)), (None, "u", 0)]
    assert html_extract.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


PROSE = "<p>" + "This is a sentence of prose, with quite a few words in it, one after another. " * 3 + "</p>"
WHOLE = "<h1>Title</h1><p>" + "The article has many words here, and they go on for long. " * 6 + "</p><p>" + "Second paragraph of the article follows it. " * 6 + "</p>"


def whole_article(markup):
    text = text_of(markup)
    return text.startswith("Title The article has many words") and text.endswith("Second paragraph of the article follows it.")


@pytest.mark.parametrize("start", ["<section>", "<h1>Title</h1>", "<pre>code</pre>", "<ul><li>a</li></ul>", "plain text"])
def test_a_head_without_its_end(start):
    assert "The article has many words" in text_of(f"<html><head><title>t</title><meta a=b><link c=d>{start}<article>{WHOLE}</article>")


@pytest.mark.parametrize("noise", [
    f"<footer>{PROSE * 8}</footer>", f"<nav>{PROSE * 8}</nav>", f"<aside>{PROSE * 5}</aside>", f"<form>{PROSE * 6}</form>",
    f"<section id='comments'>{PROSE * 4}</section>", f"<div class='comments'><div class='comment'><p>{'One long comment of a reader, who has much to say. ' * 60}</p></div></div>",
    f"<div class='site-footer'>{PROSE * 3}</div>", f"<div id=mainNav>{PROSE}</div>", f"<div class='related-posts'>{PROSE * 2}</div>", f"<div class='ad-slot'>{PROSE}</div>"])
def test_boilerplate_of_many_paragraphs_goes(noise):
    assert whole_article(f"<body><article>{WHOLE}</article>{noise}</body>")
    assert whole_article(f"<body><div>{WHOLE}</div>{noise}</body>")


def test_comments_inside_the_article_go():
    comments = "".join("<li>" + PROSE for _ in range(4))
    assert whole_article(f"<body><article>{WHOLE}<ol class='comment-list'>{comments}</ol></article></body>")


@pytest.mark.parametrize("name", ["layout has-sidebar", "post social-sharing-on", "article search-result", "legal", "hidden-gems", "no-sidebar site", "page-with-comments"])
def test_a_word_in_a_name_does_not_lose_the_article(name):
    assert whole_article(f"<body><nav><a href=x>Home</a></nav><div class=\"{name}\">{WHOLE}</div><footer>&copy; 2020</footer></body>")
    assert whole_article(f"<body><div class=\"{name}\"><nav><a href=x>Home</a></nav><div>{WHOLE}</div><div class='sidebar'>{PROSE}</div></div></body>")
    assert whole_article(f"<body><form id=aspnetForm action=x><div>{WHOLE}</div></form></body>")


def test_nested_templates_and_formulas():
    assert "LEAK" not in text_of(f"<body><template><template>a</template>LEAK of the template's words</template><article>{WHOLE}</article>")
    words = "words and more words " * 8
    assert text_of(f"<article><p>{words}where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>").endswith("where x=2 holds.")


def test_stray_tags_take_linear_time():
    import time
    start = time.process_time()
    assert whole_article("<body>" + "<div>" * 25_000 + "</section>" * 100_000 + f"<article>{WHOLE}</article>")
    text_of("<div>" * 26_000 + "<p>x</section>" * 66_000)
    assert time.process_time() - start < 10


def test_labelling_is_the_cheapest_of_all():
    """Every labelling of the graph of a small page, priced by itself."""
    rng = random.Random(11)
    parts = ["<p>Some words of a block that is not too short, really.</p>", "<nav><a href=x>Home</a></nav>", "<div class=sidebar><p>Aside words.</p></div>", "<h2>Head</h2>",
             "<footer>&copy; 2020</footer>", "<ul><li><a href=y>One</a><li>Two of them</ul>", "<article><p>Long text with many words, and more of them, and a full stop.</p></article>"]
    for _ in range(60):
        markup = "<body>" + "".join(rng.choice(parts) for _ in range(rng.randint(1, 3)))
        texts, costs, edges = html_extract.page_graph(markup)
        n = len(costs)
        if not 0 < n <= 13:
            continue

        def price(side):
            return sum(max(0, -c) if side[v] else max(0, c) for v, c in enumerate(costs)) + sum(w for a, b, w in edges if side[a] != side[b])
        best = min(price([bool(x >> v & 1) for v in range(n)]) for x in range(1 << n))
        assert price(html_extract.min_cut(costs, edges)) == pytest.approx(best)
        assert html_extract.main_text(markup)[0] == " ".join(t for t, s in zip(texts, html_extract.min_cut(costs, edges)) if s)


def test_a_very_long_page():
    body = "".join(f"<p>Paragraph {i} of the long article, which has some words and a stop.</p>" for i in range(5000))
    text = text_of(f"<nav><a href=x>Home</a></nav><article>{body}</article><footer>{PROSE * 20}</footer>")
    assert text.startswith("Paragraph 0 of") and text.endswith("a stop.") and text.count("Paragraph") == 5000


def test_min_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(1, 7)
        costs = [rng.randint(-5, 5) for _ in range(n)]
        edges = [(a, b, rng.randint(0, 4)) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def price(side):
            return (sum(c if c > 0 and not s else -c if c < 0 and s else 0 for c, s in zip(costs, side))
                    + sum(w for a, b, w in edges if side[a] != side[b]))

        assert math.isclose(price(html_extract.min_cut(costs, edges)), min(price([m >> i & 1 for i in range(n)]) for m in range(1 << n)))


RULES = [url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "b.com", "/x/"), url_filter.Rule("allow", "a.b.com", "/x/"),
         url_filter.Rule("block", "b.com", "/x/y"), url_filter.Rule("block", "com", "")]


def judged(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))])
    tail = rest[len(host):]
    path = tail[:next((i for i, c in enumerate(tail) if c in "?#"), len(tail))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best.verdict if best else "allow"


def test_url_rules(spark):
    urls = [None, "", "x", "://", "http://", "http://com", "http://COM/", "http://b.com/x/1?y=/x/", "http://a.b.com/x/1#z", "http://z.a.b.com/x/y",
            "http://xb.com/x/", "http://b.com:80/x/", "http://b.com?/x/", "http://a..com/x/y", "http://.com/", "http://bÄ.com/x/", "http://b.com/x/y" + "z" * 50_000]
    rng = random.Random(1)
    urls += [f"http://{rng.choice(['', 'a.', 'c.', 'a.b.'])}{rng.choice(['b.com', 'com', 'net', 'bcom'])}{rng.choice(['', '/', '/x/', '/x/y/', '/x'])}{rng.choice(['', '?q=1', '#/x/'])}" for _ in range(300)]
    frame = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    for rules in (RULES, RULES[:1], []):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(frame, rules, sweeps=5).collect()}
        assert got == {i: judged(u, rules) for i, u in enumerate(urls)}
    assert url_filter.judge_urls(frame.limit(0), RULES).count() == 0
    assert "Python" not in url_filter.judge_urls(frame, RULES)._jdf.queryExecution().toString().replace("PythonRDD", "")


def brute_top(rows, k, scale=1024):
    usable = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in sorted((i, v) for i, v in usable if i % 4 == 0):
        asked.setdefault(i, v)
    out = {}
    for i, v in asked.items():
        scored = sorted((-max(-(2**63 - 1), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), j) for j, w in usable if j != i and len(w) == len(v))
        out[i] = [(j, -s) for s, j in scored[:k]]
    return {i: v for i, v in out.items() if v}


@pytest.mark.parametrize("kind", ["plain", "ties", "odd", "huge"])
def test_top_k_is_exact(spark, kind):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(120)]
    if kind == "ties":
        rows = [(i, [0.5, -0.25, 0.125]) for i in range(70)] + [(70 + i, [float(i % 3), 0.0, 1.0]) for i in range(40)]
    if kind == "odd":
        rows += [(200, None), (204, []), (208, [1.0, None]), (212, [float("nan")] * 6), (216, [float("inf")] * 6), (None, [1.0] * 6),
                 (220, [1.0, 2.0]), (224, [3.0, 1.0]), (4, [0.5] * 6), (4, [0.5] * 6), (9, [2.0] * 6)]
    if kind == "huge":
        rows += [(300, [1e30] * 6), (301, [-1e12, 1e12, 5.0, 0.0, 0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5).withColumn("score", F.lit("own"))
    got = {}
    for r in topk_search.top_k(frame, 5, F.col("vec_id") % 4 == 0, query_block=13).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == brute_top(rows, 5)


def test_top_k_of_nothing(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_search.top_k(frame, 5, F.col("vec_id") % 4 == 0).count() == 0
