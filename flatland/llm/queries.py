"""One query for each training-data operator, over its whole table, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatland.llm import (
    collocations, decontaminate, filter_audit, html_extract, language_id, line_dedup, ngram_join, packing, pii_feistel, quality_zstd,
    topk_search, url_filter, warc,
)
from flatland.llm.common import table
from flatland.session import new_run_dir

#: A demonstration key; a user of the operator passes a secret one.
PII_KEY = b"demonstration key, not a secret"

URL_RULES = [
    url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"), url_filter.Rule("block", "net", "/es/"), url_filter.Rule("block", "net", "/fr/"),
]


def op1_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


def op2_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_feistel.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)


def op4_quality_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality_zstd.train_quality(documents, table(spark, sf_dir, "labels"))
    return quality_zstd.score_quality(documents, model, threshold=0.3)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(table(spark, sf_dir, "documents"), size=3, percent=90)


def op6_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


def op7_topk_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), k=10, is_query=F.col("vec_id") % 100 == 0, scale=1024.0)


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_language_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return language_id.predict_languages(documents, language_id.train_languages(documents))


def op10_decontaminate_cgk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_filter_potential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_warc_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archives = warc.write_archives(pages, new_run_dir(spark, "warc"), "page_id", "url", "html", least_bytes=0)
    index = warc.index_archives(archives).where("warc_type IN ('response', 'revisit')")
    id_type = pages.schema["page_id"].dataType
    return index.select(
        warc.row_id(F.col("record_id")).cast(id_type).alias("page_id"), F.col("target_uri").alias("url"), "payload_bytes", "payload_digest",
        F.col("warc_type").alias("record_type"), warc.row_id(F.col("refers_to")).cast(id_type).alias("refers_to"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_collocations(table(spark, sf_dir, "documents"), least=30, longest=4, top=2000)


QUERIES = {f.__name__: f for f in (
    op1_html_mincut, op2_line_windows, op3_pii_feistel, op4_quality_zstd, op5_ngram_jaccard, op6_bin_packing, op7_topk_histogram,
    op8_url_rules, op9_language_backoff, op10_decontaminate_cgk, op11_filter_potential, op12_warc_ranges, op13_collocations)}

ORACLES = {
    "op2_line_windows": r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS p FROM d),
b AS (SELECT doc_id, p, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS t FROM l),
w AS (
  SELECT doc_id, p, lead(p, 2) OVER o AS last_p, t || chr(10) || lead(t, 1) OVER o || chr(10) || lead(t, 2) OVER o AS k
  FROM b WHERE t <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
r AS (SELECT doc_id, p, last_p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS n FROM w WHERE k IS NOT NULL),
gone AS (SELECT DISTINCT l.doc_id, l.p FROM l JOIN r ON r.doc_id = l.doc_id AND l.p BETWEEN r.p AND r.last_p WHERE r.n > 1),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.p) FILTER (WHERE gone.p IS NULL) AS text, count(gone.p) AS n_removed
  FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.p = l.p GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text, CAST(coalesce(n_removed, 0) AS INTEGER) AS n_removed
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id""",
    "op7_topk_histogram": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op8_url_rules": """
WITH rules(verdict, host, path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
p AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages),
u AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p),
fit AS (
  SELECT u.n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY u.n)
SELECT u.page_id, u.host, u.path, fit.rule, coalesce(fit.verdict, 'allow') AS verdict
FROM u LEFT JOIN fit ON u.n = fit.n""",
    "op11_filter_potential": r"""
WITH d AS (SELECT doc_id AS id, coalesce(lang, '') AS part, coalesce(text, '') AS body FROM documents),
w AS (SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words, min(id) OVER (PARTITION BY body) AS least FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic, {
    'A': len(words) < 100, 'B': 100 * len(list_distinct(words)) < 80 * len(words),
    'C': 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body),
    'D': regexp_matches(body, '[#$%&*|]'), 'E': coalesce(id > least, false)} AS fails
  FROM w LEFT JOIN l ON l.doc_id = w.id),
m AS (
  SELECT part, fails.A AS fa, fails.B AS fb, fails.C AS fc, fails.D AS fd, fails.E AS fe, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o),
r AS (
  SELECT m.part, s.filter_order, s.step, substr(s.filter_order, s.step, 1) AS own, m.n, m.good, m.toxic,
    list_filter(['A', 'B', 'C', 'D', 'E'], lambda c: (c = 'A' AND fa) OR (c = 'B' AND fb) OR (c = 'C' AND fc) OR (c = 'D' AND fd) OR (c = 'E' AND fe)) AS bad,
    string_split(substr(s.filter_order, 1, s.step - 1), '') AS earlier
  FROM m CROSS JOIN s),
t AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT list_has_any(bad, list_append(earlier, own)) THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN list_contains(bad, own) AND NOT list_has_any(bad, earlier) THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN list_contains(bad, own) AND list_has_any(bad, earlier) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN bad = [own] THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN list_contains(bad, own) AND NOT list_has_any(bad, earlier) THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN list_contains(bad, own) AND NOT list_has_any(bad, earlier) THEN toxic ELSE 0 END) AS toxic_lost
  FROM r GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM t""",
    "op12_warc_ranges": r"""
WITH p AS (
  SELECT page_id, url, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, url, octet_length(body) AS payload_bytes, upper(sha1(body)) AS hex FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM h),
d AS (
  SELECT *, list_transform(range(0, 8), lambda i: list_sum(list_transform(range(0, 5), lambda j:
    CAST((strpos('0123456789ABCDEF', substr(hex, CAST(5 * i + j + 1 AS BIGINT), 1)) - 1) * power(16, 4 - j) AS BIGINT)))) AS v
  FROM m)
SELECT page_id, url, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(v, lambda x: array_to_string(list_transform([32768, 1024, 32, 1], lambda q:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((x // q) % 32 + 1 AS BIGINT), 1)), '')), '') AS payload_digest,
  CASE WHEN coalesce(page_id = first, true) THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d""",
    "op13_collocations": r"""
WITH p AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(body, '[^\x20\x09]+') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS body
    FROM documents)),
t AS (SELECT piece, lang, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM p),
g AS (
  SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4
  FROM t WINDOW o AS (PARTITION BY piece ORDER BY i)),
f AS (
  SELECT lang, w1 AS phrase, 1 AS size, count(*) AS f FROM g GROUP BY ALL
  UNION ALL SELECT lang, w1 || ' ' || w2, 2, count(*) FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3, count(*) FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4, count(*) FROM g WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
k AS (SELECT *, unnest(range(1, size)) AS k FROM c),
s AS (
  SELECT k.lang, k.phrase, k.size, k.a, k.k, h.f AS l, t.f AS r, CAST(CAST(k.a AS HUGEINT) * 2000000 // (CAST(h.f AS HUGEINT) + t.f) AS BIGINT) AS score
  FROM k
  JOIN f h ON h.lang = k.lang AND h.phrase = array_to_string(k.w[1:k.k], ' ')
  JOIN f t ON t.lang = k.lang AND t.phrase = array_to_string(k.w[k.k + 1:], ' ')),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS best FROM s),
i AS (SELECT lang, a AS longer, w, size, unnest(range(2, size)) AS n FROM c WHERE size > 2),
j AS (SELECT lang, longer, w, n, unnest(range(1, size - n + 2)) AS p FROM i),
inner_ AS (SELECT lang, array_to_string(w[p:p + n - 1], ' ') AS phrase, max(longer) AS longer FROM j GROUP BY ALL),
kept AS (
  SELECT b.* FROM b LEFT JOIN inner_ q ON q.lang = b.lang AND q.phrase = b.phrase
  WHERE b.best = 1 AND (q.longer IS NULL OR CAST(q.longer AS HUGEINT) * 100 < CAST(b.a AS HUGEINT) * 80)),
n AS (SELECT lang, count(*) AS n FROM t GROUP BY lang),
r AS (SELECT kept.*, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n.n, r.score FROM r JOIN n ON n.lang = r.lang WHERE r.rank <= 2000""",
}
