"""Registered queries: one per operator family, each with a DuckDB oracle.

Every query reads the given tables (or files Spark writes from them) in full
and returns a DataFrame. Queries that start from delimited files first turn a
given table into a feed folder with Spark's own writer; those folders are
built once per data folder and reused (they are inputs, not results).
"""

from __future__ import annotations

import re
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatland import storage
from flatland.functions.nulls import NULL_MARKERS
from flatland.operators.publish import VersionedTable, publish
from flatland.operators.stage import ColumnMap, Step, add_modify_stamp, dedup_latest, map_columns, run_steps
from flatland.session import new_run_dir, scratch_root

# A fixed job start, so that lineage columns are comparable with the oracle.
JOB_TIME = "2024-03-24 10:15:30.600000"
JOB_TIME_ROUNDED = "2024-03-24 10:15:31"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def _buckets(spark: SparkSession) -> int:
    """Bucket count of published targets: the session's shuffle width."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "8"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], None]) -> str:
    """Folder holding files derived from the given tables; built once, then reused.

    A build goes to a fresh attempt folder; a marker naming the finished
    attempt makes it visible, so a failed build is never picked up.
    """
    tag = re.sub(r"[^A-Za-z0-9]+", "_", sf_dir.rstrip("/")).strip("_")
    base = f"{scratch_root(spark)}/fixtures/{tag}/{name}"
    marker = f"{base}.ready"
    done = storage.read_small_text(spark, marker)
    if done:
        return done.strip()
    attempt = f"{base}/attempt-{uuid.uuid4().hex[:10]}"
    build(attempt)
    storage.write_small_text(spark, marker, attempt)
    return attempt


def sql_markers(extra: str | None = None) -> str:
    vals = list(NULL_MARKERS) + ([extra] if extra and extra not in NULL_MARKERS else [])
    return ", ".join("'" + v.replace("'", "''") + "'" for v in vals)


def sql_clean(x: str, quoted: bool, extra: str | None = "<NULL>") -> str:
    inner = f"CASE WHEN {x} IN ({sql_markers(extra)}) THEN NULL ELSE {x} END"
    return f"NULLIF(REPLACE({inner}, '\"', ''), '')" if quoted else inner


def sql_ts0(t: str) -> str:
    frac = f"(microsecond({t}) % 1000000)"
    return (f"(date_trunc('second', {t}) + CASE WHEN {frac} > 500000 OR ({frac} = 500000 AND {t} >= "
            f"TIMESTAMP '2000-01-01') THEN INTERVAL 1 SECOND ELSE INTERVAL 0 SECOND END)")


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
EVENTS_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]

# --------------------------------------------------------------------------
# Stage casts
# --------------------------------------------------------------------------

_SHIP_US = "(l_orderkey % 1000) * 1000 + l_linenumber * 125000"


@query("map_casts", f"""
SELECT l_orderkey, l_linenumber,
       CAST(round_even(l_quantity / 2, 0) AS INTEGER) AS qty_int,
       substring(l_returnflag || l_linestatus, 1, 1) AS flag,
       CAST(l_shipdate + to_microseconds({_SHIP_US}) AS DATE) AS ship_date,
       {sql_ts0(f"(l_shipdate + to_microseconds({_SHIP_US}))")} AS ship_ts0
FROM lineitem""")
def q_map_casts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    wrk = li.select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 2).alias("qty_half"),
                    F.concat("l_returnflag", "l_linestatus").alias("flags"),
                    F.timestamp_add("MICROSECOND", F.expr(_SHIP_US), F.col("l_shipdate")).alias("ship_ts"))
    return map_columns(wrk, [
        ColumnMap("l_orderkey", "l_orderkey", "bigint"),
        ColumnMap("l_linenumber", "l_linenumber", "integer"),
        ColumnMap("qty_half", "qty_int", "integer"),
        ColumnMap("flags", "flag", "varchar(1)"),
        ColumnMap("ship_ts", "ship_date", "date"),
        ColumnMap("ship_ts", "ship_ts0", "timestamp(0)"),
    ])


@query("cast_decimal", """
SELECT l_orderkey, l_linenumber,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS price_dec,
       CAST(l_tax AS DECIMAL(4,2)) AS tax_dec
FROM lineitem""")
def q_cast_decimal(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return map_columns(li, [
        ColumnMap("l_orderkey", "l_orderkey", "bigint"),
        ColumnMap("l_linenumber", "l_linenumber", "integer"),
        ColumnMap("l_extendedprice", "price_dec", "decimal(12,2)"),
        ColumnMap("l_tax", "tax_dec", "decimal(4,2)"),
    ])


# --------------------------------------------------------------------------
# Latest row per key
# --------------------------------------------------------------------------

def _dedup_sql(src: str = "lineitem") -> str:
    rest = [c for c in LINEITEM_COLS if c not in ("l_orderkey", "l_linenumber", "l_shipdate")]
    order = ", ".join(f"{c} DESC NULLS FIRST" for c in ["l_shipdate"] + rest)
    return (f"SELECT {', '.join(LINEITEM_COLS)} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM {src}) d WHERE rn = 1")


def _dedup_lineitem(spark, sf_dir):
    return dedup_latest(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("dedup_latest", _dedup_sql())
def q_dedup_latest(spark, sf_dir):
    return _dedup_lineitem(spark, sf_dir)


# --------------------------------------------------------------------------
# Publish by key
# --------------------------------------------------------------------------

@query("publish_upsert", """
WITH tgt AS (
  SELECT CASE WHEN o_orderkey % 3 = 1 AND o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey,
         o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 3 <> 0),
stg AS (
  SELECT CASE WHEN o_orderkey % 10 = 4 THEN NULL ELSE o_orderkey END AS o_orderkey,
         o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 2 = 0)
SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM stg WHERE stg.o_orderkey = tgt.o_orderkey)
UNION ALL
SELECT * FROM stg WHERE o_orderkey IS NOT NULL""")
def q_publish_upsert(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    tgt = (o.filter(k % 3 != 0)
           .withColumn("o_orderkey", F.when((k % 3 == 1) & (k % 7 == 0), F.lit(None)).otherwise(k)))
    stg = (o.filter(k % 2 == 0)
           .withColumn("o_totalprice", F.col("o_totalprice") + 1)
           .withColumn("o_orderkey", F.when(k % 10 == 4, F.lit(None)).otherwise(k)))
    target = VersionedTable(spark, new_run_dir(spark, "publish_upsert"))
    target.write(tgt)
    v = publish(spark, stg, target, ["o_orderkey"])
    return target.read(v)


@query("publish_upsert_composite", f"""
WITH d AS ({_dedup_sql()}),
tgt AS (SELECT * FROM d WHERE l_orderkey % 3 <> 0),
stg AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 AS l_quantity, l_extendedprice,
               l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
        FROM d WHERE l_linenumber % 2 = 0)
SELECT * FROM tgt WHERE NOT EXISTS (
  SELECT 1 FROM stg WHERE stg.l_orderkey = tgt.l_orderkey AND stg.l_linenumber = tgt.l_linenumber)
UNION ALL SELECT * FROM stg""")
def q_publish_upsert_composite(spark, sf_dir):
    d = _dedup_lineitem(spark, sf_dir)
    run = new_run_dir(spark, "publish_composite")
    # Stage and target are both materialised first, as a load would have them.
    d.write.parquet(f"{run}/dedup")
    d = spark.read.parquet(f"{run}/dedup")
    tgt = d.filter(F.col("l_orderkey") % 3 != 0)
    stg = d.filter(F.col("l_linenumber") % 2 == 0).withColumn("l_quantity", F.col("l_quantity") + 1)
    keys = ["l_orderkey", "l_linenumber"]
    target = VersionedTable(spark, f"{run}/target", keys, _buckets(spark))
    target.write(tgt)
    v = publish(spark, stg, target, keys)
    return target.read(v)


PUBLISH_SPLIT_DAY = "2000-01-01"
PUBLISH_STAGE_FROM = "1999-07-01"
ORDERS_PER_PART = 1000


@query("publish_partitions", f"""
WITH tgt AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{PUBLISH_SPLIT_DAY}'),
stg AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderdate >= TIMESTAMP '{PUBLISH_STAGE_FROM}')
SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM stg WHERE stg.o_orderkey = tgt.o_orderkey)
UNION ALL SELECT * FROM stg""")
def q_publish_partitions(spark, sf_dir):
    """Orders loaded up to a day, then a later load overlapping it by half a year,
    published into a target partitioned by key range."""
    from flatland.operators.publish import PartitionedTable, publish_partitions
    o = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    target = PartitionedTable(spark, f"{new_run_dir(spark, 'publish_partitions')}/target", ["o_orderkey"],
                              part_expr=F.floor(F.col("o_orderkey") / ORDERS_PER_PART))
    target.write(o.filter(day < F.lit(PUBLISH_SPLIT_DAY)))
    stage = o.filter(day >= F.lit(PUBLISH_STAGE_FROM)).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    publish_partitions(spark, stage, target)
    return target.read().select(*ORDERS_COLS)


# --------------------------------------------------------------------------
# Fix-up steps (P12, P13, P15, X3) and target stamp
# --------------------------------------------------------------------------

def _orders_steps():
    return [
        Step("urgent big finished orders", "update",
             pred=(F.col("o_totalprice") > 400000) & (F.col("o_orderstatus") == "F"),
             assignments={"o_orderpriority": "1-URGENT"}),
        Step("medium orders flagged", "update",
             pred=F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")) == "3-MEDIUM",
             assignments={"o_orderstatus": "X"}),
        Step("drop tiny orders", "delete", pred=F.col("o_totalprice") < 5000),
    ]


@query("conditional_update", """
WITH s1 AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         CASE WHEN COALESCE(o_totalprice > 400000 AND o_orderstatus = 'F', false) THEN '1-URGENT'
              ELSE o_orderpriority END AS o_orderpriority
  FROM orders),
s2 AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN COALESCE(NULLIF(o_orderpriority, '5-LOW') = '3-MEDIUM', false) THEN 'X'
              ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  FROM s1)
SELECT * FROM s2 WHERE NOT COALESCE(o_totalprice < 5000, false)""")
def q_conditional_update(spark, sf_dir):
    out, _counts = run_steps(table(spark, sf_dir, "orders"), _orders_steps())
    return out


@query("fixup_counts", """
WITH s1 AS (
  SELECT o_totalprice, o_orderstatus,
         CASE WHEN COALESCE(o_totalprice > 400000 AND o_orderstatus = 'F', false) THEN '1-URGENT'
              ELSE o_orderpriority END AS o_orderpriority
  FROM orders)
SELECT 'stage' AS point, 1 AS step_no, 'urgent big finished orders' AS step, 'update' AS action,
       (SELECT count(*) FROM orders WHERE o_totalprice > 400000 AND o_orderstatus = 'F') AS rows
UNION ALL
SELECT 'stage', 2, 'medium orders flagged', 'update',
       (SELECT count(*) FROM s1 WHERE NULLIF(o_orderpriority, '5-LOW') = '3-MEDIUM')
UNION ALL
SELECT 'stage', 3, 'drop tiny orders', 'delete', (SELECT count(*) FROM orders WHERE o_totalprice < 5000)""")
def q_fixup_counts(spark, sf_dir):
    _out, counts = run_steps(table(spark, sf_dir, "orders"), _orders_steps())
    return counts


@query("delete_where", f"""
SELECT {', '.join(EVENTS_COLS)} FROM events
WHERE NOT COALESCE((CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END) > 10, false)""")
def q_delete_where(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    pred = F.when(F.col("event_id") % 5 != 0, F.col("value")) > 10
    out, _ = run_steps(ev, [Step("drop large values", "delete", pred=pred)])
    return out


@query("modify_stamp", f"""
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, substring(c_name, 1, 20) AS c_name,
       CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment,
       TIMESTAMP '{JOB_TIME_ROUNDED}' AS modify_date_time
FROM customer""")
def q_modify_stamp(spark, sf_dir):
    cu = table(spark, sf_dir, "customer")
    tgt = map_columns(cu, [ColumnMap("c_custkey", "c_custkey", "bigint"),
                           ColumnMap("c_name", "c_name", "varchar(20)"),
                           ColumnMap("c_acctbal", "c_acctbal", "decimal(12,2)"),
                           ColumnMap("c_mktsegment", "c_mktsegment", "varchar(255)")])
    return add_modify_stamp(tgt, JOB_TIME)


# --------------------------------------------------------------------------
# Feeds written from the given tables
# --------------------------------------------------------------------------

from flatland.functions.casts import strict_double, strict_timestamp  # noqa: E402
from flatland.operators.land import _SHAPE, LandingField, land_feed, read_parsed  # noqa: E402
from flatland.plans.feed import Feed  # noqa: E402
from flatland.sources.files import detect_delimiter, file_headers, raw_line_counts  # noqa: E402
from flatland.sources.writers import write_archives, write_delimited, write_lines  # noqa: E402


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _feed_dir(spark, sf_dir, name, df_fn, n_files=3, **kw) -> str:
    """Folder of a feed of a whole table, in ``n_files`` files or, of a larger table, more."""
    def build(d):
        write_delimited(spark, _as_text(df_fn()), d, name, n_files=n_files, at_least=True, **kw)
    return fixture(spark, sf_dir, f"feed_{name}", build)


CUSTOMER_FIELDS = [LandingField("c_custkey", "float64"), LandingField("c_name"),
                   LandingField("c_nationkey", "float64"), LandingField("c_acctbal", "float64"),
                   LandingField("c_mktsegment")]


@query("scan_roundtrip", f"""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       TIMESTAMP '{JOB_TIME}' AS load_timestamp
FROM customer""")
def q_scan_roundtrip(spark, sf_dir):
    d = _feed_dir(spark, sf_dir, "customer", lambda: table(spark, sf_dir, "customer"))
    res = land_feed(spark, Feed("customer", d), CUSTOMER_FIELDS, JOB_TIME)
    return map_columns(res.rows, [
        ColumnMap("c_custkey", "c_custkey", "bigint"), ColumnMap("c_name", "c_name", "string"),
        ColumnMap("c_nationkey", "c_nationkey", "integer"), ColumnMap("c_acctbal", "c_acctbal", "float64"),
        ColumnMap("c_mktsegment", "c_mktsegment", "string"), ColumnMap("load_timestamp", "load_timestamp", "timestamp")])


LINEITEM_FIELDS = ([LandingField(c, "number" if c.endswith("key") or c == "l_linenumber" else "float64") for c in LINEITEM_COLS[:8]]
                   + [LandingField("l_returnflag"), LandingField("l_linestatus"),
                      LandingField("l_shipdate", "timestamp")])
LINEITEM_STAGE = [ColumnMap(c, c, t) for c, t in [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "integer"),
    ("l_quantity", "float64"), ("l_extendedprice", "float64"), ("l_discount", "float64"), ("l_tax", "float64"),
    ("l_returnflag", "varchar(1)"), ("l_linestatus", "varchar(1)"), ("l_shipdate", "timestamp")]]


@query("land_lineitem", f"SELECT {', '.join(LINEITEM_COLS)} FROM lineitem")
def q_land_lineitem(spark, sf_dir):
    d = _feed_dir(spark, sf_dir, "lineitem", lambda: table(spark, sf_dir, "lineitem"), n_files=8)
    res = land_feed(spark, Feed("lineitem", d), LINEITEM_FIELDS, JOB_TIME)
    return map_columns(res.rows, LINEITEM_STAGE)


@query("land_counts", """
SELECT 'lineitem' AS feed, 'loaded' AS status, count(*) AS raw_records, count(*) AS records_loaded FROM lineitem""")
def q_land_counts(spark, sf_dir):
    """The counters every load pays for: landed rows and the files' line counts."""
    d = _feed_dir(spark, sf_dir, "lineitem", lambda: table(spark, sf_dir, "lineitem"), n_files=8)
    files = land_feed(spark, Feed("lineitem", d), LINEITEM_FIELDS, JOB_TIME).files
    return files.groupBy("feed", "status").agg(F.sum("raw_records").alias("raw_records"), F.sum("records_loaded").alias("records_loaded"))


DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents_feed(spark, sf_dir):
    return _feed_dir(spark, sf_dir, "documents", lambda: table(spark, sf_dir, "documents"), n_files=2,
                     delimiter=",", quoting=1, extension="csv")


DOCS_FEED = dict(extension="csv", delimiter=",", quoting=1)


@query("scan_quoted_multiline", f"""
SELECT doc_id, {sql_clean('text', True)} AS text, {sql_clean('lang', True)} AS lang,
       {sql_clean('source', True)} AS source, n_chars
FROM documents""")
def q_scan_quoted_multiline(spark, sf_dir):
    d = _documents_feed(spark, sf_dir)
    res = land_feed(spark, Feed("documents", d, **DOCS_FEED),
                    [LandingField("doc_id", "float64"), LandingField("n_chars", "float64")], JOB_TIME)
    return map_columns(res.rows, [ColumnMap("doc_id", "doc_id", "bigint"), ColumnMap("text", "text", "string"),
                                  ColumnMap("lang", "lang", "string"), ColumnMap("source", "source", "string"),
                                  ColumnMap("n_chars", "n_chars", "bigint")])


# Split size for the split reader of quoted files: small enough that every
# data folder's files are cut into several splits, many of them inside a value.
QUOTED_SPLIT_BYTES = 256 * 1024


@query("scan_quoted_split", f"""
SELECT doc_id, {sql_clean('text', True)} AS text, {sql_clean('lang', True)} AS lang,
       {sql_clean('source', True)} AS source, n_chars
FROM documents""")
def q_scan_quoted_split(spark, sf_dir):
    d = _documents_feed(spark, sf_dir)
    feed = Feed("documents", d, quoted_split_bytes=QUOTED_SPLIT_BYTES, **DOCS_FEED)
    res = land_feed(spark, feed, [LandingField("doc_id", "float64"), LandingField("n_chars", "float64")], JOB_TIME)
    return map_columns(res.rows, [ColumnMap("doc_id", "doc_id", "bigint"), ColumnMap("text", "text", "string"),
                                  ColumnMap("lang", "lang", "string"), ColumnMap("source", "source", "string"),
                                  ColumnMap("n_chars", "n_chars", "bigint")])


@query("reconcile_counts", """
SELECT 'documents' AS feed, count(*) AS records_loaded,
       CAST(sum(1 + length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), ''))) AS BIGINT) AS raw_records,
       CAST(sum(length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), ''))) AS BIGINT) AS record_difference
FROM documents""")
def q_reconcile_counts(spark, sf_dir):
    from flatland.operators.metrics import reconcile
    d = _documents_feed(spark, sf_dir)
    res = land_feed(spark, Feed("documents", d, **DOCS_FEED), [LandingField("doc_id", "float64")], JOB_TIME)
    files = reconcile(res.files)
    return files.groupBy("feed").agg(
        F.sum("records_loaded").alias("records_loaded"), F.sum("raw_records").alias("raw_records"),
        F.sum(F.col("raw_records") - F.col("records_loaded")).alias("record_difference"))


NATION_FIELDS = [LandingField("n_nationkey", "float64"), LandingField("n_name"),
                 LandingField("n_regionkey", "float64")]


@query("scan_compressed", " UNION ALL ".join(
    f"SELECT n_nationkey, n_name, n_regionkey, '{c}' AS codec FROM nation" for c in ["gz", "bz2", "zip", "xz"]))
def q_scan_compressed(spark, sf_dir):
    def build(d):
        nation = _as_text(table(spark, sf_dir, "nation"))
        write_delimited(spark, nation, d, "nation_gz", compression="gzip")
        write_delimited(spark, nation, d, "nation_bz2", compression="bzip2")
        plain = write_delimited(spark, nation, f"{d}_plain", "nation_plain")
        for p, kind in zip(write_archives(spark, plain, d, "zip"), ["zip"]):
            storage.rename(spark, p, f"{d}/nation_zip_00000.txt.zip")
        for p in write_archives(spark, plain, d, "xz"):
            storage.rename(spark, p, f"{d}/nation_xz_00000.txt.xz")
    d = fixture(spark, sf_dir, "feed_nation_codecs", build)
    res = land_feed(spark, Feed("nation", d), NATION_FIELDS, JOB_TIME)
    out = map_columns(res.rows, [ColumnMap("n_nationkey", "n_nationkey", "integer"),
                                 ColumnMap("n_name", "n_name", "string"),
                                 ColumnMap("n_regionkey", "n_regionkey", "integer"),
                                 ColumnMap("load_file_name", "load_file_name", "string")])
    return out.withColumn("codec", F.regexp_extract("load_file_name", r"\.([^.]+)$", 1)).drop("load_file_name")


SUPPLIER_FIELDS = [LandingField("s_suppkey", "float64"), LandingField("s_name"),
                   LandingField("s_nationkey", "float64"), LandingField("s_acctbal", "float64")]
SUPPLIER_STAGE = [ColumnMap("s_suppkey", "s_suppkey", "bigint"), ColumnMap("s_name", "s_name", "string"),
                  ColumnMap("s_nationkey", "s_nationkey", "integer"), ColumnMap("s_acctbal", "s_acctbal", "float64")]


@query("scan_header_groups", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def q_scan_header_groups(spark, sf_dir):
    def build(d):
        s = _as_text(table(spark, sf_dir, "supplier"))
        even = s.filter(F.col("s_suppkey").cast("long") % 2 == 0)
        odd = s.filter(F.col("s_suppkey").cast("long") % 2 == 1)
        write_delimited(spark, even, d, "supplier_a", n_files=2)
        # Same columns, other order and other spelling of the names.
        write_delimited(spark, odd.select(F.col("s_acctbal").alias("S-ACCTBAL"), F.col("s_nationkey").alias("S NationKey"),
                                          F.col("s_name").alias("s_name"), F.col("s_suppkey").alias("S_SUPPKEY")),
                        d, "supplier_b", n_files=2)
    d = fixture(spark, sf_dir, "feed_supplier_groups", build)
    res = land_feed(spark, Feed("supplier", d), SUPPLIER_FIELDS, JOB_TIME)
    return map_columns(res.rows, SUPPLIER_STAGE)


@query("spec_conformance", """
SELECT 'loaded' AS status, CAST(NULL AS VARCHAR) AS reason, count(*) AS raw_records
FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL
SELECT 'bad', 'missing column: s_acctbal', count(*) FROM supplier WHERE s_suppkey % 2 = 1""")
def q_spec_conformance(spark, sf_dir):
    def build(d):
        s = _as_text(table(spark, sf_dir, "supplier"))
        write_delimited(spark, s.filter(F.col("s_suppkey").cast("long") % 2 == 0), d, "supplier_full", n_files=2)
        write_delimited(spark, s.filter(F.col("s_suppkey").cast("long") % 2 == 1).drop("s_acctbal"),
                        d, "supplier_short", n_files=2)
    d = fixture(spark, sf_dir, "feed_supplier_conformance", build)
    res = land_feed(spark, Feed("supplier", d), SUPPLIER_FIELDS, JOB_TIME)
    return (res.files.groupBy("status", "reason")
            .agg(F.sum("raw_records").alias("raw_records")))


@query("raw_line_count", """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'orders_even' ELSE 'orders_odd' END AS feed, count(*) AS raw_records
FROM orders GROUP BY 1""")
def q_raw_line_count(spark, sf_dir):
    def build(d):
        o = _as_text(table(spark, sf_dir, "orders"))
        write_delimited(spark, o.filter(F.col("o_orderkey").cast("long") % 2 == 0), f"{d}/orders_even", "orders", n_files=3)
        write_delimited(spark, o.filter(F.col("o_orderkey").cast("long") % 2 == 1), f"{d}/orders_odd", "orders", n_files=3)
    d = fixture(spark, sf_dir, "feeds_orders_split", build)
    paths = [p for sub in ("orders_even", "orders_odd")
             for p, _, _ in storage.glob_files(spark, f"{d}/{sub}/*.txt")]
    counts = raw_line_counts(spark, paths)
    return (counts.withColumn("feed", F.regexp_extract("path", r"/(orders_[a-z]+)/[^/]+$", 1))
            .groupBy("feed").agg(F.sum("raw_records").alias("raw_records")))


@query("delimiter_detect", """
SELECT * FROM (VALUES ('customer', 'comma'), ('lineitem', 'tab'), ('orders', 'pipe')) AS t(feed, delimiter)""")
def q_delimiter_detect(spark, sf_dir):
    def build(d):
        write_delimited(spark, _as_text(table(spark, sf_dir, "lineitem")), f"{d}/lineitem", "lineitem",
                        n_files=2, at_least=True, delimiter="\t")
        write_delimited(spark, _as_text(table(spark, sf_dir, "orders")), f"{d}/orders", "orders",
                        n_files=2, at_least=True, delimiter="|", quoting=0)
        write_delimited(spark, _as_text(table(spark, sf_dir, "customer")), f"{d}/customer", "customer",
                        n_files=2, at_least=True, delimiter=",", quoting=0)
    d = fixture(spark, sf_dir, "feeds_delimiters", build)
    paths = [p for sub in ("lineitem", "orders", "customer") for p, _, _ in storage.glob_files(spark, f"{d}/{sub}/*.txt")]
    heads = file_headers(spark, paths)
    names = F.create_map(F.lit("\t"), F.lit("tab"), F.lit("|"), F.lit("pipe"), F.lit(","), F.lit("comma"))
    return (heads.select(F.regexp_extract("path", r"/([a-z]+)/[^/]+$", 1).alias("feed"),
                         names[detect_delimiter(F.col("header"))].alias("delimiter"))
            .distinct())


EVENTS_NULL_VALUE = "MISSING"
_NEAR_MISSES = ["nan", "N/A", "null ", "NONE", " NULL"]


@query("null_markers", f"""
SELECT event_id,
       CASE WHEN event_id % 16 < 15 THEN NULL ELSE event_type END AS event_type,
       CASE event_id % 6 {' '.join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(_NEAR_MISSES))} ELSE props END AS props
FROM events""")
def q_null_markers(spark, sf_dir):
    def build(d):
        ev = table(spark, sf_dir, "events")
        markers = F.array(*[F.lit(m) for m in list(NULL_MARKERS) + [EVENTS_NULL_VALUE]])
        k16, k6 = F.col("event_id") % 16, F.col("event_id") % 6
        misses = F.array(*[F.lit(m) for m in _NEAR_MISSES])
        planted = ev.select(
            F.col("event_id").cast("string").alias("event_id"),
            F.when(k16 < 15, F.element_at(markers, (k16 + 1).cast("int"))).otherwise(F.col("event_type")).alias("event_type"),
            F.when(k6 < 5, F.element_at(misses, (k6 + 1).cast("int"))).otherwise(F.col("props")).alias("props"))
        write_delimited(spark, planted, d, "events", n_files=3)
    d = fixture(spark, sf_dir, "feed_events_markers", build)
    res = land_feed(spark, Feed("events", d, null_value=EVENTS_NULL_VALUE),
                    [LandingField("event_id", "float64")], JOB_TIME)
    return map_columns(res.rows, [ColumnMap("event_id", "event_id", "bigint"),
                                  ColumnMap("event_type", "event_type", "string"),
                                  ColumnMap("props", "props", "string")])


_QTY_RULE = "(l_orderkey + l_linenumber) % 11"


@query("strict_number", f"""
SELECT l_orderkey, l_linenumber, qty_text,
       CASE r WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 4 THEN 100000.0
              WHEN 5 THEN CAST('inf' AS DOUBLE) WHEN 6 THEN -0.5 ELSE l_quantity END AS qty_value,
       r IN (0, 1, 2) AS qty_bad
FROM (SELECT l_orderkey, l_linenumber, l_quantity, {_QTY_RULE} AS r,
             CASE {_QTY_RULE} WHEN 0 THEN 'abc' WHEN 1 THEN '1,5' WHEN 2 THEN CAST(l_quantity AS VARCHAR) || 'd'
                  WHEN 3 THEN ' ' || CAST(l_quantity AS VARCHAR) || ' ' WHEN 4 THEN '1e5' WHEN 5 THEN 'inf'
                  WHEN 6 THEN '-0.5' ELSE CAST(l_quantity AS VARCHAR) END AS qty_text
      FROM lineitem) t""")
def q_strict_number(spark, sf_dir):
    def build(d):
        li = table(spark, sf_dir, "lineitem")
        r = F.expr(_QTY_RULE)
        q = F.col("l_quantity").cast("string")
        text = (F.when(r == 0, F.lit("abc")).when(r == 1, F.lit("1,5")).when(r == 2, F.concat(q, F.lit("d")))
                .when(r == 3, F.concat(F.lit(" "), q, F.lit(" "))).when(r == 4, F.lit("1e5"))
                .when(r == 5, F.lit("inf")).when(r == 6, F.lit("-0.5")).otherwise(q))
        write_delimited(spark, li.select(F.col("l_orderkey").cast("string").alias("l_orderkey"),
                                         F.col("l_linenumber").cast("string").alias("l_linenumber"),
                                         text.alias("l_quantity")), d, "lineitem_qty", n_files=4)
    d = fixture(spark, sf_dir, "feed_lineitem_qty", build)
    res = land_feed(spark, Feed("lineitem_qty", d),
                    [LandingField("l_orderkey", "float64"), LandingField("l_linenumber", "float64"),
                     LandingField("l_quantity")], JOB_TIME)
    value, bad = strict_double(F.col("l_quantity"))
    return res.rows.select(F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
                           F.col("l_linenumber").cast("int").alias("l_linenumber"),
                           F.col("l_quantity").alias("qty_text"), value.alias("qty_value"), bad.alias("qty_bad"))


_TS_RULE = "(l_orderkey + l_linenumber) % 10"
_TS_TRUE_SQL = "(l_shipdate + to_seconds(l_orderkey % 86400))"


@query("strict_timestamp", f"""
SELECT l_orderkey, l_linenumber, ship_text,
       CASE r WHEN 0 THEN t WHEN 1 THEN t WHEN 3 THEN date_trunc('minute', t)
              WHEN 6 THEN NULL WHEN 7 THEN NULL ELSE date_trunc('day', t) END AS ship_ts,
       r = 6 AS ship_bad
FROM (SELECT l_orderkey, l_linenumber, {_TS_RULE} AS r, {_TS_TRUE_SQL} AS t,
             CASE {_TS_RULE}
               WHEN 0 THEN strftime({_TS_TRUE_SQL}, '%Y-%m-%d %H:%M:%S')
               WHEN 1 THEN strftime({_TS_TRUE_SQL}, '%-m/%-d/%Y %-H:%M:%S')
               WHEN 2 THEN strftime({_TS_TRUE_SQL}, '%-m/%-d/%Y')
               WHEN 3 THEN strftime({_TS_TRUE_SQL}, '%-m/%-d/%Y %-I:%M %p')
               WHEN 4 THEN strftime({_TS_TRUE_SQL}, '%Y%m%d')
               WHEN 5 THEN strftime({_TS_TRUE_SQL}, '%-d-%b-%Y')
               WHEN 6 THEN 'x'
               WHEN 7 THEN '9999-12-31 00:00:00'
               WHEN 8 THEN strftime({_TS_TRUE_SQL}, '%Y-%m-%d')
               ELSE CASE WHEN day({_TS_TRUE_SQL}) > 12 THEN strftime({_TS_TRUE_SQL}, '%d/%m/%Y')
                         ELSE strftime({_TS_TRUE_SQL}, '%Y-%m-%d') END
             END AS ship_text
      FROM lineitem) s""")
def q_strict_timestamp(spark, sf_dir):
    def build(d):
        li = table(spark, sf_dir, "lineitem")
        r = F.expr(_TS_RULE)
        t = F.timestamp_add("SECOND", F.col("l_orderkey") % 86400, F.col("l_shipdate"))
        fmt = lambda p: F.date_format(t, p)
        text = (F.when(r == 0, fmt("yyyy-MM-dd HH:mm:ss")).when(r == 1, fmt("M/d/yyyy H:mm:ss"))
                .when(r == 2, fmt("M/d/yyyy")).when(r == 3, fmt("M/d/yyyy h:mm a"))
                .when(r == 4, fmt("yyyyMMdd")).when(r == 5, fmt("d-MMM-yyyy"))
                .when(r == 6, F.lit("x")).when(r == 7, F.lit("9999-12-31 00:00:00"))
                .when(r == 8, fmt("yyyy-MM-dd"))
                .otherwise(F.when(F.dayofmonth(t) > 12, fmt("dd/MM/yyyy")).otherwise(fmt("yyyy-MM-dd"))))
        write_delimited(spark, li.select(F.col("l_orderkey").cast("string").alias("l_orderkey"),
                                         F.col("l_linenumber").cast("string").alias("l_linenumber"),
                                         text.alias("l_shipdate")), d, "lineitem_ship", n_files=4)
    d = fixture(spark, sf_dir, "feed_lineitem_ship", build)
    res = land_feed(spark, Feed("lineitem_ship", d),
                    [LandingField("l_orderkey", "float64"), LandingField("l_linenumber", "float64"),
                     LandingField("l_shipdate")], JOB_TIME)
    value, bad = strict_timestamp(F.col("l_shipdate"))
    return res.rows.select(F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
                           F.col("l_linenumber").cast("int").alias("l_linenumber"),
                           F.col("l_shipdate").alias("ship_text"), value.alias("ship_ts"), bad.alias("ship_bad"))


@query("ragged_rows", """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 7 = 3 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       CASE o_orderkey % 7 WHEN 3 THEN 'short' WHEN 5 THEN 'long' WHEN 6 THEN 'long' ELSE 'ok' END AS row_shape
FROM orders""")
def q_ragged_rows(spark, sf_dir):
    def build(d):
        o = table(spark, sf_dir, "orders")
        cols = [F.col(c).cast("string") for c in ORDERS_COLS]
        r = F.col("o_orderkey") % 7
        line = (F.when(r == 3, F.concat_ws("\t", *cols[:-1]))
                .when(r == 5, F.concat_ws("\t", *cols, F.lit("EXTRA")))
                .when(r == 6, F.concat_ws("\t", *cols, F.lit("")))
                .otherwise(F.concat_ws("\t", *cols)))
        write_delimited(spark, o.select(line.alias("\t".join(ORDERS_COLS))), d, "orders_ragged", n_files=3)
    d = fixture(spark, sf_dir, "feed_orders_ragged", build)
    res = land_feed(spark, Feed("orders", d), [LandingField("o_orderkey", "float64")], JOB_TIME)
    parsed = read_parsed(spark, res.parsed_path)
    return parsed.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderpriority",
                         F.col(_SHAPE).alias("row_shape"))


@query("file_quarantine", """
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_orderkey % 4 <> 2""")
def q_file_quarantine(spark, sf_dir):
    def build(d):
        o = _as_text(table(spark, sf_dir, "orders"))
        k = F.col("o_orderkey").cast("long")
        for b in range(4):
            part = o.filter(k % 4 == b)
            if b == 2:
                part = part.withColumn("o_totalprice", F.when(k == 2, F.lit("bad")).otherwise(F.col("o_totalprice")))
            write_delimited(spark, part, d, f"orders_b{b}", n_files=1)
    d = fixture(spark, sf_dir, "feed_orders_quarantine", build)
    res = land_feed(spark, Feed("orders", d),
                    [LandingField("o_orderkey", "float64"), LandingField("o_totalprice", "float64"),
                     LandingField("o_orderdate", "timestamp")], JOB_TIME)
    return map_columns(res.rows, [ColumnMap("o_orderkey", "o_orderkey", "bigint"),
                                  ColumnMap("o_totalprice", "o_totalprice", "float64"),
                                  ColumnMap("o_orderdate", "o_orderdate", "timestamp")])


@query("quarantine_report", """
SELECT 'orders_b2_00000.txt' AS load_file_name, 'bad number in o_totalprice' AS reason,
       CAST(1 AS BIGINT) AS bad_rows, count(*) AS raw_records, 'bad' AS sample
FROM orders WHERE o_orderkey % 4 = 2""")
def q_quarantine_report(spark, sf_dir):
    q_file_quarantine(spark, sf_dir)  # builds the feed folder if needed
    d = fixture(spark, sf_dir, "feed_orders_quarantine", lambda _: None)
    res = land_feed(spark, Feed("orders", d),
                    [LandingField("o_orderkey", "float64"), LandingField("o_totalprice", "float64"),
                     LandingField("o_orderdate", "timestamp")], JOB_TIME)
    return (res.files.filter(F.col("status") == "bad")
            .select("load_file_name", "reason", "bad_rows", "raw_records", "sample"))


# --------------------------------------------------------------------------
# Names, profiling, inference, spec
# --------------------------------------------------------------------------

from flatland.functions.names import (LANDING_DROPPED_CHARS, STAGE_KEYWORDS,  # noqa: E402
                                      landing_name_col, stage_name_col)
from flatland.operators.land import profile_rows  # noqa: E402
from flatland.operators.profile import distinct_values, infer_types, profile_columns  # noqa: E402
from flatland.operators.validate import key_check, key_offenders  # noqa: E402
from flatland.plans.spec import build_spec, plan_from_spec, read_spec, write_spec  # noqa: E402

_SUFFIXES = ["ID", "Name", " (USD)", "qty"]


def _sample_names_sql() -> str:
    word2 = "split_part(p_name, ' ', 2)"
    suffix = "CASE p_size % 4 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_SUFFIXES)) + " END"
    return (f"SELECT DISTINCT lower(split_part(p_name, ' ', 1)) || upper(substr({word2}, 1, 1)) || "
            f"lower(substr({word2}, 2)) || {suffix} || '-' || p_type AS sample FROM part")


def _landing_sql(x: str) -> str:
    out = f"lower(replace(replace({x}, ' ', '_'), '-', '_'))"
    for ch in LANDING_DROPPED_CHARS:
        out = f"replace({out}, '{ch}', '')"
    return out


def _stage_sql_select() -> str:
    s = "regexp_replace(sample, '([A-Z]+)([A-Z][a-z])', '\\1_\\2', 'g')"
    s = f"regexp_replace({s}, '([a-z0-9])([A-Z])', '\\1_\\2', 'g')"
    s = f"regexp_replace(regexp_replace(lower({s}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"
    whens = " ".join(
        f"WHEN suffix(x0, '{kw}') AND length(x0) > {len(kw)} AND NOT suffix(x0, '_{kw}') "
        f"THEN substr(x0, 1, length(x0) - {len(kw)}) || '_{kw}'" for kw in STAGE_KEYWORDS)
    return f"{s} AS x0, CASE {whens} ELSE x0 END AS stage_name"


@query("clean_names", f"""
SELECT sample, {_landing_sql('sample')} AS landing_name, stage_name
FROM (SELECT sample, {_stage_sql_select()} FROM ({_sample_names_sql()}) s) t""")
def q_clean_names(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    w1, w2 = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    suffix = F.element_at(F.array(*[F.lit(s) for s in _SUFFIXES]), (F.col("p_size") % 4 + 1).cast("int"))
    sample = F.concat(F.lower(w1), F.upper(F.substring(w2, 1, 1)), F.lower(F.substring(w2, 2, 1 << 20)),
                      suffix, F.lit("-"), F.col("p_type"))
    s = p.select(sample.alias("sample")).distinct()
    return s.select("sample", landing_name_col(F.col("sample")).alias("landing_name"),
                    stage_name_col(F.col("sample")).alias("stage_name"))


def _lineitem_text_rows(spark, sf_dir):
    d = _feed_dir(spark, sf_dir, "lineitem", lambda: table(spark, sf_dir, "lineitem"), n_files=8)
    res = land_feed(spark, Feed("lineitem", d), [], JOB_TIME)
    return profile_rows(read_parsed(spark, res.parsed_path)).drop("load_file_name", "load_timestamp")


_DT_SQL = "try_strptime({s}, '%Y-%m-%d %H:%M:%S')"


def _profile_sql_for(table_name: str, cols: list[str], ts_parse: str = _DT_SQL) -> str:
    parts = []
    for i, c in enumerate(cols):
        s = f"CAST({c} AS VARCHAR)"
        v = f"TRY_CAST({s} AS DOUBLE)"
        fin = f"({v} IS NOT NULL AND NOT isnan({v}) AND NOT isinf({v}))"
        plain = f"({fin} AND NOT regexp_matches({s}, '[eE]'))"
        ts = ts_parse.format(s=s)
        right = (f"length(regexp_replace(CASE WHEN contains(trim({s}), '.') THEN split_part(trim({s}), '.', 2) "
                 f"ELSE '' END, '0+$', ''))")
        parts.append(
            f"SELECT '{c}' AS column_name, {i + 1} AS position, count(*) AS n_rows, count({s}) AS n_nonnull, "
            f"count(*) FILTER (WHERE {s} IS NULL) AS n_null, CAST(max(length({s})) AS INTEGER) AS max_len, "
            f"count(*) FILTER (WHERE {s} IS NOT NULL AND {v} IS NULL) AS n_bad_number, "
            f"count(*) FILTER (WHERE {s} IS NOT NULL AND {ts} IS NULL) AS n_bad_datetime, "
            f"coalesce(bool_and(CASE WHEN {fin} THEN {v} % 1 = 0 END), true) AS all_integral, "
            f"min(CASE WHEN {fin} THEN {v} END) AS min_number, max(CASE WHEN {fin} THEN {v} END) AS max_number, "
            f"CAST(max(CASE WHEN {plain} THEN greatest(length(split_part(trim({s}), '.', 1)), 1) END) AS INTEGER) AS max_left, "
            f"CAST(max(CASE WHEN {plain} THEN {right} END) AS INTEGER) AS max_right, "
            f"coalesce(bool_or({ts} <> date_trunc('day', {ts})), false) AS has_time "
            f"FROM {table_name}")
    return " UNION ALL ".join(parts)


@query("profile_columns", _profile_sql_for("lineitem", LINEITEM_COLS))
def q_profile_columns(spark, sf_dir):
    return profile_columns(_lineitem_text_rows(spark, sf_dir)).drop("date_layouts")


@query("distinct_values", f"""
WITH kv AS (
  {" UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM lineitem" for c in LINEITEM_COLS)}),
c AS (SELECT column_name, value, count(*) AS frequency FROM kv GROUP BY ALL),
n AS (SELECT column_name, count(value) AS n_distinct FROM c GROUP BY ALL)
SELECT c.column_name, value, frequency, rank, n_distinct FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY frequency DESC, value ASC NULLS FIRST) AS INTEGER) AS rank
  FROM c) c JOIN n USING (column_name) WHERE rank <= 10""")
def q_distinct_values(spark, sf_dir):
    rows = _lineitem_text_rows(spark, sf_dir)
    return distinct_values(rows, LINEITEM_COLS, top_n=10)


def _infer_sql(table_name: str, cols: list[str]) -> str:
    prof = _profile_sql_for(table_name, cols, "TRY_CAST({s} AS TIMESTAMP)")
    scale = "(max_right + 1)"
    prec = f"least(max_left + {scale} + 2, 38)"
    ladder = "CASE WHEN max_len = 1 THEN 1 " + " ".join(
        f"WHEN {n} > floor(max_len * 1.3) THEN {n}" for n in [10, 20, 40, 60, 80, 100, 255, 500, 2000, 4000]) + \
        " ELSE 4000 END"
    landing = ("CASE WHEN n_nonnull = 0 THEN 'string' WHEN n_bad_number = 0 THEN 'float64' "
               "WHEN n_bad_datetime = 0 THEN CASE WHEN has_time THEN 'timestamp' ELSE 'date' END ELSE 'string' END")
    name = table_name.replace("'", "''")
    return f"""SELECT '{name}' AS table_name, column_name, landing_type,
  CASE WHEN landing_type = 'timestamp' THEN 'timestamp(0)' WHEN landing_type = 'date' THEN 'date'
       WHEN landing_type = 'float64' THEN CASE WHEN all_integral THEN
            CASE WHEN max_number > 9223372036854775807.0 OR min_number < -9223372036854775808.0 THEN 'decimal(38,0)'
                 WHEN max_number > 2147483647 OR min_number < -2147483648 THEN 'bigint' ELSE 'integer' END
            ELSE 'decimal(' || {prec} || ',' || least({scale}, {prec}) || ')' END
       WHEN n_nonnull = 0 THEN 'varchar(?)'
       ELSE 'varchar(' || {ladder} || ')' END AS db_type, position
FROM (SELECT *, {landing} AS landing_type FROM ({prof}) p) q"""


PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _text_table(spark, sf_dir, name):
    """A given table's rows as the strings a delimited file would hold."""
    return _as_text(table(spark, sf_dir, name))


@query("infer_types", " UNION ALL ".join([
    _infer_sql("orders", ORDERS_COLS), _infer_sql("part", PART_COLS), _infer_sql("events", EVENTS_COLS)]))
def q_infer_types(spark, sf_dir):
    out = None
    for name in ("orders", "part", "events"):
        inferred = infer_types(profile_columns(_text_table(spark, sf_dir, name)))
        part = inferred.select(F.lit(name).alias("table_name"), "column_name", "landing_type", "db_type", "position")
        out = part if out is None else out.unionByName(part)
    return out


SPEC_NAMES = {"wrk_schema": "wrk_schema", "wrk_table": "wrk_{t}", "stg_schema": "stg_schema",
              "stg_table": "stg_{t}", "tgt_schema": "tgt_schema", "tgt_table": "{t}"}


def _spec_names(t: str) -> dict:
    return {k: v.format(t=t) for k, v in SPEC_NAMES.items()}


def _build_spec_sql(t: str, cols: list[str]) -> str:
    from flatland.functions.names import stage_name
    n = _spec_names(t)
    k = len(cols)
    stg_names = "CASE column_name " + " ".join(f"WHEN '{c}' THEN '{stage_name(c)}'" for c in cols) + " END"
    cols_out = ("action, schema, target_table, target_field, comment, type, char_encoding, pk, fk, "
                "source_system, source_table, source_fields, layer, position")
    N = "CAST(NULL AS VARCHAR)"

    def fixed(layer, pos, action, field, typ, comment, system, table_, source):
        q = lambda v: N if v is None else "'" + v + "'"
        return (f"SELECT {q(action)}, '{n[layer + '_schema']}', '{n[layer + '_table']}', {q(field)}, {q(comment)}, "
                f"{q(typ)}, {N}, {N}, {N}, {q(system)}, {q(table_)}, {q(source)}, '{layer}', {pos}")
    rows = [
        fixed("wrk", 0, "Create Table", None, None, None, None, None, None),
        fixed("wrk", k + 1, "Add Field", "load_file_name", "string", "Automatically added by the application",
              "Flat File", "System Generated", "load_file_name"),
        fixed("wrk", k + 2, "Add Field", "load_timestamp", "timestamp", "Automatically added by the application",
              "Flat File", "System Generated", "load_timestamp"),
        fixed("stg", 0, "Create Table", None, None, None, None, None, None),
        fixed("stg", k + 1, "Add Field", "load_file_name", "varchar(255)", "", "DB Internal", n["wrk_table"],
              "load_file_name"),
        fixed("stg", k + 2, "Add Field", "load_timestamp", "timestamp(0)", "", "DB Internal", n["wrk_table"],
              "load_timestamp"),
        fixed("tgt", 0, "Create Table", None, None, None, None, None, None),
        fixed("tgt", k + 1, "Add Field", "modify_date_time", "timestamp(0)", None, "System Generated",
              "System Generated", "System Generated"),
        fixed("tgt", k + 2, "Add Field", "load_file_name", "varchar(255)", None, "DB Internal", n["stg_table"],
              "load_file_name"),
        fixed("tgt", k + 3, "Add Field", "load_timestamp", "timestamp(0)", None, "DB Internal", n["stg_table"],
              "load_timestamp"),
    ]
    inf = _infer_sql(t, cols)
    layer_rows = [
        f"SELECT 'Add Field', '{n['wrk_schema']}', '{n['wrk_table']}', column_name, {N}, landing_type, {N}, {N}, {N}, "
        f"'Flat File', 'Flat File', column_name, 'wrk', position FROM inf",
        f"SELECT 'Add Field', '{n['stg_schema']}', '{n['stg_table']}', {stg_names}, "
        f"CASE WHEN db_type = 'varchar(?)' THEN 'All records are NULL value, fix data type' END, db_type, {N}, {N}, {N}, "
        f"'DB Internal', '{n['wrk_table']}', column_name, 'stg', position FROM inf",
        f"SELECT 'Add Field', '{n['tgt_schema']}', '{n['tgt_table']}', {stg_names}, {N}, db_type, {N}, {N}, {N}, "
        f"'DB Internal', '{n['stg_table']}', {stg_names}, 'tgt', position FROM inf",
    ]
    body = " UNION ALL ".join(rows + layer_rows)
    return f"WITH inf AS ({inf}) SELECT * FROM ({body}) AS s({cols_out})"


@query("build_spec", _build_spec_sql("customer", CUSTOMER_COLS))
def q_build_spec(spark, sf_dir):
    inferred = infer_types(profile_columns(_text_table(spark, sf_dir, "customer")))
    return build_spec(spark, inferred, _spec_names("customer"))


# The part spec inferred at sf 0.01, written out as the cast list it implies.
@query("spec_plan", f"""
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS INTEGER) AS p_size,
       CAST(p_retailprice AS DECIMAL(7,2)) AS p_retail_price,
       TIMESTAMP '{JOB_TIME_ROUNDED}' AS modify_date_time, TIMESTAMP '{JOB_TIME_ROUNDED}' AS load_timestamp
FROM part""")
def q_spec_plan(spark, sf_dir):
    from flatland.plans.run import run_feed
    d = _feed_dir(spark, sf_dir, "part", lambda: table(spark, sf_dir, "part"), n_files=2)
    feed = Feed("part", d)
    # 1. profile the files, 2. write the spec, 3. a user marks the key, 4. plan from the spec file alone.
    probe = land_feed(spark, feed, [], JOB_TIME)
    rows = profile_rows(read_parsed(spark, probe.parsed_path)).drop("load_file_name", "load_timestamp")
    spec = build_spec(spark, infer_types(profile_columns(rows)), _spec_names("part"))
    spec = spec.withColumn("pk", F.when((F.col("layer") == "tgt") & (F.col("target_field") == "p_partkey"),
                                        F.lit("Y")).otherwise(F.col("pk")))
    run = new_run_dir(spark, "spec_plan")
    write_spec(spec, f"{run}/spec")
    plan = plan_from_spec(read_spec(spark, f"{run}/spec"))
    target = VersionedTable(spark, f"{run}/target", ["p_partkey"], _buckets(spark))
    result = run_feed(spark, feed, plan, target, JOB_TIME, run_dir=f"{run}/load")
    return target.read(result.target_version).drop("load_file_name")


@query("key_check", """
WITH ld AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
            GROUP BY ALL HAVING count(*) > 1),
od AS (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY ALL HAVING count(*) > 1)
SELECT 'lineitem' AS table_name, 'l_orderkey,l_linenumber' AS key_columns,
       (SELECT count(*) FROM ld) = 0 AS is_unique,
       (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL) = 0 AS no_nulls,
       (SELECT count(*) FROM ld) AS duplicate_keys,
       (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS null_key_rows,
       (SELECT string_agg(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR), ','
                          ORDER BY l_orderkey, l_linenumber)
        FROM (SELECT * FROM ld ORDER BY l_orderkey, l_linenumber LIMIT 5) s) AS sample
UNION ALL
SELECT 'orders', 'o_orderkey', (SELECT count(*) FROM od) = 0,
       (SELECT count(*) FROM orders WHERE o_orderkey IS NULL) = 0, (SELECT count(*) FROM od),
       (SELECT count(*) FROM orders WHERE o_orderkey IS NULL),
       (SELECT string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey)
        FROM (SELECT * FROM od ORDER BY o_orderkey LIMIT 5) s)""")
def q_key_check(spark, sf_dir):
    li = key_check(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem")
    od = key_check(table(spark, sf_dir, "orders"), ["o_orderkey"], "orders")
    return li.unionByName(od)


# --------------------------------------------------------------------------
# Metrics, summary, manifest, retention
# --------------------------------------------------------------------------

from flatland.operators.metrics import (flatten_summary, load_counters, load_summary, new_files,  # noqa: E402
                                        retention_report)

_LEVEL_SQL = "CASE grouping(feed, load_file_name) WHEN 0 THEN 'file' WHEN 1 THEN 'folder' ELSE 'job' END"
_EVENTS_AS_FILES = ("SELECT *, event_type AS feed, 'user_' || CAST(user_id AS VARCHAR) || '.txt' AS load_file_name "
                    "FROM events")


def _events_as_landed(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("*", F.col("event_type").alias("feed"),
                     F.concat(F.lit("user_"), F.col("user_id").cast("string"), F.lit(".txt")).alias("load_file_name"))


@query("load_counters", f"""
SELECT feed, load_file_name, {_LEVEL_SQL} AS level, count(*) AS records, count(DISTINCT load_file_name) AS files,
       format('{{:,}}', count(*)) AS records_text
FROM ({_EVENTS_AS_FILES}) e GROUP BY ROLLUP (feed, load_file_name)""")
def q_load_counters(spark, sf_dir):
    return load_counters(_events_as_landed(spark, sf_dir))


@query("load_durations", f"""
SELECT feed, load_file_name, {_LEVEL_SQL} AS level, count(*) AS records, count(DISTINCT load_file_name) AS files,
       format('{{:,}}', count(*)) AS records_text, min(ts) AS level_start, max(ts) AS level_end,
       date_sub('second', min(ts), max(ts)) AS duration_seconds,
       CAST(date_sub('second', min(ts), max(ts)) AS VARCHAR) || ' seconds' AS duration_text
FROM ({_EVENTS_AS_FILES}) e GROUP BY ROLLUP (feed, load_file_name)""")
def q_load_durations(spark, sf_dir):
    return load_counters(_events_as_landed(spark, sf_dir), start_col="ts")


RETENTION_NOW = "2024-02-01 00:00:00"
RETENTION_DAYS = 10


@query("retention", f"""
WITH a AS (SELECT event_type, CAST(floor(date_sub('second', ts, TIMESTAMP '{RETENTION_NOW}') / 86400) AS BIGINT) AS age
           FROM events)
SELECT event_type, count(*) FILTER (WHERE age <= {RETENTION_DAYS}) AS kept_rows,
       count(*) FILTER (WHERE age > {RETENTION_DAYS}) AS expired_rows,
       max(CASE WHEN age <= {RETENTION_DAYS} THEN age END) AS oldest_kept_age_days
FROM a GROUP BY event_type""")
def q_retention(spark, sf_dir):
    now = F.lit(RETENTION_NOW).cast("timestamp_ntz")
    return retention_report(table(spark, sf_dir, "events"), "ts", now, RETENTION_DAYS, "event_type")


def _events_tree(spark, sf_dir) -> str:
    """events as five feed folders (one per event type), one file per day."""
    def build(d):
        ev = table(spark, sf_dir, "events")
        cols = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in EVENTS_COLS]
        lines = ev.select(F.concat_ws("\t", *cols).alias("\t".join(EVENTS_COLS)), "event_type",
                          F.date_format("ts", "yyyyMMdd").alias("day"))
        tmp = f"{d}/_tmp"
        (lines.repartition("event_type", "day").write.partitionBy("event_type", "day")
         .option("header", True).option("sep", "\u0001").option("quote", "\u0000").option("escape", "\u0000")
         .option("escapeQuotes", False).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(tmp))
        for tdir, is_dir in storage.list_dir(spark, tmp):
            if not is_dir:
                continue
            etype = tdir.rstrip("/").rsplit("event_type=", 1)[-1]
            for ddir, _ in storage.list_dir(spark, tdir):
                day = ddir.rstrip("/").rsplit("day=", 1)[-1]
                for f, _ in storage.list_dir(spark, ddir):
                    if f.rsplit("/", 1)[-1].startswith("part-"):
                        storage.rename(spark, f, f"{d}/{etype}/events_{etype}_{day}.txt")
        storage.delete(spark, tmp)
    return fixture(spark, sf_dir, "feeds_events_by_day", build)


_EVENT_FILE_SQL = "'events_' || event_type || '_' || strftime(ts, '%Y%m%d') || '.txt'"
MANIFEST_CUTOFF = "20240115"


@query("load_manifest", f"""
SELECT {_EVENT_FILE_SQL} AS load_file_name, count(*) AS records_loaded
FROM events WHERE strftime(ts, '%Y%m%d') >= '{MANIFEST_CUTOFF}' GROUP BY 1""")
def q_load_manifest(spark, sf_dir):
    d = _events_tree(spark, sf_dir)
    files = storage.glob_files(spark, f"{d}/*/*.txt")
    listing = spark.createDataFrame([(p, p.rsplit("/", 1)[-1]) for p, _, _ in files], "path string, load_file_name string")
    # The manifest of an earlier run: every file of the days before the cut-off.
    manifest = listing.filter(F.regexp_extract("load_file_name", r"_([0-9]{8})\.txt$", 1) < MANIFEST_CUTOFF)
    todo = [r["path"] for r in new_files(listing, manifest, manifest_rows=len(files)).collect()]
    res = land_feed(spark, Feed("events", d), [LandingField("event_id", "float64")], JOB_TIME, paths=todo)
    return res.files.select("load_file_name", "records_loaded")


@query("load_summary", f"""
WITH f AS (SELECT event_type AS folder, {_EVENT_FILE_SQL} AS fileName, count(*) AS n FROM events GROUP BY ALL)
SELECT 'events-load' AS jobName, folder, fileName, n AS fileRawRecords, n AS fileRecordsLoaded,
       CAST(sum(n) OVER (PARTITION BY folder) AS BIGINT) AS folderRecordsLoaded,
       CAST(sum(n) OVER () AS BIGINT) AS jobRecordsLoaded,
       count(*) OVER () AS jobFilesLoaded
FROM f""")
def q_load_summary(spark, sf_dir):
    d = _events_tree(spark, sf_dir)
    paths = [p for p, _, _ in storage.glob_files(spark, f"{d}/*/*.txt")]
    res = land_feed(spark, Feed("events", d), [LandingField("event_id", "float64"), LandingField("ts", "timestamp")],
                    JOB_TIME, paths=paths)
    files = (res.files.withColumn("feed", F.regexp_extract("source_path", r"/([^/]+)/[^/]+$", 1))
             .withColumn("file_start", F.lit(JOB_TIME).cast("timestamp_ntz"))
             .withColumn("file_end", F.lit(JOB_TIME).cast("timestamp_ntz")))
    summary = load_summary(files, "events-load")
    run = new_run_dir(spark, "load_summary")
    summary.write.json(f"{run}/summary")                                       # K7
    back = spark.read.schema(summary.schema).json(f"{run}/summary")
    flat = flatten_summary(back)
    folders = back.select(F.col("folderPath").alias("folder"), "folderRecordsLoaded", "jobRecordsLoaded", "jobFilesLoaded")
    return (flat.join(folders, "folder")
            .select("jobName", "folder", "fileName", "fileRawRecords", "fileRecordsLoaded", "folderRecordsLoaded",
                    "jobRecordsLoaded", "jobFilesLoaded"))


# --------------------------------------------------------------------------
# Streaming
# --------------------------------------------------------------------------

from flatland.streaming.incremental import incremental_land, publish_batches, read_counters, read_landed  # noqa: E402

EVENT_FIELDS = [LandingField("event_id", "float64"), LandingField("ts", "timestamp"),
                LandingField("user_id", "float64"), LandingField("value", "float64")]
EVENT_STAGE = [ColumnMap("event_id", "event_id", "bigint"), ColumnMap("ts", "ts", "timestamp"),
               ColumnMap("user_id", "user_id", "bigint"), ColumnMap("event_type", "event_type", "string"),
               ColumnMap("value", "value", "float64"), ColumnMap("props", "props", "string")]
_DROPS = [("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2100-01-01")]


def _stream_drops(spark, sf_dir, on_batch_factory=None):
    """Three drops of event files into an incoming folder, one availableNow run after each."""
    run = new_run_dir(spark, "stream")
    incoming, sink, ckpt, archive = f"{run}/incoming", f"{run}/sink", f"{run}/checkpoint", f"{run}/archive"
    ev = table(spark, sf_dir, "events")
    feed = Feed("events", incoming)
    hook = on_batch_factory(run) if on_batch_factory else None
    for i, (lo, hi) in enumerate(_DROPS):
        drop = ev.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
        write_delimited(spark, _as_text(drop), incoming, f"drop{i}", n_files=2)
        incremental_land(spark, feed, EVENT_FIELDS, sink, ckpt, JOB_TIME,
                         archive_dir=archive, on_batch=hook)
    return run, sink


@query("stream_land", f"SELECT {', '.join(EVENTS_COLS)} FROM events")
def q_stream_land(spark, sf_dir):
    _run, sink = _stream_drops(spark, sf_dir)
    return map_columns(read_landed(spark, sink), EVENT_STAGE)


def _drop_case_sql() -> str:
    whens = " ".join(f"WHEN ts >= TIMESTAMP '{lo}' AND ts < TIMESTAMP '{hi}' THEN {i}" for i, (lo, hi) in enumerate(_DROPS))
    return f"CASE {whens} END"


@query("stream_counters", f"""
SELECT CAST({_drop_case_sql()} AS BIGINT) AS batch_id, CAST(2 AS BIGINT) AS files_loaded,
       count(*) AS records_loaded, CAST(0 AS BIGINT) AS bad_files
FROM events WHERE {_drop_case_sql()} IS NOT NULL GROUP BY 1""")
def q_stream_counters(spark, sf_dir):
    """Per-batch load counters (T3): one availableNow run per drop, so one batch per drop."""
    _run, sink = _stream_drops(spark, sf_dir)
    c = read_counters(spark, sink)
    return c.groupBy("batch_id").agg(F.count_if(F.col("status") == "loaded").alias("files_loaded"),
                                     F.sum("records_loaded").alias("records_loaded"),
                                     F.count_if(F.col("status") == "bad").alias("bad_files"))


@query("stream_publish", f"""
SELECT {', '.join(EVENTS_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST,
                               event_type DESC NULLS FIRST, value DESC NULLS FIRST, props DESC NULLS FIRST) AS rn
  FROM events) e WHERE rn = 1""")
def q_stream_publish(spark, sf_dir):
    holder = {}

    def factory(run):
        holder["target"] = VersionedTable(spark, f"{run}/target", ["user_id"], _buckets(spark))
        return publish_batches(spark, holder["target"], ["user_id"], ["ts"],
                               transform=lambda rows: map_columns(rows, EVENT_STAGE))
    _stream_drops(spark, sf_dir, factory)
    return holder["target"].read()


USERS_PER_PART = 8


@query("stream_publish_partitions", f"""
SELECT {', '.join(EVENTS_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST,
                               event_type DESC NULLS FIRST, value DESC NULLS FIRST, props DESC NULLS FIRST) AS rn
  FROM events) e WHERE rn = 1""")
def q_stream_publish_partitions(spark, sf_dir):
    """Each micro-batch publishes into a target partitioned by user range,
    rewriting only the partitions of the users it carries (T2)."""
    holder = {}

    def factory(run):
        from flatland.operators.publish import PartitionedTable
        holder["target"] = PartitionedTable(spark, f"{run}/target", ["user_id"],
                                            part_expr=F.floor(F.col("user_id") / USERS_PER_PART))
        return publish_batches(spark, holder["target"], ["user_id"], ["ts"],
                               transform=lambda rows: map_columns(rows, EVENT_STAGE))
    _stream_drops(spark, sf_dir, factory)
    return holder["target"].read().select(*EVENTS_COLS)


# --------------------------------------------------------------------------
# Flagship: a feed end to end, driven by a spec
# --------------------------------------------------------------------------

from flatland.plans.spec import SPEC_SCHEMA, SPEC_COLUMNS  # noqa: E402


def _orders_spec(spark):
    """The mapping spec a user would keep for the orders feed."""
    wrk = [("o_orderkey", "float64"), ("o_custkey", "float64"), ("o_orderstatus", "string"),
           ("o_totalprice", "float64"), ("o_orderdate", "date"), ("o_orderpriority", "string"),
           ("load_file_name", "string"), ("load_timestamp", "timestamp")]
    stg = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "varchar(1)"),
           ("o_totalprice", "decimal(12,2)"), ("o_orderdate", "date"), ("o_orderpriority", "varchar(15)"),
           ("load_file_name", "varchar(255)"), ("load_timestamp", "timestamp(0)")]
    rows = []

    def add(layer, pos, field, typ, system, source, pk=None, action="Add Field"):
        r = dict.fromkeys(SPEC_COLUMNS)
        r.update(action=action, schema=f"{layer}_schema", target_table=f"{layer}_orders", target_field=field,
                 type=typ, source_system=system, source_fields=source, pk=pk, layer=layer, position=pos)
        rows.append(tuple(r[c] for c in SPEC_COLUMNS))
    for layer in ("wrk", "stg", "tgt"):
        add(layer, 0, None, None, None, None, action="Create Table")
    for i, (c, t) in enumerate(wrk, 1):
        add("wrk", i, c, t, "Flat File", c)
    for i, (c, t) in enumerate(stg, 1):
        add("stg", i, c, t, "DB Internal", c)
    for i, (c, t) in enumerate(stg[:6], 1):
        add("tgt", i, c, t, "DB Internal", c, pk="Y" if c == "o_orderkey" else None)
    add("tgt", 7, "modify_date_time", "timestamp(0)", "System Generated", "System Generated")
    add("tgt", 8, "load_file_name", "varchar(255)", "DB Internal", "load_file_name")
    add("tgt", 9, "load_timestamp", "timestamp(0)", "DB Internal", "load_timestamp")
    return spark.createDataFrame(rows, SPEC_SCHEMA)


@query("entry_load", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
       TIMESTAMP '{JOB_TIME_ROUNDED}' AS modify_date_time, TIMESTAMP '{JOB_TIME_ROUNDED}' AS load_timestamp
FROM orders""")
def q_entry_load(spark, sf_dir):
    from flatland.plans.run import run_feed
    d = _feed_dir(spark, sf_dir, "orders", lambda: table(spark, sf_dir, "orders"), n_files=4)
    plan = plan_from_spec(_orders_spec(spark))
    run = new_run_dir(spark, "entry_load")
    target = VersionedTable(spark, f"{run}/target", ["o_orderkey"], _buckets(spark))
    result = run_feed(spark, Feed("orders", d), plan, target, JOB_TIME, run_dir=f"{run}/load")
    return target.read(result.target_version).drop("load_file_name")


# --------------------------------------------------------------------------
# File analyzer over a folder of mixed files (S9, S10, S11, K11) and error counters
# --------------------------------------------------------------------------

from flatland.operators.metrics import error_counters  # noqa: E402
from flatland.plans.analyze import file_settings, profile_folder  # noqa: E402

NATION_COLS = ["n_nationkey", "n_name", "n_regionkey"]
SUPPLIER_COLS = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]


def _analyzer_folder(spark, sf_dir):
    def build(d):
        # Two files of one layout, and two of another name with other columns: four subjects.
        customer = _as_text(table(spark, sf_dir, "customer"))
        for odd in (0, 1):
            write_delimited(spark, customer.filter(F.col("c_custkey").cast("long") % 2 == odd), d, f"customer.{odd}", n_files=1,
                            delimiter=",", quoting=0, extension="csv")
        write_delimited(spark, _as_text(table(spark, sf_dir, "supplier")), d, "supplier", n_files=1,
                        delimiter="\t", extension="tsv")
        write_delimited(spark, _as_text(table(spark, sf_dir, "nation")), d, "nation", n_files=1,
                        delimiter="|", quoting=0, extension="dat")
        write_delimited(spark, _as_text(table(spark, sf_dir, "region")), d, "region", n_files=1,
                        delimiter="|", quoting=0, extension="json")   # not an analyzer extension
    return fixture(spark, sf_dir, "analyzer_folder_by_file", build)


def _subject_sql(subject: str, table_name: str, cols: list[str]) -> str:
    return (f"SELECT '{subject}' AS subject, column_name, landing_type, db_type, position "
            f"FROM ({_infer_sql(table_name, cols)}) i")


@query("profile_folder", " UNION ALL ".join([
    _subject_sql("customer.0_00000", "(SELECT * FROM customer WHERE c_custkey % 2 = 0) c", CUSTOMER_COLS),
    _subject_sql("customer.1_00000", "(SELECT * FROM customer WHERE c_custkey % 2 = 1) c", CUSTOMER_COLS),
    _subject_sql("nation_00000", "nation", NATION_COLS),
    _subject_sql("supplier_00000", "supplier", SUPPLIER_COLS)]))
def q_profile_folder(spark, sf_dir):
    out = profile_folder(spark, _analyzer_folder(spark, sf_dir))
    return out.select("subject", "column_name", "landing_type", "db_type", "position")


@query("file_settings", """
SELECT * FROM (VALUES ('customer.0_00000.csv', '0_00000.csv', ',', 'utf-8'), ('customer.1_00000.csv', '1_00000.csv', ',', 'utf-8'),
                      ('nation_00000.dat', 'dat', '|', 'utf-8'), ('supplier_00000.tsv', 'tsv', chr(9), 'utf-8'))
       AS t(file_name, extension, delimiter, encoding)""")
def q_file_settings(spark, sf_dir):
    from flatland.plans.analyze import analyzer_files
    d = _analyzer_folder(spark, sf_dir)
    return file_settings(spark, analyzer_files(spark, d)).select("file_name", "extension", "delimiter", "encoding")


@query("load_errors", """
SELECT feed, bad_files, warnings, files_loaded, records_loaded FROM (VALUES
  ('orders', 1, 0, 3, (SELECT count(*) FROM orders WHERE o_orderkey % 4 <> 2)),
  ('supplier', 2, 0, 2, (SELECT count(*) FROM supplier WHERE s_suppkey % 2 = 0)),
  (NULL, 3, 0, 5, (SELECT count(*) FROM orders WHERE o_orderkey % 4 <> 2)
                  + (SELECT count(*) FROM supplier WHERE s_suppkey % 2 = 0)))
  AS t(feed, bad_files, warnings, files_loaded, records_loaded)""")
def q_load_errors(spark, sf_dir):
    q_file_quarantine(spark, sf_dir)          # makes sure both feed folders exist
    q_spec_conformance(spark, sf_dir)
    orders = land_feed(spark, Feed("orders", fixture(spark, sf_dir, "feed_orders_quarantine", lambda _: None)),
                       [LandingField("o_orderkey", "float64"), LandingField("o_totalprice", "float64"),
                        LandingField("o_orderdate", "timestamp")], JOB_TIME)
    supp = land_feed(spark, Feed("supplier", fixture(spark, sf_dir, "feed_supplier_conformance", lambda _: None)),
                     SUPPLIER_FIELDS, JOB_TIME)
    out = error_counters(orders.files.unionByName(supp.files))
    return out.select("feed", F.col("bad_files").cast("int").alias("bad_files"),
                      F.col("warnings").cast("int").alias("warnings"),
                      F.col("files_loaded").cast("int").alias("files_loaded"), "records_loaded")


# --------------------------------------------------------------------------
# Exact integers from landing to publish
# --------------------------------------------------------------------------

# Neighbours here differ only beyond a double's 53 bits.
BIG_KEY = 900719925474099300


def _orders_spec_for(spark, stage_types: dict[str, str], key: str):
    """A three-layer spec of orders' columns with the given stage types."""
    rows = []
    for layer in ("wrk", "stg", "tgt"):
        fields = [(c, {"decimal(12,2)": "float64", "bigint": "float64"}.get(t, t) if layer == "wrk" else t) for c, t in stage_types.items()]
        for i, (c, t) in enumerate([(None, None), *fields]):
            r = dict.fromkeys(SPEC_COLUMNS)
            r.update(action="Add Field" if c else "Create Table", schema=f"{layer}_schema", target_table=f"{layer}_orders", target_field=c,
                     type=t, source_system="Flat File" if layer == "wrk" and c else "DB Internal" if c else None, source_fields=c,
                     pk="Y" if layer == "tgt" and c == key else None, layer=layer, position=i)
            rows.append(tuple(r[x] for x in SPEC_COLUMNS))
    return spark.createDataFrame(rows, SPEC_SCHEMA)


@query("exact_keys", f"""
SELECT {BIG_KEY} + o_orderkey AS big_key, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice FROM orders""")
def q_exact_keys(spark, sf_dir):
    """18-digit keys through land, stage, latest row per key and publish: none lost, none changed."""
    from flatland.plans.run import run_feed
    d = _feed_dir(spark, sf_dir, "orders_big", lambda: table(spark, sf_dir, "orders").select(
        (F.lit(BIG_KEY) + F.col("o_orderkey")).alias("big_key"), "o_totalprice"), n_files=2)
    plan = plan_from_spec(_orders_spec_for(spark, {"big_key": "bigint", "o_totalprice": "decimal(12,2)"}, "big_key"))
    run = new_run_dir(spark, "exact_keys")
    target = VersionedTable(spark, f"{run}/target", ["big_key"], _buckets(spark))
    result = run_feed(spark, Feed("orders_big", d), plan, target, JOB_TIME, run_dir=f"{run}/load")
    return target.read(result.target_version).select("big_key", "o_totalprice")


@query("exact_casts", """
SELECT o_orderkey, 9007199254740992 + o_orderkey AS from_bigint, 9007199254740992 + o_orderkey AS from_text,
       CAST(round_even(o_orderkey / 2, 0) AS INTEGER) AS from_decimal
FROM orders""")
def q_exact_casts(spark, sf_dir):
    big = F.lit(9007199254740992) + F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", big.alias("b"), F.concat(F.lit(" +"), big.cast("string")).alias("t"),
                                              (F.col("o_orderkey").cast("decimal(20,1)") / 2).cast("decimal(20,1)").alias("d"))
    return map_columns(o, [ColumnMap("o_orderkey", "o_orderkey", "bigint"), ColumnMap("b", "from_bigint", "bigint"),
                           ColumnMap("t", "from_text", "bigint"), ColumnMap("d", "from_decimal", "integer")])


# --------------------------------------------------------------------------
# Publish: text partitions, duplicate stage keys
# --------------------------------------------------------------------------

_TEXT_PART_SQL = "CASE o_orderkey % 4 WHEN 0 THEN '01' WHEN 1 THEN '1' WHEN 2 THEN '' ELSE '2024-01-01' END"


@query("publish_text_partitions", f"""
SELECT {_TEXT_PART_SQL} || '/' || o_orderkey AS k, o_totalprice + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS o_totalprice
FROM orders""")
def q_publish_text_partitions(spark, sf_dir):
    """A text partition value with leading zeros, one that is empty and one like a date, published twice."""
    from flatland.operators.publish import PartitionedTable, publish_partitions
    part = F.when(F.col("o_orderkey") % 4 == 0, "01").when(F.col("o_orderkey") % 4 == 1, "1").when(F.col("o_orderkey") % 4 == 2, "").otherwise("2024-01-01")
    o = table(spark, sf_dir, "orders").select(F.concat(part, F.lit("/"), F.col("o_orderkey").cast("string")).alias("k"), "o_orderkey", "o_totalprice")
    target = PartitionedTable(spark, f"{new_run_dir(spark, 'publish_text')}/target", ["k"], part_expr=F.split_part("k", F.lit("/"), F.lit(1)))
    publish_partitions(spark, o.drop("o_orderkey"), target)
    publish_partitions(spark, o.filter(F.col("o_orderkey") % 3 == 0).select("k", (F.col("o_totalprice") + 1).alias("o_totalprice")), target)
    return target.read()


@query("duplicate_stage_keys", """
SELECT 'versioned' AS layout, count(*) > count(DISTINCT o_custkey) AS refused, CAST(0 AS BIGINT) AS published FROM orders
UNION ALL SELECT 'partitioned', count(*) > count(DISTINCT o_custkey), 0 FROM orders""")
def q_duplicate_stage_keys(spark, sf_dir):
    """A stage with duplicate keys is refused and leaves no target."""
    from flatland.operators.publish import PartitionedTable, publish_partitions
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    run = new_run_dir(spark, "duplicate_keys")
    versioned, parts = VersionedTable(spark, f"{run}/v"), PartitionedTable(spark, f"{run}/p", ["o_custkey"])
    out = []
    for layout, target, go in (("versioned", versioned, lambda: publish(spark, o, versioned, ["o_custkey"])),
                               ("partitioned", parts, lambda: publish_partitions(spark, o, parts))):
        try:
            go()
            refused = False
        except ValueError:
            refused = True
        left = target.read()
        out.append((layout, refused, 0 if left is None else left.count()))
    return spark.createDataFrame(out, "layout string, refused boolean, published long")


# --------------------------------------------------------------------------
# Steps after the latest row per key; files loaded once
# --------------------------------------------------------------------------

def _events_plan(spark):
    types = {"event_id": "bigint", "ts": "timestamp", "user_id": "bigint", "event_type": "varchar(20)", "value": "float64", "props": "string"}
    return plan_from_spec(_orders_spec_for(spark, types, "user_id"))


_LATEST_EVENT = """SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC NULLS FIRST, ts DESC NULLS FIRST,
  event_type DESC NULLS FIRST, value DESC NULLS FIRST, props DESC NULLS FIRST) AS rn FROM events"""


@query("steps_after_latest", f"""
SELECT user_id, event_id, event_type FROM ({_LATEST_EVENT}) e WHERE rn = 1 AND event_type <> 'click'""")
def q_steps_after_latest(spark, sf_dir):
    """A step that deletes a user's latest row must not bring an older one back."""
    from flatland.plans.run import FeedSteps, run_all
    d = _feed_dir(spark, sf_dir, "events", lambda: table(spark, sf_dir, "events"), n_files=3)
    run = new_run_dir(spark, "steps_after_latest")
    target = VersionedTable(spark, f"{run}/target", ["user_id"], _buckets(spark))
    steps = FeedSteps(stage=[Step("no clicks", "delete", pred=F.col("event_type") == "click")])
    (done,) = run_all(spark, [Feed("events", d)], {"events": _events_plan(spark)}, {"events": target}, JOB_TIME, steps={"events": steps})
    if done.error:
        raise RuntimeError(done.error)
    return target.read().select("user_id", "event_id", "event_type")


@query("load_once", """
WITH n AS (SELECT count(*) FILTER (WHERE o_orderkey % 2 = 0) AS even, count(*) AS total FROM orders)
SELECT 1 AS run_no, 2 AS files, even AS records_loaded, even AS target_rows FROM n
UNION ALL SELECT 2, 0, 0, even FROM n
UNION ALL SELECT 3, 2, total - even, total FROM n""")
def q_load_once(spark, sf_dir):
    """Three runs over one folder: all files, none again, then the files that have arrived since."""
    from flatland.plans.run import file_metrics, run_all
    run = new_run_dir(spark, "load_once")
    feed, plan = Feed("orders", f"{run}/in"), plan_from_spec(_orders_spec(spark))
    target = VersionedTable(spark, f"{run}/target", ["o_orderkey"], _buckets(spark))
    o = _as_text(table(spark, sf_dir, "orders"))
    out = []
    for n in (1, 2, 3):
        if n != 2:
            write_delimited(spark, o.filter(F.col("o_orderkey").cast("long") % 2 == n // 2), f"{run}/in", f"orders{n}", n_files=2)
        runs = run_all(spark, [feed], {"orders": plan}, {"orders": target}, JOB_TIME, manifest=f"{run}/manifest", summary=f"{run}/summary")
        if runs[0].error:
            raise RuntimeError(runs[0].error)
        files = file_metrics(spark, runs)
        out.append((n, files.count(), files.agg(F.coalesce(F.sum("records_loaded"), F.lit(0))).first()[0], target.read().count()))
    return spark.createDataFrame(out, "run_no int, files int, records_loaded long, target_rows long")


# --------------------------------------------------------------------------
# Date layouts (V4); quoted files at any split size
# --------------------------------------------------------------------------

# Layout number: (DuckDB format, Spark pattern, what is lost of the value).
DATE_LAYOUTS = [
    ("%Y-%m-%d %H:%M", "yyyy-MM-dd HH:mm", "minute"), ("%Y-%m-%dT%H:%M:%SZ", "yyyy-MM-dd'T'HH:mm:ss'Z'", "second"), ("%Y-%m-%dT%H:%M", "yyyy-MM-dd'T'HH:mm", "minute"),
    (" %Y-%m-%d ", " yyyy-MM-dd ", "day"), ("%Y/%m/%d", "yyyy/MM/dd", "day"), ("%Y-%-m-%-d", "yyyy-M-d", "day"), ("%b %-d, %Y", "MMM d, yyyy", "day"),
    ("%-d %B %Y", "d MMMM yyyy", "day"), ("%-m/%-d/%y", "M/d/yy", "day"), ("%d-%b-%y", "dd-MMM-yy", "day"),
    ("%Y-%m-%d %H:%M:%S+00:00", "yyyy-MM-dd HH:mm:ss'+00:00'", "second"), ("%Y-%m-%d %H:%M:%S.1234567", "yyyy-MM-dd HH:mm:ss'.1234567'", "tenths"),
]
# Dates before 2000 with two-digit years read as 20xx, so the planted times are from then on.
_LAYOUT_T = "(TIMESTAMP '2001-03-04' + to_seconds(o_orderkey * 86399))"


@query("date_layouts", f"""
SELECT o_orderkey, CASE r {' '.join(
    f"WHEN {i} THEN " + (f"date_trunc('second', t) + to_microseconds(123456)" if lost == "tenths" else f"date_trunc('{lost}', t)")
    for i, (_, _, lost) in enumerate(DATE_LAYOUTS))} ELSE date_trunc('day', t) END AS ts
FROM (SELECT o_orderkey, o_orderkey % {len(DATE_LAYOUTS) + 1} AS r, {_LAYOUT_T.replace("o_orderkey * 86399", "(o_orderkey % 20000) * 86399")} AS t FROM orders) s""")
def q_date_layouts(spark, sf_dir):
    """The layouts that files really have, trimmed, and one of the feed's own."""
    def build(d):
        o = table(spark, sf_dir, "orders")
        r = F.col("o_orderkey") % (len(DATE_LAYOUTS) + 1)
        t = F.timestamp_add("SECOND", (F.col("o_orderkey") % 20000) * 86399, F.lit("2001-03-04").cast("timestamp_ntz"))
        text = F.date_format(t, "'year' yyyy, 'day' MM'of'dd")
        for i, (_, pattern, _) in enumerate(DATE_LAYOUTS):
            text = F.when(r == i, F.date_format(t, pattern)).otherwise(text)
        write_delimited(spark, o.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), text.alias("ts")), d, "orders_dates", n_files=3)
    d = fixture(spark, sf_dir, "feed_orders_dates", build)
    feed = Feed("orders_dates", d, date_layouts=("'year' yyyy, 'day' MM'of'dd",))
    res = land_feed(spark, feed, [LandingField("o_orderkey", "number"), LandingField("ts", "timestamp")], JOB_TIME)
    return map_columns(res.rows, [ColumnMap("o_orderkey", "o_orderkey", "bigint"), ColumnMap("ts", "ts", "timestamp")])


_QUOTED_CELL_SQL = """CASE o_orderkey % 5 WHEN 0 THEN '5" pipe' WHEN 1 THEN 'a' || chr(13) || 'b' WHEN 2 THEN 'two' || chr(10) || 'lines, "said" he'
  WHEN 3 THEN 'plain' ELSE repeat('x"y', 200) END"""


@query("quoted_whole_table", f"""
SELECT split_bytes, o_orderkey, REPLACE({_QUOTED_CELL_SQL}, '"', '') AS cell,
       (SELECT count(*) + count(*) FILTER (WHERE o_orderkey % 5 = 2) FROM orders) AS raw_records
FROM orders, (VALUES (32768), (262144), (0)) AS s(split_bytes)""")
def q_quoted_whole_table(spark, sf_dir):
    """Bare quotes, a lone CR, line breaks and doubled quotes over all of orders: one result at every split size. The
    file that is set aside holds every order too; some of its values have 150 KB and a surplus cell after them."""
    def build(d):
        o = table(spark, sf_dir, "orders")
        r, key = F.col("o_orderkey") % 5, F.col("o_orderkey").cast("string")
        cell = (F.when(r == 0, F.lit('5" pipe')).when(r == 1, F.lit('"a\rb"')).when(r == 2, F.lit('"two\nlines, ""said"" he"'))
                .when(r == 3, F.lit("plain")).otherwise(F.concat(F.lit('"'), F.repeat(F.lit('x""y'), 200), F.lit('"'))))
        write_delimited(spark, o.select(F.concat(key, F.lit(","), cell).alias("o_orderkey,cell")), d, "quoted", n_files=2, at_least=True, extension="csv")
        long = F.concat(F.lit('"'), F.repeat(F.lit('z""'), 50_000), F.lit('",surplus'))
        bad = F.concat(key, F.lit(","), F.when(F.col("o_orderkey") % 5000 == 1, long).otherwise(cell))
        write_delimited(spark, o.select(bad.alias("o_orderkey,cell")), d, "ragged", n_files=1, extension="csv")
    d = fixture(spark, sf_dir, "feed_quoted_whole_table", build)
    out = None
    for split in (32768, 262144, 0):
        feed = Feed("quoted", d, extension="csv", delimiter=",", quoting=0, quoted_split_bytes=split or None)
        res = land_feed(spark, feed, [LandingField("o_orderkey", "number")], JOB_TIME)
        raw = res.files.filter(F.col("status") == "loaded").agg(F.sum("raw_records").alias("raw_records"))
        part = map_columns(res.rows, [ColumnMap("o_orderkey", "o_orderkey", "bigint"), ColumnMap("cell", "cell", "string")]).select(
            F.lit(split).alias("split_bytes"), "o_orderkey", "cell").join(F.broadcast(raw))
        out = part if out is None else out.unionByName(part)
    return out


@query("file_faults", """
WITH o AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'good' WHEN 1 THEN 'open' ELSE 'bytes' END AS f FROM orders),
n AS (SELECT f, count(*) AS raw_records, sum(o_orderkey) AS keys FROM o GROUP BY f)
SELECT split_bytes, f || '_00000.csv' AS load_file_name, CASE f WHEN 'good' THEN 'loaded' ELSE 'bad' END AS status,
       CASE f WHEN 'open' THEN 'file ends inside a quoted value' WHEN 'bytes' THEN 'bytes that utf-8 does not have' END AS reason, raw_records,
       CASE f WHEN 'good' THEN raw_records ELSE 0 END AS records_loaded, CAST(CASE f WHEN 'good' THEN keys END AS BIGINT) AS keys
FROM n, (VALUES (8192), (65536), (0)) AS s(split_bytes)""")
def q_file_faults(spark, sf_dir):
    """All of orders in three files: one is fine, one has a quote that is never closed, one has bytes that are
    no UTF-8. What is loaded and why not is the same at every split size."""
    def build(d):
        key = F.col("o_orderkey")
        o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
        first = {r["m"]: r["k"] for r in o.groupBy((key % 3).alias("m")).agg(F.min("o_orderkey").alias("k")).collect()}
        cells = {"good": F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit('"')),
                 "open": F.when(key == first.get(1), F.lit('"never closed')).otherwise(F.col("o_orderpriority")),
                 "bytes": F.when(key == first.get(2), F.concat(F.lit('"caf'), F.unhex(F.lit("E9")).cast("string"), F.lit('"'))).otherwise(F.col("o_orderpriority"))}
        for m, (name, cell) in enumerate(cells.items()):
            write_lines(spark, o.where(key % 3 == m).select(F.concat(key.cast("string"), F.lit(","), cell).alias("line")), "o_orderkey,cell", d, name, "csv")
    d = fixture(spark, sf_dir, "feed_file_faults", build)
    out = None
    for split in (8192, 65536, 0):
        res = land_feed(spark, Feed("faults", d, extension="csv", delimiter=",", quoting=0, quoted_split_bytes=split or None),
                        [LandingField("o_orderkey", "number")], JOB_TIME)
        keys = res.rows.groupBy("load_file_name").agg(F.sum(F.col("o_orderkey").cast("bigint")).alias("keys"))
        part = res.files.join(keys, "load_file_name", "left").select(
            F.lit(split).alias("split_bytes"), "load_file_name", "status", "reason", "raw_records", "records_loaded", "keys")
        out = part if out is None else out.unionByName(part)
    return out


_ACCENTED_SQL = "'façade n° ' || o_orderkey || chr(10) || 'ñandú, « ' || o_orderpriority || ' »'"


@query("encoded_copies", f"""
SELECT copy, split_bytes, o_orderkey, {_ACCENTED_SQL} AS cell
FROM orders, (VALUES ('utf-8', 16384), ('latin-1', 16384), ('latin-1', 0), ('cr', 16384)) AS s(copy, split_bytes)""")
def q_encoded_copies(spark, sf_dir):
    """Copies of one quoted file in UTF-8, in Latin-1 and with lines that end with CR alone, read in many splits: equal rows."""
    def lines(end):
        cell = F.concat(F.lit("façade n° "), F.col("o_orderkey").cast("string"), F.lit(end + "ñandú, « "), F.col("o_orderpriority"), F.lit(" »"))
        return table(spark, sf_dir, "orders").select(F.concat(F.col("o_orderkey").cast("string"), F.lit(',"'), cell, F.lit('"')).alias("line"))
    folders = {
        "utf-8": fixture(spark, sf_dir, "feed_copy_utf8", lambda d: write_lines(spark, lines("\n"), "o_orderkey,cell", d, "copy", "csv")),
        "latin-1": fixture(spark, sf_dir, "feed_copy_latin1", lambda d: write_lines(spark, lines("\n"), "o_orderkey,cell", d, "copy", "csv", encoding="latin-1")),
        "cr": fixture(spark, sf_dir, "feed_copy_cr", lambda d: write_lines(spark, lines("\r"), "o_orderkey,cell", d, "copy", "csv", line_sep="\r"))}
    out = None
    for copy, split in (("utf-8", 16384), ("latin-1", 16384), ("latin-1", 0), ("cr", 16384)):
        feed = Feed("copies", folders[copy], extension="csv", delimiter=",", quoting=0, encoding=copy.replace("cr", "utf-8"), quoted_split_bytes=split or None)
        res = land_feed(spark, feed, [LandingField("o_orderkey", "number")], JOB_TIME)
        part = map_columns(res.rows, [ColumnMap("o_orderkey", "o_orderkey", "bigint"), ColumnMap("cell", "cell", "string")]).select(
            F.lit(copy).alias("copy"), F.lit(split).alias("split_bytes"), "o_orderkey", "cell")
        out = part if out is None else out.unionByName(part)
    return out


@query("date_layout_vote", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day_first, CAST(o_orderdate AS DATE) AS month_first, CAST(o_orderdate AS DATE) AS dotted,
       CAST(o_orderdate AS DATE) AS named, 'd/M/yyyy, M/d/yyyy, d.M.yyyy[ H:mm[:ss]], MMMM d yyyy[ H:mm[:ss]]' AS layouts
FROM orders""")
def q_date_layout_vote(spark, sf_dir):
    """Orders' dates in four layouts, day first and month first among them: each column's layout is found from all
    its values, kept in the spec, and read by that."""
    def build(d):
        o, t = table(spark, sf_dir, "orders"), F.col("o_orderdate")
        write_delimited(spark, o.select("o_orderkey", F.date_format(t, "dd/MM/yyyy").alias("day_first"), F.date_format(t, "M/d/yyyy").alias("month_first"),
                                        F.date_format(t, "dd.MM.yyyy").alias("dotted"), F.date_format(t, "EEEE, MMMM d, yyyy").alias("named")), d, "layouts", n_files=3, at_least=True)
    from flatland.plans.spec import LAYOUT_COMMENT
    d = fixture(spark, sf_dir, "feed_layout_vote", build)
    feed = Feed("layouts", d)
    probe = land_feed(spark, feed, [], JOB_TIME)
    rows = profile_rows(read_parsed(spark, probe.parsed_path)).drop("load_file_name", "load_timestamp")
    plan = plan_from_spec(build_spec(spark, infer_types(profile_columns(rows)), _spec_names("layouts")))
    named = ", ".join(f.layout for f in plan.landing if f.layout)
    res = land_feed(spark, feed, plan.landing, JOB_TIME)
    return map_columns(res.rows, [ColumnMap("o_orderkey", "o_orderkey", "bigint"), *[ColumnMap(c, c, "date") for c in ("day_first", "month_first", "dotted", "named")]]
                       ).withColumn("layouts", F.lit(named))


# --------------------------------------------------------------------------
# Offending rows of a key (A10, O3); mergeable sketches of columns (A4, U4)
# --------------------------------------------------------------------------

_OFFENDER_COLS = "l_orderkey, l_part, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate"


@query("key_offenders", f"""
WITH l AS (SELECT l_orderkey, nullif(l_linenumber, 7) AS l_part, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM lineitem),
d AS (SELECT l_orderkey, l_part FROM l WHERE l_orderkey IS NOT NULL AND l_part IS NOT NULL GROUP BY ALL HAVING count(*) > 1
      ORDER BY l_orderkey, l_part LIMIT 20),
r AS (
  SELECT 'duplicate' AS offence, {_OFFENDER_COLS}, row_number() OVER (PARTITION BY l_orderkey, l_part ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS n
  FROM l JOIN d USING (l_orderkey, l_part)
  UNION ALL
  SELECT 'null key', {_OFFENDER_COLS}, row_number() OVER (ORDER BY l_orderkey NULLS FIRST, l_part NULLS FIRST, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate)
  FROM l WHERE l_orderkey IS NULL OR l_part IS NULL)
SELECT offence, {_OFFENDER_COLS} FROM r WHERE n <= CASE offence WHEN 'duplicate' THEN 3 ELSE 60 END""")
def q_key_offenders(spark, sf_dir):
    """Whole rows that break a key: up to 3 of each of the first 20 duplicated keys, and 60 rows with a null in it."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.nullif(F.col("l_linenumber"), F.lit(7)).alias("l_part"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    return key_offenders(rows, ["l_orderkey", "l_part"], n_keys=20, n_rows=3)


@query("sketch_distinct", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, true AS close, true AS merged_equal FROM orders" for c in ORDERS_COLS))
def q_sketch_distinct(spark, sf_dir):
    """Sketches of every column of orders for each year's file, merged: within 6 percent of the exact counts, and the same as
    those of the whole table at once."""
    from flatland.operators.profile import unpivot
    from flatland.operators.sketches import column_sketches, merge_sketches, sketch_facts
    o = table(spark, sf_dir, "orders")
    long = unpivot(o, ORDERS_COLS, file=F.year("o_orderdate").cast("string"))
    stored = new_run_dir(spark, "sketches")
    column_sketches(long, ["file", "column_name"]).write.partitionBy("file").parquet(stored)        # kept with each file
    merged = sketch_facts(merge_sketches(spark.read.parquet(stored), ["column_name"])).select("column_name", F.col("n_distinct").alias("by_file"))
    whole = sketch_facts(column_sketches(long, ["column_name"])).select("column_name", F.col("n_distinct").alias("at_once"))
    exact = long.groupBy("column_name").agg(F.count_distinct("s").alias("n_distinct"))
    apart = F.abs(F.col("by_file") - F.col("n_distinct")) <= F.greatest(F.lit(1), 0.06 * F.col("n_distinct"))
    same = F.abs(F.col("by_file") - F.col("at_once")) <= F.greatest(F.lit(1), 0.06 * F.col("n_distinct"))
    return exact.join(merged, "column_name").join(whole, "column_name").select("column_name", "n_distinct", apart.alias("close"), same.alias("merged_equal"))
