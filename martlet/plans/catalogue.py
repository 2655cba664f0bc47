"""Catalogue of queries over the driver tables: one per operator family.

Each entry maps the reference's domain onto the TPC-H-like tables and runs
the library operator on the *whole* tables:

    games    <- part      (game_id = p_partkey, game_name = p_name)
    streams  <- lineitem  (stream_id = l_orderkey*10 + l_linenumber,
                           game_id = l_partkey, viewer_count = l_quantity,
                           soft-deleted when l_returnflag = 'R')
    hours    <- lineitem  (main_story = 1.2*qty - 3.6, ... as decimal(6,2))
    load log <- events    (source = 'SRC' || user_id % 10, one load per event)

Every query has an ANSI SQL twin (``ORACLE``) with the same column names,
written independently against the raw tables, which DuckDB runs as the
correctness oracle. Edge cases the tables lack (blanks, NULLs, orphans) are
derived deterministically inside both the query and its SQL.
"""

from __future__ import annotations

import functools
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from martlet.functions import (
    blank_to_null, default_if_blank, is_present, trimmed, positive_decimal,
    null_to_zero_int, to_bool, is_rejected, map_from_json, map_value,
    array_first, array_nth, normalize_column_names,
)
from martlet.operators import (
    keep_first, top_k_per_key, distinct_values, split_by_kind, union_kinds,
    first_match_lookup, unmatched_titles, enrich_children, null_blank_share,
    quality_report, not_null_violations, unique_violations, fk_violations,
    max_length_violations, constraint_summary, popular_entities, entity_kpis,
    load_summary, log_kpis, duration_view, casted_view, count_per_category,
    mode_comparison, stat_leaders, value_distribution, usage_ranking, longest,
    with_audit_columns, with_duration_seconds,
)
from martlet.operators.audit import duration_seconds
from martlet.plans.specs import clean, reject_counts, TWITCH, HLTB, POKEDEX, PROFILES
from martlet.session import scratch_path
from martlet.sinks import append_new_rows, export_csv, write_parquet
from martlet.sources import (
    conform_to_schema, flatten_keyed_objects, read_pages, read_table,
)
from martlet.sources.schemas import schema_of, S, L, I

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a catalogue query (and its SQL twin). The registered callable
    pins the session time zone to UTC, the library's contract for parsing
    naive and ``Z``-marked stamps (T4, T5)."""
    def deco(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        REGISTRY[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------- adapters
def games(spark, d) -> DataFrame:
    return read_table(spark, d, "part", ["p_partkey", "p_name"]).select(
        F.col("p_partkey").alias("game_id"), F.col("p_name").alias("game_name"),
        F.lit(False).alias("dw_deleted"))


def streams(spark, d) -> DataFrame:
    return read_table(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("stream_id"),
        F.col("l_partkey").alias("game_id"),
        F.col("l_quantity").cast("int").alias("viewer_count"),
        (F.col("l_returnflag") == "R").alias("dw_deleted"))


def hours(spark, d, scale: bool = True) -> DataFrame:
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber",
                                           "l_quantity", "l_returnflag"])
    q = F.col("l_quantity")
    story = positive_decimal(q * F.lit(1.2) - F.lit(3.6)) if scale else positive_decimal(q)
    return li.select(
        F.concat(F.lit("G"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"))
        .alias("game_title"),
        story.alias("main_story"),
        positive_decimal(q * F.lit(1.5) - F.lit(10.0)).alias("main_extra"),
        positive_decimal(q * F.lit(2.0)).alias("completionist"),
        (F.col("l_returnflag") == "R").alias("dw_deleted"))


def load_log(spark, d) -> DataFrame:
    ev = read_table(spark, d, "events", ["ts", "user_id", "event_type", "value"])
    secs = F.floor("value").cast("bigint")
    log = ev.select(
        F.concat(F.lit("SRC"), (F.col("user_id") % 10).cast("string")).alias("source"),
        F.col("ts").alias("load_start_time"),
        F.timestamp_add("SECOND", secs, F.col("ts")).alias("load_end_time"),
        secs.alias("records_count"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("SUCCESS").alias("status"))
    return with_duration_seconds(log)


_GAMES_SQL = "SELECT p_partkey AS game_id, p_name AS game_name, FALSE AS dw_deleted FROM part"
_STREAMS_SQL = ("SELECT l_orderkey * 10 + l_linenumber AS stream_id, l_partkey AS game_id, "
                "CAST(l_quantity AS INTEGER) AS viewer_count, "
                "l_returnflag = 'R' AS dw_deleted FROM lineitem")
_LOG_SQL = """SELECT 'SRC' || CAST(user_id % 10 AS VARCHAR) AS source,
       ts AS load_start_time,
       ts + to_seconds(CAST(floor(value) AS BIGINT)) AS load_end_time,
       CAST(floor(value) AS BIGINT) AS records_count,
       CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'SUCCESS' END AS status,
       CAST(CAST(floor(value) AS BIGINT) AS DECIMAL(10,2)) AS duration_seconds
FROM events"""


def _dec(x: str) -> str:
    return f"CASE WHEN ({x}) > 0 THEN TRY_CAST(({x}) AS DECIMAL(6,2)) END"


def _hours_sql(scale: bool = True) -> str:
    story = _dec("l_quantity * 1.2::DOUBLE - 3.6::DOUBLE") if scale else _dec("l_quantity")
    return f"""SELECT 'G' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS game_title,
       {story} AS main_story,
       {_dec("l_quantity * 1.5::DOUBLE - 10.0::DOUBLE")} AS main_extra,
       {_dec("l_quantity * 2.0::DOUBLE")} AS completionist,
       l_returnflag = 'R' AS dw_deleted
FROM lineitem"""


_BANDS_SQL = """CASE WHEN main_story < 10 THEN 'Corto (< 10h)'
            WHEN main_story BETWEEN 10 AND 25 THEN 'Medio (10-25h)'
            WHEN main_story BETWEEN 25 AND 50 THEN 'Largo (25-50h)'
            WHEN main_story > 50 THEN 'Muy Largo (> 50h)'
            ELSE 'Sin datos' END"""


# ------------------------------------------------------------ mart / KPIs
_POPULAR_SQL = f"""SELECT tg.game_id, tg.game_name,
       COUNT(ts.stream_id) AS active_streams,
       AVG(ts.viewer_count) AS avg_viewers,
       CAST(SUM(ts.viewer_count) AS BIGINT) AS total_viewers,
       MAX(ts.viewer_count) AS max_viewers
FROM ({_GAMES_SQL}) tg
LEFT JOIN ({_STREAMS_SQL}) ts ON tg.game_id = ts.game_id
WHERE tg.dw_deleted = FALSE AND (ts.dw_deleted = FALSE OR ts.dw_deleted IS NULL)
GROUP BY tg.game_id, tg.game_name"""


@query("popular_entities", f"""
SELECT game_name, active_streams, avg_viewers, total_viewers, max_viewers
FROM ({_POPULAR_SQL}) p ORDER BY total_viewers DESC NULLS LAST, game_id""")
def q_popular_entities(spark, d):
    return popular_entities(games(spark, d), streams(spark, d))


@query("kpis", f"""
WITH p AS ({_POPULAR_SQL}),
     s AS ({_STREAMS_SQL}), g AS ({_GAMES_SQL}),
     top AS (SELECT game_name, total_viewers FROM p
             ORDER BY total_viewers DESC NULLS LAST, game_id LIMIT 1)
SELECT (SELECT CAST(COUNT(DISTINCT game_id) AS INTEGER) FROM g WHERE dw_deleted = FALSE) AS total_games,
       (SELECT CAST(COUNT(*) AS INTEGER) FROM s WHERE dw_deleted = FALSE) AS total_active_streams,
       (SELECT AVG(viewer_count) FROM s WHERE dw_deleted = FALSE) AS avg_viewers_per_stream,
       (SELECT game_name FROM top) AS top_game,
       (SELECT total_viewers FROM top) AS top_game_viewers""")
def q_kpis(spark, d):
    return entity_kpis(games(spark, d), streams(spark, d))


_SUMMARY_SQL = """SELECT source, COUNT(*) AS total_loads,
       CAST(SUM(records_count) AS BIGINT) AS total_records,
       CAST(SUM(duration_seconds) AS DOUBLE) / COUNT(duration_seconds) AS avg_duration_seconds,
       MAX(load_end_time) AS last_load_time,
       ROUND(CAST(COUNT(*) FILTER (WHERE status = 'SUCCESS') AS DOUBLE) / COUNT(*) * 100.0::DOUBLE, 2) AS success_rate
FROM ({log}) l {where}
GROUP BY source ORDER BY total_records DESC NULLS LAST, source"""


@query("load_summary", _SUMMARY_SQL.format(log=_LOG_SQL, where=""))
def q_load_summary(spark, d):
    return load_summary(load_log(spark, d))


@query("load_summary_one", _SUMMARY_SQL.format(log=_LOG_SQL, where="WHERE source = 'SRC3'"))
def q_load_summary_one(spark, d):
    return load_summary(load_log(spark, d), source="SRC3")


@query("log_kpis", f"""
SELECT source, COUNT(*) AS total_loads, MAX(load_end_time) AS last_load_time,
       COUNT(*) FILTER (WHERE status = 'ERROR') AS error_loads,
       CAST(SUM(records_count) AS BIGINT) AS total_records
FROM ({_LOG_SQL}) l GROUP BY source""")
def q_log_kpis(spark, d):
    return log_kpis(load_log(spark, d))


@query("duration_bands", f"""
SELECT game_title, main_story, main_extra, completionist, {_BANDS_SQL} AS duration_category
FROM ({_hours_sql()}) h WHERE dw_deleted = FALSE AND main_story IS NOT NULL
ORDER BY main_story DESC""")
def q_duration_bands(spark, d):
    return duration_view(hours(spark, d))


@query("duration_bands_edges", f"""
SELECT game_title, main_story, main_extra, completionist, {_BANDS_SQL} AS duration_category
FROM ({_hours_sql(False)}) h WHERE dw_deleted = FALSE AND main_story IS NOT NULL
ORDER BY main_story DESC""")
def q_duration_bands_edges(spark, d):
    return duration_view(hours(spark, d, scale=False))


@query("casted_view", """
SELECT o_orderkey, order_text, CAST(order_text AS TIMESTAMP) AS order_text_casted
FROM (SELECT o_orderkey,
             CASE WHEN o_orderstatus = 'P' THEN NULL
                  ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS order_text
      FROM orders) o
WHERE order_text IS NOT NULL""")
def q_casted_view(spark, d):
    o = read_table(spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_orderdate"])
    o = o.select("o_orderkey", F.when(
        F.col("o_orderstatus") != "P",
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("order_text"))
    v = casted_view(o, "order_text")
    return v.withColumn("order_text_casted", F.col("order_text_casted").cast("timestamp_ntz"))


@query("category_counts", """
SELECT p_type AS category, COUNT(*) AS n_rows
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def q_category_counts(spark, d):
    li = read_table(spark, d, "lineitem", ["l_partkey"]).withColumnRenamed("l_partkey", "k")
    pa = read_table(spark, d, "part", ["p_partkey", "p_type"]).select(
        F.col("p_partkey").alias("k"), F.col("p_type").alias("category"))
    return count_per_category(li, pa, key="k", category="category")


@query("coverage_left_join", """
SELECT d.source, d.lang, COUNT(*) AS n_docs, COUNT(l.doc_id) AS n_labelled,
       AVG(l.quality) AS avg_quality, CAST(SUM(l.toxic) AS BIGINT) AS toxic_docs
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
GROUP BY d.source, d.lang""")
def q_coverage_left_join(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "source", "lang"])
    lab = read_table(spark, d, "labels", ["doc_id", "quality", "toxic"]) \
        .withColumnRenamed("doc_id", "l_doc_id")
    j = docs.join(lab, docs["doc_id"] == lab["l_doc_id"], "left")
    return j.groupBy("source", "lang").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count("l_doc_id").alias("n_labelled"),
        F.avg("quality").alias("avg_quality"),
        F.sum("toxic").cast("bigint").alias("toxic_docs"))


@query("mode_comparison", f"""
WITH h AS ({_hours_sql()}),
     u AS (SELECT 'main_story' AS mode, main_story AS hours FROM h
           UNION ALL SELECT 'main_extra', main_extra FROM h
           UNION ALL SELECT 'completionist', completionist FROM h)
SELECT mode, COUNT(hours) AS n_values,
       CAST(SUM(hours) AS DOUBLE) / COUNT(hours) AS avg_value,
       percentile_disc(0.5) WITHIN GROUP (ORDER BY hours) AS median_value,
       MIN(hours) AS min_value, MAX(hours) AS max_value
FROM u GROUP BY mode""")
def q_mode_comparison(spark, d):
    return mode_comparison(hours(spark, d), ["main_story", "main_extra", "completionist"],
                           ids=["game_title"])


@query("stat_leaders", """
WITH u AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS VARCHAR) AS stat,
                  unnest(embedding) AS value FROM embeddings)
SELECT stat, vec_id, value FROM u WHERE value IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY stat ORDER BY value DESC, vec_id) = 1""")
def q_stat_leaders(spark, d):
    return stat_leaders(read_table(spark, d, "embeddings", ["vec_id", "embedding"]),
                        "vec_id", array_col="embedding")


@query("type_distribution", """
SELECT value, COUNT(*) AS n_rows
FROM (SELECT unnest(string_split(p_name, ' ')) AS value FROM part) t GROUP BY value""")
def q_type_distribution(spark, d):
    p = read_table(spark, d, "part", ["p_name"]).select(F.split("p_name", " ").alias("types"))
    return value_distribution(p, "types")


@query("usage_ranking", """
SELECT event_type AS name, 'F' || CAST(user_id % 3 AS VARCHAR) AS format,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value) AS avg_usage_percentage,
       COUNT(*) AS months_tracked, MAX(CAST(ts AS DATE)) AS latest_month
FROM events GROUP BY 1, 2 ORDER BY avg_usage_percentage DESC, name, format""")
def q_usage_ranking(spark, d):
    ev = read_table(spark, d, "events", ["event_type", "user_id", "value", "ts"]).select(
        F.col("event_type").alias("name"),
        F.concat(F.lit("F"), (F.col("user_id") % 3).cast("string")).alias("format"),
        F.col("value").cast("decimal(18,2)").alias("usage"),
        F.col("ts").cast("date").alias("month"))
    return usage_ranking(ev, "name", "format", "usage", "month", deleted=None)


# ------------------------------------------------------ cleaning rules
def _prio_raw():
    k = F.col("o_orderkey") % 7
    return (F.when(k == 0, F.lit("")).when(k == 1, F.lit("   "))
            .when(k == 2, F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")))
            .otherwise(F.col("o_orderpriority")))
_PRIO_RAW_SQL = """CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN '   '
       WHEN 2 THEN '  ' || o_orderpriority || ' ' ELSE o_orderpriority END"""


def _prio(spark, d) -> DataFrame:
    return read_table(spark, d, "orders", ["o_orderkey", "o_orderpriority"]).select(
        "o_orderkey", _prio_raw().alias("raw"))


@query("blank_rules", f"""
SELECT o_orderkey, NULLIF(raw, '') AS blank_null, NULLIF(trim(raw), '') AS blank_null_trim,
       COALESCE(NULLIF(raw, ''), 'unknown') AS with_default, trim(raw) AS trimmed,
       NULLIF(trim(raw), '') IS NOT NULL AS present
FROM (SELECT o_orderkey, {_PRIO_RAW_SQL} AS raw FROM orders) o""")
def q_blank_rules(spark, d):
    return _prio(spark, d).select(
        "o_orderkey", blank_to_null("raw").alias("blank_null"),
        blank_to_null("raw", trim=True).alias("blank_null_trim"),
        default_if_blank("raw").alias("with_default"), trimmed("raw").alias("trimmed"),
        is_present("raw").alias("present"))


@query("trim_require", f"""
SELECT o_orderkey, trim(raw) AS priority
FROM (SELECT o_orderkey, {_PRIO_RAW_SQL} AS raw FROM orders) o
WHERE NULLIF(trim(raw), '') IS NOT NULL""")
def q_trim_require(spark, d):
    return _prio(spark, d).filter(is_present("raw")).select(
        "o_orderkey", trimmed("raw").alias("priority"))


@query("nonpositive_decimal", """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN TRY_CAST(c_acctbal AS DECIMAL(6,2)) END AS acctbal
FROM customer""")
def q_nonpositive_decimal(spark, d):
    c = read_table(spark, d, "customer", ["c_custkey", "c_acctbal"])
    return c.select("c_custkey", positive_decimal("c_acctbal").alias("acctbal"))


@query("any_measure", f"""
SELECT * FROM (
  SELECT c_custkey, {_dec('c_acctbal')} AS m1, {_dec('c_acctbal - 5000.0::DOUBLE')} AS m2,
         {_dec('c_acctbal - 9000.0::DOUBLE')} AS m3 FROM customer) c
WHERE m1 IS NOT NULL OR m2 IS NOT NULL OR m3 IS NOT NULL""")
def q_any_measure(spark, d):
    c = read_table(spark, d, "customer", ["c_custkey", "c_acctbal"])
    a = F.col("c_acctbal")
    m = c.select("c_custkey", positive_decimal(a).alias("m1"),
                 positive_decimal(a - F.lit(5000.0)).alias("m2"),
                 positive_decimal(a - F.lit(9000.0)).alias("m3"))
    return m.filter(F.col("m1").isNotNull() | F.col("m2").isNotNull() | F.col("m3").isNotNull())


_COUNT_RAW_SQL = """CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN 'n/a'
            ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END"""


@query("null_to_zero", f"""
SELECT event_id, CASE WHEN raw IS NULL THEN 0 ELSE TRY_CAST(raw AS INTEGER) END AS viewer_count,
       raw IS NOT NULL AND TRY_CAST(raw AS INTEGER) IS NULL AS rejected
FROM (SELECT event_id, {_COUNT_RAW_SQL} AS raw FROM events) e""")
def q_null_to_zero(spark, d):
    ev = read_table(spark, d, "events", ["event_id", "event_type", "value"])
    raw = F.when(F.col("event_type") == "error", F.lit(None).cast("string")) \
        .when(F.col("event_type") == "signup", F.lit("n/a")) \
        .otherwise(F.floor("value").cast("bigint").cast("string"))
    e = ev.select("event_id", raw.alias("raw"))
    v = null_to_zero_int("raw")
    return e.select("event_id", v.alias("viewer_count"), is_rejected("raw", v).alias("rejected"))


@query("bool_cast", """
SELECT event_id, TRY_CAST(CASE event_type WHEN 'view' THEN 'true' WHEN 'click' THEN 'false'
       WHEN 'purchase' THEN '1' WHEN 'signup' THEN '0' ELSE 'maybe' END AS BOOLEAN) AS is_mature
FROM events""")
def q_bool_cast(spark, d):
    ev = read_table(spark, d, "events", ["event_id", "event_type"])
    t = F.col("event_type")
    raw = F.when(t == "view", "true").when(t == "click", "false") \
        .when(t == "purchase", "1").when(t == "signup", "0").otherwise("maybe")
    return ev.select("event_id", to_bool(raw).alias("is_mature"))


@query("rename_all", """
SELECT o_orderkey AS order_key, o_orderstatus AS d_a, o_totalprice AS total_price,
       o_orderpriority AS priority FROM orders""")
def q_rename_all(spark, d):
    o = read_table(spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice",
                                        "o_orderpriority"])
    return normalize_column_names(o.toDF("Order Key", "Día Ñ", "Total-Price($)", "__Priority__"))


@query("audit_columns", """
SELECT o_orderkey, o_orderstatus, 'r0001' AS dw_id_carga, FALSE AS dw_deleted,
       'TPCH' AS dw_source, 'orders' AS dw_endpoint FROM orders""")
def q_audit_columns(spark, d):
    o = read_table(spark, d, "orders", ["o_orderkey", "o_orderstatus"])
    # the load timestamp is non-deterministic; it is checked in the unit tests
    return with_audit_columns(o, "tpch", "orders", run_id="r0001").drop("dw_fecha_registro")


@query("map_stats", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(NULL AS INTEGER) AS z FROM events""")
def q_map_stats(spark, d):
    ev = read_table(spark, d, "events", ["event_id", "props"])
    m = map_from_json("props", "int")
    return ev.select("event_id", map_value(m, "k").alias("k"), map_value(m, "z").alias("z"))


@query("keyed_flatten", """
SELECT event_id, 'user' || CAST(user_id AS VARCHAR) AS key, event_type AS label,
       CAST(event_id % 97 AS INTEGER) AS n FROM events
UNION ALL
SELECT event_id, 'id' || CAST(event_id AS VARCHAR), NULL, CAST(user_id % 89 AS INTEGER) FROM events
UNION ALL
SELECT event_id, event_type, 'last', NULL FROM events""")
def q_keyed_flatten(spark, d):
    """Three objects per record, under keys of their own, some without a field."""
    ev = read_table(spark, d, "events", ["event_id", "user_id", "event_type"])
    obj = F.format_string('{"user%d": {"label": "%s", "n": %d}, "id%d": {"n": %d}, "%s": {"label": "last"}}',
                          "user_id", "event_type", F.col("event_id") % 97, "event_id",
                          F.col("user_id") % 89, "event_type")
    return flatten_keyed_objects(ev.select("event_id", obj.alias("payload")), "payload",
                                 "label string, n int")


@query("array_items", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS type1, string_split(p_name, ' ')[2] AS type2,
       string_split(p_name, ' ')[3] AS type3 FROM part""")
def q_array_items(spark, d):
    p = read_table(spark, d, "part", ["p_partkey", "p_name"]).withColumn(
        "types", F.split("p_name", " "))
    return p.select("p_partkey", array_first("types").alias("type1"),
                    array_nth("types", 2).alias("type2"), array_nth("types", 3).alias("type3"))


@query("kind_split_union", """
SELECT event_id, user_id, ts, value AS view_seconds FROM events WHERE event_type = 'view'
UNION ALL BY NAME
SELECT event_id, user_id, value AS amount, props FROM events WHERE event_type = 'purchase'""")
def q_kind_split_union(spark, d):
    ev = read_table(spark, d, "events", ["event_id", "user_id", "ts", "value", "props",
                                         "event_type"])
    k = split_by_kind(ev, ["view", "purchase"], col="event_type")
    views = k["view"].select("event_id", "user_id", "ts", F.col("value").alias("view_seconds"))
    buys = k["purchase"].select("event_id", "user_id", F.col("value").alias("amount"), "props")
    return union_kinds([views, buys])


# ------------------------------------------------- dedup / top-k / distinct
@query("dedup_keep_first", """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""")
def q_dedup_keep_first(spark, d):
    return keep_first(read_table(spark, d, "events"), ["user_id", "event_type"],
                      ["ts", "event_id"])


@query("topk_per_key", """
SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 5""")
def q_topk_per_key(spark, d):
    return top_k_per_key(read_table(spark, d, "orders"), ["o_custkey"],
                         [("o_totalprice", "desc"), "o_orderkey"], 5)


@query("distinct_limit", """
SELECT DISTINCT o_custkey FROM orders ORDER BY o_custkey LIMIT 100""")
def q_distinct_limit(spark, d):
    """The first 100 of many more distinct values (S9: the limit is the feature)."""
    return distinct_values(read_table(spark, d, "orders", ["o_custkey"]), "o_custkey", limit=100)


# ------------------------------------------------------------------ lookup
def _title():
    k, n = F.col("p_partkey") % 5, F.col("p_name")
    return (F.when(k == 0, F.upper(n))
            .when(k == 1, F.concat(F.lit("  "), n, F.lit("  ")))
            .when(k == 2, F.substr(n, F.lit(1), F.length(n) - 1))
            .when(k == 3, F.regexp_replace(n, " ", ""))
            .otherwise(F.concat(n, F.lit(" remastered"))))
_TITLES_SQL = """SELECT DISTINCT CASE p_partkey % 5 WHEN 0 THEN upper(p_name)
       WHEN 1 THEN '  ' || p_name || '  ' WHEN 2 THEN substr(p_name, 1, length(p_name) - 1)
       WHEN 3 THEN replace(p_name, ' ', '') ELSE p_name || ' remastered' END AS title FROM part"""
_NORM = "lower(trim(regexp_replace({x}, '\\s+', ' ', 'g')))"
_LOOKUP_SQL = f"""WITH t AS ({_TITLES_SQL}),
  tk AS (SELECT title, {_NORM.format(x='title')} AS k FROM t),
  c AS (SELECT p_partkey AS match_id, p_name AS match_name, {_NORM.format(x='p_name')} AS ck FROM part),
  cand AS (SELECT title, match_id, match_name, CAST(levenshtein(k, ck) AS INTEGER) AS distance
           FROM tk JOIN c ON levenshtein(k, ck) <= 2)"""


def _titles(spark, d) -> DataFrame:
    return read_table(spark, d, "part", ["p_partkey", "p_name"]).select(_title().alias("title"))


def _catalogue(spark, d) -> DataFrame:
    return read_table(spark, d, "part", ["p_partkey", "p_name"]).select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


@query("lookup_first_match", f"""{_LOOKUP_SQL}
SELECT title, match_id, match_name, distance FROM cand
QUALIFY row_number() OVER (PARTITION BY title ORDER BY distance, match_id) = 1""")
def q_lookup_first_match(spark, d):
    return first_match_lookup(_titles(spark, d), _catalogue(spark, d))


@query("lookup_segments", f"""{_LOOKUP_SQL}
SELECT title, match_id, match_name, distance FROM cand
QUALIFY row_number() OVER (PARTITION BY title ORDER BY distance, match_id) = 1""")
def q_lookup_segments(spark, d):
    """Same lookup with the segment (pigeonhole) candidate filter."""
    return first_match_lookup(_titles(spark, d), _catalogue(spark, d), blocking="segments")


@query("lookup_unmatched", f"""{_LOOKUP_SQL}
SELECT title FROM t WHERE title NOT IN (SELECT title FROM cand)""")
def q_lookup_unmatched(spark, d):
    t = _titles(spark, d)
    return unmatched_titles(t, first_match_lookup(t, _catalogue(spark, d)))


# ----------------------------------------------------- quality/constraints
def _docs_labels(spark, d) -> DataFrame:
    docs = read_table(spark, d, "documents", ["doc_id", "lang", "source", "n_chars"])
    lab = read_table(spark, d, "labels", ["doc_id", "quality", "toxic"])
    return docs.join(lab, "doc_id", "left")


_DL_SQL = """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


@query("null_share", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL{blank}) AS null_count, "
    f"round_even(100.0::DOUBLE * COUNT(*) FILTER (WHERE {c} IS NULL{blank}) / COUNT(*), 2) AS null_pct "
    f"FROM ({_DL_SQL}) j"
    for c, blank in [("doc_id", ""), ("lang", " OR lang = ''"), ("source", " OR source = ''"),
                     ("n_chars", ""), ("quality", ""), ("toxic", "")]))
def q_null_share(spark, d):
    return null_blank_share(_docs_labels(spark, d))


@query("quality_report", f"""
SELECT 'documents' AS source, COUNT(*) AS total_records,
       COUNT(*) - COUNT(DISTINCT doc_id) AS duplicate_count,
       (CASE WHEN COUNT(*) FILTER (WHERE quality IS NULL) > 0 THEN 1 ELSE 0 END
        + CASE WHEN COUNT(*) FILTER (WHERE toxic IS NULL) > 0 THEN 1 ELSE 0 END) AS n_columns_with_empty,
       COUNT(*) = COUNT(DISTINCT doc_id) AND COUNT(*) FILTER (WHERE quality IS NULL OR toxic IS NULL) = 0
         AS validation_passed,
       round_even(100.0::DOUBLE * COUNT(*) FILTER (WHERE quality IS NULL) / COUNT(*), 2) AS quality_null_pct
FROM ({_DL_SQL}) j""")
def q_quality_report(spark, d):
    r = quality_report(_docs_labels(spark, d), "documents", keys=["doc_id"])
    return r.select("source", "total_records", "duplicate_count",
                    F.size("columns_with_empty").alias("n_columns_with_empty"),
                    "validation_passed",
                    F.col("null_percentage")["quality"].alias("quality_null_pct"))


@query("unique_violations", """
SELECT l_orderkey, COUNT(*) AS occurrences FROM lineitem
WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey HAVING COUNT(*) > 1""")
def q_unique_violations(spark, d):
    return unique_violations(read_table(spark, d, "lineitem", ["l_orderkey"]), ["l_orderkey"])


@query("fk_violations", """
SELECT d.doc_id, d.lang, d.source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def q_fk_violations(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "lang", "source"])
    return fk_violations(docs, ["doc_id"], read_table(spark, d, "labels", ["doc_id"]), ["doc_id"])


@query("not_null_violations", f"""
SELECT doc_id, concat_ws(',', CASE WHEN quality IS NULL THEN 'quality' END,
                              CASE WHEN toxic IS NULL THEN 'toxic' END) AS violated
FROM ({_DL_SQL}) j WHERE quality IS NULL OR toxic IS NULL""")
def q_not_null_violations(spark, d):
    v = not_null_violations(_docs_labels(spark, d), ["quality", "toxic"])
    return v.select("doc_id", F.array_join("violated", ",").alias("violated"))


@query("max_length_violations", """
SELECT p_partkey, concat_ws(',', CASE WHEN length(p_name) > 10 THEN 'p_name' END,
                                 CASE WHEN length(p_brand) > 7 THEN 'p_brand' END) AS violated
FROM part WHERE length(p_name) > 10 OR length(p_brand) > 7""")
def q_max_length_violations(spark, d):
    p = read_table(spark, d, "part", ["p_partkey", "p_name", "p_brand"])
    v = max_length_violations(p, {"p_name": 10, "p_brand": 7})
    return v.select("p_partkey", F.array_join("violated", ",").alias("violated"))


@query("constraint_summary", """
SELECT 'not_null' AS check_name, 'l_orderkey' AS column_name, COUNT(*) FILTER (WHERE l_orderkey IS NULL) AS violations FROM lineitem
UNION ALL SELECT 'not_null', 'l_partkey', COUNT(*) FILTER (WHERE l_partkey IS NULL) FROM lineitem
UNION ALL SELECT 'max_length', 'l_returnflag', COUNT(*) FILTER (WHERE length(l_returnflag) > 1) FROM lineitem
UNION ALL SELECT 'max_length', 'status_flags', COUNT(*) FILTER (WHERE length(l_linestatus || l_returnflag) > 1) FROM lineitem
UNION ALL SELECT 'unique', 'l_orderkey,l_linenumber', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM
  (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1) u""")
def q_constraint_summary(spark, d):
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber",
                                           "l_returnflag", "l_linestatus"])
    li = li.withColumn("status_flags", F.concat("l_linestatus", "l_returnflag"))
    return constraint_summary(li, not_null=["l_orderkey", "l_partkey"],
                              max_length={"l_returnflag": 1, "status_flags": 1},
                              unique=["l_orderkey", "l_linenumber"])


@query("conform_defaults", """
SELECT o_orderkey, o_custkey, TRY_CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
       'SUCCESS' AS status, 0 AS records_count, CAST(NULL AS VARCHAR) AS note FROM orders""")
def q_conform_defaults(spark, d):
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    target = schema_of(("o_orderkey", L), ("o_custkey", L), ("o_totalprice", DecimalType(18, 2)),
                     ("status", S), ("records_count", I), ("note", S))
    return conform_to_schema(o, target, defaults={"status": "SUCCESS", "records_count": 0})


@query("generated_duration", """
SELECT user_id, MIN(ts) AS load_start_time, MAX(ts) AS load_end_time,
       CAST((epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / 1000000.0 AS DECIMAL(10,2)) AS duration_seconds
FROM events GROUP BY user_id""")
def q_generated_duration(spark, d):
    ev = read_table(spark, d, "events", ["user_id", "ts"])
    per = ev.groupBy("user_id").agg(F.min("ts").alias("load_start_time"),
                                    F.max("ts").alias("load_end_time"))
    return per.withColumn("duration_seconds",
                          duration_seconds("load_start_time", "load_end_time"))


@query("idempotent_append", "SELECT * FROM orders")
def q_idempotent_append(spark, d):
    """Two batch runs with overlapping date windows appended to one table:
    the second run adds only keys the table lacks, so the result is every
    order exactly once."""
    o = read_table(spark, d, "orders")
    target = scratch_path(spark, f"idempotent-{uuid.uuid4().hex}")
    first = o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    second = o.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    write_parquet(first, target, mode="append")
    new = append_new_rows(second, spark.read.parquet(target), ["o_orderkey"])
    write_parquet(new, target, mode="append")
    return spark.read.parquet(target)


# ------------------------------------------------- full source cleaning
_RUN = "r0001"
def _url():
    return F.when(F.col("p_partkey") % 3 == 0, F.lit("")).otherwise(
        F.concat(F.lit("https://img.example/"), F.col("p_brand"), F.lit("-{width}x{height}.jpg")))
_URL_SQL = ("CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'https://img.example/' || p_brand "
            "|| '-{width}x{height}.jpg' END")


def raw_twitch(spark, d) -> DataFrame:
    """Mixed games+streams landing as the extractor writes it, derived from
    part (games, extracted on two days) and lineitem (streams)."""
    p = read_table(spark, d, "part", ["p_partkey", "p_name", "p_brand"])
    k = F.col("p_partkey")
    name = F.when(k % 11 == 0, F.lit("")).when(
        k % 11 == 1, F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).otherwise(F.col("p_name"))
    g1 = p.select(F.lit("game").alias("record_type"), k.cast("string").alias("game_id"),
                  name.alias("game_name"), _url().alias("box_art_url"),
                  F.lit("2025-06-10T19:45:49.123456").alias("extraction_time"),
                  F.lit("twitch").alias("source"), F.lit("games/top").alias("endpoint"))
    # the whole list extracted again a day later: some names re-cased, some
    # blank (then the older copy must win: filter before dedup, T1)
    name2 = F.when(k % 11 == 5, F.lit("")).when(k % 4 == 0, F.upper("p_name")) \
        .otherwise(F.col("p_name"))
    g2 = p.select(
        F.lit("game").alias("record_type"), k.cast("string").alias("game_id"),
        name2.alias("game_name"), _url().alias("box_art_url"),
        F.lit("2025-06-11T08:00:00").alias("extraction_time"),
        F.lit("twitch").alias("source"), F.lit("games/top").alias("endpoint"))
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey",
                                           "l_suppkey", "l_quantity", "l_linestatus",
                                           "l_returnflag", "l_shipdate"])
    s = li.select(
        F.lit("stream").alias("record_type"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("stream_id"),
        F.concat(F.lit("  Stream "), F.col("l_orderkey"), F.lit(" ")).alias("stream_title"),
        F.col("l_partkey").cast("string").alias("game_id"),
        F.lit(None).cast("string").alias("game_name"),
        F.col("l_suppkey").cast("string").alias("user_id"),
        F.when(F.col("l_linenumber") == 3, F.lit("")).otherwise(
            F.concat(F.lit("user"), F.col("l_suppkey"))).alias("user_name"),
        F.when((F.col("l_linenumber") == 1) & (F.col("l_linestatus") == "F"),
               F.lit(None).cast("bigint")).otherwise(F.col("l_quantity").cast("bigint"))
        .alias("viewer_count"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("started_at"),
        F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.lower("l_returnflag"))
        .alias("language"),
        F.lit("2025-06-10T19:45:49.123456").alias("extraction_time"),
        F.lit("twitch").alias("source"), F.lit("streams").alias("endpoint"))
    return union_kinds([g1, g2, s])


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols if c in df.columns})


@query("clean_twitch", f"""
WITH raw AS (
  SELECT 'game' AS record_type, CAST(p_partkey AS VARCHAR) AS game_id,
         CASE WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 11 = 1 THEN '  ' || p_name || ' '
              ELSE p_name END AS game_name,
         {_URL_SQL} AS box_art_url, '2025-06-10T19:45:49.123456' AS extraction_time FROM part
  UNION ALL
  SELECT 'game', CAST(p_partkey AS VARCHAR),
         CASE WHEN p_partkey % 11 = 5 THEN '' WHEN p_partkey % 4 = 0 THEN upper(p_name)
              ELSE p_name END,
         {_URL_SQL}, '2025-06-11T08:00:00' FROM part),
g AS (SELECT * FROM raw WHERE NULLIF(trim(game_name), '') IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY game_id
                                 ORDER BY CAST(extraction_time AS TIMESTAMP) DESC) = 1),
s AS (SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS stream_id,
             trim('  Stream ' || CAST(l_orderkey AS VARCHAR) || ' ') AS stream_title,
             CAST(l_partkey AS VARCHAR) AS game_id, CAST(l_suppkey AS VARCHAR) AS user_id,
             'user' || CAST(l_suppkey AS VARCHAR) AS user_name,
             CASE WHEN l_linenumber = 1 AND l_linestatus = 'F' THEN 0
                  ELSE CAST(l_quantity AS INTEGER) END AS viewer_count,
             l_shipdate AS started_at,
             CASE WHEN l_returnflag = 'N' THEN 'unknown' ELSE lower(l_returnflag) END AS language
      FROM lineitem WHERE l_linenumber <> 3
      QUALIFY row_number() OVER (
        PARTITION BY l_orderkey * 10 + l_linenumber
        ORDER BY game_id NULLS FIRST, stream_title NULLS FIRST, user_id NULLS FIRST,
                 user_name NULLS FIRST, viewer_count NULLS FIRST, started_at NULLS FIRST,
                 language NULLS FIRST) = 1)
SELECT 'game' AS record_type, game_id, trim(game_name) AS game_name,
       NULLIF(box_art_url, '') AS box_art_url, CAST(extraction_time AS TIMESTAMP) AS extraction_time,
       CAST(NULL AS VARCHAR) AS stream_id, CAST(NULL AS VARCHAR) AS stream_title,
       CAST(NULL AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS user_name,
       CAST(NULL AS INTEGER) AS viewer_count, CAST(NULL AS TIMESTAMP) AS started_at,
       CAST(NULL AS VARCHAR) AS language,
       '{_RUN}' AS dw_id_carga, FALSE AS dw_deleted, 'TWITCH' AS dw_source, 'twitch_api' AS dw_endpoint
FROM g
UNION ALL
SELECT 'stream', game_id, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
       CAST('2025-06-10T19:45:49.123456' AS TIMESTAMP), stream_id, stream_title, user_id, user_name,
       viewer_count, started_at, language, '{_RUN}', FALSE, 'TWITCH', 'twitch_api'
FROM s""")
def q_clean_twitch(spark, d):
    out = clean(raw_twitch(spark, d), TWITCH, run_id=_RUN).drop("dw_fecha_registro")
    return _ntz(out, "extraction_time", "started_at")


def raw_hltb(spark, d) -> DataFrame:
    """Duration lookups as landed: one per order line, the title per order
    (so an order's lines are re-extractions of one title, newest last)."""
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey",
                                           "l_quantity", "l_discount", "l_linestatus"])
    q = F.col("l_quantity")
    return li.select(
        F.lit("hl_tb_time").alias("record_type"),
        F.when(F.col("l_linenumber") == 4, F.lit("  ")).otherwise(
            F.concat(F.lit("G"), F.col("l_orderkey"), F.lit(" "))).alias("game_name"),
        F.concat(F.lit("https://img.example/"), F.col("l_partkey")).alias("game_image_url"),
        (F.col("l_discount") * F.lit(100.0)).alias("review_score"),
        (q * F.lit(1.2) - F.lit(3.6)).alias("main_story"),
        (q * F.lit(1.5) - F.lit(10.0)).alias("main_extra"),
        F.when(F.col("l_linestatus") == "F", F.lit(None).cast("double"))
        .otherwise(q * F.lit(2.0)).alias("completionist"),
        F.concat(F.lit("2025-06-1"), F.col("l_linenumber"), F.lit("T00:00:00"))
        .alias("extraction_time"),
        F.lit("howlongtobeat").alias("source"), F.lit("hltb_search").alias("endpoint"))


@query("clean_hltb", f"""
WITH c AS (
  SELECT 'hl_tb_time' AS record_type, trim('G' || CAST(l_orderkey AS VARCHAR) || ' ') AS game_name,
         'https://img.example/' || CAST(l_partkey AS VARCHAR) AS game_image_url,
         {_dec('l_discount * 100.0::DOUBLE')} AS review_score,
         {_dec('l_quantity * 1.2::DOUBLE - 3.6::DOUBLE')} AS main_story,
         {_dec('l_quantity * 1.5::DOUBLE - 10.0::DOUBLE')} AS main_extra,
         CASE WHEN l_linestatus = 'F' THEN NULL ELSE {_dec('l_quantity * 2.0::DOUBLE')} END AS completionist,
         CAST('2025-06-1' || CAST(l_linenumber AS VARCHAR) || 'T00:00:00' AS TIMESTAMP) AS extraction_time
  FROM lineitem WHERE l_linenumber <> 4)
SELECT *, '{_RUN}' AS dw_id_carga, FALSE AS dw_deleted, 'HLTB' AS dw_source,
       'howlongtobeat_api' AS dw_endpoint
FROM c WHERE main_story IS NOT NULL OR main_extra IS NOT NULL OR completionist IS NOT NULL
QUALIFY row_number() OVER (
  PARTITION BY game_name
  ORDER BY extraction_time DESC, game_image_url NULLS FIRST, review_score NULLS FIRST,
           main_story NULLS FIRST, main_extra NULLS FIRST, completionist NULLS FIRST) = 1""")
def q_clean_hltb(spark, d):
    out = clean(raw_hltb(spark, d), HLTB, run_id=_RUN).drop("dw_fecha_registro")
    return _ntz(out, "extraction_time")


def raw_pokedex(spark, d) -> DataFrame:
    """Catalogue entries with a types array (0, 1 or 2 items), a stats map
    missing ``spe`` and an abilities map, derived from part."""
    p = read_table(spark, d, "part", ["p_partkey", "p_name", "p_type", "p_size",
                                      "p_retailprice", "p_brand"])
    k = F.col("p_partkey")
    types = F.when(k % 6 == 0, F.array("p_type")).when(
        k % 6 == 1, F.array().cast("array<string>")).otherwise(F.split("p_name", " "))
    stats = F.create_map(F.lit("hp"), F.col("p_size"),
                         F.lit("atk"), (F.col("p_retailprice").cast("int") % 100),
                         F.lit("def"), (k % 97).cast("int"),
                         F.lit("spa"), (k % 89).cast("int"),
                         F.lit("spd"), (k % 83).cast("int"))
    new = p.select(
        F.lit("pokedex").alias("record_type"), k.cast("string").alias("pokemon_id"),
        F.concat(F.lit("  "), F.col("p_name")).alias("name"), types.alias("types"),
        stats.alias("baseStats"), F.create_map(F.lit("0"), F.col("p_brand")).alias("abilities"),
        F.lit("2025-06-10T19:45:49").alias("extraction_time"),
        F.lit("showdown").alias("source"), F.lit("data/pokedex.json").alias("endpoint"))
    # an older copy of every entry (dropped), and of some a copy of the same
    # time that differs in its types only: the shorter array comes first
    older = new.withColumns({"name": F.lit("older"), "extraction_time": F.lit("2025-06-09T00:00:00")})
    twin = new.filter(F.col("pokemon_id").cast("long") % 4 == 0).withColumn(
        "types", F.concat("types", F.array(F.lit("zz"))))
    return new.unionByName(older).unionByName(twin)


@query("clean_pokedex", f"""
SELECT 'pokedex' AS record_type, CAST(p_partkey AS VARCHAR) AS pokemon_id, p_name AS name,
       p_size AS hp, CAST(CAST(floor(p_retailprice) AS BIGINT) % 100 AS INTEGER) AS atk,
       CAST(p_partkey % 97 AS INTEGER) AS def, CAST(p_partkey % 89 AS INTEGER) AS spa,
       CAST(p_partkey % 83 AS INTEGER) AS spd, CAST(NULL AS INTEGER) AS spe,
       CASE WHEN p_partkey % 6 = 0 THEN p_type WHEN p_partkey % 6 = 1 THEN NULL
            ELSE string_split(p_name, ' ')[1] END AS type1,
       CASE WHEN p_partkey % 6 IN (0, 1) THEN NULL ELSE string_split(p_name, ' ')[2] END AS type2,
       '{{"0":"' || p_brand || '"}}' AS abilities_json,
       CAST('2025-06-10T19:45:49' AS TIMESTAMP) AS extraction_time,
       '{_RUN}' AS dw_id_carga, FALSE AS dw_deleted, 'SHOWDOWN' AS dw_source,
       'showdown_pokedex' AS dw_endpoint
FROM part""")
def q_clean_pokedex(spark, d):
    out = clean(raw_pokedex(spark, d), POKEDEX, run_id=_RUN).drop("dw_fecha_registro", "types")
    return _ntz(out, "extraction_time")


# ------------------------------------------ extraction shape and sinks
@query("top_entity_children", """
WITH p AS (SELECT p_partkey AS game_id, p_name AS game_name FROM part
           ORDER BY p_retailprice DESC, p_partkey LIMIT 200),
     c AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS stream_id,
                  l_partkey AS game_id, CAST(l_quantity AS INTEGER) AS viewer_count,
                  CASE WHEN l_linenumber % 2 = 0 THEN 'as played in ' || CAST(l_orderkey AS VARCHAR) END AS own
           FROM lineitem)
SELECT c.game_id, c.stream_id, COALESCE(c.own, p.game_name) AS game_name, c.viewer_count
FROM c JOIN p ON c.game_id = p.game_id
QUALIFY row_number() OVER (PARTITION BY c.game_id ORDER BY c.viewer_count DESC, c.stream_id) <= 10""")
def q_top_entity_children(spark, d):
    """Top 200 games, then at most 10 of their some 30 streams each, a missing
    name falling back to the game's (S3, S5, J2). The caps are the feature."""
    parents = (read_table(spark, d, "part", ["p_partkey", "p_name", "p_retailprice"])
               .orderBy(F.desc("p_retailprice"), "p_partkey").limit(200)
               .select(F.col("p_partkey").alias("game_id"), F.col("p_name").alias("game_name")))
    kids = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey",
                                             "l_quantity"]).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("stream_id"),
        F.col("l_partkey").alias("game_id"),
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("as played in "), F.col("l_orderkey")))
        .alias("game_name"),
        F.col("l_quantity").cast("int").alias("viewer_count"))
    out = enrich_children(parents, kids, "game_id", "game_name", per_key_limit=10,
                          order=[("viewer_count", "desc"), "stream_id"])
    return out.select("game_id", "stream_id", "game_name", "viewer_count")


@query("csv_round_trip", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name,
       '[' || array_to_string(string_split(p_name, ' '), ', ') || ']' AS types FROM part""")
def q_csv_round_trip(spark, d):
    """CSV export with an array column written as text, read back (K2)."""
    p = read_table(spark, d, "part", ["p_partkey", "p_name"]).withColumn(
        "types", F.split("p_name", " "))
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    export_csv(p, path)
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


@query("parquet_round_trip", "SELECT * FROM orders")
def q_parquet_round_trip(spark, d):
    """Partitioned Parquet write and read back (K1): the partition column
    comes back from the directory names."""
    path = scratch_path(spark, f"parquet-{uuid.uuid4().hex}")
    write_parquet(read_table(spark, d, "orders"), path, partition_by=["o_orderstatus"])
    return spark.read.parquet(path)


@query("clean_profiles", f"""
SELECT 'profile' AS record_type, c_name AS username, c_mktsegment AS format,
       CAST(NULL AS DOUBLE) AS gxe, c_acctbal AS rating, c_nationkey AS levels,
       CAST('2025-06-10T19:45:49' AS TIMESTAMP) AS extraction_time,
       '{_RUN}' AS dw_id_carga, FALSE AS dw_deleted, 'SHOWDOWN' AS dw_source,
       'showdown_api' AS dw_endpoint
FROM customer""")
def q_clean_profiles(spark, d):
    """Ladder/profile cleaning (P29, P18): key (username, format), text
    ratings to double, levels to int, blank gxe to NULL."""
    c = read_table(spark, d, "customer", ["c_name", "c_mktsegment", "c_acctbal", "c_nationkey"])
    raw = c.select(F.lit("profile").alias("record_type"), F.col("c_name").alias("username"),
                   F.col("c_mktsegment").alias("format"), F.lit("").alias("gxe"),
                   F.col("c_acctbal").cast("string").alias("rating"),
                   F.col("c_nationkey").cast("string").alias("levels"),
                   F.lit("2025-06-10T19:45:49").alias("extraction_time"),
                   F.lit("showdown").alias("source"), F.lit("users").alias("endpoint"))
    # every profile extracted once before, with another rating: dropped
    before = raw.withColumns({"rating": F.lit("-1"), "extraction_time": F.lit("2025-06-09T19:45:49")})
    out = clean(before.unionByName(raw), PROFILES, run_id=_RUN).drop("dw_fecha_registro")
    return _ntz(out, "extraction_time")


@query("reject_counts", """
SELECT 'stream' AS kind, 'viewer_count' AS column_name,
       COUNT(*) FILTER (WHERE event_type = 'signup') AS rejected FROM events
UNION ALL
SELECT 'stream', 'started_at', COUNT(*) FILTER (WHERE event_type = 'error') FROM events""")
def q_reject_counts(spark, d):
    """Per-column count of values that were present but did not convert
    (T6), over a stream landing derived from events with text counts and
    UTC stamps, some of them unparsable."""
    ev = read_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    t = F.col("event_type")
    raw = ev.select(
        F.lit("stream").alias("record_type"), F.col("event_id").cast("string").alias("stream_id"),
        F.concat(F.lit("user"), F.col("user_id")).alias("user_name"),
        F.when(t == "signup", F.lit("n/a")).when(t == "view", F.lit(None).cast("string"))
        .otherwise(F.floor("value").cast("bigint").cast("string")).alias("viewer_count"),
        F.when(t == "error", F.lit("not a time"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("started_at"),
        F.lit("2025-06-10T19:45:49").alias("extraction_time"))
    return reject_counts(raw, TWITCH)


@query("paged_collection", """
SELECT p_partkey AS id, p_name AS name FROM part ORDER BY p_partkey LIMIT 200""")
def q_paged_collection(spark, d):
    """Paged listing (S2): the catalogue, listed by id, is landed as JSON page
    objects (page N = ids 100N..100N+99, so a page holds at most 100 items),
    many to a file, then read back in page/position order and cut at the first
    200 items, as the collector does."""
    per_page = 100
    p = read_table(spark, d, "part", ["p_partkey", "p_name"])
    pages = (p.groupBy(F.floor(F.col("p_partkey") / per_page).alias("page"))
             .agg(F.sort_array(F.collect_list(F.struct(
                 F.col("p_partkey").alias("k"), F.col("p_name").alias("name")))).alias("_items"))
             .select("page", F.transform("_items", lambda x: F.struct(
                 x["k"].cast("string").alias("id"), x["name"].alias("name"))).alias("data"),
                     F.struct(F.concat(F.lit("c"), F.col("page") + 1).alias("cursor"))
                     .alias("pagination")))
    path = scratch_path(spark, f"pages-{uuid.uuid4().hex}")
    pages.write.json(path)
    item = schema_of(("id", S), ("name", S))
    got = read_pages(spark, path, item, limit=200, multi_line=False, page_col="page")
    return got.select(F.col("id").cast("long").alias("id"), "name")


@query("longest_games", f"""
SELECT game_title, main_story, main_extra, completionist
FROM ({_hours_sql()}) h WHERE dw_deleted = FALSE AND main_story IS NOT NULL
ORDER BY main_story DESC, game_title, main_extra NULLS FIRST, completionist NULLS FIRST
LIMIT 10""")
def q_longest_games(spark, d):
    return longest(hours(spark, d), "main_story", 10,
                   tie=["game_title", "main_extra", "completionist"]).drop("dw_deleted")
