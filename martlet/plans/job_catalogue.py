"""Catalogue of the job layer: the pipeline, the SQL surface, ladder records and
the lookup on names that are unique per row, each over whole driver tables.

Landings are derived from the tables, written as files to the shared scratch
folder and run through the same functions that the command line calls. Every
query has its SQL twin.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from martlet.operators import duration_view, first_match_lookup, unmatched_titles
from martlet.operators.audit import audit_frame
from martlet.plans.catalogue import (
    _BANDS_SQL, _GAMES_SQL, _LOG_SQL, _NORM, _POPULAR_SQL, _RUN, _STREAMS_SQL, _SUMMARY_SQL, _hours_sql, _ntz,
    games, hours, load_log, query, raw_twitch, streams,
)
from martlet.plans.pipeline import ROUTES, Landing, exists, hours_for_titles, read_mart, rejected_rows, run_pipeline
from martlet.plans.specs import PROFILES, clean, clean_source
from martlet.plans.views import register_mart_views, register_table_functions
from martlet.session import scratch_path
from martlet.sinks import drop_void_columns, write_parquet
from martlet.sources import LANDING_SCHEMAS, empty_frame, point_read, read_table, stamp_batch_time
from martlet.sources.schemas import schema_of, S


# ------------------------------------------------------------ the pipeline
def _landing(spark, d) -> DataFrame:
    """The mixed games and streams landing, with rows that must not vanish
    unseen: games without an id, games with an id too long for the mart, and
    records of a kind that the source doesn't list."""
    p = read_table(spark, d, "part", ["p_partkey", "p_name"])
    k = F.col("p_partkey")

    def game(kind: str, game_id, rest: int) -> DataFrame:
        return p.filter(k % 50 == rest).select(
            F.lit(kind).alias("record_type"), game_id.alias("game_id"), F.col("p_name").alias("game_name"),
            F.lit("2025-06-12T00:00:00").alias("extraction_time"), F.lit("twitch").alias("source"),
            F.lit("games/top").alias("endpoint"))

    out = raw_twitch(spark, d)
    for extra in (game("game", F.lit(None).cast("string"), 7),
                  game("game", F.lpad(k.cast("string"), 60, "0"), 11), game("clip", k.cast("string"), 9)):
        out = out.unionByName(extra, allowMissingColumns=True)
    return out


def _run(spark, d, times: int = 1, base: str | None = None, only: str | None = None,
         run_id: str = _RUN) -> tuple[str, DataFrame]:
    """Land (as JSON) and run the pipeline; the base folder and the last audit."""
    base = base or scratch_path(spark, f"job-{uuid.uuid4().hex}")
    raw = _landing(spark, d)
    if only:
        raw = raw.filter(F.col("record_type") == only)
    path = f"{base}/landed-{uuid.uuid4().hex}"
    # text so alike packs well; files that can't be split are kept small
    raw.write.option("compression", "lz4").option("maxRecordsPerFile", 500_000).json(path)
    for _ in range(times):
        logs = run_pipeline(spark, [Landing("Twitch", path, LANDING_SCHEMAS["twitch"])], base, run_id)
    return base, logs


def _mart(spark, base: str) -> DataFrame:
    g = read_mart(spark, f"{base}/core/twitch_games").select(
        F.lit("twitch_games").alias("table_name"), F.col("game_id").alias("id"), F.col("game_name").alias("label"),
        F.lit(None).cast("int").alias("viewer_count"), "extraction_time", "dw_id_carga", "dw_source", "dw_endpoint")
    s = read_mart(spark, f"{base}/core/twitch_streams").select(
        F.lit("twitch_streams").alias("table_name"), F.col("stream_id").alias("id"),
        F.col("stream_title").alias("label"), "viewer_count", "extraction_time", "dw_id_carga", "dw_source",
        "dw_endpoint")
    return _ntz(g.unionByName(s), "extraction_time")


# per (kind, key) the row that cleaning keeps
_CLEAN_SQL = """
g AS (SELECT CAST(p_partkey AS VARCHAR) AS id,
             CASE WHEN p_partkey % 11 = 5 THEN p_name WHEN p_partkey % 4 = 0 THEN upper(p_name) ELSE p_name END AS label,
             CASE WHEN p_partkey % 11 = 5 THEN TIMESTAMP '2025-06-10 19:45:49.123456'
                  ELSE TIMESTAMP '2025-06-11 08:00:00' END AS extraction_time
      FROM part),
s AS (SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id, 'Stream ' || CAST(l_orderkey AS VARCHAR) AS label,
             CASE WHEN l_linenumber = 1 AND l_linestatus = 'F' THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS viewer_count
      FROM lineitem WHERE l_linenumber <> 3
      QUALIFY row_number() OVER (
        PARTITION BY l_orderkey * 10 + l_linenumber
        ORDER BY CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                 CASE WHEN l_linenumber = 1 AND l_linestatus = 'F' THEN 0 ELSE CAST(l_quantity AS INTEGER) END) = 1)"""

_MART_SQL = f"""WITH {_CLEAN_SQL}
SELECT 'twitch_games' AS table_name, id, label, CAST(NULL AS INTEGER) AS viewer_count, extraction_time,
       '{_RUN}' AS dw_id_carga, 'TWITCH' AS dw_source, 'load/core_twitch' AS dw_endpoint FROM g
UNION ALL
SELECT 'twitch_streams', id, label, viewer_count, TIMESTAMP '2025-06-10 19:45:49.123456',
       '{_RUN}', 'TWITCH', 'load/core_twitch' FROM s"""


@query("pipeline_mart", _MART_SQL)
def q_pipeline_mart(spark, d):
    """Mart tables of a whole run (G1, G2, K5, K8): games without an id or with
    one too long, and clips, are not in them."""
    return _mart(spark, _run(spark, d)[0])


@query("pipeline_rerun", _MART_SQL)
def q_pipeline_rerun(spark, d):
    """The same run twice, then landed again with games only: the mart holds
    every row once, whatever the order of runs (C7)."""
    base, _ = _run(spark, d, times=2)
    _run(spark, d, base=base, only="game")
    return _mart(spark, base)


_COUNTS_SQL = f"""WITH {_CLEAN_SQL},
n AS (SELECT (SELECT COUNT(*) FROM part) AS parts, (SELECT COUNT(*) FROM lineitem) AS lines,
             (SELECT COUNT(*) FROM part WHERE p_partkey % 50 = 7) AS no_id,
             (SELECT COUNT(*) FROM part WHERE p_partkey % 50 = 11) AS long_id,
             (SELECT COUNT(*) FROM part WHERE p_partkey % 50 = 9) AS clips,
             (SELECT COUNT(*) FROM g) AS games, (SELECT COUNT(*) FROM s) AS streams)"""


@query("pipeline_audit", f"""{_COUNTS_SQL}
SELECT '{_RUN}' AS run_id, step, 'TWITCH' AS source, endpoint, CAST(records_count AS BIGINT) AS records_count,
       CAST(rejected_count AS BIGINT) AS rejected_count, 'SUCCESS' AS status, note
FROM (SELECT 'land' AS step, 'parquet/twitch' AS endpoint,
             2 * parts + lines + no_id + long_id + clips AS records_count, 0 AS rejected_count,
             CAST(NULL AS VARCHAR) AS note FROM n
      UNION ALL
      SELECT 'clean', 'transform/twitch', games + streams + long_id + CASE WHEN no_id > 0 THEN 1 ELSE 0 END, clips,
             CAST(2 * parts + lines + no_id + long_id + clips AS VARCHAR) FROM n
      UNION ALL
      SELECT 'publish', 'load/core_twitch', games, long_id + CASE WHEN no_id > 0 THEN 1 ELSE 0 END, NULL FROM n
      UNION ALL
      SELECT 'publish', 'load/core_twitch', streams, 0, NULL FROM n) x""")
def q_pipeline_audit(spark, d):
    """The audit log's columns that don't depend on the clock (G3, A6, K6, K7,
    K9): what each step wrote and set aside, and the rows before cleaning. All
    games without an id are one key to the dedup, as NULL is one value."""
    base, _ = _run(spark, d)
    logs = spark.read.parquet(f"{base}/etl_logs")
    return logs.select("run_id", "step", "source", "endpoint", "records_count", "rejected_count", "status",
                       F.get_json_object("error_message", "$.rows_before").alias("note"))


@query("pipeline_rejects", f"""{_COUNTS_SQL}
SELECT 'twitch_games' AS table_name, lpad(CAST(p_partkey AS VARCHAR), 60, '0') AS id, 'game_id' AS violated,
       '{_RUN}' AS dw_id_carga FROM part WHERE p_partkey % 50 = 11
UNION ALL
SELECT 'twitch_games', NULL, 'game_id', '{_RUN}' FROM n WHERE no_id > 0""")
def q_pipeline_rejects(spark, d):
    """Rows kept out of the mart for NOT NULL or their length (C1, C4), after a
    re-run: none is lost, none twice."""
    base, _ = _run(spark, d, times=2)
    route = ROUTES["twitch"][0]
    bad = rejected_rows(spark, route, read_mart(spark, f"{base}/core/{route.table}").schema, f"{base}/core")
    return bad.select(F.lit(route.table).alias("table_name"), F.col("game_id").alias("id"),
                      F.array_join("violated", ",").alias("violated"), "dw_id_carga")


@query("pipeline_reland", f"""{_COUNTS_SQL}
SELECT 'raw' AS layer, 'game' AS record_type, 2 * parts + no_id + long_id AS n_rows FROM n
UNION ALL
SELECT 'clean', 'game', games + long_id + CASE WHEN no_id > 0 THEN 1 ELSE 0 END FROM n""")
def q_pipeline_reland(spark, d):
    """A run landed again with fewer kinds: no row of its first landing stays in
    the raw and clean tables (K1, K9)."""
    base, _ = _run(spark, d)
    _run(spark, d, base=base, only="game")
    schema = schema_of(("record_type", S), ("dw_id_carga", S))
    layers = [spark.read.schema(schema).parquet(f"{base}/{layer}/twitch").select(
        F.lit(layer).alias("layer"), "record_type") for layer in ("raw", "clean") if exists(spark, f"{base}/{layer}")]
    return layers[0].unionByName(layers[1]).groupBy("layer", "record_type").agg(F.count("*").alias("n_rows"))


@query("pipeline_run_ids", f"""SELECT 'TWITCH' AS source, CAST(COUNT(*) AS BIGINT) AS n_games, '0001' AS dw_id_carga
FROM part""")
def q_pipeline_run_ids(spark, d):
    """A run id of digits stays text in every table."""
    base, _ = _run(spark, d, only="game", run_id="0001")
    return (read_mart(spark, f"{base}/core/twitch_games").groupBy(F.col("dw_source").alias("source"), "dw_id_carga")
            .agg(F.count("*").alias("n_games")))


# ----------------------------------------------------------- the SQL surface
def _views(spark, d) -> None:
    st = streams(spark, d).withColumn("extraction_time", F.when(
        F.col("stream_id") % 7 != 0, F.lit("2025-06-10T19:45:49.123456")))
    register_mart_views(spark, games(spark, d), st, hltb=hours(spark, d).withColumnRenamed("game_title", "game_name"),
                        logs=load_log(spark, d))
    register_table_functions(spark)


@query("sql_load_summary", _SUMMARY_SQL.format(log=_LOG_SQL, where="").replace(
    "ORDER BY total_records DESC NULLS LAST, source", ""))
def q_sql_load_summary(spark, d):
    _views(spark, d)
    return spark.sql("SELECT * FROM get_load_summary(NULL)")


@query("sql_load_summary_one", _SUMMARY_SQL.format(log=_LOG_SQL, where="WHERE source = 'SRC3'").replace(
    "ORDER BY total_records DESC NULLS LAST, source", ""))
def q_sql_load_summary_one(spark, d):
    _views(spark, d)
    return spark.sql("SELECT * FROM get_load_summary('SRC3')")


@query("sql_kpis", f"""
WITH p AS ({_POPULAR_SQL}), s AS ({_STREAMS_SQL}), g AS ({_GAMES_SQL}),
     top AS (SELECT game_name, total_viewers FROM p ORDER BY total_viewers DESC NULLS LAST, game_id LIMIT 1)
SELECT (SELECT CAST(COUNT(DISTINCT game_id) AS INTEGER) FROM g WHERE dw_deleted = FALSE) AS total_games,
       (SELECT CAST(COUNT(*) AS INTEGER) FROM s WHERE dw_deleted = FALSE) AS total_active_streams,
       (SELECT AVG(viewer_count) FROM s WHERE dw_deleted = FALSE) AS avg_viewers_per_stream,
       (SELECT game_name FROM top) AS top_game, (SELECT total_viewers FROM top) AS top_game_viewers""")
def q_sql_kpis(spark, d):
    _views(spark, d)
    return spark.sql("SELECT * FROM get_twitch_kpis()")


@query("sql_popular", f"""
SELECT game_name, active_streams, avg_viewers, total_viewers, max_viewers FROM ({_POPULAR_SQL}) p""")
def q_sql_popular(spark, d):
    _views(spark, d)
    return spark.sql("SELECT * FROM v_twitch_popular_games")


@query("sql_duration_view", f"""
SELECT game_title AS game_name, main_story, main_extra, completionist, {_BANDS_SQL} AS duration_category
FROM ({_hours_sql()}) h WHERE dw_deleted = FALSE AND main_story IS NOT NULL""")
def q_sql_duration_view(spark, d):
    _views(spark, d)
    return spark.sql("SELECT * FROM v_hltb_games_by_duration")


@query("sql_streams_casted", f"""
SELECT stream_id, TIMESTAMP '2025-06-10 19:45:49.123456' AS extraction_time_casted
FROM ({_STREAMS_SQL}) s WHERE stream_id % 7 <> 0""")
def q_sql_streams_casted(spark, d):
    _views(spark, d)
    return _ntz(spark.sql("SELECT stream_id, extraction_time_casted FROM twitch_streams_casted"),
                "extraction_time_casted")


# ------------------------------------------------------------ ladder records
@query("clean_ladder", f"""
SELECT 'ladder' AS record_type, c_name AS username, c_mktsegment AS format, c_acctbal AS elo, c_acctbal / 2 AS rating,
       CAST(c_custkey % 90 AS INTEGER) AS wins, CAST(c_nationkey AS INTEGER) AS losses,
       CAST(NULL AS INTEGER) AS games, CAST(NULL AS DOUBLE) AS win_ratio, CAST(NULL AS DOUBLE) AS gxe,
       CAST(NULL AS INTEGER) AS games_played, CAST(NULL AS INTEGER) AS levels,
       TIMESTAMP '2025-06-11 00:00:00' AS extraction_time, '{_RUN}' AS dw_id_carga, FALSE AS dw_deleted,
       'SHOWDOWN' AS dw_source, 'showdown_api' AS dw_endpoint FROM customer
UNION ALL
SELECT 'profile', c_name, c_mktsegment, NULL, c_acctbal, NULL, NULL, NULL, 0.5::DOUBLE,
       CAST(c_custkey AS DOUBLE), CAST(c_custkey % 7 AS INTEGER), CAST(c_nationkey AS INTEGER),
       TIMESTAMP '2025-06-11 00:00:00', '{_RUN}', FALSE, 'SHOWDOWN', 'showdown_api' FROM customer""")
def q_clean_ladder(spark, d):
    """Ladder and profile records of one landing (P18, P29): numbers as text,
    a count that isn't one, and an older copy of each (username, format)."""
    c = read_table(spark, d, "customer")
    who = [F.col("c_name").alias("username"), F.col("c_mktsegment").alias("format")]
    tail = [F.lit("2025-06-11T00:00:00").alias("extraction_time"), F.lit("showdown").alias("source"),
            F.lit("ladder").alias("endpoint")]

    def text(x):
        return x.cast("string")

    ladder = c.select(F.lit("ladder").alias("record_type"), *who, text(F.col("c_acctbal")).alias("elo"),
                      text(F.col("c_acctbal") / 2).alias("rating"), text(F.col("c_custkey") % 90).alias("wins"),
                      text(F.col("c_nationkey")).alias("losses"), F.lit("many").alias("games"), *tail)
    profile = c.select(F.lit("profile").alias("record_type"), *who, text(F.col("c_acctbal")).alias("rating"),
                       F.lit("0.5").alias("win_ratio"), text(F.col("c_custkey")).alias("gxe"),
                       text(F.col("c_custkey") % 7).alias("games_played"),
                       text(F.col("c_nationkey")).alias("levels"), *tail)
    new = ladder.unionByName(profile, allowMissingColumns=True)
    old = new.withColumns({"rating": F.lit("0"), "extraction_time": F.lit("2025-06-01T00:00:00")})
    raw = old.unionByName(new).select(*LANDING_SCHEMAS["showdown"].fieldNames())
    return _ntz(clean(raw, PROFILES, run_id=_RUN).drop("dw_fecha_registro"), "extraction_time")


# ------------------------------------- lookup on names unique to their rows
def _named(spark, d, prefix: str) -> DataFrame:
    return read_table(spark, d, "part", ["p_partkey", "p_name"]).select(
        F.col("p_partkey").alias("id"),
        (F.concat(F.lit(prefix), F.substr(F.md5(F.col("p_partkey").cast("string")), F.lit(1), F.lit(12)))
         if prefix else F.concat_ws(" ", "p_name", F.substr(F.md5(F.col("p_partkey").cast("string")), F.lit(1), F.lit(8)))
         ).alias("name"))


def _asked(names: DataFrame) -> DataFrame:
    k, n = F.col("id") % 5, F.col("name")
    return names.select((F.when(k == 0, F.upper(n)).when(k == 1, F.concat(F.lit("  "), n, F.lit("  ")))
                         .when(k == 2, F.substr(n, F.lit(1), F.length(n) - 1))
                         .when(k == 3, F.concat(F.lit("x"), n, F.lit("y")))
                         .otherwise(F.concat(n, F.lit(" remastered")))).alias("title"))


def _unique_sql(name: str) -> str:
    title = (f"CASE p_partkey % 5 WHEN 0 THEN upper({name}) WHEN 1 THEN '  ' || {name} || '  ' "
             f"WHEN 2 THEN substr({name}, 1, length({name}) - 1) WHEN 3 THEN 'x' || {name} || 'y' "
             f"ELSE {name} || ' remastered' END")
    return f"""WITH tk AS (SELECT DISTINCT {title} AS title, {_NORM.format(x=title)} AS k FROM part),
  c AS (SELECT p_partkey AS match_id, {name} AS match_name, {_NORM.format(x=name)} AS ck FROM part),
  cand AS (SELECT title, match_id, match_name, CAST(levenshtein(k, ck) AS INTEGER) AS distance
           FROM tk JOIN c ON abs(length(k) - length(ck)) <= 2 AND levenshtein(k, ck) <= 2)"""


_BEST = """
SELECT title, match_id, match_name, distance FROM cand
QUALIFY row_number() OVER (PARTITION BY title ORDER BY distance, match_id) = 1"""
_OWN_NAME = "p_name || ' ' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8)"
_SERIES = "the long running series volume "
_SERIES_NAME = f"'{_SERIES}' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 12)"


@query("lookup_unique_names", _unique_sql(_OWN_NAME) + _BEST)
def q_lookup_unique_names(spark, d):
    """Every row has a name of its own (J3): as many titles as names."""
    names = _named(spark, d, "")
    return first_match_lookup(_asked(names), names)


@query("lookup_shared_prefix", _unique_sql(_SERIES_NAME) + _BEST)
def q_lookup_shared_prefix(spark, d):
    """All names share a long prefix, so one block holds the whole catalogue
    (J3): what surrounds the segment keeps the candidates few."""
    names = _named(spark, d, _SERIES)
    return first_match_lookup(_asked(names), names, block=200)


@query("lookup_unmatched_names", _unique_sql(_OWN_NAME) + """
SELECT title FROM tk WHERE title NOT IN (SELECT title FROM cand)""")
def q_lookup_unmatched_names(spark, d):
    names = _named(spark, d, "")
    titles = _asked(names)
    return unmatched_titles(titles, first_match_lookup(titles, names))


@query("durations_for_titles", f"""
SELECT upper({_OWN_NAME}) AS game_name, p_retailprice AS main_story, 'howlongtobeat' AS source FROM part""")
def q_durations_for_titles(spark, d):
    """Durations of all game names, far more than a hundred."""
    names = _named(spark, d, "")
    price = read_table(spark, d, "part", ["p_partkey", "p_retailprice"]).select(
        F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("main_story"))
    found, _ = hours_for_titles(names.select(F.upper("name").alias("game_name")), names.join(price, "id"),
                                "2025-06-10T10:00:00")
    return found.select("game_name", "main_story", "source")


# ----------------------------------------------------------- smaller pieces
@query("point_read", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey = 7")
def q_point_read(spark, d):
    """All orders of one customer (S15); the comparison reaches the scan."""
    return point_read(read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_totalprice"]), "o_custkey", 7)


@query("void_columns", "SELECT o_orderkey, CAST(NULL AS VARCHAR) AS note FROM orders")
def q_void_columns(spark, d):
    """A column without a type can't be stored: dropped, a typed NULL stays (K4)."""
    o = read_table(spark, d, "orders", ["o_orderkey"]).select(
        "o_orderkey", F.lit(None).alias("void"), F.lit(None).cast("string").alias("note"))
    path = scratch_path(spark, f"void-{uuid.uuid4().hex}")
    write_parquet(drop_void_columns(o), path)
    return spark.read.parquet(path)


@query("empty_source", "SELECT c_name AS username, c_mktsegment AS format, CAST(NULL AS VARCHAR) AS elo FROM customer")
def q_empty_source(spark, d):
    """A failed source is an empty typed frame and unites with others."""
    c = read_table(spark, d, "customer").select(F.col("c_name").alias("username"), F.col("c_mktsegment").alias("format"))
    none = empty_frame(spark, LANDING_SCHEMAS["showdown"]).select("username", "format", "elo")
    return none.unionByName(c, allowMissingColumns=True)


@query("interval_arithmetic", """
SELECT event_id, ts - INTERVAL '2 hours' AS load_start_time, ts + INTERVAL '90 minutes' AS load_end_time,
       ts + to_days(CAST(user_id % 3 AS INTEGER)) AS due FROM events""")
def q_interval_arithmetic(spark, d):
    """Fixed and computed intervals around a timestamp."""
    ev = read_table(spark, d, "events", ["event_id", "ts", "user_id"])
    return ev.select("event_id", F.expr("ts - INTERVAL '2' HOUR").alias("load_start_time"),
                     F.expr("ts + INTERVAL 90 MINUTES").alias("load_end_time"),
                     F.expr("ts + make_dt_interval(cast(user_id % 3 as int))").alias("due"))


@query("batch_time", """
SELECT p_partkey AS id, '2025-06-10T19:45:49' AS extraction_time FROM part""")
def q_batch_time(spark, d):
    """One extraction time for a whole batch, over the rows' own."""
    p = read_table(spark, d, "part", ["p_partkey"]).select(
        F.col("p_partkey").alias("id"), F.col("p_partkey").cast("string").alias("extraction_time"))
    return stamp_batch_time(p, "2025-06-10T19:45:49")


@query("audit_records", """
SELECT 'run-' || lpad(CAST(r_regionkey AS VARCHAR), 4, '0') AS run_id, r_name AS source,
       CAST(n AS BIGINT) AS records_count, CAST(0 AS BIGINT) AS rejected_count, 'SUCCESS' AS status,
       TRUE AS has_times FROM region JOIN (SELECT n_regionkey, COUNT(*) AS n FROM nation GROUP BY n_regionkey) c
  ON n_regionkey = r_regionkey""")
def q_audit_records(spark, d):
    """Records, one per region, made a typed log frame with its defaults (S10,
    K6). The records go through the driver, as a run's few steps do."""
    n = read_table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.count("*").alias("n"))
    rows = read_table(spark, d, "region").join(n, "r_regionkey").collect()
    logs = audit_frame(spark, [{"run_id": f"run-{r.r_regionkey:04d}", "source": r.r_name, "records_count": r.n}
                               for r in rows])
    return logs.select("run_id", "source", "records_count", "rejected_count", "status",
                       F.expr("created_at is not null and load_start_time <= load_end_time "
                              "and duration_seconds = 0").alias("has_times"))


@query("dispatch_sources", """
SELECT 'HLTB' AS dw_source, COUNT(*) AS n_rows, COUNT(DISTINCT game_name) AS n_keys
FROM (SELECT DISTINCT upper(p_name) AS game_name FROM part)""")
def q_dispatch_sources(spark, d):
    """Cleaning rules found by the source's name in any case."""
    raw = read_table(spark, d, "part", ["p_name"]).select(
        F.lit("hl_tb_time").alias("record_type"), F.upper("p_name").alias("game_name"), F.lit(2.0).alias("main_story"),
        F.lit("2025-06-10T19:45:49").alias("extraction_time"))
    return (clean_source(raw, "HowLongToBeat", _RUN).groupBy("dw_source")
            .agg(F.count("*").alias("n_rows"), F.count_distinct("game_name").alias("n_keys")))


@query("duration_ties", f"""
SELECT duration_category, COUNT(*) AS n_rows, CAST(COUNT(DISTINCT main_story) AS BIGINT) AS n_values
FROM (SELECT main_story, {_BANDS_SQL} AS duration_category FROM ({_hours_sql()}) h
      WHERE dw_deleted = FALSE AND main_story IS NOT NULL) v GROUP BY duration_category""")
def q_duration_ties(spark, d):
    """Rows and values by band (P23): a value's rows are many, so the view's
    sort needs more than the value (O2)."""
    return (duration_view(hours(spark, d)).groupBy("duration_category")
            .agg(F.count("*").alias("n_rows"), F.count_distinct("main_story").alias("n_values")))
