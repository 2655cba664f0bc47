"""Catalogue of landing, selection and recovery: listings by cursor, the step log,
large keyed objects, inferred schemas, similar titles, exact medians, large top-k,
map ties and one-file exports, each over whole driver tables with its SQL twin.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from martlet.functions import canonical
from martlet.operators import (
    exact_quantiles, keep_first, similar_titles, top_k_per_key, with_audit_columns, with_exact_quantiles,
)
from martlet.plans.catalogue import _RUN, query
from martlet.plans.pipeline import Landing, _read, export_all, run_pipeline
from martlet.plans.steplog import StepLog
from martlet.session import scratch_path
from martlet.sinks import export_csv_file, join_parts, part_files
from martlet.sources import (
    LANDING_SCHEMAS, inferred_schema, read_cursor_pages, read_keyed_objects, read_pages, read_table, schema_report,
)
from martlet.sources.schemas import schema_of, S


def _folder(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


# ------------------------------------------------------- listings by cursor
def _pages(spark, d) -> DataFrame:
    """The catalogue as pages of seven items: page, data."""
    p = read_table(spark, d, "part", ["p_partkey", "p_name"])
    return (p.groupBy(F.floor(F.col("p_partkey") / 7).alias("page"))
            .agg(F.sort_array(F.collect_list(F.struct(
                F.col("p_partkey").alias("k"), F.col("p_name").alias("name")))).alias("_items"))
            .select("page", F.transform("_items", lambda x: F.struct(
                x["k"].cast("string").alias("id"), x["name"].alias("name"))).alias("data")))


_LISTED_SQL = """
WITH p AS (SELECT p_partkey AS id, p_name AS name, CAST(p_partkey // 7 AS BIGINT) AS page FROM part),
     e AS (SELECT min(page) AS lo, max(page) * 3 // 4 AS e FROM p)
SELECT id, name, page - lo AS page, CAST(row_number() OVER (PARTITION BY page ORDER BY id) - 1 AS INTEGER) AS pos
FROM p, e WHERE page < e"""


@query("paged_by_cursor", _LISTED_SQL)
def q_paged_by_cursor(spark, d):
    """A listing whose pages name cursors and no numbers (S2): shuffled over many
    files, every fifth landed twice (every tenth the second time without items), an
    empty page in the middle with more behind it, and a page no cursor leads to."""
    pages = _pages(spark, d)
    bounds = pages.agg(F.min("page").alias("lo"), F.max("page").alias("hi"))

    def cursor(k):
        return F.md5(k.cast("string"))

    k = F.col("page")
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    end = F.floor(hi * 3 / 4)
    landed = pages.select(
        F.when(k > lo, cursor(k)).alias("after"), F.when(k == end, F.slice("data", 1, 0)).otherwise(F.col("data")).alias("data"),
        F.struct(F.when(k < hi, cursor(k + 1)).alias("cursor")).alias("pagination"), k.alias("page"))
    again = landed.filter(k % 5 == 0).withColumn(
        "data", F.when(k % 10 == 0, F.slice("data", 1, 0)).otherwise(F.col("data")))
    astray = landed.filter(k == lo).withColumn("after", F.lit("nowhere"))
    path = _folder(spark, "cursors")
    landed.unionByName(again).unionByName(astray).drop("page").repartition(8, F.xxhash64("after", "data")).write.json(path)
    got = read_cursor_pages(spark, path, schema_of(("id", S), ("name", S)), multi_line=False)
    return got.select(F.col("id").cast("long").alias("id"), "name", F.col("_page").alias("page"), F.col("_pos").alias("pos"))


@query("paged_to_the_end", _LISTED_SQL)
def q_paged_to_the_end(spark, d):
    """Numbered pages with an empty one in the middle: what lies behind it isn't read."""
    pages = _pages(spark, d)
    bounds = pages.agg(F.min("page").alias("lo"), F.max("page").alias("hi"))
    lo, end = bounds.select("lo").scalar(), F.floor(bounds.select("hi").scalar() * 3 / 4)
    path = _folder(spark, "pages")
    pages.select((F.col("page") - lo).alias("page"), F.when(F.col("page") == end, F.slice("data", 1, 0)).otherwise(
        F.col("data")).alias("data")).write.json(path)
    got = read_pages(spark, path, schema_of(("id", S), ("name", S)), multi_line=False, page_col="page")
    return got.select(F.col("id").cast("long").alias("id"), "name", F.col("_page").alias("page"), F.col("_pos").alias("pos"))


@query("paged_children", """
SELECT CAST(o_custkey AS VARCHAR) AS game_id, o_orderkey AS id,
       CAST((row_number() OVER w - 1) // 3 AS BIGINT) AS page
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)
QUALIFY row_number() OVER w <= 7""")
def q_paged_children(spark, d):
    """A listing per key (S2, S3): every customer's orders in pages of three, whose
    cursors are the same few for all customers; at most seven of each. Some
    listings end with an empty page, the others without a cursor."""
    o = read_table(spark, d, "orders", ["o_custkey", "o_orderkey"])
    by = o.groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("ids"))
    n = F.ceil(F.size("ids") / 3)
    ends = F.col("o_custkey") % 2 == 0
    pages = by.select("o_custkey", "ids", n.alias("n"), ends.alias("ends"), F.explode(F.sequence(
        F.lit(0), F.when(ends, n).otherwise(n - 1))).alias("k"))
    path = _folder(spark, "children")
    pages.select(
        F.col("o_custkey").cast("string").alias("game_id"), F.when(F.col("k") > 0, F.concat(F.lit("c"), "k")).alias("after"),
        F.transform(F.slice("ids", (F.col("k") * 3 + 1).cast("int"), F.lit(3)),
                    lambda x: F.struct(x.cast("string").alias("id"))).alias("data"),
        F.struct(F.when(F.col("k") < F.when(F.col("ends"), F.col("n")).otherwise(F.col("n") - 1),
                        F.concat(F.lit("c"), F.col("k") + 1)).alias("cursor")).alias("pagination")
    ).repartition(8).write.json(path)
    got = read_cursor_pages(spark, path, schema_of(("id", S),), limit=7, by=["game_id"], multi_line=False)
    return got.select("game_id", F.col("id").cast("long").alias("id"), F.col("_page").alias("page"))


# ------------------------------------------------------------- the step log
@query("pipeline_failed_source", f"""
WITH n AS (SELECT CAST(COUNT(*) AS BIGINT) AS parts FROM part),
     ok AS (SELECT step, ord FROM (VALUES ('land', 1), ('clean', 2), ('publish', 3)) v(step, ord))
SELECT run_id, step, 'TWITCH_GAMES' AS source, 'SUCCESS' AS status, parts AS records_count, CAST(NULL AS VARCHAR) AS error
FROM n, ok, (VALUES ('{_RUN}'), ('later')) r(run_id)
UNION ALL SELECT '{_RUN}', 'land', 'HOWLONGTOBEAT', 'ERROR', 0, 'unsupported landing format ''carrier pigeon'''
UNION ALL SELECT 'lost', 'clean', 'TWITCH_GAMES', 'ERROR', 0, 'interrupted: the run ended inside this step'""")
def q_pipeline_failed_source(spark, d):
    """A run whose second source can't be landed, one whose driver is lost inside a
    step, and a third that goes through (G3, G1): the log has every finished step, the
    failing one and, settled by the third run, the lost one."""
    base = _folder(spark, "failing")
    games = read_table(spark, d, "part", ["p_partkey", "p_name"]).select(
        F.lit("game").alias("record_type"), F.col("p_partkey").cast("string").alias("game_id"),
        F.col("p_name").alias("game_name"), F.lit("2025-06-12T00:00:00").alias("extraction_time"))
    games.write.json(f"{base}/landed")
    good = Landing("twitch_games", f"{base}/landed", LANDING_SCHEMAS["twitch_games"])
    bad = Landing("howlongtobeat", f"{base}/landed", LANDING_SCHEMAS["howlongtobeat"], fmt="carrier pigeon")
    try:
        run_pipeline(spark, [good, bad], base, _RUN)
    except ValueError:
        pass
    StepLog(spark, f"{base}/etl_logs", "lost", _read).open("clean", "twitch_games", "transform/twitch_games")
    run_pipeline(spark, [good], base, "later")
    logs = spark.read.parquet(f"{base}/etl_logs")
    return logs.select("run_id", "step", "source", "status", "records_count",
                       F.when(F.col("status") == "ERROR", F.col("error_message")).alias("error"))


# ------------------------------------------------------------ similar titles
_OWN = "p_name || ' ' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8)"
_REAL = f"""CASE p_partkey % 6 WHEN 0 THEN {_OWN} || ' remastered' WHEN 1 THEN 'The ' || {_OWN}
     WHEN 2 THEN upper({_OWN}) || ': Game of the Year Edition' WHEN 3 THEN substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8) || '_' || p_name
     WHEN 4 THEN p_name ELSE 'unheard of ' || CAST(p_partkey AS VARCHAR) END"""


def _similar_sql(title: str, name: str) -> str:
    return f"""
WITH t AS (SELECT DISTINCT {title} AS name FROM part), c AS (SELECT p_partkey AS id, {name} AS name FROM part),
s AS (SELECT 0 AS side, name, CAST(NULL AS BIGINT) AS id FROM t
      UNION ALL SELECT 1, arg_min(name, id), min(id) FROM c GROUP BY lower(trim(regexp_replace(name, '\\s+', ' ', 'g')))),
w AS (SELECT DISTINCT side, name, id, unnest(regexp_extract_all(lower(name), '[\\p{{L}}\\p{{N}}]+')) AS word FROM s),
n AS (SELECT count(*) AS n FROM (SELECT DISTINCT side, name, id FROM w) x),
f AS (SELECT word, length(format('{{:b}}', (SELECT n FROM n) // count(*))) AS weight FROM w GROUP BY word),
a AS (SELECT name AS title, word, weight, sum(weight) OVER (PARTITION BY name) AS total FROM w JOIN f USING (word) WHERE side = 0),
b AS (SELECT id, name, word, weight, sum(weight) OVER (PARTITION BY id) AS total FROM w JOIN f USING (word) WHERE side = 1),
p AS (SELECT title, id, any_value(b.name) AS name, sum(a.weight) AS shared, any_value(a.total) + any_value(b.total) - sum(a.weight) AS whole
      FROM a JOIN b USING (word) GROUP BY title, id)
SELECT title, id AS match_id, name AS match_name, CAST(shared AS DOUBLE) / CAST(whole AS DOUBLE) AS similarity FROM p WHERE 5 * shared >= 3 * whole
QUALIFY row_number() OVER (PARTITION BY title ORDER BY CAST(shared AS DOUBLE) / CAST(whole AS DOUBLE) DESC, id) = 1"""


def _real_titles(spark, d) -> tuple[DataFrame, DataFrame]:
    p = read_table(spark, d, "part", ["p_partkey", "p_name"])
    digest = F.substr(F.md5(F.col("p_partkey").cast("string")), F.lit(1), F.lit(8))
    n, k = F.concat_ws(" ", "p_name", digest), F.col("p_partkey") % 6
    asked = (F.when(k == 0, F.concat(n, F.lit(" remastered"))).when(k == 1, F.concat(F.lit("The "), n))
             .when(k == 2, F.concat(F.upper(n), F.lit(": Game of the Year Edition")))
             .when(k == 3, F.concat_ws("_", digest, "p_name")).when(k == 4, F.col("p_name"))
             .otherwise(F.concat(F.lit("unheard of "), "p_partkey")))
    return p.select(asked.alias("title")), p.select(F.col("p_partkey").alias("id"), n.alias("name"))


@query("lookup_similar_words", _similar_sql(_REAL, _OWN))
def q_lookup_similar_words(spark, d):
    """Titles beyond two edits (S8, J3): editions, articles, other word orders, and
    titles that nothing is like."""
    return similar_titles(*_real_titles(spark, d))


@query("lookup_common_words", _similar_sql("CASE WHEN p_partkey % 3 = 0 THEN 'the ' || p_name ELSE 'the game ' || CAST(p_partkey % 20 AS VARCHAR) END",
                                           "CASE WHEN p_partkey % 3 = 0 THEN 'the game ' || CAST(p_partkey AS VARCHAR) ELSE 'the ' || p_name END"))
def q_lookup_common_words(spark, d):
    """Names that share one word, a third of them all but one, split in parts of forty."""
    p = read_table(spark, d, "part", ["p_partkey", "p_name"])
    third, k = F.col("p_partkey") % 3 == 0, F.col("p_partkey")
    the = F.concat(F.lit("the "), "p_name")
    titles = p.select(F.when(third, the).otherwise(F.concat(F.lit("the game "), k % 20)).alias("title"))
    names = p.select(k.alias("id"), F.when(third, F.concat(F.lit("the game "), k)).otherwise(the).alias("name"))
    return similar_titles(titles, names, block=40)


# --------------------------------------------- large objects, inferred schemas
def _one_line(spark, rows: DataFrame, target: str) -> None:
    """Members (k, member) as one JSON object in one file without line breaks, in
    the order of k."""
    parts = f"{target}.parts"
    spark.createDataFrame([("{",)], "x string").coalesce(1).write.option("lineSep", " ").text(f"{parts}/0")
    (rows.repartitionByRange("k").sortWithinPartitions("k").select("member")
     .write.option("lineSep", ", ").text(f"{parts}/1"))
    spark.createDataFrame([('"last": {"label": "}, {"}}',)], "x string").coalesce(1).write.option("lineSep", "\n").text(f"{parts}/2")
    join_parts(spark, [p for i in range(3) for p in part_files(spark, f"{parts}/{i}")], target)


@query("keyed_large", """
SELECT 'id' || CAST(event_id AS VARCHAR) AS key, CASE event_id % 4 WHEN 0 THEN 'a, "quoted" } one' WHEN 1 THEN 'back\\slash\\' ELSE event_type END AS label,
       CAST(user_id % 89 AS INTEGER) AS n, [event_type, '],[', CAST(event_id AS VARCHAR)] AS tags FROM events
UNION ALL SELECT 'last', '}, {', NULL, NULL""")
def q_keyed_large(spark, d):
    """All events as one JSON object on one line of one file (S6), with commas, brackets,
    quotes and backslashes inside strings; read in byte ranges."""
    ev = read_table(spark, d, "events", ["event_id", "user_id", "event_type"])
    k = F.col("event_id") % 4
    label = F.when(k == 0, F.lit('a, "quoted" } one')).when(k == 1, F.lit("back\\slash\\")).otherwise(F.col("event_type"))
    value = F.to_json(F.struct(label.alias("label"), (F.col("user_id") % 89).alias("n"), F.array(
        F.col("event_type"), F.lit("],["), F.col("event_id").cast("string")).alias("tags")))
    path = f"{_folder(spark, 'keyed')}/one.json"
    _one_line(spark, ev.select(F.col("event_id").alias("k"), F.concat(
        F.lit('"id'), F.col("event_id"), F.lit('": '), value).alias("member")), path)
    return read_keyed_objects(spark, path, "label string, n int, tags array<string>")


def _mixed_records(spark, d) -> DataFrame:
    """Events as JSON records whose fields change type, go missing or are null."""
    ev = read_table(spark, d, "events", ["event_id", "user_id", "event_type", "value"])
    k = F.col("event_id") % 10
    q = F.lit('"')
    fields = [
        F.concat(F.lit('"id": '), F.col("event_id")),
        F.when(k < 6, F.concat(F.lit('"amount": '), F.when(k < 3, F.col("user_id").cast("string")).otherwise(
            F.concat(F.col("user_id").cast("string"), F.lit(".25"))))).when(k == 6, F.lit('"amount": null')),
        F.when(k == 7, F.concat(F.lit('"odd": '), F.col("user_id"))).when(k == 8, F.concat(F.lit('"odd": '), q, F.col("event_type"), q)),
        F.when(k == 9, F.lit('"odd": {"x": true}')),
        F.when(k != 4, F.concat(F.lit('"user": {"name": '), q, F.col("event_type"), q, F.lit(', "tags": ['),
                                F.when(k % 2 == 0, F.lit("1, 2")).otherwise(F.lit("")), F.lit("]}"))),
        F.lit('"a.b": 1e5'),
    ]
    return ev.select(F.when(k == 5, F.lit("{broken")).otherwise(
        F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))).alias("json"))


@query("schema_report", """
WITH e AS (SELECT event_id % 10 AS k FROM events), g AS (SELECT * FROM e WHERE k <> 5),
o(path, type, conflict, kind, n) AS (
  SELECT '', 'object', FALSE, 'object', count(*) FROM g UNION ALL
  SELECT '', 'object', FALSE, 'null', count(*) FROM e WHERE k = 5 UNION ALL
  SELECT 'id', 'whole', FALSE, 'whole', count(*) FROM g UNION ALL
  SELECT 'amount', 'decimal', FALSE, 'whole', count(*) FROM g WHERE k < 3 UNION ALL
  SELECT 'amount', 'decimal', FALSE, 'decimal', count(*) FROM g WHERE k IN (3, 4) UNION ALL
  SELECT 'amount', 'decimal', FALSE, 'null', count(*) FROM g WHERE k = 6 UNION ALL
  SELECT 'odd', 'text', TRUE, 'whole', count(*) FROM g WHERE k = 7 UNION ALL
  SELECT 'odd', 'text', TRUE, 'text', count(*) FROM g WHERE k = 8 UNION ALL
  SELECT 'odd', 'text', TRUE, 'object', count(*) FROM g WHERE k = 9 UNION ALL
  SELECT 'odd.x', 'boolean', FALSE, 'boolean', count(*) FROM g WHERE k = 9 UNION ALL
  SELECT 'user', 'object', FALSE, 'object', count(*) FROM g WHERE k <> 4 UNION ALL
  SELECT 'user.name', 'text', FALSE, 'text', count(*) FROM g WHERE k <> 4 UNION ALL
  SELECT 'user.tags', 'list', FALSE, 'list', count(*) FROM g WHERE k <> 4 UNION ALL
  SELECT 'user.tags.[]', 'whole', FALSE, 'whole', count(*) FROM g WHERE k <> 4 AND k % 2 = 0 UNION ALL
  SELECT 'user.tags.[]', 'whole', FALSE, 'null', count(*) FROM g WHERE k <> 4 AND k % 2 = 1 UNION ALL
  SELECT '`a.b`', 'double', FALSE, 'double', count(*) FROM g)
SELECT path, any_value(type) AS type, CAST(sum(n) AS BIGINT) AS n_records,
       CAST(coalesce(sum(n) FILTER (WHERE kind = 'null'), 0) AS BIGINT) AS n_null, any_value(conflict) AS conflict,
       string_agg(kind || ':' || CAST(n AS VARCHAR), ',' ORDER BY kind) AS observed FROM o WHERE n > 0 GROUP BY path""")
def q_schema_report(spark, d):
    """Types observed per field path of mixed records, and where they conflict."""
    return schema_report(_mixed_records(spark, d)).drop("digits", "places")


@query("schema_inferred_read", """
SELECT CASE WHEN event_id % 10 <> 5 THEN event_id END AS id,
       CASE WHEN event_id % 10 < 3 THEN CAST(user_id AS DOUBLE) WHEN event_id % 10 IN (3, 4) THEN CAST(user_id AS DOUBLE) + 0.25 END AS amount,
       CASE event_id % 10 WHEN 7 THEN CAST(user_id AS VARCHAR) WHEN 8 THEN event_type WHEN 9 THEN '{"x":true}' END AS odd,
       CASE WHEN event_id % 10 NOT IN (4, 5) THEN event_type END AS user_name FROM events""")
def q_schema_inferred_read(spark, d):
    """The same records read with the schema that the report gives: a conflict is text."""
    records = _mixed_records(spark, d)
    schema = inferred_schema(schema_report(records))
    r = records.select(F.from_json("json", schema).alias("r"))
    return r.select("r.id", F.col("r.amount").cast("double").alias("amount"), "r.odd", F.col("r.user.name").alias("user_name"))


# ------------------------------------------- quantiles, large k, ties of maps
@query("quantile_by_group", """
SELECT l_returnflag AS return_flag, percentile_disc(0.9) WITHIN GROUP (ORDER BY l_extendedprice) AS p90 FROM lineitem GROUP BY l_returnflag""")
def q_quantile_by_group(spark, d):
    """The ninth decile of prices per group, a value of the data."""
    li = read_table(spark, d, "lineitem", ["l_returnflag", "l_extendedprice"])
    found = exact_quantiles(li, "l_returnflag", "l_extendedprice", 0.9)
    out = with_exact_quantiles(li.select("l_returnflag").distinct(), "l_returnflag", found, "p90", li.schema["l_extendedprice"].dataType)
    return out.withColumnRenamed("l_returnflag", "return_flag")


@query("topk_large", """
WITH s AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END AS game_id, l_orderkey, l_linenumber, l_extendedprice FROM lineitem)
SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) <= 5000""")
def q_topk_large(spark, d):
    """The 5,000 largest of each key, one of which has a third of all rows."""
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice"])
    keyed = li.select(F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_suppkey")).alias("game_id"),
                      "l_orderkey", "l_linenumber", "l_extendedprice")
    return top_k_per_key(keyed, ["game_id"], [("l_extendedprice", "desc"), "l_orderkey", "l_linenumber"], 5000)


@query("dedup_map_ties", """
SELECT o_custkey, o_orderstatus, o_orderpriority || '=' || CAST(o_orderkey % 5 AS VARCHAR) AS entries FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus, o_orderpriority || '=' || CAST(o_orderkey % 5 AS VARCHAR)) = 1""")
def q_dedup_map_ties(spark, d):
    """Rows of a key that differ only in a map (D1, P27): the one whose entries come first
    stays, whatever the partitioning."""
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])
    # the same entries, put in in two orders
    a, b = [F.lit("status"), F.col("o_orderstatus")], [F.lit("work"), F.concat("o_orderpriority", F.lit("="), F.col("o_orderkey") % 5)]
    m = F.when(F.col("o_orderkey") % 2 == 0, F.create_map(*a, *b)).otherwise(F.create_map(*b, *a))
    # a customer's rows are dealt over all tasks, each of a share of the rows
    rows = o.select("o_custkey", m.alias("m"), "o_orderkey").repartition(F.xxhash64("m.work", "o_orderkey")).drop("o_orderkey")
    kept = keep_first(rows, ["o_custkey"], [canonical(F.col("m"), rows.schema["m"].dataType)])
    return kept.select("o_custkey", F.col("m.status").alias("o_orderstatus"), F.col("m.work").alias("entries"))


# -------------------------------------------------------------- one CSV file
@query("csv_one_file", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'a "b", ' || p_name ELSE p_name END AS p_name,
       '[' || array_to_string(string_split(p_name, ' '), ', ') || ']' AS types FROM part""")
def q_csv_one_file(spark, d):
    """One CSV file with one header, written by several tasks, read back (K2)."""
    p = read_table(spark, d, "part", ["p_partkey", "p_name"])
    name = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('a "b", '), "p_name")).otherwise(F.col("p_name"))
    path = f"{_folder(spark, 'one-csv')}/part.csv"
    export_csv_file(p.select("p_partkey", name.alias("p_name"), F.split("p_name", " ").alias("types")).repartition(5), path)
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


@query("export_all_files", """
SELECT 'nation' AS dataset, CAST(n_nationkey AS VARCHAR) AS id, n_name AS label FROM nation
UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), c_name FROM customer""")
def q_export_all_files(spark, d):
    """Every dataset of a folder exported to a CSV file of its name."""
    base = _folder(spark, "exports")
    for name, cols in (("nation", ["n_nationkey", "n_name"]), ("customer", ["c_custkey", "c_name"])):
        read_table(spark, d, name, cols).write.parquet(f"{base}/data/{name}")
    export_all(spark, ["nation", "customer"], f"{base}/data", f"{base}/csv", single_file=True)
    back = [spark.read.option("header", True).csv(f"{base}/csv/{n}.csv").toDF("id", "label").select(F.lit(n).alias("dataset"), "id", "label")
            for n in ("nation", "customer")]
    return back[0].unionByName(back[1])


# ------------------------------------------------------------- smaller pieces
@query("audit_stamp", "SELECT p_partkey, TRUE AS in_bounds, 1::BIGINT AS n_stamps FROM part")
def q_audit_stamp(spark, d):
    """The registration stamp of a load (X5, P2): one for all rows of a run, and between
    the run's begin and its end."""
    begin = F.lit(datetime.now(timezone.utc))
    path = _folder(spark, "stamped")
    with_audit_columns(read_table(spark, d, "part", ["p_partkey"]), "TPCH", "part", _RUN).write.parquet(path)
    end = F.lit(datetime.now(timezone.utc))
    got = spark.read.parquet(path)
    one = got.select(F.count_distinct("dw_fecha_registro")).scalar()
    return got.select("p_partkey", F.col("dw_fecha_registro").between(begin, end).alias("in_bounds"), one.alias("n_stamps"))
