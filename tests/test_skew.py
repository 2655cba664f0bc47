"""A key holding a third of all rows must not change results and must be
reduced map-side (partial aggregate / partial window limit) before any
shuffle, so no task receives the whole hot group."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from martlet.operators import (
    duplicate_count, first_match_lookup, keep_first, popular_entities, top_k_per_key,
)

N = 30_000


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    # key 0 holds one third of the rows, the rest spread over 2,000 keys
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        F.col("id"), ((F.col("id") * 7919) % 1000).alias("v")).repartition(8)


def test_top_k_hot_key(spark, skewed):
    out = top_k_per_key(skewed, ["k"], [("v", "desc"), "id"], 3)
    rows = [(r.k, r.v, r.id) for r in out.collect()]
    groups = defaultdict(list)
    for i in range(N):
        k = 0 if i % 3 == 0 else i % 2000 + 1
        groups[k].append((-(i * 7919 % 1000), i))
    expect = sorted((k, -nv, i) for k, g in groups.items() for nv, i in sorted(g)[:3])
    assert sorted(rows) == expect
    plan = _plan(out)
    assert plan.index("Partial") > plan.index("Exchange hashpartitioning")  # partial below


def test_keep_first_hot_key(spark, skewed):
    out = keep_first(skewed, ["k"], ["v", "id"])
    got = {r.k: r.id for r in out.collect()}
    assert got[0] == min((i * 7919 % 1000, i) for i in range(0, N, 3))[1]
    assert len(got) == 2001


def test_popular_entities_hot_game(spark, skewed):
    games = spark.range(2001).select(F.col("id").alias("game_id"),
                                     F.concat(F.lit("g"), F.col("id")).alias("game_name"),
                                     F.lit(False).alias("dw_deleted"))
    streams = skewed.select(F.col("id").alias("stream_id"), F.col("k").alias("game_id"),
                            F.col("v").alias("viewer_count"),
                            (F.col("v") % 10 == 0).alias("dw_deleted"))
    out = popular_entities(games, streams, keep_key=True)
    got = {r.game_id: (r.active_streams, r.total_viewers) for r in out.collect()}
    live = Counter()
    total = Counter()
    for i in range(N):
        k, v = (0 if i % 3 == 0 else i % 2000 + 1), i * 7919 % 1000
        if v % 10:
            live[k] += 1
            total[k] += v
    assert got[0] == (live[0], total[0])
    assert all(got[k] == (live[k], total[k]) for k in live)
    plan = _plan(out)
    assert "partial_count" in plan and "partial_sum" in plan


def test_duplicate_count_hot_key(spark, skewed):
    assert duplicate_count(skewed, ["k"]).first()[0] == N - 2001


def test_lookup_hot_catalogue_name(spark):
    # one normalised name repeated 10,000 times is reduced to its smallest id
    cat = spark.range(10_000).select(F.col("id"), F.lit("Zelda  Quest").alias("name")) \
        .unionByName(spark.createDataFrame([(20_000, "Doom")], "id long, name string"))
    titles = spark.createDataFrame([("zelda quest",), ("zelda quesy",), ("dom",)], "title string")
    got = {r.title: (r.match_id, r.distance)
           for r in first_match_lookup(titles, cat, id_col="id").collect()}
    assert got == {"zelda quest": (0, 0), "zelda quesy": (0, 1), "dom": (20_000, 1)}


def test_duration_view_splits_a_common_value(spark):
    """Equal measures don't share one sort task: more tasks hold rows than there are values."""
    from pyspark.sql import functions as F
    from martlet.operators.mart import duration_view
    df = spark.range(4000).select(F.col("id"), (F.col("id") % 2).cast("double").alias("main_story"))
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = duration_view(df, deleted=None)
        held = out.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert len(held) >= 6 and max(r["count"] for r in held) < 1500


def test_shared_segments_keep_candidates_few(spark):
    """All names share a prefix: one block of n names, yet far fewer than n * n pairs."""
    from pyspark.sql import functions as F
    from martlet.operators.lookup import segment_candidates
    n = 1500
    names = spark.range(n).select(
        F.concat(F.lit("a shared long prefix "), F.substr(F.md5(F.col("id").cast("string")), F.lit(1), F.lit(12)))
        .alias("_ck"), F.col("id").alias("match_id")).withColumn("match_name", F.col("_ck"))
    titles = names.select(F.col("_ck").alias("title"), F.col("_ck").alias("_k"))
    pairs = segment_candidates(titles, names, 2, block=20)
    assert pairs.filter("title = _ck").select("title").distinct().count() == n
    assert pairs.distinct().count() < 20 * n
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan or "MERGE" in plan.upper()
