from pyspark.sql import functions as F

from martlet.operators import (
    distinct_values, keep_first, split_by_kind, top_k_per_key, union_kinds,
)
from martlet.functions import is_present


def test_filter_before_dedup_keeps_good_duplicate(spark):
    # same game twice, the first (older) with a blank name
    df = spark.createDataFrame(
        [("g1", "", "2025-06-10"), ("g1", "Zelda", "2025-06-09"), ("g2", "Mario", "2025-06-10")],
        "game_id string, game_name string, ts string")
    out = keep_first(df.filter(is_present("game_name")), ["game_id"], [("ts", "desc")])
    assert sorted(r.game_name for r in out.collect()) == ["Mario", "Zelda"]


def test_keep_first_is_deterministic_and_null_key_is_one_group(spark):
    rows = [(None, 3), (None, 1), (1, 5), (1, 2), (2, None), (2, 7)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(3)
    got = {(r.k, r.v) for r in keep_first(df, ["k"], ["v"]).collect()}
    assert got == {(None, 1), (1, 2), (2, None)}  # ascending: NULL first


def test_top_k_plans_partial_limit_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    out = top_k_per_key(df, ["k"], [("v", "desc")], 2)
    assert sorted((r.k, r.v) for r in out.collect()) == [(0, 996), (0, 999), (1, 994),
                                                          (1, 997), (2, 995), (2, 998)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_distinct_values_limit(spark):
    df = spark.createDataFrame([(n,) for n in "cbacab"], "n string")
    assert [r.n for r in distinct_values(df, "n", limit=2).collect()] == ["a", "b"]


def test_split_and_union_by_name(spark):
    df = spark.createDataFrame([("game", "1", None), ("stream", None, "s1")],
                               "record_type string, game_id string, stream_id string")
    k = split_by_kind(df, ["game", "stream"])
    g = k["game"].select("record_type", "game_id")
    s = k["stream"].select("record_type", "stream_id")
    u = union_kinds([g, s, g.limit(0)])
    assert set(u.columns) == {"record_type", "game_id", "stream_id"}
    assert u.count() == 2
