import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from martlet.operators import (
    duration_view, entity_kpis, load_summary, log_kpis, mode_comparison,
    popular_entities, stat_leaders, value_distribution, count_per_category,
    usage_ranking, casted_view, with_duration_seconds,
)
from martlet.plans.views import register_mart_views, register_table_functions

G = "game_id string, game_name string, dw_deleted boolean"
S = "stream_id string, game_id string, viewer_count int, dw_deleted boolean"


def _mart(spark):
    games = spark.createDataFrame([
        ("1", "Alpha", False),   # two live streams
        ("2", "Beta", False),    # no streams at all -> stays, count 0
        ("3", "Gamma", False),   # all streams deleted -> disappears (T16)
        ("4", "Delta", True),    # deleted game
        ("5", "Eps", False),     # stream with NULL flag counts as live (P20)
    ], G)
    streams = spark.createDataFrame([
        ("s1", "1", 100, False), ("s2", "1", 50, False), ("s3", "1", 999, True),
        ("s4", "3", 70, True), ("s5", "4", 10, False), ("s6", "5", 30, None),
    ], S)
    return games, streams


def test_popular_entities_left_join_soft_delete(spark):
    games, streams = _mart(spark)
    r = popular_entities(games, streams).collect()
    assert [x.game_name for x in r] == ["Alpha", "Eps", "Beta"]  # NULL total last (T15)
    a, e, b = r
    assert (a.active_streams, a.avg_viewers, a.total_viewers, a.max_viewers) == (2, 75.0, 150, 100)
    assert (e.active_streams, e.total_viewers) == (1, 30)
    assert (b.active_streams, b.avg_viewers, b.total_viewers, b.max_viewers) == (0, None, None, None)


def test_popular_entities_nulls_first_and_multiplicity(spark):
    games, streams = _mart(spark)
    first = popular_entities(games, streams, nulls="first").collect()
    assert first[0].game_name == "Beta"  # PostgreSQL DESC order
    doubled = games.unionByName(games.filter("game_id = '1'"))  # two loads of game 1 (T17)
    r = {x.game_name: x for x in popular_entities(doubled, streams).collect()}
    assert (r["Alpha"].active_streams, r["Alpha"].total_viewers) == (4, 300)


def test_popular_entities_latest_run(spark):
    g = spark.createDataFrame([("1", "A", False, "r1"), ("1", "A", False, "r2")],
                              G + ", run string")
    s = spark.createDataFrame([("s", "1", 5, False, "r1"), ("s", "1", 7, False, "r2")],
                              S + ", run string")
    r = popular_entities(g, s, run_col="run").collect()
    assert [(x.active_streams, x.total_viewers) for x in r] == [(1, 7)]


def test_entity_kpis_single_row(spark):
    games, streams = _mart(spark)
    r = entity_kpis(games, streams).collect()
    assert len(r) == 1
    k = r[0]
    assert k.total_games == 4 and k.total_active_streams == 3  # NULL flag excluded (P19)
    assert abs(k.avg_viewers_per_stream - (100 + 50 + 10) / 3) < 1e-9
    assert (k.top_game, k.top_game_viewers) == ("Alpha", 150)
    assert entity_kpis(games, streams, approx_distinct=True).first().total_games == 4


def _logs(spark):
    now = dt.datetime(2025, 6, 10, 12, 0, 0)
    m = dt.timedelta(minutes=1)
    rows = [  # the three sample log rows: 5 minutes each
        ("TWITCH", now - 60 * m, now - 55 * m, 1000, "SUCCESS"),
        ("TWITCH", now - 50 * m, now - 45 * m, 2500, "SUCCESS"),
        ("HLTB", now - 30 * m, now - 25 * m, 750, "SUCCESS"),
    ]
    df = spark.createDataFrame(rows, "source string, load_start_time timestamp, "
                                     "load_end_time timestamp, records_count int, status string")
    return with_duration_seconds(df)


def test_load_summary_sample_rows(spark):
    r = load_summary(_logs(spark)).collect()
    assert [(x.source, x.total_loads, x.total_records, x.avg_duration_seconds, x.success_rate)
            for x in r] == [("TWITCH", 2, 3500, 300.0, 100.0), ("HLTB", 1, 750, 300.0, 100.0)]
    one = load_summary(_logs(spark), source="HLTB").collect()
    assert [x.source for x in one] == ["HLTB"]


def test_success_rate_shares(spark):
    t = dt.datetime(2025, 1, 1)
    rows = [("A", "SUCCESS"), ("A", "SUCCESS"), ("B", "SUCCESS"), ("B", "SUCCESS"),
            ("B", "ERROR"), ("C", "ERROR")]
    df = spark.createDataFrame([(s, t, t, 1, st) for s, st in rows],
                               "source string, load_start_time timestamp, load_end_time timestamp, "
                               "records_count int, status string")
    r = {x.source: x.success_rate for x in load_summary(with_duration_seconds(df)).collect()}
    assert r == {"A": 100.0, "B": 66.67, "C": 0.0}
    e = {x.source: x.error_loads for x in log_kpis(df).collect()}
    assert e == {"A": 0, "B": 1, "C": 1}


def test_duration_view_edges(spark):
    df = spark.createDataFrame(
        [("a", Decimal("10.00"), False), ("b", Decimal("25.00"), False),
         ("c", Decimal("50.00"), False), ("d", None, False), ("e", Decimal("60.00"), True)],
        "game_name string, main_story decimal(6,2), dw_deleted boolean")
    r = duration_view(df).collect()
    assert [(x.game_name, x.duration_category) for x in r] == [
        ("c", "Largo (25-50h)"), ("b", "Medio (10-25h)"), ("a", "Medio (10-25h)")]


def test_mode_comparison_leaders_distribution(spark):
    df = spark.createDataFrame([(1, Decimal("1.00"), Decimal("3.00")),
                                (2, Decimal("2.00"), None)],
                               "id int, main_story decimal(6,2), main_extra decimal(6,2)")
    r = {x.mode: x for x in mode_comparison(df, ["main_story", "main_extra"], ["id"]).collect()}
    assert (r["main_story"].n_values, r["main_story"].avg_value) == (2, 1.5)
    assert r["main_story"].median_value == Decimal("1.00")
    assert r["main_extra"].n_values == 1
    st = spark.createDataFrame([(1, 10, 5), (2, 10, 9)], "id int, hp int, atk int")
    lead = {x.stat: (x.id, x.value) for x in stat_leaders(st, "id", ["hp", "atk"]).collect()}
    assert lead == {"hp": (1, 10), "atk": (2, 9)}
    ty = spark.createDataFrame([(["Fire", "Flying"],), (["Fire"],), ([],)], "types array<string>")
    assert {x.value: x.n_rows for x in value_distribution(ty, "types").collect()} == {
        "Fire": 2, "Flying": 1}


def test_category_counts_and_usage(spark):
    kids = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    par = spark.createDataFrame([(1, "x"), (2, "y")], "k int, category string")
    assert {r.category: r.n_rows for r in count_per_category(kids, par, "k").collect()} == {
        "x": 2, "y": 1}
    u = spark.createDataFrame([("p", "ou", Decimal("10.00"), "2025-01", False),
                               ("p", "ou", Decimal("20.00"), "2025-02", False),
                               ("p", "ou", Decimal("99.00"), "2025-03", True)],
                              "name string, fmt string, usage decimal(6,2), month string, "
                              "dw_deleted boolean")
    r = usage_ranking(u, "name", "fmt", "usage", "month").first()
    assert (r.avg_usage_percentage, r.months_tracked, r.latest_month) == (15.0, 2, "2025-02")


def test_casted_view_and_sql_functions(spark):
    games, streams = _mart(spark)
    streams = streams.withColumn("extraction_time", F.lit("2025-06-10T10:00:00"))
    cv = casted_view(streams, "extraction_time").first()
    assert cv.extraction_time_casted == dt.datetime(2025, 6, 10, 10, 0)
    register_mart_views(spark, games, streams, logs=_logs(spark))
    register_table_functions(spark)
    k = spark.sql("SELECT * FROM get_twitch_kpis()").collect()
    assert [(x.total_games, x.top_game, x.top_game_viewers) for x in k] == [(4, "Alpha", 150)]
    s = spark.sql("SELECT * FROM get_load_summary('TWITCH')").collect()
    assert [(x.source, x.total_records, x.avg_duration_seconds) for x in s] == [
        ("TWITCH", 3500, 300.0)]
    assert spark.sql("SELECT COUNT(*) FROM get_load_summary()").first()[0] == 2
    pop = spark.sql("SELECT game_name FROM v_twitch_popular_games").collect()
    assert {r.game_name for r in pop} == {"Alpha", "Beta", "Eps"}
    g2 = games.withColumn("dw_id_carga", F.lit("r1")).unionByName(
        games.filter("game_id = '1'").withColumn("dw_id_carga", F.lit("r2")))
    s2 = streams.withColumn("dw_id_carga", F.lit("r2"))
    register_mart_views(spark, g2, s2)
    latest = spark.sql("SELECT game_name, total_viewers FROM v_twitch_popular_games_latest")
    assert [tuple(r) for r in latest.collect()] == [("Alpha", 150)]
    doubled = spark.sql("SELECT total_viewers FROM v_twitch_popular_games "
                        "WHERE game_name = 'Alpha'").first()[0]
    assert doubled == 300  # every load joined, as the plain view does


def test_kpis_and_views_on_empty_tables(spark):
    games = spark.createDataFrame([], G)
    streams = spark.createDataFrame([], S)
    k = entity_kpis(games, streams).collect()
    assert [tuple(r) for r in k] == [(0, 0, None, None, None)]
    assert popular_entities(games, streams).count() == 0
    assert load_summary(_logs(spark).limit(0)).count() == 0


def test_duration_sql_view(spark):
    games, streams = _mart(spark)
    hltb = spark.createDataFrame(
        [("A", Decimal("60.00"), None, None, False), ("B", Decimal("5.00"), None, None, False),
         ("C", None, Decimal("3.00"), None, False), ("D", Decimal("30.00"), None, None, True)],
        "game_name string, main_story decimal(6,2), main_extra decimal(6,2), "
        "completionist decimal(6,2), dw_deleted boolean")
    register_mart_views(spark, games, streams, hltb=hltb)
    r = spark.sql("SELECT game_name, duration_category FROM v_hltb_games_by_duration").collect()
    assert [tuple(x) for x in r] == [("A", "Muy Largo (> 50h)"), ("B", "Corto (< 10h)")]
