import datetime as dt
from decimal import Decimal

import pytest

from martlet.plans.specs import (
    clean, clean_source, reject_counts, TWITCH, HLTB, PROFILES,
)
from martlet.sources import empty_frame, GAMES, STREAMS, POKEDEX as POKEDEX_SCHEMA, HLTB as HLTB_S
from martlet.operators import union_kinds


def _twitch_raw(spark):
    g = spark.createDataFrame([
        ("game", "1", "", None, "2025-06-10T10:00:00", "twitch", "games/top"),
        ("game", "1", " Zelda ", "", "2025-06-09T10:00:00", "twitch", "games/top"),
        ("game", "2", "   ", "u", "2025-06-10T10:00:00", "twitch", "games/top"),
        ("game", "3", "Mario", "http://x/{width}x{height}.jpg", "2025-06-10T10:00:00",
         "twitch", "games/top"),
    ], GAMES)
    s = spark.createDataFrame([
        ("stream", "s1", " title ", "1", None, "u1", "ann", None, "2025-06-10T19:45:49Z", "",
         "2025-06-10T10:00:00", "twitch", "streams"),
        ("stream", "s2", "t", "1", "Zelda", "u2", "", 5, "2025-06-10T19:45:49Z", "en",
         "2025-06-10T10:00:00", "twitch", "streams"),
        ("stream", "s3", "t", "3", "Mario", "u3", "bob", 7, "not a time", None,
         "2025-06-10T10:00:00", "twitch", "streams"),
    ], STREAMS)
    return union_kinds([g, s])


def test_clean_twitch_edge_rows(spark):
    out = clean(_twitch_raw(spark), TWITCH, run_id="r1")
    games = {r.game_id: r for r in out.filter("record_type = 'game'").collect()}
    assert set(games) == {"1", "3"}           # blank-name copy filtered before dedup (T1, T2)
    assert games["1"].game_name == "Zelda" and games["1"].box_art_url is None
    streams = {r.stream_id: r for r in out.filter("record_type = 'stream'").collect()}
    assert set(streams) == {"s1", "s3"}       # blank user dropped
    s1 = streams["s1"]
    assert (s1.viewer_count, s1.language, s1.stream_title) == (0, "unknown", "title")
    assert s1.started_at == dt.datetime(2025, 6, 10, 19, 45, 49)  # UTC marker honoured (T4)
    assert streams["s3"].started_at is None   # bad text -> NULL, no job failure (T6)
    assert {r.dw_id_carga for r in out.collect()} == {"r1"}  # run id stored (T12)
    assert "source" not in out.columns and "endpoint" not in out.columns
    assert dict(out.dtypes)["started_at"] == "timestamp"       # not widened to string
    assert dict(out.dtypes)["extraction_time"] == "timestamp"  # always converted (T3)


def test_clean_pokedex_nested(spark):
    raw = spark.createDataFrame([
        ("pokedex", "bulbasaur", " Bulbasaur", ["Grass", "Poison"],
         {"hp": 45, "atk": 49}, {"0": "Overgrow"}, "2025-06-10T10:00:00", "showdown", "x"),
        ("pokedex", "ditto", "Ditto", [], {"hp": 48}, None, "2025-06-10T10:00:00", "showdown", "x"),
        ("pokedex", "pikachu", "Pikachu", ["Electric"], {}, {}, "2025-06-10T10:00:00",
         "showdown", "x"),
    ], POKEDEX_SCHEMA)
    out = {r.pokemon_id: r for r in clean_source(raw, "SHOWDOWN_POKEDEX", "r1").collect()}
    b, d, p = out["bulbasaur"], out["ditto"], out["pikachu"]
    assert (b.name, b.hp, b.atk, b.spe, b.type1, b.type2) == ("Bulbasaur", 45, 49, None, "Grass",
                                                             "Poison")
    assert (d.type1, d.type2, d.hp) == (None, None, 48)      # empty array (T7, T8)
    assert (p.type1, p.type2) == ("Electric", None)
    assert b.abilities_json == '{"0":"Overgrow"}'
    assert b.dw_source == "SHOWDOWN"


def test_clean_hltb_measures(spark):
    raw = spark.createDataFrame([
        ("hl_tb_time", "Game A ", None, 80.0, 0.0, 12.5, None, "2025-06-10T10:00:00", "h", "e"),
        ("hl_tb_time", "Game B", None, None, -1.0, None, None, "2025-06-10T10:00:00", "h", "e"),
        ("hl_tb_time", "Game C", None, None, 6499.35, 10000.0, 9999.99, "2025-06-10T10:00:00",
         "h", "e"),
    ], HLTB_S)
    out = {r.game_name: r for r in clean(raw, HLTB).collect()}
    assert set(out) == {"Game A", "Game C"}                  # all measures NULL -> dropped
    assert out["Game A"].main_story is None and out["Game A"].main_extra == Decimal("12.50")
    c = out["Game C"]
    assert (c.main_story, c.main_extra, c.completionist) == (
        Decimal("6499.35"), None, Decimal("9999.99"))       # overflow -> NULL (T10)


def test_profiles_key_is_username_and_format(spark):
    raw = spark.createDataFrame([
        ("profile", "ash", "gen9ou", "", "", "", "2025-06-10T10:00:00", "s", "e"),
        ("profile", "ash", "gen9ubers", "", "", "", "2025-06-10T10:00:00", "s", "e"),
        ("profile", "i<3bea", "gen9ou", "", "", "", "2025-06-10T10:00:00", "s", "e"),
    ], "record_type string, username string, format string, gxe string, rating string, "
       "levels string, extraction_time string, source string, endpoint string")
    assert clean(raw, PROFILES).count() == 3


def test_empty_input_and_dispatch(spark):
    assert clean(empty_frame(spark, GAMES), TWITCH).count() == 0
    with pytest.raises(ValueError):
        clean_source(empty_frame(spark, GAMES), "nope")


def test_reject_counts(spark):
    rej = {(r.kind, r.column_name): r.rejected
           for r in reject_counts(_twitch_raw(spark), TWITCH).collect()}
    assert rej == {("stream", "started_at"): 1}   # "not a time"; NULLs are not rejects
    h = spark.createDataFrame([("hl_tb_time", "A", None, None, 10000.0, -1.0, None, "t", "h", "e")],
                              HLTB_S)
    rej = {(r.kind, r.column_name): r.rejected for r in reject_counts(h, HLTB).collect()}
    assert rej == {("*", "main_story"): 1, ("*", "extraction_time"): 1}
