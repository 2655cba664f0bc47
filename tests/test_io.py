import pytest
import json
import os

from pyspark.sql import functions as F

from martlet.plans.job_catalogue import _run as job_run
from martlet.plans.pipeline import Landing, _not_stored, export_all, run_pipeline
from martlet.sinks import (
    append_new_rows, drop_void_columns, export_csv, restamp_lineage, route_by_kind,
    write_parquet,
)
from martlet.sources import (
    STREAMS, conform_to_schema, flatten_keyed_objects, point_read, read_json, read_pages,
    stamp_batch_time,
)
from martlet.sources.schemas import HLTB as HLTB_RAW, schema_of, S, L, I


def test_parquet_round_trip_and_point_read(spark, tmp_dir):
    df = spark.createDataFrame([(10, "ash"), (20, "birch")], "id bigint, tree string")
    p = os.path.join(tmp_dir, "t")
    write_parquet(df, p)
    back = point_read(spark.read.parquet(p), "id", 20)
    assert [r.tree for r in back.collect()] == ["birch"]
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,20)]" in \
        back._jdf.queryExecution().executedPlan().toString()


def test_csv_export_complex_types(spark, tmp_dir):
    df = spark.createDataFrame([("p", ["Fire"], {"hp": 1}, (1, "q"))],
                               "id string, types array<string>, s map<string,int>, "
                               "st struct<a:int,b:string>")
    p = os.path.join(tmp_dir, "csv")
    export_csv(df, p, single_file=True)
    back = spark.read.option("header", True).csv(p).first()
    assert (back.types, back.s, back.st) == ("[Fire]", "{hp -> 1}", "{1, q}")


def test_jdbc_sink_drops_void_columns(spark):
    # No database is started in tests: the JDBC write itself is not exercised here.
    df = spark.createDataFrame([("g1", "Zelda")], "game_id string, game_name string") \
        .withColumn("dw_id_carga", F.lit(None))  # void column (T13)
    assert drop_void_columns(df).columns == ["game_id", "game_name"]


def test_paged_landing_and_keyed_objects(spark, tmp_dir):
    d = os.path.join(tmp_dir, "pages")
    os.makedirs(d)
    for i, ids in enumerate([["a", "b"], ["c", "d"], []]):
        with open(os.path.join(d, f"page-{i:03d}.json"), "w") as f:
            json.dump({"data": [{"id": x, "name": x.upper()} for x in ids],
                       "pagination": {"cursor": f"c{i}"}}, f)
    item = schema_of(("id", S), ("name", S))
    got = [r.id for r in read_pages(spark, d, item, limit=3).collect()]
    assert got == ["a", "b", "c"]
    obj = spark.createDataFrame([('{"bulbasaur": {"name": "Bulbasaur", "types": ["Grass"]},'
                                  ' "ditto": {"name": "Ditto"}}',)], "payload string")
    flat = flatten_keyed_objects(obj, "payload", "name string, types array<string>",
                                 key_name="pokemon_id")
    rows = {r.pokemon_id: (r.name, r.types) for r in flat.collect()}
    assert rows == {"bulbasaur": ("Bulbasaur", ["Grass"]), "ditto": ("Ditto", None)}


def test_conform_defaults_and_stamp(spark):
    df = spark.createDataFrame([("1", None)], "records_count string, source string")
    target = schema_of(("records_count", I), ("source", S), ("status", S), ("load_id", L))
    r = conform_to_schema(df, target, {"status": "SUCCESS", "source": "UNKNOWN"}).first()
    assert (r.records_count, r.source, r.status, r.load_id) == (1, None, "SUCCESS", None)
    assert stamp_batch_time(df, "t0").first().extraction_time == "t0"


def test_routing_and_lineage(spark):
    df = spark.createDataFrame([("game", "1"), ("stream", "2"), ("odd", "3")],
                               "record_type string, id string")
    r = route_by_kind(df, {"game": ("g", ["id"]), "stream": ("s", None)})
    assert r["g"].columns == ["id"] and r["s"].count() == 1 and r["_unrouted"].count() == 1
    st = restamp_lineage(df, "twitch", "load/core_twitch", "r1").first()
    assert (st.dw_source, st.dw_endpoint, st.dw_id_carga) == ("TWITCH", "load/core_twitch", "r1")
    assert append_new_rows(df, df.filter("id = '1'"), ["id"]).count() == 2


def test_pipeline_rerun_is_idempotent(spark, tmp_dir):
    land_dir = os.path.join(tmp_dir, "landed")
    os.makedirs(land_dir)
    recs = [
        {"record_type": "game", "game_id": "1", "game_name": "Zelda", "source": "twitch",
         "endpoint": "games/top", "extraction_time": "2025-06-10T10:00:00"},
        {"record_type": "stream", "stream_id": "s1", "game_id": "1", "user_name": "ann",
         "user_id": "u", "viewer_count": 10, "started_at": "2025-06-10T19:45:49Z",
         "extraction_time": "2025-06-10T10:00:00", "source": "twitch", "endpoint": "streams"},
        {"record_type": "stream", "stream_id": "s1", "game_id": "1", "user_name": "ann",
         "user_id": "u", "viewer_count": 10, "started_at": "2025-06-10T19:45:49Z",
         "extraction_time": "2025-06-10T10:00:00", "source": "twitch", "endpoint": "streams"},
    ]
    with open(os.path.join(land_dir, "part-0.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    schema = schema_of(*[(f.name, f.dataType) for f in STREAMS.fields] +
                     [("box_art_url", S)])
    src = Landing("twitch", land_dir, schema)
    base = os.path.join(tmp_dir, "wh")
    for _ in range(2):  # the same run twice: second adds nothing
        logs = run_pipeline(spark, [src], base, run_id="r1")
    assert spark.read.parquet(os.path.join(base, "core", "twitch_games")).count() == 1
    assert spark.read.parquet(os.path.join(base, "core", "twitch_streams")).count() == 1
    last = {(r.step, r.source): r.records_count for r in logs.collect()}
    assert last[("land", "TWITCH")] == 3 and last[("clean", "TWITCH")] == 2
    games = spark.read.parquet(os.path.join(base, "core", "twitch_games")).first()
    assert (games.dw_source, games.dw_endpoint, games.dw_id_carga) == (
        "TWITCH", "load/core_twitch", "r1")
    assert {r.status for r in spark.read.parquet(os.path.join(base, "etl_logs")).collect()} == {
        "SUCCESS"}
    export_all(spark, ["twitch_games"], os.path.join(base, "core"), os.path.join(base, "csv"))
    assert spark.read.option("header", True).csv(os.path.join(base, "csv", "twitch_games")) \
        .count() == 1


def test_publish_error_becomes_audit_row(spark, tmp_dir):
    from martlet.plans.pipeline import publish
    mart = os.path.join(tmp_dir, "core")
    os.makedirs(mart)
    with open(os.path.join(mart, "hltb_games"), "w") as f:  # a file where a table must go
        f.write("not a table")
    df = spark.createDataFrame([("G", "r1")], "game_name string, dw_id_carga string")
    rows = publish(spark, df, "howlongtobeat", mart, "r1")
    assert [r["status"] for r in rows] == ["ERROR"] and rows[0]["records_count"] == 0
    assert rows[0]["error_message"]


def test_cli_run_and_export(spark, tmp_dir):
    from martlet.__main__ import LANDING_SCHEMAS
    land = os.path.join(tmp_dir, "hltb")
    os.makedirs(land)
    with open(os.path.join(land, "a.json"), "w") as f:
        f.write(json.dumps({"record_type": "hl_tb_time", "game_name": "Halo", "main_story": 9.5,
                            "extraction_time": "2025-06-10T10:00:00"}))
    from martlet.plans.pipeline import Landing, run_pipeline, export_all
    base = os.path.join(tmp_dir, "wh")
    logs = run_pipeline(spark, [Landing("howlongtobeat", land, LANDING_SCHEMAS["howlongtobeat"])],
                        base, run_id="r1")
    assert logs.filter("status = 'ERROR'").count() == 0
    export_all(spark, ["hltb_games"], os.path.join(base, "core"), os.path.join(base, "csv"))
    back = spark.read.option("header", True).csv(os.path.join(base, "csv", "hltb_games")).first()
    assert (back.game_name, back.main_story) == ("Halo", "9.50")


def test_cli_subprocess(tmp_dir):
    import subprocess
    import sys as _sys
    land = os.path.join(tmp_dir, "hltb")
    os.makedirs(land)
    with open(os.path.join(land, "a.json"), "w") as f:
        f.write(json.dumps({"record_type": "hl_tb_time", "game_name": "Doom", "main_story": 12.0,
                            "extraction_time": "2025-06-10T10:00:00"}))
    base, out = os.path.join(tmp_dir, "wh"), os.path.join(tmp_dir, "csv")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=repo)
    run = [_sys.executable, "-m", "martlet", "run", "--base", base,
           "--landing", f"howlongtobeat={land}", "--run-id", "r1"]
    assert subprocess.run(run, env=env, timeout=300, capture_output=True).returncode == 0
    exp = [_sys.executable, "-m", "martlet", "export", "--in", os.path.join(base, "core"),
           "--out", out, "hltb_games"]
    assert subprocess.run(exp, env=env, timeout=300, capture_output=True).returncode == 0
    files = [f for f in os.listdir(os.path.join(out, "hltb_games")) if f.endswith(".csv")]
    text = "".join(open(os.path.join(out, "hltb_games", f)).read() for f in files)
    assert "Doom" in text and "12.00" in text


def test_hours_for_titles(spark):
    from martlet.plans.pipeline import hours_for_titles
    games = spark.createDataFrame([("1", "Zelda"), ("2", "Zelda"), ("3", "Halo 3"),
                                   ("4", "Unknown Game")], "game_id string, game_name string")
    cat = spark.createDataFrame([(10, "zelda", 50.0, None), (11, "Halo3", 8.5, 12.0)],
                                "id long, name string, main_story double, main_extra double")
    rec, miss = hours_for_titles(games, cat, "2025-06-10T10:00:00", n_titles=100)
    got = {r.game_name: (r.main_story, r.main_extra, r.source) for r in rec.collect()}
    assert got == {"Zelda": (50.0, None, "howlongtobeat"), "Halo 3": (8.5, 12.0, "howlongtobeat")}
    assert rec.columns == [f.name for f in HLTB_RAW.fields]
    assert [r.title for r in miss.collect()] == ["Unknown Game"]


def test_pipeline_with_duration_lookup(spark, tmp_dir):
    land_dir = os.path.join(tmp_dir, "landed")
    os.makedirs(land_dir)
    recs = [{"record_type": "game", "game_id": str(i), "game_name": n, "source": "twitch",
             "endpoint": "games/top", "extraction_time": "2025-06-10T10:00:00"}
            for i, n in enumerate(["Zelda", "Halo 3", "Nope Nope"])]
    with open(os.path.join(land_dir, "g.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    from martlet.sources import LANDING_SCHEMAS
    cat = spark.createDataFrame([(1, "zelda", 40.0, 0.0), (2, "halo3", 9.0, 12.5)],
                                "id long, name string, main_story double, main_extra double")
    base = os.path.join(tmp_dir, "wh")
    logs = run_pipeline(spark, [Landing("twitch", land_dir, LANDING_SCHEMAS["twitch"])], base,
                        run_id="r1", durations=cat)
    hl = {r.game_name: (r.main_story, r.main_extra)
          for r in spark.read.parquet(os.path.join(base, "core", "hltb_games")).collect()}
    assert {k: (float(a), b) for k, (a, b) in hl.items()} == {"Zelda": (40.0, None),
                                                             "Halo 3": (9.0, 12.5)}
    look = [r for r in logs.collect() if r.step == "lookup"][0]
    assert look.records_count == 2 and look.error_message == "1 titles without match"


def test_empty_and_malformed_landings(spark, tmp_dir):
    from martlet.sources import LANDING_SCHEMAS, HLTB
    empty = os.path.join(tmp_dir, "empty")
    os.makedirs(empty)
    bad = os.path.join(tmp_dir, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "a.json"), "w") as f:
        f.write('{"record_type": "hl_tb_time", "game_name": "Halo", "main_story": 9.5}\n'
                '{not json at all\n')
    assert read_json(spark, bad, HLTB).count() == 2          # malformed row kept as NULLs
    base = os.path.join(tmp_dir, "wh")
    logs = run_pipeline(spark, [Landing("showdown_pokedex", empty,
                                        LANDING_SCHEMAS["showdown_pokedex"]),
                                Landing("howlongtobeat", bad, LANDING_SCHEMAS["howlongtobeat"])],
                        base, run_id="r1")
    steps = {(r.step, r.source): (r.records_count, r.status) for r in logs.collect()}
    assert steps[("land", "SHOWDOWN_POKEDEX")] == (0, "SUCCESS")
    assert steps[("publish", "SHOWDOWN_POKEDEX")] == (0, "SUCCESS")
    assert steps[("publish", "HOWLONGTOBEAT")] == (1, "SUCCESS")  # NULL-name row filtered


def test_sql_entry_over_warehouse(spark, tmp_dir):
    from martlet.__main__ import register_warehouse
    from martlet.sources import LANDING_SCHEMAS
    land_dir = os.path.join(tmp_dir, "landed")
    os.makedirs(land_dir)
    recs = [{"record_type": "game", "game_id": "1", "game_name": "Zelda",
             "extraction_time": "2025-06-10T10:00:00"},
            {"record_type": "stream", "stream_id": "s1", "game_id": "1", "user_name": "ann",
             "user_id": "u1", "viewer_count": 10, "extraction_time": "2025-06-10T10:00:00"}]
    with open(os.path.join(land_dir, "a.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    base = os.path.join(tmp_dir, "wh")
    run_pipeline(spark, [Landing("twitch", land_dir, LANDING_SCHEMAS["twitch"])], base, "r1")
    register_warehouse(spark, base)
    top = spark.sql("SELECT top_game, top_game_viewers FROM get_twitch_kpis()").first()
    assert tuple(top) == ("Zelda", 10)
    s = spark.sql("SELECT source, total_loads FROM get_load_summary('TWITCH')").collect()
    assert [r.source for r in s] == ["TWITCH"]


def test_parquet_landing(spark, tmp_dir):
    from martlet.sources import LANDING_SCHEMAS, HLTB
    src_dir = os.path.join(tmp_dir, "raw_parquet")
    spark.createDataFrame([("hl_tb_time", "Halo", None, None, 9.5, None, None,
                            "2025-06-10T10:00:00", "howlongtobeat", "hltb_search")],
                          HLTB).write.parquet(src_dir)
    base = os.path.join(tmp_dir, "wh")
    logs = run_pipeline(spark, [Landing("howlongtobeat", src_dir,
                                        LANDING_SCHEMAS["howlongtobeat"], fmt="parquet")],
                        base, run_id="r1")
    assert {(r.step, r.records_count) for r in logs.collect()} >= {("land", 1), ("publish", 1)}


def test_separate_game_and_stream_landings(spark, tmp_dir):
    from martlet.sources import LANDING_SCHEMAS
    g, st = os.path.join(tmp_dir, "g"), os.path.join(tmp_dir, "s")
    os.makedirs(g)
    os.makedirs(st)
    with open(os.path.join(g, "a.json"), "w") as f:
        f.write(json.dumps({"record_type": "game", "game_id": "1", "game_name": "Zelda",
                            "extraction_time": "2025-06-10T10:00:00"}))
    with open(os.path.join(st, "a.json"), "w") as f:
        f.write(json.dumps({"record_type": "stream", "stream_id": "s1", "game_id": "1",
                            "user_name": "ann", "user_id": "u1", "viewer_count": 4,
                            "extraction_time": "2025-06-10T10:00:00"}))
    base = os.path.join(tmp_dir, "wh")
    run_pipeline(spark, [Landing("twitch_games", g, LANDING_SCHEMAS["twitch_games"]),
                         Landing("twitch_streams", st, LANDING_SCHEMAS["twitch_streams"])],
                 base, run_id="r1")
    assert spark.read.parquet(os.path.join(base, "core", "twitch_games")).count() == 1
    assert spark.read.parquet(os.path.join(base, "core", "twitch_streams")).count() == 1


def test_quality_step_in_pipeline(spark, tmp_dir):
    from martlet.sources import LANDING_SCHEMAS
    land = os.path.join(tmp_dir, "h")
    os.makedirs(land)
    with open(os.path.join(land, "a.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in [
            {"record_type": "hl_tb_time", "game_name": "Halo", "main_story": 9.5,
             "extraction_time": "2025-06-10T10:00:00"},
            {"record_type": "hl_tb_time", "game_name": "Doom", "main_story": 4.0,
             "main_extra": 6.0, "extraction_time": "2025-06-10T10:00:00"}]))
    logs = run_pipeline(spark, [Landing("howlongtobeat", land, LANDING_SCHEMAS["howlongtobeat"])],
                        os.path.join(tmp_dir, "wh"), run_id="r1", quality=True)
    q = [r for r in logs.collect() if r.step == "quality"]
    rep = json.loads(q[0].error_message)
    assert len(q) == 1 and q[0].records_count == 0 and rep["total_records"] == 2
    assert rep["duplicate_count"] == 0 and rep["null_percentage"]["main_extra"] == 50.0
    assert rep["validation_passed"] is False and "main_extra" in rep["columns_with_empty"]


# ------------------------------------------------------ nothing lost unseen
def _lines(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))


def _game(game_id, name="Zelda", kind="game"):
    return {"record_type": kind, "game_id": game_id, "game_name": name,
            "extraction_time": "2025-06-10T10:00:00"}


def _twitch(path):
    from martlet.sources import LANDING_SCHEMAS
    return Landing("Twitch", path, LANDING_SCHEMAS["twitch"])


def test_unknown_source_raises_before_anything_runs(spark, tmp_dir):
    from martlet.plans.pipeline import publish
    from martlet.sources import HLTB
    base = os.path.join(tmp_dir, "wh")
    with pytest.raises(ValueError, match="unknown source: 'steam'"):
        run_pipeline(spark, [Landing("steam", tmp_dir, HLTB)], base, run_id="r1")
    assert not os.path.exists(base)
    with pytest.raises(ValueError, match="unknown source"):
        publish(spark, spark.range(1).toDF("x"), "steam", base, "r1")
    with pytest.raises(ValueError, match="run id"):
        run_pipeline(spark, [_twitch(tmp_dir)], base, run_id="../r1")


def test_every_row_is_stored_or_counted(spark, tmp_dir):
    from martlet.plans.pipeline import ROUTES, read_mart, rejected_rows
    land, base = os.path.join(tmp_dir, "l"), os.path.join(tmp_dir, "wh")
    _lines(land, "a.json", [_game("1"), _game(None), _game("2" * 51), _game("3", "N" * 501), _game("c", kind="clip"),
                            {"game_id": "k", "game_name": "no kind"}])
    for _ in range(3):  # NULL keys don't pile up, whatever the number of runs
        logs = run_pipeline(spark, [_twitch(land)], base, run_id="0001")
    games = read_mart(spark, os.path.join(base, "core", "twitch_games"))
    assert [(r.game_id, r.dw_id_carga) for r in games.collect()] == [("1", "0001")]
    bad = rejected_rows(spark, ROUTES["twitch"][0], games.schema, os.path.join(base, "core"))
    assert sorted((r.violated, r.dw_id_carga) for r in bad.collect()) == [
        (["game_id"], "0001"), (["game_id"], "0001"), (["game_name"], "0001")]
    rows = {(r.step, os.path.basename(r.output_file)): r for r in logs.collect()}
    assert rows["land", "twitch"].records_count == 6
    clean = rows["clean", "twitch"]
    assert (clean.records_count, clean.rejected_count) == (4, 2)
    assert json.loads(clean.error_message) == {"rows_before": 6, "rows_after": 4,
                                               "rejected": {"*.record_type": 2}}
    assert rows["publish", "twitch_games"].rejected_count == 3
    assert all(r.created_at is not None for r in rows.values())


def test_relanding_replaces_the_run(spark, tmp_dir):
    base = os.path.join(tmp_dir, "wh")
    stream = {"record_type": "stream", "stream_id": "s", "user_id": "u", "user_name": "ann", "game_id": "1"}
    for i, rows in enumerate([[_game("1"), stream], [_game("1")], []]):
        land = os.path.join(tmp_dir, f"l{i}")
        _lines(land, "a.json", rows)
        run_pipeline(spark, [_twitch(land)], base, run_id="r1")
        run_pipeline(spark, [_twitch(os.path.join(tmp_dir, "l0"))], base, run_id="other")
        from martlet.sources import LANDING_SCHEMAS
        raw = spark.read.schema(LANDING_SCHEMAS["twitch"]).parquet(os.path.join(base, "raw", "twitch", "dw_id_carga=r1"))
        assert raw.count() == len(rows)


def test_title_limit_is_off_by_default_and_told(spark, tmp_dir):
    land = os.path.join(tmp_dir, "l")
    names = [f"title number {chr(97 + i % 26) * 5}{chr(97 + i // 26) * 5}" for i in range(130)]
    _lines(land, "a.json", [_game(str(i), n) for i, n in enumerate(names)])
    cat = spark.createDataFrame([(i, n, 5.0) for i, n in enumerate(names)], "id long, name string, main_story double")
    for limit, found, note in ((None, 130, None), (100, 100, "30 titles beyond the limit of 100")):
        logs = run_pipeline(spark, [_twitch(land)], os.path.join(tmp_dir, f"wh{limit}"), run_id="r1",
                            durations=cat, n_titles=limit)
        look = [r for r in logs.collect() if r.step == "lookup"][0]
        assert (look.records_count, look.error_message) == (found, note)


def test_ladder_records_reach_the_mart(spark, tmp_dir):
    from martlet.sources import LANDING_SCHEMAS
    land, base = os.path.join(tmp_dir, "l"), os.path.join(tmp_dir, "wh")
    _lines(land, "a.json", [
        {"record_type": "ladder", "username": "ann", "format": "ou", "elo": "1500.5", "wins": 7, "games": "x"},
        {"record_type": "profile", "username": "ann", "format": "ou", "games_played": 9, "win_ratio": "0.5"}])
    logs = run_pipeline(spark, [Landing("showdown", land, LANDING_SCHEMAS["showdown"])], base, run_id="r1")
    ladder = spark.read.parquet(os.path.join(base, "core", "showdown_ladder")).first()
    assert (ladder.username, ladder.elo, ladder.wins, ladder.games) == ("ann", 1500.5, 7, None)
    assert spark.read.parquet(os.path.join(base, "core", "showdown_profiles")).first().games_played == 9
    assert [r.rejected_count for r in logs.collect() if r.step == "clean"] == [1]


def test_pages_without_a_number_raise(spark, tmp_dir):
    _lines(os.path.join(tmp_dir, "p"), "page.json", [{"data": [{"id": "a"}]}])
    item = schema_of(("id", S),)
    with pytest.raises(Exception, match="no page number"):
        read_pages(spark, os.path.join(tmp_dir, "p"), item, page_pattern=r"page-(\d+)").collect()


@pytest.mark.parametrize("stored, new", [([], "abn"), ([("a", "r"), (None, "r")], "b"), ([("a", "r"), ("b", "r"), (None, "r")], "")])
def test_rows_not_stored_yet(spark, stored, new):
    df = spark.createDataFrame([("a", "r", 1), ("b", "r", 2), ("b", "r", 3), (None, "r", 4)], "k string, run string, v int")
    existing = spark.createDataFrame(stored, "k string, run string")
    got = _not_stored(df, existing, ["k", "run"])
    assert sorted((r.k or "n") for r in got.collect()) == sorted(c for c in "abbn" if c in new)
    if not stored:  # nothing to compare with: no join, no shuffle
        assert "Join" not in got._jdf.queryExecution().toString()


def test_landing_is_stored_packed_and_in_bounded_files(spark, tmp_dir):
    for name, rows, ddl in (("part", [(i, f"n{i}", "Brand#1") for i in range(60)], "p_partkey long, p_name string, p_brand string"),):
        spark.createDataFrame(rows, ddl).write.parquet(os.path.join(tmp_dir, f"{name}.parquet"))
    spark.createDataFrame([(1, 1, 1, 1, 2.0, "F", "N", None)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, "
                          "l_quantity double, l_linestatus string, l_returnflag string, l_shipdate timestamp"
                          ).write.parquet(os.path.join(tmp_dir, "lineitem.parquet"))
    base, _ = job_run(spark, tmp_dir, base=os.path.join(tmp_dir, "job"))
    files = [f for d in os.listdir(base) if d.startswith("landed-") for f in os.listdir(os.path.join(base, d)) if f.startswith("part-")]
    assert files and all(f.endswith(".json.lz4") for f in files)
    assert spark.read.parquet(os.path.join(base, "core", "twitch_games")).count() == 60
