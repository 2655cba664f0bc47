"""Listings by cursor, the step log, large objects, inference, quantiles, large k, one-file exports."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from martlet.functions import canonical, nested_fingerprint
from martlet.operators import end_candidates, exact_quantiles, gram_candidates, keep_first, similar_titles, top_k_per_key
from martlet.operators.dedup import large_top_k_per_key
from martlet.operators.lookup import segment_candidates
from martlet.plans.landing_catalogue import q_dedup_map_ties
from martlet.plans.pipeline import Landing, _read, hours_for_titles, run_pipeline
from martlet.plans.steplog import StepLog
from martlet.sinks import export_csv_file
from martlet.sources import (
    LANDING_SCHEMAS, before_the_end, flatten_keyed_objects, inferred_schema, rank_links, read_cursor_pages,
    read_keyed_objects, read_pages, schema_report,
)
from martlet.sources import keyed
from martlet.sources.schemas import schema_of, S

ITEM = schema_of(("id", S),)


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(json.dumps(x) for x in lines))


# listings

def test_rank_links_of_paths_circles_and_strays(spark):
    links = [("a", "", "x"), ("a", "x", "y"), ("a", "y", "x"), ("a", "lost", "y"), ("b", "", None), ("b", "z", ""),
             ("c", "q", "r")] + [("d", str(i) if i else "", str(i + 1)) for i in range(40)]
    df = spark.createDataFrame(links, "k string, node string, next string")
    got = {(r.k, r.node): r["rank"] for r in rank_links(df, ["k"]).collect()}
    want = {("a", ""): 0, ("a", "x"): 1, ("a", "y"): 2, ("b", ""): 0}
    want |= {("d", str(i) if i else ""): i for i in range(40)}
    assert got == want
    assert rank_links(df.filter("false"), ["k"]).count() == 0


def test_cursor_pages(spark, tmp_dir):
    def page(after, ids, cursor):
        return {"after": after, "data": [{"id": i} for i in ids], "pagination": {"cursor": cursor}}
    write(tmp_dir, "1.json", [page("b", ["5"], "c"), page("", ["1", "2"], "a"), page("c", [], "d"), page("d", ["9"], None)])
    write(tmp_dir, "2.json", [page("a", [], "b"), page("a", ["3", "4"], "b"), page("stray", ["0"], "a")])
    got = read_cursor_pages(spark, tmp_dir, ITEM, multi_line=False)
    assert [(r.id, r._page, r._pos) for r in got.orderBy("_page", "_pos").collect()] == [
        ("1", 0, 0), ("2", 0, 1), ("3", 1, 0), ("4", 1, 1), ("5", 2, 0)]
    assert [r.id for r in read_cursor_pages(spark, tmp_dir, ITEM, limit=3, multi_line=False).collect()] == ["1", "2", "3"]


def test_numbered_pages_stop_at_a_gap(spark, tmp_dir):
    for name, pages in (("empty", {3: ["a"], 4: [], 5: ["b"]}), ("missing", {0: ["a"], 2: ["b"]}), ("whole", {7: ["a"], 8: ["b"]})):
        folder = os.path.join(tmp_dir, name)
        write(folder, "p.json", [{"n": k, "data": [{"id": i} for i in ids]} for k, ids in pages.items()])
        got = sorted(r.id for r in read_pages(spark, folder, ITEM, multi_line=False, page_col="n").collect())
        assert got == (["a", "b"] if name == "whole" else ["a"]), name


def test_end_per_key(spark):
    df = spark.createDataFrame([("x", 0, ["i"]), ("x", 1, None), ("x", 2, ["i"]), ("y", 5, ["i"]), ("y", 6, ["i"])],
                               "k string, n bigint, data array<string>")
    assert sorted((r.k, r.n) for r in before_the_end(df, ["k"], "n").collect()) == [("x", 0), ("y", 5), ("y", 6)]


# the step log

def games(tmp_dir):
    write(os.path.join(tmp_dir, "in"), "g.json", [{"record_type": "game", "game_id": "1", "game_name": "g"}])
    return Landing("twitch_games", os.path.join(tmp_dir, "in"), LANDING_SCHEMAS["twitch_games"])


def test_failing_source_leaves_its_row_and_the_finished_ones(spark, tmp_dir):
    base = os.path.join(tmp_dir, "base")
    bad = Landing("howlongtobeat", "nowhere", LANDING_SCHEMAS["howlongtobeat"], fmt="odd")
    with pytest.raises(ValueError, match="odd"):
        run_pipeline(spark, [games(tmp_dir), bad], base, "r1")
    rows = spark.read.parquet(f"{base}/etl_logs").orderBy("load_start_time").collect()
    assert [(r.step, r.status) for r in rows] == [
        ("land", "SUCCESS"), ("clean", "SUCCESS"), ("publish", "SUCCESS"), ("land", "ERROR")]
    assert "odd" in rows[-1].error_message and all(r.duration_seconds >= 0 for r in rows)


def test_lost_steps_are_settled_once(spark, tmp_dir):
    log = StepLog(spark, f"{tmp_dir}/logs", "r1", _read)
    log.settle()
    log.run("land", "a", "e", lambda: [])
    log.open("clean", "a", "e")
    for _ in range(2):
        StepLog(spark, f"{tmp_dir}/logs", "r2", _read).settle()
    rows = spark.read.parquet(f"{tmp_dir}/logs").orderBy("step").collect()
    assert [(r.run_id, r.step, r.status, r.records_count) for r in rows] == [
        ("r1", "clean", "ERROR", 0), ("r1", "land", "SUCCESS", 0)]
    assert "interrupted" in rows[0].error_message


def test_a_failing_step_is_logged_and_raised(spark, tmp_dir):
    log = StepLog(spark, f"{tmp_dir}/logs", "r1", _read)

    def work():
        raise RuntimeError("no disk")
    with pytest.raises(RuntimeError):
        log.run("land", "a", "e", work)
    assert [(r.status, r.error_message) for r in log.frame().collect()] == [("ERROR", "no disk")]


# pairs by the ends of names

def _within(a, b, d):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1] <= d


def _edited(rng, s, k):
    for _ in range(k):
        i, c = rng.randrange(len(s) + 1), rng.choice(["", "a", "é", "bb"])
        s = s[:i] + c + s[i + rng.randrange(2):]
    return s


@pytest.mark.parametrize("d, block", [(1, 1000), (2, 20), (2, 1000), (3, 60)])
def test_end_candidates_hold_all_pairs_within_the_distance(spark, d, block):
    rng = random.Random(d + block)
    part = lambda n, of="abé😀": "".join(rng.choices(of, k=n))
    names = [part(rng.choice([0, 1, 7, 8, 9, 15, 16, 17, 25])) for _ in range(80)]
    names += ["the series " + part(5) for _ in range(30)] + [part(5) + " the series" for _ in range(30)]
    names += ["a long one " + part(2) + " the series of it" for _ in range(30)]  # common at both ends
    names = sorted(set(names))
    titles = sorted({_edited(rng, s, rng.randrange(d + 2)) for s in names})
    got = [tuple(r) for r in end_candidates(
        spark.createDataFrame(list(enumerate(titles)), "tid long, s string"),
        spark.createDataFrame(list(enumerate(names)), "nid long, s string"), d, block).collect()]
    want = {(i, j) for i, a in enumerate(titles) for j, b in enumerate(names) if _within(a, b, d)}
    assert len(got) == len(set(got)) and want <= set(got)


def test_names_with_a_short_part_of_their_own_meet_few_titles(spark):
    rng = random.Random(5)
    names = [f"the {rng.choice(['red', 'hot'])} ring {rng.randrange(16 ** 8):08x}" for _ in range(3000)]
    t = spark.createDataFrame([(f"{s[:-1]}", s[:-1]) for s in names], "title string, _k string")
    c = spark.createDataFrame([(s, i, s) for i, s in enumerate(names)], "_ck string, match_id long, match_name string")
    pairs = {tuple(r) for r in segment_candidates(t, c, 2, block=3).select("title", "match_id").collect()}
    assert {(s[:-1], i) for i, s in enumerate(names)} <= pairs and len(pairs) < 4 * len(names)


# one large object

def odd_value(rng):
    texts = ['a, "b" } {', "\\", '\\"', "],[", "é\n", "", '"']
    return {"label": rng.choice([*texts, None]), "n": rng.randrange(9), "tags": rng.choices(texts, k=rng.randrange(4))}


@pytest.mark.parametrize("indent", [None, 1])
def test_large_object_equals_flatten_and_is_read_by_many_tasks(spark, tmp_dir, indent):
    rng = random.Random(2)
    rows = {f'key "{i}", {{': odd_value(rng) for i in range(900)}
    path = os.path.join(tmp_dir, "one.json")
    with open(path, "w") as f:
        json.dump(rows, f, indent=indent)
    ddl = "label string, n int, tags array<string>"
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    try:
        for n in names:
            spark.conf.set(n, "4k")
        parts = read_keyed_objects(spark, path, ddl)
        got = sorted(map(repr, parts.collect()))
        lines = spark.read.option("lineSep", ",").text(path)
        assert lines.rdd.getNumPartitions() > 5
    finally:
        for n in names:
            spark.conf.unset(n)
    whole = spark.createDataFrame([(json.dumps(rows),)], "j string")
    assert got == sorted(map(repr, flatten_keyed_objects(whole, "j", ddl).collect())) and len(got) == 900


@pytest.mark.parametrize("block", [1, 4])
def test_large_object_in_blocks_smaller_than_a_byte_range(spark, tmp_dir, monkeypatch, block):
    rng = random.Random(3)
    rows = {f"k{i}": odd_value(rng) for i in range(60)}
    path = os.path.join(tmp_dir, "one.json")
    with open(path, "w") as f:
        json.dump(rows, f)
    monkeypatch.setattr(keyed, "BLOCK", block)
    ddl = "label string, n int, tags array<string>"
    whole = spark.createDataFrame([(json.dumps(rows),)], "j string")
    assert (sorted(map(repr, read_keyed_objects(spark, path, ddl).collect()))
            == sorted(map(repr, flatten_keyed_objects(whole, "j", ddl).collect())))


@pytest.mark.parametrize("text, want", [("{}", []), ("  { }\n", []), ('{"a": {"n": 1}}', [("a", 1)]),
                                        ('{"a": 5, "b": {"n": 2}}', [("a", None), ("b", 2)]), ("", [])])
def test_small_objects(spark, tmp_dir, text, want):
    path = os.path.join(tmp_dir, "o.json")
    with open(path, "w") as f:
        f.write(text)
    assert sorted((r.key, r.n) for r in read_keyed_objects(spark, path, "n int").collect()) == want


# inference

def test_report_and_schema_of_mixed_records(spark):
    rows = ['{"a": 1, "b": [1, 2.5], "c": {"d": null, "x.y": true}}', '{"a": 99999999999.25, "b": [], "c": {"d": "t"}}',
            '{"a": 1e3, "e": [{"f": 1}, {"f": "s"}]}', "{bad", None, '{"c": "text", "`q": 0}']
    report = schema_report(spark.createDataFrame([(r,) for r in rows], "json string"))
    got = {r.path: (r.type, r.n_records, r.n_null, r.conflict) for r in report.collect()}
    assert got == {"": ("object", 6, 2, False), "a": ("double", 3, 0, False), "b": ("list", 2, 0, False),
                   "b.[]": ("decimal", 2, 1, False), "c": ("text", 3, 0, True), "c.d": ("text", 2, 1, False),
                   "c.`x.y`": ("boolean", 1, 0, False), "e": ("list", 1, 0, False), "e.[]": ("object", 1, 0, False),
                   "e.[].f": ("text", 1, 0, True), "`q": ("whole", 1, 0, False)}
    schema = inferred_schema(report)
    assert schema["c"].dataType.simpleString() == "string"
    assert schema["e"].dataType.simpleString() == "array<struct<f:string>>"
    with pytest.raises(ValueError, match="not objects"):
        inferred_schema(schema_report(spark.createDataFrame([("[1]",)], "json string")))
    assert schema_report(spark.createDataFrame([], "json string")).count() == 0


# quantiles

@pytest.mark.parametrize("kind", ["int", "bigint", "double", "decimal(6,2)", "decimal(30,10)"])
@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 1.0])
def test_quantiles_equal_percentile_disc(spark, kind, p):
    rng = random.Random(7)
    rows = [(g, rng.choice([None, rng.uniform(-999, 999), float(rng.randrange(5))])) for g in "abcd" for _ in range(300)]
    rows += [("e", None), (None, 3.0), ("f", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").select("g", F.col("v").cast(kind).alias("v"))
    want = {r.g: r.q for r in df.groupBy("g").agg(F.expr(
        f"percentile_disc({p}) within group (order by v)").cast(kind).alias("q")).collect()}
    assert exact_quantiles(df, "g", "v", p, buckets=4) == want


def test_quantiles_of_extreme_values(spark):
    inf = float("inf")
    rows = [("a", x) for x in (-inf, -1e308, -5e-324, 0.0, 5e-324, 1e308, inf)] + [("b", float("nan")), ("b", 1.0), ("b", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    assert exact_quantiles(df, "g", "v", 0.5) == {"a": 0.0, "b": 2.0}
    big = spark.createDataFrame([(1, -2**63), (1, 2**63 - 1), (1, 2**63 - 2)], "g int, v bigint")
    assert exact_quantiles(big, "g", "v", 0.5, buckets=8) == {1: 2**63 - 2}


# large k, ties

def test_large_k_in_two_stages(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
                                    F.xxhash64("id").alias("v"), "id").repartition(16)
    want = {(r.k, r.id) for r in top_k_per_key(df, ["k"], [("v", "desc"), "id"], 900).collect()}
    got = large_top_k_per_key(df, ["k"], [("v", "desc"), "id"], 900, parts=4)
    assert {(r.k, r.id) for r in got.collect()} == want
    plan = top_k_per_key(df, ["k"], [("v", "desc"), "id"], 5000)._jdf.queryExecution().executedPlan().toString()
    assert "_part" in plan
    # a sub-key of the hot key is a bounded part of it
    parts = df.filter("k = 0").groupBy(F.spark_partition_id() % 4).count().collect()
    assert len(parts) == 4 and max(r["count"] for r in parts) < 0.5 * df.filter("k = 0").count()


def test_map_ties_under_any_partitioning(spark):
    rows = [(i % 5, {"b": i % 7, "a": [{"z": i % 3, "y": 1}]}) for i in range(200)]
    schema = "k int, m map<string,string>"
    df = spark.createDataFrame([(k, {x: json.dumps(y) for x, y in m.items()}) for k, m in rows], schema)
    order = [canonical(F.col("m"), df.schema["m"].dataType)]
    seen = {tuple(sorted((r.k, tuple(sorted(r.m.items()))) for r in keep_first(x, ["k"], order).collect()))
            for x in (df, df.repartition(7), df.orderBy(F.rand(3)), df.coalesce(1))}
    assert len(seen) == 1


def test_fingerprint_ignores_entry_order_only(spark):
    df = spark.sql("""select map('a', map('x', 1, 'y', 2), 'b', map('z', 3)) as m, array(1, 2) as l
        union all select map('b', map('z', 3), 'a', map('y', 2, 'x', 1)), array(1, 2)
        union all select map('b', map('z', 3), 'a', map('y', 2, 'x', 1)), array(2, 1)
        union all select null, array(2, 1)""")
    prints = [r[0] for r in df.select(nested_fingerprint({f.name: f.dataType for f in df.schema.fields})).collect()]
    assert prints[0] == prints[1] and len(set(prints)) == 3


# candidates

def test_gram_candidates_hold_all_pairs_within_the_distance(spark):
    rng = random.Random(11)
    base = ["the same long beginning of every name here " + "".join(rng.choices("abcdef", k=rng.randrange(2, 16))) for _ in range(60)]
    base += ["".join(rng.choices("ab", k=rng.randrange(0, 20))) for _ in range(60)]

    def edited(s):
        for _ in range(rng.randrange(3)):
            p = rng.randrange(len(s) + 1)
            s = s[:p] + rng.choice(["", "x", "a"]) + s[p + rng.randrange(2):]
        return s
    titles = spark.createDataFrame([(i, edited(s)) for i, s in enumerate(base)], "tid bigint, s string")
    names = spark.createDataFrame(list(enumerate(base)), "nid bigint, s string")
    want = {(r.tid, r.nid) for r in titles.crossJoin(names.withColumnRenamed("s", "n"))
            .filter(F.levenshtein("s", "n") <= 2).collect()}
    for block in (1, 20, 10_000):
        got = [(r.tid, r.nid) for r in gram_candidates(titles, names, 2, block).collect()]
        assert want <= set(got) and len(got) == len(set(got))


def test_similar_titles(spark):
    names = spark.createDataFrame([(1, "Zelda Ocarina of Time"), (2, "Zelda Majora"), (3, "The Game"), (4, None), (5, "zelda  majora")],
                                  "id int, name string")
    titles = spark.createDataFrame([("Zelda: Ocarina of Time Remastered",), ("majora zelda",), ("--",), (None,), ("Unknown",)], "title string")
    got = {r.title: (r.match_id, r.similarity) for r in similar_titles(titles, names).collect()}
    assert set(got) == {"Zelda: Ocarina of Time Remastered", "majora zelda"}
    assert got["majora zelda"] == (2, 1.0) and got["Zelda: Ocarina of Time Remastered"][0] == 1


def test_durations_of_similar_titles(spark):
    names = spark.createDataFrame([(1, "Zelda Ocarina of Time", 30.0), (2, "Tetris", 1.0)], "id int, name string, main_story double")
    games = spark.createDataFrame([("Zelda Ocarina of Time Remastered",), ("Tetriss",), ("Unknown",)], "game_name string")
    for similar, want in ((None, {"Tetriss": 1.0}), ((3, 5), {"Tetriss": 1.0, "Zelda Ocarina of Time Remastered": 30.0})):
        found, rest = hours_for_titles(games, names, "2025-06-10T10:00:00", similar=similar)
        assert {r.game_name: r.main_story for r in found.collect()} == want
        assert {r.title for r in rest.collect()} == {r.game_name for r in games.collect()} - set(want)


# one CSV file

def test_one_csv_file_of_many_parts(spark, tmp_dir):
    df = spark.range(1000).select("id", F.concat(F.lit('q"é, '), "id").alias("text"), F.array("id").alias("a"))
    path = os.path.join(tmp_dir, "x", "one.csv")
    n = export_csv_file(df.repartition(7), path)
    assert os.path.getsize(path) == n
    with open(path, encoding="utf-8") as f:
        lines = f.read().split("\n")
    assert lines[0] == "id,text,a" and len(lines) == 1002 and lines[-1] == ""
    back = spark.read.option("header", True).csv(path)
    assert {(r.id, r.text, r.a) for r in back.collect()} == {(str(i), f'q"é, {i}', f"[{i}]") for i in range(1000)}
    export_csv_file(df.limit(0), path)
    with open(path) as f:
        assert f.read() == "id,text,a\n"


def test_other_file_systems_raise(spark):
    from martlet.sinks import join_parts
    with pytest.raises(Exception, match="neither|ViewFs"):
        join_parts(spark, [], "viewfs://nowhere/x.csv")


def test_map_ties_are_dealt_over_as_many_tasks_as_the_rows_need(spark, tmp_dir):
    rows = [(i, i % 3, "FOP"[i % 3], f"{i % 5}-P") for i in range(90)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(
        os.path.join(tmp_dir, "orders.parquet"))
    got = q_dedup_map_ties(spark, tmp_dir)
    assert "REPARTITION_BY_NUM" not in got._jdf.queryExecution().toString()
    want = {c: min((f"{p}={k % 5}") for k, c_, _, p in rows if c_ == c) for c in range(3)}
    assert {r.o_custkey: r.entries for r in got.collect()} == want
