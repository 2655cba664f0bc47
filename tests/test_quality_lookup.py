import random

from hypothesis import given, settings, strategies as st

from martlet.operators import (
    constraint_summary, deletion_variants, duplicate_count, first_match_lookup,
    fk_violations, max_length_violations, not_null_violations, null_blank_share,
    quality_report, unique_violations, unmatched_titles, enrich_children,
)


def test_quality_report_one_pass(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "", None), (2, None, 7), (None, "b", 1)],
                               "id int, name string, n int")
    r = quality_report(df, "src", keys=["id"]).first()
    assert (r.total_records, r.duplicate_count) == (4, 1)
    assert r.null_percentage == {"id": 25.0, "name": 50.0, "n": 25.0}
    assert sorted(r.columns_with_empty) == ["id", "n", "name"] and r.validation_passed is False
    nk = quality_report(df, "src").first()
    assert nk.duplicate_count is None
    share = {x.column_name: (x.null_count, x.null_pct) for x in null_blank_share(df).collect()}
    assert share == {"id": (1, 25.0), "name": (2, 50.0), "n": (1, 25.0)}
    assert duplicate_count(df, ["id"]).first()[0] == 1
    dotted = spark.createDataFrame([(1, None)], "`a.b` int, `c d` string")
    assert {r.column_name: r.null_count for r in null_blank_share(dotted).collect()} == {
        "a.b": 0, "c d": 1}
    assert not_null_violations(dotted, ["c d"]).count() == 1
    assert duplicate_count(dotted, ["a.b"]).first()[0] == 0
    empty = spark.createDataFrame([], "id int, name string")
    e = quality_report(empty, "e", keys=["id"]).first()
    assert e.total_records == 0 and e.null_percentage == {"id": None, "name": None}


def test_constraints(spark):
    # duplicate key with NULL run id never conflicts; same run id does
    df = spark.createDataFrame([("g1", None), ("g1", None), ("g2", "r1"), ("g2", "r1"),
                                ("g3", "r9")], "game_id string, run string")
    u = unique_violations(df, ["game_id", "run"]).collect()
    assert [(r.game_id, r.run, r.occurrences) for r in u] == [("g2", "r1", 2)]
    logs = spark.createDataFrame([("r1",)], "id string")
    orphans = fk_violations(df, ["run"], logs, ["id"]).collect()  # C3: r9 orphan, NULL ignored
    assert [r.run for r in orphans] == ["r9"]
    nn = not_null_violations(df, ["run"]).count()
    assert nn == 2
    ml = max_length_violations(df, {"game_id": 1}).count()
    assert ml == 5
    s = {(r.check_name, r.column_name): r.violations for r in constraint_summary(
        df, not_null=["run"], max_length={"game_id": 2}, unique=["game_id", "run"]).collect()}
    assert s == {("not_null", "run"): 2, ("max_length", "game_id"): 0,
                 ("unique", "game_id,run"): 1}


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def _brute(titles, cat, d=2):
    out = {}
    for t in titles:
        k = " ".join(t.split()).lower()
        best = min(((_lev(k, " ".join(n.split()).lower()), i, n) for i, n in cat), default=None)
        if best and best[0] <= d:
            out[t] = (best[1], best[0])
    return out


def test_lookup_matches_brute_force(spark):
    rnd = random.Random(7)
    words = ["zelda", "mario", "kart", "halo", "doom", "portal", "tetris"]
    cat = [(i, " ".join(rnd.sample(words, 2))) for i in range(60)]
    titles = set()
    for _, n in cat[:30]:
        titles |= {n.upper(), "  " + n, n[:-1], n.replace(" ", ""), n + " deluxe", n[1:] + "x"}
    cdf = spark.createDataFrame(cat, "id int, name string")
    tdf = spark.createDataFrame([(t,) for t in titles], "title string")
    got = {r.title: (r.match_id, r.distance) for r in first_match_lookup(tdf, cdf).collect()}
    assert got == _brute(titles, cat)
    seg = {r.title: (r.match_id, r.distance)
           for r in first_match_lookup(tdf, cdf, blocking="segments").collect()}
    assert seg == got
    un = {r.title for r in unmatched_titles(tdf, first_match_lookup(tdf, cdf)).collect()}
    assert un == titles - set(got)


@settings(max_examples=15, deadline=None)
@given(st.text(alphabet="abc ", min_size=0, max_size=6), st.text(alphabet="abc ", max_size=6))
def test_deletion_neighbourhood_complete(spark, a, b):
    # any pair within distance 2 shares a deletion variant (exactness of the blocking)
    r = spark.createDataFrame([(a, b)], "a string, b string").select(
        deletion_variants("a", 2).alias("va"), deletion_variants("b", 2).alias("vb")).first()
    if _lev(a, b) <= 2:
        assert set(r.va) & set(r.vb)


def test_enrich_children_fallback_and_cap(spark):
    parents = spark.createDataFrame([("g1", "Zelda")], "game_id string, game_name string")
    kids = spark.createDataFrame([("s1", "g1", None, 5), ("s2", "g1", "Z!", 9),
                                  ("s3", "g1", None, 7), ("s4", "gX", "?", 1)],
                                 "stream_id string, game_id string, game_name string, v int")
    r = enrich_children(parents, kids, "game_id", "game_name", per_key_limit=2,
                        order=[("v", "desc"), "stream_id"]).collect()
    assert sorted((x.stream_id, x.game_name) for x in r) == [("s2", "Z!"), ("s3", "Zelda")]


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="ab c", min_size=0, max_size=7), st.text(alphabet="ab c", max_size=7))
def test_segment_filter_complete(spark, a, b):
    # a catalogue name b within distance 2 of title a shares a probe key
    from martlet.operators.lookup import segment_keys, segment_probes
    r = spark.createDataFrame([(a, b)], "a string, b string").select(
        segment_probes("a", 2).alias("p"), segment_keys("b", 2).alias("k")).first()
    if _lev(a, b) <= 2:
        assert {tuple(x)[:3] for x in r.p} & {tuple(x)[:3] for x in r.k}


def test_percent_ties_round_to_even(spark):
    # 1 NULL in 800 rows is exactly 0.125 %: Python's round gives 0.12
    from pyspark.sql import functions as F
    df = spark.range(800).select(F.when(F.col("id") == 0, F.lit(None)).otherwise(
        F.col("id")).alias("v"))
    assert null_blank_share(df).first().null_pct == 0.12


def test_segment_filter_complete_on_random_edits(spark):
    # 4,000 random strings, each with 0-2 random edits: every pair must share
    # a probe/segment key; checked in one Spark job
    from pyspark.sql import functions as F
    from martlet.operators.lookup import segment_keys, segment_probes
    rnd = random.Random(3)
    pairs = []
    for _ in range(4000):
        a = "".join(rnd.choice("abcde ") for _ in range(rnd.randint(0, 20)))
        b = list(a)
        for _ in range(rnd.randint(0, 2)):
            op, pos = rnd.choice("isd"), rnd.randint(0, len(b))
            if op == "i":
                b.insert(pos, rnd.choice("abcde "))
            elif b and op == "s":
                b[min(pos, len(b) - 1)] = rnd.choice("abcde ")
            elif b:
                del b[min(pos, len(b) - 1)]
        pairs.append((a, "".join(b)))
    rows = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", segment_probes("a", 2).alias("p"), segment_keys("b", 2).alias("k"),
        F.size(segment_probes("a", 2)).alias("n")).collect()
    assert max(r.n for r in rows) <= 19
    missed = [(r.a, r.b) for r in rows
              if _lev(r.a, r.b) <= 2 and not ({tuple(x)[:3] for x in r.p} & {tuple(x)[:3] for x in r.k})]
    assert missed == []
