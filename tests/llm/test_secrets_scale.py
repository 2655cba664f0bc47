"""Secret scans of texts with very many matches: the same spans, in linear time."""

import random
import time

from pyspark.sql import functions as F

from martlet.llm import secrets


def test_running_equals_a_loop(spark):
    rng = random.Random(4)
    rows = [([rng.randrange(100) for _ in range(n)],) for n in (0, 1, 2, 255, 256, 257, 512, 513, 2000)]
    df = spark.createDataFrame(rows, "v array<int>")
    got = df.select("v", secrets.running(F.col("v"), F.lit(0), "int", lambda a, x: a + x).alias("s"),
                    secrets.running(F.col("v"), F.lit(0), "int", secrets.larger).alias("m")).collect()
    for r in got:
        assert r.s == [sum(r.v[:k]) for k in range(len(r.v) + 1)]
        assert r.m == [max([0, *r.v[:k]]) for k in range(len(r.v) + 1)]


def test_redaction_equals_a_loop(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(60):
        n = rng.choice((0, 5, 1024, 1025, 5000))
        text = "".join(rng.choices("ab é\U0001F600\n", k=n))
        cuts = sorted((a, min(n, a + rng.randrange(1, 40))) for a in (rng.randrange(n) for _ in range(rng.randrange(30)))) if n else []
        rows.append((text, [(a, 0, "k", b) for a, b in cuts]))
    df = spark.createDataFrame(rows, f"text string, s {secrets.SPAN}")
    for r in df.select("text", "s", secrets.redacted(F.col("text"), F.col("s"), "#").alias("out")).collect():
        want, at = "", 0
        for i, p in enumerate(r.s):
            if i == 0 or p.start > at:
                want += r.text[at:p.start] + "#"
            at = max(at, p.end)
        assert r.out == want + r.text[at:]


def test_time_grows_with_the_matches(spark):
    def text(m):
        return " ".join(f"token={i:016d}x{i:08d}" for i in range(m))

    def took(m):
        df = spark.createDataFrame([(1, text(m))], "doc_id long, text string")
        t = time.time()
        r = df.select("text", secrets.spans(F.col("text"), {}).alias("s")).select(
            F.size("s").alias("n"), F.length(secrets.redacted(F.col("text"), F.col("s"))).alias("l")).first()
        assert (r.n, r.l) == (m, m * len("[SECRET]") + m - 1)
        return time.time() - t

    took(100)
    small, large = took(4000), took(64_000)
    assert large < 15 * max(small, 1.0), (small, large)
