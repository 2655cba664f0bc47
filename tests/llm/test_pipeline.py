"""The pipeline, stage by stage, against brute force on what each stage was given."""

import os

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from martlet.llm.queries import vocabulary
from martlet.llm.tokens import Encoder
from test_native import key, slow_base, slow_contamination, slow_kept
from test_simhash import slow_components, slow_print
from test_tokens import check_packing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def folder(spark, path, documents, benchmark):
    documents.write.parquet(os.path.join(path, "documents.parquet"))
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(os.path.join(path, "benchmark.parquet"))
    return path


def odd_documents():
    prose = [" ".join(f"w{i}x{j}" for j in range(80)) for i in range(12)]
    near = prose[0].replace("w0x79", "other")
    item = " ".join(f"q{j}" for j in range(20))
    rows = [(i, t) for i, t in enumerate(prose)] + [
        (20, prose[0]), (21, near), (21, near), (22, prose[1].upper()), (30, None), (31, ""), (32, "short"),
        (33, "UP " * 90), (34, "$ # " * 90), (35, prose[3] + " " + item), (36, "a b " * 60_000),
        (37, prose[4] + " password=hunter2hunter2 " + "0123456789abcdef" * 3), (None, " ".join(f"n{j}" for j in range(70))),
        (None, " ".join(f"m{j}" for j in range(70)) + " " + item),
        (None, prose[5]), (38, " ".join(f"long{j}" for j in range(9000)))]
    return [(d, t, "en", None if i % 3 else "s", len(t or ""), "x") for i, (d, t) in enumerate(rows)], [(1, item), (2, None)]


def run_stages(spark, docs, sf_dir):
    """Rows after each stage, each written and read again."""
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        got = stage(spark, out[-1], sf_dir)
        path = os.path.join(sf_dir, f"stage{i}")
        got.write.parquet(path)
        out.append(spark.read.schema(got.schema).parquet(path))
    return out


def check_stages(spark, sf_dir, benchmark):
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    tables = run_stages(spark, docs, sf_dir)
    for t in tables[:-1]:
        assert t.dtypes == docs.dtypes
    rows = [t.collect() for t in tables]
    assert key(rows[1]) == key(r for r in rows[0] if slow_kept(r.text))

    found = slow_components([(r.doc_id, slow_print(r.text)) for r in rows[1]], 4)
    want = {}
    for r, (doc_id, fingerprint, component) in zip(rows[1], found):
        if doc_id == component:
            want.setdefault((doc_id, fingerprint if doc_id is None else None), set()).add(tuple(r))
    left = [tuple(r) for r in rows[2]]
    assert len(left) == len(want) and all(len(x.intersection(left)) == 1 for x in want.values())

    bad = [r[5] for r in slow_contamination([r[:2] for r in rows[2]], benchmark)]
    assert key(rows[3]) == key(r for r, b in zip(rows[2], bad) if not b)

    before = {(r.doc_id, r.n_chars): r for r in rows[3]}
    assert len(rows[4]) == len(rows[3])
    for r in rows[4]:
        if "[SECRET]" not in (r.text or ""):
            assert before[r.doc_id, r.n_chars].text == r.text and not slow_base(r.text)
        assert not slow_base(r.text) and r.n_chars == len(r.text or "")
    check_packing([r[:2] for r in rows[4]], rows[5], Encoder(vocabulary()), 1024, 2)
    return rows


def test_stages_over_documents(spark, tmp_dir):
    sf = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    benchmark = [tuple(r) for r in items.collect()]
    rows = check_stages(spark, folder(spark, tmp_dir, docs, benchmark), benchmark)
    sizes = [len({r.doc_id for r in x}) for x in rows]
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4] == sizes[5]
    assert key(corpus_pipeline.run(spark, tmp_dir).select("doc_id", "piece", "ids_crc32").collect()) == key(
        (r.doc_id, r.piece, r.ids_crc32) for r in rows[5])


def test_stages_over_odd_rows(spark, tmp_dir):
    documents, benchmark = odd_documents()
    rows = check_stages(spark, folder(spark, tmp_dir, spark.createDataFrame(documents, SCHEMA), benchmark), benchmark)
    kept = {r.doc_id for r in rows[4]}
    assert {0, 1, 2, 37, 38} <= kept and not {20, 21, 22, 30, 31, 32, 33, 34, 35, 36} & kept
    assert any("password" not in r.text and "[SECRET]" in r.text for r in rows[4] if r.doc_id == 37)


@pytest.mark.parametrize("benchmark", [[], [(1, "one item of words")]])
def test_empty_tables(spark, tmp_dir, benchmark):
    path = folder(spark, tmp_dir, spark.createDataFrame([], SCHEMA), benchmark)
    assert corpus_pipeline.run(spark, path).count() == 0


def test_stages_are_those_of_the_contract():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "SimHash near-dedup", "benchmark decontamination", "secret scans", "best-fit packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_components_with_one_smallest_id(spark, tmp_dir):
    a, b = (" ".join(f"{x}{j}" for j in range(80)) for x in "ab")
    rows = [(1, a), (1, b), (1, b), (2, a), (3, b)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t), "x") for d, t in rows], SCHEMA)
    left = corpus_pipeline.simhash_near_dedup(spark, docs, tmp_dir).collect()
    assert sorted((r.doc_id, r.text) for r in left) == [(1, a), (1, b)]


def test_rows_of_one_id_and_text_leave_the_same_one_in_any_order(spark):
    text = " ".join(f"w{j}" for j in range(80))
    rows = [(1, text, "en", s, 5, x) for s in ("b", "a", None) for x in ("z", "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    left = {tuple(r) for o in (["source"], ["extra", "source"], [F.desc("source")])
            for r in corpus_pipeline.simhash_near_dedup(spark, df.orderBy(*o), "").collect()}
    assert left == {(1, text, "en", None, 5, "y")}
