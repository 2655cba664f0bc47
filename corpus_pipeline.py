"""Corpus pipeline: quality rules, near-duplicates, benchmark decontamination,
secrets and packing, each stage written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martlet.functions import canonical
from martlet.llm import decontam, packing, quality, secrets, simhash
from martlet.llm.common import stored
from martlet.llm.queries import vocabulary
from martlet.operators import keep_first
from martlet.sources.readers import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: SQL can express neither the components of fingerprints nor packing
ORACLE_SQL: str | None = None


def _text_keys() -> tuple[Column, Column]:
    """128 bits of a text's hash, in two numbers: they decide which rows go, so 64
    would be few. The second starts from the hash of a word of its own."""
    text = F.coalesce("text", F.lit(""))
    return F.xxhash64(text).alias("_text_a_"), F.xxhash64(F.lit("text"), text).alias("_text_b_")


KEYS = ("_text_a_", "_text_b_")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the cascade rejects."""
    return quality.kept_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document with the smallest
    doc_id; of its rows that share that id, one, that with the smallest text hash and
    then the first by its other columns. A row without an id stays if nothing
    with an id is linked to it; of such rows with equal fingerprints, one."""
    found = simhash.near_duplicates(docs.select("doc_id", "text", *_text_keys()), shingle=4, max_bits=4,
                                    also=KEYS, root=True)
    # one id may be the smallest of several components
    group = F.when(F.col("doc_id").isNull(), F.col("fingerprint")).otherwise(F.col("root").cast("string"))
    chosen = (found.filter(F.col("component_id").eqNullSafe(F.col("doc_id")))
              .groupBy("doc_id", group.alias("g")).agg(F.min(F.struct(*KEYS)).alias("key"))
              .select(F.col("doc_id").alias("chosen_id"), *[F.col(f"key.{k}").alias(f"chosen{k}") for k in KEYS]))
    keyed = docs.select("*", *_text_keys())
    same = keyed["doc_id"].eqNullSafe(chosen["chosen_id"])
    for k in KEYS:
        same &= keyed[k] == chosen[f"chosen{k}"]
    kept = keyed.join(chosen, same, "left_semi")
    # rows of one id and text differ in other columns only
    rest = [canonical(F.col(f"`{f.name}`"), f.dataType) for f in docs.schema.fields if f.name not in ("doc_id", "text")]
    return keep_first(kept, ["doc_id", *KEYS], rest or [F.lit(0)]).drop(*KEYS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose texts aren't contaminated. The text alone decides, so its
    hash stands for the row; that holds for rows without an id, too."""
    items = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    a, _ = _text_keys()
    keyed = docs.select("*", a)
    judged = decontam.contamination(keyed.select(F.col(KEYS[0]).alias("doc_id"), "text"), items, slack=0)
    bad = judged.filter("contaminated").select(F.col("doc_id").alias("bad_key")).distinct()
    return keyed.join(bad, keyed[KEYS[0]] == bad["bad_key"], "left_anti").drop(KEYS[0])


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced by a mark."""
    return secrets.redacted_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return packing.pack_documents(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
