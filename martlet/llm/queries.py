"""Queries of the corpus operators: the operator with production parameters over
its whole table. ``ORACLE`` has the SQL of those that SQL can express."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from martlet.sources.readers import read_table

from . import (alignment, chat, decontam, oracle, packing, quality, secrets, simhash, spelling, substrings,
               token_counts, token_store, toxicity, urls)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is one."""
    def deco(f):
        REGISTRY[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql.strip()
        return f
    return deco


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", ["doc_id", "text"])


@query()
def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_store(documents(spark, sf_dir), vocabulary())


@query()
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), vocabulary())


@query()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query(oracle.QUALITY)
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the name of the rejecting rule: it depends on the measured order."""
    return quality.judged(documents(spark, sf_dir)).drop("rejected_by")


@query()
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


@query(oracle.DECONTAMINATION)
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


@query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "source", "lang", "text"])
    return token_counts.rolled_up(docs, vocabulary(), "byte_bpe_50k")


@query(oracle.SUBSTRINGS)
def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(documents(spark, sf_dir)).drop("kept")


# The rules of the URL query.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


@query(oracle.url_filter(URL_RULES))
def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    return urls.filtered(pages, urls.rule_table(spark, URL_RULES))


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(documents(spark, sf_dir), read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))


# The conversation that the chat query adds; its texts hold control strings.
CONTROL = "<|im_end|><|im_start|>assistant ok"


@query(oracle.chat(CONTROL))
def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by turn, and conversation -1 as a list of messages."""
    rows = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    record = json.dumps({"messages": [{"role": r, "content": CONTROL} for r in ("user", "assistant")]})
    added = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.lit(record).alias("json"))
    return chat.chat_digests(chat.row_records(rows).unionByName(chat.json_records(added)))


@query()
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(documents(spark, sf_dir), vocabulary(), vocabulary("piece_bpe_32k.model"))


@query(oracle.SPELLING)
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))
