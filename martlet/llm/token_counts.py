"""Token counts kept as rollups that signed changes add to.

A batch holds inserts, deletes and revised counts of documents; its signed sums by
source, language and tokenizer version are stored. The totals are stored, too: a
commit adds the batch's sums to them and takes away those of an earlier commit of the
same batch, so it costs as much as there are keys, however many batches there were,
and a retry or a replay adds nothing. Each commit is a version of the totals; it
counts once Spark has marked it whole.
"""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import WHITE, arrow, shared_folder, stored
from .tokens import CHARS, encoder, groups

KEYS = ("source", "lang", "tokenizer")
ROLLUP = "source string, lang string, tokenizer string, n_docs long, n_tokens long"

APPLIED = "batch string, folder string"

#: of a change: what it does to the number of documents, and to the tokens
SIGNS = {"insert": (1, 1, 0), "delete": (-1, 0, -1), "revise": (0, 1, -1)}


def counted(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``docs`` (doc_id, source, lang, text) with n_tokens in place of the text;
    null texts have none. One encoding of each whole text."""
    def run(batches):
        enc = encoder(vocabulary)
        for batch in batches:
            n = [len(ids) for _, texts in groups(batch.column("text"), CHARS) for ids in enc.encode(texts)]
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(n, pa.int64())],
                                             names=[*rest, "n_tokens"])

    rest = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    return arrow(docs.select(*[f"`{f.name}`" for f in rest], "text"), run, f"{schema}, n_tokens long")


def signed(changes: DataFrame) -> DataFrame:
    """Signed sums of ``changes`` (op, source, lang, tokenizer, n_tokens: the
    new count, old_tokens: the one it replaces) by key. A null op or one that
    isn't known raises; a null count counts as 0; null keys are keys like others."""
    def by_op(place: int) -> Column:
        case = F.when(F.lit(False), F.lit(0))
        for op, sign in SIGNS.items():
            case = case.when(F.col("op") == op, F.lit(sign[place]))
        return case.otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("op", F.lit("null")))).cast("int"))

    tokens = (by_op(1) * F.coalesce("n_tokens", F.lit(0)) + by_op(2) * F.coalesce("old_tokens", F.lit(0))).cast("long")
    return (changes.select(*KEYS, by_op(0).cast("long").alias("d"), tokens.alias("t"))
            .groupBy(*KEYS).agg(F.sum("d").alias("n_docs"), F.sum("t").alias("n_tokens")))


class Rollups:
    """Rollups below ``path``, for one writer at a time: ``sums`` has the signed sums of every
    commit, ``applied/v=N`` which of them each batch stands with in version N, and
    ``totals/v=N`` the totals. A version is whole once its totals have Spark's ``_SUCCESS``
    file; a commit that fails before leaves the version before it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _version(self) -> int:
        """The last whole version, 0 if there is none."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/totals/v=*/_SUCCESS")
        found = where.getFileSystem(conf).globStatus(where) or []
        return max((int(x.getPath().getParent().getName()[2:]) for x in found), default=0)

    def _read(self, name: str, version: int, schema: str) -> DataFrame:
        if not version:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}/v={version}")

    def commit(self, batch: str, changes: DataFrame) -> None:
        """Add a batch, or replace the one of that name: a new version of the totals."""
        if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
            raise ValueError(f"not a batch name: {batch!r}")
        version = self._version()
        applied = self._read("applied", version, APPLIED)
        folder = f"sums/{batch}-{uuid.uuid4().hex}"
        signed(changes).write.parquet(f"{self.path}/{folder}")
        rows = self.totals().unionByName(self.spark.read.schema(ROLLUP).parquet(f"{self.path}/{folder}"))
        for old in applied.filter(F.col("batch") == batch).collect():   # one row, if any
            was = self.spark.read.schema(ROLLUP).parquet(f"{self.path}/{old.folder}")
            rows = rows.unionByName(was.select(*KEYS, (-F.col("n_docs")).alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens")))
        new = self.spark.createDataFrame([(batch, folder)], APPLIED)
        applied.filter(F.col("batch") != batch).unionByName(new).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/applied/v={version + 1}")
        # last, as it makes the version whole
        (rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
         .filter("n_docs <> 0 or n_tokens <> 0")
         .write.mode("overwrite").parquet(f"{self.path}/totals/v={version + 1}"))

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs and n_tokens over all batches; a key
        whose sums are back at zero has no row, a store without batches none."""
        return self._read("totals", self._version(), ROLLUP)


def history(docs: DataFrame, vocabulary: str, tokenizer: str) -> dict[str, DataFrame]:
    """Three batches of changes that a corpus goes through: ``load`` inserts
    every row of ``docs`` (doc_id, source, lang, text); ``dedup`` deletes the
    rows with a text that a row before them has (by doc_id, source, lang; of
    rows equal in all these, one stays); ``tidy`` revises the counts of those
    left whose text changes when runs of white space become one space. Null and
    empty texts are one text, without tokens."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.col("lang").cast("string").alias("lang"), F.sha2(text, 256).alias("same"), text.alias("text"))
    now = stored(counted(rows, vocabulary).withColumn("row", F.monotonically_increasing_id()), "counts")
    tidy = F.trim(F.regexp_replace("text", WHITE, " "))
    after = stored(counted(rows.select("same", "text", tidy.alias("tidy")).filter("text <> tidy")
                           .dropDuplicates(["same"]).select("same", F.col("tidy").alias("text")), vocabulary), "recounts")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "source", "lang", "row")
    kept = now.groupBy("same").agg(F.min(first).alias("kept")).select(F.col("same").alias("s"), "kept.row")
    none = F.lit(None).cast("long")

    def change(df: DataFrame, op: str, new: Column, old: Column) -> DataFrame:
        return df.select(F.lit(op).alias("op"), "source", "lang", F.lit(tokenizer).alias("tokenizer"),
                         new.alias("n_tokens"), old.alias("old_tokens"))

    left = now.join(kept, "row", "left_semi")
    revised = left.withColumnRenamed("n_tokens", "old").join(after, "same")
    return {"load": change(now, "insert", F.col("n_tokens"), none),
            "dedup": change(now.join(kept, "row", "left_anti"), "delete", none, F.col("n_tokens")),
            "tidy": change(revised, "revise", F.col("n_tokens"), F.col("old"))}


def rolled_up(docs: DataFrame, vocabulary: str, tokenizer: str) -> DataFrame:
    """Totals after all batches of ``history``, each committed to a new store,
    and one of them once more, as after a lost acknowledgement. An empty table
    gives no rows."""
    store = Rollups(docs.sparkSession, shared_folder(docs.sparkSession, "rollups"))
    batches = history(docs, vocabulary, tokenizer)
    for name in (*batches, "dedup"):
        store.commit(name, batches[name])
    return store.totals()
