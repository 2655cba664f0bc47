"""One large JSON object of objects, read in parallel.

``flatten_keyed_objects`` parses a document in one task. Here the file is read in byte
ranges: Spark splits it at commas near the ranges' ends, and whether a comma stands
between two members follows from what lies before it: inside a string or not, and how
deep in brackets. Both are prefix sums. A block (a run of pieces of a byte range) first sums its
quotes and, for either state that it may begin in, its brackets; the blocks' sums give each one's
state at its begin; and a second pass over the blocks finds the members' borders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: pieces of a byte range that are one block
BLOCK = 1 << 16


def _brackets(pieces: Column) -> Column:
    """Opening less closing brackets in texts without quotes."""
    text = F.array_join(pieces, "")
    def count(a: str) -> Column:
        return F.length(text) - F.length(F.translate(text, a, ""))
    return count("{[") - count("}]")


def member_texts(spark: SparkSession, path: str) -> DataFrame:
    """Members of the JSON object in each file at ``path`` as text: file, member (its
    place, from 0), text (``"key": value``). Files may have line breaks anywhere, or none. What
    is no object, or not complete, gives members that don't parse.

    A block is at most ``BLOCK`` pieces, so a shuffled task's memory follows from the
    number of shuffle partitions, not from the size of the byte ranges, and is bounded below by the
    largest member.
    """
    lines = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("chunk"))
    # ids ascend within a byte range, so (start, part) is a block's place
    lines = lines.withColumn("block", F.struct("start", F.shiftright("id", BLOCK.bit_length() - 1).alias("part"))).drop("start")
    # an escape can't reach over a comma, so it is within a chunk
    parts = F.split(F.regexp_replace("chunk", r"\\.", ""), '"', -1)
    outside = F.filter(parts, lambda _, i: i % 2 == 0)
    inside = F.filter(parts, lambda _, i: i % 2 == 1)
    own = Window.partitionBy("file", "block").orderBy("id")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    chunks = (lines.withColumns({"quotes": F.size(parts) - 1, "d0": _brackets(outside), "d1": _brackets(inside)})
              # quotes before the chunk in its block decide which pieces are outside of strings
              .withColumn("odd", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
              .withColumns({"if0": F.when(F.col("odd") == 0, F.col("d0")).otherwise(F.col("d1")),
                            "if1": F.when(F.col("odd") == 0, F.col("d1")).otherwise(F.col("d0"))}))
    total = chunks.groupBy("file", "block").agg(F.sum("quotes").alias("q"), F.sum("if0").alias("t0"), F.sum("if1").alias("t1"))
    # one row per block of a file
    prior = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    state = (total.withColumn("in", (F.coalesce(F.sum("q").over(prior), F.lit(0)) % 2).cast("int"))
             .withColumn("t", F.when(F.col("in") == 0, F.col("t0")).otherwise(F.col("t1")))
             .select("file", "block", "in", F.coalesce(F.sum("t").over(prior), F.lit(0)).alias("deep")))
    placed = (chunks.join(state, ["file", "block"])
              .withColumn("depth", F.col("deep") + F.sum(
                  F.when(F.col("in") == 0, F.col("if0")).otherwise(F.col("if1"))).over(own))
              # a comma outside of strings, in the outer object only
              .withColumn("border", ((F.col("depth") == 1) & ((F.col("in") + F.col("odd") + F.col("quotes")) % 2 == 0)).cast("int")))
    borders = placed.groupBy("file", "block").agg(F.sum("border").alias("b")).select(
        "file", "block", F.coalesce(F.sum("b").over(prior), F.lit(0)).alias("first"))
    member = F.col("first") + F.coalesce(F.sum("border").over(before), F.lit(0))
    numbered = placed.join(borders, ["file", "block"]).select(
        "file", "block", "id", "chunk", "depth", member.alias("member"))
    return (numbered.groupBy("file", "member").agg(
        F.array_sort(F.collect_list(F.struct("block", "id", "chunk"))).alias("c"), F.min("depth").alias("least"))
        .withColumn("text", F.array_join(F.transform("c", lambda x: x["chunk"]), ","))
        .select("file", "member", F.when(F.col("least") <= 0, F.regexp_replace("text", r"\}\s*\z", "")).otherwise(
            F.col("text")).alias("text"))
        .withColumn("text", F.when(F.col("member") == 0, F.regexp_replace("text", r"\A\s*\{", "")).otherwise(F.col("text")))
        .filter(r"text rlike '\\S'"))


def read_keyed_objects(spark: SparkSession, path: str, value_ddl: str, key_name: str = "key") -> DataFrame:
    """The rows of ``flatten_keyed_objects`` for files that hold one large object each:
    the key and the inner object's fields. A member that isn't an object gives
    its key and nulls; a key that stands twice gives two rows."""
    member = F.concat(F.lit("{"), "text", F.lit("}"))
    value = f"struct<{value_ddl}>"
    one = F.coalesce(F.from_json(member, f"map<string,{value}>"), F.transform_values(
        F.from_json(member, "map<string,string>"), lambda _, v: F.lit(None).cast(value)))
    return member_texts(spark, path).select(F.explode(one).alias(key_name, "_v")).select(key_name, "_v.*")
