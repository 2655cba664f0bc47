"""Schemas inferred from records by a lattice of observed types.

Every value's type is observed per field path. Types form a lattice: null below
everything, boolean, whole number below decimal below double, text, object, list; types without a
common one below text meet in text, which is a conflict and is reported as such.
The report is one aggregate over the shapes that occur; no record leaves its task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DataType, DecimalType, DoubleType, LongType, StringType,
                               StructField, StructType)

PATHS = "array<struct<path:array<string>,type:string>>"


def typed_paths(shape: Column) -> Column:
    """Field paths of a record's shape, as ``schema_of_variant`` writes it, each with
    its type: ``[]`` in a path is a list's element, and the record itself is the empty path."""
    # a name (quoted if odd), a container's start, a plain type, or an end
    marks = F.regexp_extract_all(
        shape, F.lit(r"(`(?:[^`]|``)*`: |[^\s<>,:`()]+: |OBJECT<|ARRAY<|[A-Z_]+(?:\(\d+,\d+\))?|>)"), F.lit(1))
    begin = F.struct(F.array().cast("array<string>").alias("at"), F.array().cast("array<array<string>>").alias("open"),
                     F.array().cast(PATHS).alias("found"))

    def step(s: Column, m: Column) -> Column:
        at, opened, found = s["at"], s["open"], s["found"]
        name = F.regexp_replace(F.regexp_replace(F.regexp_replace(m, ": $", ""), "^`|`$", ""), "``", "`")

        def seen(what: Column) -> Column:
            return F.concat(found, F.array(F.struct(at.alias("path"), what.alias("type"))))

        def state(at_: Column, open_: Column, found_: Column) -> Column:
            return F.struct(at_.alias("at"), open_.alias("open"), found_.alias("found"))

        return (F.when(m == "OBJECT<", state(at, F.concat(opened, F.array(at)), seen(F.lit("object"))))
                .when(m == "ARRAY<", state(F.concat(at, F.array(F.lit("[]"))), F.concat(opened, F.array(at)),
                                           seen(F.lit("list"))))
                .when(m == ">", state(F.element_at(opened, -1), F.slice(opened, 1, F.size(opened) - 1), found))
                .when(m.endswith(": "), state(F.concat(F.element_at(opened, -1), F.array(name)), opened, found))
                .otherwise(state(at, opened, seen(F.lower(m)))))

    return F.aggregate(marks, begin, step, lambda s: s["found"])


# The types that variants have, by what they are here.
KINDS = {"void": "null", "boolean": "boolean", "bigint": "whole", "double": "double", "string": "text",
         "object": "object", "list": "list", "variant": "mixed"}


def schema_report(records: DataFrame, json_col: str = "json") -> DataFrame:
    """What JSON records hold, one row per field path: path (dotted; ``[]`` for a
    list's elements; a name with a dot in back quotes), type (the lattice's: null, boolean, whole, decimal, double, text, object,
    list), n_records (with a value or null there), n_null, conflict, and observed (each type that
    occurs with its records, ``type:n`` by type).

    Records that are null or no JSON object count at the path ``''`` with the type they
    have there (null if they can't be parsed). A list whose elements differ is ``mixed`` for
    that record, which is a conflict. An empty table gives no rows.
    """
    shape = F.coalesce(F.schema_of_variant(F.try_parse_json(json_col)), F.lit("VOID"))
    shapes = records.select(shape.alias("shape")).groupBy("shape").agg(F.count("*").alias("n"))
    kinds = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    each = shapes.select("n", F.explode(typed_paths(F.col("shape"))).alias("x")).select(
        F.array_join(F.transform("x.path", lambda p: F.when(p.contains("."), F.concat(F.lit("`"), p, F.lit("`")))
                                 .otherwise(p)), ".").alias("path"), F.coalesce(
            F.try_element_at(kinds, F.col("x.type")), F.when(F.col("x.type").startswith("decimal"), "decimal"),
            F.lit("text")).alias("kind"), F.col("x.type").alias("exact"), "n")
    # whole digits and places that the decimals and whole numbers need
    digits = F.when(F.col("kind") == "decimal", F.regexp_extract("exact", r"\((\d+),", 1).cast("int")
                    - F.regexp_extract("exact", r",(\d+)\)", 1).cast("int")).when(F.col("kind") == "whole", 19)
    places = F.when(F.col("kind") == "decimal", F.regexp_extract("exact", r",(\d+)\)", 1).cast("int")).otherwise(0)
    by = each.groupBy("path", "kind").agg(F.sum("n").alias("n"), F.max(digits).alias("digits"), F.max(places).alias("places"))
    of = (by.groupBy("path").agg(
        F.array_sort(F.collect_list(F.struct("kind", "n"))).alias("seen"), F.sum("n").alias("n_records"),
        F.coalesce(F.sum(F.when(F.col("kind") == "null", F.col("n"))), F.lit(0)).alias("n_null"),
        F.max("digits").alias("digits"), F.max("places").alias("places")))
    have = F.array_remove(F.transform("seen", lambda x: x["kind"]), "null")
    number = F.size(F.array_except(have, F.array(F.lit("whole"), F.lit("decimal"), F.lit("double")))) == 0
    one = F.when(F.size(have) == 0, "null").when((F.size(have) == 1) & (have[0] != "mixed"), have[0]).when(
        number & ~F.array_contains(have, "double") & (F.col("digits") + F.col("places") <= 38), "decimal").when(
        number, "double")
    return of.select("path", F.coalesce(one, F.lit("text")).alias("type"), "n_records", "n_null",
                     one.isNull().alias("conflict"),
                     F.array_join(F.transform("seen", lambda x: F.concat(x["kind"], F.lit(":"), x["n"])), ",").alias("observed"),
                     "digits", "places")


def inferred_schema(report: DataFrame, most_paths: int = 10_000) -> StructType:
    """The schema that a report gives, for reading the same records with. Fields seen only as
    null, and conflicts, are text; nothing inside a conflict is a field. The report's rows
    go to the driver, one per field path; over ``most_paths`` it raises."""
    rows = report.limit(most_paths + 1).collect()
    if len(rows) > most_paths:
        raise ValueError(f"more than {most_paths} field paths: these records have data for keys")
    tree: dict = {}
    for r in sorted(rows, key=lambda r: r.path):
        node = tree
        for part in re.findall(r"`[^`]*`|[^.]+", r.path):
            node = node.setdefault("parts", {}).setdefault(part.strip("`"), {})
        node["row"] = r

    def of(node: dict) -> DataType:
        r = node.get("row")
        if r is None or r.conflict or r.type in ("null", "text"):
            return StringType()
        if r.type == "object":
            return StructType([StructField(k, of(v), True) for k, v in node.get("parts", {}).items()])
        if r.type == "list":
            return ArrayType(of(node.get("parts", {}).get("[]", {})))
        return {"boolean": BooleanType(), "whole": LongType(), "double": DoubleType()}.get(
            r.type) or DecimalType(r.digits + r.places, r.places)

    if "row" in tree and tree["row"].type not in ("object", "null"):
        raise ValueError(f"the records are not objects: {tree['row'].observed}")
    return StructType([StructField(k, of(v), True) for k, v in tree.get("parts", {}).items()])
