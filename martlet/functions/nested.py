"""Map / array / JSON accessors that never raise on missing elements."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from martlet.functions.text import _c


def map_value(m, key: str, dtype: str | None = None) -> Column:
    """``m[key]``; an absent key is NULL (T9). Optional safe cast."""
    v = _c(m).getItem(key)
    return v.try_cast(dtype) if dtype else v


def array_first(a) -> Column:
    """First element, NULL for an empty or NULL array."""
    return F.get(_c(a), F.lit(0))


def array_nth(a, n: int) -> Column:
    """1-based element ``n``; NULL when out of range."""
    return F.try_element_at(_c(a), F.lit(n))


def json_text(c) -> Column:
    """Map/struct/array -> JSON text."""
    return F.to_json(_c(c))


def map_from_json(c, value_type: str = "int") -> Column:
    """JSON object text -> ``map<string, value_type>``; bad JSON -> NULL."""
    return F.from_json(_c(c), f"map<string,{value_type}>")


def canonical(c, dtype: DataType) -> Column:
    """``c`` as a value that can be ordered and is the same for equal values: a map
    becomes its entries in key order, at any depth; a list keeps its order; a variant becomes
    its JSON. NULL stays NULL."""
    c = _c(c)
    if isinstance(dtype, MapType):
        entries = F.transform(F.map_entries(c), lambda e: F.struct(
            canonical(e["key"], dtype.keyType).alias("key"), canonical(e["value"], dtype.valueType).alias("value")))
        return F.array_sort(entries)
    if isinstance(dtype, ArrayType):
        if canonical_type(dtype.elementType):
            return c
        return F.transform(c, lambda x: canonical(x, dtype.elementType))
    if isinstance(dtype, StructType):
        if canonical_type(dtype):
            return c
        return F.when(c.isNotNull(), F.struct(*[canonical(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]))
    return F.to_json(c) if isinstance(dtype, VariantType) else c


def canonical_type(dtype: DataType) -> bool:
    """Whether values of a type are their own canonical form."""
    if isinstance(dtype, ArrayType):
        return canonical_type(dtype.elementType)
    if isinstance(dtype, StructType):
        return all(canonical_type(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (MapType, VariantType))


def nested_fingerprint(columns: dict[str, DataType]) -> Column:
    """One 128-bit hash of several columns' values, nested ones by their canonical
    form: equal for rows that are equal but for the order of map entries."""
    return F.md5(F.to_json(F.struct(*[canonical(F.col(n), t).alias(f"c{i}") for i, (n, t) in enumerate(columns.items())]),
                           {"ignoreNullFields": "false"}))
