"""JSONB operators (F18–F23) on stored VARIANT columns and on JSON text.

A stored document is parsed once, when its table is written, into a VARIANT
that Parquet holds shredded; ``text_at`` and ``has_key_at`` read only the
fields of their paths.  The functions that take JSON text serve columns that
are not stored so.  ``contains`` becomes a conjunction of predicates on the
VARIANT, built from the pattern at plan time.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: The parsed twin of ``business_data`` in the stored table.
DOCUMENT = "business_doc"


def document(businesses: DataFrame) -> Column:
    """The businesses' document as VARIANT: the stored one, or the text parsed where a frame has only that."""
    return F.col(DOCUMENT) if DOCUMENT in businesses.columns else F.try_parse_json("business_data")


def _path(*path: str) -> str:
    return "$" + "".join(f"[{json.dumps(p)}]" for p in path)


def text_at(v: Column, *path: str) -> Column:
    """``v #>> path`` of a VARIANT: text of the value; JSON null or no such path → SQL NULL."""
    return F.try_variant_get(v, _path(*path), "string")


def has_value_at(v: Column, *path: str) -> Column:
    """Whether the path holds anything but JSON null."""
    found = F.try_variant_get(v, _path(*path), "variant")
    return found.isNotNull() & ~F.is_variant_null(found)


def has_key_at(v: Column, key: str, *path: str) -> Column:
    """``v #> path ? key`` for objects — true even when the value is JSON null."""
    return F.try_variant_get(v, _path(*path, key), "variant").isNotNull()


def has_any_key_at(v: Column, keys: list[str], *path: str) -> Column:
    """``?|`` on a VARIANT."""
    return reduce(or_, [has_key_at(v, k, *path) for k in keys], F.lit(False))


def has_all_keys_at(v: Column, keys: list[str], *path: str) -> Column:
    """``?&`` on a VARIANT."""
    return reduce(and_, [has_key_at(v, k, *path) for k in keys], F.lit(True))


def arrow(doc: Column, *path: str) -> Column:
    """``doc -> a -> b`` (JSON text of the object/array/scalar)."""
    return F.get_json_object(doc, "$." + ".".join(path))


def arrow_text(doc: Column, *path: str) -> Column:
    """``doc -> a ->> b``: text of the value; JSON null → SQL NULL."""
    return F.get_json_object(doc, "$." + ".".join(path))


def keys_at(doc: Column, *path: str) -> Column:
    obj = doc if not path else F.get_json_object(doc, "$." + ".".join(path))
    return F.json_object_keys(obj)


def has_key(doc: Column, key: str, *path: str) -> Column:
    """``doc #> path ? key`` — true even when the value is JSON null."""
    return F.coalesce(F.array_contains(keys_at(doc, *path), F.lit(key)), F.lit(False))


def has_any_key(doc: Column, keys: list[str], *path: str) -> Column:
    """``?|``"""
    return F.coalesce(F.arrays_overlap(keys_at(doc, *path), F.array(*[F.lit(k) for k in keys])), F.lit(False))


def has_all_keys(doc: Column, keys: list[str], *path: str) -> Column:
    """``?&``"""
    inter = F.array_intersect(keys_at(doc, *path), F.array(*[F.lit(k) for k in keys]))
    return F.coalesce(F.size(inter) == len(set(keys)), F.lit(False))


def _value(v: Column, pattern) -> Column:
    """Whether a VARIANT value is this JSON scalar: the kinds must agree, numbers by value."""
    kind = F.schema_of_variant(v)
    if pattern is None:
        return F.is_variant_null(v)
    if isinstance(pattern, bool):
        return (kind == "BOOLEAN") & (F.try_variant_get(v, "$", "boolean") == F.lit(pattern))
    if isinstance(pattern, (int, float)):
        number = kind.startswith("DECIMAL") | kind.isin("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE")
        exact = F.try_variant_get(v, "$", "decimal(38,10)") == F.lit(str(pattern)).cast("decimal(38,10)")
        return number & F.coalesce(exact, F.try_variant_get(v, "$", "double") == F.lit(float(pattern)))
    return (kind == "STRING") & (F.try_variant_get(v, "$", "string") == F.lit(pattern))


def _some(elements: Column, pattern, test) -> Column:
    return F.coalesce(F.exists(elements, lambda e: F.coalesce(test(e, pattern), F.lit(False))), F.lit(False))


def _holds(v: Column, pattern, top: bool = False) -> Column:
    """``v @> pattern`` on VARIANT values, as a conjunction built from the pattern."""
    elements = F.try_variant_get(v, "$", "array<variant>")
    is_array = F.schema_of_variant(v).startswith("ARRAY")
    if isinstance(pattern, dict):
        out = F.schema_of_variant(v).startswith("OBJECT")
        for key, inner in pattern.items():
            name = json.dumps(key)
            out = out & F.coalesce(_holds(F.try_variant_get(v, f"$[{name}]", "variant"), inner), F.lit(False))
        return out
    if isinstance(pattern, list):
        out = is_array
        for inner in pattern:
            # An element of the pattern must be held by some element (an array by an array, an object by an object).
            out = out & _some(elements, inner, _holds)
        return out
    same = F.coalesce(_value(v, pattern), F.lit(False))
    if top:   # an array on the outside may hold a bare scalar
        same = same | (is_array & _some(elements, pattern, _value))
    return same


def contains(doc: Column, pattern) -> Column:
    """``doc @> pattern`` for objects, arrays and scalars, as in PostgreSQL.

    Kinds count: the string "3" does not hold the number 3.  Arrays hold a
    pattern's elements in any order and number.  Texts that are no JSON hold
    nothing.
    """
    return holds(F.try_parse_json(doc), pattern)


def holds(v: Column, pattern) -> Column:
    """:func:`contains` for a VARIANT."""
    return F.coalesce(_holds(v, pattern, top=True), F.lit(False))


SQL_NAMES = ("json_has_key", "json_contains_all_keys", "json_contains_any_key")


def register_sql(spark) -> None:
    """SQL functions for JSON key tests, callable from ``spark.sql``: (document, path or '$', key or keys)."""
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION json_has_key(doc STRING, path STRING, key STRING) RETURNS BOOLEAN
        RETURN coalesce(array_contains(json_object_keys(get_json_object(doc, path)), key), false)""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION json_contains_any_key(doc STRING, path STRING, keys ARRAY<STRING>) RETURNS BOOLEAN
        RETURN coalesce(arrays_overlap(json_object_keys(get_json_object(doc, path)), keys), false)""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION json_contains_all_keys(doc STRING, path STRING, keys ARRAY<STRING>) RETURNS BOOLEAN
        RETURN coalesce(size(array_intersect(json_object_keys(get_json_object(doc, path)), keys)) = size(array_distinct(keys)), false)""")
