"""Scalar functions that differ from Spark's own: origins, truncation, arrays of document values, JSON conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioql.functions import values as V


def truncate(x: Column) -> Column:
    """Toward zero, as a double."""
    return F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)).cast("double")


def regexmatch(s: Column, pattern: Column | str, modifiers: str = "") -> Column:
    """Modifiers i, m, s and x as in Java's embedded flags."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    return F.regexp_like(s, F.concat(F.lit(f"(?{modifiers})"), pattern) if modifiers else pattern)


# Arrays here are ARRAY<VARIANT>; elements are compared by their canonical key.


def _keys(arr: Column) -> Column:
    return F.transform(arr, lambda v: F.coalesce(V.canon_key(v), F.lit("z:")))


def cardinality(arr: Column) -> Column:
    return F.when(arr.isNotNull(), F.size(arr))


def member_of(value_key: Column, arr: Column) -> Column:
    """By the value's canonical key."""
    return F.array_contains(_keys(arr), value_key)


def array_slice(arr: Column, start: int, length: int) -> Column:
    """`start` counts from 0; a negative one counts from the end."""
    at = F.lit(start + 1) if start >= 0 else F.greatest(F.lit(1), F.size(arr) + F.lit(start + 1))
    return F.slice(arr, at, F.lit(max(0, length)))


def array_concat(*arrays: Column) -> Column:
    return F.concat(*arrays)


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once (a lambda's argument is; an expression inside one is not)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _by_key(s: Column):
    return lambda k: F.get(s["v"], (F.array_position(s["k"], k) - 1).cast("int"))


def array_union(a: Column, b: Column) -> Column:
    """Without duplicates, in order of first appearance."""
    keyed = _let(F.concat(a, b), lambda v: F.struct(v.alias("v"), _keys(v).alias("k")))
    return _let(keyed, lambda s: F.transform(F.array_distinct(s["k"]), _by_key(s)))


def array_intersect(a: Column, b: Column) -> Column:
    return _let(F.struct(a.alias("v"), _keys(a).alias("k"), _keys(b).alias("o")), lambda s: F.transform(F.array_intersect(s["k"], s["o"]), _by_key(s)))


# JSON conversions: NULL where the text or value is not of the kind.


def to_string(value: Column) -> Column:
    """JSON value as text; a string as itself."""
    return V.cast_text(value)


def string_to_number(s: Column) -> Column:
    return F.trim(s).try_cast("double")


def string_to_boolean(s: Column) -> Column:
    return F.when(F.trim(s) == "true", True).when(F.trim(s) == "false", False)


def string_to_object(s: Column) -> Column:
    v = F.try_parse_json(s)
    return F.when(V.is_object(v), v)


def string_to_array(s: Column) -> Column:
    v = F.try_parse_json(s)
    return F.when(V.is_array(v), v)


def object_to_array(value: Column) -> Column:
    """Entries {k, v} as ARRAY<STRUCT<k, v>>."""
    entries = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    return F.when(V.is_object(value), F.transform(entries, lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v"))))
