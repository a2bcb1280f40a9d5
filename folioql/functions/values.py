"""Semantics of document values: absent and null, types, keys, order, casts.

A document is a VARIANT.  Everywhere but in `is_defined` and `is_null`, JSON null and an absent path
are both SQL NULL (`norm`).  Comparisons hold inside one JSON type; across types they are unknown.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Order of the types in a sort over mixed values; SQL NULL is placed by the sort itself.
RANK = {"boolean": 1, "number": 2, "string": 3, "array": 4, "object": 5}
#: The first letters of the type names of numbers; of the others: VOID, BOOLEAN, ARRAY, OBJECT, and what counts as a string.
NUMBER_KINDS = ("BIG", "DOU", "DEC", "INT", "FLO", "SMA", "TIN")
NO_STRINGS = ("VOI", "BOO", "ARR", "OBJ", *NUMBER_KINDS)
INT_LIMITS = {"tinyint": (-(2**7), 2**7 - 1), "smallint": (-(2**15), 2**15 - 1), "int": (-(2**31), 2**31 - 1), "bigint": (-(2**63), 2**63 - 1)}


def path_text(segments: Sequence[str | int]) -> str:
    """The JSON path of property names and zero-based indexes."""
    out = "$"
    for s in segments:
        out += f"[{s}]" if isinstance(s, int) else f".{s}" if s.isidentifier() and s.isascii() else "['" + s.replace("\\", "\\\\").replace("'", "\\'") + "']"
    return out


def raw(doc: Column, *segments: str | int) -> Column:
    """The value at a path: NULL when absent, a JSON null when null.  Indexes are SQL's, from 1."""
    if any(isinstance(s, int) and s < 1 for s in segments):
        return F.lit(None).cast("variant")
    zero_based = [s - 1 if isinstance(s, int) else s for s in segments]
    return F.try_variant_get(doc, path_text(zero_based), "variant") if segments else doc


def norm(value: Column) -> Column:
    """JSON null as SQL NULL."""
    return F.when(~F.is_variant_null(value), value)


def path(doc: Column, *segments: str | int) -> Column:
    return norm(raw(doc, *segments))


def _kind(value: Column) -> Column:
    """The first letters of the value's type."""
    return F.substring(F.schema_of_variant(value), 1, 3)


def once(value: Column, body) -> Column:
    """`body` of a value that it repeats (a lambda's argument is computed once, a repeated expression is not)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def by_kind(value: Column, body) -> Column:
    """`body` of the value's kind, which is found once."""
    return once(_kind(value), body)


def type_of(value: Column) -> Column:
    """null, boolean, number, string, array or object; NULL when absent."""
    return by_kind(
        value,
        lambda k: F.when(k.isNull(), None).when(k == "VOI", "null").when(k == "BOO", "boolean").when(k == "ARR", "array").when(k == "OBJ", "object").when(k.isin(*NUMBER_KINDS), "number").otherwise("string"),
    )


def is_defined(value: Column) -> Column:
    return value.isNotNull()


def is_null(value: Column) -> Column:
    return F.coalesce(F.is_variant_null(value), F.lit(False))


def _is(value: Column, *kinds: str) -> Column:
    return F.coalesce(type_of(value).isin(*kinds), F.lit(False))


def is_array(value: Column) -> Column:
    return _is(value, "array")


def is_bool(value: Column) -> Column:
    return _is(value, "boolean")


def is_number(value: Column) -> Column:
    return _is(value, "number")


def is_object(value: Column) -> Column:
    return _is(value, "object")


def is_string(value: Column) -> Column:
    return _is(value, "string")


def is_primitive(value: Column) -> Column:
    return _is(value, "null", "boolean", "number", "string")


def num(value: Column) -> Column:
    """The number, else NULL."""
    return F.when(_kind(value).isin(*NUMBER_KINDS), F.try_variant_get(value, "$", "double"))


def text(value: Column) -> Column:
    """The string, else NULL (no coercion)."""
    return F.when(~_kind(value).isin(*NO_STRINGS), F.try_variant_get(value, "$", "string"))


def boolean(value: Column) -> Column:
    return F.when(_kind(value) == "BOO", F.try_variant_get(value, "$", "boolean"))


def array(value: Column) -> Column:
    """The elements, else NULL."""
    return F.when(_kind(value) == "ARR", F.try_variant_get(value, "$", "array<variant>"))


def number_text(value: Column) -> Column:
    """One spelling for equal numbers, whatever their JSON form: whole ones as integers, others as doubles."""
    d = F.when(value == 0, F.lit(0.0)).otherwise(value)
    return F.when((d == F.floor(d)) & (F.abs(d) < 2.0**53), d.cast("bigint").cast("string")).otherwise(d.cast("string"))


def canon_key(value: Column) -> Column:
    """A string that is equal for equal values: what groups, joins, distinct and set operations compare.

    Numbers inside arrays and objects are compared as they are printed.
    """

    def key(v: Column) -> Column:
        printed = F.try_variant_get(v, "$", "string")
        number = F.concat(F.lit("n:"), once(F.try_variant_get(v, "$", "double"), number_text))
        return by_kind(
            v,
            lambda k: F.when(k.isNull() | (k == "VOI"), None).when(k.isin(*NUMBER_KINDS), number).when(k == "BOO", F.concat(F.lit("b:"), printed)).when(k.isin("ARR", "OBJ"), F.concat(F.lit("j:"), F.to_json(v))).otherwise(F.concat(F.lit("s:"), printed)),
        )

    return once(value, key)


def plain_key(value: Column, kind: str) -> Column:
    """`canon_key` of a typed column."""
    if kind in INT_LIMITS or kind in ("float", "double") or kind.startswith("decimal"):
        return F.concat(F.lit("n:"), number_text(value.cast("double")))
    return F.concat(F.lit("b:" if kind == "boolean" else "s:"), value.cast("string"))


def sort_key(value: Column) -> Column:
    """A struct that sorts mixed values: boolean < number < string < array < object; NULL for null and absent."""

    def key(k: Column) -> Column:
        number = k.isin(*NUMBER_KINDS)
        rank = F.when(k == "BOO", RANK["boolean"]).when(number, RANK["number"]).when(k == "ARR", RANK["array"]).when(k == "OBJ", RANK["object"]).otherwise(RANK["string"])
        d = F.when(number, F.try_variant_get(value, "$", "double")).when(k == "BOO", F.try_variant_get(value, "$", "boolean").cast("int").cast("double"))
        s = F.when(k.isin("ARR", "OBJ"), F.to_json(value)).when(~k.isin(*NO_STRINGS), F.try_variant_get(value, "$", "string"))
        return F.when(k.isNotNull() & (k != "VOI"), F.struct(rank.alias("rank"), d.alias("number"), s.alias("text")))

    return by_kind(value, key)


# --- casts ----------------------------------------------------------------------------------------


def cast_integer(value: Column, kind: str = "int", safe: bool = False) -> Column:
    """Strings convert, fractions truncate toward zero, int and bigint saturate; others raise (NULL when safe)."""
    low, high = INT_LIMITS[kind]
    d = F.try_variant_get(value, "$", "double")
    t = type_of(value)
    printed = F.trim(F.try_variant_get(value, "$", "string"))
    d = F.when(t == "string", printed.try_cast("double") if safe else printed.cast("double")).otherwise(d)
    cut = F.when(d >= 0, F.floor(d)).otherwise(F.ceil(d))
    if kind in ("int", "bigint"):
        number = F.when(d >= float(high), F.lit(high)).when(d <= float(low), F.lit(low)).otherwise(cut).cast(kind)
    else:
        number = d.try_cast(kind) if safe else d.cast(kind)
    exact = F.try_variant_get(value, "$", "bigint")  # whole numbers beyond 2^53 keep their digits
    if kind == "bigint":
        number = F.when((t == "number") & F.schema_of_variant(value).startswith("BIGINT"), exact).otherwise(number)
    return _convertible(t, number, safe, kind)


def _convertible(t: Column, converted: Column, safe: bool, kind: str) -> Column:
    wrong = F.lit(None) if safe else F.raise_error(F.concat(F.lit("cannot cast "), t, F.lit(f" to {kind}")))
    return F.when(t.isNull() | (t == "null"), None).when(t.isin("number", "string"), converted).otherwise(wrong.cast(kind) if safe else wrong)


def saturated(value: Column, to: str, safe: bool = False) -> Column:
    """A typed number as a whole type, like `cast_integer`: toward zero; int and bigint saturate, others raise (NULL when safe)."""
    low, high = INT_LIMITS[to]
    if to not in ("int", "bigint"):
        return value.try_cast(to) if safe else value.cast(to)
    return F.when(value >= F.lit(high), F.lit(high).cast(to)).when(value <= F.lit(low), F.lit(low).cast(to)).otherwise(value.cast(to))


def cast_double(value: Column, safe: bool = False, kind: str = "double") -> Column:
    t = type_of(value)
    printed = F.trim(F.try_variant_get(value, "$", "string"))
    d = F.when(t == "string", printed.try_cast("double") if safe else printed.cast("double")).otherwise(F.try_variant_get(value, "$", "double"))
    return _convertible(t, d.cast(kind), safe, kind)


def cast_decimal(value: Column, precision: int, scale: int, safe: bool = False) -> Column:
    kind = f"decimal({precision},{scale})"
    t = type_of(value)
    printed = F.trim(F.try_variant_get(value, "$", "string"))
    wide = printed.try_cast("double") if safe else printed.cast("double")
    exact = printed.try_cast("decimal(38,18)")
    number = F.coalesce(exact.try_cast(kind) if safe else exact.cast(kind), wide.try_cast(kind) if safe else wide.cast(kind))
    return _convertible(t, number, safe, kind)


def cast_boolean(value: Column, safe: bool = False) -> Column:
    t = type_of(value)
    printed = F.try_variant_get(value, "$", "string")
    converted = F.when(t == "boolean", F.try_variant_get(value, "$", "boolean")).when(t == "string", printed.try_cast("boolean") if safe else printed.cast("boolean"))
    wrong = F.lit(None).cast("boolean") if safe else F.raise_error(F.concat(F.lit("cannot cast "), t, F.lit(" to boolean")))
    return F.when(t.isNull() | (t == "null"), None).when(t.isin("boolean", "string"), converted).otherwise(wrong)


def cast_text(value: Column) -> Column:
    """Strings as they are, numbers and booleans as printed, arrays and objects as JSON text."""
    printed = F.try_variant_get(value, "$", "string")
    number = number_text(F.try_variant_get(value, "$", "double"))
    return by_kind(value, lambda k: F.when(k.isNull() | (k == "VOI"), None).when(k.isin("ARR", "OBJ"), F.to_json(value)).when((k != "BIG") & k.isin(*NUMBER_KINDS), number).otherwise(printed))


def cast_value(value: Column, kind: str, safe: bool = False) -> Column:
    """A document value as a SQL type, by the type's Spark name."""
    kind = kind.lower()
    if kind in INT_LIMITS:
        return cast_integer(value, kind, safe)
    if kind in ("double", "float"):
        return cast_double(value, safe, kind)
    if kind.startswith("decimal"):
        inside = kind[kind.index("(") + 1 : -1].split(",") if "(" in kind else ["38", "0"]
        return cast_decimal(value, int(inside[0]), int(inside[1]) if len(inside) > 1 else 0, safe)
    if kind == "boolean":
        return cast_boolean(value, safe)
    if kind == "string":
        return cast_text(value)
    if kind == "variant":
        return value
    converted = cast_text(value)
    return converted.try_cast(kind) if safe else converted.cast(kind)
