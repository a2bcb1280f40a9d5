"""Typed reading of JSON values, and building documents from rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioql.functions import values as V
from folioql.sources.container import SERVICE


def typed_value(value: Column, kind: str) -> Column:
    """A JSON value as a declared SQL type, without coercion: another JSON type raises.

    Absent and null are NULL.  Whole numbers only for integers, in range; text for strings; base64
    text for binary; ISO text or a day count for dates; ISO text (UTC) or epoch milliseconds for
    timestamps.
    """
    kind = kind.lower()
    t = V.type_of(value)
    printed, d = F.try_variant_get(value, "$", "string"), F.try_variant_get(value, "$", "double")
    refuse = F.raise_error(F.concat(F.lit(f"DocumentTypeError: expected {kind}, found "), t))
    case = F.when(t.isNull() | (t == "null"), None)
    if kind == "variant":
        return V.norm(value)
    if kind == "boolean":
        return case.when(t == "boolean", F.try_variant_get(value, "$", "boolean")).otherwise(refuse)
    if kind in V.INT_LIMITS:
        low, high = V.INT_LIMITS[kind]
        whole = (t == "number") & (d == F.floor(d)) & (d >= float(low)) & (d <= float(high))
        return case.when(whole, F.try_variant_get(value, "$", "bigint").cast(kind)).otherwise(refuse)
    if kind in ("float", "double"):
        return case.when(t == "number", d.cast(kind)).otherwise(refuse)
    if kind.startswith("decimal"):
        return case.when(t == "number", printed.cast(kind)).otherwise(refuse)
    if kind == "string":
        return case.when(t == "string", printed).otherwise(refuse)
    if kind == "binary":
        return case.when(t == "string", F.unbase64(printed)).otherwise(refuse)
    if kind == "date":
        days = F.date_add(F.lit("1970-01-01").cast("date"), d.cast("int"))
        return case.when(t == "string", printed.cast("date")).when((t == "number") & (d == F.floor(d)), days).otherwise(refuse)
    if kind in ("timestamp", "timestamp_ntz"):
        return case.when(t == "string", printed.cast("timestamp").cast(kind)).when(t == "number", F.timestamp_millis(d.cast("bigint")).cast(kind)).otherwise(refuse)
    if kind.startswith("map<"):
        return case.when(t == "object", F.try_variant_get(value, "$", "map<string,variant>")).otherwise(refuse)
    if kind.startswith("array<"):
        return case.when(t == "array", F.try_variant_get(value, "$", "array<variant>")).otherwise(refuse)
    raise ValueError(f"documents have no {kind} values")


def read_rows(df: DataFrame, schema: Mapping[str, str], doc: str = "doc") -> DataFrame:
    """One typed column per property; a row that is no object raises."""
    value = F.col(doc)
    whole = F.when(V.is_object(value), value).otherwise(F.raise_error(F.lit("DocumentTypeError: a row must be an object")))
    return df.select(whole.alias("_doc")).select(*(typed_value(V.raw(F.col("_doc"), name), kind).alias(name) for name, kind in schema.items()))


def build_document(document: Column | None, **promoted: Column) -> Column:
    """The document that a row writes: the map first, non-null promoted columns over it, service properties stripped."""
    base = F.try_variant_get(document, "$", "map<string,variant>") if document is not None else F.lit(None).cast("map<string,variant>")
    base = F.coalesce(base, F.create_map().cast("map<string,variant>"))
    over = F.map_filter(F.create_map(*(x for n, c in promoted.items() for x in (F.lit(n), c.cast("variant")))), lambda _, v: v.isNotNull()) if promoted else F.create_map().cast("map<string,variant>")
    kept = F.map_filter(base, lambda k, _: ~k.isin(*SERVICE) & ~F.array_contains(F.map_keys(over), k))
    return F.to_variant_object(F.map_concat(kept, over))
