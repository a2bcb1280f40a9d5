"""The document operators as SQL functions of a session, for plain `spark.sql` over VARIANT columns."""

from __future__ import annotations

from pyspark.sql import SparkSession

_KIND = "schema_of_variant(v)"
_NUMBER = f"{_KIND} RLIKE '^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)'"
_TOKENS = r"filter(split(lower(s), '[^\\p{L}\\p{N}]+'), t -> t <> '')"

_SHORT = "substring(schema_of_variant(x), 1, 3)"
#: The canonical key of an array's element x.
_KEY = (
    "coalesce(CASE WHEN is_variant_null(x) THEN NULL"
    f" WHEN {_SHORT} IN ('BIG', 'DOU', 'DEC', 'INT', 'FLO', 'SMA', 'TIN') THEN concat('n:', CAST(try_variant_get(x, '$', 'double') AS STRING))"
    f" WHEN {_SHORT} IN ('ARR', 'OBJ') THEN concat('j:', to_json(x)) WHEN {_SHORT} = 'BOO' THEN concat('b:', CAST(x AS STRING)) ELSE concat('s:', CAST(x AS STRING)) END, 'z:')"
)
_KEYS = lambda a: f"transform({a}, x -> {_KEY})"
_DOT = lambda a, b: f"aggregate(zip_with({a}, {b}, (p, q) -> CAST(p AS DOUBLE) * CAST(q AS DOUBLE)), 0D, (s, v) -> s + v)"

#: name(parameters) RETURNS type -> expression
FUNCTIONS = {
    "is_defined(v VARIANT) RETURNS BOOLEAN": "v IS NOT NULL",
    "is_null(v VARIANT) RETURNS BOOLEAN": "coalesce(is_variant_null(v), false)",
    "is_array(v VARIANT) RETURNS BOOLEAN": f"coalesce(startswith({_KIND}, 'ARRAY'), false)",
    "is_bool(v VARIANT) RETURNS BOOLEAN": f"coalesce({_KIND} = 'BOOLEAN', false)",
    "is_number(v VARIANT) RETURNS BOOLEAN": f"coalesce({_NUMBER}, false)",
    "is_object(v VARIANT) RETURNS BOOLEAN": f"coalesce(startswith({_KIND}, 'OBJECT'), false)",
    "is_string(v VARIANT) RETURNS BOOLEAN": f"coalesce({_KIND} = 'STRING', false)",
    "is_primitive(v VARIANT) RETURNS BOOLEAN": f"coalesce({_KIND} IN ('STRING', 'BOOLEAN', 'VOID') OR {_NUMBER}, false)",
    "doc_norm(v VARIANT) RETURNS VARIANT": "CASE WHEN is_variant_null(v) THEN NULL ELSE v END",
    "doc_num(v VARIANT) RETURNS DOUBLE": f"CASE WHEN {_NUMBER} THEN try_variant_get(v, '$', 'double') END",
    "doc_text(v VARIANT) RETURNS STRING": f"CASE WHEN {_KIND} = 'STRING' THEN try_variant_get(v, '$', 'string') END",
    "tostring(v VARIANT) RETURNS STRING": "CASE WHEN NOT is_variant_null(v) THEN CAST(v AS STRING) END",
    "stringtonumber(s STRING) RETURNS DOUBLE": "try_cast(trim(s) AS DOUBLE)",
    "stringtoboolean(s STRING) RETURNS BOOLEAN": "CASE trim(s) WHEN 'true' THEN true WHEN 'false' THEN false END",
    "stringtoobject(s STRING) RETURNS VARIANT": "CASE WHEN startswith(schema_of_variant(try_parse_json(s)), 'OBJECT') THEN try_parse_json(s) END",
    "stringtoarray(s STRING) RETURNS VARIANT": "CASE WHEN startswith(schema_of_variant(try_parse_json(s)), 'ARRAY') THEN try_parse_json(s) END",
    "objecttoarray(v VARIANT) RETURNS ARRAY<STRUCT<k: STRING, v: VARIANT>>": f"CASE WHEN startswith({_KIND}, 'OBJECT') THEN transform(map_entries(try_variant_get(v, '$', 'map<string,variant>')), e -> named_struct('k', e.key, 'v', e.value)) END",
    "doc_array(v VARIANT) RETURNS ARRAY<VARIANT>": f"CASE WHEN startswith({_KIND}, 'ARRAY') THEN try_variant_get(v, '$', 'array<variant>') END",
    "array_slice(a ARRAY<VARIANT>, start INT, n INT) RETURNS ARRAY<VARIANT>": "slice(a, CASE WHEN start >= 0 THEN start + 1 ELSE greatest(1, size(a) + start + 1) END, greatest(0, n))",
    "doc_array_concat(a ARRAY<VARIANT>, b ARRAY<VARIANT>) RETURNS ARRAY<VARIANT>": "concat(a, b)",
    "doc_array_union(a ARRAY<VARIANT>, b ARRAY<VARIANT>) RETURNS ARRAY<VARIANT>": f"transform(array_distinct({_KEYS('concat(a, b)')}), k -> get(concat(a, b), CAST(array_position({_KEYS('concat(a, b)')}, k) AS INT) - 1))",
    "doc_array_intersect(a ARRAY<VARIANT>, b ARRAY<VARIANT>) RETURNS ARRAY<VARIANT>": f"transform(array_intersect({_KEYS('a')}, {_KEYS('b')}), k -> get(a, CAST(array_position({_KEYS('a')}, k) AS INT) - 1))",
    "vectordistance(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE": f"CASE WHEN size(a) = size(b) THEN {_DOT('a', 'b')} / sqrt({_DOT('a', 'a')} * {_DOT('b', 'b')}) END",
    "regexmatch(s STRING, p STRING) RETURNS BOOLEAN": "regexp_like(s, p)",
    "fulltextcontains(s STRING, k STRING) RETURNS BOOLEAN": f"array_contains({_TOKENS}, lower(k))",
    "fulltextcontainsall(s STRING, k ARRAY<STRING>) RETURNS BOOLEAN": f"size(array_except(transform(k, x -> lower(x)), {_TOKENS})) = 0",
    "fulltextcontainsany(s STRING, k ARRAY<STRING>) RETURNS BOOLEAN": f"arrays_overlap({_TOKENS}, transform(k, x -> lower(x)))",
}


def register_functions(spark: SparkSession) -> None:
    """Temporary SQL functions; Catalyst inlines their bodies."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
