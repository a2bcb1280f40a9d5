"""A container: Parquet with the document as VARIANT, promoted columns, key columns, and buckets of keys.

A document lies in the folder of its bucket, a hash of its leading key; the number of folders is
declared, whatever the number of keys.  Within files rows are sorted by key and id, so that their
statistics prune further.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioql.functions import values as V

MAP, ID, TS, ETAG = "_MAP", "id", "_ts", "_etag"
#: Properties the store assigns; they are never part of a written document.
SERVICE = ("_ts", "_etag", "_rid", "_self", "_attachments")
#: Keys of documents whose key path is absent, or holds null.
NONE_KEY, NULL_KEY = "none:", "null:"
BUCKET = "_bucket"


@dataclass(frozen=True)
class ContainerMeta:
    """What is declared about a container; nothing is inferred from documents."""

    name: str
    partition_key: tuple[str, ...] = ()  # policy paths such as /category
    composite_indexes: tuple[tuple[tuple[str, str], ...], ...] = ()
    included: tuple[str, ...] = ("/*",)
    excluded: tuple[str, ...] = ()
    promoted: dict[str, str] = field(default_factory=dict, hash=False)  # further paths kept as typed columns, for file pruning
    buckets: int = 64

    def __post_init__(self):
        if len(self.partition_key) > 3:
            raise ValueError("a container has at most three partition keys")

    @property
    def key_paths(self) -> list[tuple[str, ...]]:
        return [tuple(p.strip("/").split("/")) for p in self.partition_key]

    @property
    def key_columns(self) -> list[str]:
        """Single-segment keys become columns of the row type."""
        return [p[0] for p in self.key_paths if len(p) == 1 and p[0] not in (ID, TS, ETAG)]

    @property
    def partition_columns(self) -> list[str]:
        return [f"_pk{k}" for k in range(len(self.partition_key))]

    @property
    def promoted_columns(self) -> list[tuple[str, str, str]]:
        """Path, stored column and type of each promoted path."""
        return [(p, "_p_" + p.strip("/").replace("/", "_"), kind) for p, kind in self.promoted.items()]

    def bucket(self, leading: Column) -> Column:
        return F.pmod(F.xxhash64(leading), F.lit(self.buckets)).cast("int")

    def in_parts(self, part: int, keys: Sequence[str]) -> Column:
        """Rows whose key part is one of `keys`; for the leading part also their buckets, which are folders."""
        test = F.col(self.partition_columns[part]).isin(*keys)
        return test & F.col(BUCKET).isin(*(self.bucket(F.lit(k)) for k in keys)) if part == 0 else test

    def is_indexed(self, path: str) -> bool:
        """Whether the index policy covers a path: the deepest pattern wins, exact before subtree."""

        def match(pattern: str) -> int:
            stem = pattern.removesuffix("/*").removesuffix("/?")
            if pattern.endswith("/*") and (path == stem or path.startswith(stem + "/") or not stem):
                return 2 * stem.count("/") + 1
            return 2 * stem.count("/") + 2 if path == stem else 0

        best = lambda patterns: max(map(match, patterns), default=0)
        return best(self.included) > best(self.excluded)

    def serves_order(self, order: Sequence[tuple[str, str]]) -> bool:
        """Whether a composite index has this order, or its exact reverse."""
        flipped = [(p, "desc" if d == "asc" else "asc") for p, d in order]
        return any(list(i) in (list(order), flipped) for i in self.composite_indexes)


def key_text(doc: Column, segments: Sequence[str]) -> Column:
    """The canonical key of a document; absent and null keys have reserved texts."""
    value = V.raw(doc, *segments)
    return F.when(value.isNull(), NONE_KEY).when(V.is_null(value), NULL_KEY).otherwise(V.canon_key(value))


def key_literal(value) -> str:
    """The canonical key of a Python value."""
    if value is None:
        return NULL_KEY
    if isinstance(value, bool):
        return f"b:{str(value).lower()}"
    if isinstance(value, (int, float)):
        return f"n:{int(value)}" if float(value).is_integer() and abs(value) < 2**53 else f"n:{float(value)}"
    return f"s:{value}"


def layout(docs: DataFrame, meta: ContainerMeta, doc: str = "doc", now: int | None = None) -> DataFrame:
    """Documents as rows of the container on disk."""
    value = F.col(doc)
    body = F.to_variant_object(F.map_filter(F.try_variant_get(value, "$", "map<string,variant>"), lambda k, _: ~k.isin(*SERVICE)))
    columns = [body.alias(MAP), V.text(V.raw(value, ID)).alias(ID), (F.lit(now) if now is not None else F.unix_timestamp()).cast("bigint").alias(TS), F.md5(F.to_json(body).cast("binary")).alias(ETAG)]
    columns += [V.cast_value(V.raw(value, *p.strip("/").split("/")), kind, safe=True).alias(name) for p, name, kind in meta.promoted_columns]
    columns += [key_text(value, p).alias(c) for p, c in zip(meta.key_paths, meta.partition_columns)]
    rows = docs.select(*columns)
    return rows.withColumn(BUCKET, meta.bucket(F.col("_pk0"))) if meta.partition_key else rows


def writer(rows: DataFrame, meta: ContainerMeta, mode: str):
    """Rows of the layout, gathered by bucket; adaptive execution splits large buckets over several files."""
    if not meta.partition_key:
        return rows.write.mode(mode)
    return rows.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *meta.partition_columns, ID).write.mode(mode).partitionBy(BUCKET)


def from_rows(df: DataFrame, id_column: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Plain rows as documents: NULL columns are absent, `id` is the text of a column."""
    columns = list(columns or df.columns)
    entries = [x for c in columns for x in (F.lit(c), F.to_json(F.struct(F.col(c).alias("v"))))]
    whole = F.map_filter(F.create_map(*entries), lambda _, v: v != "{}")
    named = F.create_map(F.lit(ID), F.col(id_column).cast("string").cast("variant"))
    kept = F.map_filter(F.transform_values(whole, lambda _, v: F.variant_get(F.parse_json(v), "$.v", "variant")), lambda k, _: k != ID)
    doc = F.to_variant_object(F.map_concat(kept, named))
    return df.select(doc.alias("doc"))


def create(docs: DataFrame, meta: ContainerMeta, path: str, doc: str = "doc", now: int | None = None) -> None:
    """Write a new container."""
    writer(layout(docs, meta, doc, now), meta, "errorifexists").parquet(path)


def scan(spark: SparkSession, meta: ContainerMeta, path: str) -> DataFrame:
    """The row type: _MAP, id, _ts, _etag and key columns (values, null where absent)."""
    stored = spark.read.parquet(path)
    return row_type(stored, meta)


def row_type(stored: DataFrame, meta: ContainerMeta) -> DataFrame:
    keys = [V.path(F.col(MAP), c).alias(c) for c in meta.key_columns]
    return stored.select(MAP, ID, TS, ETAG, *keys, *hidden_columns(meta))


def hidden_columns(meta: ContainerMeta) -> list[str]:
    """Stored columns that only prune: buckets, keys, promoted paths."""
    return [*([BUCKET] if meta.partition_key else []), *meta.partition_columns, *(c for _, c, _ in meta.promoted_columns)]


def route(df: DataFrame, meta: ContainerMeta, *key_values) -> DataFrame:
    """Rows of the leading partition keys: one bucket's folder, pruned by the key columns, no predicate on documents."""
    for part, value in enumerate(key_values):
        df = df.where(meta.in_parts(part, [key_literal(value)]))
    return df


def point_read(df: DataFrame, meta: ContainerMeta, document_id: str, *key_values) -> DataFrame:
    return route(df, meta, *key_values).where(F.col(ID) == document_id)


def point_read_batch(df: DataFrame, meta: ContainerMeta, ids: Sequence[str], *key_values) -> DataFrame:
    return route(df, meta, *key_values).where(F.col(ID).isin(sorted(set(ids))))


# --- metadata -----------------------------------------------------------------------------------


def write_meta(spark: SparkSession, meta: ContainerMeta, path: str) -> None:
    """Keep the declaration beside the container, for `read_meta`."""
    text = json.dumps({"name": meta.name, "partitionKey": meta.partition_key, "compositeIndexes": meta.composite_indexes, "includedPaths": meta.included, "excludedPaths": meta.excluded, "promoted": meta.promoted, "buckets": meta.buckets})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}.meta")


def read_meta(spark: SparkSession, path: str) -> ContainerMeta:
    said = json.loads(spark.read.text(f"{path.rstrip('/')}.meta").first()[0])
    composite = tuple(tuple((p, d) for p, d in i) for i in said["compositeIndexes"])
    return ContainerMeta(said["name"], tuple(said["partitionKey"]), composite, tuple(said["includedPaths"]), tuple(said["excludedPaths"]), said["promoted"], said["buckets"])


def statistics(spark: SparkSession, meta: ContainerMeta, path: str) -> dict:
    """Documents, bytes of their files, distinct keys (about), and rows of the largest bucket: one pass over narrow columns."""
    stored = spark.read.parquet(path)
    keys = F.approx_count_distinct(F.struct(*meta.partition_columns)) if meta.partition_key else F.lit(1)
    sums = stored.groupBy(*([BUCKET] if meta.partition_key else [])).agg(F.count("*").alias("n"), keys.alias("keys"))
    row = sums.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("keys"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = root.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(root).getLength()
    return {"documents": row[0], "bytes": size, "keys": row[1], "largest_bucket": row[2]}
