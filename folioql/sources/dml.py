"""Insert, delete and replace on containers, by copy on write of the touched buckets.

A conflict is found before anything is written.  Rewritten buckets are staged beside the container
first; the swap of a bucket is one dynamic overwrite, and emptied ones are removed.  The driver sees
numbers of buckets only, of which there are as many as declared.  Last write wins; there are no
transactions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioql.functions import values as V
from folioql.sources.container import BUCKET, ETAG, ID, MAP, SERVICE, TS, ContainerMeta, key_literal, key_text, layout, point_read_batch, row_type, writer


class DuplicateDocument(ValueError):
    """An inserted document has the key and id of another."""


class Container:
    """A container on disk that can be written; `cache` is told about writes."""

    def __init__(self, spark: SparkSession, meta: ContainerMeta, path: str, cache=None):
        self.spark, self.meta, self.path, self.cache = spark, meta, path, cache

    def stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def df(self) -> DataFrame:
        return row_type(self.stored(), self.meta)

    # -- writes return the number of documents they touched

    def insert(self, docs: DataFrame, doc: str = "doc", now: int | None = None) -> int:
        """Create documents; one that exists already (same key and id) fails the whole insert."""
        staged = self._stage(layout(docs, self.meta, doc, now))
        try:
            rows = self.spark.read.parquet(staged)
            if rows.where(F.col(ID).isNull()).limit(1).count():
                raise ValueError("a document needs a text id")
            key = [*([BUCKET] if self.meta.partition_key else []), *self.meta.partition_columns, ID]
            twice = rows.groupBy(*key).count().where("count > 1").select(*key).limit(1)
            there = rows.join(self.stored().select(*key), key, "left_semi").select(*key).limit(1)
            if clash := twice.union(there).take(1):
                raise DuplicateDocument(f"document exists: {clash[0].asDict()}")
            n = rows.count()
            writer(rows, self.meta, "append").parquet(self.path)
        finally:
            self._remove(staged)
        self._changed()
        return n

    def insert_rows(self, rows: DataFrame, now: int | None = None) -> int:
        """SQL's INSERT: `_MAP` and promoted columns become one document; service columns may not be named."""
        from folioql.sources.documents import build_document

        if named := [c for c in rows.columns if c in SERVICE]:
            raise ValueError(f"the store assigns {', '.join(named)}")
        promoted = {c: F.col(c) for c in rows.columns if c != MAP}
        return self.insert(rows.select(build_document(F.col(MAP) if MAP in rows.columns else None, **promoted).alias("doc")), now=now)

    def delete_where(self, condition: Column, within: Column | None = None) -> int:
        """Documents for which the condition is true go; an unknown condition keeps its row.

        `within` is what the condition implies for stored columns: only files that meet it are read for hits.
        """
        return self._rewrite(condition, None, within=within)

    def replace_where(self, condition: Column, document: Column, now: int | None = None, within: Column | None = None) -> int:
        """Replace whole documents.  The new one keeps its key and id: changing either raises."""
        return self._rewrite(condition, document, now, within)

    def delete_item(self, document_id: str, *key_values) -> bool:
        return self.delete_where(F.col(ID) == document_id, self._at(key_values)) > 0

    def replace_item(self, document: Column, document_id: str, *key_values) -> bool:
        return self.replace_where(F.col(ID) == document_id, document, within=self._at(key_values)) > 0

    def _at(self, key_values) -> Column | None:
        at = None
        for part, v in enumerate(key_values):
            test = self.meta.in_parts(part, [key_literal(v)])
            at = test if at is None else at & test
        return at

    def delete_partition(self, *key_values) -> int:
        """Empty one whole partition: only its bucket is read and rewritten, by key columns."""
        if len(key_values) != len(self.meta.partition_columns) or not key_values:
            raise ValueError("the whole partition key is needed")
        return self.delete_where(F.lit(True), self._at(key_values))

    def read_items(self, ids, *key_values) -> list:
        """The documents of one partition with these ids, as rows; found through the lookup cache, absent ones not at all."""
        ids, place = sorted(set(ids)), tuple(map(key_literal, key_values))
        known = {i: self.cache.get((place, i)) for i in ids} if self.cache else {}
        missing = [i for i in ids if known.get(i) is None]
        if missing:
            found: dict = {i: [] for i in missing}
            for row in point_read_batch(self.df(), self.meta, missing, *key_values).collect():
                found[row[ID]].append(row)
            for i, rows in found.items():
                known[i] = rows
                if self.cache:
                    self.cache.put((place, i), rows)
        return [row for i in ids for row in known[i]]

    # -- copy on write

    def _rewrite(self, condition: Column, document: Column | None, now: int | None = None, within: Column | None = None) -> int:
        hit = F.coalesce(condition if within is None else condition & within, F.lit(False))
        rows = self.df()
        hits = rows.where(condition if within is None else within & condition)
        keyed = bool(self.meta.partition_key)
        counts = hits.groupBy(*([BUCKET] if keyed else [])).count().collect()
        n = sum(r["count"] for r in counts)
        if not n:
            return 0
        touched = [r[BUCKET] for r in counts] if keyed else None
        rows = rows.where(F.col(BUCKET).isin(*touched)) if keyed else rows  # other buckets are not written
        rows = rows.withColumn("_hit", hit)
        if document is None:
            kept = rows.where(~F.col("_hit"))
        else:
            new = F.to_variant_object(F.map_filter(F.try_variant_get(document, "$", "map<string,variant>"), lambda k, _: ~k.isin(*SERVICE)))
            rows = rows.withColumn("_new", F.when(F.col("_hit"), new))
            same = V.text(V.raw(F.col("_new"), ID)).eqNullSafe(F.col(ID))
            for p, c in zip(self.meta.key_paths, self.meta.partition_columns):
                same = same & (key_text(F.col("_new"), p) == F.col(c))
            body = F.when(~F.col("_hit"), F.col(MAP)).when(same, F.col("_new")).otherwise(F.raise_error(F.lit("a replaced document keeps its key and id")).cast("variant"))
            stamp = (F.lit(now) if now is not None else F.unix_timestamp()).cast("bigint")
            kept = rows.withColumn(MAP, body).withColumn(TS, F.when(F.col("_hit"), stamp).otherwise(F.col(TS))).withColumn(ETAG, F.md5(F.to_json(F.col(MAP)).cast("binary")))
            for p, c, kind in self.meta.promoted_columns:
                kept = kept.withColumn(c, V.cast_value(V.raw(F.col(MAP), *p.strip("/").split("/")), kind, safe=True))
        # the files it was read from are about to be replaced, so the new rows are written beside them first
        staged = f"{self.path.rstrip('/')}.staged-{uuid.uuid4()}"
        schema = self.stored().schema
        try:
            writer(kept.select(*schema.names), self.meta, "errorifexists").parquet(staged)
            rows = self.spark.read.schema(schema).parquet(staged)
            if keyed:
                # a bucket that is left without rows is not overwritten: its folder goes
                emptied = set(touched) - {r[0] for r in rows.select(BUCKET).distinct().collect()}
                writer(rows, self.meta, "overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)
                for bucket in emptied:
                    self._remove(f"{self.path.rstrip('/')}/{BUCKET}={bucket}")
            else:
                writer(rows, self.meta, "overwrite").parquet(self.path)
        finally:
            self._remove(staged)
        self._changed()
        return n

    def _stage(self, rows: DataFrame) -> str:
        at = f"{self.path.rstrip('/')}.staged-{uuid.uuid4()}"
        writer(rows, self.meta, "errorifexists").parquet(at)
        return at

    def _remove(self, at: str) -> None:
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(at)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def _changed(self) -> None:
        self.spark.catalog.refreshByPath(self.path)
        if self.cache is not None:
            self.cache.clear()
