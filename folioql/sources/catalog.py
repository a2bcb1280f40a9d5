"""Accounts, databases and containers by name, from a connection model; shared lookup caches."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from folioql.sources.container import ContainerMeta
from folioql.sources.dml import Container


class LookupCache:
    """Rows found for keys, shared by lookups: expires after writing, bounded in rows; absence costs one row.

    A full cache drops what has expired and then declines.  Any write to the container clears it.
    """

    def __init__(self, max_rows: int = 10_000, expire_seconds: float = 60.0, clock=time.monotonic):
        self.max_rows, self.expire, self.clock = max_rows, expire_seconds, clock
        self.entries: dict = {}
        self.rows = 0

    def get(self, key):
        """The rows of a key (maybe none), or None when it is not known."""
        found = self.entries.get(key)
        if found is None or found[0] <= self.clock():
            return None
        return found[1]

    def put(self, key, rows: list) -> bool:
        cost = max(1, len(rows))
        self._drop(key)
        if self.rows + cost > self.max_rows:
            for k in [k for k, (until, _) in self.entries.items() if until <= self.clock()]:
                self._drop(k)
        if self.rows + cost > self.max_rows:
            return False
        self.entries[key] = (self.clock() + self.expire, rows)
        self.rows += cost
        return True

    def _drop(self, key) -> None:
        if key in self.entries:
            self.rows -= max(1, len(self.entries.pop(key)[1]))

    def clear(self) -> None:
        self.entries.clear()
        self.rows = 0


class Catalog:
    """Databases of containers.  Names resolve as `container`, `database.container` or registered views."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.databases: dict[str, dict[str, Container]] = {}
        self.views: dict[str, object] = {}
        self.counts: dict[str, tuple[float, int]] = {}

    @classmethod
    def from_model(cls, spark: SparkSession, model: Mapping) -> Catalog:
        """`databases` -> `containers` (path, partitionKey, compositeIndexes, includedPaths, excludedPaths, promoted), `csv` sources and `views`."""
        catalog = cls(spark)
        limit, expire = model.get("lookupCacheMaxRows"), model.get("lookupCacheExpireSeconds", 60.0)
        for database, spec in model.get("databases", {}).items():
            for name, c in spec.get("containers", {}).items():
                composite = tuple(tuple((e["path"], e.get("order", "asc")) for e in i) for i in c.get("compositeIndexes", ()) if len(i) > 1)
                strip = lambda ps: tuple(ps)
                meta = ContainerMeta(name, tuple(c.get("partitionKey", ())), composite, strip(c.get("includedPaths", ("/*",))), strip(c.get("excludedPaths", ())), dict(c.get("promoted", {})), c.get("buckets", ContainerMeta.buckets))
                catalog.add(database, Container(spark, meta, c["path"], LookupCache(limit, expire) if limit else None))
        for name, source in model.get("csv", {}).items():
            catalog.views[name.lower()] = spark.read.csv(source["path"], header=True, schema=source["schema"])
        for name, text in model.get("views", {}).items():
            catalog.views[name.lower()] = text
        return catalog

    def add(self, database: str, container: Container) -> None:
        self.databases.setdefault(database, {})[container.meta.name] = container

    def add_view(self, name: str, source: DataFrame | str) -> None:
        """A DataFrame, or a statement that is planned where the view is used."""
        self.views[name.lower()] = source

    def container(self, *name: str) -> Container | None:
        if len(name) == 2:
            return self.databases.get(name[0], {}).get(name[1])
        found = [d[name[0]] for d in self.databases.values() if name[0] in d]
        if len(found) > 1:
            raise ValueError(f"{name[0]} is in several databases")
        return found[0] if found else None

    def document_count(self, container: Container, expire_seconds: float = 300.0) -> int:
        """Documents in a container, remembered for a while."""
        known = self.counts.get(container.path)
        if known is None or known[0] <= time.monotonic():
            known = (time.monotonic() + expire_seconds, container.stored().count())
            self.counts[container.path] = known
        return known[1]

    def register_views(self) -> None:
        """Every container as a temporary view `database__container` (and by its own name where that is free)."""
        seen: dict[str, int] = {}
        for containers in self.databases.values():
            for name in containers:
                seen[name] = seen.get(name, 0) + 1
        for database, containers in self.databases.items():
            for name, c in containers.items():
                c.df().createOrReplaceTempView(f"{database}__{name}")
                if seen[name] == 1:
                    c.df().createOrReplaceTempView(name)
