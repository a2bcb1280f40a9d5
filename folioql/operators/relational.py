"""Grouping, distinct, sorting, joins, set operations and traversal over document values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioql.functions import values as V

#: A lookup side of up to so many bytes (by the optimizer's estimate, which counts files as they are) is broadcast.
BROADCAST_BYTES = 16 << 20
#: Ranges of time into which an as-of join cuts its keys.
TIME_RANGES = 64


def is_document(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.VariantType)


def comparable(df: DataFrame, column: str) -> Column:
    """What groups and joins compare: the canonical key of a document value, other columns as they are."""
    return V.canon_key(F.col(f"`{column}`")) if is_document(df, column) else F.col(f"`{column}`")


def _quoted(column: str) -> Column:
    return F.col(f"`{column}`")


def unnest(df: DataFrame, array: Column, name: str = "element", outer: bool = False, ordinal: str | None = None) -> DataFrame:
    """Each row with each element of an array value; absent and non-array values give no row (one when `outer`).  Ordinals count from 1."""
    elements = V.array(array)
    if ordinal:
        f = F.posexplode_outer if outer else F.posexplode
        return df.select("*", f(elements).alias(ordinal, name)).withColumn(ordinal, F.col(ordinal) + 1)
    return df.select("*", (F.explode_outer if outer else F.explode)(elements).alias(name))


def group(df: DataFrame, keys: Mapping[str, Column], aggregates: Sequence[Column], how: str = "groupBy", sets: Sequence[Sequence[str]] | None = None, document_keys: Sequence[str] = ()) -> DataFrame:
    """Aggregate by document values; null and absent are one group.

    Values are grouped by canonical key, and any value of the group stands for it.  `how` is groupBy,
    rollup, cube or groupingSets.
    """
    keyed = df.select("*", *(V.canon_key(c).alias(f"_k_{n}") if n in document_keys else c.alias(f"_k_{n}") for n, c in keys.items()), *(c.alias(f"_v_{n}") for n, c in keys.items() if n in document_keys))
    names = [F.col(f"_k_{n}") for n in keys]
    if how == "groupingSets":
        grouped = keyed.groupingSets([[F.col(f"_k_{n}") for n in s] for s in sets or []], *names)
    else:
        grouped = getattr(keyed, how)(*names)
    shown = [F.first(f"_v_{n}", ignorenulls=True).alias(f"_v_{n}") for n in keys if n in document_keys]
    flags = [F.grouping(f"_k_{n}").alias(f"_g_{n}") for n in keys if n in document_keys] if how != "groupBy" else []
    out = grouped.agg(*aggregates, *shown, *flags)
    columns = []
    for n in keys:
        if n not in document_keys:
            columns.append(F.col(f"_k_{n}").alias(n))
        else:
            value = F.col(f"_v_{n}")
            columns.append((F.when(F.col(f"_g_{n}") == 0, value) if flags else value).alias(n))
    rest = [c for c in out.columns if not c.startswith(("_k_", "_v_", "_g_"))]
    return out.select(*columns, *rest)


def group_by_partials(df: DataFrame, keys: Mapping[str, Column], partials: Sequence[Column], merged: Sequence[Column], how: str, sets: Sequence[Sequence[str]] | None = None, document_keys: Sequence[str] = (), distinct: Sequence[str] = ()) -> DataFrame:
    """`group` in two steps: the finest groups first, then the grouping sets over these few rows.

    Grouping sets expand every input row once per set before they aggregate; so they had better not
    be rows of the table.  `merged` reads the columns that `partials` make, and those of `distinct`,
    by whose values the finest groups are also split.
    """
    finest = group(df, {**keys, **{n: F.col(n) for n in distinct}}, partials, "groupBy", None, document_keys)
    return group(finest, {n: F.col(n) for n in keys}, merged, how, sets, document_keys)


def rollup_by_partials(df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """ROLLUP of sums over plain columns in two steps."""
    return group_by_partials(df, {k: F.col(k) for k in keys}, [F.sum(c).alias(n) for n, c in sums.items()], [F.sum(n).alias(n) for n in sums], "rollup")


def distinct(df: DataFrame, *columns: str) -> DataFrame:
    """DISTINCT with document values, by their canonical keys."""
    columns = columns or tuple(df.columns)
    if not any(is_document(df, c) for c in columns):
        return df.select(*map(_quoted, columns)).distinct()
    keyed = df.select(*map(_quoted, columns), *(comparable(df, c).alias(f"_k{i}") for i, c in enumerate(columns)))
    return keyed.dropDuplicates([f"_k{i}" for i in range(len(columns))]).select(*map(_quoted, columns))


def order(df: DataFrame, *keys: tuple[Column, str] | tuple[Column, str, str]) -> list[Column]:
    """Sort columns with SQL's placement of nulls: last when ascending, first when descending, unless said."""
    out = []
    for column, direction, *nulls in keys:
        place = nulls[0] if nulls else ("last" if direction == "asc" else "first")
        out.append(getattr(column, f"{direction}_nulls_{place}")())
    return out


def page(df: DataFrame, offset: int = 0, fetch: int | None = None) -> DataFrame:
    if offset < 0 or (fetch is not None and fetch < 0):
        raise ValueError("offset and fetch are not negative")
    df = df.offset(offset) if offset else df
    return df if fetch is None else df.limit(fetch)


def lookup_side(df: DataFrame, how: str = "inner") -> DataFrame:
    """The right side of a join, broadcast where the join allows it and the optimizer's size estimate is small.

    Beyond that, keys are shuffled, and adaptive execution splits skewed ones.
    """
    return F.broadcast(df) if how in ("inner", "left", "left_semi", "left_anti") and size_estimate(df) <= BROADCAST_BYTES else df


def lookup_join(build: DataFrame, probe: DataFrame, build_key: str, probe_key: str, how: str = "inner") -> DataFrame:
    """Keyed lookup: numbers match as doubles, null keys never match."""
    b = build.withColumn("_bk", lookup_key(build, build_key))
    p = probe.withColumn("_pk", lookup_key(probe, probe_key))
    how = {"left": "right", "right": "left"}.get(how, how)
    return p.join(lookup_side(b, how), F.col("_pk") == F.col("_bk"), how).drop("_pk", "_bk")


def lookup_key(df: DataFrame, column: str) -> Column:
    c = _quoted(column)
    return V.canon_key(c) if is_document(df, column) else V.plain_key(c, df.schema[column].dataType.simpleString())


def size_estimate(df: DataFrame) -> int:
    """Bytes of a plan by Catalyst's statistics."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def as_of_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, on: Sequence[str]) -> DataFrame:
    """Each left row with the last right row of its key at or before it: no pair explosion, and no task for a whole hot key.

    Both sides are cut at the same times into ranges.  A window finds the last right row within its key
    and range; what earlier ranges leave (a row for each key and range) is carried over.
    """
    values = [c for c in right.columns if c not in on]
    both = left.select("*", F.col(left_time).alias("_t"), F.lit(1).alias("_side"), *(F.lit(None).cast(right.schema[c].dataType).alias(f"_r_{c}") for c in values)).unionByName(
        right.where(F.col(right_time).isNotNull()).select(*on, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), *(F.col(c).alias(f"_r_{c}") for c in values)), allowMissingColumns=True
    )
    tick = F.unix_micros(F.col("_t").cast("timestamp")) if both.schema["_t"].dataType.typeName() in ("date", "timestamp", "timestamp_ntz") else F.col("_t").cast("double")
    cuts = sorted(set(both.agg(F.percentile_approx(tick, [k / TIME_RANGES for k in range(1, TIME_RANGES)], 1000)).first()[0] or ()))
    ahead = F.when(tick.isNotNull(), F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < tick))) if cuts else F.lit(0)
    both = both.withColumn("_range", F.coalesce(ahead, F.lit(0)))
    row = F.when(F.col("_side") == 0, F.struct(*(f"_r_{c}" for c in values)))
    w = W.partitionBy(*on, "_range").orderBy("_t", "_side").rowsBetween(W.unboundedPreceding, 0)
    found = both.withColumn("_m", F.last(row, ignorenulls=True).over(w)).where("_side = 1")
    last = both.where("_side = 0").groupBy(*on, "_range").agg(F.max_by(row, F.struct("_t", *(f"_r_{c}" for c in values if _orders(right.schema[c].dataType)))).alias("_last"))
    # a left row needs what the ranges before its own leave: rows for each key and range only
    needed = found.select(*on, "_range").distinct().withColumn("_last", F.lit(None).cast(last.schema["_last"].dataType)).withColumn("_need", F.lit(True))
    steps = needed.unionByName(last.withColumn("_need", F.lit(False)))
    earlier = W.partitionBy(*on).orderBy("_range").rangeBetween(W.unboundedPreceding, -1)
    carried = steps.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier)).where("_need").select(*(F.col(k).alias(f"_c_{k}") for k in on), F.col("_range").alias("_c_range"), "_carried")
    same = F.col("_range") == F.col("_c_range")
    for k in on:
        same = same & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    out = found.join(carried, same, "left").withColumn("_m", F.coalesce("_m", "_carried"))
    return out.select(*left.columns, *(F.col(f"_m._r_{c}").alias(c if c not in left.columns else f"right_{c}") for c in values))


def _orders(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.VariantType, T.MapType, T.ArrayType, T.StructType))


def set_operation(a: DataFrame, b: DataFrame, how: str, every: bool = False) -> DataFrame:
    """UNION, INTERSECT and EXCEPT [ALL]; document values are compared by canonical key."""
    b = b.toDF(*a.columns)
    if how == "union":
        both = a.union(b)
        return both if every else distinct(both)
    operation = {"intersect": "intersectAll" if every else "intersect", "except": "exceptAll" if every else "subtract"}[how]
    if not any(is_document(a, c) for c in a.columns):
        return getattr(a, operation)(b)
    # the operation on keys, and one row of `a` for each key that is left
    keys = [f"_k{i}" for i in range(len(a.columns))]
    keyed = lambda df: df.select(*(comparable(df, c).alias(k) for c, k in zip(df.columns, keys)))
    left = getattr(keyed(a), operation)(keyed(b))
    rows = a.select(*(comparable(a, c).alias(f"_a{k}") for c, k in zip(a.columns, keys)), *(_quoted(c).alias(f"_v{k}") for c, k in zip(a.columns, keys))).dropDuplicates([f"_a{k}" for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_a{k}"))
    return left.join(rows, same).select(*(F.col(f"_v{k}").alias(c) for c, k in zip(a.columns, keys)))
