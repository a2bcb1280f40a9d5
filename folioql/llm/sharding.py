"""Hilbert-curve sharding (operator 2): metadata dimensions quantised, rows in curve order, runs cut.

Each dimension becomes one of 2^bits cells between quantiles of the data: of strings themselves, and
otherwise of a number that keeps the order.  The Hilbert index of the cells orders the rows; rows of
one cell are ordered by a hash of their row.  The global rank comes from one range-partitioned sort
and a table of partition counts, and equal runs of ranks are the shards, so files are narrow in every
dimension at once and all `shards` counts are at most one apart.

Edge cases: null dimensions count as lower than all values; null texts have size 1 and the CRC of
nothing.  A hot value is only a wide cell: its rows are spread by the hash, never kept together.
Repeated rows, and rows of one id, spread as others do and get slots of their own.  An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioql.llm._common import cut

BITS = 5
#: Error bound of the quantiles, as a share of the rows.
ACCURACY = 1000


def hilbert_index(cells: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Position of grid cells along the Hilbert curve (Skilling 2004, transposed form, read bit by bit)."""
    x = [np.asarray(c, np.int64).copy() for c in cells]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where(x[n - 1] & q, turn ^ (q - 1), turn)
        q >>= 1
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = index << 1 | ((x[i] ^ turn) >> b & 1)
    return index


def ordinal(df: DataFrame, column: str) -> Column:
    """A long that keeps the order of a column's values (no strings); null is lowest."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        value = F.col(column).cast("double")
        value = F.when(F.isnan(value), F.lit(2**62)).otherwise(F.floor(F.least(F.greatest(value, F.lit(-1e15)), F.lit(1e15)) * 1000)).cast("long")
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(F.col(column).cast("timestamp"))
    else:
        value = F.col(column).cast("long")
    return F.coalesce(value, F.lit(-(2**62)))


def _at_most(value: Column):
    return lambda c: c <= value


def string_cuts(df: DataFrame, column: str, cells: int) -> list[str]:
    """The quantiles of a string column at 1/cells, 2/cells and so on, by whole values; nulls are lowest and never a cut.

    Distinct values are counted and sorted by range; the driver gets a row a partition and at most `cells` values.
    """
    partitions = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counted = df.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    counted = cut(counted.repartitionByRange(partitions, "v").sortWithinPartitions("v").withColumn("_p", F.spark_partition_id()))
    sums = {r["_p"]: r["n"] for r in counted.groupBy("_p").agg(F.sum("n").alias("n")).collect()}
    before, total = [], 0
    for p in sorted(sums):
        before.append((p, total))
        total += sums[p]
    if not total:
        return []
    starts = df.sparkSession.createDataFrame(before, "_q int, _before long")
    own = F.sum("n").over(Window.partitionBy("_p").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counted.withColumn("_own", own).join(F.broadcast(starts), F.col("_p") == F.col("_q")).withColumn("_up", F.col("_before") + F.col("_own"))
    crossed = F.expr(f"least((_up * {cells}) div {total}, {cells - 1}) > ((_up - n) * {cells}) div {total}")
    return sorted(r["v"] for r in ranked.where(crossed & F.col("v").isNotNull()).select("v").collect())


def with_curve(df: DataFrame, dimensions: Sequence[str], bits: int = BITS, name: str = "curve") -> DataFrame:
    """`df` with its Hilbert index over `dimensions`."""
    cells = 1 << bits
    shares = F.array(*(F.lit(k / cells) for k in range(1, cells)))
    strings = {d for d in dimensions if isinstance(df.schema[d].dataType, T.StringType)}
    numbers = [d for d in dimensions if d not in strings]
    found = df.agg(*(F.percentile_approx(ordinal(df, d), shares, F.lit(ACCURACY)) for d in numbers)).first() if numbers else ()
    bounds = dict(zip(numbers, found))
    grid = []
    for d in dimensions:
        cuts = string_cuts(df, d, cells) if d in strings else sorted(set(bounds[d] or []))
        # few values: a cell for each, spread over the axis, so that all bits of the curve count
        spread = max(1, cells // (len(cuts) + 1))
        value, kind = (F.col(d), "array<string>") if d in strings else (ordinal(df, d), "array<long>")
        passed = F.size(F.filter(F.array(*map(F.lit, cuts)).cast(kind), _at_most(value)))
        grid.append(passed * spread)
    curve = F.pandas_udf(lambda *x: pd.Series(hilbert_index([c.to_numpy() for c in x], bits)), T.LongType())
    return df.withColumn(name, curve(*grid))


def with_rank(df: DataFrame, *order: str, name: str = "rank") -> tuple[DataFrame, int]:
    """`df` with its 0-based rank in `order`, and the row count.  `df` is written once in that order."""
    spark = df.sparkSession
    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ordered = cut(ordered)
    part = F.shiftright(F.col("_at"), 33)
    # one row a partition
    counts = {r["p"]: r["n"] for r in ordered.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    before, total = {}, 0
    for p in sorted(counts):
        before[p], total = total, total + counts[p]
    starts = spark.createDataFrame([(p, b) for p, b in before.items()] or [(0, 0)], "_p long, _before long")
    ranked = ordered.join(F.broadcast(starts), part == F.col("_p"))
    return ranked.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_p", "_before"), total


def hilbert_shards(docs: DataFrame, dimensions: Sequence[str] = ("lang", "source", "n_chars"), shards: int = 8, id_column: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard and curve of every row."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_column), *(F.col(d).alias(f"_d{k}") for k, d in enumerate(dimensions)), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    rows = cut(rows).withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))  # of the written table: the same on every run
    curved = with_curve(rows, [f"_d{k}" for k in range(len(dimensions))], bits).drop(*(f"_d{k}" for k in range(len(dimensions))))
    ranked, total = with_rank(curved, "curve", "_tie")
    # shard k holds the ranks from ceil(k * total / shards) on
    shard = F.expr(f"(rank * {shards}) div {max(1, total)}")
    return (
        ranked.withColumn("shard", shard.cast("int"))
        .withColumn("slot", (F.col("rank") - F.expr(f"(shard * {total} + {shards - 1}) div {shards}")).cast("long"))
        .select(id_column, "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")
    )


def write_shards(docs: DataFrame, path: str, dimensions: Sequence[str] = ("lang", "source", "n_chars"), bits: int = BITS, files: int | None = None) -> None:
    """Write `docs` in curve order, a run of the curve a file, for min/max pruning on every dimension."""
    curved = with_curve(docs, dimensions, bits, "_curve")
    n = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    curved.repartitionByRange(n, "_curve", *dimensions).sortWithinPartitions("_curve").drop("_curve").write.mode("overwrite").parquet(path)
