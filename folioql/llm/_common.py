"""Helpers that several operators share: the shared folder, lineage cuts, skew-proof lookups."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one is set only on a local master that names none (tests)."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="folioql-"))
    return named or context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder once and continue from the written copy."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, for sessions started without it on their workers' path."""
    context = spark.sparkContext
    if not getattr(context, "_folioql_shipped", False):
        root = Path(__file__).resolve().parents[1]
        at = Path(tempfile.mkdtemp(prefix="folioql-")) / "folioql.zip"
        with zipfile.ZipFile(at, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        context.addPyFile(str(at))
        context._folioql_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table by name; the path is only handed to Spark's reader."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A group that holds at least 1/HOT_SHARE of all rows is hot; there are at most HOT_SHARE such groups.
HOT_SHARE = 1000


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left-join `groups` (one row per `key`, with row count `size`) to `rows` without a hot reducer.

    Groups with `size` * HOT_SHARE >= `total` are at most HOT_SHARE by counting, so they are
    broadcast; rows that found theirs get a key of their own in the shuffled join with the others,
    which leaves no key with more than `total` / HOT_SHARE rows.  Null keys find nothing.
    """
    values = [c for c in groups.columns if c != key]
    is_hot = F.col(size) * HOT_SHARE >= F.lit(total)
    hot = groups.where(is_hot).select(F.col(key).alias("_hk"), F.struct(*values).alias("_hot"))
    cold = groups.where(~is_hot).select(F.col(key).alias("_ck"), F.struct(*values).alias("_cold"))
    rows = rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hk")), "left")
    # rows already served, and null keys, are dealt out by a salt and meet nothing
    rows = rows.withColumn("_jk", F.when(F.col("_hk").isNull(), F.col(key)))
    rows = rows.withColumn("_js", F.when(F.col("_jk").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1)))
    found = rows.join(cold.withColumn("_s", F.lit(-1).cast("long")), (F.col("_jk") == F.col("_ck")) & (F.col("_js") == F.col("_s")), "left")
    picked = [F.coalesce(F.col(f"_hot.{c}"), F.col(f"_cold.{c}")).alias(c) for c in values]
    plain = [c for c in rows.columns if c not in ("_hk", "_hot", "_jk", "_js")]
    return found.select(*plain, *picked)


_SLOT: dict = {}


def worker_slot(key, make):
    """What a Python worker keeps between tasks: one operator's state at a time, so that memory does not add up."""
    if key not in _SLOT:
        _SLOT.clear()
        _SLOT[key] = make()
    return _SLOT[key]


def crc32_text(column: Column | str) -> Column:
    """Unsigned CRC-32 of a column's text form (null counts as empty)."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def batches_of(batch, *names: str):
    """Python lists of the named columns of an Arrow record batch."""
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """`names`, lengthened where a column of `df` has them already (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def most_frequent(df: DataFrame, count: str, limit: int) -> DataFrame:
    """The rows of highest `count`, at most `limit` of them, without a global sort.

    Counts fall into 16 buckets an octave (some hundred in all); whole buckets are taken from the
    top while they fit.  The cut depends on counts alone, so it is the same on every run.
    """
    bucket = F.floor(F.log2(F.greatest(F.col(count), F.lit(1)).cast("double")) * 16)
    sizes = {r["b"]: r["n"] for r in df.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()}
    taken, lowest = 0, None
    for b in sorted(sizes, reverse=True):
        if taken + sizes[b] > limit:
            break
        taken, lowest = taken + sizes[b], b
    return df.where(bucket >= lowest) if lowest is not None else df.limit(0)
