"""Full-text search, ranking and vectors.

Definitions: tokens are lower-cased runs of letters and digits; BM25 with k1 = 1.2, b = 0.75 and
idf = ln(1 + (N - df + 0.5) / (df + 0.5)) (Robertson and Zaragoza 2009); reciprocal rank fusion with
k = 60 (Cormack et al. 2009).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K1, B, RRF_K = 1.2, 0.75, 60


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _words(keywords: Sequence[str]) -> Column:
    return F.array(*(F.lower(F.lit(k)) for k in keywords))


def contains(text: Column, keyword: str) -> Column:
    return F.array_contains(tokens(text), keyword.lower())


def contains_all(text: Column, *keywords: str) -> Column:
    return F.when(text.isNotNull(), F.size(F.array_except(_words(keywords), tokens(text))) == 0)


def contains_any(text: Column, *keywords: str) -> Column:
    return F.arrays_overlap(tokens(text), _words(keywords))


def with_bm25(df: DataFrame, text: str, keywords: Sequence[str], name: str = "score") -> DataFrame:
    """`df` with the BM25 score of a text column.

    The statistics are one aggregate over the column (a row to the driver); scoring is a projection.
    """
    words = sorted({k.lower() for k in keywords})
    taken = {c.lower() for c in df.columns}
    held = next(n for n in ("_counts" + "_" * k for k in range(len(taken) + 1)) if n.lower() not in taken)
    # the tokens of a text are found once, for its length and for all key words
    counts = lambda ts: F.struct(F.size(ts).alias("n"), *(F.size(F.filter(ts, _equals(w))).alias(f"t{k}") for k, w in enumerate(words)))
    df = df.withColumn(held, F.get(F.transform(F.array(tokens(F.col(text))), counts), F.lit(0)))
    length = F.when(F.col(text).isNotNull(), F.col(f"{held}.n"))
    tf = [F.when(F.col(text).isNotNull(), F.col(f"{held}.t{k}")).otherwise(0) for k in range(len(words))]
    stats = df.agg(F.count(length).alias("docs"), F.avg(length).alias("mean"), *(F.count_if(t > 0).alias(f"d{k}") for k, t in enumerate(tf)))
    row = stats.first()
    docs, mean = row["docs"], row["mean"] or 1.0
    score = F.lit(0.0)
    for k, t in enumerate(tf):
        idf = F.log1p(F.lit((docs - row[f"d{k}"] + 0.5) / (row[f"d{k}"] + 0.5)))
        score = score + idf * t * (K1 + 1) / (t + K1 * (1 - B + B * length / F.lit(mean)))
    return df.withColumn(name, F.coalesce(score, F.lit(0.0))).drop(held)


def _equals(word: str):
    return lambda t: t == word


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays of numbers; NULL for a null, or when the lengths differ."""
    product = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.when(F.size(a) == F.size(b), product(a, b) / F.sqrt(product(a, a) * product(b, b)))


def dot(a: Column, b: Column) -> Column:
    return F.when(F.size(a) == F.size(b), F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v))


def euclidean(a: Column, b: Column) -> Column:
    return F.when(F.size(a) == F.size(b), F.sqrt(F.aggregate(F.zip_with(a, b, lambda p, q: (p.cast("double") - q.cast("double")) * (p.cast("double") - q.cast("double"))), F.lit(0.0), lambda s, v: s + v)))


def vector_distance(a: Column, b: Column, metric: str = "cosine") -> Column:
    return {"cosine": cosine, "dotproduct": dot, "euclidean": euclidean}[metric](a, b)


def rank_by(df: DataFrame, score: Column, limit: int, *ties: str) -> DataFrame:
    """The `limit` rows of highest score, without the score (a top-k, never a full sort)."""
    name = "_score"
    return df.withColumn(name, score).orderBy(F.col(name).desc_nulls_last(), *ties).limit(limit).drop(name)


#: Ranks are counted in about so many ranges of scores.
RANGES = 200


def with_rank(df: DataFrame, score: str, name: str, depth: int | None = None) -> DataFrame:
    """`df` with one more than the number of rows of higher `score` (NULL without a score, or beyond `depth`).

    Scores are counted, and the distinct ones cut into ranges at approximate quantiles; a range's rows
    ahead are known from the counts of the ranges above it (a few numbers), so each range is ordered
    by itself and no task sees all scores.
    """
    steps = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("_v")).agg(F.count("*").alias("_n"))
    if depth is not None:
        steps = steps.orderBy(F.desc("_v")).limit(depth)
    cuts = sorted(set(steps.agg(F.percentile_approx("_v", [k / RANGES for k in range(1, RANGES)], 10_000)).first()[0] or ()))
    range_ = F.size(F.filter(F.array(*(F.lit(c) for c in cuts)), lambda c: c < F.col("_v"))) if cuts else F.lit(0)
    steps = steps.withColumn("_range", range_)
    sizes = {r["_range"]: r["n"] for r in steps.groupBy("_range").agg(F.sum("_n").alias("n")).collect()}
    above = [sum(n for r, n in sizes.items() if r > k) for k in range(len(cuts) + 1)]
    within = F.coalesce(F.sum("_n").over(W.partitionBy("_range").orderBy(F.desc("_v")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranks = steps.select("_v", (F.get(F.array(*(F.lit(n).cast("long") for n in above)), F.col("_range")) + within + 1).alias(name))
    return df.join(ranks, F.col(score) == F.col("_v"), "left").drop("_v")


def fuse(df: DataFrame, scores: Sequence[str], limit: int | None = None, ties: Sequence[str] = (), weights: Sequence[float] | None = None, name: str = "score", depth: int | None = None) -> DataFrame:
    """Reciprocal rank fusion of score columns: the fused score of every row, or the `limit` best rows.

    A document's rank is one more than the number of documents with a higher score (equal scores,
    equal ranks).  With `depth`, each list is its `depth` best scores (the usual retrieval depth) and
    the rest count as unranked.
    """
    weights = weights or [1.0] * len(scores)
    fused = F.lit(0.0)
    for k, (s, w) in enumerate(zip(scores, weights)):
        df = with_rank(df, s, f"_r{k}", depth)
        fused = fused + F.coalesce(F.lit(float(w)) / (F.lit(RRF_K) + F.col(f"_r{k}")), F.lit(0.0))
    df = df.withColumn(name, fused).drop(*(f"_r{k}" for k in range(len(scores))))
    return df if limit is None else df.orderBy(F.col(name).desc(), *ties).limit(limit)
