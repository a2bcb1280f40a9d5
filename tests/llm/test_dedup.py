import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from folioql.llm import dedup
from folioql.llm._common import attach_groups


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    out = []
    for i, t, *_ in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return out


def test_against_brute_force(messy, rows):
    got = [tuple(r) for r in dedup.exact_duplicates(messy).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_stage_keeps_rows_and_columns(messy, rows, empty):
    kept = dedup.drop_exact_duplicates(messy)
    assert kept.columns == messy.columns
    want = [r for r, b in zip(rows, brute(rows)) if b[3]]
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert dedup.drop_exact_duplicates(empty).count() == 0 and dedup.exact_duplicates(empty).count() == 0


def test_chunks_are_lossless_and_local(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 9)))
    sentences = " ".join(word() + r.choice(["", "", "", ".", "!", "\n"]) for _ in range(20_000))
    unbroken = " ".join(word() for _ in range(20_000))
    texts = []
    for long in (sentences, unbroken):
        middle = len(long) // 2
        texts += [long, "new start. " + long, long[:middle] + "in the middle" + long[middle:], long[:middle] + long[middle + 30 :]]
    texts += ["", "y" * 20_000, "same line\n" * 3000, "...!!\n\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r[1] for r in sorted(df.select("i", dedup.chunks(F.col("t"))).collect())]
    assert ["".join(c) for c in got] == texts
    assert max(len(c) for cs in got for c in cs) <= dedup.MAX_CHARS
    for k in (0, 4):  # an edit changes the chunks around it, and no others
        assert len(got[k]) > len(texts[k]) / 4 / dedup.MEAN_CHARS
        for other in got[k + 1 : k + 4]:
            assert len(set(got[k]) - set(other)) <= 3 and len(set(other) - set(got[k])) <= 3


def test_fingerprint_clash_is_told_apart(spark, monkeypatch):
    # all chunks share one fingerprint: only the verified identifiers separate them
    monkeypatch.setattr(dedup.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c")], "doc_id long, text string")
    got = sorted(tuple(r)[:3] for r in dedup.exact_duplicates(df).collect())
    assert got == [(1, 3, 2), (2, 2, 1), (3, 3, 2), (4, 4, 1)]


def test_native_plan(messy):
    plan = dedup.exact_duplicates(messy)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_attach_groups_serves_hot_and_cold(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2003, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"))
    groups = rows.where("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("m"))
    got = attach_groups(rows, groups, "k", "n", 5000)
    assert got.count() == 5000 and got.where("k is null and n is null").count() == 3 and got.where("n = 2000 and m = 1999").count() == 2000 and got.where("n = 1 and m = id").count() == 2997
