import random

import pytest
from pyspark.sql import functions as F

from folioql.llm import ngram_join as nj
from folioql.llm.graph import connected_components


def brute(rows, n=5):
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)]) if w else frozenset()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holds = {}
    for i, s in sets.items():
        for z in s:
            holds.setdefault(z, []).append(i)
    for i, s in sets.items():
        shared = {}
        for z in s:
            for j in holds[z]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, k in shared.items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(2000)]
    bases = [[r.choice(vocabulary) for _ in range(r.randrange(20, 160))] for _ in range(20)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(500):
        words = list(r.choice(bases[:3] if r.random() < 0.7 else bases)) if r.random() < 0.8 else [r.choice(vocabulary) for _ in range(r.randrange(0, 80))]
        for _ in range(r.randrange(0, 6)):
            if words:
                words[r.randrange(len(words))] = r.choice(vocabulary)
        rows.append((i, " ".join(words + passage * (r.random() < 0.3))))
    return rows


@pytest.mark.parametrize("seed,block", [(1, 512), (2, 16)])
def test_against_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(nj, "BLOCK", block)
    rows = corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == brute(rows)


def test_edge_cases(messy, rows, empty):
    got = nj.components(messy).collect()
    assert len(got) == len(rows)
    want = brute([r for r in rows if r[0] is not None])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert nj.components(empty).count() == 0


def test_stage_keeps_one_of_each_component(messy, rows):
    kept = nj.keep_representatives(messy)
    assert kept.columns == messy.columns
    want = brute([r for r in rows if r[0] is not None])
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, (r[0] for r in rows if r[0] is None or want[r[0]][1] == r[0])))


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_blocks_hold_every_pair_of_like_sizes_once(spark, monkeypatch, percent):
    monkeypatch.setattr(nj, "BLOCK", 8)
    sizes = [1 + k * k // 9 for k in range(90)] + [4, 5] * 10
    rows = [(h, i, n, n, 0, i, len(sizes)) for h in (1, 2) for i, n in enumerate(sizes)] + [(3, 7, 10, 10, 0, 7, 2), (3, 8, 90, 90, 0, 8, 2)]
    postings = spark.createDataFrame(rows, "h long, id long, n long, shared long, place long, component long, c long")
    blocks = {}
    for r in nj.dealt_in_blocks(postings, percent).collect():
        blocks.setdefault((r.h, r.a, r.b), []).append((r.id, r.side))
    met = [(h, min(i, j), max(i, j)) for (h, *_), own in blocks.items() for x, (i, s) in enumerate(own) for j, t in own[:x] if s == 2 or s != t]
    like = {(h, i, j) for h in (1, 2) for j in range(len(sizes)) for i in range(j) if 100 * min(sizes[i], sizes[j]) >= percent * max(sizes[i], sizes[j])}
    assert len(met) == len(set(met)) and like | {(3, 7, 8)} <= set(met)
    assert max(map(len, blocks.values())) < 60 and (percent == 50 or len(met) < len(sizes) ** 2 / 2)


def test_long_path_is_one_component(spark):
    edges = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    got = connected_components(edges.union(spark.createDataFrame([(1000, 1001)], "u long, v long"))).collect()
    assert {r.node: r.component for r in got} == {**{k: 0 for k in range(201)}, 1000: 1000, 1001: 1000}


@pytest.mark.parametrize("buckets", [16, 64, 200])
def test_rows_of_many_small_batches_fill_all_buckets(buckets):
    dealt = [b for part in range(100) for b in nj._spread(part << 32, 100, buckets)]
    sizes = [dealt.count(b) for b in range(buckets)]
    assert max(sizes) < 2 * len(dealt) / buckets and min(sizes) > len(dealt) / buckets / 2
    first = {nj._spread(part << 32, 1, buckets)[0] for part in range(20 * buckets)}
    assert len(first) == buckets


def test_long_words_of_a_pattern_keep_apart():
    bits = "0"
    while len(bits) < 4096:  # a word and its mirror whose polynomials agree modulo 2^64
        bits += bits.translate({48: "1", 49: "0"})
    a, b = bits, bits.translate({48: "1", 49: "0"})
    (x, _), (y, _) = nj.shingle_sets([a, b])
    assert list(x) != list(y)
