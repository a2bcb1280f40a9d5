import os
import re
import textwrap
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioql.llm import langid, licenses, lm, sharding, wordhash


# --- licences ---


def brute_scan(rows):
    low = lambda t: "".join(c.lower() if c.isascii() else c for c in t)
    sets = licenses.template_words(licenses.TEMPLATES)
    out = []
    for i, t, *_ in rows:
        words = re.findall(licenses.WORD, low(t or ""))
        base = [(k, label) for label, p in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        found, best = set(), 0.0
        for line in low(t or "").split("\n"):
            own = set(re.findall(licenses.WORD, line))
            for label, ws in sets.items():
                c = len(own & set(ws)) / len(ws)
                if c >= 0.8 - 1e-9:
                    found.add(label)
                    best = max(best, c)
        labels = sorted({label for _, label in base})
        at = [k for k, _ in base]
        out.append((i, len(words), len(base), min(at, default=None), max(at, default=None), ",".join(labels), ",".join(sorted({*labels, *found})), 1.0 if base else best))
    return out


def test_license_scan(spark, messy, rows, empty):
    assert sorted(map(str, map(tuple, licenses.scan(messy).collect()))) == sorted(map(str, brute_scan(rows)))
    assert licenses.scan(empty).count() == 0
    texts = ["gnu general public license GNU  General-Public\nLICENSE", "ccby cc by, CC-BY cc\nby", "mit licensed MIT license apache license", "Redistribution and use in source and binary forms with modification are permitted provided that the following conditions are met", "released under license", "gnu general publicKicense"]
    more = [(k, t) for k, t in enumerate(texts)]
    got = licenses.scan(spark.createDataFrame(more, "doc_id long, text string")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_scan(more)))


def test_license_scan_is_native(messy):
    plan = licenses.scan(messy)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def brute_runs(text):
    """Labels and best containment by lines and by all runs of words up to a notice's longest run."""
    low = lambda t: "".join(c.lower() if c.isascii() else c for c in t)
    found, words = {}, re.findall(licenses.WORD, low(text))
    for label, ws in licenses.template_words(licenses.TEMPLATES).items():
        n = licenses.run_words(licenses.TEMPLATES[label])
        blocks = [re.findall(licenses.WORD, line) for line in low(text).split("\n")] + [words[k : k + n] for k in range(len(words))]
        best = max(len(set(b) & set(ws)) / len(ws) for b in blocks)
        if best >= 0.8 - 1e-9:
            found[label] = best
    return ",".join(sorted(found)), max(found.values(), default=0.0)


def test_wrapped_notices(spark):
    """Each notice at several widths, with comment marks, inside other text, and with words that lie too far apart."""
    r, texts = np.random.default_rng(4), []
    for label, notice in licenses.TEMPLATES.items():
        for width, mark in ((72, ""), (80, "# "), (30, " * "), (20, "dnl ")):
            wrapped = "\n".join(mark + x for x in textwrap.wrap(notice, width))
            texts += [(label, wrapped), (label, f"one two of the\n\n{wrapped}\n{'word in a ' * 30}")]
        texts.append((None, "\n".join(f"{w} {'x ' * 9}" for w in notice.split())))
    pool = sorted({w for t in licenses.TEMPLATES.values() for w in t.split()})
    texts += [(None, "\n".join(" ".join(r.choice(pool, 6)) for _ in range(n))) for n in (3, 60, 400)]
    texts.append(("mit-permission", "the software " * 3000 + textwrap.fill(licenses.TEMPLATES["mit-permission"], 60) + "\nthe" * 700))
    got = {x.doc_id: x for x in licenses.scan(spark.createDataFrame([(k, t) for k, (_, t) in enumerate(texts)], "doc_id long, text string"), phrases={"none": "no such phrase"}).collect()}
    for k, (label, t) in enumerate(texts):
        labels, best = brute_runs(t)
        assert got[k].labels == labels and abs(got[k].score - best) < 1e-9
        assert label is None or label in labels.split(",")


# --- sharding ---


@pytest.mark.parametrize("n,bits", [(2, 4), (3, 3)])
def test_hilbert_steps_to_neighbours(n, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
    index = sharding.hilbert_index(list(grid.T), bits)
    assert sorted(index) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


def test_shards(messy, rows, empty):
    got = sharding.hilbert_shards(messy).collect()
    assert sorted(map(str, ((r.doc_id, r.size, r.text_crc32) for r in got))) == sorted(map(str, ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)))
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sharding.hilbert_shards(empty).count() == 0


def test_files_prune_on_every_dimension(spark, tmp_path):
    df = spark.range(4096).select((F.col("id") % 64).alias("a"), F.floor(F.col("id") / 64).alias("b"))
    sharding.write_shards(df, str(tmp_path / "s"), ("a", "b"), files=16)
    spans = spark.read.parquet(str(tmp_path / "s")).groupBy(F.input_file_name()).agg(*(F.max(c) - F.min(c) for c in "ab")).collect()
    assert len(spans) == 16 and all(a < 48 and b < 48 for _, a, b in spans)


def test_long_common_prefixes_do_not_hide_a_dimension(spark, tmp_path):
    name = lambda c: F.concat(F.lit("https://example.org/source_"), F.lpad(c.cast("string"), 3, "0"))
    df = spark.range(4096).select(name(F.col("id") % 64).alias("a"), name(F.floor(F.col("id") / 64)).alias("b"))
    assert sharding.with_curve(df, ("a", "b")).select("curve").distinct().count() == 1024
    sharding.write_shards(df, str(tmp_path / "s"), ("a", "b"), files=16)
    number = lambda c: F.substring(c, -3, 3).cast("int")
    spans = spark.read.parquet(str(tmp_path / "s")).groupBy(F.input_file_name()).agg(*(F.max(number(F.col(c))) - F.min(number(F.col(c))) for c in "ab")).collect()
    assert len(spans) == 16 and all(a < 48 and b < 48 for _, a, b in spans)


def test_string_cuts(spark):
    values = [None] * 10 + ["a"] * 20 + [f"prefix-{k:02}" for k in range(50)]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
    want = sorted({values[-(-k * len(values) // 8) - 1] for k in range(1, 8)} - {None})
    assert sharding.string_cuts(df, "v", 8) == want
    assert sharding.string_cuts(df.limit(0), "v", 8) == []


# --- languages ---


def training(spark):
    words = {"en": "the and of with that", "de": "der und mit nicht sich", "ru": "это как что для они"}
    return spark.createDataFrame([(k, " ".join(w.split() * 5), lang) for k, (lang, w) in enumerate(list(words.items()) * 20)], "doc_id long, text string, lang string")


def test_language_spans(spark, messy, rows, empty):
    model = langid.fit(training(spark), F.lit(True))
    text = "the and of with that the of " * 3 + "der und mit nicht sich der " * 3 + "что они как"
    df = spark.createDataFrame([(1, text), (2, None), (3, "123 !?"), (4, "漢字")], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in langid.language_spans(df, model).collect()}
    assert [s.lang for s in spans[1]] == ["en", "de", "ru"] and spans[2] == spans[3] == []
    assert text[spans[1][1].start : spans[1][1].end].startswith("der und") and text[: spans[1][0].end].endswith("that the of")
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    assert got[1].lang_pred == "de" and 0 < got[1].score < 1 and got[2].lang_pred == got[3].lang_pred == "und" and got[3].score == 0 and got[4].lang_pred in ("de", "en", "ru")
    assert langid.identify(messy, model).count() == len(rows) and langid.identify(empty, model).count() == 0
    kept = langid.keep_identified(messy, model)
    assert kept.columns == messy.columns
    want = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, want))


def test_scripts_that_training_never_saw_are_rejected(spark):
    model = langid.fit(training(spark), F.lit(True))
    texts = ["漢字 漢字漢字", "漢字 the and of with that", "漢字漢字漢字漢字 the", "ελληνικά", "это как", "the", "漢漢 of", "123", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in langid.keep_identified(df, model).collect()) == [1, 4, 5, 6]
    assert langid.keep_identified(training(spark), model).count() == training(spark).count()


def test_language_without_training(spark, messy):
    model = langid.fit(training(spark), F.lit(False))
    assert {(r.lang_pred, r.score) for r in langid.identify(messy, model).collect()} == {("und", 0.0)}


def test_viterbi_against_plain_dynamic_programming():
    r = np.random.default_rng(2)
    lengths = np.array([5, 0, 1, 40, 17])
    scores = r.normal(0, 3, (lengths.sum(), 3)).astype(np.float32)
    labels = langid.viterbi(scores, lengths, 2.0)
    at = 0
    for n in lengths:
        own, path = scores[at : at + n].astype(float), labels[at : at + n]
        if n:
            best = own[0]
            for row in own[1:]:
                best = np.maximum(best, best.max() - 2.0) + row
            assert abs(best.max() - (own[np.arange(n), path].sum() - 2.0 * (np.diff(path) != 0).sum())) < 1e-6
        at += n


def test_language_query(spark):
    """The registered query on the supplied table: contract, split and held-out accuracy."""
    from folioql.llm import registry

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("needs the supplied tables")
    truth = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = registry.op10_language_spans(spark, folder).collect()
    learned = {r.lang for i, r in truth.items() if r.lang is not None and zlib.crc32(str(i).encode()) % 4 != 2}
    assert sorted(r.doc_id for r in got) == sorted(truth)
    right = total = 0
    for r in got:
        text, lang = truth[r.doc_id].text, truth[r.doc_id].lang
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not text or not any(c.isalpha() for c in text)) and r.lang_pred in {*learned, "und"}
        if r.held_out and lang in learned and r.lang_pred != "und":
            right, total = right + (r.lang_pred == lang), total + 1
    assert total > 20 and right >= 0.95 * total


def test_model_beats_the_base_on_held_out_texts(spark):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("needs the supplied tables")
    sums = lm.score(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert sums[0] > sums[1] + 0.1 * sums[2]


# --- language model ---


def streams():
    return [np.array([1, 2, 3] * 40 + [0], "<u2").tobytes() for _ in range(60)], np.bincount([*[1, 2, 3] * 2400, *[0] * 60], minlength=5).astype(float)


def test_model_is_normalised_and_learns():
    r = np.random.default_rng(1)
    model = lm.train(*streams(), dimensions=8, epochs=8)
    every = np.exp([[model.log_probabilities(np.array([a]), np.array([b]), np.array([c]))[0] for c in range(5)] for a, b in r.integers(0, 5, (20, 2))]).sum(axis=1)
    assert np.allclose(every, 1, atol=1e-4)
    assert np.exp(model.log_probabilities(np.array([1]), np.array([2]), np.array([3])))[0] > 0.8


def test_a_training_step_is_the_plain_gradient():
    """One batch, token by token in float64: the products that are shared by the tokens of a class change nothing."""
    r, n, size = np.random.default_rng(5), 9, 300
    before, last, target = r.integers(0, n, (3, size))
    noise = lm.noise_of(np.bincount(target, minlength=n).astype(float))
    for dimensions in (6, 5):
        start = lm.start(noise * size, dimensions, seed=3)
        got = {k: v.copy() for k, v in start.items()}
        touched = {k: np.zeros(n) for k in "rq"}
        lm.descend(got, before, last, target, noise, np.random.default_rng(8), touched)
        rng = np.random.default_rng(8)
        rng.permutation(np.zeros(size, np.uint64))
        drawn = np.searchsorted(np.cumsum(noise), rng.random(lm.NOISE) * noise.sum(), side="right")
        p = {k: v.astype(float) for k, v in start.items()}
        g = {k: np.zeros_like(p[k]) for k in lm.PARTS}
        for a, b, c in zip(before, last, target):
            context, back = p["m1"] @ p["r"][a] + p["m2"] @ p["r"][b], np.zeros(dimensions)
            for k, w in enumerate([c, *drawn]):
                d = 1 / (1 + np.exp(-(context @ p["q"][w] + p["bias"][w] - np.log(lm.NOISE * noise[w]))))
                pull = 1 - d if k == 0 else -d
                g["q"][w] += pull * context
                g["bias"][w] += pull
                back += pull * p["q"][w]
            g["r"][a] += p["m1"].T @ back
            g["r"][b] += p["m2"].T @ back
            g["m1"] += np.outer(back, p["r"][a])
            g["m2"] += np.outer(back, p["r"][b])
        for k in lm.PARTS:
            squares = p[f"+{k}"] + g[k] ** 2
            assert np.allclose(got[f"+{k}"], squares, rtol=2e-3, atol=1e-5) and np.allclose(got[k], p[k] + lm.RATE * g[k] / np.sqrt(squares), atol=2e-3), k
        assert (touched["q"] == np.bincount(target, minlength=n) + np.bincount(drawn, minlength=n)).all()
        assert (touched["r"] == np.bincount(before, minlength=n) + np.bincount(last, minlength=n)).all()


def test_hashing_holds_a_text_few_times_over():
    """Powers and sums of bytes are kept for a block, not for the whole group; the hashes are those of the definition."""
    size = wordhash.GROUP_BYTES + 2000
    text = (b"x" * 50 + b" ") * (size // 51)
    wordhash.Words([b"warm up"])
    tracemalloc.start()
    words = wordhash.Words([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * size and len(np.unique(words.hashes)) == 1
    odd = wordhash.Words([b"one " * 8192 + b"b" * 60, b"two\tthree", b""])
    for k in (0, 8191, 8192, 8193, 8194):
        plain = sum((byte + 1) * pow(wordhash.MULTIPLIER, i, 1 << 64) for i, byte in enumerate(odd.word(k))) + int(odd.lengths[k])
        assert wordhash.mix(np.array([plain % (1 << 64)], np.uint64))[0] == odd.hashes[k]


def words_of(text):
    return [*(text or "").encode().lower().split(), b""]  # the end last


def test_scores_against_brute_force(messy, rows, empty, monkeypatch):
    kept = {}
    train = lm.train_everywhere
    monkeypatch.setattr(lm, "train_everywhere", lambda *a, **k: kept.setdefault("model", train(*a, **k)))
    vocabulary = lm.vocabulary
    monkeypatch.setattr(lm, "vocabulary", lambda *a, **k: kept.setdefault("vocabulary", vocabulary(*a, **k)))
    got = lm.score(messy, known_words=30, classes=16, sample_tokens=5000).collect()
    model, vocab = kept["model"][0], kept["vocabulary"]
    counts = Counter()
    for i, t, *_ in rows:
        if zlib.crc32(str("" if i is None else i).encode()) % 5 != 1:
            counts.update(words_of(t))
    n, v = sum(counts.values()), len(counts)
    every = {w for _, t, *_ in rows for w in words_of(t)}
    # classes of single words go to the most frequent ones; the others follow their spelling
    singles = sorted((w for w in counts if w), key=lambda w: -counts[w])[: vocab.top - 1]
    floor = counts[singles[-1]]
    cls = {b"": 0}
    for w in every - {b""}:
        asked = lm.Words([w])
        number = int(vocab.index.find(asked.hashes, asked.signatures())[0])
        two = w[-2:] if len(w) > 1 else b"\0" + w
        cls[w] = int(vocab.cls[number]) if 0 <= number < vocab.top else int(vocab.spelled[two[0] << 9 | two[1] << 1 | (len(w) > 7)])
        assert (cls[w] < vocab.top) >= (counts[w] > floor) and (cls[w] >= vocab.top or counts[w] >= floor)
    shares = {}
    for w in every:
        if counts[w] and cls[w] >= vocab.top:
            shares.setdefault(cls[w], []).append(counts[w])
    contexts = {}

    def class_score(a, b, c):
        if (a, b) not in contexts:
            scores = (model.first[a] + model.second[b]).astype(float) @ model.words.T.astype(float) + model.bias
            contexts[a, b] = scores - np.log(np.exp(scores).sum())
        return contexts[a, b][c] / np.log(10)

    want = {}
    for i, t, *_ in rows:
        words = words_of(t)
        base = sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        chain = [0, 0, *(cls[w] for w in words)]
        score = sum(class_score(*chain[k : k + 3]) for k in range(len(words)))
        for w in words:
            if cls[w] >= vocab.top:
                inside = shares.get(cls[w], [])
                score += np.log10((counts[w] + 0.5) / (sum(inside) + 0.5 * (len(inside) + 1)))
        want.setdefault((i, len(words)), []).append((sum(counts[w] > 0 for w in words), base, score))
    assert len(got) == len(rows)
    for r in got:
        close = [x for x in want[r.doc_id, r.n_tokens] if abs(x[1] - r.base_score) < 1e-6 * max(1, abs(x[1]))]
        assert r.train_tokens == n and close and close[0][0] == r.n_known and abs(r.score - close[0][2]) < 1e-4 * max(1, abs(close[0][2]))
    assert lm.score(empty).count() == 0


def test_classes_grow_with_the_vocabulary(spark):
    def made(distinct):
        words = spark.range(distinct).selectExpr("id + 1 AS h", "id + 1 AS s", "2 + id % 5000 AS suffix", "1 + 100000 DIV (id + 1) AS n", "1 + 100000 DIV (id + 1) AS total")
        return lm.vocabulary(words)

    small, large = made(20_000), made(180_000)
    assert small.classes == 2 * 141 and large.classes == 2 * 424 and small.top < large.top
    for vocab in (small, large):  # every class is a distribution with room for one unseen word
        assert vocab.counts.sum() == vocab.tokens and len(np.unique(vocab.cls[: vocab.top])) == vocab.top


def test_every_training_text_reaches_the_model(spark):
    """Word order is only in texts that a sample by hash (here the lowest 0.2 of the hashes) would leave out."""
    r, words = np.random.default_rng(3), list("abcdef")
    ids = spark.range(4000).select("id", F.xxhash64("id").alias("h"), lm.held_out("id").alias("held")).collect()
    rows = [(x.id, " ".join(words * 8 if x.h >= -(2**63) + 0.2 * 2**64 else r.choice(words, 48))) for x in ids if not x.held]
    held = [x.id for x in ids if x.held][:2]
    docs = spark.createDataFrame([*rows, (held[0], " ".join(words * 8)), (held[1], " ".join(words[::-1] * 8))], "doc_id long, text string").coalesce(2)
    got = {x.doc_id: x.score for x in lm.score(docs, sample_tokens=30_000).where("held_out").collect()}
    assert got[held[0]] - got[held[1]] > 0.3 * 48


def test_passes_read_every_token(spark):
    texts, counts = streams()
    df = spark.createDataFrame([(bytearray(s),) for s in texts], "ids binary").repartition(3)
    model, read = lm.train_everywhere(df, counts, int(counts.sum()), share_tokens=2000, epochs=8)
    assert read == 8 * counts.sum()
    assert np.exp(model.log_probabilities(np.array([1]), np.array([2]), np.array([3])))[0] > 0.5
    model, read = lm.train_everywhere(df.limit(0), counts, 0)
    assert read == 0 and np.isfinite(model.normal).all()
