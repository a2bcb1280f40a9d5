import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from folioql.llm import packing, tokens, wordhash


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_file(vocabulary)


def test_encoder_equals_library(library, vocabulary):
    r = random.Random(5)
    texts = ["", None, "\x1c a\x1fb", "It's I'LL we've Σας ΑΣ", "a<|endoftext|>b <|startoftext|>", "́e é İstanbul ﬁ Ⅷ ½ 漢字", "ab" * 3000, "😀👩‍👩‍👧   x", "don't <|endoftext|", "՘Ᲊ Ǆ"]
    texts += ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(0x80, 0x3000), r.randrange(0x4E00, 0x9FFF), r.randrange(0x1F300, 0x1F700)])) for _ in range(r.randrange(1, 60))) for _ in range(800)]
    for lexicon in (None, tokens.compile_lexicon(["the", "of", "it", "漢字", "we"], vocabulary)):
        for text, (ids, shown) in zip(texts, tokens.Encoder(vocabulary, lexicon).encode_batch(texts)):
            want = library.encode(text or "", add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want
            assert shown == library.decode(want, skip_special_tokens=False) == tokens.decode(want, vocabulary)


def test_ids_by_hashes_equal_library(library, vocabulary, monkeypatch):
    r = random.Random(6)
    signs = "abcXYZ .,!?'-_<|>\"é ñÉİΣςßıǅ\u0301\u0308\x1c1290日本語\u2003\u2028\xa0\t\n"
    texts = ["", None, "x" * 5000 + " " + "xy" * 40, "a.b.. c''s D'LL", "<|endoftext|>a<|x|>", *("".join(r.choice(signs) for _ in range(r.randrange(60))) for _ in range(3000))]
    want = [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert list(tokens.IdEncoder(vocabulary, shown=False).ids_batch(texts)) == want
    monkeypatch.setattr(tokens, "MEMO_ENTRIES", 300)  # the memo is cut again and again
    small = tokens.IdEncoder(vocabulary, shown=False)
    assert [ids for k in range(0, len(texts), 50) for ids in small.ids_batch(texts[k : k + 50])] == want


def test_words_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(wordhash, "mix", lambda x: x % np.uint64(7))
    words = wordhash.Words([b"one two three four", b"two five six seven eight nine one"])
    hashes, first, _, kinds = words.distinct()
    assert len(hashes) == 9 and [words.words(first)[k] for k in kinds] == words.words(np.arange(len(words)))


def test_transducer_numbers_every_word(vocabulary):
    r = random.Random(3)
    words = sorted({"".join(r.choice("abcdé") for _ in range(r.randrange(1, 9))) for _ in range(3000)})
    automaton = tokens.Transducer(tokens.compile_lexicon(words, vocabulary))
    bpe = tokens.WordBpe(vocabulary)
    numbers = automaton.find([w.encode() for w in words])
    assert sorted(numbers) == list(range(len(words)))
    assert all(automaton.ids(n) == np.array(bpe.merge(w), "<u4").tobytes() for w, n in zip(words, numbers))
    assert (automaton.find([w.encode() + b"z" for w in words]) == -1).all() and automaton.find([b""])[0] == -1
    # suffixes are shared: far fewer edges than letters
    assert len(automaton.keys) < 0.5 * sum(len(w.encode()) for w in words)
    assert tokens.Transducer(tokens.build_transducer({})).find([b"a"])[0] == -1


@pytest.mark.parametrize("partitions", [1, 5])
def test_lexicon_counts_every_chunk(spark, vocabulary, monkeypatch, partitions):
    monkeypatch.setattr(tokens, "COUNTED", 10)  # a task hands its counts on again and again
    texts = [f"common and w{k % 50}x rare{k}q" for k in range(200)] + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(partitions)
    split = tokens.WordBpe(vocabulary).split
    words = lambda chunks: sorted({w for c in chunks for w in split(c)})
    assert tokens.frequent_words(docs, "text", vocabulary, 100) == words(["common", "and", *(f"w{k}x" for k in range(50))])
    assert tokens.frequent_words(docs, "text", vocabulary, 40) == words(["common", "and"])


def test_full_memo_changes_nothing(vocabulary, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_ENTRIES", 20)
    texts = [f"word{k} and {k % 7} more" for k in range(300)]
    small = list(tokens.Encoder(vocabulary).encode_batch(texts))
    monkeypatch.undo()
    assert small == list(tokens.Encoder(vocabulary).encode_batch(texts))


def test_queries_over_messy_rows(messy, rows, empty, library, vocabulary):
    got = tokens.encode_digests(messy, vocabulary, lexicon_words=50).collect()
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert tokens.encode_digests(empty, vocabulary).count() == 0
    assert tokens.encode(messy.where("doc_id = 4"), vocabulary).first().ids == library.encode("one two", add_special_tokens=False).ids


def test_packing_over_messy_rows(messy, rows, empty, library, vocabulary):
    got = packing.pack_documents(messy, vocabulary, max_tokens=256).collect()
    pieces = []
    for i, t, *_ in rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        pieces += [(i, k, low, len(ids[low : low + 256]), zlib.crc32(ids[low : low + 256].tobytes())) for k, low in enumerate(range(0, len(ids), 256))]
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, pieces))
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= 1 + -(-sum(p[3] for p in pieces) // 256) * 1.02
    assert packing.pack_documents(empty, vocabulary).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_constraint_holds(rule):
    r = np.random.default_rng(4)
    lengths = np.clip(np.exp(r.normal(4, 1.2, 3000)).astype(int), 1, 512)
    bins, offsets = packing.best_fit(lengths, 512, 5, 512 * 512, rule=rule)
    for b in np.unique(bins):
        own = lengths[bins == b]
        assert own.sum() <= 512 and len(own) <= 5 and (own.astype(float) ** 2).sum() <= 512 * 512
    loose, _ = packing.best_fit(lengths, 512, 512, 512 * 512, rule=rule)
    assert loose.max() + 1 <= -(-lengths.sum() // 512) + 2


def test_one_repeated_id_spreads_over_cells(spark):
    pieces = spark.range(40_000).selectExpr("7L AS doc_id", "0 AS piece", "0L AS start", "cast(1 + id % 90 AS long) AS length", "5L AS ids_crc32").repartition(3)
    got = packing.pack(pieces, max_tokens=256, cell_rows=8192).selectExpr("sequence_id >> 32 AS cell", "sequence_id", "length").collect()
    cells = [r.cell for r in got]
    assert len(got) == 40_000 and len(set(cells)) == 5 and max(cells.count(c) for c in set(cells)) < 10_000
    filled = {}
    for r in got:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert max(filled.values()) <= 256 and len(filled) <= 1.01 * -(-sum(r.length for r in got) // 256) + 5


def test_documents_and_attention_bind_where_they_are_smaller(spark):
    pieces = spark.range(2000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "cast(1 + id * 7 % 256 AS long) AS length", "id AS ids_crc32")
    got = packing.pack(pieces, max_tokens=512, max_documents=3, max_attention=300_000, weights=(1.0, 0.5, 0.5)).collect()
    filled = {}
    for r in got:
        filled.setdefault(r.sequence_id, []).append(r.length)
    assert max(map(len, filled.values())) == 3 and max(map(sum, filled.values())) <= 512
    assert max(sum(n * n for n in own) for own in filled.values()) <= 300_000
