"""BPE encoding and decoding with a minimal acyclic transducer lexicon (operator 7).

The words of the most frequent chunks, counted over all texts, are compiled on the driver into a shared-suffix automaton
whose path sums number its words (a perfect hash), and the numbers point to id sequences.  The
automaton is one flat byte string of bounded size (`lexicon_words`); executors get it as a
broadcast and memory-map a private, already unlinked copy.  Words that it does not hold are merged
exactly by the tokenizer file's merge ranks.  The lexicon only saves merging: results never depend on it.

The vocabulary is a `tokenizers` JSON file of the word-end BPE kind: NFC, white space collapsed,
lower case per character, byte-level symbols, a suffix on the last symbol of a word.

Edge cases: null and empty texts give no ids, and the digests of the empty string.  Texts of any
length are encoded whole.  Strings of special tokens in a text become their ids, as the library
does.  Repeated rows give repeated rows; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import mmap
import re
import struct
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import batched, chain, compress, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioql.llm._common import batches_of, cut, most_frequent, worker_slot
from folioql.llm.wordhash import Index, Words, grouped

#: Distinct chunks a worker remembers (half as many with their decoded text); the longest it remembers.
MEMO_ENTRIES, MEMO_CHARS = 1_000_000, 64
#: Words of at most so many bytes are merged side by side in numpy.
LOCKSTEP = 32
#: The lexicon is made of at most so many chunks, of at most MEMO_CHARS characters; the words of others are merged.
LEXICON_WORDS = 65_536
#: Distinct chunks a task counts before it hands them on.
COUNTED = 3_000_000
#: Rank of a pair that does not merge.
UNMERGED = 1 << 30
#: ASCII signs that are one pre-token when they follow a word; an apostrophe may begin one of its own.
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte value in byte-level vocabularies."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Exact merges of one vocabulary file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.token_of = {i: t for t, i in vocab.items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + suffix] for s in symbols]
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words_of = regex.compile(pattern).findall
        self.path, self.library = path, None
        self.byte_of = {s: b for b, s in enumerate(symbols)}

    def _split_by_library(self, chunk: str) -> list[str]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))
        return [bytes(self.byte_of[c] for c in p).decode("utf-8") for p, _ in pieces]

    def merge(self, word: str) -> tuple[int, ...]:
        """The ids of one pre-token."""
        raw = word.encode("utf-8")
        ids = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        return tuple(self._merge_short(ids) if len(ids) <= 96 else self._merge_long(ids))

    def merge_many(self, words: list[str]) -> list[bytes]:
        """`merge` of many words, as packed ids: those of up to LOCKSTEP bytes advance together, one merge a step."""
        raws = [w.encode("utf-8") for w in words]
        lengths = np.fromiter(map(len, raws), np.int64, len(raws))
        out: list = [None] * len(raws)
        for low, high in ((0, 6), (6, 9), (9, 12), (12, 16), (16, LOCKSTEP)):
            for at in np.array_split(np.flatnonzero((lengths > low) & (lengths <= high)), max(1, len(raws) // 50_000)):
                if len(at):
                    for k, ids in zip(at.tolist(), self._lockstep([raws[k] for k in at], lengths[at], high)):
                        out[k] = ids
        return [np.array(self.merge(w), "<u4").tobytes() if o is None else o for o, w in zip(out, words)]

    def _lockstep(self, raws: list[bytes], lengths: np.ndarray, width: int) -> list[bytes]:
        if not hasattr(self, "pair_keys"):
            pairs = sorted((a << 32 | b, r) for (a, b), (r, _) in self.merges.items())
            self.pair_keys, self.pair_ranks = np.array([k for k, _ in pairs], np.int64), np.array([r for _, r in pairs], np.int32)
            self.made = np.array([new for _, (_, new) in sorted((r, (r, new)) for r, new in self.merges.values())], np.int32)
            # the pairs that words start with are of bytes: a table of all of them
            self.byte_ids = np.array([*self.inner, *self.last], np.int32)
            self.byte_ranks = np.array([[self.merges.get((a, b), (UNMERGED,))[0] for b in self.byte_ids.tolist()] for a in self.inner], np.int32)

        def look(a, b):
            key = a.astype(np.int64) << 32 | b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            return np.where((self.pair_keys[at] == key) & (b >= 0), self.pair_ranks[at], np.int32(UNMERGED))

        n = len(raws)
        columns = np.arange(width)
        data = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raws), np.uint8).reshape(n, width).astype(np.int64)
        data += 256 * (columns == lengths[:, None] - 1)
        inside = columns < lengths[:, None]
        ids = np.full((n, width + 1), -1, np.int32)
        ids[:, :width] = np.where(inside, self.byte_ids[data], -1)
        ranks = np.full((n, width + 1), UNMERGED, np.int32)
        ranks[:, : width - 1] = np.where(inside[:, 1:], self.byte_ranks[data[:, :-1] & 255, data[:, 1:]], UNMERGED)
        rows, open_ids, open_ranks = np.arange(n), ids, ranks
        spread = np.arange(width)
        while len(rows):
            best = open_ranks.argmin(axis=1)
            low = open_ranks[np.arange(len(rows)), best]
            more = low < UNMERGED
            if not more.all():  # words without a merge left are done
                ids[rows[~more]] = open_ids[~more]
                rows, best, low, open_ids, open_ranks = rows[more], best[more], low[more], open_ids[more], open_ranks[more]
            if not len(rows):
                break
            # close the gap behind the merged pair
            k = np.arange(len(rows))
            take = spread + (spread > best[:, None])
            open_ids[:, :width] = np.take_along_axis(open_ids, take, 1)
            open_ranks[:, :width] = np.take_along_axis(open_ranks, take, 1)
            open_ids[:, width], open_ranks[:, width] = -1, UNMERGED
            merged = self.made[low]
            open_ids[k, best] = merged
            open_ranks[k, best] = look(merged, open_ids[k, best + 1])
            has = np.flatnonzero(best > 0)
            before = best[has] - 1
            open_ranks[has, before] = look(open_ids[has, before], merged[has])
        kept = ids >= 0
        flat = ids[kept].astype("<u4").tobytes()
        ends = (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _merge_short(self, ids: list[int]) -> list[int]:
        get, none = self.merges.get, (1 << 60, 0)
        ranks = [get(p, none) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best is none:
                break
            k = ranks.index(best)
            ids[k : k + 2] = [best[1]]
            del ranks[k]
            if k < len(ranks):
                ranks[k] = get((ids[k], ids[k + 1]), none)
            if k:
                ranks[k - 1] = get((ids[k - 1], ids[k]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and a linked list, for words of any length."""
        n, get = len(ids), self.merges.get
        left, right, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
        heap = [(r[0], k, ids[k], ids[k + 1], r[1]) for k in range(n - 1) if (r := get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, k, a, b, new = heapq.heappop(heap)
            if not alive[k] or ids[k] != a or (j := right[k]) < 0 or ids[j] != b:
                continue
            ids[k], alive[j], right[k] = new, False, right[j]
            if right[j] >= 0:
                left[right[j]] = k
            for i in (left[k], k):
                if i >= 0 and right[i] >= 0 and (r := get((ids[i], ids[right[i]]))):
                    heapq.heappush(heap, (r[0], i, ids[i], ids[right[i]], r[1]))
        return [ids[k] for k in range(n) if alive[k]]

    def split(self, chunk: str) -> list[str | int]:
        """Pre-tokens (text) and special tokens (ids) of a chunk without white space."""
        if "<|" in chunk and len(parts := self.cut_special.split(chunk)) > 1:
            return list(chain.from_iterable([self.special[p]] if p in self.special else self.split(p) for p in parts if p))
        if not chunk.isascii():
            if any(unicodedata.category(c) == "Cn" for c in chunk):  # newer than this Python's tables: ask the library
                return self._split_by_library(chunk)
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")  # capital sigma lowers alike everywhere
        return self.words_of(chunk.lower())


def chunks_of(text: str) -> list[str]:
    """Runs between white space; pre-tokens never cross it.  Python also splits at U+001C..1F, which the pattern does not."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [c for c in re.split("[\t-\r \x85\xa0  -     　]+", text) if c]
    return text.split()


#: White space of more than one byte, and the signs that only Python takes for white space.
_WIDE_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_WIDE_BYTES = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def spaced(text: str) -> bytes:
    """The text in UTF-8 with one-byte white space (20 and 09-0D) between its chunks, and none inside them."""
    if _WIDE_SPACE.search(text) if text.isascii() else _WIDE_BYTES.search(text.encode("utf-8")):
        text = " ".join(chunks_of(text))
    return text.encode("utf-8")


# --- the transducer ---------------------------------------------------------------------------


def build_transducer(entries: dict[bytes, bytes]) -> bytes:
    """A minimal acyclic automaton over the keys, with the id sequences it points to, as one byte string."""
    words = sorted(w for w in entries if w)
    register: dict[tuple, int] = {}
    finals: list[bool] = []
    edges: list[tuple[tuple[int, int], ...]] = []
    counts: list[int] = []

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if (at := register.get(key)) is None:
            at = register[key] = len(finals)
            finals.append(node[0])
            edges.append(key[1])
            counts.append(node[0] + sum(counts[t] for _, t in key[1]))
        return at

    path: list[list] = [[False, []]]  # nodes of the current word that are still open
    before = b""
    for word in words:
        same = 0
        while same < min(len(before), len(word)) and before[same] == word[same]:
            same += 1
        for k in range(len(before), same, -1):
            done = freeze(path.pop())
            path[-1][1].append((before[k - 1], done))
        path.extend([False, []] for _ in word[same:])
        path[-1][0] = True
        before = word
    for k in range(len(before), 0, -1):
        done = freeze(path.pop())
        path[-1][1].append((before[k - 1], done))
    root = freeze(path.pop())
    keys, targets, skips = [], [], []
    for state, out in enumerate(edges):
        passed = int(finals[state])
        for label, target in out:
            keys.append(state << 8 | label)
            targets.append(target)
            skips.append(passed)
            passed += counts[target]
    flat = np.frombuffer(b"".join([entries[w] for w in words]), "<u4")
    starts = np.cumsum([0, *(len(entries[w]) // 4 for w in words)])
    parts = [np.array(keys, "<i8"), np.array(targets, "<i4"), np.array(skips, "<i4"), np.array(finals, "<u1"), starts.astype("<i4"), flat]
    header = struct.pack("<7q", root, *(p.nbytes for p in parts))
    return header + b"".join(p.tobytes() for p in parts)


class Transducer:
    """A mapped automaton; `find` walks many words at once."""

    def __init__(self, blob: bytes):
        with tempfile.TemporaryFile() as f:  # has no name: nothing stays behind, a new worker maps its own
            f.write(blob)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, *sizes = struct.unpack_from("<7q", self.map)
        at, views = 56, []
        for kind, size in zip(("<i8", "<i4", "<i4", "<u1", "<i4", "<u4"), sizes):
            views.append(np.frombuffer(self.map, kind, size // np.dtype(kind).itemsize, at))
            at += size
        self.keys, self.targets, self.skips, self.finals, self.starts, self.flat = views

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, or -1."""
        number = np.full(len(words), -1, np.int64)
        if not words or not len(self.keys):
            return number
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        data = np.frombuffer(b"".join(words), np.uint8)
        rows, state, index = np.arange(len(words)), np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        step = 0
        while len(rows):
            done = lengths[rows] == step
            if done.any():
                ok = done & (self.finals[state] == 1)
                number[rows[ok]] = index[ok]
                rows, state, index = rows[~done], state[~done], index[~done]
                if not len(rows):
                    break
            want = state << 8 | data[offsets[rows] + step]
            at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            hit = self.keys[at] == want
            rows, at = rows[hit], at[hit]
            state, index = self.targets[at].astype(np.int64), index[hit] + self.skips[at]
            step += 1
        return number

    def ids(self, number: int) -> bytes:
        return self.flat[self.starts[number] : self.starts[number + 1]].tobytes()


# --- encoding ---------------------------------------------------------------------------------


class Encoder:
    """Text to ids through a memo of chunks, the transducer, and exact merges, in this order.

    The memo keeps the chunks that came first, for frequent ones come early; when it is full the later half goes.
    """

    def __init__(self, path: str, lexicon: bytes | None = None, shown: bool = True):
        self.bpe = WordBpe(path)
        self.lexicon = Transducer(lexicon) if lexicon else None
        self.shown, self.most = shown, MEMO_ENTRIES // (2 if shown else 1)
        self.memo: dict[str, tuple[bytes, str]] = {}
        self.index, self.starts, self.flat = Index(), np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def known(self, words: list[str]) -> list[bytes | None]:
        """The ids of words that are chunks of the memo."""
        return [e[0] if e else None for e in map(self.memo.get, words)]

    def learn(self, fresh: Iterable[str]) -> dict[str, bytes]:
        """The ids of chunks that the memo does not hold."""
        listed, several, words, split = list(fresh), {}, {}, self.bpe.split
        # no chunk holds white space, so all can be lowered at once
        lows = unicodedata.normalize("NFC", "\n".join(listed)).replace("Σ", "σ").lower().split("\n")
        cores = [low.rstrip(TAIL) for low in lows]
        simple = [core.isalpha() for core in cores]  # one word, maybe with signs behind it
        for c, ok in zip(listed, simple):
            if not ok:
                several[c] = split(c)
        tails = [low[len(core) :] for low, core in zip(lows, cores)]
        unseen = {*compress(cores, simple), *compress(tails, simple), *(w for p in several.values() for w in p if isinstance(w, str))}
        unseen.discard("")
        words[""] = b""
        own = [w for w in unseen if w.isascii() and w.isalpha()]  # such a word may be a chunk of the memo
        words.update((w, ids) for w, ids in zip(own, self.known(own)) if ids is not None)
        unseen.difference_update(words)
        todo = list(unseen)
        if self.lexicon:
            found = self.lexicon.find([w.encode("utf-8") for w in todo]).tolist()
            words |= {w: self.lexicon.ids(number) for w, number in zip(todo, found) if number >= 0}
            todo = [w for w, number in zip(todo, found) if number < 0]
        words.update(zip(todo, self.bpe.merge_many(todo)))
        out = {c: words[core] + words[tail] for c, core, tail, ok in zip(listed, cores, tails, simple) if ok}
        for c, p in several.items():
            out[c] = b"".join([words[w] if isinstance(w, str) else struct.pack("<I", w) for w in p])
        return out

    def encode_batch(self, texts: list[str | None]) -> Iterator[tuple[bytes, str]]:
        """For each text its ids as little-endian 32-bit integers, and what they decode to."""
        for group in groups_of(texts):
            for got in self.lookup(group):
                yield b"".join([e[0] for e in got]), " ".join([e[1] for e in got])

    def ids_batch(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids alone.  Chunks are told by their hashes, and their ids gathered for whole groups of texts at once."""
        for words in grouped([spaced(t) if t else b"" for t in texts]):
            if len(words):
                hashes, first, signs, kinds = words.distinct()
                number = self.index.find(hashes, signs)
                if len(new := np.flatnonzero(number < 0)):
                    number[new] = self._remember(hashes[new], signs[new], words.words(first[new]))
                number = number[kinds]
                lows, sizes = self.starts[number], self.starts[number + 1] - self.starts[number]
                ends = np.cumsum(sizes)
                ids = self.flat[np.repeat(lows - ends + sizes, sizes) + np.arange(ends[-1])]
                ends = np.concatenate([[0], ends])[words.bounds].tolist()
            else:
                ids, ends = self.flat[:0], [0] * len(words.bounds)
            for a, b in zip(ends, ends[1:]):
                yield ids[a:b].tobytes()
            if len(self.index) > self.most or len(self.flat) > 16 * self.most:
                kept = min(len(self.index), self.most // 2, int(np.searchsorted(self.starts, 8 * self.most)))
                self.index.keep(kept)
                self.starts = self.starts[: kept + 1].copy()
                self.flat = self.flat[: self.starts[-1]].copy()

    def _remember(self, hashes: np.ndarray, signs: np.ndarray, chunks: list[bytes]) -> np.ndarray:
        texts = [c.decode("utf-8") for c in chunks]
        ids = self.learn(texts)
        ids = [ids[t] for t in texts]
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum([len(i) // 4 for i in ids])])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), "<u4")])
        return self.index.add(hashes, signs)

    def lookup(self, group: list[list[str]]) -> list[list[tuple[bytes, str]]]:
        """The ids and decoded texts of lists of chunks."""
        collecting = gc.isenabled()
        gc.disable()  # nothing here makes cycles, and the collector would walk the memo again and again
        got = [list(map(self.memo.get, chunks)) for chunks in group]
        short = [k for k, g in enumerate(got) if None in g]
        if short:
            token_of = self.bpe.token_of
            new = self.learn({c for k in short for c, e in zip(group[k], got[k]) if e is None})
            new = {c: (ids, " ".join([token_of[i] for i in memoryview(ids).cast("I")])) for c, ids in new.items()}
            for k in short:
                got[k] = [new[c] if e is None else e for c, e in zip(group[k], got[k])]
            if len(self.memo) + len(new) > self.most:
                self.memo = dict(islice(self.memo.items(), self.most // 2))
            self.memo.update((c, e) for c, e in new.items() if len(c) <= MEMO_CHARS)
        if collecting:
            gc.enable()
        return got


class IdEncoder(Encoder):
    """An encoder whose memo is arrays: ids only."""

    def known(self, words: list[str]) -> list[bytes | None]:
        if not words or not len(self.index):
            return [None] * len(words)
        asked = Words([w.encode("ascii") for w in words])
        numbers = self.index.find(asked.hashes, asked.signatures())
        lows, highs = self.starts[numbers].tolist(), self.starts[numbers + 1].tolist()
        return [self.flat[a:b].tobytes() if n >= 0 else None for n, a, b in zip(numbers.tolist(), lows, highs)]


def groups_of(texts: list[str | None], most: int = 400_000) -> Iterator[list[list[str]]]:
    """Lists of the chunks of each text, about `most` chunks together, so that memory follows neither batches nor texts."""
    group, n = [], 0
    for t in texts:
        group.append(chunks_of(t) if t else [])
        n += len(group[-1])
        if n >= most:
            yield group
            group, n = [], 0
    if group:
        yield group


def encoder(path: str, lexicon=None, version: str = "", shown: bool = True) -> Encoder:
    """The encoder of this worker process; `lexicon` is a broadcast."""
    return worker_slot(("bpe", path, version, shown), lambda: (Encoder if shown else IdEncoder)(path, lexicon.value if lexicon is not None else None, shown))


def frequent_words(docs: DataFrame, text: str, vocabulary: str, limit: int = LEXICON_WORDS) -> list[str]:
    """The pre-tokens of about the `limit` most frequent chunks of all texts.

    Every chunk of at most MEMO_CHARS characters is counted, added up in each task before the shuffle,
    so the counts are exact and do not depend on the partitions.  A chunk that occurs once is not
    worth an entry.
    """

    def count(batches):
        seen: Counter = Counter()

        def report():
            for part in batched(((c, n) for c, n in seen.items() if len(c) <= MEMO_CHARS), 100_000):
                chunks, counts = zip(*part)
                yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.string()), pa.array(counts, pa.int64())], names=["chunk", "n"])
            seen.clear()

        for batch in batches:
            for t in batches_of(batch, text)[0]:
                if t:
                    seen.update(chunks_of(t))
                if len(seen) > COUNTED:
                    yield from report()
        yield from report()

    counted = docs.select(text).mapInArrow(count, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))
    chunks = most_frequent(cut(counted.where("n > 1")), "n", limit).toArrow()["chunk"].to_pylist()
    bpe = WordBpe(vocabulary)
    return sorted({w for c in chunks for w in bpe.split(c) if isinstance(w, str)})


def compile_lexicon(words: Iterable[str], vocabulary: str) -> bytes:
    bpe = WordBpe(vocabulary)
    words = [w for w in words if w]
    return build_transducer(dict(zip([w.encode("utf-8") for w in words], bpe.merge_many(words))))


def encode(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text", lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """Every text encoded and decoded again: id, ids (array of int), decoded (string)."""

    def rows(keys, pairs):
        got = [(np.frombuffer(i, "<u4").tolist(), d) for i, d in pairs]
        return {id_column: keys, "ids": pa.array([g[0] for g in got], pa.list_(pa.int64())), "decoded": pa.array([g[1] for g in got], pa.string())}

    return _encoded(docs, vocabulary, id_column, text, lexicon_words, rows, "ids array<long>, decoded string")


def encode_digests(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text", lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """`encode`, reduced to n_tokens, ids_sha256 and decoded_sha256 before anything leaves the worker."""

    def rows(keys, pairs):
        n, a, b = [], [], []
        for ids, shown in pairs:
            n.append(len(ids) // 4)
            a.append(hashlib.sha256(ids).hexdigest())
            b.append(hashlib.sha256(shown.encode("utf-8")).hexdigest())
        return {id_column: keys, "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(a, pa.string()), "decoded_sha256": pa.array(b, pa.string())}

    return _encoded(docs, vocabulary, id_column, text, lexicon_words, rows, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _encoded(docs: DataFrame, vocabulary: str, id_column: str, text: str, lexicon_words: int, rows: Callable, columns: str) -> DataFrame:
    blob = compile_lexicon(frequent_words(docs, text, vocabulary, lexicon_words), vocabulary)
    lexicon, version = docs.sparkSession.sparkContext.broadcast(blob), hashlib.sha256(blob).hexdigest()

    def run(batches):
        own = encoder(vocabulary, lexicon, version)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_pydict(rows(part.column(0), own.encode_batch(batches_of(part, text)[0])))

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text).mapInArrow(run, f"`{id_column}` {kind}, {columns}")


def decode(ids: Iterable[int], vocabulary: str) -> str:
    """What the library's decode(ids, skip_special_tokens=False) returns for a vocabulary without a decoder."""
    token_of = _vocabulary(vocabulary).token_of
    return " ".join(token_of[i] for i in ids)


_vocabulary = lru_cache(maxsize=1)(WordBpe)
