"""The words of many texts as packed hashes, so that per-word work is numpy's and only distinct words are Python's.

A word is told by its 64-bit hash and by a signature of its length and first eight bytes (which is
the word itself up to eight bytes).  Words over LONG_WORD bytes are hashed by BLAKE2b, for the
polynomial of the others can be led astray by long patterns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

LONG_WORD = 64
#: Bytes of text that are taken together.
GROUP_BYTES = 4 << 20
MULTIPLIER = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (constants of the public splitmix64 generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes that are hashed together; sums over them stay in the processor's cache.
BLOCK = 1 << 15


def _powers(of: int, n: int) -> np.ndarray:
    """The first powers of an odd number modulo 2^64."""
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(n, 1) - 1, of % (1 << 64), np.uint64))])


UP, DOWN = _powers(MULTIPLIER, BLOCK), _powers(pow(MULTIPLIER, -1, 1 << 64), BLOCK)


def _polynomials(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """For each word between two `edges`: the sum of (byte + 1) * MULTIPLIER^(place in the word), modulo 2^64."""
    blocks = -(-len(data) // BLOCK)
    up, down = _powers(pow(MULTIPLIER, BLOCK, 1 << 64), blocks), _powers(pow(MULTIPLIER, -BLOCK, 1 << 64), blocks)
    total, sums, before, at = np.empty(len(edges), np.uint64), np.zeros(BLOCK + 1, np.uint64), np.zeros(1, np.uint64), 0
    last = np.searchsorted(edges, np.arange(1, blocks + 1) * BLOCK, side="right")
    for k in range(blocks):
        part = data[k * BLOCK : (k + 1) * BLOCK]
        inside = sums[1 : len(part) + 1]
        np.add(part, np.uint64(1), out=inside)
        inside *= UP[: len(part)]
        np.cumsum(inside, out=inside)
        total[at : last[k]] = sums[edges[at : last[k]] - k * BLOCK] * up[k] + before
        before, at = before + inside[-1:] * up[k], last[k]
    starts = edges[::2]
    return (total[1::2] - total[::2]) * DOWN[starts % BLOCK] * down[starts // BLOCK]


def long_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def _unique(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """np.unique with first places and inverse, by a hash table: only distinct values are sorted."""
    coded = pa.array(values).dictionary_encode()
    distinct, code = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    first = np.flatnonzero(np.diff(np.maximum.accumulate(code), prepend=-1))  # codes are dealt in order of appearance
    order = np.argsort(distinct)
    rank = np.empty(len(order), np.intp)
    rank[order] = np.arange(len(order))
    return distinct[order], first[order], rank[code]


class Words:
    """The words of some texts (bytes without their white space: 20 and 09-0D): hashes, starts and ends in `raw`."""

    def __init__(self, texts: Sequence[bytes]):
        self.raw = b"\n".join(texts)
        data = np.frombuffer(self.raw, np.uint8)
        space = np.ones(len(data) + 2, bool)
        np.logical_or(data == 0x20, data - np.uint8(9) < np.uint8(5), out=space[1:-1])
        edges = np.flatnonzero(space[1:] != space[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        self.lengths = self.ends - self.starts
        self.hashes = mix(_polynomials(data, edges) + self.lengths.astype(np.uint64))
        for k in np.flatnonzero(self.lengths > LONG_WORD):
            self.hashes[k] = long_hash(self.word(k))
        #: the first word of each text, and the end
        self.bounds = np.searchsorted(self.starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))

    def __len__(self) -> int:
        return len(self.starts)

    def word(self, k: int) -> bytes:
        return self.raw[self.starts[k] : self.ends[k]]

    def words(self, places: np.ndarray) -> list[bytes]:
        return [self.raw[a:b] for a, b in zip(self.starts[places].tolist(), self.ends[places].tolist())]

    def signatures(self) -> np.ndarray:
        padded = self.raw + bytes(8)
        eight = np.ndarray((len(self.raw) + 1,), "<u8", padded, strides=(1,))[self.starts]
        kept = np.minimum(self.lengths, 8).astype(np.uint64) * np.uint64(8)
        mask = np.where(kept == 64, ~np.uint64(0), (np.uint64(1) << (kept & np.uint64(63))) - np.uint64(1))
        return (eight & mask) + self.lengths.astype(np.uint64) * np.uint64(MULTIPLIER)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the distinct words in order, a place and the signature of each, and the number of every word."""
        signs = self.signatures()
        hashes, first, kinds = _unique(self.hashes)
        if (signs[first][kinds] != signs).any():  # two words of one hash
            self.hashes = np.array([long_hash(w) for w in self.words(np.arange(len(self)))], np.uint64)
            hashes, first, kinds = _unique(self.hashes)
        return hashes, first, signs[first], kinds


def grouped(texts: Sequence[bytes], most: int = GROUP_BYTES) -> Iterator[Words]:
    """Words of runs of texts of bounded size; memory follows neither the batch nor, but for its own bytes, a text."""
    run, held = [], 0
    for k, t in enumerate(texts):
        run.append(t)
        held += len(t) + 1
        if held >= most or k == len(texts) - 1:
            yield Words(run)
            run, held = [], 0


class Index:
    """Numbers of words, from 0 in the order they were added; looked up for many words at once."""

    def __init__(self):
        self.hashes, self.signs, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, hashes: np.ndarray, signs: np.ndarray) -> np.ndarray:
        """The number of each word, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where((self.hashes[at] == hashes) & (self.signs[at] == signs), self.numbers[at], -1)

    def add(self, hashes: np.ndarray, signs: np.ndarray) -> np.ndarray:
        """Numbers for new words, in the order given."""
        numbers = np.arange(len(self), len(self) + len(hashes))
        order = np.argsort(hashes, kind="stable")
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes, self.signs, self.numbers = (np.insert(old, at, new[order]) for old, new in ((self.hashes, hashes), (self.signs, signs), (self.numbers, numbers)))
        return numbers

    def keep(self, most: int) -> None:
        """Only the first `most` words stay."""
        kept = self.numbers < most
        self.hashes, self.signs, self.numbers = self.hashes[kept], self.signs[kept], self.numbers[kept]
