"""Language-model scores by a log-bilinear model with noise-contrastive estimation (operator 8).

Words are counted over all texts.  The most frequent words are classes of their own, and the others
belong to spelling classes by their last two bytes and whether they are longer than most; the more
distinct words a corpus has, the more classes there are (CLASSES_BY, up to MOST_CLASSES).  A class is
predicted from the two before it:

    s(c | a, b) = q_c . (M1 r_a + M2 r_b) + bias_c,        P(c | a, b) = exp s / sum over classes

Parameters are fitted in numpy by noise-contrastive estimation (Mnih and Teh 2012) on all training
texts: in each epoch every task goes over its own texts, shuffled `sample_tokens` or so at a time,
and the parameters of the tasks are averaged; biases start from the class frequencies.  Since the
score is a sum over the two positions, all normalisers are one matrix product of exponentials, and
scoring a token is a product of two short vectors, exactly normalised.  A word of a spelling class has
its share of the class, (n + 0.5) / (class total + 0.5 (class types + 1)), counted over all training
texts; so the model is a distribution over words, with one unseen word a class.

Words travel as a 64-bit hash and a signature (wordhash), so long ones cost what short ones do.  Rare
words never go to the driver: their rows meet the word counts in a shuffled join, in which no key is
hot, because the `known_words` most frequent of all texts (held out or not) are known to every worker.

Edge cases: null and empty texts are the end token alone.  Words and texts of any length are scored
whole.  Rows are told apart by a row number, so repeated ids are scored row by row, and rows without
an id (their id counts as the empty string) too.  Other columns are ignored, whatever their names.
Without training rows every count is 0 and the model is uniform over classes.  An empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioql.llm._common import batches_of, crc32_text, cut, most_frequent
from folioql.llm.wordhash import MULTIPLIER, Index, Words, grouped, mix

#: Words that every worker knows, by frequency; 28 bytes each.  The others are looked up by a join.
KNOWN_WORDS = 200_000
#: There are about CLASSES_BY * sqrt(distinct training words) classes, of which a SPELLING-th part is for spellings.
CLASSES_BY, LEAST_CLASSES, MOST_CLASSES, SPELLING = 2, 256, 4096, 8
#: SAMPLE_TOKENS is what a task shuffles at a time and has at least between two averages; all tokens are trained on.
SAMPLE_TOKENS, DIMENSIONS, NOISE, BATCH, EPOCHS, RATE = 1_500_000, 24, 64, 2048, 3, 0.1
#: Sums of parameters that are added in one task.
FAN_IN = 16
#: Distinct words a task counts before it hands them on.
COUNTED = 1_000_000
#: Hash and signature of the end token; no word has suffix 0.
END = 0
SUFFIXES = 1 << 17


def lowered(text: str | None) -> bytes:
    """bytes.lower knows A-Z only, as the words of `Words` know only ASCII white space."""
    return text.encode("utf-8").lower() if text else b""


def suffixes(words: Words, places: np.ndarray) -> np.ndarray:
    """The last two bytes of words, and whether they are long, as one number."""
    data, ends, lengths = np.frombuffer(words.raw, np.uint8), words.ends[places], words.lengths[places]
    if not len(places):
        return np.zeros(0, np.int64)
    before = np.where(lengths > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.int64)
    return before << 9 | data[ends - 1].astype(np.int64) << 1 | (lengths > 7)


def held_out(id_column: str = "doc_id") -> Column:
    return F.pmod(crc32_text(id_column), F.lit(5)) == 1


def count_words(docs: DataFrame, train: Column, text: str) -> DataFrame:
    """Hash h, signature s and suffix of each word, and its count in training and in all texts."""

    def run(batches):
        index, sums = Index(), np.zeros((3, 0), np.int64)  # suffix, training count, count
        ends = np.zeros(2, np.int64)

        def report(index, sums):
            at = np.argsort(index.numbers)
            columns = (index.hashes[at].view(np.int64), index.signs[at].view(np.int64), *sums)
            for low in range(0, len(at), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[low : low + 100_000]) for c in columns], names=["h", "s", "suffix", "n", "total"])

        for batch in batches:
            own, texts = batches_of(batch, "_train", text)
            own, done = np.array(own, bool), 0
            ends += [own.sum(), len(own)]
            for words in grouped([lowered(t) for t in texts]):
                mine = np.repeat(own[done : done + len(words.bounds) - 1], np.diff(words.bounds))
                done += len(words.bounds) - 1
                hashes, first, signs, kinds = words.distinct()
                got = np.stack([np.zeros(len(hashes), np.int64), np.bincount(kinds, mine, len(hashes)).astype(np.int64), np.bincount(kinds, minlength=len(hashes))])
                number = index.find(hashes, signs)
                old, new = number >= 0, np.flatnonzero(number < 0)
                sums[:, number[old]] += got[:, old]
                got[0] = suffixes(words, first)
                index.add(hashes[new], signs[new])
                sums = np.concatenate([sums, got[:, new]], axis=1)
                if len(index) > COUNTED:
                    yield from report(index, sums)
                    index, sums = Index(), np.zeros((3, 0), np.int64)
        yield from report(index, sums)
        yield pa.RecordBatch.from_pydict({k: pa.array([v], pa.int64()) for k, v in zip(("h", "s", "suffix", "n", "total"), (END, END, 0, *ends.tolist()))})

    counted = docs.select(train.alias("_train"), F.col(text)).mapInArrow(run, "h long, s long, suffix long, n long, total long")
    return counted.groupBy("h", "s").agg(F.max("suffix").alias("suffix"), F.sum("n").alias("n"), F.sum("total").alias("total"))


@dataclass
class Vocabulary:
    index: Index  # the known words, END first
    n: np.ndarray  # training count of each known word
    cls: np.ndarray  # its class
    spelled: np.ndarray  # class of each suffix
    top: int  # classes of one word
    counts: np.ndarray  # training tokens of each class
    room: np.ndarray  # log10 of what a word's count + 0.5 is divided by in its class (0 for classes of one word)
    tokens: int
    distinct: int

    @property
    def classes(self) -> int:
        return len(self.counts)

    @property
    def total(self) -> float:
        """log10 of what a count + 0.5 is divided by in the unigram model."""
        return float(np.log10(self.tokens + 0.5 * (self.distinct + 1)))


def vocabulary(words: DataFrame, known_words: int = KNOWN_WORDS, classes: int | None = None) -> Vocabulary:
    """Bounded parts of the word counts: the known words, and totals by suffix (SUFFIXES at most)."""
    is_end = (F.col("h") == END) & (F.col("s") == END)
    known = most_frequent(words.where(~is_end), "total", known_words).union(words.where(is_end)).select("h", "s", "suffix", "n").toArrow()
    h, s, suffix, n = (known[c].to_numpy() for c in ("h", "s", "suffix", "n"))
    at = np.lexsort((h, s, -n, (h != END) | (s != END)))  # END first, then by count
    h, s, suffix, n = h[at], s[at], suffix[at], n[at]
    if not len(h):  # an empty table has no end either
        h = s = suffix = n = np.zeros(1, np.int64)
    sums = words.groupBy("suffix").agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("types")).toArrow()
    inside, types = np.zeros(SUFFIXES), np.zeros(SUFFIXES)
    inside[sums["suffix"].to_numpy()], types[sums["suffix"].to_numpy()] = sums["n"].to_numpy(), sums["types"].to_numpy()
    tokens, distinct = int(inside.sum()), int(types.sum())
    classes = classes or min(MOST_CLASSES, max(LEAST_CLASSES, CLASSES_BY * isqrt(distinct)))
    spelling = max(2, classes // SPELLING)
    top = min(classes - spelling, 1 + int(np.count_nonzero(n[1:] > 0)))
    np.subtract.at(inside, suffix[:top], n[:top])
    np.subtract.at(types, suffix[:top], (n[:top] > 0).astype(float))
    # frequent suffixes are classes of their own, the others share the rest
    own = spelling // 2
    spelled = (top + own + mix(np.arange(SUFFIXES, dtype=np.uint64) * np.uint64(MULTIPLIER)) % np.uint64(spelling - own)).astype(np.int64)
    spelled[np.lexsort((np.arange(SUFFIXES), -inside))[:own]] = top + np.arange(own)
    counts, kinds = (np.bincount(spelled, x, top + spelling) for x in (inside, types))
    counts[:top] = n[:top]
    room = np.log10(counts + 0.5 * (kinds + 1))
    room[:top] = 0
    cls = spelled[suffix]
    cls[:top] = np.arange(top)
    index = Index()
    index.add(h.view(np.uint64), s.view(np.uint64))
    return Vocabulary(index, n, cls, spelled, top, counts, room, tokens, distinct)


@dataclass
class Model:
    first: np.ndarray  # classes x dimensions: what a class two back adds to the context
    second: np.ndarray  # the same, one back
    words: np.ndarray  # classes x dimensions
    bias: np.ndarray
    normal: np.ndarray  # classes x classes: log normaliser of a context

    def log_probabilities(self, before: np.ndarray, last: np.ndarray, target: np.ndarray, block: int = 1 << 12) -> np.ndarray:
        out, normal, n = np.empty(len(target), np.float64), self.normal.ravel(), len(self.normal)
        for low in range(0, len(target), block):
            a, b, c = before[low : low + block], last[low : low + block], target[low : low + block]
            context = self.first.take(a, 0)
            context += self.second.take(b, 0)
            out[low : low + block] = np.einsum("ij,ij->i", context, self.words.take(c, 0)) + self.bias[c] - normal.take(a.astype(np.intp) * n + b)
        return out


def tables(r: np.ndarray, q: np.ndarray, m1: np.ndarray, m2: np.ndarray, bias: np.ndarray) -> Model:
    """All normalisers as one matrix product, a block of contexts at a time: only one table of all pairs of classes is held."""
    a, b = r @ m1.T, r @ m2.T
    second = (b @ q.T + bias).astype(np.float32)
    high2 = second.max(axis=1, keepdims=True)
    second = np.exp(np.subtract(second, high2, out=second), out=second)
    normal = np.empty((len(r), len(r)), np.float32)
    for low in range(0, len(r), 256):
        first = a[low : low + 256] @ q.T
        high1 = first.max(axis=1, keepdims=True)
        normal[low : low + 256] = np.log(np.exp(first - high1).astype(np.float32) @ second.T) + high1 + high2.T
    return Model(*(x.astype(np.float32) for x in (a, b, q, bias)), normal)


PARTS = ("r", "q", "m1", "m2", "bias")


def start(counts: np.ndarray, dimensions: int = DIMENSIONS, seed: int = 7) -> dict[str, np.ndarray]:
    """Parameters and Adagrad sums (under "+" and the name) before training; biases are log frequencies."""
    rng, n = np.random.default_rng(seed), len(counts)
    p = {"r": rng.normal(0, 0.1, (n, dimensions)), "q": rng.normal(0, 0.1, (n, dimensions)), "m1": np.eye(dimensions) * 0.5, "m2": np.eye(dimensions), "bias": np.log((counts + 0.5) / (counts + 0.5).sum())}
    p |= {f"+{k}": np.full(v.shape, 1e-6) for k, v in p.items()}
    return {k: v.astype(np.float32) for k, v in p.items()}


def contexts(stream: np.ndarray, starts: np.ndarray, end: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The classes two back and one back of each token of texts that each end in `end`."""
    last = np.concatenate([[end], stream[:-1]])
    before = np.concatenate([[end], last[:-1]])
    before[starts] = end
    return before, last


def joined(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The classes of several texts in one row, and where each begins."""
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
    return np.frombuffer(b"".join(ids), "<u2").astype(np.int32), np.cumsum(sizes) - sizes


def _sorted(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct classes of `at` (uint16), the order that sorts it, and where each class begins in that order."""
    order = np.argsort(at, kind="stable")
    own = at.take(order)
    first = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1])
    return own.take(first).astype(np.intp), order, first


def _sums(rows: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of each class; two numbers are added as one complex number, which halves numpy's calls."""
    rows = rows.take(order, 0)
    if rows.shape[1] % 2:
        return np.add.reduceat(rows, first, axis=0)
    return np.add.reduceat(rows.view(np.complex64), first, axis=0).view(np.float32)


def _step(values: np.ndarray, squared: np.ndarray, own: np.ndarray, total: np.ndarray) -> None:
    """Adagrad on the rows `own`, whose gradients are `total`."""
    squares = squared.take(own, 0)
    squares += total * total
    squared[own] = squares
    total *= np.float32(RATE)
    total /= np.sqrt(squares, out=squares)
    total += values.take(own, 0)
    values[own] = total


def descend(p: dict[str, np.ndarray], before: np.ndarray, last: np.ndarray, target: np.ndarray, noise: np.ndarray, rng: np.random.Generator, touched: dict[str, np.ndarray]) -> None:
    """One pass of noise-contrastive estimation over tokens in random order; `noise` is shared by a batch.

    A batch holds far fewer classes than tokens, so what depends on the class of one position alone (its
    product with m1 or m2, forth and back) is computed once a class.  `touched` counts how often each
    row was updated.
    """
    r, m1, m2 = (p[k] for k in ("r", "m1", "m2"))
    n, wide = len(noise), r.shape[1]
    room = wide + 2 - wide % 2  # even, for _sums
    offset = (np.log(noise) + np.log(NOISE)).astype(np.float32)

    def widened(table: np.ndarray, column: np.ndarray | float) -> np.ndarray:
        out = np.zeros((len(table), room), np.float32)
        out[:, :wide], out[:, wide] = table, column
        return out

    # a bias is one more number of a word's vector, and 1 the one of its context
    q, squared = widened(p["q"], p["bias"] - offset), widened(p["+q"], p["+bias"])
    squared[:, wide + 1 :] = 1
    tokens = np.zeros((len(target), 4), np.uint16)
    for k, ids in enumerate((before, last, target)):
        tokens[:, k] = ids
    tokens = rng.permutation(tokens.view(np.uint64).ravel())
    parts = np.array_split(tokens, max(1, len(target) // BATCH))
    cumulated = np.cumsum(noise)
    samples = np.minimum(np.searchsorted(cumulated, rng.random((len(parts), NOISE)) * cumulated[-1], side="right"), n - 1)
    half, rate, place, seen = np.float32(0.5), np.float32(RATE), np.empty(n, np.intp), np.zeros(n, bool)
    for part, drawn in zip(parts, samples):
        short = np.ascontiguousarray(part.view(np.uint16).reshape(-1, 4).T)
        a, b, c = short[:3].astype(np.intp)
        (own_a, *of_a), (own_b, *of_b) = _sorted(short[0]), _sorted(short[1])
        own_q, *of_q = _sorted(np.concatenate([short[2], drawn.astype(np.uint16)]))
        ra, rb, qc, qd = r.take(own_a, 0), r.take(own_b, 0), q.take(c, 0), q.take(drawn, 0)
        place[own_a] = np.arange(len(own_a))
        context = widened(ra @ m1.T, 1).take(place.take(a), 0)
        place[own_b] = np.arange(len(own_b))
        context += widened(rb @ m2.T, 0).take(place.take(b), 0)
        # P(data) against NOISE noise samples a token; the normaliser is taken as 1
        true = np.einsum("ij,ij->i", context, qc)
        # logistic functions by tanh, which cannot overflow: those of the samples are (1 + tanh(score / 2)) / 2,
        # whose two parts are multiplied apart
        qd *= half
        false = context @ qd.T
        np.tanh(false, out=false)
        pull = half - half * np.tanh(half * true)
        qc *= pull[:, None]
        qc -= qd.sum(axis=0)
        qc -= false @ qd
        grads = np.empty((len(c) + NOISE, room), np.float32)
        push = (context.T @ false).T
        push += np.ones(len(c), np.float32) @ context
        np.multiply(push, -half, out=grads[len(c) :])
        np.multiply(context, pull[:, None], out=grads[: len(c)])
        _step(q, squared, own_q, _sums(grads, *of_q))
        sum_a, sum_b = _sums(qc, *of_a)[:, :wide], _sums(qc, *of_b)[:, :wide]
        seen[own_a] = seen[own_b] = True
        own = np.flatnonzero(seen)
        seen[own] = False
        place[own] = np.arange(len(own))
        total = np.zeros((len(own), wide), np.float32)
        total[place.take(own_a)] = sum_a @ m1
        total[place.take(own_b)] += sum_b @ m2
        _step(r, p["+r"], own, total)
        for k, g in (("m1", sum_a.T @ ra), ("m2", sum_b.T @ rb)):
            p[f"+{k}"] += g**2
            p[k] += rate * g / np.sqrt(p[f"+{k}"])
    p["q"][:], p["bias"][:], p["+q"][:], p["+bias"][:] = q[:, :wide], q[:, wide] + offset, squared[:, :wide], squared[:, wide]
    touched["q"] += np.bincount(target, minlength=n) + np.bincount(samples.ravel(), minlength=n)
    touched["r"] += np.bincount(before, minlength=n) + np.bincount(last, minlength=n)


def noise_of(counts: np.ndarray) -> np.ndarray:
    return (counts + 0.5) / (counts + 0.5).sum()


def train(texts: list[bytes], counts: np.ndarray, dimensions: int = DIMENSIONS, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Noise-contrastive estimation with Adagrad in this process; class 0 ends each text."""
    p, rng = start(counts, dimensions, seed), np.random.default_rng(seed)
    if texts:
        stream, starts = joined(texts)
        for _ in range(epochs):
            descend(p, *contexts(stream, starts), stream, noise_of(counts), rng, {k: np.zeros(len(counts)) for k in "rq"})
    return tables(*(p[k].astype(np.float64) for k in PARTS))


def _weights(touched: dict[str, np.ndarray], tokens: int) -> dict[str, np.ndarray | float]:
    """What a share's value of each parameter counts for in the average: the updates of a row, the tokens of a matrix."""
    own = {"r": touched["r"][:, None], "q": touched["q"][:, None], "bias": touched["q"], "m1": float(tokens), "m2": float(tokens)}
    return own | {f"+{k}": v for k, v in own.items()}


def train_everywhere(streams: DataFrame, counts: np.ndarray, tokens: int, share_tokens: int = SAMPLE_TOKENS, epochs: int = EPOCHS, seed: int = 7) -> tuple[Model, int]:
    """The model of all `streams` (column ids: classes of whole training texts), and how many tokens its passes read.

    In each epoch every task goes once over all its texts, `share_tokens` or so in memory at a time,
    and the parameters are averaged, row by row by the number of updates.  Sums are added up by FAN_IN
    at a time, so that neither a task nor the driver gets more of them, however many tasks there are.
    """
    spark, p, n, read = streams.sparkSession, start(counts, seed=seed), len(counts), 0
    # too short shares would hardly move between two averages
    streams = streams.coalesce(max(1, -(-tokens // share_tokens)))
    tasks = streams.rdd.getNumPartitions()
    shapes, noise = {k: v.shape for k, v in p.items()}, noise_of(counts)

    def packed(sums, touched, seen):
        return np.concatenate([*(sums[k].ravel() for k in shapes), touched["r"], touched["q"], [seen]]).astype(np.float64)

    def unpacked(flat):
        sums, at = {}, 0
        for k, shape in shapes.items():
            sums[k] = flat[at : at + int(np.prod(shape))].reshape(shape)
            at += int(np.prod(shape))
        return sums, {"r": flat[at : at + n], "q": flat[at + n : at + 2 * n]}, int(flat[-1])

    def add(batch: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<f8") for x in batch["flat"].to_pylist())
        return pa.table({"grp": batch["grp"].slice(0, 1), "flat": pa.array([total.tobytes()], pa.binary())})

    for epoch in range(epochs):
        shared = spark.sparkContext.broadcast(p)

        def run(batches, shared=shared, epoch=epoch):
            part = TaskContext.get().partitionId()
            own, rng = {k: v.copy() for k, v in shared.value.items()}, np.random.default_rng([seed, epoch, part])
            touched, held, size, seen = {k: np.zeros(n) for k in "rq"}, [], 0, 0

            def go():
                stream, starts = joined(held)
                descend(own, *contexts(stream, starts), stream, noise, rng, touched)

            for batch in batches:
                for ids in batches_of(batch, "ids")[0]:
                    held.append(ids)
                    size += len(ids) // 2
                    if size >= share_tokens:
                        go()
                        held, size, seen = [], 0, seen + size
            if size:
                go()
            seen += size
            weights = _weights(touched, seen)
            flat = packed({k: v * weights[k] for k, v in own.items()}, touched, seen)
            yield pa.RecordBatch.from_pydict({"grp": pa.array([part], pa.int64()), "flat": pa.array([flat.tobytes()], pa.binary())})

        sums_, width = streams.mapInArrow(run, "grp long, flat binary"), tasks
        while width > 1:
            sums_ = sums_.withColumn("grp", F.floor(F.col("grp") / FAN_IN)).groupBy("grp").applyInArrow(lambda t: add(t), "grp long, flat binary")
            width = -(-width // FAN_IN) if width > FAN_IN else 1
        got = sums_.select("flat").toArrow()
        if got.num_rows:
            sums, touched, seen = unpacked(sum(np.frombuffer(x, "<f8") for x in sorted(got["flat"].to_pylist())))
            weights = _weights(touched, seen)
            # rows that nobody updated keep their values
            p = {k: np.where(np.broadcast_to(weights[k], v.shape) > 0, sums[k] / np.maximum(weights[k], 1), v).astype(np.float32) for k, v in p.items()}
            read += seen
        shared.unpersist()
    return tables(*(p[k].astype(np.float64) for k in PARTS)), read


def _looked(words: Words, vocab: Vocabulary) -> dict[str, pa.Array]:
    """What known words say about some texts, their classes, and what is still to be looked up."""
    texts = len(words.bounds) - 1
    hashes, first, signs, kinds = words.distinct()
    number = vocab.index.find(hashes, signs)
    known = number >= 0
    n = np.where(known, vocab.n[number], 0)
    cls = np.where(known, vocab.cls[number], vocab.spelled[suffixes(words, first)])
    count = np.where(known, np.log10(n + 0.5), 0.0)
    owner = np.repeat(np.arange(texts), np.diff(words.bounds))
    total = lambda values: np.bincount(owner, values[kinds], texts)
    # the end; classes of one word have no share
    counted = total(count) + np.log10(vocab.n[0] + 0.5)
    n_tokens = np.diff(words.bounds) + 1
    alone = known & (cls < vocab.top)
    # the part of rare words that needs their counts comes later
    inner = total(np.where(alone, 0.0, count - vocab.room[cls]))
    rare = np.flatnonzero(~known[kinds])
    pairs, tf = np.unique(owner[rare] * (len(hashes) + 1) + kinds[rare], return_counts=True)
    who, what = np.divmod(pairs, len(hashes) + 1)
    ids = np.insert(cls[kinds].astype("<u2"), words.bounds[1:], 0)
    offsets = pa.py_buffer(((words.bounds + np.arange(texts + 1)) * 2).astype(np.int32).tobytes())
    struct = pa.StructArray.from_arrays([pa.array(x) for x in (hashes[what].view(np.int64), signs[what].view(np.int64), tf.astype(np.int64))], names=["h", "s", "tf"])
    return {
        "n_tokens": pa.array(n_tokens), "n_known": pa.array(total((n > 0).astype(float)).astype(np.int64) + int(vocab.n[0] > 0)),
        "base": pa.array(counted - n_tokens * vocab.total), "inner": pa.array(inner),
        "ids": pa.Array.from_buffers(pa.binary(), texts, [None, offsets, pa.py_buffer(ids.tobytes())]),
        "rare": pa.ListArray.from_arrays(pa.array(np.searchsorted(who, np.arange(texts + 1)).astype(np.int32)), struct),
    }


def _blocks(batch: pa.RecordBatch, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    yield from (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def score(docs: DataFrame, id_column: str = "doc_id", text: str = "text", known_words: int = KNOWN_WORDS, classes: int | None = None, sample_tokens: int = SAMPLE_TOKENS) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    own = ~held_out(id_column)
    words = cut(count_words(docs, own, text))
    vocab = vocabulary(words, known_words, classes)
    known = spark.sparkContext.broadcast(vocab)
    kind = docs.schema[id_column].dataType.simpleString()

    def look(batches):
        vocab = known.value
        for batch in batches:
            done = 0
            for part in grouped([lowered(t) for t in batches_of(batch, "_text")[0]]):
                got, rows = _looked(part, vocab), len(part.bounds) - 1
                plain = batch.slice(done, rows)
                done += rows
                yield pa.RecordBatch.from_arrays([plain.column(0), plain.column(1), *got.values()], names=[id_column, "_own", *got])

    looked = docs.select(id_column, own.alias("_own"), F.col(text).alias("_text")).mapInArrow(look, f"`{id_column}` {kind}, _own boolean, n_tokens long, n_known long, base double, inner double, ids binary, rare array<struct<h: bigint, s: bigint, tf: bigint>>")
    looked = cut(looked.withColumn("_row", F.monotonically_increasing_id()))
    model, _ = train_everywhere(looked.where("_own").select("ids"), vocab.counts, vocab.tokens, sample_tokens)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in (b for whole in batches for b in _blocks(whole)):
            stream, starts = joined(batches_of(batch, "ids")[0])
            found = np.add.reduceat(model.log_probabilities(*contexts(stream, starts), stream), starts) / np.log(10)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(5)), pa.array(found + batch.column(6).to_numpy())], names=[*plain, "score"])

    plain = [id_column, "_row", "n_tokens", "n_known", "base"]
    rows = looked.select(*plain, "ids", "inner").mapInArrow(run, f"`{id_column}` {kind}, _row long, n_tokens long, n_known long, base double, score double")
    rare = looked.select("_row", F.explode("rare").alias("r")).select("_row", "r.h", "r.s", "r.tf")
    # words that no training text holds need no partner: their count is 0
    met = rare.join(words.where("n > 0").select("h", "s", "n"), ["h", "s"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("double"))
    sums = met.groupBy("_row").agg(F.sum(F.when(F.col("n") > 0, F.col("tf")).otherwise(0)).alias("_k"), F.sum(F.col("tf") * F.log10(F.col("n") + 0.5)).alias("_c"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return rows.join(sums, "_row", "left").select(
        id_column, held_out(id_column).alias("held_out"), "n_tokens", (F.col("n_known") + zero("_k")).alias("n_known"), F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("_c")).alias("base_score"), (F.col("score") + zero("_c")).alias("score"),
    )
