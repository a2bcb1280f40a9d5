"""Language identification by script ranges and Viterbi over words (operator 10).

Words are runs of letters.  The script of a word (by code point ranges) narrows its candidates to
the languages that training texts write in that script.  Each candidate gets the word's log
likelihood under hashed letter trigrams, and a Viterbi pass with a penalty for each change of
language labels every word; runs of equal labels are the spans.  A document's language is the one
with the most letters, its score the share of letters that have it.

The model is fitted on a sample of at most about `sample_rows` labelled rows (dealt by a hash of
the id, whole texts), and has `BUCKETS` counts a language; everything else reads all rows.

Edge cases: a null text, or one without a letter, is `und` with score 0 and no spans; so is every
text when no row is labelled.  Words in scripts that training never saw are neutral and take their
neighbours' language.  Ties go to the language that sorts first.  Texts of any length are labelled
whole.  Repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioql.llm._common import batches_of, crc32_text, fresh, worker_slot

BUCKETS = 1 << 16
SAMPLE_ROWS = 20_000
SWITCH_PENALTY = 12.0
#: Documents with a smaller share of letters in the scripts of training are rejected.
KNOWN_SHARE = 0.5
#: First and last code points of the larger scripts.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x531, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "indic": ((0x900, 0xDFF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}
OTHER = len(SCRIPTS) + 1
#: Code points scored at a time, and code points whose words are labelled side by side.
BLOCK, GROUP = 1 << 19, 3 << 20


@cache
def script_of() -> np.ndarray:
    """Script number of each code point; 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint8)
    letters = np.fromiter((not 0xD800 <= c < 0xE000 and chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    out[letters] = OTHER
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for low, high in ranges:
            part = out[low : high + 1]
            part[part > 0] = number
    return out


def trigrams(points: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The bucket of the trigram centred at each code point; what is no letter counts as a blank."""
    p = np.where(letters, points, 0).astype(np.uint32)
    left, right = np.concatenate([[0], p[:-1]]).astype(np.uint32), np.concatenate([p[1:], [0]]).astype(np.uint32)
    h = (left * np.uint32(0x9E3779B1)) ^ (p * np.uint32(0x85EBCA77)) ^ (right * np.uint32(0xC2B2AE3D))
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(16)).astype(np.int64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


class Model:
    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray):
        """counts: languages x BUCKETS; scripts: languages x script numbers (letters seen)."""
        self.languages = languages
        total = counts.sum(axis=1, keepdims=True)
        self.log = np.log((counts + 0.5) / (total + 0.5 * BUCKETS)).T.astype(np.float32).copy() if len(languages) else np.zeros((BUCKETS, 0), np.float32)
        seen = scripts > 0.001 * np.maximum(1, scripts.sum(axis=1, keepdims=True))
        self.neutral = ~seen.any(axis=0)
        self.allowed = np.where(seen | self.neutral, 0.0, -1e6).T.astype(np.float32)

    def word_scores(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and lengths of the words of code points, and their score by language."""
        script = script_of()[np.minimum(points, 0x10FFFF)]
        letters = script > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], letters.view(np.int8), [0]])))
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return starts, starts, np.zeros((0, len(self.languages)), np.float32)
        bucket = trigrams(points, letters)[letters]
        begin = np.concatenate([[0], np.cumsum(ends - starts)[:-1]])
        scores = np.add.reduceat(self.log[bucket], begin, axis=0)
        first = script[starts]
        scores[self.neutral[first]] = 0
        return starts, ends - starts, scores + self.allowed[first]


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Best labels for several runs of words at once; `scores` holds the runs one after the other.

    Runs advance in lockstep, longest first, so that those still running are a leading slice.
    """
    n, k = scores.shape
    labels = np.zeros(n, np.int16)
    if not n or k < 2:
        return labels
    offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    offs, lens = offsets[order], lengths[order]
    alive = len(lens) - np.searchsorted(lens[::-1], np.arange(lens[0]), side="right")  # runs longer than t
    came = np.zeros((n, k), np.int16)  # label before, for each word and label
    best = scores[offs].astype(np.float64)
    own = np.arange(k)
    final = best.copy()
    for t in range(1, int(lens[0])):
        a = alive[t]
        now = best[:a]
        top = now.argmax(axis=1)
        high = now[np.arange(a), top] - penalty
        stay = now >= high[:, None]
        at = offs[:a] + t
        came[at] = np.where(stay, own, top[:, None])
        best = np.maximum(now, high[:, None]) + scores[at]
        final[:a] = best
    last = final.argmax(axis=1)
    for t in range(int(lens[0]) - 1, -1, -1):
        a = alive[t]
        at = offs[:a] + t
        labels[at] = last[:a]
        last[:a] = came[at, last[:a]]
    return labels


def label(model: Model, texts: list[str | None], penalty: float = SWITCH_PENALTY):
    """For each text: starts, lengths and labels of its words."""
    group, held = [], 0
    for k, t in enumerate(texts):
        group.append(code_points(t) if t else np.zeros(0, np.uint32))
        held += len(group[-1])
        if held >= GROUP or k == len(texts) - 1:
            yield from _label_group(model, group, penalty)
            group, held = [], 0


def _label_group(model: Model, group: list[np.ndarray], penalty: float):
    blank = np.zeros(1, np.uint32)
    words: list[tuple] = []
    run, held = [], 0
    scored = []

    def flush():
        joined = np.concatenate([x for p in run for x in (p, blank)])
        starts, lengths, scores = model.word_scores(joined)
        bounds = np.cumsum([0, *(len(p) + 1 for p in run)])
        cuts = np.searchsorted(starts, bounds)
        for k in range(len(run)):
            part = slice(cuts[k], cuts[k + 1])
            words.append((starts[part] - bounds[k], lengths[part]))
        scored.append(scores)

    for p in group:
        run.append(p)
        held += len(p)
        if held >= BLOCK:
            flush()
            run, held = [], 0
    if run:
        flush()
    counts = np.array([len(s) for s, _ in words])
    labels = viterbi(np.concatenate(scored), counts, penalty)
    ends = np.cumsum(counts)
    for (starts, lengths), end in zip(words, ends):
        yield starts, lengths, labels[end - len(starts) : end]


def fit(docs: DataFrame, where: Column, id_column: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Count trigrams and scripts of each language over a bounded sample of the labelled rows that `where` admits."""
    rows = docs.where(where & F.col(lang).isNotNull() & F.col(text).isNotNull())
    every = max(1, -(-rows.select(lang).count() // sample_rows))
    sample = rows.where(F.pmod(F.xxhash64(id_column), F.lit(every)) == 0).select(lang, text)

    def count(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, t in zip(*batches_of(batch, lang, text)):
                own = counts.setdefault(name, np.zeros(BUCKETS + OTHER + 1, np.int64))
                points = code_points(t)
                for low in range(0, len(points), BLOCK):
                    part = points[low : low + BLOCK]
                    script = script_of()[np.minimum(part, 0x10FFFF)]
                    own[:BUCKETS] += np.bincount(trigrams(part, script > 0)[script > 0], minlength=BUCKETS)
                    own[BUCKETS:] += np.bincount(script, minlength=OTHER + 1)
        for name, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(at), pa.string()), "at": pa.array(at, pa.int32()), "n": pa.array(own[at], pa.int64())})

    found = sample.mapInArrow(count, "lang string, at int, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    grid = np.zeros((len(languages), BUCKETS + OTHER + 1), np.float64)
    if len(found):
        grid[found["lang"].map({x: k for k, x in enumerate(languages)}).to_numpy(), found["at"].to_numpy()] = found["n"].to_numpy()
    scripts = grid[:, BUCKETS:].copy()
    scripts[:, 0] = 0
    return Model(languages, grid[:, :BUCKETS], scripts)


def _run(docs: DataFrame, model: Model, keep: list[str], text: str, columns: str, rows) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model))
    kept, key = [docs.schema[c] for c in keep], uuid.uuid4().hex
    (read,) = fresh(docs, "_text")

    def run(batches):
        own = worker_slot(("languages", key), lambda: shared.value[1])
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                values = rows(own, part.column(len(kept)).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(kept))), *values[1]], names=[*keep, *values[0]])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.select(*keep, F.col(text).alias(read)).mapInArrow(run, f"{fields}, {columns}")


def _verdicts(model: Model, texts: list[str | None]):
    names, scores = [], []
    for _, lengths, labels in label(model, texts):
        if not len(labels) or not model.languages:
            names.append("und")
            scores.append(0.0)
            continue
        letters = np.bincount(labels, weights=lengths, minlength=len(model.languages))
        top = int(letters.argmax())
        names.append(model.languages[top])
        scores.append(float(letters[top] / letters.sum()))
    return ["lang_pred", "score"], [pa.array(names, pa.string()), pa.array(scores, pa.float64())]


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, lang_pred and score of every document."""
    return _run(docs, model, [id_column], text, "lang_pred string, score double", _verdicts)


def _spans(model: Model, texts: list[str | None]):
    out = []
    for starts, lengths, labels in label(model, texts):
        if not len(labels) or not model.languages:
            out.append([])
            continue
        first = np.flatnonzero(np.diff(labels, prepend=-1))
        last = np.append(first[1:], len(labels)) - 1
        out.append([{"start": int(starts[a]), "end": int(starts[b] + lengths[b]), "lang": model.languages[labels[a]]} for a, b in zip(first, last)])
    return ["spans"], [pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])))]


def language_spans(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id and the spans of one language each: start and end (characters of the lower-cased text) and lang."""
    return _run(docs, model, [id_column], text, "spans array<struct<start: bigint, end: bigint, lang: string>>", _spans)


def held_out(id_column: str = "doc_id") -> Column:
    """Rows that training never sees."""
    return F.pmod(crc32_text(id_column), F.lit(4)) == 2


def known_share(model: Model, text: str | None) -> float:
    """The share of a text's letters that are in scripts training has seen."""
    letters = np.zeros(OTHER + 1, np.int64)
    points = code_points(text) if text else np.zeros(0, np.uint32)
    for low in range(0, len(points), BLOCK):
        letters += np.bincount(script_of()[np.minimum(points[low : low + BLOCK], 0x10FFFF)], minlength=OTHER + 1)
    letters[0] = 0
    return float(letters[~model.neutral].sum() / max(1, letters.sum()))


def keep_identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents that have a language, with their own columns.

    At least KNOWN_SHARE of a document's letters must be in scripts that training has seen: the words
    of other scripts score 0 in every language, so that they say nothing of the one found.
    """
    (verdict,) = fresh(docs, "lang_pred")

    def rows(model, texts):
        names = _verdicts(model, texts)[1][0].to_pylist()
        return [verdict], [pa.array([n if n == "und" or known_share(model, t) >= KNOWN_SHARE else "und" for n, t in zip(names, texts)], pa.string())]

    return _run(docs, model, docs.columns, text, f"`{verdict}` string", rows).where(F.col(verdict) != "und").drop(verdict)
