"""Vector best-fit packing of tokenised documents into sequences (operator 4).

Pieces have three demands: tokens, documents (1) and attention cost (length squared).  A sequence has
a capacity for each.  Longest pieces go first; a piece goes to the open sequence that can take it
under every constraint and that has the smallest weighted norm of residual capacities afterwards
(`rule="norm"`) or the largest weighted dot product of demands and residuals (`rule="dot"`).

With the default capacities only tokens can bind (a sequence of 2048 tokens has at most 2048 documents,
and no more attention cost than one full piece), so the weights choose between pieces' equals only;
`max_documents` or `max_attention` below that make the other two bind, and the tests hold such runs.

Pieces are written once, without their ids, and packed in cells dealt out by a hash of their row in
that table: a cell has about `cell_rows` pieces whatever the corpus, and leaves at most its last few
sequences part-filled, so the loss against one global packing is a few sequences in some thousands.
No cell depends on any value, so hot sources, groups of copies and repeated ids spread evenly.

Edge cases: null and empty texts are one piece, the separator alone.  Longer documents are cut into
full pieces and a remainder; nothing else is cut.  Repeated rows are packed as rows of their own.
An empty table gives no pieces.  Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioql.llm._common import batches_of, cut
from folioql.llm.tokens import encoder

MAX_TOKENS = 2048
CELL_ROWS = 8192
#: Weights of tokens, documents and attention cost in the rules.
WEIGHTS = (1.0, 0.01, 0.05)


def token_pieces(docs: DataFrame, vocabulary: str, max_tokens: int = MAX_TOKENS, separator: int = 0, id_column: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Documents as pieces of at most `max_tokens` ids: id, piece, start, length, ids_crc32 (and ids)."""

    def run(batches):
        own = encoder(vocabulary, shown=False)
        tail = int(separator).to_bytes(4, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keys, texts = batches_of(part, id_column, text)
                out: dict[str, list] = {id_column: [], "piece": [], "start": [], "length": [], "ids_crc32": []} | ({"ids": []} if with_ids else {})
                for key, raw in zip(keys, own.ids_batch(texts)):
                    raw += tail
                    for piece, low in enumerate(range(0, len(raw), 4 * max_tokens)):
                        body = raw[low : low + 4 * max_tokens]
                        row = (key, piece, low // 4, len(body) // 4, zlib.crc32(body))
                        for values, v in zip(out.values(), row):
                            values.append(v)
                        if with_ids:
                            out["ids"].append(np.frombuffer(body, "<u4").tolist())
                yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(out, types)], names=list(out))

    kind = docs.schema[id_column].dataType.simpleString()
    # the key's own Arrow type comes with the first column; lists of ids are 64-bit because ids are unsigned
    types = [_arrow(docs, id_column), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    return docs.select(id_column, text).mapInArrow(run, f"`{id_column}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids)


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def best_fit(lengths: np.ndarray, max_tokens: int, max_documents: int, max_attention: int, weights=WEIGHTS, rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; lengths must not exceed `max_tokens`."""
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    capacity = np.array([max_tokens, max_documents, max_attention], float)
    scale = np.array(weights, float)
    order = np.argsort(-lengths, kind="stable")
    shortest = int(lengths.min()) if n else 0
    free = np.empty((n, 3))  # residual capacities of open sequences, as shares of the whole
    names, used, opened, top = np.empty(n, np.int64), np.zeros(n, np.int64), 0, 0
    for k in order:
        size = int(lengths[k])
        demand = np.array([size, 1, float(size) * size]) / capacity
        fits = (free[:top] >= demand - 1e-12).all(axis=1)
        if fits.any():
            at = np.flatnonzero(fits)
            rest = free[at] - demand
            score = (rest * rest * scale).sum(axis=1) if rule == "norm" else -(free[at] * demand * scale).sum(axis=1)
            slot = int(at[score.argmin()])
        else:
            slot, top, opened = top, top + 1, opened + 1
            free[slot], names[slot], used[slot] = 1.0, opened - 1, 0
        bins[k], offsets[k] = names[slot], used[slot]
        free[slot] -= demand
        used[slot] += size
        full = max_tokens - used[slot] < shortest or (free[slot, 1:] < np.array([1, float(shortest) ** 2]) / capacity[1:] - 1e-12).any()
        if full:  # nothing to come fits: the last open sequence takes its slot
            top -= 1
            free[slot], names[slot], used[slot] = free[top], names[top], used[top]
    return bins, offsets


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS, max_documents: int | None = None, max_attention: int | None = None, id_column: str = "doc_id", cell_rows: int = CELL_ROWS, weights=WEIGHTS, rule: str = "norm") -> DataFrame:
    """`pieces` with sequence_id and offset.

    By default only tokens bind: at most one document per token, and the cost of one full piece.
    """
    documents, attention = max_documents or max_tokens, max_attention or max_tokens**2
    if attention < max_tokens**2:
        raise ValueError("max_attention must admit one full piece")
    pieces = cut(pieces)  # what follows numbers its rows
    cells = max(1, -(-pieces.count() // cell_rows))

    def run(cell: pa.Table) -> pa.Table:
        # ties are broken by the piece's own values, so that a lost task gives the same packing again
        cell = cell.sort_by([(c, "ascending") for c in (id_column, "piece", "ids_crc32")])
        bins, offsets = best_fit(cell["length"].to_numpy(), max_tokens, documents, attention, weights, rule)
        sequence = (cell["cell"].to_numpy().astype("int64") << 32) + bins
        return cell.drop_columns("cell").append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offsets))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    celled = pieces.withColumn("cell", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(cells)))
    return celled.groupBy("cell").applyInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """Tokenise and pack whole documents."""
    max_tokens = limits.get("max_tokens", MAX_TOKENS)
    return pack(token_pieces(docs, vocabulary, max_tokens, id_column=id_column, text=text), id_column=id_column, **limits)
