"""Jaccard join on word n-grams with rare-first prefix filtering (operator 6).

Sets are the distinct n-word shingles of the whole text, as 64-bit hashes.  Two sets of which one has
more than |x| - ceil(t |x|) shingles that no other set holds can not be linked, whatever else they
share.  So:

1. equal word sequences are found by a 128-bit digest; one document stands for each;
2. a hash-dealt part of all shingles is counted over all documents, and documents with too many
   shingles of their own (already in that part) are put aside: they have no link;
3. the shingles of the others are counted exactly; each set is ordered rarest first (ties by hash),
   and the shingles of its prefix that others hold too are its postings;
4. postings meet on the shingle.  Length, positional and suffix bounds (the shared shingles behind
   the meeting point, and a parity sketch that bounds the symmetric difference from below) drop
   pairs before their sets are compared.  First each document is compared with the most central one
   it meets; then only pairs that are still in different components, in blocks of bounded size, of
   which only those of like set sizes meet;
5. links make components.

Every pair is verified on whole sets, once; links inside a component that is already known change
nothing and are not looked for.  Sets hold 64-bit hashes of shingles: two sets of some thousand
shingles meet a false common hash with a chance of about 10^-12.

Counting is done on packed arrays: a task sends a bucket of hashes as one byte string, and gets a
byte string of counts back, so the shuffle holds 6 to 10 bytes a shingle and no key is hot.  Buckets
are ranges of hashes; there are as many as bound the elements of each, whatever the corpus.

Edge cases: null and empty texts, and texts without words, have no shingles and no link.  With fewer
than `n` words the whole sequence is one shingle.  Texts of any length are read whole.  Rows that
share an id are one node of the graph.  Rows without an id are counted but have no component.  Ids
must be whole numbers or cast to them; others raise in ANSI mode.
An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from folioql.llm._common import attach_groups, batches_of, cut, fresh
from folioql.llm.graph import connected_components
from folioql.llm.wordhash import MULTIPLIER, grouped, mix

N, PERCENT = 5, 80
#: Share of the shingles that the first count looks at.
FIRST_SHARE = 0.4
#: Tables of up to so many rows (24 bytes each) are broadcast to the scan; larger ones are joined by shuffle.
BROADCAST_ROWS = 1_000_000
BLOCK = 512
SKETCH_BITS = 1024
#: Bytes of text whose words are hashed together.
TOGETHER = 1 << 20
#: A batch of sets closes at so many documents or elements.
BATCH_SETS, BATCH_ELEMENTS = 4096, 1_000_000
#: A bucket has about so many elements at most.
BUCKET_ELEMENTS = 16_000_000


def shingle_sets(texts: list[str | None], n: int = N):
    """For each text the sorted distinct shingle hashes and a digest of the word sequence (None without words)."""
    for words in grouped([t.encode("utf-8").lower() if t else b"" for t in texts], TOGETHER):
        yield from _sets(words.hashes, words.bounds, n)


def _sets(words: np.ndarray, bounds: np.ndarray, n: int):
    shingles = words[: max(0, len(words) - n + 1)].copy()
    for k in range(1, n):
        shingles = mix(shingles) + words[k : len(words) - n + 1 + k]
    shingles = mix(shingles)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= n:
            yield np.unique(shingles[a : b - n + 1]), hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest()
        elif b > a:
            digest = hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest()
            yield np.frombuffer(digest[:8], np.uint64), digest  # a shorter sequence is a shingle of its own
        else:
            yield np.zeros(0, np.uint64), None


def _table(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) for k, t in kinds.items()], names=list(kinds))


def _buckets(df: DataFrame, elements: int) -> int:
    return max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-elements // BUCKET_ELEMENTS))


def _spread(batch: int, rows: int, buckets: int) -> list[int]:
    """A bucket for each row of a batch, by a mixed hash of its place."""
    place = np.uint64(batch * MULTIPLIER % 2**64) + np.arange(rows, dtype=np.uint64)
    return (mix(mix(place)) % np.uint64(buckets)).astype(np.int64).tolist()


def _dealt(sets: list[np.ndarray], buckets: int, width: int):
    """The elements of a batch of sets by bucket: (bucket, sorted elements, owners), elements cut to `width` bytes."""
    elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owners = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
    order = np.argsort(elements, kind="stable")
    elements, owners = elements[order], owners[order]
    step = (1 << 64) // buckets + 1
    cuts = np.searchsorted(elements, np.array([k * step for k in range(1, buckets)], np.uint64))
    for k, (e, o) in enumerate(zip(np.split(elements, cuts), np.split(owners, cuts))):
        if len(e):
            yield k, e.astype(f"<u{width}").tobytes(), o.tobytes()


def _each(batches, id_column: str, text: str, n: int):
    """id, set and digest of each text."""
    for whole in batches:
        for low in range(0, whole.num_rows, 512):
            ids, texts = batches_of(whole.slice(low, 512), id_column, text)
            yield from ((i, own, digest) for i, (own, digest) in zip(ids, shingle_sets(texts, n)))


def _numbered(rows):
    """Runs of sets of bounded size, each with a number of its own."""
    group, held, count = [], 0, 0
    for row in rows:
        group.append(row)
        held += len(row[1])
        if held >= BATCH_ELEMENTS or len(group) == BATCH_SETS:
            yield TaskContext.get().partitionId() << 32 | count, group
            group, held, count = [], 0, count + 1
    if group:
        yield TaskContext.get().partitionId() << 32 | count, group


# --- 2: documents that can have no link ---------------------------------------------------------


def _described(docs: DataFrame, id_column: str, text: str, n: int, percent: int, share: float) -> DataFrame:
    """id, digest, size n and `own`, the shingles in the counted part that no other document holds."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text) + 1), F.lit(0))).first()[0]
    buckets = _buckets(docs, int(share * size) // 2)  # a word takes two bytes at least
    kind = docs.schema[id_column].dataType
    key = to_arrow_type(kind)
    wire = {"bucket": pa.int32(), "batch": pa.int64(), "elements": pa.binary(), "owners": pa.binary(), "at": pa.int32(), "id": key, "digest": pa.binary(), "n": pa.int64()}
    bound = np.uint64(int(share * 2.0**64)) if share < 1 else np.uint64(2**64 - 1)

    def send(batches):
        for batch, group in _numbered(_each(batches, id_column, text, n)):
            out: dict[str, list] = {k: [] for k in wire}
            for at, (bucket, (i, own, digest)) in enumerate(zip(_spread(batch, len(group), buckets), group)):
                for k, v in zip(wire, (bucket, batch, None, None, at, i, digest, len(own))):
                    out[k].append(v)
            # hashes are mixed again, so that the counted part is spread over all buckets
            for b, e, o in _dealt([own[mix(own) <= bound] for _, own, _ in group], buckets, 4):
                for k, v in zip(wire, (b, batch, e, o, None, None, None, None)):
                    out[k].append(v)
            yield _table(out, wire)

    back = {"batch": pa.int64(), "at": pa.int32(), "id": key, "digest": pa.binary(), "n": pa.int64(), "own": pa.binary()}

    def count(table: pa.Table) -> pa.Table:
        docs_ = table.filter(pc.is_valid(table["at"])).select(["batch", "at", "id", "digest", "n"])
        blobs = table.filter(pc.is_valid(table["elements"]))
        docs_ = docs_.append_column("own", pa.nulls(len(docs_), pa.binary()))
        if not len(blobs):
            return docs_
        parts = [np.frombuffer(x, "<u4") for x in blobs["elements"].to_pylist()]
        _, inverse, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        alone = np.split(counts[inverse] == 1, np.cumsum([len(p) for p in parts])[:-1])
        out = {"batch": blobs["batch"].to_pylist(), "own": []}
        for o, single in zip(blobs["owners"].to_pylist(), alone):
            out["own"].append(np.bincount(np.frombuffer(o, np.uint16)[single], minlength=1).astype("<u4").tobytes())
        rest = pa.table({k: pa.array(out[k], t) if k in out else pa.nulls(len(blobs), t) for k, t in back.items()})
        return pa.concat_tables([docs_, rest])

    def gather(table: pa.Table) -> pa.Table:
        rows = table.filter(pc.is_valid(table["at"])).sort_by("at")
        own = np.zeros(len(rows), np.int64)
        for x in table["own"].to_pylist():
            if x:
                part = np.frombuffer(x, "<u4")
                own[: len(part)] += part
        return pa.table({"id": rows["id"], "digest": rows["digest"], "n": rows["n"], "own": pa.array(own)})

    name = kind.simpleString()
    sent = docs.select(id_column, text).mapInArrow(send, f"bucket int, batch long, elements binary, owners binary, at int, id {name}, digest binary, n long")
    counted = sent.groupBy("bucket").applyInArrow(count, f"batch long, at int, id {name}, digest binary, n long, own binary")
    return counted.groupBy("batch").applyInArrow(gather, f"id {name}, digest binary, n long, own long")


# --- 3: rare-first prefixes ---------------------------------------------------------------------


def _alive_sets(docs: DataFrame, alive: DataFrame, id_column: str, text: str, n: int) -> DataFrame:
    """batch, at, id and set (sorted hashes) of the documents that may have a link."""
    few = alive.count() <= BROADCAST_ROWS
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).join(F.broadcast(alive) if few else alive, "id")

    def run(batches):
        # the wanted digest travels as part of the key: rows may share an id
        for batch, group in _numbered(_each(batches, "key", "text", n)):
            kept = [(k["id"], own.tobytes()) for k, own, digest in group if k["digest"] == digest]
            yield pa.RecordBatch.from_pydict({"batch": pa.array([batch] * len(kept), pa.int64()), "at": pa.array(range(len(kept)), pa.int32()), "id": pa.array([i for i, _ in kept], pa.int64()), "set": pa.array([x for _, x in kept], pa.binary())})

    return chosen.select(F.struct(F.col("id").cast("long").alias("id"), "digest").alias("key"), "text").mapInArrow(run, "batch long, at int, id long, set binary")


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """For sets that may have a link: id, n, shared, sketch, and the postings of its prefix (shingle, place)."""
    buckets = _buckets(sets, sets.agg(F.coalesce(F.sum(F.octet_length("set")), F.lit(0))).first()[0] // 8)
    wire = {"bucket": pa.int32(), "batch": pa.int64(), "elements": pa.binary()}

    def send(batches):
        group: dict = {}

        def flush():
            for batch, rows in group.items():
                rows.sort(key=lambda r: r[0])
                dealt = [(b, batch, e) for b, e, _ in _dealt([np.frombuffer(raw, np.uint64) for _, raw in rows], buckets, 8)]
                yield _table(dict(zip(wire, map(list, zip(*dealt)))) if dealt else {k: [] for k in wire}, wire)
            group.clear()

        for part in batches:
            for batch, at, raw in zip(*batches_of(part, "batch", "at", "set")):
                if batch not in group and group:
                    yield from flush()
                group.setdefault(batch, []).append((at, raw))
        yield from flush()

    def count(blobs: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, "<u8") for x in blobs["elements"].to_pylist()]
        _, inverse, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        split = np.split(np.minimum(counts, 65535)[inverse].astype("<u2"), np.cumsum([len(p) for p in parts])[:-1])
        return pa.table({"batch": blobs["batch"], "bucket": blobs["bucket"], "counts": pa.array([x.tobytes() for x in split], pa.binary())})

    done = {"id": pa.int64(), "n": pa.int64(), "shared": pa.int64(), "sketch": pa.binary(), "set": pa.binary(), "shingles": pa.list_(pa.int64()), "places": pa.list_(pa.int64())}

    def order(rows: pa.Table, blobs: pa.Table) -> pa.Table:
        rows, blobs = rows.sort_by("at"), blobs.sort_by("bucket")
        raws = rows["set"].to_pylist()
        sets_ = [np.frombuffer(r, np.uint64) for r in raws]
        elements = np.concatenate(sets_)
        owners = np.repeat(np.arange(len(sets_)), [len(s) for s in sets_])
        by_element = np.argsort(elements, kind="stable")  # as they were sent
        df = np.empty(len(elements), np.int64)
        df[by_element] = np.concatenate([np.frombuffer(x, "<u2") for x in blobs["counts"].to_pylist()])
        ends = np.cumsum([len(s) for s in sets_])
        out: dict[str, list] = {k: [] for k in done}
        for i, own, raw, end in zip(rows["id"].to_pylist(), sets_, raws, ends):
            counts = df[end - len(own) : end]
            size, alone = len(own), int(np.count_nonzero(counts == 1))
            prefix = size - -(-percent * size // 100) + 1
            if alone >= prefix:
                continue
            shared = own[counts > 1]
            rank = np.lexsort((shared, counts[counts > 1]))[: prefix - alone]
            sketch = np.packbits((np.bincount((own & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)).tobytes()
            for k, v in zip(done, (i, size, size - alone, sketch, raw, shared[rank].view(np.int64).tolist(), list(range(alone, alone + len(rank))))):
                out[k].append(v)
        return pa.table({k: pa.array(out[k], t) for k, t in done.items()})

    sent = sets.mapInArrow(send, "bucket int, batch long, elements binary")
    counted = sent.groupBy("bucket").applyInArrow(count, "batch long, bucket int, counts binary")
    # the sets themselves only move to their batch's counts
    return sets.groupBy("batch").cogroup(counted.groupBy("batch")).applyInArrow(order, "id long, n long, shared long, sketch binary, set binary, shingles array<long>, places array<long>")


# --- 4: pairs -----------------------------------------------------------------------------------


def _need(n1, n2, percent: int):
    """The smallest intersection of linked sets of these sizes: 100 i >= percent (n1 + n2 - i)."""
    return -(-percent * (n1 + n2) // (100 + percent))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) that are linked, by their whole sets.

    A set that is in many pairs is one key of a sort-merge join without aggregation above it, whose
    partitions adaptive execution splits.
    """
    left = sets.select(F.col("id").alias("x"), F.col("set").alias("sx"))
    right = sets.select(F.col("id").alias("y"), F.col("set").alias("sy"))
    both = pairs.join(left, "x").join(right, "y")

    def run(batches):
        for batch in batches:
            keep = []
            for k, (a, b) in enumerate(zip(*batches_of(batch, "sx", "sy"))):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                same = len(a) + len(b) - len(np.union1d(a, b))
                if 100 * same >= percent * (len(a) + len(b) - same):
                    keep.append(k)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)).take(pa.array(keep, pa.int64())) for c in ("x", "y")], names=["x", "y"])

    return both.select("x", "y", "sx", "sy").mapInArrow(run, "x long, y long")


def _survivors(percent: int):
    """Pairs of a sorted stream of groups (shingle, block a, block b) that no bound rules out."""

    def pairs(rows: dict[str, np.ndarray], sketches: np.ndarray):
        n, s, at, who, part, side = (rows[k] for k in ("n", "shared", "place", "id", "component", "side"))
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        for low in range(0, len(left), 256):
            a = left[low : low + 256]
            need = _need(n[a][:, None], n[right], percent)
            ok = (part[a][:, None] != part[right]) & (who[a][:, None] != who[right])
            ok &= np.minimum(s[a][:, None], s[right]) >= need
            ok &= np.minimum((n - at)[a][:, None], (n - at)[right]) >= need
            i, j = np.nonzero(ok)
            i, j = a[i], right[j]
            if len(i):
                # a sketch's differing bits are at most the symmetric difference
                apart = np.bitwise_count(sketches[i] ^ sketches[j]).sum(axis=1, dtype=np.int64)
                close = (n[i] + n[j] - apart) >= 2 * _need(n[i], n[j], percent)
                yield np.minimum(who[i], who[j])[close], np.maximum(who[i], who[j])[close]

    def run(batches):
        names = ("h", "a", "b", "side", "id", "n", "shared", "place", "component")
        held: dict[str, np.ndarray] | None = None
        held_sketch = np.zeros((0, SKETCH_BITS // 64), np.uint64)

        def done(rows, sketches):
            cuts = np.flatnonzero((np.diff(rows["h"]) != 0) | (np.diff(rows["a"]) != 0) | (np.diff(rows["b"]) != 0)) + 1
            found = [np.zeros((2, 0), np.int64)]
            for low, high in zip([0, *cuts], [*cuts, len(rows["h"])]):
                if high - low > 1:
                    found += [np.stack(p) for p in pairs({k: v[low:high] for k, v in rows.items()}, sketches[low:high])]
            both = np.unique(np.concatenate(found, axis=1), axis=1)
            return pa.RecordBatch.from_pydict({"x": pa.array(both[0]), "y": pa.array(both[1])})

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {k: batch.column(batch.schema.get_field_index(k)).to_numpy() for k in names}
            sketch = np.frombuffer(b"".join(batches_of(batch, "sketch")[0]), np.uint64).reshape(-1, SKETCH_BITS // 64)
            if held is not None:
                rows = {k: np.concatenate([held[k], v]) for k, v in rows.items()}
                sketch = np.concatenate([held_sketch, sketch])
            # the last group may go on in the next batch
            open_ = (rows["h"] == rows["h"][-1]) & (rows["a"] == rows["a"][-1]) & (rows["b"] == rows["b"][-1])
            first = int(np.argmax(open_))
            if first:
                yield done({k: v[:first] for k, v in rows.items()}, sketch[:first])
            held, held_sketch = {k: v[first:] for k, v in rows.items()}, sketch[first:]
        if held is not None:
            yield done(held, held_sketch)

    return run


def dealt_in_blocks(postings: DataFrame, percent: int) -> DataFrame:
    """Postings of shingles (h, held by c) in pairs of blocks (a, b) that may hold a linked pair; side 2 is both.

    Sizes of linked sets differ by a factor of 100 / percent at most.  So the postings of a frequent
    shingle are dealt by classes of size, of which only the same and neighbours meet, and these into
    blocks of about BLOCK.
    """
    step = math.log(100 / percent * 1.001)  # a little more than the factor, against rounding
    postings = postings.withColumn("class", F.when(F.col("c") > BLOCK, F.floor(F.log("n") / F.lit(step))).otherwise(0).cast("int"))
    sizes = postings.where(F.col("c") > BLOCK).groupBy("h", "class").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    sizes = sizes.groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("class", "blocks"))).alias("blocks"))
    lone = lambda k: F.when((F.col("c") <= BLOCK) & (k == 0), 1).otherwise(0)  # noqa: E731  a rare shingle is one block
    found = lambda k: F.coalesce(F.try_element_at("blocks", k), lone(k))
    block = lambda k, at: k.cast("long") * F.lit(1 << 32) + at

    def pairs(k: Column, make) -> Column:
        return F.when(found(k) > 0, F.transform(F.sequence(F.lit(0), F.greatest(found(k), F.lit(1)) - 1), make)).otherwise(F.array().cast("array<struct<a: bigint, b: bigint, side: int>>"))

    pair = lambda a, b, side: F.struct(a.alias("a"), b.alias("b"), side.cast("int").alias("side"))
    k = F.col("class")
    dealt = postings.join(sizes, "h", "left").withColumn("own", F.pmod(F.xxhash64("id"), found(k)).cast("int"))
    own = F.col("own")
    same = pairs(k, lambda o: pair(block(k, F.least(own, o)), block(k, F.greatest(own, o)), F.when(own == o, 2).when(own < o, 0).otherwise(1)))
    above = pairs(k + 1, lambda o: pair(block(k, own), block(k + 1, o), F.lit(0)))
    below = pairs(k - 1, lambda o: pair(block(k - 1, o), block(k, own), F.lit(1)))
    dealt = dealt.select("h", "id", "n", "shared", "place", "component", F.explode(F.concat(same, above, below)).alias("p"))
    return dealt.select("h", "p.a", "p.b", "p.side", "id", "n", "shared", "place", "component")


def links(members: DataFrame, percent: int) -> DataFrame:
    """Links (x, y) that span every component of the sets in `members`."""
    postings = members.select("id", "n", "shared", F.explode(F.arrays_zip("shingles", "places")).alias("p")).select("id", "n", "shared", F.col("p.shingles").alias("h"), F.col("p.places").alias("place"))
    postings = cut(postings)
    central = F.struct(((F.col("n") - F.col("shared")) / F.col("n")).alias("alone"), F.col("id").alias("y"), F.col("n").alias("n2"), F.col("shared").alias("s2"))
    pivots = cut(postings.groupBy("h").agg(F.count("*").alias("c"), F.min(central).alias("pivot")).where("c > 1"))
    need = F.ceil(F.lit(percent) * (F.col("n") + F.col("pivot.n2")) / F.lit(100 + percent))
    met = postings.join(pivots, "h").where((F.col("id") != F.col("pivot.y")) & (F.least("shared", "pivot.s2") >= need))
    central = met.groupBy("id").agg(F.min("pivot").alias("p"))
    first = cut(central.select(F.least("id", "p.y").alias("x"), F.greatest("id", "p.y").alias("y")).distinct())
    sets = members.select("id", "set")
    one = cut(verified(first, sets, percent))
    component = cut(connected_components(one.select(F.col("x").alias("u"), F.col("y").alias("v"))))
    # what is left: shingles whose postings are in several components
    labelled = postings.join(component.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    labelled = cut(labelled)
    mixed = labelled.groupBy("h").agg(F.count("*").alias("c"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    dealt = dealt_in_blocks(labelled.join(mixed.select("h", "c"), "h"), percent).join(members.select("id", "sketch"), "id")
    dealt = dealt.repartition("h", "a", "b").sortWithinPartitions("h", "a", "b")
    met_again = dealt.mapInArrow(_survivors(percent), "x long, y long").distinct()
    two = verified(met_again.join(first, ["x", "y"], "left_anti"), sets, percent)
    return one.union(two)


def components(docs: DataFrame, id_column: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT, first_share: float = FIRST_SHARE) -> DataFrame:
    """One row per document: id, n_shingles and component_id (the smallest id that links reach)."""
    rows = cut(_described(docs, id_column, text, n, percent, first_share))
    groups = cut(rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("id").cast("long").alias("rep"), F.count("*").alias("copies"), F.min("n").alias("n"), F.min("own").alias("own")))
    alive = groups.where((F.col("own") <= F.col("n") - F.ceil(F.lit(percent) * F.col("n") / F.lit(100))) & F.col("rep").isNotNull()).select(F.col("rep").alias("id"), "digest")
    sets = cut(_alive_sets(docs, cut(alive), id_column, text, n))
    members = cut(_postings(sets, percent))
    found = connected_components(links(members, percent).select(F.col("x").alias("u"), F.col("y").alias("v")))
    named = groups.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("digest", "copies", "rep", F.coalesce("component", "rep").alias("component"))
    # a text without copies and links needs no lookup
    named = named.where("copies > 1 OR component <> rep").drop("rep")
    total = groups.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    linked = cut(named)
    attached = attach_groups(rows, linked, "digest", "copies", total)
    return attached.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component", F.col("id").cast("long"))).alias("component_id"))


def keep_representatives(docs: DataFrame, id_column: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """One document of each component stays, with its own columns; rows without an id stay."""
    (at,) = fresh(docs, "_gone")
    gone = components(docs, id_column, text, n, percent).where(F.col(id_column) != F.col("component_id")).select(F.col(id_column).alias(at)).distinct()
    return docs.join(gone, F.col(id_column) == F.col(at), "left_anti")
