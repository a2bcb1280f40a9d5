"""Exact deduplication by content-defined chunk recipes (operator 3), in DataFrame functions only.

Texts are cut at content-defined places into chunks; a chunk's fingerprint is 64 bits, and chunks
with equal fingerprints are verified against each other by their SHA-256.  Fingerprints that stand
for one chunk only are its identifier; the few that do not are told apart by a rank.  A document is
then its ordered list of identifiers, and documents are equal when the lists are.  Texts and chunks
never leave the scan: only fingerprints, digests and lists are shuffled.

Edge cases: null and empty texts are equal to each other.  Texts of any length are cut whole.  Of
equal texts the row with the largest id stays; rows that share that id stay together (repeated rows
are copies with one id).  A null id never wins over another.  An empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioql.llm._common import attach_groups, cut, fresh

#: Chunks have about MEAN_CHARS characters, and MAX_CHARS at most; longer sentences are cut between words.
MEAN_CHARS, MAX_CHARS, LONG_SENTENCE = 1024, 8192, 1024
#: Tables of up to so many rows (fingerprint, digest and rank) are broadcast.
BROADCAST_ROWS = 1_000_000
_ENDS, _MARK = r"[.!?\n。！？]", "\x01"


def chunks(text: Column, mean: int = MEAN_CHARS, most: int = MAX_CHARS, long: int = LONG_SENTENCE) -> Column:
    """The chunks of a text in order; their concatenation is the text.

    Candidates for a cut are the ends of sentences and lines, and of words in sentences of more than
    `long` characters.  A candidate is taken when the hash of what it ends, modulo `mean`, is below
    that unit's length: so a chunk has about `mean` characters, and every cut depends on the one unit
    before it, not on its position or on other cuts.  What is still longer than `most` (text without
    white space) is cut at fixed places of its own chunk.
    """
    text = F.replace(text, F.lit(_MARK), F.lit(_MARK + "\x02"))  # a mark of the text's own is told from a cut
    sentences, words = F.split(text, f"(?<={_ENDS})"), lambda s: F.split(s, r"(?<=\s)")
    marked = lambda u: F.when(F.pmod(F.xxhash64(u), F.lit(mean)) < F.length(u), F.concat(u, F.lit(_MARK + "\x03"))).otherwise(u)
    units = F.transform(sentences, lambda s: F.when(F.length(s) > long, F.array_join(F.transform(words(s), marked), "")).otherwise(marked(s)))
    whole = F.filter(F.split(F.array_join(units, ""), _MARK + "\x03"), lambda c: c != "")
    short = F.flatten(F.transform(whole, lambda c: F.when(F.length(c) > most, F.regexp_extract_all(c, F.lit(rf"(?s).{{1,{most}}}"), F.lit(0))).otherwise(F.array(c))))
    return F.transform(short, lambda c: F.replace(c, F.lit(_MARK + "\x02"), F.lit(_MARK)))


def recipes(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, text_sha256 and `recipe`, the ordered identifiers of its chunks."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id_column),
        F.octet_length(whole).cast("long").alias("n_bytes"),
        F.sha2(whole.cast("binary"), 256).alias("text_sha256"),
        F.transform(chunks(whole), lambda c: F.struct(F.xxhash64(c).alias("key"), F.unhex(F.sha2(c.cast("binary"), 256)).alias("digest"))).alias("parts"),
    )
    rows = cut(rows)
    known = rows.select(F.explode("parts").alias("p")).select("p.key", "p.digest").groupBy("key", "digest").agg(F.count("*").alias("n"))
    # Fingerprints of several chunks: of n distinct chunks about n^2 / 2^65 pairs, some hundreds among 10^11.
    clash = known.groupBy("key").agg(F.count("*").alias("chunks"), F.sort_array(F.collect_list("digest")).alias("digests")).where("chunks > 1")
    ranks = cut(clash.select(F.col("key").alias("_k"), F.posexplode("digests").alias("rank", "_d")).where("rank > 0"))
    plain = F.transform("parts", lambda p: p["key"])
    clashes = ranks.count()
    if not clashes:
        return rows.select(id_column, "n_bytes", "text_sha256", plain.alias("recipe"))
    ranks = F.broadcast(ranks) if clashes <= BROADCAST_ROWS else ranks
    moved = rows.select("n_bytes", "text_sha256", F.posexplode("parts").alias("at", "p")).join(ranks, (F.col("p.key") == F.col("_k")) & (F.col("p.digest") == F.col("_d")))
    # a recipe that holds such a chunk carries the ranks after the fingerprints
    fixes = moved.groupBy("text_sha256", "n_bytes").agg(F.sort_array(F.collect_set(F.struct("at", "rank"))).alias("fixes"))
    ranked = F.concat(plain, F.transform("fixes", lambda f: f["at"].cast("long")), F.transform("fixes", lambda f: f["rank"].cast("long")))
    joined = rows.join(fixes, ["text_sha256", "n_bytes"], "left")
    return joined.select(id_column, "n_bytes", "text_sha256", F.when(F.col("fixes").isNull(), plain).otherwise(ranked).alias("recipe"))


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    rows = recipes(docs, id_column, text).select(id_column, "text_sha256", F.struct("n_bytes", "recipe").alias("same"))
    groups = cut(rows.groupBy("same").agg(F.max(id_column).alias("keep_id"), F.count("*").alias("group_size")))
    total = groups.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    # most texts stand alone: they need no lookup
    found = attach_groups(rows, groups.where("group_size > 1"), "same", "group_size", total)
    keep = F.coalesce("keep_id", id_column)
    return found.select(id_column, keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), F.col(id_column).eqNullSafe(keep).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their own columns.  Where no copy has an id, all of them stay."""
    at, sha = fresh(docs, "_gone", "_gone_sha")
    gone = exact_duplicates(docs, id_column, text).where(~F.col("kept")).select(F.col(id_column).alias(at), F.col("text_sha256").alias(sha)).distinct()
    whole = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    return docs.join(gone, F.col(id_column).eqNullSafe(F.col(at)) & (whole == F.col(sha)), "left_anti")
