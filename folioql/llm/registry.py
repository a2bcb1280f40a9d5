"""The queries of this subpackage: one per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from folioql.llm import dedup, langid, licenses, lm, matroska, ngram_join, oracle, packing, sharding, tokens, warc
from folioql.llm._common import table


def word_vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record for every page, read back by the record chain."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight runs of the Hilbert curve over lang, source and n_chars."""
    return sharding.hilbert_shards(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts by chunk recipes."""
    return dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces in sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_vocabulary())


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, and notices by set similarity, in every whole text."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingles overlap by 0.8 or more."""
    return ngram_join.components(table(spark, sf_dir, "documents"))


def op7_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every whole text, and of what they decode to."""
    return tokens.encode_digests(table(spark, sf_dir, "documents"), word_vocabulary())


def op8_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and model scores of every whole text."""
    return lm.score(table(spark, sf_dir, "documents"))


def op9_matroska_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as Matroska, read back and measured."""
    return matroska.media_digests(table(spark, sf_dir, "documents"))


def op10_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main language of every whole text, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, ~langid.held_out())
    return langid.identify(docs, model).withColumn("held_out", langid.held_out()).select("doc_id", "held_out", "lang_pred", "score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return oracle.SQL
