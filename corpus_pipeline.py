"""The corpus pipeline: language identification, exact and near deduplication, packing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept.  All but the last
return the columns of `documents`; `run` writes each stage as Parquet in the shared folder and
reads it back as the next one's docs.

In every stage nulls may stand in any column, texts may be empty or very long, columns beside those of
`documents` are carried on (whatever their names), and an empty table gives an empty one.  What each
stage makes of null texts, missing ids, ties and repeated rows is said with it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from folioql.llm import dedup, langid, ngram_join, packing
from folioql.llm._common import shared_dir, ship, table
from folioql.llm.registry import word_vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is found (no text, no letter, or mostly scripts that training never saw) go.

    Null and empty texts go.  Repeated rows are judged each by itself and alike; ids play no part but
    to choose the rows that are learned from.
    """
    ship(spark)
    return langid.keep_identified(docs, langid.fit(docs, ~langid.held_out()))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays.

    Null counts as empty.  Rows that are equal in text and id stay together; a row without an id gives
    way to one with an id, and where no copy has one, all stay.
    """
    ship(spark)
    return dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word shingles (Jaccard 0.8 or more) the smallest id stays.

    Texts without words have no link and stay, as do rows without an id; rows that share an id stay or
    go together.
    """
    ship(spark)
    return ngram_join.keep_representatives(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset.

    A null or empty text is one piece of the separator; long ones are cut into full pieces and a rest.
    Repeated rows are packed each by itself.
    """
    ship(spark)
    return packing.pack_documents(docs, word_vocabulary())


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("best_fit_packing", pack_sequences),
]

#: Components and packing are no SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole `documents` table."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4()}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
