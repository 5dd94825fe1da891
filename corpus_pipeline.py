"""A corpus pipeline: language, near-duplicates, personal data, mix, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept; all but the last return the columns of ``documents``, and
further columns of ``docs``, whatever their names, stay. Empty tables give
empty results, and very long texts are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lymphlake.llm import bpe, langid, minhash, mixing, pii
from lymphlake.plans.tables import table, written

VOCABULARY = "byte_bpe_50k.tiktoken"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language the network can tell.

    Null and empty texts, texts without letters and texts with a score under
    the threshold go. Repeated rows share their verdict. If no row has a
    label, nothing is learned and all rows stay.
    """
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each near-duplicate group, the one of the smallest id.

    Ties: the smallest text digest, then the smallest hash of all columns, so
    of repeated rows one stays. Rows without id come last. Null texts and
    texts without words are no copies of each other: all of them stay.
    """
    return minhash.keep_first(docs, once=True)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts; no document goes. Null and empty texts stay as they are."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents to the sources' target weights; one taken twice is there twice.

    A null source is a source of its own. Texts without words have no size, so
    the mix takes none of them. Repeated rows are documents of their own.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # travels whole, so that no name can clash
    mixed = mixing.fair_mix(docs.select(row.alias("row"), "doc_id", "source", mixing.n_words(F.col("text")).alias("words")), size="words")
    copies = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    return mixed.select("row", F.explode(F.array_repeat(F.lit(1), copies))).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with their number; workers decode them and compare with the text. Null text: no ids."""
    ids = bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, ["doc_id", "lang", "source"], decoded=False)
    return ids.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mix", mix), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The network of the first stage has no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None
