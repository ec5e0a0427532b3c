"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage calls one operator of ``regiocube.llm`` on all rows that the stage
before has kept; its result is written as Parquet to the shared folder and read
again. A cell of null, an empty or very long text, ties, repeated rows, an empty
table and further columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiocube.llm import language, mixing, packing, simhash, substring
from regiocube.llm.common import stored, table

#: The vocabulary that packing reads (a path of the machine's installed tokenizers).
VOCABULARY = "word_bpe_49k.json"
#: A document stays if its language makes up this share of its letters at least.
LEAST_SHARE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: rejects texts that are null or without a letter, and
    those in which no language has half of the letters. All columns stay as they are."""
    found = language.identify(docs, language.fit(docs.select("text", "lang")))
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SHARE)).select("row.*")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate component."""
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a smaller doc_id has too.

    A text that loses words becomes its other words joined by one space, and
    n_chars follows it; a text that loses none stays as it is. A document that
    loses all its words goes.
    """
    found = substring.dedup_substrings(docs, keep=docs.columns)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    left = found.where("n_removed = 0 or n_removed < n_words").withColumn("left", text)
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("left").cast("long")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("left"), "n_chars": n_chars}
    return left.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (0 to 3 times)."""
    return mixing.mixed(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mixing", source_mixing),
    ("sequence_packing", sequence_packing),
]

#: Token ids and XXH64 fingerprints are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
