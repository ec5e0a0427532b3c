"""The registered queries opN_<name>, each with the production parameters of its operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiocube.llm import chat, editprint, language, lexical, mixing, neighbours, packing, secrets, simhash, structure, substring, tokens, warc
from regiocube.llm.common import table

#: The vocabulary that the token queries read (a path of the machine's installed tokenizers).
VOCABULARY = "word_bpe_49k.json"
#: Tokens above which a document is over the limit.
TOKEN_LIMIT = 2048


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text; learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held = language.held_out(F.col("doc_id"))
    model = language.fit(docs.where(~held & F.col("doc_id").isNotNull()).select("text", "lang"))
    found = language.identify(docs, model, keep=["doc_id"])
    return found.select("row.doc_id", language.held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score",
                        F.size("spans").cast("long").alias("n_spans"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the windows of 13 words that a smaller doc_id has too."""
    return substring.dedup_substrings(table(spark, sf_dir, "documents"), digest=True).select(
        "row.doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found for every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that quotes control strings, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    quoting = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                    F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(quoting)
    return chat.conversation_digests(chat.chat_windows(rows))


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to WARC archives and read back through their merged index."""
    index = warc.archive_and_index(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    found = simhash.simhash_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    found = mixing.allocate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces, packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op9_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit fingerprints of every document and its edited text, and its class of near copies."""
    return editprint.edit_fingerprints(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    found = tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return found.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with a fault in a quarter of their turns, drawn by crc32 of ``conv_id:turn`` (null: one space)."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(some("conv_id"), F.lit(":"), some("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", some("role").alias("role"), some("text").alias("text"), draw.alias("draw"))
    text = (F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    role = F.when(F.col("draw") == 4, structure.USER).otherwise(F.col("role"))
    copies = F.when(F.col("draw") == 3, 2).otherwise(1)
    return (rows.where("draw <> 0").withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
            .select("conv_id", "turn", role.alias("role"), text.alias("text")))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired by the cheapest edits."""
    conversations = table(spark, sf_dir, "conversations")
    found = structure.conversation_audits(structure.repair(damaged(conversations))).withColumnRenamed("conv_id", "repaired_id")
    known = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    whole = known.join(found, F.col("conv_id").eqNullSafe(F.col("repaired_id")), "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return whole.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text: the base patterns' matches, and windows of high entropy."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    of_kind = lambda k: F.filter("spans", lambda s: s["kind"] == k)
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != secrets.ENTROPY)
    return found.select("row.doc_id", *[F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in secrets.KINDS],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_language_id, op2_substring_dedup, op3_nearest_neighbours, op4_chat_formatting, op5_warc_archive, op6_simhash_dedup, op7_source_mixing, op8_sequence_packing,
        op9_edit_fingerprints, op10_token_counts, op11_structure_repair, op12_secret_scan, op13_lexical_search)
}
