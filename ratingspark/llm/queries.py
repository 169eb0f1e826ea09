"""The registered queries of this subpackage, one for each operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, divergence, embeddings, hard_negatives, langid, lines, mixing, packing, secrets, simhash, spotsigs,
               suffix_dedup, token_files)
from .common import shared_folder, table

Query = Callable[[SparkSession, str], DataFrame]

#: Vocabulary of the token-file and packing queries.
VOCABULARY = "word_bpe_49k.json"


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    folder = shared_folder(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents", "doc_id", "text"),
                                  folder, public_tokenizers.path(VOCABULARY))
    return token_files.read_token_files(spark, folder)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, 2 bits."""
    found = simhash.groups(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of each label: cosine 0.93."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of all documents, its component and whether it stays."""
    found = lines.repeated(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "line_no", "component_id", "kept")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    samples = langid.learn(docs)
    found = langid.predict(docs.select("doc_id", langid.held_out().alias("held_out"), "text"), samples)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    found = secrets.scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id", *[secrets.counted("base", kind).alias(f"n_{kind}") for kind in secrets.KINDS[:3]],
        F.sha2(secrets.joined("base"), 256).alias("base_sha256"), secrets.joined("spans").alias("spans"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into windows of 2048 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"),
                                  public_tokenizers.path(VOCABULARY))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    shares = mixing.shares(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return shares.select("doc_id", "size", "source_size", "target", "taken")


def op9_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return spotsigs.fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles and canonical turns of every conversation."""
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return chat.format_chat(rows, chat.learn(rows))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every pair of sources of a language, and the terms behind it."""
    return divergence.divergence(table(spark, sf_dir, "documents", "lang", "source", "text"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every fiftieth vector, for each of its positives."""
    rows = hard_negatives.integer_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated strings of 400 bytes."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


LLM_QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_token_files, op2_simhash, op3_embeddings, op4_lines, op5_language, op6_secrets,
    op7_packing, op8_mixing, op9_spotsigs, op10_chat, op11_divergence,
    op12_hard_negatives, op13_suffix_dedup)}
