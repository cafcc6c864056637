"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (chat_format, filter_audit, fingerprints, language_id, lm_scoring, merkle, mixing, packing, quality_rules, secret_scans,
               simhash_dedup, token_counts, token_files)
from .common import ship, table
from .oracles import ORACLES  # noqa: F401


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_words(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "first_place")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """The documents packed by the 50k byte-level vocabulary, whose files' places are parameters."""
    import public_tokenizers

    return packing.pack(docs, tokenizer("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                        capacity=1024, end_id=0)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), limit=4096)


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("secret_spans")
    scanned = secret_scans.scan(table(spark, sf_dir, "documents"))
    return scanned.select(
        "doc_id", *[secret_scans.count_kind(found, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secret_scans.joined(found, ("assign", "access", "hex")), 256).alias("base_sha256"),
        secret_scans.joined(found).alias("spans"), secret_scans.count_kind(found, "novel").alias("n_novel"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.score(table(spark, sf_dir, "documents"))
    return scored.withColumns({c: F.round(c, 6) for c in ("log_score", "mean_log_score")})


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    calls, results = chat_format.turns_as_calls(conversations)
    return chat_format.link(calls, results, chat_format.REPLY, context=chat_format.other_turns(conversations))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.classes(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), folder, tokenizer("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.tiktoken"),
                      public_tokenizers.PATTERN, end_id=0)
    return token_files.read(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"), merkle.tampered_text())


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {f.__name__: _shipped(f) for f in (op1_mixing, op2_language_id, op3_fingerprints, op4_packing, op5_token_counts, op6_secret_scans, op7_lm_scoring,
                                             op8_quality_rules, op9_chat_format, op10_simhash_dedup, op11_filter_audit, op12_token_files, op13_merkle_manifest)}
