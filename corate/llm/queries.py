"""Registered queries of the text operators: thin callables (spark, sf_dir) -> DataFrame.

Each applies its operator to the whole table with production parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, fill_in_middle, grade_model, jaccard_join, line_dedup, lm_score, mixing, pii, quality_rules, simhash, source_audit,
               token_counts, token_store)
from .common import documents, pick, saved

TOKENIZERS = "/opt/tokenizers"


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document (4-word shingles, 4 bits)."""
    docs = pick(documents(spark, sf_dir), doc_id="bigint", text="string")
    return simhash.near_duplicates(docs, shingle=4, max_bits=4)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, greedy word pieces and unknown words of every document."""
    docs = pick(documents(spark, sf_dir), doc_id="bigint", text="string")
    automaton = token_counts.Automaton(*token_counts.sentencepiece_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model"))
    return token_counts.count_tokens(docs, automaton).select("doc_id", "n_words", "n_tokens", "n_unknown")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probability and selection of every document, learnt from ``labels``."""
    docs = pick(documents(spark, sf_dir), doc_id="bigint", text="string")
    model = grade_model.fit(docs, grade_model.graded(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return grade_model.score(docs, model).select("doc_id", "expected_grade", "p_top", "kept")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, base rules and adaptive verdict of every document."""
    docs = pick(documents(spark, sf_dir), doc_id="bigint", text="string", lang="string", source="string")
    return quality_rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-log-likelihood of every document under a network trained on all of them."""
    docs = pick(documents(spark, sf_dir), doc_id="bigint", text="string")
    counts = saved(lm_score.count_words(docs), "lm-words")
    vocabulary, network = lm_score.fit(docs, counts=counts)
    return lm_score.score(docs, vocabulary, network, counts, text=False).select("doc_id", "n_tokens", "log_prob", "mean_log_prob")


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded into binary shards and read back through their hash indexes."""
    docs = pick(documents(spark, sf_dir), doc_id="bigint", text="string")
    return token_store.store_digest(docs, f"{TOKENIZERS}/word_bpe_49k.json")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base spans, all spans."""
    found = pii.detect(pick(documents(spark, sf_dir), doc_id="bigint", text="string"))
    count = {k: F.size(pii.of_kind(F.col("base"), k)).cast("bigint").alias(f"n_{k}") for k in pii.BASE}
    return found.select("doc_id", *count.values(), F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, those that repeat or nearly repeat (1 edit) an earlier line, and their matches."""
    docs = pick(documents(spark, sf_dir), doc_id="bigint", text="string")
    return line_dedup.deduplicate_lines(docs, edits=1, text=False)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words and items found in every document (13-word windows)."""
    docs = pick(documents(spark, sf_dir), doc_id="bigint", text="string")
    found = decontaminate.hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), "contaminated")


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of all documents: 100% of all words, weights 1, 2, 3 by source, at most 3 epochs."""
    docs = pick(documents(spark, sf_dir), doc_id="bigint", text="string", source="string")
    return mixing.mix(docs, cap=3.0, weights=(1, 2, 3), seed=10).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every pair of sources of a language, and each source's 200 terms that stand out (in 3 documents at least)."""
    return source_audit.audit(documents(spark, sf_dir))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and component of every document (4-word shingles, Jaccard similarity of 0.85 or more)."""
    return jaccard_join.similar_documents(documents(spark, sf_dir), shingle=4, percent=85)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle form of every document: lengths, digest of the output and of the text rebuilt from it."""
    out = fill_in_middle.transform(pick(documents(spark, sf_dir), doc_id="bigint", text="string"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_simhash_dedup, op2_token_counts, op3_quality_classifier, op4_quality_rules, op5_lm_score, op6_token_store, op7_pii, op8_line_dedup, op9_decontaminate, op10_source_mix,
        op11_source_audit, op12_jaccard_join, op13_fill_in_middle,
    )}
