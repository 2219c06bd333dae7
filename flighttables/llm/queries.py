"""Queries that apply each corpus operator with production parameters to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flighttables.llm._common import table
from flighttables.llm.decontamination import find_contamination
from flighttables.llm.hard_negatives import hard_negatives
from flighttables.llm.html_text import extract_text
from flighttables.llm.jaccard_join import jaccard_components
from flighttables.llm.lm_scoring import lm_scores
from flighttables.llm.mixing import CORPUS_DOMAIN, CORPUS_TARGETS, mixing_rates
from flighttables.llm.near_dedup import near_classes
from flighttables.llm.oracle import ORACLE_SQL  # noqa: F401
from flighttables.llm.quality_classifier import quality_scores
from flighttables.llm.quality_rules import quality_rules
from flighttables.llm.substring_dedup import drop_repeats
from flighttables.llm.token_alignment import align_tokens
from flighttables.llm.token_counts import token_counts
from flighttables.llm.token_files import read_token_files, write_token_files


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, compressed, written, and read back from the files."""
    path = write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path, with_ids=False)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors, rate and copies of every document."""
    rates = mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), CORPUS_TARGETS, CORPUS_DOMAIN)
    return rates.select("doc_id", "n_words", *[F.col("posterior")[i].alias(f"p_{k}") for i, k in enumerate(CORPUS_TARGETS)],
                        "rate", "copies")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that repeat from an earlier place, in every document."""
    return drop_repeats(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the rule cascade for every document."""
    return quality_rules(table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and maximum-entropy score of every document."""
    return lm_scores(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document."""
    return near_classes(table(spark, sf_dir, "documents"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document by links of 85 % similar shingle sets."""
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; the labels of every seventh are moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between two tokenizers' tokens of every document."""
    return align_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_token_files, op2_mixing, op3_html_text, op10_near_dedup, op4_decontamination, op5_substring_dedup, op6_quality_rules,
                                   op7_lm_scoring, op8_token_counts, op9_quality_classifier, op11_jaccard_join, op12_hard_negatives, op13_token_alignment)}
