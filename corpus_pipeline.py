"""Corpus pipeline: quality, near duplicates, decontamination, mixing, token files.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read again as the
next one's ``docs``.  All but the last return the columns of ``docs``.  Nothing here can be told in SQL (trained
models, sampling sketches, a grammar), so ``ORACLE_SQL`` is None and ``tests/llm`` holds the stages against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flighttables.llm._common import staged, table
from flighttables.llm.decontamination import find_contamination
from flighttables.llm.mixing import CORPUS_DOMAIN, CORPUS_TARGETS, mixing_rates
from flighttables.llm.near_dedup import near_classes
from flighttables.llm.quality_classifier import quality_scores
from flighttables.llm.token_files import read_token_files, write_token_files

ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_scores(docs, table(spark, sf_dir, "labels"), keep=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of least id of each class of near duplicates, and all rows without id.

    Each row is a document, also where rows repeat an id: only rows whose texts are alike are in one class.  Null, empty and blank
    texts are alike with nothing and stay.
    """
    row = "_near_row"
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "near-rows")
    classes = near_classes(rows, id_col=row)
    first = (classes.join(rows.where("doc_id is not null").select(row, "doc_id"), row).groupBy("class_id")
             .agg(F.min(F.struct("doc_id", row)).alias("first")).select(F.col(f"first.{row}").alias(row)))
    kept = rows.join(first, row, "left_semi")
    return kept.unionByName(rows.where("doc_id is null")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return find_contamination(docs, table(spark, sf_dir, "benchmark"), keep=True)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its rate says."""
    return mixing_rates(docs, table(spark, sf_dir, "labels"), CORPUS_TARGETS, CORPUS_DOMAIN, keep=True)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture encoded, compressed, written and read back: a row per document taken."""
    path = write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path, with_ids=False)


STAGES = [("quality_classifier", quality_classifier), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("mixing", mixing), ("token_files", token_files)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again between."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
    return docs
