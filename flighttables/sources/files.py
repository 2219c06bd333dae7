"""File listings (S1, S2, S6, S7): message files, raw logs and held-log ids.

Listings use the ``binaryFile`` source with the content column pruned, so only file
metadata is read; the listing itself is distributed over the input splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.names import file_name, log_date_from_name, mcap_id_from_path


def list_files(spark: SparkSession, root: str, suffix: str, recursive: bool = True) -> DataFrame:
    """``(path, length, modificationTime)`` of files under ``root`` whose name ends with ``suffix``."""
    reader = (spark.read.format("binaryFile")
              .option("pathGlobFilter", f"*{suffix}")
              .option("recursiveFileLookup", str(recursive).lower()))
    return (reader.load(root).select("path", "length", "modificationTime")
            .where(F.col("path").endswith(suffix)))


def message_file_manifest(files: DataFrame) -> DataFrame:
    """Per message file: flight id and log date from the name (raises on a bad date prefix)."""
    return files.select("path", "length",
                        mcap_id_from_path(F.col("path")).alias("mcap_id"),
                        log_date_from_name(file_name(F.col("path"))).alias("log_date"))


def count_files(files: DataFrame) -> DataFrame:
    """One-row count of held files."""
    return files.agg(F.count(F.lit(1)).alias("n_files"))
