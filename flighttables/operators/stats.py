"""Run statistics (A9, A10, A13, T19): ingest and conversion roll-ups from run-log rows.

Run log row: one per processed file with byte counts and seconds per phase.  Rates are
MB (1024 * 1024 bytes) per second, 0 when the seconds are not positive; ratio is output
bytes over input bytes.  All roll-ups are single partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import safe_rate, size_ratio, to_mb


def ingest_stats(runs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Files, byte sums, phase seconds, transform / read / write MB/s, size ratio, wall total."""
    by = by or []
    g = runs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("in_bytes").alias("in_bytes"), F.sum("out_bytes").alias("out_bytes"),
        F.sum("read_seconds").alias("read_seconds"), F.sum("transform_seconds").alias("transform_seconds"),
        F.sum("write_seconds").alias("write_seconds"))
    return g.select(*by, "n_files", "in_bytes", "out_bytes",
                    safe_rate(to_mb("in_bytes"), F.col("transform_seconds")).alias("transform_mb_s"),
                    safe_rate(to_mb("in_bytes"), F.col("read_seconds")).alias("read_mb_s"),
                    safe_rate(to_mb("out_bytes"), F.col("write_seconds")).alias("write_mb_s"),
                    size_ratio(F.col("out_bytes"), F.col("in_bytes")).alias("ratio"),
                    (F.col("read_seconds") + F.col("transform_seconds") + F.col("write_seconds")).alias("wall_seconds"))


def conversion_stats(runs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Skipped vs converted counts; byte and second sums and rates over converted files only."""
    by = by or []
    conv = F.col("outcome") != "skipped"
    g = runs.groupBy(*by).agg(
        F.count_if(F.col("outcome") == "skipped").alias("n_skipped"),
        F.count_if(conv).alias("n_converted"),
        F.sum(F.when(conv, F.col("in_bytes"))).alias("in_bytes"),
        F.sum(F.when(conv, F.col("out_bytes"))).alias("out_bytes"),
        F.sum(F.when(conv, F.col("transform_seconds"))).alias("transform_seconds"))
    return g.select(*by, "n_skipped", "n_converted", "in_bytes", "out_bytes",
                    safe_rate(to_mb("in_bytes"), F.col("transform_seconds")).alias("transform_mb_s"),
                    size_ratio(F.col("out_bytes"), F.col("in_bytes")).alias("ratio"))


def outcome_counts(runs: DataFrame) -> DataFrame:
    """Files per outcome (downloaded / skipped / failed, converted / skipped)."""
    return runs.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
