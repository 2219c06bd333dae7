"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._util import as_col

# Fixed values of the throughput metrics: MB is 1024 * 1024 bytes.
BYTES_PER_MB = 1024 * 1024


def to_mb(nbytes) -> Column:
    return as_col(nbytes).cast("double") / F.lit(float(BYTES_PER_MB))


def safe_rate(amount, seconds) -> Column:
    """``amount / seconds``; 0.0 when seconds <= 0."""
    s = as_col(seconds).cast("double")
    return F.when(s > 0, as_col(amount).cast("double") / s).otherwise(F.lit(0.0))


def size_ratio(out_bytes, in_bytes) -> Column:
    """Output bytes / input bytes (NULL when no input bytes)."""
    i = as_col(in_bytes).cast("double")
    return F.when(i != 0, as_col(out_bytes).cast("double") / i)
