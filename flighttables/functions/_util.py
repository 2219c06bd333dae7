from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(c) -> Column:
    """Accept a Column or a column name."""
    return c if isinstance(c, Column) else F.col(c)
