"""Skew-safe ordered computations within groups: sequence number, previous and next row.

``Window.partitionBy(flight).orderBy(time)`` sends every row of one flight to one task, so a flight holding a third
of all rows would be sorted by a single task.  Here the first order column is cut into buckets of a fixed width:

1. rows are numbered, and look back and ahead, inside their ``(group, bucket)``: a window over the bucket;
2. a partial aggregate counts each ``(group, bucket)`` and keeps its first and last values: one small row a bucket;
3. running sums over the buckets of a group give each bucket its offset, its neighbours the values across its border;
4. both are joined by the bucket's key, by which the rows are already dealt, or a bucket's small row goes before its rows through
   their shuffle into ranges.

Nothing depends on how rows are partitioned, so the result may be unioned, coalesced or ordered again.  The width
bounds a task by the rows that a group has within it (rows of one equal first order value always share a bucket); the
buckets of a group are counted by its extent over the width.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

#: Default widths: ten minutes for times, 100,000 for numbers.
TIME_WIDTH_US = 600_000_000
NUMBER_WIDTH = 100_000

_KEY, _GROUP, _BUCKET, _LOCAL, _ROW = "_ow_key", "_ow_group", "_ow_bucket", "_ow_local", "_ow_row"


def bucket_of(col: str, dtype: T.DataType, width: int | Column | None) -> Column:
    """The bucket of an order value: times by microseconds, numbers as they are; a null has a bucket of its own."""
    c = F.col(col)
    if isinstance(dtype, T.TimestampNTZType):
        c = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    elif isinstance(dtype, T.TimestampType):
        c = F.unix_micros(c)
    elif not isinstance(dtype, T.NumericType):
        raise TypeError(f"the first order column {col!r} must be a time or a number, not {dtype.simpleString()}")
    timed = isinstance(dtype, (T.TimestampNTZType, T.TimestampType))
    if not isinstance(width, Column):
        width = F.lit(width or (TIME_WIDTH_US if timed else NUMBER_WIDTH))
    return F.floor(c / width).cast("bigint")


def ordered_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], *,
                   seq_col: str | None = "seq", lag_cols: Sequence[str] = (), lead_cols: Sequence[str] = (),
                   width: int | Column | None = None, ranges: int | None = None) -> DataFrame:
    """Add ``seq_col`` (1-based order inside the group), ``prev_<c>`` and ``next_<c>`` columns.

    Equal to ``row_number() / lag(c) / lead(c) OVER (PARTITION BY group ORDER BY order)`` (nulls first; null group
    values form a group).  ``order_cols`` must order the rows of a group totally (end with a unique ordinal), and the first
    must be a time or a number; ``width`` is the width of its buckets (microseconds for times), or a column that holds the width of
    the row's group, null where the group is one bucket.  With ``ranges`` rows are dealt to that many ranges of (group, bucket), in which
    the result stays in order, by the only shuffle of whole rows; what a bucket takes over from those before it is a small row in the same shuffle.
    """
    group_cols, order_cols, lag_cols, lead_cols = map(list, (group_cols, order_cols, lag_cols, lead_cols))
    group, order = F.struct(*[F.col(g) for g in group_cols]), F.struct(*[F.col(c) for c in order_cols])
    # Keys are structs: never null as a whole, and equal where their fields are equal or both null.
    bucket = bucket_of(order_cols[0], df.schema[order_cols[0]].dataType, width)
    key = F.struct(*[F.col(g) for g in group_cols], bucket.alias(_BUCKET))
    keyed = df.withColumn(_KEY, key)

    needed = list(dict.fromkeys([*group_cols, *order_cols, *lag_cols, *lead_cols]))
    aggs = [F.count(F.lit(1)).alias("_ow_n")]
    if lag_cols:
        aggs.append(F.max_by(F.struct(*lag_cols), order).alias("_ow_last"))
    if lead_cols:
        aggs.append(F.min_by(F.struct(*lead_cols), order).alias("_ow_first"))
    # A group of one bucket takes over nothing.
    cut = df.where(width.isNotNull()) if ranges and isinstance(width, Column) else df
    sizes = cut.select(*needed, key.alias(_KEY)).withColumn(_GROUP, group).groupBy(_KEY, _GROUP).agg(*aggs)
    along = Window.partitionBy(_GROUP).orderBy(F.col(f"{_KEY}.{_BUCKET}"))
    border = {"_ow_offset": F.coalesce(F.sum("_ow_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))}
    if lag_cols:
        border["_ow_before"] = F.lag("_ow_last").over(along)
    if lead_cols:
        border["_ow_after"] = F.lead("_ow_first").over(along)
    borders = sizes.withColumns(border).select(F.col(_KEY), *border)

    if ranges:
        keyed = keyed.withColumn(_ROW, F.lit(True)).unionByName(borders.withColumn(_ROW, F.lit(False)), allowMissingColumns=True)
        keyed = keyed.repartitionByRange(ranges, _KEY)
    inside = Window.partitionBy(_KEY).orderBy(*([_ROW] if ranges else []), *order_cols)
    earlier = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {_LOCAL: F.row_number().over(inside)}
    # The row of a bucket's border is its first, and no row's neighbour.
    local |= {f"_ow_prev_{c}": F.lag(F.when(F.col(_ROW), F.struct(c)) if ranges else F.struct(c)).over(inside) for c in lag_cols}
    local |= {f"_ow_next_{c}": F.lead(F.struct(c)).over(inside) for c in lead_cols}
    if ranges:
        local |= {c: F.first(c).over(earlier) for c in border}
        local["_ow_offset"] = F.coalesce(F.first("_ow_offset").over(earlier) - 1, F.lit(0))
    rows = keyed.withColumns(local)

    joined = rows.where(_ROW) if ranges else rows.join(borders, on=_KEY, how="inner")
    out = [F.col(c) for c in df.columns]
    if seq_col:
        out.append((F.col(_LOCAL) + F.col("_ow_offset")).cast("bigint").alias(seq_col))
    out += [F.coalesce(F.col(f"_ow_prev_{c}"), F.struct(F.col("_ow_before")[c].alias(c)))[c].alias(f"prev_{c}") for c in lag_cols]
    out += [F.coalesce(F.col(f"_ow_next_{c}"), F.struct(F.col("_ow_after")[c].alias(c)))[c].alias(f"next_{c}") for c in lead_cols]
    return joined.select(*out)
