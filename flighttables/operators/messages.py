"""Message-level operators: standard columns.

A message envelope is ``(mcap_id, log_date, topic, log_time_ns, publish_time_ns, sequence,
payload...)``.  Times are nanoseconds relative to the start of the log; they are anchored
to midnight of the log date at microsecond precision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.names import topic_base, topic_multi_id
from ..functions.time import TIME_SOURCE, anchor_time, offset_us
from ..functions.types import STANDARD_COLUMNS

STANDARD_NAMES = [n for n, _ in STANDARD_COLUMNS]


def with_topic_parts(messages: DataFrame, topic_col: str = "topic") -> DataFrame:
    """Add ``base_topic`` and ``multi_id`` parsed from the channel name."""
    t = F.col(topic_col)
    return messages.withColumns({"base_topic": topic_base(t), "multi_id": topic_multi_id(t)})


def standard_columns(messages: DataFrame, payload_cols: list[str] | None = None) -> DataFrame:
    """The eight standard columns (fixed order, non-null), ``base_topic``, then payload columns."""
    m = messages if "base_topic" in messages.columns else with_topic_parts(messages)
    std = [
        anchor_time(F.col("log_date"), F.col("log_time_ns")).alias("log_time"),
        anchor_time(F.col("log_date"), F.col("publish_time_ns")).alias("publish_time"),
        F.col("sequence").cast("bigint").alias("sequence"),
        F.col("mcap_id").cast("string").alias("mcap_id"),
        F.col("multi_id").cast("int").alias("multi_id"),
        offset_us(F.col("log_time_ns")).alias("offset_us"),
        F.col("log_date").cast("date").alias("log_date"),
        F.lit(TIME_SOURCE).alias("time_source"),
    ]
    payload = payload_cols if payload_cols is not None else [
        c for c in m.columns if c not in {"log_time_ns", "publish_time_ns", "topic", "base_topic", *STANDARD_NAMES}]
    return m.select(*std, "base_topic", *payload)


def sort_for_write(df: DataFrame, partition_cols: list[str] | None = None, tie_cols: list[str] | None = None) -> DataFrame:
    """Rows ordered by ``publish_time`` (nulls last) inside each output partition (O3, K2).

    Equal publish times keep input order, told by ``tie_cols`` (default: the file and the row's place in it, ``source`` and
    ``row_index``, then flight, message ``sequence`` and ``log_time``, as far as the rows have them).  With ``partition_cols`` the sort leads with them, which is the
    order a partitioned file writer requires; it then adds no sort of its own.
    """
    ties = tie_cols if tie_cols is not None else [c for c in ("source", "row_index", "mcap_id", "sequence", "log_time") if c in df.columns]
    keys = [F.col(c) for c in (partition_cols or [])] + [F.col("publish_time").asc_nulls_last(), *[F.col(c) for c in ties]]
    return df.sortWithinPartitions(*keys)


def topic_counts(messages: DataFrame, topic_col: str = "topic") -> DataFrame:
    """Messages per topic (A11); a partial aggregate, ordered by topic."""
    return messages.groupBy(topic_col).agg(F.count(F.lit(1)).alias("n_messages")).orderBy(topic_col)


def descriptor_check(messages: DataFrame, schema_col: str = "schema_name") -> DataFrame:
    """Per (flight, base topic): message count and number of distinct descriptor names.

    Every instance of a base topic must share one descriptor; the ``ok`` column is asserted
    with ``assert_true`` so a mismatch fails the job (fail fast), like the grouping step.
    """
    m = messages if "base_topic" in messages.columns else with_topic_parts(messages)
    # Hash pre-aggregate over all messages (fixed-width buffer), then a small final step
    # over one row per (flight, topic, descriptor).
    per_desc = m.groupBy("mcap_id", "base_topic", F.col(schema_col).alias("_desc")).agg(
        F.count(F.lit(1)).alias("_n"))
    g = (per_desc.groupBy("mcap_id", "base_topic")
         .agg(F.sum("_n").alias("n_messages"),
              F.count(F.col("_desc")).alias("n_descriptors"),
              F.min(F.col("_desc")).alias("schema_name")))
    return g.withColumn("ok", F.col("n_descriptors") == 1) \
            .where(F.assert_true(F.col("ok"), F.lit("topic base has mismatched descriptors across instances")).isNull())
