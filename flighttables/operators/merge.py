"""Ordered merge of message streams.

All streams of a flight — topic samples, untagged logs, tagged logs, parameter changes,
trajectory — become one envelope ``(mcap_id, topic, ts_us, payload)`` in time order.
Equal times keep stream order (the order of the ``streams`` list, then ``sub_ord`` inside
a stream such as the topic's position), then input order (``row_ord``).

The total order is produced per flight by the skew-safe ``ordered_within`` (a flight of few messages is one bucket, a longer one has
buckets of ten minutes, or less where these hold many messages), never by a single global sort into one partition or by one task per long
flight.  The messages are written once before, so that what they come from is computed once, and whole messages are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.time import micros_to_nanos
from ..session import new_output_dir
from .ordered import TIME_WIDTH_US, ordered_within

#: Messages of a flight that a bucket is to hold, and buckets of all flights, unless ten minutes give more.
BUCKET_ROWS, MOST_BUCKETS = 200_000, 500_000
#: Messages that one task orders.
RANGE_ROWS = 400_000

ENVELOPE = ["mcap_id", "topic", "ts_us", "row_ord", "payload"]


def envelope(df: DataFrame, stream_idx: int) -> DataFrame:
    """Project one stream to the envelope; ``sub_ord`` defaults to 0."""
    sub = F.col("sub_ord").cast("bigint") if "sub_ord" in df.columns else F.lit(0).cast("bigint")
    return df.select(F.col("mcap_id").cast("string").alias("mcap_id"), F.col("topic").cast("string").alias("topic"),
                     F.col("ts_us").cast("bigint").alias("ts_us"), F.lit(stream_idx).alias("stream"),
                     sub.alias("sub_ord"), F.col("row_ord").cast("bigint").alias("row_ord"),
                     F.col("payload").cast("string").alias("payload"))


def bucket_width(rows: DataFrame) -> tuple[int, int]:
    """Width of the time buckets by the densest ten minutes of a flight, and the number of messages."""
    held = rows.groupBy("mcap_id", F.floor(F.col("ts_us") / TIME_WIDTH_US).alias("b")).agg(
        F.count(F.lit(1)).alias("n"), (F.max("ts_us") - F.min("ts_us") + 1).alias("extent"))
    r = held.agg(F.sum("n").alias("n"), F.sum("extent").alias("extent"),
                 F.min(F.when(F.col("n") > BUCKET_ROWS, F.col("extent") * F.lit(float(BUCKET_ROWS)) / F.col("n"))).alias("width")).first()
    if r["width"] is None:
        return TIME_WIDTH_US, r["n"] or 0
    return min(TIME_WIDTH_US, max(1, int(r["width"]), r["extent"] // MOST_BUCKETS)), r["n"]


def long_flights(rows: DataFrame) -> tuple[list, int]:
    """Flights of more messages than a bucket is to hold, at most one for each so many messages, and the number of all messages."""
    sizes = rows.groupBy("mcap_id").agg(F.count(F.lit(1)).alias("n"))
    r = sizes.agg(F.sum("n").alias("n"), F.collect_list(F.when(F.col("n") > BUCKET_ROWS, F.struct("mcap_id"))).alias("long")).first()
    return [(x["mcap_id"],) for x in r["long"]], r["n"] or 0


def merge_streams(streams: list[DataFrame]) -> DataFrame:
    """Union the streams (in priority order) and number each flight's messages in merge order.

    Output: ``mcap_id, seq, ts_us, topic, stream, sub_ord, row_ord, payload, log_time_ns,
    publish_time_ns`` (both message times are ``ts_us * 1000``).  Each partition is a range of (flight, place in the flight), in that order.
    """
    u = None
    for i, s in enumerate(streams):
        e = envelope(s, i)
        u = e if u is None else u.unionByName(e)
    spark, path = u.sparkSession, new_output_dir(u.sparkSession, "merge-streams")
    u.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(u.schema).parquet(path)
    flights, n = long_flights(rows)
    width = F.lit(None).cast("bigint")
    if flights:
        long = spark.createDataFrame(flights, "long_id string")
        is_long = F.col("mcap_id").eqNullSafe(F.col("long_id"))
        us, _ = bucket_width(rows.join(F.broadcast(long), is_long, "left_semi"))
        rows, width = rows.join(F.broadcast(long.withColumn("width", F.lit(us))), is_long, "left"), F.col("width")
    seq = ordered_within(rows, ["mcap_id"], ["ts_us", "stream", "sub_ord", "row_ord"], seq_col="seq", width=width,
                         ranges=n // RANGE_ROWS + spark.sparkContext.defaultParallelism)
    return seq.select("mcap_id", "seq", "ts_us", "topic", "stream", "sub_ord", "row_ord", "payload",
                      micros_to_nanos(F.col("ts_us")).alias("log_time_ns"),
                      micros_to_nanos(F.col("ts_us")).alias("publish_time_ns"))
