"""Curated views kept up to date: partial aggregates of each ingest batch, folded at read.

All measures of the curated views are minima, maxima and sums, so a view over a table is the fold of the same aggregates over its
batches.  An ingest job that is asked to adds, before it commits a batch, a row per group of that batch to
``<table>/_partials/<name>/batch_id=<id>``, read from the batch's own files.  Readers fold the partials of the committed batches: a new
batch costs a pass over itself, and a view reads a few rows per flight and batch instead of the table.  Partials of a batch
that failed before its commit do not count, and are replaced when it is run again.  Committed batches without partials (older ones, or
those whose files lack a column) are aggregated from their rows at read, until :func:`add_partials` has added theirs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.time import format_duration, register_sql_functions
from ..sinks.lake import MANIFEST, PARTIALS, read_manifest, read_topic_table, topic_table_schema
from ..session import path_exists
from .curated import ARMED_STATE, BATTERY_MEASURES, BATTERY_NAMES, ERROR_LEVEL

_FOLDS = {"min": F.min, "max": F.max, "sum": F.sum}


@dataclass(frozen=True)
class Partial:
    """Aggregates by ``keys`` that can be folded: ``measures`` has, by column, the fold and the value of a row."""

    name: str
    topic: str
    keys: tuple[str, ...]
    needs: frozenset[str]
    measures: dict[str, tuple[str, Callable[[], Column]]]

    def of(self, rows: DataFrame, *more_keys: str) -> DataFrame:
        """One row per group of ``rows``."""
        return rows.groupBy(*more_keys, *self.keys).agg(*[_FOLDS[f](value()).alias(c) for c, (f, value) in self.measures.items()])

    def fold(self, partials: DataFrame) -> DataFrame:
        """One row per group of any union of partials."""
        return partials.groupBy(*self.keys).agg(*[_FOLDS[f](c).alias(c) for c, (f, _) in self.measures.items()])

    def fits(self, rows: DataFrame) -> bool:
        return (self.needs | set(self.keys)) <= set(rows.columns)


def _armed() -> Column:
    return F.when(F.col("arming_state") == ARMED_STATE, F.col("log_time"))


def _bounds() -> dict[str, tuple[str, Callable[[], Column]]]:
    return {"first_time": ("min", lambda: F.col("log_time")), "last_time": ("max", lambda: F.col("log_time"))}


ERRORS = Partial("errors", "logged_messages", ("mcap_id",), frozenset({"level"}), {
    "error_count": ("sum", lambda: F.when(F.col("level") == ERROR_LEVEL, F.lit(1)).otherwise(F.lit(0)).cast("bigint"))})
FLIGHT_TIMES = Partial("flight_times", "vehicle_status", ("mcap_id",), frozenset({"log_date", "log_time", "arming_state"}), {
    "flight_date": ("min", lambda: F.col("log_date")), **_bounds(), "armed_from": ("min", _armed), "armed_to": ("max", _armed)})
BATTERY_RANGES = Partial("battery_ranges", "battery_status", ("mcap_id", "multi_id", "cell_count"), frozenset(BATTERY_MEASURES), {
    f"{fold}_{BATTERY_NAMES[m]}": (fold, lambda m=m: F.col(m)) for m in BATTERY_MEASURES for fold in ("min", "max")})
ALTITUDE = Partial("altitude", "vehicle_local_position", ("mcap_id",), frozenset({"log_time", "z"}), {
    "top": ("max", lambda: -F.col("z")), **_bounds()})
ALL = (ERRORS, FLIGHT_TIMES, BATTERY_RANGES, ALTITUDE)


def partials_of(topic: str) -> tuple[Partial, ...]:
    """The partials that a batch of the topic carries."""
    return tuple(p for p in ALL if p.topic == topic)


def _like_rows(spark: SparkSession, table_dir: str) -> DataFrame:
    """A DataFrame with the table's columns, without a listing of its files where its schema is recorded."""
    schema = topic_table_schema(spark, table_dir)
    return read_topic_table(spark, table_dir) if schema is None else spark.createDataFrame([], schema)


def _held(spark: SparkSession, table_dir: str, partial: Partial, like: DataFrame) -> DataFrame | None:
    """Partials as written, of all batches, with ``batch_id``; ``None`` if no batch has any."""
    path = f"{table_dir.rstrip('/')}/{PARTIALS}/{partial.name}"
    if not partial.fits(like) or not path_exists(spark, path):
        return None
    return spark.read.schema(partial.of(like).schema.add("batch_id", "string")).parquet(path)


def _lacking(spark: SparkSession, table_dir: str, held: DataFrame | None) -> DataFrame:
    """Ids of committed batches without partials."""
    manifest = read_manifest(spark, table_dir, MANIFEST)
    if manifest is None:
        raise ValueError(f"no committed batch in {table_dir}")
    batches = manifest.select("batch_id").distinct()
    return batches if held is None else batches.join(held.select("batch_id").distinct(), "batch_id", "left_anti")


def read_folded(spark: SparkSession, table_dir: str, partial: Partial) -> DataFrame:
    """The partial's aggregates over all committed rows of a topic table."""
    like = _like_rows(spark, table_dir)
    held = _held(spark, table_dir, partial, like)
    if held is None:
        return partial.of(read_topic_table(spark, table_dir))
    committed = read_manifest(spark, table_dir, MANIFEST).select("batch_id").distinct()
    counted = held.join(committed, "batch_id", "left_semi").drop("batch_id")
    lacking = _lacking(spark, table_dir, held)
    if not lacking.isEmpty():
        counted = counted.unionByName(partial.of(read_topic_table(spark, table_dir, lacking)))
    return partial.fold(counted)


def add_partials(spark: SparkSession, table_dir: str, partial: Partial) -> int:
    """Write the partials of committed batches that lack them, in one pass over their rows; returns the number of these batches."""
    like = _like_rows(spark, table_dir)
    if not partial.fits(like):
        raise ValueError(f"{table_dir} lacks columns of {partial.name}")
    lacking = _lacking(spark, table_dir, _held(spark, table_dir, partial, like)).persist()
    n = lacking.count()
    if n:
        rows = read_topic_table(spark, table_dir, lacking, with_batch=True)
        partial.of(rows, "batch_id").write.mode("append").partitionBy("batch_id").parquet(f"{table_dir.rstrip('/')}/{PARTIALS}/{partial.name}")
    lacking.unpersist()
    return n


def error_counts(spark: SparkSession, lake_dir: str) -> DataFrame:
    """:func:`curated.error_counts` from partials."""
    return read_folded(spark, f"{lake_dir.rstrip('/')}/{ERRORS.topic}", ERRORS)


def flights(spark: SparkSession, lake_dir: str) -> DataFrame:
    """:func:`curated.flights` from partials."""
    times = read_folded(spark, f"{lake_dir.rstrip('/')}/{FLIGHT_TIMES.topic}", FLIGHT_TIMES)
    return times.join(error_counts(spark, lake_dir), on="mcap_id", how="left").select(
        "mcap_id", "flight_date", F.col("first_time").alias("start_time"),
        format_duration(F.col("last_time") - F.col("first_time")).alias("duration"),
        format_duration(F.col("armed_to") - F.col("armed_from")).alias("armed_duration"),
        F.coalesce("error_count", F.lit(0).cast("bigint")).alias("error_count"))


def battery(spark: SparkSession, lake_dir: str) -> DataFrame:
    """:func:`curated.battery` from partials."""
    return read_folded(spark, f"{lake_dir.rstrip('/')}/{BATTERY_RANGES.topic}", BATTERY_RANGES)


def max_altitude(spark: SparkSession, lake_dir: str) -> DataFrame:
    """:func:`curated.max_altitude` from partials."""
    return read_folded(spark, f"{lake_dir.rstrip('/')}/{ALTITUDE.topic}", ALTITUDE).select(
        "mcap_id", F.round("top", 1).alias("max_alt_m"), F.col("first_time").alias("started"),
        format_duration(F.col("last_time") - F.col("first_time")).alias("duration"))


#: Curated views by name, and the topics that they need.
VIEWS = {"error_counts": (error_counts, {"logged_messages"}), "flights": (flights, {"vehicle_status", "logged_messages"}),
         "battery": (battery, {"battery_status"}), "max_altitude": (max_altitude, {"vehicle_local_position"})}


def register_folded_views(spark: SparkSession, lake_dir: str, topics: list[str]) -> list[str]:
    """Create the curated temp views whose topics the lake has, over the partials; returns their names."""
    register_sql_functions(spark)
    made = [name for name, (_, needs) in VIEWS.items() if needs <= set(topics)]
    for name in made:
        VIEWS[name][0](spark, lake_dir).createOrReplaceTempView(name)
    return made
