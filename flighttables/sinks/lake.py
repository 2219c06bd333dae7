"""Topic-table sink (K1-K4, K7, O3, §2.13.16 re-ingest policy).

A topic table is a folder ``<lake>/<topic>/batch_id=<id>/log_date=YYYY-MM-DD/`` of zstd files whose rows are sorted by
``publish_time``; the single-pass fan-out adds ``base_topic=<t>`` between.  A batch is written in three steps:

1. the evolved payload schema is recorded (by the ingest job);
2. the data go to the folder of the batch's id, replacing what a failed run of the same batch left there;
3. the batch's manifest rows ``(mcap_id, source, stamp, log_date[, base_topic])`` go to ``_ingested/batch_id=<id>``.

Only batches with manifest rows count: readers take their data, whatever else lies in the table.  So a batch that failed
before step 3 shows nothing and loses nothing when it is run again, with the same id or a new one, and a batch that
is run again after step 3 is skipped.  What was ingested is told by (flight, source file), so a flight whose rows lie in
several files may arrive in several batches.  ``stamp`` tells versions of a file apart: a file that has changed since it
was ingested is an error, never taken for the one that is held.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.messages import sort_for_write
from ..session import new_output_dir, path_exists, remove_dir

COMPRESSION = "zstd"
ZSTD_LEVEL = "3"
MANIFEST = "_ingested"
FANOUT_MANIFEST = "_ingested_topics"
TABLE_SCHEMA = "_table_schema"
POLICIES = ("error", "skip", "append")
_MANIFEST_SCHEMA = "mcap_id string, source string, stamp string, log_date date, batch_id string"
_FANOUT_SCHEMA = "mcap_id string, source string, stamp string, base_topic string, log_date date, batch_id string"
#: Columns of a batch that tell where a row came from; they order the rows and go to the manifest, not to the table.
_ORIGIN = ("source", "stamp", "row_index")
RUNS = "_runs"
#: Manifest rows of a batch up to which the manifests may be broadcast, which brings them to the driver.
BROADCAST_ROWS = 50_000
#: Folder of a topic table with the partial aggregates of its batches (:mod:`flighttables.operators.partials`).
PARTIALS = "_partials"
_RUN_SCHEMA = ("base_topic string, n_files bigint, in_bytes bigint, rows_in bigint, out_files bigint, out_bytes bigint, rows_written bigint, "
               "read_seconds double, transform_seconds double, write_seconds double, batch_id string")


def new_batch_id() -> str:
    return uuid.uuid4().hex


def read_manifest(spark: SparkSession, root: str, name: str = MANIFEST) -> DataFrame | None:
    """Committed ``(mcap_id, source[, base_topic], log_date, batch_id)`` of a table or lake; ``None`` if it has none yet."""
    path = f"{root.rstrip('/')}/{name}"
    if not path_exists(spark, path):
        return None
    return spark.read.schema(_FANOUT_SCHEMA if name == FANOUT_MANIFEST else _MANIFEST_SCHEMA).parquet(path)


def committed_batches(spark: SparkSession, root: str, name: str = MANIFEST) -> list[str]:
    """Ids of the committed batches (one per ingest run; metadata)."""
    manifest = read_manifest(spark, root, name)
    return [] if manifest is None else sorted(r[0] for r in manifest.select("batch_id").distinct().collect())


def _with_source(messages: DataFrame) -> DataFrame:
    """Messages without a ``source`` column are told by their flight, and without ``stamp`` by the source alone."""
    rows = messages if "source" in messages.columns else messages.withColumn("source", F.col("mcap_id").cast("string"))
    return rows if "stamp" in rows.columns else rows.withColumn("stamp", F.lit(None).cast("string"))


def _stage_and_check(spark: SparkSession, messages: DataFrame, root: str, keys: list[str], name: str, mode: str, on_existing: str,
                     batch_id: str | None, listing: DataFrame | None = None) -> tuple[DataFrame, DataFrame, str, str] | None:
    """Stage the batch's manifest rows and apply the re-ingest policy.

    ``error``: fail if a (flight, source) of the batch is already listed; ``skip``: drop those rows from the batch;
    ``append``: no check.  ``listing`` has the key columns of all messages, where they can be read more cheaply.  Returns (messages, manifest rows, staged folder, batch id), or ``None`` if the batch is committed.
    """
    if on_existing not in POLICIES:
        raise ValueError(f"unknown on_existing policy {on_existing!r}")
    if batch_id is not None and not re.fullmatch(r"[A-Za-z0-9._-]+", batch_id):
        raise ValueError(f"a batch id is made of letters, digits and ._- only: {batch_id!r}")
    if mode == "overwrite":
        remove_dir(spark, root)
    batch_id = batch_id or new_batch_id()
    done = read_manifest(spark, root, name)
    if done is not None and not done.where(F.col("batch_id") == batch_id).isEmpty():
        return None
    messages = _with_source(messages)
    # One pass over a few pruned columns; the result is written, never collected.
    staged_dir = new_output_dir(spark, "ingest-batch")
    (messages if listing is None else listing).select(*keys).distinct().write.parquet(staged_dir)
    batch = spark.read.schema(messages.select(*keys).schema).parquet(staged_dir)
    if done is not None and on_existing != "append":
        pair = ["mcap_id", "source"]
        many = batch.count() > BROADCAST_ROWS or done.count() > BROADCAST_ROWS  # from the files' footers
        by_key = lambda d: d.hint("merge") if many else d
        held = done.groupBy(*pair).agg(F.max("stamp").alias("held_stamp"))
        already = batch.select(*pair, "stamp").distinct().join(by_key(held), on=pair)
        changed = already.where(F.col("stamp") != F.col("held_stamp")).limit(1).collect()
        if changed:
            raise ValueError(f"{changed[0]['source']} has changed since it was ingested into {root}")
        already = already.select(*pair)
        if on_existing == "skip":
            messages = messages.join(by_key(already), on=pair, how="left_anti")
            messages = messages.hint("rebalance", "log_date") if many else messages  # they lie by flight now
            batch = batch.join(by_key(already), on=pair, how="left_anti")
        else:
            dup = already.limit(1).collect()
            if dup:
                raise ValueError(f"flight {dup[0]['mcap_id']} is already ingested into {root}")
    return messages, batch, staged_dir, batch_id


def _write_data(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    (df.drop(*_ORIGIN).write.mode("overwrite").partitionBy(*partition_cols).option("compression", COMPRESSION)
     .option("parquet.compression.codec.zstd.level", ZSTD_LEVEL).parquet(path))


def _commit(batch: DataFrame, root: str, name: str, batch_id: str) -> None:
    batch.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}/batch_id={batch_id}")


def write_topic_table(spark: SparkSession, rows: DataFrame, table_dir: str, mode: str = "append", on_existing: str = "error",
                      batch_id: str | None = None, rebalance: bool = True, listing: DataFrame | None = None,
                      counted: Observation | None = None, partials: Sequence = ()) -> bool:
    """Append (or overwrite) one topic's rows, partitioned by ``log_date``, sorted by publish time.

    ``batch_id`` names the write: the same batch again replaces what a failed run left, and does nothing once it is
    committed.  ``source`` in ``rows`` is the file a row came from (default: its flight); it is not stored.
    ``rebalance=False`` is for rows that already lie together by day; ``listing`` has the rows' key columns, read more cheaply than
    from ``rows``; ``counted`` gets the number of ``rows`` written.  ``partials`` are aggregates of the batch that are kept with it, made from its
    written files before it is committed.  Returns whether anything was written.
    """
    root = table_dir.rstrip("/")
    checked = _stage_and_check(spark, rows, root, ["mcap_id", "source", "stamp", "log_date"], MANIFEST, mode, on_existing, batch_id, listing)
    if checked is None:
        return False
    rows, batch, staged, batch_id = checked
    if counted is not None:
        rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    rows = rows.hint("rebalance", "log_date") if rebalance else rows
    _write_data(sort_for_write(rows, ["log_date"]), f"{root}/batch_id={batch_id}", ["log_date"])
    if partials:
        written = spark.read.schema(rows.drop(*_ORIGIN).schema).parquet(f"{root}/batch_id={batch_id}")
        for p in partials:
            if p.fits(written):
                p.of(written).write.mode("overwrite").parquet(f"{root}/{PARTIALS}/{p.name}/batch_id={batch_id}")
    _commit(batch, root, MANIFEST, batch_id)
    remove_dir(spark, staged)
    return True


#: The side table with the metadata that a flight was logged with.
FLIGHT_METADATA = "flight_metadata"


def write_flight_metadata(spark: SparkSession, entries: DataFrame, lake_dir: str, on_existing: str = "error", batch_id: str | None = None) -> bool:
    """Add flights' metadata to the lake's side table, a row per flight with its three named maps.

    ``entries (mcap_id, log_date, name, key, value, source, stamp, row_index)`` are the metadata records of the files; of a key that a flight
    repeats the last one by file and place counts.  The table has a manifest like a topic table, so a batch adds all of its flights or none.
    """
    from ..operators.logs import named_metadata
    root = f"{lake_dir.rstrip('/')}/{FLIGHT_METADATA}"
    placed = _with_source(entries).withColumn("place", F.struct("source", "row_index"))
    listing = placed.select("mcap_id", "source", "stamp", F.col("log_date").cast("date").alias("log_date"))
    checked = _stage_and_check(spark, placed, root, ["mcap_id", "source", "stamp", "log_date"], MANIFEST, "append", on_existing, batch_id, listing)
    if checked is None:
        return False
    placed, batch, staged, batch_id = checked
    maps = named_metadata(placed, ordinal_col="place")
    days = placed.groupBy("mcap_id").agg(F.min(F.col("log_date").cast("date")).alias("log_date"))
    rows = maps.join(days, "mcap_id").hint("rebalance", "log_date")
    _write_data(rows.sortWithinPartitions("log_date", "mcap_id"), f"{root}/batch_id={batch_id}", ["log_date"])
    _commit(batch, root, MANIFEST, batch_id)
    remove_dir(spark, staged)
    return True


def written_files(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and bytes of the data files under ``path``, by a distributed listing."""
    if not path_exists(spark, path):
        return 0, 0
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    r = listing.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("size")).first()
    return r["n"], r["size"]


def write_run(spark: SparkSession, lake_dir: str, batch_id: str, topics: list[dict]) -> None:
    """Add what an ingest run did, a row per topic (metadata), to the lake's run table; a batch that is run again adds its figures again
    only for the topics that it wrote."""
    rows = [t for t in topics if t["out_files"]]
    if rows:
        schema = T.StructType.fromDDL(_RUN_SCHEMA)
        data = [tuple(batch_id if f.name == "batch_id" else t[f.name] for f in schema.fields) for t in rows]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").partitionBy("batch_id").parquet(f"{lake_dir.rstrip('/')}/{RUNS}")


def read_runs(spark: SparkSession, lake_dir: str) -> DataFrame:
    """The lake's run table: per batch and topic the files, bytes and rows read, files, bytes and rows written, and seconds by phase
    (``read_seconds``: staging of the whole batch; files and bytes read are the batch's too)."""
    path = f"{lake_dir.rstrip('/')}/{RUNS}"
    return spark.read.schema(_RUN_SCHEMA).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], _RUN_SCHEMA)


def write_lake(spark: SparkSession, messages: DataFrame, lake_dir: str, mode: str = "append", on_existing: str = "error",
               metrics: dict | None = None, batch_id: str | None = None) -> list[str]:
    """Fan out standard-column messages (with ``base_topic``) to one table per base topic.

    Single pass: ``partitionBy("base_topic", "log_date")`` writes every topic's folder at once.  ``mode="overwrite"``
    resets the lake (K7); it is only ever applied to the caller's folder.  Returns the lake's topics (from the manifest).
    ``messages`` is read twice (its flight list for the re-ingest check, then the rows), so pass a written or cheap
    DataFrame rather than a long computation.  When ``metrics`` is a dict it receives the rows and flights written,
    counted by an ``Observation`` during the write itself (no extra pass).
    """
    root = lake_dir.rstrip("/")
    checked = _stage_and_check(spark, messages, root, ["mcap_id", "source", "stamp", "base_topic", "log_date"], FANOUT_MANIFEST, mode,
                               on_existing, batch_id)
    if checked is not None:
        messages, batch, staged, batch_id = checked
        obs = None
        if metrics is not None:
            obs = Observation("lake_write")
            messages = messages.observe(obs, F.count(F.lit(1)).alias("rows_written"))
        out = sort_for_write(messages.hint("rebalance", "base_topic", "log_date"), ["base_topic", "log_date"])
        _write_data(out, f"{root}/batch_id={batch_id}", ["base_topic", "log_date"])
        _commit(batch, root, FANOUT_MANIFEST, batch_id)
        if obs is not None:
            metrics.update(obs.get)
            metrics["flights_written"] = batch.select("mcap_id").distinct().count()
        remove_dir(spark, staged)
    manifest = read_manifest(spark, root, FANOUT_MANIFEST)
    return [] if manifest is None else sorted(r["base_topic"] for r in manifest.select("base_topic").distinct().collect())


def _read(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None, batches: DataFrame | None = None,
          with_batch: bool = False) -> DataFrame:
    manifest = read_manifest(spark, root, name)
    if manifest is None or manifest.isEmpty():
        raise ValueError(f"no committed batch in {root}")
    reader = spark.read.option("mergeSchema", "true") if schema is None else \
        spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.StringType())]))
    wanted = manifest.select("batch_id").distinct() if batches is None else batches
    rows = reader.parquet(root).join(wanted, on="batch_id", how="left_semi")
    return rows if with_batch else rows.drop("batch_id")


def read_lake(spark: SparkSession, lake_dir: str) -> DataFrame:
    """All committed rows of a lake written by :func:`write_lake`, with ``base_topic``."""
    return _read(spark, lake_dir.rstrip("/"), FANOUT_MANIFEST)


def read_topic(spark: SparkSession, lake_dir: str, base_topic: str) -> DataFrame:
    """One topic table of a lake written by :func:`write_lake` (partition pruning on the topic)."""
    return read_lake(spark, lake_dir).where(F.col("base_topic") == base_topic)


def register_topic_table(spark: SparkSession, name: str, table_dir: str) -> None:
    """``CREATE TABLE IF NOT EXISTS`` over a topic table folder, partitioned by batch and ``log_date``.

    With a schema record the table is declared with the evolved schema (all columns, also those only newer files
    carry); otherwise the schema is inferred from the files.  Partitions of batches that are not committed are left
    out; call it again to take in batches committed later.
    """
    schema = topic_table_schema(spark, table_dir)
    if schema is None:
        schema = _read(spark, table_dir.rstrip("/"), MANIFEST).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema.fields, T.StructField("batch_id", T.StringType())])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet PARTITIONED BY (batch_id, log_date) LOCATION '{table_dir}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    batches = set(committed_batches(spark, table_dir))
    found = {re.search(r"batch_id=([^/]+)", r[0])[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for b in sorted(found - batches):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (batch_id = '{b}')")


def read_table_schema(spark: SparkSession, table_dir: str) -> T.StructType | None:
    """The evolved payload schema recorded for a topic table, or ``None`` for a new table."""
    path = f"{table_dir.rstrip('/')}/{TABLE_SCHEMA}"
    if not path_exists(spark, path):
        return None
    records = spark.read.schema("version long, schema string").json(path)
    last = records.orderBy(F.desc("version")).first()
    return None if last is None else T.StructType.fromJson(json.loads(last["schema"]))


def write_table_schema(spark: SparkSession, table_dir: str, schema: T.StructType) -> None:
    """Record a topic table's evolved payload schema: one small record more, the latest counts.

    Records are added, never replaced, so a failed write leaves the one before.
    """
    path = f"{table_dir.rstrip('/')}/{TABLE_SCHEMA}"
    if read_table_schema(spark, table_dir) == schema:
        return
    version = 0
    if path_exists(spark, path):
        version = 1 + (spark.read.schema("version long, schema string").json(path).agg(F.max("version")).first()[0] or 0)
    spark.createDataFrame([(version, schema.json())], "version long, schema string").coalesce(1).write.mode("append").json(path)


def topic_table_schema(spark: SparkSession, table_dir: str) -> T.StructType | None:
    """Full read schema of a topic table (standard columns, evolved payload, ``log_date``),
    from its schema record; ``None`` when the table has no record."""
    from ..functions.types import STANDARD_COLUMNS
    payload = read_table_schema(spark, table_dir)
    if payload is None:
        return None
    std = T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in STANDARD_COLUMNS if n != "log_date"))
    return T.StructType(list(std.fields) + list(payload.fields) + [T.StructField("log_date", T.DateType(), True)])


def read_topic_table(spark: SparkSession, table_dir: str, batches: DataFrame | None = None, with_batch: bool = False) -> DataFrame:
    """Committed rows of a topic table (or those of the committed ``batches`` given by ``batch_id``; ``with_batch`` keeps that column).  With a schema record the read schema is given explicitly (no footer scan of
    every file; files that predate a column read it as NULL); without one the file schemas are merged."""
    return _read(spark, table_dir.rstrip("/"), MANIFEST, topic_table_schema(spark, table_dir), batches, with_batch)
