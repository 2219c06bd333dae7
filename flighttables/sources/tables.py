"""Table scans and catalog registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Deal a scan's rows round-robin to ``partitions`` tasks.

    For a small file with one row group, which one task reads, when heavy per-row work (explode, pattern matching, byte
    text) follows; a large input has input splits enough and needs no such shuffle.
    """
    return df if df.rdd.getNumPartitions() >= partitions else df.repartition(partitions)


def read_table(spark: SparkSession, root: str, name: str, spread_to: int | None = None) -> DataFrame:
    """Parquet table ``<root>/<name>.parquet`` (or a partitioned folder of that name), dealt by :func:`spread` if asked for."""
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
    return spread(df, spread_to) if spread_to else df


def register_tables(spark: SparkSession, root: str, names=DRIVER_TABLES) -> list[str]:
    """Register each table as a temp view so it can be queried by name with ``spark.sql``."""
    for n in names:
        read_table(spark, root, n).createOrReplaceTempView(n)
    return list(names)


def register_lake(spark: SparkSession, lake_dir: str, topics: list[str]) -> None:
    """Register written topic tables (one folder per base topic) as temp views.

    Each table is read with its recorded evolved schema (files written before a column was
    added read it as NULL), or with merged file schemas when it has no record.
    """
    from ..sinks.lake import read_topic_table
    for t in topics:
        read_topic_table(spark, f"{lake_dir.rstrip('/')}/{t}").createOrReplaceTempView(t)


def catalog_tables(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """``SHOW ALL TABLES``: registered tables and views with column and row counts.

    The listing is catalog metadata; the row counts are one distributed count per table.
    ``names`` restricts the listing to those tables.
    """
    out = None
    for t in spark.catalog.listTables():
        if names is not None and t.name not in names:
            continue
        tbl = spark.table(t.name)
        part = tbl.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(t.name).alias("name"), F.lit(t.tableType).alias("table_type"),
            F.lit(bool(t.isTemporary)).alias("is_temporary"), F.lit(len(tbl.columns)).alias("n_columns"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def describe(spark: SparkSession, name: str) -> DataFrame:
    """``DESCRIBE <table>``: column name and type rows."""
    return spark.sql(f"DESCRIBE TABLE {name}")


def open_lake(spark: SparkSession, lake_dir: str, folded: bool = False) -> list[str]:
    """Attach a lake: every topic table becomes a view, plus the ``format_duration`` SQL
    function and the curated views whose inputs exist.

    Two layouts are recognised: one folder per topic (the ingest job; topics found from the
    tables' manifests by a distributed listing) and the single-pass fan-out of ``write_lake``
    (``base_topic=<t>`` partitions; topics from the lake's manifest).  ``folded`` takes the curated views from the partial
    aggregates that the batches of the first layout keep, and adds ``max_altitude``.  Returns the topics.
    """
    from ..operators.curated import register_curated_views
    from ..operators.partials import register_folded_views
    from ..functions.time import register_sql_functions
    from ..sinks.lake import FANOUT_MANIFEST, MANIFEST, read_manifest, read_topic
    root = lake_dir.rstrip("/")
    fanout = read_manifest(spark, root, FANOUT_MANIFEST)      # None: one folder per topic
    if fanout is not None:
        topics = sorted(r["base_topic"] for r in fanout.select("base_topic").distinct().collect())
        for t in topics:
            read_topic(spark, root, t).drop("base_topic").createOrReplaceTempView(t)
    else:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/*/{MANIFEST}").select("path")
        topics = sorted(r["t"] for r in listing.select(
            F.regexp_extract("path", rf"/([^/]+)/{MANIFEST}/", 1).alias("t")).distinct().collect())
        register_lake(spark, root, topics)
    register_sql_functions(spark)
    if folded:
        if fanout is not None:
            raise ValueError(f"{root} has no partial aggregates: it was written by write_lake")
        register_folded_views(spark, root, topics)
        return topics
    views = [v for v, needs in (("error_counts", {"logged_messages"}),
                                ("flights", {"vehicle_status", "logged_messages"}),
                                ("battery", {"battery_status"})) if needs <= set(topics)]
    register_curated_views(spark, views=tuple(views))
    return topics
