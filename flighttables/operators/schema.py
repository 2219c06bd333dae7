"""Schema evolution of topic tables.

A topic table is created by its first writer and only ever grows: new fields become new
nullable columns at the end, and a field that arrives with a different type than the
table column of that name goes to a sibling column ``<name>__as_<suffix>``.  Widening
(all integers to bigint, floats to double) happens before the comparison, so width
changes across firmware versions never fork a column.  "First" is defined by sorted
source path, which makes the result independent of arrival order.

Two passes, as for any schema merge at scale:

1. ``resolve_columns`` works on a *fields* table — one row per (topic, source, field) —
   which is metadata-sized, and yields every source field's target column.
2. ``evolve_union`` projects each schema batch onto the table schema (renames, widening,
   typed NULLs for absent columns) and unions them by name.
"""

from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.types import STANDARD_COLUMNS, is_supported, table_type_of, type_suffix_col, widen


def supported_columns(df: DataFrame) -> DataFrame:
    """Drop map and nested-message columns (also arrays of structs): not table columns."""
    return df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields if is_supported(f.dataType)])


def fields_of(topic: str, source: str, df: DataFrame) -> list[tuple]:
    """Field rows ``(topic, source, ordinal, field, type)`` of one batch's supported columns."""
    return [(topic, source, i, f.name, table_type_of(f.dataType).simpleString())
            for i, f in enumerate(df.schema.fields) if is_supported(f.dataType)]


FIELDS_SCHEMA = "topic string, source string, ordinal int, field string, type string"


def resolve_columns(fields: DataFrame) -> DataFrame:
    """Target column of every (topic, source, field) under first-writer-wins typing.

    Output: ``topic, source, field, type, column, first_source, position`` where
    ``position`` orders the table's columns (first source, then field ordinal).
    """
    first = (fields.groupBy("topic", "field")
             .agg(F.min_by("type", F.struct("source", "ordinal")).alias("first_type")))
    mapped = fields.join(first, on=["topic", "field"], how="inner").withColumn(
        "column", F.when(F.col("type") == F.col("first_type"), F.col("field"))
        .otherwise(F.concat(F.col("field"), F.lit("__as_"), type_suffix_col(F.col("type")))))
    order = (mapped.groupBy("topic", "column")
             .agg(F.min(F.struct("source", "ordinal")).alias("_first"))
             .select("topic", "column", F.col("_first.source").alias("first_source"),
                     F.col("_first.ordinal").alias("first_ordinal")))
    return (mapped.join(order, on=["topic", "column"], how="inner")
            .select("topic", "source", "field", "type", "column", "first_source",
                    F.struct("first_source", "first_ordinal").alias("position")))


def table_schema(resolved_rows: list) -> "OrderedDict[str, str]":
    """Column name -> type name of one topic table, in column order (from resolved rows)."""
    cols = sorted({(r["position"]["first_source"], r["position"]["first_ordinal"], r["column"], r["type"])
                   for r in resolved_rows})
    out: OrderedDict[str, str] = OrderedDict()
    for _, _, c, t in cols:
        out.setdefault(c, t)
    clash = [c for c in out if c in {n for n, _ in STANDARD_COLUMNS}]
    if clash:
        raise ValueError(f"payload fields named like standard columns: {clash}")
    return out


def evolved_columns(spark: SparkSession, topic: str, sources: list[tuple[str, list[tuple]]], existing=None):
    """Evolve a topic table by the fields of ``sources``: ``(source, [(field, data type)])`` pairs.

    ``existing`` (a payload schema) comes before all sources.  Returns (column -> type name in column order,
    source -> {field -> column}).  The one evolution routine: it runs :func:`resolve_columns` over field rows (metadata only).
    """
    rows = [(topic, "", i, f.name, f.dataType.simpleString()) for i, f in enumerate(existing.fields if existing else [])]
    for source, fields in sources:
        rows += [(topic, f"_{source}", i, name, table_type_of(t).simpleString()) for i, (name, t) in enumerate(fields)]
    resolved = resolve_columns(spark.createDataFrame(rows, FIELDS_SCHEMA)).collect()
    mapping: dict[str, dict[str, str]] = {}
    for r in resolved:
        if r["source"]:
            mapping.setdefault(r["source"][1:], {})[r["field"]] = r["column"]
    return table_schema(resolved), mapping


def evolve_union(spark: SparkSession, topic: str, batches: list[tuple[str, DataFrame]],
                 keep: list[str] | None = None) -> DataFrame:
    """Union schema batches of one topic into its evolved table schema.

    ``batches`` are ``(source, DataFrame)`` pairs — one per payload schema (e.g. per
    firmware version) — whose columns are the payload fields plus the ``keep`` columns
    (standard or key columns, passed through unchanged).  The resolution runs over
    the batches' field rows (metadata only); the data is never collected.
    """
    keep = keep or []
    schema, by_source = evolved_columns(spark, topic, [
        (source, [(f.name, f.dataType) for f in df.schema.fields if f.name not in keep and is_supported(f.dataType)])
        for source, df in batches])
    out = None
    for source, df in batches:
        mapping = by_source.get(source, {})
        dtypes = {f.name: f.dataType for f in df.schema.fields}
        present = {mapping[f]: f for f in mapping}
        cols = [F.col(f"`{c}`") for c in keep]
        for c, t in schema.items():
            if c in present:
                cols.append(widen(F.col(f"`{present[c]}`"), dtypes[present[c]]).cast(t).alias(c))
            else:
                cols.append(F.lit(None).cast(t).alias(c))
        part = df.select(*cols)
        out = part if out is None else out.unionByName(part)
    return out
