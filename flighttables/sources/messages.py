"""Message payload decoding (S3) and the log catalog reader.

Payloads are self-described JSON text; they are decoded against the topic's schema with
``FAILFAST`` so a malformed payload fails the job instead of silently becoming NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def decode_payload(messages: DataFrame, schema: T.StructType | str, payload_col: str = "payload",
                   keep: list[str] | None = None, into: str | None = None) -> DataFrame:
    """Parse ``payload_col`` with ``schema`` (fail fast); its fields stand next to ``keep``, or as one struct ``into``."""
    parsed = F.from_json(F.col(payload_col), schema, {"mode": "FAILFAST"})
    keep = keep if keep is not None else [c for c in messages.columns if c != payload_col]
    if into:
        return messages.select(*keep, parsed.alias(into))
    return messages.select(*keep, parsed.alias("_payload")).select(*keep, "_payload.*")


def parse_fields(payload) -> Column:
    """The fields of a JSON payload by name, each a VARIANT: one parse, whatever types they turn out to have (fail fast; NULL for an empty text)."""
    return F.from_json(payload, "map<string,variant>", {"mode": "FAILFAST"})


def with_origin(envelopes: DataFrame) -> DataFrame:
    """Envelopes read from Parquet files with where each row came from: ``source`` (path), ``stamp`` (size and modification time of the
    file), ``file_size`` and ``row_index`` (place in the file).  Works on batch and streaming reads."""
    m = lambda c: F.col(f"_metadata.{c}")
    stamp = F.concat_ws("-", m("file_size").cast("string"), F.unix_millis(m("file_modification_time")).cast("string"))
    return envelopes.select("*", m("file_path").alias("source"), stamp.alias("stamp"), m("file_size").alias("file_size"),
                            m("row_index").alias("row_index"))


def read_envelopes(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Envelope files (Parquet) under ``path`` with their rows' origin."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return with_origin(reader.parquet(path))


def read_log_catalog(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                     multi_line: bool = True) -> DataFrame:
    """Log catalog records, ``log_date`` as DATE.

    ``multi_line=True`` reads the service format (each file one JSON array of records);
    ``False`` reads JSON lines as written by ``write_log_catalog``.
    """
    reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(path)
    if "log_date" in df.columns:
        df = df.withColumn("log_date", F.to_date("log_date", "yyyy-MM-dd"))
    return df


def write_log_catalog(df: DataFrame, path: str) -> None:
    """Write catalog records as JSON lines (one record per line, keys in column order)."""
    df.write.mode("errorifexists").json(path)


def catalog_as_json(df: DataFrame, out: str = "json") -> DataFrame:
    """Each catalog record as one JSON object with its keys in sorted order (``--print`` view)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)])).alias(out))
