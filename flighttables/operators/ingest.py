"""Message envelopes -> topic tables (S3, A8, P1, W2, U2, K1-K4, O3, A9): the ingest job.

Input envelope rows: ``mcap_id, log_date, topic, log_time_ns, publish_time_ns, sequence, schema_name, payload`` (payload =
JSON text) and, optionally, ``source`` (the file a row came from), ``stamp`` (what tells versions of that file apart), ``file_size`` and
``row_index`` (the row's place in it), as :func:`flighttables.sources.messages.read_envelopes` gives them.  Steps:

1. descriptor check: every instance of a base topic of a flight carries one descriptor (fails fast);
2. stage the envelopes once, by base topic and day (one shuffle, a written table in the shared folder, removed at the end),
   so each topic's job reads only its own folder and needs no shuffle of its own;
3. per base topic: each payload is parsed once, into its fields by name as VARIANT values, and each column picks its field by the
   row's descriptor, so the topic is scanned and parsed once however many descriptors it has (fail fast, also on a field
   outside the descriptor).  Fields that the descriptor has but a payload leaves out read as their type's zero value; columns that the
   descriptor lacks are NULL.  The table's payload schema is evolved over all descriptors of the batch and recorded
   (first writer wins; a field arriving with another type goes to ``<name>__as_<suffix>``; new fields append), then
   the rows are appended to the topic table as one batch, equal publish times in the order of the input files;
4. what the job did (files, bytes, rows, seconds) is added to the lake's run table.

A batch of files is named by their set (:func:`batch_digest`): the same files are the same batch, whoever runs it, and
other files never are.  The loop in step 3 runs over the topic list (metadata); each iteration is a distributed job over that topic's rows only.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.types import is_supported, variant_value, widen, zero_value
from ..session import new_output_dir, remove_dir
from ..sinks.lake import new_batch_id, read_table_schema, write_flight_metadata, write_run, write_table_schema, write_topic_table, written_files
from ..sources.messages import parse_fields
from .messages import descriptor_check, standard_columns, with_topic_parts
from .partials import partials_of
from .schema import evolved_columns

ENVELOPE_COLS = ["mcap_id", "log_date", "topic", "log_time_ns", "publish_time_ns", "sequence", "schema_name", "payload"]
#: Columns that tell where a row came from, and their types.
ORIGIN = {"source": "string", "stamp": "string", "file_size": "bigint", "row_index": "bigint"}
_KEYS = ["mcap_id", "source", "stamp", "row_index", "log_date", "base_topic", "multi_id", "log_time_ns", "publish_time_ns", "sequence"]


def _struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _by_descriptor(given, found: list[str | None]) -> dict[str | None, T.StructType]:
    """Schema of each descriptor: given one by one, or one for all of the topic."""
    if not isinstance(given, dict):
        return {d: _struct(given) for d in found}
    missing = [d for d in found if d not in given]
    if missing:
        raise ValueError(f"no payload schema for descriptors {missing}")
    return {d: _struct(given[d]) for d in found}


def batch_digest(rows: DataFrame) -> str | None:
    """A name for the set of files (source, stamp) that ``rows`` came from; ``None`` if any row lacks its stamp.

    The digest doesn't depend on order: the number of distinct files and two 64-bit hashes of each, joined by exclusive or.
    """
    files = rows.select("source", "stamp").distinct()
    h = lambda salt: F.bit_xor(F.xxhash64("source", "stamp", F.lit(salt)))
    r = files.agg(F.count(F.lit(1)).alias("n"), F.count("stamp").alias("known"), h(1).alias("x"), h(2).alias("y")).first()
    if not r["n"] or r["known"] < r["n"]:
        return None
    return f"files-{r['n']}-{r['x'] & (2 ** 64 - 1):016x}{r['y'] & (2 ** 64 - 1):016x}"


def _only_known_fields(rows: DataFrame, schemas: dict[str | None, T.StructType]) -> DataFrame:
    """Rows as they are; a payload (``_fields``) with a field that its descriptor lacks fails the job."""
    known = F.array().cast("array<string>")
    for names in {tuple(s.fieldNames()) for s in schemas.values()}:
        mine = [d for d, s in schemas.items() if tuple(s.fieldNames()) == names]
        known = F.when(_is_one_of(mine), F.array(*map(F.lit, names)).cast("array<string>")).otherwise(known)
    extra = F.array_except(F.map_keys("_fields"), known)
    ok = F.coalesce(F.size(extra) <= 0, F.lit(True))
    said = F.concat(F.lit("payload fields outside the descriptor's schema: "), F.array_join(F.coalesce(extra, F.array()), ", "))
    return rows.where(F.assert_true(ok, said).isNull())


def _is_one_of(descriptors: list[str | None]) -> Column:
    name, named = F.col("schema_name"), [d for d in descriptors if d is not None]
    one = F.coalesce(name.isin(named), F.lit(False)) if named else F.lit(False)
    return one | name.isNull() if None in descriptors else one


def decode_topic(rows: DataFrame, schemas: dict[str | None, T.StructType], columns: dict[str, str], mapping: dict[str, dict[str, str]]) -> DataFrame:
    """Key columns and the table's payload ``columns`` of one topic's envelopes, in one pass for all descriptors.

    ``mapping`` has, by the number of the descriptor in ``schemas``, the column of each field.
    """
    parsed = _only_known_fields(rows.select(*_KEYS, "schema_name", parse_fields(F.col("payload")).alias("_fields")), schemas)
    payload = []
    for column, t in columns.items():
        dtype = T.StructType.fromDDL(f"c {t}")[0].dataType
        sources: dict[tuple, list] = {}  # descriptors by the field, and its type, that the column takes from them
        for i, (descriptor, schema) in enumerate(schemas.items()):
            for field in schema.fields:
                if mapping.get(f"{i:09d}", {}).get(field.name) == column:
                    sources.setdefault((field.name, field.dataType.json()), []).append((descriptor, field))
        value = F.lit(None).cast(dtype)
        for (name, _), of in sources.items():
            kind = of[0][1].dataType
            found = widen(variant_value(F.try_element_at("_fields", F.lit(name)), kind), kind).cast(dtype)
            value = F.when(_is_one_of([d for d, _ in of]), F.coalesce(found, zero_value(dtype))).otherwise(value)
        payload.append(value.alias(column))
    return parsed.select(*_KEYS, *payload)


def ingest_envelopes(spark: SparkSession, envelopes: DataFrame, schemas: dict, lake_dir: str, on_existing: str = "error",
                     parallel_topics: int = 4, batch_id: str | None = None, metadata: DataFrame | None = None,
                     partials: bool = False) -> list[str]:
    """Write every base topic of ``envelopes`` to ``<lake_dir>/<base_topic>``; returns the topics.

    ``metadata`` has the metadata records of the same files (see :func:`flighttables.sinks.lake.write_flight_metadata`); they go to the lake's side
    table in the same batch.  ``partials`` keeps the curated views' aggregates of the batch with it (:mod:`flighttables.operators.partials`).

    ``schemas`` has a payload schema per base topic, or per base topic a dictionary of schemas by descriptor name.
    ``batch_id`` names the run (default: the digest of the files, where the rows tell them): run again, it replaces what a failed run left and
    skips the topics it committed.  Topic jobs are independent (own table, manifest and schema record) and are submitted from ``parallel_topics`` driver
    threads, so many small topics keep the cluster busy.
    """
    started = time.time()
    origin = [(F.col(c) if c in envelopes.columns else F.col("mcap_id") if c == "source" else F.lit(None)).cast(t).alias(c) for c, t in ORIGIN.items()]
    env = with_topic_parts(envelopes.select(*ENVELOPE_COLS, *origin))
    staged = new_output_dir(spark, "ingest-staging")
    try:
        # rebalance: rows of a topic and day gather in few tasks (AQE splits a hot one), so the staged table has about
        # size/advisory files per topic and day instead of one per task.
        (env.withColumn("_day", F.col("log_date").cast("date")).hint("rebalance", "base_topic", "_day")
         .write.partitionBy("base_topic", "_day").parquet(staged))
        whole = spark.read.schema(T.StructType([*env.schema.fields, T.StructField("_day", T.DateType())])).parquet(staged)
        batch_id = batch_id or batch_digest(whole) or new_batch_id()
        # The descriptor check and the batch's list of (topic, descriptor), in the order of their first source file.
        descriptor_check(whole).agg(F.count(F.lit(1))).collect()
        listed: dict[str, list[str | None]] = {}
        for r in (whole.groupBy("base_topic", "schema_name").agg(F.min("source").alias("s")).orderBy("s", "schema_name").collect()):
            listed.setdefault(r["base_topic"], []).append(r["schema_name"])
        missing = sorted(t for t in listed if t not in schemas)
        if missing:
            raise ValueError(f"no payload schema for topics {missing}")
        files = (whole.groupBy("source").agg(F.max("file_size").alias("size"), F.count(F.lit(1)).alias("rows"))
                 .agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("in_bytes"), F.sum("rows").alias("rows_in")).first())
        read_seconds = time.time() - started

        def one(topic: str) -> dict:
            begun = time.time()
            rows = whole.where(F.col("base_topic") == topic)
            variants = _by_descriptor(schemas[topic], listed[topic])
            table_dir = f"{lake_dir.rstrip('/')}/{topic}"
            columns, mapping = evolved_columns(spark, topic, [(f"{i:09d}", [(f.name, f.dataType) for f in s.fields if is_supported(f.dataType)])
                                                              for i, s in enumerate(variants.values())], read_table_schema(spark, table_dir))
            evolved = T.StructType([T.StructField(c, T.StructType.fromDDL(f"c {t}")[0].dataType, True) for c, t in columns.items()])
            write_table_schema(spark, table_dir, evolved)  # before the data: no row is ever in a column that is not recorded
            decoded = decode_topic(rows, variants, columns, mapping)
            table = standard_columns(decoded, payload_cols=[*columns, "source", "stamp", "row_index"]).drop("base_topic")
            prepared, counted = time.time(), Observation(f"rows of {topic}")
            wrote = write_topic_table(spark, table, table_dir, on_existing=on_existing, batch_id=batch_id, rebalance=False,
                                      listing=rows.select("mcap_id", "source", "stamp", F.col("_day").alias("log_date")), counted=counted,
                                      partials=partials_of(topic) if partials else ())
            n, size = written_files(spark, f"{table_dir}/batch_id={batch_id}") if wrote else (0, 0)
            return {"base_topic": topic, "out_files": n, "out_bytes": size, "rows_written": counted.get["rows"] if wrote else 0,
                    "transform_seconds": prepared - begun, "write_seconds": time.time() - prepared}

        with ThreadPoolExecutor(max_workers=max(1, parallel_topics)) as pool:
            done = list(pool.map(one, sorted(listed)))
        if metadata is not None:
            write_flight_metadata(spark, metadata, lake_dir, on_existing, batch_id)
        write_run(spark, lake_dir, batch_id, [{**d, "n_files": files["n_files"], "in_bytes": files["in_bytes"], "rows_in": files["rows_in"],
                                               "read_seconds": read_seconds} for d in done])
        return [d["base_topic"] for d in done]
    finally:
        remove_dir(spark, staged)
