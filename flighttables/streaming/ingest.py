"""Incremental ingest with Structured Streaming.

The batch ingest job is the source of truth; this only runs it on each new set of envelope files: ``readStream`` over a
folder of Parquet envelope files, then ``ingest_envelopes`` inside ``foreachBatch`` (payload decode, schema evolution, topic
tables, manifests).  The streaming checkpoint (offsets and commits) lives under the shared checkpoint folder, so a
restarted query resumes where it stopped.  Each micro-batch is one ingest batch named by the set of its files (path, size and
modification time), never by its epoch, whose numbers start again with every new checkpoint: a replay replaces what a failed run left
and does nothing for topics that were committed, and a query with a fresh checkpoint adds what is not held yet.  Rows are told by
(flight, source file), so a flight may be spread over files that arrive in different micro-batches; a file that has changed since it was
ingested fails the query.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import ENVELOPE_COLS, ORIGIN, ingest_envelopes
from ..session import shared_dir
from ..sources.messages import with_origin


def ingest_stream(spark: SparkSession, envelope_dir: str, envelope_schema: T.StructType | str, lake_dir: str, schemas: dict,
                  name: str | None = None, available_now: bool = True, max_files_per_trigger: int | None = None,
                  processing_time: str = "30 seconds", partials: bool = False) -> StreamingQuery:
    """Start a stream that ingests new envelope files into the lake's topic tables.

    ``available_now=True`` processes everything present and stops (catch-up);
    ``False`` keeps running and picks up files as they land, every ``processing_time``.  ``name`` names the query and its
    checkpoint (default: a name of its own for each pair of folders, so that two streams never share one).  ``partials`` keeps the curated
    views' aggregates with each batch.
    """
    name = name or "ingest-" + hashlib.sha256(f"{envelope_dir.rstrip('/')}\n{lake_dir.rstrip('/')}".encode()).hexdigest()[:16]
    reader = spark.readStream.schema(envelope_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    source = with_origin(reader.parquet(envelope_dir)).select(*ENVELOPE_COLS, *ORIGIN)

    def commit(batch: DataFrame, epoch_id: int) -> None:
        ingest_envelopes(batch.sparkSession, batch, schemas, lake_dir, on_existing="skip", partials=partials)

    checkpoint = f"{shared_dir(spark)}/flighttables/streams/{name}"
    writer = source.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
