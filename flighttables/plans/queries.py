"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query builds its stand-in input from the driver tables (``standins``) and runs the
library operator on it.  Columns are aliased to the names used by ``oracle.ORACLE_SQL``.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window

from ..operators import curated
from . import standins as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


@query("flights_overview")
def flights_overview(spark, root):
    """Flagship: flight overview with armed duration and error counts."""
    return curated.flights(S.vehicle_status(spark, root), S.logged_messages(spark, root))


@query("error_counts")
def error_counts(spark, root):
    """ERROR log rows per flight."""
    return curated.error_counts(S.logged_messages(spark, root))


@query("battery_ranges")
def battery_ranges(spark, root):
    """Min / max of the battery measures per (flight, instance, cell count)."""
    return curated.battery(S.battery_status(spark, root))


@query("max_altitude")
def max_altitude(spark, root):
    """Highest point, start and formatted duration per flight."""
    return curated.max_altitude(S.local_position(spark, root))


# ---------------------------------------------------------------- log catalog selection
from ..operators import catalog as C  # noqa: E402

CATALOG_SELECT = C.CatalogQuery(mav_type=["1-URGENT", "2-high", "3-Medium"], rating=["f", "O"],
                                airframe_type="quad", latest_per_vehicle=True, source="webui", max_num=25)
CATALOG_ALL = C.CatalogQuery(mav_type=["1-URGENT", "2-high", "3-Medium"], rating=["f", "O"],
                             airframe_type="quad", latest_per_vehicle=True, source="webui", max_num=0)
CATALOG_NEW = C.CatalogQuery(mav_type=["1-urgent", "2-HIGH"], max_num=500)


@query("latest_per_vehicle")
def latest_per_vehicle(spark, root):
    """Latest log per vehicle (ties to the first in input order; no-uuid rows dropped)."""
    return C.latest_per_vehicle(S.log_catalog(spark, root))


@query("catalog_select")
def catalog_select(spark, root):
    """Full filter chain, newest first, top 25."""
    return C.select_logs(S.log_catalog(spark, root), CATALOG_SELECT)


@query("catalog_matches")
def catalog_matches(spark, root):
    """Full filter chain without a limit (every matching log)."""
    return C.select_logs(S.log_catalog(spark, root), CATALOG_ALL)


CATALOG_IDS = C.CatalogQuery(log_id=["L1", "L-2", "-L-33-", "L--4--5", "L-1000"])
CATALOG_UUIDS = C.CatalogQuery(uuid=["veh-1", "veh-7", "VEH-8", "veh-11"])
CATALOG_NAMES = C.CatalogQuery(vehicle_name="vehicle-7", airframe_name="airframe-1", git_hash="v1996")


@query("catalog_by_log_id")
def catalog_by_log_id(spark, root):
    """Logs by id, dashes ignored on both sides."""
    return C.select_logs(S.log_catalog(spark, root), CATALOG_IDS)


@query("catalog_by_uuid")
def catalog_by_uuid(spark, root):
    """Logs by exact vehicle uuid."""
    return C.select_logs(S.log_catalog(spark, root), CATALOG_UUIDS)


@query("catalog_by_names")
def catalog_by_names(spark, root):
    """Logs by vehicle name, airframe name and firmware hash, each applied alone."""
    cat, q = S.log_catalog(spark, root), CATALOG_NAMES
    parts = [("vehicle_name", C.CatalogQuery(vehicle_name=q.vehicle_name)), ("airframe_name", C.CatalogQuery(airframe_name=q.airframe_name)),
             ("git_hash", C.CatalogQuery(git_hash=q.git_hash))]
    out = None
    for name, one in parts:
        got = C.filter_catalog(cat, one).select(F.lit(name).alias("by"), "log_id")
        out = got if out is None else out.unionByName(got)
    return out


@query("held_log_count")
def held_log_count(spark, root):
    """Number of held raw logs and whether the skip gate closes at a third, all and more than all of them."""
    held = FS.count_files(S.held_log_files(spark, root))
    n = held.first()["n_files"]
    gates = [(k, C.skip_gate(n, C.CatalogQuery(skip_if_cached=limit, overwrite=overwrite)))
             for k, limit, overwrite in (("third", n // 3 + 1, False), ("all", n, False), ("more", n + 1, False),
                                         ("off", 0, False), ("overwrite", 1, True))]
    return held.crossJoin(F.broadcast(spark.createDataFrame(gates, "gate string, closed boolean")))


@query("catalog_new_only")
def catalog_new_only(spark, root):
    """Top 500 by date, minus ids of already held raw logs (limit before anti-join)."""
    sel = C.select_logs(S.log_catalog(spark, root), CATALOG_NEW)
    held = C.held_ids_from_files(S.held_log_files(spark, root))
    return C.new_logs(sel, held, CATALOG_NEW)


@query("catalog_outcomes")
def catalog_outcomes(spark, root):
    """Selected vs already-held counts for the top-500 selection."""
    sel = C.select_logs(S.log_catalog(spark, root), CATALOG_NEW)
    held = C.held_ids_from_files(S.held_log_files(spark, root))
    return C.selection_outcomes(sel, held, CATALOG_NEW)


@query("skip_existing")
def skip_existing(spark, root):
    """Raw-log keys whose converted output does not exist yet."""
    return C.pending_conversions(S.raw_log_keys(spark, root), S.converted_keys(spark, root))


# ---------------------------------------------------------------- names, times, levels
from pyspark.sql import functions as F  # noqa: E402

from ..functions import levels as L, names as N, time as TM  # noqa: E402
from ..operators import messages as M  # noqa: E402

from ..operators.series import NAV_STATE_LABELS  # noqa: E402


@query("topic_split")
def topic_split(spark, root):
    """Base topic and u8 instance id of every channel name."""
    t = S.topic_names(spark, root)
    return t.select("ordinal", "topic", N.topic_base("topic").alias("base_topic"),
                    N.topic_multi_id("topic").alias("multi_id"))


@query("topic_compose")
def topic_compose(spark, root):
    """Compose ``{name}_{multi_id}`` then parse it back."""
    ev = S._t(spark, root, "events")
    composed = ev.select(F.col("event_id").alias("ordinal"), F.col("event_type").alias("name"),
                         F.col("user_id").cast("int").alias("instance"))
    composed = composed.withColumn("topic", N.compose_topic("name", "instance"))
    return composed.select("ordinal", "topic", N.topic_base("topic").alias("base_topic"),
                           N.topic_multi_id("topic").alias("multi_id"))


@query("names_from_paths")
def names_from_paths(spark, root):
    """Flight id, log id, log date and epoch day from message-file paths."""
    p = S.message_file_paths(spark, root)
    return p.select("ordinal", N.mcap_id_from_path("path").alias("mcap_id"),
                    N.log_id_from_stem(N.mcap_id_from_path("path")).alias("log_id"),
                    N.log_date_from_name(N.file_name("path")).alias("log_date"),
                    TM.days_since_epoch(N.log_date_from_name(N.file_name("path"))).alias("log_day"))


@query("log_id_from_name")
def log_id_from_name(spark, root):
    """Log id of every raw-log stem (date prefix stripped when present)."""
    s = S.log_file_stems(spark, root)
    return s.select("ordinal", "stem", N.log_id_from_stem("stem").alias("log_id"))


@query("standard_columns")
def standard_columns(spark, root):
    """Standard columns of message envelopes, sorted by publish time for writing."""
    m = S.message_envelopes(spark, root)
    return M.sort_for_write(M.standard_columns(m, payload_cols=["ordinal", "value"]))


@query("sec_nsec")
def sec_nsec(spark, root):
    """Sample times split into seconds and nanoseconds, and scaled to nanoseconds."""
    s = S.sample_micros(spark, root)
    return s.select("ordinal", "ts_us", TM.micros_to_sec_nsec("ts_us").alias("t"),
                    TM.micros_to_nanos("ts_us").alias("ts_ns")) \
            .select("ordinal", "ts_us", F.col("t.sec").alias("sec"), F.col("t.nsec").alias("nsec"), "ts_ns")


@query("level_remap")
def level_remap(spark, root):
    """Source log levels mapped to lake levels, their rank and the panel filter."""
    lv = S.source_log_levels(spark, root).withColumn("level", L.remap_level("source_level"))
    return lv.select("ordinal", "source_level", "level", L.level_rank("level").alias("level_rank"),
                     L.at_least_level("level").alias("shown"))


@query("enum_label")
def enum_label(spark, root):
    """Navigation state numbers labelled (UNKNOWN_<n> for unlisted numbers)."""
    vs = S.vehicle_status(spark, root)
    return vs.select("ordinal", "nav_state", L.enum_label("nav_state", NAV_STATE_LABELS).alias("nav_state_label"))


@query("format_duration_cases")
def format_duration_cases(spark, root):
    """Time of day of every event as an interval, formatted."""
    ev = S._t(spark, root, "events")
    d = F.col("ts") - F.col("ts").cast("date").cast("timestamp_ntz")
    return ev.select(F.col("event_id").alias("ordinal"), TM.format_duration(d).alias("duration"))


# ---------------------------------------------------------------- logs, parameters, payloads
from ..operators import logs as LG  # noqa: E402
from ..sources import messages as MS  # noqa: E402


@query("log_messages")
def log_messages(spark, root):
    """Tagged log records merged per flight by time, tag order, input order."""
    return LG.merge_tagged(S.conversation_logs(spark, root))


@query("parameter_split")
def parameter_split(spark, root):
    """Parameter values split into an integer or a real branch."""
    return LG.parameter_changes(S.parameter_rows(spark, root))


@query("payload_decode")
def payload_decode(spark, root):
    """JSON payloads decoded against their schema (fail fast)."""
    ev = S._t(spark, root, "events").select("event_id", "props")
    return MS.decode_payload(ev, "k BIGINT", payload_col="props")


@query("metadata_map")
def metadata_map(spark, root):
    """Metadata map per log, looked up with a default, emitted as (log, key, value) rows."""
    maps = LG.metadata_lookup(LG.metadata_maps(S.metadata_rows(spark, root)), "ver_sw", "unknown", "ver_sw")
    return maps.select("mcap_id", "ver_sw", F.explode("metadata").alias("key", "value"))


@query("metadata_named")
def metadata_named(spark, root):
    """The three named metadata maps of each log as rows; a repeated key keeps its last value."""
    maps = LG.named_metadata(S.named_metadata_rows(spark, root), ordinal_col="ordinal")
    out = None
    for name in LG.METADATA_NAMES:
        part = maps.select("mcap_id", F.lit(name).alias("name"), F.explode(name).alias("key", "value"))
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- unflattening
from ..functions import text as TX  # noqa: E402
from ..operators import unflatten as U  # noqa: E402


@query("samples_to_rows")
def samples_to_rows(spark, root):
    """Columnar topic datasets turned into one row per sample."""
    return U.samples_to_rows(S.embedding_datasets(spark, root), ["control[0]", "control[1]"])


@query("topic_fields")
def topic_fields(spark, root):
    """Each topic's field list in declaration order, as text."""
    tf = U.topic_fields(S.field_rows(spark, root))
    return tf.select("mcap_id", "topic", F.array_join(F.transform("fields", lambda x: F.concat(x["field"], F.lit(":"), x["type"])),
                                           ",").alias("fields"))


@query("schema_registry")
def schema_registry(spark, root):
    """One schema per type: first channel and instance count."""
    return U.schema_registry(S.channels(spark, root))


@query("field_classify")
def field_classify(spark, root):
    """Table columns derived from flat field lists."""
    return U.classify_fields(S.field_rows(spark, root))


@query("field_drops")
def field_drops(spark, root):
    """Flat fields that get no column, with reason and warning flag."""
    return U.dropped_fields(S.field_rows(spark, root))


@query("pack_arrays")
def pack_arrays(spark, root):
    """Flat array columns packed into an array (exploded) and a char array into text."""
    packed = U.pack_flat_columns(S.flat_samples(spark, root), text_bases=("flag",))
    return packed.select("l_orderkey", "l_linenumber", "flag", F.posexplode("m").alias("pos", "m"))


@query("pack_topic")
def pack_topic(spark, root):
    """A topic's flat samples packed by its field list: arrays, texts and arrays of texts; other fields left out."""
    packed = U.pack_topic(S.motor_samples(spark, root), S.MOTOR_FIELDS)
    return packed.select("l_orderkey", "l_linenumber", "time", F.array_join("motor__tag", "/").alias("tags"),
                         F.element_at("motor__volt", 1).alias("volt_0"), F.element_at("motor__volt", 2).alias("volt_1"),
                         F.element_at("mix", -1).alias("mix_last"), "unit", F.lit(len(packed.columns)).alias("n_columns"))


@query("struct_array_transpose")
def struct_array_transpose(spark, root):
    """Struct-array leaves packed and transposed into per-leaf arrays (exploded)."""
    packed = U.transpose_struct_array(U.pack_struct_array_columns(S.struct_array_samples(spark, root)), "motors")
    z = F.arrays_zip("esc__rpm", "esc__temp", "motors__id", "motors__sid")
    return packed.select("l_orderkey", "l_linenumber", F.posexplode(z).alias("pos", "z")).select(
        "l_orderkey", "l_linenumber", "pos", "z.*")


@query("char_text")
def char_text(spark, root):
    """Whole texts stored as signed char arrays decoded back to text."""
    return S.char_samples(spark, root).select("conv_id", "turn", TX.char_array_to_text("chars").alias("text"))


@query("char_text_array")
def char_text_array(spark, root):
    """Arrays of char arrays decoded to arrays of text (joined per row)."""
    t = S.char_array_samples(spark, root).select("conv_id", "turn", TX.char_arrays_to_texts("chars").alias("texts"))
    return t.select("conv_id", "turn", F.size("texts").alias("n_lines"), F.array_join("texts", "\n").alias("text"))


# ---------------------------------------------------------------- trajectory, merge
from ..operators import merge as MG, trajectory as TJ  # noqa: E402


@query("trajectory_points")
def trajectory_points(spark, root):
    """Instance-0 trajectory points in ENU with their index in sample order."""
    return TJ.trajectory_points(S.position_samples(spark, root))


@query("trajectory_first_ts")
def trajectory_first_ts(spark, root):
    """Per flight: first valid sample time, point count and scene constants."""
    return TJ.trajectory_summary(S.position_samples(spark, root))


@query("merge_streams")
def merge_streams(spark, root):
    """Topic samples, tagged logs and parameter changes merged per flight in time order."""
    return MG.merge_streams(S.merge_inputs(spark, root))


# ---------------------------------------------------------------- schema evolution, sink, catalog
from ..operators import schema as SC  # noqa: E402
from ..session import new_output_dir  # noqa: E402
from ..sinks import lake as LK  # noqa: E402
from ..sources import files as FS, tables as TB  # noqa: E402

_KEYS = ["mcap_id", "log_time", "ordinal"]


@query("union_missing")
def union_missing(spark, root):
    """Two payload schema versions unioned; fields absent from a version read as NULL."""
    return SC.evolve_union(spark, "events", S.schema_batches(spark, root, conflict=False), keep=_KEYS)


@query("type_conflict_sibling")
def type_conflict_sibling(spark, root):
    """Two payload schema versions with a type change; the later type goes to a sibling column."""
    return SC.evolve_union(spark, "events", S.schema_batches(spark, root, conflict=True), keep=_KEYS)


@query("supported_fields")
def supported_fields(spark, root):
    """Payload rows with map and struct fields dropped."""
    kept = SC.supported_columns(S.nested_payloads(spark, root))
    return kept.select("event_id", "value", F.element_at("tags", 1).alias("tag"),
                       F.lit(len(kept.columns)).alias("n_columns"))


@query("descriptor_check")
def descriptor_check(spark, root):
    """Per (flight, base topic): message and descriptor counts, failing on a mismatch."""
    return M.descriptor_check(S.channel_messages(spark, root))


@query("topic_counts")
def topic_counts(spark, root):
    """Messages per channel."""
    return M.topic_counts(S.channel_messages(spark, root))


def _write_sample_lake(spark, root, name):
    """Standard-column messages appended to a fresh lake folder in two batches (by day)."""
    msgs = M.standard_columns(S.message_envelopes(spark, root), payload_cols=["ordinal", "value"])
    lake = new_output_dir(spark, name)
    switch = F.lit(S.FIRMWARE_SWITCH[:10]).cast("date")
    LK.write_lake(spark, msgs.where(F.col("log_date") < switch), lake, mode="append")
    LK.write_lake(spark, msgs.where(F.col("log_date") >= switch), lake, mode="append")
    return lake


@query("partitioned_append")
def partitioned_append(spark, root):
    """Write topic tables (two appends), read the whole lake back."""
    lake = _write_sample_lake(spark, root, "partitioned_append")
    return LK.read_lake(spark, lake)


@query("file_manifest")
def file_manifest(spark, root):
    """Files of a written lake by the topic and day in their path, with the rows that lie in them."""
    lake = _write_sample_lake(spark, root, "file_manifest")
    files = FS.list_files(spark, lake, ".parquet").where(~F.col("path").contains(LK.FANOUT_MANIFEST))
    plain = lambda c: F.regexp_replace(c, "^[a-z]+:/+", "/")  # noqa: E731 - the two sources write the scheme differently
    held = spark.read.parquet(lake).groupBy(plain(F.col("_metadata.file_path")).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return (files.withColumn("name", plain(F.col("path"))).join(held, on="name", how="left")
            .groupBy(F.regexp_extract("path", r"base_topic=([^/]+)", 1).alias("base_topic"),
                     F.to_date(F.regexp_extract("path", r"log_date=([0-9-]+)", 1)).alias("log_date"))
            .agg(F.sum("n").alias("n_rows")))


@query("lake_reset")
def lake_reset(spark, root):
    """A lake reset by an overwrite holds the rows written last, and so does its manifest."""
    lake = _write_sample_lake(spark, root, "lake_reset")
    msgs = M.standard_columns(S.message_envelopes(spark, root), payload_cols=["ordinal", "value"])
    LK.write_lake(spark, msgs.where(F.col("base_topic") == "click"), lake, mode="overwrite")
    rows = LK.read_lake(spark, lake).groupBy("base_topic", "mcap_id").agg(F.count(F.lit(1)).alias("n_rows"))
    listed = LK.read_manifest(spark, lake, LK.FANOUT_MANIFEST).groupBy("base_topic", "mcap_id").agg(F.count(F.lit(1)).alias("n_days"))
    return rows.join(listed, on=["base_topic", "mcap_id"], how="full")


@query("topic_table_sql")
def topic_table_sql(spark, root):
    """A topic table created with ``CREATE TABLE IF NOT EXISTS`` and queried with SQL."""
    table = new_output_dir(spark, "topic_table_sql")
    msgs = M.standard_columns(S.message_envelopes(spark, root), payload_cols=["ordinal", "value"])
    LK.write_topic_table(spark, msgs.where(F.col("base_topic") == "click").drop("base_topic"), table)
    name = "click_" + os.path.basename(table).rsplit("-", 1)[-1]
    LK.register_topic_table(spark, name, table)
    LK.register_topic_table(spark, name, table)      # does nothing the second time
    return spark.sql(f"SELECT log_date, count(*) AS n_rows, min(ordinal) AS first_ordinal FROM {name} GROUP BY log_date")


@query("catalog_tables")
def catalog_tables(spark, root):
    """Register the driver tables and the curated views; list them with row counts."""
    from ..operators import curated as CU
    TB.register_tables(spark, root)
    S.vehicle_status(spark, root).createOrReplaceTempView("vehicle_status")
    S.logged_messages(spark, root).createOrReplaceTempView("logged_messages")
    S.battery_status(spark, root).createOrReplaceTempView("battery_status")
    CU.register_curated_views(spark)
    return TB.catalog_tables(spark, names=[*TB.DRIVER_TABLES, "vehicle_status", "logged_messages", "battery_status",
                                           "error_counts", "flights", "battery"])


#: About so many records are in one array file of the catalog.
ARRAY_RECORDS = 10_000


@query("catalog_json_array")
def catalog_json_array(spark, root):
    """The service's catalog form, one JSON array of bounded size a file, read back."""
    cat = S.log_catalog(spark, root)
    parts = -(-cat.count() // ARRAY_RECORDS)
    record = F.to_json(F.struct(*C.CATALOG_COLUMNS))
    files = new_output_dir(spark, "catalog_json_array")
    (cat.groupBy(F.pmod(F.xxhash64("ordinal"), F.lit(max(1, parts))).alias("part"))
     .agg(F.concat(F.lit("["), F.array_join(F.collect_list(record), ",\n"), F.lit("]")).alias("value"))
     .write.partitionBy("part").text(files))
    read = MS.read_log_catalog(spark, files, schema=C.CATALOG_JSON_SCHEMA)
    return read.select("log_id", "log_date", "mav_type", "source")


@query("catalog_json")
def catalog_json(spark, root):
    """Catalog records written as JSON and read back (dates parsed, nulls omitted)."""
    path = new_output_dir(spark, "catalog_json")
    MS.write_log_catalog(S.log_catalog(spark, root), path)
    cat = MS.read_log_catalog(spark, path, schema=C.CATALOG_JSON_SCHEMA + ", ordinal bigint", multi_line=False)
    return cat.select(*C.CATALOG_COLUMNS, "ordinal")


# ---------------------------------------------------------------- dashboard series, states, run stats
from ..operators import series as SE, stats as ST  # noqa: E402


@query("state_transitions")
def state_transitions(spark, root):
    """State segments of navigation, arming and failsafe state per flight."""
    return SE.state_transitions(S.vehicle_status(spark, root))


@query("series_xy_height")
def series_xy_height(spark, root):
    """X-Y position and height series of instance 0."""
    pos = S.position_full(spark, root)
    return SE.xy_series(pos).join(SE.height_series(pos), on=["mcap_id", "log_time"], how="inner")


@query("series_xy")
def series_xy(spark, root):
    """X-Y position series of instance 0."""
    return SE.xy_series(S.position_full(spark, root))


@query("series_height")
def series_height(spark, root):
    """Height series of instance 0."""
    return SE.height_series(S.position_full(spark, root))


@query("series_velocity")
def series_velocity(spark, root):
    """Directional velocity series of instance 0 (as the dashboard defines them)."""
    return SE.velocity_series(S.position_full(spark, root))


@query("series_battery")
def series_battery(spark, root):
    """Battery voltage, remaining, current and low-voltage line of instance 0."""
    return SE.battery_series(S.battery_samples(spark, root))


def _rounded(df, cols, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("run_stats")
def run_stats(spark, root):
    """Ingest run statistics per batch: counts, sums, MB/s rates, size ratio."""
    st = ST.ingest_stats(S.run_log(spark, root), by=["batch"])
    return _rounded(st, ["transform_mb_s", "read_mb_s", "write_mb_s", "ratio", "wall_seconds"])


@query("convert_stats")
def convert_stats(spark, root):
    """Conversion statistics per batch over converted files only."""
    st = ST.conversion_stats(S.run_log(spark, root), by=["batch"])
    return _rounded(st, ["transform_mb_s", "ratio"])


@query("run_outcomes")
def run_outcomes(spark, root):
    """Files per outcome."""
    return ST.outcome_counts(S.run_log(spark, root))


@query("flights_sample")
def flights_sample(spark, root):
    """``SELECT * FROM flights LIMIT 5`` with a total order (earliest starts first)."""
    return curated.flights(S.vehicle_status(spark, root), S.logged_messages(spark, root)) \
        .orderBy("start_time", "mcap_id").limit(5)


@query("lake_flights")
def lake_flights(spark, root):
    """End to end: envelopes -> topic tables -> registered tables -> curated ``flights`` SQL view."""
    from ..operators.ingest import ingest_envelopes
    lake = new_output_dir(spark, "lake_flights")
    ingest_envelopes(spark, S.telemetry_envelopes(spark, root), S.TELEMETRY_SCHEMAS, lake)
    TB.open_lake(spark, lake)
    return spark.sql("SELECT * FROM flights")


@query("stream_lake_flights")
def stream_lake_flights(spark, root):
    """Envelope files ingested by a Structured Streaming query (foreachBatch), then ``flights``."""
    from ..streaming.ingest import ingest_stream
    env_dir, lake = new_output_dir(spark, "stream_envelopes"), new_output_dir(spark, "stream_lake")
    S.telemetry_envelopes(spark, root).write.parquet(env_dir)
    q = ingest_stream(spark, env_dir, spark.read.parquet(env_dir).schema, lake, S.TELEMETRY_SCHEMAS,
                      name=os.path.basename(lake))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"ingest stream failed: {q.exception()}")
    TB.open_lake(spark, lake)
    return spark.sql("SELECT * FROM flights")


@query("ingest_replay")
def ingest_replay(spark, root):
    """A topic whose manifest rows were lost after its data were written, ingested again, counts once."""
    from ..operators.ingest import ingest_envelopes
    from ..session import remove_dir
    lake = new_output_dir(spark, "ingest_replay")
    env = S.telemetry_envelopes(spark, root)
    ingest_envelopes(spark, env, S.TELEMETRY_SCHEMAS, lake)
    remove_dir(spark, f"{lake}/vehicle_status/{LK.MANIFEST}")
    ingest_envelopes(spark, env, S.TELEMETRY_SCHEMAS, lake, on_existing="skip")
    TB.open_lake(spark, lake)
    return spark.sql("SELECT * FROM flights")


@query("ingest_split_flight")
def ingest_split_flight(spark, root):
    """Flights spread over several files that arrive in several micro-batches; every row is counted."""
    from ..streaming.ingest import ingest_stream
    env_dir, lake = new_output_dir(spark, "split_envelopes"), new_output_dir(spark, "split_lake")
    S.telemetry_envelopes(spark, root).repartition(4, "log_time_ns").write.parquet(env_dir)
    q = ingest_stream(spark, env_dir, spark.read.parquet(env_dir).schema, lake, S.TELEMETRY_SCHEMAS,
                      name=os.path.basename(lake), max_files_per_trigger=2)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"ingest stream failed: {q.exception()}")
    TB.open_lake(spark, lake)
    return spark.sql("SELECT * FROM flights")


@query("ingest_two_firmwares")
def ingest_two_firmwares(spark, root):
    """Two descriptors of a topic in one batch: a type conflict, and NULL where a flight's firmware lacks the field."""
    from ..operators.ingest import ingest_envelopes
    lake = new_output_dir(spark, "ingest_two_firmwares")
    ingest_envelopes(spark, S.firmware_envelopes(spark, root), S.FIRMWARE_SCHEMAS, lake)
    return LK.read_topic_table(spark, f"{lake}/vehicle_status").select(
        "mcap_id", "log_time", "arming_state", "nav_state", "nav_state__as_f64", "failsafe")


@query("ingest_new_checkpoint")
def ingest_new_checkpoint(spark, root):
    """Files ingested by a stream, more files ingested by a stream with a fresh checkpoint, then the first stream again: all rows once."""
    from ..streaming.ingest import ingest_stream
    env_dir, lake = new_output_dir(spark, "checkpoint_envelopes"), new_output_dir(spark, "checkpoint_lake")
    env = S.telemetry_envelopes(spark, root)
    late = F.col("log_date") >= F.lit(S.FIRMWARE_SWITCH[:10]).cast("date")
    env.where(~late).write.parquet(env_dir)
    for k, name in enumerate(("first", "fresh", "first")):
        if k == 1:
            env.where(late).write.mode("append").parquet(env_dir)
        q = ingest_stream(spark, env_dir, env.schema, lake, S.TELEMETRY_SCHEMAS, name=f"{os.path.basename(lake)}-{name}")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"ingest stream failed: {q.exception()}")
    TB.open_lake(spark, lake)
    return spark.sql("SELECT * FROM flights")


@query("flights_folded")
def flights_folded(spark, root):
    """``flights`` folded from the partial aggregates of three batches over which every flight is spread, one of them run twice."""
    from ..operators.ingest import ingest_envelopes
    lake = new_output_dir(spark, "flights_folded")
    env = S.in_parts(S.telemetry_envelopes(spark, root), "log_time_ns")
    for k in (0, 1, 2, 1):
        ingest_envelopes(spark, env.where(F.col("part") == k), S.TELEMETRY_SCHEMAS, lake, batch_id=f"part-{k}", partials=True)
    TB.open_lake(spark, lake, folded=True)
    return spark.sql("SELECT * FROM flights")


def _written_in_parts(spark, rows, lake, partial):
    """A topic table written in three batches, the first without partials, the second twice."""
    for k, kept in ((0, ()), (1, (partial,)), (2, (partial,)), (1, (partial,))):
        LK.write_topic_table(spark, rows.where(F.col("part") == k).drop("part"), f"{lake}/{partial.topic}", batch_id=f"part-{k}", partials=kept)


@query("battery_folded")
def battery_folded(spark, root):
    """``battery`` folded from partial aggregates; a batch that has none is read from its rows."""
    from ..operators import partials as PA
    lake = new_output_dir(spark, "battery_folded")
    rows = S.battery_status(spark, root).withColumns({
        "log_date": F.date_add(F.lit("2024-01-01").cast("date"), F.col("multi_id")), "publish_time": F.col("voltage_v")})
    _written_in_parts(spark, S.in_parts(rows, "voltage_v"), lake, PA.BATTERY_RANGES)
    return PA.battery(spark, lake)


@query("max_altitude_folded")
def max_altitude_folded(spark, root):
    """``max_altitude`` folded from partial aggregates, those of the first batch added later."""
    from ..operators import partials as PA
    lake = new_output_dir(spark, "max_altitude_folded")
    rows = S.local_position(spark, root).withColumns({"log_date": F.col("log_time").cast("date"), "publish_time": F.col("log_time")})
    _written_in_parts(spark, S.in_parts(rows, "log_time"), lake, PA.ALTITUDE)
    PA.add_partials(spark, f"{lake}/{PA.ALTITUDE.topic}", PA.ALTITUDE)
    return PA.max_altitude(spark, lake)


@query("ingest_ten_descriptors")
def ingest_ten_descriptors(spark, root):
    """Ten descriptors of a topic in one batch, decoded in one pass: a type conflict, and a field of each descriptor's own."""
    from ..operators.ingest import ingest_envelopes
    lake = new_output_dir(spark, "ingest_ten_descriptors")
    env, schemas = S.ten_descriptors(spark, root)
    ingest_envelopes(spark, env, schemas, lake)
    own = F.coalesce(*[F.col(f"own_{i}") for i in range(10)])
    n_own = sum(F.col(f"own_{i}").isNotNull().cast("int") for i in range(10))
    return LK.read_topic_table(spark, f"{lake}/vehicle_status").select(
        "mcap_id", "log_time", "arming_state", "nav_state", "nav_state__as_f64", own.alias("own"), n_own.alias("n_own"))


@query("ingest_run_stats")
def ingest_run_stats(spark, root):
    """The run table of a real ingest of files in two batches against the listing of the lake and the rows in it."""
    from ..operators.ingest import ingest_envelopes
    env_dir, lake = new_output_dir(spark, "run_envelopes"), new_output_dir(spark, "run_lake")
    env = S.telemetry_envelopes(spark, root)
    late = F.col("log_date") >= F.lit(S.FIRMWARE_SWITCH[:10]).cast("date")
    in_bytes = 0
    for part, some in (("a", ~late), ("b", late)):
        env.where(some).repartition(2, "log_date").write.parquet(f"{env_dir}/{part}")
        in_bytes += LK.written_files(spark, f"{env_dir}/{part}")[1]
        ingest_envelopes(spark, MS.read_envelopes(spark, f"{env_dir}/{part}"), S.TELEMETRY_SCHEMAS, lake)
    files = FS.list_files(spark, lake, ".parquet").withColumn("base_topic", F.regexp_extract("path", r"/([^/]+)/batch_id=[^/]+/log_date=", 1))
    listed = files.where("base_topic <> ''").groupBy("base_topic").agg(F.sum("length").alias("listed"), F.count(F.lit(1)).alias("listed_files"))
    runs = LK.read_runs(spark, lake).withColumn("outcome", F.lit("converted"))
    per_batch = runs.groupBy("batch_id").agg(F.max("in_bytes").alias("b")).agg(F.sum("b").alias("batch_bytes"))
    stats = ST.conversion_stats(runs, by=["base_topic"]).select("base_topic", "n_converted", "out_bytes", (F.col("transform_mb_s") > 0).alias("timed"))
    rows = runs.groupBy("base_topic").agg(F.sum("rows_written").alias("rows_written"), F.sum("out_files").alias("out_files"), F.sum("rows_in").alias("rows_in"))
    got = stats.join(rows, "base_topic").join(listed, "base_topic").withColumn("batch_bytes", F.lit(per_batch.first()["batch_bytes"]))
    return got.select("base_topic", F.col("n_converted").alias("n_batches"), "rows_written", "rows_in", (F.col("out_bytes") == F.col("listed")).alias("bytes_agree"),
                      (F.col("out_files") == F.col("listed_files")).alias("files_agree"), (F.col("batch_bytes") == F.lit(in_bytes)).alias("input_agrees"), "timed")


@query("file_order")
def file_order(spark, root):
    """Rows of equal publish times lie in the written files in the order of the files they came from."""
    from ..operators.ingest import ingest_envelopes
    lake = new_output_dir(spark, "file_order")
    env = S.ordered_files(spark, root, new_output_dir(spark, "ordered_files"))
    ingest_envelopes(spark, env, {"vehicle_status": "event bigint"}, lake)
    rows = spark.read.parquet(f"{lake}/vehicle_status/batch_id=*/log_date=*/*.parquet").select(
        "event", "publish_time", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    before = Window.partitionBy("file").orderBy("place")
    return rows.select("event", "publish_time", F.when(F.lag("publish_time").over(before) == F.col("publish_time"),
                                                       F.lag("event").over(before)).alias("event_before"))


@query("u64_wrap")
def u64_wrap(spark, root):
    """Unsigned 64-bit payload fields, single and in arrays, around 2^63 and 2^64 as table values."""
    from pyspark.sql import types as T
    from ..functions.types import variant_value, widen
    od = S._t(spark, root, "orders")
    big = lambda n, k: (F.lit(n).cast("decimal(20,0)") + F.col("o_orderkey") % k).cast("decimal(20,0)")
    rows = od.select("o_orderkey", F.to_json(F.struct(big(Decimal(2 ** 63 - 2), 4).alias("counter"), F.array(
        F.lit(Decimal(0)).cast("decimal(20,0)"), big(Decimal(2 ** 64 - 3), 3)).alias("marks"), F.col("o_orderkey").alias("plain"))).alias("payload"))
    fields = MS.parse_fields(F.col("payload"))
    u64 = T.DecimalType(20, 0)
    value = lambda name, kind: widen(variant_value(F.try_element_at("f", F.lit(name)), kind), kind)
    got = rows.select("o_orderkey", fields.alias("f")).select("o_orderkey", value("counter", u64).alias("counter"),
                                                              value("marks", T.ArrayType(u64)).alias("m"), value("plain", T.LongType()).alias("plain"))
    return got.select("o_orderkey", "counter", F.col("m")[0].alias("mark_0"), F.col("m")[1].alias("mark_1"), "plain")


#: Points of a segment in the registered polyline, few enough that the given flights have several.
POLYLINE_POINTS = 50


@query("trajectory_polyline")
def trajectory_polyline(spark, root):
    """Each flight's line as segments of bounded size, taken apart again: segments in order give the line."""
    lines = TJ.polyline(S.position_samples(spark, root), POLYLINE_POINTS)
    return lines.select("mcap_id", "segment", "first_ts", "n_points", F.posexplode("points").alias("place", "p")).select(
        "mcap_id", "segment", "first_ts", "n_points", (F.col("segment") * POLYLINE_POINTS + F.col("place") + 1).alias("point_idx"), "p.x", "p.y", "p.z")


@query("convert_flight")
def convert_flight(spark, root):
    """Raw logs to ordered messages: field lists and columnar samples packed by definition, merged with the other four streams, written, read back."""
    from ..operators import convert as CV
    pages, tagged, parameters, positions = S.converted_streams(spark, root)
    messages = CV.convert(S.converted_fields(spark, root), S.converted_samples(spark, root), pages, tagged, parameters, positions, segment=POLYLINE_POINTS)
    return CV.write_messages(spark, messages, new_output_dir(spark, "convert_flight")).select("mcap_id", "seq", "ts_us", "topic", "stream", "payload")


@query("catalog_describe")
def catalog_describe(spark, root):
    """Columns and types of the topic tables and curated views of an ingested lake, as ``DESCRIBE`` gives them."""
    from ..operators.ingest import ingest_envelopes
    lake = new_output_dir(spark, "catalog_describe")
    ingest_envelopes(spark, S.telemetry_envelopes(spark, root), S.TELEMETRY_SCHEMAS, lake)
    TB.open_lake(spark, lake)
    out = None
    for name in ("vehicle_status", "logged_messages", "error_counts", "flights"):
        part = TB.describe(spark, name).select(F.lit(name).alias("name"), "col_name", "data_type")
        out = part if out is None else out.unionByName(part)
    return out


@query("lake_metadata")
def lake_metadata(spark, root):
    """The three metadata maps of each flight, stored with it in one batch (the same batch again adds nothing) and read back from the lake by SQL."""
    from ..operators.ingest import ingest_envelopes
    lake = new_output_dir(spark, "lake_metadata")
    rows = S.named_metadata_rows(spark, root).withColumnRenamed("ordinal", "row_index").withColumns(
        {"log_date": F.lit("2024-01-05").cast("date"), "source": F.concat(F.lit("/logs/"), F.col("mcap_id")), "stamp": F.lit("1")})
    env = S.telemetry_envelopes(spark, root).where("log_date < '2024-01-03'")
    for _ in range(2):
        ingest_envelopes(spark, env, S.TELEMETRY_SCHEMAS, lake, on_existing="skip", batch_id="flights-1", metadata=rows)
    TB.open_lake(spark, lake)
    return spark.sql(" UNION ALL ".join(f"SELECT mcap_id, '{n}' AS name, explode({n}) AS (key, value) FROM {LK.FLIGHT_METADATA}" for n in LG.METADATA_NAMES))
