"""Stand-in inputs: driver tables reshaped into the telemetry schemas the operators take.

These functions only rename, cast and derive columns so the driver tables have the
schema a job expects; none of them does any of the job's work.  Every job is correct on
any data of that schema.

Roles (see SURVEY §7.3): ``events.user_id`` + day -> flight, ``events.ts`` -> log time,
``events.event_type`` -> topic / level, ``events.event_id`` -> ordinal,
``events.props`` -> payload, ``orders`` -> log catalog, ``lineitem`` -> battery samples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import read_table


def _t(spark: SparkSession, root: str, name: str, spread: bool = False) -> DataFrame:
    return read_table(spark, root, name, spread_to=spark.sparkContext.defaultParallelism if spread else None)


def flight_id() -> F.Column:
    """``{log_date}-{id}`` flight id, shaped like the log file naming."""
    return F.concat(F.col("ts").cast("date").cast("string"), F.lit("-"), F.col("user_id").cast("string"))


def vehicle_status(spark, root) -> DataFrame:
    """``vehicle_status(mcap_id, log_date, log_time, multi_id, arming_state, nav_state, failsafe)``."""
    ev = _t(spark, root, "events").where(F.col("event_type").isin("click", "purchase", "signup"))
    return ev.select(
        flight_id().alias("mcap_id"),
        F.col("ts").cast("date").alias("log_date"),
        F.col("ts").alias("log_time"),
        F.lit(0).alias("multi_id"),
        F.when(F.col("event_type") == "purchase", F.lit(2)).otherwise(F.lit(1)).cast("bigint").alias("arming_state"),
        (F.floor(F.col("value")) % 7).cast("bigint").alias("nav_state"),
        (F.col("event_type") == "signup").alias("failsafe"),
        F.col("event_id").alias("ordinal"))


def logged_messages(spark, root) -> DataFrame:
    """``logged_messages(mcap_id, log_date, log_time, level, message)``."""
    ev = _t(spark, root, "events").where(F.col("event_type").isin("error", "view"))
    return ev.select(
        flight_id().alias("mcap_id"),
        F.col("ts").cast("date").alias("log_date"),
        F.col("ts").alias("log_time"),
        F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO")).alias("level"),
        F.col("props").alias("message"))


def battery_status(spark, root) -> DataFrame:
    """``battery_status(mcap_id, multi_id, cell_count, voltage_v, current_a, remaining, temperature)``."""
    li = _t(spark, root, "lineitem")
    return li.select(
        F.concat(F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus")).alias("mcap_id"),
        F.col("l_linenumber").cast("int").alias("multi_id"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("cell_count"),
        (F.col("l_extendedprice") / 1000).alias("voltage_v"),
        F.col("l_quantity").alias("current_a"),
        F.col("l_discount").alias("remaining"),
        (F.col("l_tax") * 1000).alias("temperature"))


def local_position(spark, root) -> DataFrame:
    """``vehicle_local_position(mcap_id, log_time, multi_id, z)`` with ``z = -value``."""
    ev = _t(spark, root, "events")
    return ev.select(flight_id().alias("mcap_id"), F.col("ts").alias("log_time"),
                     F.lit(0).alias("multi_id"), (-F.col("value")).alias("z"))


def log_catalog(spark, root) -> DataFrame:
    """Log catalog rows (all strings but the date) with an input-order ``ordinal``."""
    o = _t(spark, root, "orders")
    key = F.col("o_orderkey").cast("string")
    return o.select(
        F.concat(F.lit("L-"), key).alias("log_id"),
        F.col("o_orderdate").cast("date").alias("log_date"),
        F.col("o_orderpriority").alias("mav_type"),
        F.col("o_orderstatus").alias("rating"),
        F.when(F.col("o_custkey") % 50 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("veh-"), F.col("o_custkey").cast("string"))).alias("vehicle_uuid"),
        F.concat(F.lit("vehicle-"), F.col("o_custkey").cast("string")).alias("vehicle_name"),
        F.concat(F.lit("airframe-"), F.substring("o_orderpriority", 1, 1)).alias("airframe_name"),
        F.when(F.col("o_totalprice") > 200000, F.lit("quad")).otherwise(F.lit("fixed_wing")).alias("airframe_type"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
         .when(F.col("o_orderpriority").startswith("1"), F.lit("CI"))
         .otherwise(F.lit("webui")).alias("source"),
        F.concat(F.lit("v"), F.year("o_orderdate").cast("string")).alias("ver_sw"),
        F.col("o_orderkey").alias("ordinal"))


def named_metadata_rows(spark, root) -> DataFrame:
    """Metadata rows of a log (a brand) under three names; keys repeat, the last part's value counts."""
    p = _t(spark, root, "part")
    kv = p.select("p_brand", "p_partkey", F.inline(F.array(
        F.struct(F.lit("info").alias("name"), F.lit("type").alias("key"), F.col("p_type").alias("value")),
        F.struct(F.lit("initial_parameters").alias("name"), F.concat(F.lit("SIZE_"), F.col("p_size").cast("string")).alias("key"),
                 F.col("p_name").alias("value")),
        F.struct(F.lit("default_parameters").alias("name"), F.lit("PRICE").alias("key"),
                 F.when(F.col("p_size") > 25, F.col("p_retailprice").cast("string")).alias("value")))))
    return kv.where(F.col("value").isNotNull()).select(F.col("p_brand").alias("mcap_id"), "name", "key", "value",
                                                        F.col("p_partkey").alias("ordinal"))


def held_log_files(spark, root) -> DataFrame:
    """Paths of raw logs already held: ``{log_date}-{log_id}.ulg`` for orders with status F."""
    o = _t(spark, root, "orders").where(F.col("o_orderstatus") == "F")
    return o.select(F.concat(F.lit("/data/raw/"), F.col("o_orderdate").cast("date").cast("string"), F.lit("-L-"),
                             F.col("o_orderkey").cast("string"), F.lit(".ulg")).alias("path"))


def raw_log_keys(spark, root) -> DataFrame:
    """Object keys of every raw log."""
    o = _t(spark, root, "orders")
    return o.select(F.concat(F.lit("raw/"), F.col("o_orderdate").cast("date").cast("string"), F.lit("-L-"),
                             F.col("o_orderkey").cast("string"), F.lit(".ulg")).alias("key"))


def converted_keys(spark, root) -> DataFrame:
    """Object keys of message files already converted (urgent orders)."""
    o = _t(spark, root, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return o.select(F.concat(F.lit("raw/"), F.col("o_orderdate").cast("date").cast("string"), F.lit("-L-"),
                             F.col("o_orderkey").cast("string"), F.lit(".mcap")).alias("dest_key"))


def topic_names(spark, root) -> DataFrame:
    """Channel names of all shapes: u8 suffixes, suffixes above 255, no suffix, empty base."""
    ev = _t(spark, root, "events")
    et, uid, eid = F.col("event_type"), F.col("user_id").cast("string"), F.col("event_id").cast("string")
    topic = (F.when(et.isin("click", "purchase"), F.concat(et, F.lit("_"), uid))
             .when(et == "error", F.concat(F.lit("sensor_"), et, F.lit("_"), eid))
             .when(et == "view", F.concat(et, F.lit("_messages")))
             .otherwise(F.concat(F.lit("_"), uid)))
    return ev.select(F.col("event_id").alias("ordinal"), topic.alias("topic"))


def message_file_paths(spark, root) -> DataFrame:
    """Message-file paths ``bucket/{log_date}-{log_id}.mcap`` (some with a doubled suffix)."""
    o = _t(spark, root, "orders")
    name = F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("-L-"), F.col("o_orderkey").cast("string"))
    suffix = F.when(F.col("o_orderstatus") == "O", F.lit(".mcap.mcap")).otherwise(F.lit(".mcap"))
    return o.select(F.col("o_orderkey").alias("ordinal"), F.concat(F.lit("store://logs/"), name, suffix).alias("path"))


def log_file_stems(spark, root) -> DataFrame:
    """Raw-log file stems, with and without the date prefix."""
    o = _t(spark, root, "orders")
    key = F.concat(F.lit("L-"), F.col("o_orderkey").cast("string"))
    stem = F.when(F.col("o_orderstatus") == "P", key).otherwise(
        F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("-"), key))
    return o.select(F.col("o_orderkey").alias("ordinal"), stem.alias("stem"))


def message_envelopes(spark, root) -> DataFrame:
    """Message envelopes: times in ns relative to the log's midnight, one channel per type."""
    ev = _t(spark, root, "events")
    day = F.col("ts").cast("date")
    rel_us = F.timestamp_diff("MICROSECOND", day.cast("timestamp_ntz"), F.col("ts"))
    return ev.select(
        flight_id().alias("mcap_id"), day.alias("log_date"),
        F.concat(F.col("event_type"), F.lit("_0")).alias("topic"),
        (rel_us * 1000 + 999).alias("log_time_ns"),
        (rel_us * 1000 + 999).alias("publish_time_ns"),
        F.lit(0).cast("bigint").alias("sequence"),
        F.col("event_id").alias("ordinal"),
        F.col("value"))


def sample_micros(spark, root) -> DataFrame:
    """Sample times in µs around an epoch so that negative values occur."""
    ev = _t(spark, root, "events")
    us = F.timestamp_diff("MICROSECOND", F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    return ev.select(F.col("event_id").alias("ordinal"), us.alias("ts_us"))


# The eight source log level names plus one unknown name.
SOURCE_LEVEL_NAMES = ["EMERGENCY", "ALERT", "CRITICAL", "ERROR", "WARNING", "NOTICE", "INFO", "DEBUG", "WEIRD"]


def source_log_levels(spark, root) -> DataFrame:
    """Source log records with a level name taken round-robin from the names above."""
    ev = _t(spark, root, "events")
    names = F.array(*[F.lit(n) for n in SOURCE_LEVEL_NAMES])
    return ev.select(F.col("event_id").alias("ordinal"),
                     F.element_at(names, (F.col("event_id") % len(SOURCE_LEVEL_NAMES) + 1).cast("int")).alias("source_level"))


def conversation_logs(spark, root) -> DataFrame:
    """Tagged log rows: conversation = flight, turn = input order, role = tag."""
    c = _t(spark, root, "conversations")
    role = F.col("role")
    return c.select(
        F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("mcap_id"),
        (F.floor(F.col("turn") / 2) * 1000000).cast("bigint").alias("ts_us"),
        F.col("turn").alias("ordinal"),
        F.when(role == "system", 0).when(role == "user", 1).otherwise(2).alias("tag"),
        F.col("text").alias("message"),
        F.when(role == "system", "NOTICE").when(role == "user", "INFO").otherwise("WARNING").alias("level_name"))


def parameter_rows(spark, root) -> DataFrame:
    """Parameter changes with textual values: part size (integer) and retail price (real)."""
    p = _t(spark, root, "part")
    return p.select(F.col("p_brand").alias("mcap_id"), F.col("p_partkey").alias("timestamp"),
                    F.inline(F.array(
                        F.struct(F.lit("P_SIZE").alias("name"), F.col("p_size").cast("string").alias("value")),
                        F.struct(F.lit("P_PRICE").alias("name"), F.col("p_retailprice").cast("string").alias("value")))))


def metadata_rows(spark, root) -> DataFrame:
    """Per-log metadata key/value rows (a ``ver_sw`` key only where the part size exceeds 25)."""
    p = _t(spark, root, "part")
    kv = p.select("p_partkey", F.inline(F.array(
        F.struct(F.lit("name").alias("key"), F.col("p_name").alias("value")),
        F.struct(F.lit("brand").alias("key"), F.col("p_brand").alias("value")),
        F.struct(F.lit("size").alias("key"), F.col("p_size").cast("string").alias("value")),
        F.struct(F.lit("retailprice").alias("key"), F.col("p_retailprice").cast("string").alias("value")),
        F.struct(F.lit("ver_sw").alias("key"),
                 F.when(F.col("p_size") > 25, F.col("p_type")).alias("value")))))
    return kv.where(F.col("value").isNotNull()).withColumnRenamed("p_partkey", "mcap_id")


def embedding_datasets(spark, root) -> DataFrame:
    """Columnar topic datasets: per vector, a timestamp array and two field arrays."""
    e = _t(spark, root, "embeddings")
    return e.select(
        F.lit("embedding").alias("topic_name"), F.col("label").alias("multi_id"),
        F.transform("embedding", lambda x, i: F.col("vec_id") * 1000 + i).alias("timestamp"),
        F.col("embedding").alias("control[0]"),
        F.transform("embedding", lambda x: -x).alias("control[1]"))


# The twelve source field type names, in their usual order.
SOURCE_TYPES = ["int8_t", "int16_t", "int32_t", "int64_t", "uint8_t", "uint16_t", "uint32_t", "uint64_t",
                "float", "double", "bool", "char"]


def field_rows(spark, root) -> DataFrame:
    """Flat field lists ``(mcap_id, topic, ordinal, field, type)``: an order is a topic, forty orders a log, lines are fields."""
    li = _t(spark, root, "lineitem", spread=True)     # pattern matching per field row follows
    ln = (F.col("l_linenumber") - 1).cast("string")
    types = F.array(*[F.lit(t) for t in SOURCE_TYPES])
    rpm_type = F.element_at(types, (F.col("l_partkey") % 12 + 1).cast("int"))
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    f1 = F.when(rf == "R", F.struct(F.concat(F.lit("name["), ln, F.lit("]")).alias("field"), F.lit("char").alias("type"))) \
          .otherwise(F.struct(F.concat(F.lit("control["), ln, F.lit("]")).alias("field"), F.lit("float").alias("type")))
    f2 = (F.when(ls == "O", F.struct(F.concat(F.lit("esc["), ln, F.lit("].label["), (F.col("l_suppkey") % 3).cast("string"),
                                             F.lit("]")).alias("field"), F.lit("char").alias("type")))
          .when(rf == "A", F.struct(F.concat(F.lit("esc["), ln, F.lit("].current[0]")).alias("field"),
                                    F.lit("float").alias("type")))
          .when(rf == "N", F.struct(F.concat(F.lit("esc["), ln, F.lit("]._padding0[1]")).alias("field"),
                                    F.lit("uint8_t").alias("type")))
          .otherwise(F.struct(F.concat(F.lit("outer["), ln, F.lit("].inner.x")).alias("field"),
                              F.lit("int16_t").alias("type"))))
    f3 = F.when(F.col("l_linenumber") == 1, F.struct(F.lit("timestamp").alias("field"), F.lit("uint64_t").alias("type"))) \
          .otherwise(F.struct(F.concat(F.lit("gps.fix["), ln, F.lit("]")).alias("field"), F.lit("int8_t").alias("type")))
    f0 = F.struct(F.concat(F.lit("esc["), ln, F.lit("].rpm")).alias("field"), rpm_type.alias("type"))
    rows = li.select(F.concat(F.lit("log-"), F.floor(F.col("l_orderkey") / 40).cast("string")).alias("mcap_id"),
                     F.concat(F.lit("order_"), (F.col("l_orderkey") % 40).cast("string")).alias("topic"),
                     "l_linenumber", F.posexplode(F.array(f0, f1, f2, f3)).alias("k", "f"))
    return rows.select("mcap_id", "topic", ((F.col("l_linenumber") - 1) * 10 + F.col("k")).cast("bigint").alias("ordinal"),
                       F.col("f.field").alias("field"), F.col("f.type").alias("type"))


def channels(spark, root) -> DataFrame:
    """Channels ``{type}_{instance}`` of each log (a day) with their type name and first-seen ordinal."""
    ev = _t(spark, root, "events")
    return ev.select(F.concat(F.lit("log-"), F.col("ts").cast("date").cast("string")).alias("mcap_id"), F.concat(F.col("event_type"), F.lit("_"), F.col("user_id").cast("string")).alias("topic"),
                     F.col("event_type").alias("type_name"), F.col("event_id").alias("ordinal"))


def flat_samples(spark, root) -> DataFrame:
    """Wide samples with flat array columns ``m[0..3]`` and a char array ``flag[0..2]``."""
    li = _t(spark, root, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.col("l_quantity").alias("m[0]"), F.col("l_extendedprice").alias("m[1]"),
                     F.col("l_discount").alias("m[2]"), F.col("l_tax").alias("m[3]"),
                     F.ascii("l_returnflag").alias("flag[0]"), F.ascii("l_linestatus").alias("flag[1]"),
                     F.lit(0).alias("flag[2]"))


def struct_array_samples(spark, root) -> DataFrame:
    """Samples with flat struct-array leaves ``esc[i].rpm / esc[i].temp`` and an array<struct>."""
    li = _t(spark, root, "lineitem")
    motors = F.array(F.struct(F.col("l_partkey").alias("id"), F.col("l_suppkey").alias("sid")),
                     F.struct(F.col("l_suppkey").alias("id"), F.col("l_partkey").alias("sid")))
    return li.select("l_orderkey", "l_linenumber",
                     F.col("l_quantity").alias("esc[0].rpm"), F.col("l_linenumber").cast("double").alias("esc[1].rpm"),
                     F.col("l_tax").alias("esc[0].temp"), F.col("l_discount").alias("esc[1].temp"),
                     motors.alias("motors"))


def char_samples(spark, root) -> DataFrame:
    """Whole texts as signed byte arrays followed by a NUL and junk bytes."""
    from ..functions.text import text_to_signed_bytes
    c = _t(spark, root, "conversations", spread=True)  # per-byte work on whole texts follows
    junk = F.array(F.lit(0), F.lit(-120), F.lit(99))
    return c.select("conv_id", "turn", F.concat(text_to_signed_bytes(F.col("text")), junk).alias("chars"))


def char_array_samples(spark, root) -> DataFrame:
    """Texts split into lines; each line a NUL-terminated signed byte array."""
    from ..functions.text import text_to_signed_bytes
    c = _t(spark, root, "conversations", spread=True)  # per-byte work on whole texts follows
    lines = F.split(F.col("text"), "\n", -1)
    return c.select("conv_id", "turn", F.transform(
        lines, lambda l: F.concat(text_to_signed_bytes(l), F.array(F.lit(0), F.lit(-61)))).alias("chars"))


def _components(spark, root, n: int) -> DataFrame:
    """All components of each embedding as rows of ``n`` neighbours ``c`` (null past the end), numbered ``i``."""
    e = _t(spark, root, "embeddings")
    last = F.ceil(F.size("embedding") / F.lit(n)).cast("int") - 1
    rows = e.select("vec_id", "label", "embedding", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    return rows.select("vec_id", "label", "i", F.array(*[F.get("embedding", F.col("i") * n + k).cast("double") for k in range(n)]).alias("c"))


def position_samples(spark, root) -> DataFrame:
    """Local-position samples from embedding components; some NaN coordinates, some instance 1, times out of order."""
    e = _components(spark, root, 3)
    nan = F.lit(float("nan"))
    x = F.when(F.col("vec_id") % 7 == 0, nan).otherwise(F.col("c")[0])
    ordinal = F.col("vec_id") * 1000 + F.col("i")
    return e.select(F.concat(F.lit("flight-"), F.col("label").cast("string")).alias("mcap_id"),
                    F.when(F.col("vec_id") % 5 == 4, 1).otherwise(0).alias("multi_id"),
                    (ordinal * 7919 % 100003 * 1000).alias("timestamp"), ordinal.alias("ordinal"),
                    x.alias("x"), F.col("c")[1].alias("y"), F.col("c")[2].alias("z"))


def merge_inputs(spark, root) -> list[DataFrame]:
    """The five streams of each flight, in their order: topic samples (events), untagged logs (pages), tagged logs
    (conversations), parameter changes (orders), trajectory (embeddings)."""
    ev = _t(spark, root, "events")
    topics = ev.select(F.concat(F.lit("f"), F.col("user_id").cast("string")).alias("mcap_id"),
                       F.concat(F.col("event_type"), F.lit("_0")).alias("topic"),
                       F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                        F.col("ts")).alias("ts_us"),
                       F.col("event_id").alias("row_ord"), F.col("props").alias("payload"))
    cv = _t(spark, root, "conversations")
    logs = cv.select(F.concat(F.lit("f"), F.col("conv_id").cast("string")).alias("mcap_id"),
                     F.lit("logged_messages").alias("topic"), (F.col("turn") * 1000000).alias("ts_us"),
                     F.col("turn").alias("row_ord"), F.col("text").alias("payload"))
    od = _t(spark, root, "orders")
    params = od.select(F.concat(F.lit("f"), F.col("o_custkey").cast("string")).alias("mcap_id"),
                       F.lit("parameter_changes").alias("topic"),
                       F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                        F.col("o_orderdate")).alias("ts_us"),
                       F.col("o_orderkey").alias("row_ord"), F.col("o_orderpriority").alias("payload"))
    pg = _t(spark, root, "pages")
    untagged = pg.select(F.concat(F.lit("f"), (F.col("page_id") % 500).cast("string")).alias("mcap_id"),
                         F.lit("log").alias("topic"), (F.col("page_id") * 1000).alias("ts_us"),
                         F.col("page_id").alias("row_ord"), F.col("url").alias("payload"))
    em = _t(spark, root, "embeddings")
    trajectory = em.groupBy(F.concat(F.lit("f"), F.col("label").cast("string")).alias("mcap_id")).agg(
        F.min(F.col("vec_id") * 1000).alias("ts_us"), F.count(F.lit(1)).cast("string").alias("payload")).select(
        "mcap_id", F.lit("trajectory").alias("topic"), "ts_us", F.lit(0).cast("bigint").alias("row_ord"), "payload")
    return [topics, untagged, logs, params, trajectory]


FIRMWARE_SWITCH = "2024-01-16 00:00:00"   # stand-in: payload schema changes from this time on


def schema_batches(spark, root, conflict: bool) -> list[tuple[str, DataFrame]]:
    """Two payload schema versions of one topic, split at a firmware switch time.

    Without ``conflict`` the later version only adds a field ``k``; with it, ``k`` changes
    from an integer to text, ``value`` narrows to float and an int field ``extra`` appears.
    """
    ev = _t(spark, root, "events")
    switch = F.lit(FIRMWARE_SWITCH).cast("timestamp_ntz")
    base = [flight_id().alias("mcap_id"), F.col("ts").alias("log_time"), F.col("event_id").alias("ordinal")]
    k_text = F.get_json_object("props", "$.k")
    early = ev.where(F.col("ts") < switch)
    late = ev.where(F.col("ts") >= switch)
    if not conflict:
        a = early.select(*base, F.col("value"))
        b = late.select(*base, F.col("value"), k_text.cast("bigint").alias("k"))
    else:
        a = early.select(*base, k_text.cast("bigint").alias("k"), F.col("value"))
        b = late.select(*base, F.col("value").cast("float").alias("value"), k_text.alias("k"),
                        F.col("user_id").cast("int").alias("extra"))
    return [("2024-01-01-fw1.mcap", a), ("2024-01-16-fw2.mcap", b)]


def nested_payloads(spark, root) -> DataFrame:
    """Payload rows with map, struct and array-of-struct fields next to supported ones."""
    ev = _t(spark, root, "events")
    return ev.select("event_id", "value",
                     F.from_json("props", "map<string,bigint>").alias("props_map"),
                     F.struct("value", "user_id").alias("point"),
                     F.array(F.col("event_type")).alias("tags"),
                     F.array(F.struct("value")).alias("points"))


def channel_messages(spark, root) -> DataFrame:
    """Messages with channel names ``{type}_{user}`` and their descriptor name."""
    ev = _t(spark, root, "events")
    return ev.select(flight_id().alias("mcap_id"),
                     F.concat(F.col("event_type"), F.lit("_"), F.col("user_id").cast("string")).alias("topic"),
                     F.col("event_type").alias("schema_name"))


def position_full(spark, root) -> DataFrame:
    """Local position with velocities from embedding components (instance 1 on some rows)."""
    e = _components(spark, root, 6)
    names = ("x", "y", "z", "vx", "vy", "vz")
    return e.select(F.concat(F.lit("flight-"), F.col("label").cast("string")).alias("mcap_id"),
                    F.when(F.col("vec_id") % 5 == 4, 1).otherwise(0).alias("multi_id"),
                    F.timestamp_add("SECOND", F.col("vec_id") * 1000 + F.col("i"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
                    .alias("log_time"), *[F.col("c")[k].alias(n) for k, n in enumerate(names)])


def battery_samples(spark, root) -> DataFrame:
    """Battery samples per order (instance = line number - 1) at the ship date."""
    li = _t(spark, root, "lineitem")
    return li.select(F.concat(F.lit("order-"), F.col("l_orderkey").cast("string")).alias("mcap_id"),
                     (F.col("l_linenumber") - 1).alias("multi_id"), F.col("l_shipdate").alias("log_time"),
                     (F.col("l_extendedprice") / 1000).alias("voltage_v"), F.col("l_discount").alias("remaining"),
                     F.col("l_quantity").alias("current_a"),
                     F.round(F.col("l_tax") * 100).cast("bigint").alias("cell_count"))


def run_log(spark, root) -> DataFrame:
    """Per-file run-log rows: byte counts and phase seconds (zero seconds occur)."""
    li = _t(spark, root, "lineitem")
    return li.select(F.col("l_returnflag").alias("batch"),
                     F.when(F.col("l_linestatus") == "O", "skipped").otherwise("converted").alias("outcome"),
                     F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("in_bytes"),
                     F.round(F.col("l_quantity") * 1000).cast("bigint").alias("out_bytes"),
                     F.col("l_tax").alias("read_seconds"), F.col("l_discount").alias("transform_seconds"),
                     F.col("l_tax").alias("write_seconds"))


# Payload schemas of the two stand-in topics (a message definition each).
TELEMETRY_SCHEMAS = {
    "vehicle_status": "arming_state int, nav_state int, failsafe boolean",
    "logged_messages": "level string, message string",
}


def telemetry_envelopes(spark, root) -> DataFrame:
    """Message envelopes with JSON payloads: vehicle status from click/purchase/signup events,
    log messages from error/view events; times in ns after the log's midnight."""
    ev = _t(spark, root, "events")
    day = F.col("ts").cast("date")
    ns = F.timestamp_diff("MICROSECOND", day.cast("timestamp_ntz"), F.col("ts")) * 1000
    status = F.col("event_type").isin("click", "purchase", "signup")
    payload = F.when(status, F.to_json(F.struct(
        F.when(F.col("event_type") == "purchase", 2).otherwise(1).alias("arming_state"),
        (F.floor(F.col("value")) % 7).cast("int").alias("nav_state"),
        (F.col("event_type") == "signup").alias("failsafe")))).otherwise(F.to_json(F.struct(
            F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
            F.col("props").alias("message"))))
    return ev.select(flight_id().alias("mcap_id"), day.alias("log_date"),
                     F.when(status, F.lit("vehicle_status_0")).otherwise(F.lit("logged_messages")).alias("topic"),
                     ns.alias("log_time_ns"), ns.alias("publish_time_ns"), F.lit(0).cast("bigint").alias("sequence"),
                     F.when(status, F.lit("vehicle_status")).otherwise(F.lit("Log")).alias("schema_name"),
                     payload.alias("payload"))


def in_parts(rows: DataFrame, by: str, n: int = 3) -> DataFrame:
    """Rows dealt to ``n`` parts by the hash of a column, each flight's rows of a part as from a file of their own."""
    part = F.pmod(F.xxhash64(by), F.lit(n)).cast("int")
    return rows.withColumn("part", part).withColumn("source", F.concat_ws("#", "mcap_id", "part"))


# Payload schemas of the status message by firmware (its descriptor).
FIRMWARE_SCHEMAS = {"vehicle_status": {"StatusV1": "arming_state int, nav_state int",
                                       "StatusV2": "arming_state int, nav_state double, failsafe boolean"}}


def firmware_envelopes(spark, root) -> DataFrame:
    """Status envelopes whose descriptor, and with it the payload's fields, changes at ``FIRMWARE_SWITCH``."""
    env = telemetry_envelopes(spark, root).where(F.col("topic") == "vehicle_status_0")
    new = F.col("log_date") >= F.lit(FIRMWARE_SWITCH[:10]).cast("date")
    was = F.from_json("payload", "arming_state int, nav_state int, failsafe boolean")
    v1 = F.to_json(F.struct(was["arming_state"].alias("arming_state"), was["nav_state"].alias("nav_state")))
    v2 = F.to_json(F.struct(was["arming_state"].alias("arming_state"), (was["nav_state"] + F.lit(0.5)).cast("double").alias("nav_state"),
                            was["failsafe"].alias("failsafe")))
    return env.withColumns({"payload": F.when(new, v2).otherwise(v1),
                            "schema_name": F.when(new, F.lit("StatusV2")).otherwise(F.lit("StatusV1"))})


# The field list of the motor topic.
MOTOR_FIELDS = [("time", "uint64_t"), ("motor[0].tag[0]", "char"), ("motor[0].tag[1]", "char"), ("motor[0].volt", "float"),
                ("motor[0].raw[0]", "float"), ("motor[1].tag[0]", "char"), ("motor[1].tag[1]", "char"), ("motor[1].volt", "float"),
                ("mix[0]", "float"), ("mix[1]", "float"), ("unit[0]", "char"), ("unit[1]", "char"), ("rig[0].arm.len", "float")]


def motor_samples(spark, root) -> DataFrame:
    """Samples of the motor topic in flat columns, with the order and line they stand for."""
    li = _t(spark, root, "lineitem")
    flag, status = F.ascii("l_returnflag"), F.ascii("l_linestatus")
    return li.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("time"), flag.alias("motor[0].tag[0]"),
                     status.alias("motor[0].tag[1]"), F.col("l_quantity").alias("motor[0].volt"), F.col("l_tax").alias("motor[0].raw[0]"),
                     status.alias("motor[1].tag[0]"), F.lit(0).alias("motor[1].tag[1]"), F.col("l_tax").alias("motor[1].volt"),
                     F.col("l_discount").alias("mix[0]"), F.col("l_quantity").alias("mix[1]"), flag.alias("unit[0]"),
                     flag.alias("unit[1]"), F.col("l_tax").alias("rig[0].arm.len"))


# ---------------------------------------------------------------- whole conversion, origin of rows

def _flight_of(c) -> F.Column:
    """One of ten flights, by a number."""
    return F.concat(F.lit("flight-"), (F.col(c) % 10).cast("string"))


# The field lists of the converted topics; flights with an odd number have the later firmware.
CONVERTED_FIELDS = {
    "motor": [("timestamp", "uint64_t"), *MOTOR_FIELDS[1:]],
    "status": [("timestamp", "uint64_t"), ("nav_state", "uint8_t"), ("load", "float")],
    "status_later": [("timestamp", "uint64_t"), ("nav_state", "uint8_t"), ("load", "float"), ("counter", "uint64_t")],
}


def converted_fields(spark, root) -> DataFrame:
    """Field lists of the topic types of every flight that has samples."""
    flights = _t(spark, root, "lineitem").select(_flight_of("l_orderkey").alias("mcap_id")).union(
        _t(spark, root, "events").select(_flight_of("user_id"))).distinct()
    rows = [(name, i, f, t) for name, fields in CONVERTED_FIELDS.items() for i, (f, t) in enumerate(fields)]
    lists = spark.createDataFrame(rows, "list string, ordinal bigint, field string, type string")
    later = F.col("mcap_id").rlike("[13579]$")
    held = flights.withColumn("list", F.explode(F.array(F.lit("motor"), F.when(later, F.lit("status_later")).otherwise(F.lit("status")))))
    return held.join(F.broadcast(lists), "list").select("mcap_id", F.regexp_replace("list", "_later$", "").alias("topic"), "ordinal", "field", "type")


def converted_samples(spark, root) -> DataFrame:
    """Columnar parts: an order's lines are a part of the motor dataset of its flight, an event is one of the status dataset."""
    li = motor_samples(spark, root)
    names = [f for f, _ in CONVERTED_FIELDS["motor"][1:]]
    line = F.struct("l_linenumber", "time", F.col("`motor[0].volt`").alias("volt"), F.col("`mix[0]`").alias("mix"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ts"), *[F.col(f"`{n}`").cast("string").alias(n) for n in names])
    parts = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))  # an order has a few lines
    values = lambda n: F.transform("lines", lambda x: x[n])
    motor = parts.select(_flight_of("l_orderkey").alias("mcap_id"), F.lit("motor").alias("topic_name"),
                         F.floor(F.col("l_orderkey") / 10 % 2).cast("int").alias("multi_id"), F.lit(1).alias("topic_ord"),
                         (F.col("l_orderkey") * 10).alias("first"), F.transform("lines", lambda x: x["ts"]).alias("timestamp"),
                         F.create_map(*[c for n in names for c in (F.lit(n), values(n))]).alias("data"))
    ev = _t(spark, root, "events")
    one = lambda c: F.array(c.cast("string"))
    counter = F.when(F.col("user_id") % 2 == 1, F.lit(2 ** 63 - 1).cast("decimal(20,0)") + F.col("event_id") % 3)
    status = ev.select(_flight_of("user_id").alias("mcap_id"), F.lit("status"), F.lit(0), F.lit(0), F.col("event_id"),
                       F.array(F.col("event_id") * 7), F.create_map(F.lit("nav_state"), one(F.floor(F.col("value")) % 7),
                                                                   F.lit("load"), one(F.floor(F.col("value")) / 4), F.lit("counter"), one(counter)))
    return motor.union(status)


def converted_streams(spark, root) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Untagged logs (pages), tagged logs (conversations), parameter changes (parts) and positions (embeddings) of the ten flights."""
    pages = _t(spark, root, "pages").select(_flight_of("page_id").alias("mcap_id"), (F.col("page_id") * 1000).alias("ts_us"),
                                            F.col("page_id").alias("ordinal"), F.col("url").alias("message"),
                                            F.when(F.col("page_id") % 3 == 0, "ERROR").otherwise("INFO").alias("level_name"))
    tagged = conversation_logs(spark, root).withColumn("conv", F.regexp_extract("mcap_id", "([0-9]+)$", 1).cast("bigint"))
    tagged = tagged.withColumns({"mcap_id": _flight_of("conv"), "ordinal": F.col("conv") * 1000 + F.col("ordinal")}).drop("conv")
    parameters = parameter_rows(spark, root).withColumn("ordinal", F.col("timestamp") * 2 + F.when(F.col("name") == "P_SIZE", 0).otherwise(1))
    parameters = parameters.withColumn("mcap_id", _flight_of("timestamp"))
    positions = position_samples(spark, root)
    whole = lambda c: F.floor(F.col(c) * 256).cast("double")
    positions = positions.withColumns({c: F.when(F.isnan(c), F.col(c)).otherwise(whole(c)) for c in ("x", "y", "z")})
    return pages, tagged, parameters, positions


def ordered_files(spark, root, path: str) -> DataFrame:
    """Status envelopes with many equal publish times, written as files in the order of falling event ids, and read with their origin."""
    from ..sources.messages import read_envelopes
    ev = _t(spark, root, "events")
    day = F.col("ts").cast("date")
    ns = F.lit(3_600_000_000_000) * F.hour("ts")
    env = ev.select(flight_id().alias("mcap_id"), day.alias("log_date"), F.lit("vehicle_status_0").alias("topic"), ns.alias("log_time_ns"),
                    ns.alias("publish_time_ns"), F.lit(0).cast("bigint").alias("sequence"), F.lit("Status").alias("schema_name"),
                    F.to_json(F.struct(F.col("event_id").alias("event"))).alias("payload"))
    env.withColumn("_o", F.get_json_object("payload", "$.event").cast("bigint")).repartitionByRange(4, F.desc("_o")) \
        .sortWithinPartitions(F.desc("_o")).drop("_o").write.parquet(path)
    return read_envelopes(spark, path)


def ten_descriptors(spark, root) -> tuple[DataFrame, dict]:
    """Status envelopes of ten firmwares (by user), each with an own field, and their payload schemas."""
    env = telemetry_envelopes(spark, root).where(F.col("topic") == "vehicle_status_0")
    was = F.from_json("payload", "arming_state int, nav_state int, failsafe boolean")
    k = F.regexp_extract("mcap_id", "([0-9])$", 1).cast("int")
    payload = F.lit(None).cast("string")
    schemas = {}
    for i in range(10):
        nav = was["nav_state"] if i < 5 else (was["nav_state"] + F.lit(0.5)).cast("double")
        one = F.to_json(F.struct(was["arming_state"].alias("arming_state"), nav.alias("nav_state"), (was["nav_state"] * 10 + i).alias(f"own_{i}")))
        payload = F.when(k == i, one).otherwise(payload)
        schemas[f"StatusV{i}"] = f"arming_state int, nav_state {'int' if i < 5 else 'double'}, own_{i} bigint"
    return env.withColumns({"payload": payload, "schema_name": F.concat(F.lit("StatusV"), k.cast("string"))}), {"vehicle_status": schemas}
