import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from flighttables.operators import messages as M
from flighttables.session import new_output_dir
from flighttables.sinks import lake as LK
from tests.conftest import rows

ENV = "mcap_id string, log_date date, topic string, log_time_ns long, publish_time_ns long, sequence long, v double"


def msgs(spark, flight, day):
    d = dt.date(2024, 1, day)
    return M.standard_columns(spark.createDataFrame(
        [(flight, d, "sensor_baro_1", 3000, 3000, 0, 1.0), (flight, d, "sensor_baro_0", 1000, 1000, 0, 2.0),
         (flight, d, "gps", 2000, 2000, 0, 3.0)], ENV))


def test_standard_columns(spark):
    out = msgs(spark, "2024-01-01-a", 1)
    assert out.columns[:8] == ["log_time", "publish_time", "sequence", "mcap_id", "multi_id", "offset_us",
                               "log_date", "time_source"]
    r = out.where(F.col("base_topic") == "sensor_baro").orderBy("multi_id").collect()
    assert [x["multi_id"] for x in r] == [0, 1] and r[0]["offset_us"] == 1 and r[0]["time_source"] == "log_date"


def test_write_lake_append_and_reingest(spark):
    lake = new_output_dir(spark, "test-lake")
    LK.write_lake(spark, msgs(spark, "2024-01-01-a", 1), lake)
    topics = LK.write_lake(spark, msgs(spark, "2024-01-02-b", 2), lake)
    assert sorted(topics) == ["gps", "sensor_baro"]
    baro = LK.read_topic(spark, lake, "sensor_baro")
    assert baro.count() == 4
    with pytest.raises(ValueError, match="already ingested"):
        LK.write_lake(spark, msgs(spark, "2024-01-02-b", 2), lake)
    LK.write_lake(spark, msgs(spark, "2024-01-02-b", 2), lake, on_existing="skip")
    assert LK.read_lake(spark, lake).count() == 6


def failing_commit(monkeypatch, times=1):
    """Make the next ``times`` commits fail after the data were written."""
    real, left = LK._commit, [times]

    def commit(*args):
        if left[0]:
            left[0] -= 1
            raise OSError("lost before the manifest")
        real(*args)
    monkeypatch.setattr(LK, "_commit", commit)


def test_replay_after_a_failed_commit_writes_rows_once(spark, monkeypatch):
    for batch_id in (None, "run-7"):  # run again under a new id, and under the same one
        lake = new_output_dir(spark, "test-replay")
        failing_commit(monkeypatch)
        with pytest.raises(OSError):
            LK.write_lake(spark, msgs(spark, "2024-06-01-a", 1), lake, batch_id=batch_id)
        LK.write_lake(spark, msgs(spark, "2024-06-01-a", 1), lake, on_existing="skip", batch_id=batch_id)
        assert LK.read_lake(spark, lake).count() == 3
        LK.write_lake(spark, msgs(spark, "2024-06-01-a", 1), lake, on_existing="skip", batch_id=batch_id)
        assert LK.read_lake(spark, lake).count() == 3


ENVELOPES = ("mcap_id string, log_date date, topic string, log_time_ns long, publish_time_ns long, sequence long, "
             "schema_name string, payload string")


def test_stream_takes_a_flight_from_several_files_and_batches(spark, monkeypatch):
    from flighttables.streaming.ingest import ingest_stream
    src, lake = new_output_dir(spark, "test-split-src"), new_output_dir(spark, "test-split-lake")
    for f in range(2):
        spark.createDataFrame([("2024-07-01-a", dt.date(2024, 7, 1), "gps_0", i, i, i, "g", '{"lat": %d.0}' % i)
                               for i in range(f * 500, f * 500 + 500)], ENVELOPES).coalesce(1).write.parquet(f"{src}/f{f}")
    name = f"s{abs(hash(lake)) % 10**8}"
    start = lambda: ingest_stream(spark, f"{src}/*", ENVELOPES, lake, {"gps": "lat double"}, name=name, max_files_per_trigger=1)
    failing_commit(monkeypatch)
    with pytest.raises(Exception, match="lost before the manifest"):
        start().awaitTermination()
    start().awaitTermination()                       # the failed micro-batch is replayed under its own id
    got = LK.read_topic_table(spark, f"{lake}/gps")
    assert got.count() == 1000 and got.select("lat").distinct().count() == 1000


def test_two_firmwares_in_one_batch(spark):
    from flighttables.operators.ingest import ingest_envelopes
    env = spark.createDataFrame([
        ("2024-08-01-a", dt.date(2024, 8, 1), "esc_0", 1, 1, 0, "Esc1", '{"temp": 7}'),
        ("2024-08-02-b", dt.date(2024, 8, 2), "esc_0", 1, 1, 0, "Esc2", '{"temp": 7.5, "rpm": 90}'),
        ("2024-08-03-c", dt.date(2024, 8, 3), "esc_0", 1, 1, 0, "Esc2", '{"rpm": 91}')], ENVELOPES)
    lake = new_output_dir(spark, "test-firmwares")
    schemas = {"esc": {"Esc1": "temp int", "Esc2": "temp double, rpm int"}}
    ingest_envelopes(spark, env, schemas, lake)
    got = LK.read_topic_table(spark, f"{lake}/esc").orderBy("mcap_id")
    assert rows(got, "temp", "temp__as_f64", "rpm") == [(7, None, None), (None, 7.5, 90), (None, 0.0, 91)]
    bad = env.withColumn("payload", F.lit('{"temp": 7, "new": 1}'))
    with pytest.raises(Exception, match="outside the descriptor's schema: new"):
        ingest_envelopes(spark, bad, schemas, new_output_dir(spark, "test-firmwares2"))
    with pytest.raises(ValueError, match="no payload schema for descriptors"):
        ingest_envelopes(spark, env, {"esc": {"Esc1": "temp int"}}, new_output_dir(spark, "test-firmwares3"))
    clash = env.where("schema_name = 'Esc1'").withColumn("payload", F.lit('{"multi_id": 7}'))
    with pytest.raises(ValueError, match="standard columns"):
        ingest_envelopes(spark, clash, {"esc": "multi_id int"}, new_output_dir(spark, "test-firmwares4"))


def test_descriptor_check_fails_fast(spark):
    m = spark.createDataFrame([("f", "esc_0", "EscA"), ("f", "esc_1", "EscB")],
                              "mcap_id string, topic string, schema_name string")
    with pytest.raises(Exception, match="mismatched descriptors"):
        M.descriptor_check(m).collect()


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["mcap_id", "flight_date", "start_time", "duration", "armed_duration", "error_count"]
    assert set(E.oracle_sql()) <= set(E.queries())


def test_ingest_stream_available_now(spark):
    from flighttables.streaming.ingest import ingest_stream
    src = new_output_dir(spark, "test-envelopes")
    env = spark.createDataFrame(
        [("2024-01-01-a", dt.date(2024, 1, 1), "gps", 1000, 1000, 0, "gps", '{"lat": 1.5}'),
         ("2024-01-01-a", dt.date(2024, 1, 1), "baro_1", 2000, 2000, 0, "baro", '{"p": 1013}')],
        "mcap_id string, log_date date, topic string, log_time_ns long, publish_time_ns long, sequence long, "
        "schema_name string, payload string")
    env.write.parquet(src)
    lake = new_output_dir(spark, "test-stream-lake")
    q = ingest_stream(spark, src, env.schema, lake, {"gps": "lat double", "baro": "p int"},
                      name=f"t{abs(hash(lake)) % 10**8}")
    q.awaitTermination(120)
    assert q.exception() is None
    assert spark.read.parquet(f"{lake}/gps").count() == 1 and spark.read.parquet(f"{lake}/baro").first()["p"] == 1013


def test_write_topic_table_policy(spark):
    table = new_output_dir(spark, "test-topic-table")
    m = msgs(spark, "2024-01-03-c", 3).where(F.col("base_topic") == "gps")
    LK.write_topic_table(spark, m, table)
    with pytest.raises(ValueError, match="already ingested"):
        LK.write_topic_table(spark, m, table)
    LK.write_topic_table(spark, m, table, on_existing="skip")
    assert spark.read.parquet(table).count() == 1


def test_lake_metrics_and_table_registration(spark):
    lake = new_output_dir(spark, "test-lake-metrics")
    m = {}
    LK.write_lake(spark, msgs(spark, "2024-01-04-d", 4), lake, metrics=m)
    assert m["rows_written"] == 3 and m["flights_written"] == 1
    table = new_output_dir(spark, "test-registered")
    LK.write_topic_table(spark, msgs(spark, "2024-01-05-e", 5).where(F.col("base_topic") == "gps"), table)
    LK.register_topic_table(spark, "gps_registered", table)
    assert spark.table("gps_registered").count() == 1


def test_catalog_as_json(spark):
    from flighttables.sources.messages import catalog_as_json
    df = spark.createDataFrame([("b", "a")], "z string, a string")
    assert catalog_as_json(df).first()["json"] == '{"a":"a","z":"b"}'


def test_ingest_envelopes(spark):
    from flighttables.operators.ingest import ingest_envelopes
    d = dt.date(2024, 1, 6)
    env = spark.createDataFrame(
        [("2024-01-06-f", d, "battery_status_0", 2000, 2000, 0, "battery_status", '{"voltage_v": 11.5, "cells": 3}'),
         ("2024-01-06-f", d, "battery_status_1", 1000, 1000, 0, "battery_status", '{"voltage_v": 12.5, "cells": 4}')],
        "mcap_id string, log_date date, topic string, log_time_ns long, publish_time_ns long, sequence long, "
        "schema_name string, payload string")
    lake = new_output_dir(spark, "test-ingest")
    assert ingest_envelopes(spark, env, {"battery_status": "voltage_v float, cells int"}, lake) == ["battery_status"]
    t = spark.read.parquet(f"{lake}/battery_status")
    assert dict(t.dtypes)["cells"] == "bigint" and dict(t.dtypes)["voltage_v"] == "double"
    assert sorted(rows(t, "multi_id", "cells")) == [(0, 3), (1, 4)]
    with pytest.raises(ValueError, match="no payload schema"):
        ingest_envelopes(spark, env, {"gps": "lat double"}, new_output_dir(spark, "test-ingest2"))


def test_ingest_evolves_table_schema(spark):
    from flighttables.operators.ingest import ingest_envelopes
    from flighttables.sources.tables import register_lake
    schema = ("mcap_id string, log_date date, topic string, log_time_ns long, publish_time_ns long, sequence long, "
              "schema_name string, payload string")
    d1, d2 = dt.date(2024, 1, 7), dt.date(2024, 1, 8)
    lake = new_output_dir(spark, "test-evolve")
    b1 = spark.createDataFrame([("2024-01-07-a", d1, "battery_status_0", 1, 1, 0, "b", '{"vbatt": 11}')], schema)
    ingest_envelopes(spark, b1, {"battery_status": "vbatt int"}, lake)
    b2 = spark.createDataFrame([("2024-01-08-b", d2, "battery_status_0", 1, 1, 0, "b", '{"vbatt": 11.5, "rpm": 7}')],
                               schema)
    ingest_envelopes(spark, b2, {"battery_status": "vbatt double, rpm int"}, lake)
    b3 = spark.createDataFrame([("2024-01-09-c", d2, "battery_status_0", 1, 1, 0, "b", '{"vbatt": 12}')], schema)
    ingest_envelopes(spark, b3, {"battery_status": "vbatt long"}, lake)
    register_lake(spark, lake, ["battery_status"])
    t = spark.table("battery_status")
    assert [c for c in t.columns if c in ("vbatt", "vbatt__as_f64", "rpm")] == ["vbatt", "vbatt__as_f64", "rpm"]
    got = sorted(rows(t, "mcap_id", "vbatt", "vbatt__as_f64", "rpm"))
    assert got == [("2024-01-07-a", 11, None, None), ("2024-01-08-b", None, 11.5, 7), ("2024-01-09-c", 12, None, None)]


def test_lake_reset_with_overwrite(spark):
    lake = new_output_dir(spark, "test-reset")
    LK.write_lake(spark, msgs(spark, "2024-01-10-r", 10), lake)
    LK.write_lake(spark, msgs(spark, "2024-01-11-s", 11), lake)
    assert LK.read_lake(spark, lake).select("mcap_id").distinct().count() == 2
    LK.write_lake(spark, msgs(spark, "2024-01-10-r", 10), lake, mode="overwrite")   # reset, then re-ingest
    assert rows(LK.read_lake(spark, lake).select("mcap_id").distinct()) == [("2024-01-10-r",)]
    assert rows(LK.read_manifest(spark, lake, LK.FANOUT_MANIFEST).select("mcap_id").distinct()) == [("2024-01-10-r",)]


def test_ingest_missing_fields_read_as_zero_values(spark):
    from flighttables.operators.ingest import ingest_envelopes
    schema = ("mcap_id string, log_date date, topic string, log_time_ns long, publish_time_ns long, sequence long, "
              "schema_name string, payload string")
    env = spark.createDataFrame([("2024-01-12-z", dt.date(2024, 1, 12), "param_0", 1, 1, 0, "P",
                                  '{"name": "MC_PITCH_P", "int_value": 42}')], schema)
    lake = new_output_dir(spark, "test-zero")
    ingest_envelopes(spark, env, {"param": "name string, int_value long, float_value double, flags array<int>, "
                                           "ok boolean"}, lake)
    r = spark.read.parquet(f"{lake}/param").first()
    assert (r["name"], r["int_value"], r["float_value"], r["flags"], r["ok"]) == ("MC_PITCH_P", 42, 0.0, [], False)


def test_open_lake_runs_the_sample_queries(spark):
    from flighttables.operators.ingest import ingest_envelopes
    from flighttables.sources.tables import open_lake
    schema = ("mcap_id string, log_date date, topic string, log_time_ns long, publish_time_ns long, sequence long, "
              "schema_name string, payload string")
    f, d = "2026-06-24-abc", dt.date(2026, 6, 24)
    s = 10 ** 9
    env = spark.createDataFrame([
        (f, d, "vehicle_status_0", 1 * s, 1 * s, 0, "vs", '{"arming_state": 1}'),
        (f, d, "vehicle_status_0", 2 * s, 2 * s, 0, "vs", '{"arming_state": 2}'),
        (f, d, "vehicle_status_0", 70 * s, 70 * s, 0, "vs", '{"arming_state": 2}'),
        (f, d, "logged_messages", 3 * s, 3 * s, 0, "Log", '{"level": "ERROR", "message": "x"}'),
        (f, d, "vehicle_local_position_0", 5 * s, 5 * s, 0, "lp", '{"z": -12.34}'),
        (f, d, "vehicle_local_position_0", 9 * s, 9 * s, 0, "lp", '{"z": -3.0}'),
        (f, d, "battery_status_0", 4 * s, 4 * s, 0, "bs",
         '{"cell_count": 4, "voltage_v": 15.2, "current_a": 1.0, "remaining": 0.9, "temperature": 30.0}'),
    ], schema)
    lake = new_output_dir(spark, "test-open-lake")
    ingest_envelopes(spark, env, {
        "vehicle_status": "arming_state int", "logged_messages": "level string, message string",
        "vehicle_local_position": "z float",
        "battery_status": "cell_count int, voltage_v float, current_a float, remaining float, temperature float"},
        lake)
    assert open_lake(spark, lake) == ["battery_status", "logged_messages", "vehicle_local_position", "vehicle_status"]
    fl = spark.sql("SELECT * FROM flights").collect()
    assert [(r["mcap_id"], r["duration"], r["armed_duration"], r["error_count"]) for r in fl] == [(f, "1m9s", "1m8s", 1)]
    alt = spark.sql("""SELECT mcap_id, ROUND(MAX(-z), 1) AS max_alt_m, MIN(log_time) AS started,
                              format_duration(MAX(log_time) - MIN(log_time)) AS duration
                       FROM vehicle_local_position GROUP BY mcap_id""").first()
    assert (alt["max_alt_m"], alt["duration"]) == (12.3, "4s")
    assert spark.sql("SELECT * FROM battery").first()["max_voltage"] == pytest.approx(15.2, rel=1e-6)
    assert spark.sql("SELECT * FROM logged_messages LIMIT 10").count() == 1
    assert "vehicle_status" in [t.name for t in spark.catalog.listTables()]
    assert "arming_state" in [r["col_name"] for r in spark.sql("DESCRIBE vehicle_status").collect()]


def test_topic_tables_prune_partitions_and_push_filters(spark):
    import contextlib
    import io
    from flighttables.operators.ingest import ingest_envelopes
    schema = ("mcap_id string, log_date date, topic string, log_time_ns long, publish_time_ns long, sequence long, "
              "schema_name string, payload string")
    env = spark.createDataFrame([(f"2024-01-{d:02d}-x", dt.date(2024, 1, d), "gps_0", 5, 5, 0, "g", '{"lat": 1.0}')
                                 for d in (1, 2, 3)], schema)
    lake = new_output_dir(spark, "test-prune")
    ingest_envelopes(spark, env, {"gps": "lat double"}, lake)
    q = LK.read_topic_table(spark, f"{lake}/gps").where(
        (F.col("log_date") == F.lit("2024-01-02").cast("date")) & (F.col("publish_time") > F.lit("2024-01-01").cast("timestamp_ntz")))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain("formatted")
    plan = buf.getvalue()
    assert re.search(r"PartitionFilters: \[.*isnotnull\(log_date", plan) and "PushedFilters: [IsNotNull(publish_time)" in plan
    assert q.count() == 1


def test_register_topic_table_uses_the_evolved_schema(spark):
    from flighttables.operators.ingest import ingest_envelopes
    schema = ("mcap_id string, log_date date, topic string, log_time_ns long, publish_time_ns long, sequence long, "
              "schema_name string, payload string")
    lake = new_output_dir(spark, "test-k3")
    b1 = spark.createDataFrame([("2024-02-01-a", dt.date(2024, 2, 1), "imu_0", 1, 1, 0, "i", '{"ax": 1.0}')], schema)
    b2 = spark.createDataFrame([("2024-02-02-b", dt.date(2024, 2, 2), "imu_0", 1, 1, 0, "i", '{"ax": 2.0, "ay": 3.0}')],
                               schema)
    ingest_envelopes(spark, b1, {"imu": "ax double"}, lake)
    ingest_envelopes(spark, b2, {"imu": "ax double, ay double"}, lake)
    LK.register_topic_table(spark, "imu_k3", f"{lake}/imu")
    t = spark.table("imu_k3")
    assert "ay" in t.columns
    assert sorted(rows(t, "mcap_id", "ay")) == [("2024-02-01-a", None), ("2024-02-02-b", 3.0)]


def test_open_lake_fanout_layout(spark):
    from flighttables.sources.tables import open_lake
    lake = new_output_dir(spark, "test-open-fanout")
    LK.write_lake(spark, msgs(spark, "2024-03-01-q", 1), lake)
    assert open_lake(spark, lake) == ["gps", "sensor_baro"]
    assert spark.sql("SELECT count(*) FROM sensor_baro").first()[0] == 2


def test_ingest_stream_continuous_picks_up_new_files(spark):
    from flighttables.streaming.ingest import ingest_stream
    schema = ("mcap_id string, log_date date, topic string, log_time_ns long, publish_time_ns long, sequence long, "
              "schema_name string, payload string")
    src, lake = new_output_dir(spark, "test-cont-src"), new_output_dir(spark, "test-cont-lake")
    first = spark.createDataFrame([("2024-04-01-a", dt.date(2024, 4, 1), "gps", 1, 1, 0, "g", '{"lat": 1.0}')], schema)
    first.write.parquet(f"{src}/f1")
    q = ingest_stream(spark, f"{src}/*", first.schema, lake, {"gps": "lat double"},
                      name=f"c{abs(hash(lake)) % 10**8}", available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        spark.createDataFrame([("2024-04-02-b", dt.date(2024, 4, 2), "gps", 1, 1, 0, "g", '{"lat": 2.0}')],
                              schema).write.parquet(f"{src}/f2")
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(rows(spark.read.parquet(f"{lake}/gps"), "mcap_id", "lat")) == [("2024-04-01-a", 1.0),
                                                                               ("2024-04-02-b", 2.0)]


def test_write_topic_table_overwrite(spark):
    table = new_output_dir(spark, "test-topic-overwrite")
    LK.write_topic_table(spark, msgs(spark, "2024-05-01-a", 1).where(F.col("base_topic") == "gps").drop("base_topic"),
                         table)
    LK.write_topic_table(spark, msgs(spark, "2024-05-02-b", 2).where(F.col("base_topic") == "gps").drop("base_topic"),
                         table, mode="overwrite")
    assert rows(spark.read.parquet(table).select("mcap_id").distinct()) == [("2024-05-02-b",)]
    assert rows(spark.read.parquet(f"{table}/_ingested").select("mcap_id").distinct()) == [("2024-05-02-b",)]


def test_many_flights_are_not_broadcast(spark, tmp_path, monkeypatch):
    """What a table holds, and the view's rows by flight, are joined by shuffles: they don't go through the driver."""
    from flighttables.operators import curated
    from flighttables.sinks import lake as LK
    rows = spark.range(6).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("mcap_id"), F.lit("2024-01-01").cast("date").alias("log_date"),
                                 F.col("id").alias("publish_time"), F.col("id").alias("v"))
    path = f"{tmp_path}/t"
    assert LK.write_topic_table(spark, rows.where("v < 4"), path, batch_id="one")
    keys = ["mcap_id", "source", "stamp", "log_date"]
    monkeypatch.setattr(LK, "BROADCAST_ROWS", 3)
    messages, batch, *_ = LK._stage_and_check(spark, rows, path, keys, LK.MANIFEST, "append", "skip", "two")
    for df in (messages, batch):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan
        assert sorted(r["mcap_id"] for r in df.collect()) == ["f4", "f5"]
    times = rows.select("mcap_id", "log_date", F.timestamp_seconds("v").cast("timestamp_ntz").alias("log_time"), F.lit(2).alias("arming_state"))
    view = curated.flights(times, rows.where("v > 2").select("mcap_id", F.lit("ERROR").alias("level")))
    assert "Broadcast" not in view._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["mcap_id"], r["error_count"]) for r in view.collect()) == [(f"f{i}", int(i > 2)) for i in range(6)]
