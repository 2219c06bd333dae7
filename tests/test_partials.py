"""Curated views folded from the partial aggregates of batches against the same views over all rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from flighttables.operators import curated, ingest as IN, partials as PA
from flighttables.session import new_output_dir, path_exists, remove_dir
from flighttables.sinks import lake as LK
from flighttables.sources import tables as TB
from flighttables.streaming.ingest import ingest_stream

ENV = "mcap_id string, log_date date, topic string, log_time_ns long, publish_time_ns long, sequence long, schema_name string, payload string, source string"
SCHEMAS = {"vehicle_status": "arming_state int", "logged_messages": "level string"}
DAY = datetime.date(2024, 6, 1)


def envelopes(spark, seed, flights=("f1", "f2", "f3"), n=60):
    """Status and log rows of flights at random times over some hours, in a file of this seed for each flight."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        f, t = rng.choice(flights), rng.randrange(0, 10 ** 13, 10 ** 6)
        status = i % 3 > 0
        payload = f'{{"arming_state":{rng.choice([1, 1, 2])}}}' if status else f'{{"level":"{rng.choice(["ERROR", "FATAL", "INFO"])}"}}'
        rows.append((f, DAY, "vehicle_status_0" if status else "logged_messages", t, t, 0, "S" if status else "L", payload, f"{f}-{seed}"))
    return spark.createDataFrame(rows, ENV)


def rows_of(df):
    return sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


def same_views(spark, lake):
    TB.open_lake(spark, lake)
    plain = {v: rows_of(spark.table(v)) for v in ("flights", "error_counts")}
    assert TB.open_lake(spark, lake, folded=True) == ["logged_messages", "vehicle_status"]
    assert plain == {v: rows_of(spark.table(v)) for v in plain}
    return plain["flights"]


def test_views_after_batches_a_replay_and_a_lost_commit(spark):
    lake = new_output_dir(spark, "lake")
    seen = []
    for k in range(3):
        IN.ingest_envelopes(spark, envelopes(spark, k), SCHEMAS, lake, batch_id=f"b{k}", partials=True)
        seen.append(same_views(spark, lake))
    IN.ingest_envelopes(spark, envelopes(spark, 1), SCHEMAS, lake, batch_id="b1", partials=True)
    assert same_views(spark, lake) == seen[2] != seen[1]
    # what a batch left that failed before its commit doesn't count, and counts once when it is run again
    IN.ingest_envelopes(spark, envelopes(spark, 3), SCHEMAS, lake, batch_id="b3", partials=True)
    full = same_views(spark, lake)
    for topic in SCHEMAS:
        remove_dir(spark, f"{lake}/{topic}/{LK.MANIFEST}/batch_id=b3")
    assert same_views(spark, lake) == seen[2] != full
    IN.ingest_envelopes(spark, envelopes(spark, 3), SCHEMAS, lake, batch_id="b3", partials=True)
    assert same_views(spark, lake) == full


def test_batches_without_partials_are_read_from_their_rows(spark):
    lake = new_output_dir(spark, "lake")
    for k in range(3):
        IN.ingest_envelopes(spark, envelopes(spark, k), SCHEMAS, lake, batch_id=f"b{k}", partials=k == 1)
    want = same_views(spark, lake)
    table = f"{lake}/vehicle_status"
    assert PA.add_partials(spark, table, PA.FLIGHT_TIMES) == 2 and PA.add_partials(spark, table, PA.FLIGHT_TIMES) == 0
    assert same_views(spark, lake) == want
    remove_dir(spark, f"{table}/batch_id=b0")   # the folded views read no rows of a batch whose partials are there
    assert rows_of(PA.flights(spark, lake)) == want


def test_no_partials_at_all_and_tables_without_the_columns(spark):
    lake = new_output_dir(spark, "lake")
    IN.ingest_envelopes(spark, envelopes(spark, 1), SCHEMAS, lake, batch_id="b1")
    same_views(spark, lake)
    with pytest.raises(ValueError, match="no committed batch"):
        PA.read_folded(spark, f"{lake}/battery_status", PA.BATTERY_RANGES)
    IN.ingest_envelopes(spark, envelopes(spark, 2).where("topic = 'logged_messages'").withColumn("payload", F.lit('{"other":1}')),
                        {"logged_messages": "other int"}, f"{lake}-2", batch_id="b1", partials=True)
    assert not path_exists(spark, f"{lake}-2/logged_messages/{LK.PARTIALS}")
    with pytest.raises(ValueError, match="lacks columns"):
        PA.add_partials(spark, f"{lake}-2/logged_messages", PA.ERRORS)
    # the column comes with a later batch: NULL in the rows before it
    IN.ingest_envelopes(spark, envelopes(spark, 3).where("topic = 'logged_messages'"), {"logged_messages": "level string"}, f"{lake}-2",
                        batch_id="b2", partials=True)
    rows = LK.read_topic_table(spark, f"{lake}-2/logged_messages")
    assert rows_of(PA.error_counts(spark, f"{lake}-2")) == rows_of(curated.error_counts(rows))


def test_groups_with_null_keys_and_measures(spark):
    lake = new_output_dir(spark, "lake")
    rng = random.Random(5)
    some = lambda: rng.choice([None, float("nan"), rng.random(), -rng.random()])
    data = [(f"f{i % 3}", DAY, i, i % 4, rng.choice([0, 1, None]), rng.choice([4, None]), some(), some(), some(), None) for i in range(200)]
    rows = spark.createDataFrame(data, "mcap_id string, log_date date, publish_time long, part int, multi_id int, cell_count long, voltage_v double, "
                                       "current_a double, remaining double, temperature double").withColumn("source", F.concat_ws("#", "mcap_id", "part"))
    for k in range(4):
        LK.write_topic_table(spark, rows.where(F.col("part") == k).drop("part"), f"{lake}/battery_status", batch_id=f"b{k}", partials=PA.partials_of("battery_status"))
    assert rows_of(PA.battery(spark, lake)) == rows_of(curated.battery(rows))


def test_a_stream_keeps_partials(spark):
    env_dir, lake = new_output_dir(spark, "env"), new_output_dir(spark, "lake")
    for k in range(2):
        envelopes(spark, k).drop("source").coalesce(1).write.mode("append").parquet(env_dir)
    q = ingest_stream(spark, env_dir, ENV.rsplit(",", 1)[0], lake, SCHEMAS, max_files_per_trigger=1, partials=True)
    q.awaitTermination()
    assert q.exception() is None
    assert len(LK.committed_batches(spark, f"{lake}/vehicle_status")) == 2
    assert spark.read.parquet(f"{lake}/vehicle_status/{LK.PARTIALS}/flight_times").select("batch_id").distinct().count() == 2
    same_views(spark, lake)
