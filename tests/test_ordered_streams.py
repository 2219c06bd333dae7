import datetime as dt
import random

from pyspark.sql import Window, functions as F

from flighttables.operators import logs as LG, merge as MG, series as SE, trajectory as TJ
from flighttables.operators.ordered import ordered_within
from tests.conftest import rows


def test_ordered_within_matches_window_on_a_hot_group(spark):
    random.seed(7)
    data = [("hot" if i % 4 else random.choice(["a", "b", None]), i, random.randint(0, 3),
             None if i % 11 == 0 else float(i), i * 10**12) for i in range(300)]
    df = spark.createDataFrame(data, "g string, o long, s long, v double, big long")
    got = ordered_within(df, ["g"], ["o"], lag_cols=["s", "v", "big"], lead_cols=["s", "big"], width=6)
    w = Window.partitionBy("g").orderBy("o")
    exp = df.select("*", F.row_number().over(w).cast("bigint").alias("seq"), F.lag("s").over(w).alias("prev_s"),
                    F.lag("v").over(w).alias("prev_v"), F.lag("big").over(w).alias("prev_big"),
                    F.lead("s").over(w).alias("next_s"), F.lead("big").over(w).alias("next_big"))
    assert sorted(rows(got.select(exp.columns)), key=str) == sorted(rows(exp), key=str)


def test_trajectory(spark):
    nan = float("nan")
    s = spark.createDataFrame([("f", 0, 1, 1, nan, 2.0, 3.0), ("f", 0, 2, 2, 1.0, 2.0, 3.0),
                               ("f", 0, 3, 3, 4.0, 5.0, 6.0), ("f", 1, 4, 4, 9.0, 9.0, 9.0),
                               ("g", 0, 1, 1, nan, nan, nan)],
                              "mcap_id string, multi_id int, timestamp long, ordinal long, x double, y double, z double")
    assert rows(TJ.trajectory_points(s).orderBy("point_idx")) == [("f", 1, 2, 2.0, 1.0, -3.0), ("f", 2, 3, 5.0, 4.0, -6.0)]
    summ = TJ.trajectory_summary(s).collect()
    assert len(summ) == 1 and summ[0]["first_ts"] == 2 and summ[0]["n_points"] == 2
    assert summ[0]["entity_id"] == "trajectory" and summ[0]["frame_id"] == "local_origin"


def test_merge_streams_order_and_counts(spark):
    topics = spark.createDataFrame([("f", "a_0", 10, 1, "x"), ("f", "b_0", 5, 2, "y")],
                                   "mcap_id string, topic string, ts_us long, row_ord long, payload string")
    logs = spark.createDataFrame([("f", "logged_messages", 10, 1, "hello")],
                                 "mcap_id string, topic string, ts_us long, row_ord long, payload string")
    out = MG.merge_streams([topics, logs]).orderBy("seq")
    assert rows(out, "seq", "topic", "log_time_ns") == [(1, "b_0", 5000), (2, "a_0", 10000),
                                                       (3, "logged_messages", 10000)]
    assert out.count() == topics.count() + logs.count()


def test_state_transitions(spark):
    base = dt.datetime(2024, 1, 1)
    vs = spark.createDataFrame(
        [("f", 0, base + dt.timedelta(seconds=i), i, n, a, fs) for i, (n, a, fs) in
         enumerate([(0, 1, False), (0, 1, False), (2, 2, False), (2, 2, True), (9, 1, True)])],
        "mcap_id string, multi_id int, log_time timestamp_ntz, ordinal long, nav_state long, arming_state long, "
        "failsafe boolean")
    got = rows(SE.state_transitions(vs).where("state = 'nav_state'").orderBy("segment"),
               "segment", "value", "label", "rel_start_us")
    assert got == [(1, "0", "MANUAL", 0), (2, "2", "POSCTL", 2000000), (3, "9", "UNKNOWN_9", 4000000)]
    arm = rows(SE.state_transitions(vs).where("state = 'arming_state'").orderBy("segment"), "label", "end_time")
    assert arm == [("Disarmed", base + dt.timedelta(seconds=2)), ("Armed", base + dt.timedelta(seconds=4)),
                   ("Disarmed", None)]


def test_ordered_within_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        data = [("hot" if i % 5 else "x", i % 7, i) for i in range(120)]
        df = spark.createDataFrame(data, "g string, t int, ord long")
        got = ordered_within(df, ["g"], ["t", "ord"], lag_cols=["t"], width=5)
        w = Window.partitionBy("g").orderBy("t", "ord")
        exp = df.select("*", F.row_number().over(w).cast("bigint").alias("seq"), F.lag("t").over(w).alias("prev_t"))
        assert sorted(rows(got.select(exp.columns)), key=str) == sorted(rows(exp), key=str)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_hot_group_is_split_into_buckets(spark):
    # 95% of the rows belong to one flight; a flight-keyed window would put them in one task.
    n = 4000
    df = spark.range(n).select(F.when(F.col("id") % 20 == 0, F.concat(F.lit("f"), F.col("id").cast("string")))
                               .otherwise(F.lit("hot")).alias("g"), F.col("id").alias("o"))
    got = ordered_within(df, ["g"], ["o"], width=100)
    sizes = [r["n"] for r in got.groupBy("g", F.floor(F.col("o") / 100)).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) <= 100
    seqs = sorted(r[0] for r in rows(got.where("g = 'hot'").select("seq")))
    assert seqs == list(range(1, 3801))


def test_ordered_results_may_be_unioned_coalesced_and_ordered_again(spark):
    df = spark.range(5000).select(F.lit("f").alias("g"), ((F.col("id") * 7919) % 5000).alias("o"))
    got = ordered_within(df, ["g"], ["o"], lag_cols=["o"], lead_cols=["o"], width=300)
    want = sorted((i, i + 1, i - 1 if i else None, i + 1 if i < 4999 else None) for i in range(5000))
    key = lambda r: (r[0], r[1])
    assert sorted(rows(got.coalesce(2), "o", "seq", "prev_o", "next_o"), key=key) == want
    other = spark.range(10).select(F.lit("x").alias("g"), F.col("id").alias("o"), F.col("id").alias("seq"),
                                   F.col("id").alias("prev_o"), F.col("id").alias("next_o"))
    both = other.unionByName(got).where("g = 'f'")
    assert sorted(rows(both, "o", "seq", "prev_o", "next_o"), key=key) == want
    again = ordered_within(both.drop("prev_o", "next_o"), ["g"], ["seq"], seq_col="again", width=70)
    assert again.where("again <> seq").count() == 0 and again.count() == 5000


def test_merged_stream_inside_a_merge(spark):
    logs = spark.range(3000).select(F.lit("f").alias("mcap_id"), (F.col("id") * 1_000_000).alias("ts_us"), F.lit("INFO").alias("level_name"),
                                    F.lit("m").alias("message"), (F.col("id") % 3).alias("tag"), F.col("id").alias("ordinal"))
    merged = LG.merge_tagged(logs)
    stream = merged.select("mcap_id", F.lit("logged").alias("topic"), "ts_us", F.col("seq").alias("row_ord"), F.lit("").alias("payload"))
    out = MG.merge_streams([stream, stream.where("row_ord % 2 = 0")])
    assert out.count() == 4500
    assert rows(out.agg(F.min("seq"), F.max("seq"), F.countDistinct("seq"))) == [(1, 4500, 4500)]
    first = out.where("stream = 0").select("ts_us", "row_ord")
    assert first.where("ts_us <> (row_ord - 1) * 1000000").count() == 0


def test_trajectory_follows_sample_order_not_time(spark):
    s = spark.createDataFrame([("f", 0, 300, 1, 1.0, 2.0, 3.0), ("f", 0, 100, 2, 4.0, 5.0, 6.0)],
                              "mcap_id string, multi_id int, timestamp long, ordinal long, x double, y double, z double")
    assert rows(TJ.trajectory_points(s).orderBy("point_idx"), "point_idx", "timestamp") == [(1, 300), (2, 100)]
    assert TJ.trajectory_summary(s).first()["first_ts"] == 300


def test_ordered_within_empty_and_single_row(spark):
    empty = spark.createDataFrame([], "g string, o long, v long")
    assert ordered_within(empty, ["g"], ["o"], lag_cols=["v"], lead_cols=["v"], width=4).count() == 0
    one = spark.createDataFrame([("a", 1, 7)], "g string, o long, v long")
    assert rows(ordered_within(one, ["g"], ["o"], lag_cols=["v"], lead_cols=["v"], width=4)) == \
        [("a", 1, 7, 1, None, None)]


def test_merge_streams_deals_whole_messages_once(spark, monkeypatch):
    """A dense flight is cut into narrow buckets; whole messages are shuffled once, into ranges that are in order as they lie."""
    monkeypatch.setattr(MG, "BUCKET_ROWS", 50)
    monkeypatch.setattr(MG, "RANGE_ROWS", 100)
    flight = F.when(F.col("id") % 5 == 0, F.lit("b")).otherwise(F.lit("a"))
    stream = spark.range(1000).select(flight.alias("mcap_id"), F.lit("t").alias("topic"), (F.col("id") * 37 % 400).alias("ts_us"),
                                      F.col("id").alias("row_ord"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("payload"))
    out = MG.merge_streams([stream.where("row_ord % 2 = 0"), stream.where("row_ord % 2 = 1")])
    parts = [[(r["mcap_id"], r["seq"]) for r in p] for p in out.rdd.glom().collect()]
    assert len([p for p in parts if p]) > 4 and max(map(len, parts)) < 400
    assert [x for p in parts for x in p] == [("a", i + 1) for i in range(800)] + [("b", i + 1) for i in range(200)]
    got = [(r["mcap_id"], r["ts_us"], r["stream"], r["row_ord"], r["payload"]) for r in out.collect()]
    want = sorted(((r["mcap_id"], r["ts_us"], r["row_ord"] % 2, r["row_ord"], r["payload"]) for r in stream.collect()), key=lambda x: x[:4])
    assert got == want


def test_bucket_width_follows_the_densest_flight(spark, monkeypatch):
    monkeypatch.setattr(MG, "BUCKET_ROWS", 10)
    dense = spark.range(100).select(F.lit("a").alias("mcap_id"), F.col("id").alias("ts_us"))
    sparse = spark.range(5).select(F.lit("b").alias("mcap_id"), (F.col("id") * 10 ** 12).alias("ts_us"))
    assert MG.bucket_width(dense.union(sparse)) == (10, 105)
    assert MG.bucket_width(sparse) == (MG.TIME_WIDTH_US, 5) and MG.bucket_width(sparse.limit(0)) == (MG.TIME_WIDTH_US, 0)
    monkeypatch.setattr(MG, "MOST_BUCKETS", 6)
    assert MG.bucket_width(dense.union(sparse))[0] == 17


def test_merge_streams_broadcasts_no_row_per_bucket(spark, monkeypatch):
    """Messages far apart: nearly every one has a bucket of its own, of which the driver must hold nothing."""
    monkeypatch.setattr(MG, "BUCKET_ROWS", 40)
    monkeypatch.setattr(MG, "RANGE_ROWS", 60)
    held, hint = [], F.broadcast
    monkeypatch.setattr(F, "broadcast", lambda df: held.append(df.count()) or hint(df))
    flight = F.when(F.col("id") % 3 == 0, F.lit("long")).when(F.col("id") % 5 > 1, F.concat(F.lit("f"), (F.col("id") % 40).cast("string")))
    when = F.when(F.col("id") % 17 > 0, (F.col("id") * 37 % 400 - 100) * 2 * MG.TIME_WIDTH_US)
    stream = spark.range(400).select(flight.alias("mcap_id"), F.lit("t").alias("topic"), when.alias("ts_us"), F.col("id").alias("row_ord"),
                                     F.concat(F.lit("p"), F.col("id").cast("string")).alias("payload"))
    out = MG.merge_streams([stream.where("row_ord % 2 = 0"), stream.where("row_ord % 2 = 1")])
    assert max(held, default=0) <= 2  # the long flights: "long" and the one without a name
    w = Window.partitionBy("mcap_id").orderBy("ts_us", "stream", "row_ord")
    want = stream.withColumn("stream", (F.col("row_ord") % 2).cast("int")).withColumn("seq", F.row_number().over(w).cast("bigint"))
    cols = ["mcap_id", "seq", "ts_us", "stream", "row_ord", "payload"]
    assert sorted(rows(out, *cols), key=str) == sorted(rows(want, *cols), key=str)
    short = MG.merge_streams([stream.where("mcap_id <> 'long'")])
    assert short.count() == 160 and "BroadcastExchange" not in short._jdf.queryExecution().executedPlan().toString()


def test_ordered_within_ranges_matches_window(spark):
    """A column of widths, null where a group is one bucket; border rows are no row's neighbours and not in the result."""
    random.seed(11)
    data = [(random.choice(["hot", "hot", "hot", "a", "b", None]), None if i % 13 == 0 else random.randint(-90, 90), i,
             None if i % 7 == 0 else float(i)) for i in range(300)]
    df = spark.createDataFrame(data, "g string, t long, o long, v double")
    w = Window.partitionBy("g").orderBy("t", "o")
    exp = df.select("*", F.row_number().over(w).cast("bigint").alias("seq"), F.lag("v").over(w).alias("prev_v"),
                    F.lag("o").over(w).alias("prev_o"), F.lead("v").over(w).alias("next_v"), F.lead("t").over(w).alias("next_t"))
    for width in (7, F.when(F.coalesce(F.col("g"), F.lit("hot")) == "hot", F.lit(7)), F.lit(None).cast("bigint")):
        got = ordered_within(df, ["g"], ["t", "o"], lag_cols=["v", "o"], lead_cols=["v", "t"], width=width, ranges=5)
        assert got.columns == exp.columns
        assert sorted(rows(got), key=str) == sorted(rows(exp), key=str)
        assert "BroadcastExchange" not in got._jdf.queryExecution().executedPlan().toString()
