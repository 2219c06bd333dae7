import datetime

import pytest
from pyspark.sql import functions as F

from flighttables.functions import levels as L, names as N, text as TX, time as TM
from tests.conftest import rows


def test_topic_split(spark):
    df = spark.createDataFrame([(t,) for t in ["sensor_baro_1", "logged_messages", "foo_256", "foo_", "_3", "x"]],
                               "topic string")
    got = rows(df.select(N.topic_base("topic"), N.topic_multi_id("topic")))
    assert got == [("sensor_baro", 1), ("logged_messages", 0), ("foo_256", 0), ("foo_", 0), ("", 3), ("x", 0)]


def test_compose_then_parse_is_identity(spark):
    df = spark.range(256).select(F.lit("sensor_accel").alias("n"), F.col("id").cast("int").alias("m"))
    t = df.select("n", "m", N.compose_topic("n", "m").alias("t"))
    got = rows(t.select("n", "m", N.topic_base("t"), N.topic_multi_id("t")))
    assert all(a == c and b == d for a, b, c, d in got)
    assert rows(spark.createDataFrame([("sensor_accel", 0)], "n string, m int").select(N.compose_topic("n", "m"))) \
        == [("sensor_accel_0",)]


def test_file_names(spark):
    df = spark.createDataFrame([("store://logs/2026-06-24-abc.mcap.mcap",), ("x/2024-01-02-q-1",)], "p string")
    got = rows(df.select(N.mcap_id_from_path("p"), N.log_id_from_stem(N.file_stem("p")),
                         N.log_date_from_name(N.file_name("p"))))
    assert got == [("2026-06-24-abc", "abc.mcap", datetime.date(2026, 6, 24)),
                   ("2024-01-02-q-1", "q-1", datetime.date(2024, 1, 2))]
    assert rows(spark.createDataFrame([("abc",)], "s string").select(N.log_id_from_stem("s"))) == [("abc",)]


def test_bad_date_prefix_raises(spark):
    df = spark.createDataFrame([("flight-abc.mcap",)], "p string")
    with pytest.raises(Exception, match="YYYY-MM-DD"):
        df.select(N.log_date_from_name("p")).collect()


def test_dest_key(spark):
    ok = spark.createDataFrame([("a/b.ulg",)], "k string")
    assert rows(ok.select(N.dest_key("k"))) == [("a/b.mcap",)]
    with pytest.raises(Exception, match="ulg"):
        spark.createDataFrame([("a/b.txt",)], "k string").select(N.dest_key("k")).collect()


def test_struct_array_test_and_column_names(spark):
    t = ["esc[0].timestamp", "esc[7]._padding0[3]", "outer[0].inner"]
    f = ["timestamp", "control[0]", "name[5]", "gps.lat"]
    df = spark.createDataFrame([(x,) for x in t + f], "f string")
    assert [r[0] for r in rows(df.select(N.is_struct_array_field("f")))] == [True] * 3 + [False] * 4
    cn = spark.createDataFrame([("gps.lat", None), ("esc", "rpm"), ("device.name", None)], "b string, l string")
    assert [r[0] for r in rows(cn.select(N.column_name(F.col("b"), F.col("l"))))] == ["gps_lat", "esc__rpm",
                                                                                       "device_name"]


def test_anchor_time(spark):
    df = spark.createDataFrame([(datetime.date(2026, 6, 24), 1999)], "d date, ns long")
    got = rows(df.select(TM.anchor_time("d", "ns"), TM.offset_us("ns"), TM.days_since_epoch("d")))
    assert got == [(datetime.datetime(2026, 6, 24, 0, 0, 0, 1), 1, 20628)]


def test_format_duration(spark):
    secs = [59, 60, 61, 120, 3910, 90061, None]
    df = spark.createDataFrame([(s,) for s in secs], "s long").select(
        F.when(F.col("s").isNotNull(), F.make_dt_interval(secs=F.col("s"))).alias("d"))
    assert [r[0] for r in rows(df.select(TM.format_duration("d")))] == ["59s", "0s", "1m1s", "2m0s", "5m10s",
                                                                        "1m1s", None]


def test_format_duration_sql_function(spark):
    TM.register_sql_functions(spark)
    got = spark.sql("SELECT format_duration(INTERVAL '61' SECOND), format_duration(INTERVAL '60' SECOND)").first()
    assert tuple(got) == ("1m1s", "0s")


def test_sec_nsec_floor(spark):
    df = spark.createDataFrame([(1500001,), (-1500000,), (0,)], "us long")
    got = rows(df.select(TM.micros_to_sec_nsec("us").alias("t")).select("t.sec", "t.nsec"))
    assert got == [(1, 500001000), (-2, 500000000), (0, 0)]


def test_level_remap(spark):
    names = ["EMERGENCY", "ALERT", "CRITICAL", "ERROR", "WARNING", "NOTICE", "INFO", "DEBUG", "WEIRD"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(L.remap_level("n").alias("l"))
    got = [r[0] for r in rows(df)]
    assert got == ["FATAL"] * 3 + ["ERROR", "WARNING", "INFO", "INFO", "DEBUG", "UNKNOWN"]
    shown = [r[0] for r in rows(df.select(L.at_least_level("l")))]
    assert shown == [True] * 8 + [False]


def test_enum_label(spark):
    df = spark.createDataFrame([(0,), (5,), (9,)], "n long")
    got = [r[0] for r in rows(df.select(L.enum_label("n", {0: "MANUAL", 5: "AUTO_RTL"})))]
    assert got == ["MANUAL", "AUTO_RTL", "UNKNOWN_9"]


@pytest.mark.parametrize("data,expected", [
    ([104, 105, 0, 99, 100], "hi"),          # NUL trim
    ([118, 115, 0, -120], "vs"),             # signed bytes after the NUL
    ([104, 105], "hi"),                      # no NUL
    ([-61, -87, 0], "é"),               # two-byte UTF-8 from signed bytes
    ([104, -1, 105], "h�i"),            # invalid byte replaced
])
def test_char_array_to_text(spark, data, expected):
    df = spark.createDataFrame([(data,)], "a array<int>")
    assert rows(df.select(TX.char_array_to_text("a"))) == [(expected,)]


def test_char_arrays_to_texts_and_round_trip(spark):
    df = spark.createDataFrame([([[97, 0], [98, 99]],)], "a array<array<int>>")
    assert rows(df.select(TX.char_arrays_to_texts("a"))) == [(["a", "bc"],)]
    t = spark.createDataFrame([("héllo ü",), ("",)], "t string")
    assert rows(t.select(TX.char_array_to_text(TX.text_to_signed_bytes("t")))) == [("héllo ü",), ("",)]


@pytest.mark.parametrize("raw", [[0xE2, 0x82], [0xFF], [0x61, 0xC3], [0xE2, 0x28, 0xA1], [0xF0, 0x9F, 0x98],
                                 [0xED, 0xA0, 0x80], [0xC0, 0xAF], [0xF4, 0x90, 0x80, 0x80], [0x61, 0x80, 0x80, 0x62]])
def test_invalid_utf8_is_replaced_like_python(spark, raw):
    signed = [b - 256 if b > 127 else b for b in raw]
    df = spark.createDataFrame([(signed,)], "a array<int>")
    assert rows(df.select(TX.char_array_to_text("a"))) == [(bytes(raw).decode("utf-8", errors="replace"),)]
