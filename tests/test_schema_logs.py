import pytest
from pyspark.sql import types as T

from flighttables.functions.types import compatible, evolved_name, type_suffix
from flighttables.operators import logs as LG, schema as SC
from tests.conftest import rows


def test_type_suffix_codes():
    assert type_suffix(T.LongType()) == "i64"
    assert type_suffix(T.DoubleType()) == "f64"
    assert type_suffix(T.ArrayType(T.LongType())) == "list_i64"


def test_list_compatibility_ignores_nullability():
    assert compatible(T.ArrayType(T.LongType(), True), T.ArrayType(T.LongType(), False))
    assert not compatible(T.LongType(), T.DoubleType())
    assert not compatible(T.ArrayType(T.LongType()), T.ArrayType(T.DoubleType()))


def test_evolved_names():
    cols = {"vbatt": T.LongType()}
    assert evolved_name("rpm", T.LongType(), cols) == "rpm"
    assert evolved_name("vbatt", T.LongType(), cols) == "vbatt"
    assert evolved_name("vbatt", T.DoubleType(), cols) == "vbatt__as_f64"


def test_evolve_union_siblings_widening_and_order(spark):
    a = spark.createDataFrame([(1, 10, 1.5)], "id long, vbatt int, temp float")
    b = spark.createDataFrame([(2, 2.5, 7, True)], "id long, vbatt double, rpm int, ok boolean")
    c = spark.createDataFrame([(3, 4)], "id long, vbatt long")
    out = SC.evolve_union(spark, "battery", [("2024-01-02-b", b), ("2024-01-01-a", a), ("2024-01-03-c", c)],
                          keep=["id"])
    assert out.columns == ["id", "vbatt", "temp", "vbatt__as_f64", "rpm", "ok"]
    assert dict(out.dtypes)["vbatt"] == "bigint" and dict(out.dtypes)["temp"] == "double"
    got = sorted(rows(out))
    assert got == [(1, 10, 1.5, None, None, None), (2, None, None, 2.5, 7, True), (3, 4, None, None, None, None)]


def test_supported_columns(spark):
    df = spark.createDataFrame([(1, {"a": 1}, (1, 2), [1], [(1,)])],
                               "a long, m map<string,long>, s struct<x:long,y:long>, l array<long>, "
                               "ls array<struct<x:long>>")
    assert SC.supported_columns(df).columns == ["a", "l"]


def test_standard_column_clash_raises(spark):
    a = spark.createDataFrame([(1, 2)], "id long, mcap_id long")
    with pytest.raises(ValueError, match="standard columns"):
        SC.evolve_union(spark, "t", [("s", a)], keep=["id"])


def test_log_records_defaults(spark):
    logs = spark.createDataFrame([("f", 100000200, 1, "Info", "hello"), ("f", 5, 2, "EMERGENCY", "boom")],
                                 "mcap_id string, ts_us long, ordinal long, level_name string, message string")
    got = rows(LG.log_records(logs), "message", "level", "name", "file", "line", "ts_sec", "ts_nsec")
    assert got == [("hello", "UNKNOWN", "", "", 0, 100, 200000), ("boom", "FATAL", "", "", 0, 0, 5000)]


def test_tagged_merge_orders_by_time_then_tag_then_input(spark):
    logs = spark.createDataFrame(
        [("f", 10, 0, 7, "INFO", "b1"), ("f", 5, 1, 3, "INFO", "a1"), ("f", 10, 2, 3, "INFO", "a2"),
         ("f", 5, 3, 7, "INFO", "b0")],
        "mcap_id string, ts_us long, ordinal long, tag int, level_name string, message string")
    got = rows(LG.merge_tagged(logs).orderBy("seq"), "seq", "message", "name")
    # tag 7 appears first in the log (ordinal 0), so it wins ties
    assert got == [(1, "b0", "7"), (2, "a1", "3"), (3, "b1", "7"), (4, "a2", "3")]


def test_parameter_split(spark):
    p = spark.createDataFrame([(100, "MC_PITCH_P", "42"), (200, "MC_PITCH_P", "1.5"), (5, "foo", "-3")],
                              "timestamp long, name string, value string")
    got = rows(LG.parameter_changes(p), "timestamp", "int_value", "float_value")
    assert got == [(100, 42, None), (200, None, 1.5), (5, -3, None)]
    assert rows(LG.with_table_defaults(LG.parameter_changes(p)), "int_value", "float_value")[1] == (0, 1.5)


def test_metadata_maps(spark):
    kv = spark.createDataFrame([("f", "ver_sw", "abc"), ("f", "sys_name", "PX"), ("g", "x", "1")],
                               "mcap_id string, key string, value string")
    m = LG.metadata_lookup(LG.metadata_maps(kv), "ver_sw", "unknown", "ver")
    assert dict(rows(m, "mcap_id", "ver")) == {"f": "abc", "g": "unknown"}


def test_tagged_merge_keeps_null_tags(spark):
    logs = spark.createDataFrame([("f", 1, 0, None, "INFO", "x"), ("f", 1, 1, 5, "INFO", "y")],
                                 "mcap_id string, ts_us long, ordinal long, tag int, level_name string, message string")
    assert rows(LG.merge_tagged(logs).orderBy("seq"), "message", "name") == [("x", ""), ("y", "5")]
