"""Unflattening: cases derived from the rules of field classification and packing."""

import pytest

from flighttables.operators import unflatten as U
from tests.conftest import rows

FIELDS = "topic string, ordinal long, field string, type string"


def table_of(spark, *fields):
    """Column name -> (kind, table type, outer length, inner length) in column order."""
    df = spark.createDataFrame([("rig", i, name, kind) for i, (name, kind) in enumerate(fields)], FIELDS)
    out = U.classify_fields(df).orderBy("position")
    return {r[0]: r[1:] for r in rows(out, "column_name", "kind", "table_type", "outer_len", "inner_len")}


@pytest.mark.parametrize("source, wire, table", [
    ("int8_t", "int32", "bigint"), ("uint32_t", "uint32", "bigint"), ("int64_t", "int64", "bigint"), ("bool", "bool", "boolean"),
    ("float", "float", "double"), ("char", "string", "string")])
def test_a_scalar_has_the_type_of_its_source(spark, source, wire, table):
    df = spark.createDataFrame([("rig", 4, "level", source)], FIELDS)
    assert rows(U.classify_fields(df), "position", "column_name", "wire_type", "table_type") == [(4, "level", wire, table)]


def test_array_length_is_the_greatest_index_whatever_the_gaps(spark):
    got = table_of(spark, ("tank[6]", "int16_t"), ("tank[2]", "int16_t"))
    assert got == {"tank": ("array", "array<bigint>", 7, 1)}


def test_a_repeated_index_counts_once(spark):
    got = table_of(spark, ("tank[1]", "double"), ("tank[1]", "double"), ("tank[0]", "double"))
    assert got == {"tank": ("array", "array<double>", 2, 1)}


def test_the_first_field_of_a_base_decides_its_kind(spark):
    assert table_of(spark, ("code[0]", "char"), ("code[1]", "uint8_t"))["code"][0] == "text"
    assert table_of(spark, ("code[0]", "uint8_t"), ("code[1]", "char"))["code"][0] == "array"


def test_bases_of_all_kinds_side_by_side(spark):
    got = table_of(spark, ("wing.flap[0]", "float"), ("wing.id", "uint8_t"), ("cell[0].mv", "uint16_t"), ("cell[3].mv", "uint16_t"),
                   ("cell[1].serial[11]", "char"), ("wing.flap[4]", "float"))
    assert got == {"wing_flap": ("array", "array<double>", 5, 1), "wing_id": ("scalar", "bigint", 1, 1),
                   "cell__mv": ("array", "array<bigint>", 4, 1), "cell__serial": ("text_array", "array<string>", 2, 12)}


def test_what_no_column_can_hold_is_reported(spark):
    df = spark.createDataFrame([("rig", 0, "cell[0].temps[3]", "float"), ("rig", 1, "cell[0].padding9[0]", "uint8_t"),
                                ("rig", 2, "cell[2].cal.gain", "double"), ("rig", 3, "mode", "uint8_t")], FIELDS)
    assert rows(U.dropped_fields(df).orderBy("ordinal"), "field", "drop_reason", "warn") == [
        ("cell[0].temps[3]", "numeric_array_in_struct", True), ("cell[0].padding9[0]", "numeric_array_in_struct", False),
        ("cell[2].cal.gain", "nested_deeper", True)]
    assert rows(U.classify_fields(df), "column_name") == [("mode",)]


def test_logs_with_topics_of_one_name_are_kept_apart(spark):
    df = spark.createDataFrame([("x", "rig", 0, "a", "float"), ("y", "rig", 0, "a", "bool"), ("y", "rig", 1, "b[2]", "char")],
                               "mcap_id string, " + FIELDS)
    assert sorted(rows(U.classify_fields(df), "mcap_id", "column_name", "table_type")) == [
        ("x", "a", "double"), ("y", "a", "boolean"), ("y", "b", "string")]
    lists = {r["mcap_id"]: [f["field"] for f in r["fields"]] for r in U.topic_fields(df).collect()}
    assert lists == {"x": ["a"], "y": ["a", "b[2]"]}


def test_schema_registry_per_log_and_without_one(spark):
    ch = spark.createDataFrame([("x", "imu_1", "imu", 8), ("x", "imu_0", "imu", 5), ("y", "imu_0", "imu", 2)],
                               "mcap_id string, topic string, type_name string, ordinal long")
    assert sorted(rows(U.schema_registry(ch), "mcap_id", "first_topic", "n_instances")) == [("x", "imu_0", 2), ("y", "imu_0", 1)]
    assert rows(U.schema_registry(ch.drop("mcap_id")), "first_topic", "first_ordinal", "n_instances") == [("imu_0", 2, 2)]


def test_packing_a_topic_by_its_field_list(spark):
    fields = [("t", "uint64_t"), ("cell[1].tag[0]", "char"), ("cell[0].tag[0]", "char"), ("cell[0].tag[1]", "char"),
              ("cell[1].tag[1]", "char"), ("cell[0].cal[0]", "float"), ("cell[0].mv", "int32_t"), ("cell[1].mv", "int32_t"),
              ("frame[0].pose.x", "float"), ("unit.sym[0]", "char"), ("gain[1]", "float"), ("gain[0]", "float")]
    values = (9, 66, 65, 0, 67, 0.5, 31, 32, 7.5, 86, 1.5, 2.5)
    df = spark.createDataFrame([("k", *values)], "key string, " + ", ".join(
        f"`{n}` {'double' if k == 'float' else 'int'}" for n, k in fields))
    out = U.pack_topic(df, fields)
    assert out.columns == ["key", "t", "cell__tag", "cell__mv", "unit_sym", "gain"]
    assert rows(out) == [("k", 9, ["A", "BC"], [31, 32], "V", [2.5, 1.5])]
    with pytest.raises(ValueError, match="missing elements"):
        U.pack_topic(df.drop("cell[0].mv"), [f for f in fields if f[0] != "cell[0].mv"])


def test_packing_without_a_field_list(spark):
    df = spark.createDataFrame([(7, 1.25, 2.25, 79, 75, 3.0, 4.0)], "n int, `lift[0]` double, `lift[1]` double, `st[0]` int, `st[1]` int, "
                                                                     "`leg[0].load` double, `leg[1].load` double")
    out = U.pack_struct_array_columns(U.pack_flat_columns(df, text_bases=("st",)))
    assert out.columns == ["n", "lift", "st", "leg__load"] and rows(out) == [(7, [1.25, 2.25], "OK", [3.0, 4.0])]
    gap = spark.createDataFrame([(1.0, 2.0)], "`lift[0]` double, `lift[2]` double")
    with pytest.raises(ValueError, match="missing elements"):
        U.pack_flat_columns(gap)


def test_transposing_a_struct_array(spark):
    df = spark.createDataFrame([(5, [(1, "a"), (2, "b")]), (6, [])], "k int, leg array<struct<id:int,side:string>>")
    assert sorted(rows(U.transpose_struct_array(df, "leg"))) == [(5, [1, 2], ["a", "b"]), (6, [], [])]


def test_samples_to_rows_of_several_datasets(spark):
    ds = spark.createDataFrame([("wind", 2, [5, 8, 9], [0.1, 0.2, 0.3]), ("wind", 0, [], [])],
                               "topic_name string, multi_id int, timestamp array<long>, `v[3]` array<double>")
    assert rows(U.samples_to_rows(ds, ["v[3]"])) == [("wind_2", 5, 0.1), ("wind_2", 8, 0.2), ("wind_2", 9, 0.3)]


def test_topic_fields_collects_after_its_shuffle_only(spark):
    """No list is collected, and sorted by topic, before the rows are dealt by topic."""
    df = spark.createDataFrame([("l", "t", 1, "b", "float"), ("l", "t", 0, "a", "float"), (None, "t", 0, "c", "char"), ("l", None, 0, "d", "char")],
                               "mcap_id string, topic string, ordinal long, field string, type string")
    out = U.topic_fields(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("ObjectHashAggregate") < plan.index("Exchange hashpartitioning") == plan.rindex("Exchange hashpartitioning")
    assert {(r["mcap_id"], r["topic"]): [f["field"] for f in r["fields"]] for r in out.collect()} == {
        ("l", "t"): ["a", "b"], (None, "t"): ["c"], ("l", None): ["d"]}


def test_spread_leaves_a_scan_of_many_splits(spark):
    from flighttables.sources.tables import spread
    df = spark.range(0, 100, 1, 6)
    plan = lambda n: spread(df, n)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(6) and "Exchange" not in plan(4) and "Exchange" in plan(8) and spread(df, 8).count() == 100
