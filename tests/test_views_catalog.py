import datetime as dt

import pytest

from flighttables.operators import catalog as C, curated as CU
from tests.conftest import rows

VS = "mcap_id string, log_date date, log_time timestamp_ntz, arming_state long"
D = dt.date(2024, 1, 1)


def t(s):
    return dt.datetime(2024, 1, 1, 0, 0, 0) + dt.timedelta(seconds=s)


def test_flights_view(spark):
    vs = spark.createDataFrame([("a", D, t(0), 1), ("a", D, t(10), 2), ("a", D, t(75), 2), ("a", D, t(130), 1),
                                ("b", D, t(0), 1), ("b", D, t(3700), 1)], VS)
    lm = spark.createDataFrame([("a", "ERROR"), ("a", "FATAL"), ("a", "ERROR"), ("c", "ERROR")],
                               "mcap_id string, level string")
    got = sorted(rows(CU.flights(vs, lm)))
    assert got == [("a", D, t(0), "2m10s", "1m5s", 2),     # FATAL not counted; armed 10..75
                   ("b", D, t(0), "1m40s", None, 0)]      # never armed -> NULL, no logs -> 0; hours dropped


def test_flights_sql_view(spark):
    spark.createDataFrame([("a", D, t(0), 2), ("a", D, t(61), 2)], VS).createOrReplaceTempView("vehicle_status")
    spark.createDataFrame([("a", "ERROR")], "mcap_id string, level string").createOrReplaceTempView("logged_messages")
    spark.createDataFrame([("a", 0, 3, 11.0, 1.0, 0.5, 20.0)],
                          "mcap_id string, multi_id int, cell_count long, voltage_v double, current_a double, "
                          "remaining double, temperature double").createOrReplaceTempView("battery_status")
    CU.register_curated_views(spark)
    assert rows(spark.sql("SELECT duration, armed_duration, error_count FROM flights")) == [("1m1s", "1m1s", 1)]
    assert rows(spark.sql("SELECT min_voltage, max_temperature FROM battery")) == [(11.0, 20.0)]


def test_battery_and_altitude(spark):
    b = spark.createDataFrame([("a", 0, 3, 11.0, 1.0, 0.5, 20.0), ("a", 0, 3, 12.0, float("nan"), 0.4, 21.0)],
                              "mcap_id string, multi_id int, cell_count long, voltage_v double, current_a double, "
                              "remaining double, temperature double")
    got = rows(CU.battery(b))
    assert got[0][3:5] == (11.0, 12.0) and got[0][5] == 1.0
    lp = spark.createDataFrame([("a", t(0), -1.26), ("a", t(30), -3.04)], "mcap_id string, log_time timestamp_ntz, z double")
    assert rows(CU.max_altitude(lp)) == [("a", 3.0, t(0), "30s")]


CAT = ("log_id string, log_date date, mav_type string, rating string, vehicle_uuid string, vehicle_name string, "
       "airframe_name string, airframe_type string, source string, ver_sw string, ordinal long")


def catalog(spark):
    d = dt.date
    return spark.createDataFrame([
        ("id-1", d(2024, 1, 5), "Quadrotor", "Good", "u1", "v", "x", "quad", "webui", "h1", 0),
        ("id-2", d(2024, 1, 5), "quadrotor", "good", "u1", "v", "x", "quad", "webui", "h2", 1),   # tie: first kept
        ("id-3", d(2024, 1, 9), "Quadrotor", "Good", "u2", "v", "x", "quad", None, "h1", 2),
        ("id-4", d(2024, 1, 7), "Quadrotor", "Good", None, "v", "x", "quad", "webui", "h1", 3),   # no uuid
        ("id-5", d(2024, 1, 1), "Fixed", "Good", "u3", "v", "x", "plane", "CI", "h1", 4),
    ], CAT)


def test_latest_per_vehicle_ties_and_nulls(spark):
    got = sorted(rows(C.latest_per_vehicle(catalog(spark)), "log_id"))
    assert got == [("id-1",), ("id-3",), ("id-5",)]


def test_filter_order_and_case(spark):
    # git hash filter after latest-per-vehicle: u1's latest (id-1, h1) survives, id-2 (h2) never competes
    q = C.CatalogQuery(mav_type=["QUADROTOR"], latest_per_vehicle=True, git_hash="h2")
    assert rows(C.select_logs(catalog(spark), q), "log_id") == []
    q2 = C.CatalogQuery(mav_type=["QUADROTOR"], rating=["GOOD"], git_hash="h2")
    assert rows(C.select_logs(catalog(spark), q2), "log_id") == [("id-2",)]
    q3 = C.CatalogQuery(source="webui")      # NULL source dropped
    assert rows(C.select_logs(catalog(spark), q3), "log_id") == [("id-4",), ("id-1",), ("id-2",)]
    q4 = C.CatalogQuery(log_id=["id3", "i-d-5"])   # dash-insensitive
    assert rows(C.select_logs(catalog(spark), q4), "log_id") == [("id-3",), ("id-5",)]
    q5 = C.CatalogQuery(uuid=["u1"], airframe_type="quad", vehicle_name="v", airframe_name="x")
    assert rows(C.select_logs(catalog(spark), q5), "log_id") == [("id-1",), ("id-2",)]


def test_limit_before_anti_join(spark):
    q = C.CatalogQuery(max_num=3)
    sel = C.select_logs(catalog(spark), q)
    assert rows(sel, "log_id") == [("id-3",), ("id-4",), ("id-1",)]
    held = spark.createDataFrame([("id-3",), ("id-5",)], "log_id string")
    assert sorted(rows(C.new_logs(sel, held, q), "log_id")) == [("id-1",), ("id-4",)]
    assert dict(rows(C.selection_outcomes(sel, held, q))) == {"selected": 2, "skipped": 1}
    assert len(rows(C.new_logs(sel, held, C.CatalogQuery(max_num=3, overwrite=True)))) == 3


def test_skip_gate_and_held_ids(spark):
    assert C.skip_gate(25, C.CatalogQuery(skip_if_cached=20))
    assert not C.skip_gate(25, C.CatalogQuery(skip_if_cached=20, overwrite=True))
    assert not C.skip_gate(25, C.CatalogQuery(skip_if_cached=20, print_entries=True))
    assert not C.skip_gate(5, C.CatalogQuery(skip_if_cached=20))
    files = spark.createDataFrame([("/d/2024-01-01-abc.ulg",), ("/d/xyz.ulg",)], "path string")
    assert sorted(rows(C.held_ids_from_files(files))) == [("abc",), ("xyz",)]


def test_pending_conversions(spark):
    src = spark.createDataFrame([("a.ulg",), ("b.ulg",)], "key string")
    done = spark.createDataFrame([("a.mcap",)], "dest_key string")
    assert rows(C.pending_conversions(src, done)) == [("b.ulg", "b.mcap")]
    assert len(rows(C.pending_conversions(src, done, overwrite=True))) == 2
    with pytest.raises(Exception, match="ulg"):
        C.pending_conversions(spark.createDataFrame([("c.txt",)], "key string"), done).collect()
