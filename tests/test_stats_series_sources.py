import datetime as dt

from flighttables.operators import series as SE, stats as ST
from flighttables.session import new_output_dir
from flighttables.sources import files as FS, tables as TB
from tests.conftest import rows

MB = 1024 * 1024
RUNS = "batch string, outcome string, in_bytes long, out_bytes long, read_seconds double, " \
       "transform_seconds double, write_seconds double"


def test_ingest_stats_rates_and_zero_guard(spark):
    r = spark.createDataFrame([("a", "converted", 2 * MB, MB, 1.0, 2.0, 0.0),
                               ("a", "converted", 2 * MB, MB, 1.0, 2.0, 0.0)], RUNS)
    got = ST.ingest_stats(r).first()
    assert got["n_files"] == 2 and got["transform_mb_s"] == 1.0 and got["read_mb_s"] == 2.0
    assert got["write_mb_s"] == 0.0 and got["ratio"] == 0.5 and got["wall_seconds"] == 6.0


def test_conversion_stats_only_converted(spark):
    r = spark.createDataFrame([("a", "skipped", 10 * MB, 0, 0.0, 0.0, 0.0),
                               ("a", "converted", 4 * MB, 2 * MB, 0.0, 2.0, 0.0)], RUNS)
    got = ST.conversion_stats(r).first()
    assert (got["n_skipped"], got["n_converted"], got["in_bytes"], got["transform_mb_s"], got["ratio"]) == \
        (1, 1, 4 * MB, 2.0, 0.5)
    assert dict(rows(ST.outcome_counts(r))) == {"skipped": 1, "converted": 1}


def test_series(spark):
    t = dt.datetime(2024, 1, 1)
    pos = spark.createDataFrame([("f", 0, t, 1.0, 2.0, -3.0, 0.5, 0.6, -0.7), ("f", 1, t, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0)],
                                "mcap_id string, multi_id int, log_time timestamp_ntz, x double, y double, z double, "
                                "vx double, vy double, vz double")
    assert rows(SE.xy_series(pos), "x", "y") == [(1.0, 2.0)]
    assert rows(SE.height_series(pos), "height") == [(3.0,)]
    assert rows(SE.velocity_series(pos), "z", "y", "x") == [(0.7, 2.0, 0.5)]   # y is position y, as defined
    bat = spark.createDataFrame([("f", 0, t, 11.1, 0.5, 3.0, 3)],
                                "mcap_id string, multi_id int, log_time timestamp_ntz, voltage_v double, "
                                "remaining double, current_a double, cell_count long")
    assert abs(rows(SE.battery_series(bat), "low_voltage_v")[0][0] - 9.9) < 1e-9


def test_list_files_and_manifest(spark):
    d = new_output_dir(spark, "test-files")
    df = spark.createDataFrame([(1,)], "a int")
    for name in ["2024-01-01-aaa.mcap", "2024-01-02-bbb.mcap"]:
        df.write.parquet(f"{d}/src/{name}")
    # message files are folders here; list the parquet parts under them and parse their parent names
    files = FS.list_files(spark, f"{d}/src", ".parquet")
    assert files.count() >= 2
    assert rows(FS.count_files(files))[0][0] == files.count()


def test_register_and_catalog_tables(spark):
    names = TB.register_tables(spark, "/root/testdata/sf0.001", ["region", "nation"])
    assert names == ["region", "nation"]
    cat = {r["name"]: r for r in TB.catalog_tables(spark).collect()}
    assert cat["region"]["n_rows"] == 5 and cat["nation"]["n_columns"] == 3
    assert [r["col_name"] for r in TB.describe(spark, "region").collect()][:2] == ["r_regionkey", "r_name"]


def test_read_log_catalog_json_array(spark):
    import json
    import os
    from flighttables.sources.messages import read_log_catalog
    d = new_output_dir(spark, "test-catalog-json")
    os.makedirs(d, exist_ok=True)
    recs = [{"log_id": "a-1", "log_date": "2024-01-02", "mav_type": "Quadrotor", "vehicle_uuid": "u1"},
            {"log_id": "b-2", "log_date": "2024-01-03", "mav_type": "Fixed Wing"}]
    with open(os.path.join(d, "db_info.json"), "w") as f:
        json.dump(recs, f, indent=4)
    cat = read_log_catalog(spark, d)
    got = sorted(rows(cat, "log_id", "log_date", "vehicle_uuid"))
    assert got == [("a-1", dt.date(2024, 1, 2), "u1"), ("b-2", dt.date(2024, 1, 3), None)]


def test_catalog_arrays_are_bounded(spark, monkeypatch):
    import glob
    import json
    from pyspark.sql import functions as F
    from flighttables.plans import queries as Q
    one_year = spark.range(25_000).select(
        F.concat(F.lit("L-"), "id").alias("log_id"), F.lit("2024-01-02").cast("date").alias("log_date"), F.lit("1-URGENT").alias("mav_type"),
        *[F.lit(None).cast("string").alias(c) for c in ("rating", "vehicle_uuid", "vehicle_name", "airframe_name", "airframe_type", "source", "ver_sw")],
        F.col("id").alias("ordinal"))
    monkeypatch.setattr(Q.S, "log_catalog", lambda spark, root: one_year)
    made = []
    monkeypatch.setattr(Q, "new_output_dir", lambda spark, name: made.append(new_output_dir(spark, name)) or made[-1])
    got = Q.catalog_json_array(spark, "")
    assert sorted(r["log_id"] for r in got.collect()) == sorted(f"L-{i}" for i in range(25_000))
    sizes = [len(json.load(open(p))) for p in glob.glob(f"{made[-1].removeprefix('file:')}/part=*/*.txt")]
    assert sum(sizes) == 25_000 and max(sizes) < 12_000


def test_message_file_manifest(spark):
    import os
    d = new_output_dir(spark, "test-mcap-files")
    os.makedirs(os.path.join(d, "sub"), exist_ok=True)
    for name in ["2024-01-01-abc.mcap", "sub/2024-02-03-def.mcap.mcap", "notes.txt"]:
        with open(os.path.join(d, name), "wb") as f:
            f.write(b"\x89MCAP0\r\n")
    files = FS.list_files(spark, d, ".mcap")
    got = sorted(rows(FS.message_file_manifest(files), "mcap_id", "log_date", "length"))
    assert got == [("2024-01-01-abc", dt.date(2024, 1, 1), 8), ("2024-02-03-def", dt.date(2024, 2, 3), 8)]


def test_scale_conf(spark):
    from flighttables.session import input_bytes, scale_conf
    c = scale_conf(100 * 1024 ** 4)                        # 100 TB
    assert c["spark.sql.shuffle.partitions"] == "409600"      # 256 MB a partition, no cap
    assert scale_conf(10 * 1024 ** 3)["spark.sql.shuffle.partitions"] == "40"   # 10 GB / 256 MB
    assert scale_conf(1)["spark.sql.shuffle.partitions"] == "1"
    assert input_bytes(spark, ["/root/testdata/sf0.001"]) > 0


def test_spread_deals_a_scan_to_the_given_partitions(spark):
    small = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    assert TB.spread(small, 6).rdd.getNumPartitions() == 6 and TB.spread(small, 6).count() == small.count()


def test_a_cluster_without_a_shared_folder_is_an_error():
    import pytest
    from flighttables import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.new_output_dir(Session(), "x")
    assert session.is_local("local[4]") and session.is_local("local") and not session.is_local("yarn")


def test_new_output_dir_keeps_the_scheme():
    from flighttables import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {"spark.checkpoint.dir": "hdfs://name/shared/"}

        def getCheckpointDir(self):
            return "hdfs://name/shared/app"

    class Session:
        sparkContext = Context()

    assert session.new_output_dir(Session(), "a").startswith("hdfs://name/shared/flighttables/a-")
