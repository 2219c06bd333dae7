"""Ingest by files: identity of batches, changed files, decoding in one pass, u64, order in files, the run table; conversion; polyline."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flighttables.functions.types import variant_value, widen
from flighttables.operators import convert as CV, ingest as IN, trajectory as TJ
from flighttables.session import new_output_dir
from flighttables.sinks import lake as LK
from flighttables.sources import messages as MS
from flighttables.streaming.ingest import ingest_stream

ENV = "mcap_id string, log_date date, topic string, log_time_ns long, publish_time_ns long, sequence long, schema_name string, payload string"
DAY = datetime.date(2024, 6, 1)


def envelopes(spark, flight, n, first=0, schema_name="S", payload=lambda i: f'{{"a":{i}}}'):
    return spark.createDataFrame([(flight, DAY, "status_0", 1000 * (i // 5), 1000 * (i // 5), 0, schema_name, payload(i)) for i in range(first, first + n)], ENV)


def run_stream(spark, env_dir, lake, name=None):
    q = ingest_stream(spark, env_dir, ENV, lake, {"status": "a long"}, name=name)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def held(spark, lake):
    return sorted((r["mcap_id"], r["a"]) for r in LK.read_topic_table(spark, f"{lake}/status").select("mcap_id", "a").collect())


def test_fresh_checkpoint_shared_name_and_replay(spark):
    env_dir, lake, other = (new_output_dir(spark, n) for n in ("env", "lake", "other"))
    envelopes(spark, "2024-06-01-f1", 50).write.parquet(env_dir)
    run_stream(spark, env_dir, lake, "one-" + lake[-8:])
    envelopes(spark, "2024-06-01-f2", 50).write.mode("append").parquet(env_dir)
    run_stream(spark, env_dir, lake, "two-" + lake[-8:])          # a checkpoint that starts again at epoch 0
    want = [(f, i) for f in ("2024-06-01-f1", "2024-06-01-f2") for i in range(50)]
    assert held(spark, lake) == want
    for name in ("one-" + lake[-8:], "two-" + lake[-8:], "three-" + lake[-8:]):   # what the first stream has not seen is held, and so is everything else
        run_stream(spark, env_dir, lake, name)
    assert held(spark, lake) == want
    run_stream(spark, env_dir, lake)                                # without names two lakes have checkpoints of their own
    run_stream(spark, env_dir, other)
    assert held(spark, lake) == want == held(spark, other)


def test_a_changed_file_is_an_error(spark):
    lake = new_output_dir(spark, "lake")
    env = envelopes(spark, "2024-06-01-f1", 5).withColumns({"source": F.lit("/x/f1"), "stamp": F.lit("10-1")})
    schemas = {"status": "a long"}
    IN.ingest_envelopes(spark, env, schemas, lake)
    IN.ingest_envelopes(spark, env, schemas, lake)                  # the same files: the same batch
    assert len(held(spark, lake)) == 5
    with pytest.raises(ValueError, match="has changed since"):
        IN.ingest_envelopes(spark, env.withColumn("stamp", F.lit("12-2")), schemas, lake, on_existing="skip")
    more = envelopes(spark, "2024-06-01-f1", 5, first=5).withColumns({"source": F.lit("/x/f1b"), "stamp": F.lit("10-1")})
    with pytest.raises(ValueError, match="already ingested"):
        IN.ingest_envelopes(spark, env.unionByName(more), schemas, lake)
    IN.ingest_envelopes(spark, env.unionByName(more), schemas, lake, on_existing="skip")
    assert [a for _, a in held(spark, lake)] == list(range(10))


def test_batch_digest(spark):
    rows = [("/a", "1"), ("/b", "2"), ("/a", "1")]
    digest = lambda r: IN.batch_digest(spark.createDataFrame(r, "source string, stamp string"))
    assert digest(rows) == digest(rows[::-1][:2]) != digest([("/a", "1"), ("/b", "3")])
    assert digest(rows + [("/c", None)]) is None and digest([]) is None
    assert digest([("/a", "1")]).startswith("files-1-")


def test_staging_is_removed_after_a_failure(spark):
    lake = new_output_dir(spark, "lake")
    root = lake.rsplit("/", 1)[0]
    before = {r["path"].split("/ingest-staging")[0] for r in _staged(spark, root)}
    with pytest.raises(ValueError, match="no payload schema for topics"):
        IN.ingest_envelopes(spark, envelopes(spark, "2024-06-01-f1", 5), {}, lake)
    with pytest.raises(Exception, match="outside the descriptor"):
        IN.ingest_envelopes(spark, envelopes(spark, "2024-06-01-f1", 5), {"status": "b long"}, lake)
    assert {r["path"].split("/ingest-staging")[0] for r in _staged(spark, root)} == before


def _staged(spark, root):
    import glob
    path = root.removeprefix("file:")
    return [{"path": p} for p in glob.glob(f"{path}/ingest-staging*")]


def test_many_descriptors_are_one_scan(spark):
    lake = new_output_dir(spark, "staged")
    parts = [envelopes(spark, f"2024-06-01-f{k}", 4, schema_name=f"D{k}", payload=lambda i, k=k: f'{{"a":{i}.5,"f{k}":{k}}}' if k % 2 else f'{{"a":{i},"f{k}":{k}}}')
             for k in range(10)]
    env = parts[0]
    for p in parts[1:]:
        env = env.unionByName(p)
    schemas = {"status": {f"D{k}": f"a {'double' if k % 2 else 'long'}, f{k} long" for k in range(10)}}
    IN.ingest_envelopes(spark, env, schemas, lake)
    got = LK.read_topic_table(spark, f"{lake}/status")
    for r in got.collect():
        k = int(r["mcap_id"][-1])
        assert r[f"f{k}"] == k and all(r[f"f{j}"] is None for j in range(10) if j != k)
        assert (r["a__as_f64"] is not None and r["a"] is None) if k % 2 else (r["a"] is not None and r["a__as_f64"] is None)
    path = new_output_dir(spark, "one")
    env.withColumns({"base_topic": F.lit("status"), "multi_id": F.lit(0), "source": F.lit("s"), "stamp": F.lit("t"), "row_index": F.lit(0).cast("long")}).write.parquet(path)
    structs = {d: T.StructType.fromDDL(s) for d, s in schemas["status"].items()}
    mapping = {f"{i:09d}": {f.name: f.name for f in s.fields} for i, s in enumerate(structs.values())}
    plan = IN.decode_topic(spark.read.parquet(path), structs, {"a": "bigint", **{f"f{k}": "bigint" for k in range(10)}}, mapping)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan parquet") == 1 and "Union" not in text


def test_variant_values(spark):
    big = [0, 1, 2 ** 63 - 1, 2 ** 63, 2 ** 64 - 1]
    rows = spark.createDataFrame([(f'{{"u":{v},"us":[{v},0],"s":"{v}","d":1.5,"b":true,"t":"x","x":"AAE=","n":null,"nan":"NaN"}}', Decimal(v)) for v in big], "p string, v decimal(20,0)")
    f = lambda name, kind: widen(variant_value(F.try_element_at("f", F.lit(name)), kind), kind)
    u64 = T.DecimalType(20, 0)
    got = rows.select("v", MS.parse_fields(F.col("p")).alias("f")).select(
        "v", f("u", u64).alias("u"), f("us", T.ArrayType(u64)).alias("us"), f("s", u64).alias("s"), f("d", T.DoubleType()).alias("d"),
        f("b", T.BooleanType()).alias("b"), f("t", T.StringType()).alias("t"), f("x", T.BinaryType()).alias("x"), f("n", T.LongType()).alias("n"),
        f("none", T.LongType()).alias("none"), f("nan", T.DoubleType()).alias("nan")).collect()
    for r in got:
        v = int(r["v"])
        want = v - 2 ** 64 if v >= 2 ** 63 else v
        assert (r["u"], r["us"], r["s"], r["d"], r["b"], r["t"], bytes(r["x"]), r["n"], r["none"]) == (want, [want, 0], want, 1.5, True, "x", b"\x00\x01", None, None)
        assert r["nan"] != r["nan"]
    for bad, kind in (('{"u":1.5}', T.LongType()), ('{"u":"x"}', T.LongType()), ('{"u":[1]}', T.LongType()), ('{"u":"x"}', T.DoubleType()), ('{"u":18446744073709551616000}', u64)):
        with pytest.raises(Exception):
            spark.createDataFrame([(bad,)], "p string").select(MS.parse_fields(F.col("p")).alias("f")).select(f("u", kind)).collect()


def test_run_table(spark):
    env_dir, lake = new_output_dir(spark, "env"), new_output_dir(spark, "lake")
    envelopes(spark, "2024-06-01-f1", 20).unionByName(envelopes(spark, "2024-06-01-f2", 10)).repartition(3).write.parquet(env_dir)
    IN.ingest_envelopes(spark, MS.read_envelopes(spark, env_dir), {"status": "a long"}, lake)
    IN.ingest_envelopes(spark, MS.read_envelopes(spark, env_dir), {"status": "a long"}, lake)   # nothing to write: no run
    run, = LK.read_runs(spark, lake).collect()
    n, size = LK.written_files(spark, env_dir)
    assert (run["n_files"], run["in_bytes"], run["rows_in"], run["rows_written"]) == (n, size, 30, 30)
    assert (run["out_files"], run["out_bytes"]) == LK.written_files(spark, f"{lake}/status/batch_id={run['batch_id']}")
    assert min(run["read_seconds"], run["transform_seconds"], run["write_seconds"]) > 0
    assert LK.read_runs(spark, lake + "-none").count() == 0


def test_flight_metadata(spark):
    lake = new_output_dir(spark, "lake")
    rows = [("f1", "info", "k", "old", "/a", 0), ("f1", "info", "k", "new", "/a", 1), ("f1", "initial_parameters", "P", "1", "/a", 2), ("f2", "info", None, "x", "/b", 0),
            ("f2", "info", "k", None, "/b", 1)]
    entries = spark.createDataFrame([(m, DAY, n, k, v, s, i) for m, n, k, v, s, i in rows], "mcap_id string, log_date date, name string, key string, value string, source string, row_index long")
    assert LK.write_flight_metadata(spark, entries, lake, batch_id="b1") and not LK.write_flight_metadata(spark, entries, lake, batch_id="b1")
    with pytest.raises(ValueError, match="already ingested"):
        LK.write_flight_metadata(spark, entries, lake)
    got = {r["mcap_id"]: (r["info"], r["initial_parameters"], r["default_parameters"]) for r in LK.read_topic_table(spark, f"{lake}/{LK.FLIGHT_METADATA}").collect()}
    assert got == {"f1": ({"k": "new"}, {"P": "1"}, {}), "f2": ({"k": None}, {}, {})}


# ------------------------------------------------------------------ polyline, conversion

@pytest.mark.parametrize("size", [1, 4, 100])
def test_polyline(spark, size):
    rng = random.Random(size)
    rows = [(f"f{k}", 0 if rng.random() < 0.9 else 1, 1000 - i, i, float(i) if rng.random() < 0.8 else float("nan"), 2.0 * i, -1.0 * i) for k in range(3) for i in range(30)]
    samples = spark.createDataFrame(rows, "mcap_id string, multi_id int, timestamp long, ordinal long, x double, y double, z double").repartition(4)
    want = {}
    for m, multi, ts, i, x, y, z in rows:
        if multi == 0 and x == x:
            want.setdefault(m, []).append((ts, (y, x, -z)))
    got = {}
    for r in TJ.polyline(samples, size).orderBy("mcap_id", "segment").collect():
        line = got.setdefault(r["mcap_id"], [])
        assert r["segment"] * size == len(line) and r["n_points"] == len(r["points"]) <= size and r["first_ts"] == want[r["mcap_id"]][len(line)][0]
        line += [tuple(p) for p in r["points"]]
    assert got == {m: [p for _, p in line] for m, line in want.items()}


def test_topic_messages_by_definition(spark):
    old = [("timestamp", "uint64_t"), ("name[0]", "char"), ("name[1]", "char"), ("esc[0].rpm", "uint16_t"), ("esc[1].rpm", "uint16_t"), ("esc[0].id[0]", "char"),
           ("esc[1].id[0]", "char"), ("esc[0].cur[0]", "float"), ("ok", "bool"), ("c", "char")]
    new = [*old, ("big", "uint64_t")]
    fields = [(m, "t", i, f, k) for m, of in (("f1", old), ("f2", old), ("f3", new)) for i, (f, k) in enumerate(of)]
    data = {"name[0]": ["72", "-61"], "name[1]": ["0", "-87"], "esc[0].rpm": ["1", "65535"], "esc[1].rpm": ["2", "3"], "esc[0].id[0]": ["65", "66"], "esc[1].id[0]": ["67", "0"],
            "esc[0].cur[0]": ["1.5", "2.5"], "ok": ["true", "false"], "c": ["90", "0"], "big": ["18446744073709551615", "7"]}
    samples = [(m, "t", 1, 3, 10, [100, 200], {k: v for k, v in data.items() if m == "f3" or k != "big"}) for m in ("f1", "f2", "f3")]
    f = spark.createDataFrame(fields, "mcap_id string, topic string, ordinal long, field string, type string")
    s = spark.createDataFrame(samples, "mcap_id string, topic_name string, multi_id int, topic_ord int, first long, timestamp array<long>, data map<string, array<string>>")
    assert CV.definitions(f)[0].select("definition").distinct().count() == 2
    got = {(r["mcap_id"], r["row_ord"]): r for r in CV.topic_messages(f, s).collect()}
    base = '{"timestamp":100,"name":"H","esc__rpm":[1,2],"esc__id":["A","C"],"ok":true,"c":"Z"'
    later = '{"timestamp":200,"name":"é","esc__rpm":[65535,3],"esc__id":["B",""],"ok":false,"c":""'
    assert {k: r["payload"] for k, r in got.items()} == {("f1", 10): base + "}", ("f1", 11): later + "}", ("f2", 10): base + "}", ("f2", 11): later + "}",
                                                        ("f3", 10): base + ',"big":-1}', ("f3", 11): later + ',"big":7}'}
    assert {(r["topic"], r["sub_ord"], r["ts_us"]) for r in got.values()} == {("t_1", 3, 100), ("t_1", 3, 200)}
    gap = spark.createDataFrame([("f1", "t", 0, "a[0]", "float"), ("f1", "t", 1, "a[2]", "float")], "mcap_id string, topic string, ordinal long, field string, type string")
    with pytest.raises(ValueError, match=r"a\[1\]"):
        CV.topic_messages(gap, s)
