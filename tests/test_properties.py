"""Property checks: ordered window == Window, merge is sorted and conserves rows,
schema evolution is idempotent, topic parse inverts compose."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from flighttables.functions import names as N
from flighttables.operators import merge as MG, schema as SC
from flighttables.operators.ordered import ordered_within
from tests.conftest import rows

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

group_rows = st.lists(st.tuples(st.sampled_from(["a", "b", "hot", "hot", "hot", None]),
                                st.integers(-5, 5), st.one_of(st.none(), st.integers(-3, 3))),
                      min_size=1, max_size=60)


@SETTINGS
@given(data=group_rows, parts=st.integers(1, 6))
def test_ordered_within_equals_window(spark, data, parts):
    df = spark.createDataFrame([(g, t, i, v) for i, (g, t, v) in enumerate(data)],
                               "g string, t int, ord long, v int")
    got = ordered_within(df, ["g"], ["t", "ord"], lag_cols=["v"], lead_cols=["v", "t"], width=parts)
    w = Window.partitionBy("g").orderBy("t", "ord")
    exp = df.select("*", F.row_number().over(w).cast("bigint").alias("seq"), F.lag("v").over(w).alias("prev_v"),
                    F.lead("v").over(w).alias("next_v"), F.lead("t").over(w).alias("next_t"))
    assert sorted(rows(got.select(exp.columns)), key=str) == sorted(rows(exp), key=str)


@SETTINGS
@given(a=st.lists(st.tuples(st.sampled_from(["f1", "f2"]), st.integers(0, 20)), max_size=25),
       b=st.lists(st.tuples(st.sampled_from(["f1", "f3"]), st.integers(0, 20)), max_size=25))
def test_merge_sorted_and_conserving(spark, a, b):
    schema = "mcap_id string, topic string, ts_us long, row_ord long, payload string"
    s1 = spark.createDataFrame([(f, "x_0", t, i, "p") for i, (f, t) in enumerate(a)], schema)
    s2 = spark.createDataFrame([(f, "logged_messages", t, i, "q") for i, (f, t) in enumerate(b)], schema)
    out = rows(MG.merge_streams([s1, s2]), "mcap_id", "seq", "ts_us", "stream", "row_ord")
    assert len(out) == len(a) + len(b)
    for f in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == f), key=lambda r: r[1])
        assert [r[1] for r in mine] == list(range(1, len(mine) + 1))
        keys = [(r[2], r[3], r[4]) for r in mine]
        assert keys == sorted(keys)


def test_evolve_is_idempotent(spark):
    a = spark.createDataFrame([(1, 10, 1.5)], "id long, vbatt int, temp float")
    b = spark.createDataFrame([(2, 2.5, True)], "id long, vbatt double, ok boolean")
    once = SC.evolve_union(spark, "t", [("s1", a), ("s2", b)], keep=["id"])
    twice = SC.evolve_union(spark, "t", [("s0", once)], keep=["id"])
    assert twice.columns == once.columns and sorted(rows(twice)) == sorted(rows(once))


@SETTINGS
@given(names=st.lists(st.text(alphabet="abc_xyz0123456789", min_size=0, max_size=8), min_size=1, max_size=10),
       ids=st.lists(st.integers(0, 255), min_size=1, max_size=10))
def test_parse_compose_identity(spark, names, ids):
    pairs = list(zip(names, ids))
    df = spark.createDataFrame(pairs, "n string, m int").select("n", "m", N.compose_topic("n", "m").alias("t"))
    for n, m, base, mid in rows(df.select("n", "m", N.topic_base("t"), N.topic_multi_id("t"))):
        assert (base, mid) == (n, m)


@SETTINGS
@given(us=st.lists(st.integers(0, 3 * 86400 * 10**6), min_size=1, max_size=30))
def test_format_duration_matches_part_rule(spark, us):
    from flighttables.functions.time import format_duration

    def model(t):
        secs = (t // 10**6) % 60
        return f"{(t // (60 * 10**6)) % 60}m{secs}s" if t > 60 * 10**6 else f"{secs}s"

    df = spark.createDataFrame([(u,) for u in us], "us long").select(
        "us", F.make_dt_interval(secs=F.col("us") / F.lit(10**6)).alias("d"))
    got = [(r["us"], r["t"]) for r in df.select("us", format_duration("d").alias("t")).collect()]
    assert got == [(u, model(u)) for u in us]


@SETTINGS
@given(topics=st.lists(st.text(alphabet="ab_+0129", min_size=0, max_size=9), min_size=1, max_size=30))
def test_topic_split_matches_u8_rule(spark, topics):
    import re

    def model(t):
        if "_" not in t:
            return t, 0
        base, suffix = t.rsplit("_", 1)
        if re.fullmatch(r"\+?[0-9]+", suffix) and int(suffix) <= 255:
            return base, int(suffix)
        return t, 0

    df = spark.createDataFrame([(t,) for t in topics], "t string")
    got = [(r[0], r[1]) for r in df.select(N.topic_base("t"), N.topic_multi_id("t")).collect()]
    assert got == [model(t) for t in topics]


@SETTINGS
@given(us=st.lists(st.integers(-10**15, 10**15), min_size=1, max_size=30),
       stems=st.lists(st.text(alphabet="2024-01x_", min_size=0, max_size=14), min_size=1, max_size=30))
def test_sec_nsec_and_log_id_match_python(spark, us, stems):
    import re
    from flighttables.functions.time import micros_to_sec_nsec
    df = spark.createDataFrame([(u,) for u in us], "us long").select(micros_to_sec_nsec("us").alias("t"))
    assert [(r["t"]["sec"], r["t"]["nsec"]) for r in df.collect()] == \
        [(divmod(u, 10**6)[0], divmod(u, 10**6)[1] * 1000) for u in us]

    def model(s):
        m = re.match(r"[0-9]{4}-[0-9]{2}-[0-9]{2}-(.+)", s)
        return m.group(1) if m else s

    sd = spark.createDataFrame([(s,) for s in stems], "s string")
    assert [r[0] for r in sd.select(N.log_id_from_stem("s")).collect()] == [model(s) for s in stems]


@SETTINGS
@given(logs=st.lists(st.tuples(st.integers(0, 4), st.sampled_from([3, 7, 9])), min_size=1, max_size=40))
def test_tagged_merge_matches_heap_merge(spark, logs):
    import heapq
    from flighttables.operators import logs as LG
    streams = {}
    for ordinal, (ts, tag) in enumerate(logs):                      # dict keeps first-appearance order
        streams.setdefault(tag, []).append((ts, ordinal))
    ordered = [sorted(s, key=lambda x: x[0]) for s in streams.values()]   # stable per tag
    expected = [o for _, o in heapq.merge(*ordered, key=lambda x: x[0])]
    df = spark.createDataFrame([("f", ts, i, tag, "INFO", "m") for i, (ts, tag) in enumerate(logs)],
                               "mcap_id string, ts_us long, ordinal long, tag int, level_name string, message string")
    got = [r["ordinal"] for r in LG.merge_tagged(df).orderBy("seq").collect()]
    assert got == expected


@SETTINGS
@given(samples=st.lists(st.tuples(st.sampled_from(["f", "g"]), st.sampled_from([0, 0, 1]), st.integers(0, 50),
                                  st.sampled_from([1.0, -2.5, float("nan")]), st.sampled_from([0.5, 3.0])),
                        min_size=1, max_size=30))
def test_trajectory_matches_model(spark, samples):
    import math
    from flighttables.operators import trajectory as TJ
    rows_in = [(f, m, ts, i, x, 2.0 * i, z) for i, (f, m, ts, x, z) in enumerate(samples)]
    df = spark.createDataFrame(rows_in, "mcap_id string, multi_id int, timestamp long, ordinal long, "
                                        "x double, y double, z double")
    exp = {}
    for f, m, ts, i, x, y, z in rows_in:      # sample order, whatever the times
        if m == 0 and not any(math.isnan(v) for v in (x, y, z)):
            exp.setdefault(f, []).append((ts, y, x, -z))
    got = {}
    for r in TJ.trajectory_points(df).orderBy("mcap_id", "point_idx").collect():
        got.setdefault(r["mcap_id"], []).append((r["timestamp"], r["x"], r["y"], r["z"]))
    assert got == exp
    summary = {r["mcap_id"]: (r["first_ts"], r["n_points"]) for r in TJ.trajectory_summary(df).collect()}
    assert summary == {f: (pts[0][0], len(pts)) for f, pts in exp.items()}


@SETTINGS
@given(values=st.lists(st.tuples(st.sampled_from(["f", "g"]), st.integers(0, 2)), min_size=1, max_size=30))
def test_state_segments_match_model(spark, values):
    import datetime as dt
    from flighttables.operators import series as SE
    t0 = dt.datetime(2024, 1, 1)
    rows_in = [(f, 0, t0 + dt.timedelta(seconds=i), i, v, 1, False) for i, (f, v) in enumerate(values)]
    df = spark.createDataFrame(rows_in, "mcap_id string, multi_id int, log_time timestamp_ntz, ordinal long, "
                                        "nav_state long, arming_state long, failsafe boolean")
    exp = []
    for f in sorted({r[0] for r in rows_in}):
        mine = [r for r in rows_in if r[0] == f]
        starts = [r for k, r in enumerate(mine) if k == 0 or r[4] != mine[k - 1][4]]
        for k, r in enumerate(starts):
            end = starts[k + 1][2] if k + 1 < len(starts) else None
            exp.append((f, k + 1, str(r[4]), r[2], end))
    got = [(r["mcap_id"], r["segment"], r["value"], r["start_time"], r["end_time"])
           for r in SE.state_transitions(df).where("state = 'nav_state'").orderBy("mcap_id", "segment").collect()]
    assert got == exp


@SETTINGS
@given(batches=st.lists(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                                           st.sampled_from(["int", "bigint", "double", "float", "string", "boolean"])),
                                 min_size=1, max_size=4, unique_by=lambda t: t[0]),
                        min_size=1, max_size=4))
def test_evolution_matches_model(spark, batches):
    widen = {"int": "bigint", "bigint": "bigint", "double": "double", "float": "double", "string": "string",
             "boolean": "boolean"}
    suffix = {"bigint": "i64", "double": "f64", "string": "str", "boolean": "bool"}
    sources = [f"s{k}" for k in range(len(batches))]
    cols = {}
    for src, fields in sorted(zip(sources, batches)):
        for name, typ in fields:
            t = widen[typ]
            col = name if cols.get(name, t) == t else f"{name}__as_{suffix[t]}"
            cols.setdefault(col, t)
    dfs = []
    for src, fields in zip(sources, batches):
        ddl = ", ".join(["id long"] + [f"{n} {t}" for n, t in fields])
        dfs.append((src, spark.createDataFrame([], ddl)))
    out = SC.evolve_union(spark, "t", list(reversed(dfs)), keep=["id"])
    assert [(f.name, f.dataType.simpleString()) for f in out.schema.fields[1:]] == list(cols.items())


@SETTINGS
@given(spec=st.lists(st.tuples(st.sampled_from(["m", "gps.fix", "name"]), st.integers(1, 4)), min_size=1,
                     max_size=3, unique_by=lambda t: t[0]),
       seed=st.integers(0, 10**6))
def test_pack_flat_columns_matches_model(spark, spec, seed):
    import random
    from flighttables.operators import unflatten as U
    rnd = random.Random(seed)
    cols, values = ["ts"], [7]
    for base, n in spec:                       # element columns of each base, in order
        for i in range(n):
            cols.append(f"{base}[{i}]")
            values.append(rnd.choice([0, 104, 105]) if base == "name" else rnd.randint(-5, 5))
    ddl = ", ".join(f"`{c}` int" for c in cols)
    df = spark.createDataFrame([tuple(values)], ddl)
    out = U.pack_flat_columns(df, text_bases=("name",))
    exp_cols, exp_vals = ["ts"], [7]
    for base, n in spec:
        vals = [values[cols.index(f"{base}[{i}]")] for i in range(n)]
        exp_cols.append(base.replace(".", "_"))
        exp_vals.append(bytes(vals).split(b"\x00", 1)[0].decode() if base == "name" else vals)
    assert out.columns == exp_cols
    assert list(out.first()) == exp_vals


@SETTINGS
@given(ds=st.lists(st.tuples(st.sampled_from(["motors", "sensor_baro"]), st.integers(0, 3),
                             st.lists(st.integers(0, 10**6), min_size=0, max_size=6)), min_size=1, max_size=5))
def test_samples_to_rows_matches_model(spark, ds):
    from flighttables.operators import unflatten as U
    data = [(name, mid, ts, [t * 0.5 for t in ts], [-t for t in ts]) for name, mid, ts in ds]
    df = spark.createDataFrame(data, "topic_name string, multi_id int, timestamp array<long>, "
                                     "`control[0]` array<double>, `control[1]` array<long>")
    got = [tuple(r) for r in U.samples_to_rows(df, ["control[0]", "control[1]"]).collect()]
    exp = [(f"{name}_{mid}", t, t * 0.5, -t) for name, mid, ts, _, _ in data for t in ts]
    assert sorted(got) == sorted(exp)


@SETTINGS
@given(n=st.integers(1, 4), leaves=st.lists(st.sampled_from(["rpm", "temp", "x.y"]), min_size=1, max_size=3,
                                              unique=True))
def test_struct_array_packing_matches_model(spark, n, leaves):
    from flighttables.operators import unflatten as U
    cols = [f"esc[{i}].{leaf}" for leaf in leaves for i in range(n)]
    vals = list(range(len(cols)))
    df = spark.createDataFrame([tuple(vals)], ", ".join(f"`{c}` int" for c in cols))
    out = U.pack_struct_array_columns(df)
    expected = {f"esc__{leaf}" for leaf in leaves if "." not in leaf}
    packed = {c: v for c, v in zip(out.columns, out.first())}
    for leaf in leaves:
        if "." in leaf:                                   # deeper than one struct level: left as is
            assert all(f"esc[{i}].{leaf}" in packed for i in range(n))
        else:
            assert packed[f"esc__{leaf}"] == [vals[cols.index(f"esc[{i}].{leaf}")] for i in range(n)]
    assert expected <= set(out.columns)


@SETTINGS
@given(kv=st.lists(st.tuples(st.sampled_from(["f1", "f2", "f3"]), st.sampled_from(["ver_sw", "sys_name", "hw"]),
                             st.integers(0, 99)), min_size=1, max_size=20, unique_by=lambda t: (t[0], t[1])))
def test_metadata_maps_match_model(spark, kv):
    from flighttables.operators import logs as LG
    df = spark.createDataFrame(kv, "mcap_id string, key string, value int")
    got = {r["mcap_id"]: (dict(r["metadata"]), r["ver"])
           for r in LG.metadata_lookup(LG.metadata_maps(df), "ver_sw", "unknown", "ver").collect()}
    exp = {}
    for f, k, v in kv:
        exp.setdefault(f, {})[k] = str(v)
    assert got == {f: (m, m.get("ver_sw", "unknown")) for f, m in exp.items()}
