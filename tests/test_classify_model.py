"""classify_fields against a plain-Python model of the field rules, on random field lists."""

import re

from hypothesis import HealthCheck, given, settings, strategies as st

from flighttables.operators import unflatten as U
from flighttables.functions.types import SOURCE_TO_WIRE, WIRE_TO_TABLE

TYPES = ["uint8_t", "int16_t", "int32_t", "uint64_t", "float", "double", "bool", "char"]
BASES = ["a", "esc", "gps.fix"]
LEAVES = ["rpm", "name", "_padding0", "x.y"]


def model(fields):
    """Expected columns {(base, leaf): (first ordinal, kind, type, outer, inner)} and drop set."""
    cols, drops = {}, set()
    for ordinal, (name, typ) in enumerate(fields):
        m = re.match(r"^(.+?)\[(\d+)\]\.(.+)$", name)
        if m:
            base, idx, leaf = m.group(1), int(m.group(2)), m.group(3)
            if "." in leaf:
                drops.add((ordinal, "nested_deeper"))
                continue
            la = re.match(r"^(.*)\[(\d+)\]$", leaf)
            if la and typ != "char":
                drops.add((ordinal, "numeric_array_in_struct"))
                continue
            key = (base, la.group(1) if la else leaf)
            kind, outer, inner = ("text_array", idx + 1, int(la.group(2)) + 1) if la else ("array", idx + 1, None)
        else:
            fa = re.match(r"^(.*)\[(\d+)\]$", name)
            if fa:
                key, idx = (fa.group(1), None), int(fa.group(2))
                kind = "text" if typ == "char" else "array"
                outer, inner = (None, idx + 1) if typ == "char" else (idx + 1, None)
            else:
                key, kind, outer, inner = (name, None), "scalar", None, None
        if key not in cols:
            cols[key] = [ordinal, kind, typ, outer or 1, inner or 1]
        else:
            c = cols[key]
            c[3] = max(c[3], outer or 1)
            c[4] = max(c[4], inner or 1)
    return cols, drops


name_st = st.one_of(
    st.sampled_from(BASES),
    st.builds(lambda b, i: f"{b}[{i}]", st.sampled_from(BASES), st.integers(0, 3)),
    st.builds(lambda b, i, l: f"{b}[{i}].{l}", st.sampled_from(BASES), st.integers(0, 3), st.sampled_from(LEAVES)),
    st.builds(lambda b, i, l, j: f"{b}[{i}].{l}[{j}]", st.sampled_from(BASES), st.integers(0, 3),
              st.sampled_from(LEAVES), st.integers(0, 3)),
)
# a topic's field list: names unique, and each column key keeps one type (as in a message definition)
fields_st = st.lists(st.tuples(name_st, st.sampled_from(TYPES)), min_size=1, max_size=25,
                     unique_by=lambda t: t[0])


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(fields=fields_st)
def test_classify_matches_model(spark, fields):
    exp_cols, exp_drops = model(fields)
    df = spark.createDataFrame([("t", i, n, ty) for i, (n, ty) in enumerate(fields)],
                               "topic string, ordinal long, field string, type string")
    got = {(r["base"], r["leaf"]): [r["position"], r["kind"], r["source_type"], r["outer_len"], r["inner_len"]]
           for r in U.classify_fields(df).collect()}
    # the model takes the first row of a key by ordinal; the operator too (types break ties only
    # for equal ordinals, which a field list never has)
    assert got == {k: v for k, v in exp_cols.items()}
    got_drops = {(r["ordinal"], r["drop_reason"]) for r in U.dropped_fields(df).collect()}
    assert got_drops == exp_drops
    for r in U.classify_fields(df).collect():
        wire = "string" if r["kind"] in ("text", "text_array") else SOURCE_TO_WIRE[r["source_type"]]
        table = WIRE_TO_TABLE[wire]
        assert r["wire_type"] == wire
        assert r["table_type"] == (f"array<{table}>" if r["kind"] in ("array", "text_array") else table)
