"""Unflattening samples.

Raw logs describe each topic by a flat field list (``control[0]``, ``esc[1].rpm``,
``name[3]`` of type char ...) and store samples column-wise.  These operators

* turn a columnar topic dataset into one row per sample (``samples_to_rows``),
* list a topic's fields in order (``topic_fields``) and keep one schema per type,
* classify flat fields into table columns: scalars, arrays, texts, arrays of texts,
  and drops with reasons (``classify_fields`` / ``dropped_fields``),
* pack flat columns into arrays, struct-array leaves into ``base__leaf`` arrays.

Everything is row-local or a group-by over one topic's field list (bounded by the message
definition), so nothing grows with the number of samples except narrow projections.
"""

from __future__ import annotations

import re
from collections import OrderedDict

from pyspark.sql import DataFrame, functions as F

from ..functions.names import column_name, compose_topic
from ..functions.text import char_array_to_text
from ..functions.types import SOURCE_TO_WIRE, table_type, wire_type

# Flat field name patterns.
ARRAY_RE = r"^(.*)\[([0-9]+)\]$"                     # base[idx]
STRUCT_LEAF_RE = r"^(.+?)\[([0-9]+)\]\.(.+)$"         # base[idx].leaf (shortest base)
CHAR_TYPE = "char"
PADDING_MARK = "padding"


def _q(name: str):
    return F.col(f"`{name}`")


# ------------------------------------------------------------------ samples -> rows

def samples_to_rows(datasets: DataFrame, field_cols: list[str], name_col: str = "topic_name",
                    multi_col: str = "multi_id", time_col: str = "timestamp") -> DataFrame:
    """One row per sample: ``(topic, timestamp, <fields>)``; row count = length of ``time_col``.

    Field names pass through unchanged (``control[0]`` stays a column of that name).
    """
    elem = lambda t, i: F.struct(t.alias(time_col), *[_q(f)[i].alias(f) for f in field_cols])
    return datasets.select(compose_topic(F.col(name_col), F.col(multi_col)).alias("topic"),
                           F.inline(F.transform(F.col(time_col), elem)))


# ------------------------------------------------------------------ field inventory

def _per_log(df: DataFrame) -> list[str]:
    """The key of the log, where the rows tell it: topics of different logs have nothing to do with each other."""
    return ["mcap_id"] if "mcap_id" in df.columns else []


def topic_fields(fields: DataFrame) -> DataFrame:
    """``([mcap_id,] topic) -> [(field, type)]`` in declaration order (a list is bounded by one message definition).

    Declaration order is ``(ordinal, field, type)``; equal ordinals break by name, then type.  Rows are dealt by topic before
    they are collected: lists collected on both sides of a shuffle are sorted in either, and those before it spill.
    """
    ordered = F.array_sort(F.collect_list(F.struct("ordinal", "field", "type")))
    keys = [*_per_log(fields), "topic"]
    return (fields.select(*keys, "ordinal", "field", "type").repartition(*keys).groupBy(*keys).agg(ordered.alias("_f"))
            .select(*keys, F.transform("_f", lambda x: F.struct(x["field"].alias("field"),
                                                                  x["type"].alias("type"))).alias("fields")))


def schema_registry(channels: DataFrame, type_col: str = "type_name", topic_col: str = "topic") -> DataFrame:
    """One schema per type shared by all its instances: first channel by ordinal, instance count.

    A hash pre-aggregate per (type, channel) runs over all rows; the final step sees one
    row per channel.
    """
    log = _per_log(channels)
    per_channel = channels.groupBy(*log, type_col, topic_col).agg(F.min("ordinal").alias("_first"))
    return (per_channel.groupBy(*log, type_col)
            .agg(F.min_by(F.col(topic_col), F.col("_first")).alias("first_topic"),
                 F.min("_first").alias("first_ordinal"),
                 F.count(F.lit(1)).alias("n_instances")))


# ------------------------------------------------------------------ field classification

def _classified_rows(fields: DataFrame) -> DataFrame:
    """Per flat field row: its column key (base, leaf), kind, length candidates, drop reason."""
    name, typ = F.col("field"), F.col("type")
    is_struct = name.rlike(STRUCT_LEAF_RE)
    s_base = F.regexp_extract(name, STRUCT_LEAF_RE, 1)
    s_idx = F.regexp_extract(name, STRUCT_LEAF_RE, 2).cast("int")
    s_leaf = F.regexp_extract(name, STRUCT_LEAF_RE, 3)
    leaf_is_array = s_leaf.rlike(ARRAY_RE)
    leaf_base = F.regexp_extract(s_leaf, ARRAY_RE, 1)
    leaf_idx = F.regexp_extract(s_leaf, ARRAY_RE, 2).cast("int")
    is_flat = ~is_struct & name.rlike(ARRAY_RE)
    f_base = F.regexp_extract(name, ARRAY_RE, 1)
    f_idx = F.regexp_extract(name, ARRAY_RE, 2).cast("int")
    is_char = typ == CHAR_TYPE

    drop = (F.when(is_struct & s_leaf.contains("."), F.lit("nested_deeper"))
            .when(is_struct & leaf_is_array & ~is_char, F.lit("numeric_array_in_struct")))
    warn = F.when(drop == "numeric_array_in_struct", ~s_leaf.contains(PADDING_MARK)).when(drop.isNotNull(), True)
    base = F.when(is_struct, s_base).when(is_flat, f_base).otherwise(name)
    leaf = F.when(is_struct, F.when(leaf_is_array, leaf_base).otherwise(s_leaf))
    kind = (F.when(is_struct & leaf_is_array, F.lit("text_array"))
            .when(is_struct, F.lit("array"))
            .when(is_flat & is_char, F.lit("text"))
            .when(is_flat, F.lit("array"))
            .otherwise(F.lit("scalar")))
    outer = F.when(is_struct, s_idx + 1).when(is_flat & ~is_char, f_idx + 1)
    inner = F.when(is_struct & leaf_is_array, leaf_idx + 1).when(is_flat & is_char, f_idx + 1)
    return fields.select(*_per_log(fields), "topic", "ordinal", "field", "type", base.alias("base"), leaf.alias("leaf"),
                         kind.alias("row_kind"), outer.alias("outer_cand"), inner.alias("inner_cand"),
                         drop.alias("drop_reason"), warn.alias("warn"))


KINDS = ["scalar", "array", "text", "text_array"]
_TYPE_CODES = list(SOURCE_TO_WIRE)          # source type names in their fixed order
_UNKNOWN_TYPE = 31


def _code(values: list[str], c, unknown: int):
    m = F.create_map(*[x for i, v in enumerate(values) for x in (F.lit(v), F.lit(i))])
    return F.coalesce(F.try_element_at(m, c), F.lit(unknown)).cast("bigint")


def _decode(values: list[str], code):
    return F.try_element_at(F.array(*[F.lit(v) for v in values]), (code + 1).cast("int"))


def classify_fields(fields: DataFrame) -> DataFrame:
    """Table columns of each topic from its flat field list ``(topic, ordinal, field, type)``.

    The first field of a column decides its kind and type (equal ordinals break by type,
    then kind).  The choice is packed into one bigint — ``ordinal * 256 + type * 8 + kind``
    — so the whole roll-up is a hash aggregate with a fixed-width buffer.
    Output per column: ``topic, position`` (first field ordinal, i.e. column order),
    ``column_name, base, leaf, kind`` (scalar / array / text / text_array),
    ``source_type, wire_type, table_type, outer_len, inner_len``.
    """
    # Dropped rows stay in the scan and are masked inside the aggregates: filtering first
    # would be pushed below the classifying projection and evaluate every pattern twice.
    rows = _classified_rows(fields)
    kept = F.col("drop_reason").isNull()
    packed = (F.col("ordinal").cast("bigint") * 256 + _code(_TYPE_CODES, F.col("type"), _UNKNOWN_TYPE) * 8
              + _code(KINDS, F.col("row_kind"), 7))
    log = _per_log(fields)
    g = (rows.groupBy(*log, "topic", "base", "leaf")
         .agg(F.min(F.when(kept, packed)).alias("_first"),
              F.coalesce(F.max(F.when(kept, F.col("outer_cand"))), F.lit(1)).alias("outer_len"),
              F.coalesce(F.max(F.when(kept, F.col("inner_cand"))), F.lit(1)).alias("inner_len"))
         .where(F.col("_first").isNotNull()))
    first = F.col("_first")
    kind = _decode(KINDS, first % 8)
    source_type = _decode(_TYPE_CODES, F.floor(first / 8) % 32)
    wire = F.when(kind.isin("text", "text_array"), F.lit("string")).otherwise(wire_type(source_type))
    scalar_table = table_type(wire)
    table = F.when(kind.isin("array", "text_array"), F.concat(F.lit("array<"), scalar_table, F.lit(">"))) \
             .otherwise(scalar_table)
    return g.select(*log, "topic", F.floor(first / 256).cast("bigint").alias("position"),
                    column_name(F.col("base"), F.col("leaf")).alias("column_name"),
                    "base", "leaf", kind.alias("kind"), source_type.alias("source_type"),
                    wire.alias("wire_type"), table.alias("table_type"), "outer_len", "inner_len")


def dropped_fields(fields: DataFrame) -> DataFrame:
    """Flat fields that get no column, with the reason and whether a warning is due."""
    rows = _classified_rows(fields).where(F.col("drop_reason").isNotNull())
    return rows.select(*_per_log(fields), "topic", "ordinal", "field", "type", "drop_reason", "warn")


# ------------------------------------------------------------------ packing flat columns

def _flat_groups(columns: list[str]):
    flat, struct = OrderedDict(), OrderedDict()
    for c in columns:
        m = re.match(STRUCT_LEAF_RE, c)
        if m and "." not in m.group(3) and not re.match(ARRAY_RE, m.group(3)):
            struct.setdefault((m.group(1), m.group(3)), {})[int(m.group(2))] = c
            continue
        m = re.match(ARRAY_RE, c)
        if m and not re.search(r"\[[0-9]+\]\.", c):
            flat.setdefault(m.group(1), {})[int(m.group(2))] = c
    return flat, struct


def _array_of(by_idx: dict, text: bool):
    n = max(by_idx) + 1
    missing = [i for i in range(n) if i not in by_idx]
    if missing:
        raise ValueError(f"flat array is missing elements {missing}: {sorted(by_idx.values())}")
    cols = [_q(by_idx[i]) for i in range(n)]
    return char_array_to_text(F.array(*cols)) if text else F.array(*cols)


def pack_flat_columns(df: DataFrame, text_bases: tuple[str, ...] = ()) -> DataFrame:
    """Replace flat ``base[i]`` columns by one array column ``base`` (n = max index + 1).

    ``text_bases`` are char arrays and become one string (NUL-cut, UTF-8).  The new column
    takes the place of the first flat column of its base; other columns keep their order.
    """
    flat, _ = _flat_groups(df.columns)
    placed, out = set(), []
    for c in df.columns:
        m = re.match(ARRAY_RE, c)
        if m and m.group(1) in flat and not re.search(r"\[[0-9]+\]\.", c):
            b = m.group(1)
            if b not in placed:
                placed.add(b)
                out.append(_array_of(flat[b], b in text_bases).alias(b.replace(".", "_")))
            continue
        out.append(_q(c))
    return df.select(*out)


def pack_struct_array_columns(df: DataFrame) -> DataFrame:
    """Replace flat ``base[i].leaf`` columns by array columns ``base__leaf`` (dots -> ``_``)."""
    _, struct = _flat_groups(df.columns)
    placed, out = set(), []
    for c in df.columns:
        m = re.match(STRUCT_LEAF_RE, c)
        if m and (m.group(1), m.group(3)) in struct:
            key = (m.group(1), m.group(3))
            if key not in placed:
                placed.add(key)
                out.append(_array_of(struct[key], False).alias(f"{key[0]}__{key[1]}".replace(".", "_")))
            continue
        out.append(_q(c))
    return df.select(*out)


def pack_topic(df: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
    """Table rows of one topic from its flat sample columns, by its field list ``(field, source type)``.

    Scalars stay, ``base[i]`` becomes an array (of char: a text), ``base[i].leaf`` the array ``base__leaf``, and
    ``base[i].leaf[j]`` of char an array of texts.  Fields that no table column can hold (numeric arrays inside a struct,
    deeper nesting) are left out of the rows.  A column stands where its first field stands; columns that are no fields
    (keys) come first.  An array with a missing element is an error.
    """
    types = dict(fields)
    parts: OrderedDict[tuple, dict] = OrderedDict()
    for name, kind in fields:
        struct, flat = re.match(STRUCT_LEAF_RE, name), re.match(ARRAY_RE, name)
        if struct:
            base, index, leaf = struct.group(1), int(struct.group(2)), struct.group(3)
            inner = re.match(ARRAY_RE, leaf)
            if "." in leaf or (inner and kind != CHAR_TYPE):
                continue
            if inner:
                parts.setdefault(("texts", f"{base}__{inner.group(1)}"), {}).setdefault(index, {})[int(inner.group(2))] = name
            else:
                parts.setdefault(("array", f"{base}__{leaf}"), {})[index] = name
        elif flat:
            parts.setdefault(("text" if kind == CHAR_TYPE else "array", flat.group(1)), {})[int(flat.group(2))] = name
        else:
            parts[("scalar", name)] = {0: name}
    out = [_q(c) for c in df.columns if c not in types]
    for (kind, name), of in parts.items():
        if kind == "scalar":
            value = _q(of[0])
        elif kind == "texts":
            missing = [i for i in range(max(of) + 1) if i not in of]
            if missing:
                raise ValueError(f"array of texts {name} is missing elements {missing}")
            value = F.array(*[_array_of(of[i], True) for i in sorted(of)])
        else:
            value = _array_of(of, kind == "text")
        out.append(value.alias(name.replace(".", "_")))
    return df.select(*out)


def transpose_struct_array(df: DataFrame, col: str) -> DataFrame:
    """``array<struct<a, b>>`` column -> one array column per leaf, named ``<col>__<leaf>``."""
    leaves = df.schema[col].dataType.elementType.fieldNames()
    keep = [c for c in df.columns if c != col]
    return df.select(*[_q(c) for c in keep],
                     *[F.col(col)[leaf].alias(f"{col}__{leaf}".replace(".", "_")) for leaf in leaves])
