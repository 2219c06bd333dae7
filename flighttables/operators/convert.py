"""Whole conversion of raw logs to ordered message envelopes.

Inputs, for any number of logs at once:

* ``fields (mcap_id, topic, ordinal, field, type)``: the flat field list of each topic type of each log;
* ``samples (mcap_id, topic_name, multi_id, topic_ord, first, timestamp, data)``: columnar parts of topic datasets. ``timestamp`` is the array of
  sample times, ``data`` has for each other field the array of its values as text, ``first`` is the dataset's position of the part's first
  sample, ``topic_ord`` the dataset's place in its log;
* untagged and tagged log rows, parameter rows, and the samples of the local position (see :mod:`logs` and :mod:`trajectory`).

Field lists that are equal are one *definition*, and those are as many as firmware versions have topics: metadata.  A definition is
classified once, and each of its table columns becomes one expression over a sample's fields; a sample's payload is picked by its
definition, so all topics are read in one scan and one projection.  Messages of all five streams are then merged per flight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.names import compose_topic
from ..functions.text import char_array_to_text
from ..functions.types import widen
from . import logs as LG, trajectory as TJ
from .merge import merge_streams
from .unflatten import CHAR_TYPE, classify_fields, topic_fields

LOG_TOPIC, PARAMETER_TOPIC, TRAJECTORY_TOPIC = "log", "parameter_changes", "trajectory"
TIME_FIELD = "timestamp"
#: Points of one trajectory message.
SEGMENT = 1_000
# Spark types in which the values of the source field types are read.
_READ_AS = {"int8_t": "tinyint", "int16_t": "smallint", "int32_t": "int", "int64_t": "bigint", "uint8_t": "smallint", "uint16_t": "int",
            "uint32_t": "bigint", "uint64_t": "decimal(20,0)", "float": "float", "double": "double", "bool": "boolean", "char": "int"}


def definitions(fields: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(mcap_id, topic, definition)`` of every log's topic types, and the distinct definitions as field rows (``topic`` = definition)."""
    lists = topic_fields(fields).withColumn("definition", F.sha2(F.to_json(F.struct("topic", "fields")), 256))
    used = lists.select("mcap_id", "topic", "definition")
    each = lists.groupBy("definition").agg(F.min("fields").alias("fields"))
    rows = each.select(F.col("definition").alias("topic"), F.posexplode("fields").alias("ordinal", "f"))
    return used, rows.select("topic", F.col("ordinal").cast("bigint").alias("ordinal"), "f.field", "f.type")


def column_values(columns: list, names: set[str], value) -> list[tuple[str, Column]]:
    """``(column name, value)`` of the table columns of one definition, in column order.

    ``columns`` are the classified rows of the definition, ``names`` its fields and ``value(field, source type)`` a field's value.
    An array with a missing element is an error, as such a log cannot be encoded.
    """
    out = []
    for c in sorted(columns, key=lambda r: (r["position"], r["column_name"])):
        base, leaf, kind, typ = c["base"], c["leaf"], c["kind"], c["source_type"]

        def of(name: str, typ=typ) -> Column:
            if name not in names:
                raise ValueError(f"array field {name!r} is missing from its field list")
            return value(name, typ)

        text = lambda prefix, n=c["inner_len"]: char_array_to_text(F.array(*[of(f"{prefix}[{j}]", CHAR_TYPE) for j in range(n)]))
        at = (lambda i, base=base: f"{base}[{i}]") if leaf is None else (lambda i, base=base, leaf=leaf: f"{base}[{i}].{leaf}")
        if kind == "text_array":
            v = F.array(*[text(at(i)) for i in range(c["outer_len"])])
        elif kind == "text":
            v = text(base)
        elif kind == "array":
            v = F.array(*[of(at(i)) for i in range(c["outer_len"])])
        else:
            v = char_array_to_text(F.array(of(base))) if typ == CHAR_TYPE else of(base)
        out.append((c["column_name"], v))
    return out


def _value(field: str, typ: str) -> Column:
    """A field of a sample in its table type (chars as signed numbers)."""
    from pyspark.sql import types as T
    raw = F.col("ts_us").cast("string") if field == TIME_FIELD else F.try_element_at("flat", F.lit(field))
    kind = _READ_AS[typ]
    v = raw.cast(kind)
    return v if typ == CHAR_TYPE else widen(v, T.StructType.fromDDL(f"c {kind}")[0].dataType)


def topic_messages(fields: DataFrame, samples: DataFrame) -> DataFrame:
    """Envelope rows ``(mcap_id, topic, ts_us, sub_ord, row_ord, payload)`` of all topic samples; the payload is the table row as JSON."""
    used, rows = definitions(fields)
    columns: dict[str, list] = {}
    for r in classify_fields(rows).collect():  # a row per column of a definition: metadata
        columns.setdefault(r["topic"], []).append(r)
    names: dict[str, set[str]] = {}
    for r in rows.select("topic", "field").collect():
        names.setdefault(r["topic"], set()).add(r["field"])
    sample = lambda t, i: F.struct(t.cast("bigint").alias("ts_us"), (F.col("first") + i).cast("bigint").alias("row_ord"),
                                   F.transform_values("data", lambda _, v: F.get(v, i)).alias("flat"))
    known = samples.join(used.select("mcap_id", F.col("topic").alias("topic_name"), "definition"), ["mcap_id", "topic_name"])
    flat = known.select("mcap_id", "definition", compose_topic(F.col("topic_name"), F.col("multi_id")).alias("topic"),
                        F.col("topic_ord").alias("sub_ord"), F.inline(F.transform("timestamp", sample)))
    payload = F.lit(None).cast("string")
    for d, of in columns.items():
        struct = F.struct(*[v.alias(n) for n, v in column_values(of, names[d], _value)])
        payload = F.when(F.col("definition") == d, F.to_json(struct, {"ignoreNullFields": "false"})).otherwise(payload)
    return flat.select("mcap_id", "topic", "ts_us", "sub_ord", "row_ord", payload.alias("payload"))


def _as_json(*names: str) -> Column:
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def convert(fields: DataFrame, samples: DataFrame, untagged: DataFrame, tagged: DataFrame, parameters: DataFrame, positions: DataFrame,
            segment: int = SEGMENT) -> DataFrame:
    """All messages of every log in time order, numbered per flight (columns of :func:`merge.merge_streams`).

    Streams, in the order that breaks ties of time: topic samples, untagged logs, tagged logs, parameter changes, trajectory.  The
    trajectory is one message for each ``segment`` points, all at the time of the flight's first valid point.
    """
    log = _as_json("ts_sec", "ts_nsec", "level", "message", "name", "file", "line")
    plain = LG.log_records(untagged).select("mcap_id", F.lit(LOG_TOPIC).alias("topic"), "ts_us", F.col("ordinal").alias("row_ord"), log.alias("payload"))
    marked = LG.merge_tagged(tagged).select("mcap_id", F.lit(LOG_TOPIC).alias("topic"), "ts_us", F.col("seq").alias("row_ord"), log.alias("payload"))
    changes = LG.parameter_changes(parameters)
    changes = changes.select("mcap_id", F.lit(PARAMETER_TOPIC).alias("topic"), F.col("timestamp").alias("ts_us"), F.col("ordinal").alias("row_ord"),
                             F.to_json(F.struct("timestamp", "name", "int_value", "float_value")).alias("payload"))
    first = TJ.trajectory_summary(positions).select("mcap_id", F.col("first_ts").alias("ts_us"))
    lines = TJ.polyline(positions, segment).join(first, "mcap_id")
    track = lines.select("mcap_id", F.lit(TRAJECTORY_TOPIC).alias("topic"), "ts_us", F.col("segment").alias("row_ord"),
                         F.to_json(F.struct(F.transform("points", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), p["z"].alias("z"))).alias("points")))
                         .alias("payload"))
    return merge_streams([topic_messages(fields, samples), plain, marked, changes, track])


def write_messages(spark: SparkSession, messages: DataFrame, path: str) -> DataFrame:
    """Write ordered messages as Parquet, each file a range of (flight, place in the flight) in that order, and read them back.

    :func:`merge.merge_streams` gives them in such ranges, which are written as they lie, without another shuffle.
    """
    messages.sortWithinPartitions("mcap_id", "seq").write.option("compression", "zstd").parquet(path)
    return spark.read.schema(messages.schema).parquet(path)
