"""Log records and parameter changes.

Log records come in two streams: untagged (name ``''``) and tagged (name = tag as text).
Tagged records are ordered by time; at equal times the tag seen first in the log wins,
then input order.  Parameter changes split a value into exactly one of ``int_value`` /
``float_value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.levels import remap_level
from ..functions.time import micros_to_sec_nsec
from .ordered import TIME_WIDTH_US, ordered_within

INT_TEXT_RE = r"^[+-]?[0-9]+$"


def log_records(logs: DataFrame, tagged: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Shape raw log rows ``(mcap_id, ts_us, level_name, message[, tag], ordinal)`` into log records.

    Output: ``mcap_id, ts_us, ordinal, <keep>, message, level, name, file, line, ts_sec,
    ts_nsec``; ``file`` and ``line`` default to ``''`` and ``0``.
    """
    name = F.coalesce(F.col("tag").cast("string"), F.lit("")) if tagged else F.lit("")
    t = micros_to_sec_nsec(F.col("ts_us"))
    return logs.select(
        "mcap_id", "ts_us", "ordinal", *keep,
        F.col("message").cast("string").alias("message"),
        remap_level(F.col("level_name")).alias("level"),
        name.alias("name"),
        F.lit("").alias("file"),
        F.lit(0).cast("bigint").alias("line"),
        t["sec"].alias("ts_sec"), t["nsec"].alias("ts_nsec"))


def tag_first_seen(logs: DataFrame) -> DataFrame:
    """Per (flight, tag): the ordinal of the tag's first record (its stream position)."""
    return logs.groupBy("mcap_id", "tag").agg(F.min("ordinal").alias("tag_first"))


def merge_tagged(logs: DataFrame) -> DataFrame:
    """Tagged records of each flight in merge order, with ``seq`` (1-based) per flight."""
    firsts = tag_first_seen(logs).alias("f")
    cond = (F.col("l.mcap_id") == F.col("f.mcap_id")) & F.col("l.tag").eqNullSafe(F.col("f.tag"))
    keyed = logs.alias("l").join(firsts, on=cond, how="inner").select("l.*", "f.tag_first")
    recs = log_records(keyed, tagged=True, keep=("tag_first",))
    return ordered_within(recs, ["mcap_id"], ["ts_us", "tag_first", "ordinal"], seq_col="seq",
                          width=TIME_WIDTH_US).drop("tag_first")


def parameter_changes(params: DataFrame, value_col: str = "value", kind_col: str | None = None) -> DataFrame:
    """Split parameter values: integers -> ``int_value``, everything else -> ``float_value``.

    ``kind_col`` ('int' / other) decides when given; otherwise the value text decides
    (an optional sign and digits only is an integer).  Exactly one branch is set.
    """
    v = F.col(value_col).cast("string")
    is_int = (F.col(kind_col) == "int") if kind_col else v.rlike(INT_TEXT_RE)
    return params.select(
        *[c for c in params.columns if c not in (value_col, kind_col)],
        F.when(is_int, v.cast("bigint")).alias("int_value"),
        F.when(~is_int, v.cast("double")).alias("float_value"))


def with_table_defaults(changes: DataFrame) -> DataFrame:
    """Table-level view of a parameter change: the unset branch reads as its zero value."""
    return changes.withColumns({"int_value": F.coalesce("int_value", F.lit(0).cast("bigint")),
                                "float_value": F.coalesce("float_value", F.lit(0.0))})


def metadata_maps(kv: DataFrame, group_col: str = "mcap_id", key_col: str = "key", value_col: str = "value",
                  ordinal_col: str | None = None) -> DataFrame:
    """One ``map<string,string>`` per log from its metadata key/value rows (keys, values as text).

    A key that a log repeats keeps its last value: the one of the greatest ``ordinal_col``, or without one the
    greatest value.  A collected group is bounded by the keys of a header, not by the data volume.
    """
    value = F.col(value_col).cast("string")
    last = F.max_by(F.struct(value.alias("v")), F.col(ordinal_col)) if ordinal_col else F.max(F.struct(value.alias("v")))
    one = kv.groupBy(group_col, F.col(key_col).cast("string").alias("_key")).agg(last.alias("_last"))
    entry = F.struct(F.col("_key").alias("key"), F.col("_last.v").alias("value"))
    return one.where("_key is not null").groupBy(group_col).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("metadata"))


#: The metadata a log is written with: general information, initial parameters, default parameters.
METADATA_NAMES = ("info", "initial_parameters", "default_parameters")


def named_metadata(kv: DataFrame, group_col: str = "mcap_id", name_col: str = "name", key_col: str = "key",
                   value_col: str = "value", ordinal_col: str | None = None) -> DataFrame:
    """One row per log with the three named metadata maps (empty where the log has no row of a name)."""
    maps = metadata_maps(kv.select(F.struct(group_col, name_col).alias("_g"), key_col, value_col, *([ordinal_col] if ordinal_col else [])),
                         "_g", key_col, value_col, ordinal_col)
    empty = F.create_map().cast("map<string,string>")
    return (maps.groupBy(F.col(f"_g.{group_col}").alias(group_col))
            .agg(*[F.coalesce(F.max_by("metadata", F.when(F.col(f"_g.{name_col}") == n, F.lit(1))), empty).alias(n) for n in METADATA_NAMES]))


def metadata_lookup(maps: DataFrame, key: str, default: str, out: str, map_col: str = "metadata") -> DataFrame:
    """Add ``out`` = ``map[key]`` or ``default`` when the key is missing."""
    return maps.withColumn(out, F.coalesce(F.try_element_at(F.col(map_col), F.lit(key)), F.lit(default)))
