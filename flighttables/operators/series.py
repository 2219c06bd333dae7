"""Dashboard series and state transitions.

The series are plain projections of topic tables.  State transitions turn each state
column of ``vehicle_status`` into segments: a segment starts where the value differs from
the previous sample of the same flight and instance, ends where the next segment starts
(NULL for the last one), carries its label and its start relative to the flight's first
sample.  Previous / next values come from the skew-safe ``ordered_within``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.levels import enum_label
from .ordered import ordered_within

# State labels of the dashboard's state panel.
NAV_STATE_LABELS = {0: "MANUAL", 1: "ALTCTL", 2: "POSCTL", 3: "AUTO_MISSION", 4: "AUTO_LOITER", 5: "AUTO_RTL"}
ARMING_STATE_LABELS = {1: "Disarmed", 2: "Armed"}
FAILSAFE_LABELS = {"false": "False", "true": "True"}
LOW_VOLTAGE_PER_CELL = 3.3


def xy_series(local_position: DataFrame, instance: int = 0) -> DataFrame:
    """X-Y position of one instance."""
    return local_position.where(F.col("multi_id") == instance).select("mcap_id", "log_time", "x", "y")


def height_series(estimator_position: DataFrame, instance: int = 0) -> DataFrame:
    """Height ``-z`` of one instance."""
    return estimator_position.where(F.col("multi_id") == instance).select(
        "mcap_id", "log_time", (-F.col("z")).alias("height"))


def velocity_series(local_position: DataFrame, instance: int = 0) -> DataFrame:
    """Directional series as defined by the dashboard: z = -vz, y = position y (sic), x = vx."""
    return local_position.where(F.col("multi_id") == instance).select(
        "mcap_id", "log_time", (-F.col("vz")).alias("z"), F.col("y").alias("y"), F.col("vx").alias("x"))


def battery_series(battery_status: DataFrame, instance: int = 0) -> DataFrame:
    """Voltage, remaining, current and the low-voltage line ``cell_count * 3.3``."""
    return battery_status.where(F.col("multi_id") == instance).select(
        "mcap_id", "log_time", "voltage_v", "remaining", "current_a",
        (F.col("cell_count") * F.lit(LOW_VOLTAGE_PER_CELL)).alias("low_voltage_v"))


STATES = ("nav_state", "arming_state", "failsafe")


def _labelled(state: str, value):
    if state == "failsafe":
        text = F.lower(value.cast("string"))
        return text, enum_label(text, FAILSAFE_LABELS)
    return value.cast("string"), enum_label(value, NAV_STATE_LABELS if state == "nav_state" else ARMING_STATE_LABELS)


def state_transitions(vehicle_status: DataFrame) -> DataFrame:
    """Segments ``(mcap_id, multi_id, state, segment, value, label, start_time, end_time, rel_start_us)``.

    ``rel_start_us`` is the segment start in microseconds after the flight's first sample.  One ordered pass over the
    samples looks back at all three states; only changes are expanded to a row per state and numbered.
    """
    samples = vehicle_status.select("mcap_id", "multi_id", "log_time", "ordinal", *STATES)
    with_prev = ordered_within(samples, ["mcap_id", "multi_id"], ["log_time", "ordinal"], seq_col="sample_seq",
                               lag_cols=list(STATES))
    changed = []
    for s in STATES:
        value, label = _labelled(s, F.col(s))
        before, _ = _labelled(s, F.col(f"prev_{s}"))
        new = (F.col("sample_seq") == 1) | ~value.eqNullSafe(before)
        changed.append(F.when(new, F.struct(F.lit(s).alias("state"), value.alias("value"), label.alias("label"))))
    rows = with_prev.select("mcap_id", "multi_id", "log_time", "ordinal", F.inline(F.array_compact(F.array(*changed))))
    keys = ["mcap_id", "multi_id", "state"]
    seg = ordered_within(rows, keys, ["log_time", "ordinal"], seq_col="segment", lead_cols=["log_time"])
    # A plain partial aggregate over the samples; deriving it from the changes would repeat the ordered pass.
    starts = vehicle_status.groupBy("mcap_id", "multi_id").agg(F.min("log_time").alias("_t0"))
    return (seg.join(starts, on=["mcap_id", "multi_id"], how="inner")
            .select(*keys, "segment", "value", "label", F.col("log_time").alias("start_time"),
                    F.col("next_log_time").alias("end_time"),
                    F.timestamp_diff("MICROSECOND", F.col("_t0"), F.col("log_time")).alias("rel_start_us")))
