"""Flight trajectory.

Instance 0 of the local-position topic, samples with a NaN (or missing) coordinate
dropped, converted from North-East-Down to East-North-Up, in sample order.  The
trajectory is kept in long form (one row per point with its 1-based index) or as a line of
segments of a bounded number of points, so no flight is ever collected into one array or one
task; the summary row per flight carries the first valid sample time, the point count and the
fixed scene attributes of the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ordered import ordered_within

# Scene attributes of the trajectory line.
SCENE = {
    "entity_id": "trajectory",
    "frame_id": "local_origin",
    "line_type": "LINE_STRIP",
    "thickness": 2.0,
    "scale_invariant": True,
    "color_r": 1.0,
    "color_g": 0.55,
    "color_b": 0.0,
    "color_a": 1.0,
    "lifetime_sec": 0,
    "lifetime_nsec": 0,
    "pose_x": 0.0, "pose_y": 0.0, "pose_z": 0.0,
    "orient_x": 0.0, "orient_y": 0.0, "orient_z": 0.0, "orient_w": 1.0,
}
INSTANCE = 0


def ned_to_enu(x, y, z) -> Column:
    """``(x, y, z)`` North-East-Down -> ``struct(x=y, y=x, z=-z)`` East-North-Up."""
    return F.struct(F.col(y).cast("double").alias("x"), F.col(x).cast("double").alias("y"),
                    (-F.col(z).cast("double")).alias("z"))


def valid_points(samples: DataFrame) -> DataFrame:
    """Instance-0 samples whose x, y and z are all numbers (not NaN, not NULL)."""
    ok = F.lit(True)
    for c in ("x", "y", "z"):
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c))
    return samples.where((F.col("multi_id") == INSTANCE) & ok)


def trajectory_points(samples: DataFrame) -> DataFrame:
    """``(mcap_id, point_idx, timestamp, x, y, z)`` in ENU, ``point_idx`` in sample order (``ordinal``), whatever the times."""
    pts = valid_points(samples).select("mcap_id", "timestamp", "ordinal",
                                       ned_to_enu("x", "y", "z").alias("p"))
    seq = ordered_within(pts, ["mcap_id"], ["ordinal"], seq_col="point_idx")
    return seq.select("mcap_id", "point_idx", "timestamp", "p.x", "p.y", "p.z")


def polyline(samples: DataFrame, size: int = 1_000) -> DataFrame:
    """``(mcap_id, segment, first_ts, n_points, points)``: a flight's line in segments of at most ``size`` points.

    ``points`` are in sample order; the segments of a flight, by their number (from 0), follow each other.  ``first_ts`` is the
    time of a segment's first point.
    """
    pts = trajectory_points(samples).withColumn("segment", F.floor((F.col("point_idx") - 1) / F.lit(size)).cast("bigint"))
    ordered = F.array_sort(F.collect_list(F.struct("point_idx", "timestamp", "x", "y", "z")))
    held = pts.groupBy("mcap_id", "segment").agg(ordered.alias("_p"))
    return held.select("mcap_id", "segment", F.col("_p")[0]["timestamp"].alias("first_ts"), F.size("_p").cast("bigint").alias("n_points"),
                       F.transform("_p", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), p["z"].alias("z"))).alias("points"))


def trajectory_summary(samples: DataFrame) -> DataFrame:
    """One row per flight with valid points: first valid sample time, count, scene constants."""
    pts = valid_points(samples)
    g = pts.groupBy("mcap_id").agg(F.min_by("timestamp", "ordinal").alias("first_ts"), F.count(F.lit(1)).alias("n_points"))
    return g.select("mcap_id", "first_ts", "n_points", *[F.lit(v).alias(k) for k, v in SCENE.items()])
