"""Log catalog selection (F1-F6, F12, W1, O1, O2, J2, U3, A13) and skip-existing.

The selection is one lazy DataFrame chain whose filter order is part of the semantics:
type / rating / uuid / id / names first, then latest-per-vehicle, then source and
firmware hash.  Newest first with ties in input order, then the optional top-k, then the
anti-join with already held ids (after the limit, so k = 25 with 10 held yields 15).

Scale notes:
* latest-per-vehicle is ``min(struct(-date, ordinal, row))`` per uuid: a partial
  aggregate, so one vehicle holding a third of the catalog is reduced map-side instead of
  being sorted in one window task.
* the held-id anti-join is a plain join: AQE broadcasts the held ids only when their
  measured size is under the broadcast threshold, and shuffles both sides otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ..functions.names import dest_key, file_stem, log_id_from_stem, require_suffix

CATALOG_COLUMNS = ["log_id", "log_date", "mav_type", "rating", "vehicle_uuid", "vehicle_name",
                   "airframe_name", "airframe_type", "source", "ver_sw"]
# Catalog records as JSON text (dates as YYYY-MM-DD strings): read with this schema, no inference pass.
CATALOG_JSON_SCHEMA = ", ".join(f"{c} string" for c in CATALOG_COLUMNS)


@dataclass
class CatalogQuery:
    """Selection parameters; ``None`` / empty means the filter is not applied."""
    mav_type: list[str] | None = None
    rating: list[str] | None = None
    uuid: list[str] | None = None
    log_id: list[str] | None = None
    vehicle_name: str | None = None
    airframe_name: str | None = None
    airframe_type: str | None = None
    latest_per_vehicle: bool = False
    source: str | None = None
    git_hash: str | None = None
    max_num: int = 0
    overwrite: bool = False
    skip_if_cached: int = 0
    print_entries: bool = False
    extra: dict = field(default_factory=dict)


def filter_catalog(catalog: DataFrame, q: CatalogQuery, ordinal: str = "ordinal") -> DataFrame:
    """Apply the catalog filters in their fixed order (no sort, no limit)."""
    df = catalog
    if q.mav_type is not None:
        df = df.where(F.lower("mav_type").isin([v.lower() for v in q.mav_type]))
    if q.rating is not None:
        df = df.where(F.lower("rating").isin([v.lower() for v in q.rating]))
    if q.uuid is not None:
        df = df.where(F.col("vehicle_uuid").isin(list(q.uuid)))
    if q.log_id is not None:
        wanted = [v.replace("-", "") for v in q.log_id]
        df = df.where(F.regexp_replace("log_id", "-", "").isin(wanted))
    if q.vehicle_name is not None:
        df = df.where(F.col("vehicle_name") == F.lit(q.vehicle_name))
    if q.airframe_name is not None:
        df = df.where(F.col("airframe_name") == F.lit(q.airframe_name))
    if q.airframe_type is not None:
        df = df.where(F.col("airframe_type") == F.lit(q.airframe_type))
    if q.latest_per_vehicle:
        df = latest_per_vehicle(df, ordinal)
    if q.source is not None:
        df = df.where(F.col("source") == F.lit(q.source))
    if q.git_hash is not None:
        df = df.where(F.col("ver_sw") == F.lit(q.git_hash))
    return df


def latest_per_vehicle(catalog: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """One row per vehicle: the latest ``log_date``, ties to the first row in input order.

    Rows without a vehicle uuid are dropped.  Written as a partial aggregate over a struct
    whose first two fields order the candidates, so the per-vehicle reduction happens in
    every map task (skew-safe), then the struct is unpacked back into the row.
    """
    cols = catalog.columns
    rank_key = F.struct((-F.unix_date(F.col("log_date"))).alias("_neg_day"), F.col(ordinal).alias("_ord"),
                        *[F.col(c) for c in cols])
    best = (catalog.where(F.col("vehicle_uuid").isNotNull())
            .groupBy("vehicle_uuid")
            .agg(F.min(rank_key).alias("_best")))
    return best.select(*[F.col(f"_best.{c}").alias(c) for c in cols])


def newest_first(df: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Sort by ``log_date`` descending; equal dates keep input order (stable)."""
    return df.orderBy(F.col("log_date").desc(), F.col(ordinal).asc())


def top_k(df: DataFrame, k: int, ordinal: str = "ordinal") -> DataFrame:
    """Newest ``k`` rows when ``k > 0``; all rows (sorted) otherwise."""
    ordered = newest_first(df, ordinal)
    return ordered.limit(k) if k > 0 else ordered


def held_ids_from_files(files: DataFrame, path_col: str = "path") -> DataFrame:
    """Distinct log ids of held raw logs: file stem minus its ``YYYY-MM-DD-`` prefix."""
    return files.select(log_id_from_stem(file_stem(F.col(path_col))).alias("log_id")).distinct()


def skip_gate(held_count: int, q: CatalogQuery) -> bool:
    """True when enough logs are already held and nothing should be selected."""
    return q.skip_if_cached > 0 and not q.overwrite and not q.print_entries and held_count >= q.skip_if_cached


def select_logs(catalog: DataFrame, q: CatalogQuery, ordinal: str = "ordinal") -> DataFrame:
    """Filtered, newest-first, optionally top-k selection."""
    return top_k(filter_catalog(catalog, q, ordinal), q.max_num, ordinal)


def new_logs(selected: DataFrame, held_ids: DataFrame, q: CatalogQuery) -> DataFrame:
    """Selected logs minus already held ids (exact id compare); ``overwrite`` keeps all."""
    if q.overwrite:
        return selected
    return selected.join(held_ids.select("log_id").distinct(), on="log_id", how="left_anti")


def selection_outcomes(selected: DataFrame, held_ids: DataFrame, q: CatalogQuery) -> DataFrame:
    """Counts of selected logs that will be fetched vs skipped as already held."""
    held = held_ids.select("log_id").distinct().withColumn("_held", F.lit(True))
    marked = selected.join(held, on="log_id", how="left")
    is_skip = F.col("_held").isNotNull() & F.lit(not q.overwrite)
    return (marked.groupBy(F.when(is_skip, F.lit("skipped")).otherwise(F.lit("selected")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n")))


def pending_conversions(sources: DataFrame, existing: DataFrame, overwrite: bool = False,
                        key_col: str = "key") -> DataFrame:
    """Raw-log keys still to convert: ``(key, dest_key)`` minus existing outputs.

    Keys must end with ``.ulg`` (checked, raises otherwise); the output key replaces it by
    ``.mcap``.  ``overwrite`` bypasses the existence anti-join.
    """
    pending = sources.select(require_suffix(F.col(key_col), ".ulg").alias("key"),
                             dest_key(F.col(key_col)).alias("dest_key"))
    if overwrite:
        return pending
    return (pending.join(existing.select(F.col("dest_key")).distinct(), on="dest_key", how="left_anti")
            .select("key", "dest_key"))
