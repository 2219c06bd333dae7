"""Log level and enum label functions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from ._util import as_col

# Autopilot log level names -> viewer log level (lake value is the enum name).
LEVEL_REMAP = {
    "EMERGENCY": "FATAL",
    "ALERT": "FATAL",
    "CRITICAL": "FATAL",
    "ERROR": "ERROR",
    "WARNING": "WARNING",
    "NOTICE": "INFO",
    "INFO": "INFO",
    "DEBUG": "DEBUG",
}
UNKNOWN_LEVEL = "UNKNOWN"

# Viewer log level enum numbers (UNKNOWN=0 ... FATAL=5).
LEVEL_RANK = {"UNKNOWN": 0, "DEBUG": 1, "INFO": 2, "WARNING": 3, "ERROR": 4, "FATAL": 5}

# The minimum level shown by the dashboard's log panel.
MIN_PANEL_LEVEL = 1


def _literal_map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def remap_level(level_name) -> Column:
    """Source level name -> lake level name; anything unknown -> ``UNKNOWN``."""
    return F.coalesce(F.try_element_at(_literal_map(LEVEL_REMAP), as_col(level_name)), F.lit(UNKNOWN_LEVEL))


def level_rank(level) -> Column:
    """Numeric rank of a lake level name (unknown names rank 0)."""
    return F.coalesce(F.try_element_at(_literal_map(LEVEL_RANK), as_col(level)), F.lit(0))


def at_least_level(level, minimum: int = MIN_PANEL_LEVEL) -> Column:
    """Predicate: level rank >= ``minimum`` (the log panel's filter)."""
    return level_rank(level) >= F.lit(minimum)


def enum_label(number, labels: dict) -> Column:
    """Enum number -> label from ``labels``; unlisted numbers -> ``UNKNOWN_<n>``."""
    n = as_col(number)
    return F.coalesce(F.try_element_at(_literal_map(labels), n),
                      F.concat(F.lit("UNKNOWN_"), n.cast("string")))
