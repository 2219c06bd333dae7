"""String functions on topic, file and column names.

All are native Column expressions: they run inside whole-stage codegen and need no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._util import as_col

# Name patterns and suffixes of the message and log-file naming scheme.
TOPIC_SUFFIX_RE = r"^(.*)_(\+?[0-9]+)$"          # <base>_<u8 instance>, split at the last '_'
LOG_STEM_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}-(.+)"  # {log_date}-{log_id}
STRUCT_ARRAY_TEST_RE = r"\[[0-9]+\]\."             # `esc[0].rpm` style field names
RAW_SUFFIX = ".ulg"
MESSAGE_SUFFIX = ".mcap"
MULTI_ID_MAX = 255                                  # instance ids are unsigned 8-bit


def topic_base(topic) -> Column:
    """Base topic: the name before the last ``_`` when the suffix is a u8, else the name."""
    t = as_col(topic)
    return F.when(_suffix_id(t).isNotNull(), F.regexp_extract(t, TOPIC_SUFFIX_RE, 1)).otherwise(t)


def topic_multi_id(topic) -> Column:
    """Instance id: the u8 suffix after the last ``_`` (0-255, optional ``+``), else 0."""
    return F.coalesce(_suffix_id(as_col(topic)), F.lit(0))


def _suffix_id(t: Column) -> Column:
    digits = F.regexp_extract(t, TOPIC_SUFFIX_RE, 2)
    # try_cast keeps ANSI mode from failing on over-long digit runs.
    value = F.when(t.rlike(TOPIC_SUFFIX_RE), digits.try_cast("int"))
    return F.when(value.between(0, MULTI_ID_MAX), value)


def compose_topic(name, multi_id) -> Column:
    """Channel name ``{name}_{multi_id}``."""
    return F.concat(as_col(name), F.lit("_"), as_col(multi_id).cast("string"))


def log_id_from_stem(stem) -> Column:
    """Strip a leading ``YYYY-MM-DD-`` from a log file stem; leave other stems unchanged."""
    s = as_col(stem)
    return F.when(s.rlike(LOG_STEM_RE), F.regexp_extract(s, LOG_STEM_RE, 1)).otherwise(s)


def file_name(path) -> Column:
    """Last path segment."""
    return F.element_at(F.split(as_col(path), "/"), -1)


def file_stem(path) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def mcap_id_from_path(path) -> Column:
    """Flight id: the file name with every trailing ``.mcap`` removed."""
    return F.regexp_replace(file_name(path), r"(\.mcap)+$", "")


def log_date_from_name(name) -> Column:
    """Log date from the first 10 characters ``YYYY-MM-DD``; raises on anything else."""
    n = as_col(name)
    head = F.substring(n, 1, 10)
    parsed = F.try_to_date(head, "yyyy-MM-dd")
    return F.when(parsed.isNotNull() & (F.length(n) >= 10), parsed).otherwise(
        F.raise_error(F.concat(F.lit("file name has no valid YYYY-MM-DD prefix: "), n)).cast("date"))


def dest_key(key) -> Column:
    """Output key for a raw log: the ``.ulg`` suffix replaced once by ``.mcap``; raises otherwise."""
    k = as_col(key)
    stem = F.substring(k, F.lit(1), F.length(k) - len(RAW_SUFFIX))
    return F.when(k.endswith(RAW_SUFFIX), F.concat(stem, F.lit(MESSAGE_SUFFIX))).otherwise(
        F.raise_error(F.concat(F.lit("input key does not end with '.ulg': "), k)).cast("string"))


def require_suffix(path, suffix: str) -> Column:
    """The path itself when it ends with ``suffix``; raises otherwise."""
    p = as_col(path)
    return F.when(p.endswith(suffix), p).otherwise(
        F.raise_error(F.concat(F.lit(f"path does not end with '{suffix}': "), p)).cast("string"))


def column_name(base, leaf=None) -> Column:
    """Table column name: struct-array leaves joined by ``__``, dots turned into ``_``."""
    b = as_col(base)
    joined = b if leaf is None else F.concat_ws("__", b, as_col(leaf))
    return F.translate(joined, ".", "_")


def is_struct_array_field(field) -> Column:
    """True for array-of-struct flat names such as ``esc[0].timestamp``."""
    return as_col(field).rlike(STRUCT_ARRAY_TEST_RE)
