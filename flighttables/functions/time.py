"""Time functions (T13-T17): anchoring relative message times to calendar time.

Times are ``TIMESTAMP_NTZ`` values holding UTC wall-clock time, so no result depends on
``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from ._util import as_col

# Fixed values of the time model.
NANOS_PER_MICRO = 1000
MICROS_PER_SECOND = 1_000_000
TIME_SOURCE = "log_date"   # the only time source: midnight of the log's date


def midnight(log_date) -> Column:
    """Start of the log date as ``TIMESTAMP_NTZ``."""
    return as_col(log_date).cast("timestamp_ntz")


def offset_us(time_ns) -> Column:
    """Un-anchored offset in microseconds: integer ``ns / 1000``."""
    return _div(as_col(time_ns).cast("bigint"), NANOS_PER_MICRO)


def _div(c: Column, n: int) -> Column:
    # Integral division truncating toward zero, exact in 64 bits.
    return F.call_function("div", c, F.lit(n).cast("bigint"))


def anchor_time(log_date, time_ns) -> Column:
    """Calendar time: midnight(log_date) + ``time_ns / 1000`` microseconds."""
    return F.timestamp_add("MICROSECOND", offset_us(time_ns), midnight(log_date))


def days_since_epoch(log_date) -> Column:
    """Days since 1970-01-01."""
    return F.unix_date(as_col(log_date))


def micros_to_sec_nsec(us) -> Column:
    """``struct(sec, nsec)`` with floor seconds and the non-negative remainder in nanoseconds."""
    u = as_col(us).cast("bigint")
    rem = F.pmod(u, F.lit(MICROS_PER_SECOND))
    sec = _div(u - rem, MICROS_PER_SECOND)
    return F.struct(sec.alias("sec"), (rem * F.lit(NANOS_PER_MICRO)).alias("nsec"))


def micros_to_nanos(us) -> Column:
    """Message time in nanoseconds from a microsecond sample time."""
    return as_col(us).cast("bigint") * F.lit(NANOS_PER_MICRO)


def format_duration(duration) -> Column:
    """Duration text: ``<m>m<s>s`` above one minute, else ``<s>s``; NULL stays NULL.

    Only the minute and second *parts* print, and the compare is strictly greater than one
    minute, so exactly 60 s prints ``0s`` and hours or days do not show (kept on purpose).
    """
    d = as_col(duration)
    minutes = F.extract(F.lit("MINUTE"), d).cast("string")
    seconds = F.extract(F.lit("SECOND"), d).cast("int").cast("string")
    return F.when(d > F.expr("INTERVAL '1' MINUTE"),
                  F.concat(minutes, F.lit("m"), seconds, F.lit("s"))).otherwise(F.concat(seconds, F.lit("s")))


FORMAT_DURATION_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION format_duration(duration INTERVAL DAY TO SECOND)
RETURNS STRING
RETURN CASE
    WHEN duration > INTERVAL '1' MINUTE
        THEN concat(cast(extract(MINUTE FROM duration) AS STRING), 'm',
                    cast(cast(extract(SECOND FROM duration) AS INT) AS STRING), 's')
    ELSE concat(cast(cast(extract(SECOND FROM duration) AS INT) AS STRING), 's')
END
"""


def register_sql_functions(spark: SparkSession) -> None:
    """Register ``format_duration`` as a SQL function (inlined by the analyzer)."""
    spark.sql(FORMAT_DURATION_SQL)
