"""Time buckets and trailing ranges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugemill.schemas import MONTH_PARTITION

# What a range ends at: nothing (now), a moment, an expression, or a one-row frame.
AsOf = datetime | str | Column | DataFrame | None


def month_start(timestamp: Column) -> Column:
    return F.trunc(timestamp, "month")


def year_month(date: Column) -> Column:
    return F.date_format(date, "yyyyMM")


def latest(readings: DataFrame, partitioned: bool = False) -> DataFrame:
    """One row: the newest timestamp. Stays a plan; nothing is brought to the driver.

    With ``partitioned`` months, as in the readings table, the newest one is looked up first,
    from the files' metadata, and only its times are read. A month is NULL where its timestamp
    is, so that the newest one holds the newest timestamp.
    """
    if partitioned:
        newest = readings.agg(F.max(MONTH_PARTITION).alias("month"))
        # The months of rows from other time zones may begin a day earlier or later.
        first = newest.select(F.trunc(F.date_sub("month", 1), "month").alias("first"))
        readings = readings.where(F.col(MONTH_PARTITION) >= first.scalar())
    return readings.agg(F.max("timestamp").alias("as_of"))


def fixed(as_of: DataFrame) -> str | None:
    """The moment in a one-row frame as text, for a stream that would compute it per batch."""
    (name,) = as_of.columns
    return as_of.select(F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]


def resolved(as_of: AsOf) -> AsOf:
    """A frame's moment as a literal, computed now; anything else as it is."""
    return F.lit(fixed(as_of)).cast("timestamp") if isinstance(as_of, DataFrame) else as_of


def days_before(as_of: AsOf, days: int) -> Column:
    return _before(as_of, F.make_dt_interval(F.lit(days)))


def months_before(as_of: AsOf, months: int) -> Column:
    """Calendar months; the day is clamped to the month's end."""
    return _before(as_of, F.make_ym_interval(F.lit(0), F.lit(months)))


def _before(as_of: AsOf, interval: Column) -> Column:
    if isinstance(as_of, DataFrame):
        # Subtract inside the subquery: a bare scalar can still be pushed into the scan.
        (name,) = as_of.columns
        return as_of.select((as_of[name] - interval).alias("cutoff")).scalar()
    if as_of is None:
        moment = F.current_timestamp()
    elif isinstance(as_of, Column):
        moment = as_of
    else:
        moment = F.lit(as_of).cast("timestamp")
    return moment - interval
