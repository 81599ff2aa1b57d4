"""Row filters on cleaned readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugemill.functions.timing import AsOf, days_before, month_start, months_before
from gaugemill.schemas import MONTH_PARTITION


def of_machine(readings: DataFrame, machine_id: int) -> DataFrame:
    return readings.where(F.col("machine_id") == machine_id)


def last_days(readings: DataFrame, days: int, as_of: AsOf = None) -> DataFrame:
    return since(readings, days_before(as_of, days))


def last_months(readings: DataFrame, months: int, as_of: AsOf = None) -> DataFrame:
    return since(readings, months_before(as_of, months))


def since(readings: DataFrame, cutoff: Column) -> DataFrame:
    """Rows at or after ``cutoff``.

    A range on ``timestamp`` does not prune partitions by itself, so the matching range on
    the partition column is added where the frame has one. It starts a day early: the months
    may have been set in another time zone.
    """
    recent = readings.where(F.col("timestamp") >= cutoff)
    if MONTH_PARTITION in readings.columns:
        first_month = month_start(cutoff - F.make_dt_interval(F.lit(1)))
        recent = recent.where(F.col(MONTH_PARTITION) >= first_month)
    return recent
