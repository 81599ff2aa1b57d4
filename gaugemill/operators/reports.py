"""The three analytical reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugemill.functions.timing import AsOf
from gaugemill.operators.filters import last_days, of_machine


# The machine and the days of the report.
MACHINE, DAYS = 39, 45


def daily_averages(
    readings: DataFrame, machine_id: int = MACHINE, days: int = DAYS, as_of: AsOf = None
) -> DataFrame:
    """Average temperature and vibration per day of one machine, by day."""
    return (
        last_days(of_machine(readings, machine_id), days, as_of)
        .groupBy(F.to_date("timestamp").alias("day"))
        .agg(F.avg("temperature").alias("avg_temp"), F.avg("vibration").alias("avg_vib"))
        .orderBy("day")
    )


def high_risk(readings: DataFrame, remaining_life: int = 50) -> DataFrame:
    """Anomalous readings of machines near the end of their life."""
    return readings.where(
        (F.col("remaining_life") < remaining_life) & F.col("anomaly_flag")
    ).select("machine_id", "remaining_life", "machine_status", "anomaly_flag")


def needs_maintenance(readings: DataFrame) -> DataFrame:
    return readings.where(F.col("maintenance_required")).select(
        "machine_id", "machine_status", "maintenance_required"
    )


def all_reports(as_of: AsOf = None) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """The reports by name; each takes the readings and is run by the caller."""
    return {
        "daily_averages": lambda readings: daily_averages(readings, as_of=as_of),
        "high_risk": high_risk,
        "needs_maintenance": needs_maintenance,
    }


def preview(frame: DataFrame, rows: int = 20) -> None:
    """Print the schema and the first rows, untruncated."""
    frame.printSchema()
    frame.show(rows, truncate=False)
