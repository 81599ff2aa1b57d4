"""Summaries computed from all readings at once, by the definitions of their states."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from gaugemill.functions.timing import AsOf
from gaugemill.operators.states import ENERGY, TEMPERATURE, anomalies


def anomaly_summary(readings: DataFrame, count_type: str = "int") -> DataFrame:
    """Anomalies per machine and month, including months without any."""
    return anomalies(count_type).summarise(readings)


def energy_efficiency(readings: DataFrame) -> DataFrame:
    """Highest and average energy, and average status, per machine."""
    return ENERGY.summarise(readings)


def monthly_temp(readings: DataFrame, months: int = 3, as_of: AsOf = None) -> DataFrame:
    """Average temperature per machine and month over the last months."""
    return replace(TEMPERATURE, months=months).summarise(readings, as_of)
