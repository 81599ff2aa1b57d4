"""CSV rows to typed readings, typed readings to documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugemill.functions.labels import FAILURE_CODES, failure_code, label, label_timestamp
from gaugemill.functions.parsing import (
    HUMIDITY_LABEL,
    MACHINE_LABEL,
    parse_timestamp,
    text_to_int,
)
from gaugemill.schemas import CSV_COLUMNS, DOUBLE_COLUMNS, INT_COLUMNS


def type_readings(rows: DataFrame) -> DataFrame:
    """All-text rows to typed readings, in one projection."""
    return rows.select(*(typed_value(name, F.col(name)).alias(name) for name in CSV_COLUMNS))


def typed_value(name: str, text: Column) -> Column:
    """The text of a column as its value."""
    if name == "timestamp":
        return parse_timestamp(text)
    if name in INT_COLUMNS:
        return text_to_int(text)
    if name in DOUBLE_COLUMNS:
        return text.try_cast("double")
    return text


def nest_readings(typed: DataFrame, codes: Mapping[str, int] = FAILURE_CODES) -> DataFrame:
    """Typed readings to documents: labelled text, a nested struct and a failure code."""
    measurements = F.struct(
        "temperature",
        "vibration",
        label(HUMIDITY_LABEL, F.col("humidity")).alias("humidity"),
        "pressure",
        F.col("energy_consumption").alias("energy_use"),
    )
    return typed.select(
        label_timestamp(F.col("timestamp")).alias("timestamp"),
        label(MACHINE_LABEL, F.col("machine_id")).alias("machine_id"),
        measurements.alias("readings"),
        "machine_status",
        "anomaly_flag",
        F.col("predicted_remaining_life").alias("life_remaining"),
        failure_code(F.col("failure_type"), codes).alias("failure_code"),
        "downtime_risk",
        "maintenance_required",
    )


def flatten_documents(documents: DataFrame) -> DataFrame:
    """Documents with the nested measurements as top-level columns."""
    return documents.select(
        *(name for name in documents.columns if name != "readings"), "readings.*"
    )
