"""Documents to cleaned flat readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugemill.functions.parsing import (
    DATE_LABEL,
    HUMIDITY_LABEL,
    machine_number,
    parse_timestamp,
    strip_label,
)
from gaugemill.functions.timing import month_start
from gaugemill.schemas import MONTH_PARTITION, reading_table

_KEPT = (
    "_id",
    "anomaly_flag",
    "downtime_risk",
    "failure_code",
    "machine_status",
    "maintenance_required",
)


def clean_readings(documents: DataFrame, float_type: str = "double") -> DataFrame:
    """Fifteen typed columns per document; every column is cast, whatever was inferred.

    Projections only: no shuffle, and only the struct fields used are read. The month is
    taken from the parsed timestamp in a second step, so that the text is parsed once.
    """
    found = {name: F.col(name) for name in _KEPT}
    found |= {
        "timestamp": parse_timestamp(strip_label(F.col("timestamp"), DATE_LABEL)),
        "machine_id": machine_number(F.col("machine_id")),
        "remaining_life": F.col("life_remaining"),
        "temperature": F.col("readings.temperature"),
        "pressure": F.col("readings.pressure"),
        "vibration": F.col("readings.vibration"),
        "energy_consumption": F.col("readings.energy_use"),
        "humidity": strip_label(F.col("readings.humidity"), HUMIDITY_LABEL),
    }
    schema = reading_table(float_type)
    typed = documents.select(
        *(
            found[field.name].try_cast(field.dataType).alias(field.name)
            for field in schema
            if field.name in found
        )
    )
    return typed.withColumn(MONTH_PARTITION, month_start(F.col("timestamp")))
