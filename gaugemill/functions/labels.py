"""Values to labelled text and codes. NULL stays NULL, except in ``failure_code``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugemill.functions.parsing import DATE_LABEL, TIMESTAMP_FORMAT

# Codes of the failure types; all others, and NULL, are UNKNOWN_FAILURE.
FAILURE_CODES = {"Normal": 0, "Critical": 1}
UNKNOWN_FAILURE = 99


def label(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def label_timestamp(timestamp: Column) -> Column:
    return label(DATE_LABEL, F.date_format(timestamp, TIMESTAMP_FORMAT))


def failure_code(
    failure_type: Column,
    codes: Mapping[str, int] = FAILURE_CODES,
    unknown: int = UNKNOWN_FAILURE,
) -> Column:
    """Case-sensitive code of a failure type."""
    code = F.lit(unknown)
    for name, number in codes.items():
        code = F.when(failure_type == name, number).otherwise(code)
    return code
