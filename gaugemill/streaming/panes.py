"""Trailing ranges from states by day.

States of a month can't give up the days that leave a trailing range. States by day can: the
range is a cutoff, the days after it are merged from their states, and of the cutoff's own day
the readings from that moment on are read, a day of the readings table. The result is that of all
readings at once, for any moment, and later moments need no new states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugemill.functions.timing import AsOf, month_start, months_before
from gaugemill.operators.states import EXACT_TEMPERATURE
from gaugemill.plans.tables import SummaryTable
from gaugemill.schemas import MONTH_PARTITION


def trailing_temperature(
    readings: DataFrame, table: SummaryTable, database: str, as_of: AsOf = None, months: int = 3
) -> DataFrame:
    """Average temperature per machine and month over the last months before a moment.

    ``table`` holds states by day of all of ``readings``, which are months as partitions.
    """
    cutoff = months_before(as_of, months)
    day, month = F.to_date(cutoff), F.to_date(month_start(cutoff))
    states = table.live_states(readings.sparkSession, database)
    later = states.where((F.col("month") >= month) & (F.col("day") > day))
    # Months of rows from other time zones may begin a day earlier or later.
    near = F.col(MONTH_PARTITION).between(F.add_months(month, -1), F.add_months(month, 1))
    edge = readings.where(
        near & (F.col("timestamp") >= cutoff) & (F.to_date("timestamp") == day)
    )
    of_edge = table.summary.to_states(table.summary.select_inputs(edge))
    kept = [field.name for field in EXACT_TEMPERATURE.schema]
    merged = later.select(*kept).unionByName(of_edge.select(*kept))
    return EXACT_TEMPERATURE.merge_states(merged)
