"""Mergeable partial aggregates.

Averages of averages are wrong when inserts differ in size. Each insert is therefore reduced
to states (``max``, and ``sum`` with ``count``) that merge to the same result in any order.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugemill.functions.timing import AsOf
from gaugemill.operators import exact
from gaugemill.operators.filters import last_months
from gaugemill.schemas import MONTH_PARTITION, struct

KEY_INPUTS = {
    "machine_id": "machine_id",
    "month": MONTH_PARTITION,
    "day": "to_date(timestamp)",
}


@dataclass(frozen=True)
class Summary:
    """A summary by its keys, its inputs, and SQL for building and merging its states.

    ``states`` aggregates inputs, ``combined`` aggregates states to states of the same
    columns, and ``finals`` turns combined states into values.
    """

    name: str
    keys: tuple[str, ...]
    inputs: tuple[str, ...]
    states: dict[str, str]
    combined: dict[str, str]
    finals: dict[str, str]
    schema: T.StructType
    months: int | None = None

    def select_inputs(self, readings: DataFrame, as_of: AsOf = None) -> DataFrame:
        """The rows and columns the summary needs; works on streams, too."""
        if self.months is not None:
            readings = last_months(readings, self.months, as_of)
        return readings.select(*self.inputs)

    def to_states(self, inputs: DataFrame) -> DataFrame:
        """One row of states per key; ids become text after grouping by the number."""
        keys = (F.expr(KEY_INPUTS[key]).alias(key) for key in self.keys)
        states = inputs.groupBy(*keys).agg(*_columns(self.states))
        return states.withColumn("machine_id", F.col("machine_id").cast("string"))

    def summarise(self, readings: DataFrame, as_of: AsOf = None) -> DataFrame:
        """Final values per key from all readings at once."""
        states = self.to_states(self.select_inputs(readings, as_of))
        return states.select(*self.keys, *_columns(self.finals))

    def combine_states(self, states: DataFrame) -> DataFrame:
        """One row of states per key from any number of rows."""
        return states.groupBy(*self.keys).agg(*_columns(self.combined))

    def merge_states(self, states: DataFrame) -> DataFrame:
        """Final values per key from any number of state rows."""
        return self.combine_states(states).select(*self.keys, *_columns(self.finals))

    def merge_sql(self, table: str) -> str:
        """``merge_states`` as SQL text, for a catalog view."""
        keys = ", ".join(self.keys)
        return (
            f"SELECT {keys}, {_select_list(self.finals)} FROM "
            f"(SELECT {keys}, {_select_list(self.combined)} FROM {table} GROUP BY {keys})"
        )


def _columns(expressions: dict[str, str]) -> list[Column]:
    return [F.expr(sql).alias(name) for name, sql in expressions.items()]


def _select_list(expressions: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in expressions.items())


def _average_state(value: str) -> str:
    return f"named_struct('sum', sum({value}), 'count', count({value}))"


def _combined_average(state: str) -> str:
    return f"named_struct('sum', sum({state}.sum), 'count', sum({state}.count))"


def _average(state: str) -> str:
    return f"try_divide({state}.sum, {state}.count)"


_AVERAGE = struct(sum=T.DoubleType(), count=T.LongType())


def anomalies(count_type: str) -> Summary:
    return Summary(
        name="anomalies",
        keys=("machine_id", "month"),
        inputs=("machine_id", MONTH_PARTITION, "anomaly_flag"),
        states={"anomaly_count": "count_if(anomaly_flag)"},
        combined={"anomaly_count": "sum(anomaly_count)"},
        finals={"anomaly_count": f"cast(anomaly_count AS {count_type})"},
        schema=struct(
            machine_id=T.StringType(), month=T.DateType(), anomaly_count=T.LongType()
        ),
    )


ANOMALIES = anomalies("int")
ANOMALIES_AS_DOUBLE = anomalies("double")

_ENERGY = "cast(energy_consumption AS double)"
_STATUS = "try_cast(machine_status AS double)"

ENERGY = Summary(
    name="energy",
    keys=("machine_id",),
    inputs=("machine_id", "energy_consumption", "machine_status"),
    states={
        "max_energy": f"max({_ENERGY})",
        "avg_energy": _average_state(_ENERGY),
        "avg_machine_status": _average_state(_STATUS),
    },
    combined={
        "max_energy": "max(max_energy)",
        "avg_energy": _combined_average("avg_energy"),
        "avg_machine_status": _combined_average("avg_machine_status"),
    },
    finals={
        "max_energy": "max_energy",
        "avg_energy": _average("avg_energy"),
        "avg_machine_status": _average("avg_machine_status"),
    },
    schema=struct(
        machine_id=T.StringType(),
        max_energy=T.DoubleType(),
        avg_energy=_AVERAGE,
        avg_machine_status=_AVERAGE,
    ),
)

_TEMPERATURE = "cast(temperature AS double)"

TEMPERATURE = Summary(
    name="temperature",
    keys=("month", "machine_id"),
    inputs=("machine_id", MONTH_PARTITION, "temperature"),
    states={"avg_temp": _average_state(_TEMPERATURE)},
    combined={"avg_temp": _combined_average("avg_temp")},
    finals={"avg_temperature": _average("avg_temp")},
    schema=struct(month=T.DateType(), machine_id=T.StringType(), avg_temp=_AVERAGE),
    months=3,
)

# The same summaries with sums that don't depend on the order of inserts and partitions.

EXACT_ENERGY = replace(
    ENERGY,
    name="exact_energy",
    states={
        "max_energy": f"max({_ENERGY})",
        "avg_energy": exact.average_state(_ENERGY),
        "avg_machine_status": exact.average_state(_STATUS),
    },
    combined={
        "max_energy": "max(max_energy)",
        "avg_energy": exact.combined_average("avg_energy"),
        "avg_machine_status": exact.combined_average("avg_machine_status"),
    },
    finals={
        "max_energy": "max_energy",
        "avg_energy": exact.average("avg_energy"),
        "avg_machine_status": exact.average("avg_machine_status"),
    },
    schema=struct(
        machine_id=T.StringType(),
        max_energy=T.DoubleType(),
        avg_energy=exact.EXACT,
        avg_machine_status=exact.EXACT,
    ),
)

EXACT_TEMPERATURE = replace(
    TEMPERATURE,
    name="exact_temperature",
    states={"avg_temp": exact.average_state(_TEMPERATURE)},
    combined={"avg_temp": exact.combined_average("avg_temp")},
    finals={"avg_temperature": exact.average("avg_temp")},
    schema=struct(month=T.DateType(), machine_id=T.StringType(), avg_temp=exact.EXACT),
)

# Temperature by day, of all times: ``streaming.panes`` reads trailing ranges from it.
DAILY_TEMPERATURE = replace(
    EXACT_TEMPERATURE,
    name="daily_temperature",
    keys=("month", "day", "machine_id"),
    inputs=("machine_id", MONTH_PARTITION, "timestamp", "temperature"),
    schema=struct(
        month=T.DateType(), day=T.DateType(), machine_id=T.StringType(), avg_temp=exact.EXACT
    ),
    months=None,
)
