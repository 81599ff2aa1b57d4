"""Column layouts of the data at each step, from CSV text to summaries."""

from __future__ import annotations

from pyspark.sql import types as T

# The CSV header, in file order. Every column arrives as text.
CSV_COLUMNS = (
    "timestamp",
    "machine_id",
    "temperature",
    "vibration",
    "humidity",
    "pressure",
    "energy_consumption",
    "machine_status",
    "anomaly_flag",
    "predicted_remaining_life",
    "failure_type",
    "downtime_risk",
    "maintenance_required",
)
INT_COLUMNS = (
    "machine_id",
    "machine_status",
    "anomaly_flag",
    "predicted_remaining_life",
    "downtime_risk",
    "maintenance_required",
)
DOUBLE_COLUMNS = ("temperature", "vibration", "humidity", "pressure", "energy_consumption")

def struct(**types: T.DataType) -> T.StructType:
    """Nullable columns in the order given."""
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


_TEXT, _INT, _DOUBLE = T.StringType(), T.IntegerType(), T.DoubleType()

CSV_READING = struct(**dict.fromkeys(CSV_COLUMNS, _TEXT))

# A document as the ingest step writes it, with labelled text and nested
# measurements.
RAW_DOCUMENT = struct(
    _id=_TEXT,
    timestamp=_TEXT,
    machine_id=_TEXT,
    readings=struct(
        temperature=_DOUBLE,
        vibration=_DOUBLE,
        humidity=_TEXT,
        pressure=_DOUBLE,
        energy_use=_DOUBLE,
    ),
    machine_status=_INT,
    anomaly_flag=_INT,
    life_remaining=_INT,
    failure_code=_INT,
    downtime_risk=_INT,
    maintenance_required=_INT,
)

# The first day of the timestamp's month, set when a reading is cleaned. Filters and
# summaries rely on it: in the table it costs no read and no computation per row.
MONTH_PARTITION = "month_partition"
REQUIRED_COLUMNS = ("_id", "timestamp", MONTH_PARTITION)


def reading_table(float_type: str = "double") -> T.StructType:
    """The cleaned reading in table order; ``float_type`` is ``double`` or ``float``.

    Names, types and order are fixed values.
    """
    kinds = {"double": T.DoubleType(), "float": T.FloatType()}
    if float_type not in kinds:
        raise ValueError(f"float_type must be 'double' or 'float', not {float_type!r}")
    real = kinds[float_type]
    return struct(
        _id=_TEXT,
        timestamp=T.TimestampType(),
        temperature=real,
        pressure=real,
        vibration=real,
        energy_consumption=real,
        humidity=real,
        anomaly_flag=T.BooleanType(),
        downtime_risk=real,
        failure_code=_TEXT,
        remaining_life=_INT,
        machine_id=_INT,
        machine_status=_TEXT,
        maintenance_required=T.BooleanType(),
        month_partition=T.DateType(),
    )


def ddl(schema: T.StructType) -> str:
    """Column list of a CREATE TABLE statement."""
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
