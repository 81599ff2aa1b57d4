"""Readings seen in the given ``events`` and ``lineitem`` tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugemill.functions.labels import label, label_timestamp
from gaugemill.functions.parsing import HUMIDITY_LABEL, MACHINE_LABEL, TIMESTAMP_FORMAT
from gaugemill.functions.timing import month_start
from gaugemill.schemas import CSV_COLUMNS, RAW_DOCUMENT, reading_table, struct
from gaugemill.sources.readers import limited

# Reading the times as TIMESTAMP here, not casting them later, keeps range filters pushable.
EVENTS = struct(
    event_id=T.LongType(),
    ts=T.TimestampType(),
    user_id=T.LongType(),
    event_type=T.StringType(),
    value=T.DoubleType(),
    props=T.StringType(),
)
LINEITEM = struct(
    l_suppkey=T.LongType(),
    l_orderkey=T.LongType(),
    l_linenumber=T.IntegerType(),
    l_quantity=T.DoubleType(),
    l_extendedprice=T.DoubleType(),
    l_discount=T.DoubleType(),
    l_tax=T.DoubleType(),
    l_returnflag=T.StringType(),
    l_linestatus=T.StringType(),
    l_shipdate=T.TimestampType(),
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(LINEITEM).parquet(f"{sf_dir}/lineitem.parquet")


def lineitem_stream(
    spark: SparkSession, sf_dir: str, max_bytes: int | None = None
) -> DataFrame:
    """``lineitem`` as a stream, be it one file or a directory of them."""
    # A stream takes directories and patterns only. The pattern fits the one name, so that it
    # works for a file, too.
    reader = limited(spark.readStream.schema(LINEITEM), max_bytes=max_bytes)
    return reader.parquet(f"{sf_dir}/lineitem.parque[t]")


def _props_k() -> Column:
    return F.get_json_object("props", "$.k")


def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def _failure_type() -> Column:
    return (
        F.when(_is("view"), "Normal").when(_is("error"), "Critical").otherwise(F.col("event_type"))
    )


def _spoiled(good: Column, *texts: str | None) -> Column:
    """The text of a value; in the first of every eight rows by id, other texts in turn."""
    text = good.cast("string")
    for place, bad in enumerate(texts):
        text = F.when(F.col("event_id") % 8 == place, F.lit(bad)).otherwise(text)
    return text


def spoiled_csv_rows(source: DataFrame) -> DataFrame:
    """``csv_rows`` with texts that are hard to read, or no values at all."""
    time = F.date_format("ts", TIMESTAMP_FORMAT)
    ids = ("7.9", " 12 ", "", None, "abc", "99999999999", "-1.9")
    times = ("2024-01-05 06:07:08", "bad", None, "2024-1-2 03:04", "2024-13-01 00:00:00")
    return csv_rows(
        source,
        timestamp=_spoiled(time, *times),
        machine_id=_spoiled(F.col("user_id"), *ids),
        temperature=_spoiled(F.col("value"), "1e3", " 3.5 ", "", None, "abc", "-0"),
        machine_status=_spoiled(F.col("event_id") % 3, "1e3", ".5", "2.", "+4", "0x1"),
        failure_type=_spoiled(_failure_type(), None, "normal", "Criticality"),
    )


def spoiled_documents(source: DataFrame) -> DataFrame:
    """``raw_documents`` with texts that are hard to read, or no values at all."""
    none = F.lit(None)
    row = F.col("event_id") % 8
    humidity = label(HUMIDITY_LABEL, _props_k())
    return raw_documents(
        source,
        timestamp=_spoiled(
            label_timestamp(F.col("ts")),
            None,
            "Date: bad",
            "2024-01-05 06:07:08",
            "Date: 2025-1-2 03:04",
        ),
        machine_id=_spoiled(
            label(MACHINE_LABEL, F.col("user_id")),
            "xMachine_12b",
            "M_1",
            "",
            None,
            "Machine_99999999999",
        ),
        readings=F.struct(
            F.when(row != 6, F.col("value")).alias("temperature"),
            (F.col("value") / 10).alias("vibration"),
            _spoiled(humidity, "humid_value:abc", "5.5", None, "", "x5").alias("humidity"),
            (F.col("value") + 1000).alias("pressure"),
            (F.col("value") * 2).alias("energy_use"),
        ),
        anomaly_flag=F.when(row == 5, 2).when(row != 6, _is("error").cast("int")),
        life_remaining=F.when(row != 6, _props_k()),
        failure_code=F.when(row == 6, none).when(_is("view"), 0).when(_is("error"), 1).otherwise(99),
    )


def csv_rows(source: DataFrame, **others: Column) -> DataFrame:
    """Events as the thirteen text columns of a CSV file; ``others`` replace columns."""
    values = {
        "timestamp": F.date_format("ts", TIMESTAMP_FORMAT),
        "machine_id": F.col("user_id"),
        "temperature": F.col("value"),
        "vibration": F.col("value") / 10,
        "humidity": _props_k(),
        "pressure": F.col("value") + 1000,
        "energy_consumption": F.col("value") * 2,
        "machine_status": F.col("event_id") % 3,
        "anomaly_flag": _is("error").cast("int"),
        "predicted_remaining_life": _props_k(),
        "failure_type": _failure_type(),
        "downtime_risk": F.lit(0),
        "maintenance_required": _is("signup").cast("int"),
    } | others
    return source.select(*(values[name].cast("string").alias(name) for name in CSV_COLUMNS))


def raw_documents(source: DataFrame, **others: Column) -> DataFrame:
    """Events as documents with labelled text and nested measurements."""
    values = {
        "_id": F.col("event_id"),
        "timestamp": label_timestamp(F.col("ts")),
        "machine_id": label(MACHINE_LABEL, F.col("user_id")),
        "readings": F.struct(
            F.col("value").alias("temperature"),
            (F.col("value") / 10).alias("vibration"),
            label(HUMIDITY_LABEL, _props_k()).alias("humidity"),
            (F.col("value") + 1000).alias("pressure"),
            (F.col("value") * 2).alias("energy_use"),
        ),
        "machine_status": F.col("event_id") % 3,
        "anomaly_flag": _is("error"),
        "life_remaining": _props_k(),
        "failure_code": F.when(_is("view"), 0).when(_is("error"), 1).otherwise(99),
        "downtime_risk": F.lit(0),
        "maintenance_required": _is("signup"),
    } | others
    return source.select(
        *(values[field.name].cast(field.dataType).alias(field.name) for field in RAW_DOCUMENT)
    )


def redesigned_documents(documents: DataFrame) -> DataFrame:
    """``raw_documents`` in another layout: flat measurements, other names, numbers as text."""
    kept = [name for name in documents.columns if name not in ("readings", "life_remaining")]
    return documents.select(
        *kept,
        F.col("readings.temperature").cast("string").alias("temperature"),
        "readings.vibration",
        "readings.humidity",
        "readings.pressure",
        F.col("readings.energy_use").alias("energy_consumption"),
        F.col("life_remaining").alias("predicted_remaining_life"),
        F.lit("2").alias("layout"),
    )


def shipment_documents(source: DataFrame) -> DataFrame:
    """Line items as documents; cleaned, they equal ``shipment_readings``."""
    values = {
        "_id": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "timestamp": label_timestamp(F.col("l_shipdate")),
        "machine_id": label(MACHINE_LABEL, F.col("l_suppkey")),
        "readings": F.struct(
            F.col("l_quantity").alias("temperature"),
            F.col("l_discount").alias("vibration"),
            label(HUMIDITY_LABEL, F.col("l_tax")).alias("humidity"),
            F.col("l_extendedprice").alias("pressure"),
            F.col("l_extendedprice").alias("energy_use"),
        ),
        "machine_status": F.col("l_linenumber") % 3,
        "anomaly_flag": F.col("l_returnflag") == "R",
        "life_remaining": F.col("l_linenumber"),
        "failure_code": F.lit(99),
        "downtime_risk": F.lit(0),
        "maintenance_required": F.col("l_linestatus") == "O",
    }
    return source.select(
        *(values[field.name].cast(field.dataType).alias(field.name) for field in RAW_DOCUMENT)
    )


def event_readings(source: DataFrame) -> DataFrame:
    """Events as cleaned readings, equal to cleaning ``raw_documents``."""
    timestamp = F.date_trunc("second", "ts")
    return _as_readings(
        source,
        {
            "_id": F.col("event_id"),
            "timestamp": timestamp,
            "temperature": F.col("value"),
            "pressure": F.col("value") + 1000,
            "vibration": F.col("value") / 10,
            "energy_consumption": F.col("value") * 2,
            "humidity": _props_k(),
            "anomaly_flag": _is("error"),
            "downtime_risk": F.lit(0),
            "failure_code": F.when(_is("view"), "0").when(_is("error"), "1").otherwise("99"),
            "remaining_life": _props_k(),
            "machine_id": F.col("user_id"),
            "machine_status": F.col("event_id") % 3,
            "maintenance_required": _is("signup"),
            "month_partition": month_start(timestamp),
        },
    )


def shipment_readings(source: DataFrame) -> DataFrame:
    """Line items as cleaned readings over many months; works on the stream, too."""
    return _as_readings(
        source,
        {
            "_id": F.concat_ws("-", "l_orderkey", "l_linenumber"),
            "timestamp": F.col("l_shipdate"),
            "temperature": F.col("l_quantity"),
            "pressure": F.col("l_extendedprice"),
            "vibration": F.col("l_discount"),
            "energy_consumption": F.col("l_extendedprice"),
            "humidity": F.col("l_tax"),
            "anomaly_flag": F.col("l_returnflag") == "R",
            "downtime_risk": F.lit(0),
            "failure_code": F.lit("99"),
            "remaining_life": F.col("l_linenumber"),
            "machine_id": F.col("l_suppkey"),
            "machine_status": F.col("l_linenumber") % 3,
            "maintenance_required": F.col("l_linestatus") == "O",
            "month_partition": month_start(F.col("l_shipdate")),
        },
    )


def _as_readings(source: DataFrame, values: dict[str, Column]) -> DataFrame:
    return source.select(
        *(values[field.name].cast(field.dataType).alias(field.name) for field in reading_table())
    )
