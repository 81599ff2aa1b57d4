from __future__ import annotations

import glob
from unittest.mock import MagicMock

import pyarrow.parquet as pq
import pytest
from conftest import MEDIUM, SMALL, plan_of, rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gaugemill.operators.filters import last_months
from gaugemill.operators.reports import daily_averages
from gaugemill.plans import tables
from gaugemill.plans.tables import (
    READINGS,
    STATE_TABLES,
    SUMMARY_TABLES,
    create_database,
    create_readings,
    create_states,
    create_summaries,
)
from gaugemill.schemas import REQUIRED_COLUMNS, reading_table
from gaugemill.session import build_session, register_catalog
from gaugemill.sources import folders
from gaugemill.sources.folders import new_staging_path
from gaugemill.sources.readers import read_table
from gaugemill.sources.sample_tables import event_readings, events, lineitem, shipment_readings
from gaugemill.sources.writers import append_jdbc, append_readings, append_table, require_values


@pytest.fixture
def table(spark, database):
    name = f"{database}.{READINGS}"
    create_readings(spark, name)
    return name


def month_files(tmp_path, month):
    return sorted(glob.glob(f"{tmp_path}/tables/{READINGS}/month_partition={month}/*.parquet"))


def test_append_matches_columns_by_name(spark, table):
    readings = event_readings(events(spark, SMALL))
    shuffled = readings.select(*reversed(readings.columns))
    append_readings(shuffled, table)
    stored = read_table(spark, table)
    assert stored.columns == reading_table().fieldNames()
    assert rows(stored) == rows(readings)
    append_readings(readings, table)
    assert stored.count() == 2 * readings.count()


def test_overwrite_mode(spark, table):
    readings = event_readings(events(spark, SMALL))
    append_readings(readings, table)
    append_readings(readings.where("machine_id = 1"), table, mode="overwrite")
    assert read_table(spark, table).select("machine_id").distinct().collect() == [(1,)]
    append_readings(readings.where("machine_id = 2"), table)
    assert read_table(spark, table).select("machine_id").distinct().count() == 2


def test_months_are_partitions_sorted_by_time(spark, table, tmp_path):
    append_readings(shipment_readings(lineitem(spark, MEDIUM)), table)
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 83
    for month in ("1995-01-01", "1998-06-01", "2001-11-01"):
        (file,) = month_files(tmp_path, month)
        times = pq.ParquetFile(file).read(["timestamp"])["timestamp"].to_pylist()
        assert times == sorted(times)


def test_large_month_is_split(spark, table, tmp_path, setting):
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    readings = shipment_readings(lineitem(spark, MEDIUM))
    hot = F.when(F.col("machine_id") % 3 == 0, F.lit("1998-06-01").cast("date"))
    append_readings(
        readings.withColumn("month_partition", F.coalesce(hot, "month_partition")).repartition(16),
        table,
    )
    files = month_files(tmp_path, "1998-06-01")
    assert len(files) > 4
    sizes = [pq.ParquetFile(file).metadata.num_rows for file in files]
    assert max(sizes) < sum(sizes) / 4
    for file in files:
        times = pq.ParquetFile(file).read(["timestamp"])["timestamp"].to_pylist()
        assert times == sorted(times)
    assert read_table(spark, table).count() == readings.count()


def test_time_range_prunes_months(spark, table):
    append_readings(shipment_readings(lineitem(spark, MEDIUM)), table)
    recent = last_months(read_table(spark, table), 3, "2001-11-04 00:00:00")
    plan = plan_of(recent.select("temperature"))
    assert "PartitionFilters: [isnotnull(month_partition" in plan
    assert "(month_partition#" in plan and ">= 2001-08-01" in plan
    assert "GreaterThanOrEqual(timestamp,2001-08-04" in plan
    early = last_months(read_table(spark, table), 3, "2001-12-01 00:00:00")
    assert ">= 2001-08-01" in plan_of(early.select("temperature"))
    report = daily_averages(read_table(spark, table))
    assert "EqualTo(machine_id,39)" in plan_of(report)
    assert "PartitionFilters: [isnotnull(month_partition" in plan_of(report)


def test_missing_values_are_refused_or_dropped(spark, table):
    readings = event_readings(events(spark, SMALL))
    holed = readings.withColumn(
        "timestamp", F.when(F.col("machine_id") != 1, F.col("timestamp"))
    )
    with pytest.raises(PySparkException, match="NULL in required column timestamp"):
        append_readings(holed, table)
    append_readings(holed, table, on_null="drop")
    expected = readings.where("machine_id != 1")
    assert rows(read_table(spark, table)) == rows(expected)
    with pytest.raises(ValueError, match="on_null"):
        append_readings(holed, table, on_null="ignore")


def test_requirement_check_keeps_values(spark):
    readings = event_readings(events(spark, SMALL))
    assert rows(require_values(readings, REQUIRED_COLUMNS)) == rows(readings)
    assert require_values(readings, (), "drop") is readings


def test_plain_table_append(spark, database):
    name = f"{database}.plain"
    append_table(spark.range(3), name)
    append_table(spark.range(3), name, options={"compression": "zstd"})
    assert read_table(spark, name).count() == 6


def test_other_provider(spark, database):
    readings = event_readings(events(spark, SMALL))
    create_readings(spark, f"{database}.other", provider="orc")
    append_readings(readings, f"{database}.other", gather=False, fmt="orc")
    assert rows(read_table(spark, f"{database}.other")) == rows(readings)


def test_float_table(spark, database):
    create_readings(spark, f"{database}.narrow", "float")
    kinds = [kind for _, kind in read_table(spark, f"{database}.narrow").dtypes]
    assert kinds.count("float") == 6
    with pytest.raises(ValueError, match="float_type"):
        reading_table("decimal")


def test_definitions_can_be_repeated(spark, database):
    for _ in range(2):
        create_database(spark, database)
        create_readings(spark, f"{database}.{READINGS}", properties={"site": "plant"})
        create_summaries(spark, database)
        create_states(spark, database)
    properties = spark.sql(f"SHOW TBLPROPERTIES {database}.{READINGS}").collect()
    assert ("site", "plant") in [tuple(row) for row in properties]
    for entry in SUMMARY_TABLES + STATE_TABLES:
        assert spark.catalog.tableExists(f"{database}.{entry.states}")
        assert read_table(spark, f"{database}.{entry.name}").isEmpty()
    kinds = {
        entry.name: dict(read_table(spark, f"{database}.{entry.name}").dtypes)
        for entry in SUMMARY_TABLES
    }
    assert kinds == {
        "sp_anomaly_summary": {"machine_id": "string", "month": "date", "anomaly_count": "int"},
        "sp_energy_efficiency": {
            "machine_id": "string",
            "max_energy": "double",
            "avg_energy": "double",
            "avg_machine_status": "double",
        },
        "sp_monthly_temp": {
            "month": "date",
            "machine_id": "string",
            "avg_temperature": "double",
        },
    }


def test_a_failing_definition_does_not_stop_the_others(spark, database):
    statements = {
        "bad": "CREATE TABLE nowhere.at_all (x INT) USING parquet",
        "good": f"CREATE TABLE {database}.good (x INT) USING parquet",
        "worse": "CREATE NOTHING",
    }
    with pytest.raises(RuntimeError, match="(?s)2 of 3 statements failed: bad: .*worse: "):
        tables._run_all(spark, statements)
    assert spark.catalog.tableExists(f"{database}.good")


def test_jdbc_needs_a_driver(spark):
    with pytest.raises(Py4JJavaError, match="No suitable driver"):
        append_jdbc(spark.range(1), "jdbc:none://nowhere/db", "readings", connections=2)


def test_jdbc_settings():
    """No database is at hand, so the writer only records what it is told."""
    frame = MagicMock()
    writer = frame.write.format.return_value
    writer.options.return_value = writer.option.return_value = writer
    append_jdbc(frame, "jdbc:x://host/db", "readings", connections=4, properties={"user": "me"})
    frame.write.format.assert_called_once_with("jdbc")
    writer.options.assert_called_once_with(user="me")
    assert {call.args for call in writer.option.call_args_list} == {
        ("url", "jdbc:x://host/db"),
        ("dbtable", "readings"),
        ("batchsize", 10_000),
        ("numPartitions", 4),
    }
    writer.mode.assert_called_once_with("append")
    writer.mode.return_value.save.assert_called_once_with()


def test_external_catalog_settings(spark):
    options = {"host": "store", "http_port": "8123"}
    assert register_catalog(spark, "store", "org.example.Catalog", options) == "store"
    assert spark.conf.get("spark.sql.catalog.store") == "org.example.Catalog"
    assert spark.conf.get("spark.sql.catalog.store.http_port") == "8123"


def test_session_settings_can_be_overridden(spark):
    session = build_session("again", {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"})
    assert session.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "64m"
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    session.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_staging_is_in_the_named_folder(spark):
    first, second = (new_staging_path(spark, "x") for _ in range(2))
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))
    spark.range(10).write.mode("append").parquet(first)
    assert spark.read.parquet(first).count() == 10


def test_staging_without_a_named_folder_is_in_the_warehouse(spark, monkeypatch):
    monkeypatch.setattr(folders, "CHECKPOINT_DIR", "gaugemill.none")
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda _: None)
    assert new_staging_path(spark, "x").startswith(spark.conf.get("spark.sql.warehouse.dir"))
