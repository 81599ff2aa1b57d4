from __future__ import annotations

import glob
import os

import pytest
from conftest import SMALL, rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from test_streaming import rounded

from gaugemill.functions.timing import latest
from gaugemill.operators import reports, summaries
from gaugemill.operators.clean import clean_readings
from gaugemill.plans.flows import load_states, run_ingest, run_jdbc, run_native
from gaugemill.plans.tables import STATE_TABLES
from gaugemill.schemas import RAW_DOCUMENT
from gaugemill.sources.folders import staged
from gaugemill.sources.readers import read_documents
from gaugemill.sources.sample_tables import csv_rows, event_readings, events, raw_documents


def test_ingest_appends(spark, tmp_path):
    csv, target = str(tmp_path / "csv"), str(tmp_path / "documents")
    csv_rows(events(spark, SMALL)).write.option("header", True).csv(csv)
    run_ingest(spark, csv, target)
    run_ingest(spark, csv, target)
    cleaned = clean_readings(read_documents(spark, target, schema=RAW_DOCUMENT)).drop("_id")
    expected = event_readings(events(spark, SMALL)).drop("_id")
    assert rows(cleaned) == rows(expected.union(expected))


def test_native_flow_twice(spark, database, tmp_path):
    documents = raw_documents(events(spark, SMALL))
    readings = event_readings(events(spark, SMALL))
    as_of = latest(readings)
    for expected in (readings, readings.union(readings)):
        found = run_native(
            spark, documents, database, str(tmp_path / "checkpoint"), "run", as_of=as_of
        )
        assert set(found) == {"daily_averages", "high_risk", "needs_maintenance"}
        assert rows(found["high_risk"]) == rows(reports.high_risk(expected))
        assert rows(found["needs_maintenance"]) == rows(reports.needs_maintenance(expected))
        energy = spark.table(f"{database}.sp_energy_efficiency")
        assert rounded(energy) == rounded(summaries.energy_efficiency(expected))
        anomalies = spark.table(f"{database}.sp_anomaly_summary")
        assert rounded(anomalies) == rounded(
            summaries.anomaly_summary(expected).select(anomalies.columns)
        )


def test_native_flow_after_the_catalog_was_lost(spark, database, tmp_path):
    documents = raw_documents(events(spark, SMALL))
    readings = event_readings(events(spark, SMALL))
    as_of = latest(readings)
    location = str(tmp_path / "files")
    for expected in (readings, readings.union(readings)):
        found = run_native(
            spark,
            documents,
            database,
            str(tmp_path / "checkpoint"),
            "run",
            as_of=as_of,
            location=location,
        )
        assert rows(found["high_risk"]) == rows(reports.high_risk(expected))
        energy = spark.table(f"{database}.sp_energy_efficiency")
        assert rounded(energy) == rounded(summaries.energy_efficiency(expected))
        spark.sql(f"DROP DATABASE {database} CASCADE")
        spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path / 'again'}'")


def test_native_flow_refuses_readings_without_time(spark, database, tmp_path):
    documents = raw_documents(events(spark, SMALL)).replace("Machine_1", "x")
    bad = documents.selectExpr("* EXCEPT (timestamp)", "'Date: bad' AS timestamp")
    with pytest.raises(PySparkException, match="NULL in required column timestamp"):
        run_native(spark, bad, database, str(tmp_path / "checkpoint"), "run")


def test_states_go_along_with_a_jdbc_write(spark, database):
    documents = raw_documents(events(spark, SMALL))
    narrow = clean_readings(documents, "float")
    as_of = latest(narrow)
    for _ in range(2):
        load_states(spark, narrow, database, "run", 0, as_of=as_of)
    anomalies, energy, temperature = (table.read(spark, database) for table in STATE_TABLES)
    assert rounded(anomalies) == rounded(summaries.anomaly_summary(narrow, "double"))
    assert rounded(energy) == rounded(summaries.energy_efficiency(narrow))
    assert rounded(temperature) == rounded(summaries.monthly_temp(narrow, as_of=as_of))


def test_a_failed_jdbc_write_leaves_no_states(spark, database):
    documents = raw_documents(events(spark, SMALL))
    with pytest.raises(Py4JJavaError, match="No suitable driver"):
        run_jdbc(spark, documents, "jdbc:none://nowhere/db", database, "run", 0)
    assert not spark.catalog.tableExists(f"{database}.{STATE_TABLES[0].states}")
    assert not glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/gaugemill/readings-*")


def test_staged_readings_are_read_back_and_removed(spark):
    narrow = clean_readings(raw_documents(events(spark, SMALL)), "float")
    with staged(narrow, "readings") as stored:
        assert stored.dtypes == narrow.dtypes
        assert rows(stored) == rows(narrow)
        (path,) = {os.path.dirname(file) for file in stored.inputFiles()}
    assert not os.path.exists(path.removeprefix("file://"))
