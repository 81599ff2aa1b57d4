"""Layouts that spare reading: by machine, in one pass, and with what can't be read set apart."""

from __future__ import annotations

import json

from conftest import MEDIUM, SMALL, plan_of, rows
from pyspark.sql import functions as F

from gaugemill.operators.clean import clean_readings
from gaugemill.operators.filters import last_days, of_machine
from gaugemill.operators.ingest import type_readings
from gaugemill.operators.quarantine import sort_out
from gaugemill.plans.tables import BY_MACHINE, READINGS, create_readings
from gaugemill.schemas import CSV_COLUMNS
from gaugemill.sources.readers import read_csv
from gaugemill.sources.sample_tables import (
    events,
    lineitem,
    raw_documents,
    redesigned_documents,
    shipment_readings,
    spoiled_csv_rows,
)
from gaugemill.sources.variants import from_variants, read_variants
from gaugemill.sources.writers import append_readings


def rows_read(frame) -> int:
    """Rows in the row groups that the scan has opened."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    while leaves.apply(0).getClass().getSimpleName() != "FileSourceScanExec":
        leaf = leaves.apply(0)
        inner = leaf.plan() if "QueryStage" in leaf.getClass().getSimpleName() else leaf.executedPlan()
        leaves = inner.collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def one_month(spark):
    readings = shipment_readings(lineitem(spark, MEDIUM))
    return readings.withColumn("month_partition", F.lit("1998-06-01").cast("date"))


def test_a_machine_is_read_from_few_row_groups(spark, database):
    name = f"{database}.{READINGS}"
    small = {"parquet.block.size": "16384", "parquet.page.size.row.check.min": "100"}
    create_readings(spark, name, options=BY_MACHINE | small)
    whole = one_month(spark)
    append_readings(whole, name, machine_buckets=64)
    total = whole.count()
    machine = of_machine(spark.table(name), 39)
    assert rows(machine.select(*whole.columns)) == rows(of_machine(whole, 39))
    assert rows_read(machine.select("temperature")) < total / 10
    newest = whole.agg(F.max("timestamp")).first()[0]
    recent = last_days(spark.table(name), 45, newest).select("temperature")
    assert rows(recent) == rows(last_days(whole, 45, newest).select("temperature"))
    assert rows_read(recent) < total / 4


def test_a_month_is_still_a_partition(spark, database):
    name = f"{database}.{READINGS}"
    create_readings(spark, name)
    readings = shipment_readings(lineitem(spark, SMALL))
    append_readings(readings, name, machine_buckets=8)
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 83
    assert rows(spark.table(name).select(*readings.columns)) == rows(readings)


def test_two_layouts_in_one_scan(spark, tmp_path):
    path = str(tmp_path / "documents")
    documents = raw_documents(events(spark, SMALL))
    documents.where("_id % 2 = 0").write.json(path)
    redesigned_documents(documents.where("_id % 2 = 1")).write.mode("append").json(path)
    frame = clean_readings(from_variants(read_variants(spark, path)))
    assert plan_of(frame).count("FileScan json") == 1
    assert rows(frame) == rows(clean_readings(documents))


def test_reading_variants_starts_no_job(spark, tmp_path):
    path = str(tmp_path / "documents")
    raw_documents(events(spark, SMALL)).write.json(path)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("variants", "")
    clean_readings(from_variants(read_variants(spark, path))).schema
    assert not tracker.getJobIdsForGroup("variants")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_odd_documents(spark, tmp_path):
    path = tmp_path / "documents"
    path.mkdir()
    lines = [
        json.dumps({"_id": 1, "readings": {"temperature": "x", "pressure": "2.5"}}),
        json.dumps({"_id": "2", "temperature": None, "readings": {"temperature": 3}}),
        json.dumps({"readings": "none", "vibration": 4.5, "machine_status": [1]}),
        "{}",
    ]
    (path / "a.json").write_text("\n".join(lines))
    found = from_variants(read_variants(spark, str(path)))
    picked = found.select("_id", "readings.temperature", "readings.pressure", "readings.vibration")
    assert rows(picked) == [
        ("1", None, 2.5, None),
        ("2", 3.0, None, None),
        (None, None, None, 4.5),
        (None, None, None, None),
    ]
    assert rows(found.select("machine_status").distinct()) == [(None,)]


def test_every_row_is_typed_or_rejected(spark, tmp_path):
    path = str(tmp_path / "csv")
    spoiled_csv_rows(events(spark, SMALL)).write.option("header", True).csv(path)
    found = sort_out(spark, path, str(tmp_path / "sorted"))
    raw = read_csv(spark, path)
    total = raw.count()
    assert found.totals["rows"] == total
    assert found.totals["typed"] == found.typed.count() > 0
    assert found.totals["rejected"] == found.rejected.count() > 0
    assert found.totals["typed"] + found.totals["rejected"] == total
    again = type_readings(found.rejected.select(*CSV_COLUMNS)).union(found.typed)
    assert rows(again) == rows(type_readings(raw))
    files = {row[0] for row in found.rejected.select("source_file").distinct().collect()}
    assert files and all(file.endswith(".csv") and path in file for file in files)
    (count,) = found.rejected.select(F.count_if(F.array_contains("reasons.column", "machine_id"))).first()
    assert count == found.totals["machine_id"]


def test_a_file_without_rows(spark, tmp_path):
    path = str(tmp_path / "csv")
    header = spoiled_csv_rows(events(spark, SMALL)).limit(0).coalesce(1)
    header.write.option("header", True).csv(path)
    found = sort_out(spark, path, str(tmp_path / "sorted"))
    assert found.typed.count() == found.rejected.count() == found.totals["rows"] == 0
