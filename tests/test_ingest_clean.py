from __future__ import annotations

from datetime import date, datetime

from conftest import SMALL, plan_of, rows
from pyspark.sql import functions as F

from gaugemill.operators.clean import clean_readings
from gaugemill.operators.ingest import flatten_documents, nest_readings, type_readings
from gaugemill.schemas import CSV_COLUMNS, CSV_READING, RAW_DOCUMENT, reading_table
from gaugemill.sources.readers import read_csv, read_documents, stream_documents
from gaugemill.sources.sample_tables import csv_rows, event_readings, events, raw_documents
from gaugemill.sources.writers import append_documents

GOOD = (
    "2025-03-31 23:59:59,39,70.5,1.25,41.5,1.01,2.5,1,1,49,Critical,0,1\n"
    "2025-04-01 00:00:00,7,1,2,3,4,5,0,0,100,Normal,0.37,0\n"
)
BAD = "31/03/2025,x,hot,,NaN,1e2,-,1e3,,99999999999,odd,abc,.5\nonly,two\n"


def write_csv(path, text):
    path.write_text(",".join(CSV_COLUMNS) + "\n" + text)
    return str(path)


def test_csv_is_typed_without_failing(spark, tmp_path):
    typed = type_readings(read_csv(spark, write_csv(tmp_path / "a.csv", GOOD + BAD)))
    found = {row["failure_type"]: row for row in typed.collect()}
    assert found["Critical"]["timestamp"] == datetime(2025, 3, 31, 23, 59, 59)
    assert found["Critical"]["machine_id"] == 39
    assert found["Normal"]["downtime_risk"] == 0
    odd = found["odd"].asDict()
    assert str(odd.pop("humidity")) == "nan"
    assert odd.pop("pressure") == 100.0
    assert odd.pop("maintenance_required") == 0
    assert odd.pop("failure_type") == "odd"
    assert set(odd.values()) == {None}
    assert set(found[None]) == {None}


def test_column_types(spark):
    typed = type_readings(spark.createDataFrame([], CSV_READING))
    kinds = dict(typed.dtypes)
    assert kinds["timestamp"] == "timestamp"
    assert kinds["failure_type"] == "string"
    assert [name for name, kind in kinds.items() if kind == "int"] == [
        "machine_id",
        "machine_status",
        "anomaly_flag",
        "predicted_remaining_life",
        "downtime_risk",
        "maintenance_required",
    ]
    assert sum(kind == "double" for kind in kinds.values()) == 5
    documents = nest_readings(typed)
    assert [f.name for f in documents.schema] == [f.name for f in RAW_DOCUMENT if f.name != "_id"]


def test_round_trip_keeps_valid_readings(spark, tmp_path):
    typed = type_readings(read_csv(spark, write_csv(tmp_path / "a.csv", GOOD)))
    cleaned = clean_readings(nest_readings(typed).withColumn("_id", F.lit("x")))
    assert cleaned.schema.simpleString() == reading_table().simpleString()
    first, second = cleaned.orderBy("timestamp").collect()
    assert first.asDict() == {
        "_id": "x",
        "timestamp": datetime(2025, 3, 31, 23, 59, 59),
        "temperature": 70.5,
        "pressure": 1.01,
        "vibration": 1.25,
        "energy_consumption": 2.5,
        "humidity": 41.5,
        "anomaly_flag": True,
        "downtime_risk": 0.0,
        "failure_code": "1",
        "remaining_life": 49,
        "machine_id": 39,
        "machine_status": "1",
        "maintenance_required": True,
        "month_partition": date(2025, 3, 1),
    }
    assert (second["failure_code"], second["anomaly_flag"]) == ("0", False)


def test_dirty_documents_clean_to_null(spark):
    measurements = (1.0, 2.0, "humid_value:abc", None, 3.0)
    dirty = [
        ("1", "Date: bad", "M_1", measurements, 1, 2, None, 99, None, None),
        (None, None, None, None, None, None, None, None, None, None),
    ]
    first, second = clean_readings(spark.createDataFrame(dirty, RAW_DOCUMENT)).collect()
    assert first["timestamp"] is first["month_partition"] is first["machine_id"] is None
    assert first["humidity"] is None and first["temperature"] == 1.0
    assert first["anomaly_flag"] is True and first["maintenance_required"] is None
    assert set(second) == {None}


def test_float_variant(spark):
    documents = raw_documents(events(spark, SMALL))
    narrow = clean_readings(documents, "float")
    kinds = [kind for _, kind in narrow.dtypes]
    assert kinds.count("float") == 6 and "double" not in kinds
    wide = clean_readings(documents).select("_id", F.col("temperature").cast("float"))
    assert rows(narrow.select("_id", "temperature")) == rows(wide)


def test_event_views_agree(spark):
    source = events(spark, SMALL)
    assert rows(clean_readings(raw_documents(source))) == rows(event_readings(source))
    typed = type_readings(csv_rows(source))
    assert typed.where("timestamp IS NULL OR machine_id IS NULL OR humidity IS NULL").isEmpty()


def test_cleaning_is_one_stage_and_reads_what_is_used(spark, tmp_path):
    path = str(tmp_path / "documents")
    append_documents(raw_documents(events(spark, SMALL)), path, "parquet")
    documents = read_documents(spark, path, "parquet", RAW_DOCUMENT)
    plan = plan_of(clean_readings(documents).select("temperature", "month_partition"))
    assert "Exchange" not in plan
    assert "ReadSchema: struct<timestamp:string,readings:struct<temperature:double>>" in plan
    assert plan_of(clean_readings(documents)).count("gettimestamp") == 1


def test_inferred_documents_clean_the_same(spark, tmp_path):
    path = str(tmp_path / "documents")
    documents = raw_documents(events(spark, SMALL))
    append_documents(documents, path)
    inferred = read_documents(spark, path)
    assert dict(inferred.dtypes)["anomaly_flag"] == "bigint"
    assert rows(clean_readings(inferred)) == rows(clean_readings(documents))


def test_documents_append_and_get_ids(spark, tmp_path):
    path = str(tmp_path / "documents")
    documents = nest_readings(type_readings(csv_rows(events(spark, SMALL))))
    for _ in range(2):
        append_documents(documents, path)
    stored = read_documents(spark, path, schema=RAW_DOCUMENT)
    assert stored.count() == 2 * documents.count()
    assert stored.select("_id").distinct().count() == stored.count()
    assert rows(flatten_documents(stored.drop("_id")).distinct()) == rows(
        flatten_documents(documents).distinct()
    )


def test_documents_stream(spark, tmp_path):
    path = str(tmp_path / "documents")
    documents = raw_documents(events(spark, SMALL))
    append_documents(documents, path)
    stream = stream_documents(spark, path, RAW_DOCUMENT, max_files=1)
    query = (
        clean_readings(stream)
        .writeStream.format("memory")
        .queryName("streamed_documents")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert rows(spark.table("streamed_documents")) == rows(clean_readings(documents))
