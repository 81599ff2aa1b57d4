from __future__ import annotations

import glob
import os
import time
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from conftest import MEDIUM, SMALL, rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_reports import NOW, readings

from gaugemill.functions.timing import fixed, latest
from gaugemill.operators import summaries
from gaugemill.operators.states import ANOMALIES, ENERGY, TEMPERATURE
from gaugemill.plans.tables import (
    READINGS,
    STATE_TABLES,
    SUMMARY_TABLES,
    create_database,
    create_readings,
    create_states,
    create_summaries,
    quoted_name,
)
from gaugemill.sources.readers import stream_documents, stream_table
from gaugemill.sources.sample_tables import (
    event_readings,
    events,
    lineitem,
    lineitem_stream,
    shipment_readings,
)
from gaugemill.sources.writers import append_readings
from gaugemill.streaming import views
from gaugemill.streaming.views import catch_up, fold_states, maintain, write_states

ALL_TABLES = SUMMARY_TABLES + STATE_TABLES


def direct(table, frame, as_of):
    """The summary of all readings at once."""
    if table.summary.name == "anomalies":
        return summaries.anomaly_summary(frame, "double" if "agg" in table.name else "int")
    if table.summary.name == "energy":
        return summaries.energy_efficiency(frame)
    return summaries.monthly_temp(frame, as_of=as_of)


def rounded(frame):
    kinds = dict(frame.dtypes)
    return rows(
        frame.select(
            *(
                F.round(F.col(name), 6) if kinds[name] == "double" else F.col(name)
                for name in sorted(frame.columns)
            )
        )
    )


def batches(spark, database, table):
    states = spark.table(f"{database}.{table.states}")
    return sorted(row[0] for row in states.select("batch_id").distinct().collect())


@pytest.fixture
def prepared(spark, database):
    create_readings(spark, f"{database}.{READINGS}")
    create_summaries(spark, database)
    create_states(spark, database)
    return database


@pytest.mark.parametrize("seed, files", [(1, 3), (2, 7)])
def test_incremental_equals_batch(spark, prepared, tmp_path, seed, files):
    frame = shipment_readings(lineitem(spark, MEDIUM))
    as_of = latest(frame)
    uneven = F.floor(F.pow(F.rand(seed), 3) * files)
    frame.withColumn("part", uneven).write.partitionBy("part").parquet(f"{tmp_path}/parts")
    stream = stream_documents(spark, f"{tmp_path}/parts/*", frame.schema, "parquet", max_files=1)
    catch_up(stream, ALL_TABLES, prepared, f"{tmp_path}/checkpoint", "run", as_of)
    for table in ALL_TABLES:
        assert batches(spark, prepared, table) == list(range(files))
        assert rounded(table.read(spark, prepared)) == rounded(direct(table, frame, as_of))
    for table in SUMMARY_TABLES:
        view = spark.table(f"{prepared}.{table.name}")
        assert rounded(view) == rounded(table.read(spark, prepared))


def test_only_new_readings_are_added(spark, prepared, tmp_path):
    name = f"{prepared}.{READINGS}"
    frame = event_readings(events(spark, SMALL))
    as_of = latest(frame)
    for expected in (frame, frame.union(frame)):
        append_readings(frame, name)
        stream = stream_table(spark, name, max_files=1)
        catch_up(stream, ALL_TABLES, prepared, f"{tmp_path}/checkpoint", "run", as_of)
        for table in ALL_TABLES:
            found = rounded(table.read(spark, prepared))
            assert found == rounded(direct(table, expected, as_of))


def test_runs_add_up(spark, prepared):
    frame = event_readings(events(spark, SMALL))
    (table,) = (entry for entry in STATE_TABLES if entry.summary is ENERGY)
    inputs = table.summary.select_inputs(frame)
    write_states(inputs.where("machine_id < 5"), table, prepared, "first", 0)
    write_states(inputs.where("machine_id >= 5"), table, prepared, "it's", 0)
    assert rounded(table.read(spark, prepared)) == rounded(summaries.energy_efficiency(frame))


@pytest.mark.parametrize("table", ALL_TABLES[1:4], ids=lambda table: table.name)
def test_folded_states_go_on(spark, prepared, tmp_path, table):
    frame = event_readings(events(spark, SMALL))
    as_of = fixed(latest(frame))
    source, checkpoint = f"{tmp_path}/parts", f"{tmp_path}/checkpoint"
    frame.repartition(4).write.parquet(source)
    stream = stream_documents(spark, source, frame.schema, "parquet", max_files=1)
    write_states(table.summary.select_inputs(frame, as_of), table, prepared, "old", 0)
    catch_up(stream, (table,), prepared, checkpoint, "run", as_of)
    target = f"{prepared}_folded"
    spark.sql(f"CREATE DATABASE {target} LOCATION '{tmp_path}/folded'")
    create_summaries(spark, target)
    create_states(spark, target)
    twice = frame.union(frame)
    for _ in range(2):
        fold_states(spark, table, prepared, target)
        assert batches(spark, target, table) == [0, 3]
        assert rounded(table.read(spark, target)) == rounded(direct(table, twice, as_of))
    frame.coalesce(1).write.mode("append").parquet(source)
    catch_up(stream, (table,), target, checkpoint, "run", as_of)
    assert batches(spark, target, table) == [0, 3, 4]
    thrice = twice.union(frame)
    assert rounded(table.read(spark, target)) == rounded(direct(table, thrice, as_of))
    spark.sql(f"DROP DATABASE {target} CASCADE")


def test_fold_of_inserts_without_a_stream(spark, prepared, tmp_path):
    frame = event_readings(events(spark, SMALL))
    table = STATE_TABLES[1]
    write_states(table.summary.select_inputs(frame), table, prepared, "old", 5)
    target = f"{prepared}_folded"
    spark.sql(f"CREATE DATABASE {target} LOCATION '{tmp_path}/folded'")
    create_states(spark, target)
    fold_states(spark, table, prepared, target)
    assert rounded(table.read(spark, target)) == rounded(direct(table, frame, None))
    spark.sql(f"DROP DATABASE {target} CASCADE")


@pytest.mark.parametrize("table", ALL_TABLES, ids=lambda table: table.name)
def test_states_are_sorted_in_files(spark, prepared, tmp_path, table):
    frame = shipment_readings(lineitem(spark, SMALL))
    inputs = table.summary.select_inputs(frame, latest(frame))
    write_states(inputs, table, prepared, "run", 0)
    assert table.order == ["month", "machine_id"][-len(table.summary.keys) :]
    pattern = f"{tmp_path}/tables/{table.states}/run_id=run/stream_id=none/batch_id=0/**/*.parquet"
    files = glob.glob(pattern, recursive=True)
    assert files
    for file in files:
        content = pq.ParquetFile(file)
        keys = [name for name in table.order if name in content.schema_arrow.names]
        found = list(zip(*(content.read([key])[key].to_pylist() for key in keys)))
        assert found == sorted(found)


@pytest.mark.parametrize("table", ALL_TABLES, ids=lambda table: table.name)
def test_repeated_insert_replaces_itself(spark, prepared, table):
    frame = shipment_readings(lineitem(spark, SMALL))
    as_of = latest(frame)
    inputs = table.summary.select_inputs(frame, as_of)
    write_states(inputs, table, prepared, "run", 0)
    partial = inputs.where("machine_id = 3")
    write_states(partial, table, prepared, "run", 1)
    write_states(inputs, table, prepared, "run", 1)
    write_states(partial, table, prepared, "run", 1)
    expected = frame.union(frame.where("machine_id = 3"))
    assert rounded(table.read(spark, prepared)) == rounded(direct(table, expected, as_of))


def test_restart_after_failure_counts_once(spark, prepared, tmp_path, monkeypatch):
    frame = event_readings(events(spark, SMALL))
    frame.repartition(4).write.parquet(f"{tmp_path}/parts")
    table = ALL_TABLES[0]
    stream = stream_documents(spark, f"{tmp_path}/parts", frame.schema, "parquet", max_files=1)
    calls = []

    def failing(inputs, table, database, run_id, batch_id):
        write_states(inputs, table, database, run_id, batch_id)
        calls.append(batch_id)
        if len(calls) == 2:
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(views, "write_states", failing)
    with pytest.raises(StreamingQueryException, match="lost after the write"):
        catch_up(stream, (table,), prepared, f"{tmp_path}/checkpoint", "run")
    catch_up(stream, (table,), prepared, f"{tmp_path}/checkpoint", "run")
    assert calls == [0, 1, 1, 2, 3]
    assert rounded(table.read(spark, prepared)) == rounded(direct(table, frame, None))


def test_a_failing_summary_stops_the_others(spark, prepared, tmp_path, monkeypatch):
    frame = event_readings(events(spark, SMALL))
    frame.write.parquet(f"{tmp_path}/parts")
    stream = stream_documents(spark, f"{tmp_path}/parts", frame.schema, "parquet")
    bad = STATE_TABLES[1]

    def failing(inputs, table, database, run_id, batch_id):
        if table is bad:
            raise RuntimeError("no space")
        write_states(inputs, table, database, run_id, batch_id)

    with monkeypatch.context() as patch:
        patch.setattr(views, "write_states", failing)
        with pytest.raises(StreamingQueryException, match="no space"):
            catch_up(stream, STATE_TABLES, prepared, f"{tmp_path}/checkpoint", "run", NOW)
    assert not spark.streams.active
    catch_up(stream, STATE_TABLES, prepared, f"{tmp_path}/checkpoint", "run", NOW)
    for table in STATE_TABLES:
        assert rounded(table.read(spark, prepared)) == rounded(direct(table, frame, NOW))


def test_continuous_trigger(spark, prepared, tmp_path):
    name = f"{prepared}.{READINGS}"
    frame = event_readings(events(spark, SMALL))
    append_readings(frame, name)
    table = STATE_TABLES[0]
    query = maintain(
        stream_table(spark, name),
        table,
        prepared,
        f"{tmp_path}/checkpoint",
        "run",
        trigger={"processingTime": "0 seconds"},
    )
    query.processAllAvailable()
    append_readings(frame, name)
    query.processAllAvailable()
    query.stop()
    expected = summaries.anomaly_summary(frame.union(frame), "double")
    assert rounded(table.read(spark, prepared)) == rounded(expected)


def test_time_range_ends_at_the_recorded_batch_start(spark, prepared, tmp_path):
    now = datetime.now().replace(microsecond=0)
    frame = readings(
        spark,
        {"timestamp": now, "temperature": 4.0},
        {"timestamp": now - timedelta(days=200), "temperature": 100.0},
        {"timestamp": None, "temperature": 100.0},
    )
    frame.write.parquet(f"{tmp_path}/parts")
    stream = stream_documents(spark, f"{tmp_path}/parts", frame.schema, "parquet")
    table = SUMMARY_TABLES[2]
    query = maintain(stream, table, prepared, f"{tmp_path}/checkpoint", "run")
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "current_timestamp" not in plan
    month = now.date().replace(day=1)
    assert rows(spark.table(f"{prepared}.{table.name}")) == [(month, "39", 4.0)]


def test_streamed_scan_reads_what_the_summary_needs(spark, prepared, tmp_path):
    frame = event_readings(events(spark, SMALL))
    append_readings(frame, f"{prepared}.{READINGS}")
    stream = stream_table(spark, f"{prepared}.{READINGS}")
    table = SUMMARY_TABLES[1]
    query = maintain(stream, table, prepared, f"{tmp_path}/checkpoint", "run")
    query.awaitTermination()
    schema = "struct<energy_consumption:double,machine_id:int,machine_status:string>"
    assert f"ReadSchema: {schema}" in query._jsq.explainInternal(False)


@pytest.mark.parametrize("table", [SUMMARY_TABLES[0], STATE_TABLES[0]], ids=lambda t: t.name)
def test_readings_without_time_or_machine(spark, prepared, table):
    frame = readings(
        spark,
        {"timestamp": None, "anomaly_flag": True},
        {"machine_id": None, "anomaly_flag": True},
    )
    for _ in range(2):
        write_states(table.summary.select_inputs(frame), table, prepared, "run", 0)
    month = NOW.date().replace(day=1)
    found = table.read(spark, prepared).select("machine_id", "month", "anomaly_count")
    assert rows(found) == [("39", None, 1), (None, month, 1)]


def test_a_table_of_many_files_streams_in_batches(spark, prepared, tmp_path):
    whole = lineitem(spark, SMALL)
    whole.repartition(5).write.parquet(f"{tmp_path}/lineitem.parquet")
    table = SUMMARY_TABLES[0]
    stream = shipment_readings(lineitem_stream(spark, str(tmp_path), max_bytes=1))
    catch_up(stream, (table,), prepared, f"{tmp_path}/checkpoint", "run")
    assert batches(spark, prepared, table) == list(range(5))
    expected = summaries.anomaly_summary(shipment_readings(whole))
    assert rounded(table.read(spark, prepared)) == rounded(expected)


def test_folded_run_is_reserved(spark, prepared, tmp_path):
    frame = event_readings(events(spark, SMALL))
    frame.write.parquet(f"{tmp_path}/parts")
    stream = stream_documents(spark, f"{tmp_path}/parts", frame.schema, "parquet")
    with pytest.raises(ValueError, match="folded"):
        maintain(stream, STATE_TABLES[0], prepared, f"{tmp_path}/checkpoint", "folded")


def aged(folder, days, known=()):
    """Set new files of a folder back in time."""
    for file in set(glob.glob(f"{folder}/**/*.parquet", recursive=True)) - set(known):
        past = time.time() - days * 86_400
        os.utime(file, (past, past))


@pytest.mark.parametrize("source", ["documents", "table"])
def test_files_of_any_age_are_read(spark, prepared, tmp_path, source):
    frame = event_readings(events(spark, SMALL))
    name, table = f"{prepared}.{READINGS}", STATE_TABLES[1]
    folder = f"{tmp_path}/parts" if source == "documents" else f"{tmp_path}/tables/{READINGS}"
    for days in (0, 30):
        known = glob.glob(f"{folder}/**/*.parquet", recursive=True)
        if source == "documents":
            frame.coalesce(1).write.mode("append").parquet(folder)
            stream = stream_documents(spark, folder, frame.schema, "parquet")
        else:
            append_readings(frame, name)
            stream = stream_table(spark, name)
        aged(folder, days, known)
        catch_up(stream, (table,), prepared, f"{tmp_path}/checkpoint", "run")
    assert rounded(table.read(spark, prepared)) == rounded(direct(table, frame.union(frame), None))


def test_a_run_of_another_checkpoint_is_refused(spark, prepared, tmp_path):
    frame = event_readings(events(spark, SMALL))
    frame.write.parquet(f"{tmp_path}/parts")
    table = STATE_TABLES[1]
    stream = stream_documents(spark, f"{tmp_path}/parts", frame.schema, "parquet")
    catch_up(stream, (table,), prepared, f"{tmp_path}/checkpoint", "run")
    before = rounded(table.read(spark, prepared))
    with pytest.raises(StreamingQueryException, match="belongs to another stream"):
        catch_up(stream, (table,), prepared, f"{tmp_path}/other", "run")
    with pytest.raises(ValueError, match="belongs to another stream"):
        write_states(table.summary.select_inputs(frame), table, prepared, "run", 7)
    assert rounded(table.read(spark, prepared)) == before


def test_fold_keeps_the_last_batch_of_each_run(spark, prepared, tmp_path):
    frame = event_readings(events(spark, SMALL))
    table = STATE_TABLES[1]
    inputs = table.summary.select_inputs(frame)
    for run_id, batch_id in (("a", 0), ("a", 1), ("b", 0)):
        write_states(inputs, table, prepared, run_id, batch_id)
    target = f"{prepared}_folded"
    spark.sql(f"CREATE DATABASE {target} LOCATION '{tmp_path}/folded'")
    create_states(spark, target)
    fold_states(spark, table, prepared, target)
    for run_id, batch_id in (("a", 1), ("b", 0)):
        write_states(inputs, table, target, run_id, batch_id)
    thrice = frame.union(frame).union(frame)
    assert rounded(table.read(spark, target)) == rounded(direct(table, thrice, None))
    spark.sql(f"DROP DATABASE {target} CASCADE")


def test_reading_between_a_failure_and_its_repetition(spark, prepared, tmp_path, monkeypatch):
    frame = event_readings(events(spark, SMALL))
    frame.write.parquet(f"{tmp_path}/parts")
    table = SUMMARY_TABLES[1]
    stream = stream_documents(spark, f"{tmp_path}/parts", frame.schema, "parquet")

    def failing(*args):
        write_states(*args)
        raise RuntimeError("lost after the write")

    with monkeypatch.context() as patch:
        patch.setattr(views, "write_states", failing)
        with pytest.raises(StreamingQueryException, match="lost after the write"):
            catch_up(stream, (table,), prepared, f"{tmp_path}/checkpoint", "run")
    expected = rounded(direct(table, frame, None))
    view = f"{prepared}.{table.name}"
    assert rounded(spark.table(view)) == rounded(table.read(spark, prepared)) == expected
    catch_up(stream, (table,), prepared, f"{tmp_path}/checkpoint", "run")
    assert rounded(spark.table(view)) == rounded(table.read(spark, prepared)) == expected


@pytest.mark.parametrize("table", [SUMMARY_TABLES[2], STATE_TABLES[0]], ids=lambda t: t.name)
def test_a_repeated_insert_with_fewer_months_in_dynamic_mode(spark, prepared, setting, table):
    setting("spark.sql.sources.partitionOverwriteMode", "dynamic")
    frame = shipment_readings(lineitem(spark, SMALL))
    inputs = table.summary.select_inputs(frame, latest(frame))
    write_states(inputs, table, prepared, "run", 0)
    month = inputs.agg(F.max("month_partition")).first()[0]
    fewer = inputs.where(F.col("month_partition") == month)
    write_states(fewer, table, prepared, "run", 0)
    months = table.read(spark, prepared).select("month").distinct()
    assert rows(months) == [(month,)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"


def test_a_frame_as_end_is_looked_up_once(spark, prepared, tmp_path):
    frame = event_readings(events(spark, SMALL))
    frame.write.parquet(f"{tmp_path}/parts")
    stream = stream_documents(spark, f"{tmp_path}/parts", frame.schema, "parquet")
    table = SUMMARY_TABLES[2]
    query = maintain(stream, table, prepared, f"{tmp_path}/checkpoint", "run", latest(frame))
    query.awaitTermination()
    assert "ubquery" not in query._jsq.explainInternal(False)
    assert rounded(table.read(spark, prepared)) == rounded(direct(table, frame, latest(frame)))


def test_places_with_quotes_and_names_that_are_keywords(spark, tmp_path):
    database, place = "order", f"{tmp_path}/it's here"
    create_database(spark, database, place)
    create_states(spark, database, f"{place}/tables")
    create_summaries(spark, database, f"{place}/tables")
    create_readings(spark, f"{database}.{READINGS}", properties={"a'b": "c'd"}, location=place)
    table = STATE_TABLES[1]
    frame = event_readings(events(spark, SMALL))
    write_states(table.summary.select_inputs(frame), table, database, "it's", 0)
    assert rounded(table.read(spark, database)) == rounded(direct(table, frame, None))
    spark.sql(f"DROP DATABASE {quoted_name(database)} CASCADE")


def test_the_newest_time_is_looked_up_in_the_newest_month(spark, prepared):
    frame = shipment_readings(lineitem(spark, SMALL))
    append_readings(frame, f"{prepared}.{READINGS}")
    table = spark.table(f"{prepared}.{READINGS}")
    assert rows(latest(table, partitioned=True)) == rows(latest(frame))
    assert rows(latest(table.where("false"), partitioned=True)) == [(None,)]


def test_uneven_batches_are_weighted(spark):
    def inserted(*temperatures):
        return TEMPERATURE.to_states(
            readings(spark, *({"temperature": value} for value in temperatures))
        )

    states = inserted(1.0, 2.0, 3.0).union(inserted(10.0)).union(inserted(None, None))
    assert rows(TEMPERATURE.merge_states(states)) == [(date(2025, 5, 1), "39", 4.0)]


def test_states_of_missing_values(spark):
    empty = readings(spark, {"energy_consumption": None, "machine_status": "broken"})
    states = ENERGY.to_states(empty)
    assert rows(states) == [("39", None, (None, 0), (None, 0))]
    assert rows(ENERGY.merge_states(states)) == [("39", None, None, None)]
    states = states.union(ENERGY.to_states(readings(spark, {"energy_consumption": 3.0})))
    assert rows(ENERGY.merge_states(states)) == [("39", 3.0, 3.0, 1.0)]
    assert rows(ANOMALIES.merge_states(ANOMALIES.to_states(empty))) == [
        ("39", NOW.date().replace(day=1), 0)
    ]


def test_state_columns_match_their_tables(spark):
    frame = readings(spark, {})
    for table in ALL_TABLES:
        states = table.summary.to_states(frame)
        assert states.dtypes == [
            (field.name, field.dataType.simpleString()) for field in table.summary.schema
        ]
