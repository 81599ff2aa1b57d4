"""One query per operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from contextlib import suppress
from datetime import datetime, timedelta
from functools import reduce
from itertools import accumulate

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugemill.functions.labels import failure_code, label, label_timestamp
from gaugemill.functions.parsing import HUMIDITY_LABEL, MACHINE_LABEL, parse_timestamp
from gaugemill.functions.timing import days_before, fixed, latest, year_month
from gaugemill.operators import reports, summaries
from gaugemill.operators.clean import clean_readings
from gaugemill.operators.ingest import flatten_documents, nest_readings, type_readings
from gaugemill.operators.quarantine import sort_out
from gaugemill.plans import flows
from gaugemill.plans.tables import (
    BY_MACHINE,
    DAILY_TABLES,
    EXACT_TABLES,
    READINGS,
    STATE_TABLES,
    SUMMARY_TABLES,
    SummaryTable,
    create_daily,
    create_database,
    create_exact,
    create_readings,
    create_states,
    create_summaries,
)
from gaugemill.schemas import MONTH_PARTITION, RAW_DOCUMENT, reading_table
from gaugemill.session import pin_utc
from gaugemill.sources.folders import new_staging_path
from gaugemill.sources.readers import (
    read_csv,
    read_documents,
    read_table,
    stream_documents,
    stream_table,
)
from gaugemill.sources.sample_tables import (
    csv_rows,
    event_readings,
    events,
    lineitem,
    raw_documents,
    redesigned_documents,
    shipment_documents,
    shipment_readings,
    spoiled_csv_rows,
    spoiled_documents,
)
from gaugemill.sources.variants import from_variants, read_variants
from gaugemill.sources.writers import append_documents, append_readings
from gaugemill.streaming.changes import (
    changes_name,
    create_changes,
    maintain_with_changes,
    replayed,
)
from gaugemill.streaming.compaction import compact
from gaugemill.streaming.one_scan import catch_up_together
from gaugemill.streaming.panes import trailing_temperature
from gaugemill.streaming.views import catch_up, fold_states, write_states

Query = Callable[[SparkSession, str], DataFrame]

RUN = "first"
# Shares of the rows, out of 16, that each insert brings.
INSERTS = (9, 2, 5)
MACHINE_BUCKETS = 64
# Documents repeat their names in every row. Files are bounded, as zipped ones are not divided.
JSON_FILES = {"compression": "gzip", "maxRecordsPerFile": "250000"}
# How long before the newest reading trailing ranges end.
TRAILING = (timedelta(0), timedelta(days=37, hours=7), timedelta(days=800, minutes=1))


def rounded(frame: DataFrame) -> DataFrame:
    """Averages to six places.

    The order of a distributed sum changes its last bits. The small shift keeps exact halves
    away from the point where those bits would decide the rounding.
    """
    return frame.withColumns(
        {
            name: F.round(F.col(name) + F.lit(1e-9), 6)
            for name in frame.columns
            if name.startswith("avg_")
        }
    )


# Sources, typing and documents


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_readings(read_csv(spark, _stage_csv(spark, sf_dir)))


def csv_ingest_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_staging_path(spark, "csv")
    rows = spoiled_csv_rows(events(spark, sf_dir))
    rows.write.mode("append").option("header", True).csv(path)
    return type_readings(read_csv(spark, path))


def label_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = type_readings(csv_rows(events(spark, sf_dir)))
    return typed.select(
        label_timestamp(F.col("timestamp")).alias("timestamp"),
        label(MACHINE_LABEL, F.col("machine_id")).alias("machine_id"),
        label(HUMIDITY_LABEL, F.col("humidity")).alias("humidity"),
    )


def failure_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_rows(events(spark, sf_dir)).select(
        parse_timestamp(F.col("timestamp")).alias("timestamp"),
        "machine_id",
        "failure_type",
        failure_code(F.col("failure_type")).alias("failure_code"),
    )


def nested_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_documents(nest_readings(type_readings(csv_rows(events(spark, sf_dir)))))


def document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stage_documents(spark, sf_dir)
    return clean_readings(read_documents(spark, path, schema=RAW_DOCUMENT))


def document_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_readings(read_documents(spark, _stage_documents(spark, sf_dir)))


def document_scan_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of an old and a new layout side by side, read once as variants."""
    path = new_staging_path(spark, "documents")
    documents = raw_documents(events(spark, sf_dir))
    is_old = F.pmod(F.xxhash64("_id"), F.lit(2)) == 0
    append_documents(documents.where(is_old), path)
    append_documents(redesigned_documents(documents.where(~is_old)), path)
    return clean_readings(from_variants(read_variants(spark, path)))


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that typing rejects, why, and how many rows there were of each kind."""
    path = new_staging_path(spark, "csv")
    rows = spoiled_csv_rows(events(spark, sf_dir))
    rows.write.mode("append").option("header", True).csv(path)
    found = sort_out(spark, path, f"{new_staging_path(spark, 'sorted')}/rows")
    reason = F.transform("reasons", lambda x: F.concat(x["column"], F.lit("="), x["text"]))
    return found.rejected.select(
        F.concat_ws("; ", reason).alias("reasons"),
        F.col("pressure").try_cast("double").alias("pressure"),
        "failure_type",
        F.lit(found.typed.count()).cast("long").alias("typed_stored"),
        *(
            F.lit(found.totals[name]).cast("long").alias(f"{name}_seen")
            for name in ("rows", "typed", "rejected", "timestamp", "machine_id")
        ),
    )


def clean_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_readings(raw_documents(events(spark, sf_dir)))


def clean_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_readings(raw_documents(events(spark, sf_dir)), "float")


def clean_double_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_readings(spoiled_documents(events(spark, sf_dir)))


def clean_float_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_readings(spoiled_documents(events(spark, sf_dir)), "float")


# Tables


def table_dropped_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings without a required value are left out of the table."""
    table = f"{_stage_database(spark, 'table_dropped_nulls')}.{READINGS}"
    create_readings(spark, table)
    append_readings(clean_double_dirty(spark, sf_dir), table, on_null="drop")
    return read_table(spark, table)


def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned events appended to the readings table and read back in SQL."""
    table = f"{_stage_database(spark, 'table_scan')}.{READINGS}"
    create_readings(spark, table)
    append_readings(clean_double(spark, sf_dir), table)
    return spark.sql(f"SELECT * FROM {table}").withColumn(
        "yyyymm", year_month(F.col(MONTH_PARTITION))
    )


def table_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily averages of one machine, from a table whose files lie by machine and time."""
    table = f"{_stage_database(spark, 'table_machine')}.{READINGS}"
    create_readings(spark, table, options=BY_MACHINE)
    readings = shipment_readings(lineitem(spark, sf_dir))
    append_readings(readings, table, machine_buckets=MACHINE_BUCKETS)
    stored = read_table(spark, table)
    as_of = fixed(latest(stored, partitioned=True))
    return rounded(reports.daily_averages(stored, as_of=as_of))


def table_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings over many months in the 32-bit table, counted by partition."""
    table = f"{_stage_database(spark, 'table_months')}.{READINGS}"
    create_readings(spark, table, "float")
    append_readings(_narrow(shipment_readings(lineitem(spark, sf_dir))), table)
    return (
        read_table(spark, table)
        .groupBy(year_month(F.col(MONTH_PARTITION)).alias("yyyymm"))
        .agg(F.count("*").alias("readings"), F.max("temperature").alias("max_temperature"))
    )


# Reports


def daily_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = events(spark, sf_dir)
    as_of = latest(event_readings(source))
    # The time in whole seconds hides the bound from the scan, so it is set on the raw time,
    # too. It is in whole seconds itself: both keep the same rows.
    recent = source.where(F.col("ts") >= days_before(as_of, reports.DAYS))
    return rounded(reports.daily_averages(event_readings(recent), as_of=as_of))


def daily_averages_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = shipment_readings(lineitem(spark, sf_dir))
    return rounded(reports.daily_averages(readings, as_of=latest(readings)))


def high_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.high_risk(event_readings(events(spark, sf_dir)))


def needs_maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.needs_maintenance(event_readings(events(spark, sf_dir)))


# Summaries


def anomaly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.anomaly_summary(shipment_readings(lineitem(spark, sf_dir)))


def anomaly_summary_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.anomaly_summary(clean_double(spark, sf_dir))


def energy_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(summaries.energy_efficiency(clean_double(spark, sf_dir)))


def monthly_temp(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = shipment_readings(lineitem(spark, sf_dir))
    return rounded(summaries.monthly_temp(readings, as_of=latest(readings)))


# Incremental summaries


def _plain(name: str) -> Query:
    """The summary's SQL view, fed by ``lineitem`` as a stream."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = _by_name(SUMMARY_TABLES, name)
        database = _stage_database(spark, name)
        create_summaries(spark, database)
        _feed_from_lineitem(spark, sf_dir, table, database)
        return rounded(spark.sql(f"SELECT * FROM {database}.{name}"))

    return query


def _state(name: str) -> Query:
    """The states of several inserts, merged."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        table, database = _states_of_inserts(spark, sf_dir, name)
        return rounded(table.read(spark, database))

    return query


def state_energy_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states of several inserts, folded into one and the run's last."""
    table, database = _states_of_inserts(spark, sf_dir, "agg_energy_efficiency")
    folded = _stage_database(spark, "folded")
    create_states(spark, folded)
    fold_states(spark, table, database, folded)
    return rounded(table.read(spark, folded))


def state_anomaly_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments dealt to two runs; both are folded, then one repeats its last batch there."""
    table = _by_name(STATE_TABLES, "agg_monthly_anomaly_counts")
    database, folded = _stage_database(spark, "two_runs"), _stage_database(spark, "two_folded")
    create_states(spark, database)
    create_states(spark, folded)
    parts = _parts(lineitem(spark, sf_dir))
    inserts = [table.summary.select_inputs(shipment_readings(part)) for part in parts]
    for run_id, batch_id, part in (("a", 0, 0), ("b", 0, 1), ("b", 1, 2)):
        write_states(inserts[part], table, database, run_id, batch_id)
    fold_states(spark, table, database, folded)
    write_states(inserts[2], table, folded, "b", 1)
    return rounded(table.read(spark, folded))


def _states_of_inserts(
    spark: SparkSession, sf_dir: str, name: str
) -> tuple[SummaryTable, str]:
    """States over months come from shipments, which span many; the others from events."""
    table = _by_name(STATE_TABLES, name)
    database = _stage_database(spark, name)
    create_states(spark, database)
    if "month" in table.summary.keys:
        documents = shipment_documents(lineitem(spark, sf_dir))
        as_of = _end_of(table, shipment_readings(lineitem(spark, sf_dir)))
    else:
        documents, as_of = raw_documents(events(spark, sf_dir)), None
    path = new_staging_path(spark, "documents")
    stream = clean_readings(stream_documents(spark, path, RAW_DOCUMENT))
    _insert_parts(spark, documents, path, "json", stream, table, database, as_of)
    return table, database


def _feed_from_lineitem(
    spark: SparkSession, sf_dir: str, table: SummaryTable, database: str
) -> None:
    source = lineitem(spark, sf_dir)
    path = new_staging_path(spark, "lineitem")
    stream = shipment_readings(stream_documents(spark, path, source.schema, "parquet"))
    as_of = _end_of(table, shipment_readings(source))
    _insert_parts(spark, source, path, "parquet", stream, table, database, as_of)


def _insert_parts(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    fmt: str,
    stream: DataFrame,
    table: SummaryTable,
    database: str,
    as_of: str | None,
) -> None:
    """Append the source to a folder part by part, and catch up after each."""
    checkpoint = new_staging_path(spark, "checkpoint")
    options = JSON_FILES if fmt == "json" else None
    for part in _parts(source):
        append_documents(part, path, fmt, options=options, id_column=None)
        catch_up(stream, (table,), database, checkpoint, RUN, as_of)


def _parts(source: DataFrame, sizes: Sequence[int] = INSERTS) -> list[DataFrame]:
    """All rows, dealt unevenly."""
    share = F.pmod(F.xxhash64(*source.columns[:3]), F.lit(sum(sizes)))
    ends = list(accumulate(sizes))
    return [source.where((share >= end - size) & (share < end)) for size, end in zip(sizes, ends)]


def _end_of(table: SummaryTable, readings: DataFrame) -> str | None:
    return None if table.summary.months is None else fixed(latest(readings))


def views_one_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three views from one stream: per machine, and the rows that the stream has read."""
    source = lineitem(spark, sf_dir)
    database = _stage_database(spark, "views_one_scan")
    create_summaries(spark, database)
    path = new_staging_path(spark, "lineitem")
    stream = shipment_readings(stream_documents(spark, path, source.schema, "parquet"))
    as_of = fixed(latest(shipment_readings(source)))
    checkpoint, read = new_staging_path(spark, "checkpoint"), 0
    for part in _parts(source):
        part.write.mode("append").parquet(path)
        read += catch_up_together(stream, SUMMARY_TABLES, database, checkpoint, RUN, as_of)
    anomalies, energy, temperature = (
        spark.table(f"{database}.{table.name}") for table in SUMMARY_TABLES
    )
    return rounded(
        energy.join(
            anomalies.groupBy("machine_id").agg(F.sum("anomaly_count").alias("anomalies")),
            "machine_id",
        )
        .join(
            temperature.groupBy("machine_id").agg(
                F.count("*").alias("months"), F.avg("avg_temperature").alias("avg_of_months")
            ),
            "machine_id",
            "left",
        )
        .withColumn("rows_read", F.lit(read).cast("long"))
    )


def state_anomaly_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments in seven inserts, merged by size after each; the last one is repeated."""
    table = _by_name(STATE_TABLES, "agg_monthly_anomaly_counts")
    database = _stage_database(spark, "compacted")
    create_states(spark, database)
    parts = _parts(lineitem(spark, sf_dir), (3, 1, 4, 1, 5, 1, 1))
    inserts = [table.summary.select_inputs(shipment_readings(part)) for part in parts]
    for batch_id, insert in enumerate(inserts):
        write_states(insert, table, database, RUN, batch_id)
        compact(spark, table, database)
    write_states(inserts[-1], table, database, RUN, len(inserts) - 1)
    return table.read(spark, database)


def state_anomaly_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies as a second stream has put them together from the changes of each batch."""
    table = _by_name(STATE_TABLES, "agg_monthly_anomaly_counts")
    source, database = lineitem(spark, sf_dir), _stage_database(spark, "replayed")
    create_states(spark, database)
    create_changes(spark, table, database)
    path, copy = new_staging_path(spark, "lineitem"), new_staging_path(spark, "copy")
    stream = shipment_readings(stream_documents(spark, path, source.schema, "parquet"))
    first, second = new_staging_path(spark, "checkpoint"), new_staging_path(spark, "checkpoint")
    for part in _parts(source):
        part.write.mode("append").parquet(path)
        maintain_with_changes(stream, table, database, first, RUN).awaitTermination()
        (
            stream_table(spark, changes_name(table, database))
            .writeStream.format("parquet")
            .option("checkpointLocation", second)
            .trigger(availableNow=True)
            .start(f"{copy}/changes")
            .awaitTermination()
        )
    return replayed(read_documents(spark, f"{copy}/changes", "parquet"), table)


def exact_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Energy from the states of several inserts, to the last bit."""
    return _exact(spark, sf_dir, "exact_energy_efficiency")


def exact_temp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly temperature from the states of several inserts, to the last bit."""
    return _exact(spark, sf_dir, "exact_monthly_temp")


def _exact(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, source = _by_name(EXACT_TABLES, name), lineitem(spark, sf_dir)
    database = _stage_database(spark, name)
    create_exact(spark, database)
    as_of = _end_of(table, shipment_readings(source))
    for batch_id, part in enumerate(_parts(source)):
        inputs = table.summary.select_inputs(shipment_readings(part), as_of)
        write_states(inputs, table, database, RUN, batch_id)
    return table.read(spark, database)


def temp_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature of the three months before each of three moments, from states by day."""
    (table,) = DAILY_TABLES
    source = lineitem(spark, sf_dir)
    database = _stage_database(spark, "temp_trailing")
    name, checkpoint = f"{database}.{READINGS}", new_staging_path(spark, "checkpoint")
    create_readings(spark, name)
    create_daily(spark, database)
    for part in _parts(source):
        append_readings(shipment_readings(part), name)
        catch_up(stream_table(spark, name), DAILY_TABLES, database, checkpoint, RUN)
    readings = read_table(spark, name)
    end = datetime.fromisoformat(fixed(latest(readings)))
    found = []
    for back in TRAILING:
        moment = F.lit(end - back).cast("timestamp")
        trailing = trailing_temperature(readings, table, database, moment)
        found.append(trailing.withColumn("as_of", moment))
    return reduce(DataFrame.unionByName, found)


# Flows


def ingest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_staging_path(spark, "documents")
    flows.run_ingest(spark, _stage_csv(spark, sf_dir), target)
    return clean_readings(read_documents(spark, target, schema=RAW_DOCUMENT)).drop("_id")


def native_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = lineitem(spark, sf_dir)
    _, results = _run_native(spark, shipment_documents(source), shipment_readings(source))
    return rounded(results["daily_averages"])


def native_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = events(spark, sf_dir)
    database, _ = _run_native(spark, raw_documents(source), event_readings(source))
    return rounded(spark.table(f"{database}.sp_energy_efficiency"))


def native_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow is called twice for the same documents; the first call fails once they are stored."""
    source = lineitem(spark, sf_dir)
    database = _stage_database(spark, "native_repeated")
    arguments = shipment_documents(source), database, new_staging_path(spark, "checkpoint"), RUN
    stop = F.raise_error(F.lit("stopped after the append")).cast("timestamp")
    with suppress(PySparkException):
        flows.run_native(spark, *arguments, as_of=stop, insert_id="shipments")
    as_of = fixed(latest(shipment_readings(source)))
    flows.run_native(spark, *arguments, as_of=as_of, insert_id="shipments")
    stored = read_table(spark, f"{database}.{READINGS}").groupBy(
        F.col("machine_id").cast("string").alias("machine_id"),
        F.col(MONTH_PARTITION).alias("month"),
    )
    counted = stored.agg(F.count("*").alias("readings"))
    return counted.join(spark.table(f"{database}.sp_anomaly_summary"), ["machine_id", "month"])


def float_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The float readings of one insert as states, as they go along with a JDBC write."""
    database = _stage_database(spark, "float_states")
    source = lineitem(spark, sf_dir)
    readings = clean_readings(shipment_documents(source), "float")
    as_of = fixed(latest(shipment_readings(source)))
    flows.load_states(spark, readings, database, RUN, 0, as_of=as_of)
    return rounded(_by_name(STATE_TABLES, "agg_monthly_temp").read(spark, database))


def _run_native(
    spark: SparkSession, documents: DataFrame, readings: DataFrame
) -> tuple[str, dict[str, DataFrame]]:
    database = _stage_database(spark, "native")
    results = flows.run_native(
        spark,
        documents,
        database,
        new_staging_path(spark, "checkpoint"),
        RUN,
        as_of=fixed(latest(readings)),
    )
    return database, results


# Staged inputs


def _stage_csv(spark: SparkSession, sf_dir: str) -> str:
    path = new_staging_path(spark, "csv")
    csv_rows(events(spark, sf_dir)).write.mode("append").option("header", True).csv(path)
    return path


def _stage_documents(spark: SparkSession, sf_dir: str) -> str:
    """The event documents as JSON."""
    path = new_staging_path(spark, "documents")
    append_documents(raw_documents(events(spark, sf_dir)), path)
    return path


_STAGED: dict[tuple[str, str], str] = {}  # the database of each query's last run


def _stage_database(spark: SparkSession, name: str) -> str:
    """A database of this run. That of the query's run before goes, with its tables' files."""
    key = spark.sparkContext.applicationId, name
    if key in _STAGED:
        spark.sql(f"DROP DATABASE IF EXISTS {_STAGED[key]} CASCADE")
    _STAGED[key] = database = f"{name}_{uuid.uuid4().hex}"
    create_database(spark, database, new_staging_path(spark, name))
    return database


def _narrow(readings: DataFrame) -> DataFrame:
    return readings.select(
        *(
            F.col(field.name).cast(field.dataType).alias(field.name)
            for field in reading_table("float")
        )
    )


def _by_name(tables: tuple[SummaryTable, ...], name: str) -> SummaryTable:
    return next(table for table in tables if table.name == name)


QUERIES: dict[str, Query] = {
    "csv_ingest": csv_ingest,
    "csv_ingest_dirty": csv_ingest_dirty,
    "label_values": label_values,
    "failure_code": failure_codes,
    "nest_readings": nested_readings,
    "document_scan": document_scan,
    "document_scan_inferred": document_scan_inferred,
    "document_scan_drift": document_scan_drift,
    "csv_quarantine": csv_quarantine,
    "clean_double": clean_double,
    "clean_float": clean_float,
    "clean_double_dirty": clean_double_dirty,
    "clean_float_dirty": clean_float_dirty,
    "table_scan": table_scan,
    "table_dropped_nulls": table_dropped_nulls,
    "table_machine": table_machine,
    "table_months": table_months,
    "daily_averages": daily_averages,
    "daily_averages_shipments": daily_averages_shipments,
    "high_risk": high_risk,
    "needs_maintenance": needs_maintenance,
    "anomaly_summary": anomaly_summary,
    "anomaly_summary_events": anomaly_summary_events,
    "energy_efficiency": energy_efficiency,
    "monthly_temp": monthly_temp,
    "mv_anomaly": _plain("sp_anomaly_summary"),
    "mv_energy": _plain("sp_energy_efficiency"),
    "mv_monthly_temp": _plain("sp_monthly_temp"),
    "state_anomaly": _state("agg_monthly_anomaly_counts"),
    "state_energy": _state("agg_energy_efficiency"),
    "state_temp": _state("agg_monthly_temp"),
    "state_energy_folded": state_energy_folded,
    "state_anomaly_two_runs": state_anomaly_two_runs,
    "views_one_scan": views_one_scan,
    "state_anomaly_compacted": state_anomaly_compacted,
    "state_anomaly_replayed": state_anomaly_replayed,
    "exact_energy": exact_energy,
    "exact_temp": exact_temp,
    "temp_trailing": temp_trailing,
    "ingest_run": ingest_run,
    "native_run": native_run,
    "native_energy": native_energy,
    "native_repeated": native_repeated,
    "float_states": float_states,
}


def all_queries() -> dict[str, Query]:
    def pinned(query: Query) -> Query:
        return lambda spark, sf_dir: query(pin_utc(spark), sf_dir)

    return {name: pinned(query) for name, query in QUERIES.items()}
