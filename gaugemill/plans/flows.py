"""The complete flows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from gaugemill.functions.timing import AsOf, resolved
from gaugemill.operators.clean import clean_readings
from gaugemill.operators.ingest import nest_readings, type_readings
from gaugemill.operators.reports import all_reports
from gaugemill.plans.tables import (
    READINGS,
    READINGS_JDBC,
    STATE_TABLES,
    SUMMARY_TABLES,
    create_database,
    create_readings,
    create_states,
    create_summaries,
    quoted_name,
)
from gaugemill.sources.folders import staged
from gaugemill.sources.readers import read_csv, read_table, stream_table
from gaugemill.sources.writers import (
    append_documents,
    append_insert,
    append_jdbc,
    append_readings,
)
from gaugemill.streaming.one_scan import catch_up_together
from gaugemill.streaming.views import write_states


def run_ingest(
    spark: SparkSession,
    csv_path: str,
    target: str | None = None,
    fmt: str = "json",
    options: Mapping[str, str] | None = None,
    insert_id: str | None = None,
) -> None:
    """CSV rows, typed and nested, appended to a document collection; with ``insert_id`` once."""
    documents = nest_readings(type_readings(read_csv(spark, csv_path)))
    append_documents(documents, target, fmt, options=options, insert_id=insert_id)


def run_native(
    spark: SparkSession,
    documents: DataFrame,
    database: str,
    checkpoint: str,
    run_id: str,
    *,
    location: str | None = None,
    as_of: AsOf = None,
    on_null: str = "raise",
    max_bytes: int | None = None,
    insert_id: str | None = None,
) -> dict[str, DataFrame]:
    """Clean documents into the readings table, update the summaries, return the reports.

    With the same ``checkpoint`` and ``run_id``, a later call summarises only the readings
    that were appended since. With an ``insert_id`` for these documents a call that failed
    anywhere is repeated as it is: readings are stored once and count once. Without one it
    appends the documents it is given, so that a call that failed is not repeated: where
    ``append_readings`` had failed, nothing was written; where it had ended, go on with
    ``summarise_native``. A table takes inserts of one kind only. Where the catalog does not
    outlive the driver, give a ``location``, so that a later session finds the tables' files
    again.
    """
    table = f"{database}.{READINGS}"
    create_database(spark, database)
    create_readings(spark, table, location=location, by_insert=insert_id is not None)
    create_summaries(spark, database, location)
    cleaned = clean_readings(documents)
    if insert_id is None:
        append_readings(cleaned, table, on_null=on_null)
    else:
        append_insert(cleaned, quoted_name(table), insert_id, on_null)
    return summarise_native(
        spark, database, checkpoint, run_id, as_of=as_of, max_bytes=max_bytes
    )


def summarise_native(
    spark: SparkSession,
    database: str,
    checkpoint: str,
    run_id: str,
    *,
    as_of: AsOf = None,
    max_bytes: int | None = None,
) -> dict[str, DataFrame]:
    """The second half of ``run_native``: can be repeated, and appends nothing."""
    table = quoted_name(f"{database}.{READINGS}")
    as_of = resolved(as_of)
    catch_up_together(
        stream_table(spark, table, max_bytes=max_bytes),
        SUMMARY_TABLES,
        database,
        checkpoint,
        run_id,
        as_of,
    )
    readings = read_table(spark, table)
    return {name: report(readings) for name, report in all_reports(as_of).items()}


def run_jdbc(
    spark: SparkSession,
    documents: DataFrame,
    url: str,
    database: str,
    run_id: str,
    batch_id: int,
    *,
    table: str = READINGS_JDBC,
    location: str | None = None,
    as_of: AsOf = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Clean documents into a database table and add the states of this insert.

    The cleaned readings are staged, so that the documents are parsed once for all of it. A
    database keeps what it was sent: after a failure, clear the table of this insert's rows
    before repeating the call, or, if only the states are missing, call ``load_states`` with
    the same ``batch_id``, which replaces them.
    """
    with staged(clean_readings(documents, "float"), "readings") as readings:
        append_jdbc(readings, url, table, properties=properties)
        load_states(spark, readings, database, run_id, batch_id, location=location, as_of=as_of)


def load_states(
    spark: SparkSession,
    readings: DataFrame,
    database: str,
    run_id: str,
    batch_id: int,
    *,
    location: str | None = None,
    as_of: AsOf = None,
) -> None:
    """Add one insert to the state tables; the same ``batch_id`` again replaces it."""
    create_database(spark, database)
    create_states(spark, database, location)
    for table in STATE_TABLES:
        inputs = table.summary.select_inputs(readings, as_of)
        write_states(inputs, table, database, run_id, batch_id)
