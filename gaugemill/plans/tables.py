"""Table definitions: the readings table and the summary tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from gaugemill.operators.states import (
    ANOMALIES,
    ANOMALIES_AS_DOUBLE,
    DAILY_TEMPERATURE,
    ENERGY,
    EXACT_ENERGY,
    EXACT_TEMPERATURE,
    TEMPERATURE,
    Summary,
)
from gaugemill.schemas import MONTH_PARTITION, ddl, reading_table
from gaugemill.sources.folders import make_folder
from gaugemill.sources.inserts import INSERT_ID, quoted

READINGS = "sensor_data"
READINGS_JDBC = "sensor_data_jdbc"
# For tables whose files lie by machine (``append_readings`` with ``machine_buckets``).
BY_MACHINE = {"parquet.bloom.filter.enabled#machine_id": "true"}

# Every insert leaves its states in a partition of its own, so that repeating it replaces
# them. See ``streaming.views``.
# ``stream_id`` is the identity that a stream keeps in its checkpoint, so that another stream
# cannot take over a run; inserts without a stream share one.
# ``until`` is the batch after the last one in it: the next one, but for merged inserts, which
# ``streaming.compaction`` makes.
INSERT_COLUMNS = {
    "run_id": "STRING",
    "stream_id": "STRING",
    "batch_id": "BIGINT",
    "until": "BIGINT",
}
NO_STREAM = "none"


@dataclass(frozen=True)
class SummaryTable:
    """Where the states of a summary are kept.

    A ``plain`` table shows final values under its name; its states are in ``<name>_states``.
    The view ``live`` leaves out what merged inserts have replaced.
    """

    name: str
    summary: Summary
    by_month: bool = False
    plain: bool = False

    @property
    def states(self) -> str:
        return f"{self.name}_states" if self.plain else self.name

    @property
    def partitions(self) -> list[str]:
        return [*INSERT_COLUMNS, *(["month"] if self.by_month else [])]

    @property
    def order(self) -> list[str]:
        """How rows are sorted within a file."""
        return [key for key in ("month", "day", "machine_id") if key in self.summary.keys]

    def read(self, spark: SparkSession, database: str) -> DataFrame:
        """Final values, merged from the states of all inserts."""
        return self.summary.merge_states(self.live_states(spark, database))

    def live_states(self, spark: SparkSession, database: str) -> DataFrame:
        """The states of all inserts, each once.

        Streams write in sessions of their own; the file list of this one is renewed.
        """
        spark.catalog.refreshTable(self.qualified(database))
        return spark.table(self.live(database))

    def qualified(self, database: str) -> str:
        return quoted_name(f"{database}.{self.states}")

    def live(self, database: str) -> str:
        return quoted_name(f"{database}.{self.states}_live")


# The names under which the summaries are published.
SUMMARY_TABLES = (
    SummaryTable("sp_anomaly_summary", ANOMALIES, plain=True),
    SummaryTable("sp_energy_efficiency", ENERGY, plain=True),
    SummaryTable("sp_monthly_temp", TEMPERATURE, by_month=True, plain=True),
)
STATE_TABLES = (
    SummaryTable("agg_monthly_anomaly_counts", ANOMALIES_AS_DOUBLE, by_month=True),
    SummaryTable("agg_energy_efficiency", ENERGY),
    SummaryTable("agg_monthly_temp", TEMPERATURE, by_month=True),
)
EXACT_TABLES = (
    SummaryTable("exact_energy_efficiency", EXACT_ENERGY),
    SummaryTable("exact_monthly_temp", EXACT_TEMPERATURE, by_month=True),
)
DAILY_TABLES = (SummaryTable("agg_daily_temp", DAILY_TEMPERATURE, by_month=True),)


def quoted_name(name: str) -> str:
    """A name of several parts, divided by dots, for SQL. Parts may be quoted already."""
    parts = (part.strip("`").replace("`", "``") for part in name.split("."))
    return ".".join(f"`{part}`" for part in parts)


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    at = f" LOCATION {quoted(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted_name(database)}{at}")


# With a ``location``, tables keep their files in folders of that name there, and files
# found in them belong to the table. A catalog that forgets its tables, as the in-memory one
# does when the driver ends, can so be filled again.


def create_readings(
    spark: SparkSession,
    table: str,
    float_type: str = "double",
    provider: str = "parquet",
    properties: Mapping[str, str] | None = None,
    location: str | None = None,
    by_insert: bool = False,
    options: Mapping[str, str] | None = None,
) -> None:
    """The readings table, partitioned by month; ``properties`` are the provider's own.

    With ``by_insert`` the months are parts of inserts, which can be repeated
    (``sources.writers.append_insert``); their ``insert_id`` is one more column. ``options`` are
    for the provider's files, such as ``BY_MACHINE``.
    """
    columns = ddl(reading_table(float_type)) + (f", {INSERT_ID} STRING" if by_insert else "")
    months = f"{INSERT_ID}, {MONTH_PARTITION}" if by_insert else MONTH_PARTITION
    statements = {
        table: f"CREATE TABLE IF NOT EXISTS {quoted_name(table)} ({columns}) "
        f"USING {provider} "
        + (f"OPTIONS ({_pairs(options)}) " if options else "")
        + f"PARTITIONED BY ({months})"
        + _at(location, table.split(".")[-1])
        + (f" TBLPROPERTIES ({_pairs(properties)})" if properties else "")
    }
    _run_all(spark, statements | _found_partitions(spark, [table], location))


def _pairs(settings: Mapping[str, str]) -> str:
    return ", ".join(f"{quoted(key)} = {quoted(value)}" for key, value in settings.items())


def create_summaries(spark: SparkSession, database: str, location: str | None = None) -> None:
    """The summaries with final values."""
    _create_all(spark, database, SUMMARY_TABLES, location)


def create_states(spark: SparkSession, database: str, location: str | None = None) -> None:
    """The summaries with mergeable states."""
    _create_all(spark, database, STATE_TABLES, location)


def create_exact(spark: SparkSession, database: str, location: str | None = None) -> None:
    """The summaries whose states don't depend on the order of inserts."""
    _create_all(spark, database, EXACT_TABLES, location)


def create_daily(spark: SparkSession, database: str, location: str | None = None) -> None:
    """The states by day, for trailing ranges."""
    _create_all(spark, database, DAILY_TABLES, location)


def _at(location: str | None, name: str) -> str:
    return " LOCATION " + quoted(f"{location}/{name}") if location else ""


def _found_partitions(
    spark: SparkSession, tables: list[str], location: str | None
) -> dict[str, str]:
    """Statements that take over the files found at the location of tables yet to be made."""
    if location is None:
        return {}
    new = [table for table in tables if not spark.catalog.tableExists(table)]
    for table in new:
        make_folder(spark, f"{location}/{table.split('.')[-1]}")
    return {f"partitions of {table}": f"MSCK REPAIR TABLE {quoted_name(table)}" for table in new}


def _create_all(
    spark: SparkSession, database: str, tables: tuple[SummaryTable, ...], location: str | None
) -> None:
    names = [f"{database}.{table.states}" for table in tables]
    statements = _definitions(database, tables, location)
    _run_all(spark, statements | _found_partitions(spark, names, location))


def _definitions(
    database: str, tables: tuple[SummaryTable, ...], location: str | None
) -> dict[str, str]:
    statements = {}
    for table in tables:
        states = table.qualified(database)
        inserts = ", ".join(f"{name} {kind}" for name, kind in INSERT_COLUMNS.items())
        statements[table.states] = (
            f"CREATE TABLE IF NOT EXISTS {states} ({ddl(table.summary.schema)}, {inserts}) "
            f"USING parquet PARTITIONED BY ({', '.join(table.partitions)})"
            + _at(location, table.states)
        )
        statements[f"{table.states}_live"] = (
            f"CREATE VIEW IF NOT EXISTS {table.live(database)} AS SELECT * FROM {states}"
        )
        if table.plain:
            statements[table.name] = (
                f"CREATE VIEW IF NOT EXISTS {quoted_name(f'{database}.{table.name}')} AS "
                f"{table.summary.merge_sql(table.live(database))}"
            )
    return statements


def _run_all(spark: SparkSession, statements: Mapping[str, str]) -> None:
    """Run every statement, then report all that failed."""
    failures = {}
    for name, statement in statements.items():
        try:
            spark.sql(statement)
        except PySparkException as error:
            failures[name] = error
    if failures:
        report = "; ".join(f"{name}: {error}" for name, error in failures.items())
        raise RuntimeError(f"{len(failures)} of {len(statements)} statements failed: {report}")
