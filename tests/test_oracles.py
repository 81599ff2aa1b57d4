"""Every query against its SQL on the same files."""

from __future__ import annotations

import glob
import os
import re

import duckdb
import pytest
from conftest import MEDIUM, SMALL, plan_of

import __spark_entry__ as entry_point
from gaugemill.plans import catalogue
from gaugemill.plans.catalogue import all_queries
from gaugemill.plans.oracles import ORACLES
from gaugemill.plans.tables import STATE_TABLES, SUMMARY_TABLES
from gaugemill.schemas import RAW_DOCUMENT
from gaugemill.streaming.views import inserts_of

QUERIES = all_queries()
_STAGED_NAMES = {
    "mv_anomaly": "sp_anomaly_summary",
    "mv_energy": "sp_energy_efficiency",
    "mv_monthly_temp": "sp_monthly_temp",
    "state_anomaly": "agg_monthly_anomaly_counts",
    "state_energy": "agg_energy_efficiency",
    "state_temp": "agg_monthly_temp",
}
KINDS = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{MEDIUM}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


def databases(spark):
    return {row[0] for row in spark.sql("SHOW DATABASES").collect()}


def test_a_second_run_replaces_the_database_of_the_first(spark):
    QUERIES["table_months"](spark, SMALL).collect()
    before = databases(spark)
    QUERIES["table_months"](spark, SMALL).collect()
    assert len(databases(spark)) == len(before)


def test_the_time_bound_reaches_the_scan(spark):
    frame = QUERIES["daily_averages"](spark, SMALL)
    frame.collect()
    assert re.search(r"PushedFilters: \[[^]]*IsNotNull\(ts\)", plan_of(frame))
    assert re.search(r"DataFilters: \[[^]]*ts#\d+ >= (Scalar|scalar-)?[sS]ubquery", plan_of(frame))


@pytest.mark.parametrize("name", ["mv_anomaly", "mv_energy", "mv_monthly_temp", "state_anomaly", "state_energy", "state_temp"])
def test_incremental_queries_merge_several_batches(spark, name):
    QUERIES[name](spark, SMALL).collect()
    table = next(
        table
        for table in SUMMARY_TABLES + STATE_TABLES
        if _STAGED_NAMES[name] == table.name
    )
    staged = catalogue._STAGED[spark.sparkContext.applicationId, table.name]
    assert len(inserts_of(spark, table, staged)) == len(catalogue.INSERTS)


@pytest.mark.parametrize("name", ["state_temp", "float_states", "native_run", "daily_averages_shipments", "monthly_temp", "mv_monthly_temp"])
def test_time_ranges_cut(tables, name):
    sql = ORACLES[name]
    start = sql.rindex('"timestamp" >=')
    end = sql.index("GROUP BY", start)
    cut = tables.execute(sql).fetchall()
    assert sorted(cut, key=repr) != sorted(
        tables.execute(sql[:start] + "true " + sql[end:]).fetchall(), key=repr
    )


def test_entry(spark):
    assert entry_point.entry(spark).count() == 15


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, tables, name):
    cursor = tables.execute(ORACLES[name])
    kinds = {column[0]: str(column[1]) for column in cursor.description}
    expected = cursor.fetchall()
    names = list(kinds)
    frame = QUERIES[name](spark, MEDIUM)
    assert {column: KINDS[kind] for column, kind in frame.dtypes} == kinds
    found = [tuple(row[column] for column in names) for row in frame.collect()]
    assert len(found) > 0
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    if name == "daily_averages":
        assert found == expected


def test_results_stay_readable_after_other_runs(spark):
    first = QUERIES["csv_ingest"](spark, SMALL)
    second = QUERIES["csv_ingest"](spark, SMALL)
    assert first.count() == second.count() == 1000


@pytest.mark.parametrize("name", ["state_anomaly", "state_temp", "state_energy"])
def test_documents_of_inserts_are_stored_in_little_room(spark, monkeypatch, name):
    folders, new = [], catalogue.new_staging_path

    def remembered(spark, name):
        folders.append(new(spark, name))
        return folders[-1]

    monkeypatch.setattr(catalogue, "new_staging_path", remembered)
    QUERIES[name](spark, SMALL)
    (folder,) = (path for path in folders if "/documents-" in path)
    files = glob.glob(f"{folder.removeprefix('file:')}/part-*")
    documents = spark.read.schema(RAW_DOCUMENT).json(folder)
    size = documents.selectExpr("sum(length(to_json(struct(*))) + 1)").first()[0]
    assert documents.count() > 0 and sum(map(os.path.getsize, files)) < size / 4
