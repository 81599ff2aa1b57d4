from __future__ import annotations

import duckdb
import pytest
from conftest import SMALL, rows
from llm_support import ODD_PAIRS, make_documents, words
from test_near_dedup import classes

import __spark_entry__ as entry_point
import corpus_pipeline
from gaugemill.llm.oracles import ORACLES
from gaugemill.llm.pii import find_entities
from gaugemill.llm.queries import QUERIES
from gaugemill.plans.catalogue import all_queries

TABLES = ("documents", "pages", "benchmark")


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(entry_point.queries()) == set(all_queries()) | set(QUERIES) | {"pipeline"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    cursor = connection.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    frame = QUERIES[name](spark, SMALL)
    assert sorted(frame.columns) == sorted(names)
    assert rows(frame.select(*names)) == sorted(cursor.fetchall(), key=repr)


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given, results = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, given, SMALL).write.parquet(f"{tmp_path}/{name}")
        result = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "best_fit_packing":
            assert result.schema == docs.schema
        results[name] = given, result
        given = result

    def pairs(frame):
        return [tuple(row) for row in frame.select("doc_id", "text").collect()]

    before, after = results["quality_classifier"]
    labels = dict(spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality").collect())
    dropped = {i for i, _ in pairs(before)} - {i for i, _ in pairs(after)}
    assert not [i for i in dropped if labels.get(i) == 1]

    before, after = results["near_dedup"]
    winners = {(row[1],) for row in classes(pairs(before))}
    assert {(i,) for i, _ in pairs(after)} == winners

    before, after = results["benchmark_decontamination"]
    windows = set()
    for row in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        own = words(row.text)
        size = min(10, len(own))
        windows |= {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
    sizes = {len(window) for window in windows}
    clean = [
        (i, text)
        for i, text in pairs(before)
        if not any(tuple(words(text)[at : at + n]) in windows for n in sizes for at in range(len(words(text)) - n + 1))
    ]
    assert sorted(pairs(after)) == sorted(clean)

    before, after = results["pii_surrogates"]
    texts = dict(pairs(after))
    for i, text in pairs(before):
        for start, end, *_ in find_entities(text):
            assert text[start:end] not in texts[i]
        if not find_entities(text):
            assert texts[i] == text
    assert after.where("n_chars <> length(text)").count() == 0

    before, after = results["best_fit_packing"]
    assert {row.doc_id for row in after.collect()} == {i for i, _ in pairs(before)}


def test_stages_take_odd_and_no_rows(spark, tmp_path):
    for number, pairs in enumerate([ODD_PAIRS, []]):
        docs = make_documents(spark, pairs)
        for name, stage in corpus_pipeline.STAGES:
            path = f"{tmp_path}/{number}-{name}"
            stage(spark, docs, SMALL).write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.count() >= (5 if pairs else 0)


def test_run(spark):
    packed = corpus_pipeline.run(spark, SMALL)
    assert packed.count() > 100
    assert corpus_pipeline.ORACLE_SQL is None
