from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from conftest import SMALL, plan_of
from llm_support import ODD_PAIRS, make_documents, paths, words

from gaugemill.llm import backoff_lm, queries
from gaugemill.llm.backoff_lm import score_documents


def expected(pairs, order):
    docs = [words(text) for _, text in pairs]
    own = [
        Counter(tuple(w[i - n + 1 : i + 1]) for n in range(1, order + 1) for i in range(n - 1, len(w)))
        for w in docs
    ]
    corpus, size = Counter(), sum(map(len, docs))
    for counts in own:
        corpus.update(counts)
    result = []
    for (doc, _), w, counts in zip(pairs, docs, own):
        total, known = 0.0, 0
        for i in range(len(w)):
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(w[i - n + 1 : i + 1])
                others = corpus[gram] - counts[gram]
                known += n == order and others > 0
                if n > 1 and others > 0:
                    total += math.log(others / (corpus[gram[:-1]] - counts[gram[:-1]]))
                elif n == 1:
                    total += math.log(max(others, 0.5) / max(size - len(w), 1))
                else:
                    continue
                total += (order - n) * math.log(0.4)
                break
        result.append((doc, len(w), known, total / len(w) if w else None))
    return result


def assert_same(frame, wanted):
    def place(row):
        return row[0] is None, row[0] or 0, row[1], row[3] or 0

    found = sorted((tuple(row) for row in frame.collect()), key=place)
    wanted = sorted(wanted, key=place)
    assert [row[:3] for row in found] == [row[:3] for row in wanted]
    assert [row[3] for row in found] == [
        None if row[3] is None else pytest.approx(row[3], abs=1e-9) for row in wanted
    ]


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("chunk", [50, 1 << 21])
def test_equals_brute_force(spark, tmp_path, monkeypatch, order, chunk):
    monkeypatch.setattr(backoff_lm, "PARTITION_WORDS", 5000)
    given = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    pairs = [tuple(row) for row in given.select("doc_id", "text").collect()] + ODD_PAIRS
    assert_same(score_documents(make_documents(spark, pairs), paths(tmp_path), order), expected(pairs, order))


def test_empty_table_and_one_document(spark, tmp_path):
    new = paths(tmp_path)
    assert score_documents(make_documents(spark, []), new).count() == 0
    assert_same(score_documents(make_documents(spark, [(1, "a b a b")]), new), expected([(1, "a b a b")], 2))


def test_a_hot_word(spark, tmp_path):
    pairs = [(i, "the " * 30 + f"x{i}") for i in range(50)]
    assert_same(score_documents(make_documents(spark, pairs), paths(tmp_path)), expected(pairs, 2))


def test_the_query_knows_contexts_of_two_words(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    pairs = [tuple(row) for row in docs.collect()]
    assert_same(queries.op5_lm_scores(spark, SMALL), expected(pairs, 3))


def test_common_pairs_in_an_unlikely_order_score_less(spark, tmp_path):
    known = ["x a b y", "z b c w", "a b d e", "q b c r"] * 3
    pairs = list(enumerate([*known, "a b d", "a b c"]))
    found = score_documents(make_documents(spark, pairs), paths(tmp_path), backoff_lm.ORDER)
    scores = {row.doc_id: (row.n_known, row.log_score) for row in found.collect()}
    assert scores[len(known)][0] == 1 and scores[len(known) + 1][0] == 0
    assert scores[len(known)][1] > scores[len(known) + 1][1]


def test_chunks_are_not_shuffled(spark, tmp_path):
    docs = make_documents(spark, [(i, f"a b c{i}") for i in range(20)])
    plan = plan_of(score_documents(docs, paths(tmp_path)))
    assert plan.count("Exchange hashpartitioning") == 2  # requests and answers


def test_coded_ngrams_come_back():
    chance = np.random.default_rng(2)
    for size in (0, 1, 3, 1000):
        ngrams = np.unique(chance.integers(0, 1 << 64, size, dtype=np.uint64))
        ngrams = np.append(ngrams, np.uint64((1 << 64) - 1))[: len(ngrams) + size % 2]
        assert (backoff_lm._decoded_ngrams(backoff_lm._coded_ngrams(ngrams)) == ngrams).all()


def test_counts_beyond_32_bits_are_whole():
    most = (1 << 32) - 1
    ngrams = np.array([3, 5, 9], np.uint64)
    control, data = backoff_lm._coded(np.array([most, 7, most]))
    request = {
        "part": 0, "ngrams": backoff_lm._coded_ngrams(ngrams), "control": control, "data": data
    }
    few, small = backoff_lm._coded(np.array([1, 2]))
    other = request | {
        "ngrams": backoff_lm._coded_ngrams(ngrams[1:]), "control": few, "data": small
    }
    rows = pd.DataFrame([request | {"chunk": 0}, request | {"chunk": 1}, other | {"chunk": 2}])
    answers = backoff_lm._answer(rows)
    found = [
        backoff_lm._whole(*row, size).tolist()
        for row, size in zip(zip(answers["control"], answers["data"], answers["above"]), (3, 3, 2))
    ]
    assert found[0] == found[1] == [2 * most, 15, 2 * most + 2]
    assert found[2] == [15, 2 * most + 2]
    small = backoff_lm._answer(rows.iloc[2:])
    assert small["above"].tolist() == [b""]


def test_a_chunk_is_scored_with_answers_of_several_partitions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(backoff_lm, "PARTITION_WORDS", 4)
    monkeypatch.setattr(backoff_lm, "SCORED_WORDS", 3)
    pairs = [(1, "a b c"), (2, "a b d"), (3, None), (4, "b c a b")]
    frame = score_documents(make_documents(spark, pairs).coalesce(1), paths(tmp_path))
    assert_same(frame, expected(pairs, 2))


@pytest.mark.parametrize("at_once", [1, 40, 1 << 20])
def test_counting_and_scoring_in_steps_give_the_same(spark, tmp_path, monkeypatch, at_once):
    chance = np.random.default_rng(5)
    pairs = [(i, " ".join(f"w{x}" for x in chance.integers(0, 12, i % 9))) for i in range(60)]
    monkeypatch.setattr(backoff_lm, "ANSWER_NGRAMS", at_once)
    monkeypatch.setattr(backoff_lm, "SCORED_WORDS", at_once)
    ngrams = np.sort(chance.integers(0, 1 << 64, 900, dtype=np.uint64))
    held = [np.unique(chance.choice(ngrams, 300)) for _ in range(4)] + [ngrams[:0]]
    times = [chance.integers(1, 5, len(some)) for some in held]
    rows = pd.DataFrame(
        [
            {"part": 0, "chunk": i, "ngrams": backoff_lm._coded_ngrams(some)}
            | dict(zip(("control", "data"), backoff_lm._coded(count)))
            for i, (some, count) in enumerate(zip(held, times))
        ]
    )
    totals = Counter()
    for some, count in zip(held, times):
        totals.update(dict(zip(some.tolist(), count.tolist())))
    answers = backoff_lm._answer(rows)
    for some, *blobs in zip(held, answers["control"], answers["data"], answers["above"]):
        assert backoff_lm._whole(*blobs, len(some)).tolist() == [totals[x] for x in some.tolist()]
    frame = score_documents(make_documents(spark, pairs).coalesce(1), paths(tmp_path), 3)
    assert_same(frame, expected(pairs, 3))


def test_a_partition_is_counted_in_little_memory():
    """A range of hashes after the other: sorting takes several times what is sorted."""
    import tracemalloc

    chance = np.random.default_rng(6)
    some = [np.unique(chance.integers(0, 1 << 64, 1 << 20, dtype=np.uint64)) for _ in range(4)]
    control, data = backoff_lm._coded(np.ones(len(some[0]), np.int64))
    rows = pd.DataFrame(
        [
            {"part": 0, "chunk": i, "ngrams": backoff_lm._coded_ngrams(x), "control": control, "data": data}
            for i, x in enumerate(some)
        ]
    )
    tracemalloc.start()
    backoff_lm._answer(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * sum(map(len, some))
