from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import MEDIUM, rows
from llm_support import ODD_PAIRS, PROSE, make_documents, paths

from gaugemill.llm import quality_classifier
from gaugemill.llm.features import count_features
from gaugemill.llm.quality_classifier import reject_low_quality, score_documents, train
from gaugemill.llm.quality_rules import judge_quality
from gaugemill.llm.weak_labels import fit_label_model, pattern_counts

SPACED = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    text = text or ""
    found = SPACED.findall(text)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    times = Counter(windows)
    repeated = {i + k for i, window in enumerate(windows) if times[window] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if SPACED.search(line)]
    return (
        len(found),
        sum(map(len, found)),
        sum(c in "#*$%&|<>" for c in text),
        sum(line in lines[:at] for at, line in enumerate(lines)),
        len(repeated),
    )


TEXTS = [
    "a b a b a b",
    "x y z x y z",
    "one\ntwo\none\n\n\n \n one",
    "a\x1cb c\x85d e\xa0f",
    "### *** $$ a|b <x>",
    "\U0001f600 é ß",
    *(text for _, text in ODD_PAIRS if text is not None and len(text) < 5000),
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_counts(text):
    assert count_features(text)[:5] == base(text)


def test_judged_rows(spark, tmp_path):
    pairs = ODD_PAIRS + [(100 + i, f"{PROSE} {PROSE[::-1]} {i}") for i in range(60)]
    found = judge_quality(make_documents(spark, pairs), paths(tmp_path)()).collect()
    assert sorted(((r[0], *r[1:6]) for r in found), key=repr) == sorted(
        ((doc, *base(text)) for doc, text in pairs), key=repr
    )
    for row in found:
        failed = row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words
        assert row.base_failed == failed
        assert not (failed and row.kept)
        assert row.kept == (not failed and row.p_good >= 0.5)


def test_empty_table(spark, tmp_path):
    new = paths(tmp_path)
    none = make_documents(spark, [])
    assert judge_quality(none, new()).count() == 0
    _, scorer = train(none, new())
    assert score_documents(none, scorer).count() == 0
    assert reject_low_quality(none, scorer).count() == 0


def test_accuracies_are_found_again():
    chance = np.random.default_rng(3)
    good = chance.random(20_000) < 0.8
    right = [0.95, 0.9, 0.8, 0.7]
    votes = np.stack(
        [np.where(chance.random(len(good)) < r, 1, -1) * np.where(good, 1, -1) for r in right],
        axis=1,
    )
    votes[chance.random(votes.shape) < 0.3] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = fit_label_model(patterns, counts.astype(float))
    assert np.allclose(model.accuracy, right, atol=0.03)
    again = fit_label_model(patterns, counts * 1000.0)
    assert np.allclose(again.accuracy, right, atol=0.03)


def test_patterns_are_counted_over_all_rows(spark):
    frame = spark.createDataFrame([(1, 0), (1, 0), (-1, 1)], "a int, b int")
    patterns, counts = pattern_counts(frame, ["a", "b"])
    assert (patterns.tolist(), counts.tolist()) == ([[-1, 1], [1, 0]], [1.0, 2.0])
    with pytest.raises(ValueError):
        pattern_counts(frame, ["a"] * 10)


@pytest.mark.parametrize("operator", ["rules", "classifier"])
def test_held_out_labels(spark, tmp_path, operator):
    """The given quality labels are used for nothing but this."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    new = paths(tmp_path)
    if operator == "rules":
        judged = judge_quality(docs, new()).where("not base_failed")
    else:
        judged = score_documents(docs, train(docs, new())[1])
    both = judged.join(labels, "doc_id").select("quality", "kept").collect()
    good = [row.kept for row in both if row.quality == 1]
    bad = [row.kept for row in both if row.quality == 0]
    assert sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.1 * len(bad)


def test_the_sample_is_bounded_and_the_result_repeats(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quality_classifier, "SAMPLE", 40)
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    new = paths(tmp_path)
    _, first = train(docs, new())
    _, second = train(docs.repartition(7), new())
    assert np.array_equal(first.weights, second.weights)


def test_odd_rows_are_scored_and_pass_whole(spark, tmp_path):
    docs = make_documents(spark, ODD_PAIRS)
    _, scorer = train(docs, paths(tmp_path)())
    scored = rows(score_documents(docs, scorer))
    assert sorted(str(row[0]) for row in scored) == sorted(str(i) for i, _ in ODD_PAIRS)
    kept = reject_low_quality(docs, scorer)
    assert kept.schema == docs.schema
    assert kept.count() == sum(row[2] for row in scored)


def test_labels_do_not_depend_on_order(spark, tmp_path):
    chance = random.Random(2)
    pairs = [(i, " ".join(chance.choices(PROSE.split(), k=80))) for i in range(50)]
    new = paths(tmp_path)
    first = rows(judge_quality(make_documents(spark, pairs), new()))
    assert first == rows(judge_quality(make_documents(spark, pairs[::-1]), new()))
