from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest

from conftest import MEDIUM
from llm_support import ODD_PAIRS, PROSE, make_documents, words

from gaugemill.llm import license_scan
from gaugemill.llm.license_scan import GRAM, SHARE, TEMPLATES, license_spans, scan_licenses
from gaugemill.llm.license_texts import PHRASES, TEXTS
from gaugemill.llm.oracles import ORACLES
from gaugemill.llm.queries import QUERIES

NAMES = "doc_id n_words n_base first_word last_word base_labels labels score".split()
MIT = TEXTS[4][1]


def brute(pairs):
    """Phrases word by word; spans from a list of all pairs of equal runs."""
    rows = []
    for name, text in pairs:
        own = words(text)
        base, labels, best = [], set(), 0.0
        for phrase, label in PHRASES.items():
            parts = phrase.split()
            for i in range(len(own)):
                if own[i : i + len(parts)] == parts:
                    base.append((i, label))
        for template in TEMPLATES[len(PHRASES) :]:
            size = len(template.words)
            votes = [
                (p, q)
                for p in range(len(own) - GRAM + 1)
                for q in range(size - GRAM + 1)
                if tuple(own[p : p + GRAM]) == template.words[q : q + GRAM]
            ]
            votes.sort(key=lambda x: x[0] - x[1])
            spans = []
            for p, q in votes:
                if spans and p - q - (spans[-1][-1][0] - spans[-1][-1][1]) <= size // 5:
                    spans[-1].append((p, q))
                else:
                    spans.append([(p, q)])
            for span in spans:
                covered = {q + step for _, q in span for step in range(GRAM)}
                length = max(p for p, _ in span) + GRAM - min(p for p, _ in span)
                score = len(covered) / max(size, length)
                if score >= SHARE:
                    labels.add(template.label)
                    best = max(best, score)
        if base:
            best = 1.0
        own_base = {label for _, label in base}
        places = [i for i, _ in base]
        rows.append(
            (name, len(own), len(base), min(places, default=None), max(places, default=None))
            + (",".join(sorted(own_base)), ",".join(sorted(labels | own_base)), best)
        )
    return sorted(rows, key=repr)


def result(frame):
    return sorted((tuple(row[name] for name in NAMES) for row in frame.collect()), key=repr)


def licensed():
    rng = random.Random(3)
    texts = [text for _, text in TEXTS] + list(PHRASES)
    made = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            own = rng.choice(texts).split()
            for _ in range(rng.randrange(0, 6)):
                at = rng.randrange(len(own) + 1)
                own[at : at + rng.randrange(2)] = rng.choice(([], ["Jane"], ["new", "words"]))
            parts.append(" ".join(own))
            parts.append(rng.choice(("", PROSE, "of the software", "cc by nc cc by nc by nc")))
        made.append((200 + i, "  ".join(parts)))
    return made


@pytest.mark.parametrize("part_bytes", [1 << 20, 64])
def test_equals_all_pairs_of_runs(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(license_scan, "PART_BYTES", part_bytes)
    pairs = [pair for pair in ODD_PAIRS if part_bytes > 64 or len(pair[1] or "") < 10_000]
    pairs = [*pairs, *licensed()]
    assert result(scan_licenses(make_documents(spark, pairs))) == brute(pairs)


def test_runs_of_parts_equal_those_of_whole_texts(monkeypatch):
    import pyarrow as pa

    rng = random.Random(1)
    letters = ["a", "Bc", "é", " ", " ", "  ", ".", "d1", "\n"]
    for size in (1, 5, 17, 1000):
        monkeypatch.setattr(license_scan, "PART_BYTES", size)
        texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(40)]
        texts[3] = None
        batch = pa.RecordBatch.from_arrays(
            [pa.array(range(40)), pa.array(range(40)), pa.array(texts, pa.string())],
            names=["row", "doc_id", "text"],
        )
        found, counts = [], {}
        for record in license_scan._runs_of(100)([batch]):
            for row in record.to_pylist():
                if row["run"] is None:
                    counts[row["row"]] = row["n_words"]
                else:
                    found.append((row["row"], row["pos"], row["run"]))
        expected = [
            (i, p, " ".join(words(text)[p : p + GRAM]))
            for i, text in enumerate(texts)
            for p in range(len(words(text)) - GRAM + 1)
        ]
        assert sorted(found) == expected
        assert counts == {i: len(words(text)) for i, text in enumerate(texts)}


def test_changed_text_keeps_its_label(spark):
    changed = MIT.replace("free of charge", "at no cost at all").replace("sublicense", "lend")
    docs = make_documents(spark, [(1, f"{PROSE} {changed} {PROSE}"), (2, PROSE), (3, MIT[:200])])
    assert [row[6:] for row in result(scan_licenses(docs))] == [
        ("mit", pytest.approx(0.93, abs=0.06)),
        ("", 0.0),
        ("", 0.0),
    ]


def test_spans_tell_where_a_template_stands(spark):
    docs = make_documents(spark, [(1, f"{PROSE} {MIT}")])
    (row,) = license_spans(docs).where("label = 'mit' AND places = 1").collect()
    begin = len(words(PROSE))
    assert (row["begin"], row["end"]) == (begin, begin + len(words(MIT)))
    assert row["covered"] == row["size"] == len(words(MIT))


def test_no_documents(spark):
    assert scan_licenses(make_documents(spark, [])).collect() == []


def test_equals_sql(spark):
    found = QUERIES["op11_license_scan"](spark, MEDIUM).select(*NAMES).collect()
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{MEDIUM}/documents.parquet'")
    expected = connection.sql(ORACLES["op11_license_scan"]).select(*NAMES).fetchall()
    assert sorted((tuple(row) for row in found), key=repr) == sorted(expected, key=repr)
    assert sum(row["labels"] == "gpl-3" for row in found) > 0
    assert np.mean([row["labels"] == "" for row in found]) > 0.5
