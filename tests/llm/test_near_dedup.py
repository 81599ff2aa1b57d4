from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import MEDIUM, rows
from llm_support import ODD_PAIRS, PROSE, make_documents, paths, words

from gaugemill.llm import probminhash
from gaugemill.llm.components import connected_components
from gaugemill.llm.probminhash import (
    first_of_each,
    is_similar,
    near_duplicates,
    prob_min_hash,
    probability_jaccard,
    shingle_counts,
)
from gaugemill.llm.words import slices, words_of


def shingles(text):
    own = words(text)
    if len(own) < 5:
        return Counter([tuple(own)] if own else [])
    return Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))


def similarity(a, b):
    common, every = a.keys() & b.keys(), [(a[i], b[i]) for i in a.keys() | b.keys()]
    return sum(1 / sum(max(x / a[i], y / b[i]) for x, y in every) for i in common)


def classes(pairs):
    """The smallest id of each row's class, by comparing all pairs that share a shingle."""
    bags = [shingles(text) for _, text in pairs]
    parent = list(range(len(pairs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, bag in enumerate(bags):
        for shingle in bag:
            holders[shingle].append(i)
    shared = Counter((a, b) for own in holders.values() for n, b in enumerate(own) for a in own[:n])
    for (a, b), count in shared.items():
        if root(a) != root(b) and 2 * count >= min(len(bags[a]), len(bags[b])) and similarity(bags[a], bags[b]) >= 0.8:
            parent[root(a)] = root(b)
    members = defaultdict(list)
    for i in range(len(pairs)):
        members[root(i)].append(i)
    result = []
    for own in members.values():
        ids = [pairs[i][0] for i in own if pairs[i][0] is not None]
        result += [(pairs[i][0], min(ids, default=None), len(own)) for i in own]
    return sorted(result, key=repr)


def changed(text, chance, share):
    own = text.split()
    for at in chance.sample(range(len(own)), int(share * len(own))):
        own[at] = f"n{chance.randrange(10**6)}"
    return " ".join(own)


def made_up(seed):
    chance = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3000)]
    texts = []
    for _ in range(12):
        first = " ".join(chance.choices(vocabulary, k=chance.choice([3, 5, 12, 60])))
        texts.append(first)
        for _ in range(chance.randrange(6)):
            texts.append(changed(chance.choice([first, texts[-1]]), chance, chance.choice([0, 0.01, 0.02, 0.2])))
    base = " ".join(chance.choices(vocabulary, k=70))
    texts += [changed(base, chance, 0.02) for _ in range(25)] + [base] * 40
    chance.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1])
def test_made_up_groups(spark, tmp_path, seed):
    pairs = made_up(seed)
    found = near_duplicates(make_documents(spark, pairs), paths(tmp_path))
    assert rows(found.select("doc_id", "class_id", "class_size")) == classes(pairs)


def test_chains_in_one_bucket_are_followed(spark, tmp_path):
    """Neighbours in a chain are similar, its ends are not."""
    chance = random.Random(3)
    text, pairs = " ".join(f"c{i}" for i in range(70)), []
    for i in chance.sample(range(1000), 16):
        pairs.append((i, text))
        text = changed(text, chance, 0.015)
    expected = classes(pairs)
    assert len({row[1] for row in expected}) < 8
    found = near_duplicates(make_documents(spark, pairs), paths(tmp_path))
    assert rows(found.select("doc_id", "class_id", "class_size")) == expected


@pytest.mark.parametrize("few, block, held", [(2, 4, 1 << 17), (0, 256, 100), (8, 256, 1 << 17)])
def test_large_group_of_copies_of_copies(spark, tmp_path, monkeypatch, few, block, held):
    """Edited copies of any copy before, with repeated words, so that shingles have weights."""
    chance = random.Random(few)
    base = " ".join(chance.choices([f"w{i}" for i in range(400)], k=50) + ["so", "on"] * 12)
    texts = [base]
    for _ in range(90):
        texts.append(changed(chance.choice(texts), chance, chance.choice([0.015, 0.03, 0.05])))
    pairs = list(enumerate(dict.fromkeys(texts)))
    expected = classes(pairs)
    assert 10 < len({row[1] for row in expected}) < len(pairs) - 10
    monkeypatch.setattr(probminhash, "CENTRES", 1)
    monkeypatch.setattr(probminhash, "FEW", few)
    monkeypatch.setattr(probminhash, "BLOCK", block)
    monkeypatch.setattr(probminhash, "BLOCK_SHINGLES", held)
    found = near_duplicates(make_documents(spark, pairs), paths(tmp_path))
    assert rows(found.select("doc_id", "class_id", "class_size")) == expected


def test_pairs_of_a_large_group_are_compared_within_tasks(spark, tmp_path, monkeypatch):
    """No table holds a row for each pair of texts that are hardly less alike than linked ones."""
    chance = random.Random(4)
    texts = [" ".join(f"w{i}" for i in range(70))]
    for _ in range(90):
        texts.append(changed(chance.choice(texts), chance, 0.03))
    pairs, tried, linked = list(enumerate(dict.fromkeys(texts))), [], []
    verified, joined = probminhash._verified, probminhash._joined

    def seen_verified(some, texts):
        tried.append(some.count())
        return verified(some, texts)

    def seen_joined(labels, links, new_path):
        linked.append(links.count())
        return joined(labels, links, new_path)

    monkeypatch.setattr(probminhash, "CENTRES", 1)
    monkeypatch.setattr(probminhash, "FEW", 0)
    monkeypatch.setattr(probminhash, "_verified", seen_verified)
    monkeypatch.setattr(probminhash, "_joined", seen_joined)
    found = near_duplicates(make_documents(spark, pairs), paths(tmp_path))
    assert rows(found.select("doc_id", "class_id", "class_size")) == classes(pairs)
    assert len(tried) == 3 and tried[-1] == 0
    assert len(linked) == 3 and 0 < linked[-1] < len(pairs)


def test_given_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    pairs = [tuple(row) for row in docs.select("doc_id", "text").collect()]
    found = near_duplicates(docs, paths(tmp_path))
    assert rows(found.select("doc_id", "class_id", "class_size")) == classes(pairs)


def test_odd_rows(spark, tmp_path):
    pairs = [pair for pair in ODD_PAIRS if len(pair[1] or "") < 10_000]
    docs = make_documents(spark, pairs + [(2, None)])
    found = near_duplicates(docs, paths(tmp_path)).collect()
    by_id = defaultdict(list)
    for row in found:
        by_id[row.doc_id].append((row.class_id, row.class_size))
    assert by_id[1] == [(1, 4), (1, 4)] and by_id[9] == [(1, 4)]  # letters' case does not count
    assert sorted(by_id[None], key=repr) == [(1, 4), (None, 1)]
    assert by_id[3] == [(3, 1)] and by_id[4] == [(4, 1)] and by_id[5] == [(5, 1)]
    kept = first_of_each(docs, paths(tmp_path / "second"))
    assert kept.schema == docs.schema
    ids = sorted(str(row.doc_id) for row in kept.collect())
    assert ids == ["1", "2", "3", "4", "5", "6", "8", "None"]


def test_long_text_and_empty_table(spark, tmp_path):
    new = paths(tmp_path)
    long_text = ODD_PAIRS[9][1]
    docs = make_documents(spark, [(1, long_text), (2, long_text + " end"), (3, PROSE)])
    assert rows(near_duplicates(docs, new).select("doc_id", "class_id")) == [(1, 1), (2, 1), (3, 3)]
    assert near_duplicates(make_documents(spark, []), new).count() == 0
    assert first_of_each(make_documents(spark, []), new).count() == 0


def test_signatures_estimate_the_similarity():
    chance = np.random.default_rng(1)
    keys = chance.integers(1, 1 << 63, 300, dtype=np.uint64)
    a, b = chance.integers(0, 6, 300), chance.integers(0, 6, 300)
    exact = probability_jaccard(keys[a > 0], a[a > 0], keys[b > 0], b[b > 0])
    text = np.concatenate([np.zeros((a > 0).sum(), np.int64), np.ones((b > 0).sum(), np.int64)])
    weights = np.concatenate([a[a > 0], b[b > 0]])
    hashes = np.concatenate([keys[a > 0], keys[b > 0]])
    one, two = prob_min_hash(hashes, text, weights, 2, 8192)
    assert abs((one == two).mean() - exact) < 0.02


def test_exact_similarity_equals_its_definition():
    texts = [PROSE, PROSE + " a b c", PROSE * 2, "x y", "the " * 20]
    ((_, _, data, offsets),) = slices(pa.array(texts))
    hashes, text, counts = shingle_counts(words_of(data, offsets))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            found = probability_jaccard(hashes[text == i], counts[text == i], hashes[text == j], counts[text == j])
            assert found == pytest.approx(similarity(shingles(a), shingles(b)))


@pytest.mark.parametrize("seed", [1])
def test_components(spark, tmp_path, seed):
    chance = random.Random(seed)
    edges = [(chance.randrange(200), chance.randrange(200)) for _ in range(110)]
    edges += [(i, i + 1) for i in range(300, 340)] + [(400, i) for i in range(401, 460)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    touched = {i for a, b in edges if a != b for i in (a, b)}
    expected = sorted((i, root(i)) for i in touched)
    frame = spark.createDataFrame(edges, "u long, v long")
    assert sorted(rows(connected_components(frame, paths(tmp_path)))) == expected


@pytest.mark.parametrize("common, every", [(12, 15), (48, 60), (80, 100), (160, 200), (1596, 1995)])
def test_exact_ties_are_similar(common, every):
    """One key more in all, or one less in common, is below the threshold."""
    keys = np.arange(1, every + 2, dtype=np.uint64)
    ones = np.ones(len(keys), np.int64)
    a, b = keys[:common], keys[:every]
    assert is_similar(a, ones[:common], b, ones[:every])
    assert is_similar(b, ones[:every], a, ones[:common])
    assert not is_similar(a, ones[:common], keys, ones)
    assert not is_similar(a[1:], ones[1:common], b, ones[:every])


def test_ties_of_repeated_shingles():
    keys = np.arange(1, 4, dtype=np.uint64)
    two = np.array([7, 1])
    assert is_similar(keys, np.array([7, 1, 2]), keys[:2], two)  # 7 / 10 + 1 / 10
    assert not is_similar(keys, np.array([7, 1, 3]), keys[:2], two)


def test_texts_of_exactly_the_threshold_are_linked(spark, tmp_path):
    first = [f"t{i}" for i in range(94)]
    second = [*first]
    second[20], second[60] = "other", "another"
    pairs = [(1, " ".join(first)), (2, " ".join(second)), (3, " ".join(first[:50]))]
    assert similarity(shingles(pairs[0][1]), shingles(pairs[1][1])) == pytest.approx(0.8, abs=1e-12)
    found = near_duplicates(make_documents(spark, pairs), paths(tmp_path))
    assert rows(found.select("doc_id", "class_id")) == [(1, 1), (2, 1), (3, 3)]
