from __future__ import annotations

import random
from collections import defaultdict

import pytest
from llm_support import ODD_PAIRS, make_documents, paths

from gaugemill.llm.features import _WORD
from gaugemill.llm.packing import best_fit, pack, pack_apart


def brute_force(documents, capacity):
    """Best fit by looking at every bin."""
    bins, result = [], []
    for size, source, cluster in documents:
        fits = [
            (bin_[0] - size, number)
            for number, bin_ in enumerate(bins)
            if bin_[0] >= size
            and (source is None or source not in bin_[1])
            and (cluster is None or cluster not in bin_[2])
        ]
        if fits:
            chosen = min(fits)[1]
        else:
            chosen = len(bins)
            bins.append([capacity, set(), set()])
        bins[chosen][0] -= size
        bins[chosen][1].add(source)
        bins[chosen][2].add(cluster)
        result.append((chosen, size))
    return result


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_equals_brute_force(seed):
    chance = random.Random(seed)
    sources = [None, *"abcdef", *["hot"] * 4]
    clusters = [None, *range(30), *[99] * 10]
    documents = [
        (chance.randint(1, 100), chance.choice(sources), chance.choice(clusters)) for _ in range(500)
    ]
    documents.sort(key=lambda x: -x[0])
    assert list(best_fit(documents, 100)) == brute_force(documents, 100)


def check(pairs, sources, found, capacity):
    """Every word is packed once, in bins that keep within their capacity and conflicts."""
    by_id, source_of = dict(pairs), {i: sources[n % len(sources)] for n, (i, _) in enumerate(pairs)}
    pieces, bins = defaultdict(list), defaultdict(list)
    for row in found:
        pieces[row.doc_id].append((row.piece, row.first_word, row.n_words))
        if row.bin is not None:
            bins[row.bin].append(row)
        else:
            assert row.n_words == 0
    for doc, text in by_id.items():
        own, end = sorted(pieces[doc]), 0
        for number, (piece, first, size) in enumerate(own):
            assert (piece, first) == (number, end)
            end += size
        assert end == len(_WORD.findall(text or ""))
    for rows in bins.values():
        assert sum(row.n_words for row in rows) == rows[0].bin_words <= capacity
        assert sorted(row.place for row in rows) == list(range(len(rows)))
        for names in ([source_of[r.doc_id] for r in rows], [by_id[r.doc_id].lower() for r in rows]):
            named = [name for name in names if name is not None]
            assert len(set(named)) == len(named)


@pytest.mark.parametrize("group", [30, 4096])
def test_documents(spark, tmp_path, group):
    chance = random.Random(5)
    texts = [" ".join(["w"] * chance.choice([1, 5, 30, 64, 65, 128, 300])) + f" {n // 3}" for n in range(300)]
    pairs = list(enumerate(texts))
    sources = ["hot", "hot", "a", "b", None, "c", "d"]
    docs = make_documents(spark, pairs, sources)
    found = pack(docs, paths(tmp_path)(), capacity=64, group=group).collect()
    check(pairs, sources, found, 64)


def test_odd_rows(spark, tmp_path):
    docs = make_documents(spark, ODD_PAIRS, [None])
    found = pack(docs, paths(tmp_path)()).collect()
    assert sum(row.n_words for row in found) == sum(len(_WORD.findall(t or "")) for _, t in ODD_PAIRS)
    assert sum(row.bin is None for row in found) == 4
    ones = [row.bin for row in found if row.doc_id == 1]
    assert len(ones) == len(set(ones)) == 2  # repeated rows are copies


def test_large_ids_are_exact(spark, tmp_path):
    big = 2**62 + 1
    docs = make_documents(spark, [(big, "a b"), (None, "c"), (big + 1, "d")])
    found = pack(docs, paths(tmp_path)()).collect()
    assert {row.doc_id for row in found} == {big, None, big + 1}


def test_empty_table(spark, tmp_path):
    assert pack(make_documents(spark, []), paths(tmp_path)()).count() == 0


def test_near_copies_of_different_sources_are_apart(spark, tmp_path):
    chance = random.Random(7)
    base = [f"b{i}" for i in range(120)]
    pairs = []
    for i in range(12):
        text = [*base]
        text[chance.randrange(120)] = f"edit{i}"
        pairs.append((i, (" " if i % 2 else "  ").join(text)))
    pairs += [(100 + i, " ".join(f"o{i}w{k}" for k in range(60))) for i in range(12)]
    pairs += [(200, "É u"), (201, "é u"), (None, None), (202, "?!"), (203, "?!")]
    sources = [f"s{i}" for i in range(len(pairs))]
    found = pack_apart(make_documents(spark, pairs, sources), paths(tmp_path), capacity=1024).collect()
    check(pairs[:-3] + pairs[-2:], sources[:-3] + sources[-2:], [r for r in found if r.doc_id is not None], 1024)
    near = [row.bin for row in found if row.doc_id is not None and row.doc_id < 12]
    assert len(set(near)) == len(near) == 12
    assert len({row.bin for row in found if row.bin}) == 12  # and nothing else is kept apart


def test_repeated_near_copies_and_empty_table(spark, tmp_path):
    docs = make_documents(spark, ODD_PAIRS, [None])
    found = pack_apart(docs, paths(tmp_path)).collect()
    assert sum(row.n_words for row in found) == sum(len(_WORD.findall(t or "")) for _, t in ODD_PAIRS)
    prose = [row.bin for row in found if row.doc_id in (1, 9) or row.doc_id is None and row.bin]
    assert len(set(prose)) == len(prose) == 4
    assert pack_apart(make_documents(spark, []), paths(tmp_path / "none")).count() == 0


def test_any_layout_gives_the_same_bins(spark, tmp_path):
    chance = random.Random(9)
    pairs = [(n % 40, " ".join(["w"] * chance.randrange(1, 90))) for n in range(120)]
    pairs += [(7, "the same row")] * 30
    docs = make_documents(spark, pairs, ["a", "b", None, "c"])
    found = [
        sorted((tuple(row) for row in pack_apart(each, paths(tmp_path / str(n)), capacity=64, group=30).collect()), key=repr)
        for n, each in enumerate((docs, docs, docs.repartition(7), docs.orderBy("text").coalesce(1)))
    ]
    assert found[0] == found[1] == found[2] == found[3]


@pytest.mark.parametrize("seed", [1, 2])
def test_no_near_copies_share_a_bin(spark, tmp_path, seed):
    """Edited copies of edited copies, by a plain similarity of all pairs."""
    chance = random.Random(seed)
    texts = [[f"w{chance.randrange(500)}" for _ in range(60)] for _ in range(6)]
    for _ in range(90):
        text = list(chance.choice(texts))
        text[chance.randrange(60)] = f"e{chance.randrange(50)}"
        texts.append(text)
    pairs = [(i, " ".join(text)) for i, text in enumerate(texts)]
    found = pack_apart(make_documents(spark, pairs, [None]), paths(tmp_path)).collect()
    bin_of = {row.doc_id: row.bin for row in found}
    shingles = [{tuple(t[i : i + 5]) for i in range(56)} for t in texts]
    links = [
        (i, j)
        for i in range(len(texts))
        for j in range(i)
        if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j])
    ]
    assert len(links) > 50
    assert not [pair for pair in links if bin_of[pair[0]] == bin_of[pair[1]]]
