from __future__ import annotations

import hashlib
import random
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from llm_support import ODD_PAIRS, PROSE, make_documents, words

from gaugemill.llm import decontaminate
from gaugemill.llm.decontaminate import contamination, decontaminated, longest_matches
from gaugemill.llm.suffixes import SuffixArray
from gaugemill.llm.words import slices, windows_of, words_of


def expected(docs, items, window=10):
    wanted = []
    for item, text in items:
        own = words(text)
        size = min(len(own), window)
        for at in range(len(own) - size + 1 if own else 0):
            wanted.append(("null" if item is None else str(item), own[at : at + size]))
    result = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for item, part in wanted:
            for at in range(len(own) - len(part) + 1):
                if own[at : at + len(part)] == part:
                    hit |= set(range(at, at + len(part)))
                    found.add(item)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        result.append((doc, len(own), len(hit), len(found), digest, bool(hit)))
    return sorted(result, key=repr)


def made_up(seed, vocabulary=4, docs=40, items=12):
    chance = random.Random(seed)
    letters = [chr(97 + i) for i in range(vocabulary)]

    def text(longest):
        return " ".join(chance.choices(letters, k=chance.randrange(longest)))

    texts = [(i, text(200)) for i in range(docs)]
    return texts, [(100 + i, text(30)) for i in range(items)] + [(100, text(25)), (None, text(12))]


@pytest.mark.parametrize("seed, vocabulary", [(1, 2), (2, 3), (3, 5)])
def test_equals_brute_force(spark, seed, vocabulary):
    docs, items = made_up(seed, vocabulary)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert rows(contamination(make_documents(spark, docs), benchmark)) == expected(docs, items)


@pytest.mark.parametrize("shard", [16, 64])
def test_small_shards_and_many_blocks_find_the_same(spark, monkeypatch, shard):
    docs, items = made_up(4, 3)
    docs += docs[:3]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    several = contamination(make_documents(spark, docs), benchmark, block_bytes=200)
    assert rows(several) == expected(docs, items)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    column = pa.array([text for _, text in docs])
    block = next(decontaminate.benchmark_blocks(benchmark))
    for _, _, data, offsets in slices(column):
        hit, pairs = decontaminate._marks(words_of(data, offsets), data, block, 10)
        assert hit.sum() == sum(row[2] for row in expected(docs, items))
        assert len(pairs) == sum(row[3] for row in expected(docs, items))


def test_odd_rows(spark):
    items = [(1, ODD_PAIRS[0][1][:80]), (2, None), (3, ""), (4, "word"), (4, "été straße")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = make_documents(spark, ODD_PAIRS)
    assert rows(contamination(docs, benchmark)) == expected(ODD_PAIRS, items)
    clean = decontaminated(docs, benchmark)
    assert clean.schema == docs.schema
    kept = sorted(str(row.doc_id) for row in clean.collect())
    assert kept == sorted(str(row[0]) for row in expected(ODD_PAIRS, items) if not row[5])


def swapped(depth):
    """Two words that any polynomial modulo 2^64 takes for one."""
    one, other = "a", "b"
    for _ in range(depth):
        one, other = one + other, other + one
    return one, other


def test_words_that_polynomials_confuse(spark):
    docs, items = [], []
    for depth in (4, 9, 11):  # of 16, 512 and 2,048 letters
        one, other = swapped(depth)
        docs += [(depth, f"x {one} y"), (-depth, f"x {other.upper()} y")]
        items.append((depth, one))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert rows(contamination(make_documents(spark, docs), benchmark)) == expected(docs, items)


def test_words_are_compared_where_hashes_agree(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "words_of", _by_length)
    _, _, data, offsets = next(slices(pa.array(["ab cd", "Ab CD x", "ab ce", "abc d"])))
    block = decontaminate._items([(1, "AB cd"), (1, "ab cd"), (2, "zz zz zz")], 10)
    hit, pairs = decontaminate._marks(_by_length(data, offsets), data, block, 10)
    assert hit.tolist() == [True] * 4 + [False] * 5
    assert pairs.tolist() == [[0, 0], [1, 0]]


def _by_length(data, offsets):
    found = words_of(data, offsets)
    return replace(found, hashes=(found.ends - found.starts).astype(np.uint64))


def test_one_id_fills_no_block(spark):
    items = [(None, f"{PROSE} {i}") for i in range(40)] * 3
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    blocks = list(decontaminate.benchmark_blocks(benchmark, block_bytes=2 * len(PROSE)))
    sizes = [len(block.data) for block in blocks]
    assert sum(sizes) == sum(len(text) for _, text in set(items))
    assert len(sizes) > 15 and max(sizes) < sum(sizes) / 4


def test_empty_tables(spark):
    docs, none = make_documents(spark, [(1, "a b c")]), make_documents(spark, [])
    benchmark = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert contamination(none, benchmark).count() == 0
    nothing = benchmark.where("item_id < 0")
    assert [row.contaminated for row in contamination(docs, nothing).collect()] == [False]
    assert decontaminated(docs, nothing).count() == 1


def test_longest_matches(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    docs = make_documents(spark, [(1, "x " + passage[:60]), (2, f"y z {passage} tail"), (3, "p1 p2")])
    benchmark = spark.createDataFrame([(7, f"head {passage} end"), (8, "none of it")], "item_id long, text string")
    assert rows(longest_matches(docs, benchmark)) == [("7", 1, 30, 2, 2)]


def test_suffix_array_is_in_order():
    chance = np.random.default_rng(5)
    texts = ["".join(f"{c} " for c in chance.choice(list("abc"), n)) for n in (0, 1, 50, 300)]
    _, _, data, offsets = next(slices(pa.array(texts)))
    found = words_of(data, offsets)
    array = SuffixArray(found, 64)
    suffixes = [array.words[at : at + 64].tolist() for at in array.order]
    assert suffixes == sorted(suffixes)
    assert sorted(array.order.tolist()) == list(range(len(array.words)))


def test_windows_do_not_cross_texts():
    _, _, data, offsets = next(slices(pa.array(["a b c", "d", None, "a b c d"])))
    _, text = windows_of(words_of(data, offsets), 3)
    assert text.tolist() == [0, 1, 3, 3]
