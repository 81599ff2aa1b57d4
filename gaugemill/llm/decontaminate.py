"""Benchmark decontamination with suffix arrays over the training texts.

Each task orders the suffixes of its texts, a shard of bounded size at a time, and looks up
every window of the benchmark by binary search. The benchmark is read in blocks: each block is
of bounded size and goes to all tasks, and there are as many passes over the texts as blocks,
one unless the benchmark has more than ``BLOCK_BYTES`` of text.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. NULL and texts without
words have no windows and are never contaminated. An item without an id is listed as ``null``;
rows of the same id are one item. Repeated documents are judged one by one. Without documents
the result is empty; without items nothing is contaminated. Other columns, whatever their names,
are neither read nor changed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugemill.llm.suffixes import SuffixArray
from gaugemill.llm.words import Words, blocks_of, same_words, slices, utf8, words_of

WINDOW = 10
BLOCK_BYTES = 8 << 20  # of text; a block's windows take some 18 times as much
SHARD_WORDS = 1 << 20

MATCH = "item_id string, item_start long, n_words long, doc_id long, doc_start long"


@dataclass(frozen=True)
class Items:
    """A block of the benchmark: distinct windows, and the items that each occurs in."""

    names: list[str]  # in ascending order
    windows: np.ndarray
    sizes: np.ndarray
    first: np.ndarray  # of a window's items in ``owners``
    owners: np.ndarray
    words: Words
    name_of: np.ndarray  # of each text in ``words``
    data: np.ndarray  # in which the words stand
    place: np.ndarray  # of a window's first word in ``words``


def _items(rows: list, window: int) -> Items:
    ids = ["null" if row[0] is None else str(row[0]) for row in rows]
    names = sorted(set(ids))
    place = {name: at for at, name in enumerate(names)}
    name_of = np.array([place[name] for name in ids], np.int64)
    texts = pa.array([row[1] for row in rows], pa.large_string())
    words = _joined([words_of(*part[2:]) for part in slices(texts)], [x[2] for x in slices(texts)])
    padded = np.concatenate([words.hashes, np.zeros(window, np.uint64)])
    sizes = np.minimum(words.counts, window)
    many = np.where(words.counts > 0, words.counts - sizes + 1, 0)
    text = np.repeat(np.arange(len(rows)), many)
    starts = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    at = (words.first[:-1][text] + starts)[:, None] + np.arange(window)
    inside = np.arange(window) < sizes[text][:, None]
    values = np.where(inside, padded[np.minimum(at, len(padded) - 1)], np.uint64(0))
    keyed = np.concatenate([values, sizes[text][:, None].astype(np.uint64)], axis=1)
    windows, place, which = np.unique(keyed, axis=0, return_index=True, return_inverse=True)
    owned = np.unique(np.stack([which.ravel(), name_of[text]], axis=1), axis=0)
    first = np.searchsorted(owned[:, 0], np.arange(len(windows) + 1))
    return Items(
        names,
        np.ascontiguousarray(windows[:, :-1]),
        windows[:, -1].astype(np.int64),
        first,
        owned[:, 1],
        words,
        name_of,
        utf8(texts)[0],
        at[place, 0],
    )


def _joined(parts: list[Words], data: list[np.ndarray]) -> Words:
    """The words of several slices, whose bytes then follow each other."""
    if not parts:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(1, np.int64))
    begins = np.cumsum([0, *(len(part.hashes) for part in parts)])
    lifts = np.cumsum([0, *(len(part) for part in data)])
    firsts = [part.first[:-1] + begin for part, begin in zip(parts, begins)]
    return Words(
        np.concatenate([part.hashes for part in parts]),
        np.concatenate([part.starts + lift for part, lift in zip(parts, lifts)]),
        np.concatenate([part.ends + lift for part, lift in zip(parts, lifts)]),
        np.concatenate([*firsts, begins[-1:]]),
    )


def benchmark_blocks(
    benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> Iterator[Items]:
    """The benchmark's items, about so many bytes at a time; one text at least.

    Repeated rows count once, and rows of one id are dealt by their texts, so that no id makes
    a block large.
    """
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    if blocks > 1:
        items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for block in range(blocks):
        some = items.where(F.col("block") == block) if blocks > 1 else items
        yield _items(some.select("item_id", "text").collect(), window)


def _shards(hashes: Words, overlap: int) -> Iterator[tuple[Words, np.ndarray, np.ndarray]]:
    """Texts in shards of limited size; a long text in pieces that overlap.

    With each shard, the text of each piece and the word at which the piece begins.
    """
    texts, begins, ends = [], [], []
    for text, count in enumerate(hashes.counts.tolist()):
        for begin in range(0, max(count - overlap, 1), SHARD_WORDS):
            texts.append(text)
            begins.append(begin)
            ends.append(min(begin + SHARD_WORDS + overlap, count))
    texts, begins, ends = (np.array(x, np.int64) for x in (texts, begins, ends))
    shard = np.cumsum(ends - begins) // SHARD_WORDS
    for number in np.unique(shard):
        own = np.flatnonzero(shard == number)
        first = np.concatenate([[0], np.cumsum((ends - begins)[own])])
        lift = np.repeat(hashes.first[texts[own]] + begins[own] - first[:-1], np.diff(first))
        words = Words(hashes.hashes[np.arange(first[-1]) + lift], None, None, first)
        yield words, texts[own], begins[own]


def _occurrences(array: SuffixArray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the shard at which a window of the benchmark occurs, and the window."""
    low, high = array.find(items.windows, items.sizes)
    many = high - low
    window = np.repeat(np.arange(len(many)), many)
    slot = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + low[window]
    return array.order[slot], window


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per document: its words, those inside a benchmark window, and the items they are from.

    A window is so many consecutive words of an item; an item of fewer is one window.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    passes = []
    for items in benchmark_blocks(benchmark, window, block_bytes):
        passes.append(docs.mapInArrow(_judge(spark.sparkContext.broadcast(items), window), _PASS))
    if len(passes) == 1:
        return passes[0].select(*_verdict(F.col("spans"), F.col("items")))
    # Equal rows have equal results: they are counted, and come back as many at the end.
    total = passes[0]
    for more in passes[1:]:
        total = total.unionByName(more)
    return (
        total.groupBy("doc_id", "content", "n_words")
        .agg(
            (F.count("*") / len(passes)).cast("int").alias("rows"),
            F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        .withColumn("row", F.explode(F.sequence(F.lit(1), "rows")))
        .select(*_verdict(F.col("spans"), F.col("items")))
    )


# What a pass finds: disjoint spans of hit words, and ascending item ids.
_PASS = (
    "doc_id long, content binary, n_words long, "
    "spans array<struct<start: long, end: long>>, items array<string>"
)


def _verdict(spans, items):
    """The columns of a verdict. Spans of several blocks can overlap: sum what each adds."""
    covered = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda total, span: F.struct(
            (
                total["n"]
                + F.greatest(
                    span["end"] - F.greatest(span["start"], total["end"]),
                    F.lit(0).cast("long"),
                )
            ).alias("n"),
            F.greatest(total["end"], span["end"]).alias("end"),
        ),
        lambda total: total["n"],
    )
    return (
        F.col("doc_id"),
        F.col("n_words"),
        covered.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size(spans) > 0).alias("contaminated"),
    )


def _judge(shared, window: int):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            texts = batch.column(1)
            for row, end, data, offsets in slices(texts):
                words = words_of(data, offsets)
                spans, listed = _found(words, data, items, window)
                content = [
                    hashlib.blake2b(data[a:b], digest_size=16).digest()
                    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, end - row),
                        pa.array(content, pa.binary()),
                        pa.array(words.counts, pa.int64()),
                        spans,
                        listed,
                    ],
                    names=["doc_id", "content", "n_words", "spans", "items"],
                )

    return judge


def _found(
    words: Words, data: np.ndarray, items: Items, window: int
) -> tuple[pa.Array, pa.Array]:
    """The disjoint spans that are hit and the items of each text, as Arrow lists."""
    texts = len(words.counts)
    hit, pairs = _marks(words, data, items, window)
    padded = np.concatenate([[False], hit, [False]])
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    text_of = words.text_of()
    cuts = words.first[1:-1]  # a span never reaches into the next text
    inner = cuts[(cuts > 0) & (cuts < len(hit))]
    inner = inner[hit[inner] & hit[inner - 1]]
    edges = np.sort(np.concatenate([edges, inner, inner]))
    starts, ends = edges[0::2], edges[1::2]
    owner = text_of[starts] if len(starts) else np.zeros(0, np.int64)
    base = words.first[:-1][owner]
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(owner, np.arange(texts + 1)), pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array(starts - base, pa.int64()), pa.array(ends - base, pa.int64())],
            names=["start", "end"],
        ),
    )
    names = pa.array(items.names, pa.string()).take(pa.array(pairs[:, 1]))
    listed = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(pairs[:, 0], np.arange(texts + 1)), pa.int32()), names
    )
    return spans, listed


def _marks(
    words: Words, data: np.ndarray, items: Items, window: int
) -> tuple[np.ndarray, np.ndarray]:
    """Which words are hit, and the sorted pairs of text and item.

    Windows are found by hashes of their words; what is found is compared word by word.
    """
    change = np.zeros(len(words.hashes) + 1, np.int64)
    pairs = [np.zeros((0, 2), np.int64)]
    for shard, texts, begins in _shards(words, window - 1):
        array = SuffixArray(shard, window)
        position, found = _occurrences(array, items)
        if not position.size:
            continue
        piece = array.text(position)
        at = words.first[texts[piece]] + begins[piece] + array.at(position)
        good = _same(words, blocks_of(data), at, items, found)
        piece, at, found = piece[good], at[good], found[good]
        np.add.at(change, at, 1)
        np.add.at(change, at + items.sizes[found], -1)
        pair = np.unique(np.stack([texts[piece], found], axis=1), axis=0)
        many = np.diff(items.first)[pair[:, 1]]
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        owners = items.owners[np.repeat(items.first[pair[:, 1]], many) + nth]
        pairs.append(np.stack([np.repeat(pair[:, 0], many), owners], axis=1))
    return np.cumsum(change[:-1]) > 0, np.unique(np.concatenate(pairs), axis=0)


def _same(
    words: Words, blocks: np.ndarray, at: np.ndarray, items: Items, found: np.ndarray
) -> np.ndarray:
    """Which windows stand word for word at the places where their hashes were found."""
    sizes = items.sizes[found]
    hit = np.repeat(np.arange(len(at)), sizes)
    step = np.arange(len(hit)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    here, there = at[hit] + step, items.place[found][hit] + step
    lengths = words.ends[here] - words.starts[here]
    equal = lengths == items.words.ends[there] - items.words.starts[there]
    equal[equal] = same_words(
        blocks,
        words.starts[here[equal]],
        blocks_of(items.data),
        items.words.starts[there[equal]],
        lengths[equal],
    )
    return np.bincount(hit, ~equal, len(at)) == 0


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents without any window of the benchmark, with all their columns."""
    spark = docs.sparkSession
    text = docs.columns.index("text")
    for items in benchmark_blocks(benchmark, window, block_bytes):
        shared = spark.sparkContext.broadcast(items)
        docs = docs.mapInArrow(_clean(shared, text, window), docs.schema)
    return docs


def _clean(shared, text: int, window: int):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(text)):
                _, pairs = _marks(words_of(data, offsets), data, items, window)
                keep = np.ones(end - row, bool)
                keep[pairs[:, 0]] = False
                yield batch.slice(row, end - row).filter(pa.array(keep))

    return clean


def longest_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """For each item, its longest passage that stands in a document, and one such place.

    Every suffix of an item is searched for in every shard. Only passages of at least
    ``window`` words, or whole items that are shorter, are returned. Of equally long ones the
    first in the item wins, then the lowest document.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    found = None
    for items in benchmark_blocks(benchmark, window, block_bytes):
        some = docs.mapInArrow(_longest(spark.sparkContext.broadcast(items), window), MATCH)
        found = some if found is None else found.unionByName(some)
    rank = F.struct(-F.col("n_words"), "item_start", "doc_id", "doc_start")
    best = F.min_by(F.struct("item_start", "n_words", "doc_id", "doc_start"), rank)
    return found.groupBy("item_id").agg(best.alias("best")).select("item_id", "best.*")


def _longest(shared, window: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        queries = items.words
        deepest = int(max([window, *queries.counts.tolist()]))
        text_of = queries.text_of()
        place = np.arange(len(text_of)) - queries.first[:-1][text_of]
        rest = queries.counts[text_of] - place
        least = np.minimum(queries.counts[text_of], window)
        padded = np.concatenate([queries.hashes, np.zeros(deepest, np.uint64)])
        names = pa.array(items.names, pa.string())
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, _, data, offsets in slices(batch.column(1)):
                words = words_of(data, offsets)
                for shard, texts, begins in _shards(words, deepest - 1):
                    array = SuffixArray(shard, deepest)
                    for run in np.array_split(np.arange(len(text_of)), len(text_of) // 4096 + 1):
                        asked = padded[run[:, None] + np.arange(deepest)]
                        length, where = array.longest(asked, rest[run])
                        good = np.flatnonzero(length >= least[run])
                        piece = array.text(where[good])
                        own = texts[piece] + row
                        yield pa.RecordBatch.from_arrays(
                            [
                                names.take(pa.array(items.name_of[text_of[run[good]]])),
                                pa.array(place[run[good]], pa.int64()),
                                pa.array(length[good], pa.int64()),
                                pa.array([ids[i] for i in own], pa.int64()),
                                pa.array(begins[piece] + array.at(where[good]), pa.int64()),
                            ],
                            names=["item_id", "item_start", "n_words", "doc_id", "doc_start"],
                        )

    return search
