"""Alignment of the tokens that two tokenizers cut the same texts into.

A is a byte-level BPE of the library ``tokenizers``, given a space and the text; B is a model of
``sentencepiece``, which adds that space itself. Both cut the same bytes. Where tokens of both
end, a group ends. The shorter of a text's two lists of ends drives: each of its ends gallops
from its guessed place in the longer list, by steps that double and a binary search after them.
Places with equal ends cut the groups, and the differences of places tell which tokens of the
longer list each driving token overlaps: these are its links.

How many documents hold a linked pair of ids is counted over the whole corpus. Tasks count
their own pairs first. The ``HELD`` pairs at most that are in more than their share of documents
go to all tasks (12 bytes each); the others of each document are joined with their counts.

Texts that are NULL or empty, or that a tokenizer does not give back byte by byte, have no
tokens. Texts are encoded in chunks, from a space to the next one after something else, which
neither tokenizer joins anything over; so long ones are aligned part by part. Only a stretch
without such a space is encoded whole. Repeated rows are documents of their own. An empty table
gives an empty result. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A slice of texts is aligned at once, and a longer text in parts of about this size.
SLICE_CHARS = 1 << 20
CACHED_CHUNKS = 600_000
HELD = 1 << 21

# A space after what is no space, but for one at the end: neither tokenizer has a token over it.
# Chunks are what stands between; each begins with the space before it.
_CUT = re.compile(r"(?<=[\w!-/:-@\[-`{-~]) (?!\Z)")
_RUN = 1_000
_NOTHING = np.zeros(0, np.int32), np.zeros(1, np.int64)

_ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, pairs binary, times binary, counted array<int>, held_by array<long>"
)
_JUDGED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, n_best long, count_sum long, rest array<int>, rest_times array<long>"
)


# Tokens of texts


def _bytes_by_letter() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a letter: itself if it can be seen, or else one
    from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [x for x in range(0x100) if x not in seen]
    return {chr(x): x for x in seen} | {chr(0x100 + i): x for i, x in enumerate(hidden)}


def byte_level_tokens(tokenizer) -> list[bytes]:
    letters = _bytes_by_letter()
    found = [b""] * tokenizer.get_vocab_size()
    for token, number in tokenizer.get_vocab().items():
        if all(letter in letters for letter in token):
            found[number] = bytes(letters[letter] for letter in token)
    return found


def piece_tokens(model) -> list[bytes]:
    found = []
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        if model.is_byte(number):
            found.append(bytes([int(piece[3:5], 16)]))
        else:
            found.append(piece.replace("▁", " ").encode())
    return found


class TwoTokenizers:
    """Ids of both tokenizers for chunks of text, kept so that each chunk is encoded once."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the machine already
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.tokens = byte_level_tokens(self.a), piece_tokens(self.b)
        self.sizes = tuple(np.array([len(x) for x in each], np.int64) for each in self.tokens)
        self.bits = (len(self.tokens[1]) - 1).bit_length()
        if len(self.tokens[0]) << self.bits > 1 << 31:
            raise ValueError("pairs of these tokenizers' ids take more than 31 bits")
        self.decimals = _decimals(max(len(each) for each in self.tokens))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.whole = np.zeros(0, bool)
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.first = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def trim(self) -> None:
        if len(self.known) > CACHED_CHUNKS:
            self._forget()

    def chunks(self, text: str) -> list[str]:
        return _CUT.split(text)

    def numbers(self, chunks: list[str]) -> np.ndarray:
        """The places where the ids of these chunks are kept, until they are trimmed."""
        known = self.known
        new = list(dict.fromkeys(chunk for chunk in chunks if chunk not in known))
        if new:
            plain = [chunk for chunk in new if _CUT.search(f"{chunk[-1:]} x")]
            runs = [plain[x : x + _RUN] for x in range(0, len(plain), _RUN)]
            odd = set(new).difference(plain)
            self._keep([*runs, *([chunk] for chunk in new if chunk in odd)])
        return np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))

    def _keep(self, runs: list[list[str]]) -> None:
        """Add chunks; those of a run are encoded together, or one by one if that goes wrong."""
        found: list[tuple[list[str], list, bool]] = []
        for run in runs:
            cut = self._encoded(run)
            if cut is None and len(run) > 1:
                found += [([chunk], self._encoded([chunk])) for chunk in run]
            else:
                found.append((run, cut))
        whole = np.repeat([cut is not None for _, cut in found], [len(run) for run, _ in found])
        chunks = [chunk for run, _ in found for chunk in run]
        self.known.update(zip(chunks, range(len(self.whole), len(self.whole) + len(chunks))))
        self.whole = np.concatenate([self.whole, whole])
        for side in range(2):
            kept = [cut[side] if cut else _NOTHING for _, cut in found]
            counts = np.concatenate([count for _, count in kept])
            self.ids[side] = np.concatenate([self.ids[side], *(ids for ids, _ in kept)])
            after = self.first[side][-1] + np.cumsum(counts)
            self.first[side] = np.concatenate([self.first[side], after])

    def _encoded(self, run: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids of some chunks and how many each has, by both; none if bytes are lost."""
        pieces = [f" {chunk}".encode() for chunk in run]
        text = "".join([f" {chunk}" for chunk in run])
        ends = np.cumsum([len(piece) for piece in pieces])
        plain, result = b"".join(pieces), []
        both = self.a.encode(text, add_special_tokens=False).ids, self.b.encode(text[1:])
        for ids, tokens, sizes in zip(both, self.tokens, self.sizes):
            if b"".join([tokens[x] for x in ids]) != plain:
                return None
            ids = np.array(ids, np.int32)
            reached = np.cumsum(sizes[ids])
            last = np.searchsorted(reached, ends)
            if (reached[last] != ends).any():
                return None
            result.append((ids, np.diff(last, prepend=-1)))
        return result

    def ids_of(self, numbers: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these chunks one after the other, and how many each has."""
        first = self.first[side][numbers]
        counts = self.first[side][numbers + 1] - first
        after = np.cumsum(counts)
        at = np.repeat(first - (after - counts), counts) + np.arange(counts.sum())
        return self.ids[side][at], counts


@lru_cache(maxsize=1)
def _tokenizers(path_a: str, path_b: str) -> TwoTokenizers:
    """Kept by a worker from task to task."""
    return TwoTokenizers(path_a, path_b)


# Alignment


def gallop(
    targets: np.ndarray, longer: np.ndarray, guess: np.ndarray, low: np.ndarray, high: np.ndarray
) -> np.ndarray:
    """For each target the first place in ``longer``, from ``low`` to ``high``, that is not less.

    All targets gallop at once, each from its guess, until they have passed their place; a
    binary search between the last two steps ends it. The value before ``high`` is no less than
    any target.
    """
    right = longer[guess] < targets
    begin, end = np.where(right, guess, low - 1), np.where(right, high - 1, guess)
    step, active = 1, np.flatnonzero(right)
    while len(active):
        probe = np.minimum(guess[active] + step, high[active] - 1)
        less = longer[probe] < targets[active]
        begin[active[less]], end[active[~less]] = probe[less], probe[~less]
        active, step = active[less], step * 2
    step, active = 1, np.flatnonzero(~right & (guess > low))
    while len(active):
        probe = np.maximum(guess[active] - step, low[active])
        less = longer[probe] < targets[active]
        begin[active[less]], end[active[~less]] = probe[less], probe[~less]
        active, step = active[~less & (probe > low[active])], step * 2
    active = np.flatnonzero(end - begin > 1)
    while len(active):
        probe = (begin[active] + end[active]) // 2
        less = longer[probe] < targets[active]
        begin[active[less]], end[active[~less]] = probe[less], probe[~less]
        active = active[end[active] - begin[active] > 1]
    return end


@dataclass(frozen=True)
class Side:
    """The tokens of some texts by one tokenizer: ids, ends, and where each text's begin."""

    ids: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # one more than there are texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def overlaps(
    drive: Side, other: Side, texts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the driving tokens in these texts: their places, where the tokens of the other side
    that each overlaps begin and end, and whether the last of them ends with it."""
    counts = drive.counts[texts]
    rank = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    place = np.repeat(drive.first[texts], counts) + rank
    low, high = (np.repeat(other.first[texts + x], counts) for x in (0, 1))
    guess = low + rank * (high - low) // np.repeat(counts, counts)
    at = gallop(drive.ends[place], other.ends, guess, low, high)
    common = other.ends[at] == drive.ends[place]
    begin = np.append(0, (at + common)[:-1]) if len(at) else at
    begin = np.where(rank == 0, low, begin)
    return place, begin, at, common


@dataclass(frozen=True)
class Aligned:
    """Per text: groups and their listing, and links as distinct pairs of ids, with times."""

    n_groups: np.ndarray
    n_links: np.ndarray
    listing: bytes  # of all texts; each group ends with a semicolon
    listing_ends: np.ndarray
    pairs: np.ndarray
    times: np.ndarray
    first_pair: np.ndarray


def align(a: Side, b: Side, bits: int, decimals: np.ndarray) -> Aligned:
    texts = len(a.first) - 1
    shared = [np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)]
    keys, n_links = [], np.zeros(texts, np.int64)
    by_a = a.counts <= b.counts
    for chosen, drive, other in ((by_a, 0, 1), (~by_a, 1, 0)):
        sides = (a, b)
        some = np.flatnonzero(chosen & (a.counts > 0))
        if not len(some):
            continue
        place, begin, at, common = overlaps(sides[drive], sides[other], some)
        shared[drive][place[common]] = True
        shared[other][at[common]] = True
        many = at + 1 - begin
        after = np.cumsum(many)
        reached = np.repeat(begin - (after - many), many) + np.arange(after[-1])
        text = np.repeat(some, sides[drive].counts[some])
        n_links += np.bincount(text, many, texts).astype(np.int64)
        links = [None, None]
        links[drive] = np.repeat(sides[drive].ids[place], many)
        links[other] = sides[other].ids[reached]
        key = np.repeat(text, many) << 31 | links[0].astype(np.int64) << bits | links[1]
        keys.append(key)
    key = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    times = np.diff(np.append(new, len(key)))
    key = key[new]
    first_pair = np.searchsorted(key >> 31, np.arange(texts + 1))
    listing, ends, n_groups = _listing(a, b, shared, decimals)
    pairs = (key & ((1 << 31) - 1)).astype(np.int32)
    return Aligned(n_groups, n_links, listing, ends, pairs, times, first_pair)


_SEPARATORS = b",|;"


def _decimals(count: int) -> np.ndarray:
    """For each separator and id: its digits and the separator, filled up with zero bytes."""
    width = len(str(count)) + 1
    rows = [f"{i}{chr(mark)}".encode().ljust(width, b"\0") for mark in _SEPARATORS for i in range(count)]
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(_SEPARATORS), count, width)


def _listing(
    a: Side, b: Side, shared: list[np.ndarray], decimals: np.ndarray
) -> tuple[bytes, np.ndarray, np.ndarray]:
    """``a1,a2|b1;`` for each group, where each text's ends, and how many groups it has."""
    lasts = [np.flatnonzero(each) for each in shared]  # the last token of each group
    groups = [np.cumsum(each) - each for each in shared]
    before_b = np.append(0, lasts[1] + 1)[groups[0]] if len(groups[0]) else groups[0]
    until_a = (lasts[0] + 1)[groups[1]] if len(groups[1]) else groups[1]
    out = np.zeros((len(a.ids) + len(b.ids), decimals.shape[2]), np.uint8)
    out[np.arange(len(a.ids)) + before_b] = decimals[shared[0].astype(np.int8), a.ids]
    out[np.arange(len(b.ids)) + until_a] = decimals[shared[1] * 2, b.ids]
    used = out != 0
    after = np.append(0, np.cumsum(used.sum(1)))
    return out[used].tobytes(), after[a.first + b.first], np.diff(
        np.append(0, np.cumsum(shared[0]))[a.first]
    )


# Documents


@dataclass
class _Text:
    """A text's values, added up over its parts."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    listing: object = None
    pairs: np.ndarray | None = None
    times: np.ndarray | None = None

    def add(self, found: Aligned, sides: tuple[Side, Side], i: int) -> None:
        first = [int(side.first[i]) for side in sides]
        self.n_a += int(sides[0].first[i + 1]) - first[0]
        self.n_b += int(sides[1].first[i + 1]) - first[1]
        self.n_groups += int(found.n_groups[i])
        self.n_links += int(found.n_links[i])
        begin, end = int(found.listing_ends[i]), int(found.listing_ends[i + 1])
        if self.listing is None:
            self.listing = hashlib.sha256()
        else:
            self.listing.update(b";")
        self.listing.update(memoryview(found.listing)[begin : end - 1])
        cut = slice(int(found.first_pair[i]), int(found.first_pair[i + 1]))
        pairs, times = found.pairs[cut], found.times[cut]
        if self.pairs is not None:
            pairs, times = _summed(
                np.concatenate([self.pairs, pairs]), np.concatenate([self.times, times])
            )
        self.pairs, self.times = pairs, times


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[new], np.add.reduceat(values, new) if len(new) else values[:0]


def aligned_texts(texts: list[str | None], both: TwoTokenizers) -> list[_Text]:
    """Align texts in slices of limited size; a long text is in several."""
    result = [_Text() for _ in texts]
    held: list[tuple[int, list[str]]] = []  # of a slice: texts and their chunks
    size = 0
    for i, text in enumerate(texts):
        if not text:
            continue
        chunks = both.chunks(text)
        if len(text) > SLICE_CHARS:
            if _is_given_back(chunks, both):
                for part in _parts(chunks):
                    _align_slice([(i, part)], both, result)
            continue
        if size + len(text) > SLICE_CHARS:
            _align_slice(held, both, result)
            held, size = [], 0
        held.append((i, chunks))
        size += len(text)
    if held:
        _align_slice(held, both, result)
    return result


def _parts(chunks: list[str]) -> Iterator[list[str]]:
    """Chunks in runs of limited size."""
    begin = held = 0
    for end, chunk in enumerate(chunks):
        if held + len(chunk) > SLICE_CHARS and end > begin:
            yield chunks[begin:end]
            begin, held = end, 0
        held += len(chunk) + 1
    yield chunks[begin:]


def _is_given_back(chunks: list[str], both: TwoTokenizers) -> bool:
    """Whether the tokens of both, joined, are a long text's bytes."""
    for part in _parts(chunks):
        numbers = both.numbers(part)
        if not both.whole[numbers].all():
            return False
        both.trim()
    return True


def _align_slice(
    held: list[tuple[int, list[str]]], both: TwoTokenizers, result: list[_Text]
) -> None:
    numbers = both.numbers([chunk for _, chunks in held for chunk in chunks])
    sizes = np.array([len(chunks) for _, chunks in held])
    edges = np.append(0, np.cumsum(sizes))
    lost = np.append(0, np.cumsum(~both.whole[numbers]))[edges]
    whole = np.diff(lost) == 0  # texts that both give back byte by byte
    numbers = numbers[np.repeat(whole, sizes)]
    edges = np.append(0, np.cumsum(sizes[whole]))
    sides = []
    for side in range(2):
        ids, counts = both.ids_of(numbers, side)
        first = np.append(0, np.cumsum(counts))[edges]
        sides.append(Side(ids, np.cumsum(both.sizes[side][ids]), first))
    found = align(*sides, both.bits, both.decimals)
    for place, owner in enumerate(np.flatnonzero(whole)):
        result[held[owner][0]].add(found, tuple(sides), place)
    both.trim()


_COUNTED_AT_ONCE = 4_000_000


def _aligner(path_a: str, path_b: str) -> Callable:
    """A row per document with its pairs, and rows with the task's counts of pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _tokenizers(path_a, path_b)
        held: list[np.ndarray] = []
        counted = np.zeros(0, np.int32), np.zeros(0, np.int64)

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([counted[0], *held])
            ones = np.ones(len(keys) - len(counted[0]), np.int64)
            return _summed(keys, np.concatenate([counted[1], ones]))

        for batch in batches:
            texts = batch.column(2).to_pylist()
            found = aligned_texts(texts, both)
            held += [x.pairs for x in found if x.pairs is not None]
            if sum(len(x) for x in held) > _COUNTED_AT_ONCE:
                counted, held = merged(), []
            if len(counted[0]) > _COUNTED_AT_ONCE:
                yield _counts(counted)
                counted = np.zeros(0, np.int32), np.zeros(0, np.int64)
            yield _documents(batch, found)
        yield _counts(merged())

    return run


_SCHEMA = pa.schema(
    [
        *((name, pa.int64()) for name in "row doc_id n_a n_b n_groups n_links".split()),
        ("groups_sha256", pa.string()),
        ("pairs", pa.binary()),
        ("times", pa.binary()),
        ("counted", pa.list_(pa.int32())),
        ("held_by", pa.list_(pa.int64())),
    ]
)


def _documents(batch: pa.RecordBatch, found: list[_Text]) -> pa.RecordBatch:
    nothing = np.zeros(0, np.int64)
    pairs = [nothing if x.pairs is None else x.pairs for x in found]
    times = [nothing if x.times is None else x.times for x in found]
    size = len(found)
    columns = [
        batch.column(0),
        batch.column(1),
        *(pa.array([getattr(x, n) for x in found], pa.int64()) for n in _SCHEMA.names[2:6]),
        pa.array(["" if x.listing is None else x.listing.hexdigest() for x in found], pa.string()),
        # Ascending, so their differences compress better.
        pa.array([np.diff(x, prepend=0).astype("<u4").tobytes() for x in pairs], pa.binary()),
        pa.array([x.astype("<u4").tobytes() for x in times], pa.binary()),
        pa.nulls(size, _SCHEMA.field("counted").type),
        pa.nulls(size, _SCHEMA.field("held_by").type),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def _counts(counted: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    step = 1 << 16
    cuts = range(0, len(counted[0]), step)
    rows = {
        "counted": [counted[0][x : x + step] for x in cuts],
        "held_by": [counted[1][x : x + step] for x in cuts],
    }
    columns = [
        pa.array(rows[field.name], field.type) if field.name in rows
        else pa.nulls(len(cuts), field.type)
        for field in _SCHEMA
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def align_documents(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    folder: Callable[[], str],
    held: int = HELD,
) -> DataFrame:
    """Groups and links of each document, and what the corpus says of its links.

    ``count_sum`` adds up, over all links, how many documents hold their pair of ids; ``n_best``
    counts the links whose pair is in as many as any pair of the same id of A.
    """
    spark = docs.sparkSession
    path = folder()
    (
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text"
        )
        .mapInArrow(_aligner(path_a, path_b), _ALIGNED)
        .write.option("compression", "zstd")
        .parquet(path)
    )
    aligned = spark.read.parquet(path)
    path = folder()
    (
        aligned.where("counted IS NOT NULL")
        .select(F.explode(F.arrays_zip("counted", "held_by")).alias("x"))
        .groupBy(F.col("x.counted").alias("pair"))
        .agg(F.sum("x.held_by").alias("n"))
        .write.parquet(path)
    )
    counts = spark.read.parquet(path)
    bits = _tokenizers(path_a, path_b).bits
    all_pairs = counts.agg(F.count("*").alias("pairs"), F.sum("n").alias("n")).first()
    # Fewer than ``held`` pairs can be in more documents than this.
    few = 0 if all_pairs["pairs"] <= held else all_pairs["n"] // held
    kept = counts.where(F.col("n") > few).toPandas().sort_values("pair")
    most = np.zeros(len(_tokenizers(path_a, path_b).tokens[0]), np.int64)
    id_a = F.shiftright("pair", bits)
    tops = counts.groupBy(id_a.alias("a")).agg(F.max("n").alias("n"))
    for row in tops.collect():  # a row per id of A
        most[row["a"]] = row["n"]
    values = spark.sparkContext.broadcast(
        (kept["pair"].to_numpy(np.int32), kept["n"].to_numpy(np.int64), most)
    )
    documents = aligned.where("counted IS NULL").drop("counted", "held_by")
    judged = documents.mapInArrow(_judge(values, bits), _JUDGED)
    if not few:
        return judged.drop("row", "rest", "rest_times")
    path = folder()
    judged.write.option("compression", "zstd").parquet(path)
    judged = spark.read.parquet(path)
    tops = tops.select(F.col("a"), F.col("n").alias("top"))
    rare = counts.where(F.col("n") <= few).join(F.broadcast(tops), F.col("a") == id_a)
    sums = (
        judged.select("row", F.explode(F.arrays_zip("rest", "rest_times")).alias("x"))
        .select("row", F.col("x.rest").alias("pair"), F.col("x.rest_times").alias("times"))
        .join(rare, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.col("n")).alias("more"),
            F.sum(F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0)).alias("best"),
        )
    )
    return (
        judged.join(sums, "row", "left")
        .withColumn("n_best", F.col("n_best") + F.coalesce("best", F.lit(0)))
        .withColumn("count_sum", F.col("count_sum") + F.coalesce("more", F.lit(0)))
        .drop("row", "rest", "rest_times", "best", "more")
    )


def _judge(values, bits: int) -> Callable:
    """Look up the counts of each document's pairs; pairs that are not held are left over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, most = values.value
        for batch in batches:
            rows = batch.num_rows
            steps, times = (
                [np.frombuffer(x.as_buffer(), "<u4") for x in batch.column(i)] for i in (7, 8)
            )
            text = np.repeat(np.arange(rows), [len(x) for x in steps])
            pair = np.concatenate([np.cumsum(x, dtype=np.int64) for x in steps] or [text])
            times = np.concatenate(times or [text]).astype(np.int64)
            at = np.searchsorted(known, pair.astype(np.int32))
            found = at < len(known)
            found[found] = known[at[found]] == pair[found]
            n = counts[at[found]]
            best = n == most[pair[found] >> bits]
            total = _sums(text[found], times[found] * n, rows)
            n_best = _sums(text[found][best], times[found][best], rows)
            rest = np.append(0, np.cumsum(np.bincount(text[~found], minlength=rows)))
            offsets = pa.array(rest, pa.int32())
            columns = [
                *batch.columns[:7],
                pa.array(n_best),
                pa.array(total),
                pa.ListArray.from_arrays(offsets, pa.array(pair[~found].astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(times[~found])),
            ]
            names = [*batch.schema.names[:7], "n_best", "count_sum", "rest", "rest_times"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _sums(text: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Exact sums of whole numbers by text, which ascends."""
    after = np.append(0, np.cumsum(values))
    return np.diff(after[np.searchsorted(text, np.arange(rows + 1))])
