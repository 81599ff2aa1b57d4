"""Token ids in files: frequency-ranked, in byte-aligned codes of variable length.

The most frequent id of the corpus gets code 0, the next one 1, and so on. A code takes one to
four bytes; two bits of a separate control byte tell how many, so that a control byte describes
four codes. Readers look up each control byte in tables and gather the codes with numpy.

The files are Parquet: ``blocks``, in shards of ascending ``doc_id``, with the control and data
bytes of some documents each, and ``ranks`` with the id of each code. NULL text counts as empty;
each document, empty or not, ends with ``end_id``. Documents of a NULL id come first; rows of
the same id are ordered by length and checksum. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugemill.llm.words import NO_SPACE, slices, spans_of

END_ID = 1
BLOCK_IDS = 1 << 18
CACHED_PIECES = 2_000_000

_TOKENS = "doc_id long, n_tokens long, crc long, ids binary"
_BLOCK = (
    "shard int, block int, first long, doc_ids array<long>, n_tokens array<long>, "
    "control binary, data binary"
)
_DOCUMENT = "shard int, doc_id long, first long, n_tokens long, ids_crc32 long"


# Tokenizing


class CachedTokenizer:
    """Token ids of texts, with the library asked once for each piece.

    This tokenizer drops white space and never joins over it, so the ids of a text are those of
    what stands between spaces. It keeps runs of letters and runs of marks apart, so that such
    a chunk of nothing else falls into these pieces; other chunks are pieces as they are. It
    lowers all letters, so that A-Z can be lowered before. Pieces are found by their 64-bit
    hashes, until too many have been seen, and compared byte by byte; where two of them share a
    hash, the texts are given to the library as they are. New pieces are sent to it together, and
    told apart by the tokens that end a word.
    """

    def __init__(self, path: str, end_id: int) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends = np.zeros(size, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = token.endswith("</w>")
        self.special = [
            token.content.lower().encode()
            for token in self.tokenizer.get_added_tokens_decoder().values()
        ]
        self.end = np.array([end_id], "<u4")
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # ascending
        self.first = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, "<u4")
        self.bytes = np.zeros(0, np.uint8)  # of all pieces, and where those of each lie
        self.begin = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def encode(self, text: bytes) -> np.ndarray:
        return np.array(
            self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4"
        )

    def encode_all(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts whose bytes lie one after the other, and how many each text has.

        Each text ends with the end id.
        """
        low = data.tobytes().lower()
        if any(token in low for token in self.special):  # to lower could make one
            return self._encode_texts(data, offsets)
        starts, ends, simple = _pieces(data, offsets)
        hashes = NO_SPACE.hashes(data, starts, ends)
        distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        place = self._places(distinct, starts[at], ends[at], simple[at], low)
        lowered, lengths = np.frombuffer(low, np.uint8), ends - starts
        first, own = (starts[at], lengths[at]), (starts, lengths)
        kept = self.begin[place], self.length[place]
        if not (
            _equal(lowered, *own, lowered, first[0][which], first[1][which])
            and _equal(lowered, *first, self.bytes, *kept)
        ):
            return self._encode_texts(data, offsets)
        # The end id as a last piece of each text.
        texts, cuts = len(offsets) - 1, np.searchsorted(starts, offsets)
        slot = np.arange(len(which)) + np.repeat(np.arange(texts), np.diff(cuts))
        first = np.full(len(which) + texts, len(self.ids))
        sizes = np.ones(len(which) + texts, np.int64)
        first[slot], sizes[slot] = self.first[place][which], self.sizes[place][which]
        after = np.cumsum(sizes)
        source = np.repeat(first - (after - sizes), sizes) + np.arange(after[-1])
        counts = np.diff(after[cuts[1:] + np.arange(texts)], prepend=0)
        return np.append(self.ids, self.end)[source], counts

    def _encode_texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Without the cache."""
        texts = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
        found = [np.concatenate([self.encode(text), self.end]) for text in texts]
        return np.concatenate(found), np.array([len(ids) for ids in found])

    def _places(self, distinct, starts, ends, simple, low: bytes) -> np.ndarray:
        """Where the ids of these hashes are kept; the library is asked for new ones."""
        if len(self.hashes) > CACHED_PIECES:
            self._forget()
        place = np.searchsorted(self.hashes, distinct)
        known = place < len(self.hashes)
        known[known] = self.hashes[place[known]] == distinct[known]
        if known.all():
            return place
        for some in (np.flatnonzero(~known & simple), np.flatnonzero(~known & ~simple)):
            pieces = [low[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist())]
            ids, sizes = self._asked(pieces, simple=bool(some.size and simple[some[0]]))
            self.hashes = np.concatenate([self.hashes, distinct[some]])
            self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.ids = np.concatenate([self.ids, ids])
            lengths = ends[some] - starts[some]
            begins = len(self.bytes) + np.cumsum(lengths) - lengths
            self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(pieces), np.uint8)])
            self.begin = np.concatenate([self.begin, begins])
            self.length = np.concatenate([self.length, lengths])
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.first = self.hashes[order], self.first[order]
        self.sizes = self.sizes[order]
        self.begin, self.length = self.begin[order], self.length[order]
        return np.searchsorted(self.hashes, distinct)

    def _asked(self, pieces: list[bytes], simple: bool) -> tuple[np.ndarray, np.ndarray]:
        found, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        step = 1000 if simple else 1
        for begin in range(0, len(pieces), step):
            run = pieces[begin : begin + step]
            ids = self.encode(b" ".join(run))
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if simple and len(cuts) != len(run):  # a piece that is not one word for the library
                each = [self.encode(piece) for piece in run]
                ids, cuts = np.concatenate(each), np.cumsum([len(x) for x in each])
            found.append(ids)
            sizes.append(np.diff(cuts, prepend=0) if simple else np.array([len(ids)]))
        return np.concatenate(found), np.concatenate(sizes)


def _equal(
    data: np.ndarray,
    starts: np.ndarray,
    sizes: np.ndarray,
    other: np.ndarray,
    other_starts: np.ndarray,
    other_sizes: np.ndarray,
) -> bool:
    """Whether byte ranges hold the same bytes, each as the other at its place."""
    if (sizes != other_sizes).any():
        return False
    shift = np.repeat(np.cumsum(sizes) - sizes, sizes)
    step = np.arange(len(shift)) - shift
    mine = data[np.repeat(starts, sizes) + step]
    return bool((mine == other[np.repeat(other_starts, sizes) + step]).all())


_MARK, _LATIN, _ODD = 1, 2, 3
_CLASS = np.where(NO_SPACE.in_word, _ODD, 0).astype(np.uint8)
_CLASS[list(b".,!?;:%$&#*|")] = _MARK
# Latin letters in UTF-8: A-Z, a-z, and U+00C0 to U+027F but for two signs, and for U+0130,
# whose lower case holds a combining mark.
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = _LATIN
_NO_LETTERS = {0xC3: (0x97, 0xB7), 0xC4: (0xB0,)}


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each piece, and whether it is letters only or marks only."""
    starts, ends = spans_of(data, offsets, NO_SPACE)
    kind = _CLASS[data]
    found = [np.flatnonzero(kind == _ODD)]
    for lead, others in _NO_LETTERS.items():
        before = np.flatnonzero(data[:-1] == lead)
        found.append(before[np.isin(data[before + 1], others)])
    simple = np.ones(len(starts), bool)
    for odd in found:
        simple[np.searchsorted(starts, odd, "right") - 1] = False
    # Where letters meet marks inside of a simple chunk.
    turn = np.flatnonzero((kind[1:] ^ kind[:-1]) == (_MARK ^ _LATIN)) + 1
    chunk = np.searchsorted(starts, turn, "right") - 1
    inside = (turn > starts[chunk]) & simple[chunk]
    turn, chunk = turn[inside], chunk[inside]
    at = chunk + 1 + np.arange(len(turn))  # of the new pieces
    old = np.ones(len(starts) + len(turn), bool)
    old[at] = False
    first = np.empty(len(old), np.int64)
    first[old], first[at] = starts, turn
    whole = np.cumsum(old) - 1  # the chunk of each piece
    is_last = np.append(old[1:], True)[: len(old)]
    last = np.where(is_last, ends[whole], np.append(first[1:], 0)[: len(old)])
    return first, last, simple[whole]


@lru_cache(maxsize=1)
def _tokenizer(path: str, end_id: int) -> CachedTokenizer:
    """Kept by a worker from task to task."""
    return CachedTokenizer(path, end_id)


def tokenized(docs: DataFrame, path: str, end_id: int = END_ID, width: int = 4) -> DataFrame:
    """The ids of each document, ended by ``end_id``, in ``width`` bytes each."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path, end_id)
        for batch in batches:
            for row, stop, data, offsets in slices(batch.column(1)):
                ids, counts = tokenizer.encode_all(data, offsets)
                ends = np.append(0, np.cumsum(counts))
                cuts = ends.tolist()
                narrow = ids.astype(f"<u{width}")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, stop - row),
                        pa.array(counts, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.Array.from_buffers(
                            pa.large_binary(),
                            stop - row,
                            [None, pa.py_buffer(ends * width), pa.py_buffer(narrow)],
                        ).cast(pa.binary()),
                    ],
                    names=["doc_id", "n_tokens", "crc", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, _TOKENS)


# Codes


def encode_codes(codes: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes."""
    codes = codes.astype("<u4")
    size = 1 + (codes > 0xFF).astype(np.uint8) + (codes > 0xFFFF) + (codes > 0xFFFFFF)
    padded = np.zeros(-(-len(codes) // 4) * 4, np.uint8)
    padded[: len(codes)] = size - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    used = np.arange(4) < size[:, None]
    return control.tobytes(), codes.view(np.uint8).reshape(-1, 4)[used].tobytes()


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each control byte: the bytes it describes, and where each byte of four codes lies.

    16 stands for a byte that is zero.
    """
    sizes = 1 + (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3)
    starts = np.cumsum(sizes, axis=1) - sizes
    byte = np.arange(4)
    place = np.where(byte < sizes[:, :, None], starts[:, :, None] + byte, 16)
    return sizes.sum(1), place.reshape(256, 16)


_LENGTHS, _PLACES = _tables()


def decode_codes(control: bytes, data: bytes, count: int) -> np.ndarray:
    """``count`` codes, by looking up each control byte in tables."""
    controls = np.frombuffer(control, np.uint8)
    ends = np.cumsum(_LENGTHS[controls])
    begins = ends - _LENGTHS[controls]
    padded = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(17, np.uint8)])
    places = _PLACES[controls]
    found = padded[np.minimum(begins[:, None] + places, len(padded) - 1)]
    found[places == 16] = 0
    return found.reshape(-1).view("<u4")[:count]


# Files


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    vocabulary: int,
    *,
    staging: str,
    end_id: int = END_ID,
) -> None:
    """Tokenize documents and write their files under ``path``.

    Token ids are kept in ``staging`` meanwhile, so that texts are tokenized once. The rank
    table has a row per id of the vocabulary, whatever the corpus, and goes to all tasks.
    """
    spark = docs.sparkSession
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    tokenized(docs, tokenizer_path, end_id, width).write.option("compression", "zstd").parquet(
        staging
    )
    tokens = spark.read.schema(_TOKENS).parquet(staging)
    ranks = spark.sparkContext.broadcast(_ranks(tokens, vocabulary, end_id, width))
    spark.createDataFrame(
        pd.DataFrame({"code": np.arange(len(ranks.value)), "id": np.argsort(ranks.value)})
    ).coalesce(1).write.parquet(f"{path}/ranks")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "n_tokens", "crc"]
    (
        tokens.repartitionByRange(shards, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_blocks(ranks, width), _BLOCK)
        .write.parquet(f"{path}/blocks")
    )


def _ranks(tokens: DataFrame, vocabulary: int, end_id: int, width: int) -> np.ndarray:
    """The code of each id, by falling frequency, then by id."""
    size = max(vocabulary, end_id + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total += np.bincount(np.frombuffer(ids.as_buffer(), f"<u{width}"), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    counted = tokens.select("ids").mapInArrow(count, "id long, n long")
    rows = counted.groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(size, np.int64)
    total[rows["id"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    ranks = np.empty(size, np.int64)
    ranks[np.lexsort((np.arange(size), -total))] = np.arange(size)
    return ranks


def _blocks(ranks, width: int) -> Callable:
    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        documents, held = [], []

        def packed() -> pa.RecordBatch:
            codes = ranks.value[np.frombuffer(b"".join(held), f"<u{width}")]
            control, data = encode_codes(codes)
            values = (
                [shard],
                [number],
                [first],
                [[x for x, _ in documents]],
                [[n for _, n in documents]],
                [control],
                [data],
            )
            kinds = (
                pa.int32(),
                pa.int32(),
                pa.int64(),
                pa.list_(pa.int64()),
                pa.list_(pa.int64()),
                pa.binary(),
                pa.binary(),
            )
            names = ["shard", "block", "first", "doc_ids", "n_tokens", "control", "data"]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds)], names
            )

        size = 0
        for batch in batches:
            ids, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for name, count, value in zip(ids, counts, batch.column(3)):
                documents.append((name, count))
                held.append(value.as_py())
                size += count
                if size >= BLOCK_IDS:
                    yield packed()
                    number, first = number + 1, first + size
                    documents, held, size = [], [], 0
        if documents:
            yield packed()

    return block


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: where its ids start in the whole corpus, how many they are, and their CRC.

    The start of each shard is the sum of those before it: a row per shard, not per document.
    """
    rows = spark.read.parquet(f"{path}/ranks").orderBy("code").select("id").toPandas()
    table = spark.sparkContext.broadcast(rows["id"].to_numpy(np.int64).astype("<u4"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, first, names, counts, control, data = (x[row] for x in batch.columns)
                counts = np.array(counts.as_py(), np.int64)
                codes = decode_codes(control.as_py(), data.as_py(), int(counts.sum()))
                ids, ends = table.value[codes], np.cumsum(counts)
                crc = [zlib.crc32(ids[b - n : b]) for b, n in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard.as_py()] * len(counts), pa.int32()),
                        names.values,
                        pa.array(first.as_py() + ends - counts),
                        pa.array(counts),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["shard", "doc_id", "first", "n_tokens", "ids_crc32"],
                )

    blocks = spark.read.parquet(f"{path}/blocks")
    columns = ("shard", "first", "doc_ids", "n_tokens", "control", "data")
    documents = blocks.select(*columns).mapInArrow(decode, _DOCUMENT)
    size = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda total, n: total + n)
    shards = blocks.groupBy("shard").agg(F.sum(size).alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    return documents.join(F.broadcast(starts), "shard").select(
        "doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )
