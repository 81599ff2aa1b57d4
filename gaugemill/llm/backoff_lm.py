"""Stupid-backoff language-model scores, each document by what all other documents hold.

For each order, the n-grams of the corpus are counted in tables that are partitioned by the
n-gram's hash; the n-grams of the documents are joined to them there, and the results are summed
per document. A word is scored by the longest n-gram that ends in it and occurs in another
document, as the share of that n-gram among those with its context; each shorter order costs a
factor of ``BACKOFF``. A word that no other document holds gets half a count. Counts are those of
the whole corpus less the document's own.

What travels is packed. Documents are cut into chunks once; a chunk asks each partition for its
distinct n-grams, sorted, and gets their counts back in the same order, so that an n-gram
travels once per chunk, whatever the number of its documents, and without naming itself on the
way back; sorted hashes travel as their differences. Chunks lie in buckets on disk, so that
they are not shuffled to meet their answers. Hashes spread evenly, so no partition is hot, however frequent a word is.
``CHUNK_WORDS`` and ``PARTITION_WORDS`` bound what a task holds. With a very large corpus, raise
both as far as memory goes: the fewer partitions, the more n-grams a chunk sends to each.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. NULL texts and texts
without words have a NULL score. Copies are other documents: what occurs twice is known. Repeated rows
are scored one by one. An empty table gives an empty result. Only ``doc_id`` and ``text`` are
read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugemill.llm.token_files import decode_codes, encode_codes
from gaugemill.llm.words import mix, slices, words_of

ORDER = 3  # of the query
BACKOFF = 0.4
CHUNK_WORDS = 2 << 20
PARTITION_WORDS = 2 << 20  # words of the corpus per partition of a count table
ANSWER_NGRAMS = 1 << 19  # that a partition counts at once, about
SCORED_WORDS = 1 << 18  # that a chunk scores at once, about; a document is not divided

_ODD = np.uint64(0x9E3779B97F4A7C15)

_CHUNK = (
    "chunk long, doc_ids array<string>, n_words array<long>, size long, vocabulary binary, "
    "control binary, data binary"
)
_REQUEST = "part int, chunk long, ngrams binary, control binary, data binary"
_ANSWER = "chunk long, part int, control binary, data binary, above binary"
_SCORE = "doc_id string, n_words long, n_known long, log_score double"

NewPath = Callable[[], str]


# Chunks: documents with their words as numbers of a vocabulary, the most frequent first


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids: list = []
    counts: list[np.ndarray] = []
    hashes: list[np.ndarray] = []
    held, number = 0, 0

    def packed() -> pa.RecordBatch:
        words = np.concatenate(hashes)
        vocabulary, which, times = np.unique(words, return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        control, data = encode_codes(rank[which])
        chunk = TaskContext.get().partitionId() << 32 | number
        values = ([chunk], [ids], [np.concatenate(counts)], [len(words)])
        kinds = (pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int64())
        arrays = [pa.array(value, kind) for value, kind in zip(values, kinds)]
        for blob in (vocabulary[order].tobytes(), control, data):
            arrays.append(pa.array([blob], pa.binary()))
        names = ["chunk", "doc_ids", "n_words", "size", "vocabulary", "control", "data"]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        for row, end, data, offsets in slices(batch.column(1)):
            words = words_of(data, offsets)
            ids += batch.column(0).slice(row, end - row).to_pylist()
            counts.append(words.counts)
            hashes.append(words.hashes)
            held += len(words.hashes)
            if held >= CHUNK_WORDS:
                yield packed()
                ids, counts, hashes, held, number = [], [], [], 0, number + 1
    if ids:
        yield packed()


def _words(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's word hashes, and the document of each."""
    vocabulary = np.frombuffer(row["vocabulary"], np.uint64)
    codes = decode_codes(row["control"], row["data"], int(row["size"]))
    counts = np.asarray(row["n_words"], np.int64)
    return vocabulary[codes], np.repeat(np.arange(len(counts)), counts)


def _ngrams(words: np.ndarray, document: np.ndarray, order: int) -> np.ndarray:
    """The hash of the n-gram that ends at each word; 0 where its document is too short."""
    total = np.zeros(len(words), np.uint64)
    for back in range(order - 1, -1, -1):
        total = mix(total * _ODD + np.roll(words, back))
    inside = np.ones(len(words), bool)
    if order > 1:
        inside = np.roll(document, order - 1) == document
        inside[: order - 1] = False
    total[total == 0] = 1
    return np.where(inside, total + np.uint64(order), np.uint64(0))


def _cuts(ngrams: np.ndarray, parts: int) -> np.ndarray:
    """Where each partition's share of ascending n-grams begins, and the end.

    Partitions are equal ranges of hashes.
    """
    bounds = np.array([-(-(part << 32) // parts) << 32 for part in range(parts)], np.uint64)
    return np.append(np.searchsorted(ngrams, bounds), len(ngrams))


def _sorted(words: np.ndarray, document: np.ndarray, order: int) -> np.ndarray:
    """All n-grams up to an order, ascending, as often as they occur."""
    everything, size = np.empty(order * len(words), np.uint64), 0
    for n in range(1, order + 1):
        some = _ngrams(words, document, n)
        some = some[some > 0]
        everything[size : size + len(some)] = some
        size += len(some)
    everything = everything[:size]
    everything.sort()  # in place: this is the largest array of a task
    return everything


def _starts(ascending: np.ndarray) -> np.ndarray:
    """Where another n-gram than the one before stands."""
    new = np.ones(len(ascending), bool)
    np.not_equal(ascending[1:], ascending[:-1], out=new[1:])
    return new


def _distinct(words: np.ndarray, document: np.ndarray, order: int) -> np.ndarray:
    everything = _sorted(words, document, order)
    return everything[_starts(everything)]


# What travels


def _coded(codes: np.ndarray) -> tuple[bytes, bytes]:
    control, data = encode_codes(codes)
    return _zipped(control), _zipped(data)


def _decoded(control: bytes, data: bytes, count: int) -> np.ndarray:
    return decode_codes(_unzipped(control), _unzipped(data), count)


def _zipped(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unzipped(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, "zstd", asbytes=True) if size else b""


def _coded_ngrams(ngrams: np.ndarray) -> bytes:
    """Ascending n-grams by their differences: the upper bits zipped, the rest as it is."""
    steps = np.diff(ngrams, prepend=np.uint64(0)).astype("<u8")
    control, data = _coded(steps >> np.uint64(_LOW * 8))
    sizes = b"".join(len(part).to_bytes(8, "little") for part in (control, data))
    low = steps.view(np.uint8).reshape(-1, 8)[:, :_LOW].tobytes()
    return sizes + control + data + low


def _decoded_ngrams(blob: bytes) -> np.ndarray:
    middle = 16 + int.from_bytes(blob[:8], "little")
    end = middle + int.from_bytes(blob[8:16], "little")
    low = np.frombuffer(blob, np.uint8, offset=end).reshape(-1, _LOW)
    steps = np.zeros((len(low), 8), np.uint8)
    steps[:, :_LOW] = low
    upper = _decoded(blob[16:middle], blob[middle:end], len(low)).astype(np.uint64)
    return np.cumsum(steps.reshape(-1).view("<u8") + (upper << np.uint64(_LOW * 8)), dtype=np.uint64)


_LOW = 5  # bytes of a difference that are noise


# Count tables


def _requests(order: int, parts: int):
    def request(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in range(batch.num_rows):
                row = batch.slice(number, 1).to_pylist()[0]
                everything = _sorted(*_words(row), order)
                cuts = _cuts(everything, parts)
                used = np.flatnonzero(np.diff(cuts))
                coded, blobs = [], []
                for a, b in zip(cuts[used], cuts[used + 1]):
                    starts = np.flatnonzero(_starts(everything[a:b]))
                    coded.append(_coded(np.diff(starts, append=b - a)))
                    blobs.append(_coded_ngrams(everything[a + starts]))
                del everything
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used, pa.int32()),
                        pa.array([row["chunk"]] * len(used), pa.int64()),
                        pa.array(blobs, pa.binary()),
                        pa.array([control for control, _ in coded], pa.binary()),
                        pa.array([data for _, data in coded], pa.binary()),
                    ],
                    names=["part", "chunk", "ngrams", "control", "data"],
                )

    return request


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """One partition of the count tables: sum what all chunks hold, and tell each chunk.

    Ranges of hashes are summed one after the other, as sorting takes several times their memory.
    """
    asked = [_decoded_ngrams(blob) for blob in rows["ngrams"]]
    times = [
        _decoded(control, data, len(ngrams))
        for control, data, ngrams in zip(rows["control"], rows["data"], asked)
    ]
    answers = [np.empty(len(ngrams), np.int64) for ngrams in asked]
    least = min((ngrams[0] for ngrams in asked if len(ngrams)), default=np.uint64(0))
    most = max((ngrams[-1] for ngrams in asked if len(ngrams)), default=np.uint64(0))
    steps = max(1, sum(map(len, asked)) // ANSWER_NGRAMS)
    width = int(most - least) // steps + 1
    bounds = np.array([int(least) + step * width for step in range(1, steps)], np.uint64)
    cuts = [[0, *np.searchsorted(ngrams, bounds), len(ngrams)] for ngrams in asked]
    for step in range(steps):
        ranges = [slice(cut[step], cut[step + 1]) for cut in cuts]
        some = np.concatenate([ngrams[part] for ngrams, part in zip(asked, ranges)])
        held = np.concatenate([counts[part] for counts, part in zip(times, ranges)])
        distinct, which = np.unique(some, return_inverse=True)
        totals = np.bincount(which, held, len(distinct)).astype(np.int64)[which]
        ends = np.cumsum([part.stop - part.start for part in ranges])[:-1]
        for answer, part, found in zip(answers, ranges, np.split(totals, ends)):
            answer[part] = found
    coded = [_coded(answer & _LOWER) for answer in answers]
    return pd.DataFrame(
        {
            "chunk": rows["chunk"],
            "part": rows["part"],
            "control": [control for control, _ in coded],
            "data": [data for _, data in coded],
            "above": [_above(answer) for answer in answers],
        }
    )


_LOWER = (1 << 32) - 1


def _above(counts: np.ndarray) -> bytes:
    """What is over 32 bits of each count; nothing if that is so of none."""
    above = (counts >> 32).astype("<u4")
    return above.tobytes() if above.any() else b""


def _whole(control: bytes, data: bytes, above: bytes, count: int) -> np.ndarray:
    lower = _decoded(control, data, count).astype(np.int64)
    return lower + (np.frombuffer(above, "<u4").astype(np.int64) << 32) if above else lower


# Scores


def _score(order: int, parts: int, corpus: int):
    def score(key, chunks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = chunks.iloc[0].to_dict()
        words, document = _words(row)
        ngrams = _distinct(words, document, order)
        sizes = np.diff(_cuts(ngrams, parts))
        answers = answers.sort_values("part")
        totals = np.concatenate(
            [
                np.zeros(0, np.int64),
                *(
                    _whole(control, data, above, int(sizes[part]))
                    for part, control, data, above in zip(
                        *(answers[name] for name in ("part", "control", "data", "above"))
                    )
                ),
            ]
        ).astype(np.int64)
        counts = np.asarray(row["n_words"], np.int64)
        # Whole documents, some at a time: what is made on the way is larger than the chunk.
        ends = np.cumsum(counts)
        some = (ends - counts) // SCORED_WORDS
        firsts = np.append(np.flatnonzero(np.diff(some, prepend=-1)), len(counts))
        scored = []
        for first, last in zip(firsts[:-1], firsts[1:]):
            these = slice(ends[first] - counts[first], ends[last - 1])
            held = words[these], document[these] - first, counts[first:last]
            scored.append(scores(*held, ngrams, totals))
        known, total = (np.concatenate(x) for x in zip(*scored))
        return pd.DataFrame(
            {
                "doc_id": list(row["doc_ids"]),
                "n_words": counts,
                "n_known": known,
                "log_score": np.where(counts > 0, total / np.maximum(counts, 1), np.nan),
            }
        )

    def scores(words, document, counts, ngrams, totals) -> tuple[np.ndarray, np.ndarray]:
        others = [_others(words, document, n, ngrams, totals) for n in range(1, order + 1)]
        # The longest n-gram that others hold decides; words are known from the start.
        elsewhere = (corpus - counts)[document]
        logs = np.log(np.maximum(others[0], 0.5) / np.maximum(elsewhere, 1))
        logs += (order - 1) * math.log(BACKOFF)
        for n in range(2, order + 1):
            # What the context has elsewhere is at least what the n-gram has there.
            context = np.roll(others[n - 2], 1)
            found = others[n - 1] > 0
            share = np.log(np.maximum(others[n - 1], 1) / np.maximum(context, 1))
            logs = np.where(found, share + (order - n) * math.log(BACKOFF), logs)
        known = np.bincount(document, others[order - 1] > 0, len(counts)).astype(np.int64)
        return known, np.bincount(document, logs, len(counts))

    return score


def _others(words, document, order: int, ngrams, totals) -> np.ndarray:
    """How often the n-gram that ends at each word occurs in other documents."""
    found = _ngrams(words, document, order)
    inside = np.flatnonzero(found)
    # A stable order keeps documents ascending within an n-gram: what a document holds of one
    # stands together, and looking up ascending n-grams goes through memory in order.
    inside = inside[np.argsort(found[inside], kind="stable")]
    ascending, owner = found[inside], document[inside]
    starts = np.ones(len(inside), bool)
    starts[1:] = (ascending[1:] != ascending[:-1]) | (owner[1:] != owner[:-1])
    own = np.diff(np.append(np.flatnonzero(starts), len(inside)))
    rest = totals[np.searchsorted(ngrams, ascending[starts])] - own
    result = np.zeros(len(words), np.int64)
    result[inside] = np.repeat(rest, own)
    return result


def _bucketed(chunks: DataFrame, path: str) -> DataFrame:
    """The chunks, written to a folder in buckets by their number."""
    spark = chunks.sparkSession
    name = f"lm_chunks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = chunks.write.option("path", path).option("compression", "zstd")
    writer.format("parquet").bucketBy(buckets, "chunk").saveAsTable(name)
    found = spark.table(name)
    found.schema  # looked up here, so that the name is free to go; the files stay
    spark.sql(f"DROP TABLE {name}")
    return found


def score_documents(docs: DataFrame, new_path: NewPath, order: int = 2) -> DataFrame:
    """Per document: its words, those whose full n-gram others hold, and its mean log score.

    Chunks are written to a folder of ``new_path``, so that texts are read once.
    """
    spark = docs.sparkSession
    # Ids as text: numbers that can be NULL would become floats in pandas.
    named = docs.select(F.col("doc_id").cast("long").cast("string"), "text")
    chunks = _bucketed(named.mapInArrow(_chunks, _CHUNK), new_path())
    corpus = chunks.agg(F.sum("size")).first()[0] or 0
    parts = -(-corpus // PARTITION_WORDS) or 1
    requests = chunks.mapInArrow(_requests(order, parts), _REQUEST)
    answers = requests.groupBy("part").applyInPandas(_answer, _ANSWER)
    scored = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    scored = scored.applyInPandas(_score(order, parts, corpus), _SCORE)
    return scored.select(
        F.col("doc_id").cast("long"),
        "n_words",
        "n_known",
        F.when(F.col("n_words") > 0, F.col("log_score")).alias("log_score"),
    )
