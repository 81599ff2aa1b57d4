"""License texts in documents, by votes of word runs for the places where a text would begin.

Each run of ``GRAM`` words of a document is joined, by hash and words, to the templates that
hold it. A match at word p of the document and word q of the template votes for the diagonal
p - q, the place where the template would begin. Diagonals of one template that lie within its
drift of each other, ``DRIFT`` of its words, are merged: words were put in or left out between
them. Of a merged span, the template's words that its votes cover are counted, over the length
of template or span, whichever is more; a share of ``SHARE`` gives the document the template's
label. A phrase is at a place if all of its runs vote for it.

Only words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` count, with A-Z lower-cased; NULL has none.
Templates are a fixed list of some 500 positions, so they go to all tasks; documents send on
their votes only, by row, and rows without one a single line. Repeated rows count as documents
of their own. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugemill.llm.license_texts import PHRASES, TEXTS
from gaugemill.llm.words import LETTERS_AND_DIGITS, spans_of, utf8

GRAM = 3
SHARE = 0.8
DRIFT = 0.2
# Texts are cut into parts of about so many bytes, between words.
PART_BYTES = 1 << 20

_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_RUNS = "row long, doc_id long, n_words long, pos long, run string"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    is_phrase: bool = False

    @property
    def drift(self) -> int:
        """How far apart diagonals of one span may lie; a phrase has one diagonal."""
        return 0 if self.is_phrase else int(DRIFT * len(self.words))


def words_of(text: str) -> tuple[str, ...]:
    return tuple(_WORD.findall(text.translate({x: x + 32 for x in range(65, 91)})))


TEMPLATES = (
    *(Template(label, words_of(text), True) for text, label in PHRASES.items()),
    *(Template(label, words_of(text)) for label, text in TEXTS),
)


def template_runs(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """A row per run of words in a template."""
    if any(len(template.words) < GRAM for template in templates):
        raise ValueError(f"a template needs {GRAM} words at least")
    rows = [
        (number, x.label, x.is_phrase, len(x.words), x.drift, at, " ".join(x.words[at : at + GRAM]))
        for number, x in enumerate(templates)
        for at in range(len(x.words) - GRAM + 1)
    ]
    return spark.createDataFrame(
        rows,
        "template int, label string, is_phrase boolean, size int, drift int, at long, "
        "template_run string",
    )


# Runs of words


def _parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Whole texts of limited size together, or parts of a long one: texts and bytes."""
    text, texts = 0, len(offsets) - 1
    while text < texts:
        begin = int(offsets[text])
        end = int(np.searchsorted(offsets, begin + PART_BYTES, "right")) - 1
        if end > text:
            yield text, end, begin, int(offsets[end])
            text = end
            continue
        stop = int(offsets[text + 1])
        while begin < stop:
            cut = begin + PART_BYTES
            while cut < stop:  # on to the end of a word
                ahead = np.flatnonzero(~LETTERS_AND_DIGITS.in_word[data[cut : cut + PART_BYTES]])
                if len(ahead):
                    cut += int(ahead[0])
                    break
                cut += PART_BYTES
            cut = min(cut, stop)
            yield text, text + 1, begin, cut
            begin = cut
        text += 1


class _Runs:
    """The runs of words of a column of texts, part by part."""

    def __init__(self, longest: int) -> None:
        self.longest = longest  # of a template's words, in bytes
        self.before = b"", np.zeros(0, np.int64), 0  # last words of a part, and all before

    def of(
        self, data: np.ndarray, offsets: np.ndarray, is_new: bool
    ) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """Text and place of each run, the run, and how many words each text has so far."""
        data = _LOWER[data]
        starts, ends = spans_of(data, offsets, LETTERS_AND_DIGITS)
        first = np.searchsorted(starts, offsets)
        carried, sizes, passed = (b"", np.zeros(0, np.int64), 0) if is_new else self.before
        # The words, a space after each, led by those that the part before ended with.
        own = ends - starts
        after = np.cumsum(own + 1)
        joined = np.full(int(after[-1]) if len(after) else 0, 0x20, np.uint8)
        place = np.arange(len(joined) - len(own)) + np.repeat(np.arange(len(own)), own)
        joined[place] = data[place + np.repeat(starts - (after - own - 1), own)]
        joined = np.concatenate([np.frombuffer(carried, np.uint8), joined])
        sizes = np.concatenate([sizes, own])
        lead = len(sizes) - len(own)
        counts = np.diff(first)
        text = np.concatenate([np.zeros(lead, np.int64), np.repeat(np.arange(len(counts)), counts)])
        begin = np.append(0, np.cumsum(sizes + 1))
        rank = np.arange(len(sizes)) - np.append(0, first[1:-1] + lead)[text] + (
            passed - lead if lead or passed else 0
        )
        last = len(sizes) - GRAM + 1
        at = np.arange(max(last, 0))
        at = at[text[at] == text[at + GRAM - 1]]
        for step in range(GRAM):  # a longer word is in no template
            at = at[sizes[at + step] <= self.longest]
        length = begin[at + GRAM] - 1 - begin[at]
        ends = np.cumsum(length)
        bytes_at = np.repeat(begin[at] - (ends - length), length) + np.arange(int(length.sum()))
        runs = pa.Array.from_buffers(
            pa.large_string(),
            len(at),
            [None, pa.py_buffer(np.append(0, ends)), pa.py_buffer(joined[bytes_at])],
        ).cast(pa.string())
        keep = max(len(sizes) - GRAM + 1, 0)
        total = passed + len(own)
        self.before = joined[begin[keep] :].tobytes(), sizes[keep:], total
        return text[at], runs, rank[at], counts


def _runs_of(longest: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            words = np.zeros(batch.num_rows, np.int64)
            runs, last = _Runs(longest), -1
            row = batch.column(0).to_numpy()
            for begin, end, low, high in _parts(data, offsets):
                cuts = np.clip(offsets[begin : end + 1], low, high) - low
                text, found, place, counts = runs.of(data[low:high], cuts, begin != last)
                words[begin:end] += counts
                last = begin
                yield _record(row[begin + text], None, None, place, found)
            yield _record(row, batch.column(1), words, None, None)

    return run


def _record(row, doc_id, n_words, place, runs) -> pa.RecordBatch:
    size = len(row)
    long, text = pa.int64(), pa.string()
    columns = [
        pa.array(row),
        pa.nulls(size, long) if doc_id is None else doc_id,
        pa.nulls(size, long) if n_words is None else pa.array(n_words),
        pa.nulls(size, long) if place is None else pa.array(place),
        pa.nulls(size, text) if runs is None else runs,
    ]
    return pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_words", "pos", "run"])


# Votes


def license_spans(
    docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES
) -> DataFrame:
    """Spans of documents that templates have voted for, with the template's words covered.

    ``places`` counts where the whole template stands word by word. Each document has, besides,
    a row without a template that gives its ``n_words``.
    """
    spark = docs.sparkSession
    longest = max(len(word.encode()) for x in templates for word in x.words)
    runs = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text"
    ).mapInArrow(_runs_of(longest), _RUNS)
    known = F.broadcast(template_runs(spark, templates))
    same = (F.xxhash64("run") == F.xxhash64("template_run")) & (
        F.col("run") == F.col("template_run")
    )
    votes = (
        runs.join(known, same, "left")
        .where("template IS NOT NULL OR run IS NULL")
        .drop("run", "template_run")
        .withColumn("diagonal", F.col("pos") - F.col("at"))
        .repartition("row")
    )
    diagonals = Window.partitionBy("row", "template").orderBy("diagonal", "at")
    far = F.col("diagonal") - F.lag("diagonal").over(diagonals) > F.col("drift")
    spans = Window.partitionBy("row", "template", "span").orderBy("at")
    on_diagonal = Window.partitionBy("row", "template", "diagonal")
    fresh = F.col("at") - F.lag("at").over(spans)
    whole = (F.col("at") == 0) & (F.col("votes") == F.col("size") - GRAM + 1)
    voted = (
        votes.withColumn("far", F.coalesce(far, F.lit(False)).cast("int"))
        .withColumn("span", F.sum("far").over(diagonals))
        .withColumn("votes", F.count("template").over(on_diagonal))
        .withColumn("covers", F.least(F.coalesce(fresh, F.lit(GRAM)), F.lit(GRAM)))
    )
    return voted.groupBy("row", "template", "span").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.first("label").alias("label"),
        F.first("is_phrase").alias("is_phrase"),
        F.first("size").alias("size"),
        F.min("pos").alias("begin"),
        (F.max("pos") + GRAM).alias("end"),
        F.sum("covers").alias("covered"),
        F.count_if(whole).alias("places"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first_place"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last_place"),
    )


def _score() -> Column:
    return F.col("covered") / F.greatest(F.col("size"), F.col("end") - F.col("begin"))


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Labels of each document, the places of phrases, and the best score of a labelled span."""
    found = license_spans(docs, templates).withColumn("score", _score())
    is_base = F.col("is_phrase") & (F.col("places") > 0)
    is_found = F.when(F.col("is_phrase"), F.col("places") > 0).otherwise(F.col("score") >= SHARE)

    def listed(condition: Column) -> Column:
        labels = F.collect_set(F.when(condition, F.col("label")))
        return F.concat_ws(",", F.sort_array(labels))

    return (
        found.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_words").alias("n_words"),
            F.sum(F.when(F.col("is_phrase"), F.col("places")).otherwise(0)).alias("n_base"),
            F.min(F.when(is_base, F.col("first_place"))).alias("first_word"),
            F.max(F.when(is_base, F.col("last_place"))).alias("last_word"),
            listed(is_base).alias("base_labels"),
            listed(is_found).alias("labels"),
            F.coalesce(F.max(F.when(is_found, F.col("score"))), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )
