"""Counts over a whole text, on which quality rules vote."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"

# Frequent short words of English, French, German and Spanish.
FUNCTION_WORDS = frozenset(
    "the of and to in is that it for was on as with be by at this are or from an a "
    "de la le et les des un une du en que qui dans pour est pas sur au avec par ne "
    "der die und das den von zu mit sich auf ist im dem nicht ein eine fur für als auch "
    "el los las y del se con por su para al lo como mas más o pero sus".split()
)

_WORD = re.compile(r"[^\x20\x09-\x0D]+")

COLUMNS = {
    "n_words": "words ``[^\\x20\\x09-\\x0D]+``",
    "word_chars": "code points in words",
    "n_symbols": "characters of ``[#*$%&|<>]``",
    "n_dup_lines": "lines with a word, equal to an earlier line",
    "n_repeat_words": "words in three-word windows found twice or more",
    "n_lines": "lines with a word",
    "n_function": "frequent short words, in lower case and without punctuation",
    "n_upper": "words of two cased letters or more, all in upper case",
    "n_ended": "lines that end a sentence",
    "n_distinct": "distinct words",
    "n_echo": "words equal to the one before",
    "n_bare": "words without a letter or digit",
    "n_plain": "words of letters only, but for one mark at the end",
}


def count_features(text: str) -> tuple[int, ...]:
    words = _WORD.findall(text)
    n_words = len(words)
    lines = [line for line in text.split("\n") if not _blank(line)]
    tally = Counter(words)
    function = upper = bare = plain = 0
    for word, times in tally.items():
        if word.strip(".,;:!?\"'()").lower() in FUNCTION_WORDS:
            function += times
        if word.isupper() and sum(map(str.isalpha, word)) > 1:
            upper += times
        if not any(map(str.isalnum, word)):
            bare += times
        if word.isalpha() or (word[-1] in ".,;:!?" and word[:-1].isalpha()):
            plain += times
    return (
        n_words,
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        function,
        upper,
        sum(line.rstrip(SPACES)[-1] in ".!?:;\"')…»" for line in lines),
        len(tally),
        sum(map(str.__eq__, words, words[1:])),
        bare,
        plain,
    )


def _blank(line: str) -> bool:
    return not line.strip(SPACES)


def repeated_words(words: list[str]) -> int:
    """Words inside a window of three that the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    tally = Counter(windows)
    covered, reach = 0, 0
    for at, window in enumerate(windows):
        if tally[window] > 1:
            covered += at + 3 - max(at, reach)
            reach = at + 3
    return covered


def with_features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts; NULL text counts as empty."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [count_features(text.as_py() or "") for text in batch.column(1)]
            columns = list(zip(*rows)) or [()] * len(COLUMNS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(column, pa.int64()) for column in columns)],
                names=["doc_id", *COLUMNS],
            )

    kinds = ", ".join(f"{name} long" for name in COLUMNS)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        count, f"doc_id long, {kinds}"
    )
