"""What the tests of the operators share."""

from __future__ import annotations

import itertools
import re

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Columns of users, with names that operators use themselves.
        T.StructField("label", T.StringType()),
        T.StructField("content", T.LongType()),
        T.StructField("row", T.DoubleType()),
    ]
)

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {code: code + 32 for code in range(65, 91)}

PROSE = (
    "the garden behind the old mill was quiet in the morning and a man from the village came "
    "to look at the water that had risen over the stones while the birds were still asleep "
    "on the roof of the barn and nobody in the house knew that he was there at all"
)

# NULLs, empty and very long texts, and repeated rows.
ODD_PAIRS = [
    (1, PROSE),
    (1, PROSE),
    (2, None),
    (None, None),
    (None, PROSE + " again"),
    (3, ""),
    (4, " \n\t "),
    (5, "?!"),
    (6, "word"),
    (7, " ".join(f"w{i % 977} the" for i in range(60_000))),
    (8, "été Straße   日本語 \x00 x\U0001f600y"),
    (9, PROSE.upper()),
]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def make_documents(spark, pairs, sources=("s",)):
    """A table of documents from pairs of id and text."""
    rows = [
        (i, text, "en", sources[n % len(sources)], len(text or ""), f"label {n}", n, 0.5)
        for n, (i, text) in enumerate(pairs)
    ]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


def paths(tmp_path):
    numbers = itertools.count()
    return lambda: f"{tmp_path}/{next(numbers)}"
