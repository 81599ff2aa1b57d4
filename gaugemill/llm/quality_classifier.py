"""Quality classifier: a hashed linear scorer, trained on labels that no one wrote.

Overlapping heuristic labellers vote on every document; expectation-maximisation over all of
them estimates how far each can be trusted; the posteriors are the labels. A logistic regression
over hashed features of the text's words learns from them and scores every document, also those
on which the labellers are silent.

The scorer is trained on a bounded sample: at most ``SAMPLE`` distinct texts of 1 to
``SAMPLE_WORDS`` words on which a labeller speaks, those with the smallest hashes. Everything
else covers all documents.

NULL text counts as empty: it has no features and its score is that of the intercept alone.
Repeated documents get equal scores. An empty table gives an empty result. Other columns,
whatever their names, pass through ``reject_low_quality`` unchanged.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugemill.llm.features import _WORD, COLUMNS, count_features
from gaugemill.llm.weak_labels import LabelModel, fit_label_model, pattern_counts

SAMPLE = 6000
SAMPLE_WORDS = 2000
BUCKETS = 1 << 18
STEPS = 5000  # gradient steps at least, and every row of the sample ten times at least
BATCH = 64
RATE = 0.5
L2 = 1e-5
KEEP_FROM = 0.5


def labellers() -> dict[str, Column]:
    """The votes: 1 good, -1 bad, 0 silent. They overlap: most junk is seen by several."""
    n = F.col("n_words")
    some, many = n >= 10, n >= 30
    never = F.lit(False)

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0).cast("int")

    return {
        "symbols": vote(some & (5 * F.col("n_symbols") > n), never),
        "marks": vote(some & (8 * F.col("n_bare") > n), never),
        "plain": vote(some & (2 * F.col("n_plain") < n), 10 * F.col("n_plain") > 9 * n),
        "shouting": vote(some & (2 * F.col("n_upper") > n), never),
        "echo": vote(some & (5 * F.col("n_echo") > n), never),
        "loops": vote(some & (2 * F.col("n_repeat_words") > n), never),
        "prose": vote(many & (30 * F.col("n_function") < n), 8 * F.col("n_function") > n),
        "variety": vote(many & (10 * F.col("n_distinct") < n), never),
        "lines": vote(2 * F.col("n_dup_lines") > F.col("n_lines"), never),
    }


# Features


def hashed_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text: its words, their shapes, and how often they come."""
    words = _WORD.findall(text)
    values: Counter[int] = Counter()
    for word, times in Counter(words).items():
        bare = word.strip(".,;:!?\"'()")
        values[zlib.crc32(bare.lower().encode()) % BUCKETS] += times
        values[zlib.crc32(_shape(word, bare)) % BUCKETS] += times
    echo = sum(map(str.__eq__, words, words[1:]))
    if echo:
        values[zlib.crc32(b"\0echo") % BUCKETS] += 4 * echo
    buckets = np.fromiter(values.keys(), np.int64, len(values))
    found = np.log1p(np.fromiter(values.values(), np.float64, len(values)))
    norm = np.sqrt((found * found).sum())
    return buckets, found / norm if len(found) else found


def _shape(word: str, bare: str) -> bytes:
    if not bare or not any(map(str.isalnum, bare)):
        case = "mark"
    elif bare.isupper() and len(bare) > 1:
        case = "upper"
    elif bare[0].isupper():
        case = "first"
    elif bare.isalpha():
        case = "lower"
    else:
        case = "mixed"
    last = word[-1] if not word[-1].isalnum() else ""
    return f"\0{case} {last} {min(len(bare), 15) // 4}".encode()


# Training


@dataclass(frozen=True)
class Scorer:
    weights: np.ndarray
    intercept: float

    def score(self, text: str) -> float:
        """Probability that a text is good."""
        buckets, values = hashed_features(text)
        return float(1 / (1 + np.exp(-(self.weights[buckets] @ values + self.intercept))))


def train_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]]) -> Scorer:
    """Logistic regression on soft labels: stochastic gradients with a rate per weight."""
    weights, squares = np.zeros(BUCKETS), np.full(BUCKETS, 1e-2)
    labels = np.array([label for *_, label in rows])
    share = np.clip(labels.mean(), 0.01, 0.99) if len(rows) else 0.99
    intercept, square = float(np.log(share / (1 - share))), 1e-2
    random = np.random.default_rng(11)
    epochs = max(10, -(-STEPS * BATCH // len(rows))) if rows else 0
    for _ in range(epochs):
        for batch in np.array_split(random.permutation(len(rows)), -(-len(rows) // BATCH)):
            buckets = np.concatenate([rows[i][0] for i in batch])
            values = np.concatenate([rows[i][1] for i in batch])
            row = np.repeat(np.arange(len(batch)), [len(rows[i][0]) for i in batch])
            margin = np.bincount(row, weights[buckets] * values, len(batch)) + intercept
            error = 1 / (1 + np.exp(-margin)) - labels[batch]
            used, where = np.unique(buckets, return_inverse=True)
            slope = np.bincount(where, error[row] * values, len(used)) / len(batch)
            slope += L2 * weights[used]
            squares[used] += slope * slope
            weights[used] -= RATE * slope / np.sqrt(squares[used])
            step = float(error.mean())
            square += step * step
            intercept -= RATE * step / np.sqrt(square)
    return Scorer(weights.astype(np.float32), intercept)


def train(docs: DataFrame, staging: str) -> tuple[LabelModel, Scorer]:
    """Learn the labellers' accuracies from all documents, and the scorer from the sample.

    Votes go to ``staging``, so that all texts are read once for them.
    """
    spark = docs.sparkSession
    votes = labellers()
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("pick", F.xxhash64("text"))
    counts = ", ".join(f"{name} long" for name in COLUMNS)
    counted = texts.mapInArrow(_count(with_text=False), f"pick long, {counts}")
    counted.select("pick", "n_words", *(v.alias(name) for name, v in votes.items())).write.parquet(
        staging
    )
    voted = spark.read.parquet(staging)
    model = fit_label_model(*pattern_counts(voted, list(votes)))
    spoken = F.greatest(*(F.abs(F.col(name)) for name in votes)) > 0
    usable = F.col("n_words").between(1, SAMPLE_WORDS) & spoken
    fitting = voted.where(usable).select("pick").distinct()
    last = fitting.orderBy("pick").limit(SAMPLE).agg(F.max("pick")).first()[0]
    if last is None:
        return model, train_scorer([])
    # Equal texts are one; with their own counts, so that the labels need no join.
    sample = texts.where(F.col("pick") <= last).groupBy("pick").agg(F.first("text").alias("text"))
    sample = sample.select("text", "pick").mapInArrow(
        _count(with_text=True), f"pick long, {counts}, buckets array<long>, weights array<double>"
    )
    sample = sample.withColumns(votes).where(usable).select(
        "pick", "buckets", "weights", model.posterior(list(map(F.col, votes))).alias("label")
    )
    rows = sorted(sample.collect(), key=lambda row: row.pick)
    return model, train_scorer([(np.array(r[1]), np.array(r[2]), r[3]) for r in rows])


def _count(with_text: bool):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.as_py() for text in batch.column(0)]
            columns = list(zip(*map(count_features, texts))) or [()] * len(COLUMNS)
            arrays = [batch.column(1), *(pa.array(column, pa.int64()) for column in columns)]
            names = ["pick", *COLUMNS]
            if with_text:
                hashed = [hashed_features(text) for text in texts]
                arrays.append(pa.array([b for b, _ in hashed], pa.list_(pa.int64())))
                arrays.append(pa.array([v for _, v in hashed], pa.list_(pa.float64())))
                names += ["buckets", "weights"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return count


# Scoring


def score_documents(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """``doc_id``, the probability of being good, and whether it is kept."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # as large as there are buckets

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.score(text.as_py() or "") for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "p_good"]
            )

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        score, "doc_id long, p_good double"
    )
    return scored.withColumn("kept", F.col("p_good") >= KEEP_FROM)


def reject_low_quality(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """The documents that are kept, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    text = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [shared.value.score(t.as_py() or "") >= KEEP_FROM for t in batch.column(text)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
