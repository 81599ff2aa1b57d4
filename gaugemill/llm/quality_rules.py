"""Quality rules as weak votes instead of all-must-pass filters.

Each rule looks at one ratio of the counts in ``features`` and votes good, bad, or abstains. A
label model learns the rules' accuracies from all documents, and a document is kept if it is
more likely good than not, and if it passes the base limits: 50 words, and no more than half of
them in repeated three-word windows.

NULL text counts as empty, fails the base and is not kept. Repeated documents are judged one by
one, and count as often in the model. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugemill.llm.features import with_features
from gaugemill.llm.weak_labels import fit_label_model, pattern_counts

KEEP_FROM = 0.5  # posterior probability of being good


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("int")


def rules() -> dict[str, Column]:
    """The votes. Ratios are written as products, so that an empty text divides nothing."""
    n = F.col("n_words")
    some, many = n >= 20, n >= 50
    never = F.lit(False)
    return {
        "symbols": _vote(10 * F.col("n_symbols") > n, never),
        "marks": _vote(10 * F.col("n_bare") > n, never),
        "plain": _vote(some & (10 * F.col("n_plain") < 6 * n), 10 * F.col("n_plain") > 9 * n),
        "capitals": _vote(some & (3 * F.col("n_upper") > n), never),
        "echo": _vote(some & (10 * F.col("n_echo") > n), never),
        "repeats": _vote(some & (3 * F.col("n_repeat_words") > n), never),
        "function": _vote(many & (25 * F.col("n_function") < n), 8 * F.col("n_function") > n),
        "variety": _vote(many & (8 * F.col("n_distinct") < n), never),
        "length": _vote(
            some & ((F.col("word_chars") > 9 * n) | (F.col("word_chars") < 2 * n)), never
        ),
    }


def judge_quality(docs: DataFrame, staging: str) -> DataFrame:
    """The counts of each document, its posterior, and whether it is kept.

    Counts and votes are written to ``staging``, so that texts are read once.
    """
    spark = docs.sparkSession
    counted = with_features(docs)
    votes = rules()
    counted = counted.withColumns({f"vote_{name}": vote for name, vote in votes.items()})
    counted.write.parquet(staging)
    voted = spark.read.parquet(staging)
    names = [f"vote_{name}" for name in votes]
    model = fit_label_model(*pattern_counts(voted, names))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    posterior = model.posterior([F.col(name) for name in names])
    return voted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (posterior >= KEEP_FROM)).alias("kept"),
        posterior.alias("p_good"),
    )
