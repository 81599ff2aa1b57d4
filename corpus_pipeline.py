"""From raw documents to packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugemill.llm.decontaminate import decontaminated
from gaugemill.llm.packing import pack
from gaugemill.llm.pii import replace_pii
from gaugemill.llm.probminhash import first_of_each
from gaugemill.llm.quality_classifier import reject_low_quality, train
from gaugemill.llm.queries import folders
from gaugemill.sources.folders import new_staging_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It is trained on the stage's own input."""
    _, scorer = train(docs, folders(spark, "votes")())
    return reject_low_quality(docs, scorer)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: that of the smallest id."""
    return first_of_each(docs, folders(spark, "dedup"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced in the texts; ``n_chars``, where present, follows."""
    replaced, _ = replace_pii(docs, folders(spark, "pii"))
    if "n_chars" not in docs.columns:
        return replaced
    return replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document, with its bin."""
    return pack(docs, folders(spark, "sizes")())


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_surrogates", pii_surrogates),
    ("best_fit_packing", best_fit_packing),
]

# The stages train a model, draw keyed surrogates and pack bins: no SQL for that.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{new_staging_path(spark, name)}/docs"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
