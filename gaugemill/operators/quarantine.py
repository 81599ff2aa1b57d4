"""Typing that keeps what it could not read.

A value is bad if there is text other than white space and no typed value. Rows with bad values
are set apart with the reasons and the file they came from, the others are typed; both are
written in the same pass over the input, and counted in it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugemill.operators.ingest import typed_value
from gaugemill.schemas import CSV_COLUMNS
from gaugemill.sources.readers import read_csv

_TEXT_COLUMNS = ("failure_type",)  # any text will do


@dataclass(frozen=True)
class Sorted:
    """Typed rows, rejected ones as they came with ``reasons`` and ``source_file``, and totals:
    ``rows``, ``typed``, ``rejected``, and the bad values of each column by its name."""

    typed: DataFrame
    rejected: DataFrame
    totals: dict[str, int]


def judged(rows: DataFrame) -> DataFrame:
    """Columns ``raw``, ``typed`` and ``reasons``: column and text of each bad value, in order.

    Other columns of the rows stay.
    """
    others = [name for name in rows.columns if name not in CSV_COLUMNS]
    typed = (typed_value(name, F.col(f"raw.{name}")).alias(name) for name in CSV_COLUMNS)
    reasons = (
        F.when(
            (F.trim(F.col(f"raw.{name}")) != "") & F.col(f"typed.{name}").isNull(),
            F.struct(F.lit(name).alias("column"), F.col(f"raw.{name}").alias("text")),
        )
        for name in CSV_COLUMNS
        if name not in _TEXT_COLUMNS
    )
    return (
        rows.select(F.struct(*CSV_COLUMNS).alias("raw"), *others)
        .withColumn("typed", F.struct(*typed))
        .withColumn("reasons", F.array_compact(F.array(*reasons)))
    )


def sort_out(spark: SparkSession, csv_path: str, folder: str) -> Sorted:
    """Type the rows of CSV files into ``folder`` and set apart those with bad values."""
    source = F.col("_metadata.file_path").alias("source_file")
    rows = judged(read_csv(spark, csv_path).select("*", source))
    is_bad = F.size("reasons") > 0
    seen = Observation("rows")
    bad = (
        F.count_if(F.array_contains(F.col("reasons.column"), name)).alias(name)
        for name in CSV_COLUMNS
        if name not in _TEXT_COLUMNS
    )
    (
        rows.observe(
            seen,
            F.count("*").alias("rows"),
            F.count_if(~is_bad).alias("typed"),
            F.count_if(is_bad).alias("rejected"),
            *bad,
        )
        .withColumn("is_rejected", is_bad)
        .write.partitionBy("is_rejected")
        .parquet(folder)
    )
    # The schema is given: a folder without rows has no files to tell it.
    schema = T.StructType([*rows.schema, T.StructField("is_rejected", T.BooleanType())])
    stored = spark.read.schema(schema).parquet(folder)
    return Sorted(
        stored.where("NOT is_rejected").select("typed.*"),
        stored.where("is_rejected").select("raw.*", "reasons", "source_file"),
        seen.get,
    )
