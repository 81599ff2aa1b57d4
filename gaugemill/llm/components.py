"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(edges: DataFrame, new_path: Callable[[], str]) -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, from edges ``u``, ``v``.

    Alternates between pointing the larger neighbours of each node, then the smaller ones, to
    the smallest of them, until the edges are one star per component. Each round is written to
    a new folder. A node with very many edges is met by partial aggregates and joins only, which
    split.
    """
    spark = edges.sparkSession

    def kept(frame: DataFrame) -> DataFrame:
        path = new_path()
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    def downward(frame: DataFrame) -> DataFrame:
        """From the larger node to the smaller one."""
        high, low = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        return frame.where("u <> v").select(high, low)

    edges = downward(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("low"))
        lowest = lowest.select("u", F.least("u", "low").alias("low"))
        large = both.where("v > u").join(lowest, "u")
        edges = kept(large.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct())
        lowest = edges.groupBy("u").agg(F.min("v").alias("low"))
        small = edges.join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.unionByName(lowest.select("u", F.col("low").alias("v")))
        edges = kept(downward(small).distinct())
        # In stars, a node has one edge down, or only edges up.
        degrees = edges.groupBy("u").agg(F.count("*").alias("edges"))
        inner = edges.select(F.col("v").alias("u")).join(degrees, "u", "left_semi")
        if degrees.where("edges > 1").select("u").unionByName(inner).isEmpty():
            break
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
