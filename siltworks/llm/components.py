"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.tables import written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for links ``u, v``: every node that can reach a smaller one, and the smallest it can reach.

    Each round hangs a node's larger neighbours under its smallest one, then the smaller ones, until nothing
    changes; the rounds needed grow with the logarithm of the longest path. Smallest neighbours combine before
    their exchange and are written, so that the joins with them have plain exchanges on both sides, which
    adaptive execution splits where a node has very many links.
    """
    edges = _pairs(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    while not _stars(edges):
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")), "star-least")
        large = edges.select(F.col("v").alias("w"), F.col("u").alias("v")).join(least.hint("merge"), F.col("w") == F.col("u"))
        large = written(large.select(F.col("v").alias("u"), F.least("m", "w").alias("v")), "star-large")
        down = written(large.groupBy("u").agg(F.min("v").alias("m")), "star-least")
        small = large.withColumnRenamed("u", "w").join(down.hint("merge"), F.col("w") == F.col("u"))
        edges = _pairs(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(down.select("u", F.col("m").alias("v"))))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs under one smaller node that hangs under none."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("under"), F.lit(0).alias("over"))
    ends = ends.unionAll(edges.select(F.col("v").alias("x"), F.lit(0).alias("under"), F.lit(1).alias("over")))
    nodes = ends.groupBy("x").agg(F.sum("under").alias("under"), F.max("over").alias("over"))
    return nodes.filter((F.col("under") > 1) | (F.col("under") > 0) & (F.col("over") > 0)).isEmpty()


def _pairs(edges: DataFrame) -> DataFrame:
    return written(edges.filter("u <> v").distinct(), "star-links")
