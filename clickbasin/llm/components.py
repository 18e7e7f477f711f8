"""Connected components of a graph given by its edges, in a logarithmic number of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickbasin.llm.support import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node that an edge names, with the smallest node it is connected to.

    ``edges`` are (u, v); direction, repeats and loops make no difference. Nodes link to the
    smallest of their neighbours, in turn for larger and for smaller neighbours, until nothing
    changes. Every round is written to the shared folder. A node may have very many neighbours:
    their minimum is taken before they are shuffled, and as the minima are read from a table, a
    join with them is split where one node has most of the rows.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = stored(edges, "edges")
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select("v", "u"))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        larger = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        larger = stored(larger.distinct(), "edges")
        least = stored(larger.groupBy("u").agg(F.min("v").alias("m")), "least")
        smaller = larger.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(smaller.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
