"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component): the smallest id reachable, for every id that has an edge.

    ``edges`` has long columns ``a`` and ``b``; order, repeats and loops do not matter.
    Each round replaces the edges by stars around the smallest neighbour (first towards
    larger, then towards smaller neighbours) and writes them, so the lineage stays one
    round long and nothing but two numbers a round reaches the driver.  The rounds end
    when the edges no longer change: then they are stars around each smallest id.
    """
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        before, mark = mark, _mark(e)
        if mark == before:
            break
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
