"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.llm.common import written


def _edges(df: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller end, without loops."""
    return df.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
    return row["n"], row["x"]


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every end of the links (columns u, v); a
    component is its smallest node. Rows with a null end are ignored.

    Large-star hangs every larger neighbour of a node on the smallest one of
    its neighbourhood, small-star does so with the smaller neighbours; they
    alternate until every node hangs on its component's smallest node, in
    about log(nodes) rounds. Minima are aggregated before the shuffle and
    joined back to the edges; a hub with very many edges is a skewed join,
    which adaptive execution splits. Each round is written to the shared
    folder."""
    edges = written(_edges(links), "components")
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _edges(both.where(F.col("v") > F.col("u")).join(least, "u")
                       .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = written(large, "components")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(_edges(hung.union(least.select("u", F.col("m").alias("v")))), "components")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select("v", "v").distinct())
