"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..stages import release, stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u))")).first())


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over undirected edges (u, v).

    Each round hangs neighbours on smaller nodes (large star, then small star), so long chains
    shorten geometrically. Minima are combined on the map side before they travel, and every
    round is a stage table, so the plan does not grow and lost executors cost one round. Minima are
    written before they are joined to the links they come from: in one stage with its aggregate a
    join cannot be split where one node has very many links.
    """
    links = stage(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while True:
        around = _both_ways(links)
        # Only nodes with a larger neighbour are asked for their minimum.
        above = F.max("v") > F.col("u")
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), above.alias("above")).filter("above").drop("above")
        least = minima = stage(least, "large-minima")
        large = around.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.filter("u != v").distinct(), "large-star")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "small-minima")
        joined = large.join(least, "u")
        small = joined.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = stage(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        same = _signature(small) == _signature(links)
        release(links, minima, large, least)
        links = small
        if same:
            break
    roots = links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return nodes.select("node").distinct().join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("component"))
