"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.sources.scratch import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b): the smallest node it is linked to.

    Each round hangs larger neighbours on a node's smallest one, then smaller ones too; rounds are
    stored, so lineage stays short and lost executors cost a read. Groups only ever yield their
    minimum, combined before the shuffle; the joins with it are over stored tables, so adaptive
    execution can split a node with very many links.
    """
    edges = stored(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = _print(edges)
    while True:
        edges = stored(_small_star(stored(_large_star(edges), "large-star")), "small-star")
        after = _print(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    hung = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
