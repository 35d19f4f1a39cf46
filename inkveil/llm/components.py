"""Connected components of a link table by alternating stars, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkveil.session import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour instead."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = staged(least, "least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = staged(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    tied = down.join(least, "u")
    return (tied.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .unionAll(least.select("u", F.col("m").alias("v"))).distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node but the roots; the root is the least node of its component.

    `links` has u and v of one ordered type, u <> v. Rounds go on until every node has one link, to a node that has none;
    the rows of a node that many are tied to are counted before they are shuffled; the least neighbours are a table of
    their own, so that adaptive execution can split the join of such a node (it cannot split one that an aggregate feeds).
    """
    links = staged(links.distinct(), "links")
    while True:
        links = staged(_small_star(_large_star(links)), "stars")
        several = links.groupBy("u").count().where("count > 1")
        chained = links.select(F.col("v").alias("u")).join(links.select("u"), "u", "left_semi")
        if several.isEmpty() and chained.isEmpty():
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
