"""Connected components of a link table by alternating large and small stars."""

from pyspark.sql import DataFrame, functions as F

from landfall.workspace import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the smallest node of its neighbourhood."""
    ways = _both_ways(edges)
    least = ways.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return ways.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest of them; edges run from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def settled(edges: DataFrame) -> bool:
    """Does every node have one edge at most, to a node that has none itself?"""
    ends = edges.select(F.col("b").alias("end")).distinct()
    heads = edges.groupBy("a").agg(F.count(F.lit(1)).alias("edges"))
    return heads.join(ends, heads["a"] == ends["end"], "left").filter("edges > 1 OR end IS NOT NULL").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of the links (a, b).

    Self links and repeated links are allowed. Each round halves the distance
    to the smallest node or better; a node's neighbours are only ever
    aggregated, never gathered in one place. Null ends are ignored.
    """
    spark = links.sparkSession
    ordered = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(spark, ordered, "links")
    while not settled(edges):
        edges = written(spark, small_star(large_star(edges)), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
