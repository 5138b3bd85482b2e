"""Connected components by alternating stars; no edge or label goes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.session import Workspace


def components(edges: DataFrame, kept: Workspace) -> DataFrame:
    """``node, root`` for each node of ``a, b`` beside the roots: root is the smallest node of the component.

    A step links the larger neighbours of each node to its smallest one, and then each node and its smaller
    neighbours to the smallest of them. It ends as soon as all links are stars, without a step to confirm that; the number of
    steps grows with the logarithm of the longest path.
    """
    now = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not are_stars(now):
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("a", F.col("m").alias("b")).unionAll(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        now = kept(small.distinct(), "stars")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def are_stars(links: DataFrame) -> bool:
    """Whether each node of the different links ``a, b`` has either one link to a smaller node or any number from larger ones."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.unionAll(links.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.where(F.col("down") + F.col("up") > 1).agg(F.count("*")).first()[0] == 0
