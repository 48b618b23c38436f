"""Connected components of a large graph, given as a DataFrame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.sources.scratch import materialize, release


def _stars(links: DataFrame) -> DataFrame:
    """One round: hang every larger neighbour on the least of its neighbourhood, then every node
    and its smaller neighbours on the least of those.  Components stay as they are."""
    both = links.select("node", "low").unionByName(links.select(F.col("low").alias("node"), F.col("node").alias("low")))
    least = both.groupBy("node").agg(F.least(F.min("low"), F.min("node")).alias("least"))
    large = both.join(least, "node").where("low > node").select(F.col("low").alias("node"), F.col("least").alias("low"))
    large = large.where("node > low")
    least = large.groupBy("node").agg(F.min("low").alias("least"))
    small = large.join(least, "node").where("low > least").select(F.col("low").alias("node"), F.col("least").alias("low"))
    return small.unionByName(least.select("node", F.col("least").alias("low"))).distinct()


def _only_stars(links: DataFrame) -> bool:
    """Whether every node hangs on one other, on which nothing is hung in turn."""
    ends = links.select("node", F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        links.select(F.col("low").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    )
    roles = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return roles.where("hangs > 1 OR hangs + holds > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node, component: the least node reachable, for each node of ``links`` (columns a, b) that is not itself the least.

    Every round is written and read back, so lineage stays short and a lost executor costs one
    round at most; the table of the round before then goes.  Rounds end when only stars are left; their
    number grows with the logarithm of the longest path.
    """
    pairs = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low")).where("node > low").distinct()
    now = materialize(pairs, "links")
    while not _only_stars(now):
        before, now = now, materialize(_stars(now), "links")
        release(before)
    return now.select("node", F.col("low").alias("component"))
