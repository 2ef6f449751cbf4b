"""Connected components of a link table by alternating large and small stars.

Kiveris et al., 2014. Each round hangs the larger neighbours of a node, then its smaller
ones, on the smallest node it knows; after a few rounds every node hangs on the smallest of
its component. Links stay in tables: no node's links are gathered, and none pass the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.staging import Stage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    hung = both.where(F.col("b") > F.col("a")).join(least, "a")
    return hung.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``a`` is the larger end of each link here, as the large star leaves it."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    hung = links.join(least, "a")
    moved = hung.where(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    return tuple(links.agg(F.count(F.lit(1)), digest).first())


def components(links: DataFrame, stage: Stage) -> DataFrame:
    """node, component: every node with a link, and the smallest node it is connected to.

    ``links`` has long columns ``a`` and ``b`` in any direction; loops and repeats do no
    harm. Nodes without a link are not in the result.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    current = stage.put(links.where("a <> b").select(larger, smaller).distinct(), "links")
    before = _state(current)
    while True:
        following = stage.put(_small_star(_large_star(current)), "stars")
        stage.drop(current)
        current, after = following, _state(following)
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )
