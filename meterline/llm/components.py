"""Connected components of a link table, by alternating large-star and small-star rounds.

Each round replaces links by links to the smallest neighbour and keeps their number from growing; it is
two aggregations (combined before the shuffle, so that a node with very many links sends one row per
task) and two joins, which adaptive execution splits where a node is hot. Rounds are written to the
shared folder, which cuts the lineage. Nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _smallest(links: DataFrame) -> DataFrame:
    """Of each node ``a``: the smallest of itself and its neighbours ``b``."""
    return links.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours move to the smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    moved = both.join(_smallest(both), "a").where("b > a")
    return moved.select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    moved = down.join(_smallest(down), "a")
    out = moved.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(moved.select("a", F.col("low").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Links (a, b) to (a, b): every linked node but the smallest of its component, and that smallest node."""
    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def state() -> tuple:
        return tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = state()
    if not before[0]:
        return now
    for _ in range(most_rounds):
        now = stored(_small_star(_large_star(now)))
        after = state()
        if after == before:  # stars, which a round leaves as they are
            return now
        before = after
    raise RuntimeError(f"no end of the rounds after {most_rounds}")
