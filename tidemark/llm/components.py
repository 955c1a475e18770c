"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._base import cut


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _mark(links: DataFrame):
    """Row count and sum of hashes: equal for equal tables."""
    return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component) for every id in links(a, b): component is the smallest id that links reach.

    Each round keeps connectivity and hangs nodes on smaller ones, so chains shorten geometrically; it stops when
    a round changes nothing. Minima are pre-aggregated and joined back by shuffle, so a star may have any size.
    """
    links = cut(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(links)
    for _ in range(most_rounds):
        both = _both(links)  # large star: every larger neighbour, and a itself, goes to a's smallest neighbour
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = cut(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))  # small star: smaller neighbours, and a, go to the smallest
        moved = large.join(least, "a")
        after = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()
        after = cut(after, "links")
        links, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    mine = links.groupBy("a").agg(F.min("b").alias("m"))
    return mine.select(F.col("a").alias("id"), F.col("m").alias("component")).union(mine.select("m", "m").distinct())
