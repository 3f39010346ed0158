"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from geotally.llm.common import written


def _nearest(links: DataFrame) -> DataFrame:
    """Every (u, v) with the smallest v of its u; hot nodes are counted before the shuffle and split in the join."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    # Both sides are exchanged before their sizes are known; a broadcast after that in each of many rounds would add up in the driver.
    return links.join(least.hint("merge"), "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _nearest(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    found = _nearest(links)
    moved = found.where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return found.select("u", F.col("least").alias("v")).union(moved).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) of every id in ``links`` (a, b): the smallest id that it reaches.

    Each round of two stars is written to the shared folder; the number of rounds grows with the logarithm of the
    longest path. Links with a null end or from a node to itself do not count.
    """
    first = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a != b")
    now, mark = _written(first.distinct())
    while mark[0]:
        before = mark
        now, mark = _written(_small_star(_large_star(now)))
        if mark == before:
            break
    return now.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(now.select("v", "v")).distinct()


def _written(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links as written, and a mark of them (their number, and two sums) that the writing job takes along."""
    seen = Observation()
    sums = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")]
    found = written(links.observe(seen, *sums), "links")
    return found, (seen.get["n"], seen.get["x"], seen.get["s"])
