"""Connected components of links, by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import scratch, written


def _with_least(links: DataFrame) -> DataFrame:
    """``links`` (a, b) with the least b of every a.

    The minima are combined map-side and written, so that the join has a plain
    exchange on both sides and a node with very many links can be split.
    """
    least = written(links.groupBy("a").agg(F.min("b").alias("least")))
    return links.join(least, "a")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined = _with_least(both).where("b > a")
    return joined.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    joined = _with_least(down)
    moved = joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(joined.select("a", F.col("least").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node with a link; the component is its least node.

    ``links`` has columns a and b of one orderable type; direction, repeats and
    self links don't matter. Both steps keep the components, and every round
    either shortens the forest or leaves it a set of stars, which ends the loop.
    """
    with scratch() as keep:
        current = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        state = _state(current)
        while state[0]:
            with scratch() as keep_round:
                current = keep_round(written(_small_star(written(_large_star(current)))))
            after = _state(current)
            if after == state:
                break
            state = after
        keep(current)
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.union(roots)


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
    )
