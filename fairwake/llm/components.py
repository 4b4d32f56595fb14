"""Connected components of a link table, by alternating stars.

Each round points every node at the smallest node it knows of (first among its larger
neighbours, then among its smaller ones) and is written before the next one starts, so a
lost executor costs one round. Rounds grow with the logarithm of the longest chain.
A node with very many links only matters as the key of minima, which combine before the
shuffle, and of equi joins with them. The minima are written first: adaptive execution
splits a hot key where both sides of a join come straight from a shuffle, not where one is
aggregated by that key in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairwake.llm.common import written


def _state(links: DataFrame) -> tuple:
    return tuple(links.select(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def roots(links: DataFrame) -> DataFrame:
    """(a, b) pairs of numbers -> (node, root): every node but the smallest of its component."""
    links = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    state = _state(links)
    while state[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
        least = written(least, "large-least")
        large = written(
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct(),
            "large-star",
        )
        least = written(large.groupBy("a").agg(F.min("b").alias("least")), "small-least")
        others = large.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        links = written(least.toDF("a", "b").union(others).distinct(), "small-star")
        before, state = state, _state(links)
        if state == before:
            break
    return links.toDF("node", "root")
