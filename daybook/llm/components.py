"""Connected components of links between integer ids, by alternating stars.

Each round first hangs every larger neighbour of an id on the id's smallest neighbour, then every
smaller one; links keep their components while paths halve. Rounds end when nothing changes.
Links are stored between rounds in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import stored


def _state(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def _stars(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("a"), F.col("lo").alias("b")).unionByName(
        edges.select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    )
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = (
        both.join(least, "a").where("b > a").select(F.col("b").alias("hi"), F.col("m").alias("lo"))
    ).distinct()
    smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = (
        large.join(smallest, "hi")
        .where("lo <> m")
        .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    )
    return moved.unionByName(smallest.withColumnRenamed("m", "lo")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``id``, ``component`` (its least id) of all linked ids but the components' least ones."""
    left, right = (F.col(name) for name in links.columns[:2])
    edges = stored(
        links.where(left != right)
        .select(F.greatest(left, right).alias("hi"), F.least(left, right).alias("lo"))
        .distinct()
    )
    state = _state(edges)
    while state[0]:
        edges = stored(_stars(edges))
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
