"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authlane.llm.common import packed, written

MAX_STEPS = 60


def _towards_least(pairs: DataFrame) -> DataFrame:
    """For (u, v) of one u: every v and u itself point at the least of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    return pairs.join(least, "u")


def _step(now: DataFrame) -> DataFrame:
    """The pairs (u, v), u > v, after a large-star and a small-star step.

    Pairs are doubled by a generator, as each branch of a union would run what is below it
    again, and repeats go at the end alone: no minimum depends on them.
    """
    both = now.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    large = _towards_least(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
    down = F.struct("u", F.col("least").alias("v"))
    star = _towards_least(large).select(F.inline(F.array(down, F.struct(F.col("v").alias("u"), F.col("least").alias("v")))))
    return star.where("u <> v").distinct()


def _settled(now: DataFrame) -> bool:
    """Every node points at one other at most, and none at a node that points on."""
    ends = now.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("out")), F.struct(F.col("v").alias("node"), F.lit(0).alias("out")))))
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.min("out").alias("least"))
    return nodes.where("out > 1 OR (out = 1 AND least = 0)").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); the component is its least node.

    Every step halves distances or better, so the steps grow with the logarithm of the
    longest path, and end as soon as the pairs are stars. A node's neighbours are never
    gathered: a minimum per node is joined back. Steps run in as many tasks as there are
    pairs for, as the pairs do not grow in number.
    """
    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    pairs = now.count()
    now = packed(now, pairs)
    for _ in range(MAX_STEPS):
        now = packed(written(_step(now), "edges"), pairs)
        if _settled(now):
            break
    else:
        raise RuntimeError("components did not settle")
    ends = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("component")), F.struct(F.col("v").alias("node"), F.col("v").alias("component")))
    return now.select(F.inline(ends)).distinct()
