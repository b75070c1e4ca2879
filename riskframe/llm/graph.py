"""Connected components as repeated DataFrame joins (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.frames import released
from riskframe.session import durable


def _least(directed: DataFrame) -> DataFrame:
    return directed.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node each node of an edge (a, b) can reach.

    Both stars aggregate the minimum before they join it back, so a node with
    very many neighbours is merged map-side. Each round is checkpointed and the
    files of the one before are let go; the number of rounds grows with the
    logarithm of the longest path.
    """
    pairs = durable(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_least(both), "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        )
        small = large.join(_least(large), "u")
        pairs = durable(
            small.select("u", F.col("m").alias("v"))
            .unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        )
        now = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == state:
            break
        state = now
        del both, large, small
        released(edges.sparkSession)
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))
    ).distinct()
