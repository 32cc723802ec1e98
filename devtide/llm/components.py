"""Connected components over links that Spark holds; nothing but two numbers a round
reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) of every node with a link to
    another one, from ``a``, ``b`` (long). Alternates the two star operations: neighbours
    above a node, then those below it, move to the smallest one known. The number of rounds
    grows with the logarithm of the longest path. Links with a null and loops are ignored."""
    edges = shared.stored(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while (now := _state(edges)) != before:
        before = now
        if not now[0]:
            break
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select(F.col("u").alias("k"), F.least("m", "u").alias("m"))
        up = both.filter("v > u").join(least, F.col("u") == F.col("k"))
        edges = up.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
        down = edges.join(lowest.select(F.col("u").alias("k"), "m"), F.col("u") == F.col("k"))
        edges = shared.stored(
            down.filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lowest.select("u", F.col("m").alias("v")))
            .distinct(),
            "links",
        )
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(
        edges.groupBy("v").agg(F.min("v").alias("component"))
    ).groupBy("node").agg(F.min("component").alias("component"))
