"""Connected components of links between documents, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clinchline.llm.common import staged


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of a link; the component is its smallest node.

    Each round hangs neighbours below the smallest one they know of, first from the view of
    larger neighbours, then of smaller ones; the number of rounds grows with the logarithm of
    the longest chain. Links stay distributed, every round is a written table, and a node with
    very many links is only ever reduced by a partial ``min`` or read by a join Spark can split.
    Null ends and links of a node with itself are ignored.
    """
    edges = staged(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    state = None
    while True:
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == state:
            break
        state = now
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("low"))
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("low", F.col("u")).alias("v"))
            .distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        hung = large.join(low, "u")
        edges = staged(
            hung.select(F.col("v").alias("u"), F.col("low").alias("v"))
            .union(hung.select("u", F.col("low").alias("v")))
            .where("u <> v")
            .distinct(),
            "edges",
        )
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v"), F.col("v")).distinct()
    )
