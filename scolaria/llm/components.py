"""Connected components of a table of links, in rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scolaria.llm.shared import written

MAX_ROUNDS = 100


def component_labels(links: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """node, label: the smallest node that links (a, b: long) reach, for every node of a link.

    Each round points every node's neighbours at the smallest of them: first those above the node (large star), then
    those below it (small star). The number of rounds grows with the logarithm of the number of nodes. The table of a
    round is written, and the minima are written before they are joined, so that a node with many links is split.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        raised = written(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = written(raised.groupBy("u").agg(F.min("v").alias("m")))
        met = raised.join(least, "u")
        settled = written(
            met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        )
        same = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() == settled.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        edges = settled
        if same:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
