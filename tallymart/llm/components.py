"""Connected components of a graph given by its links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import settle


def _stars(links: DataFrame, to_larger: bool) -> DataFrame:
    """Each node's neighbours are linked to the smallest node around it.

    `links` has one row per link, `a` > `b`.  With `to_larger` a node moves its larger
    neighbours (large star), otherwise its smaller ones and itself (small star).
    """
    if to_larger:
        around = links.select(F.col("a").alias("n"), F.col("b").alias("m")).unionByName(
            links.select(F.col("b").alias("n"), F.col("a").alias("m"))
        )
    else:
        around = links.select(F.col("a").alias("n"), F.col("b").alias("m"))
    low = around.groupBy("n").agg(F.least(F.col("n"), F.min("m")).alias("low"))
    moved = around.join(low, "n")
    if to_larger:
        moved = moved.where("m > n").select(F.col("m").alias("a"), F.col("low").alias("b"))
    else:
        moved = moved.select(F.col("m").alias("a"), F.col("low").alias("b")).unionByName(
            low.select(F.col("n").alias("a"), F.col("low").alias("b"))
        )
    return moved.where("a > b").distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Rows (node, root): the smallest node that each linked node reaches.

    `links` has two columns of one ordered type.  Nodes without a link to another node are
    not returned.  Links are contracted until every one ends in a root, O(log n) rounds in
    practice; each round is settled in the shared folder.  Raises if `rounds` do not suffice.
    """
    a, b = links.columns
    links = (
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").distinct()
    )
    links = settle(links, "links")
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    before = None
    for _ in range(rounds):
        now = links.agg(mark.alias("m")).first()["m"]
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
        links = settle(_stars(_stars(links, True), False), "links")
    raise RuntimeError(f"components not settled after {rounds} rounds")
