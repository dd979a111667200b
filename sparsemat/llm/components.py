"""Connected components by distributed union-find (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, shuffle_tasks

#: A node is a hub if it holds more than 1 / (HUB_SHARE * shuffle partitions) of the edges.
HUB_SHARE = 4


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of ``edges`` but the roots: root is the smallest node reachable.

    Each round hooks every node's larger neighbours, then its smaller ones, under the least
    of its neighbourhood; the rounds grow with the logarithm of the longest path. The least
    neighbour is an aggregate (summed before its shuffle) that is joined back; a hub's
    neighbours are dealt over many tasks there. Only a count and a checksum come to the driver.
    Loops and nulls are ignored, an empty input gives an empty result.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))
    )
    now = materialize(now.distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(state)
        share = max(1, state[0] // (HUB_SHARE * shuffle_tasks(edges.sparkSession)))
        now = materialize(_small_star(_large_star(now, share), share), "edges")


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c"))


def _with_least(pairs: DataFrame, share: int) -> DataFrame:
    """``(u, v, m)``: each pair and the least v of its u.

    A node with more than ``share`` pairs is a hub: its pairs go to as many slices as it has shares,
    by a hash of v, and its least is repeated for each. The pairs are at most twice the
    edges that ``share`` comes from, so there are at most 2 * ``HUB_SHARE`` * tasks hubs
    (and as many slices again), whatever the data: their list may be broadcast.
    """
    least = _least(pairs)
    slices = F.ceil(F.col("c") / share)
    hubs = least.filter(F.col("c") > share).select("u", slices.alias("n"))
    sliced = pairs.join(F.broadcast(hubs), "u", "left")
    sliced = sliced.withColumn("s", F.pmod(F.xxhash64("v"), F.coalesce("n", F.lit(1).cast("long"))))
    parts = F.when(F.col("c") > share, slices).otherwise(1).cast("long")
    repeated = least.select("u", "m", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("s"))
    return sliced.join(repeated, ["u", "s"]).select("u", "v", "m")


def _large_star(edges: DataFrame, share: int) -> DataFrame:
    """Each node's larger neighbours are put under the least of its neighbours and itself."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    larger = _with_least(both, share).filter("v > u")
    return larger.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame, share: int) -> DataFrame:
    """Each node and its smaller neighbours are put under the least of them."""
    under = _with_least(edges, share).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return under.unionAll(_least(edges).select("u", F.col("m").alias("v"))).distinct()
