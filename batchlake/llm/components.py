"""Connected components of a table of links, as alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlake.operators.skew import join_groups
from batchlake.session import materialize

#: Links from which on a node is a hub.
HUB = 10_000


def _joined(links: DataFrame, least: DataFrame) -> DataFrame:
    """``links(u, v)`` with ``m`` of their ``u``. The links of a hub are spread over the tasks."""
    return join_groups(links, least, ["u"], weight="n", salt=F.col("v"), how="inner", hot_rows=HUB)


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the smallest node around it."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"))
    return _joined(both, least).where("v > u AND v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    moved = _joined(down, least).where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def stars(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of BIGINT nodes to ``stars(a, b)``: each node but the smallest of its
    component, with that smallest one.

    Every round is written to the shared folder. The number of rounds grows with the logarithm of
    the largest component. Minima are combined before they are shuffled, and what comes back to the links
    of a hub (the smallest node of a large component has a link to each other one) is looked up where
    they are, so no task gets all links of a node.
    """
    now = materialize(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    state = _state(now)
    while state[0]:
        now = materialize(_small_star(_large_star(now)), "stars")
        before, state = state, _state(now)
        if state == before:
            break
    return now
