"""Joins of many rows to one row per group, where one group may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000  # groups up to this many rows go through the ordinary join
MAX_HOT = 10_000  # bound of the broadcast list of larger groups
SPREAD = 4096  # ways to spread rows the ordinary join has no work for


def hot_groups(groups: DataFrame, weight: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The largest groups, at most MAX_HOT of them.

    Any group outside this list holds less than 1/MAX_HOT of all rows, so one task can take it.
    """
    return groups.where(F.col(weight) > hot_rows).orderBy(F.desc(weight)).limit(MAX_HOT)


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    keys: list[str],
    weight: str,
    salt: Column,
    eligible: Column | None = None,
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``rows`` to ``groups`` (unique on ``keys``) so that no task gets a whole hot group.

    The largest groups are looked up in a broadcast list of at most MAX_HOT rows. Their rows, and
    rows that are not ``eligible`` or have a NULL key, have nothing left to look up: they pass the
    shuffle join spread evenly by ``salt`` instead of piling up on their key. All other rows meet
    their group there. The result is that of the plain join. ``how`` is left or inner.
    """
    payload = [c for c in groups.columns if c not in keys]
    # Stated here, not left to the join to infer, so that both uses of ``groups`` are one plan and
    # its shuffle is reused.
    for key in keys:
        groups = groups.where(F.col(key).isNotNull())
    hot = F.broadcast(
        hot_groups(groups, weight, hot_rows).select(
            *keys,
            *[F.col(c).alias(f"_hot_{c}") for c in payload],
            F.lit(True).alias("_hot"),
        )
    )
    can_match = F.lit(True)
    for key in keys:
        can_match = can_match & F.col(key).isNotNull()
    if eligible is not None:
        can_match = can_match & eligible
    stray = (1 + F.pmod(F.xxhash64(salt), F.lit(SPREAD))).cast("int")
    dealt = rows.join(hot, keys, "left").withColumn(
        "_lane", F.when(can_match & F.col("_hot").isNull(), F.lit(0)).otherwise(stray)
    )
    cold = groups.withColumns({"_lane": F.lit(0), "_cold": F.lit(True)})
    # A number first: rows are sorted by it, not by comparing long ids that are alike in all rows of a batch.
    number = F.xxhash64(*keys)
    joined = dealt.withColumn("_hash", number).join(cold.withColumn("_hash", number), ["_hash", *keys, "_lane"], "left")
    if how == "inner":
        joined = joined.where("_hot OR _cold")
    found = [
        F.when(F.col("_hot").isNotNull(), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c)
        for c in payload
    ]
    return joined.select(*rows.columns, *found)
