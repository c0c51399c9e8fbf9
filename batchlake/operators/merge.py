"""Keyed merge on plain DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the highest ``order`` per key, as an aggregate (it combines map-side)."""
    rest = [c for c in rows.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.col(order)).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
        .select(*rows.columns)
    )


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], keep: list[str] | None = None
) -> DataFrame:
    """``target`` with every matching row replaced by ``source``'s and new rows added.

    Both sides are unique on ``keys``. Columns in ``keep`` retain the target's value on a match
    (a creation time). One shuffle per side on the keys, none if both are bucketed by them.
    """
    keep = set(keep or [])
    src = source.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in target.columns if c not in keys]
    ).withColumn("_hit", F.lit(True))
    joined = target.join(src, keys, "full_outer")
    hit = F.col("_hit").isNotNull()

    def pick(c: str):
        if c in keys:
            return F.col(c)
        if c in keep:
            return F.coalesce(F.col(c), F.col(f"_new_{c}")).alias(c)
        return F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[pick(c) for c in target.columns])


def fold_upserts(
    target: DataFrame,
    changes: DataFrame,
    keys: list[str],
    order: str,
    created: str | None = None,
) -> DataFrame:
    """``upsert`` of many batches at once: per key the last change wins, the first one creates."""
    rest = [c for c in target.columns if c not in keys]
    aggs = [F.max_by(F.struct(*rest), F.col(order)).alias("_row")]
    if created:
        aggs.append(F.min_by(F.col(created), F.col(order)).alias("_created"))
    folded = changes.groupBy(*keys).agg(*aggs)
    source = folded.select(
        *keys,
        *[
            (F.col("_created") if c == created else F.col(f"_row.{c}")).alias(c)
            for c in rest
        ],
    )
    return upsert(target, source, keys, keep=[created] if created else None)
