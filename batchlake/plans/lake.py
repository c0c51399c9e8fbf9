"""Zones of one lake and the reports over its file listings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders of a lake.
ZONES = ("raw", "clean", "rejected", "metadata", "curated", "quarantine", "query_results")


@dataclass(frozen=True)
class Lake:
    """Folder names below one root."""

    root: str

    def zone(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def zones(self) -> dict[str, str]:
        return {name: self.zone(name) for name in ZONES}


def purposes(spark: SparkSession, texts: dict[str, str]) -> DataFrame:
    """The caller's description of each zone; a zone without one has none."""
    rows = [(name, texts.get(name)) for name in ZONES]
    return spark.createDataFrame(rows, "zone string, purpose string")


def zone_inventory(objects: DataFrame, zones: DataFrame) -> DataFrame:
    """Per zone: objects, bytes, newest object, whether any key is partitioned (``k=v``).

    ``zones`` has a row per zone; zones without objects are listed with zeros.
    """
    totals = objects.groupBy("zone").agg(
        F.count(F.lit(1)).alias("object_count"),
        F.sum("size").alias("total_bytes"),
        F.max("last_modified").alias("latest_object"),
        F.bool_or(F.contains("key", F.lit("="))).alias("partitioned"),
    )
    return zones.join(totals, "zone", "left").select(
        "zone",
        "purpose",
        F.coalesce("object_count", F.lit(0)).alias("object_count"),
        F.coalesce("total_bytes", F.lit(0)).alias("total_bytes"),
        "latest_object",
        F.coalesce("partitioned", F.lit(False)).alias("partitioned"),
    )


def total_bytes(objects: DataFrame) -> DataFrame:
    return objects.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("storage_bytes"))


def zone_latest(objects: DataFrame, zone: str, prefix: str = "", n: int = 200) -> DataFrame:
    """The newest ``n`` objects of a zone, with a flag whether it holds more."""
    inside = objects.where((F.col("zone") == zone) & F.col("key").startswith(prefix))
    full = inside.agg((F.count(F.lit(1)) > n).alias("t")).scalar()
    return (
        inside.orderBy(F.desc("last_modified"), "key").limit(n).withColumn("truncated", full)
    )


def partition_segments(objects: DataFrame, n: int = 12) -> DataFrame:
    """Distinct ``k=v`` path segments, first ``n`` by text."""
    return (
        objects.select(F.explode(F.split("key", "/")).alias("segment"))
        .where(F.contains("segment", F.lit("=")))
        .distinct()
        .orderBy("segment")
        .limit(n)
    )


def new_objects(after: DataFrame, before: DataFrame, key: str = "key") -> DataFrame:
    """Objects of the later listing that the earlier one lacks."""
    return after.join(before.select(key), key, "left_anti")


def freshness(objects: DataFrame, batch_ts: Column, slack_seconds: int = 30) -> DataFrame:
    """Object count, newest object and whether it is at most ``slack_seconds`` older than
    ``batch_ts``."""
    fresh = F.unix_millis("latest") >= F.unix_millis(batch_ts) - slack_seconds * 1000
    return objects.agg(
        F.count(F.lit(1)).alias("object_count"), F.max("last_modified").alias("latest")
    ).withColumn("fresh", F.coalesce(fresh, F.lit(False)))
