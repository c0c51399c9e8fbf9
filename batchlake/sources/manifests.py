"""Lineage manifests and serving hand-offs: one JSON document per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlake.schemas import MANIFEST, SERVING_BATCH
from batchlake.sources.listing import decoded_path, key_below


def _documents(spark: SparkSession, root: str, schema: T.StructType, mode: str) -> DataFrame:
    reader = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())]))
        .option("multiLine", True)
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", "_corrupt")
    )
    key = key_below(decoded_path(F.col("_metadata.file_path")), root)
    return reader.json(root).select("*", key.alias("manifest_key"))


def read_manifests(spark: SparkSession, root: str, clean_prefix: str = "") -> DataFrame:
    """Every ``*.json`` manifest below ``root``; an unreadable one is skipped, not fatal.

    ``clean_prefix`` keeps the batches whose clean or raw key lies below it.
    """
    found = _documents(spark, root, MANIFEST, "PERMISSIVE")
    good = found.where("_corrupt IS NULL AND phase1_batch_id IS NOT NULL").drop("_corrupt")
    return below_prefix(good, clean_prefix)


def below_prefix(manifests: DataFrame, clean_prefix: str) -> DataFrame:
    prefix = clean_prefix.strip("/")
    if not prefix:
        return manifests
    below = lambda c: F.coalesce(F.col(c).startswith(f"{prefix}/"), F.lit(False))
    return manifests.where(below("clean_key") | below("raw_key"))


def read_handoffs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Serving hand-offs, and the malformed ones as (manifest_key, reason)."""
    found = _documents(spark, root, SERVING_BATCH, "PERMISSIVE")
    fault = F.when(F.col("_corrupt").isNotNull(), "unreadable document").when(
        F.col("curated_object_keys").isNull(), "curated_object_keys is not a list"
    )
    judged = found.withColumn("reason", fault)
    return (
        judged.where("reason IS NULL").drop("_corrupt", "reason"),
        judged.where("reason IS NOT NULL").select("manifest_key", "reason"),
    )
