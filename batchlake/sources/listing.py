"""Object listings: names, sizes and times of files, never their content."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def decoded_path(c: Column) -> Column:
    """A path as the file system spells it; metadata columns hold it percent-encoded."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def key_below(path: Column, root: str) -> Column:
    """The part of a path below ``root``: what follows the first place at which it is named."""
    folder = root.split("://", 1)[-1].split(":", 1)[-1].rstrip("/") + "/"
    begin = F.locate(folder, path)
    return F.when(begin > 0, F.substring(path, begin + len(folder), F.length(path))).otherwise(path)


def list_objects(
    spark: SparkSession,
    root: str,
    prefix: str = "",
    name_filter: str | None = None,
    paths: list[str] | None = None,
) -> DataFrame:
    """(key, size, last_modified) of every file below ``root``/``prefix``, or of the files named
    in ``paths``. Not capped."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    found = reader.load(paths or f"{root.rstrip('/')}/{prefix}".rstrip("/")).drop("content")
    return found.select(
        key_below(F.col("path"), root).alias("key"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )


def list_zones(spark: SparkSession, zones: dict[str, str]) -> DataFrame:
    """(zone, key, size, last_modified) of several zones, given as {zone: root}."""
    parts = [
        list_objects(spark, root).select(F.lit(zone).alias("zone"), "*")
        for zone, root in zones.items()
    ]
    return reduce(DataFrame.unionByName, parts)
