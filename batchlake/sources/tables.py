"""Curated Parquet, external tables and the catalogue."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlake.schemas import CLEAN, CURATED, PARTITIONS
from batchlake.session import exists
from batchlake.sources.listing import decoded_path, key_below


def read_curated(
    spark: SparkSession, root: str, objects: list[str] | None = None, schema: T.StructType = CURATED
) -> DataFrame:
    """The curated table, or only some of its objects. Partition columns stay text."""
    reader = spark.read.schema(schema).option("basePath", root)
    if objects is None:
        return reader.parquet(root)
    return reader.parquet(*[f"{root.rstrip('/')}/{key}" for key in objects])


def read_batches(spark: SparkSession, root: str, batches: list[str]) -> DataFrame | None:
    """The rows of the named batches (those of a round), None if there are none. Their folders are looked up by
    name, so the objects of no other batch are listed, however many the table holds."""
    if not exists(spark, root):
        return None
    if not all(re.fullmatch(r"[\w.-]+", name) for name in batches):  # not to be spelled as a pattern
        return read_curated(spark, root).where(F.col("phase3_batch_id").isin(batches))
    days = "/".join(f"{part}=*" for part in PARTITIONS)
    try:
        return read_curated(spark, root, [f"{days}/phase3_batch_id={{{','.join(sorted(batches))}}}"])
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def with_file(curated: DataFrame) -> DataFrame:
    """Add ``_file`` and ``_row``: the object a row came from and its place there."""
    return curated.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )


def curated_objects(curated: DataFrame, root: str) -> DataFrame:
    """(phase3_batch_id, curated_object_keys) of rows with ``_file``: which objects hold a batch.

    The pairs are made distinct map-side; a batch has as many keys as it has files.
    """
    files = curated.select("phase3_batch_id", "_file").distinct()
    pairs = files.select("phase3_batch_id", key_below(decoded_path(F.col("_file")), root).alias("key"))
    return pairs.groupBy("phase3_batch_id").agg(
        F.array_sort(F.collect_list("key")).alias("curated_object_keys")
    )


def create_clean_table(spark: SparkSession, name: str, location: str) -> None:
    """External table over the clean files."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CLEAN)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, batch_id STRING) USING csv "
        f"OPTIONS (header 'true', quote '\"', escape '\"') "
        f"PARTITIONED BY (batch_id) LOCATION '{location}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")


def create_curated_table(spark: SparkSession, name: str, location: str, repair: bool = True) -> None:
    """External partitioned table over the curated files; picks up the partitions found there, unless told
    to leave them to ``add_partitions``."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CURATED)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(PARTITIONS)}, phase3_batch_id) LOCATION '{location}'"
    )
    if repair:
        repair_partitions(spark, name)


def repair_partitions(spark: SparkSession, name: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {name}")


#: Partitions that one statement adds.
ADDED_AT_ONCE = 200


def add_partitions(spark: SparkSession, name: str, location: str, batches: list[str]) -> int:
    """Register the folders of the named batches (those of a run) in a partitioned table, without a look at
    any other; how many there are. Folders that are registered already stay as they are."""
    keys = [*PARTITIONS, "phase3_batch_id"]
    mine = read_curated(spark, location).where(F.col("phase3_batch_id").isin(batches))
    found = [tuple(r) for r in mine.select(*keys).distinct().orderBy(*keys).collect()]
    for begin in range(0, len(found), ADDED_AT_ONCE):
        parts = []
        for values in found[begin : begin + ADDED_AT_ONCE]:
            pairs = list(zip(keys, values, strict=True))
            folder = "/".join(f"{k}={v}" for k, v in pairs)
            spec = ", ".join(f"{k} = '{v}'" for k, v in pairs)
            parts.append(f"PARTITION ({spec}) LOCATION '{location.rstrip('/')}/{folder}'")
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts)}")
    return len(found)


def catalogue_columns(spark: SparkSession, database: str | None = None) -> DataFrame:
    """(table_name, ordinal, column_name, data_type, is_nullable) of the catalogue's tables.

    Catalogue entries live in the driver's session; there is nothing to distribute.
    """
    rows = []
    for table in spark.catalog.listTables(database):
        if table.isTemporary:
            continue
        name = f"{table.namespace[0]}.{table.name}" if table.namespace else table.name
        for i, column in enumerate(spark.catalog.listColumns(name), start=1):
            rows.append((table.name, i, column.name, column.dataType, column.nullable))
    return spark.createDataFrame(
        rows,
        "table_name string, ordinal int, column_name string, data_type string, is_nullable boolean",
    )


def catalogue_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """(table_name, column_count), by name."""
    return (
        catalogue_columns(spark, database)
        .groupBy("table_name")
        .agg(F.count(F.lit(1)).alias("column_count"))
        .orderBy("table_name")
    )
