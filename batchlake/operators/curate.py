"""Clean rows to typed, categorised curated rows, or to quarantine with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlake.functions import dates, digests, numbers, text
from batchlake.operators.skew import HOT_ROWS, join_groups
from batchlake.schemas import LINEAGE, PARTITIONS, REQUIRED

PIPELINE_VERSION = "3.0.0"
MAX_INVALID_PERCENT = 10.0

INVALID_SALES = "invalid_sales"
SCHEMA_MISMATCH = "schema_mismatch"
DATE_PARSE_ERROR = "date_parse_error"

VALUE = "sales_value"  # the parsed sales of a tagged row


def with_lineage(
    rows: DataFrame,
    manifests: DataFrame,
    processed_timestamp: str | None,
    pipeline_version: str = PIPELINE_VERSION,
    batch: str = "batch_id",
    order: str = "ord",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Attach the lineage columns of each row's manifest; rows without a manifest drop out.

    The curated batch keeps the identity of the validated one, so a replay meets its own batch.
    ``processed_timestamp`` is the run's clock as ISO text; None keeps the manifest's.
    """
    stamp = (
        F.lit(processed_timestamp) if processed_timestamp else F.col("phase1_processed_timestamp")
    )
    lineage = manifests.select(
        F.col("phase1_batch_id").alias(batch),
        F.col("event_timestamp").alias("ingestion_timestamp"),
        stamp.alias("processed_timestamp"),
        "phase1_batch_id",
        F.col("phase1_batch_id").alias("phase3_batch_id"),
        "source_filename",
        F.col("raw_key").alias("source_raw_key"),
        F.col("clean_key").alias("source_clean_key"),
        F.lit(pipeline_version).alias("pipeline_version"),
        F.coalesce("valid_records", F.lit(0)).alias("_rows"),
    )
    return join_groups(
        rows, lineage, [batch], weight="_rows", salt=F.col(order), how="inner", hot_rows=hot_rows
    ).drop("_rows")


def error_reason(sales: Column, columns: list[str], date_column: str | None) -> Column:
    """Why a row cannot be curated, NULL if it can: bad sales, then no date column, then bad date.

    ``sales`` is the parsed whole number, NULL where there is none.
    """
    reason = F.when(sales.isNull(), INVALID_SALES)
    if date_column and date_column not in columns:
        reason = reason.otherwise(SCHEMA_MISMATCH)
    elif date_column:
        reason = reason.when(dates.date_unparsed(F.col(date_column)), DATE_PARSE_ERROR)
    return reason


def _payload(rows: DataFrame, extra: set[str]) -> list[str]:
    """The file's own columns: everything but lineage and bookkeeping."""
    return [c for c in rows.columns if c not in extra and c not in LINEAGE]


def tag_curation(
    rows: DataFrame, date_column: str | None = None, batch: str = "batch_id", order: str = "ord"
) -> DataFrame:
    """Add the parsed ``sales_value``, ``error_reason`` and the y/m/d partition columns to rows
    with lineage."""
    columns = _payload(rows, {batch, order})
    # One step per use: the optimizer keeps a costly column that is used twice in its own step.
    return (
        rows.withColumn("_number", numbers.parse_number(text.ustrip(F.col("sales"))))
        .withColumn(VALUE, numbers.whole(F.col("_number")))
        .withColumn("error_reason", error_reason(F.col(VALUE), columns, date_column))
        .withColumns(dates.partition_parts(F.col("ingestion_timestamp")))
        .drop("_number")
    )


def curated_rows(
    tagged: DataFrame,
    date_column: str | None = None,
    batch: str = "batch_id",
    order: str = "ord",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Curated rows in table order. Extra text columns pass through with blanks collapsed; columns
    named in ``keep`` come along untouched at the end."""
    fixed = {batch, order, "error_reason", VALUE, *keep, *PARTITIONS, *REQUIRED}
    extras = _payload(tagged, fixed)
    kept = [
        (
            F.date_format(dates.standardize_date(text.collapse(F.col(c))), "yyyy-MM-dd")
            if c == date_column
            else text.collapse(F.col(c))
        ).alias(c)
        for c in extras
    ]
    sales = F.col(VALUE)
    return tagged.where("error_reason IS NULL").select(
        text.collapse(F.col("customer_id")).alias("customer_id"),
        text.normalize_name(F.col("name")).alias("name"),
        text.normalize_email(text.collapse(F.col("email"))).alias("email"),
        sales.alias("sales"),
        numbers.sales_category(sales).alias("sales_category"),
        *LINEAGE,
        *kept,
        *PARTITIONS,
        *keep,
    )


def quarantine_rows(
    tagged: DataFrame, batch: str = "batch_id", order: str = "ord"
) -> DataFrame:
    """Quarantined rows with the untouched record as a map."""
    own = _payload(tagged, {batch, order, "error_reason", VALUE, *PARTITIONS})
    pairs = [x for c in own for x in (F.lit(c), F.col(c).cast("string"))]
    return tagged.where("error_reason IS NOT NULL").select(
        F.create_map(*pairs).alias("raw_record"),
        "error_reason",
        "source_filename",
        "ingestion_timestamp",
        "processed_timestamp",
        "phase1_batch_id",
        "phase3_batch_id",
        "pipeline_version",
        F.col("error_reason").alias("reason"),
        *PARTITIONS,
    )


def run_stats(tagged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows read, written and quarantined, over all or per group."""
    return tagged.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col("error_reason").isNull()).alias("rows_written"),
        F.count_if(F.col("error_reason").isNotNull()).alias("rows_quarantined"),
    )


def quality_gate(stats: DataFrame, max_invalid_percent: float = MAX_INVALID_PERCENT) -> DataFrame:
    """Add ``passed``: the quarantined share may reach the limit but not exceed it; no rows pass."""
    share = F.col("rows_quarantined") / F.col("rows_read") * 100
    return stats.withColumn(
        "passed", F.when(F.col("rows_read") > 0, share <= max_invalid_percent).otherwise(True)
    )


def serving_batches(curated: DataFrame) -> DataFrame:
    """One hand-off row per curated batch: row count, checksum, origin, and the objects that hold
    it if the rows have their ``key``.

    The origin and the object are the same in all rows of a file, so they are part of the first
    grouping; texts are only compared between the files of a batch.
    """
    keyed = "key" in curated.columns
    parts = curated.groupBy(
        "phase3_batch_id", "source_filename", "source_raw_key", "pipeline_version", *["key"] * keyed
    ).agg(*digests.digest_parts(F.col("customer_id"), F.col("sales")))
    keys = F.array_sort(F.collect_set("key")).alias("curated_object_keys")
    raw_key = F.max("source_raw_key")
    return parts.groupBy("phase3_batch_id").agg(
        F.concat(F.lit("metadata/"), raw_key, F.lit(".json")).alias("source_manifest_key"),
        F.max("source_filename").alias("source_filename"),
        digests.merged_digest().alias("source_checksum"),
        F.sum("_rows").alias("records_written"),
        F.max("pipeline_version").alias("pipeline_version"),
        *[keys] * keyed,
    )
