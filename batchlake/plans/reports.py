"""Read-only reports over manifests, curated rows and the load audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlake.functions import text
from batchlake.functions.numbers import percent

PAGE_DEFAULT = 50
PAGE_MAX = 200

# Columns a manifest listing shows, in order; the search looks at their values.
LISTING = [
    "batch_id",
    "pipeline_version",
    "source_filename",
    "processed_timestamp",
    "total_records",
    "valid_records",
    "invalid_records",
    "execution_duration_ms",
    "raw_key",
    "clean_key",
    "rejected_key",
    "validation_status",
]


# ---- manifests -------------------------------------------------------------------------------


def _newest_first() -> list[Column]:
    return [F.desc_nulls_last("phase1_processed_timestamp"), F.asc("raw_key")]


def dashboard_totals(manifests: DataFrame) -> DataFrame:
    """Files, rows, valid and failed rows, and the success rate in percent (NULL without rows)."""
    totals = manifests.agg(
        F.count(F.lit(1)).alias("files_processed"),
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("records_processed"),
        F.coalesce(F.sum("valid_records"), F.lit(0)).alias("valid_records"),
        F.coalesce(F.sum("invalid_records"), F.lit(0)).alias("failed_records"),
    )
    rate = percent(F.col("valid_records"), F.col("records_processed"))
    return totals.withColumn("success_rate", F.bround(rate, 1))


def dashboard_daily(manifests: DataFrame) -> DataFrame:
    """Files, valid and invalid rows per processing day, ascending; undated batches left out."""
    day = F.substring("phase1_processed_timestamp", 1, 10)
    return (
        manifests.withColumn("date", day)
        .where("date != ''")
        .groupBy("date")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("valid_records"), F.lit(0)).alias("valid"),
            F.coalesce(F.sum("invalid_records"), F.lit(0)).alias("invalid"),
        )
        .orderBy("date")
    )


def latest_batch(manifests: DataFrame, n: int = 1) -> DataFrame:
    """The newest ``n`` manifests. A top-k: every partition keeps only its own best ``n``."""
    return manifests.orderBy(*_newest_first()).limit(n)


def pick_batch(manifests: DataFrame, batch_id: str | None = None) -> DataFrame:
    """The asked-for batch, else the newest one."""
    asked = F.coalesce(F.col("phase1_batch_id") == F.lit(batch_id), F.lit(False))
    return manifests.orderBy(F.desc(asked), *_newest_first()).limit(1)


def recent_batches(manifests: DataFrame, n: int = 15) -> DataFrame:
    return latest_batch(manifests, n).select(
        F.col("phase1_batch_id").alias("batch_id"),
        "source_filename",
        F.col("phase1_processed_timestamp").alias("processed_timestamp"),
        "total_records",
        "valid_records",
        "invalid_records",
        F.col("execution_duration_ms").alias("duration_ms"),
    )


def selectable_batches(manifests: DataFrame, n: int = 25) -> DataFrame:
    return recent_batches(manifests, n).select(
        "batch_id", "source_filename", "processed_timestamp"
    )


def manifest_listing(
    manifests: DataFrame, status: str | None = None, search: str | None = None
) -> DataFrame:
    """All manifests as listing rows, filtered by status and by a case-blind text search."""
    invalid = F.coalesce("invalid_records", F.lit(0))
    rows = manifests.select(
        F.col("phase1_batch_id").alias("batch_id"),
        F.col("phase1_pipeline_version").alias("pipeline_version"),
        "source_filename",
        F.col("phase1_processed_timestamp").alias("processed_timestamp"),
        "total_records",
        "valid_records",
        invalid.alias("invalid_records"),
        "execution_duration_ms",
        "raw_key",
        "clean_key",
        "rejected_key",
        F.when(invalid == 0, "CLEAN").otherwise("PARTIAL").alias("validation_status"),
    )
    if status:
        rows = rows.where(F.lower("validation_status") == status.strip().lower())
    if search:
        values = F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in LISTING]))
        rows = rows.where(F.contains(values, F.lit(search.strip().lower())))
    return rows


def manifest_page(
    manifests: DataFrame,
    status: str | None = None,
    search: str | None = None,
    limit: int = PAGE_DEFAULT,
    offset: int = 0,
) -> DataFrame:
    """One page of the listing, newest first, with the number of rows before paging as ``total``.

    Offset and limit run as one top-k, so no global sort happens.
    """
    rows = manifest_listing(manifests, status, search)
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        rows.orderBy(F.desc_nulls_last("processed_timestamp"), "raw_key")
        .offset(max(0, offset))
        .limit(max(1, min(PAGE_MAX, limit)))
        .withColumn("total", total)
    )


def processing_summary(manifests: DataFrame) -> DataFrame:
    """Batches, success rate, mean duration over batches that have one, newest run."""
    duration = F.when(F.col("execution_duration_ms") != 0, F.col("execution_duration_ms"))
    rate = percent(F.sum("valid_records"), F.sum("total_records"))
    return manifests.agg(
        F.count(F.lit(1)).alias("batches_processed"),
        F.bround(rate, 1).alias("success_rate"),
        F.bround(F.avg(duration), 1).alias("average_duration_ms"),
        F.max("phase1_processed_timestamp").alias("latest_run"),
    )


def lineage_counts(manifests: DataFrame, objects: DataFrame) -> DataFrame:
    """(stage, n, unit): rows or objects at each stage, NULL where a stage counts nothing."""
    rows = manifests.agg(
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("valid_records"), F.lit(0)).alias("valid"),
    )
    stored = objects.agg(
        F.count_if(F.col("zone") == "raw").alias("raw"),
        F.count_if(F.col("zone") == "curated").alias("curated"),
    )
    none = F.lit(None).cast("bigint")

    def unpivot(frame: DataFrame, stages: list[tuple[str, Column, str | None]]) -> DataFrame:
        entries = [
            F.struct(
                F.lit(stage).alias("stage"),
                n.cast("bigint").alias("n"),
                F.lit(unit).cast("string").alias("unit"),
            )
            for stage, n, unit in stages
        ]
        return frame.select(F.inline(F.array(*entries)))

    by_rows = unpivot(
        rows,
        [
            ("upload", F.col("total"), "records"),
            ("validation", F.col("total"), "records"),
            ("clean", F.col("valid"), "records"),
            ("etl", none, None),
            ("athena", none, None),
            ("portal", none, None),
        ],
    )
    by_objects = unpivot(
        stored,
        [("raw", F.col("raw"), "objects"), ("curated", F.col("curated"), "objects")],
    )
    return by_rows.unionByName(by_objects)


# ---- clean and curated rows ------------------------------------------------------------------


def clean_listing(clean: DataFrame) -> DataFrame:
    """Clean rows by customer. The row position splits a customer of many rows over sort ranges."""
    return clean.orderBy("customer_id", "batch_id", "ord").select(
        "customer_id", "name", "email", "sales"
    )


def clean_totals(clean: DataFrame) -> DataFrame:
    """Rows, total and mean sales of the clean rows, whose sales are numeric text."""
    amount = F.col("sales").try_cast("decimal(20,4)")
    return clean.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum(amount).alias("total_sales"),
        (F.sum(amount).cast("double") / F.count(amount)).alias("average_sales"),
    )


def analytics_summary(curated: DataFrame) -> DataFrame:
    """Rows, distinct customers, revenue and mean order."""
    per_customer = curated.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("sales").alias("k"), F.sum("sales").alias("s")
    )
    return per_customer.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.count("customer_id").alias("customers"),
        F.sum("s").alias("revenue"),
        F.try_divide(F.sum("s"), F.sum("k")).alias("average_order"),
    )


def by_category(curated: DataFrame) -> DataFrame:
    return (
        curated.groupBy("sales_category")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("sales").alias("revenue"))
        .orderBy(F.desc("revenue"), "sales_category")
    )


def by_day(curated: DataFrame) -> DataFrame:
    return (
        curated.groupBy("year", "month", "day")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("sales").alias("revenue"))
        .orderBy("year", "month", "day")
        .withColumn("day_label", text.day_label(F.col("year"), F.col("month"), F.col("day")))
    )


def top_customers(curated: DataFrame, n: int = 10) -> DataFrame:
    return (
        curated.groupBy("customer_id", "name")
        .agg(F.sum("sales").alias("revenue"))
        .orderBy(F.desc("revenue"), "customer_id", "name")
        .limit(n)
    )


def by_source(curated: DataFrame) -> DataFrame:
    return (
        curated.groupBy("source_filename")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("sales").alias("total_sales"),
            F.max("sales_category").alias("sample_category"),
        )
        .orderBy("source_filename")
    )


def in_partition(curated: DataFrame, year: str, month: str, day: str) -> DataFrame:
    """Rows of one day; on the partitioned table the other days' files are never opened."""
    return curated.where(
        (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day)
    )


def category_totals(curated: DataFrame) -> DataFrame:
    return (
        curated.groupBy("sales_category")
        .agg(F.count(F.lit(1)).alias("customer_count"), F.sum("sales").alias("category_sales"))
        .orderBy("sales_category")
    )


def top_sales(curated: DataFrame, n: int = 10) -> DataFrame:
    return (
        curated.orderBy(F.desc("sales"), "customer_id", "source_filename")
        .limit(n)
        .select(
            "customer_id",
            "name",
            "email",
            "sales",
            "sales_category",
            "source_filename",
            "ingestion_timestamp",
        )
    )


def layer_reconcile(manifests: DataFrame, tagged: DataFrame, sales: DataFrame) -> DataFrame:
    """Per batch: manifest valid rows = curated + quarantined, and rows in the serving fact.

    ``tagged`` carries ``phase1_batch_id`` and ``error_reason``.
    """
    said = manifests.select(
        F.col("phase1_batch_id").alias("batch_id"), F.col("valid_records").alias("valid")
    )
    made = tagged.groupBy(F.col("phase1_batch_id").alias("batch_id")).agg(
        F.count_if(F.col("error_reason").isNull()).alias("curated"),
        F.count_if(F.col("error_reason").isNotNull()).alias("quarantined"),
    )
    served = sales.groupBy("batch_id").agg(F.count(F.lit(1)).alias("served"))
    both = said.join(made, "batch_id", "full_outer").join(served, "batch_id", "full_outer")
    figures = ["valid", "curated", "quarantined", "served"]
    out = both.select("batch_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in figures])
    return out.withColumns(
        {
            "curation_matches": F.col("valid") == F.col("curated") + F.col("quarantined"),
            "not_served": F.col("curated") - F.col("served"),
        }
    )


# ---- load audit ------------------------------------------------------------------------------


def audit_recent(audit: DataFrame, n: int = 50) -> DataFrame:
    return (
        audit.orderBy(F.desc_nulls_last("start_time"), "batch_id")
        .limit(n)
        .select(
            "batch_id",
            "source_file",
            "status",
            "records_loaded",
            "records_updated",
            "records_failed",
            "duration_ms",
            "start_time",
            "end_time",
        )
    )


def audit_by_status(audit: DataFrame, status: str) -> DataFrame:
    """Batches in one status, latest end first. SKIPPED ones are in the attempts log."""
    return (
        audit.where(F.col("status") == status)
        .select("batch_id", "source_file", "records_failed", "end_time")
        .orderBy(F.desc_nulls_last("end_time"), "batch_id")
    )


def errors_of_batch(errors: DataFrame, batch_id: str) -> DataFrame:
    return (
        errors.where(F.col("batch_id") == batch_id)
        .select("customer_id", "error_message", "error_timestamp", "source_file")
        .orderBy("error_timestamp", "customer_id", "error_message")
    )


def load_summary(audit: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Totals of the batches started in the last ``hours`` before ``now``."""
    since = now - F.expr(f"INTERVAL {int(hours)} HOURS")
    return audit.where(F.col("start_time") >= since).agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("records_loaded").alias("total_loaded"),
        F.sum("records_updated").alias("total_updated"),
        F.sum("records_failed").alias("total_failed"),
        F.round(F.avg("duration_ms")).alias("avg_duration_ms"),
    )


def errors_by_source(errors: DataFrame, n: int = 20) -> DataFrame:
    return (
        errors.groupBy("source_file")
        .agg(F.count(F.lit(1)).alias("errors"))
        .orderBy(F.desc("errors"), "source_file")
        .limit(n)
    )
