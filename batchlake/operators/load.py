"""Rules and checks between a curated batch and the serving tables. All work on many batches at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlake.functions import dates, digests, numbers, text
from batchlake.operators.skew import HOT_ROWS, join_groups
from batchlake.schemas import STAGING_COLUMNS

# Per-row error messages, in rule order.
MISSING_ID = "missing customer_id"
DUPLICATE_ID = "duplicate customer_id within batch"
SALES_MISSING = "sales is missing"
SALES_NOT_NUMBER = "sales is not a valid number"
SALES_NOT_WHOLE = "sales must be a whole number"
SALES_NEGATIVE = "sales must be non-negative"


def sales_error(c: Column, whole: bool = False) -> Column:
    """Message for a sales value that cannot be loaded, NULL if it can. ``whole`` tells that the
    column is BIGINT already, which leaves two faults."""
    if whole:
        return F.when(c.isNull(), SALES_MISSING).when(c < 0, SALES_NEGATIVE)
    value = c.cast("string")
    number = numbers.parse_number(value)
    unreal = value.rlike(r"^\s*[+-]?(?i:nan|inf|infinity)\s*$")
    return (
        F.when(value.isNull() | (value == ""), SALES_MISSING)
        .when(unreal, SALES_NOT_WHOLE)
        .when(number.isNull(), SALES_NOT_NUMBER)
        .when(~numbers.is_whole(number), SALES_NOT_WHOLE)
        .when(number < 0, SALES_NEGATIVE)
    )


def tag_load(
    rows: DataFrame, batch: str = "batch_id", order: str = "ord", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``error_message`` (NULL for rows to stage) and strip ``customer_id``.

    Only an accepted row uses up its id: a bad row before it does not, and any row after it is a
    duplicate whatever its sales.
    """
    known = text.present(F.col("customer_id"))
    bad_sales = sales_error(F.col("sales"), _is_bigint(rows))
    stripped = rows.withColumn("customer_id", F.when(known, text.ustrip(F.col("customer_id"))))
    repeats = (
        stripped.where("customer_id IS NOT NULL")
        .groupBy(batch, "customer_id")
        .agg(
            F.min(F.when(bad_sales.isNull(), F.col(order))).alias("_accepted"),
            F.count(F.lit(1)).alias("_rows"),
        )
        .where("_rows > 1 AND _accepted IS NOT NULL")
    )
    joined = join_groups(
        stripped, repeats, [batch, "customer_id"], "_rows", F.col(order), hot_rows=hot_rows
    )
    message = (
        F.when(F.col("customer_id").isNull(), MISSING_ID)
        .when(F.col(order) > F.col("_accepted"), DUPLICATE_ID)
        .otherwise(bad_sales)
    )
    return joined.withColumn("error_message", message).select(*rows.columns, "error_message")


def _is_bigint(rows: DataFrame) -> bool:
    return rows.schema["sales"].dataType == T.LongType()


def staged_rows(tagged: DataFrame) -> DataFrame:
    """The 13 staging columns of the rows without an error."""
    sales = F.col("sales")
    if not _is_bigint(tagged):
        sales = numbers.parse_whole(sales.cast("string"))
    return (
        tagged.where("error_message IS NULL")
        .withColumn("sales", sales)
        .select(*[c for c in STAGING_COLUMNS])
    )


def load_errors(tagged: DataFrame, error_timestamp: Column, batch: str = "batch_id") -> DataFrame:
    return tagged.where("error_message IS NOT NULL").select(
        "customer_id",
        "error_message",
        F.coalesce("source_filename", F.lit("")).alias("source_file"),
        error_timestamp.alias("error_timestamp"),
        F.col(batch).alias("batch_id"),
    )


def skip_loaded(rows: DataFrame, audit: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Rows (or batches) whose batch has not been loaded successfully yet."""
    return rows.join(_loaded(audit, batch), batch, "left_anti")


def already_loaded(batches: DataFrame, audit: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Batches that a replay delivered again."""
    return batches.join(_loaded(audit, batch), batch, "left_semi")


def _loaded(audit: DataFrame, batch: str) -> DataFrame:
    return audit.where("status = 'SUCCESS'").select(F.col("batch_id").alias(batch)).distinct()


def single_batch_check(rows: DataFrame, unit: str, batch: str = "phase3_batch_id") -> DataFrame:
    """Per delivered unit (file or hand-off): number of distinct non-empty batch ids, and the fault.

    Two-step count: the distinct pairs are found map-side first, so a unit of any size costs one
    row per batch id it holds.
    """
    pairs = rows.groupBy(unit, batch).agg(F.count(F.lit(1)).alias("rows"))
    ids = F.count_if(F.coalesce(F.col(batch), F.lit("")) != "")
    return (
        pairs.groupBy(unit)
        .agg(ids.alias("batch_ids"), F.sum("rows").alias("records"))
        .withColumn(
            "error",
            F.when(F.col("batch_ids") == 0, "no batch id").when(
                F.col("batch_ids") > 1, "several batch ids"
            ),
        )
    )


def verify_handoff(manifests: DataFrame, curated: DataFrame) -> DataFrame:
    """Compare each hand-off row with the curated rows of its batch: they must carry that one
    batch id and have the checksum that was handed on. ``error`` is NULL for a sound batch; a
    hand-off of no rows is sound if there are none.

    Checksum and ids come from one grouping, which costs a row per id that a batch holds.
    """
    parts = curated.groupBy("phase3_batch_id", "phase1_batch_id").agg(
        *digests.digest_parts(F.col("customer_id"), F.col("sales"))
    )
    ids = F.count_if(F.coalesce("phase1_batch_id", F.lit("")) != "")
    found = parts.groupBy("phase3_batch_id").agg(
        F.sum("_rows").alias("found_records"),
        digests.merged_digest().alias("found_checksum"),
        ids.alias("batch_ids"),
    )
    both = manifests.join(found, "phase3_batch_id", "left")
    empty = F.col("source_checksum").isNull() & F.col("found_records").isNull()
    return both.withColumn(
        "error",
        F.when(empty, None)
        .when(F.col("found_records").isNull(), "batch rows missing")
        .when(F.col("batch_ids") == 0, "no batch id")
        .when(F.col("batch_ids") > 1, "several batch ids")
        .when(~F.col("source_checksum").eqNullSafe(F.col("found_checksum")), "checksum mismatch"),
    )


def pre_merge_checks(staged: DataFrame, expected: DataFrame) -> DataFrame:
    """Staged rows against the expected count, mandatory fields and unique keys, per batch.

    ``expected`` has batch_id and expected_rows. A batch with no staged rows and none expected
    passes. One grouping on (batch, key) yields the duplicate count and the totals together.
    """
    no_key = F.coalesce(F.col("customer_id"), F.lit("")) == ""
    per_key = staged.groupBy("batch_id", "customer_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(no_key).alias("no_key"),
        F.count_if(F.col("sales").isNull()).alias("no_sales"),
        F.count_if(F.col("sales") < 0).alias("negative"),
    )
    totals = per_key.groupBy("batch_id").agg(
        F.sum("n").alias("staged_rows"),
        F.sum("no_key").alias("missing_customer_id"),
        F.sum("no_sales").alias("missing_sales"),
        F.sum("negative").alias("negative_sales"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
    )
    counts = [
        "staged_rows",
        "missing_customer_id",
        "missing_sales",
        "negative_sales",
        "duplicate_keys",
    ]
    joined = expected.join(totals, "batch_id", "left").select(
        "batch_id", "expected_rows", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts]
    )
    ok = F.col("staged_rows") == F.col("expected_rows")
    for c in counts[1:]:
        ok = ok & (F.col(c) == 0)
    return joined.withColumn("passed", ok)


def missing_references(staged: DataFrame, customers: DataFrame) -> DataFrame:
    """Staged rows per batch whose customer is not in the serving table (run after the merge)."""
    ids = staged.groupBy("batch_id", "customer_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        ids.join(customers.select("customer_id"), "customer_id", "left_anti")
        .groupBy("batch_id")
        .agg(F.sum("n").alias("unreferenced_rows"))
    )


def post_merge_checks(staged: DataFrame, sales: DataFrame) -> DataFrame:
    """Rows, sales total and distinct customers per batch: staged against loaded."""

    def side(frame: DataFrame, amount: str, name: str) -> DataFrame:
        # One row per (batch, customer) first: the distinct count then needs no second copy.
        per_key = frame.groupBy("batch_id", "customer_id").agg(
            F.count(F.lit(1)).alias("n"), F.sum(amount).alias("amount")
        )
        return per_key.groupBy("batch_id").agg(
            F.sum("n").alias(f"{name}_rows"),
            F.coalesce(F.sum("amount"), F.lit(0)).alias(f"{name}_total"),
            F.count("customer_id").alias(f"{name}_customers"),
        )

    both = side(staged, "sales", "staged").join(
        side(sales, "sales_amount", "loaded"), "batch_id", "full_outer"
    )
    figures = [f"{s}_{f}" for s in ("staged", "loaded") for f in ("rows", "total", "customers")]
    out = both.select("batch_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in figures])
    ok = F.lit(True)
    for f in ("rows", "total", "customers"):
        ok = ok & (F.col(f"staged_{f}") == F.col(f"loaded_{f}"))
    return out.withColumn("passed", ok)


def merge_counts(staged: DataFrame, customers: DataFrame) -> DataFrame:
    """Rows each batch inserts and updates. Must be taken before the merge.

    Batches load in ascending batch order, so a customer new to the table is inserted by the first
    staged batch that has it and updated by every later one. Of ``customers`` only the key column
    is read (keys may repeat), and it is first cut down to the staged keys: where those are few,
    adaptive execution broadcasts them and the large table is scanned without a shuffle.
    """
    firsts = staged.groupBy("customer_id").agg(F.min("batch_seq").alias("batch_seq"))
    known = customers.select("customer_id").join(
        firsts.select("customer_id"), "customer_id", "left_semi"
    )
    new = (
        firsts.join(known, "customer_id", "left_anti")
        .groupBy("batch_seq")
        .agg(F.count(F.lit(1)).alias("inserted"))
    )
    totals = (
        staged.groupBy("batch_id", "batch_seq", "customer_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("batch_id", "batch_seq")
        .agg(F.count(F.lit(1)).alias("total"))
    )
    inserted = F.coalesce("inserted", F.lit(0))
    return totals.join(new, "batch_seq", "left").select(
        "batch_id", inserted.alias("inserted"), (F.col("total") - inserted).alias("updated")
    )


def customer_rows(staged: DataFrame, loaded_at: Column, *more: Column) -> DataFrame:
    """Staged rows in the shape of the customers table, stamped with the load time."""
    return staged.select(
        "customer_id",
        "name",
        "email",
        "sales",
        "sales_category",
        "batch_id",
        dates.parse_timestamp(F.col("processed_timestamp")).alias("processed_timestamp"),
        "source_filename",
        "pipeline_version",
        loaded_at.alias("created_at"),
        loaded_at.alias("updated_at"),
        *more,
    )


def sales_rows(staged: DataFrame, loaded_at: Column) -> DataFrame:
    """Staged rows in the shape of the per-batch sales fact."""
    return staged.select(
        "customer_id",
        F.col("sales").alias("sales_amount"),
        "sales_category",
        "source_filename",
        dates.parse_timestamp(F.col("ingestion_timestamp")).cast("date").alias("ingestion_date"),
        dates.parse_timestamp(F.col("processed_timestamp")).alias("processed_timestamp"),
        loaded_at.alias("loaded_at"),
        "batch_id",
    )
