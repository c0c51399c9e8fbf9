"""Row rules of the arrival step: tag every row, then split it clean or rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlake.functions import numbers, text
from batchlake.operators.skew import HOT_ROWS, join_groups
from batchlake.schemas import REQUIRED

# Reasons in rule order.
REASONS = [
    "missing_customer_id",
    "missing_name",
    "invalid_email",
    "non_numeric_sales",
    "repeated_customer_id",
]


def missing_columns(header: list[str]) -> list[str]:
    """Required columns the header lacks, sorted."""
    return sorted(set(REQUIRED) - set(header))


def missing_of(header: Column) -> Column:
    """The same for an array of names, as text."""
    lacks = F.array_except(F.array(*[F.lit(c) for c in REQUIRED]), header)
    return F.array_join(F.array_sort(lacks), ", ")


def repeated_ids(rows: DataFrame, batch: str = "batch_id", order: str = "ord") -> DataFrame:
    """Ids occurring more than once in a batch: first position and row count.

    Only two narrow columns and the position are shuffled, after map-side combining. Blank ids
    stay out: they are rejected anyway and would form one giant group.
    """
    return (
        rows.where(text.present(F.col("customer_id")))
        .groupBy(batch, "customer_id")
        .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > 1)
    )


def tag_rows(
    rows: DataFrame, batch: str = "batch_id", order: str = "ord", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``reject_reasons`` (array, empty when fine) and ``is_valid``.

    An id is used up by its first row in file order, valid or not. ``order`` must be unique and
    ascending within a batch.
    """
    known = text.present(F.col("customer_id"))
    joined = join_groups(
        rows,
        repeated_ids(rows, batch, order),
        [batch, "customer_id"],
        weight="_rows",
        salt=F.col(order),
        eligible=known,
        hot_rows=hot_rows,
    )
    rules = [
        known,
        text.present(F.col("name")),
        text.is_email(F.col("email")),
        numbers.is_number(F.col("sales")),
        F.coalesce(F.col(order) <= F.col("_first"), F.lit(True)),
    ]
    # Each rule is a column of its own first, so it is evaluated once for both results. The joined
    # text stands in for an array filter, which would fall out of generated code.
    names = [f"_rule{i}" for i in range(len(rules))]
    ruled = joined.withColumns(dict(zip(names, rules)))
    broken = F.concat_ws(",", *[F.when(~F.col(n), F.lit(r)) for n, r in zip(names, REASONS)])
    valid = F.lit(True)
    for n in names:
        valid = valid & F.col(n)
    return ruled.select(
        *rows.columns,
        F.when(valid, F.array().cast("array<string>"))
        .otherwise(F.split(broken, ","))
        .alias("reject_reasons"),
        valid.alias("is_valid"),
    )


def clean_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where("is_valid").drop("reject_reasons", "is_valid")


def rejected_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where("NOT is_valid").drop("is_valid")


def batch_counts(tagged: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Total, valid and invalid rows per batch."""
    return tagged.groupBy(batch).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("is_valid").alias("valid_records"),
        F.count_if(~F.col("is_valid")).alias("invalid_records"),
    )


def reason_counts(tagged: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Rejected rows per batch and reason; a row with two faults counts under both."""
    return (
        tagged.where("NOT is_valid")
        .select(batch, F.explode("reject_reasons").alias("reject_reason"))
        .groupBy(batch, "reject_reason")
        .agg(F.count(F.lit(1)).alias("records"))
    )
