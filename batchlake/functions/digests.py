"""Checksums of a batch: row count, xor and sum of row hashes.

The three merge in any order, so a batch of any size is summed map-side in one pass, and neither
the order of its rows nor how they are partitioned matters. One rule holds for every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(*cols: Column) -> Column:
    """60-bit hash of the row's text, as BIGINT."""
    text = F.concat_ws(":", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def digest_parts(id_col: Column, sales_col: Column) -> list[Column]:
    """Aggregates of one group of rows, to be merged by ``merged_digest``."""
    h = row_hash(id_col, sales_col)
    return [
        F.count(F.lit(1)).alias("_rows"),
        F.bit_xor(h).alias("_xor"),
        F.sum(h.cast("decimal(38,0)")).alias("_sum"),
    ]


def merged_digest() -> Column:
    """Aggregate over ``digest_parts``: ``rows-xor-sum``."""
    zero = F.lit(0)
    return F.concat_ws(
        "-",
        F.coalesce(F.sum("_rows"), zero).cast("string"),
        F.coalesce(F.bit_xor("_xor"), zero).cast("string"),
        F.coalesce(F.sum("_sum").cast("decimal(38,0)"), zero).cast("string"),
    )


def batch_digests(
    rows: DataFrame, batch: str = "batch_id", id_col: str = "customer_id", sales_col: str = "sales"
) -> DataFrame:
    """One row per batch: ``records`` and ``source_checksum``."""
    parts = rows.groupBy(batch).agg(*digest_parts(F.col(id_col), F.col(sales_col)))
    return parts.groupBy(batch).agg(
        F.sum("_rows").alias("records"), merged_digest().alias("source_checksum")
    )
