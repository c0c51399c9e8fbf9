"""Writers. Each overwrites exactly the partitions of the batches it is given, so a replay of a
batch replaces it instead of doubling it.

Where order matters, rows are dealt out by ranges of (batch, place). Other partitioned writes go
through a REBALANCE on the partition columns: adaptive execution merges the small partitions into few
files and splits a partition that holds too many rows over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlake.schemas import PARTITIONS, REQUIRED

MAX_ROWS_PER_FILE = 5_000_000
MAX_ROWS_PER_TEXT_FILE = 1_000_000  # delimited files with quoted line breaks cannot be split


def _partitioned(frame: DataFrame, by: list[str]):
    return (
        frame.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .partitionBy(*by)
    )


def deal(frame: DataFrame, batch: str, order: str) -> DataFrame:
    """The rows dealt out by ranges of (batch, order). The rows are read twice for it, so what is costly to compute
    from them is better computed after this step."""
    return frame.repartitionByRange(batch, order)


def _ordered(frame: DataFrame, by: list[str], batch: str, order: str, dealt: bool = False):
    """As ``_partitioned``, with the rows of a batch in their order: ranges of (batch, order) go to
    the tasks in turn, so a batch's files, by name, continue each other. A large batch is
    several ranges. ``dealt`` tells that the rows lie in such ranges already."""
    rest = [c for c in by if c != batch]
    return (
        (frame if dealt else deal(frame, batch, order))
        .sortWithinPartitions(*by, order)
        .select(*[c for c in frame.columns if c not in (order, *by)], *rest, batch)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .partitionBy(*by)
    )


def write_delimited(rows: DataFrame, path: str) -> None:
    """Clean or rejected rows of many batches in file order (``ord``): one folder per batch, with
    a header."""
    (
        _ordered(rows.select(*REQUIRED, "batch_id", "ord"), ["batch_id"], "batch_id", "ord")
        .option("maxRecordsPerFile", MAX_ROWS_PER_TEXT_FILE)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_documents(rows: DataFrame, path: str, batch: str) -> None:
    """One JSON document per batch, keys sorted, NULLs left out, below ``<path>/batch=...``."""
    body = rows.select(*sorted(rows.columns), F.col(batch).alias("batch"))
    _partitioned(body, ["batch"]).json(path)


def write_curated(curated: DataFrame, path: str, dealt: bool = False) -> None:
    """Snappy Parquet by year, month and day, in the order ``ord`` of each batch if there is one; ``dealt`` tells that
    the rows come from ``deal``.

    The batch is a further folder level, which makes a batch replaceable on its own. Readers that
    filter on year, month and day prune as usual.
    """
    by = [*PARTITIONS, "phase3_batch_id"]
    ordered = "ord" in curated.columns
    write = _ordered(curated, by, "phase3_batch_id", "ord", dealt) if ordered else _partitioned(curated, by)
    write.option("compression", "snappy").parquet(path)


def write_quarantine(quarantined: DataFrame, path: str) -> None:
    """JSON by reason, year, month, day and batch. Writing no rows writes no files."""
    by = ["reason", *PARTITIONS, "phase3_batch_id"]
    _partitioned(quarantined, by).json(path)


def write_batches(rows: DataFrame, path: str, batch: str = "batch_id") -> None:
    """Parquet with one folder per batch."""
    _partitioned(rows, [batch]).parquet(path)


def write_report(document: DataFrame, path: str) -> None:
    """A check report, as ``report_document`` makes it, as one JSON file below ``run_id=...``."""
    body = document.select("*", F.col("run_id").alias("run"))
    _partitioned(body, ["run"]).json(path)


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
