"""Declarative integrity checks over related tables.

A suite is plain data: lists of keys, references, mandatory columns and predicates. Each check is one
aggregate (one scan per table for all NULL counts and predicates) and a job of its own, so a fault
in one leaves the others alone; nothing but the report leaves the executors.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from batchlake.operators.skew import join_groups

Tables = dict[str, DataFrame]

#: Checks that run at the same time.
AT_ONCE = 8
#: Rows whose keys one task counts, on average. Adaptive execution merges tasks by compressed bytes, and keys in
#: order compress to next to nothing, so the number of tasks is taken from the number of rows.
KEYS_PER_TASK = 500_000

REPORT = "section string, check_name string, status string, issue_count bigint, error string"


@dataclass(frozen=True)
class Suite:
    """What to check. Every entry becomes one row of the report."""

    primary_keys: list[tuple[str, str]] = field(default_factory=list)
    foreign_keys: list[tuple[str, str, str, str]] = field(default_factory=list)
    not_null: list[tuple[str, str]] = field(default_factory=list)
    predicates: dict[str, tuple[str, str]] = field(default_factory=dict)  # name: (table, SQL)
    custom: dict = field(default_factory=dict)  # name: function(tables) -> violating rows


# ---- single checks ---------------------------------------------------------------------------


def duplicate_keys(table: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once (a repeated NULL counts as one), with their row count.

    The rows are counted first, so ``table`` should be a stored one. A task holds a bounded number of keys, however
    many there are; the rows of a hot key pass through one task, which keeps a single count for them.
    """
    tasks = max(1, -(-table.count() // KEYS_PER_TASK))
    keys = table.select(key).repartition(tasks, key)
    return keys.groupBy(key).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def duplicate_sample(table: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The first ``n`` duplicate keys in key order."""
    return duplicate_keys(table, key).orderBy(key).limit(n)


def duplicate_samples(keys: list[tuple[str, str]], tables: Tables, n: int = 10) -> DataFrame:
    """(table_name, key_value, occurrences): the first ``n`` duplicate keys of each table, as text."""
    return _union(
        [
            duplicate_sample(tables[name], key, n).select(
                F.lit(name).alias("table_name"), F.col(key).cast("string").alias("key_value"), "occurrences"
            )
            for name, key in keys
        ]
    )


def _orphan_keys(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child keys without a parent and their row counts. Child rows are counted per key before the
    join, so the shuffle carries one row per distinct key and a hot key costs nothing extra."""
    per_key = (
        child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    )
    keys = parent.select(F.col(parent_column).alias(column))
    return per_key.join(keys, column, "left_anti")


def orphans(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, null_is_orphan: bool = False
) -> DataFrame:
    """Child rows whose key has no parent; rows with a NULL key too if asked for."""
    bad = _orphan_keys(child, column, parent, parent_column)
    rows = join_groups(
        child.where(F.col(column).isNotNull()),
        bad,
        [column],
        weight="_n",
        salt=F.xxhash64(*child.columns),
        how="inner",
    ).select(*child.columns)
    return rows.unionByName(child.where(F.col(column).isNull())) if null_is_orphan else rows


def orphan_count(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Number of orphaned rows."""
    return _orphan_keys(child, column, parent, parent_column).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("issue_count")
    )


def null_counts(table: DataFrame, columns: list[str], name: str = "") -> DataFrame:
    """(column_name, null_count) for all the columns in one pass."""
    prefix = f"{name}." if name else ""
    return _unpivot(
        table.agg(*[F.count_if(F.col(c).isNull()).alias(f"{prefix}{c}") for c in columns]),
        "column_name",
        "null_count",
    )


def table_counts(tables: Tables) -> DataFrame:
    """(table_name, row_count) of every table."""
    return _union(
        [
            t.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, t in tables.items()
        ]
    )


def table_checksum(table: DataFrame, key: str) -> DataFrame:
    """Row count, key sum, maximum and minimum, and the MD5 of the four joined by ``|``."""
    k = F.col(key).cast("bigint")
    figures = ["row_count", "id_sum", "max_id", "min_id"]
    text = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in figures]
    return table.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(k.cast("decimal(38,0)")).alias("id_sum"),
        F.max(k).alias("max_id"),
        F.min(k).alias("min_id"),
    ).withColumn("checksum", F.md5(F.concat_ws("|", *text).cast("binary")))


def table_checksums(keys: dict[str, str], tables: Tables) -> DataFrame:
    return _union(
        [
            table_checksum(tables[name], key).select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.col("id_sum").cast("string").alias("id_sum"),
                "max_id",
                "min_id",
                "checksum",
            )
            for name, key in keys.items()
        ]
    )


def date_ranges(columns: dict[str, str], tables: Tables) -> DataFrame:
    """(table_name, min_date, max_date, record_count) per table."""
    return _union(
        [
            tables[name]
            .agg(
                F.min(c).alias("min_date"),
                F.max(c).alias("max_date"),
                F.count(F.lit(1)).alias("record_count"),
            )
            .select(F.lit(name).alias("table_name"), "min_date", "max_date", "record_count")
            for name, c in columns.items()
        ]
    )


def counted(metrics: dict[str, dict[str, str]], tables: Tables) -> DataFrame:
    """(metric, value): rows meeting a condition; ``metrics`` is {table: {metric: SQL}}. One scan
    per table."""
    return _union(
        [
            _unpivot(
                tables[name].agg(*[F.count_if(F.expr(cond)).alias(m) for m, cond in per.items()]),
                "metric",
                "value",
            )
            for name, per in metrics.items()
        ]
    )


def summed(metrics: dict[str, tuple[str, dict[str, str]]], tables: Tables) -> DataFrame:
    """(metric, amount): exact DECIMAL(15,2) sums; ``metrics`` is {table: (condition, {metric:
    column})}."""
    parts = []
    for name, (cond, per) in metrics.items():
        rows = tables[name].where(cond) if cond else tables[name]
        totals = rows.agg(
            *[F.sum(F.col(c)).cast("decimal(15,2)").alias(m) for m, c in per.items()]
        )
        parts.append(_unpivot(totals, "metric", "amount"))
    return _union(parts)


def reconcile(
    parents: DataFrame,
    lines: DataFrame,
    key: str,
    stored: str,
    part: str,
    tolerance: float = 0.01,
) -> DataFrame:
    """Parents whose stored total differs from the sum of their lines (no lines sum to 0).

    Lines are summed per key before the join: map-side combining, one row per key shuffled on.
    """
    sums = lines.groupBy(key).agg(F.sum(part).alias("_sum"))
    out = parents.join(sums, key, "left").withColumn(
        "calculated_total", F.coalesce("_sum", F.lit(0))
    )
    return (
        out.withColumn("difference", F.col(stored) - F.col("calculated_total"))
        .where(F.abs("difference") > tolerance)
        .drop("_sum")
    )


# ---- whole suite -----------------------------------------------------------------------------


@dataclass(frozen=True)
class _Job:
    """Checks that share a job: their sections and names, and what makes the frame with the row (issue counts in the
    same order); ``alone`` makes the frame of one of them."""

    names: list[tuple[str, str]]
    frame: Callable[[], DataFrame]
    alone: Callable[[int], DataFrame] | None = None


def _outcome(spark: SparkSession, job: _Job) -> list[tuple]:
    """Report rows of a job, run under a job group of its own. If it fails, each of its checks is run
    alone, so that only the faulty ones are errors."""
    spark.sparkContext.setJobGroup("check " + ", ".join(f"{s}: {n}" for s, n in job.names[:3]), "integrity check")
    try:
        counts = job.frame().first()
    except Exception as fault:  # whatever stopped the job is this check's result
        if len(job.names) > 1:
            return [r for k, name in enumerate(job.names) for r in _outcome(spark, _Job([name], lambda k=k: job.alone(k)))]
        return [(*job.names[0], "ERROR", None, _message(fault))]
    return [(s, n, "FAIL" if count else "PASS", count, None) for (s, n), count in zip(job.names, counts, strict=True)]


def _message(fault: Exception) -> str:
    return str(fault).split("\n")[0] or type(fault).__name__


def run_suite(spark: SparkSession, suite: Suite, tables: Tables, at_once: int = AT_ONCE) -> DataFrame:
    """The report: one row per check with PASS, FAIL or ERROR and the number of faults.

    Checks are jobs of their own, ``at_once`` at a time; NULL counts and predicates of a table share one
    scan. A check that cannot be planned (missing table or column) or fails while it runs (a division
    by zero, an unreadable file) is an ERROR row; the others are not touched by it. A row per check
    comes to the driver.
    """
    jobs: list[_Job] = []
    rows: list[tuple] = []

    def attempt(section: str, name: str, build: Callable[[], DataFrame], then: Callable = lambda frame: frame) -> None:
        """``then`` is the part of the plan that runs jobs of its own; it belongs to the check's job."""
        try:
            frame = build()
            frame.schema  # forces analysis now, so a bad column surfaces here
            jobs.append(_Job([(section, name)], lambda: then(frame).select(F.col("issue_count").cast("bigint"))))
        except (AnalysisException, KeyError) as fault:
            rows.append((section, name, "ERROR", None, _message(fault)))

    def count(frame: DataFrame) -> DataFrame:
        return frame.agg(F.count(F.lit(1)).alias("issue_count"))

    for table, key in suite.primary_keys:
        attempt(
            "primary_keys",
            f"{table}.{key}",
            lambda: tables[table].select(key),
            lambda keys, key=key: count(duplicate_keys(keys, key)),
        )
    for child, column, parent, parent_column in suite.foreign_keys:
        attempt(
            "foreign_keys",
            f"{child}.{column} -> {parent}.{parent_column}",
            lambda: orphan_count(tables[child], column, tables[parent], parent_column),
        )

    flags: dict[str, list[tuple[str, str, str]]] = {}
    for table, column in suite.not_null:
        flags.setdefault(table, []).append(("null_constraints", f"{table}.{column}", f"`{column}` IS NULL"))
    for name, (table, condition) in suite.predicates.items():
        flags.setdefault(table, []).append(("data_consistency", name, condition))
    for table, checks in flags.items():
        good = []
        for section, name, condition in checks:
            try:
                tables[table].where(condition).schema
                good.append((section, name, condition))
            except (AnalysisException, KeyError) as fault:
                rows.append((section, name, "ERROR", None, _message(fault)))

        def counted(some: list[tuple[str, str, str]], table: str = table) -> DataFrame:
            return tables[table].agg(*[F.count_if(F.expr(c)).alias(f"c{i}") for i, (_, _, c) in enumerate(some)])

        if good:
            alone = lambda k, good=good, counted=counted: counted([good[k]])
            jobs.append(_Job([(s, n) for s, n, _ in good], lambda good=good, counted=counted: counted(good), alone))
    for name, violations in suite.custom.items():
        attempt("data_consistency", name, lambda: count(violations(tables)))

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        run = inheritable_thread_target(spark)(lambda job: _outcome(spark, job))
        for found in pool.map(run, jobs):
            rows += found
    return spark.createDataFrame(rows, REPORT)


def summarize(report: DataFrame) -> DataFrame:
    """One row: overall status and the number of checks by outcome."""
    bad = F.count_if(F.col("status") != "PASS")
    return report.agg(
        F.when(bad == 0, "PASS").otherwise("FAIL").alias("overall_status"),
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("status") == "PASS").alias("passed_checks"),
        F.count_if(F.col("status") == "FAIL").alias("failed_checks"),
        F.count_if(F.col("status") == "ERROR").alias("errors"),
    )


def report_document(
    report: DataFrame, facts: dict[str, DataFrame], run_id: str, run_ts: str
) -> DataFrame:
    """The whole run as one row: status, counts, checks by section, and further result tables
    (row counts, checksums). Its size is that of the suite, not of the data."""
    entry = F.struct("check_name", "status", "issue_count", "error")
    sections = (
        report.groupBy("section")
        .agg(F.array_sort(F.collect_list(entry)).alias("checks"))
        .agg(F.map_from_entries(F.collect_list(F.struct("section", "checks"))).alias("results"))
    )
    document = summarize(report).select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_ts).alias("validation_timestamp"),
        "overall_status",
        F.struct("total_checks", "passed_checks", "failed_checks", "errors").alias("summary"),
        sections.scalar().alias("results"),
    )
    for name, rows in facts.items():
        listed = rows.agg(F.array_sort(F.collect_list(F.struct(*rows.columns))))
        document = document.withColumn(name, listed.scalar())
    return document


def summary_metrics(summary: DataFrame) -> DataFrame:
    """The four published figures: status as 1/0 and total, passed and failed checks."""
    return _unpivot(
        summary.select(
            F.when(F.col("overall_status") == "PASS", 1).otherwise(0).cast("bigint").alias("ValidationStatus"),
            F.col("total_checks").alias("TotalChecks"),
            F.col("passed_checks").alias("PassedChecks"),
            F.col("failed_checks").alias("FailedChecks"),
        ),
        "metric",
        "value",
    )


def _unpivot(one_row: DataFrame, name: str, value: str) -> DataFrame:
    entries = F.array(
        *[
            F.struct(F.lit(c).alias(name), F.col(f"`{c}`").alias(value))
            for c in one_row.columns
        ]
    )
    return one_row.select(F.inline(entries))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
