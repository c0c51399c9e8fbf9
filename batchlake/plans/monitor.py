"""Operational metrics, alarms and run states. Every function takes a batch or a streaming frame
unless its text says otherwise; the windows are plain event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlake.operators.asof import first_at_or_after

# Alarm rules on 300 s windows (name, metric, statistic, comparison, threshold).
ALARM_RULES = [
    ("function-errors", "Errors", "Sum", ">=", 1.0),
    ("function-throttles", "Throttles", "Sum", ">=", 1.0),
    ("failed-invocations", "FailedInvocations", "Sum", ">=", 1.0),
    ("dead-letters", "QueueDepth", "Maximum", ">=", 1.0),
    ("loader-duration", "Duration", "Maximum", ">", 60000.0),
    ("failed-records", "RecordsFailed", "Sum", ">", 10.0),
]
ALARM_PERIOD = "300 seconds"
MAX_QUARANTINE_PERCENT = 10.0

RUN_FAULTS = ["FAILED", "TIMEOUT", "STOPPED"]
QUERY_FAULTS = ["FAILED", "CANCELLED"]


def _windowed(frame: DataFrame, ts: str, width: str, watermark: str | None) -> DataFrame:
    out = frame.withWatermark(ts, watermark) if watermark else frame
    return out.withColumn("window", F.window(ts, width))


def hourly_metrics(
    metrics: DataFrame, dimension: str = "function_name", watermark: str | None = None
) -> DataFrame:
    """Invocations, errors and mean duration per hour and function.

    ``metrics`` has ts, metric, value and the dimension column.
    """
    v = F.col("value")

    def of(name: str) -> Column:
        return F.when(F.col("metric") == name, v)

    return (
        _windowed(metrics, "ts", "1 hour", watermark)
        .groupBy("window", dimension)
        .agg(
            F.coalesce(F.sum(of("Invocations")), F.lit(0.0)).alias("invocations"),
            F.coalesce(F.sum(of("Errors")), F.lit(0.0)).alias("errors"),
            F.avg(of("Duration")).alias("average_duration"),
        )
        .select(
            F.col("window.start").alias("hour"),
            dimension,
            "invocations",
            "errors",
            "average_duration",
        )
    )


def last_days(metrics: DataFrame, now: Column, days: int = 7) -> DataFrame:
    return metrics.where(
        (F.col("ts") >= now - F.expr(f"INTERVAL {int(days)} DAYS")) & (F.col("ts") < now)
    )


def error_rate(metrics: DataFrame) -> DataFrame:
    """Invocations, errors and errors per hundred invocations, NULL without invocations."""
    v = F.col("value")
    totals = metrics.agg(
        F.coalesce(F.sum(F.when(F.col("metric") == "Invocations", v)), F.lit(0.0)).alias(
            "invocations"
        ),
        F.coalesce(F.sum(F.when(F.col("metric") == "Errors", v)), F.lit(0.0)).alias("errors"),
    )
    rate = F.try_divide(F.col("errors"), F.col("invocations")) * 100
    return totals.withColumn("error_rate", F.bround(rate, 2))


def quarantine_rate(
    metrics: DataFrame,
    max_percent: float = MAX_QUARANTINE_PERCENT,
    width: str = ALARM_PERIOD,
    watermark: str | None = None,
) -> DataFrame:
    """Quarantined per hundred rows read, per window, environment and job; 0 when none were read."""
    v = F.col("value")
    totals = (
        _windowed(metrics.where("metric IN ('RowsRead', 'RowsQuarantined')"), "ts", width, watermark)
        .groupBy("window", "environment", "job_name")
        .agg(
            F.coalesce(F.sum(F.when(F.col("metric") == "RowsRead", v)), F.lit(0.0)).alias(
                "rows_read"
            ),
            F.coalesce(F.sum(F.when(F.col("metric") == "RowsQuarantined", v)), F.lit(0.0)).alias(
                "rows_quarantined"
            ),
        )
    )
    rate = F.when(
        F.col("rows_read") > 0, F.col("rows_quarantined") * 100 / F.col("rows_read")
    ).otherwise(0.0)
    return totals.select(
        F.col("window.start").alias("window_start"),
        "environment",
        "job_name",
        "rows_read",
        "rows_quarantined",
        rate.alias("quarantine_rate"),
        F.when(rate > max_percent, "ALARM").otherwise("OK").alias("state"),
    )


def alarm_rules(spark: SparkSession, rules: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(
        ALARM_RULES if rules is None else rules,
        "alarm string, metric string, statistic string, comparison string, threshold double",
    )


def threshold_alarms(
    metrics: DataFrame,
    rules: DataFrame,
    dimension: str = "function_name",
    width: str = ALARM_PERIOD,
    watermark: str | None = None,
) -> DataFrame:
    """State of every rule in every window and dimension that has data; no data means no row: OK.

    ``rules`` is the hand-written rule table (a few rows), so it is broadcast.
    """
    stats = (
        _windowed(metrics, "ts", width, watermark)
        .groupBy("window", "metric", dimension)
        .agg(F.sum("value").alias("total"), F.max("value").alias("peak"))
    )
    seen = F.when(F.col("statistic") == "Sum", F.col("total")).otherwise(F.col("peak"))
    breached = F.when(F.col("comparison") == ">=", seen >= F.col("threshold")).otherwise(
        seen > F.col("threshold")
    )
    return stats.join(F.broadcast(rules), "metric").select(
        F.col("window.start").alias("window_start"),
        "alarm",
        "metric",
        dimension,
        seen.alias("observed"),
        "threshold",
        F.when(breached, "ALARM").otherwise("OK").alias("state"),
    )


def alarm_states(alarms: DataFrame, dimension: str = "function_name") -> DataFrame:
    """Latest state of each alarm: alarms first, then by name. Batch only."""
    latest = alarms.groupBy("alarm", dimension).agg(
        F.max("window_start").alias("updated"),
        F.max_by("state", "window_start").alias("state"),
    )
    return latest.orderBy(F.col("state") != "ALARM", "alarm", dimension)


def parse_logs(lines: DataFrame, column: str = "value") -> DataFrame:
    """Structured log lines as columns; a line that is no JSON object has only NULLs."""
    schema = (
        "timestamp string, pipeline string, stage string, status string, batch_id string, "
        "source_file string, error string, message string, records_inserted bigint, "
        "records_updated bigint, records_failed bigint, retry_count bigint"
    )
    return lines.select("*", F.from_json(column, schema).alias("log")).select(
        *[c for c in lines.columns if c != column], "log.*"
    )


def log_line(fields: dict[str, Column], run_ts: Column, pipeline: str, stage: str) -> Column:
    """One JSON log line with sorted keys."""
    named = {
        "timestamp": run_ts,
        "pipeline": F.lit(pipeline),
        "stage": F.lit(stage),
        **fields,
    }
    return F.to_json(F.struct(*[named[k].alias(k) for k in sorted(named)]))


def log_metrics(logs: DataFrame) -> DataFrame:
    """Metrics of parsed log lines: record counts of loads that succeeded, one per skipped batch,
    retries where a line names them."""
    ok = F.col("status") == "SUCCESS"
    entries = [
        ("RecordsInserted", F.when(ok, F.col("records_inserted"))),
        ("RecordsFailed", F.when(ok, F.col("records_failed"))),
        ("RecordsUpdated", F.when(ok, F.col("records_updated"))),
        ("SkippedBatches", F.when(F.col("status") == "SKIPPED", F.lit(1))),
        ("RetryCount", F.col("retry_count")),
    ]
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), v.cast("double").alias("value"))
            for name, v in entries
        ]
    )
    return logs.select(
        F.try_to_timestamp("timestamp").alias("ts"),
        F.col("stage").alias("environment"),
        F.inline(F.filter(pairs, lambda p: p["value"].isNotNull())),
    )


def recent_logs(logs: DataFrame, n: int = 100) -> DataFrame:
    """The last ``n`` log lines, newest first. Batch only."""
    keys = [F.desc("timestamp")] + [F.asc(c) for c in logs.columns if c != "timestamp"]
    return logs.orderBy(*keys).limit(n)


def run_alerts(events: DataFrame) -> DataFrame:
    """State changes that need attention. ``events`` has source ('job' or 'query') and state."""
    fault = (
        (F.col("source") == "job") & F.col("state").isin(RUN_FAULTS)
    ) | ((F.col("source") == "query") & F.col("state").isin(QUERY_FAULTS))
    return events.where(fault)


def pipeline_metrics(stats: DataFrame, ts: Column, environment: str, job_name: str) -> DataFrame:
    """RowsRead, RowsWritten and RowsQuarantined of a run as metric rows."""
    names = {
        "RowsRead": "rows_read",
        "RowsWritten": "rows_written",
        "RowsQuarantined": "rows_quarantined",
    }
    entries = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value"))
            for m, c in names.items()
        ]
    )
    return stats.select(
        ts.alias("ts"),
        F.lit(environment).alias("environment"),
        F.lit(job_name).alias("job_name"),
        F.inline(entries),
    ).select("ts", "metric", "environment", "job_name", "value")


def run_attribution(
    batches: DataFrame, runs: DataFrame, slack_seconds: int = 30, by: str = "job_name"
) -> DataFrame:
    """The run each batch belongs to: the first one started no earlier than ``slack_seconds``
    before it. ``batches`` has batch_ts, ``runs`` has started, run_id and state; both have ``by``.
    Batch only."""
    return first_at_or_after(
        batches,
        runs,
        by,
        "batch_ts",
        "started",
        ["started", "run_id", "state"],
        slack_ms=slack_seconds * 1000,
    )


def batch_progress(arrivals: DataFrame, manifests: DataFrame, attributed: DataFrame) -> DataFrame:
    """State per arrived file: PROCESSING until its manifest exists, then COMPLETE; and the state
    of the downstream step, from the run attributed to the batch. Batch only."""
    done = manifests.select(
        "raw_key", F.col("phase1_batch_id").alias("batch_id"), "valid_records", "invalid_records"
    )
    runs = attributed.select("batch_id", F.col("state").alias("run_state"))
    state = F.when(F.col("batch_id").isNull(), "PROCESSING").otherwise("COMPLETE")
    downstream = (
        F.when(F.col("batch_id").isNull() | F.col("run_state").isNull(), "pending")
        .when(F.col("run_state").isin("RUNNING", "STARTING"), "active")
        .when(F.col("run_state") == "SUCCEEDED", "done")
        .when(F.col("run_state").isin(RUN_FAULTS), "failed")
        .otherwise("pending")
    )
    return (
        arrivals.join(done, "raw_key", "left")
        .join(runs, "batch_id", "left")
        .select(
            "raw_key",
            "batch_id",
            state.alias("state"),
            downstream.alias("downstream"),
            "valid_records",
            "invalid_records",
        )
    )
