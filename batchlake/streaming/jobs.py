"""The jobs as streaming queries. Checkpoints hold what was delivered; every sink replaces a batch
by its id, so a replayed micro-batch changes nothing."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from batchlake.plans import curation, ingest, loading, monitor
from batchlake.plans.lake import Lake
from batchlake.schemas import MANIFEST, SERVING_BATCH
from batchlake.sources.listing import decoded_path, key_below

FILES_PER_TRIGGER = 5
INTERVAL = "15 seconds"
WATERMARK = "10 minutes"


def utc_now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def _start(frame: DataFrame, action, checkpoint: str, once: bool) -> StreamingQuery:
    writer = frame.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": INTERVAL}
    return writer.trigger(**trigger).start()


def ingest_stream(
    spark: SparkSession,
    lake: Lake,
    checkpoint: str | None = None,
    once: bool = False,
    files: int = FILES_PER_TRIGGER,
) -> StreamingQuery:
    """Validate files as they arrive. Without a checkpoint of its own the stream shares the ledger of the
    batch job: what either has taken, the other does not meet."""

    def step(batch: DataFrame, _: int) -> None:
        # At most ``files`` names.
        paths = sorted(r["path"] for r in batch.select("path").collect())
        if paths:
            ingest.ingest_files(batch.sparkSession, lake, utc_now(), paths)

    return _start(ingest.arrivals(spark, lake, files), step, checkpoint or lake.zone(ingest.ARRIVALS), once)


def curate_stream(
    spark: SparkSession,
    lake: Lake,
    checkpoint: str,
    once: bool = False,
    files: int = FILES_PER_TRIGGER,
    max_invalid_percent: float = curation.op.MAX_INVALID_PERCENT,
) -> StreamingQuery:
    """Curate validated batches as their manifests appear."""
    manifests = (
        spark.readStream.schema(MANIFEST)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .option("maxFilesPerTrigger", files)
        .json(lake.zone("metadata"))
        .select("*", key_below(decoded_path(F.col("_metadata.file_path")), lake.zone("metadata")).alias("manifest_key"))
    )

    def step(batch: DataFrame, _: int) -> None:
        curation.curate(
            batch.sparkSession,
            lake,
            utc_now(),
            max_invalid_percent=max_invalid_percent,
            manifests=batch,
        )

    return _start(manifests, step, checkpoint, once)


def load_stream(
    spark: SparkSession, lake: Lake, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Load batches as they are handed on, one micro-batch at a time."""
    handoffs = spark.readStream.schema(SERVING_BATCH).parquet(lake.zone("serving_batches"))

    def step(batch: DataFrame, _: int) -> None:
        loading.load(batch.sparkSession, lake, utc_now(), batch)

    return _start(handoffs, step, checkpoint, once)


def to_files(frame: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append a stream's final rows as Parquet."""
    trigger = {"availableNow": True} if once else {"processingTime": INTERVAL}
    return (
        frame.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def hourly_stream(metrics: DataFrame, path: str, checkpoint: str, once: bool = False):
    """Hourly figures per function; an hour is written once the watermark has passed it."""
    return to_files(monitor.hourly_metrics(metrics, watermark=WATERMARK), path, checkpoint, once)


def quarantine_stream(metrics: DataFrame, path: str, checkpoint: str, once: bool = False):
    return to_files(monitor.quarantine_rate(metrics, watermark=WATERMARK), path, checkpoint, once)


def alarm_stream(
    metrics: DataFrame, rules: DataFrame, path: str, checkpoint: str, once: bool = False
):
    return to_files(
        monitor.threshold_alarms(metrics, rules, watermark=WATERMARK), path, checkpoint, once
    )


def alert_stream(events: DataFrame, path: str, checkpoint: str, once: bool = False):
    """Failed runs and queries, as they happen."""
    return to_files(monitor.run_alerts(events), path, checkpoint, once)


def log_metric_stream(lines: DataFrame, path: str, checkpoint: str, once: bool = False):
    return to_files(monitor.log_metrics(monitor.parse_logs(lines)), path, checkpoint, once)
