"""Arrival job: raw files -> clean and rejected rows, one lineage manifest per file."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlake.functions import dates, text
from batchlake.operators import validate
from batchlake.plans.lake import Lake
from batchlake.session import exists, materialize, together
from batchlake.sinks import writers
from batchlake.sources.delimited import empty_files, read_raw
from batchlake.sources.listing import list_objects

PIPELINE_VERSION = "1.1.0"
MAX_ATTEMPTS = 24
ROUND = 1000  # files of a round

#: Folders of the arrival ledger and of the log of failures.
ARRIVALS, FAILURES = "checkpoints/arrivals", "failed_files"
#: Entries of the log, and the states it adds up to.
FAILED, RESOLVED, WAITING, GIVEN_UP = "FAILED", "RESOLVED", "WAITING", "GIVEN_UP"

_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def build_manifests(
    files: DataFrame,
    counts: DataFrame,
    processed_timestamp: str,
    duration_ms: float,
    pipeline_version: str = PIPELINE_VERSION,
    request_id: str | None = None,
    objects: DataFrame | None = None,
) -> DataFrame:
    """Manifest rows of the files, joined with their row counts; a file without rows counts 0.

    ``files`` has batch_id, raw_key and event_time (ISO text or anything else, then the run's
    time stands in). ``objects`` (batch_id, clean_object_keys, rejected_object_keys) are the files written; the
    first of each is the batch's clean or rejected key, and a batch that has none has no such key.
    """
    totals = ["total_records", "valid_records", "invalid_records"]
    key = F.col("raw_key")
    keys = ["clean_object_keys", "rejected_object_keys"]
    both = files.join(counts, "batch_id", "left")
    if objects is None:
        none = F.lit(None).cast("array<string>")
        both = both.withColumns(dict.fromkeys(keys, none))
    else:
        both = both.join(objects, "batch_id", "left")
    return both.select(
        F.lit("raw").alias("raw_bucket"),
        "raw_key",
        F.lit("clean").alias("clean_bucket"),
        F.get("clean_object_keys", 0).alias("clean_key"),
        F.lit("rejected").alias("rejected_bucket"),
        F.get("rejected_object_keys", 0).alias("rejected_key"),
        text.base_name(key).alias("source_filename"),
        dates.event_timestamp(F.col("event_time"), processed_timestamp).alias("event_timestamp"),
        F.lit(processed_timestamp).alias("phase1_processed_timestamp"),
        F.col("batch_id").alias("phase1_batch_id"),
        F.lit(pipeline_version).alias("phase1_pipeline_version"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in totals],
        F.lit(round(duration_ms, 1)).alias("execution_duration_ms"),
        *[F.coalesce(k, F.array().cast("array<string>")).alias(k) for k in keys],
        F.lit(request_id).cast("string").alias("lambda_request_id"),
    )


def manifest_key(raw_key: str, prefix: str = "metadata") -> str:
    """Where the manifest of a raw key lives."""
    return "/".join(p for p in [prefix.strip("/"), f"{raw_key}.json"] if p)


def manifest_key_of(raw_key: Column, prefix: str = "metadata") -> Column:
    """The same for a column of keys."""
    return F.concat_ws("/", F.lit(prefix.strip("/") or None), F.concat(raw_key, F.lit(".json")))


def arrivals(spark: SparkSession, lake: Lake, files: int) -> DataFrame:
    """Stream of new raw files by name, time and size, at most ``files`` at a time; their content is not
    read here."""
    return (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files)
        .load(lake.zone("raw"))
        .drop("content")
    )


def ingest(
    spark: SparkSession,
    lake: Lake,
    run_ts: str,
    paths: list[str] | None = None,
    header: list[str] | None = None,
    files: int = ROUND,
) -> DataFrame:
    """Validate what has arrived in the raw zone since the last run (or ``paths``) and return the
    manifests made.

    What has arrived is known from the checkpoint of a file stream (``ARRIVALS``), which the streaming
    job may share: each file is delivered once, ``files`` of them at a time, and again only if its
    round broke off. So a run without new files lists the zone and reads and writes nothing.
    Files without a byte are never delivered; the listing shows them.
    """
    if paths is not None:
        return ingest_files(spark, lake, run_ts, paths, header)
    made: list[DataFrame] = []

    def step(batch: DataFrame, _: int) -> None:
        names = sorted(r["path"] for r in batch.select("path").collect())  # at most ``files``
        if names:
            made.append(ingest_files(batch.sparkSession, lake, run_ts, names, header))

    (
        arrivals(spark, lake, files)
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", lake.zone(ARRIVALS))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    empty = empty_files(spark, [lake.zone("raw")], "*.csv", lake.zone("raw"))
    known = failures(spark, lake)
    if known is not None:
        empty = empty.join(known.select("raw_key"), "raw_key", "left_anti")
    _note(empty, lake, run_ts, FAILED)
    none = build_manifests(
        spark.createDataFrame([], "batch_id string, raw_key string, event_time string"),
        spark.createDataFrame([], "batch_id string, total_records bigint, valid_records bigint, invalid_records bigint"),
        run_ts,
        0.0,
    )
    return reduce(DataFrame.unionByName, made) if made else none


def _note(files: DataFrame, lake: Lake, run_ts: str, state: str, attempt: Column | None = None) -> None:
    """Append ``files(raw_key, reason)`` to the log of failures, if there are any."""
    rows = files.select(
        "raw_key",
        "reason",
        F.lit(run_ts).alias("failed_at"),
        (F.lit(1) if attempt is None else attempt).cast("int").alias("attempt"),
        F.lit(state).alias("state"),
    )
    rows = materialize(rows, "failed-files")
    if not rows.isEmpty():
        writers.append(rows, lake.zone(FAILURES))


def ingest_files(
    spark: SparkSession,
    lake: Lake,
    run_ts: str,
    paths: list[str],
    header: list[str] | None = None,
    tries: DataFrame | None = None,
) -> DataFrame:
    """Validate the named files and return their manifests.

    Row work happens once: parsed rows are written to the shared folder, tagged from there, and
    the tagged rows written again; clean, rejected and counts read that table. Manifests go last,
    so a file whose run broke off has none and is simply redone. Files that cannot be read are
    noted in the log of failures; ``tries(raw_key, attempts)`` says how often they failed before.
    """
    begun = time.monotonic()
    root = lake.zone("raw")
    raw, failed = read_raw(spark, root, paths, header)
    failed, rows = together(
        spark,
        lambda: materialize(failed, "unreadable-files"),
        lambda: materialize(raw.drop("raw_key"), "raw-rows"),
    )
    tagged = materialize(validate.tag_rows(rows), "tagged-rows")

    _, _, counts = together(
        spark,
        lambda: writers.write_delimited(validate.clean_rows(tagged), lake.zone("clean")),
        lambda: writers.write_delimited(validate.rejected_rows(tagged), lake.zone("rejected")),
        lambda: materialize(validate.batch_counts(tagged), "batch-counts"),
    )
    files = list_objects(spark, root, "", "*.csv", paths).select(
        F.col("key").alias("raw_key"),
        dates.file_batch_id(
            F.col("key"), F.unix_millis("last_modified"), F.col("size")
        ).alias("batch_id"),
        dates.iso_z(F.col("last_modified")).alias("event_time"),
    ).join(failed.select("raw_key"), "raw_key", "left_anti")
    objects = [_objects(spark, lake, zone, counts) for zone in ("clean", "rejected")]
    manifests = build_manifests(
        files,
        counts,
        run_ts,
        (time.monotonic() - begun) * 1000,
        objects=objects[0].join(objects[1], "batch_id", "full_outer"),
    )
    manifests = materialize(manifests, "manifests")
    writers.write_documents(manifests, lake.zone("metadata"), "phase1_batch_id")
    if tries is None:
        _note(failed, lake, run_ts, FAILED)
    else:
        before = F.coalesce("attempts", F.lit(0))
        _note(failed.join(tries, "raw_key", "left"), lake, run_ts, FAILED, before + 1)
        mended = tries.join(manifests.select("raw_key"), "raw_key", "left_semi")
        _note(mended.withColumn("reason", F.lit(None).cast("string")), lake, run_ts, RESOLVED, F.col("attempts"))
    return manifests


def _objects(spark: SparkSession, lake: Lake, zone: str, counts: DataFrame) -> DataFrame:
    """(batch_id, <zone>_object_keys): the files that now hold the rows of the batches in ``counts``, from a
    listing of their folders only."""
    rows = {"clean": "valid_records", "rejected": "invalid_records"}[zone]
    names = [r[0] for r in counts.where(F.col(rows) > 0).select("batch_id").collect()]  # of one round
    shape = f"batch_id string, {zone}_object_keys array<string>"
    if not names:
        return spark.createDataFrame([], shape)
    root = lake.zone(zone)
    listed = list_objects(spark, root, "", "*.csv", [f"{root}/batch_id={n}" for n in sorted(names)])
    batch = F.regexp_extract("key", r"(?:^|/)batch_id=([^/]+)/", 1).alias("batch_id")
    return listed.groupBy(batch).agg(F.array_sort(F.collect_list("key")).alias(f"{zone}_object_keys"))


def failures(spark: SparkSession, lake: Lake, max_attempts: int = MAX_ATTEMPTS) -> DataFrame | None:
    """Each file that ever failed: ``raw_key``, ``attempts``, ``reason`` of the last one and ``state``: WAITING to
    be tried again, GIVEN_UP after ``max_attempts``, or RESOLVED. None if no file has failed yet.

    The log only grows by rows, so a run that breaks off and is repeated says the same twice; the state is
    the log folded by file: the highest attempt counts, and whether it was resolved.
    """
    if not exists(spark, lake.zone(FAILURES)):
        return None
    log = spark.read.parquet(lake.zone(FAILURES))
    resolved = (F.col("state") == RESOLVED).cast("int")
    last = log.groupBy("raw_key").agg(F.max(F.col("attempt") * 2 + resolved).alias("_last"))
    last = last.select("raw_key", F.floor(F.col("_last") / 2).cast("bigint").alias("attempts"), (F.col("_last") % 2 == 1).alias("_done"))
    state = (
        F.when(F.col("_done"), RESOLVED).when(F.col("attempts") >= max_attempts, GIVEN_UP).otherwise(WAITING)
    )
    reasons = log.where(F.col("state") == FAILED).select("raw_key", F.col("attempt").cast("bigint").alias("attempts"), "reason")
    return (
        last.join(reasons.dropDuplicates(["raw_key", "attempts"]), ["raw_key", "attempts"], "left")
        .select("raw_key", "attempts", "reason", state.alias("state"))
    )


def redrive(spark: SparkSession, lake: Lake, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """(raw_key, attempts, reason) of failed files that may be tried again."""
    known = failures(spark, lake, max_attempts)
    if known is None:
        return spark.createDataFrame([], "raw_key string, attempts bigint, reason string")
    return known.where(F.col("state") == WAITING).drop("state")


def redrive_files(
    spark: SparkSession, lake: Lake, run_ts: str, max_attempts: int = MAX_ATTEMPTS, files: int = ROUND
) -> DataFrame:
    """Try the files again that wait for it, ``files`` at a time, and return the state of all failures.

    A file that can be read now gets its manifest and is resolved; any other has one more attempt, until
    it is given up. A file that is gone counts as a failed attempt.
    """
    waiting = materialize(redrive(spark, lake, max_attempts), "redriven-files")
    root, last = lake.zone("raw"), ""
    while True:
        # By name, so that each round takes the next ones; the driver holds one round of names.
        some = waiting.where(F.col("raw_key") > last).orderBy("raw_key").limit(files)
        keys = [r["raw_key"] for r in some.select("raw_key").collect()]
        if not keys:
            break
        last = keys[-1]
        there = [k for k in keys if exists(spark, f"{root}/{k}")]
        tries = waiting.where(F.col("raw_key").between(keys[0], last)).select("raw_key", "attempts")
        if there:
            ingest_files(spark, lake, run_ts, [f"{root}/{k}" for k in there], tries=tries)
        gone = tries.where(~F.col("raw_key").isin(there)) if there else tries
        _note(gone.withColumn("reason", F.lit("file is gone")), lake, run_ts, FAILED, F.col("attempts") + 1)
    known = failures(spark, lake, max_attempts)
    return known if known is not None else waiting.withColumn("state", F.lit(WAITING))
