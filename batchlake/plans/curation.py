"""Curation job: clean batches -> curated and quarantined rows, metrics, gate, hand-off."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlake.operators import curate as op
from batchlake.plans.lake import Lake
from batchlake.plans.monitor import pipeline_metrics
from batchlake.schemas import SERVING_BATCH
from batchlake.session import exists, materialize, together
from batchlake.sinks import writers
from batchlake.sources.delimited import read_clean
from batchlake.sources.listing import decoded_path, key_below
from batchlake.sources.manifests import below_prefix, read_manifests
from batchlake.sources.tables import read_batches, with_file


class QualityGateError(RuntimeError):
    """Too large a share of the run's rows was quarantined. Outputs are written, nothing is
    handed on."""


#: Batches curated at a time. All pending ones are, in rounds of this many; each round names its
#: folders to the scan, so nothing of other batches is read.
ROUND = 1_000


def pending(
    spark: SparkSession,
    lake: Lake,
    prefix: str = "",
    manifests: DataFrame | None = None,
    max_invalid_percent: float = op.MAX_INVALID_PERCENT,
) -> DataFrame:
    """Manifests (all, or of ``manifests``) without a hand-off row yet. A parked batch is left out
    until the limit is above the one it was parked at."""
    if manifests is None:
        manifests = read_manifests(spark, lake.zone("metadata"))
    manifests = below_prefix(manifests, prefix)
    done = lake.zone("serving_batches")
    if exists(spark, done):
        handed = spark.read.parquet(done).select(F.col("phase3_batch_id").alias("phase1_batch_id"))
        manifests = manifests.join(handed, "phase1_batch_id", "left_anti")
    parked = lake.zone("parked_batches")
    if exists(spark, parked):
        held = spark.read.schema(_PARKED).parquet(parked).groupBy("batch_id").agg(F.max("max_invalid_percent").alias("at"))
        held = held.where(F.col("at") >= max_invalid_percent)
        manifests = manifests.join(
            held.select(F.col("batch_id").alias("phase1_batch_id")), "phase1_batch_id", "left_anti"
        )
    return manifests


_PARKED = (
    "batch_id string, rows_read bigint, rows_written bigint, rows_quarantined bigint, "
    "max_invalid_percent double, run_ts string"
)


def curate(
    spark: SparkSession,
    lake: Lake,
    run_ts: str,
    prefix: str = "",
    date_column: str | None = None,
    max_invalid_percent: float = op.MAX_INVALID_PERCENT,
    environment: str = "dev",
    job_name: str = "curate",
    manifests: DataFrame | None = None,
    gate: str = "run",
) -> dict[str, int]:
    """Curate every batch (or those of ``manifests``) not handed on yet; returns rows read, written
    and quarantined.

    Each batch replaces its own partitions. After outputs and metrics are written, the gate decides:
    with ``gate="run"`` all batches are handed on or, if the run's share of quarantined rows is too
    high, none and an error is raised. With ``gate="batch"`` each batch is judged by itself; those
    that fail go to ``parked_batches`` and hold up no other. A batch without curated rows is handed
    on with no rows, so it is not met again.
    """
    manifests = materialize(
        pending(spark, lake, prefix, manifests, max_invalid_percent), "pending"
    )
    totals = {"rows_read": 0, "rows_written": 0, "rows_quarantined": 0}
    handed, parked, after = [], [], ""
    while True:
        page = manifests.where(F.col("phase1_batch_id") > after).orderBy("phase1_batch_id")
        found = page.select("phase1_batch_id", "valid_records").limit(ROUND).collect()
        if not found:
            break
        after = found[-1][0]
        names = [r[0] for r in found]
        mine = manifests.where(F.col("phase1_batch_id").isin(names))
        filled = [r[0] for r in found if r[1]]
        stats = _curate_round(spark, lake, mine, filled, run_ts, date_column)
        judged = op.quality_gate(stats, max_invalid_percent)
        sums = judged.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in totals]).first()
        totals = {k: totals[k] + sums[k] for k in totals}
        if gate == "batch":
            parked.append(judged.where("NOT passed").drop("passed"))
        handed.append(materialize(handoff(spark, lake, mine, names), "handoff"))
    if not handed:
        return totals
    run = spark.createDataFrame([tuple(totals.values())], ", ".join(f"{k} bigint" for k in totals))
    writers.append(
        pipeline_metrics(run, F.lit(run_ts).cast("timestamp"), environment, job_name),
        lake.zone("metrics"),
    )
    ready = reduce(DataFrame.unionByName, handed)
    if gate == "batch":
        out = materialize(reduce(DataFrame.unionByName, parked), "parked")
        ready = ready.join(
            out.select(F.col("batch_id").alias("phase3_batch_id")), "phase3_batch_id", "left_anti"
        )
        limit = F.lit(float(max_invalid_percent)).alias("max_invalid_percent")
        if not out.isEmpty():
            writers.append(out.select("*", limit, F.lit(run_ts).alias("run_ts")), lake.zone("parked_batches"))
    elif not op.quality_gate(run, max_invalid_percent).first()["passed"]:
        raise QualityGateError(f"{totals['rows_quarantined']} of {totals['rows_read']} rows quarantined")
    ready = materialize(ready, "handed-on")
    writers.write_documents(ready, lake.zone("handoffs"), "phase3_batch_id")
    writers.append(ready, lake.zone("serving_batches"))
    return totals


def _curate_round(
    spark: SparkSession,
    lake: Lake,
    manifests: DataFrame,
    filled: list[str],
    run_ts: str,
    date_column: str | None,
) -> DataFrame:
    """Write the rows of the named batches; their counts per batch."""
    if not filled:
        return spark.createDataFrame(
            [], "batch_id string, rows_read bigint, rows_written bigint, rows_quarantined bigint"
        )
    clean = read_clean(spark, lake.zone("clean"), filled)
    tagged = materialize(
        op.tag_curation(op.with_lineage(clean, manifests, run_ts), date_column), "curation"
    )
    dealt = writers.deal(tagged.where("error_reason IS NULL"), "phase3_batch_id", "ord")
    good = op.curated_rows(dealt, date_column, keep=("ord",))
    _, _, stats = together(
        spark,
        lambda: writers.write_curated(good, lake.zone("curated"), dealt=True),
        lambda: writers.write_quarantine(op.quarantine_rows(tagged), lake.zone("quarantine")),
        lambda: materialize(op.run_stats(tagged, ["batch_id"]), "batch-stats"),
    )
    return stats


def handoff(spark: SparkSession, lake: Lake, manifests: DataFrame, names: list[str]) -> DataFrame:
    """Hand-off rows of the batches in ``manifests`` (``names``), from what the curated zone now
    holds; one scan of their folders."""
    root = lake.zone("curated")
    origin = manifests.select(
        F.col("phase1_batch_id").alias("phase3_batch_id"),
        F.col("source_filename").alias("_name"),
        # The document the manifest was read from.
        F.concat(F.lit("metadata/"), "manifest_key").alias("_manifest"),
    )
    rows = read_batches(spark, root, names)
    if rows is not None:
        made = op.serving_batches(with_file(rows).withColumn("key", F.col("_file")))
        # Paths are turned into keys once a file, not once a row.
        keys = F.transform("curated_object_keys", lambda path: key_below(decoded_path(path), root))
        made = made.withColumn("curated_object_keys", F.array_sort(keys))
    else:
        made = spark.createDataFrame([], SERVING_BATCH).drop("curated_bucket")
    both = origin.join(made, "phase3_batch_id", "left")
    return both.select(
        "phase3_batch_id",
        F.col("_manifest").alias("source_manifest_key"),
        F.coalesce("source_filename", "_name").alias("source_filename"),
        "source_checksum",
        F.lit("curated").alias("curated_bucket"),
        F.coalesce("curated_object_keys", F.array().cast("array<string>")).alias("curated_object_keys"),
        F.coalesce("records_written", F.lit(0)).alias("records_written"),
        F.coalesce("pipeline_version", F.lit(op.PIPELINE_VERSION)).alias("pipeline_version"),
    )
