"""Load job: handed-on batches -> serving tables, with checks, errors and an audit trail.

Plain files have no multi-table transaction. Every batch therefore writes under its own folder
(staging, customer changes, sales), and the audit row is appended last: readers only see folders
whose batch has a SUCCESS row. A load that breaks off leaves folders nobody reads, and the next
attempt overwrites them. The customers table is a base snapshot plus the changes since; a change
costs its own size, and ``compact`` folds the changes into a new base now and then.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchlake import schemas
from batchlake.functions import dates, digests
from batchlake.operators import load as op
from batchlake.operators.merge import fold_upserts, last_per_key
from batchlake.plans.lake import Lake
from batchlake.plans.monitor import log_line
from batchlake.session import create_once, entries, exists, materialize, together
from batchlake.sinks import writers
from batchlake.sources.manifests import read_handoffs
from batchlake.sources.tables import curated_objects, read_curated, with_file

MAX_ATTEMPTS = 3
#: Seconds after which a round that neither ended nor failed counts as dead.
LEASE = 3_600

#: Batches loaded at a time. All waiting ones are, in rounds of this many, by ingestion time, then
#: batch id; each round names its folders to the scans.
ROUND = 1_000

_SEQ = T.StructField("load_seq", T.StringType())
_CHANGES = T.StructType([*schemas.CUSTOMERS.fields, _SEQ])
_BASE = T.StructType([*_CHANGES.fields, T.StructField("first_seq", T.StringType())])
_COMPACTIONS = "version bigint, buckets array<int>"

#: Buckets of the customers' base, by a hash of the id. A compaction rewrites those it has changes for,
#: and a load looks for known customers in those it has rows for.
BUCKETS = 64


def _bucket() -> Column:
    return F.pmod(F.xxhash64("customer_id"), F.lit(BUCKETS)).cast("int")


class Serving:
    """The serving tables of a lake, as frames of what is committed."""

    def __init__(self, spark: SparkSession, lake: Lake):
        self.spark = spark
        self.root = lake.zone("serving")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _read(self, name: str, schema: T.StructType | str) -> DataFrame:
        if not exists(self.spark, self.path(name)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(name))

    def audit(self) -> DataFrame:
        """Latest audit row per batch. A SUCCESS is never replaced by a later attempt."""
        log = self._read("audit", schemas.AUDIT)
        rank = (
            F.when(F.col("status") == "SUCCESS", 2).when(F.col("status") == "IN_PROGRESS", 0).otherwise(1)
        )
        ranked = log.withColumn("_at", F.struct(rank, F.col("end_time"), F.col("start_time")))
        return last_per_key(ranked, ["batch_id"], "_at").drop("_at")

    def attempts(self) -> DataFrame:
        """Every attempt, skipped ones too."""
        return self._read("attempts", schemas.AUDIT)

    def committed(self, rows: DataFrame) -> DataFrame:
        done = self._read("audit", schemas.AUDIT).where("status = 'SUCCESS'").select("batch_id")
        return rows.join(done, "batch_id", "left_semi")

    def staging(self) -> DataFrame:
        return self._read("staging", schemas.STAGING)

    def sales(self) -> DataFrame:
        return self.committed(self._read("sales", schemas.SALES))

    def errors(self) -> DataFrame:
        return self._read("load_errors", schemas.LOAD_ERRORS)

    def changes(self) -> DataFrame:
        return self.committed(self._read("customer_changes", _CHANGES))

    def customers(self) -> DataFrame:
        """One row per customer: the base snapshot with all other committed changes folded in."""
        base, later = self._parts()
        return _fold(base, later).drop("load_seq", "first_seq")

    def customer_keys(self, buckets: list[int] | None = None) -> DataFrame:
        """Ids of all customers (or of those in ``buckets``), possibly repeated; nothing is folded for it."""
        base, later = self._parts(buckets)
        if buckets is not None:
            later = later.where(_bucket().isin(buckets))
        return base.select("customer_id").unionByName(later.select("customer_id"))

    def _parts(self, buckets: list[int] | None = None) -> tuple[DataFrame, DataFrame]:
        """The base, and the committed changes of all batches that are not in it."""
        base, folded, _ = self._base(buckets)
        return base, self.changes().join(folded, "batch_id", "left_anti")

    def _base(self, buckets: list[int] | None = None) -> tuple[DataFrame, DataFrame, int]:
        """The base (or these buckets of it), the batches folded into it, and its version.

        Each bucket is in the folder of the last version that rewrote it. What comes to the driver is the log
        of compactions.
        """
        log = sorted(self._read("compactions", _COMPACTIONS).collect())
        at = {b: r["version"] for r in log for b in r["buckets"]}
        wanted = sorted(at if buckets is None else at.keys() & set(buckets))

        def read(schema, paths: list[str]) -> DataFrame:
            if not paths:
                return self.spark.createDataFrame([], schema)
            return self.spark.read.schema(schema).parquet(*paths)

        base = read(_BASE, [f"{self.path('customers_base')}/version={at[b]}/bucket={b}" for b in wanted])
        folded = [f"{self.path('folded_batches')}/version={r['version']}" for r in log]
        return base, read("batch_id string", folded), log[-1]["version"] if log else 0

    def compact(self) -> None:
        """Fold the batches that are not yet in the base into it: the buckets they change are written anew, as a
        version of their own, with the names of the batches.

        A batch is in the base or it is not, whatever its clock says: a load that commits later with
        an older clock is still read. Base rows keep the order they won by, so such a load only
        wins where it would have without compaction. The log row comes last, so readers switch
        over only to a complete base.
        """
        _, folded, last = self._base()
        new = materialize(
            self.changes().select("batch_id").distinct().join(folded, "batch_id", "left_anti"),
            "to-fold",
        )
        if new.isEmpty():
            return
        later = materialize(self.changes().join(new, "batch_id", "left_semi"), "to-fold-rows")
        touched = sorted(r[0] for r in later.select(_bucket()).distinct().collect())  # at most BUCKETS
        base, _, _ = self._base(touched)
        version = last + 1
        (
            _fold(base, later)
            .withColumn("bucket", _bucket())
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(f"{self.path('customers_base')}/version={version}")
        )
        new.write.mode("overwrite").parquet(f"{self.path('folded_batches')}/version={version}")
        log = self.spark.createDataFrame([(version, touched)], _COMPACTIONS)
        writers.append(log, self.path("compactions"))


def _fold(base: DataFrame, later: DataFrame) -> DataFrame:
    """Base rows and changes as one row per customer: the highest ``load_seq`` wins, the lowest
    ``first_seq`` gives the creation time."""
    rows = base.unionByName(later.withColumn("first_seq", F.col("load_seq")).select(*base.columns))
    rest = [c for c in base.columns if c not in ("customer_id", "created_at", "first_seq")]
    folded = rows.groupBy("customer_id").agg(
        F.max_by(F.struct(*rest), "load_seq").alias("_row"),
        F.min_by(F.struct("created_at", "first_seq"), "first_seq").alias("_first"),
    )
    return folded.select("customer_id", "_row.*", "_first.*").select(*base.columns)


class Rounds:
    """The log of load rounds, which keeps two loads from taking one batch.

    A round is a file of the next number, created only if it is not there yet, that names its batches and
    its begin; a second file says that the round has ended. Who finds a number taken looks again at
    what is open and loaded before it tries the next one. A round that has not ended within ``LEASE``
    seconds is dead, and its batches are free.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root}/rounds"

    def _names(self) -> tuple[list[int], set[int]]:
        found = entries(self.spark, self.root)
        begun = sorted(int(n.removesuffix(".begun")) for n in found if n.endswith(".begun"))
        return begun, {int(n.removesuffix(".ended")) for n in found if n.endswith(".ended")}

    def _path(self, number: int, kind: str) -> str:
        return f"{self.root}/{number:012d}.{kind}"

    def open_batches(self, besides: int | None = None) -> tuple[int, DataFrame | None]:
        """The last number, and (batch_id) of all rounds that are open now; None if there is none."""
        begun, ended = self._names()
        open_ = [n for n in begun if n not in ended and n != besides]
        last = begun[-1] if begun else 0
        if not open_:
            return last, None
        rows = self.spark.read.schema("begun double, batch_id string").json([self._path(n, "begun") for n in open_])
        return last, rows.where(F.col("begun") > time.time() - LEASE).select("batch_id")

    def begin(self, batches: list[str], last: int) -> int | None:
        """Take the batches as the round after ``last``; its number, or None if somebody was first."""
        lines = [json.dumps({"begun": time.time(), "batch_id": b}) for b in batches]
        taken = create_once(self.spark, self._path(last + 1, "begun"), "\n".join(lines))
        return last + 1 if taken else None

    def end(self, number: int) -> None:
        create_once(self.spark, self._path(number, "ended"), "")


def load(
    spark: SparkSession,
    lake: Lake,
    run_ts: str,
    handoffs: DataFrame | None = None,
) -> DataFrame:
    """Load every handed-on batch that is not loaded yet; returns the audit rows of this run.

    All batches load as if one after the other, by ingestion time then id, those of a round in one
    job. While a round runs its batches are IN_PROGRESS in the audit and held in the log of rounds, so
    another load leaves them alone; if it breaks off they are FAILED, with a row in the errors that
    carries no customer.
    """
    now = F.lit(run_ts).cast("timestamp")
    serving = Serving(spark, lake)
    if handoffs is None:
        handoffs = spark.read.parquet(lake.zone("serving_batches"))
    # A delivery may repeat within one run; the batch is still loaded once.
    asked = handoffs.dropDuplicates(["phase3_batch_id"]).withColumn(
        "batch_id", F.col("phase3_batch_id")
    )
    audit = serving.audit()
    tried = materialize(
        _attempt_rows(op.already_loaded(asked, audit), now, "SKIPPED"), "skipped"
    )
    todo = _timed(spark, lake, materialize(op.skip_loaded(asked, audit), "to-load"))
    if not tried.isEmpty():
        _note(serving, tried)
    done = []
    rounds = Rounds(spark, serving.root)
    for page in _pages(todo, "_at", "batch_id"):
        number, names = _claim(serving, rounds, page)
        if number is None:
            continue
        mine = todo.where(F.col("batch_id").isin(names)).drop("_at")
        writers.append(_attempt_rows(mine, now, "IN_PROGRESS"), serving.path("audit"))
        try:
            done.append(_load_batches(spark, lake, serving, mine, names, run_ts))
        except Exception as fault:
            # The round's folders stay unread without a SUCCESS row; note the attempt and pass it on.
            failed = _attempt_rows(mine, now, "FAILED")
            message = F.lit(f"{type(fault).__name__}: {fault}"[:500])
            _batch_errors(mine, message, now).write.mode("append").partitionBy("batch_id").parquet(
                serving.path("load_errors")
            )
            writers.append(failed, serving.path("attempts"))
            writers.append(failed, serving.path("audit"))
            raise
        finally:
            rounds.end(number)
    if not done:
        return spark.createDataFrame([], schemas.AUDIT)
    return reduce(DataFrame.unionByName, done)


def _claim(serving: Serving, rounds: Rounds, page: list[str]) -> tuple[int | None, list[str]]:
    """Those of the batches that no other load holds or has loaded, as a round of this load; no round if
    none is left."""
    while True:
        last, held = rounds.open_batches()
        # Read after the log: a round that has ended since has its rows in the audit.
        gone = serving.audit().where("status = 'SUCCESS'").select("batch_id").where(F.col("batch_id").isin(page))
        if held is not None:
            gone = gone.unionByName(held.where(F.col("batch_id").isin(page)))
        taken = {r["batch_id"] for r in gone.collect()}  # of one page
        names = [b for b in page if b not in taken]
        if not names:
            return None, []
        number = rounds.begin(names, last)
        if number is not None:
            return number, names


def load_documents(spark: SparkSession, lake: Lake, run_ts: str) -> DataFrame:
    """``load`` of the hand-off documents (``handoffs``). A document that cannot be read or has no list of
    objects is no batch: it becomes an error row that names the document, and the others are loaded."""
    good, bad = read_handoffs(spark, lake.zone("handoffs"))
    serving = Serving(spark, lake)
    if exists(spark, serving.path("load_errors")):
        bad = bad.join(
            serving.errors().select(F.col("source_file").alias("manifest_key")), "manifest_key", "left_anti"
        )
    bad = materialize(bad, "malformed-handoffs")
    if not bad.isEmpty():
        rows = bad.select(F.col("manifest_key").alias("source_filename"), F.lit("malformed").alias("batch_id"), "reason")
        _batch_errors(rows, F.col("reason"), F.lit(run_ts).cast("timestamp")).write.mode("append").partitionBy(
            "batch_id"
        ).parquet(serving.path("load_errors"))
    return load(spark, lake, run_ts, good.drop("manifest_key"))


def _pages(batches: DataFrame, *order: str) -> Iterator[list[str]]:
    """Batch ids in the given order, ``ROUND`` at a time."""
    at = F.struct(*order)
    rest = batches
    while True:
        page = rest.orderBy(*order).select(*order).limit(ROUND).collect()
        if not page:
            return
        yield [r["batch_id"] for r in page]
        rest = batches.where(at > F.struct(*[F.lit(page[-1][c]).alias(c) for c in order]))


def _timed(spark: SparkSession, lake: Lake, todo: DataFrame) -> DataFrame:
    """``todo`` with the ingestion time ``_at`` of each batch; empty if it has no rows.

    The order matters between rounds only, so the times are read (one column of the waiting
    batches) if there is more than one.
    """
    if todo.limit(ROUND + 1).count() <= ROUND:
        return todo.withColumn("_at", F.lit(""))
    curated = read_curated(spark, lake.zone("curated"))
    times = [
        materialize(
            curated.where(F.col("phase3_batch_id").isin(names))
            .groupBy(F.col("phase3_batch_id").alias("batch_id"))
            .agg(F.min("ingestion_timestamp").alias("_at")),
            "batch-times",
        )
        for names in _pages(todo, "batch_id")
    ]
    found = todo.join(reduce(DataFrame.unionByName, times), "batch_id", "left")
    return materialize(found.na.fill("", ["_at"]), "to-load-by-time")


def _batch_errors(batches: DataFrame, message: Column, now: Column) -> DataFrame:
    """Error rows for whole batches; they carry no customer."""
    return batches.select(
        F.lit(None).cast("string").alias("customer_id"),
        message.alias("error_message"),
        F.col("source_filename").alias("source_file"),
        now.alias("error_timestamp"),
        "batch_id",
    )


def _load_batches(
    spark: SparkSession,
    lake: Lake,
    serving: Serving,
    todo: DataFrame,
    names: list[str],
    run_ts: str,
) -> DataFrame:
    """Load the batches ``names``; every scan reads their folders only."""
    begun = time.monotonic()
    now = F.lit(run_ts).cast("timestamp")
    here = F.col("batch_id").isin(names)
    mine = with_file(
        read_curated(spark, lake.zone("curated")).where(F.col("phase3_batch_id").isin(names))
    )
    held = curated_objects(mine, lake.zone("curated")).select(
        "phase3_batch_id", F.col("curated_object_keys").alias("_held")
    )
    none = F.array().cast("array<string>")
    listed = F.array_sort("curated_object_keys").eqNullSafe(F.coalesce("_held", none))
    fault = F.coalesce("error", F.when(~listed, "objects differ from those handed on"))
    verdict = materialize(
        op.verify_handoff(todo, mine)
        .join(held, "phase3_batch_id", "left")
        .select("batch_id", "source_filename", "records_written", fault.alias("error")),
        "verdict",
    )
    sound = verdict.where("error IS NULL").select("batch_id")

    tagged = materialize(
        op.tag_load(
            with_load_order(mine).join(sound, "batch_id", "left_semi"), "batch_id", "ord"
        ),
        "load-rows",
    )
    figures = tagged.groupBy("batch_id").agg(
        F.count_if(F.expr("error_message IS NULL")).alias("expected_rows"),
        F.count_if(F.expr("error_message IS NOT NULL")).alias("records_failed"),
    )
    figures = sound.join(figures, "batch_id", "left").na.fill(0, ["expected_rows", "records_failed"])
    _, figures = together(
        spark,
        lambda: writers.write_batches(op.staged_rows(tagged), serving.path("staging")),
        lambda: materialize(figures, "load-figures"),
    )
    staged = serving.staging().where(here).join(sound, "batch_id", "left_semi")
    before = op.pre_merge_checks(staged, figures.select("batch_id", "expected_rows"))
    ok = materialize(before.where("passed").select("batch_id"), "pre-merge")
    staged = staged.join(ok, "batch_id", "left_semi")

    sequenced = staged.withColumn(
        "batch_seq", F.concat_ws("|", F.lit(run_ts), "ingestion_timestamp", "batch_id")
    )
    touched = [r[0] for r in sequenced.select(_bucket()).distinct().collect()]  # at most BUCKETS
    known = serving.customer_keys(touched)
    counts, _, _ = together(
        spark,
        lambda: materialize(op.merge_counts(sequenced, known), "merge-counts"),
        lambda: writers.write_batches(op.sales_rows(staged, now), serving.path("sales")),
        lambda: writers.write_batches(op.load_errors(tagged, now), serving.path("load_errors")),
    )
    changes = op.customer_rows(sequenced, now, F.col("batch_seq").alias("load_seq"))

    written = serving._read("sales", schemas.SALES).where(here).join(ok, "batch_id", "left_semi")
    after = op.post_merge_checks(staged, written).select(
        "batch_id", F.col("passed").alias("reconciled")
    )
    sums = digests.batch_digests(staged).select(
        "batch_id", F.col("source_checksum").alias("checksum")
    )
    state = (
        verdict.join(figures, "batch_id", "left")
        .join(ok.withColumn("staged_ok", F.lit(True)), "batch_id", "left")
        .join(after, "batch_id", "left")
        .join(counts, "batch_id", "left")
        .join(sums, "batch_id", "left")
    )
    # A batch without a sound row has nothing staged, which is a sound load of no rows.
    nothing = F.col("expected_rows") == 0
    fault = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("staged_ok").isNull(), "pre-merge validation failed")
        .when(
            ~F.coalesce(F.col("reconciled"), nothing, F.lit(False)),
            "post-merge reconciliation failed",
        )
    )
    # The counts have read the changes of earlier loads by now; a repeated load replaces its own.
    _, state = together(
        spark,
        lambda: writers.write_batches(changes, serving.path("customer_changes")),
        lambda: materialize(state.withColumn("fault", fault), "load-state"),
    )

    def of(c: str) -> Column:
        return F.when(F.col("fault").isNull(), F.coalesce(F.col(c), F.lit(0))).otherwise(0)

    # The clock of the run is a parameter; only the time it took is measured.
    spent = round((time.monotonic() - begun) * 1000)
    rows = state.select(
        "batch_id",
        F.col("source_filename").alias("source_file"),
        F.when(F.col("fault").isNull(), "SUCCESS").otherwise("FAILED").alias("status"),
        now.alias("start_time"),
        F.timestamp_millis(F.unix_millis(now) + spent).alias("end_time"),
        of("inserted").alias("records_loaded"),
        of("updated").alias("records_updated"),
        of("records_failed").alias("records_failed"),
        F.lit(spent).cast("bigint").alias("duration_ms"),
        "checksum",
    )
    rows = materialize(rows, "audit-rows")

    faults = _batch_errors(state.where("fault IS NOT NULL"), F.col("fault"), now)
    faults.write.mode("append").partitionBy("batch_id").parquet(serving.path("load_errors"))
    _note(serving, rows)
    writers.append(rows, serving.path("audit"))  # commits the round
    return rows


def _note(serving: Serving, attempts: DataFrame) -> None:
    """Append attempts to their table and to the log."""
    writers.append(attempts, serving.path("attempts"))
    writers.append(attempts.select(_log(attempts)), serving.path("logs"))


def with_load_order(rows: DataFrame, batch: str = "phase3_batch_id") -> DataFrame:
    """Add ``batch_id`` and ``ord``: files of a batch by name, rows by their place in the file.

    Only the distinct file names are ranked, and looked up from a broadcast list: the names of the files
    that are read, which the driver's listing holds anyway. So no row is moved for its place.
    """
    by_name = Window.partitionBy(batch).orderBy("_file")
    files = rows.select(batch, "_file").distinct().select(
        "_file", (F.row_number().over(by_name) - 1).cast("bigint").alias("_place")
    )
    return (
        rows.join(F.broadcast(files), "_file")
        .withColumn("ord", F.shiftleft("_place", 40) + F.col("_row"))
        .withColumn("batch_id", F.col(batch))
        .drop("_place", "_file", "_row")
    )


def _attempt_rows(batches: DataFrame, now: Column, status: str) -> DataFrame:
    none = F.lit(0).cast("bigint")
    return batches.select(
        "batch_id",
        F.col("source_filename").alias("source_file"),
        F.lit(status).alias("status"),
        now.alias("start_time"),
        now.alias("end_time"),
        none.alias("records_loaded"),
        none.alias("records_updated"),
        none.alias("records_failed"),
        none.alias("duration_ms"),
        F.lit(None).cast("string").alias("checksum"),
    )


def _log(rows: DataFrame) -> Column:
    fields = {
        "batch_id": F.col("batch_id"),
        "source_file": F.col("source_file"),
        "status": F.col("status"),
        "records_inserted": F.col("records_loaded"),
        "records_updated": F.col("records_updated"),
        "records_failed": F.col("records_failed"),
    }
    return log_line(
        fields, dates.iso_z(F.col("end_time")), "batchlake", "database_loader"
    ).alias("value")


def redrive(spark: SparkSession, lake: Lake, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """(batch_id, attempts) of batches that failed and may be tried again."""
    tries = Serving(spark, lake).attempts()
    return (
        tries.groupBy("batch_id")
        .agg(
            F.count_if(F.expr("status = 'FAILED'")).alias("attempts"),
            F.bool_or(F.col("status") == "SUCCESS").alias("done"),
        )
        .where((F.col("attempts") > 0) & ~F.col("done") & (F.col("attempts") < max_attempts))
        .drop("done")
    )
