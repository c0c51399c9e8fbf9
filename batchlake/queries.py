"""Every operator as a query over the driver's test tables: name -> f(spark, sf_dir) -> DataFrame.

All read whole tables. Where a query needs files (arrival, curated table, streams), it writes the
derived rows to a fresh folder in the shared directory first.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from batchlake import schemas, seed
from batchlake.functions import dates, digests, numbers, text
from batchlake.operators import checks, curate, load, merge, validate
from batchlake.plans import curation, ingest, lake, loading, monitor, order_checks, reports
from batchlake.session import materialize, run_dir, together
from batchlake.sinks import writers
from batchlake.sources import delimited, listing, tables
from batchlake.streaming import jobs

QUERIES: dict = {}

NOW = "2001-07-30 00:00:00"
EVENTS_END = "2024-01-31 00:00:00"
STAMP = "yyyy-MM-dd HH:mm:ss"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def query(f):
    """Register ``f`` under its name, with the session settings results depend on."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        return f(spark, sf_dir)

    run.__name__, run.__doc__ = f.__name__, f.__doc__
    QUERIES[f.__name__] = run
    return f


def text_time(c: str, layout: str = STAMP):
    return F.date_format(c, layout).alias(c)


# ---- shared steps ----------------------------------------------------------------------------


def tagged_rows(spark, sf):
    return validate.tag_rows(seed.raw_rows(spark, sf))


def stored_rows(spark, sf):
    """The tagged rows as the arrival job leaves them: a table in the shared folder. Everything
    downstream reads them more than once."""
    return materialize(tagged_rows(spark, sf), "tagged")


def manifests(spark, sf):
    return seed.manifest_rows(tagged_rows(spark, sf))


def curation_rows(spark, sf):
    tagged = stored_rows(spark, sf)
    return _curation(tagged)


def _curation(tagged):
    clean = validate.clean_rows(tagged).drop("ingested_at")
    return curate.tag_curation(curate.with_lineage(clean, seed.manifest_rows(tagged), None))


def curated(spark, sf, keep=()):
    return curate.curated_rows(curation_rows(spark, sf), keep=keep)


def stored_curated(spark, sf):
    """The curated rows as the curation job leaves them, for uses that read them twice."""
    return materialize(curated(spark, sf), "curated")


def load_rows(spark, sf):
    """Curated rows with their load verdict, as a stored table."""
    rows = curated(spark, sf, keep=("ord",)).withColumn("batch_id", F.col("phase3_batch_id"))
    return materialize(load.tag_load(materialize(rows, "curated")), "load-rows")


def staged(spark, sf):
    return load.staged_rows(load_rows(spark, sf))


def early(frame):
    """Batches taken as already loaded."""
    return frame.where("batch_id < 'b20'")


def late(frame):
    return frame.where("batch_id >= 'b20'")


def load_time(batch="batch_id"):
    """Load clock of a batch: one minute per batch number."""
    return F.timestamp_seconds(
        F.lit(1_000_000_000) + F.substring(batch, 2, 2).cast("int") * 60
    )


def customers_before(rows):
    """Customers table after the early batches of the staged rows."""
    rows = early(rows)
    changes = load.customer_rows(rows, load_time(), F.col("batch_id").alias("seq"))
    empty = changes.drop("seq").limit(0)
    return merge.fold_upserts(empty, changes, ["customer_id"], "seq", created="created_at")


def customers_after(rows):
    changes = load.customer_rows(late(rows), load_time(), F.col("batch_id").alias("seq"))
    return merge.fold_upserts(
        customers_before(rows), changes, ["customer_id"], "seq", created="created_at"
    )


def raw_load(spark, sf):
    """Raw rows straight to the loader: every load fault occurs in them."""
    rows = seed.raw_rows(spark, sf).withColumn(
        "source_filename", F.concat("batch_id", F.lit(".csv"))
    )
    return load.tag_load(rows)


def audit(spark, sf):
    """Audit rows of the late batches, some of them failed or without a start."""
    number = F.substring("batch_id", 2, 2).cast("int")
    judged = load_rows(spark, sf)
    rows = load.staged_rows(judged)
    counts = load.merge_counts(
        late(rows).withColumn("batch_seq", F.col("batch_id")), customers_before(rows)
    )
    failed = judged.groupBy("batch_id").agg(
        F.count_if(F.col("error_message").isNotNull()).alias("records_failed")
    )
    runs = manifests(spark, sf).select(
        F.col("phase1_batch_id").alias("batch_id"),
        F.col("source_filename").alias("source_file"),
        F.to_timestamp("phase1_processed_timestamp").alias("at"),
        (F.col("total_records") * 10).alias("duration_ms"),
    )
    start = F.when(number % 11 != 10, F.col("at"))
    return (
        runs.join(counts, "batch_id")
        .join(failed, "batch_id")
        .select(
            "batch_id",
            "source_file",
            F.when(number % 7 == 3, "FAILED").otherwise("SUCCESS").alias("status"),
            F.col("inserted").alias("records_loaded"),
            F.col("updated").alias("records_updated"),
            "records_failed",
            "duration_ms",
            start.alias("start_time"),
            F.timestamp_millis(F.unix_millis("at") + F.col("duration_ms")).alias("end_time"),
        )
    )


def objects(spark, sf):
    """An object listing made of the pages: one object per page, spread over the zones."""
    zone = F.element_at(
        F.array(*[F.lit(z) for z in lake.ZONES]), (F.col("page_id") % 6 + 1).cast("int")
    )
    key = F.when(
        F.col("page_id") % 6 >= 4,
        F.concat(
            F.lit("customers/year=2026/month=0"),
            (F.col("page_id") % 9 + 1).cast("string"),
            F.lit("/part-"),
            F.col("page_id").cast("string"),
        ),
    ).otherwise(F.concat(F.lit("uploads/"), F.col("page_id").cast("string"), F.lit(".csv")))
    return seed.table(spark, sf, "pages").select(
        zone.alias("zone"),
        key.alias("key"),
        F.length("html").cast("bigint").alias("size"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 61 % 100_003).alias(
            "last_modified"
        ),
    )


# ---- validation ------------------------------------------------------------------------------


@query
def validate_split(spark, sf):
    return tagged_rows(spark, sf).select(
        "batch_id", "ord", "customer_id", "name", "email", "sales", "is_valid"
    )


@query
def reject_reasons(spark, sf):
    return validate.rejected_rows(tagged_rows(spark, sf)).select(
        "batch_id", "ord", F.array_join("reject_reasons", ",").alias("reject_reasons")
    )


@query
def reason_counts(spark, sf):
    return validate.reason_counts(tagged_rows(spark, sf))


@query
def batch_counts(spark, sf):
    return validate.batch_counts(tagged_rows(spark, sf))


@query
def manifest_rows(spark, sf):
    return manifests(spark, sf)


@query
def required_columns(spark, sf):
    """Missing required columns of headers made of the documents' sources and languages."""
    header = F.split(
        F.concat_ws(
            ",",
            F.when(F.col("doc_id") % 3 != 0, "customer_id"),
            F.lit("name"),
            F.col("lang"),
            F.when(F.col("doc_id") % 5 != 1, "sales"),
            F.when(F.col("doc_id") % 2 == 0, "email"),
        ),
        ",",
    )
    return (
        seed.table(spark, sf, "documents")
        .select(validate.missing_of(header).alias("missing"))
        .groupBy("missing")
        .agg(F.count(F.lit(1)).alias("files"))
    )


# ---- curation --------------------------------------------------------------------------------


@query
def curated_rows(spark, sf):
    return curated(spark, sf)


@query
def quarantine_rows(spark, sf):
    return curate.quarantine_rows(curation_rows(spark, sf)).withColumn(
        "raw_record", F.to_json("raw_record")
    )


@query
def quarantine_by_reason(spark, sf):
    return (
        curate.quarantine_rows(curation_rows(spark, sf))
        .groupBy("reason", "phase3_batch_id")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def _dated(spark, sf):
    """Clean rows with a date column in several layouts, some of them bad."""
    day = F.col("ingested_at").cast("date")
    k = F.col("ord") % 7
    written = (
        F.when(k == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(k == 1, F.date_format(day, "M/d/yy"))
        .when(k == 2, F.date_format(day, "MM/dd/yyyy"))
        .when(k == 3, F.date_format(day, "yyyy/M/d"))
        .when(k == 4, F.concat(F.lit("  "), F.date_format(day, "yyyy-M-d"), F.lit(" ")))
        .when(k == 5, F.lit("  "))
        .otherwise(F.concat(F.date_format(day, "yyyy"), F.lit("-13-40")))
    )
    return tagged_rows(spark, sf).withColumn("signup_date", written)


@query
def date_standardise(spark, sf):
    return _dated(spark, sf).select(
        "ord",
        F.date_format(dates.standardize_date(F.col("signup_date")), "yyyy-MM-dd").alias("day"),
        dates.date_unparsed(F.col("signup_date")).alias("unparsed"),
    )


@query
def curation_with_dates(spark, sf):
    """Reason precedence with a date column: sales before date."""
    dated = materialize(_dated(spark, sf), "tagged")
    clean = validate.clean_rows(dated).drop("ingested_at")
    rows = curate.with_lineage(clean, seed.manifest_rows(dated), None)
    tagged = curate.tag_curation(rows, "signup_date")
    return tagged.select("batch_id", "ord", "error_reason")


@query
def schema_mismatch(spark, sf):
    """A configured date column the files do not have: good sales are a schema mismatch."""
    tagged = stored_rows(spark, sf)
    clean = validate.clean_rows(tagged).drop("ingested_at")
    rows = curate.with_lineage(clean, seed.manifest_rows(tagged), None)
    return (
        curate.tag_curation(rows, "signup_date")
        .groupBy("error_reason")
        .agg(F.count(F.lit(1)).alias("records"))
    )


@query
def run_stats(spark, sf):
    return curate.run_stats(curation_rows(spark, sf))


@query
def quality_gate(spark, sf):
    stats = curate.run_stats(curation_rows(spark, sf), ["phase3_batch_id"])
    return curate.quality_gate(stats, 5.0)


@query
def quality_metrics(spark, sf):
    stats = curate.run_stats(curation_rows(spark, sf))
    out = monitor.pipeline_metrics(stats, F.lit(NOW).cast("timestamp"), "dev", "curate")
    return out.withColumn("ts", text_time("ts"))


@query
def batch_checksum(spark, sf):
    return digests.batch_digests(stored_curated(spark, sf), "phase3_batch_id")


@query
def serving_batches(spark, sf):
    return curate.serving_batches(stored_curated(spark, sf))


@query
def manifest_checksum_verify(spark, sf):
    """Hand-offs, some tampered with or for a batch that does not exist, against the rows."""
    rows = stored_curated(spark, sf)
    number = F.substring("phase3_batch_id", 2, 2).cast("int")
    made = curate.serving_batches(rows).select(
        F.when(number % 16 == 9, F.concat(F.lit("x"), "phase3_batch_id"))
        .otherwise(F.col("phase3_batch_id"))
        .alias("phase3_batch_id"),
        F.when(number % 8 == 3, F.reverse("source_checksum"))
        .otherwise(F.col("source_checksum"))
        .alias("source_checksum"),
    )
    return load.verify_handoff(made, rows).select("phase3_batch_id", "error")


@query
def single_batch_check(spark, sf):
    """Units of rows by source file, with some rows' batch id blanked or swapped."""
    k = F.col("ord")
    batch = (
        F.when(F.col("batch_id") == "b07", F.lit(""))
        .when((F.col("batch_id") == "b11") & (k % 3 == 0), F.lit("b99"))
        .when(k % 5 == 0, F.lit(None))
        .otherwise(F.col("batch_id"))
    )
    rows = seed.raw_rows(spark, sf).select(
        F.concat("batch_id", F.lit(".csv")).alias("source_file"), batch.alias("phase3_batch_id")
    )
    return load.single_batch_check(rows, "source_file")


# ---- loading ---------------------------------------------------------------------------------


@query
def load_valid_rows(spark, sf):
    return (
        raw_load(spark, sf)
        .where("error_message IS NULL")
        .select(
            "batch_id",
            "ord",
            text.ustrip(F.col("customer_id")).alias("customer_id"),
            numbers.parse_whole(F.col("sales")).alias("sales"),
        )
    )


@query
def load_errors(spark, sf):
    return load.load_errors(raw_load(spark, sf), F.col("ingested_at").cast("timestamp")).withColumn(
        "error_timestamp", text_time("error_timestamp")
    )


@query
def staged_rows(spark, sf):
    return staged(spark, sf)


@query
def pre_merge_checks(spark, sf):
    """Unvalidated rows as staging, so that every check finds something."""
    rows = seed.raw_rows(spark, sf).select(
        "batch_id", "customer_id", numbers.parse_whole(F.col("sales")).alias("sales")
    )
    expected = rows.groupBy("batch_id").agg(
        (F.count(F.lit(1)) + F.max(F.substring("batch_id", 2, 2).cast("int")) % 3).alias(
            "expected_rows"
        )
    )
    return load.pre_merge_checks(rows, expected)


@query
def pre_merge_passes(spark, sf):
    rows = staged(spark, sf)
    expected = rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("expected_rows"))
    return load.pre_merge_checks(rows, expected)


@query
def merge_counts(spark, sf):
    rows = staged(spark, sf)
    return load.merge_counts(
        late(rows).withColumn("batch_seq", F.col("batch_id")), customers_before(rows)
    )


@query
def upsert_customers(spark, sf):
    out = customers_after(staged(spark, sf))
    return out.withColumns(
        {c: text_time(c) for c in ("processed_timestamp", "created_at", "updated_at")}
    )


@query
def upsert_sales(spark, sf):
    """Two loads of the same batches: the second replaces the first one's rows."""
    rows = staged(spark, sf)
    first = load.sales_rows(rows, load_time())
    again = load.sales_rows(late(rows), F.timestamp_seconds(F.lit(1_100_000_000)))
    out = merge.upsert(first, again, ["customer_id", "batch_id"])
    return out.withColumns(
        {
            "ingestion_date": F.date_format("ingestion_date", "yyyy-MM-dd"),
            "processed_timestamp": text_time("processed_timestamp"),
            "loaded_at": text_time("loaded_at"),
        }
    )


@query
def post_merge_reconcile(spark, sf):
    """Staged rows against a sales fact that lost rows of some batches and amounts of others."""
    rows = staged(spark, sf)
    number = F.substring("batch_id", 2, 2).cast("int")
    kept = rows.where(~((number % 10 == 4) & F.col("customer_id").endswith("7")))
    fact = load.sales_rows(kept, load_time()).withColumn(
        "sales_amount", F.when(number % 10 == 6, F.col("sales_amount") + 1).otherwise(F.col("sales_amount"))
    )
    return load.post_merge_checks(rows, fact)


@query
def duplicate_customers(spark, sf):
    """Customers the serving table holds more than once after the merge: none."""
    people = materialize(customers_after(staged(spark, sf)).select("customer_id"), "customers")
    return checks.duplicate_keys(people, "customer_id")


@query
def missing_references(spark, sf):
    """Staged late rows whose customer the early load does not know."""
    rows = staged(spark, sf)
    return load.missing_references(late(rows), customers_before(rows))


@query
def skip_loaded_batches(spark, sf):
    """Batches still to load: no SUCCESS row yet."""
    batches = manifests(spark, sf).select(F.col("phase1_batch_id").alias("batch_id"))
    return load.skip_loaded(batches, audit(spark, sf))


@query
def skipped_batches(spark, sf):
    batches = manifests(spark, sf).select(F.col("phase1_batch_id").alias("batch_id"))
    return load.already_loaded(batches, audit(spark, sf))


# ---- load audit ------------------------------------------------------------------------------


def _audit_text(frame):
    times = [c for c in ("start_time", "end_time") if c in frame.columns]
    return frame.withColumns({c: text_time(c) for c in times})


@query
def audit_recent(spark, sf):
    return _audit_text(reports.audit_recent(audit(spark, sf)))


@query
def audit_failed(spark, sf):
    return _audit_text(reports.audit_by_status(audit(spark, sf), "FAILED"))


@query
def audit_24h(spark, sf):
    return reports.load_summary(audit(spark, sf), F.lit(NOW).cast("timestamp"))


@query
def audit_error_sources(spark, sf):
    errors = load.load_errors(raw_load(spark, sf), F.col("ingested_at").cast("timestamp"))
    return reports.errors_by_source(errors)


@query
def errors_of_batch(spark, sf):
    errors = load.load_errors(raw_load(spark, sf), F.col("ingested_at").cast("timestamp"))
    return reports.errors_of_batch(errors, "b13").withColumn(
        "error_timestamp", text_time("error_timestamp")
    )


# ---- manifests and dashboard -----------------------------------------------------------------


@query
def dashboard_totals(spark, sf):
    return reports.dashboard_totals(manifests(spark, sf))


@query
def dashboard_daily(spark, sf):
    return reports.dashboard_daily(manifests(spark, sf))


@query
def latest_batch(spark, sf):
    return reports.latest_batch(manifests(spark, sf)).select("phase1_batch_id", "raw_key")


@query
def pick_batch(spark, sf):
    return reports.pick_batch(manifests(spark, sf), "b17").select("phase1_batch_id", "raw_key")


@query
def recent_batches(spark, sf):
    return reports.recent_batches(manifests(spark, sf))


@query
def selectable_batches(spark, sf):
    return reports.selectable_batches(manifests(spark, sf))


@query
def manifest_page(spark, sf):
    return reports.manifest_page(manifests(spark, sf), status="partial", limit=10, offset=15)


@query
def manifest_search(spark, sf):
    return reports.manifest_listing(manifests(spark, sf), search="B1")


@query
def manifest_prefix(spark, sf):
    from batchlake.sources.manifests import below_prefix

    keyed = manifests(spark, sf).withColumn(
        "clean_key",
        F.when(F.col("phase1_batch_id") < "b10", F.concat(F.lit("uploads/a/"), "source_filename"))
        .otherwise(F.col("clean_key")),
    )
    return below_prefix(keyed, "uploads/a").select("phase1_batch_id", "clean_key")


@query
def processing_summary(spark, sf):
    return reports.processing_summary(manifests(spark, sf))


@query
def lineage_counts(spark, sf):
    return reports.lineage_counts(manifests(spark, sf), objects(spark, sf))


@query
def layer_reconcile(spark, sf):
    tagged = stored_rows(spark, sf)
    rows = _curation(tagged)
    made = curate.curated_rows(rows, keep=("ord",)).withColumn("batch_id", F.col("phase3_batch_id"))
    served = load.sales_rows(late(load.staged_rows(load.tag_load(made))), load_time())
    return reports.layer_reconcile(seed.manifest_rows(tagged), rows, served)


# ---- zones -----------------------------------------------------------------------------------


@query
def zone_inventory(spark, sf):
    out = lake.zone_inventory(objects(spark, sf), lake.purposes(spark, seed.ZONE_TEXTS))
    return out.withColumn("latest_object", text_time("latest_object"))


@query
def zone_total_bytes(spark, sf):
    return lake.total_bytes(objects(spark, sf))


@query
def zone_latest(spark, sf):
    out = lake.zone_latest(objects(spark, sf), "curated", "customers/")
    return out.withColumn("last_modified", text_time("last_modified"))


@query
def zone_partitions(spark, sf):
    return lake.partition_segments(objects(spark, sf))


@query
def new_objects(spark, sf):
    after = objects(spark, sf)
    before = after.where(F.col("size") % 3 != 0)
    return lake.new_objects(after, before).select("zone", "key", "size")


@query
def zone_freshness(spark, sf):
    """Whether the curated zone has an object no more than 30 s older than each of two times."""
    curated_objects = objects(spark, sf).where("zone = 'curated'")
    parts = [
        lake.freshness(curated_objects, F.lit(at).cast("timestamp")).select(
            F.lit(at).alias("batch_ts"), "object_count", text_time("latest"), "fresh"
        )
        for at in ("2023-11-14 22:13:20", "2023-12-31 00:00:00")
    ]
    return parts[0].unionByName(parts[1])


# ---- clean and curated reports ---------------------------------------------------------------


@query
def clean_listing(spark, sf):
    return reports.clean_listing(validate.clean_rows(tagged_rows(spark, sf)))


@query
def clean_totals(spark, sf):
    out = reports.clean_totals(validate.clean_rows(tagged_rows(spark, sf)))
    return out.withColumn("total_sales", F.col("total_sales").cast("double"))


@query
def analytics_summary(spark, sf):
    return reports.analytics_summary(curated(spark, sf))


@query
def by_category(spark, sf):
    return reports.by_category(curated(spark, sf))


@query
def by_day(spark, sf):
    return reports.by_day(curated(spark, sf))


@query
def top_customers(spark, sf):
    return reports.top_customers(curated(spark, sf))


@query
def by_source(spark, sf):
    return reports.by_source(curated(spark, sf))


@query
def category_in_partition(spark, sf):
    return reports.category_totals(reports.in_partition(curated(spark, sf), "1995", "01", "01"))


@query
def top_in_partition(spark, sf):
    return reports.top_sales(reports.in_partition(curated(spark, sf), "1995", "01", "01"))


# ---- integrity checks ------------------------------------------------------------------------


def _orders(name):
    def register(f):
        def run(spark, sf):
            return f(spark, seed.order_tables(spark, sf))

        run.__name__ = name
        query(run)
        return f

    return register


@_orders("row_counts")
def _(spark, t):
    return checks.table_counts(t)


@_orders("pk_duplicates")
def _(spark, t):
    parts = [
        checks.duplicate_keys(t[n], key).select(
            F.lit(n).alias("table_name"), F.col(key).cast("string").alias("key"), "occurrences"
        )
        for n, key in order_checks.PRIMARY_KEYS
    ]
    return checks._union(parts)


@_orders("pk_sample")
def _(spark, t):
    return checks.duplicate_samples(order_checks.PRIMARY_KEYS, t)


@_orders("fk_orphans")
def _(spark, t):
    parts = [
        checks.orphan_count(t[c], col, t[p], pcol).select(
            F.lit(f"{c}.{col}").alias("reference"), F.col("issue_count").alias("orphaned_records")
        )
        for c, col, p, pcol in order_checks.FOREIGN_KEYS
    ]
    return checks._union(parts)


@_orders("orphan_customers")
def _(spark, t):
    out = checks.orphans(t["customers"], "region_id", t["regions"], "region_id")
    return out.select("customer_id", "customer_name", F.col("region_id").alias("invalid_region_id"))


@_orders("orphan_orders")
def _(spark, t):
    out = checks.orphans(t["orders"], "customer_id", t["customers"], "customer_id", True)
    return out.select("order_id", "order_number", F.col("customer_id").alias("invalid_customer_id"))


@_orders("orphan_items_by_order")
def _(spark, t):
    out = checks.orphans(t["order_items"], "order_id", t["orders"], "order_id", True)
    return out.select("order_item_id", F.col("order_id").alias("invalid_order_id"))


@_orders("orphan_items_by_product")
def _(spark, t):
    out = checks.orphans(t["order_items"], "product_id", t["products"], "product_id", True)
    return out.select("order_item_id", F.col("product_id").alias("invalid_product_id"))


@_orders("null_counts")
def _(spark, t):
    per: dict[str, list[str]] = {}
    for name, column in order_checks.NOT_NULL:
        per.setdefault(name, []).append(column)
    return checks._union([checks.null_counts(t[n], cols, n) for n, cols in per.items()])


def _money(frame, *cols):
    return frame.withColumns({c: F.col(c).cast("double") for c in cols})


@_orders("order_total_mismatch")
def _(spark, t):
    out = order_checks.order_total_mismatch(t)
    return _money(out, "stored_total", "calculated_total", "difference")


@_orders("line_total_mismatch")
def _(spark, t):
    out = order_checks.line_total_mismatch(t)
    return _money(out, "stored_line_total", "calculated_line_total", "difference")


@_orders("payment_mismatch")
def _(spark, t):
    out = order_checks.payment_mismatch(t)
    return _money(out, "payment_amount", "expected_amount", "difference")


@_orders("status_mismatch")
def _(spark, t):
    return order_checks.status_mismatch(t)


@_orders("inventory_mismatch")
def _(spark, t):
    return order_checks.inventory_mismatch(t)


@_orders("negative_inventory")
def _(spark, t):
    return order_checks.negative_inventory(t).drop("reason")


@_orders("negative_prices")
def _(spark, t):
    return order_checks.negative_prices(t).select(
        "product_id", "product_name", "unit_price", "cost_price"
    )


@_orders("table_checksums")
def _(spark, t):
    return checks.table_checksums(order_checks.CHECKSUM_KEYS, t).withColumns(
        {c: F.col(c).cast("bigint") for c in ("max_id", "min_id")}
    )


@_orders("date_ranges")
def _(spark, t):
    out = checks.date_ranges(order_checks.DATE_COLUMNS, t)
    return out.withColumns({c: text_time(c) for c in ("min_date", "max_date")})


@_orders("kpi_counts")
def _(spark, t):
    return checks.counted(order_checks.KPIS, t)


@_orders("financial_totals")
def _(spark, t):
    return _money(checks.summed(order_checks.FINANCIALS, t), "amount")


@_orders("quality_report")
def _(spark, t):
    return checks.run_suite(spark, order_checks.SUITE, t)


@_orders("quality_summary")
def _(spark, t):
    return checks.summarize(checks.run_suite(spark, order_checks.SUITE, t))


@_orders("quality_summary_metrics")
def _(spark, t):
    report = checks.run_suite(spark, order_checks.SUITE, t)
    return checks.summary_metrics(checks.summarize(report))


@_orders("quality_report_document")
def _(spark, t):
    """The report as a document: its summary, and the size of each part."""
    report = checks.run_suite(spark, order_checks.SUITE, t)
    facts = {
        "row_counts": checks.table_counts(t),
        "checksums": checks.table_checksums(order_checks.CHECKSUM_KEYS, t),
    }
    document = checks.report_document(report, facts, "run-1", "2026-07-01T00:00:00Z")
    return document.select(
        "run_id",
        "overall_status",
        "summary.total_checks",
        "summary.failed_checks",
        *[F.size(F.col("results")[s]).alias(s) for s in ("primary_keys", "foreign_keys", "null_constraints", "data_consistency")],
        F.size("row_counts").alias("row_counts"),
        F.col("checksums")[0]["checksum"].alias("first_checksum"),
    )


@_orders("quality_report_faulty")
def _(spark, t):
    """One table gone, one column gone, and a check that divides by zero while it runs: these checks are
    errors, the others still run, also those that share a scan with them."""
    short = {n: f for n, f in t.items() if n != "shipments"}
    short["orders"] = short["orders"].drop("employee_id")
    dividing = ("inventory", "quantity_on_hand / (quantity_reserved - quantity_reserved) > 1")
    suite = replace(
        order_checks.SUITE, predicates={**order_checks.SUITE.predicates, "Stock per reserved unit": dividing}
    )
    report = checks.run_suite(spark, suite, short)
    return report.select("section", "check_name", "status", "issue_count")


@_orders("spot_check_customers")
def _(spark, t):
    return (
        t["customers"]
        .orderBy("customer_id")
        .limit(10)
        .select("customer_id", "customer_name", "email", "customer_status", "credit_limit")
    )


@_orders("spot_check_orders")
def _(spark, t):
    out = (
        t["orders"]
        .orderBy("order_id")
        .limit(10)
        .select("order_id", "order_number", "customer_id", "order_date", "order_status", "order_total")
    )
    return _money(out, "order_total").withColumn("order_date", text_time("order_date"))


# ---- operations ------------------------------------------------------------------------------


def _metrics(spark, sf):
    return seed.events(spark, sf, seed.METRIC)


@query
def hourly_metrics(spark, sf):
    recent = monitor.last_days(_metrics(spark, sf), F.lit(EVENTS_END).cast("timestamp"))
    return monitor.hourly_metrics(recent).withColumn("hour", text_time("hour"))


@query
def error_rate(spark, sf):
    recent = monitor.last_days(_metrics(spark, sf), F.lit(EVENTS_END).cast("timestamp"))
    return monitor.error_rate(recent)


@query
def quarantine_rate_windows(spark, sf):
    out = monitor.quarantine_rate(seed.events(spark, sf, seed.QUALITY_METRIC))
    return out.withColumn("window_start", text_time("window_start"))


def _alarms(spark, sf):
    return monitor.threshold_alarms(_metrics(spark, sf), monitor.alarm_rules(spark))


@query
def threshold_alarms(spark, sf):
    return _alarms(spark, sf).withColumn("window_start", text_time("window_start"))


@query
def alarm_order(spark, sf):
    return monitor.alarm_states(_alarms(spark, sf)).withColumn("updated", text_time("updated"))


def _logs(spark, sf):
    return monitor.parse_logs(seed.events(spark, sf, seed.LOG))


@query
def log_metrics(spark, sf):
    return monitor.log_metrics(_logs(spark, sf)).withColumn("ts", text_time("ts"))


@query
def recent_logs(spark, sf):
    logs = _logs(spark, sf).where("timestamp IS NOT NULL")
    return monitor.recent_logs(
        logs.select("timestamp", "batch_id", "status", "records_inserted", "records_failed")
    )


@query
def log_lines(spark, sf):
    """Load results written as structured log lines."""
    rows = audit(spark, sf)
    fields = {
        "batch_id": F.col("batch_id"),
        "status": F.col("status"),
        "records_inserted": F.col("records_loaded"),
        "records_failed": F.col("records_failed"),
    }
    line = monitor.log_line(fields, dates.iso_z(F.col("end_time")), "batchlake", "loader")
    return rows.select("batch_id", line.alias("line"))


@query
def run_alerts(spark, sf):
    out = monitor.run_alerts(seed.events(spark, sf, seed.RUN))
    return out.withColumn("started", text_time("started", MICROS))


def _attributed(spark, sf):
    runs = seed.events(spark, sf, seed.RUN, "event_type = 'signup'")
    batches = seed.events(spark, sf, seed.BATCH_EVENT, "event_type = 'view'")
    return monitor.run_attribution(batches, runs)


@query
def run_attribution(spark, sf):
    return _attributed(spark, sf).select(
        "batch_id", text_time("batch_ts", MICROS), text_time("started", MICROS), "run_id", "state"
    )


@query
def batch_progress(spark, sf):
    arrivals = seed.events(spark, sf, seed.BATCH_EVENT, "event_type = 'view'").select("raw_key")
    done = seed.events(
        spark, sf, {**seed.BATCH_EVENT, "event_id": "event_id"}, "event_type = 'view' AND event_id % 3 > 0"
    ).select(
        "raw_key",
        F.col("batch_id").alias("phase1_batch_id"),
        (F.col("event_id") % 100).alias("valid_records"),
        (F.col("event_id") % 11).alias("invalid_records"),
    )
    return monitor.batch_progress(arrivals, done, _attributed(spark, sf))


@query
def scalar_functions(spark, sf):
    """Per-value functions over the pages' addresses and the orders' dates."""
    stamp = F.when(
        F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    ).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    event = dates.event_timestamp(F.coalesce(stamp, F.lit("not a time")), "2000-01-01T00:00:00Z")
    parts = dates.partition_parts(event)
    key = F.concat(F.lit("uploads/"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    name = F.concat(
        F.lit("C:\\in box\\"),
        F.col("o_orderpriority"),
        F.lit(" #"),
        F.col("o_orderkey").cast("string"),
        F.when(F.col("o_orderkey") % 4 == 0, ".txt").otherwise(".CSV"),
    )
    parsed = dates.parse_timestamp(F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(event))
    return seed.table(spark, sf, "orders").select(
        "o_orderkey",
        event.alias("event_timestamp"),
        *[c.alias(p) for p, c in parts.items()],
        text.day_label(
            F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")
        ).alias("day_label"),
        ingest.manifest_key_of(key).alias("manifest_key"),
        text.base_name(key).alias("base_name"),
        text.safe_file_name(name).alias("safe_name"),
        F.date_format(parsed, STAMP).alias("parsed"),
        dates.duration_ms(parsed, F.lit("2010-01-01 00:00:00.5").cast("timestamp")).alias(
            "duration_ms"
        ),
    )


# ---- files -----------------------------------------------------------------------------------

ROWS_PER_FILE = 2_000_000  # order keys per raw file and batch


def _write_raw(spark, sf, root: str) -> None:
    """Raw files of the seed below ``root``: a folder per batch, a file per key range, the columns
    of odd batches in another order and with an extra column."""
    part = F.floor(F.col("ord") / ROWS_PER_FILE)
    rows = seed.raw_rows(spark, sf).withColumn("part", part)
    odd = F.substring("batch_id", 2, 2).cast("int") % 2 == 1
    layouts = {
        "even": (~odd, ["customer_id", "name", "email", "sales"]),
        "odd": (odd, ["sales", "part", "email", "customer_id", "name"]),
    }

    def write(name: str, where, columns: list[str]) -> None:
        (
            rows.where(where)
            .repartition("batch_id", "part")
            .sortWithinPartitions("batch_id", "part", "ord")
            .select(*[F.col(c).cast("string").alias(c) for c in columns], "batch_id", F.col("part").alias("p"))
            .write.partitionBy("batch_id", "p")
            .option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(f"{root}/{name}")
        )

    together(spark, *[lambda name=name, layout=layout: write(name, *layout) for name, layout in layouts.items()])


def _batch_of(key: str):
    return F.regexp_extract(key, r"batch_id=(b\d+)", 1)


@query
def csv_ingest_roundtrip(spark, sf):
    """Seed rows written as files of two layouts, then read and validated from the files."""
    home = lake.Lake(run_dir(spark, "ingest"))
    _write_raw(spark, sf, home.zone("raw"))
    made = ingest.ingest(spark, home, "2026-07-01T00:00:00Z")
    return (
        made.groupBy(_batch_of("raw_key").alias("batch"))
        .agg(
            F.sum("total_records").alias("total_records"),
            F.sum("valid_records").alias("valid_records"),
            F.sum("invalid_records").alias("invalid_records"),
        )
    )


def _set_aside(spark, root: str, keys: list[str], aside: str, body: bytes) -> None:
    """Put files with another content in the place of the named ones, which move to ``aside``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for key in keys:
        files.mkdirs(path(f"{aside}/{key}").getParent())
        files.rename(path(f"{root}/{key}"), path(f"{aside}/{key}"))
        broken = files.create(path(f"{root}/{key}"))
        broken.write(bytearray(body))
        broken.close()


def _put_back(spark, root: str, keys: list[str], aside: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for key in keys:
        files.delete(path(f"{root}/{key}"), False)
        files.rename(path(f"{aside}/{key}"), path(f"{root}/{key}"))


@query
def redrive_files(spark, sf):
    """Files that fail, are tried again in vain, are mended and tried again: one manifest each, and the number of
    attempts that failed. A last run of the arrival job finds nothing new."""
    home = lake.Lake(run_dir(spark, "redrive"))
    root, aside = home.zone("raw"), home.zone("aside")
    _write_raw(spark, sf, root)
    listed = listing.list_objects(spark, root, "odd", "*.csv").select("key")
    keys = sorted(r["key"] for r in listed.collect())  # a file per odd batch
    _set_aside(spark, root, keys, aside, b"customer_id,name,email\n1,a,a@b.c\n")
    ingest.ingest(spark, home, "2026-07-01T00:00:00Z")
    ingest.redrive_files(spark, home, "2026-07-01T01:00:00Z")
    _put_back(spark, root, keys, aside)
    state = ingest.redrive_files(spark, home, "2026-07-01T02:00:00Z")
    late = ingest.ingest(spark, home, "2026-07-01T03:00:00Z").count()
    from batchlake.sources.manifests import read_manifests

    made = read_manifests(spark, home.zone("metadata")).join(
        state.select("raw_key", F.col("attempts").alias("failed"), "state"), "raw_key", "left"
    )
    return made.groupBy(_batch_of("raw_key").alias("batch")).agg(
        F.count(F.lit(1)).alias("manifests"),
        F.sum("total_records").alias("total_records"),
        F.sum("valid_records").alias("valid_records"),
        F.max(F.coalesce("failed", F.lit(0))).alias("attempts"),
        F.max("state").alias("state"),
        F.lit(late).cast("bigint").alias("late_manifests"),
    )


def _curated_lake(spark, sf) -> lake.Lake:
    """All three jobs over files of the seed."""
    home = lake.Lake(run_dir(spark, "pipeline"))
    _write_raw(spark, sf, home.zone("raw"))
    ingest.ingest(spark, home, "2026-07-01T00:00:00Z")
    curation.curate(spark, home, "2026-07-01T01:00:00Z")
    return home


@query
def curated_table_roundtrip(spark, sf):
    """Curated files behind a partitioned table, found by partition repair."""
    home = _curated_lake(spark, sf)
    name = "curated_" + home.root.rsplit("-", 1)[-1]
    tables.create_curated_table(spark, name, home.zone("curated"))
    return (
        spark.table(name)
        .groupBy(_batch_of("source_raw_key").alias("batch"), "sales_category")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("sales").alias("revenue"))
    )


@query
def registered_partitions(spark, sf):
    """A partitioned table that knows the folders of every other batch, read below a partition filter."""
    home = _curated_lake(spark, sf)
    name = "registered_" + home.root.rsplit("-", 1)[-1]
    tables.create_curated_table(spark, name, home.zone("curated"), repair=False)
    from batchlake.sources.manifests import read_manifests

    even = F.regexp_extract("raw_key", r"batch_id=b(\d+)", 1).cast("int") % 2 == 0
    made = read_manifests(spark, home.zone("metadata")).where(even).select("phase1_batch_id")
    tables.add_partitions(spark, name, home.zone("curated"), [r[0] for r in made.collect()])
    return (
        spark.table(name)
        .where("year >= '2000' AND phase3_batch_id IS NOT NULL")
        .groupBy(_batch_of("source_raw_key").alias("batch"), "sales_category")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("sales").alias("revenue"))
    )


@query
def clean_table_roundtrip(spark, sf):
    """Clean files behind an external table."""
    home = lake.Lake(run_dir(spark, "clean"))
    _write_raw(spark, sf, home.zone("raw"))
    made = ingest.ingest(spark, home, "2026-07-01T00:00:00Z")
    name = "clean_" + home.root.rsplit("-", 1)[-1]
    tables.create_clean_table(spark, name, home.zone("clean"))
    files = made.select(
        F.col("phase1_batch_id").alias("batch_id"), _batch_of("raw_key").alias("batch")
    )
    return (
        spark.table(name)
        .join(files, "batch_id")
        .groupBy("batch")
        .agg(F.count(F.lit(1)).alias("records"), F.min("email").alias("first_email"))
    )


@query
def quarantine_files(spark, sf):
    home = _curated_lake(spark, sf)
    from batchlake.schemas import QUARANTINE

    return (
        spark.read.schema(QUARANTINE)
        .json(home.zone("quarantine"))
        .groupBy("reason")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count(F.col("raw_record")["customer_id"]).alias("with_id"),
        )
    )


@query
def schema_discovery(spark, sf):
    """Column types as found in the clean files."""
    home = lake.Lake(run_dir(spark, "discovery"))
    clean = validate.clean_rows(tagged_rows(spark, sf))
    writers.write_delimited(clean, home.zone("clean"))
    return delimited.infer_columns(spark, home.zone("clean"))


@query
def table_catalogue(spark, sf):
    """Column counts of the tables registered for this run."""
    home = lake.Lake(run_dir(spark, "catalogue"))
    tag = home.root.rsplit("-", 1)[-1]
    rows = curated(spark, sf)
    writers.write_curated(rows, home.zone("curated"))
    tables.create_curated_table(spark, f"cat_{tag}", home.zone("curated"))
    found = tables.catalogue_tables(spark).where(F.col("table_name") == f"cat_{tag}")
    per_table = spark.table(f"cat_{tag}").agg(F.count(F.lit(1)).alias("records"))
    return found.select(
        "column_count",
        per_table.scalar().alias("records"),
    )


@query
def zone_files(spark, sf):
    """The listing of files a curation run wrote: batches per zone from the real files."""
    home = _curated_lake(spark, sf)
    zones = {z: home.zone(z) for z in ("clean", "rejected", "metadata", "curated", "quarantine")}
    folder = F.regexp_extract("key", r"(?:batch|batch_id|phase3_batch_id)=([^/]+)/", 1)
    return (
        listing.list_zones(spark, zones)
        .where(folder != "")
        .groupBy("zone")
        .agg(F.countDistinct(folder).alias("batches"), (F.sum("size") > 0).alias("filled"))
    )


def _spaced_raw(spark, sf, root: str) -> None:
    """One raw file per batch whose ids occur twice, the second time with a blank in front: two ids
    for validation, one after curation. The sales of the later row are odd."""
    rows = seed.raw_rows(spark, sf).select("batch_id", "ord", F.col("ord").cast("string").alias("id"))
    twice = rows.select(
        "batch_id",
        F.inline(
            F.array(
                *[
                    F.struct((F.col("ord") * 2 + k).alias("place"), F.concat(F.lit(" " * k), "id").alias("customer_id"))
                    for k in (0, 1)
                ]
            )
        ),
    )
    (
        twice.select(
            "batch_id", "place", "customer_id", F.lit("n").alias("name"), F.lit("a@b.c").alias("email"),
            F.col("place").cast("string").alias("sales"),
        )
        .repartition("batch_id")
        .sortWithinPartitions("batch_id", "place")
        .drop("place")
        .write.partitionBy("batch_id")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(root)
    )


@query
def ordered_outputs(spark, sf):
    """Through all jobs the first of two rows with one id is the one that counts."""
    home = lake.Lake(run_dir(spark, "ordered"))
    _spaced_raw(spark, sf, home.zone("raw"))
    ingest.ingest(spark, home, "2026-07-01T00:00:00Z")
    clean = delimited.read_clean(spark, home.zone("clean"))
    order = Window.partitionBy("batch_id").orderBy("ord")
    fallen = (
        clean.withColumn("before", F.lag(F.col("sales").cast("bigint")).over(order))
        .agg(F.count_if(F.col("sales").cast("bigint") <= F.col("before")))
        .scalar()
    )
    curation.curate(spark, home, "2026-07-01T01:00:00Z")
    loading.load(spark, home, "2026-07-01T02:00:00Z")
    sales = loading.Serving(spark, home).sales()
    return sales.agg(
        F.count(F.lit(1)).alias("loaded"),
        F.count_if(F.col("sales_amount") % 2 == 1).alias("later_rows"),
    ).withColumn("fallen", fallen)


def _half_loaded(spark, sf, first_clock: str, second_clock: str) -> loading.Serving:
    """Batches of even number loaded and compacted, then the others with another clock."""
    home = _curated_lake(spark, sf)
    from batchlake.sources.manifests import read_manifests

    made = read_manifests(spark, home.zone("metadata"))
    even = F.regexp_extract("raw_key", r"batch_id=b(\d+)", 1).cast("int") % 2 == 0
    names = made.select(F.col("phase1_batch_id").alias("phase3_batch_id"), even.alias("even"))
    handed = spark.read.parquet(home.zone("serving_batches")).join(names, "phase3_batch_id")
    loading.load(spark, home, first_clock, handed.where("even").drop("even"))
    serving = loading.Serving(spark, home)
    serving.compact()
    loading.load(spark, home, second_clock, handed.where("NOT even").drop("even"))
    return serving


@query
def compact_backfill(spark, sf):
    """A load with an older clock after a compaction: no customer is lost, and the row with the later
    clock stays."""
    serving = _half_loaded(spark, sf, "2026-07-01T05:00:00Z", "2026-07-01T02:00:00Z")
    people = serving.customers()
    return people.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.hour("updated_at") == 5).alias("from_first"),
        F.count_if(F.hour("created_at") == 2).alias("created_by_second"),
    )


@query
def mixed_objects(spark, sf):
    """Hand-offs against curated rows of which some carry another batch's id, or none."""
    rows = stored_curated(spark, sf)
    number = F.substring("phase3_batch_id", 2, 2).cast("int")
    inner = (
        F.when(number % 8 == 2, F.lit(""))
        .when((number % 8 == 5) & (F.substring("customer_id", -1, 1) == "1"), F.lit("other"))
        .otherwise(F.col("phase1_batch_id"))
    )
    changed = rows.withColumn("phase1_batch_id", inner)
    return load.verify_handoff(curate.serving_batches(rows), changed).select("phase3_batch_id", "error")


@query
def handoff_documents(spark, sf):
    """Hand-off documents, two of them malformed, loaded: batches by outcome, and keys that lead nowhere."""
    home = _curated_lake(spark, sf)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(home.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, body in (("torn.json", b"{not json"), ("bare.json", b'{"phase3_batch_id": "x"}')):
        made = files.create(path(f"{home.zone('handoffs')}/{name}"))
        made.write(bytearray(body))
        made.close()
    loading.load_documents(spark, home, "2026-07-01T02:00:00Z")
    serving = loading.Serving(spark, home)
    from batchlake.sources.manifests import read_handoffs, read_manifests

    manifests = read_manifests(spark, home.zone("metadata"))
    handed, _ = read_handoffs(spark, home.zone("handoffs"))
    named = {
        "clean": manifests.select(F.explode("clean_object_keys").alias("key")),
        "rejected": manifests.select(F.explode("rejected_object_keys").alias("key")),
        "curated": handed.select(F.explode("curated_object_keys").alias("key")),
        "metadata": handed.select(F.regexp_replace("source_manifest_key", "^metadata/", "").alias("key")),
    }
    found = listing.list_zones(spark, {z: home.zone(z) for z in named})
    dangling = None
    for zone, keys in named.items():
        lost = keys.join(found.where(F.col("zone") == zone).select("key"), "key", "left_anti")
        dangling = lost if dangling is None else dangling.unionByName(lost)
    faults = serving.errors().where("customer_id IS NULL")
    return serving.audit().agg(
        F.count_if(F.col("status") == "SUCCESS").alias("loaded"),
        F.count_if(F.col("status") != "SUCCESS").alias("not_loaded"),
    ).select(
        "*",
        faults.agg(F.count_if(F.col("error_message") == "unreadable document")).scalar().alias("unreadable"),
        faults.agg(F.count_if(F.contains("error_message", F.lit("not a list")))).scalar().alias("without_list"),
        dangling.agg(F.count(F.lit(1))).scalar().alias("dangling_keys"),
    )


@query
def failed_load_audit(spark, sf):
    """A load that breaks off at a torn object and one after the object is back: entries of the audit log by
    status, the batches whose latest entry is SUCCESS, and attempts that failed."""
    home = _curated_lake(spark, sf)
    root, aside = home.zone("curated"), home.zone("aside")
    torn = listing.list_objects(spark, root, "", "*.parquet").orderBy("key").limit(1).first()["key"]
    _set_aside(spark, root, [torn], aside, b"torn")
    try:
        loading.load(spark, home, "2026-07-01T02:00:00Z")
    except Exception as fault:  # noqa: BLE001 - any fault of the load is what the audit has to show
        said = type(fault).__name__
    else:
        said = ""
    _put_back(spark, root, [torn], aside)
    loading.load(spark, home, "2026-07-01T03:00:00Z")
    serving = loading.Serving(spark, home)
    log = spark.read.schema(schemas.AUDIT).parquet(serving.path("audit"))
    return log.agg(
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in ("IN_PROGRESS", "FAILED", "SUCCESS")]
    ).select(
        "*",
        serving.audit().agg(F.count_if(F.col("status") == "SUCCESS")).scalar().alias("loaded"),
        serving.attempts().agg(F.count_if(F.col("status") == "FAILED")).scalar().alias("broken_off"),
        F.lit(said != "").alias("raised"),
    )


@query
def gate_per_batch(spark, sf):
    """Batches judged one by one at 5 %: handed on or parked."""
    home = lake.Lake(run_dir(spark, "gate"))
    _write_raw(spark, sf, home.zone("raw"))
    manifests = ingest.ingest(spark, home, "2026-07-01T00:00:00Z").select(
        F.col("phase1_batch_id").alias("batch_id"), _batch_of("raw_key").alias("batch")
    )
    curation.curate(spark, home, "2026-07-01T01:00:00Z", max_invalid_percent=5, gate="batch")
    handed = spark.read.parquet(home.zone("serving_batches")).select(
        F.col("phase3_batch_id").alias("batch_id"), F.lit("handed on").alias("state")
    )
    parked = spark.read.parquet(home.zone("parked_batches")).select("batch_id", F.lit("parked").alias("state"))
    return manifests.join(handed.unionByName(parked), "batch_id").select("batch", "state")


@query
def load_roundtrip(spark, sf):
    """Files to serving tables, loaded twice: the second load skips every batch."""
    home = _curated_lake(spark, sf)
    loading.load(spark, home, "2026-07-01T02:00:00Z")
    loading.load(spark, home, "2026-07-01T03:00:00Z")
    serving = loading.Serving(spark, home)
    facts = serving.sales().agg(
        F.count(F.lit(1)).alias("sales_rows"), F.sum("sales_amount").alias("sales_total")
    )
    people = serving.customers().agg(F.count(F.lit(1)).alias("n"))
    tries = serving.attempts()
    return facts.select(
        "sales_rows",
        "sales_total",
        people.scalar().alias("customers"),
        serving.errors().agg(F.count(F.lit(1))).scalar().alias("errors"),
        tries.agg(F.count_if(F.col("status") == "SUCCESS")).scalar().alias("loaded"),
        tries.agg(F.count_if(F.col("status") == "SKIPPED")).scalar().alias("skipped"),
    )


# ---- streams ---------------------------------------------------------------------------------


def _drain(*started) -> None:
    for q in started:
        q.awaitTermination()


@query
def stream_ingest(spark, sf):
    """The arrival job driven by new files."""
    home = lake.Lake(run_dir(spark, "stream-ingest"))
    _write_raw(spark, sf, home.zone("raw"))
    _drain(jobs.ingest_stream(spark, home, home.zone("checkpoints/ingest"), True, files=20))
    from batchlake.sources.manifests import read_manifests

    return (
        read_manifests(spark, home.zone("metadata"))
        .groupBy(_batch_of("raw_key").alias("batch"))
        .agg(
            F.sum("total_records").alias("total_records"),
            F.sum("valid_records").alias("valid_records"),
        )
    )


@query
def stream_load_idempotent(spark, sf):
    """All three jobs as streams; the load stream is then replayed from a new checkpoint."""
    home = lake.Lake(run_dir(spark, "stream-load"))
    _write_raw(spark, sf, home.zone("raw"))
    _drain(jobs.ingest_stream(spark, home, home.zone("checkpoints/ingest"), True, files=20))
    _drain(jobs.curate_stream(spark, home, home.zone("checkpoints/curate"), True, files=20))
    _drain(jobs.load_stream(spark, home, home.zone("checkpoints/load"), True))
    _drain(jobs.load_stream(spark, home, home.zone("checkpoints/again"), True))
    serving = loading.Serving(spark, home)
    return serving.sales().agg(
        F.count(F.lit(1)).alias("sales_rows"),
        F.sum("sales_amount").alias("sales_total"),
    ).select(
        "*", serving.customers().agg(F.count(F.lit(1))).scalar().alias("customers")
    )


def _stream_out(spark, sf, columns, label, start):
    home = run_dir(spark, label)
    _drain(start(seed.event_stream(spark, sf, columns), f"{home}/out", f"{home}/checkpoint", True))
    return spark.read.parquet(f"{home}/out")


@query
def stream_hourly(spark, sf):
    """Hourly figures as a stream: hours the watermark has passed."""
    out = _stream_out(spark, sf, seed.METRIC, "stream-hourly", jobs.hourly_stream)
    return out.withColumn("hour", text_time("hour"))


@query
def stream_quarantine_rate(spark, sf):
    out = _stream_out(spark, sf, seed.QUALITY_METRIC, "stream-quarantine", jobs.quarantine_stream)
    return out.withColumn("window_start", text_time("window_start"))


@query
def stream_alarms(spark, sf):
    rules = monitor.alarm_rules(spark)
    out = _stream_out(
        spark,
        sf,
        seed.METRIC,
        "stream-alarms",
        lambda rows, *rest: jobs.alarm_stream(rows, rules, *rest),
    )
    return out.withColumn("window_start", text_time("window_start"))


@query
def stream_alerts(spark, sf):
    out = _stream_out(spark, sf, seed.RUN, "stream-alerts", jobs.alert_stream)
    return out.withColumn("started", text_time("started", MICROS))


@query
def stream_log_metrics(spark, sf):
    out = _stream_out(spark, sf, seed.LOG, "stream-logs", jobs.log_metric_stream)
    return out.withColumn("ts", text_time("ts"))
