"""Fixed table schemas. Names and types are the data contract, so files stay interchangeable."""

from __future__ import annotations

from pyspark.sql import types as T

REQUIRED = ["customer_id", "name", "email", "sales"]


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


CLEAN = T.StructType(_strings(*REQUIRED))

# Raw rows after reading: file identity, position in the file, required columns as text.
RAW = T.StructType(
    _strings("batch_id") + [T.StructField("ord", T.LongType())] + _strings(*REQUIRED)
)

PARTITIONS = ["year", "month", "day"]

LINEAGE = [
    "ingestion_timestamp",
    "processed_timestamp",
    "phase1_batch_id",
    "phase3_batch_id",
    "source_filename",
    "source_raw_key",
    "source_clean_key",
    "pipeline_version",
]

CURATED = T.StructType(
    _strings("customer_id", "name", "email")
    + [T.StructField("sales", T.LongType())]
    + _strings("sales_category", *LINEAGE, *PARTITIONS)
)

QUARANTINE = T.StructType(
    [T.StructField("raw_record", T.MapType(T.StringType(), T.StringType()))]
    + _strings(
        "error_reason",
        "source_filename",
        "ingestion_timestamp",
        "processed_timestamp",
        "phase1_batch_id",
        "phase3_batch_id",
        "pipeline_version",
        "reason",
        *PARTITIONS,
    )
)

MANIFEST = T.StructType(
    _strings(
        "raw_bucket",
        "raw_key",
        "clean_bucket",
        "clean_key",
        "rejected_bucket",
        "rejected_key",
        "source_filename",
        "event_timestamp",
        "phase1_processed_timestamp",
        "phase1_batch_id",
        "phase1_pipeline_version",
    )
    + [
        T.StructField("total_records", T.LongType()),
        T.StructField("valid_records", T.LongType()),
        T.StructField("invalid_records", T.LongType()),
        T.StructField("execution_duration_ms", T.DoubleType()),
        T.StructField("clean_object_keys", T.ArrayType(T.StringType())),
        T.StructField("rejected_object_keys", T.ArrayType(T.StringType())),
    ]
    + _strings("lambda_request_id")
)

SERVING_BATCH = T.StructType(
    _strings(
        "phase3_batch_id",
        "source_manifest_key",
        "source_filename",
        "source_checksum",
        "curated_bucket",
    )
    + [
        T.StructField("curated_object_keys", T.ArrayType(T.StringType())),
        T.StructField("records_written", T.LongType()),
    ]
    + _strings("pipeline_version")
)

STAGING_COLUMNS = [
    "customer_id",
    "name",
    "email",
    "sales",
    "sales_category",
    "ingestion_timestamp",
    "processed_timestamp",
    "phase1_batch_id",
    "batch_id",
    "source_filename",
    "source_raw_key",
    "source_clean_key",
    "pipeline_version",
]

STAGING = T.StructType(
    [T.StructField(n, T.LongType() if n == "sales" else T.StringType()) for n in STAGING_COLUMNS]
)

CUSTOMERS = T.StructType(
    _strings("customer_id", "name", "email")
    + [T.StructField("sales", T.LongType())]
    + _strings("sales_category", "batch_id")
    + [T.StructField("processed_timestamp", T.TimestampType())]
    + _strings("source_filename", "pipeline_version")
    + [
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

SALES = T.StructType(
    _strings("customer_id")
    + [T.StructField("sales_amount", T.LongType())]
    + _strings("sales_category", "source_filename")
    + [
        T.StructField("ingestion_date", T.DateType()),
        T.StructField("processed_timestamp", T.TimestampType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
    + _strings("batch_id")
)

AUDIT = T.StructType(
    _strings("batch_id", "source_file", "status")
    + [
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("records_loaded", T.LongType()),
        T.StructField("records_updated", T.LongType()),
        T.StructField("records_failed", T.LongType()),
        T.StructField("duration_ms", T.LongType()),
    ]
    + _strings("checksum")
)

LOAD_ERRORS = T.StructType(
    _strings("customer_id", "error_message", "source_file")
    + [T.StructField("error_timestamp", T.TimestampType())]
    + _strings("batch_id")
)

METRIC = T.StructType(
    [T.StructField("ts", T.TimestampType())]
    + _strings("metric", "environment", "job_name")
    + [T.StructField("value", T.DoubleType())]
)
