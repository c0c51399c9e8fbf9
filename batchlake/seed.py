"""Views of the driver's test tables in the shapes this library works on.

Every table is spelled as (source, {column: SQL}) with expressions that mean the same in Spark and
in the SQL engine that checks the results, so both sides start from identical rows. Faults (NULLs,
orphans, wrong totals, bad cells) are injected by key arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What the zones of the test lake are for, as a caller would describe them.
ZONE_TEXTS = {
    "raw": "inbox",
    "clean": "passed the row rules",
    "rejected": "failed a row rule",
    "metadata": "manifests",
    "curated": "typed tables",
    "quarantine": "could not be typed",
}


# ---- customer files --------------------------------------------------------------------------

RAW = {
    "ord": "o_orderkey",
    "batch_id": "concat('b', lpad(cast(o_orderkey % 40 as string), 2, '0'))",
    "customer_id": (
        "case when o_orderkey % 23 = 5 then null when o_orderkey % 29 = 7 then '   ' "
        "else concat('C-', cast(o_custkey as string)) end"
    ),
    "name": (
        "case when o_orderkey % 31 = 3 then '' "
        "else concat('  ', lower(c_name), '   ', c_mktsegment, ' ') end"
    ),
    "email": (
        "case when o_orderkey % 13 = 2 then 'no-at-sign.example.com' "
        "when o_orderkey % 37 = 4 then 'two@@example.com' "
        "else concat(' User', cast(o_custkey as string), '@Example.COM ') end"
    ),
    "sales": (
        "case when o_orderkey % 11 = 1 then 'N/A' when o_orderkey % 17 = 6 then '1,500' "
        "when o_orderkey % 19 = 8 then concat(cast(o_orderkey % 900 as string), '.75') "
        "when o_orderkey % 41 = 9 then concat('-', cast(o_orderkey % 900 + 1 as string)) "
        "else concat('  ', cast(o_orderkey % 2000 as string)) end"
    ),
    "ingested_at": "o_orderdate",
}

RAW_SQL = (
    "SELECT "
    + ", ".join(f"{expr} AS {name}" for name, expr in RAW.items())
    + " FROM orders JOIN customer ON o_custkey = c_custkey"
)


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer rows in 40 batches, one row per order, in file order ``ord``."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.selectExpr(*[f"{expr} AS {name}" for name, expr in RAW.items()])


# Lineage of a batch, from its rows: counts come from the validated rows, times from the order
# dates, the duration from the row count.
MANIFEST = {
    "raw_bucket": "'raw'",
    "raw_key": "concat('uploads/', batch_id, '.csv')",
    "clean_bucket": "'clean'",
    "clean_key": "concat('uploads/', batch_id, '.csv')",
    "rejected_bucket": "'rejected'",
    "rejected_key": "concat('uploads/', batch_id, '.csv')",
    "source_filename": "concat(batch_id, '.csv')",
    "phase1_batch_id": "batch_id",
    "phase1_pipeline_version": "'1.1.0'",
    "total_records": "total_records",
    "valid_records": "valid_records",
    "invalid_records": "invalid_records",
    "execution_duration_ms": (
        "case when cast(substr(batch_id, 2) as int) % 9 = 4 then null "
        "else cast(total_records as double) * 5e-1 end"
    ),
}


def manifest_rows(tagged: DataFrame) -> DataFrame:
    """One manifest per batch of tagged rows (which still carry ``ingested_at``)."""
    counts = tagged.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("is_valid").alias("valid_records"),
        F.count_if(F.expr("NOT is_valid")).alias("invalid_records"),
        F.date_format(F.min("ingested_at"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_timestamp"),
        F.date_format(
            F.max("ingested_at") - F.expr("INTERVAL 1 DAY") * F.expr("int(substr(batch_id, 2)) % 7"),
            "yyyy-MM-dd'T'HH:mm:ss'Z'",
        ).alias("phase1_processed_timestamp"),
    )
    return counts.selectExpr(
        *[f"{expr} AS {name}" for name, expr in MANIFEST.items()],
        "event_timestamp",
        "phase1_processed_timestamp",
    )


# ---- order domain ----------------------------------------------------------------------------

def _cents(amount: str) -> str:
    """An amount as DECIMAL(15,2), half cents up, computed the same way by every engine."""
    return f"cast(cast(cast(floor(({amount}) * 1e2 + 5e-1) as bigint) as decimal(17,0)) * 0.01 as decimal(15,2))"


ORDER_DOMAIN: dict[str, tuple[str, dict[str, str]]] = {
    "regions": (
        "region",
        {
            "region_id": "r_regionkey",
            "region_name": "r_name",
            "region_code": "case when r_regionkey = 4 then null else substr(r_name, 1, 2) end",
        },
    ),
    "customers": (
        "customer",
        {
            "customer_id": "c_custkey",
            "customer_name": "case when c_custkey % 211 = 9 then null else c_name end",
            "email": (
                "case when c_custkey % 97 = 13 then null "
                "else concat('user', cast(c_custkey as string), '@example.com') end"
            ),
            "region_id": (
                "case when c_custkey % 101 = 7 then null when c_custkey % 53 = 3 then 99 "
                "else c_nationkey % 5 end"
            ),
            "customer_status": "case when c_custkey % 3 = 0 then 'INACTIVE' else 'ACTIVE' end",
            "credit_limit": "c_acctbal",
        },
    ),
    "suppliers": (
        "supplier",
        {
            "supplier_id": "s_suppkey",
            "region_id": "case when s_suppkey % 17 = 5 then 77 else s_nationkey % 5 end",
        },
    ),
    "products": (
        "part",
        {
            "product_id": "p_partkey",
            "product_name": "case when p_partkey % 307 = 11 then null else p_name end",
            "product_code": "concat('P', cast(p_partkey as string))",
            "unit_price": (
                "case when p_partkey % 83 = 5 then null when p_partkey % 61 = 8 "
                "then 0 - p_retailprice else p_retailprice end"
            ),
            "cost_price": "case when p_partkey % 71 = 2 then -1e0 else p_retailprice * 5e-1 end",
            "supplier_id": "case when p_partkey % 59 = 4 then 1000000000 + p_partkey else p_partkey % 10 end",
            "discontinued": "case when p_partkey % 4 = 1 then 'Y' else 'N' end",
        },
    ),
    "inventory": (
        "part",
        {
            "inventory_id": "p_partkey % 1000000000 + case when p_partkey % 149 = 1 then -1 else 0 end",
            "product_id": "case when p_partkey % 67 = 6 then 1000000000 + p_partkey else p_partkey end",
            "quantity_on_hand": "cast(case when p_partkey % 43 = 2 then -5 else p_size * 10 end as int)",
            "quantity_reserved": "cast(p_size as int)",
            "quantity_available": (
                "cast(case when p_partkey % 43 = 2 then -5 else p_size * 10 end as int) "
                "- cast(p_size as int) + case when p_partkey % 37 = 12 then 1 else 0 end"
            ),
        },
    ),
    "employees": (
        "customer",
        {
            "employee_id": "c_custkey",
            "first_name": "case when c_custkey % 401 = 3 then null else c_name end",
            "last_name": "c_mktsegment",
            "email": "concat('e', cast(c_custkey as string), '@example.com')",
            "manager_id": (
                "case when c_custkey % 10 = 0 then null when c_custkey % 89 = 5 "
                "then 1000000000 + c_custkey else c_custkey - c_custkey % 10 end"
            ),
        },
    ),
    "orders": (
        "orders",
        {
            "order_id": "o_orderkey",
            "order_number": (
                "case when o_orderkey % 503 = 17 then null "
                "else concat('SO-', cast(o_orderkey as string)) end"
            ),
            "customer_id": (
                "case when o_orderkey % 199 = 3 then null when o_orderkey % 157 = 8 "
                "then 1000000000 + o_custkey else o_custkey end"
            ),
            "employee_id": "case when o_orderkey % 181 = 5 then 2000000000 else o_custkey end",
            "order_date": "o_orderdate",
            "order_status": (
                "case when o_orderstatus = 'F' then 'DELIVERED' when o_orderstatus = 'O' "
                "then 'SHIPPED' else 'PENDING' end"
            ),
            "order_total": _cents("o_totalprice"),
            "tax_amount": _cents("o_totalprice * 5e-2"),
            "shipping_cost": "cast(o_orderkey % 50 as decimal(15,2))",
        },
    ),
    "order_items": (
        "lineitem",
        {
            "order_item_id": "l_orderkey * 10 + l_linenumber",
            "order_id": "case when l_orderkey % 251 = 4 then 1000000000 + l_orderkey else l_orderkey end",
            "product_id": (
                "case when l_partkey % 263 = 9 then null when l_partkey % 239 = 6 "
                "then 1000000000 + l_partkey else l_partkey end"
            ),
            "quantity": "case when l_orderkey % 811 = 10 then null else l_quantity end",
            "unit_price": "l_extendedprice / l_quantity",
            "discount_pct": "case when l_linenumber = 7 then null else l_discount * 1e2 end",
            "line_total": (
                _cents(
                    "case when l_linenumber = 7 then l_extendedprice "
                    "else l_extendedprice * (1e0 - l_discount) end "
                    "+ case when l_orderkey % 97 = 3 then 1e0 else 0e0 end"
                )
            ),
        },
    ),
    "payments": (
        "orders",
        {
            "payment_id": "o_orderkey",
            "order_id": (
                "case when o_orderkey % 307 = 2 then null when o_orderkey % 293 = 1 "
                "then 1000000000 + o_orderkey else o_orderkey end"
            ),
            "payment_amount": (
                "case when o_orderkey % 409 = 6 then null else "
                f"{_cents('o_totalprice')} + {_cents('o_totalprice * 5e-2')} "
                "+ cast(o_orderkey % 50 as decimal(15,2)) "
                "+ cast(case when o_orderkey % 103 = 5 then 1 else 0 end as decimal(15,2)) end"
            ),
            "payment_status": "case when o_orderkey % 6 = 0 then 'PENDING' else 'COMPLETED' end",
            "payment_date": "o_orderdate",
        },
    ),
    "shipments": (
        "orders",
        {
            "shipment_id": "case when o_orderkey % 613 = 7 then o_orderkey - 1 else o_orderkey end",
            "order_id": "case when o_orderkey % 283 = 9 then 1000000000 + o_orderkey else o_orderkey end",
            "shipment_status": (
                "case when o_orderkey % 109 = 11 then 'LOST' when o_orderkey % 113 = 2 then null "
                "when o_orderstatus = 'F' then 'DELIVERED' when o_orderkey % 2 = 0 then 'SHIPPED' "
                "else 'IN_TRANSIT' end"
            ),
            "shipment_date": "case when o_orderstatus = 'P' then null else o_orderdate end",
        },
    ),
}


def order_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The ten order-domain tables."""
    return {
        name: table(spark, sf_dir, source).selectExpr(
            *[f"{expr} AS {column}" for column, expr in columns.items()]
        )
        for name, (source, columns) in ORDER_DOMAIN.items()
    }


def order_ctes(*names: str) -> str:
    """``WITH`` list entries for the checking engine; CTE names carry the prefix ``d_``."""
    return ",\n".join(
        f"d_{name} AS (SELECT "
        + ", ".join(f"{e} AS {c}" for c, e in ORDER_DOMAIN[name][1].items())
        + f" FROM {ORDER_DOMAIN[name][0]})"
        for name in (names or ORDER_DOMAIN)
    )


# ---- operations ------------------------------------------------------------------------------

METRIC = {
    "ts": "ts",
    "function_name": "concat('fn', cast(user_id % 4 as string))",
    "metric": (
        "case event_type when 'error' then 'Errors' when 'click' then 'Invocations' "
        "when 'view' then 'Duration' when 'purchase' then 'RecordsFailed' else 'QueueDepth' end"
    ),
    "value": (
        "case event_type when 'error' then cast(user_id % 2 as double) "
        "when 'click' then cast(1 + user_id % 7 as double) "
        "when 'view' then cast(event_id % 700 * 100 as double) "
        "when 'purchase' then cast(event_id % 13 as double) else cast(event_id % 2 as double) end"
    ),
}

QUALITY_METRIC = {
    "ts": "ts",
    "environment": "'dev'",
    "job_name": "concat('job', cast(user_id % 3 as string))",
    "metric": "case when event_type in ('error', 'click') then 'RowsQuarantined' else 'RowsRead' end",
    "value": (
        "case when event_type in ('error', 'click') then cast(event_id % 5 as double) "
        "else cast(event_id % 40 as double) end"
    ),
}

# Job runs and batches on one time line: signups are runs, views are batches.
RUN = {
    "job_name": "concat('job', cast(user_id % 3 as string))",
    "started": "ts",
    "run_id": "event_id",
    "source": "case when event_id % 2 = 0 then 'job' else 'query' end",
    "state": (
        "case event_id % 7 when 0 then 'FAILED' when 1 then 'RUNNING' when 2 then 'TIMEOUT' "
        "when 3 then 'CANCELLED' when 4 then 'STOPPED' else 'SUCCEEDED' end"
    ),
}
BATCH_EVENT = {
    "job_name": "concat('job', cast(user_id % 3 as string))",
    "batch_id": "concat('e', cast(event_id as string))",
    "raw_key": "concat('uploads/e', cast(event_id as string), '.csv')",
    "batch_ts": "ts",
}

LOG = {
    "event_id": "event_id",
    "value": (
        "case when event_type = 'view' then 'not a log line' else "
        "concat('{\"timestamp\": \"', substr(cast(ts as string), 1, 10), 'T', "
        "substr(cast(ts as string), 12, 8), 'Z\", \"pipeline\": \"batchlake\", \"stage\": \"loader\", "
        "\"batch_id\": \"e', cast(event_id as string), '\", \"status\": \"', "
        "case event_type when 'signup' then 'SUCCESS' when 'click' then 'SUCCESS' "
        "when 'error' then 'FAILED' else 'SKIPPED' end, "
        "'\", \"records_inserted\": ', cast(event_id % 50 as string), "
        "', \"records_updated\": ', cast(event_id % 9 as string), "
        "', \"records_failed\": ', cast(event_id % 3 as string), '}') end"
    ),
}


def _exprs(columns: dict[str, str]) -> list[str]:
    return [f"{e} AS {c}" for c, e in columns.items()]


def events(
    spark: SparkSession, sf_dir: str, columns: dict[str, str], where: str | None = None
) -> DataFrame:
    """The events table in one of the shapes above, timestamps in the session's zone."""
    rows = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return (rows.where(where) if where else rows).selectExpr(*_exprs(columns))


def events_sql(columns: dict[str, str], where: str | None = None) -> str:
    return f"SELECT {', '.join(_exprs(columns))} FROM events" + (f" WHERE {where}" if where else "")


def event_stream(spark: SparkSession, sf_dir: str, columns: dict[str, str]) -> DataFrame:
    """The same rows as a stream over the table's file."""
    schema = table(spark, sf_dir, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return rows.withColumn("ts", F.col("ts").cast("timestamp")).selectExpr(*_exprs(columns))
