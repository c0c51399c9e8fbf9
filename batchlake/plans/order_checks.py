"""The integrity suite of the ten-table order schema, and its ad-hoc violation lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlake.operators import checks
from batchlake.operators.checks import Suite, Tables

TOLERANCE = 0.01

# What the suite checks.
PRIMARY_KEYS = [
    ("regions", "region_id"),
    ("customers", "customer_id"),
    ("suppliers", "supplier_id"),
    ("products", "product_id"),
    ("inventory", "inventory_id"),
    ("employees", "employee_id"),
    ("orders", "order_id"),
    ("order_items", "order_item_id"),
    ("payments", "payment_id"),
    ("shipments", "shipment_id"),
]
FOREIGN_KEYS = [
    ("customers", "region_id", "regions", "region_id"),
    ("suppliers", "region_id", "regions", "region_id"),
    ("products", "supplier_id", "suppliers", "supplier_id"),
    ("inventory", "product_id", "products", "product_id"),
    ("employees", "manager_id", "employees", "employee_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("orders", "employee_id", "employees", "employee_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("shipments", "order_id", "orders", "order_id"),
]
NOT_NULL = [
    ("regions", "region_name"),
    ("regions", "region_code"),
    ("customers", "customer_name"),
    ("customers", "email"),
    ("products", "product_name"),
    ("products", "product_code"),
    ("products", "unit_price"),
    ("employees", "first_name"),
    ("employees", "last_name"),
    ("employees", "email"),
    ("orders", "order_number"),
    ("orders", "customer_id"),
    ("order_items", "order_id"),
    ("order_items", "product_id"),
    ("order_items", "quantity"),
    ("payments", "order_id"),
    ("payments", "payment_amount"),
]
CHECKSUM_KEYS = {
    "regions": "region_id",
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
}
DATE_COLUMNS = {
    "orders": "order_date",
    "payments": "payment_date",
    "shipments": "shipment_date",
}
KPIS = {
    "customers": {"Total Customers": "true", "Active Customers": "customer_status = 'ACTIVE'"},
    "orders": {
        "Total Orders": "true",
        "Completed Orders": "order_status IN ('SHIPPED', 'DELIVERED')",
    },
    "products": {"Total Products": "true", "Active Products": "discontinued = 'N'"},
    "order_items": {"Total Order Items": "true"},
    "payments": {"Total Payments": "true", "Completed Payments": "payment_status = 'COMPLETED'"},
}
FINANCIALS = {
    "orders": (
        "",
        {
            "Total Order Value": "order_total",
            "Total Tax Amount": "tax_amount",
            "Total Shipping Cost": "shipping_cost",
        },
    ),
    "payments": (
        "payment_status = 'COMPLETED'",
        {"Total Payments Received": "payment_amount"},
    ),
}

_LINE = "quantity * unit_price * (1 - coalesce(discount_pct, 0) / 100)"


def order_total_mismatch(t: Tables) -> DataFrame:
    """Orders whose total is not the sum of their lines, largest difference first."""
    orders = t["orders"].select("order_id", "order_number", "order_total")
    out = checks.reconcile(orders, t["order_items"], "order_id", "order_total", "line_total")
    return out.withColumnRenamed("order_total", "stored_total").orderBy(
        F.abs("difference").desc(), "order_id"
    )


def payment_mismatch(t: Tables) -> DataFrame:
    """Completed payments that do not equal order total + tax + shipping."""
    paid = t["payments"].where("payment_status = 'COMPLETED'")
    due = t["orders"].select(
        "order_id",
        "order_number",
        (F.col("order_total") + F.col("tax_amount") + F.col("shipping_cost")).alias(
            "expected_amount"
        ),
    )
    return (
        paid.select("payment_id", "order_id", "payment_amount")
        .join(due, "order_id")
        .withColumn("difference", F.col("payment_amount") - F.col("expected_amount"))
        .where(F.abs("difference") > TOLERANCE)
    )


def line_total_mismatch(t: Tables) -> DataFrame:
    """Lines whose total is not quantity x price less discount, rounded to cents."""
    exact = F.expr(_LINE).cast("decimal(18,6)")
    return (
        t["order_items"]
        .withColumn("calculated_line_total", F.round(exact, 2))
        .withColumn("difference", F.col("line_total") - F.col("calculated_line_total"))
        .where(F.abs("difference") > TOLERANCE)
        .select(
            "order_item_id",
            "order_id",
            "quantity",
            "unit_price",
            "discount_pct",
            F.col("line_total").alias("stored_line_total"),
            "calculated_line_total",
            "difference",
        )
    )


def inventory_mismatch(t: Tables) -> DataFrame:
    """Stock rows whose available quantity is not on hand less reserved."""
    expected = F.col("quantity_on_hand") - F.col("quantity_reserved")
    return (
        t["inventory"]
        .withColumn("calculated_available", expected)
        .withColumn("difference", F.col("quantity_available") - expected)
        .where("difference != 0")
        .select(
            "inventory_id",
            "product_id",
            "quantity_on_hand",
            "quantity_reserved",
            "quantity_available",
            "calculated_available",
            "difference",
        )
    )


def negative_inventory(t: Tables) -> DataFrame:
    return t["inventory"].where(
        "quantity_on_hand < 0 OR quantity_reserved < 0 OR quantity_available < 0"
    )


def negative_prices(t: Tables) -> DataFrame:
    return t["products"].where("unit_price < 0 OR cost_price < 0")


def status_mismatch(t: Tables) -> DataFrame:
    """Orders whose shipment contradicts their status, per pair of shipment and payment status with
    the number of such pairs (``occurrences``).

    An order without shipment is consistent. Shipments and payments are counted per order and
    status first, so an order with very many of them is a handful of rows.
    """

    def per_status(table: str, status: str, n: str) -> DataFrame:
        return t[table].groupBy("order_id", status).agg(F.count(F.lit(1)).alias(n))

    orders = (
        t["orders"]
        .where("order_status IN ('DELIVERED', 'SHIPPED')")
        .select("order_id", "order_number", "order_status")
    )
    wrong = orders.join(per_status("shipments", "shipment_status", "_s"), "order_id").where(
        "(order_status = 'DELIVERED' AND shipment_status != 'DELIVERED') OR "
        "(order_status = 'SHIPPED' AND "
        "shipment_status NOT IN ('SHIPPED', 'IN_TRANSIT', 'DELIVERED'))"
    )
    paid = wrong.join(per_status("payments", "payment_status", "_p"), "order_id", "left")
    # An order id may repeat, so the pairs are summed per row of the result.
    return paid.groupBy(
        "order_id", "order_number", "order_status", "payment_status", "shipment_status"
    ).agg(F.sum(F.col("_s") * F.coalesce("_p", F.lit(1))).alias("occurrences"))


SUITE = Suite(
    primary_keys=PRIMARY_KEYS,
    foreign_keys=FOREIGN_KEYS,
    not_null=NOT_NULL,
    predicates={
        "Inventory quantities are non-negative": (
            "inventory",
            "quantity_on_hand < 0 OR quantity_reserved < 0",
        ),
        "Available inventory calculation correct": (
            "inventory",
            "quantity_available != (quantity_on_hand - quantity_reserved)",
        ),
        "Order line totals calculated correctly": (
            "order_items",
            f"abs(line_total - {_LINE}) > {TOLERANCE}",
        ),
    },
    custom={
        # The suite only counts, so neither the sort nor the extra columns of the lists are needed.
        "Order totals match line items": lambda t: checks.reconcile(
            t["orders"].select("order_id", "order_total"),
            t["order_items"],
            "order_id",
            "order_total",
            "line_total",
        ),
        "Payment amounts match order totals": payment_mismatch,
    },
)
