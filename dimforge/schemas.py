"""Typed schemas of the warehouse tables, their keys and physical layout.

Surrogate keys are LONG (INT would cap at 2^31 - 1 rows).  Spark does not enforce
primary, unique or foreign keys on Parquet; they are data-quality checks instead
(``plans.checks``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

L, I, S, B, D = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.DateType()
TS = T.TimestampNTZType()


def dec(p, s):
    return T.DecimalType(p, s)


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


SCHEMAS: dict[str, T.StructType] = {
    "dim_date": _schema(
        ("date_key", I, False), ("full_date", D, False), ("year", I, False),
        ("quarter", I, False), ("month", I, False), ("month_name", S, False),
        ("week_of_year", I, False), ("day_of_week", I, False), ("day_name", S, False),
        ("is_weekend", B, False),
    ),
    "dim_customer": _schema(
        ("customer_key", L, False), ("customer_unique_id", S, False), ("customer_id", S, False),
        ("customer_zip_code", S, True), ("customer_city", S, True), ("customer_state", S, True),
    ),
    "dim_seller": _schema(
        ("seller_key", L, False), ("seller_id", S, False), ("seller_zip_code", S, True),
        ("seller_city", S, True), ("seller_state", S, True),
    ),
    "dim_seller_hist": _schema(
        ("seller_hist_key", L, False), ("seller_id", S, False), ("seller_zip_code", S, True),
        ("seller_city", S, True), ("seller_state", S, True), ("scd_start_date", D, False),
        ("scd_end_date", D, True), ("is_current", B, False),
    ),
    "dim_product": _schema(
        ("product_key", L, False), ("product_id", S, False), ("category_name", S, True),
        ("category_name_english", S, True), ("product_name_length", I, True),
        ("product_description_length", I, True), ("product_photos_qty", I, True),
        ("product_weight_g", I, True), ("product_length_cm", I, True),
        ("product_height_cm", I, True), ("product_width_cm", I, True),
    ),
    "dim_product_hist": _schema(
        ("product_hist_key", L, False), ("product_id", S, False), ("category_name", S, True),
        ("category_name_english", S, True), ("product_weight_g", I, True),
        ("product_length_cm", I, True), ("product_height_cm", I, True),
        ("product_width_cm", I, True), ("scd_start_date", D, False), ("scd_end_date", D, True),
        ("is_current", B, False),
    ),
    "dim_payment_type": _schema(
        ("payment_type_key", I, False), ("payment_type", S, False), ("payment_type_desc", S, True),
    ),
    "dim_order_flags": _schema(
        ("order_flags_key", L, False), ("order_status", S, False),
        ("is_late_delivery", B, False), ("is_multi_item", B, False),
    ),
    "fct_order_items": _schema(
        ("order_item_key", L, False), ("order_date_key", I, False), ("customer_key", L, False),
        ("seller_key", L, False), ("product_key", L, False), ("order_flags_key", L, True),
        ("order_id", S, False), ("order_item_id", I, False), ("price", dec(10, 2), False),
        ("freight_value", dec(10, 2), False), ("total_item_value", dec(10, 2), False),
        ("shipping_limit_date", TS, True), ("order_purchase_date", D, False),
    ),
    "fct_order_lifecycle": _schema(
        ("order_lifecycle_key", L, False), ("purchase_date_key", I, True),
        ("approved_date_key", I, True), ("carrier_date_key", I, True),
        ("delivered_date_key", I, True), ("estimated_date_key", I, True),
        ("customer_key", L, False), ("order_flags_key", L, True), ("order_id", S, False),
        ("approval_delay_hours", dec(10, 2), True), ("carrier_pickup_delay_hours", dec(10, 2), True),
        ("delivery_delay_days", dec(10, 2), True), ("vs_estimated_days", dec(10, 2), True),
        ("order_purchase_date", D, False),
    ),
    "fct_seller_monthly_snapshot": _schema(
        ("snapshot_key", L, False), ("snapshot_month_key", I, False), ("seller_key", L, False),
        ("total_orders", I, False), ("total_items_sold", I, False),
        ("total_revenue", dec(12, 2), False), ("total_freight", dec(12, 2), False),
        ("avg_review_score", dec(4, 2), True), ("avg_delivery_delay_days", dec(8, 2), True),
        ("snapshot_year_month", S, False),
    ),
    # our own roll-up of the item fact
    "agg_category_day": _schema(
        ("order_purchase_date", D, False), ("category_name_english", S, True), ("total_orders", L, False),
        ("total_items", L, False), ("total_revenue", dec(38, 2), False), ("total_freight", dec(38, 2), False),
    ),
    "dqc_results": _schema(
        ("run_timestamp", TS, False), ("layer", S, False), ("table_name", S, False),
        ("check_name", S, False), ("status", S, False), ("failed_count", L, False),
        ("note", S, True),
    ),
}

DIMENSIONS = [
    "dim_date", "dim_customer", "dim_seller", "dim_seller_hist", "dim_product",
    "dim_product_hist", "dim_payment_type", "dim_order_flags",
]
FACTS = ["fct_order_items", "fct_order_lifecycle", "fct_seller_monthly_snapshot"]
WAREHOUSE_TABLES = DIMENSIONS + FACTS

# Physical layout used when a table is published: (partition columns, derived from,
# sort-within-partition columns).  Facts are partitioned by calendar month; days are
# pruned by Parquet min/max statistics on the sorted date column.
LAYOUT = {
    "fct_order_items": (["purchase_month"], "order_purchase_date", ["order_purchase_date", "customer_key"]),
    "fct_order_lifecycle": (["purchase_month"], "order_purchase_date", ["order_id"]),
    "fct_seller_monthly_snapshot": (["snapshot_year_month"], None, ["seller_key"]),
    "agg_category_day": (["purchase_month"], "order_purchase_date", ["order_purchase_date"]),
    "dim_seller_hist": ([], None, ["seller_id", "is_current"]),
    "dim_product_hist": ([], None, ["product_id", "is_current"]),
}


# The business key of each table and its surrogate key.
KEYS = {
    "dim_customer": (["customer_unique_id"], "customer_key"),
    "dim_seller": (["seller_id"], "seller_key"),
    "dim_seller_hist": (["seller_id"], "seller_hist_key"),
    "dim_product": (["product_id"], "product_key"),
    "dim_product_hist": (["product_id"], "product_hist_key"),
    "fct_order_items": (["order_id", "order_item_id"], "order_item_key"),
    "fct_order_lifecycle": (["order_id"], "order_lifecycle_key"),
    "fct_seller_monthly_snapshot": (["seller_key", "snapshot_year_month"], "snapshot_key"),
}


def schema_of(name: str) -> T.StructType:
    """The declared schema of a table, or of the side table ``keys_<fact>``."""
    if name in SCHEMAS:
        return SCHEMAS[name]
    fact = name.removeprefix("keys_")
    key, sk = KEYS[fact]
    return T.StructType([T.StructField(c, SCHEMAS[fact][c].dataType, False) for c in [*key, sk]])


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], schema_of(name))


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select and cast ``df`` to the table's declared columns and types (store assignment)."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema_of(name).fields])
