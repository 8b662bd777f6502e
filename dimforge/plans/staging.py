"""Cleansed staging relations shared by the dimension and fact loads.

Each is defined once; the loads reuse them instead of re-stating the casts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import clean_lower, clean_upper, declared, or_unknown
from ..operators.dedupe import first_per_key, latest_per_key


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    """One cleansed row per real customer: the one with the smallest order-level id."""
    cleansed = raw_customers.select(
        "customer_unique_id",
        "customer_id",
        F.trim("customer_zip_code_prefix").alias("customer_zip_code"),
        clean_lower("customer_city").alias("customer_city"),
        clean_upper("customer_state").alias("customer_state"),
    )
    return first_per_key(cleansed, "customer_unique_id", ["customer_id"])


def stg_sellers(raw_sellers: DataFrame) -> DataFrame:
    return raw_sellers.select(
        "seller_id",
        F.trim("seller_zip_code_prefix").alias("seller_zip_code"),
        clean_lower("seller_city").alias("seller_city"),
        clean_upper("seller_state").alias("seller_state"),
    )


def stg_cat(raw_category_translation: DataFrame) -> DataFrame:
    return raw_category_translation.select(
        "product_category_name",
        clean_lower("product_category_name_english").alias("category_name_english"),
    )


PRODUCT_INT_COLS = {
    "product_name_length": "product_name_lenght",
    "product_description_length": "product_description_lenght",
    "product_photos_qty": "product_photos_qty",
    "product_weight_g": "product_weight_g",
    "product_length_cm": "product_length_cm",
    "product_height_cm": "product_height_cm",
    "product_width_cm": "product_width_cm",
}


def stg_products(raw_products: DataFrame, raw_category_translation: DataFrame) -> DataFrame:
    """Products with English category ('unknown' when missing) and integer measures.

    The translation is joined on the untrimmed source name, as the load always did;
    a translation listing a name twice would fan products out, so loads check it.
    """
    cat = stg_cat(raw_category_translation)
    typed = raw_products.select(
        "product_id", "product_category_name",
        *[declared(raw_products, src, "int").alias(dst) for dst, src in PRODUCT_INT_COLS.items()],
    )
    p = typed.alias("p").join(
        cat.alias("c"), F.col("p.product_category_name") == F.col("c.product_category_name"), "left"
    )
    return p.select(
        F.col("p.product_id").alias("product_id"),
        or_unknown(F.col("p.product_category_name")).alias("category_name"),
        or_unknown(F.col("c.category_name_english")).alias("category_name_english"),
        *PRODUCT_INT_COLS,
    )


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    """Orders with typed stage timestamps (NULL when a stage is missing or unparseable)."""
    return raw_orders.select(
        "order_id",
        "customer_id",
        "order_status",
        declared(raw_orders, "order_purchase_timestamp", "timestamp_ntz").alias("purchase_ts"),
        declared(raw_orders, "order_approved_at", "timestamp_ntz").alias("approved_ts"),
        declared(raw_orders, "order_delivered_carrier_date", "timestamp_ntz").alias("carrier_ts"),
        declared(raw_orders, "order_delivered_customer_date", "timestamp_ntz").alias("delivered_ts"),
        declared(raw_orders, "order_estimated_delivery_date", "timestamp_ntz").alias("estimated_ts"),
    )


def stg_items(raw_order_items: DataFrame) -> DataFrame:
    """Typed order items; rows whose price or freight is not a number are dropped."""
    typed = raw_order_items.select(
        "order_id",
        declared(raw_order_items, "order_item_id", "int").alias("order_item_id"),
        "product_id",
        "seller_id",
        declared(raw_order_items, "shipping_limit_date", "timestamp_ntz").alias("shipping_limit_date"),
        declared(raw_order_items, "price", "decimal(10,2)").alias("price"),
        declared(raw_order_items, "freight_value", "decimal(10,2)").alias("freight_value"),
    )
    return typed.where(F.col("price").isNotNull() & F.col("freight_value").isNotNull())


def item_rejects(raw_order_items: DataFrame) -> DataFrame:
    """(column_name, rejected): how many raw items have no number there and are dropped."""
    counts = raw_order_items.agg(*[F.count_if(declared(raw_order_items, c, "decimal(10,2)").isNull()).alias(c) for c in ("price", "freight_value")])
    return counts.select(F.expr("stack(2, 'price', price, 'freight_value', freight_value) AS (column_name, rejected)"))


def items_per_order(items: DataFrame) -> DataFrame:
    """Multi-item flag per order, from the cleansed items (one definition for both facts)."""
    return items.groupBy("order_id").agg((F.count(F.lit(1)) > 1).alias("is_multi_item"))


def customer_lookup(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.select("customer_id", "customer_unique_id")


def stg_reviews(raw_reviews: DataFrame) -> DataFrame:
    """Latest answer per review id (ties broken by order id, then score)."""
    typed = raw_reviews.select(
        "review_id",
        "order_id",
        declared(raw_reviews, "review_score", "int").alias("review_score"),
        declared(raw_reviews, "review_answer_timestamp", "timestamp_ntz").alias("answer_ts"),
    )
    latest = latest_per_key(typed, "review_id", "answer_ts", ["order_id", "review_score"])
    return latest.select("review_id", "order_id", "review_score")


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    """Review scores summed per order, so joining them cannot multiply item rows."""
    return reviews.groupBy("order_id").agg(
        F.sum("review_score").cast("long").alias("review_score_sum"),
        F.count("review_score").alias("review_score_n"),
    )
