"""Dimension loads: each takes the current table (or None on first load) and raw
relations, and returns the next state of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.keys import assign_keys, require_unique
from ..operators.merge import insert_if_absent, upsert
from ..operators.scd2 import scd2_apply
from ..sources import literals
from . import staging


def _current(spark: SparkSession, table: DataFrame | None, name: str) -> DataFrame:
    return table if table is not None else schemas.empty(spark, name)


def load_dim_date(spark, current=None) -> DataFrame:
    return insert_if_absent(_current(spark, current, "dim_date"), literals.date_spine(spark), "date_key")


def load_dim_payment_type(spark, current=None) -> DataFrame:
    return insert_if_absent(
        _current(spark, current, "dim_payment_type"), literals.payment_types(spark), "payment_type"
    )


def load_dim_order_flags(spark, current=None) -> DataFrame:
    """Junk dimension: every combination once; new ones keyed in (status, late, multi) order."""
    target = _current(spark, current, "dim_order_flags")
    key = ["order_status", "is_late_delivery", "is_multi_item"]
    new = literals.order_flag_combinations(spark).join(target.select(*key), key, "left_anti")
    offset = target.agg(F.max("order_flags_key")).first()[0] or 0
    keyed = assign_keys(new, "order_flags_key", key, offset=offset)
    return target.unionByName(keyed.select(*target.columns))


CUSTOMER_SET_COLS = ["customer_id", "customer_zip_code", "customer_city", "customer_state"]
SELLER_SET_COLS = ["seller_zip_code", "seller_city", "seller_state"]
SELLER_HIST_TYPE1 = ["seller_zip_code"]
SELLER_HIST_TYPE2 = ["seller_city", "seller_state"]


def load_dim_customer(spark, raw_customers, current=None) -> DataFrame:
    src = staging.stg_customers(raw_customers)
    return upsert(
        _current(spark, current, "dim_customer"), src, "customer_unique_id",
        CUSTOMER_SET_COLS, sk_col="customer_key", check_unique=False,  # one row per key by construction
    )


def load_dim_seller(spark, raw_sellers, current=None) -> DataFrame:
    src = staging.stg_sellers(raw_sellers)
    return upsert(
        _current(spark, current, "dim_seller"), src, "seller_id",
        SELLER_SET_COLS, sk_col="seller_key",
    )


PRODUCT_SET_COLS = [
    "category_name", "category_name_english", "product_name_length",
    "product_description_length", "product_photos_qty", "product_weight_g",
    "product_length_cm", "product_height_cm", "product_width_cm",
]


def load_dim_product(spark, raw_products, raw_category_translation, current=None) -> DataFrame:
    require_unique(raw_category_translation, "product_category_name", "category translation")
    src = staging.stg_products(raw_products, raw_category_translation)
    return upsert(
        _current(spark, current, "dim_product"), src, "product_id", PRODUCT_SET_COLS,
        sk_col="product_key",
    )


def load_dim_seller_hist(spark, raw_sellers, as_of, current=None) -> DataFrame:
    src = staging.stg_sellers(raw_sellers)
    return scd2_apply(
        _current(spark, current, "dim_seller_hist"), src, "seller_id",
        type1_cols=SELLER_HIST_TYPE1, type2_cols=SELLER_HIST_TYPE2,
        as_of=as_of, sk_col="seller_hist_key",
    )


PRODUCT_HIST_TYPE1 = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
PRODUCT_HIST_TYPE2 = ["category_name", "category_name_english"]


def load_dim_product_hist(spark, raw_products, raw_category_translation, as_of, current=None):
    src = staging.stg_products(raw_products, raw_category_translation)
    return scd2_apply(
        _current(spark, current, "dim_product_hist"), src, "product_id",
        type1_cols=PRODUCT_HIST_TYPE1, type2_cols=PRODUCT_HIST_TYPE2,
        as_of=as_of, sk_col="product_hist_key",
    )
