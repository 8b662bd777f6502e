"""Raw Parquet sources: scans by declared columns, exposed as named views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import fits

# Raw view name -> file name of the original e-commerce dataset.
PARQUET_FILES = {
    "raw_customers": "olist_customers_dataset.parquet",
    "raw_order_items": "olist_order_items_dataset.parquet",
    "raw_payments": "olist_order_payments_dataset.parquet",
    "raw_reviews": "olist_order_reviews_dataset.parquet",
    "raw_orders": "olist_orders_dataset.parquet",
    "raw_products": "olist_products_dataset.parquet",
    "raw_sellers": "olist_sellers_dataset_city.parquet",
    "raw_category_translation": "product_category_name_translation.parquet",
}


# The columns of each raw relation that the loads read, and the kind each is
# declared as.  A file may store any of them as text; the loads cast it by rule.
RAW_COLUMNS = {
    "raw_customers": {
        "customer_id": "string", "customer_unique_id": "string", "customer_zip_code_prefix": "string",
        "customer_city": "string", "customer_state": "string",
    },
    "raw_sellers": {
        "seller_id": "string", "seller_zip_code_prefix": "string", "seller_city": "string", "seller_state": "string",
    },
    "raw_products": {
        "product_id": "string", "product_category_name": "string", "product_name_lenght": "int",
        "product_description_lenght": "int", "product_photos_qty": "int", "product_weight_g": "int",
        "product_length_cm": "int", "product_height_cm": "int", "product_width_cm": "int",
    },
    "raw_category_translation": {"product_category_name": "string", "product_category_name_english": "string"},
    "raw_orders": {
        "order_id": "string", "customer_id": "string", "order_status": "string",
        "order_purchase_timestamp": "timestamp_ntz", "order_approved_at": "timestamp_ntz",
        "order_delivered_carrier_date": "timestamp_ntz", "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz",
    },
    "raw_order_items": {
        "order_id": "string", "order_item_id": "int", "product_id": "string", "seller_id": "string",
        "shipping_limit_date": "timestamp_ntz", "price": "decimal(10,2)", "freight_value": "decimal(10,2)",
    },
    "raw_reviews": {
        "review_id": "string", "order_id": "string", "review_score": "int", "review_answer_timestamp": "timestamp_ntz",
    },
    "raw_payments": {
        "order_id": "string", "payment_sequential": "int", "payment_type": "string", "payment_installments": "int",
        "payment_value": "decimal(10,2)",
    },
}


class RawSchemaError(ValueError):
    """A raw file lacks a declared column or stores it as something else."""


def read_raw(spark: SparkSession, data_path: str, name: str) -> DataFrame:
    """Scan one raw file by its declared columns.

    The footer's schema is checked first: a column that is missing, or stored neither as text
    nor as its declared kind, is an error before any row is read.  Columns keep their stored
    type: text is cast by the loads' rules, typed columns are not cast at all, so filters on
    them and the choice of columns reach the scan."""
    path = f"{data_path.rstrip('/')}/{PARQUET_FILES[name]}"
    footer = spark.read.parquet(path)  # a missing path raises AnalysisException
    stored = dict(footer.dtypes)
    wrong = [c if c not in stored else f"{c} ({stored[c]})" for c, kind in RAW_COLUMNS[name].items() if c not in stored or not fits(stored[c], kind)]
    if wrong:
        raise RawSchemaError(f"{PARQUET_FILES[name]}: columns missing or of another kind: {', '.join(wrong)}")
    schema = T.StructType([T.StructField(c, footer.schema[c].dataType, True) for c in RAW_COLUMNS[name]])
    df = spark.read.schema(schema).parquet(path)
    # what is declared as text is text for the loads, whatever the file holds
    return df.select(*[
        F.col(c).cast("string").alias(c) if kind == "string" and stored[c] != "string" else F.col(c)
        for c, kind in RAW_COLUMNS[name].items()
    ])


def register_raw_views(spark: SparkSession, data_path: str) -> dict[str, DataFrame]:
    """Expose all raw files as temp views; a missing file is fatal before any work starts."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    missing = []
    for f in PARQUET_FILES.values():
        p = jvm.org.apache.hadoop.fs.Path(f"{data_path.rstrip('/')}/{f}")
        if not p.getFileSystem(conf).exists(p):
            missing.append(f)
    if missing:
        raise FileNotFoundError(f"raw files missing under {data_path}: {missing}")
    frames = {name: read_raw(spark, data_path, name) for name in PARQUET_FILES}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames
