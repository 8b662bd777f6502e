"""Registered queries of loads into published tables: a first load from an earlier state of the
raw relations, then a batch, through the manifest of parts.

The earlier states are derived from the given tables by the rules in each docstring.
``plans.oracle_loads`` holds the matching SQL.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections import ChainMap
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.exprs import declared
from ..operators.joins import batch
from ..operators.keys import ensure_checkpoint_dir, rejects, written
from ..operators.merge import insert_if_absent, replace_by_key, upsert
from ..operators.scd2 import scd2_apply
from ..sources.raw import PARQUET_FILES, RAW_COLUMNS, register_raw_views
from . import catalog, dims, facts, rollup, serving, staging
from .keyed import apply_history, upsert_buckets
from .pipeline import run_pipeline
from .publish import TableStore
from .reload import reload_fact

#: Months that the second batches cover.
MONTHS = ("2016-03", "2017-11")
FIRST_AS_OF = dt.date(2020, 1, 1)


def _store(spark) -> TableStore:
    return TableStore(spark, f"{ensure_checkpoint_dir(spark)}/warehouse-{uuid.uuid4().hex}")


def _run(store: TableStore, load) -> None:
    version = store.next_version("q")
    load(version)
    store.commit(version, list(store.pending))


def _number(column) -> F.Column:
    """The number in ids such as or12, se7, cu3."""
    return F.substring(column, F.lit(3), F.length(column)).cast("long")


def _in_months(raw: Mapping) -> DataFrame:
    return raw["raw_orders"].where(F.substring("order_purchase_timestamp", 1, 7).isin(*MONTHS))


def _ids_in_months(raw: Mapping) -> DataFrame:
    return batch(written(_in_months(raw).select("order_id")))


def _changed(raw: Mapping, **relations) -> Mapping:
    """``raw`` with other relations in place of some; those that no load reads aren't derived."""
    return ChainMap(relations, raw)


def _batch(raw: Mapping) -> Mapping:
    """The orders of MONTHS, their items, and all other relations."""
    items = raw["raw_order_items"].join(_ids_in_months(raw), "order_id", "left_semi")
    return _changed(raw, raw_orders=_in_months(raw), raw_order_items=items)


def _earlier_items(raw: Mapping, missing) -> Mapping:
    """Items of MONTHS carry no freight yet, and those for which ``missing`` holds aren't there."""
    marked = raw["raw_order_items"].join(_ids_in_months(raw).withColumn("_in", F.lit(True)), "order_id", "left")
    late = F.coalesce("_in", F.lit(False))
    kept = marked.where(~(late & missing)).withColumn("freight_value", F.when(late, "0.00").otherwise(F.col("freight_value")))
    return _changed(raw, raw_order_items=kept.drop("_in"))


def second_load_items(spark, sf_dir):
    """MONTHS reloaded; at the first load their second items were missing and freight was 0."""
    w, store = catalog._w(spark, sf_dir), _store(spark)
    for raw in (_earlier_items(w.raw, F.trim("order_item_id") == "2"), _batch(w.raw)):
        _run(store, lambda v: reload_fact(store, "fct_order_items", facts.build_order_items(raw, w.dims()), facts.item_scope(raw), "order_id", v))
    return store.read("fct_order_items")


def second_load_lifecycle(spark, sf_dir):
    """MONTHS reloaded; at the first load every fourth order of them was missing and none was
    approved."""
    w, store = catalog._w(spark, sf_dir), _store(spark)
    late = F.coalesce(F.substring("order_purchase_timestamp", 1, 7).isin(*MONTHS), F.lit(False))
    earlier = w.raw["raw_orders"].where(~(late & (_number("order_id") % 4 == 0))).withColumn(
        "order_approved_at", F.when(~late, F.col("order_approved_at")))
    for raw in (_changed(w.raw, raw_orders=earlier), _batch(w.raw)):
        _run(store, lambda v: reload_fact(store, "fct_order_lifecycle", facts.build_order_lifecycle(raw, w.dims()), facts.order_scope(raw), "order_id", v))
    return store.read("fct_order_lifecycle")


def second_load_snapshot(spark, sf_dir):
    """MONTHS rebuilt; at the first load every fifth seller had no items in them."""
    w, store = catalog._w(spark, sf_dir), _store(spark)
    for raw in (_earlier_items(w.raw, _number("seller_id") % 5 == 0), _batch(w.raw)):
        _run(store, lambda v: reload_fact(
            store, "fct_seller_monthly_snapshot", facts.build_seller_monthly_snapshot(raw, w.dims()),
            facts.snapshot_months(raw["raw_orders"]), "snapshot_year_month", v))
    return store.read("fct_seller_monthly_snapshot")


def pipeline_second_run(spark, sf_dir):
    """Rows of each table after a whole run and one with the orders of MONTHS, and how many
    parts the second run wrote and its checks scanned."""
    w = catalog._w(spark, sf_dir)
    root = _store(spark).root
    run_pipeline(spark, w.raw, root, catalog.AS_OF, catalog.RUN_TS_1)
    second = run_pipeline(spark, _batch(w.raw), root, catalog.AS_OF, catalog.RUN_TS_2)
    parts = [(t, len(second["written"][t]), len(second["scanned"][t])) for t in schemas.WAREHOUSE_TABLES]
    return second["row_counts"].join(spark.createDataFrame(parts, "table_name string, written long, scanned long"), "table_name")


def pipeline_dqc(spark, sf_dir):
    """The results of the checks after a second run, from the states of the parts."""
    w = catalog._w(spark, sf_dir)
    root = _store(spark).root
    run_pipeline(spark, w.raw, root, catalog.AS_OF, catalog.RUN_TS_1)
    second = run_pipeline(spark, _batch(w.raw), root, catalog.AS_OF, catalog.RUN_TS_2)
    return second["dqc"].where("layer <> 'ext'").drop("run_timestamp")


def _rolled_up(spark, sf_dir) -> DataFrame:
    """The roll-up after two runs: MONTHS had other items and every third product another
    category at the first."""
    w, store = catalog._w(spark, sf_dir), _store(spark)
    products = w.raw["raw_products"]
    earlier = products.withColumn("product_category_name", F.when(_number("product_id") % 3 == 0, "legacy").otherwise(F.col("product_category_name")))
    for raw, names in ((_earlier_items(w.raw, F.trim("order_item_id") == "2"), earlier), (_batch(w.raw), products)):
        rows = staging.stg_products(names, w.raw["raw_category_translation"])

        def load(v):
            upsert_buckets(store, "dim_product", rows, dims.PRODUCT_SET_COLS, v)
            reload_fact(store, "fct_order_items", facts.build_order_items(raw, w.dims()), facts.item_scope(raw), "order_id", v)
            rollup.refresh(store, v)

        _run(store, load)
    return store.read(rollup.TABLE, with_partitions=True)


def revenue_from_rollup(spark, sf_dir):
    return rollup.revenue_by_category(_rolled_up(spark, sf_dir))


def revenue_from_rollup_range(spark, sf_dir):
    return rollup.revenue_by_category(_rolled_up(spark, sf_dir), date_from="2016-03-01", date_to="2019-06-30", limit=3)


def upsert_buckets_customer(spark, sf_dir):
    """Customers by bucket; the first load lacked every fourth and had every third one's city
    wrong."""
    w, store = catalog._w(spark, sf_dir), _store(spark)
    src = staging.stg_customers(w.raw["raw_customers"])
    n = _number("customer_unique_id")
    earlier = src.where(n % 4 != 0).withColumn("customer_city", F.when(n % 3 == 0, "old city").otherwise(F.col("customer_city")))
    for rows in (earlier, src):
        _run(store, lambda v: upsert_buckets(store, "dim_customer", rows, dims.CUSTOMER_SET_COLS, v))
    return store.read("dim_customer")


def _earlier_sellers(src):
    n = _number("seller_id")
    return src.where(n % 4 != 0).select(
        "seller_id",
        F.when(n % 5 == 0, "00000").otherwise(F.col("seller_zip_code")).alias("seller_zip_code"),
        F.when(n % 3 == 0, "old town").otherwise(F.col("seller_city")).alias("seller_city"),
        "seller_state",
    )


def scd2_buckets_seller(spark, sf_dir):
    """Seller history by bucket; as of FIRST_AS_OF every fourth seller was missing, every third
    lived in another city and every fifth had another zip code."""
    w, store = catalog._w(spark, sf_dir), _store(spark)
    src = staging.stg_sellers(w.raw["raw_sellers"])
    for rows, day in ((_earlier_sellers(src), FIRST_AS_OF), (src, catalog.AS_OF)):
        _run(store, lambda v: apply_history(store, "dim_seller_hist", rows, dims.SELLER_HIST_TYPE1, dims.SELLER_HIST_TYPE2, day, v))
    return store.read("dim_seller_hist")


def _with_null_keys(rows: DataFrame, key: str) -> DataFrame:
    """Every seventh row twice, once without its key."""
    return rows.unionByName(rows.where(_number(key) % 7 == 0).withColumn(key, F.lit(None).cast("string")))


def insert_null_keys_rerun(spark, sf_dir):
    """Rows without a key don't go in, at no run."""
    w = catalog._w(spark, sf_dir)
    old = catalog._old_products(w)
    src = _with_null_keys(staging.stg_products(w.raw["raw_products"], w.raw["raw_category_translation"]).select(*old.columns), "product_id")
    return insert_if_absent(insert_if_absent(old, src, "product_id"), src, "product_id")


def upsert_null_keys_rerun(spark, sf_dir):
    w = catalog._w(spark, sf_dir)
    target = catalog._old_dim(w.dim_seller, "seller_key", "seller_state", "OLD")
    src = _with_null_keys(staging.stg_sellers(w.raw["raw_sellers"]), "seller_id")
    for _ in range(2):
        target = upsert(target, src, "seller_id", dims.SELLER_SET_COLS, sk_col="seller_key")
    return target


def scd2_null_keys_rerun(spark, sf_dir):
    hist, src = catalog._seller_hist_case(catalog._w(spark, sf_dir))
    src = _with_null_keys(src, "seller_id")
    for _ in range(2):
        hist = scd2_apply(hist, src, as_of=catalog.AS_OF, sk_col="seller_hist_key", **catalog.SELLER_SCD)
    return hist


def replace_null_keys_rerun(spark, sf_dir):
    """Reloading all orders twice, with rows that lack their natural key in the batch."""
    w = catalog._w(spark, sf_dir)
    fresh = _with_null_keys(facts.build_order_lifecycle(w.raw, w.dims(), w.orders), "order_id")
    target = w.fct_order_lifecycle
    for _ in range(2):
        target = replace_by_key(target, fresh, w.raw["raw_orders"].select("order_id"), "order_id", ["order_id"], "order_lifecycle_key")
    return schemas.conform(target, "fct_order_lifecycle")


def key_rejects(spark, sf_dir):
    """How many rows of a batch lack their key."""
    w = catalog._w(spark, sf_dir)
    sellers = rejects(_with_null_keys(staging.stg_sellers(w.raw["raw_sellers"]), "seller_id"), "seller_id")
    items = staging.stg_items(w.raw["raw_order_items"]).withColumn("order_item_id", F.when(F.col("order_item_id") != 3, F.col("order_item_id")))
    return sellers.unionByName(rejects(_with_null_keys(items, "order_id"), ["order_id", "order_item_id"]))


def raw_files(spark, raw: dict, folder: str) -> str:
    """The raw relations as files of the original's names: stand-in input, typed where the rules
    read numbers and times, products all text."""
    for name, columns in RAW_COLUMNS.items():
        if name in raw:
            df = raw[name].select(*[c if name == "raw_products" else declared(raw[name], c, k).alias(c) if k != "string" else c for c, k in columns.items()])
        else:  # payments: a view that no load reads
            df = spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in columns.items()))
        df.write.mode("overwrite").parquet(f"{folder}/{PARQUET_FILES[name]}")
    return folder


def load_from_files(spark, sf_dir):
    """The item fact's rows from raw files: orders, items and reviews stored typed, products as
    text."""
    w = catalog._w(spark, sf_dir)
    views = register_raw_views(spark, raw_files(spark, w.raw, f"{ensure_checkpoint_dir(spark)}/raw-{uuid.uuid4().hex}"))
    out = facts.build_order_items(views, w.dims())
    products = staging.stg_products(views["raw_products"], views["raw_category_translation"])
    names = products.join(w.dim_product.select("product_id", "product_key"), "product_id").select("product_key", "category_name_english")
    return out.join(names, "product_key").drop("shipping_limit_date")


def snapshot_outcomes(spark, sf_dir):
    """Every second supplier number, up to twice the highest: sellers found, without months, and
    not found."""
    w = catalog._w(spark, sf_dir)
    ids = catalog._table(spark, sf_dir, "supplier").select(F.concat(F.lit("se"), (F.col("s_suppkey") * 2).cast("string")).alias("seller_id"))
    month = w.fct_seller_monthly_snapshot.where(F.col("snapshot_year_month") == MONTHS[0])
    return serving.snapshot_outcomes(month, w.dim_seller, ids)


QUERIES = {f.__name__: f for f in (
    second_load_items, second_load_lifecycle, second_load_snapshot, pipeline_second_run, pipeline_dqc,
    upsert_buckets_customer, scd2_buckets_seller, insert_null_keys_rerun, upsert_null_keys_rerun,
    scd2_null_keys_rerun, replace_null_keys_rerun, key_rejects, load_from_files, snapshot_outcomes,
    revenue_from_rollup, revenue_from_rollup_range,
)}
