"""Revenue by category and day, kept up to date by month.

An order is bought at one time, so its items lie on one day: numbers of distinct orders by day
and category add up over days, exactly, like the sums do.  The roll-up has a row for each day
and category; a refresh rebuilds the months that the run wrote to the item fact, and the months
with items of products that moved to another category.  A range of days then reads a few rows
a day instead of the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import cents, distinct_from, hundredths
from ..operators.joins import by_rows
from . import check_states, serving
from .publish import TableStore
from .reload import values

TABLE = "agg_category_day"


def by_day(items: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Distinct orders, items and sums of each day and category.  Items are summed by order
    first, so a hot day's rows are combined before the shuffle and none is expanded.  Money is
    summed in cents: longs stay small in the shuffles, where sums of decimals don't."""
    j = items.select("order_purchase_date", "order_id", "product_key", "price", "freight_value").join(
        by_rows(dim_product.select("product_key", "category_name_english")), "product_key")
    per_order = j.groupBy("order_purchase_date", "category_name_english", "order_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("price")).alias("revenue"), F.sum(cents("freight_value")).alias("freight"))
    return per_order.groupBy("order_purchase_date", "category_name_english").agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("n").alias("total_items"),
        hundredths(F.sum("revenue")).alias("total_revenue"), hundredths(F.sum("freight")).alias("total_freight"))


def _moved_products(store: TableStore) -> DataFrame | None:
    """Keys of products whose category this run changed."""
    old = store.read("dim_product")
    if old is None or "dim_product" not in store.pending or not store.pending["dim_product"]["written"]:
        return None
    new = check_states.current(store, "dim_product").select("product_key", F.col("category_name_english").alias("_new"))
    return old.join(by_rows(new), "product_key").where(distinct_from("category_name_english", "_new")).select("product_key")


def refresh(store: TableStore, version: str) -> DataFrame:
    """Bring the roll-up to the run's state of the item fact and the products."""
    fact = store.pending.get("fct_order_items") or store.entry("fct_order_items")
    there = store.entry(TABLE)["parts"]
    # months that the run wrote, months that are new to the roll-up, and those that have gone
    touched = set(fact["written"] if "fct_order_items" in store.pending else []) | (fact["parts"].keys() ^ there.keys())
    if (moved := _moved_products(store)) is not None:
        places = store.frame("fct_order_items", fact, with_partitions=True).select("product_key", "purchase_month")
        touched |= {f"purchase_month={m}" for m in values(places.join(moved, "product_key", "left_semi"), "purchase_month")}
    items = store.frame("fct_order_items", fact, labels=touched)
    return store.replace_parts(TABLE, by_day(items, check_states.current(store, "dim_product")) if touched else None, version, touched)


def revenue_by_category(rollup: DataFrame, date_from=None, date_to=None, limit: int = 20) -> DataFrame:
    """``serving.revenue_by_category`` from the roll-up."""
    days = serving.in_days(rollup, date_from, date_to)
    return serving.top_categories(days.groupBy("category_name_english").agg(
        F.sum("total_orders").alias("total_orders"), F.sum("total_items").alias("total_items"),
        F.sum("total_revenue").alias("revenue"),
        (F.sum("total_revenue") * 100).cast("long").alias("price_cents"),
        (F.sum("total_freight") * 100).cast("long").alias("freight_cents")), limit)
