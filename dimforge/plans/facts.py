"""Fact loads: transaction, accumulating snapshot and periodic snapshot.

``build_*`` return the fresh fact rows from raw relations and the current
dimensions; ``load_*`` apply them to the current fact table idempotently
(replace by order, or by month), keeping surrogate keys reproducible.

Join order is chosen for scale: orders are resolved to customer keys at order
grain before they meet the (larger) item stream; items, orders and the per-order
item counts all join on ``order_id`` so they share one partitioning; the junk
dimension has a fixed 32 rows and is always broadcast; the other dimensions are
left to AQE, which broadcasts them only when their measured size is under the
threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.exprs import cents, date_key, declared, hundredths, minutes_between, round_ratio
from ..operators.joins import by_rows
from ..operators.merge import replace_by_key
from ..operators.keys import assign_keys, written
from . import staging
from .reload import reload_fact

FLAG_KEY = ["order_status", "is_late_delivery", "is_multi_item"]


def _is_late():
    delivered, estimated = F.col("delivered_ts"), F.col("estimated_ts")
    # Three-valued on purpose: NULL (no match in the junk dimension) when the
    # order was delivered but has no estimate.
    return delivered.isNotNull() & (delivered > estimated)


def _flags(dim_order_flags: DataFrame) -> DataFrame:
    # Junk dimension: 8 statuses x 2 x 2 rows by construction, so broadcasting it is bounded.
    return F.broadcast(dim_order_flags.select("order_flags_key", *FLAG_KEY))


def resolved_orders(raw_orders, raw_customers, dim_customer) -> DataFrame:
    """Orders with a purchase time, resolved to the real customer's surrogate key."""
    return _with_customer(bought_orders(raw_orders), raw_customers, dim_customer)


def bought_orders(raw_orders) -> DataFrame:
    return staging.stg_orders(raw_orders).where(F.col("purchase_ts").isNotNull())


def _with_customer(o, raw_customers, dim_customer) -> DataFrame:
    cl = staging.customer_lookup(raw_customers)
    dc = dim_customer.select("customer_unique_id", "customer_key")
    return o.join(by_rows(cl), "customer_id").join(by_rows(dc), "customer_unique_id").drop("customer_unique_id")


STAGES = ["purchase_ts", "approved_ts", "carrier_ts", "delivered_ts", "estimated_ts"]


def order_grain(raw: dict, dims: dict) -> DataFrame:
    """Whatever an order decides, on the order: its customer's key, its flags' key, its stage
    times.  Both order facts start from these rows; a build of both may write them once.

    The item counts come first and the customers, joined on other keys, last: a later join on
    ``order_id`` has its own exchanges and AQE can split an order that holds a large share of
    the items."""
    ipo = staging.items_per_order(staging.stg_items(raw["raw_order_items"]))
    orders = bought_orders(raw["raw_orders"]).join(ipo, "order_id", "left")
    return (
        _with_customer(orders, raw["raw_customers"], dims["dim_customer"])
        .withColumn("is_late_delivery", _is_late())
        .withColumn("is_multi_item", F.coalesce(F.col("is_multi_item"), F.lit(False)))
        .join(_flags(dims["dim_order_flags"]), FLAG_KEY, "left")
        .select("order_id", "customer_key", "order_flags_key", *STAGES)
    )


def build_order_items(raw: dict, dims: dict, orders: DataFrame | None = None) -> DataFrame:
    """Fresh item rows.  ``orders``: the rows of ``order_grain``, if they stand ready."""
    items = staging.stg_items(raw["raw_order_items"])
    # one join on order_id is left at item grain
    orders = order_grain(raw, dims) if orders is None else orders
    j = (
        items
        .join(orders.select("order_id", "customer_key", "order_flags_key", "purchase_ts"), "order_id")
        .join(by_rows(dims["dim_seller"].select("seller_id", "seller_key")), "seller_id")
        .join(by_rows(dims["dim_product"].select("product_id", "product_key")), "product_id")
    )
    return j.select(
        date_key("purchase_ts").alias("order_date_key"),
        "customer_key", "seller_key", "product_key", "order_flags_key",
        "order_id", "order_item_id", "price", "freight_value",
        (F.col("price") + F.col("freight_value")).cast("decimal(10,2)").alias("total_item_value"),
        "shipping_limit_date",
        F.col("purchase_ts").cast("date").alias("order_purchase_date"),
    )


def _load(current, fresh, scope, scope_col, natural_key, sk_col, name, spark):
    target = current if current is not None else schemas.empty(spark, name)
    if current is None:
        out = assign_keys(fresh, sk_col, natural_key)
    else:
        out = replace_by_key(target, fresh, scope, scope_col, natural_key, sk_col)
    return schemas.conform(out, name)


def item_scope(raw: dict) -> DataFrame:
    return raw["raw_order_items"].select("order_id")


def order_scope(raw: dict) -> DataFrame:
    return raw["raw_orders"].select("order_id")


def load_order_items(spark, raw: dict, dims: dict, current=None, orders=None) -> DataFrame:
    fresh = build_order_items(raw, dims, orders)
    scope = item_scope(raw)
    return _load(current, fresh, scope, "order_id", ["order_id", "order_item_id"],
                 "order_item_key", "fct_order_items", spark)


def build_order_lifecycle(raw: dict, dims: dict, orders: DataFrame | None = None) -> DataFrame:
    """Fresh lifecycle rows.  ``orders``: the rows of ``order_grain``, if they stand ready."""
    j = order_grain(raw, dims) if orders is None else orders
    p, a, c = F.col("purchase_ts"), F.col("approved_ts"), F.col("carrier_ts")
    d, e = F.col("delivered_ts"), F.col("estimated_ts")
    return j.select(
        date_key(p).alias("purchase_date_key"),
        date_key(a).alias("approved_date_key"),
        date_key(c).alias("carrier_date_key"),
        date_key(d).alias("delivered_date_key"),
        date_key(e).alias("estimated_date_key"),
        "customer_key", "order_flags_key", "order_id",
        round_ratio(minutes_between(p, a), F.lit(60)).alias("approval_delay_hours"),
        round_ratio(minutes_between(a, c), F.lit(60)).alias("carrier_pickup_delay_hours"),
        round_ratio(minutes_between(c, d), F.lit(1440)).alias("delivery_delay_days"),
        round_ratio(minutes_between(e, d), F.lit(1440)).alias("vs_estimated_days"),
        p.cast("date").alias("order_purchase_date"),
    )


def load_order_lifecycle(spark, raw: dict, dims: dict, current=None, orders=None) -> DataFrame:
    fresh = build_order_lifecycle(raw, dims, orders)
    scope = order_scope(raw)
    return _load(current, fresh, scope, "order_id", ["order_id"],
                 "order_lifecycle_key", "fct_order_lifecycle", spark)


def build_seller_monthly_snapshot(raw: dict, dims: dict) -> DataFrame:
    items = staging.stg_items(raw["raw_order_items"])
    orders = staging.stg_orders(raw["raw_orders"]).where(F.col("purchase_ts").isNotNull())
    reviews = staging.reviews_per_order(staging.stg_reviews(raw["raw_reviews"]))
    # Items are summed by order and seller first (partial sums, so a hot order is a row for each
    # of its sellers) and reviews meet orders at order grain.  Money is summed in cents: longs
    # stay small in the shuffles, where sums of decimals don't.
    sold = items.groupBy("order_id", "seller_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("price")).alias("price"), F.sum(cents("freight_value")).alias("freight"))
    reviewed = orders.select("order_id", "purchase_ts", "delivered_ts", "estimated_ts").join(
        reviews, "order_id", "left")
    base = (
        sold.join(reviewed, "order_id")
        .join(dims["dim_seller"].select("seller_id", "seller_key"), "seller_id")
        .select(
            "seller_key", "n", "price", "freight", "review_score_sum", "review_score_n",
            F.trunc(F.col("purchase_ts").cast("date"), "month").alias("snap_month"),
            minutes_between("estimated_ts", "delivered_ts").alias("vs_minutes"),
        )
    )
    # an order has one month, so a seller's rows of a month are its orders
    agg = base.groupBy("seller_key", "snap_month").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("n").alias("total_items_sold"),
        F.sum("price").alias("total_revenue"),
        F.sum("freight").alias("total_freight"),
        F.sum(F.col("review_score_sum") * F.col("n")).alias("rs_sum"),
        F.sum(F.col("review_score_n") * F.col("n")).alias("rs_n"),
        F.sum(F.col("vs_minutes") * F.col("n")).alias("vs_sum"),
        F.sum(F.when(F.col("vs_minutes").isNotNull(), F.col("n")).otherwise(0)).alias("vs_n"),
    )
    return agg.select(
        date_key("snap_month").alias("snapshot_month_key"),
        "seller_key",
        F.col("total_orders").cast("int").alias("total_orders"),
        F.col("total_items_sold").cast("int").alias("total_items_sold"),
        hundredths("total_revenue").cast("decimal(12,2)").alias("total_revenue"),
        hundredths("total_freight").cast("decimal(12,2)").alias("total_freight"),
        round_ratio("rs_sum", "rs_n", 2, precision=4).alias("avg_review_score"),
        round_ratio("vs_sum", F.col("vs_n") * 1440, 2, precision=8).alias("avg_delivery_delay_days"),
        F.date_format("snap_month", "yyyy-MM").alias("snapshot_year_month"),
    )


def snapshot_months(raw_orders: DataFrame) -> DataFrame:
    """Months the source covers; each is rebuilt whole (emptied if it gets no rows)."""
    ts = declared(raw_orders, "order_purchase_timestamp", "timestamp_ntz")
    return raw_orders.where(ts.isNotNull()).select(F.date_format(ts, "yyyy-MM").alias("snapshot_year_month"))


def load_seller_monthly_snapshot(spark, raw: dict, dims: dict, current=None) -> DataFrame:
    fresh = build_seller_monthly_snapshot(raw, dims)
    scope = snapshot_months(raw["raw_orders"])
    return _load(current, fresh, scope, "snapshot_year_month",
                 ["seller_key", "snapshot_year_month"], "snapshot_key",
                 "fct_seller_monthly_snapshot", spark)


def reload_facts(store, raw: dict, dims: dict, version: str) -> dict:
    """Table name to a load that replaces, in the published fact, what the batch ``raw`` covers:
    its orders, or the months it has orders of.  The batch's orders are resolved once."""
    orders = written(order_grain(raw, dims))
    return {
        "fct_order_items": lambda: reload_fact(
            store, "fct_order_items", build_order_items(raw, dims, orders), item_scope(raw), "order_id", version),
        "fct_order_lifecycle": lambda: reload_fact(
            store, "fct_order_lifecycle", build_order_lifecycle(raw, dims, orders), order_scope(raw), "order_id", version),
        "fct_seller_monthly_snapshot": lambda: reload_fact(
            store, "fct_seller_monthly_snapshot", build_seller_monthly_snapshot(raw, dims),
            snapshot_months(raw["raw_orders"]), "snapshot_year_month", version),
    }
