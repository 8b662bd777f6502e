"""Registered queries: each ``(spark, sf_dir) -> DataFrame`` over the driver tables.

Every query runs the library's real load / operator code over raw relations
derived from the given tables (``sources.standins``), so its work grows with them.
``plans.oracle_sql`` holds the matching SQL for each key.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..functions.exprs import (
    any_distinct, date_key, day_of_week0, distinct_from, minutes_between, round_ratio,
    try_date, try_dec,
)
from ..operators import quality
from ..operators.dedupe import first_per_key
from ..operators.keys import CODEC, ensure_checkpoint_dir, max_key, written
from ..operators.merge import insert_if_absent, replace_by_key, upsert
from ..operators.scd2 import (
    scd2_apply, scd2_close_changed, scd2_open_missing, scd2_update_type1,
)
from ..sources import standins
from . import checks, dims, facts, serving, staging
from .publish import TableStore

AS_OF = dt.date(2023, 1, 1)


class RawTables(Mapping):
    """The raw relations of one data folder.  Each is derived on first access and written to the
    shared folder as Parquet: loads read it several times, column by column, in splits that
    follow its size, and no executor's memory holds it meanwhile."""

    def __init__(self, spark: SparkSession, sf_dir: str, folder: str):
        self._spark, self._folder = spark, folder
        self._derived = standins.raw_standins(spark, sf_dir)
        self._written: dict[str, DataFrame] = {}
        self._locks = {name: threading.Lock() for name in self._derived}

    def __getitem__(self, name: str) -> DataFrame:
        df = self._derived[name]
        with self._locks[name]:
            if name not in self._written:
                df.write.option("compression", CODEC).parquet(f"{self._folder}/{name}")
                self._written[name] = self._spark.read.schema(df.schema).parquet(f"{self._folder}/{name}")
        return self._written[name]

    def __contains__(self, name) -> bool:
        return name in self._derived

    def __iter__(self):
        return iter(self._derived)

    def __len__(self) -> int:
        return len(self._derived)


class Warehouse:
    """Lazily built first-load warehouse over one scale-factor directory.

    Tables are built on first access and memoised per object, so a query that
    needs the fact table builds the dimensions it depends on exactly once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of=AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self._lock = threading.Lock()
        self._locks: dict[str, threading.Lock] = {}
        self.raw = RawTables(spark, sf_dir, f"{ensure_checkpoint_dir(spark)}/raw-{uuid.uuid4().hex}")
        self._t: dict[str, DataFrame] = {}
        self.store = TableStore(spark, f"{ensure_checkpoint_dir(spark)}/warehouse-{uuid.uuid4().hex}")

    def _get(self, name, build):
        # Each table is read by several consumers (facts, checks, serving): it is published
        # once as Parquet in the shared folder, in its layout, and read from there.
        return self.once(name, lambda: self.store.publish(name, build(), "1"))

    def once(self, name, make) -> DataFrame:
        """What ``make`` returned at the first call under this name."""
        with self._lock:
            lock = self._locks.setdefault(name, threading.Lock())
        with lock:
            if name not in self._t:
                self._t[name] = make()
        return self._t[name]

    def build_all(self, threads: int = 4) -> "Warehouse":
        """Build every table in dependency waves (raw, dimensions, facts); the loads of
        one wave are independent, so their Spark jobs are submitted concurrently."""
        from .. import schemas

        waves = [
            [lambda name=name: self.raw[name] for name in self.raw],
            [lambda t=t: self.table(t) for t in schemas.DIMENSIONS],
            [lambda t=t: self.table(t) for t in schemas.FACTS],
        ]
        with ThreadPoolExecutor(threads) as pool:
            for wave in waves:
                for f in [pool.submit(step) for step in wave]:
                    f.result()
        return self

    @property
    def dim_date(self):
        return self._get("dim_date", lambda: dims.load_dim_date(self.spark))

    @property
    def dim_payment_type(self):
        return self._get("dim_payment_type", lambda: dims.load_dim_payment_type(self.spark))

    @property
    def dim_order_flags(self):
        return self._get("dim_order_flags", lambda: dims.load_dim_order_flags(self.spark))

    @property
    def dim_customer(self):
        return self._get("dim_customer",
                         lambda: dims.load_dim_customer(self.spark, self.raw["raw_customers"]))

    @property
    def dim_seller(self):
        return self._get("dim_seller",
                         lambda: dims.load_dim_seller(self.spark, self.raw["raw_sellers"]))

    @property
    def dim_product(self):
        return self._get("dim_product", lambda: dims.load_dim_product(
            self.spark, self.raw["raw_products"], self.raw["raw_category_translation"]))

    @property
    def dim_seller_hist(self):
        return self._get("dim_seller_hist", lambda: dims.load_dim_seller_hist(
            self.spark, self.raw["raw_sellers"], self.as_of))

    @property
    def dim_product_hist(self):
        return self._get("dim_product_hist", lambda: dims.load_dim_product_hist(
            self.spark, self.raw["raw_products"], self.raw["raw_category_translation"], self.as_of))

    def dims(self) -> dict:
        return {"dim_customer": self.dim_customer, "dim_seller": self.dim_seller,
                "dim_product": self.dim_product, "dim_order_flags": self.dim_order_flags}

    @property
    def orders(self):
        """The order-grain rows that both order facts start from, written once."""
        return self.once("order_grain", lambda: written(facts.order_grain(
            self.raw, {"dim_customer": self.dim_customer, "dim_order_flags": self.dim_order_flags})))

    @property
    def fct_order_items(self):
        return self._get("fct_order_items", lambda: facts.load_order_items(
            self.spark, self.raw, self.dims(), orders=self.orders))

    @property
    def fct_order_lifecycle(self):
        return self._get("fct_order_lifecycle", lambda: facts.load_order_lifecycle(
            self.spark, self.raw, self.dims(), orders=self.orders))

    @property
    def fct_seller_monthly_snapshot(self):
        return self._get("fct_seller_monthly_snapshot", lambda: facts.load_seller_monthly_snapshot(
            self.spark, self.raw, self.dims()))

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)


_WAREHOUSES: dict = {}


def _w(spark, sf_dir) -> Warehouse:
    """The warehouse of one (application, data folder), built once and shared by queries."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = Warehouse(spark, sf_dir)
    return _WAREHOUSES[key]


def build_warehouse(spark, sf_dir, threads: int = 4) -> Warehouse:
    return _w(spark, sf_dir).build_all(threads)


def reset_warehouses(spark=None) -> None:
    """Forget shared builds (and drop cached data), so the next query starts cold."""
    _WAREHOUSES.clear()
    if spark is not None:
        spark.catalog.clearCache()


def _table(spark, sf_dir, name):
    return standins.read_table(spark, sf_dir, name)


# ---------------------------------------------------------------- serving (E-*)

def revenue_by_category(spark, sf_dir):
    w = _w(spark, sf_dir)
    return serving.revenue_by_category(w.fct_order_items, w.dim_product)


def revenue_by_category_range(spark, sf_dir):
    w = _w(spark, sf_dir)
    w.fct_order_items  # published
    items = w.store.read("fct_order_items", "1", with_partitions=True)
    return serving.revenue_by_category(items, w.dim_product,
                                       date_from="2016-03-01", date_to="2019-06-30", limit=3)


def row_counts(spark, sf_dir):
    w = _w(spark, sf_dir)
    from .. import schemas
    return serving.row_counts({t: w.table(t) for t in schemas.WAREHOUSE_TABLES})


def list_sellers(spark, sf_dir):
    return serving.list_sellers(_w(spark, sf_dir).dim_seller, state="africa", limit=50)


def list_sellers_ilike(spark, sf_dir):
    return serving.list_sellers(_w(spark, sf_dir).dim_seller, city="TION_1", limit=500)


def seller_snapshot(spark, sf_dir):
    w = _w(spark, sf_dir)
    out = serving.seller_snapshot_rows(w.fct_seller_monthly_snapshot, w.dim_seller, "se1", 12)
    return out.select(
        "year_month", "total_orders", "total_items_sold",
        F.col("total_revenue").cast("decimal(12,2)").alias("total_revenue"),
        F.col("total_freight").cast("decimal(12,2)").alias("total_freight"),
        F.col("avg_review_score").cast("decimal(4,2)").alias("avg_review_score"),
        F.col("avg_delivery_delay_days").cast("decimal(8,2)").alias("avg_delivery_delay_days"),
    )


def order_lifecycle_lookup(spark, sf_dir):
    return _lifecycle(_w(spark, sf_dir))


def order_lifecycle_points(spark, sf_dir):
    """Some orders by id, one of which does not exist."""
    return _lifecycle(_w(spark, sf_dir), ["or1", "or7", "or32", "none"])


def _lifecycle(w, order_ids=None):
    out = serving.lifecycle_rows(w.fct_order_lifecycle, w.dim_order_flags, order_ids)
    return out.select(
        "order_id", "order_status", "order_purchase_date",
        *[F.col(c).cast("decimal(10,2)").alias(c) for c in (
            "approval_delay_hours", "carrier_pickup_delay_hours", "delivery_delay_days",
            "vs_estimated_days")],
        "is_late",
    )


# ---------------------------------------------------------------- dimensions (B-1..B-8)

def date_spine(spark, sf_dir):
    """The whole date spine with the number of orders purchased each day."""
    w = _w(spark, sf_dir)
    per_day = w.fct_order_lifecycle.groupBy(F.col("purchase_date_key").alias("date_key")).agg(
        F.count(F.lit(1)).alias("orders_purchased"))
    return w.dim_date.join(per_day, "date_key", "left").withColumn(
        "orders_purchased", F.coalesce("orders_purchased", F.lit(0)))


def order_flags_junk(spark, sf_dir):
    """Junk dimension rows with the number of orders carrying each combination."""
    w = _w(spark, sf_dir)
    per_flag = w.fct_order_lifecycle.groupBy("order_flags_key").agg(F.count(F.lit(1)).alias("orders"))
    return w.dim_order_flags.join(per_flag, "order_flags_key", "left").withColumn(
        "orders", F.coalesce("orders", F.lit(0)))


def dim_customer(spark, sf_dir):
    return _w(spark, sf_dir).dim_customer


def dim_seller(spark, sf_dir):
    return _w(spark, sf_dir).dim_seller


def dim_product(spark, sf_dir):
    return _w(spark, sf_dir).dim_product


def dim_seller_hist(spark, sf_dir):
    return _w(spark, sf_dir).dim_seller_hist


def dim_product_hist(spark, sf_dir):
    return _w(spark, sf_dir).dim_product_hist


# ---------------------------------------------------------------- write operators (W-*)

def _old_products(w):
    """An earlier product state: a quarter of the ids missing, a third re-categorised."""
    p = staging.stg_products(w.raw["raw_products"], w.raw["raw_category_translation"])
    k = F.substring("product_id", F.lit(3), F.length("product_id")).cast("long")
    return p.where(k % 4 != 0).select(
        "product_id",
        F.when(k % 3 == 0, F.lit("legacy")).otherwise(F.col("category_name")).alias("category_name"),
        "category_name_english",
    )


def insert_if_absent_new(spark, sf_dir):
    w = _w(spark, sf_dir)
    src = staging.stg_products(w.raw["raw_products"], w.raw["raw_category_translation"])
    return insert_if_absent(_old_products(w), src.select(*_old_products(w).columns), "product_id")


def insert_if_absent_rerun(spark, sf_dir):
    w = _w(spark, sf_dir)
    src = staging.stg_products(w.raw["raw_products"], w.raw["raw_category_translation"])
    src = src.select("product_id", "category_name", "category_name_english")
    once = insert_if_absent(_old_products(w), src, "product_id")
    return insert_if_absent(once, src, "product_id")


def _old_dim(df, sk, col, value):
    return df.where(F.col(sk) % 4 != 0).withColumn(
        col, F.when(F.col(sk) % 3 == 0, F.lit(value)).otherwise(F.col(col)))


def upsert_customer(spark, sf_dir):
    w = _w(spark, sf_dir)
    target = _old_dim(w.dim_customer, "customer_key", "customer_city", "old city")
    return upsert(target, staging.stg_customers(w.raw["raw_customers"]), "customer_unique_id",
                  ["customer_id", "customer_zip_code", "customer_city", "customer_state"],
                  sk_col="customer_key")


def upsert_seller(spark, sf_dir):
    w = _w(spark, sf_dir)
    target = _old_dim(w.dim_seller, "seller_key", "seller_state", "OLD")
    return upsert(target, staging.stg_sellers(w.raw["raw_sellers"]), "seller_id",
                  ["seller_zip_code", "seller_city", "seller_state"], sk_col="seller_key")


def upsert_product(spark, sf_dir):
    w = _w(spark, sf_dir)
    target = _old_dim(w.dim_product, "product_key", "category_name_english", "old name")
    src = staging.stg_products(w.raw["raw_products"], w.raw["raw_category_translation"])
    return upsert(target, src, "product_id", dims.PRODUCT_SET_COLS, sk_col="product_key")


OLD_START, CLOSED_START, CLOSED_END = dt.date(2020, 1, 1), dt.date(2018, 1, 1), dt.date(2019, 12, 31)


def _old_hist(hist, sk, id_col, t1_col, t1_value, t2_col, t2_value, same_day_col, same_day_value,
              as_of=AS_OF):
    """An earlier history: quarter of keys missing, type 1 and 2 values changed on some keys,
    some versions opened on ``as_of`` itself, and closed older versions for every fifth key."""
    k = F.col(sk)
    above = max_key(hist, sk)
    cur = hist.where(k % 4 != 0).select(*[
        F.when(k % 3 == 0, F.lit(t1_value)).otherwise(F.col(c)).alias(c) if c == t1_col
        else F.when(k % 3 == 0, F.lit(t2_value)).otherwise(F.col(c)).alias(c) if c == t2_col
        else F.when(k % 7 == 0, F.lit(same_day_value)).otherwise(F.col(c)).alias(c) if c == same_day_col
        else F.when(k % 7 == 0, F.lit(as_of)).otherwise(F.lit(OLD_START)).alias(c) if c == "scd_start_date"
        else F.col(c)
        for c in hist.columns
    ])
    closed = hist.where(k % 5 == 0).select(*[
        (k + above).alias(c) if c == sk
        else F.lit(CLOSED_START).alias(c) if c == "scd_start_date"
        else F.lit(CLOSED_END).alias(c) if c == "scd_end_date"
        else F.lit(False).alias(c) if c == "is_current"
        else F.lit("ancient").alias(c) if c == t2_col
        else F.col(c)
        for c in hist.columns
    ])
    return cur.unionByName(closed)


def _seller_hist_case(w):
    hist = _old_hist(w.dim_seller_hist, "seller_hist_key", "seller_id", "seller_zip_code", "00000",
                     "seller_city", "old town", "seller_state", "MOVED")
    return hist, staging.stg_sellers(w.raw["raw_sellers"])


SELLER_SCD = dict(key_cols="seller_id", type1_cols=["seller_zip_code"],
                  type2_cols=["seller_city", "seller_state"])
PRODUCT_SCD = dict(key_cols="product_id", type1_cols=dims.PRODUCT_HIST_TYPE1,
                   type2_cols=dims.PRODUCT_HIST_TYPE2)


def _product_hist_case(w):
    hist = _old_hist(w.dim_product_hist, "product_hist_key", "product_id", "product_weight_g", 1,
                     "category_name", "legacy", "category_name_english", "moved")
    return hist, staging.stg_products(w.raw["raw_products"], w.raw["raw_category_translation"])


def scd1_all_versions(spark, sf_dir):
    hist, src = _seller_hist_case(_w(spark, sf_dir))
    return scd2_update_type1(hist, src, "seller_id", ["seller_zip_code"])


def scd2_close(spark, sf_dir):
    hist, src = _seller_hist_case(_w(spark, sf_dir))
    step1 = scd2_update_type1(hist, src, "seller_id", ["seller_zip_code"])
    return scd2_close_changed(step1, src, "seller_id", ["seller_city", "seller_state"], AS_OF)


def scd2_open(spark, sf_dir):
    hist, src = _seller_hist_case(_w(spark, sf_dir))
    step1 = scd2_update_type1(hist, src, "seller_id", ["seller_zip_code"])
    step2 = scd2_close_changed(step1, src, "seller_id", ["seller_city", "seller_state"], AS_OF)
    return scd2_open_missing(step2, src, as_of=AS_OF, sk_col="seller_hist_key", **SELLER_SCD)


def scd2_apply_seller(spark, sf_dir):
    hist, src = _seller_hist_case(_w(spark, sf_dir))
    return scd2_apply(hist, src, as_of=AS_OF, sk_col="seller_hist_key", **SELLER_SCD)


def scd2_apply_product(spark, sf_dir):
    hist, src = _product_hist_case(_w(spark, sf_dir))
    return scd2_apply(hist, src, as_of=AS_OF, sk_col="product_hist_key", **PRODUCT_SCD)


def scd2_rerun(spark, sf_dir):
    """Applying the same source twice on the same day equals applying it once."""
    hist, src = _product_hist_case(_w(spark, sf_dir))
    once = scd2_apply(hist, src, as_of=AS_OF, sk_col="product_hist_key", **PRODUCT_SCD)
    return scd2_apply(once, src, as_of=AS_OF, sk_col="product_hist_key", **PRODUCT_SCD)


def _with_phantoms(df, sk, col, phantom):
    """Rows of ``df`` plus a copy of each under a key the source never mentions."""
    ghost = df.withColumn(col, phantom).withColumn(sk, F.col(sk) + max_key(df, sk))
    return df.unionByName(ghost)


def replace_by_key_items(spark, sf_dir):
    w = _w(spark, sf_dir)
    fct = w.fct_order_items
    stale = fct.where(F.col("order_item_id") != 2).withColumn(
        "price", (F.col("price") + 1).cast("decimal(10,2)"))
    target = _with_phantoms(stale, "order_item_key", "order_id", F.concat(F.lit("zz"), "order_id"))
    fresh = facts.build_order_items(w.raw, w.dims(), w.orders)
    out = replace_by_key(target, fresh, w.raw["raw_order_items"].select("order_id"), "order_id",
                         ["order_id", "order_item_id"], "order_item_key")
    from .. import schemas
    return schemas.conform(out, "fct_order_items")


def replace_by_key_orders(spark, sf_dir):
    w = _w(spark, sf_dir)
    fct = w.fct_order_lifecycle
    stale = fct.where(F.col("order_lifecycle_key") % 3 != 0).withColumn(
        "approval_delay_hours", F.lit(None).cast("decimal(10,2)"))
    target = _with_phantoms(stale, "order_lifecycle_key", "order_id", F.concat(F.lit("zz"), "order_id"))
    fresh = facts.build_order_lifecycle(w.raw, w.dims(), w.orders)
    out = replace_by_key(target, fresh, w.raw["raw_orders"].select("order_id"), "order_id",
                         ["order_id"], "order_lifecycle_key")
    from .. import schemas
    return schemas.conform(out, "fct_order_lifecycle")


def replace_by_month(spark, sf_dir):
    """Months in the source are rebuilt whole: stale rows and stale sellers vanish."""
    w = _w(spark, sf_dir)
    fct = w.fct_seller_monthly_snapshot
    stale = fct.withColumn("total_revenue", F.lit(0).cast("decimal(12,2)"))
    ghost_seller = fct.withColumn("seller_key", F.col("seller_key") + max_key(fct, "seller_key")).withColumn(
        "snapshot_key", F.col("snapshot_key") + 2 * max_key(fct, "snapshot_key"))
    old_month = F.concat(F.lit("19"), F.substring("snapshot_year_month", 3, 5))
    target = _with_phantoms(stale, "snapshot_key", "snapshot_year_month", old_month).unionByName(ghost_seller)
    fresh = facts.build_seller_monthly_snapshot(w.raw, w.dims())
    out = replace_by_key(target, fresh, facts.snapshot_months(w.raw["raw_orders"]),
                         "snapshot_year_month", ["seller_key", "snapshot_year_month"], "snapshot_key")
    from .. import schemas
    return schemas.conform(out, "fct_seller_monthly_snapshot")


# ---------------------------------------------------------------- staging, casts, dedupe

def dedupe_first_per_key(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    first = first_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"])
    return first.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


def latest_per_key_nulls_last(spark, sf_dir):
    return staging.stg_reviews(_w(spark, sf_dir).raw["raw_reviews"])


def cleanse_text(spark, sf_dir):
    raw = _w(spark, sf_dir).raw["raw_customers"]
    return raw.select(
        "customer_id",
        F.trim("customer_zip_code_prefix").alias("customer_zip_code"),
        F.lower(F.trim("customer_city")).alias("customer_city"),
        F.upper(F.trim("customer_state")).alias("customer_state"),
    )


def safe_cast_int(spark, sf_dir):
    w = _w(spark, sf_dir)
    return staging.stg_products(w.raw["raw_products"], w.raw["raw_category_translation"])


def safe_cast_decimal(spark, sf_dir):
    raw = _w(spark, sf_dir).raw["raw_order_items"]
    return raw.select("order_id", "order_item_id", try_dec("price").alias("price"),
                      try_dec("freight_value").alias("freight_value"))


def safe_cast_timestamp(spark, sf_dir):
    return staging.stg_orders(_w(spark, sf_dir).raw["raw_orders"])


def safe_cast_date(spark, sf_dir):
    raw = _w(spark, sf_dir).raw["raw_orders"]
    return raw.select(
        "order_id",
        try_date("order_purchase_timestamp").alias("purchase_date"),
        try_date("order_estimated_delivery_date").alias("estimated_date"),
    )


def _user_days(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    return e.groupBy("user_id", F.col("ts").cast("date").alias("day"))


def minute_diff(spark, sf_dir):
    """Minute boundaries crossed between a user's first and last event of each day."""
    g = _user_days(spark, sf_dir).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
                                      F.count(F.lit(1)).alias("n_events"))
    return g.select("user_id", "day", "n_events",
                    minutes_between("first_ts", "last_ts").alias("minutes"),
                    minutes_between("last_ts", "first_ts").alias("minutes_back"))


def stage_delays(spark, sf_dir):
    """Per user and day: first signup, view, click and purchase, and the delays between them."""
    stages = ["signup", "view", "click", "purchase"]
    g = _user_days(spark, sf_dir).agg(*[
        F.min(F.when(F.col("event_type") == s, F.col("ts"))).alias(f"{s}_ts") for s in stages])
    return g.select(
        "user_id", "day",
        round_ratio(minutes_between("signup_ts", "view_ts"), F.lit(60)).alias("signup_to_view_hours"),
        round_ratio(minutes_between("view_ts", "click_ts"), F.lit(60)).alias("view_to_click_hours"),
        round_ratio(minutes_between("click_ts", "purchase_ts"), F.lit(60)).alias("click_to_purchase_hours"),
        round_ratio(minutes_between("signup_ts", "purchase_ts"), F.lit(1440)).alias("signup_to_purchase_days"),
    )


def calendar_parts(spark, sf_dir):
    o = staging.stg_orders(_w(spark, sf_dir).raw["raw_orders"]).where(F.col("purchase_ts").isNotNull())
    d = F.col("purchase_ts").cast("date")
    return o.select(
        "order_id",
        date_key(d).alias("date_key"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.weekofyear(d).alias("week_of_year"), day_of_week0(d).alias("day_of_week"),
        F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "EEEE").alias("day_name"),
        day_of_week0(d).isin(0, 6).alias("is_weekend"),
        F.trunc(d, "month").alias("month_start"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
    )


def date_keys(spark, sf_dir):
    o = staging.stg_orders(_w(spark, sf_dir).raw["raw_orders"])
    return o.select("order_id", *[date_key(c).alias(c.replace("_ts", "_date_key")) for c in (
        "purchase_ts", "approved_ts", "carrier_ts", "delivered_ts", "estimated_ts")])


# ---------------------------------------------------------------- joins (J-*)

def multi_item_flag(spark, sf_dir):
    return staging.items_per_order(staging.stg_items(_w(spark, sf_dir).raw["raw_order_items"]))


def junk_lookup(spark, sf_dir):
    w = _w(spark, sf_dir)
    o = staging.stg_orders(w.raw["raw_orders"]).where(F.col("purchase_ts").isNotNull())
    ipo = staging.items_per_order(staging.stg_items(w.raw["raw_order_items"]))
    late = F.col("delivered_ts").isNotNull() & (F.col("delivered_ts") > F.col("estimated_ts"))
    o = o.join(staging.customer_lookup(w.raw["raw_customers"]), "customer_id").join(ipo, "order_id", "left").select(
        "order_id", "order_status", late.alias("is_late_delivery"),
        F.coalesce("is_multi_item", F.lit(False)).alias("is_multi_item"))
    # the junk dimension has 32 rows by construction
    key = ["order_status", "is_late_delivery", "is_multi_item"]
    return o.join(F.broadcast(w.dim_order_flags.select("order_flags_key", *key)), key, "left").select(
        "order_id", *key, "order_flags_key")


def bridge_lookup(spark, sf_dir):
    w = _w(spark, sf_dir)
    r = facts.resolved_orders(w.raw["raw_orders"], w.raw["raw_customers"], w.dim_customer)
    return r.select("order_id", "customer_id", "customer_key")


def star_lookup(spark, sf_dir):
    w = _w(spark, sf_dir)
    return facts.build_order_items(w.raw, w.dims(), w.orders)


def role_playing_dates(spark, sf_dir):
    """The five date keys of each order resolved against one date dimension in five roles."""
    w = _w(spark, sf_dir)
    out = w.fct_order_lifecycle.select("order_id", "purchase_date_key", "approved_date_key",
                                       "carrier_date_key", "delivered_date_key", "estimated_date_key")
    # dim_date has 2922 rows by construction: broadcasting each role is bounded.
    dd = w.dim_date.select("date_key", "full_date")
    for role in ("purchase", "approved", "carrier", "delivered", "estimated"):
        d = F.broadcast(dd.select(F.col("date_key").alias(f"{role}_date_key"),
                                  F.col("full_date").alias(f"{role}_date")))
        out = out.join(d, f"{role}_date_key", "left")
    return out.select("order_id", "purchase_date", "approved_date", "carrier_date", "delivered_date",
                      "estimated_date")


def semi_join_keys(spark, sf_dir):
    """Orders having at least one cleansed item."""
    w = _w(spark, sf_dir)
    o = staging.stg_orders(w.raw["raw_orders"])
    return o.join(staging.stg_items(w.raw["raw_order_items"]), "order_id", "left_semi").select(
        "order_id", "order_status")


def anti_join_orphans(spark, sf_dir):
    """Products without a returned item (no row of lineitem flagged R with a quantity above 40)."""
    w = _w(spark, sf_dir)
    returned = _table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' AND l_quantity > 40").select(
        F.concat(F.lit("pr"), F.col("l_partkey").cast("string")).alias("product_id")).distinct()
    return w.dim_product.join(returned, "product_id", "left_anti").select("product_id", "category_name")


def null_safe_diff(spark, sf_dir):
    """Which attributes of each current seller version differ from the source (NULL-safe)."""
    w = _w(spark, sf_dir)
    hist, src = _seller_hist_case(w)
    cur = hist.where("is_current").select("seller_id", *[F.col(c).alias(f"h_{c}") for c in (
        "seller_zip_code", "seller_city", "seller_state")])
    j = cur.join(src, "seller_id")
    return j.select(
        "seller_id",
        distinct_from("h_seller_zip_code", "seller_zip_code").alias("zip_changed"),
        distinct_from("h_seller_city", "seller_city").alias("city_changed"),
        distinct_from("h_seller_state", "seller_state").alias("state_changed"),
        any_distinct([("h_seller_city", "seller_city"), ("h_seller_state", "seller_state")]).alias(
            "needs_new_version"),
    )


# ---------------------------------------------------------------- aggregates (A-*)

def having_duplicates(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def distinct_count_group(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem")
    return li.groupBy("l_suppkey").agg(F.count_distinct("l_orderkey").alias("orders"),
                                       F.count(F.lit(1)).alias("items"))


def decimal_sum_avg(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", F.col("l_extendedprice").cast("decimal(10,2)").alias("price"))
    g = li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("price").cast("decimal(38,2)").alias("total_price"),
        F.sum((F.col("price") * 100).cast("long")).alias("cents"),
        F.count(F.lit(1)).alias("n"))
    return g.select("l_returnflag", "l_linestatus", "total_price", "n",
                    round_ratio("cents", F.col("n") * 100, 2, 38).alias("avg_price"))


# ---------------------------------------------------------------- facts (B-9..B-11)

def fct_order_items(spark, sf_dir):
    return _w(spark, sf_dir).fct_order_items


def fct_order_lifecycle(spark, sf_dir):
    return _w(spark, sf_dir).fct_order_lifecycle


def fct_seller_monthly_snapshot(spark, sf_dir):
    return _w(spark, sf_dir).fct_seller_monthly_snapshot


# ---------------------------------------------------------------- quality (Q-*)

RUN_TS_1 = dt.datetime(2023, 1, 1, 6, 0, 0)
RUN_TS_2 = dt.datetime(2023, 1, 2, 6, 0, 0)
ALL_CHECKS = checks.DIM_CHECKS + checks.FCT_CHECKS


def _tables(w):
    from .. import schemas
    return {t: w.table(t) for t in schemas.WAREHOUSE_TABLES}


def _results(spark, sf_dir, check_list, tables=None, run_ts=RUN_TS_1):
    w = _w(spark, sf_dir)
    res = quality.run_checks(spark, tables or _tables(w), check_list, run_ts)
    return res.drop("run_timestamp")


def dqc_dim_all(spark, sf_dir):
    return _results(spark, sf_dir, checks.DIM_CHECKS)


def dqc_fct_all(spark, sf_dir):
    return _results(spark, sf_dir, checks.FCT_CHECKS)


def dqc_extra(spark, sf_dir):
    """Our own foreign-key checks on the junk key and the five lifecycle stage dates."""
    return _results(spark, sf_dir, checks.EXTRA_FCT_CHECKS)


def _family(fam):
    return [c for c in ALL_CHECKS if c.family == fam]


def dqc_row_count(spark, sf_dir):
    return _results(spark, sf_dir, _family("K"))


def dqc_unique(spark, sf_dir):
    return _results(spark, sf_dir, _family("U"))


def dqc_predicate(spark, sf_dir):
    return _results(spark, sf_dir, _family("P"))


def dqc_referential(spark, sf_dir):
    return _results(spark, sf_dir, _family("R"))


def dqc_scd2(spark, sf_dir):
    return _results(spark, sf_dir, [c for c in ALL_CHECKS if c.reported.endswith("_hist")])


def payment_types(spark, sf_dir):
    """The payment types by content, with the orders whose key falls on each."""
    used = _table(spark, sf_dir, "orders").groupBy((F.col("o_orderkey") % 5 + 1).cast("long").alias("payment_type_key")).agg(F.count(F.lit(1)).alias("n"))
    return _w(spark, sf_dir).dim_payment_type.join(used, "payment_type_key", "left")


def item_rejects(spark, sf_dir):
    return staging.item_rejects(_w(spark, sf_dir).raw["raw_order_items"])


def sql_parameters(spark, sf_dir):
    """SQL over the published tables with bound parameters."""
    w = _w(spark, sf_dir)
    w.fct_order_items.createOrReplaceTempView("published_items")
    w.dim_seller.createOrReplaceTempView("published_sellers")
    return serving.query(spark, """
        SELECT seller_id, COUNT(*) AS items, SUM(price) AS revenue FROM published_items JOIN published_sellers USING (seller_key)
        WHERE seller_state = :state AND price >= :least GROUP BY seller_id""", {"state": "ASIA", "least": 100})


def insert_if_absent_repeated(spark, sf_dir):
    """A source that repeats keys: of each new key the first row goes in."""
    w = _w(spark, sf_dir)
    old = _old_products(w)
    src = staging.stg_products(w.raw["raw_products"], w.raw["raw_category_translation"]).select(*old.columns)
    again = src.withColumn("category_name", F.concat(F.lit("zz "), "category_name"))
    return insert_if_absent(old, src.unionByName(again), "product_id")


def replace_by_key_repeated(spark, sf_dir):
    """A target that repeats natural keys: each reloaded row is there once, under its
    smallest key."""
    w = _w(spark, sf_dir)
    fct = w.fct_order_lifecycle
    twice = fct.unionByName(fct.withColumn("order_lifecycle_key", F.col("order_lifecycle_key") + max_key(fct, "order_lifecycle_key")))
    out = replace_by_key(twice, facts.build_order_lifecycle(w.raw, w.dims(), w.orders), w.raw["raw_orders"].select("order_id"),
                         "order_id", ["order_id"], "order_lifecycle_key")
    return out.select(*fct.columns)


def dqc_append(spark, sf_dir):
    """The results log keeps both runs."""
    return _results_log(spark, sf_dir).drop("run_timestamp")


def dqc_clear_layer(spark, sf_dir):
    """One layer of the log replaced by a later run's rows."""
    w = _w(spark, sf_dir)
    new = quality.run_checks(spark, _tables(w), checks.DIM_CHECKS, RUN_TS_2)
    return quality.clear_layer_and_append(_results_log(spark, sf_dir), new, "dim").drop("run_timestamp")


def _broken_tables(w):
    """The warehouse with a corrupted item fact: duplicated first items pointing at unknown
    products with negated prices, so four fact checks must fail with exact counts."""
    t = _tables(w)
    fi = t["fct_order_items"]
    bad = fi.where(F.col("order_item_id") == 1).withColumn(
        "product_key", F.col("product_key") + max_key(t["dim_product"], "product_key")).withColumn(
        "price", (-F.col("price")).cast("decimal(10,2)"))
    t["fct_order_items"] = fi.unionByName(bad)
    return t


def dqc_fct_broken(spark, sf_dir):
    w = _w(spark, sf_dir)
    return _results(spark, sf_dir, checks.FCT_CHECKS, tables=_broken_tables(w))


def _results_log(spark, sf_dir):
    """The log of two runs of all checks, written once like any table: those that read it twice
    or after one another don't run the checks again."""
    w = _w(spark, sf_dir)
    return w.once("results_log", lambda: written(_two_runs(spark, w)))


def _two_runs(spark, w):
    good = quality.run_checks(spark, _tables(w), ALL_CHECKS, RUN_TS_1)
    bad = quality.run_checks(spark, _broken_tables(w), ALL_CHECKS, RUN_TS_2)
    return good.unionByName(bad)


def dqc_summary(spark, sf_dir):
    w = _w(spark, sf_dir)
    return quality.summary(quality.run_checks(spark, _broken_tables(w), ALL_CHECKS, RUN_TS_1))


def dqc_latest(spark, sf_dir):
    return serving.dqc_latest(_results_log(spark, sf_dir), layer="FCT", status="fail")


QUERIES = {name: fn for name, fn in list(globals().items()) if callable(fn) and name in {
    "revenue_by_category", "revenue_by_category_range", "row_counts", "list_sellers",
    "list_sellers_ilike", "seller_snapshot", "order_lifecycle_lookup",
    "date_spine", "order_flags_junk", "dim_customer", "dim_seller", "dim_product",
    "dim_seller_hist", "dim_product_hist",
    "insert_if_absent_new", "insert_if_absent_rerun", "upsert_customer", "upsert_seller",
    "upsert_product", "scd1_all_versions", "scd2_close", "scd2_open", "scd2_apply_seller",
    "scd2_apply_product", "scd2_rerun", "replace_by_key_items", "replace_by_key_orders",
    "replace_by_month", "order_lifecycle_points", "payment_types", "item_rejects", "sql_parameters",
    "insert_if_absent_repeated", "replace_by_key_repeated", "dqc_append", "dqc_clear_layer",
    "dedupe_first_per_key", "latest_per_key_nulls_last", "cleanse_text", "safe_cast_int",
    "safe_cast_decimal", "safe_cast_timestamp", "safe_cast_date", "minute_diff", "stage_delays",
    "calendar_parts", "date_keys",
    "multi_item_flag", "junk_lookup", "bridge_lookup", "star_lookup", "role_playing_dates",
    "semi_join_keys", "anti_join_orphans", "null_safe_diff",
    "having_duplicates", "distinct_count_group", "decimal_sum_avg",
    "fct_order_items", "fct_order_lifecycle", "fct_seller_monthly_snapshot",
    "dqc_dim_all", "dqc_fct_all", "dqc_row_count", "dqc_unique", "dqc_predicate",
    "dqc_referential", "dqc_scd2", "dqc_extra", "dqc_fct_broken", "dqc_summary", "dqc_latest",
}}
