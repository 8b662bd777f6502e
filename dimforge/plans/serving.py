"""Read-only analytics over the published warehouse (the serving surface).

Every query is a function of the tables it reads and its arguments, returning a
DataFrame; the caller decides whether to collect.  Arguments are bound as Column
literals (never spliced into SQL text), validated like the original endpoints,
and result orders get tie-breakers so LIMIT picks are deterministic.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import round_ratio


class NotFound(LookupError):
    """The requested seller / order does not exist, or has no data."""


def _check_limit(limit: int, lo: int, hi: int, name="limit") -> int:
    if not isinstance(limit, int) or isinstance(limit, bool) or not lo <= limit <= hi:
        raise ValueError(f"{name} must be an integer in [{lo}, {hi}], got {limit!r}")
    return limit


_DATE_ARG = re.compile(r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$")


def _date_arg(value, name):
    """A date argument as DATE; malformed text is an error, not an empty filter."""
    if isinstance(value, dt.date):
        return value
    if not isinstance(value, str) or not _DATE_ARG.match(value):
        raise ValueError(f"{name} must be a date YYYY-MM-DD, got {value!r}")
    y, m, d = (int(x) for x in value.strip().split("-"))
    return dt.date(y, m, d)  # raises on impossible dates


#: The largest limit that a serving call takes.
MOST_RECORDS = 500


def query(spark: SparkSession, sql: str, params: dict | None = None) -> DataFrame:
    """Parameterised SQL over registered tables; named parameters are bound, not spliced."""
    return spark.sql(sql, args=params or {})


def to_records(df: DataFrame) -> list[dict]:
    """A result of at most ``MOST_RECORDS`` rows as a list of dicts; a larger one is an error."""
    rows = df.limit(MOST_RECORDS + 1).collect()
    if len(rows) > MOST_RECORDS:
        raise ValueError(f"more than {MOST_RECORDS} rows")
    return [r.asDict() for r in rows]


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n) for each table, one union of global counts."""
    parts = [df.select(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _ilike_pattern(text: str) -> str:
    # '%' and '_' in the argument stay wildcards; a backslash is a literal character.
    return "%" + text.replace("\\", "\\\\") + "%"


def list_sellers(dim_seller: DataFrame, state=None, city=None, limit: int = 50) -> DataFrame:
    """Sellers filtered by state (case-insensitive equality) and city (case-insensitive
    substring), ordered by state, city (NULLs last), seller_id."""
    _check_limit(limit, 1, 500)
    df = dim_seller
    if state:
        df = df.where(F.upper("seller_state") == F.lit(state.upper()))
    if city:
        df = df.where(F.col("seller_city").ilike(_ilike_pattern(city)))
    return (
        df.select("seller_id", "seller_city", "seller_state", "seller_zip_code")
        .orderBy(F.asc_nulls_last("seller_state"), F.asc_nulls_last("seller_city"), "seller_id")
        .limit(limit)
    )


def seller_exists(dim_seller: DataFrame, seller_id: str) -> bool:
    return not dim_seller.where(F.col("seller_id") == F.lit(seller_id)).limit(1).isEmpty()


def snapshot_outcomes(snapshot: DataFrame, dim_seller: DataFrame, ids: DataFrame) -> DataFrame:
    """For each id of ``ids`` (seller_id): what the snapshot endpoint answers -- ``found``,
    ``no data`` (a seller without months) or ``not found`` -- and the number of months.  Both
    probes are semi joins: no row of the dimension or the fact is multiplied."""
    months = snapshot.groupBy("seller_key").agg(F.count(F.lit(1)).alias("months"))
    known = dim_seller.select("seller_id", "seller_key").join(months, "seller_key", "left")
    known = known.select("seller_id", F.coalesce("months", F.lit(0)).alias("months"), F.lit(True).alias("_known"))
    outcome = F.when(F.col("_known").isNull(), "not found").when(F.col("months") == 0, "no data").otherwise("found")
    return ids.select("seller_id").distinct().join(known, "seller_id", "left").select(
        "seller_id", outcome.alias("outcome"), F.coalesce("months", F.lit(0)).alias("months"))


def seller_snapshot_rows(snapshot: DataFrame, dim_seller: DataFrame, seller_id: str,
                         months: int = 12) -> DataFrame:
    """Most recent ``months`` monthly snapshot rows of one seller."""
    _check_limit(months, 1, 60, "months")
    # the key as a literal reaches the Parquet filter, and the files are sorted by it
    seller = dim_seller.where(F.col("seller_id") == F.lit(seller_id)).select("seller_key").first()
    return (
        snapshot.where(F.col("seller_key") == F.lit(seller["seller_key"] if seller else None))
        .select(
            F.col("snapshot_year_month").alias("year_month"),
            "total_orders", "total_items_sold",
            F.round("total_revenue", 2).alias("total_revenue"),
            F.round("total_freight", 2).alias("total_freight"),
            F.round("avg_review_score", 2).alias("avg_review_score"),
            F.round("avg_delivery_delay_days", 2).alias("avg_delivery_delay_days"),
        )
        .orderBy(F.desc("year_month"))
        .limit(months)
    )


def seller_snapshot(snapshot, dim_seller, seller_id: str, months: int = 12) -> list[dict]:
    """As the endpoint: unknown seller and seller without data are distinct errors."""
    if not seller_exists(dim_seller, seller_id):
        raise NotFound(f"Seller '{seller_id}' not found")
    rows = to_records(seller_snapshot_rows(snapshot, dim_seller, seller_id, months))
    if not rows:
        raise NotFound(f"No snapshot data for seller '{seller_id}'")
    return rows


def lifecycle_rows(lifecycle: DataFrame, dim_order_flags: DataFrame, order_ids=None) -> DataFrame:
    """Stage delays per order with its status and late flag (all orders, or some)."""
    fl = lifecycle
    if order_ids is not None:
        ids = [order_ids] if isinstance(order_ids, str) else list(order_ids)
        fl = fl.where(F.col("order_id").isin(ids))
    flags = F.broadcast(dim_order_flags.select("order_flags_key", "order_status", "is_late_delivery"))
    return fl.join(flags, "order_flags_key", "left").select(
        "order_id",
        "order_status",
        F.col("order_purchase_date").cast("string").alias("order_purchase_date"),
        F.round("approval_delay_hours", 2).alias("approval_delay_hours"),
        F.round("carrier_pickup_delay_hours", 2).alias("carrier_pickup_delay_hours"),
        F.round("delivery_delay_days", 2).alias("delivery_delay_days"),
        F.round("vs_estimated_days", 2).alias("vs_estimated_days"),
        F.col("is_late_delivery").alias("is_late"),
    )


def order_lifecycle(lifecycle, dim_order_flags, order_id: str) -> dict:
    rows = lifecycle_rows(lifecycle, dim_order_flags, order_id).limit(1).collect()
    if not rows:
        raise NotFound(f"Order '{order_id}' not found")
    return rows[0].asDict()


def revenue_by_category(
    fct_order_items: DataFrame,
    dim_product: DataFrame,
    date_from=None,
    date_to=None,
    limit: int = 20,
) -> DataFrame:
    """Category revenue: distinct orders, items, revenue, average price and freight.

    Both date bounds are inclusive and optional.  Averages are exact (integer cents
    over counts) and rounded half away from zero.  Top ``limit`` by revenue, ties by
    category name.
    """
    fi = in_days(fct_order_items, date_from, date_to)
    j = fi.select("product_key", "order_id", "price", "freight_value").join(
        dim_product.select("product_key", "category_name_english"), "product_key"
    )
    agg = j.groupBy("category_name_english").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count(F.lit(1)).alias("total_items"),
        F.sum("price").alias("revenue"),
        F.sum((F.col("price") * 100).cast("long")).alias("price_cents"),
        F.sum((F.col("freight_value") * 100).cast("long")).alias("freight_cents"),
    )
    return top_categories(agg, limit)


def in_days(rows: DataFrame, date_from=None, date_to=None) -> DataFrame:
    """Rows of an inclusive range of purchase days."""
    by_month = "purchase_month" in rows.columns  # published with its month partition column
    if date_from is not None:
        d = _date_arg(date_from, "date_from")
        rows = rows.where(F.col("order_purchase_date") >= F.lit(d))
        if by_month:  # the implied month bound prunes whole partition folders
            rows = rows.where(F.col("purchase_month") >= F.lit(d.strftime("%Y-%m")))
    if date_to is not None:
        d = _date_arg(date_to, "date_to")
        rows = rows.where(F.col("order_purchase_date") <= F.lit(d))
        if by_month:
            rows = rows.where(F.col("purchase_month") <= F.lit(d.strftime("%Y-%m")))
    return rows


def top_categories(agg: DataFrame, limit: int) -> DataFrame:
    """The categories of most revenue, from sums by category."""
    _check_limit(limit, 1, 100)
    out = agg.select(
        "category_name_english",
        F.col("total_orders").cast("long").alias("total_orders"),
        F.col("total_items").cast("long").alias("total_items"),
        F.col("revenue").cast("decimal(38,2)").alias("total_revenue"),
        round_ratio("price_cents", F.col("total_items") * 100, 2, 38).alias("avg_price"),
        round_ratio("freight_cents", F.col("total_items") * 100, 2, 38).alias("avg_freight"),
    )
    return out.orderBy(F.desc("total_revenue"), F.asc("category_name_english")).limit(limit)


def dqc_latest(dqc_results: DataFrame, layer=None, status=None) -> DataFrame:
    """Checks of the most recent run, optionally one layer / one status."""
    latest = dqc_results.agg(F.max("run_timestamp").alias("_max_ts"))
    df = dqc_results.join(F.broadcast(latest), F.col("run_timestamp") == F.col("_max_ts"))
    if layer:
        df = df.where(F.col("layer") == F.lit(layer.lower()))
    if status:
        df = df.where(F.upper("status") == F.lit(status.upper()))
    return df.select("layer", "table_name", "check_name", "status", "failed_count", "note").orderBy(
        "layer", "table_name", "check_name"
    )
