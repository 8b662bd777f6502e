"""Oracle SQL of the queries in ``plans.catalog_loads``: what is published after both loads,
stated from the rules alone."""

from __future__ import annotations

from .oracle_queries import (
    CUSTOMER_COLS, ITEM_COLS, LIFECYCLE_COLS, ORACLE_SQL as SQL, SELLER_HIST_COLS, SNAPSHOT_COLS, check_sql, q, scd2_ctes,
)
from . import checks as chk

_MONTHS = "('2016-03', '2017-11')"


def _two_loads(source: str, cols: list[str], order: str, later: str) -> str:
    """``source`` with keys of two loads: rows for which ``later`` holds came with the second."""
    key, *others = cols
    return q(f"""
SELECT row_number() OVER (PARTITION BY later ORDER BY {order})
       + CASE WHEN later THEN (SELECT count(*) FROM loaded WHERE NOT later) ELSE 0 END AS {key}, {', '.join(others)}
FROM loaded""", {"loaded": f"SELECT *, coalesce({later}, FALSE) AS later FROM {source}"})


_HIST0 = """
SELECT row_number() OVER (ORDER BY seller_id) AS seller_hist_key, seller_id,
       CASE WHEN n % 5 = 0 THEN '00000' ELSE seller_zip_code END AS seller_zip_code,
       CASE WHEN n % 3 = 0 THEN 'old town' ELSE seller_city END AS seller_city, seller_state,
       DATE '2020-01-01' AS scd_start_date, NULL::DATE AS scd_end_date, TRUE AS is_current
FROM (SELECT *, substr(seller_id, 3)::BIGINT AS n FROM stg_sellers) WHERE n % 4 <> 0"""

_FACT_MONTHS = {"fct_order_items": "order_purchase_date", "fct_order_lifecycle": "order_purchase_date", "fct_seller_monthly_snapshot": None}


def _second_run() -> str:
    out = []
    for t in ("dim_date", "dim_customer", "dim_seller", "dim_seller_hist", "dim_product", "dim_product_hist",
              "dim_payment_type", "dim_order_flags", *_FACT_MONTHS):
        parts = "0"
        if t in _FACT_MONTHS:
            month = f"strftime({_FACT_MONTHS[t]}, '%Y-%m')" if _FACT_MONTHS[t] else "snapshot_year_month"
            parts = f"(SELECT count(DISTINCT {month}) FROM {t} WHERE {month} IN {_MONTHS})"
        out.append(f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS n, {parts} AS written, {parts} AS scanned")
    return q("\nUNION ALL\n".join(out))


ORACLE_SQL: dict[str, str] = {
    "second_load_items": _two_loads(
        "fresh_order_items", ITEM_COLS, "order_id, order_item_id",
        f"strftime(order_purchase_date, '%Y-%m') IN {_MONTHS} AND order_item_id = 2"),
    "second_load_lifecycle": _two_loads(
        "fresh_order_lifecycle", LIFECYCLE_COLS, "order_id",
        f"strftime(order_purchase_date, '%Y-%m') IN {_MONTHS} AND substr(order_id, 3)::BIGINT % 4 = 0"),
    "second_load_snapshot": _two_loads(
        "(fresh_snapshot JOIN (SELECT seller_key, seller_id FROM dim_seller) USING (seller_key))", SNAPSHOT_COLS, "seller_key, snapshot_year_month",
        f"snapshot_year_month IN {_MONTHS} AND substr(seller_id, 3)::BIGINT % 5 = 0"),
    "pipeline_second_run": _second_run(),
    "pipeline_dqc": q("\nUNION ALL\n".join(check_sql(c) for c in chk.DIM_CHECKS + chk.FCT_CHECKS)),
    "upsert_buckets_customer": _two_loads(
        "stg_customers", CUSTOMER_COLS, "customer_unique_id", "substr(customer_unique_id, 3)::BIGINT % 4 = 0"),
    "scd2_buckets_seller": q("SELECT * FROM sb_all", {
        "bucket_hist0": _HIST0,
        **scd2_ctes("sb", "bucket_hist0", "stg_sellers", "seller_id", ["seller_zip_code"], ["seller_city", "seller_state"],
                    "seller_hist_key", SELLER_HIST_COLS)}),
    # the rows without a key change nothing, nor does the second run
    "insert_null_keys_rerun": SQL["insert_if_absent_rerun"],
    "upsert_null_keys_rerun": SQL["upsert_seller"],
    "scd2_null_keys_rerun": SQL["scd2_apply_seller"],
    "replace_null_keys_rerun": q("FROM fct_order_lifecycle"),
    "load_from_files": q("""
SELECT f.* EXCLUDE (shipping_limit_date), category_name_english
FROM fresh_order_items f JOIN (SELECT product_key, category_name_english FROM dim_product) USING (product_key)"""),
    "snapshot_outcomes": q("""
SELECT 'se' || (s_suppkey * 2) AS seller_id,
       CASE WHEN NOT EXISTS (SELECT 1 FROM dim_seller d WHERE d.seller_id = 'se' || (s_suppkey * 2)) THEN 'not found'
            WHEN months > 0 THEN 'found' ELSE 'no data' END AS outcome, coalesce(months, 0) AS months
FROM supplier LEFT JOIN (
  SELECT seller_id, count(*) AS months FROM fct_seller_monthly_snapshot JOIN dim_seller USING (seller_key)
  WHERE snapshot_year_month = '2016-03' GROUP BY seller_id) m ON m.seller_id = 'se' || (s_suppkey * 2)"""),
    "revenue_from_rollup": SQL["revenue_by_category"],
    "revenue_from_rollup_range": SQL["revenue_by_category_range"],
    "key_rejects": q("""
SELECT 'seller_id' AS key_column, count(*) AS rejected FROM stg_sellers WHERE substr(seller_id, 3)::BIGINT % 7 = 0
UNION ALL SELECT 'order_id', count(*) FROM stg_items WHERE substr(order_id, 3)::BIGINT % 7 = 0
UNION ALL SELECT 'order_item_id', sum(CASE WHEN substr(order_id, 3)::BIGINT % 7 = 0 THEN 2 ELSE 1 END)::BIGINT
FROM stg_items WHERE order_item_id IS NULL OR order_item_id = 3"""),
}
