"""The warehouse's 35 quality checks (17 on dimensions, 18 on facts), declared as data."""

from __future__ import annotations

from ..operators.quality import predicate, referential, row_count, unique
from ..sources.literals import DATE_SPINE_ROWS, ORDER_FLAG_ROWS, PAYMENT_TYPES

D, FC = "dim", "fct"

# Check names, table names and notes are part of the results.

DIM_CHECKS = [
    row_count(D, "dim_date", "expected_row_count", DATE_SPINE_ROWS,
              "Expected 2922 rows (2015-2022 date spine)"),
    unique(D, "dim_date", "unique_date_key", "date_key", "Duplicate date_key values found"),
    predicate(D, "dim_date", "no_null_full_date", "full_date IS NULL", "NULL full_date values found"),
    unique(D, "dim_customer", "unique_pk", "customer_key", "Duplicate customer_key"),
    unique(D, "dim_customer", "unique_business_key", "customer_unique_id", "Duplicate customer_unique_id"),
    predicate(D, "dim_customer", "no_null_state", "customer_state IS NULL", "NULL customer_state values"),
    unique(D, "dim_seller", "unique_pk", "seller_key", "Duplicate seller_key"),
    unique(D, "dim_seller", "unique_business_key", "seller_id", "Duplicate seller_id"),
    unique(D, "dim_seller_hist", "scd2_single_current_per_seller", "seller_id",
           "seller_id has more than 1 is_current=TRUE record", where="is_current = TRUE"),
    # A version may live a single day: end = start is valid, end < start is not.
    predicate(D, "dim_seller_hist", "scd2_end_after_start",
              "scd_end_date IS NOT NULL AND scd_end_date < scd_start_date",
              "scd_end_date < scd_start_date"),
    referential(D, "dim_seller", "referential_seller_coverage", "seller_id", "dim_seller_hist",
                "seller_id", "seller_id in dim_seller missing from dim_seller_hist", report="dim_seller_hist"),
    unique(D, "dim_product", "unique_pk", "product_key", "Duplicate product_key"),
    predicate(D, "dim_product", "no_null_category", "category_name IS NULL",
              "NULL category_name (expected unknown instead)"),
    unique(D, "dim_product_hist", "scd2_single_current_per_product", "product_id",
           "product_id has more than 1 is_current=TRUE record", where="is_current = TRUE"),
    referential(D, "dim_product", "referential_product_coverage", "product_id", "dim_product_hist",
                "product_id", "product_id in dim_product missing from dim_product_hist", report="dim_product_hist"),
    row_count(D, "dim_order_flags", "expected_row_count", ORDER_FLAG_ROWS,
              "Expected exactly 32 junk dimension combinations"),
    row_count(D, "dim_payment_type", "expected_row_count", len(PAYMENT_TYPES),
              "Expected exactly 5 payment types"),
]

FCT_CHECKS = [
    unique(FC, "fct_order_items", "unique_natural_key", ["order_id", "order_item_id"],
           "Duplicate (order_id, order_item_id)"),
    predicate(FC, "fct_order_items", "no_null_dimension_keys",
              "customer_key IS NULL OR seller_key IS NULL OR product_key IS NULL",
              "NULL FK: customer_key, seller_key, or product_key"),
    predicate(FC, "fct_order_items", "price_positive", "price <= 0", "price <= 0"),
    predicate(FC, "fct_order_items", "freight_non_negative", "freight_value < 0", "freight_value < 0"),
    predicate(FC, "fct_order_items", "total_item_value_integrity",
              "ABS(total_item_value - (price + freight_value)) > 0.01",
              "total_item_value != price + freight_value"),
    referential(FC, "fct_order_items", "fk_customer_key", "customer_key", "dim_customer",
                "customer_key", "customer_key not found in dim_customer"),
    referential(FC, "fct_order_items", "fk_seller_key", "seller_key", "dim_seller", "seller_key",
                "seller_key not found in dim_seller"),
    referential(FC, "fct_order_items", "fk_product_key", "product_key", "dim_product", "product_key",
                "product_key not found in dim_product"),
    referential(FC, "fct_order_items", "fk_order_date_key", "order_date_key", "dim_date", "date_key",
                "order_date_key not found in dim_date"),
    unique(FC, "fct_order_lifecycle", "unique_order_id", "order_id", "Duplicate order_id"),
    predicate(FC, "fct_order_lifecycle", "vs_estimated_days_range",
              "vs_estimated_days IS NOT NULL AND (vs_estimated_days < -365 OR vs_estimated_days > 365)",
              "vs_estimated_days outside [-365, 365]"),
    predicate(FC, "fct_order_lifecycle", "approval_delay_non_negative",
              "approval_delay_hours IS NOT NULL AND approval_delay_hours < 0",
              "approval_delay_hours < 0 (approved before purchase)"),
    referential(FC, "fct_order_lifecycle", "fk_customer_key", "customer_key", "dim_customer",
                "customer_key", "customer_key not found in dim_customer"),
    unique(FC, "fct_seller_monthly_snapshot", "unique_natural_key", ["seller_key", "snapshot_year_month"],
           "Duplicate (seller_key, snapshot_year_month)"),
    predicate(FC, "fct_seller_monthly_snapshot", "revenue_non_negative", "total_revenue < 0",
              "total_revenue < 0"),
    predicate(FC, "fct_seller_monthly_snapshot", "avg_review_score_range",
              "avg_review_score IS NOT NULL AND (avg_review_score < 1 OR avg_review_score > 5)",
              "avg_review_score outside [1, 5]"),
    referential(FC, "fct_seller_monthly_snapshot", "fk_seller_key", "seller_key", "dim_seller",
                "seller_key", "seller_key not found in dim_seller"),
    referential(FC, "fct_seller_monthly_snapshot", "fk_snapshot_month_key", "snapshot_month_key",
                "dim_date", "date_key", "snapshot_month_key not found in dim_date"),
]

# Our own additions (layer "ext", kept out of the 35): foreign keys no original check
# covered.  A NULL junk key is counted (it means an order matched no flag combination);
# a NULL stage date is not (the stage was not reached yet).
X = "ext"
EXTRA_FCT_CHECKS = [
    referential(X, "fct_order_items", "fk_order_flags_key", "order_flags_key", "dim_order_flags",
                "order_flags_key", "order_flags_key NULL or not found in dim_order_flags"),
    referential(X, "fct_order_lifecycle", "fk_order_flags_key", "order_flags_key", "dim_order_flags",
                "order_flags_key", "order_flags_key NULL or not found in dim_order_flags"),
] + [
    referential(X, "fct_order_lifecycle", f"fk_{stage}_date_key", f"{stage}_date_key", "dim_date",
                "date_key", f"{stage}_date_key not found in dim_date", where=f"{stage}_date_key IS NOT NULL")
    for stage in ("purchase", "approved", "carrier", "delivered", "estimated")
]
