"""Serving queries: argument validation, filters, ordering and not-found errors."""

import pytest

from dimforge.plans import serving


def _sellers(spark):
    return spark.createDataFrame(
        [("s1", "são paulo", "SP", "1"), ("s2", None, "SP", "2"), ("s3", "rio", None, "3"),
         ("s4", "a_b%c", "RJ", "4"), ("s5", "axbyc", "RJ", "5")],
        "seller_id string, seller_city string, seller_state string, seller_zip_code string")


def test_list_sellers_orders_nulls_last_and_validates_limit(spark):
    df = _sellers(spark)
    assert [r.seller_id for r in serving.list_sellers(df).collect()] == ["s4", "s5", "s1", "s2", "s3"]
    assert [r.seller_id for r in serving.list_sellers(df, state="sp").collect()] == ["s1", "s2"]
    for bad in (0, 501, "10"):
        with pytest.raises(ValueError):
            serving.list_sellers(df, limit=bad)


def test_city_filter_is_case_insensitive_substring_with_wildcards(spark):
    df = _sellers(spark)
    assert [r.seller_id for r in serving.list_sellers(df, city="SÃO").collect()] == ["s1"]
    # '_' and '%' in the argument stay wildcards
    assert [r.seller_id for r in serving.list_sellers(df, city="a_b").collect()] == ["s4", "s5"]


def test_date_arguments(spark):
    fi = spark.createDataFrame([(1, "o1", 1.0, 1.0)], "product_key long, order_id string, price double, freight_value double")
    dp = spark.createDataFrame([(1, "x")], "product_key long, category_name_english string")
    fi = fi.selectExpr("product_key", "order_id", "cast(price as decimal(10,2)) price",
                       "cast(freight_value as decimal(10,2)) freight_value", "date'2020-01-05' order_purchase_date")
    assert serving.revenue_by_category(fi, dp, "2020-01-05", "2020-01-05").count() == 1
    assert serving.revenue_by_category(fi, dp, date_from="2020-01-06").count() == 0
    assert serving.revenue_by_category(fi, dp, date_to="2020-01-04").count() == 0
    with pytest.raises(ValueError):
        serving.revenue_by_category(fi, dp, date_from="junk")
    with pytest.raises(ValueError):
        serving.revenue_by_category(fi, dp, limit=101)


def test_seller_snapshot_not_found_errors(spark):
    sellers = _sellers(spark).withColumn("seller_key", __import__("pyspark.sql.functions").sql.functions.lit(1))
    snap = spark.createDataFrame([], "seller_key long, snapshot_year_month string, total_orders int, "
                                     "total_items_sold int, total_revenue decimal(12,2), total_freight decimal(12,2), "
                                     "avg_review_score decimal(4,2), avg_delivery_delay_days decimal(8,2)")
    with pytest.raises(serving.NotFound, match="not found"):
        serving.seller_snapshot(snap, sellers, "nobody")
    with pytest.raises(serving.NotFound, match="No snapshot"):
        serving.seller_snapshot(snap, sellers, "s1")
