"""Fact loads on hand-made raw rows: lifecycle stages, junk lookup, snapshot review handling."""

from decimal import Decimal

import pytest

from dimforge.plans import dims, facts

RAW_SCHEMAS = {
    "raw_customers": "customer_unique_id string, customer_id string, customer_zip_code_prefix string, "
                     "customer_city string, customer_state string",
    "raw_sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    "raw_products": "product_id string, product_category_name string, product_name_lenght string, "
                    "product_description_lenght string, product_photos_qty string, product_weight_g string, "
                    "product_length_cm string, product_height_cm string, product_width_cm string",
    "raw_category_translation": "product_category_name string, product_category_name_english string",
    "raw_orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
                  "order_approved_at string, order_delivered_carrier_date string, "
                  "order_delivered_customer_date string, order_estimated_delivery_date string",
    "raw_order_items": "order_id string, order_item_id string, product_id string, seller_id string, "
                       "shipping_limit_date string, price string, freight_value string",
    "raw_reviews": "review_id string, order_id string, review_score string, review_answer_timestamp string",
}

ORDERS = [
    # id, status, purchase, approved, carrier, delivered, estimated
    ("o1", "delivered", "2018-01-10 10:00:00", "2018-01-10 10:30:59", "2018-01-11 08:00:00",
     "2018-01-15 08:00:00", "2018-01-20 00:00:00"),                       # early delivery
    ("o2", "delivered", "2018-01-12 09:00:00", None, "2018-01-13 09:00:00",
     "2018-01-30 09:00:00", "2018-01-20 00:00:00"),                       # no approval, late
    ("o3", "delivered", "2018-02-01 00:00:00", "2018-01-31 23:00:00", None, "2018-02-05 00:00:00",
     None),                                                                # delivered, no estimate
    ("o4", "shipped", "2018-02-02 00:00:00", "2018-02-02 01:00:00", "2018-02-03 00:00:00", None,
     "2018-02-20 00:00:00"),                                               # not yet delivered
    ("o5", "on_hold", "2018-02-03 00:00:00", None, None, None, "2018-02-20 00:00:00"),  # unknown status
    ("o6", "delivered", "2017-10", None, None, None, None),               # unparseable purchase
]


@pytest.fixture(scope="module")
def loaded(spark):
    raw = {
        "raw_customers": [("u1", f"c{o[0]}", "01000", " Sao Paulo ", "sp ") for o in ORDERS],
        "raw_sellers": [("s1", "1", "city", "st"), ("s2", "2", "town", "st")],
        "raw_products": [("p1", "cat", "5", "10", "1", "100", "1", "1", "1")],
        "raw_category_translation": [("cat", "Category")],
        "raw_orders": [(o[0], f"c{o[0]}", *o[1:]) for o in ORDERS],
        "raw_order_items": [
            ("o1", "1", "p1", "s1", "2018-01-11 00:00:00", "10.00", "1.00"),
            ("o1", "2", "p1", "s1", "2018-01-11 00:00:00", "20.00", "2.00"),
            ("o1", "3", "p1", "s1", "2018-01-11 00:00:00", "n/a", "1.00"),   # dropped by cleansing
            ("o2", "1", "p1", "s2", "2018-01-13 00:00:00", "5.00", "0.50"),
            ("o4", "1", "p1", "s1", "2018-02-03 00:00:00", "7.00", "0.70"),
        ],
        "raw_reviews": [
            ("r1", "o1", "5", "2018-01-16 00:00:00"),
            ("r2", "o1", "3", "2018-01-17 00:00:00"),   # second review of o1
            ("r3", "o2", "1", "2018-01-31 00:00:00"),
            ("r3", "o4", "4", None),                     # same id, NULL answer time: loses
        ],
    }
    raw = {k: spark.createDataFrame(v, RAW_SCHEMAS[k]) for k, v in raw.items()}
    d = {
        "dim_customer": dims.load_dim_customer(spark, raw["raw_customers"]),
        "dim_seller": dims.load_dim_seller(spark, raw["raw_sellers"]),
        "dim_product": dims.load_dim_product(spark, raw["raw_products"], raw["raw_category_translation"]),
        "dim_order_flags": dims.load_dim_order_flags(spark),
    }
    flags = {r.order_flags_key: (r.order_status, r.is_late_delivery, r.is_multi_item)
             for r in d["dim_order_flags"].collect()}
    return raw, d, flags


def test_lifecycle_stages_and_junk_lookup(spark, loaded):
    raw, d, flags = loaded
    got = {r.order_id: r for r in facts.load_order_lifecycle(spark, raw, d).collect()}
    assert set(got) == {"o1", "o2", "o3", "o4", "o5"}          # o6 has no parseable purchase
    o1 = got["o1"]
    assert o1.approval_delay_hours == Decimal("0.50")          # 10:00 -> 10:30:59 = 30 minutes
    assert o1.vs_estimated_days == Decimal("-4.67")            # early
    assert flags[o1.order_flags_key] == ("delivered", False, True)
    o2 = got["o2"]
    assert o2.approval_delay_hours is None and o2.carrier_pickup_delay_hours is None
    assert o2.delivery_delay_days == Decimal("17.00") and o2.vs_estimated_days == Decimal("10.38")
    assert flags[o2.order_flags_key] == ("delivered", True, False)
    o3 = got["o3"]
    assert o3.approval_delay_hours == Decimal("-1.00")         # approved before purchase
    assert o3.order_flags_key is None                          # delivered, no estimate: NULL flag
    assert flags[got["o4"].order_flags_key] == ("shipped", False, False)
    assert got["o5"].order_flags_key is None                   # status outside the junk list
    assert got["o5"].estimated_date_key == 20180220 and got["o5"].approved_date_key is None


def test_items_fact(spark, loaded):
    raw, d, _ = loaded
    items = facts.load_order_items(spark, raw, d).collect()
    assert sorted((r.order_id, r.order_item_id, r.total_item_value) for r in items) == [
        ("o1", 1, Decimal("11.00")), ("o1", 2, Decimal("22.00")), ("o2", 1, Decimal("5.50")),
        ("o4", 1, Decimal("7.70"))]
    assert sorted(r.order_item_key for r in items) == [1, 2, 3, 4]


def test_snapshot_reviews_do_not_multiply_items(spark, loaded):
    raw, d, _ = loaded
    snap = {(r.seller_key, r.snapshot_year_month): r
            for r in facts.load_seller_monthly_snapshot(spark, raw, d).collect()}
    s1_jan = snap[(1, "2018-01")]
    # o1 has two reviews: still 2 items and 30.00 revenue; average over item x review pairs
    assert (s1_jan.total_orders, s1_jan.total_items_sold, s1_jan.total_revenue) == (1, 2, Decimal("30.00"))
    assert s1_jan.avg_review_score == Decimal("4.00")
    assert s1_jan.avg_delivery_delay_days == Decimal("-4.67")
    assert snap[(2, "2018-01")].avg_review_score == Decimal("1.00")
    s1_feb = snap[(1, "2018-02")]
    assert s1_feb.avg_review_score is None and s1_feb.avg_delivery_delay_days is None


def test_order_facts_share_their_orders(spark, monkeypatch):
    """A build of both order facts resolves the orders once; rows are as without."""
    from dimforge.plans import catalog, facts

    made, real = [], facts.order_grain
    monkeypatch.setattr(facts, "order_grain", lambda *a: made.append(1) or real(*a))
    w = catalog.Warehouse(spark, "/root/testdata/sf0.001")
    w.fct_order_items, w.fct_order_lifecycle
    assert made == [1]
    alone = facts.build_order_items(w.raw, w.dims())
    assert alone.exceptAll(w.fct_order_items.select(alone.columns)).isEmpty() and alone.count() == w.fct_order_items.count()
