"""Plan shape: filters and columns reach the scan, bounded sides are broadcast, anti joins stay joins."""

from pyspark.sql import functions as F

from dimforge.plans import serving
from dimforge.plans.catalog import Warehouse, reset_warehouses

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    df = li.where(F.col("l_shipdate") >= "1998-01-01").select("l_orderkey")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in p


def test_published_items_are_pruned(spark):
    from dimforge.plans import catalog
    reset_warehouses()
    p = _plan(catalog.revenue_by_category_range(spark, SF))
    assert "PartitionFilters: [isnotnull(purchase_month" in p and "GreaterThanOrEqual(order_purchase_date,2016-03-01)" in p
    schema = next(line for line in p.split("ReadSchema: struct<") if "freight_value" in line.split(">")[0]).split(">")[0]
    assert "price" in schema and "customer_key" not in schema and "shipping_limit_date" not in schema


def test_items_meet_orders_in_one_join_that_can_split(spark):
    """An order with a third of the items: the only join on order_id at item grain is split."""
    from dimforge.plans import facts
    w = Warehouse(spark, SF)
    hot = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("or1")).otherwise(F.concat(F.lit("or"), (F.col("id") % 1500).cast("string"))).alias("order_id"),
        F.col("id").cast("string").alias("order_item_id"), 
        F.concat(F.lit("pr"), (F.col("id") % 90 + 1).cast("string")).alias("product_id"), F.concat(F.lit("se"), (F.col("id") % 9 + 1).cast("string")).alias("seller_id"),
        F.lit("2017-01-01 00:00:00").alias("shipping_limit_date"), F.lit("1.50").alias("price"), F.lit("0.25").alias("freight_value"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        built = facts.build_order_items({**w.raw, "raw_order_items": hot}, w.dims())
        done = built.select("order_id", "customer_key")
        n = done.collect()
        plan = _plan(done)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(n) > 0 and "skew=true" in plan


def test_quality_referential_is_anti_join(spark):
    from dimforge.operators import quality as Q
    a = spark.createDataFrame([(1,), (2,)], "k long")
    b = spark.createDataFrame([(1,)], "k long")
    res = Q.run_checks(spark, {"a": a, "b": b}, [Q.referential("x", "a", "fk", "k", "b", "k", "")])
    assert "LeftAnti" in res._jdf.queryExecution().optimizedPlan().toString()
    assert res.first().failed_count == 1


def test_revenue_plan_is_top_k(spark):
    fi = spark.createDataFrame([], "product_key long, order_id string, price decimal(10,2), "
                                   "freight_value decimal(10,2), order_purchase_date date")
    dp = spark.createDataFrame([], "product_key long, category_name_english string")
    assert "TakeOrderedAndProject" in _plan(serving.revenue_by_category(fi, dp))


def test_first_per_key_limits_before_the_shuffle(spark):
    from dimforge.operators.dedupe import first_per_key
    df = spark.createDataFrame([(1, 2, "a"), (1, 1, "b"), (2, 5, "c")], "k int, o int, v string")
    out = first_per_key(df, "k", ["o"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = _plan(out)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in p and "Partial" in p
    assert sorted((r.k, r.v) for r in out.collect()) == [(1, "b"), (2, "c")]


def test_roll_up_sums_money_as_longs(spark):
    from dimforge.plans import rollup
    fi = spark.createDataFrame([("2020-01-02", "a", 1, "99999999.99", "0.01"), ("2020-01-02", "a", 2, "0.01", "0.02"), ("2020-01-02", "b", 1, "1.10", "0.00")],
                               "d string, order_id string, product_key long, price string, freight_value string")
    fi = fi.select(F.col("d").cast("date").alias("order_purchase_date"), "order_id", "product_key",
                   *[F.col(c).cast("decimal(10,2)").alias(c) for c in ("price", "freight_value")])
    dp = spark.createDataFrame([(1, "x"), (2, "y")], "product_key long, category_name_english string")
    out = rollup.by_day(fi, dp)
    got = {r.category_name_english: (r.total_orders, r.total_items, str(r.total_revenue), str(r.total_freight)) for r in out.collect()}
    assert got == {"x": (2, 2, "100000001.09", "0.01"), "y": (1, 1, "0.01", "0.02")}
    assert "partial_sum(cast((price" in _plan(out) and "partial_sum(price" not in _plan(out)


def test_referential_checks_broadcast_no_referenced_keys(spark):
    """A dimension's keys are as many as its rows, however small its files are."""
    from dimforge.operators import quality as Q
    from dimforge.operators.keys import written
    a = written(spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "s string, k long"))
    b = written(spark.createDataFrame([("a", 1), ("b", 3)], "s string, k long"))
    cs = [Q.referential("x", "a", f"fk_{c}", c, "b", c, "") for c in ("s", "k")]
    res = Q.run_checks(spark, {"a": a, "b": b}, cs)
    anti = [line for line in _plan(res).split("== Initial Plan ==")[0].splitlines() if "LeftAnti" in line]
    assert len(anti) == 2 and all("SortMergeJoin" in line for line in anti)
    assert {r.check_name: r.failed_count for r in res.collect()} == {"fk_s": 1, "fk_k": 1}


def test_a_batch_is_looked_up_without_a_shuffle_of_all_items(spark):
    from dimforge.plans import catalog_loads
    w = Warehouse(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [_plan(raw["raw_order_items"]) for raw in (catalog_loads._batch(w.raw), catalog_loads._earlier_items(w.raw, F.lit(True)))]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all("BroadcastHashJoin" in p and "Exchange hashpartitioning" not in p for p in plans)
