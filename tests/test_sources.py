"""Raw files by name with declared schemas; bound query parameters."""

import datetime as dt
import os
import tempfile

import pytest

from dimforge.plans import serving
from dimforge.plans.pipeline import run_pipeline
from dimforge.plans import facts, staging
from dimforge.plans.catalog_loads import raw_files
from dimforge.sources.raw import PARQUET_FILES, RawSchemaError, read_raw, register_raw_views
from dimforge.sources.standins import raw_standins
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def _write_raw_folder(spark, folder):
    raw = raw_standins(spark, SF)
    for name, fname in PARQUET_FILES.items():
        df = raw.get(name)
        if df is None:  # payments: registered, read by no load
            df = spark.createDataFrame([("o1", "1", "boleto", "1", "10.5")],
                                       "order_id string, payment_sequential string, payment_type string, "
                                       "payment_installments string, payment_value string")
        df.coalesce(1).write.parquet(os.path.join(folder, fname))
    return raw


def test_pipeline_from_raw_files_equals_pipeline_from_frames(spark):
    folder = tempfile.mkdtemp(prefix="dimforge-raw-")
    raw = _write_raw_folder(spark, folder)
    views = register_raw_views(spark, folder)
    assert set(views) == set(PARQUET_FILES)
    assert all(dict(v.dtypes)[c] == "string" for v in views.values() for c in v.columns)
    a = run_pipeline(spark, folder, tempfile.mkdtemp(prefix="dimforge-wh-"), dt.date(2023, 1, 1),
                     dt.datetime(2023, 1, 1, 6))
    b = run_pipeline(spark, raw, tempfile.mkdtemp(prefix="dimforge-wh-"), dt.date(2023, 1, 1),
                     dt.datetime(2023, 1, 1, 6))
    for t in ("dim_customer", "dim_product_hist", "fct_order_items", "fct_seller_monthly_snapshot"):
        assert rows(a["tables"][t]) == rows(b["tables"][t]), t


def test_missing_raw_file_is_fatal(spark):
    folder = tempfile.mkdtemp(prefix="dimforge-raw-empty-")
    with pytest.raises(FileNotFoundError, match="raw files missing"):
        register_raw_views(spark, folder)


def test_query_binds_parameters(spark):
    df = serving.query(spark, "SELECT :x + 1 AS y, upper(:s) AS s", {"x": 41, "s": "o'brien"})
    r = df.first()
    assert (r.y, r.s) == (42, "O'BRIEN")


def test_typed_files_are_scanned_without_casts(spark):
    folder = raw_files(spark, raw_standins(spark, SF), tempfile.mkdtemp(prefix="dimforge-raw-"))
    views = register_raw_views(spark, folder)
    assert dict(views["raw_order_items"].dtypes)["price"] == "decimal(10,2)"
    assert dict(views["raw_products"].dtypes)["product_weight_g"] == "string"
    plan = staging.stg_items(views["raw_order_items"])._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(price)" in plan and "IsNotNull(freight_value)" in plan and "cast(" not in plan
    plan = facts.bought_orders(views["raw_orders"])._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(order_purchase_timestamp)" in plan and "cast(" not in plan
    text = raw_standins(spark, SF)
    for stage, name in ((staging.stg_items, "raw_order_items"), (staging.stg_orders, "raw_orders"), (staging.stg_reviews, "raw_reviews")):
        assert rows(stage(views[name])) == rows(stage(text[name])), name


def test_a_file_that_breaks_its_declaration_is_refused(spark):
    folder = tempfile.mkdtemp(prefix="dimforge-raw-")
    path = os.path.join(folder, PARQUET_FILES["raw_order_items"])
    spark.createDataFrame([("o", True, "p", "s", 1.5)], "order_id string, order_item_id boolean, product_id string, seller_id string, price double").write.parquet(path)
    with pytest.raises(RawSchemaError, match=r"order_item_id \(boolean\), shipping_limit_date, freight_value"):
        read_raw(spark, folder, "raw_order_items")


def test_typed_numbers_follow_the_rules_of_their_kind(spark):
    from dimforge.functions.exprs import declared

    df = spark.createDataFrame([(2.5, 7.5, 2**40, float("nan"))], "a double, b double, c long, d double").selectExpr("*", "cast(2.5 as decimal(5,1)) e", "date'2020-01-02' f")
    got = df.select(declared(df, "a", "int"), declared(df, "b", "int"), declared(df, "c", "int"), declared(df, "d", "int"), declared(df, "e", "int"), declared(df, "f", "timestamp_ntz"), declared(df, "a", "decimal(10,2)")).first()
    assert tuple(got)[:5] == (2, 8, None, None, 3) and got[5] == dt.datetime(2020, 1, 2) and str(got[6]) == "2.50"


def test_shared_raw_relations_are_files(spark):
    """The raw relations that queries share are derived once, on first access, and read as
    Parquet with pruned columns; they equal the derivation."""
    from dimforge.plans.catalog import RawTables

    raw = RawTables(spark, SF, tempfile.mkdtemp(prefix="dimforge-rawtables-"))
    derived = raw_standins(spark, SF)
    assert set(raw) == set(derived) and "raw_payments" not in raw
    items = raw["raw_order_items"]
    assert raw["raw_order_items"] is items and items.inputFiles()
    plan = items.select("order_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<order_id:string>" in plan and "InMemoryTableScan" not in plan
    assert items.exceptAll(derived["raw_order_items"]).isEmpty() and items.count() == derived["raw_order_items"].count()
