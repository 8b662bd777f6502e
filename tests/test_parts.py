"""Loads that touch only the parts they change: file lists, keys, rules, concurrent runs."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from dimforge import schemas
from dimforge.operators import quality
from dimforge.operators.keys import DuplicateKeyError
from dimforge.operators.merge import insert_if_absent, replace_by_key, upsert
from dimforge.operators.scd2 import scd2_apply
from dimforge.plans import check_states, checks
from dimforge.plans.keyed import apply_history, upsert_buckets
from dimforge.plans.pipeline import run_pipeline
from dimforge.plans.publish import ConcurrentRun, TableStore, keys_of
from dimforge.plans.reload import reload_fact
from dimforge.sources import literals
from dimforge.sources.standins import raw_standins
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2023, 1, 1)


@pytest.fixture
def store(spark):
    return TableStore(spark, tempfile.mkdtemp(prefix="dimforge-wh-"))


def items(spark, given):
    """(order, item, price, day) rows of the item fact without its surrogate key."""
    return spark.createDataFrame(
        [(int(day.replace("-", "")), 1, 1, 1, 1, o, i, float(p), 0.0, float(p), None, dt.date.fromisoformat(day)) for o, i, p, day in given],
        "order_date_key int, customer_key long, seller_key long, product_key long, order_flags_key long, order_id string, order_item_id int,"
        "price double, freight_value double, total_item_value double, shipping_limit_date timestamp_ntz, order_purchase_date date",
    )


def load_items(spark, store, given, scope=None, commit=True):
    version = store.next_version("x")
    orders = sorted({g[0] for g in given if g[0] is not None}) if scope is None else scope
    reload_fact(store, "fct_order_items", items(spark, given), spark.createDataFrame([(o,) for o in orders], "order_id string"), "order_id", version)
    if commit:
        store.commit(version, list(store.pending))
    return version


def keyed(store):
    return {(r.order_id, r.order_item_id): (r.order_item_key, float(r.price)) for r in store.read("fct_order_items").collect()}


def test_one_month_leaves_the_others_files(spark, store):
    load_items(spark, store, [("a", 1, 1, "2016-01-05"), ("b", 1, 2, "2016-02-05"), ("c", 1, 3, "2016-02-09"), ("d", 1, 4, "2016-03-01")])
    before = store.files("fct_order_items")
    load_items(spark, store, [("b", 1, 20, "2016-02-05"), ("b", 2, 21, "2016-02-05")])
    after = store.files("fct_order_items")
    for month in ("2016-01", "2016-03"):
        mine = {f for f in before if f"purchase_month={month}" in f}
        assert mine and mine == {f for f in after if f"purchase_month={month}" in f}
    assert not {f for f in before if "purchase_month=2016-02" in f} & after.keys()
    assert keyed(store) == {("a", 1): (1, 1), ("b", 1): (2, 20), ("c", 1): (3, 3), ("d", 1): (4, 4), ("b", 2): (5, 21)}


def test_an_order_that_moves_touches_both_months(spark, store):
    load_items(spark, store, [("a", 1, 1, "2016-01-05"), ("b", 1, 2, "2016-01-06"), ("c", 1, 3, "2016-02-09"), ("d", 1, 3, "2016-03-09")])
    first = store.manifest()["version"]
    version = load_items(spark, store, [("b", 1, 2, "2016-02-06")])
    parts = store.entry("fct_order_items")["parts"]
    assert {m: f.split("/")[0][2:] for m, f in parts.items()} == {
        "purchase_month=2016-01": version, "purchase_month=2016-02": version, "purchase_month=2016-03": first}
    assert keyed(store)[("b", 1)] == (2, 2) and len(keyed(store)) == 4


def test_an_emptied_month_loses_its_part(spark, store):
    load_items(spark, store, [("a", 1, 1, "2016-01-05"), ("b", 1, 2, "2016-02-06")])
    load_items(spark, store, [], scope=["a"])
    assert list(store.entry("fct_order_items")["parts"]) == ["purchase_month=2016-02"]
    assert keyed(store) == {("b", 1): (2, 2)}
    load_items(spark, store, [], scope=["b"])
    assert keyed(store) == {}


def test_keys_outlive_rows_and_lost_runs(spark, store):
    load_items(spark, store, [("a", 1, 1, "2016-01-05"), ("b", 1, 2, "2016-01-06")])
    load_items(spark, store, [], scope=["a"])
    load_items(spark, store, [("n", 1, 5, "2016-05-05"), ("m", 1, 5, "2016-05-05")], commit=False)  # a lost run
    load_items(spark, store, [("a", 1, 7, "2016-01-05"), ("z", 1, 5, "2016-05-05")])
    assert keyed(store) == {("a", 1): (1, 7), ("b", 1): (2, 2), ("z", 1): (3, 5)}
    # only new natural keys were numbered and appended
    sizes = [store.read(keys_of("fct_order_items"), labels=[x]).count() for x in store.entry(keys_of("fct_order_items"))["parts"]]
    assert sizes == [2, 0, 1]


def test_reload_equals_the_whole_table_form(spark, store):
    import random

    draw = random.Random(8)
    current = None
    for step in range(3):
        batch = {}
        for _ in range(40):
            o = f"o{draw.randint(0, 30)}"
            batch[o] = f"20{draw.randint(15, 16)}-{draw.randint(1, 12):02d}-03"
        given = [(o, i, draw.randint(1, 99), day) for o, day in batch.items() for i in range(1, draw.randint(2, 4))]
        load_items(spark, store, given)
        fresh, scope = items(spark, given), spark.createDataFrame([(o,) for o in batch], "order_id string")
        current = schemas.empty(spark, "fct_order_items") if current is None else current
        current = schemas.conform(replace_by_key(current, fresh, scope, "order_id", ["order_id", "order_item_id"], "order_item_key"), "fct_order_items").localCheckpoint()
        cols = [c for c in current.columns if c != "order_item_key"]
        assert rows(store.read("fct_order_items"), *cols) == rows(current, *cols)
        keys = [k for k, _ in keyed(store).values()]
        assert len(set(keys)) == len(keys)


def test_null_keys_and_duplicates_in_a_reload(spark, store):
    given = [("a", 1, 1, "2016-01-05"), (None, 1, 9, "2016-01-06"), ("a", None, 9, "2016-01-05")]
    for _ in range(2):
        load_items(spark, store, given)
        assert keyed(store) == {("a", 1): (1, 1)}
    with pytest.raises(DuplicateKeyError):
        load_items(spark, store, [("a", 1, 1, "2016-01-05"), ("a", 1, 2, "2016-01-05")])


SET = ["seller_zip_code", "seller_city", "seller_state"]


def sellers(spark, changed=(), n=200):
    given = [(f"s{i}", "z", "moved" if i in changed else f"c{i}", None if i == 3 else "ST") for i in range(n)]
    return spark.createDataFrame(given, "seller_id string, seller_zip_code string, seller_city string, seller_state string")


def run(store, load):
    version = store.next_version("x")
    load(version)
    store.commit(version, list(store.pending))
    return version


def test_an_upsert_writes_only_buckets_that_change(spark, store):
    run(store, lambda v: upsert_buckets(store, "dim_seller", sellers(spark), SET, v))
    before = store.files("dim_seller")
    assert len(store.entry("dim_seller")["parts"]) == 16
    run(store, lambda v: upsert_buckets(store, "dim_seller", sellers(spark), SET, v))  # nothing new
    assert store.files("dim_seller") == before
    target = store.read("dim_seller").localCheckpoint()
    source = sellers(spark, changed=(7,)).where("seller_id IN ('s7', 's8', 's9')")
    run(store, lambda v: upsert_buckets(store, "dim_seller", source, SET, v))
    assert len(before.keys() - store.files("dim_seller").keys()) == 1
    assert rows(store.read("dim_seller")) == rows(upsert(target, source, "seller_id", SET, "seller_key").select(target.columns))
    # new sellers get the next keys, in key order
    run(store, lambda v: upsert_buckets(store, "dim_seller", sellers(spark, n=203), SET, v))
    got = {r.seller_id: r.seller_key for r in store.read("dim_seller").collect()}
    assert [got["s200"], got["s201"], got["s202"]] == [201, 202, 203] and len(got) == 203
    with pytest.raises(DuplicateKeyError):
        upsert_buckets(store, "dim_seller", sellers(spark, n=2).unionByName(sellers(spark, n=1)), SET, store.next_version("x"))


def test_a_history_writes_only_buckets_that_change(spark, store):
    t1, t2 = ["seller_zip_code"], ["seller_city", "seller_state"]
    history = lambda src, day: run(store, lambda v: apply_history(store, "dim_seller_hist", src, t1, t2, day, v))
    history(sellers(spark), AS_OF)
    before = store.files("dim_seller_hist")
    history(sellers(spark), dt.date(2023, 2, 1))
    assert store.files("dim_seller_hist") == before
    target = store.read("dim_seller_hist").localCheckpoint()
    source = sellers(spark, changed=(5,), n=201)
    history(source, dt.date(2023, 3, 1))
    assert 1 <= len(before.keys() - store.files("dim_seller_hist").keys()) <= 2  # s5's bucket and s200's
    expected = scd2_apply(target, source, "seller_id", t1, t2, dt.date(2023, 3, 1), "seller_hist_key")
    assert rows(store.read("dim_seller_hist")) == rows(expected.select(target.columns))
    with pytest.raises(ValueError, match="back-dated"):
        history(source, dt.date(2023, 2, 15))


def test_rows_without_a_key_never_go_in(spark, store):
    bad = sellers(spark, n=5).unionByName(sellers(spark, n=2).withColumn("seller_id", F.lit(None).cast("string")))
    target = schemas.empty(spark, "dim_seller")
    hist = schemas.empty(spark, "dim_seller_hist")
    for _ in range(2):
        target = upsert(target, bad, "seller_id", SET, "seller_key").localCheckpoint()
        hist = scd2_apply(hist, bad, "seller_id", SET[:1], SET[1:], AS_OF, "seller_hist_key").localCheckpoint()
        run(store, lambda v: upsert_buckets(store, "dim_seller", bad, SET, v))
        run(store, lambda v: apply_history(store, "dim_seller_hist", bad, SET[:1], SET[1:], AS_OF, v))
        assert target.count() == hist.count() == store.read("dim_seller").count() == store.read("dim_seller_hist").count() == 5
    flat = target.select("seller_id", "seller_city")
    assert insert_if_absent(flat, bad.select(flat.columns), "seller_id").count() == 5


def test_a_null_that_breaks_a_rule_is_refused_before_commit(spark, store):
    run(store, lambda v: upsert_buckets(store, "dim_seller", sellers(spark, n=3), SET, v))
    version = store.next_version("x")
    bad = store.read("dim_seller").withColumn("seller_id", F.when(F.col("seller_key") > 1, F.col("seller_id")))
    with pytest.raises(Exception, match="NULL in dim_seller.seller_id"):
        store.publish("dim_seller", bad, version)
    assert "dim_seller" not in store.pending
    assert store.read("dim_seller").where("seller_id IS NULL").count() == 0


def test_of_two_runs_from_one_state_one_commits(spark, store):
    run(store, lambda v: upsert_buckets(store, "dim_seller", sellers(spark, n=3), SET, v))
    other = TableStore(spark, store.root)
    mine, theirs = store.next_version("mine"), other.next_version("theirs")
    upsert_buckets(store, "dim_seller", sellers(spark, changed=(1,), n=3), SET, mine)
    other.publish("dim_payment_type", literals.payment_types(spark).limit(1), theirs)
    other.commit(theirs, ["dim_payment_type"])
    with pytest.raises(ConcurrentRun):
        store.commit(mine, ["dim_seller"])
    assert store.read("dim_payment_type").count() == 1
    assert store.read("dim_seller").where("seller_city = 'moved'").count() == 0
    assert [n for n in store._names(f"{store.root}/_runs") if n.startswith(".0")] == []
    # it starts again from what the other left
    run(store, lambda v: upsert_buckets(store, "dim_seller", sellers(spark, changed=(1,), n=3), SET, v))
    assert store.read("dim_seller").where("seller_city = 'moved'").count() == 1


def test_the_log_grows_by_its_new_rows_alone(spark, store):
    sizes = []
    for n in range(20):
        row = [(dt.datetime(2023, 1, 1, n), "dim", "dim_date", f"check {k}", "PASS", 0, None) for k in range(3)]
        version = run(store, lambda v: store.append("dqc_results", spark.createDataFrame(row, schemas.SCHEMAS["dqc_results"]).coalesce(1), v))
        sizes.append(sum(store.files("dqc_results", f"v={version}").values()))
    assert max(sizes) - min(sizes) < 64
    assert store.read("dqc_results").count() == 60
    latest = store.latest_part("dqc_results")
    assert {r.run_timestamp.hour for r in latest.collect()} == {19} and len(latest.inputFiles()) == 1


def test_vacuum_keeps_what_kept_runs_name(spark, store):
    a = load_items(spark, store, [("a", 1, 1, "2016-01-05"), ("b", 1, 2, "2016-02-05")])
    b = load_items(spark, store, [("b", 1, 3, "2016-02-05")])
    c = load_items(spark, store, [("b", 1, 4, "2016-02-05")])
    gone = store.vacuum(keep=2)
    assert gone["fct_order_items"] == [f"v={a}/purchase_month=2016-02"]
    assert {float(r.price) for r in store.read("fct_order_items", b).collect()} == {1, 3}
    assert {float(r.price) for r in store.read("fct_order_items", c).collect()} == {1, 4}
    assert store.read("fct_order_items", a) is None
    load_items(spark, store, [("a", 1, 5, "2016-01-05")])
    assert keyed(store) == {("a", 1): (1, 5), ("b", 1): (2, 4)}


def test_a_month_batch_through_the_whole_run(spark):
    """Second run with one month's orders: other months' files stay, checks scan what was
    written, and their results equal those of whole scans."""
    root = tempfile.mkdtemp(prefix="dimforge-wh-")
    raw = raw_standins(spark, SF)
    first = run_pipeline(spark, raw, root, AS_OF, dt.datetime(2023, 1, 1, 6))
    store = TableStore(spark, root)
    files = {t: store.files(t) for t in schemas.WAREHOUSE_TABLES}
    before = rows(store.read("fct_order_items"))
    month = "2016-03"
    orders = raw["raw_orders"].where(F.col("order_purchase_timestamp").startswith(month))
    ids = orders.select("order_id")
    batch = {**raw, "raw_orders": orders, "raw_order_items": raw["raw_order_items"].join(ids, "order_id", "left_semi").withColumn("freight_value", F.lit("0.00"))}
    second = run_pipeline(spark, batch, root, AS_OF, dt.datetime(2023, 1, 2, 6))
    assert second["written"]["fct_order_items"] == [f"purchase_month={month}"]
    assert second["written"]["fct_order_lifecycle"] == [f"purchase_month={month}"]
    assert second["written"]["fct_seller_monthly_snapshot"] == [f"snapshot_year_month={month}"]
    for t in schemas.DIMENSIONS:
        assert second["written"][t] == [] and store.files(t) == files[t], t
    for t in schemas.FACTS:
        assert {f for f in files[t] if month not in f} == {f for f in store.files(t) if month not in f}
        assert all(month in x for x in second["scanned"][t]) and second["scanned"][t]
    after = store.read("fct_order_items")
    untouched = F.date_format("order_purchase_date", "yyyy-MM") != month
    assert rows(after.where(untouched)) == [r for r in before if r[-1].strftime("%Y-%m") != month]
    assert after.where(~untouched & (F.col("freight_value") != 0)).count() == 0 < after.where(~untouched).count()
    tables = {t: store.read(t) for t in schemas.WAREHOUSE_TABLES}
    everything = checks.DIM_CHECKS + checks.FCT_CHECKS + checks.EXTRA_FCT_CHECKS
    whole = quality.run_checks(spark, tables, everything)
    cols = ("layer", "table_name", "check_name", "status", "failed_count", "note")
    assert rows(second["dqc"], *cols) == rows(whole, *cols)
    assert rows(first["row_counts"]) == rows(second["row_counts"])
    assert {r.table_name: r.n for r in second["row_counts"].collect()} == {t: df.count() for t, df in tables.items()}


def test_the_rollup_follows_months_and_categories(spark, store):
    from dimforge.plans import rollup, serving

    def products(names):
        return spark.createDataFrame(
            [(f"p{i}", n, n, None, None, None, None, None, None, None) for i, n in enumerate(names, 1)],
            "product_id string, category_name string, category_name_english string, product_name_length int, product_description_length int, product_photos_qty int,"
            "product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int")  # fmt: skip

    from dimforge.plans.dims import PRODUCT_SET_COLS

    def load(names, given):
        version = store.next_version("x")
        upsert_buckets(store, "dim_product", products(names), PRODUCT_SET_COLS, version)
        fresh = items(spark, given).withColumn("product_key", F.col("order_item_id").cast("long"))
        reload_fact(store, "fct_order_items", fresh, spark.createDataFrame([(g[0],) for g in given], "order_id string"), "order_id", version)
        rollup.refresh(store, version)
        written = store.pending[rollup.TABLE]["written"]
        store.commit(version, list(store.pending))
        got = rollup.revenue_by_category(store.read(rollup.TABLE)).collect()
        assert got == serving.revenue_by_category(store.read("fct_order_items"), store.read("dim_product")).collect()
        assert rollup.revenue_by_category(store.read(rollup.TABLE), "2016-01-05", "2016-02-05").collect() == serving.revenue_by_category(
            store.read("fct_order_items"), store.read("dim_product"), "2016-01-05", "2016-02-05").collect()
        return written

    jan, feb, mar = (f"purchase_month=2016-0{m}" for m in (1, 2, 3))
    assert load(["a", "a", "b"], [("x", 1, 1, "2016-01-05"), ("x", 2, 2, "2016-01-05"), ("y", 3, 5, "2016-02-05"), ("z", 1, 7, "2016-03-05")]) == [jan, feb, mar]
    assert load(["a", "a", "b"], [("y", 3, 6, "2016-02-05"), ("y", 1, 6, "2016-02-05")]) == [feb]
    assert load(["a", "b", "b"], [("z", 1, 7, "2016-03-05")]) == [jan, mar]  # product 2 moves, z is loaded again
    assert load(["a", "b", "b"], [("y", 3, 6, "2016-01-09")]) == [jan]  # y moves, and its other item goes: no February


def test_catalog_tables_follow_the_manifest(spark, store):
    load_items(spark, store, [("a", 1, 1, "2016-01-05"), ("b", 1, 2, "2016-02-05"), ("c", 1, 3, "2016-03-09")])
    run(store, lambda v: upsert_buckets(store, "dim_seller", sellers(spark, n=20), SET, v, buckets=4))
    load_items(spark, store, [("b", 1, 9, "2016-02-05"), ("b", 2, 9, "2016-02-05")])
    names = ["fct_order_items", "dim_seller"]
    try:
        assert sorted(store.register_tables(names)) == sorted(names)
        for name in names:
            columns = schemas.SCHEMAS[name].names
            assert rows(spark.table(f"default.{name}").select(columns)) == rows(store.read(name).select(columns))
        stats = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED default.fct_order_items").collect()}
        assert "4 rows" in stats["Statistics"] and stats["Type"] == "EXTERNAL"
        month = spark.sql("SELECT price FROM default.fct_order_items WHERE purchase_month = '2016-02'")
        assert sorted(float(r.price) for r in month.collect()) == [9.0, 9.0]
        assert all("purchase_month=2016-02" in f for f in month.inputFiles())
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS default.{name}")
    assert store.read("fct_order_items").count() == 4  # dropping the tables left the files


def test_states_count_each_broken_part(spark, store):
    given = [("a", 1, 1, "2016-01-05"), ("b", 1, 0, "2016-02-05"), ("c", 1, 0, "2016-02-06")]
    load_items(spark, store, given)
    version = store.next_version("x")
    load = [c for c in checks.FCT_CHECKS if c.table == "fct_order_items" and c.family == "P"]
    reload_fact(store, "fct_order_items", items(spark, [("d", 1, 0, "2016-03-05")]), spark.createDataFrame([("d",)], "order_id string"), "order_id", version)
    scanned = check_states.update(store, load)["fct_order_items"]
    assert sorted(scanned) == [f"purchase_month=2016-0{m}" for m in (1, 2, 3)]  # none had a state yet
    got = {r.check_name: r.failed_count for r in check_states.results(store, load, dt.datetime(2023, 1, 1)).collect()}
    assert got["price_positive"] == 3
    store.commit(version, list(store.pending))
    version = store.next_version("x")
    reload_fact(store, "fct_order_items", items(spark, [("b", 1, 4, "2016-02-05")]), spark.createDataFrame([("b",)], "order_id string"), "order_id", version)
    assert check_states.update(store, load)["fct_order_items"] == ["purchase_month=2016-02"]
    got = {r.check_name: r.failed_count for r in check_states.results(store, load, dt.datetime(2023, 1, 1)).collect()}
    assert got["price_positive"] == 2


def test_a_long_side_table_of_keys_is_not_broadcast(spark, store, monkeypatch):
    """Keys in order are a few bytes a row on disk, so Spark would take them for a small side."""
    from dimforge.operators.joins import BROADCAST_BYTES
    from dimforge.plans import reload
    n = BROADCAST_BYTES // 28 + 1
    known = spark.range(n).select(F.concat(F.lit("or"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("order_id"), (F.col("id") + 1).alias("order_lifecycle_key"))
    first = store.next_version("x")
    store.append(keys_of("fct_order_lifecycle"), known, first)
    store.replace_parts("fct_order_lifecycle", schemas.empty(spark, "fct_order_lifecycle"), first, ["purchase_month=2016-01"], next_key=n + 1)
    store.commit(first, list(store.pending))
    assert sum(store.files(keys_of("fct_order_lifecycle")).values()) < 10 << 20
    plans, write = [], reload.written
    monkeypatch.setattr(reload, "written", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    fresh = spark.createDataFrame([("or000000007",), ("new",)], "order_id string")
    keyed, next_key = reload.with_keys(store, "fct_order_lifecycle", fresh, store.next_version("y"))
    assert "SortMergeJoin" in plans[0] and "BroadcastHashJoin" not in plans[0]
    assert rows(keyed) == [("new", n + 1), ("or000000007", 8)] and next_key == n + 2


def test_dimensions_are_not_broadcast_by_the_bytes_of_their_files(spark, store, monkeypatch):
    """Second loads of both kinds: sides over the bound on rows x width meet by a sort merge."""
    from dimforge.operators import joins, scd2
    from dimforge.plans import dims, keyed, reload
    sellers = lambda city: spark.range(300).select(
        F.concat(F.lit("se"), F.col("id").cast("string")).alias("seller_id"), F.lit("1").alias("seller_zip_code"),
        F.when(F.col("id") % 2 == 0, city).otherwise("y").alias("seller_city"), F.lit("s").alias("seller_state"))
    plans, write = [], keyed.written
    note = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 300 * 20)
    monkeypatch.setattr(keyed, "written", note)
    monkeypatch.setattr(scd2, "written", note)
    monkeypatch.setattr(keyed, "values", lambda df, c: plans.append(df._jdf.queryExecution().executedPlan().toString()) or reload.values(df, c))
    for city in ("x", "z"):
        plans.clear()
        version = store.next_version("x")
        upsert_buckets(store, "dim_seller", sellers(city), dims.SELLER_SET_COLS, version)
        apply_history(store, "dim_seller_hist", sellers(city), dims.SELLER_HIST_TYPE1, dims.SELLER_HIST_TYPE2, AS_OF if city == "z" else dt.date(2020, 1, 1), version)
        store.commit(version, list(store.pending))
    joined = [p for p in plans if "Join" in p]
    sent = [line for p in joined for line in p.splitlines() if "BroadcastHashJoin" in line and "_kpid" not in line]  # starts of files are few
    assert len(joined) >= 3 and sent == []
    assert store.read("dim_seller").where("seller_city = 'z'").count() == 150 and store.read("dim_seller_hist").count() == 450
