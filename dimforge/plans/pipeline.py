"""The ordered, idempotent warehouse run.

    raw views -> dimensions -> facts -> dimension checks -> fact checks -> report

A run reads the last committed state and the raw relations (everything, or a batch) and writes
the parts that change: key buckets of dimensions, months of facts, its own part of the check
log (``plans.keyed``, ``plans.reload``, ``plans.publish``).  Facts read the dimensions just
written.  Tables of one wave (all dimensions; then all facts) do not depend on each other, so
their Spark jobs are submitted concurrently.  The first failing load aborts the run (nothing
after it is written and nothing is committed); failing quality checks do not -- they are
recorded and reported.  Running twice with the same input and ``as_of`` publishes the same
content again, surrogate keys included.  If another run commits in between, this one fails and
leaves that one's tables as they are.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators import quality
from ..operators.keys import require_unique
from ..sources.raw import register_raw_views
from . import check_states, checks, dims, facts, rollup, staging
from .keyed import BUCKETS, apply_history, upsert_buckets
from .publish import TableStore


def run_pipeline(
    spark: SparkSession,
    raw: dict[str, DataFrame] | str,
    warehouse_dir: str,
    as_of: dt.date,
    run_ts: dt.datetime | None = None,
    fail_on_check: bool = False,
    threads: int = 4,
    keep_versions: int | None = None,
    buckets: int = BUCKETS,
) -> dict:
    """Load the warehouse under ``warehouse_dir`` from ``raw`` (a folder of raw files or a
    dict of raw DataFrames): everything, or a batch whose orders and months replace what they
    cover.  Returns the published tables and the run report, with the parts written and those
    scanned by checks.  ``keep_versions`` keeps that many runs for rollback.  ``buckets`` deals
    the dimensions at their first load."""
    run_ts = (run_ts or dt.datetime.now()).replace(microsecond=0)
    run_id = run_ts.strftime("%Y%m%dT%H%M%S")
    if isinstance(raw, str):
        raw = register_raw_views(spark, raw)
    store = TableStore(spark, warehouse_dir)
    version = store.next_version(run_id)
    pub: dict[str, DataFrame] = {}

    def wave(loads: dict):
        # the loads of one wave are independent: their jobs run concurrently; the first
        # failure propagates and stops the run before the next wave is written
        with ThreadPoolExecutor(threads) as pool:
            futures = {name: pool.submit(f) for name, f in loads.items()}
            for name, f in futures.items():
                pub[name] = f.result()

    def absent(name, load):
        # fixed small tables: rows that aren't there yet go in; most runs add none
        cur = store.read(name)
        rows = load(spark, cur)
        if cur is not None and not rows.exceptAll(cur).limit(1).count():
            return store.replace_parts(name, None, version, [])
        return store.publish(name, rows, version)

    customers = lambda: staging.stg_customers(raw["raw_customers"])
    sellers = lambda: staging.stg_sellers(raw["raw_sellers"])
    products = lambda: staging.stg_products(raw["raw_products"], raw["raw_category_translation"])
    require_unique(raw["raw_category_translation"], "product_category_name", "category translation")
    upsert = lambda name, rows, cols: upsert_buckets(store, name, rows(), cols, version, buckets)
    history = lambda name, rows, t1, t2: apply_history(store, name, rows(), t1, t2, as_of, version, buckets)
    wave({
        "dim_date": lambda: absent("dim_date", dims.load_dim_date),
        "dim_payment_type": lambda: absent("dim_payment_type", dims.load_dim_payment_type),
        "dim_order_flags": lambda: absent("dim_order_flags", dims.load_dim_order_flags),
        "dim_customer": lambda: upsert("dim_customer", customers, dims.CUSTOMER_SET_COLS),
        "dim_seller": lambda: upsert("dim_seller", sellers, dims.SELLER_SET_COLS),
        "dim_product": lambda: upsert("dim_product", products, dims.PRODUCT_SET_COLS),
        "dim_seller_hist": lambda: history("dim_seller_hist", sellers, dims.SELLER_HIST_TYPE1, dims.SELLER_HIST_TYPE2),
        "dim_product_hist": lambda: history("dim_product_hist", products, dims.PRODUCT_HIST_TYPE1, dims.PRODUCT_HIST_TYPE2),
    })
    d = {k: pub[k] for k in ("dim_customer", "dim_seller", "dim_product", "dim_order_flags")}
    wave(facts.reload_facts(store, raw, d, version))

    pub[rollup.TABLE] = rollup.refresh(store, version)
    all_checks = checks.DIM_CHECKS + checks.FCT_CHECKS + checks.EXTRA_FCT_CHECKS
    scanned = check_states.update(store, all_checks)
    latest = check_states.results(store, all_checks, run_ts)
    pub["dqc_results"] = store.append("dqc_results", latest, version)  # the log keeps every run
    written = {t: store.pending[t]["written"] for t in pub}
    counts = [(t, check_states.row_count(store.pending[t])) for t in schemas.WAREHOUSE_TABLES]

    if fail_on_check and quality.failures(latest).limit(1).count():
        # the log of the checks is kept, the tables stay as the run before left them
        store.commit(version, ["dqc_results"])
        raise RuntimeError(f"quality checks failed in run {run_id}")
    store.commit(version, list(store.pending))

    if keep_versions:  # older runs are kept for rollback until trimmed here
        store.vacuum(keep_versions)

    report = {
        "run_id": run_id,
        "version": version,
        "tables": pub,
        "written": written,
        "scanned": scanned,
        "row_counts": spark.createDataFrame(counts, "table_name string, n long"),
        "dqc": latest,
        "dqc_summary": quality.summary(latest),
        "dqc_failures": quality.failures(latest),
    }
    return report


def print_report(report: dict) -> None:
    """Row counts and the check summary, as the original runner printed them."""
    print(f"run {report['run_id']}")
    for r in report["row_counts"].collect():
        print(f"  {r.table_name:<35} {r.n:>12,} rows")
    s = report["dqc_summary"].first()
    print(f"DQC {s.passed}/{s.total} PASS | {s.failed} FAIL")
    for r in report["dqc"].orderBy("layer", "table_name", "check_name").collect():
        print(f"  {r.status} [{r.layer}] {r.table_name}.{r.check_name}")
    for r in report["dqc_failures"].collect():
        print(f"  FAIL [{r.layer}] {r.table_name}.{r.check_name} -> {r.failed_count} rows | {r.note}")
