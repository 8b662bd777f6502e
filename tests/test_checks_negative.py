"""Every one of the 35 checks fails on a table broken by exactly one injected row."""

import pytest
from pyspark.sql import functions as F

from dimforge import schemas
from dimforge.operators import quality as Q
from dimforge.plans import checks
from dimforge.plans.catalog import reset_warehouses, _w

SF = "/root/testdata/sf0.001"
ALL = checks.DIM_CHECKS + checks.FCT_CHECKS

# For predicate checks: column values that make one copied row fail the check.
P_BREAK = {
    "no_null_full_date": {"full_date": None},
    "no_null_state": {"customer_state": None},
    "scd2_end_after_start": {"scd_end_date": "2000-01-01", "is_current": False, "seller_id": "zz-new"},
    "no_null_category": {"category_name": None},
    "no_null_dimension_keys": {"customer_key": None},
    "price_positive": {"price": 0},
    "freight_non_negative": {"freight_value": -1},
    "total_item_value_integrity": {"total_item_value": 0},
    "vs_estimated_days_range": {"vs_estimated_days": 400},
    "approval_delay_non_negative": {"approval_delay_hours": -1},
    "revenue_non_negative": {"total_revenue": -1},
    "avg_review_score_range": {"avg_review_score": 6},
}


def _one_bad_row(df, c):
    row = df.limit(1)
    if c.where and c.family == "U":
        row = df.where(c.where).limit(1)
    if c.family == "K" or c.family == "U":
        return row  # one extra row / one duplicated key
    if c.family == "R":
        return row.withColumn(c.fk, F.lit(-1).cast(dict(df.dtypes)[c.fk]))
    out = row
    for col, v in P_BREAK[c.name].items():
        out = out.withColumn(col, F.lit(v).cast(dict(df.dtypes)[col]))
    return out


@pytest.fixture(scope="module")
def base(spark):
    reset_warehouses()
    w = _w(spark, SF)
    tables = {t: w.table(t) for t in schemas.WAREHOUSE_TABLES}
    counts = {r.check_name + "@" + r.table_name: r.failed_count
              for r in Q.run_checks(spark, tables, ALL).collect()}
    return tables, counts


@pytest.mark.parametrize("c", ALL, ids=lambda c: f"{c.table}.{c.name}")
def test_check_fails_on_one_bad_row(spark, base, c):
    tables, before = base
    broken = dict(tables)
    broken[c.table] = tables[c.table].unionByName(_one_bad_row(tables[c.table], c))
    got = {r.check_name + "@" + r.table_name: (r.status, r.failed_count)
           for r in Q.run_checks(spark, broken, [c]).collect()}
    # a check on a history's coverage scans the dimension and reports the history
    status, n = got[f"{c.name}@{c.reported}"]
    assert status == "FAIL" and n == before[f"{c.name}@{c.reported}"] + 1
