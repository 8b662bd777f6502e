"""Quality checks: each family fails with the exact count and passes on clean input."""

import datetime as dt

from dimforge.operators import quality as Q

TS = dt.datetime(2023, 1, 1)


def _run(spark, tables, checks):
    return {r.check_name: (r.status, r.failed_count) for r in Q.run_checks(spark, tables, checks, TS).collect()}


def test_families_fail_and_pass(spark):
    dim = spark.createDataFrame([(1, "a", True), (2, "b", True), (2, "b", False), (3, None, True)],
                                "k long, v string, cur boolean")
    fact = spark.createDataFrame([(1, 10), (2, -5), (9, 1), (None, 3)], "k long, amount int")
    tables = {"dim": dim, "fact": fact}
    checks = [
        Q.row_count("dim", "dim", "count4", 4, ""),
        Q.row_count("dim", "dim", "count2", 2, ""),
        Q.unique("dim", "dim", "unique_k", "k", ""),
        Q.unique("dim", "dim", "unique_k_current", "k", "", where="cur"),
        Q.unique("dim", "dim", "unique_kv", ["k", "v"], ""),
        Q.predicate("dim", "dim", "no_null_v", "v IS NULL", ""),
        Q.predicate("fct", "fact", "amount_positive", "amount <= 0", ""),
        Q.referential("fct", "fact", "fk_k", "k", "dim", "k", ""),
    ]
    got = _run(spark, tables, checks)
    assert got == {
        "count4": ("PASS", 0), "count2": ("FAIL", 2), "unique_k": ("FAIL", 1),
        "unique_k_current": ("PASS", 0), "unique_kv": ("FAIL", 1), "no_null_v": ("FAIL", 1),
        "amount_positive": ("FAIL", 1), "fk_k": ("FAIL", 2),  # 9 and NULL have no match
    }


def test_summary_and_layer_replacement(spark):
    res = spark.createDataFrame(
        [(TS, "dim", "t", "a", "PASS", 0, None), (TS, "fct", "t", "b", "FAIL", 3, "n")],
        "run_timestamp timestamp_ntz, layer string, table_name string, check_name string, status string, "
        "failed_count long, note string")
    s = Q.summary(res).first()
    assert (s.passed, s.failed, s.total) == (1, 1, 2)
    new = res.where("layer = 'fct'").withColumn("status", __import__("pyspark.sql.functions").sql.functions.lit("PASS"))
    out = Q.clear_layer_and_append(res, new, "fct")
    assert sorted((r.layer, r.status) for r in out.collect()) == [("dim", "PASS"), ("fct", "PASS")]


def test_declared_check_counts():
    from dimforge.plans import checks
    assert len(checks.DIM_CHECKS) == 17 and len(checks.FCT_CHECKS) == 18
    assert len({c.id for c in checks.DIM_CHECKS + checks.FCT_CHECKS}) == 35


def test_foreign_keys_travel_with_a_number(spark):
    """The ids of the checks don't go through the shuffles with every key."""
    from dimforge.operators import quality as Q

    a = spark.createDataFrame([(1, 9), (2, 1)], "k long, m long")
    b = spark.createDataFrame([(1,)], "k long")
    res = Q.run_checks(spark, {"a": a, "b": b}, [Q.referential("x", "a", f"a long name {c}", c, "b", "k", "") for c in ("k", "m")])
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(check#" in plan
    assert {r.check_name: r.failed_count for r in res.collect()} == {"a long name k": 1, "a long name m": 1}


def test_the_results_log_is_run_once(spark, monkeypatch):
    from dimforge.operators import quality as Q
    from dimforge.plans import catalog

    runs, real = [], Q.run_checks
    monkeypatch.setattr(Q, "run_checks", lambda *a: runs.append(1) or real(*a))
    catalog.reset_warehouses()
    sf = "/root/testdata/sf0.001"
    assert catalog.dqc_append(spark, sf).count() == 70 and catalog.dqc_latest(spark, sf).count() == 5
    assert len(runs) == 2
