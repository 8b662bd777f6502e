"""Trap tests: text casts, minute arithmetic and calendar parts follow the warehouse rules."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from dimforge.functions import exprs as X


def _one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_try_int_rounds_half_away_and_rejects_junk(spark):
    values = ["225", "225.0", "225.5", "-2.5", "1e3", " 12 ", "", "junk", "99999999999", None]
    expected = [225, 225, 226, -3, 1000, 12, None, None, None, None]
    got = [r[0] for r in _one_col(spark, values).select(X.try_int("v")).collect()]
    assert got == expected


def test_try_dec(spark):
    values = ["12.345", "-12.345", "1e2", " 43.00 ", "123456789.00", "empattiga"]
    expected = [Decimal("12.35"), Decimal("-12.35"), Decimal("100.00"), Decimal("43.00"), None, None]
    got = [r[0] for r in _one_col(spark, values).select(X.try_dec("v", 10, 2)).collect()]
    assert got == expected


def test_try_ts_needs_a_full_date(spark):
    ok = ["2017-10-02 10:56:33", "2017-10-02T10:56:33", "2017-10-02 10:56", "2017-1-2 1:2:3"]
    bad = ["2017", "2017-10", "", "junk", "2017-10-02 25:00:00"]
    got = [r[0] for r in _one_col(spark, ok + bad).select(X.try_ts("v")).collect()]
    assert got[:4] == [dt.datetime(2017, 10, 2, 10, 56, 33), dt.datetime(2017, 10, 2, 10, 56, 33),
                       dt.datetime(2017, 10, 2, 10, 56), dt.datetime(2017, 1, 2, 1, 2, 3)]
    assert got[4:] == [None] * len(bad)
    dates = [r[0] for r in _one_col(spark, ["2017-10-02 10:56:33", "2017-10"]).select(X.try_date("v")).collect()]
    assert dates == [dt.date(2017, 10, 2), None]


def test_minutes_count_boundaries_crossed(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 1, 0)),
         (dt.datetime(2024, 1, 1, 0, 0, 30), dt.datetime(2024, 1, 1, 0, 2, 0)),
         (dt.datetime(1969, 12, 31, 23, 59, 30), dt.datetime(1970, 1, 1, 0, 0, 10))],
        "a timestamp_ntz, b timestamp_ntz")
    got = df.select(X.minutes_between("a", "b").alias("f"), X.minutes_between("b", "a").alias("r")).collect()
    assert [(r.f, r.r) for r in got] == [(1, -1), (2, -2), (1, -1)]


def test_round_ratio_is_exact_half_away_from_zero(spark):
    df = spark.createDataFrame([(36, 1440), (-36, 1440), (612, 1440), (61, 60), (1, 3), (None, 60), (5, 0)],
                               "n long, d long")
    got = [r[0] for r in df.select(X.round_ratio("n", "d")).collect()]
    assert got == [Decimal("0.03"), Decimal("-0.03"), Decimal("0.43"), Decimal("1.02"), Decimal("0.33"),
                   None, None]


def test_calendar_week_and_weekday(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),), (dt.date(2024, 1, 7),), (dt.date(2024, 1, 6),)], "d date")
    got = df.select(F.weekofyear("d"), X.day_of_week0("d"), X.date_key("d")).collect()
    assert [tuple(r) for r in got] == [(53, 5, 20210101), (1, 0, 20240107), (1, 6, 20240106)]


def test_null_safe_difference(spark):
    df = spark.createDataFrame([(None, None), (None, "a"), ("a", "a"), ("a", "b")], "x string, y string")
    got = [r[0] for r in df.select(X.distinct_from("x", "y")).collect()]
    assert got == [False, True, False, True]


def test_ratios_and_cents_stay_longs(spark):
    """No division or sum of wide decimals: exact on longs, then two places behind the point."""
    df = spark.createDataFrame([(Decimal("99999999.99"), 5, 3), (Decimal("-0.01"), -5, 3), (None, None, 3)], "p decimal(10,2), n long, d long")
    got = [tuple(r) for r in df.select(X.cents("p"), X.hundredths(X.cents("p")), X.round_ratio("n", "d")).collect()]
    assert got == [(9999999999, Decimal("99999999.99"), Decimal("1.67")), (-1, Decimal("-0.01"), Decimal("-1.67")), (None, None, None)]
    plan = df.select(X.round_ratio("n", "d"))._jdf.queryExecution().optimizedPlan().toString()
    assert " div " in plan and " / " not in plan
