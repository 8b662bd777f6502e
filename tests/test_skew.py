"""Hot keys: one key holding a third of the rows must not change any result."""

from pyspark.sql import functions as F

from dimforge.operators import quality as Q
from dimforge.operators.dedupe import first_per_key
from dimforge.operators.merge import replace_by_key
from dimforge.plans import staging

N = 3000


def _skewed(spark):
    # key 0 holds N/3 rows; the others hold one or two each
    return spark.range(N).select(
        F.when(F.col("id") < N // 3, F.lit(0)).otherwise(F.col("id") % 1500).alias("k"),
        F.col("id").alias("v"))


def test_first_per_key_under_skew(spark):
    df = _skewed(spark)
    got = {r.k: r.v for r in first_per_key(df, "k", ["v"]).collect()}
    expected = {}
    for r in df.collect():
        expected[r.k] = min(expected.get(r.k, r.v), r.v)
    assert got == expected


def test_checks_under_skew(spark):
    df = _skewed(spark)
    ref = spark.range(1, 1500).select(F.col("id").alias("k"))  # key 0 is an orphan
    res = {r.check_name: r.failed_count for r in Q.run_checks(spark, {"f": df, "d": ref}, [
        Q.unique("x", "f", "u", "k", ""),
        Q.referential("x", "f", "r", "k", "d", "k", ""),
    ]).collect()}
    dup_groups = df.groupBy("k").count().where("count > 1").count()
    assert res == {"u": dup_groups, "r": N // 3 + df.where("k = 0 AND v >= 1000").count()}


def test_replace_by_key_under_skew(spark):
    target = _skewed(spark).select((F.col("v") + 1).alias("sk"), F.col("k").cast("string").alias("order_id"),
                                   "v")
    fresh = target.where("order_id = '0'").select("order_id", (F.col("v") + 100000).alias("v"))
    scope = spark.createDataFrame([("0",)], "order_id string")
    out = replace_by_key(target, fresh.withColumnRenamed("v", "v"), scope, "order_id", ["order_id", "v"], "sk")
    assert out.count() == N
    assert out.where("order_id = '0'").agg(F.min("v")).first()[0] >= 100000


def test_items_per_order_under_skew(spark):
    items = _skewed(spark).select(F.col("k").cast("string").alias("order_id"))
    got = {r.order_id: r.is_multi_item for r in staging.items_per_order(items).collect()}
    assert got["0"] is True and len(got) == 1500
