"""Raw warehouse inputs derived from the driver's TPC-H-like tables.

The warehouse expects eight raw e-commerce relations (customers, sellers, products,
category translation, orders, order items, reviews, payments).  They are not
available here, so each is derived from the given tables with plain DataFrame
operations, keeping their work proportional to the input:

=================  ========================================================
raw relation       derived from
=================  ========================================================
raw_customers      orders x customer x nation (one customer id per order)
raw_sellers        supplier x nation x region
raw_products       part (dirty numeric text injected on purpose)
raw_category_...   fixed translation table over part types (one left out)
raw_orders         orders + first/last ship date of their lineitems
raw_order_items    lineitem, renumbered per order so (order, item) is unique
raw_reviews        events (three events per review id, two per order id)
=================  ========================================================

Dates are moved forward by 20 years so that they fall inside the date spine
(1995..2001 becomes 2015..2021).  All raw columns are text, as in the original
files, so the loads exercise their safe casts.  ``plans.oracle_sql`` holds the
same derivation in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

YEAR_SHIFT = 20
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# English names of the part types (one type is left out on purpose,
# so its products fall back to 'unknown').
CATEGORY_TRANSLATION = [
    ("standard", " Standard Goods "),
    ("medium", "MEDIUM Goods"),
    ("economy", "  economy goods"),
    ("promo", "Promo Goods  "),
    ("large", "Large GOODS"),
]

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _shift(c):
    return F.timestamp_add("YEAR", F.lit(YEAR_SHIFT), c)


def _fmt(c):
    return F.date_format(c, TS_FORMAT)


def _plus_minutes(c, n):
    return F.timestamp_add("MINUTE", n, c)


def _cap(c):
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, F.lit(2), F.length(c))))


def _txt(c):
    return c.cast("string")


def raw_customers(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    zip_code = F.lpad(_txt(F.col("c_nationkey") * 1000 + F.col("c_custkey") % 1000), 5, "0")
    city = F.when(
        F.col("o_orderkey") % 5 == 0, F.concat(F.lit("  New "), F.col("c_mktsegment"))
    ).otherwise(F.concat(F.lit(" "), _cap(F.col("c_mktsegment")), F.lit("  ")))
    return j.select(
        F.concat(F.lit("cu"), _txt(F.col("c_custkey"))).alias("customer_unique_id"),
        F.concat(F.lit("oc"), _txt(F.col("o_orderkey"))).alias("customer_id"),
        F.concat(F.lit(" "), zip_code, F.lit(" ")).alias("customer_zip_code_prefix"),
        city.alias("customer_city"),
        F.concat(F.lit(" "), F.lower(F.col("n_name"))).alias("customer_state"),
    )


def raw_sellers(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select(
        F.concat(F.lit("se"), _txt(F.col("s_suppkey"))).alias("seller_id"),
        F.concat(F.lpad(_txt(F.col("s_suppkey") % 100000), 5, "0"), F.lit("  ")).alias(
            "seller_zip_code_prefix"
        ),
        F.when(F.col("s_suppkey") % 17 != 5, F.concat(F.lit("  "), _cap(F.col("n_name")))).alias(
            "seller_city"
        ),
        F.concat(F.lower(F.col("r_name")), F.lit(" ")).alias("seller_state"),
    )


def raw_products(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    desc = (
        F.when(k % 10 == 3, F.lit("225.5"))
        .when(k % 10 == 7, F.lit("n/a"))
        .when(k % 10 == 9, F.lit(""))
        .otherwise(_txt(F.col("p_size") * 10))
    )
    return p.select(
        F.concat(F.lit("pr"), _txt(k)).alias("product_id"),
        F.when(k % 41 != 0, F.lower(F.col("p_type"))).alias("product_category_name"),
        _txt(F.length("p_name")).alias("product_name_lenght"),
        desc.alias("product_description_lenght"),
        F.concat(F.lit(" "), _txt(F.col("p_size") % 5), F.lit(" ")).alias("product_photos_qty"),
        _txt(F.col("p_retailprice").cast("decimal(10,2)")).alias("product_weight_g"),
        _txt(F.col("p_size")).alias("product_length_cm"),
        _txt(F.col("p_size") * 2).alias("product_height_cm"),
        F.when(k % 13 == 0, F.lit("1e1")).otherwise(_txt(F.col("p_size") + 1)).alias(
            "product_width_cm"
        ),
    )


def raw_category_translation(spark, sf_dir=None):
    return spark.createDataFrame(
        CATEGORY_TRANSLATION,
        "product_category_name string, product_category_name_english string",
    )


def raw_orders(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    ships = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    )
    j = o.join(ships, o.o_orderkey == ships.l_orderkey, "left")
    k = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    price = F.col("o_totalprice")
    purchase = _shift(F.col("o_orderdate"))
    status = (
        F.when(st == "F", "delivered")
        .when(st == "O", "shipped")
        .when(F.col("o_orderpriority") == "1-URGENT", "on_hold")
        .otherwise("processing")
    )
    approved = F.when(
        ~((st == "P") & (F.col("o_orderpriority") == "5-LOW")),
        _fmt(_plus_minutes(purchase, F.floor(price) % 2880)),
    )
    carrier = F.when(
        st != "P", _fmt(_plus_minutes(_shift(F.col("first_ship")), F.floor(price * 3) % 1440))
    )
    delivered = F.when(
        st == "F",
        _fmt(
            _plus_minutes(
                F.timestamp_add("DAY", F.lit(2), _shift(F.col("last_ship"))),
                F.floor(price * 7) % 1440,
            )
        ),
    )
    estimated = F.when(k % 50 != 7, _fmt(F.timestamp_add("DAY", F.lit(45), purchase)))
    return j.select(
        F.concat(F.lit("or"), _txt(k)).alias("order_id"),
        F.concat(F.lit("oc"), _txt(k)).alias("customer_id"),
        status.alias("order_status"),
        F.when(k % 997 == 13, F.lit("2017-10")).otherwise(_fmt(purchase)).alias(
            "order_purchase_timestamp"
        ),
        approved.alias("order_approved_at"),
        carrier.alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        estimated.alias("order_estimated_delivery_date"),
    )


def raw_order_items(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    # item_no = row number within the order by (line, part, supplier, price, quantity, date),
    # computed in two levels so no window spans a whole order: rows are numbered within
    # their (order, line) pair, and each pair starts after the rows of the order's lower
    # line numbers (pre-aggregated counts, at most one row per line number per order).
    per_line = li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("l_orderkey").orderBy("l_linenumber").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = per_line.select(
        "l_orderkey", "l_linenumber", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
        "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")
    li = (
        li.withColumn("_rn", F.row_number().over(within))
        .join(starts, ["l_orderkey", "l_linenumber"])
        .withColumn("item_no", F.col("_start") + F.col("_rn"))
    )
    tag = F.col("l_orderkey") + F.col("item_no")
    price_txt = _txt(F.col("l_extendedprice").cast("decimal(10,2)"))
    price = (
        F.when(tag % 97 == 0, F.lit("n/a"))
        .when(tag % 89 == 0, F.concat(F.lit(" "), price_txt, F.lit(" ")))
        .otherwise(price_txt)
    )
    return li.select(
        F.concat(F.lit("or"), _txt(F.col("l_orderkey"))).alias("order_id"),
        _txt(F.col("item_no")).alias("order_item_id"),
        F.concat(F.lit("pr"), _txt(F.col("l_partkey"))).alias("product_id"),
        F.concat(F.lit("se"), _txt(F.col("l_suppkey"))).alias("seller_id"),
        _fmt(F.timestamp_add("DAY", F.lit(3), _shift(F.col("l_shipdate")))).alias(
            "shipping_limit_date"
        ),
        price.alias("price"),
        _txt((F.col("l_quantity") * F.lit(0.25)).cast("decimal(10,2)")).alias("freight_value"),
    )


def raw_reviews(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    score = F.when(
        (F.col("event_type") == "error") & (F.col("value") > 300), F.lit("none")
    ).otherwise(_txt(F.floor(F.col("value")) % 5 + 1))
    return e.select(
        F.concat(F.lit("rv"), _txt(F.floor(eid / 3))).alias("review_id"),
        F.concat(F.lit("or"), _txt(F.floor(eid / 2))).alias("order_id"),
        score.alias("review_score"),
        F.when(F.col("event_type") != "error", _fmt(F.col("ts"))).alias("review_answer_timestamp"),
    )


RAW_BUILDERS = {
    "raw_customers": raw_customers,
    "raw_sellers": raw_sellers,
    "raw_products": raw_products,
    "raw_category_translation": raw_category_translation,
    "raw_orders": raw_orders,
    "raw_order_items": raw_order_items,
    "raw_reviews": raw_reviews,
}


def raw_standins(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All raw relations, lazily defined over the driver tables in ``sf_dir``."""
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}
