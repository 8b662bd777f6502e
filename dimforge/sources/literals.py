"""Generated and literal relations: the date spine and the two static lookups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import date_key, day_of_week0

# The calendar range of dim_date (2922 days, both ends included).
DATE_SPINE_START = dt.date(2015, 1, 1)
DATE_SPINE_END = dt.date(2022, 12, 31)
DATE_SPINE_ROWS = 2922

# Payment types (key, code, description).
PAYMENT_TYPES = [
    (1, "credit_card", "Credit Card"),
    (2, "boleto", "Boleto Bancário"),
    (3, "voucher", "Voucher / Gift Card"),
    (4, "debit_card", "Debit Card"),
    (5, "not_defined", "Not Defined / Unknown"),
]

# Order statuses of the junk dimension (8 statuses x 2 x 2 = 32 rows).
ORDER_STATUSES = [
    "delivered", "shipped", "canceled", "unavailable",
    "invoiced", "processing", "created", "approved",
]
ORDER_FLAG_ROWS = len(ORDER_STATUSES) * 2 * 2


def date_spine(spark: SparkSession, start=DATE_SPINE_START, end=DATE_SPINE_END) -> DataFrame:
    """One row per day, ``start`` to ``end`` inclusive, with calendar attributes."""
    days = spark.range(1).select(
        F.explode(
            F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))
        ).alias("full_date")
    )
    d = F.col("full_date")
    dow = day_of_week0(d)
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).cast("int").alias("week_of_year"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
    )


def payment_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PAYMENT_TYPES, "payment_type_key int, payment_type string, payment_type_desc string"
    )


def order_flag_combinations(spark: SparkSession) -> DataFrame:
    """Every (status, is_late, is_multi) combination; keys are assigned by the load."""
    statuses = spark.createDataFrame([(s,) for s in ORDER_STATUSES], "order_status string")
    flags = spark.createDataFrame([(True,), (False,)], "v boolean")
    # The flag sides have two rows each: broadcasting them is bounded, and avoids a
    # cartesian product over every pair of input partitions.
    return (
        statuses.coalesce(1)
        .crossJoin(F.broadcast(flags.withColumnRenamed("v", "is_late_delivery")))
        .crossJoin(F.broadcast(flags.withColumnRenamed("v", "is_multi_item")))
    )
