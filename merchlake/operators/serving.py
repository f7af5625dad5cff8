"""Narrow tables by day that answer what daily metrics cannot: exact distinct counts over ranges of
days, and where a page of the detail begins.

A day's orders and buyers are kept as keys, so a range counts keys instead of scanning the wide
detail, and an order or buyer that occurs on several days is counted once. All of them are built from
a day's detail alone, so rebuilding a day replaces that day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlake import schemas as S
from merchlake.functions.measures import is_valid, measure

SUMS = ["gmv", "sales_qty", "gross_amount", "discount_amount"]


def day_sum(silver: DataFrame) -> DataFrame:
    """Sums per day, and the number of rows."""
    return silver.groupBy("stat_date").agg(
        F.count(F.lit(1)).alias("row_cnt"), *[measure(name, is_valid()) for name in SUMS]
    )


def order_key(silver: DataFrame) -> DataFrame:
    """The orders of a day, with whether a line of them is valid, and one refunded."""
    refunded = F.col("order_status") == S.STATUS_REFUNDED
    return silver.groupBy("stat_date", "order_id").agg(
        F.bool_or(F.coalesce(is_valid(), F.lit(False))).alias("is_valid"),
        F.bool_or(F.coalesce(refunded, F.lit(False))).alias("is_refunded"),
    )


def user_key(silver: DataFrame) -> DataFrame:
    """The users with a valid order on a day."""
    return silver.where(is_valid()).select("stat_date", "user_id").distinct()


def order_moment(silver: DataFrame) -> DataFrame:
    """Rows per moment."""
    return silver.groupBy("stat_date", "order_time").agg(
        F.count(F.lit(1)).alias("row_cnt"), F.count_if(is_valid()).alias("valid_cnt")
    )


BUILDERS = {
    "dws_day_sum": day_sum,
    "dws_order_key": order_key,
    "dws_user_key": user_key,
    "dws_order_moment": order_moment,
}


def table(name: str, silver: DataFrame) -> DataFrame:
    """One of the tables, in its declared types."""
    built = BUILDERS[name](silver)
    return built.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(S.SERVING[name])])


def overview_measures(tables: dict[str, DataFrame], inside: Column) -> DataFrame:
    """What ``gold.overview_measures`` takes from the detail, from the keys of the days that
    ``inside`` names."""
    c = F.col
    sums = tables["dws_day_sum"].where(inside).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in SUMS], F.max("stat_date").alias("last_date")
    )
    # The exchange is keyed by order, so a hot day spreads over all tasks.
    orders = tables["dws_order_key"].where(inside).agg(
        F.count_distinct("order_id").alias("order_cnt"),
        F.count_distinct(F.when(c("is_valid"), c("order_id"))).alias("valid_order_cnt"),
        F.count_distinct(F.when(c("is_refunded"), c("order_id"))).alias("refund_order_cnt"),
    )
    users = tables["dws_user_key"].where(inside).agg(F.count_distinct("user_id").alias("buyer_cnt"))
    # One row each, side by side.
    rows = sums.unionByName(orders, allowMissingColumns=True).unionByName(users, allowMissingColumns=True)
    return rows.agg(*[F.max(name).alias(name) for name in rows.columns])
