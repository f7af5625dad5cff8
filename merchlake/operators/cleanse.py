"""Raw order lines to silver detail, rejects and quality counters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlake import schemas as S
from merchlake.functions import rules as R

LABELS = ("product_name", "category_id", "category_name", "brand")


def deduplicate(orders: DataFrame) -> DataFrame:
    """R02: one row per distinct record, with the number of its copies.

    NULLs compare equal. Copies fold on the map side first, so a record repeated any number of
    times reaches the exchange once per task.
    """
    return orders.groupBy(*S.ORDER_FIELDS).agg(F.count(F.lit(1)).alias("copies"))


def stage(orders: DataFrame) -> DataFrame:
    """Distinct raw rows with parsed values and rule flags under new names.

    Raw columns stay as they were, so no rule sees a value another rule has replaced.
    """
    return flagged(deduplicate(orders))


def flagged(distinct: DataFrame) -> DataFrame:
    """``stage`` of rows that are distinct already, with their ``copies``."""
    c = F.col
    parsed = distinct.select(
        *S.ORDER_FIELDS,
        "copies",
        R.parse_time(c("order_time")).alias("ts"),
        R.parse_quantity(c("quantity")).alias("qty"),
        R.parse_price(c("unit_price")).alias("price"),
        R.parse_discount(c("discount_amount")).alias("discount"),
        c("pay_amount").try_cast(S.PAY).alias("paid"),
        R.bad_status(c("order_status")).alias("is_bad_status"),
        (R.is_blank(c("province")) | R.is_blank(c("city")) | R.is_blank(c("pay_type"))).alias("has_blank"),
    )
    checked = parsed.select(
        "*",
        R.expected_pay(c("qty"), c("price"), c("discount")).alias("pay"),
        c("ts").isNull().alias("is_bad_time"),
        R.bad_quantity(c("qty")).alias("is_bad_qty"),
        R.bad_price(c("price")).alias("is_bad_price"),
    )
    return checked.select(
        "*",
        R.bad_amount(c("is_bad_qty"), c("is_bad_price"), c("paid"), c("pay"), c("copies")).alias("is_bad_amount"),
        R.reject_rule(c("is_bad_time"), c("is_bad_qty"), c("is_bad_price"), c("copies")).alias("rule_code"),
    )


def merge_staged(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """R02 over two loads: staged rows of the same record, compared by all fields, become one and
    their copies add up. Flags and parsed values follow from the fields, so only these are exchanged."""
    fields = (*S.ORDER_FIELDS, "copies")
    both = stored.select(*fields).unionByName(fresh.select(*fields))
    merged = flagged(both.groupBy(*S.ORDER_FIELDS).agg(F.sum("copies").alias("copies")))
    return merged.withColumn("stat_date", F.to_date("ts")).select(*stored.columns)


def _now_or(moment: dt.datetime | None) -> Column:
    return F.current_timestamp() if moment is None else F.lit(moment)


def rejects(
    staged: DataFrame, batch_id: str, at: dt.datetime | None = None, keep: tuple[Column, ...] = ()
) -> DataFrame:
    """The discarded rows, each with the first rule that discards it and a short trace, and the
    columns of ``keep``."""
    return staged.where(F.col("rule_code").isNotNull()).select(
        F.lit(batch_id).alias("batch_id"),
        "rule_code",
        R.reject_text(F.col("rule_code")).alias("rule_desc"),
        "order_id",
        "product_id",
        R.raw_trace().alias("raw_record"),
        _now_or(at).alias("create_time"),
        *keep,
    )


def product_dimension(products: DataFrame) -> DataFrame:
    """One row per product. Where labels conflict, the smallest non-null ones win, so every
    run picks the same row."""
    cleaned = products.select(
        F.col("product_id").alias("dim_product_id"),
        *[R.blank_to_null(F.col(label)).alias(f"dim_{label}") for label in LABELS],
    )
    order = [F.col(f"dim_{label}").asc_nulls_last() for label in LABELS]
    first = F.row_number().over(Window.partitionBy("dim_product_id").orderBy(*order))
    return cleaned.withColumn("choice", first).where("choice = 1").drop("choice")


def attach_products(rows: DataFrame, dimension: DataFrame) -> DataFrame:
    """Left join to the product dimension.

    No hint: the planner broadcasts a dimension whose size is under its threshold, and sorts and
    merges a larger one, where adaptive execution splits the partitions of hot products.
    """
    return rows.join(dimension, F.col("product_id") == F.col("dim_product_id"), "left")


def silver(
    staged: DataFrame, products: DataFrame, batch_id: str, at: dt.datetime | None = None
) -> DataFrame:
    """The kept rows with every repair applied, in the 23-column layout."""
    c = F.col
    kept = staged.where(c("rule_code").isNull())
    joined = attach_products(kept, product_dimension(products))
    return joined.select(
        "order_id",
        c("ts").alias("order_time"),
        F.to_date("ts").alias("stat_date"),
        R.month_key(c("ts")).alias("stat_month"),
        R.week_key(c("ts")).alias("stat_week"),
        "user_id",
        "product_id",
        F.coalesce("dim_product_name", F.lit(S.UNKNOWN_PRODUCT)).alias("product_name"),
        F.coalesce("dim_category_id", F.lit(S.UNKNOWN_CATEGORY_ID)).alias("category_id"),
        F.coalesce("dim_category_name", F.lit(S.UNKNOWN_CATEGORY)).alias("category_name"),
        F.coalesce("dim_brand", F.lit(S.UNKNOWN)).alias("brand"),
        "channel",
        R.fill_blank(c("province")).alias("province"),
        R.fill_blank(c("city")).alias("city"),
        c("qty").alias("quantity"),
        c("price").alias("unit_price"),
        c("discount").alias("discount_amount"),
        c("pay").alias("pay_amount"),
        R.standard_status(c("order_status")).alias("order_status"),
        R.fill_blank(c("pay_type")).alias("pay_type"),
        R.valid_order_flag(c("order_status")).alias("is_valid_order"),
        F.lit(batch_id).alias("batch_id"),
        _now_or(at).alias("create_time"),
    )


def missing_products(staged: DataFrame, products: DataFrame) -> DataFrame:
    """R08: kept rows whose product the dimension does not hold."""
    kept = staged.where(F.col("rule_code").isNull())
    known = products.select(F.col("product_id").alias("dim_product_id"))
    return kept.join(known, F.col("product_id") == F.col("dim_product_id"), "left_anti")


def _counters(staged: DataFrame, products: DataFrame, *by: str) -> DataFrame:
    c = F.col
    # One marker per product: a product listed twice must not count its rows twice.
    known = products.groupBy(c("product_id").alias("dim_product_id")).agg(F.lit(1).alias("known"))
    rows = staged.join(known, c("product_id") == c("dim_product_id"), "left")
    kept = c("rule_code").isNull()

    def hits(flag: Column, name: str) -> Column:
        return F.count_if(flag).alias(name)

    return rows.groupBy(*by).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_cnt"),
        hits(c("has_blank"), "null_field_cnt"),
        F.coalesce(F.sum(c("copies") - 1), F.lit(0)).alias("dup_record_cnt"),
        hits(c("is_bad_time"), "invalid_time_cnt"),
        hits(c("is_bad_amount"), "invalid_amount_cnt"),
        hits(c("is_bad_status"), "invalid_status_cnt"),
        hits(kept & c("known").isNull(), "missing_dim_cnt"),
        hits(kept, "valid_cnt"),
        hits(~kept, "discard_cnt"),
    )


def rule_counters(staged: DataFrame, products: DataFrame) -> DataFrame:
    """All nine counters in one aggregate over the staged rows.

    Rules may overlap. R01 to R07 count distinct rows before discards, R08 counts kept rows.
    """
    return _counters(staged, products)


def day_counters(staged: DataFrame, products: DataFrame) -> DataFrame:
    """The nine counters per day (``stat_date``; null: rows of no day). They add up."""
    return _counters(staged, products, "stat_date")


def summed_counters(counters: DataFrame) -> DataFrame:
    """``rule_counters`` from those of all days."""
    return counters.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in S.COUNTERS])
