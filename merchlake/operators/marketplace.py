"""A marketplace dump of six tables converted to the raw order and product layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlake import schemas as S
from merchlake.functions.rules import is_blank
from merchlake.operators.ranking import number_rows

# How native codes read in the converted data.
STATUS_WORDS = {
    "delivered": S.STATUS_DONE,
    "shipped": S.STATUS_PAID,
    "invoiced": S.STATUS_PAID,
    "processing": S.STATUS_PAID,
    "approved": S.STATUS_PAID,
    "created": S.STATUS_UNPAID,
    "canceled": S.STATUS_CANCELLED,
    "unavailable": S.STATUS_UNFULFILLED,
}
PAYMENT_WORDS = {
    "credit_card": "信用卡",
    "debit_card": "借记卡",
    "boleto": "Boleto票据",
    "voucher": "代金券",
    "not_defined": S.UNKNOWN,
}
CHANNEL = "Olist商城"


def _translate(code: Column, words: dict[str, str], other: Column) -> Column:
    result = other
    for native, word in words.items():
        result = F.when(code == native, F.lit(word)).otherwise(result)
    return result


def order_status(code: Column) -> Column:
    return _translate(code, STATUS_WORDS, F.lit(S.STATUS_OTHER))


def payment_type(code: Column) -> Column:
    """Unknown codes become NULL, which the blank rule fills later."""
    return _translate(code, PAYMENT_WORDS, F.lit(None).cast("string"))


def main_payment(payments: DataFrame) -> DataFrame:
    """The largest payment of each order; ties go to the earlier one, then by type.

    The filter on the row number lets Spark keep one candidate per order and task before the
    exchange.
    """
    order = [
        F.desc_nulls_last(F.col("payment_value").try_cast("double")),
        F.asc_nulls_last(F.col("payment_sequential").try_cast("int")),
        F.asc_nulls_last("payment_type"),
    ]
    first = F.row_number().over(Window.partitionBy("order_id").orderBy(*order))
    ranked = payments.select("order_id", "payment_type", first.alias("place"))
    return ranked.where("place = 1").drop("place")


def named_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with a category name: the English one, else the native one, else a filler."""
    english = categories.select(
        F.col("product_category_name").alias("native_name"),
        F.col("product_category_name_english").alias("english_name"),
    )
    joined = products.join(
        english, F.col("product_category_name") == F.col("native_name"), "left"
    )
    name = F.trim(F.coalesce("english_name", "product_category_name"))
    return joined.select(
        "product_id",
        F.when(is_blank(name), F.lit(S.UNKNOWN_CATEGORY)).otherwise(name).alias("category_name"),
    )


def category_codes(named: DataFrame) -> DataFrame:
    """CAT001, CAT002, ... by category name in order."""
    names = named.select("category_name").distinct()
    numbered = number_rows(names, F.substring("category_name", 1, 3), [F.asc("category_name")], "seq")
    return numbered.select("category_name", F.format_string("CAT%03d", "seq").alias("category_id"))


def coded_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    named = named_products(products, categories)
    return named.join(category_codes(named), "category_name", "left")


def item_rollup(items: DataFrame) -> DataFrame:
    """Order items folded to one row per order and product. The paid amount is the true sum of
    prices, the unit price its average in cents."""
    c = F.col
    sums = (
        items.withColumn("amount", c("price").try_cast("decimal(20,4)"))
        .groupBy("order_id", "product_id")
        .agg(
            F.count("order_item_id").alias("quantity"),
            F.sum("amount").alias("total"),
            F.count_distinct("price").alias("price_variants"),
        )
    )
    average = F.when(c("quantity") > 0, c("total").cast("double") / c("quantity").cast("double"))
    return sums.select(
        "order_id",
        "product_id",
        "quantity",
        F.round(average, 2).try_cast(S.PRICE).alias("unit_price"),
        F.round("total", 2).try_cast(S.PAY).alias("pay_amount"),
        "price_variants",
    )


def rollup_checks(rolled: DataFrame) -> DataFrame:
    """Groups with more than one price, and groups whose quantity x price misses the amount."""
    c = F.col
    gap = F.abs(
        c("unit_price").cast("double") * c("quantity").cast("double") - c("pay_amount").cast("double")
    )
    return rolled.agg(
        F.count_if(c("price_variants") > 1).alias("multi_price_groups"),
        F.count_if(gap > 0.011).alias("amount_mismatch_groups"),
    )


def convert_orders(tables: dict[str, DataFrame]) -> DataFrame:
    """The 13 raw order columns, one row per order and product of orders that have items.

    The two fact-sized joins are on order and customer keys and sort-merge at scale.
    """
    orders = tables["orders"].select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp"
    )
    buyers = tables["customers"].select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state"
    )
    # Buyers join the orders, which are fewer than their items.
    wide = (
        item_rollup(tables["items"])
        .join(orders.join(buyers, "customer_id"), "order_id")
        .join(main_payment(tables["payments"]), "order_id", "left")
    )
    return wide.select(
        "order_id",
        F.col("order_purchase_timestamp").alias("order_time"),
        F.col("customer_unique_id").alias("user_id"),
        "product_id",
        F.lit(CHANNEL).alias("channel"),
        F.col("customer_state").alias("province"),
        F.col("customer_city").alias("city"),
        F.col("quantity").cast("string").alias("quantity"),
        F.col("unit_price").cast("string").alias("unit_price"),
        F.lit("0.00").alias("discount_amount"),
        F.col("pay_amount").cast("string").alias("pay_amount"),
        order_status(F.col("order_status")).alias("order_status"),
        payment_type(F.col("payment_type")).alias("pay_type"),
    )


def convert_products(tables: dict[str, DataFrame]) -> DataFrame:
    """The 7 raw product columns. There is no native product name: category and key stand in."""
    coded = coded_products(tables["products"], tables["categories"])
    return coded.select(
        "product_id",
        F.concat("category_name", F.lit("-"), "product_id").alias("product_name"),
        F.coalesce("category_id", F.lit(S.UNKNOWN_CATEGORY_ID)).alias("category_id"),
        "category_name",
        F.lit(S.UNKNOWN).alias("brand"),
        F.lit("0.00").alias("cost_price"),
        F.lit("").alias("launch_date"),
    )


def orders_with_items(tables: dict[str, DataFrame]) -> DataFrame:
    return tables["orders"].join(tables["items"].select("order_id"), "order_id", "left_semi")


def orders_without_items(tables: dict[str, DataFrame]) -> DataFrame:
    """Orders no metric ever sees, because they have no item rows."""
    return tables["orders"].join(tables["items"].select("order_id"), "order_id", "left_anti")


def excluded_by_status(tables: dict[str, DataFrame]) -> DataFrame:
    """Orders without items per native status, with their share of that status in percent.

    One pass: each order is marked by a join with the item keys, then counted both ways.
    """
    sold = tables["items"].groupBy("order_id").agg(F.lit(1).alias("sold"))
    marked = tables["orders"].select("order_id", "order_status").join(sold, "order_id", "left")
    counts = marked.groupBy("order_status").agg(
        F.count_if(F.col("sold").isNull()).alias("excluded_cnt"),
        F.count(F.lit(1)).alias("status_cnt"),
    )
    share = F.col("excluded_cnt").cast("decimal(24,4)") * 100 / F.col("status_cnt")
    return (
        counts.where("excluded_cnt > 0")
        .select("order_status", "excluded_cnt", "status_cnt", F.round(share, 1).alias("share_pct"))
        .orderBy(F.desc("excluded_cnt"), "order_status")
    )


def status_distribution(orders: DataFrame) -> DataFrame:
    """Rows per status, their share in percent, and whether the status counts as valid."""
    counts = orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("row_cnt"))
    # Over the statuses, not the rows.
    total = F.sum("row_cnt").over(Window.partitionBy())
    share = F.round(F.col("row_cnt").cast("decimal(24,4)") * 100 / total, 2)
    valid = F.col("order_status").isin(S.VALID_STATUSES)
    return counts.select(
        "order_status",
        "row_cnt",
        share.cast("decimal(10,2)").alias("share_pct"),
        F.when(valid, F.lit(1)).otherwise(F.lit(0)).alias("counts_as_valid"),
    ).orderBy(F.desc("row_cnt"), "order_status")
