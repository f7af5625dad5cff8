"""Sums and exact distinct counts over silver rows, shared by gold tables and dashboard queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake import schemas as S


def is_valid() -> Column:
    return F.col("is_valid_order") == 1


def ratio(numerator: Column, denominator: Column, scale: int) -> Column:
    """Half-up decimal quotient, 0 where the denominator is 0 or absent."""
    quotient = numerator.cast("decimal(24,4)") / denominator.cast("decimal(24,4)")
    zero = F.lit(0).cast(f"decimal(20,{scale})")
    return F.when(denominator != 0, F.round(quotient, scale).cast(f"decimal(20,{scale})")).otherwise(zero)


def measure(name: str, counted: Column) -> Column:
    """One measure; ``counted`` marks the rows that count towards money, pieces, valid orders and
    buyers, while ``order_cnt`` and ``refund_order_cnt`` look at every row."""
    c = F.col
    money = F.lit(0).cast(S.PAY)
    gross = c("quantity").cast("decimal(10,0)") * c("unit_price")
    measures = {
        "gmv": lambda: F.sum(F.when(counted, c("pay_amount")).otherwise(money)),
        "sales_qty": lambda: F.sum(F.when(counted, c("quantity")).otherwise(F.lit(0))),
        "gross_amount": lambda: F.sum(F.when(counted, gross).otherwise(money)),
        "discount_amount": lambda: F.sum(F.when(counted, c("discount_amount")).otherwise(money)),
        "order_cnt": lambda: F.count_distinct("order_id"),
        "valid_order_cnt": lambda: F.count_distinct(F.when(counted, c("order_id"))),
        "refund_order_cnt": lambda: F.count_distinct(
            F.when(c("order_status") == S.STATUS_REFUNDED, c("order_id"))
        ),
        "buyer_cnt": lambda: F.count_distinct(F.when(counted, c("user_id"))),
        "last_date": lambda: F.max("stat_date"),
    }
    return measures[name]().alias(name)


def rollup_measures(
    rows: DataFrame, dims: list[str], wanted: list[str], counted: Column | None = None
) -> DataFrame:
    """Group ``rows`` by ``dims`` and compute the ``wanted`` measures, by default counting the
    valid orders.

    Spark plans exact distinct counts as two aggregates. The first exchange is keyed by the
    groups and the order or user, folded per task before it, so a hot day or channel spreads over
    all tasks; sums are folded to one row per group and task. The second exchange then moves one
    partial row per group and task. Folding by hand to one row per order and one per user first
    moved more bytes (trend 29.6 against 26.6 MiB, category 46.3 against 32.0 MiB at sf0.1) and
    was not faster, because every such row carries the sums along.
    """
    hit = is_valid() if counted is None else counted
    return rows.groupBy(*dims).agg(*[measure(name, hit) for name in wanted])
