"""Daily metric tables and the overview, computed from silver."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake import schemas as S
from merchlake.functions.measures import ratio, rollup_measures


def _stamp(df: DataFrame, table: str, at: dt.datetime | None) -> DataFrame:
    moment = F.current_timestamp() if at is None else F.lit(at)
    stamped = df.withColumn("gmv", F.col("gmv").cast(S.GMV)).withColumn("update_time", moment)
    return stamped.select(*S.GOLD_COLUMNS[table])


def with_trend_ratios(measures: DataFrame) -> DataFrame:
    """Average order amount (2 digits) and refund rate (a fraction, 4 digits); 0 without orders."""
    return measures.withColumns(
        {
            "avg_order_amount": ratio(F.col("gmv"), F.col("valid_order_cnt"), 2).cast(S.PAY),
            "refund_rate": ratio(F.col("refund_order_cnt"), F.col("order_cnt"), 4).cast(S.RATE),
        }
    )


TREND_MEASURES = [
    "order_cnt",
    "valid_order_cnt",
    "gmv",
    "sales_qty",
    "buyer_cnt",
    "refund_order_cnt",
]


def daily_trend(silver: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    base = rollup_measures(silver, ["stat_date"], TREND_MEASURES)
    return _stamp(with_trend_ratios(base), "ads_daily_trend", at)


def _valid_stat(
    table: str, dims: list[str], measures: list[str]
) -> Callable[[DataFrame, dt.datetime | None], DataFrame]:
    """A builder for one table of valid-order measures; its order_cnt counts valid orders."""

    def build(silver: DataFrame, at: dt.datetime | None = None) -> DataFrame:
        base = rollup_measures(silver, dims, measures)
        return _stamp(base.withColumnRenamed("valid_order_cnt", "order_cnt"), table, at)

    build.__doc__ = f"{table}: {', '.join(dims)} -> {', '.join(measures)}."
    return build


category_stat = _valid_stat(
    "ads_category_stat",
    ["stat_date", "category_id", "category_name"],
    ["gmv", "sales_qty", "valid_order_cnt", "buyer_cnt"],
)
product_stat = _valid_stat(
    "ads_product_stat",
    ["stat_date", "product_id", "product_name", "category_name", "brand"],
    ["gmv", "sales_qty", "valid_order_cnt"],
)
channel_stat = _valid_stat(
    "ads_channel_stat",
    ["stat_date", "channel"],
    ["gmv", "valid_order_cnt", "sales_qty", "buyer_cnt"],
)
paytype_stat = _valid_stat("ads_paytype_stat", ["stat_date", "pay_type"], ["gmv", "valid_order_cnt"])
region_stat = _valid_stat(
    "ads_region_stat", ["stat_date", "province"], ["gmv", "valid_order_cnt", "buyer_cnt"]
)
channel_category_stat = _valid_stat(
    "ads_channel_category_stat",
    ["stat_date", "channel", "category_name"],
    ["gmv", "valid_order_cnt"],
)

OVERVIEW_MEASURES = [
    "gmv",
    "order_cnt",
    "valid_order_cnt",
    "sales_qty",
    "buyer_cnt",
    "gross_amount",
    "discount_amount",
    "refund_order_cnt",
    "last_date",
]


def overview_measures(silver: DataFrame) -> DataFrame:
    """One row of base measures over the whole range; distinct counts are taken once, not per day.
    Sums over no rows are 0."""
    base = rollup_measures(silver, [], OVERVIEW_MEASURES)
    return base.select(
        *[
            F.col(m) if m == "last_date" else F.coalesce(F.col(m), F.lit(0)).alias(m)
            for m in OVERVIEW_MEASURES
        ]
    )


def kpi_rows(measures: DataFrame, currency: str = S.DEFAULT_CURRENCY) -> DataFrame:
    """The nine KPIs as rows (code, name, value, unit, description), with their order in
    ``kpi_rank`` and the last day in ``stat_date``. Rates are percentages."""
    c = F.col
    values: dict[str, Column] = {
        "GMV": c("gmv"),
        "ORDER_CNT": c("order_cnt"),
        "VALID_ORDER_CNT": c("valid_order_cnt"),
        "SALES_QTY": c("sales_qty"),
        "BUYER_CNT": c("buyer_cnt"),
        "AVG_ORDER_AMOUNT": ratio(c("gmv"), c("valid_order_cnt"), 2),
        "AVG_ITEM_PRICE": ratio(c("gmv"), c("sales_qty"), 2),
        "REFUND_RATE": ratio(c("refund_order_cnt") * 100, c("order_cnt"), 4),
        "DISCOUNT_RATE": ratio(c("discount_amount") * 100, c("gross_amount"), 4),
    }
    rows = [
        F.struct(
            F.lit(rank).alias("kpi_rank"),
            F.lit(code).alias("kpi_code"),
            F.lit(name).alias("kpi_name"),
            values[code].cast(S.KPI_VALUE).alias("kpi_value"),
            F.lit(unit or currency).alias("kpi_unit"),
            F.lit(text).alias("kpi_desc"),
            c("last_date").alias("stat_date"),
        )
        for rank, (code, name, unit, text) in enumerate(S.KPIS, start=1)
    ]
    return measures.select(F.inline(F.array(*rows)))


def overview(
    silver: DataFrame,
    batch_id: str,
    currency: str = S.DEFAULT_CURRENCY,
    at: dt.datetime | None = None,
) -> DataFrame:
    return overview_rows(overview_measures(silver), batch_id, currency, at)


def overview_rows(
    measures: DataFrame,
    batch_id: str,
    currency: str = S.DEFAULT_CURRENCY,
    at: dt.datetime | None = None,
) -> DataFrame:
    """The stored overview from one row of measures."""
    moment = F.current_timestamp() if at is None else F.lit(at)
    return (
        kpi_rows(measures, currency)
        .withColumn("batch_id", F.lit(batch_id))
        .withColumn("update_time", moment)
        .select(*S.GOLD_COLUMNS["ads_overview"])
    )


DAILY_BUILDERS = {
    "ads_daily_trend": daily_trend,
    "ads_category_stat": category_stat,
    "ads_product_stat": product_stat,
    "ads_channel_stat": channel_stat,
    "ads_paytype_stat": paytype_stat,
    "ads_region_stat": region_stat,
    "ads_channel_category_stat": channel_category_stat,
}


def table(
    name: str,
    silver: DataFrame,
    batch_id: str,
    currency: str = S.DEFAULT_CURRENCY,
    at: dt.datetime | None = None,
) -> DataFrame:
    """One gold table by name."""
    if name == "ads_overview":
        return overview(silver, batch_id, currency, at)
    return DAILY_BUILDERS[name](silver, at)
