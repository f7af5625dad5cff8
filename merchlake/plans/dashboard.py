"""The dashboard's questions as functions from tables and a query to a DataFrame.

Gold answers what it can: the overview without any filter, trend and product ranking without
dimension filters. Distinct counts over a range of days are never added up from daily rows; those
questions go to silver.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlake import schemas as S
from merchlake.functions.measures import rollup_measures
from merchlake.operators import gold as G
from merchlake.operators import serving
from merchlake.operators.ranking import newest_rows, ranked_shares, top_ranked
from merchlake.plans import query as Q
from merchlake.plans.query import AnalysisQuery
from merchlake.sources.tables import Warehouse

PRECOMPUTED = "PRECOMPUTE"
ON_DEMAND = "ONDEMAND"
# Gold tables that questions are routed to.
ROUTED = ("ads_overview", "ads_daily_trend", "ads_product_stat")


@dataclasses.dataclass
class Tables:
    """Silver and gold, from a warehouse or as plans not yet run.

    ``empty`` names the gold tables without rows; their questions go to silver. For stored tables
    it is read from the files' footers once; plans not yet run count as filled. ``serving`` has the
    narrow tables for ranges of days and pages, or none.
    """

    silver: DataFrame
    gold: dict[str, DataFrame]
    currency: str = S.DEFAULT_CURRENCY
    empty: frozenset[str] = frozenset()
    serving: dict[str, DataFrame] = dataclasses.field(default_factory=dict)

    @classmethod
    def stored(
        cls,
        warehouse: Warehouse,
        currency: str = S.DEFAULT_CURRENCY,
        names: tuple[str, ...] = tuple(S.GOLD_COLUMNS),
    ) -> Tables:
        gold = {name: warehouse.read(name) for name in names}
        empty = frozenset(name for name in ROUTED if name in gold and not warehouse.rows(name))
        serving = {name: warehouse.read(name) for name in S.SERVING if warehouse.versions(name)}
        return cls(warehouse.read("dwd_order_detail"), gold, currency, empty, serving)


def _sourced(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("source", F.lit(source))


# --- overview -----------------------------------------------------------------------------

CARD_COLUMNS = ["kpi_rank", "kpi_code", "kpi_name", "kpi_value", "kpi_unit", "kpi_desc"]


def overview_on_demand(tables: Tables, query: AnalysisQuery) -> DataFrame:
    """Nine KPIs over a range of days or the filtered detail. Users are counted once over the whole
    range: by the stored keys of its days where no dimension is filtered, else in the detail."""
    if tables.serving and not query.has_dimensions:
        measures = serving.overview_measures(tables.serving, Q.date_filter(query))
    else:
        measures = G.overview_measures(tables.silver.where(Q.row_filter(query)))
    cards = G.kpi_rows(measures, tables.currency)
    return _sourced(cards.select(*CARD_COLUMNS), ON_DEMAND)


def overview_stored(tables: Tables) -> DataFrame:
    """The stored KPIs in their declared order."""
    rank = F.lit(None).cast("int")
    for place, (code, *_) in enumerate(S.KPIS, start=1):
        rank = F.when(F.col("kpi_code") == code, F.lit(place)).otherwise(rank)
    stored = tables.gold["ads_overview"].withColumn("kpi_rank", rank)
    return _sourced(stored.select(*CARD_COLUMNS), PRECOMPUTED).orderBy("kpi_rank")


def overview(tables: Tables, query: AnalysisQuery) -> DataFrame:
    if query.has_dates or query.has_dimensions or "ads_overview" in tables.empty:
        return overview_on_demand(tables, query)
    return overview_stored(tables)


# --- trend --------------------------------------------------------------------------------

TREND_COLUMNS = [c for c in S.GOLD_COLUMNS["ads_daily_trend"] if c != "update_time"]


def trend_on_demand(tables: Tables, query: AnalysisQuery) -> DataFrame:
    rows = tables.silver.where(Q.row_filter(query))
    base = rollup_measures(rows, ["stat_date"], G.TREND_MEASURES)
    points = G.with_trend_ratios(base.withColumn("gmv", F.col("gmv").cast(S.GMV)))
    return _sourced(points.select(*TREND_COLUMNS), ON_DEMAND).orderBy("stat_date")


def trend_stored(tables: Tables, query: AnalysisQuery) -> DataFrame:
    points = tables.gold["ads_daily_trend"].where(Q.date_filter(query))
    return _sourced(points.select(*TREND_COLUMNS), PRECOMPUTED).orderBy("stat_date")


def trend(tables: Tables, query: AnalysisQuery) -> DataFrame:
    # Gold without rows in the range answers like silver without rows in the range.
    if query.has_dimensions or "ads_daily_trend" in tables.empty:
        return trend_on_demand(tables, query)
    return trend_stored(tables, query)


def trend_preview(tables: Tables, days: int = 5) -> DataFrame:
    """The latest days, newest first."""
    columns = ["stat_date", "valid_order_cnt", "gmv", "buyer_cnt", "refund_rate"]
    return tables.gold["ads_daily_trend"].select(*columns).orderBy(F.desc("stat_date")).limit(days)


# --- dimension statistics -------------------------------------------------------------------


def _items(tables: Tables, query: AnalysisQuery, dim: str) -> DataFrame:
    """Money, pieces, orders and users per value of one dimension, over the counted rows."""
    rows = Q.filtered(tables.silver, query).withColumnRenamed(dim, "name")
    measures = ["gmv", "sales_qty", "order_cnt", "buyer_cnt"]
    return rollup_measures(rows, ["name"], measures, counted=F.lit(True))


def category_top(tables: Tables, query: AnalysisQuery) -> DataFrame:
    return ranked_shares(_items(tables, query, "category_name"), "name", query.limit)


def region_top(tables: Tables, query: AnalysisQuery) -> DataFrame:
    return ranked_shares(_items(tables, query, "province"), "name", query.limit)


def channel_distribution(tables: Tables, query: AnalysisQuery) -> DataFrame:
    """Every channel; ``limit`` does not apply."""
    return ranked_shares(_items(tables, query, "channel"), "name", None)


def paytype_distribution(tables: Tables, query: AnalysisQuery) -> DataFrame:
    """Every payment type; ``limit`` does not apply."""
    return ranked_shares(_items(tables, query, "pay_type"), "name", None)


# --- products -------------------------------------------------------------------------------


def _product_ranks(df: DataFrame, limit: int, source: str) -> DataFrame:
    labels = [c for c in ("product_name", "category_name", "brand") if c in df.columns]
    ties = [F.asc_nulls_last(c) for c in ("product_id", *labels)]
    ranked = top_ranked(df, [F.desc("gmv"), *ties], limit)
    columns = ["product_id", *labels, "gmv", "sales_qty", "order_cnt"]
    money = ranked.withColumn("gmv", F.col("gmv").cast(S.GMV))
    return _sourced(money.select("rank_no", *columns), source)


def product_top_on_demand(tables: Tables, query: AnalysisQuery) -> DataFrame:
    rows = Q.filtered(tables.silver, query)
    dims = ["product_id", "product_name", "category_name", "brand"]
    measures = ["gmv", "sales_qty", "order_cnt"]
    stats = rollup_measures(rows, dims, measures, counted=F.lit(True))
    return _product_ranks(stats, query.limit, ON_DEMAND)


def product_top_stored(tables: Tables, query: AnalysisQuery) -> DataFrame:
    """Daily product rows added up. Products without a valid order in the range stay out, as
    they do on the detail path."""
    stats = (
        tables.gold["ads_product_stat"]
        .where(Q.date_filter(query) & (F.col("order_cnt") > 0))
        .groupBy("product_id")
        .agg(
            F.max("product_name").alias("product_name"),
            F.max("category_name").alias("category_name"),
            F.max("brand").alias("brand"),
            F.sum("gmv").alias("gmv"),
            F.sum("sales_qty").alias("sales_qty"),
            F.sum("order_cnt").alias("order_cnt"),
        )
    )
    return _product_ranks(stats, query.limit, PRECOMPUTED)


def product_top(tables: Tables, query: AnalysisQuery) -> DataFrame:
    # Gold holds valid orders only, so a query over all orders needs the detail.
    if query.has_dimensions or not query.valid_only or "ads_product_stat" in tables.empty:
        return product_top_on_demand(tables, query)
    return product_top_stored(tables, query)


# --- channel x category ---------------------------------------------------------------------


def _channel_category(tables: Tables, query: AnalysisQuery) -> DataFrame:
    rows = Q.filtered(tables.silver, query)
    stats = rollup_measures(
        rows, ["channel", "category_name"], ["gmv", "order_cnt"], counted=F.lit(True)
    )
    return stats.withColumn("gmv", F.col("gmv").cast(S.GMV))


def channel_category(tables: Tables, query: AnalysisQuery) -> DataFrame:
    return _channel_category(tables, query).orderBy(
        F.asc_nulls_last("channel"), F.desc("gmv"), F.asc_nulls_last("category_name")
    )


def channel_category_table(tables: Tables, query: AnalysisQuery, top: int = 6) -> DataFrame:
    """A row per channel found in the rows for each of the top categories by money, 0 where nothing
    was sold. Orders without a channel are a channel of their own, so a category's rows add up to its
    total."""
    cells = _channel_category(tables, query).select("category_name", "channel", "gmv")
    # One row per channel; a struct, since a collected set leaves nulls out.
    channels = cells.agg(F.collect_set(F.struct("channel"))).scalar()
    largest = (
        cells.groupBy("category_name")
        .agg(F.sum("gmv").cast(S.GMV).alias("total_gmv"))
        .orderBy(F.desc("total_gmv"), F.asc_nulls_last("category_name"))
        .limit(top)
    )
    wanted = largest.select(
        F.col("category_name").alias("_category"), "total_gmv", F.explode(channels).alias("_cell")
    )
    same = F.col("_category").eqNullSafe(F.col("category_name")) & F.col("_cell.channel").eqNullSafe(F.col("channel"))
    return (
        wanted.join(cells, same, "left")
        .select(
            F.col("_category").alias("category_name"),
            "total_gmv",
            F.col("_cell.channel").alias("channel"),
            F.coalesce("gmv", F.lit(0)).cast(S.GMV).alias("gmv"),
        )
        .orderBy(F.desc("total_gmv"), F.asc_nulls_last("category_name"), F.asc_nulls_last("channel"))
    )


# --- filter metadata ------------------------------------------------------------------------


def date_range(tables: Tables) -> DataFrame:
    days = tables.gold["ads_daily_trend"].agg(
        F.min("stat_date").alias("first"), F.max("stat_date").alias("last")
    )
    return days.select(
        F.date_format("first", "yyyy-MM-dd").alias("min_date"),
        F.date_format("last", "yyyy-MM-dd").alias("max_date"),
    )


FILTER_VALUES = {
    "channel": ("ads_channel_stat", "channel"),
    "category": ("ads_category_stat", "category_name"),
    "province": ("ads_region_stat", "province"),
    "pay_type": ("ads_paytype_stat", "pay_type"),
}


def filter_values(tables: Tables, kind: str) -> DataFrame:
    """The sorted, non-blank values one filter can take, read from its gold table."""
    table, column = FILTER_VALUES[kind]
    values = tables.gold[table].select(F.col(column).alias("value")).where("value <> ''")
    return values.distinct().orderBy("value")


def filter_meta(tables: Tables) -> DataFrame:
    """Every filter's values and the date range as (kind, value) rows."""
    days = date_range(tables).select(
        F.inline(
            F.array(
                F.struct(F.lit("min_date").alias("kind"), F.col("min_date").alias("value")),
                F.struct(F.lit("max_date").alias("kind"), F.col("max_date").alias("value")),
            )
        )
    )
    meta = days
    for kind, (table, column) in FILTER_VALUES.items():
        values = tables.gold[table].select(F.lit(kind).alias("kind"), F.col(column).alias("value"))
        meta = meta.unionByName(values.where("value <> ''").distinct())
    return meta.orderBy("kind", "value")


# --- detail ---------------------------------------------------------------------------------

DETAIL_COLUMNS = [f.name for f in S.SILVER.fields if f.name != "create_time"]


def _newest(tables: Tables, query: AnalysisQuery, start: int, size: int | None) -> DataFrame:
    rows = tables.silver.where(Q.detail_filter(query)).select(*DETAIL_COLUMNS)
    first = ["order_id", "product_id"]
    rest = [c for c in DETAIL_COLUMNS if c not in (*first, "order_time")]
    ties = [F.asc_nulls_first(c) for c in (*first, *rest)]
    return newest_rows(rows, "stat_date", "order_time", ties, start, size, _moments(tables, query))


def _moments(tables: Tables, query: AnalysisQuery) -> DataFrame | None:
    """Matching rows per moment, where a stored table tells them."""
    if "dws_order_moment" not in tables.serving or query.has_dimensions or query.order_status:
        return None
    rows = "valid_cnt" if query.valid_only else "row_cnt"
    counted = tables.serving["dws_order_moment"].where(Q.date_filter(query) & (F.col(rows) > 0))
    return counted.select("stat_date", "order_time", F.col(rows).alias("_rows"))


def order_page(tables: Tables, query: AnalysisQuery) -> DataFrame:
    """One page of order lines, newest first; all columns break ties, so pages never overlap."""
    return _newest(tables, query, (query.page_num - 1) * query.page_size, query.page_size)


def order_page_totals(tables: Tables, query: AnalysisQuery) -> DataFrame:
    """Row and page counts that go with ``order_page``."""
    size = query.page_size
    moments = _moments(tables, query)
    if moments is None:
        counted = tables.silver.where(Q.detail_filter(query)).agg(F.count(F.lit(1)).alias("total"))
    else:
        counted = moments.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"))
    return counted.select(
        F.lit(query.page_num).cast("bigint").alias("page_num"),
        F.lit(size).cast("bigint").alias("page_size"),
        "total",
        F.floor((F.col("total") + size - 1) / size).cast("bigint").alias("pages"),
    )


# Header text of the export.
EXPORT_HEADERS = {
    "order_id": "订单编号",
    "order_time": "下单时间",
    "user_id": "用户编号",
    "product_id": "商品编号",
    "product_name": "商品名称",
    "category_name": "类目",
    "brand": "品牌",
    "channel": "渠道",
    "province": "省份",
    "city": "城市",
    "quantity": "数量",
    "unit_price": "单价",
    "discount_amount": "优惠金额",
    "pay_amount": "实付金额",
    "order_status": "订单状态",
    "pay_type": "支付方式",
    "is_valid_order": "是否有效订单",
}


def order_export(tables: Tables, query: AnalysisQuery) -> DataFrame:
    """Every matching order line, or the first ``export_limit``, newest first, as text under the
    export's headers. Write it with ``sources.files.write_csv``: the parts are in order."""
    first = _newest(tables, query, 0, query.export_limit)
    flag = F.when(F.col("is_valid_order") == 1, F.lit("有效")).otherwise(F.lit("无效"))
    texts = {
        "order_time": F.date_format("order_time", "yyyy-MM-dd HH:mm:ss"),
        "is_valid_order": flag,
    }
    return first.select(
        *[texts.get(c, F.col(c)).cast("string").alias(h) for c, h in EXPORT_HEADERS.items()]
    )
