"""The query object, routing, and ranking helpers."""

from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import order_line, orders_frame, products_frame
from pyspark.sql import functions as F

from merchlake import schemas as S
from merchlake.operators import cleanse, gold, ranking
from merchlake.plans import dashboard as D
from merchlake.plans.query import AnalysisQuery


def lazy_tables(spark, lines, products=None):
    silver = cleanse.silver(cleanse.stage(orders_frame(spark, lines)), products_frame(spark, products), "B")
    return D.Tables(silver, {name: gold.table(name, silver, "B") for name in S.GOLD_COLUMNS})


def test_normalisation():
    q = AnalysisQuery(
        start_date=" 2025-10-01 ", end_date="2025-09-01", channel="  ", province=" 浙江 ",
        limit=0, page_size=-1, export_limit=None, page_num=0,
    )
    assert (q.start_date, q.end_date) == ("2025-09-01", "2025-10-01")
    assert (q.channel, q.province) == (None, "浙江")
    assert (q.limit, q.page_size, q.export_limit, q.page_num) == (10, 20, None, 1)
    large = AnalysisQuery(limit=500, page_size=1000, export_limit=10**6)
    assert (large.limit, large.page_size, large.export_limit) == (500, 1000, 10**6)


LINES = [
    order_line(order_id="1", user_id="V1", product_id="T1", province="浙江", pay_amount="100.00"),
    order_line(order_id="2", user_id="V2", product_id="T2", province="北京", unit_price="200.00"),
    order_line(order_id="3", user_id="V1", product_id="T9", province="上海", unit_price="33.33"),
    order_line(order_id="4", user_id="V3", product_id="T1", channel="官网", order_status="已退款"),
    order_line(order_id="5", user_id="V1", product_id="T1", order_time="2025-09-03T08:00:00"),
]


@pytest.fixture(scope="module")
def tables(spark):
    return lazy_tables(spark, LINES)


def test_share_does_not_depend_on_the_cut(tables):
    full = {r["name"]: r["ratio"] for r in D.region_top(tables, AnalysisQuery(limit=100)).collect()}
    one = D.region_top(tables, AnalysisQuery(limit=1)).collect()
    assert [(r["rank_no"], r["name"]) for r in one] == [(1, "北京")]
    assert one[0]["ratio"] == full["北京"] == Decimal("46.15")
    assert sum(full.values()) <= Decimal("100.01")


def test_ties_go_by_name(tables):
    rows = D.region_top(tables, AnalysisQuery(end_date="2025-09-01", province=None)).collect()
    assert [r["name"] for r in rows] == ["北京", "浙江", "上海"]


def test_distribution_ranks_every_value(tables):
    rows = D.channel_distribution(tables, AnalysisQuery(limit=1, only_valid=0)).orderBy("rank_no").collect()
    assert [(r["rank_no"], r["name"], r["order_cnt"]) for r in rows] == [(1, "线下门店", 4), (2, "官网", 1)]
    assert [r["ratio"] for r in rows] == [Decimal("81.25"), Decimal("18.75")]


def test_zero_total_gives_zero_share(spark):
    free = order_line(discount_amount="100.00", pay_amount="0.00")
    rows = D.channel_distribution(lazy_tables(spark, [free]), AnalysisQuery()).collect()
    assert [(r["gmv"], r["ratio"]) for r in rows] == [(Decimal("0.00"), Decimal("0.00"))]


def test_null_dimension_is_a_group_of_its_own(spark):
    frames = lazy_tables(spark, [order_line(order_id="1", channel=None), order_line(order_id="2")])
    rows = D.channel_distribution(frames, AnalysisQuery()).orderBy("rank_no").collect()
    assert [(r["name"], r["gmv"]) for r in rows] == [("线下门店", 100), (None, 100)]
    values = D.filter_values(frames, "channel").collect()
    assert [r["value"] for r in values] == ["线下门店"]


def test_order_count_keeps_refunds(tables):
    day = {str(r["stat_date"]): r for r in D.trend(tables, AnalysisQuery(channel="官网")).collect()}
    assert (day["2025-09-01"]["order_cnt"], day["2025-09-01"]["valid_order_cnt"]) == (1, 0)
    assert day["2025-09-01"]["refund_rate"] == Decimal("1.0000")
    assert day["2025-09-01"]["avg_order_amount"] == Decimal("0.00")


def sources(df):
    return {r["source"] for r in df.collect()}


def test_routing(tables):
    dates = {"start_date": "2025-09-01", "end_date": "2025-09-03"}
    assert sources(D.trend(tables, AnalysisQuery(**dates))) == {"PRECOMPUTE"}
    assert sources(D.trend(tables, AnalysisQuery(pay_type="现金"))) == {"ONDEMAND"}
    assert sources(D.product_top(tables, AnalysisQuery(**dates))) == {"PRECOMPUTE"}
    assert sources(D.product_top(tables, AnalysisQuery(channel="线下门店"))) == {"ONDEMAND"}
    assert sources(D.overview(tables, AnalysisQuery(**dates))) == {"ONDEMAND"}


def test_empty_gold_falls_back_to_silver(spark, tables, folder):
    from merchlake.sources.tables import Warehouse

    warehouse = Warehouse(spark, folder)
    warehouse.overwrite("dwd_order_detail", tables.silver)
    for name, df in tables.gold.items():
        warehouse.overwrite(name, df.limit(0))
    empty = D.Tables.stored(warehouse)
    assert empty.empty == frozenset(D.ROUTED)
    assert sources(D.overview(empty, AnalysisQuery())) == {"ONDEMAND"}
    assert sources(D.trend(empty, AnalysisQuery())) == {"ONDEMAND"}
    assert sources(D.product_top(empty, AnalysisQuery())) == {"ONDEMAND"}


def test_routing_runs_nothing(spark, tables):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    D.overview(tables, AnalysisQuery())
    D.trend(tables, AnalysisQuery())
    D.product_top(tables, AnalysisQuery())
    D.order_page(tables, AnalysisQuery(page_num=7))
    D.channel_distribution(tables, AnalysisQuery())
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_no_rows_at_all(spark):
    frames = lazy_tables(spark, [order_line(order_time="x")])
    kpis = frames.gold["ads_overview"].collect()
    assert len(kpis) == 9 and all(r["kpi_value"] == 0 and r["stat_date"] is None for r in kpis)
    assert frames.gold["ads_daily_trend"].count() == 0
    assert D.category_top(frames, AnalysisQuery()).count() == 0
    assert D.channel_distribution(frames, AnalysisQuery()).count() == 0


def test_cross_table_fills_gaps(tables):
    rows = D.channel_category_table(tables, AnalysisQuery(only_valid=0), top=2).collect()
    assert [(r["category_name"], r["total_gmv"], r["channel"], r["gmv"]) for r in rows] == [
        ("壶类", Decimal("300.00"), "官网", Decimal("100.00")),
        ("壶类", Decimal("300.00"), "线下门店", Decimal("200.00")),
        ("杯类", Decimal("200.00"), "官网", Decimal("0.00")),
        ("杯类", Decimal("200.00"), "线下门店", Decimal("200.00")),
    ]


def test_cross_table_adds_up_with_new_and_missing_channels(spark):
    lines = [order_line(order_id=str(i), channel=c) for i, c in enumerate(["直播", None, None])]
    rows = D.channel_category_table(lazy_tables(spark, lines), AnalysisQuery()).collect()
    assert [(r["channel"], r["total_gmv"], r["gmv"]) for r in rows] == [("直播", 300, 100), (None, 300, 200)]


def test_export_headers_and_flags(tables):
    rows = D.order_export(tables, AnalysisQuery(only_valid=0, export_limit=2))
    assert rows.columns[0] == "订单编号" and len(rows.columns) == 17
    assert [r["是否有效订单"] for r in rows.collect()] == ["有效", "有效"]
    refunded = D.order_export(tables, AnalysisQuery(only_valid=0, order_status="已退款")).collect()
    assert [(r["订单编号"], r["是否有效订单"]) for r in refunded] == [("4", "无效")]


def test_row_numbers_over_many_partitions(spark):
    frame = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5003).alias("v"))
    bucket = ranking.falling_money(F.col("v"))
    numbered = ranking.number_rows(frame, bucket, [F.desc("v")], "no").collect()
    values = sorted((r["v"] for r in numbered), reverse=True)
    assert {r["v"]: r["no"] for r in numbered} == {v: i for i, v in enumerate(values, start=1)}


@pytest.mark.parametrize("size", [1, 50, 700, None])
def test_pages_are_in_order_at_any_depth(spark, size):
    """Days of very different sizes, one of them with a third of the rows, many rows per moment."""
    values = [(0 if i % 3 == 0 else 1 + i * i % 7, i * 37 % 11, i * 41 % 1009) for i in range(1000)]
    frame = spark.createDataFrame([(d, d * 100 + t, v) for d, t, v in values], "day int, t int, v int").repartition(5)
    expected = sorted(((d, d * 100 + t, v) for d, t, v in values), key=lambda r: (-r[1], r[2]))
    for start in (0, 1, 300, 666, 950, 999, 1000, 5000):
        page = ranking.newest_rows(frame, "day", "t", [F.asc("v")], start, size)
        end = None if size is None else start + size
        assert [tuple(r) for r in page.collect()] == expected[start:end]


def test_pages_never_end_in_one_task(spark, tables):
    for query in (AnalysisQuery(page_size=100_000), AnalysisQuery(page_num=50, page_size=200)):
        plan = D.order_page(tables, query)._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" not in plan and "GlobalLimit" not in plan
    everything = D.order_export(tables, AnalysisQuery(only_valid=0))
    assert everything.count() == len(LINES)


def test_newest_rows_open_their_days_only(spark, folder):
    from merchlake.sources.tables import Warehouse

    lines = [order_line(order_id=str(i), order_time=f"2025-09-{i:02d} 10:00:00") for i in range(1, 10)]
    warehouse = Warehouse(spark, folder)
    warehouse.overwrite("dwd_order_detail", lazy_tables(spark, lines).silver)
    page = D.order_page(D.Tables(warehouse.read("dwd_order_detail"), {}), AnalysisQuery(page_size=2))
    assert [r["order_id"] for r in page.collect()] == ["9", "8"]
    plan = page._jdf.queryExecution().executedPlan().toString()
    # The scans of full rows; counting per day reads filter columns only.
    scans = [line for line in plan.splitlines() if "FileScan" in line and "user_id" in line]
    assert scans and all("PartitionFilters: [isnotnull(stat_date" in s and "2025-09-08" in s for s in scans)


def test_date_filter_reaches_the_scan(spark, folder):
    from merchlake.plans import query as Q
    from merchlake.sources.tables import Warehouse

    warehouse = Warehouse(spark, folder)
    warehouse.overwrite("dwd_order_detail", lazy_tables(spark, LINES).silver)
    silver = warehouse.read("dwd_order_detail")
    picked = Q.filtered(silver, AnalysisQuery(start_date="2025-09-02", channel="线下门店")).select("pay_amount")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stat_date" in plan
    assert "EqualTo(channel,线下门店)" in plan
    assert "ReadSchema: struct<channel:string,pay_amount:decimal(14,2),is_valid_order:int>" in plan
    assert [r[0] for r in picked.collect()] == [Decimal("100.00")]


def test_ratios_round_half_up_like_decimals(spark):
    import random
    from decimal import ROUND_HALF_UP

    from merchlake.functions.measures import ratio

    rng = random.Random(11)
    pairs = [(Decimal(rng.randrange(10**9)) / 100, rng.randrange(0, 400)) for _ in range(500)]
    pairs += [(Decimal("0.05"), 10), (Decimal("1.005"), 1), (Decimal("100.01"), 2), (Decimal("7"), 0)]
    frame = spark.createDataFrame(pairs, "a decimal(24,3), b long")
    for digits in (2, 4):
        got = frame.select("a", "b", ratio(F.col("a"), F.col("b"), digits).alias("r")).collect()
        unit = Decimal(1).scaleb(-digits)
        for r in got:
            expected = (r["a"] / r["b"]).quantize(unit, ROUND_HALF_UP) if r["b"] else Decimal(0)
            assert r["r"] == expected, r
