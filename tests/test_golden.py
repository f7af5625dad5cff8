"""Six orders over three days with a buyer who comes back: stored totals worked out by hand."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from merchlake.operators import quality, reconcile
from merchlake.plans import dashboard as D
from merchlake.plans import etl
from merchlake.plans.query import AnalysisQuery
from merchlake.sources import files
from merchlake.sources.tables import Warehouse

ORDERS = """﻿order_id,order_time,user_id,product_id,channel,province,city,quantity,unit_price,discount_amount,pay_amount,order_status,pay_type
R01,2025-11-10 08:05:00,kim,T7,官网,江苏,南京,2,45.50,1.00,90.00,已支付,银行卡
R02,2025/11/10 21:40,lee,T7,门店,江苏,苏州,1,45.50,0.00,45.50,已完成,现金

R03,2025-11-12 09:00:00,kim,T8,官网,江苏,南京,3,20.00,0.00,60.00,已完成,银行卡
R04,2025-11-12T09:00:00,moe,T8,门店,福建,厦门,1,20.00,0.00,20.00,已退款,现金
R05,2025-11-12 23:59:59,moe,T9,门店,福建,厦门,1,99.90,0.00,99.90,已取消,现金
R06,2025-11-13 00:00:00,kim,T7,官网,江苏,南京,1,45.50,5.50,40.00,已支付,银行卡
"""
PRODUCTS = """﻿product_id,product_name,category_id,category_name,brand,cost_price,launch_date
T7,砂壶,K3,壶,山房,21.00,2024-03-08
T8,瓷杯,K4,杯,山房,7.25,2024-03-08
T9,银杯,K4,杯,银作,64.00,2024-06-30
"""


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("golden")
    (root / "orders.csv").write_text(ORDERS, encoding="utf-8")
    (root / "products.csv").write_text(PRODUCTS, encoding="utf-8")
    tables = Warehouse(spark, str(root / "tables"))
    etl.run(
        tables,
        files.scan_orders(spark, str(root / "orders.csv")),
        files.scan_products(spark, str(root / "products.csv")),
        (etl.DATAFRAME, etl.SQL),
    )
    return tables


@pytest.fixture(scope="module")
def tables(warehouse):
    return D.Tables.stored(warehouse)


def cards(df):
    return {r["kpi_code"]: r["kpi_value"] for r in df.collect()}


def test_silver(warehouse):
    silver = warehouse.read("dwd_order_detail")
    assert silver.count() == 6
    assert silver.where("is_valid_order = 1").count() == 4
    assert [f.name for f in silver.schema.fields][:4] == ["order_id", "order_time", "stat_date", "stat_month"]
    assert warehouse.rows("dwd_clean_reject") == 0


def test_trend(warehouse):
    rows = warehouse.read("ads_daily_trend").orderBy("stat_date").collect()
    got = [(r["stat_date"], r["order_cnt"], r["valid_order_cnt"], r["buyer_cnt"], r["gmv"]) for r in rows]
    assert got == [
        (dt.date(2025, 11, 10), 2, 2, 2, Decimal("135.50")),
        (dt.date(2025, 11, 12), 3, 1, 1, Decimal("60.00")),
        (dt.date(2025, 11, 13), 1, 1, 1, Decimal("40.00")),
    ]
    # Daily buyers add up to 4, which is no count of buyers.
    assert sum(r["buyer_cnt"] for r in rows) == 4
    assert rows[1]["refund_rate"] == Decimal("0.3333")


def test_overview_without_filter_comes_from_gold(tables):
    answer = D.overview(tables, AnalysisQuery())
    assert {r["source"] for r in answer.collect()} == {"PRECOMPUTE"}
    assert cards(answer) == {
        "GMV": Decimal("235.5000"),
        "ORDER_CNT": Decimal("6.0000"),
        "VALID_ORDER_CNT": Decimal("4.0000"),
        "SALES_QTY": Decimal("7.0000"),
        "BUYER_CNT": Decimal("2.0000"),
        "AVG_ORDER_AMOUNT": Decimal("58.8800"),
        "AVG_ITEM_PRICE": Decimal("33.6400"),
        "REFUND_RATE": Decimal("16.6667"),
        "DISCOUNT_RATE": Decimal("2.6860"),
    }


@pytest.mark.parametrize(
    ("start", "end", "buyers", "money"),
    [
        ("2025-11-10", "2025-11-10", 2, "135.50"),
        ("2025-11-11", "2025-11-12", 1, "60.00"),
        ("2025-11-10", "2025-11-13", 2, "235.50"),
    ],
)
def test_overview_by_range_comes_from_silver(tables, start, end, buyers, money):
    answer = D.overview(tables, AnalysisQuery(start_date=start, end_date=end))
    assert {r["source"] for r in answer.collect()} == {"ONDEMAND"}
    got = cards(answer)
    assert (got["BUYER_CNT"], got["GMV"]) == (buyers, Decimal(money))


def test_detail_totals(tables):
    assert D.order_page_totals(tables, AnalysisQuery()).first()["total"] == 4
    everything = D.order_page_totals(tables, AnalysisQuery(only_valid=0, page_size=4)).first()
    assert (everything["total"], everything["pages"]) == (6, 2)
    newest = D.order_page(tables, AnalysisQuery(only_valid=0, page_size=4)).collect()
    assert [r["order_id"] for r in newest] == ["R06", "R05", "R03", "R04"]


def test_cancelled_product_is_absent_on_both_paths(tables):
    stored = D.product_top(tables, AnalysisQuery())
    detail = D.product_top(tables, AnalysisQuery(pay_type="银行卡"))
    assert [(r["product_id"], r["gmv"]) for r in stored.collect()] == [("T7", Decimal("175.50")), ("T8", 60)]
    assert [(r["product_id"], r["gmv"]) for r in detail.collect()] == [("T7", 130), ("T8", 60)]
    everything = D.product_top(tables, AnalysisQuery(only_valid=0)).collect()
    assert [(r["product_id"], r["source"]) for r in everything] == [
        ("T7", "ONDEMAND"), ("T9", "ONDEMAND"), ("T8", "ONDEMAND")
    ]


def test_consistency(tables):
    checks = reconcile.consistency(
        tables.silver, tables.gold["ads_daily_trend"], tables.gold["ads_category_stat"]
    ).collect()
    assert len(checks) == 4 and all(r["passed"] for r in checks)


def test_run_log(warehouse):
    log = quality.job_logs(warehouse.read("etl_job_log")).collect()
    assert [r["compute_mode"] for r in log] == ["DATAFRAME", "SQL"]
    assert {r["job_status"] for r in log} == {"SUCCESS"}
    # 6 detail rows; 3 days, 3 categories, 4 products, 5 channels, 5 payment types, 4 provinces,
    # 5 channels by category, 9 KPIs.
    assert [(r["input_rows"], r["output_rows"]) for r in log] == [(6, 44), (6, 44)]
    assert "结果发布：否" in log[0]["remark"] and "结果发布：是" in log[1]["remark"]
    assert all(r["remark"].endswith("PASS") for r in log)
    side_by_side = quality.compare_durations(warehouse.read("etl_job_log"), "DATAFRAME", "SQL").first()
    assert side_by_side["diff_ms"] == log[1]["duration_ms"] - log[0]["duration_ms"]


def test_quality_row(warehouse):
    row = quality.latest_quality(warehouse.read("ads_clean_stat")).first()
    assert (row["raw_cnt"], row["valid_cnt"], row["quality_score"]) == (6, 6, Decimal("1.0000"))
    assert row["batch_id"].endswith("-SQL")


def test_rerun_leaves_one_copy(warehouse):
    before = warehouse.rows("ads_product_stat")
    etl.build(warehouse, etl.DATAFRAME, "B9")
    assert warehouse.rows("dwd_order_detail") == 6
    assert warehouse.rows("ads_product_stat") == before
    assert warehouse.read("dwd_order_detail").select("batch_id").distinct().collect()[0][0] == "B9"


@pytest.mark.parametrize("by_day", [("dwd_order_detail", "ads_product_stat", "dwd_staged"), ()])
def test_rebuild_of_days(spark, tmp_path, by_day):
    """Two days come anew: one loses all rows, the other gets one order, a reject and a lost time."""
    from conftest import order_line, orders_frame

    (tmp_path / "orders.csv").write_text(ORDERS, encoding="utf-8")
    (tmp_path / "products.csv").write_text(PRODUCTS, encoding="utf-8")
    products = files.scan_products(spark, str(tmp_path / "products.csv"))
    tables = Warehouse(spark, str(tmp_path / "tables"), by_day)
    etl.load_bronze(tables, files.scan_orders(spark, str(tmp_path / "orders.csv")), products, "B8")
    etl.build(tables, etl.DATAFRAME, "B8")
    changed = [
        order_line(order_id="N1", order_time="2025-11-12 10:00:00", product_id="T8", quantity="3", pay_amount="300.00"),
        order_line(order_id="N2", order_time="2025-11-12 11:00:00", quantity="0"),
        order_line(order_id="N3", order_time="never"),
        order_line(order_id="N4", order_time="2025-12-24 10:00:00"),
    ]
    for _ in range(2):
        etl.rebuild_days(tables, orders_frame(spark, changed), products, "2025-11-12", "2025-11-13", "B10")
        trend = tables.read("ads_daily_trend").orderBy("stat_date").collect()
        assert [(str(r["stat_date"]), r["gmv"]) for r in trend] == [
            ("2025-11-10", Decimal("135.50")), ("2025-11-12", Decimal("300.00"))
        ]
        rows = {(r["order_id"], r["batch_id"]) for r in tables.read("dwd_order_detail").collect()}
        assert rows == {("R01", "B8"), ("R02", "B8"), ("N1", "B10")}
        assert {(r["order_id"], r["rule_code"]) for r in tables.read("dwd_clean_reject").collect()} == {
            ("N2", "R04"), ("N3", "R03")
        }
        stat = tables.read("ads_clean_stat").first()
        assert (stat["raw_cnt"], stat["valid_cnt"], stat["discard_cnt"], stat["invalid_time_cnt"]) == (5, 3, 2, 1)
        assert {r["order_id"] for r in tables.read("ods_order_detail").collect()} == {"R01", "R02", "N1", "N2", "N3"}
        assert tables.rows("ods_order_detail") == 5
        assert cards(tables.read("ads_overview"))["GMV"] == Decimal("435.5000")
        products_left = tables.read("ads_product_stat").orderBy("stat_date").collect()
        assert [r["gmv"] for r in products_left] == [Decimal("135.50"), Decimal("300.00")]
