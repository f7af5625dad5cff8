"""One row per rule boundary."""

from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import order_line, orders_frame, products_frame
from pyspark.sql import functions as F

from merchlake.operators import cleanse


def staged_by_id(spark, lines):
    staged = cleanse.stage(orders_frame(spark, lines)).collect()
    return {row["order_id"]: row for row in staged}


TIMES = {
    "dash": ("2025-04-02 10:00:33", True),
    "slash": ("2025/04/02 10:00", True),
    "letter": ("2025-04-02T10:00:33", True),
    "leap": ("2024-02-29 00:00:00", True),
    "month13": ("2031/19/07 30:75:00", False),
    "zeros": ("0000-01-00 00:00:00", False),
    "word": ("no time", False),
    "april31": ("2025-04-31 08:15:00", False),
    "empty": ("", False),
    "null": (None, False),
    "slash_seconds": ("2025/04/02 10:00:33", False),
    "both_marks": ("2025/04/02T10:00", False),
    "date_only": ("2025-04-02", False),
}
QUANTITIES = {
    "0": False, "1": True, "999": True, "1000": False, "-1": False, "abc": False,
    "1.5": False, "": False, "99999": False, "99999999999": False,
}
PRICES = {
    "0": False, "0.00": False, "0.01": True, "-5.00": False, "x": False, "": False,
    "0.004": False, "0.005": True, "99999999999.00": False,
}


def test_time_formats(spark):
    rows = staged_by_id(spark, [order_line(order_id=k, order_time=t) for k, (t, _) in TIMES.items()])
    assert {k: not r["is_bad_time"] for k, r in rows.items()} == {k: ok for k, (_, ok) in TIMES.items()}
    assert {k: r["rule_code"] for k, r in rows.items()} == {
        k: None if ok else "R03" for k, (_, ok) in TIMES.items()
    }


def test_quantity_bounds(spark):
    rows = staged_by_id(spark, [order_line(order_id=q, quantity=q) for q in QUANTITIES])
    assert {q: r["rule_code"] for q, r in rows.items()} == {
        q: None if ok else "R04" for q, ok in QUANTITIES.items()
    }


def test_price_bounds(spark):
    rows = staged_by_id(spark, [order_line(order_id=p, unit_price=p) for p in PRICES])
    assert {p: r["rule_code"] for p, r in rows.items()} == {
        p: None if ok else "R05" for p, ok in PRICES.items()
    }


@pytest.mark.parametrize(
    ("paid", "discount", "flagged", "pay"),
    [
        ("100.00", "0.00", False, "100.00"),
        ("100.01", "0.00", False, "100.00"),
        ("99.99", "0.00", False, "100.00"),
        ("100.02", "0.00", True, "100.00"),
        ("99.98", "0.00", True, "100.00"),
        (None, "0.00", True, "100.00"),
        ("n/a", "0.00", True, "100.00"),
        ("90.00", "10.00", False, "90.00"),
        ("100.00", None, False, "100.00"),
        ("100.00", "junk", False, "100.00"),
    ],
)
def test_amount_is_always_recomputed(spark, paid, discount, flagged, pay):
    line = order_line(pay_amount=paid, discount_amount=discount)
    row = cleanse.stage(orders_frame(spark, [line])).first()
    assert (row["is_bad_amount"], row["pay"], row["rule_code"]) == (flagged, Decimal(pay), None)


def test_amount_counter_includes_bad_quantity_and_price(spark):
    rows = staged_by_id(
        spark, [order_line(order_id="q", quantity="0"), order_line(order_id="p", unit_price="0")]
    )
    assert all(r["is_bad_amount"] for r in rows.values())


def test_amount_too_large_for_the_column_is_flagged(spark):
    line = order_line(quantity="999", unit_price="9999999999.99")
    row = cleanse.stage(orders_frame(spark, [line])).first()
    assert row["pay"] is None and row["rule_code"] is None and row["is_bad_amount"] is True


def test_blanks_are_filled_and_trimmed(spark):
    lines = [
        order_line(order_id="null", province=None),
        order_line(order_id="empty", city=""),
        order_line(order_id="space", pay_type="  "),
        order_line(order_id="padded", province=" 浙江 "),
        order_line(order_id="tab", city="\t"),
    ]
    staged = cleanse.stage(orders_frame(spark, lines))
    flags = {r["order_id"]: r["has_blank"] for r in staged.collect()}
    assert flags == {"null": True, "empty": True, "space": True, "padded": False, "tab": False}
    rows = {r["order_id"]: r for r in cleanse.silver(staged, products_frame(spark), "B").collect()}
    assert rows["null"]["province"] == rows["empty"]["city"] == rows["space"]["pay_type"] == "未知"
    assert rows["padded"]["province"] == "浙江"
    assert rows["tab"]["city"] == "\t"


def test_status_is_standardised_and_not_trimmed(spark):
    statuses = ["已完成", "已支付", "待付款", "已取消", "已退款", "无法履约", "PAID", "已完成 ", None]
    lines = [order_line(order_id=str(i), order_status=s) for i, s in enumerate(statuses)]
    silver = cleanse.silver(cleanse.stage(orders_frame(spark, lines)), products_frame(spark), "B")
    got = {int(r["order_id"]): (r["order_status"], r["is_valid_order"]) for r in silver.collect()}
    assert [got[i][0] for i in range(9)] == [*statuses[:6], "其他", "其他", "其他"]
    assert [got[i][1] for i in range(9)] == [1, 1, 0, 0, 0, 0, 0, 0, 0]


def test_duplicates_keep_one_and_nulls_pair_up(spark):
    lines = [order_line(city=None)] * 3 + [order_line(city="")] + [order_line(user_id="V2")] * 2
    rows = cleanse.deduplicate(orders_frame(spark, lines)).collect()
    assert sorted(r["copies"] for r in rows) == [1, 2, 3]


def test_missing_product_and_blank_labels(spark):
    products = products_frame(
        spark,
        [
            ("T1", " 茶壶 ", "K10", "壶类", " ", None, None),
            ("T2", None, "", None, "白瓷", None, None),
        ],
    )
    lines = [order_line(order_id=p, product_id=p) for p in ("T1", "T2", "T9")]
    lines.append(order_line(order_id="none", product_id=None))
    staged = cleanse.stage(orders_frame(spark, lines))
    rows = {r["order_id"]: r for r in cleanse.silver(staged, products, "B").collect()}
    labels = ("product_name", "category_id", "category_name", "brand")
    assert [rows["T1"][c] for c in labels] == ["茶壶", "K10", "壶类", "未知"]
    assert [rows["T2"][c] for c in labels] == ["未知商品", "UNKNOWN", "未知类目", "白瓷"]
    assert [rows["T9"][c] for c in labels] == ["未知商品", "UNKNOWN", "未知类目", "未知"]
    missing = {r["order_id"] for r in cleanse.missing_products(staged, products).collect()}
    assert missing == {"T9", "none"}
    assert cleanse.rule_counters(staged, products).first()["missing_dim_cnt"] == 2


def test_conflicting_product_rows_pick_one_every_time(spark):
    rows = [("T1", "b", "C2", "x", "z", None, None), ("T1", "a", "C9", "y", None, None, None),
            ("T1", None, "C0", "w", "z", None, None)]
    for ordering in (rows, rows[::-1]):
        picked = cleanse.product_dimension(products_frame(spark, ordering)).collect()
        assert [tuple(r) for r in picked] == [("T1", "a", "C9", "y", None)]


def test_first_rule_wins_and_trace_skips_nulls(spark):
    lines = [
        order_line(order_id="t", order_time="x", quantity="0", unit_price="0"),
        order_line(order_id="q", quantity="0", unit_price="0"),
        order_line(order_id="p", unit_price=None),
    ]
    rejected = cleanse.rejects(cleanse.stage(orders_frame(spark, lines)), "B7").collect()
    rows = {r["order_id"]: r for r in rejected}
    assert {k: r["rule_code"] for k, r in rows.items()} == {"t": "R03", "q": "R04", "p": "R05"}
    assert rows["p"]["raw_record"] == "p|2025-09-01 10:00:00|1|100.00"
    assert rows["t"]["rule_desc"].startswith("R03") and rows["t"]["batch_id"] == "B7"


def test_long_trace_is_whole(spark):
    line = order_line(order_time="x" * 600)
    row = cleanse.rejects(cleanse.stage(orders_frame(spark, [line])), "B").first()
    assert row["raw_record"].count("x") == 600


def test_week_key_pairs_calendar_year_with_iso_week(spark):
    from merchlake.functions.rules import month_key, week_key

    days = ["2027-01-01", "2024-12-31", "2025-09-05", "2026-06-15"]
    frame = spark.createDataFrame([(d,) for d in days], "d string")
    ts = F.to_timestamp("d")
    got = {r[0]: (r[1], r[2]) for r in frame.select("d", month_key(ts), week_key(ts)).collect()}
    assert got["2027-01-01"] == ("2027-01", "2027-W53")
    assert got["2024-12-31"] == ("2024-12", "2024-W01")
    assert got["2025-09-05"] == ("2025-09", "2025-W36")
    assert got["2026-06-15"] == ("2026-06", "2026-W25")


def test_counters_split_the_raw_rows(spark):
    lines = [
        *[order_line()] * 4,
        order_line(order_id="t", order_time="x"),
        order_line(order_id="q", quantity="0", city=None),
        order_line(order_id="p", unit_price="0", order_status="??"),
        order_line(order_id="ok", product_id="T9"),
    ]
    staged = cleanse.stage(orders_frame(spark, lines))
    got = cleanse.rule_counters(staged, products_frame(spark)).first().asDict()
    assert got == {
        "raw_cnt": 8,
        "null_field_cnt": 1,
        "dup_record_cnt": 3,
        "invalid_time_cnt": 1,
        "invalid_amount_cnt": 2,
        "invalid_status_cnt": 1,
        "missing_dim_cnt": 1,
        "valid_cnt": 2,
        "discard_cnt": 3,
    }
