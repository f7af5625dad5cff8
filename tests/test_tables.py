"""Versioned tables: what readers see around writes, and what a rebuild or a later load touches."""

from __future__ import annotations

import datetime as dt
import threading
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import order_line, orders_frame, products_frame
from pyspark.sql import functions as F

from merchlake import schemas as S
from merchlake.operators import ranking
from merchlake.plans import dashboard as D
from merchlake.plans import etl
from merchlake.plans.query import AnalysisQuery
from merchlake.sources import files
from merchlake.sources.tables import Cover, Warehouse


def keys(spark, *rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d) if d else None, u) for d, u in rows], S.TABLES["dws_user_key"])


def stored(warehouse, table="dws_user_key"):
    return sorted((str(r[0]), r[1]) for r in warehouse.read(table).collect())


@pytest.mark.parametrize("by_day", [("dws_user_key",), ()])
def test_versions_replace_what_they_cover(spark, folder, by_day):
    warehouse = Warehouse(spark, folder, by_day)
    warehouse.overwrite("dws_user_key", keys(spark, ("2025-01-01", "a"), ("2025-01-02", "b"), ("2025-01-03", "c"), (None, "n")))
    before = warehouse.read("dws_user_key")
    warehouse.replace_days("dws_user_key", keys(spark, ("2025-01-02", "B")), "2025-01-02", "2025-01-03")
    assert stored(warehouse) == [("2025-01-01", "a"), ("2025-01-02", "B"), ("None", "n")]
    # A plan made before the write still shows the table of then.
    assert before.count() == 4
    warehouse.replace("dws_user_key", keys(spark, (None, "N")), Cover(loose=True))
    warehouse.append("dws_user_key", keys(spark, ("2025-01-02", "more")))
    assert stored(warehouse) == [("2025-01-01", "a"), ("2025-01-02", "B"), ("2025-01-02", "more"), ("None", "N")]
    warehouse.replace_days("dws_user_key", keys(spark), "2024-01-01", "2026-01-01")
    assert stored(warehouse) == [("None", "N")]
    warehouse.overwrite("dws_user_key", keys(spark, ("2025-01-09", "z")))
    assert stored(warehouse) == [("2025-01-09", "z")] and len(warehouse.versions("dws_user_key")) == 1


def test_a_failed_write_leaves_the_old_days(spark, folder):
    warehouse = Warehouse(spark, folder)
    warehouse.overwrite("dws_user_key", keys(spark, ("2025-01-01", "a"), ("2025-01-02", "b")))
    broken = keys(spark, ("2025-01-01", "x"), ("2025-01-02", "y")).repartition(2).withColumn(
        "user_id", F.when(F.col("user_id") == "y", F.raise_error(F.lit("lost"))).otherwise(F.col("user_id"))
    )
    with pytest.raises(Exception, match="lost"):
        warehouse.replace_days("dws_user_key", broken, "2025-01-01", "2025-01-02")
    assert stored(warehouse) == [("2025-01-01", "a"), ("2025-01-02", "b")]
    # A writer that dies after writing and before publishing changes nothing either.
    unpublished = type("Unpublished", (Warehouse,), {"_publish": lambda *a: None})(spark, folder)
    unpublished.overwrite("dws_user_key", keys(spark, ("2025-01-05", "q")))
    assert stored(warehouse) == [("2025-01-01", "a"), ("2025-01-02", "b")]
    warehouse.replace_days("dws_user_key", keys(spark, ("2025-01-01", "new")), "2025-01-01", "2025-01-01")
    assert stored(warehouse) == [("2025-01-01", "new"), ("2025-01-02", "b")]


def test_a_second_writer_is_refused(spark, folder):
    warehouse = Warehouse(spark, folder)
    warehouse.overwrite("dws_user_key", keys(spark, ("2025-01-01", "a")))
    with pytest.raises(RuntimeError, match="another writer"):
        warehouse._publish("dws_user_key", 1, [])
    assert stored(warehouse) == [("2025-01-01", "a")]


def test_vacuum_keeps_what_is_named(spark, folder):
    warehouse = Warehouse(spark, folder)
    for day in ("2025-01-01", "2025-01-02", "2025-01-03"):
        warehouse.overwrite("dws_user_key", keys(spark, (day, "a")))
    warehouse.append("dws_user_key", keys(spark, ("2025-01-04", "b")))
    warehouse.vacuum("dws_user_key")
    assert len(list(Path(warehouse.path("dws_user_key")).glob("version=*"))) == 2
    assert stored(warehouse) == [("2025-01-03", "a"), ("2025-01-04", "b")]


def test_covers():
    assert Cover.of_days(["2025-03-01", "2025-02-28", "2025-03-05"]).ranges == (
        ("2025-02-28", "2025-03-01"), ("2025-03-05", "2025-03-05")
    )
    range_ = Cover(ranges=(("2025-01-01", "2025-01-31"),))
    assert range_.contains(Cover.of_days(["2025-01-05", "2025-01-09"]))
    assert not range_.contains(Cover.of_days(["2025-01-05"], loose=True)) and not range_.contains(Cover())
    assert not range_.contains(Cover(everything=True)) and Cover(everything=True).contains(range_)


def lines(*days, **fields):
    return [order_line(order_id=f"{d}-{i}", order_time=f"2025-09-{d:02d} 10:00:0{i}", **fields) for d in days for i in range(2)]


def files_by_day(warehouse, table):
    found = {}
    for part in Path(warehouse.path(table)).glob("version=*/*=*/part-*.parquet"):
        found.setdefault(part.parent.name.split("=")[1], set()).add((part.name, part.stat().st_mtime_ns))
    return found


def test_rebuild_touches_its_days_only(spark, folder):
    warehouse = Warehouse(spark, folder)
    orders = orders_frame(spark, lines(1, 2, 3, 4) + [order_line(order_id="lost", order_time="?")] * 3)
    etl.run(warehouse, orders, products_frame(spark))
    tables = ("ods_order_detail", "dwd_staged", "dwd_order_detail", "dws_order_key")
    before = {t: files_by_day(warehouse, t) for t in tables}
    etl.rebuild_days(warehouse, orders_frame(spark, lines(2, quantity="0") + lines(3)), products_frame(spark), "2025-09-02", "2025-09-03", "B2")
    for table in tables:
        now = files_by_day(warehouse, table)
        for day in ("2025-09-01", "2025-09-04"):
            assert now[day] == before[table][day]
        plan = warehouse.read(table)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1
    assert {r["order_id"] for r in warehouse.read("dwd_order_detail").collect()} == {
        f"{d}-{i}" for d in (1, 3, 4) for i in range(2)
    }
    assert warehouse.read("ods_order_detail").where("order_id = 'lost'").count() == 3
    stat = warehouse.read("ads_clean_stat").first()
    assert (stat["raw_cnt"], stat["valid_cnt"], stat["dup_record_cnt"], stat["invalid_time_cnt"]) == (11, 6, 2, 1)
    rejects = {(r["order_id"], r["rule_code"]) for r in warehouse.read("dwd_clean_reject").collect()}
    assert rejects == {("lost", "R03"), ("2-0", "R04"), ("2-1", "R04")}


def test_copies_without_a_day_follow_the_larger_load(spark, folder):
    warehouse = Warehouse(spark, folder)
    lost = [order_line(order_id="a", order_time="?")] * 3 + [order_line(order_id="b", order_time=None)]
    etl.run(warehouse, orders_frame(spark, lines(1) + lost), products_frame(spark))
    more = lines(1) + [order_line(order_id="a", order_time="?")] + [order_line(order_id="b", order_time=None, city=None)] * 2
    for _ in range(2):
        etl.rebuild_days(warehouse, orders_frame(spark, more), products_frame(spark), "2025-09-01", "2025-09-01", "B2")
        counts = warehouse.read("ods_order_detail").groupBy("order_id", "city").count().collect()
        assert {(r[0], r[1]): r[2] for r in counts if r[0] in "ab"} == {("a", "宁波"): 3, ("b", "宁波"): 1, ("b", None): 2}


def test_a_later_load_is_merged(spark, folder):
    warehouse = Warehouse(spark, folder)
    first, second = lines(1, 2), lines(2, 3) + lines(2) + [order_line(order_id="lost", order_time="?")]
    etl.run(warehouse, orders_frame(spark, first), products_frame(spark))
    before = files_by_day(warehouse, "dwd_staged")
    etl.load_more(warehouse, orders_frame(spark, second), "B2")
    assert files_by_day(warehouse, "dwd_staged")["2025-09-01"] == before["2025-09-01"]
    once = Warehouse(spark, f"{folder}/once")
    etl.run(once, orders_frame(spark, first + second), products_frame(spark))
    for table in ("dwd_staged", "ads_daily_trend", "dws_day_sum", "dws_order_moment", "dws_clean_counter", "ads_product_stat"):
        both = [
            sorted(map(str, w.read(table).drop("update_time").collect())) for w in (warehouse, once)
        ]
        assert both[0] == both[1], table
    cards = [{r["kpi_code"]: r["kpi_value"] for r in w.read("ads_overview").collect()} for w in (warehouse, once)]
    assert cards[0] == cards[1] and cards[0]["GMV"] == Decimal("600.0000")


def test_ranges_are_counted_by_keys(spark, folder):
    warehouse = Warehouse(spark, folder)
    # An order and a buyer on two days, and an order that was refunded on one of them.
    rows = lines(1, 2, 3) + [
        order_line(order_id="two", order_time="2025-09-01 09:00:00", user_id="U"),
        order_line(order_id="two", order_time="2025-09-02 09:00:00", user_id="U", order_status="已退款"),
        order_line(order_id=None, order_time="2025-09-02 09:30:00", user_id=None),
    ]
    etl.run(warehouse, orders_frame(spark, rows), products_frame(spark))
    tables = D.Tables.stored(warehouse)
    for query in (AnalysisQuery(start_date="2025-09-01", end_date="2025-09-02"), AnalysisQuery(start_date="2025-09-03")):
        by_keys = D.overview(tables, query)
        assert "user_id" not in _scans(by_keys, "dwd_order_detail") and not _scans(by_keys, "dwd_order_detail")
        assert by_keys.collect() == D.overview(D.Tables(tables.silver, tables.gold), query).collect()


def _scans(df, table):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line and f"/{table}/" in line]


def test_pages_use_stored_moments(spark, folder):
    warehouse = Warehouse(spark, folder)
    etl.run(warehouse, orders_frame(spark, lines(1, 2, 3) + lines(3, order_status="已退款")), products_frame(spark))
    tables = D.Tables.stored(warehouse)
    plain = D.Tables(tables.silver, tables.gold)
    for query in (AnalysisQuery(page_size=2), AnalysisQuery(page_size=3, page_num=2, only_valid=0), AnalysisQuery(page_size=50, page_num=9)):
        assert D.order_page(tables, query).collect() == D.order_page(plain, query).collect()
        assert D.order_page_totals(tables, query).collect() == D.order_page_totals(plain, query).collect()


def test_a_hot_moment_is_sorted_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(ranking, "FEW_ROWS", 50)
    rows = [(1, 7 if i % 3 else i % 11, i * 37 % 1009) for i in range(1000)]
    frame = spark.createDataFrame(rows, "day int, t int, v int").repartition(4)
    expected = sorted(rows, key=lambda r: (-r[1], r[2]))
    for start, size in ((0, 10), (95, 30), (300, 200), (700, 100), (740, None)):
        page = ranking.newest_rows(frame, "day", "t", [F.asc("v")], start, size)
        assert [tuple(r) for r in page.collect()] == expected[start : None if size is None else start + size]


def test_any_text_survives_csv(spark, folder):
    texts = ["a\\b", "\\n", "\\", "\\\\n", "x\ny\r\nz", 'say "hi", ok', "nul\x00 and \\0", "\\b\\", "tab\t", "é中😀"]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "k string, t string")
    files.write_csv(rows, f"{folder}/texts")
    back = files.scan_csv(spark, f"{folder}/texts", S.all_strings(["k", "t"]))
    assert {r["k"]: r["t"] for r in back.collect()} == {str(i): t for i, t in enumerate(texts)}
    # A glob of the parts finds the mark as well; files without it are read as they are.
    assert files.scan_csv(spark, f"{folder}/texts/part-*.csv", S.all_strings(["k", "t"])).where("t = 'a\\\\b'").count() == 1
    Path(f"{folder}/plain.csv").write_text("k,t\n1,a\\nb\n", encoding="utf-8")
    both = files.scan_csv(spark, [f"{folder}/plain.csv", f"{folder}/texts"], S.all_strings(["k", "t"]))
    assert both.count() == len(texts) + 1 and both.where("k = '1' AND t = 'a\\\\nb'").count() == 1


def test_tables_written_side_by_side(spark, folder, monkeypatch):
    """All writes are under way at once, texts come back as they were, and an error is not lost."""
    texts = ["plain", "a\\b", "x\ny", " ", None]
    tables = {
        name: spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "k string, t string") for name in "abc"
    }
    met, write = threading.Barrier(3), files.write_csv

    def together(df, path):
        met.wait(timeout=60)
        write(df, path)

    monkeypatch.setattr(files, "write_csv", together)
    files.write_csvs(tables, {name: f"{folder}/{name}" for name in tables})
    for name in tables:
        back = files.scan_csv(spark, f"{folder}/{name}", S.all_strings(["k", "t"]))
        assert {r["k"]: r["t"] for r in back.collect()} == {str(i): t for i, t in enumerate(texts)}
    monkeypatch.setattr(files, "write_csv", lambda df, path: write(df.selectExpr("raise_error('no') AS k"), path))
    with pytest.raises(Exception, match="no"):
        files.write_csvs(tables, {name: f"{folder}/{name}2" for name in tables})


def test_digests_find_planted_differences(spark):
    from merchlake.operators import reconcile

    rows = [(dt.date(2025, 1, 1 + i % 5), f"u{i}") for i in range(100)]
    a = spark.createDataFrame([*rows, (None, "x"), (None, None)], S.TABLES["dws_user_key"])
    changed = [(d, "other" if u == "u7" else u) for d, u in rows]
    b = spark.createDataFrame([*changed, (None, "x"), (None, None), (dt.date(2025, 1, 4), "u3")], S.TABLES["dws_user_key"])
    sums = reconcile.digests(a, b, F.coalesce(F.dayofmonth("stat_date"), F.lit(0)))
    assert {r["part"] for r in sums.collect() if not r["agree"]} == {3, 4}
    report = reconcile.compare_tables({"t": a, "same": a}, {"t": b, "same": a.repartition(3)}, set()).collect()
    assert {tuple(r) for r in report} == {("t", 102, 103, 3, False), ("same", 102, 102, 0, True)}
    # Without days, parts come from the rows themselves.
    report = reconcile.compare_tables({"t": a}, {"t": b}, {"stat_date"}).first()
    assert report["unpaired_rows"] == 3
