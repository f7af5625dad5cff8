"""What lies on disk while queries run: shuffle files, scratch tables and parts of wide exchanges."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from conftest import TESTDATA, order_line, orders_frame, products_frame
from pyspark.sql import functions as F

from merchlake import schemas as S
from merchlake.operators import cleanse, marketplace
from merchlake.plans import catalog, etl
from merchlake.plans.catalog import QUERIES, Frames
from merchlake.session import FREE_SHUFFLES, shared_root
from merchlake.sources import tables, testdata
from merchlake.sources.tables import Scratch, Warehouse

LINES = [
    *[order_line(order_id=f"S{i}", order_time=f"2025-09-{1 + i % 9:02d} 10:00:00") for i in range(40)],
    *[order_line(order_id="S1", order_time="2025-09-02 10:00:00")] * 3,
    *[order_line(order_id=None, order_time=None, city=None, quantity="x")] * 2,
    order_line(order_id="S50", order_time="lost"),
    order_line(order_id="S51", product_id="T9", unit_price="0"),
    order_line(order_id="S52", product_id=None, pay_type=" "),
]


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while blocks.hasNext():
        names.add(blocks.next().getName())
    return {name for name in names if name.startswith("shuffle_")}


def scratch_tables(spark):
    root = Path(shared_root(spark).removeprefix("file:"), f"scratch-{spark.sparkContext.applicationId}")
    return {entry.name for entry in root.iterdir()} if root.exists() else set()


def rows(df):
    dropped = ("create_time", "update_time", "run_date", "duration_ms")
    return sorted(map(str, df.select(*sorted(c for c in df.columns if c not in dropped)).collect()))


@pytest.fixture()
def many_parts(monkeypatch):
    monkeypatch.setattr(tables, "PART_BYTES", 1)


def test_a_write_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(FREE_SHUFFLES, None)
    kept = catalog.stored_once(spark.range(1000).groupBy(F.col("id") % 7).count(), "kept")
    assert not shuffle_files(spark) - before
    assert kept.count() == 7 and spark.conf.get(FREE_SHUFFLES, None) == setting


def test_a_table_is_written_without_shuffle_files(spark, folder):
    warehouse, before = Warehouse(spark, folder), shuffle_files(spark)
    keys = orders_frame(spark, LINES).select(F.lit("2025-09-01").cast("date").alias("stat_date"), "user_id").distinct()
    warehouse.overwrite("dws_user_key", keys)
    assert not shuffle_files(spark) - before
    assert warehouse.rows("dws_user_key") == 1


def test_several_frames_are_one_version(spark, folder):
    warehouse = Warehouse(spark, folder)
    keys = spark.createDataFrame([("2025-09-01", "a"), ("2025-09-02", "b"), (None, "c")], "d string, user_id string")
    keys = keys.select(F.col("d").cast("date").alias("stat_date"), "user_id")
    warehouse.overwrite("dws_user_key", tables.day_parts(keys, "stat_date", 3))
    warehouse.overwrite("dws_user_key", tables.day_parts(keys, "stat_date", 3))
    assert len(warehouse.versions("dws_user_key")) == 1
    assert sorted(r["user_id"] for r in warehouse.read("dws_user_key").collect()) == ["a", "b", "c"]


def test_layers_in_parts_hold_the_same_rows(spark, many_parts):
    whole = Frames(spark, orders_frame(spark, LINES), products_frame(spark))
    parted = whole.once()
    assert tables.parts_of(1 << 20) == tables.MOST_PARTS
    for name in ("silver", "rejects", "counters"):
        assert rows(getattr(parted, name)) == rows(getattr(whole, name))
    assert rows(parted.sql_silver) == rows(whole.silver) and rows(parted.sql_rejects) == rows(whole.rejects)
    assert rows(parted.sql_counters) == rows(whole.counters)
    assert rows(catalog._routed(whole, "ads_daily_trend").silver) == rows(whole.silver)


def test_a_part_holds_all_copies(spark, many_parts):
    f = Frames(spark, orders_frame(spark, LINES), products_frame(spark)).once()
    copies = [r["copies"] for part in f._staged_parts(cleanse.stage, False) for r in part.collect()]
    assert sorted(copies)[-2:] == [2, 4] and sum(copies) == len(LINES)


@pytest.mark.parametrize("name", ["trend_routed", "overview_empty_gold", "build_differences", "build_compare", "recon_levels"])
def test_layers_below_are_dropped(spark, name):
    before = scratch_tables(spark)
    QUERIES[name](spark, TESTDATA)
    left = {re.sub(r"-\w+$", "", table) for table in scratch_tables(spark) - before}
    assert not left & {"raw_orders", "staged", *S.GOLD_COLUMNS}


def test_tables_are_compared_one_at_a_time(spark):
    # What is left to run reads one stored report per table.
    files = QUERIES["build_differences"](spark, TESTDATA).inputFiles()
    assert files and all("/report-" in path for path in files)


def test_a_second_load_in_parts(spark, folder, many_parts):
    later = [*LINES[:5], *LINES[40:], order_line(order_id="S60", order_time="2025-09-03 09:00:00")]
    both, once = Warehouse(spark, f"{folder}/both", ()), Warehouse(spark, f"{folder}/once")
    wanted = ("dwd_staged", "ads_overview", "ads_clean_stat", "dwd_clean_reject")
    for warehouse, first in ((both, LINES), (once, LINES + later)):
        etl.load_bronze(warehouse, orders_frame(spark, first), products_frame(spark), "B")
        etl.build(warehouse, batch_id="B", wanted=wanted)
    before = scratch_tables(spark)
    etl.load_more(both, orders_frame(spark, later), "B", wanted=wanted)
    assert not {t for t in scratch_tables(spark) - before if t.startswith("fresh")}
    for name in (*wanted, "dwd_order_detail"):
        assert rows(both.read(name)) == rows(once.read(name))


def test_loads_are_merged_by_their_fields(spark):
    staged = etl.by_day(cleanse.stage(orders_frame(spark, LINES)))
    stored = Scratch(spark, "merge").add(staged)
    plan = cleanse.merge_staged(stored.read(), stored.read())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and all("is_bad_time" not in line for line in plan.splitlines() if "FileScan" in line)


@pytest.mark.parametrize("key", ["o_custkey", "customer_id"])
def test_lines_do_not_move_by_customer(spark, key):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        if key == "o_custkey":
            df = testdata.raw_orders(spark, TESTDATA)
        else:
            df = marketplace.convert_orders(testdata.market_tables(spark, TESTDATA))
        tree = df._jdf.queryExecution().executedPlan()
        text = tree.toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    lines = text.splitlines()
    at = [i for i, line in enumerate(lines) if f"Exchange hashpartitioning({key}" in line]
    assert at
    for i in at:
        depth = len(re.match(r"[\s:+|-]*", lines[i]).group())
        below = []
        for line in lines[i + 1 :]:
            if len(re.match(r"[\s:+|-]*", line).group()) <= depth:
                break
            below.append(line)
        assert not any("l_partkey" in line for line in below)
