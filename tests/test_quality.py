"""Reports over counters, and comparisons that must fail."""

from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import order_line, orders_frame, products_frame
from pyspark.sql import functions as F

from merchlake.operators import cleanse, gold, quality, reconcile
from merchlake.sources import files
from merchlake.sources.tables import Warehouse, jdbc_writer

LINES = [
    order_line(order_id="1"),
    order_line(order_id="1"),
    order_line(order_id="2", order_time="x"),
    order_line(order_id="3", unit_price="0"),
    order_line(order_id="4", unit_price="0.00", quantity="-1"),
]


@pytest.fixture(scope="module")
def staged(spark):
    return cleanse.stage(orders_frame(spark, LINES))


@pytest.fixture(scope="module")
def counters(spark, staged):
    return cleanse.rule_counters(staged, products_frame(spark))


def test_clean_stat(counters):
    row = quality.clean_stat(counters, "B1", 12).first()
    assert (row["raw_cnt"], row["dup_record_cnt"], row["discard_cnt"], row["valid_cnt"]) == (5, 1, 3, 1)
    assert (row["quality_score"], row["duration_ms"]) == (Decimal("0.2000"), 12)
    assert quality.count_invariant(counters).first()["passed"]


def test_score_without_rows_is_zero(spark):
    empty = cleanse.rule_counters(cleanse.stage(orders_frame(spark, [])), products_frame(spark))
    row = quality.clean_stat(empty, "B1").first()
    assert (row["raw_cnt"], row["quality_score"]) == (0, Decimal("0.0000"))
    assert quality.pass_rate(empty).first()["pass_rate"] == 0


def test_reports(counters, staged):
    assert [r["row_cnt"] for r in quality.quality_funnel(counters).collect()] == [5, 0, 1, 1, 2, 0, 0, 1]
    hits = {r["rule_code"]: r["hit_cnt"] for r in quality.rule_table(counters).collect()}
    assert hits == {"R01": 0, "R02": 1, "R03": 1, "R04-R06": 2, "R07": 0, "R08": 0}
    summary = quality.reject_summary(cleanse.rejects(staged, "B"))
    assert [tuple(r) for r in summary.collect()] == [("R03", 1), ("R04", 1), ("R05", 1)]
    assert quality.pass_rate(counters).first()["pass_rate"] == Decimal("0.200000")


def test_a_failed_check_is_reported(spark, staged):
    silver = cleanse.silver(staged, products_frame(spark), "B")
    trend = gold.daily_trend(silver)
    off = trend.withColumn("gmv", F.col("gmv") + F.lit("0.02").cast("decimal(3,2)"))
    rows = reconcile.consistency(silver, off, gold.category_stat(silver)).collect()
    assert [r["passed"] for r in rows] == [False, True, True, True]
    assert rows[0]["diff"] == Decimal("0.02")
    near = trend.withColumn("gmv", F.col("gmv") + F.lit("0.01").cast("decimal(3,2)"))
    assert reconcile.consistency(silver, near, gold.category_stat(silver)).first()["passed"]


def test_builds_that_differ_fail(spark, staged):
    silver = cleanse.silver(staged, products_frame(spark), "B")
    rejected, trend = cleanse.rejects(staged, "B"), gold.daily_trend(silver)
    a = reconcile.build_snapshot(silver, rejected, trend, "a_")
    same = reconcile.compare_builds(a, reconcile.build_snapshot(silver, rejected, trend, "b_")).first()
    assert (same["verdict"], same["differences"]) == ("PASS", "")
    b = reconcile.build_snapshot(silver.limit(0), rejected.limit(1), trend, "b_")
    other = reconcile.compare_builds(a, b).first()
    assert (other["verdict"], other["differences"]) == ("FAIL", "silver_rows,reject_rows")


def test_row_level_comparison_pairs_nulls_and_counts_copies(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "x"), (3, "z")], "k int, v string")
    surplus = {(r["k"], r["v"]): r["surplus"] for r in reconcile.differing_rows(a, b).collect()}
    assert surplus == {(1, None): 1, (3, "y"): 1, (3, "z"): -1}
    row = reconcile.compare_tables({"t": a}, {"t": b}, set()).first()
    assert (row["a_rows"], row["b_rows"], row["unpaired_rows"], row["passed"]) == (4, 3, 3, False)


def test_failed_comparison_turns_the_log_to_warn(spark):
    snapshots = spark.createDataFrame(
        [("B1", "DATAFRAME", 1, 2, 100, 40, 10, 8, 20), ("B2", "SQL", 3, 4, 130, 50, 10, 8, 20)],
        "batch_id string, compute_mode string, start_time long, end_time long, duration_ms long, "
        "clean_ms long, raw_rows long, silver_rows long, gold_rows long",
    )
    failed = spark.createDataFrame([("FAIL",)], "verdict string")
    log = quality.job_log_rows(snapshots, failed).collect()
    assert [r["job_status"] for r in log] == ["WARN", "WARN"]
    assert [r["output_rows"] for r in log] == [28, 28]
    assert [("是" in r["remark"]) for r in log] == [False, True]
    row = quality.compare_durations(quality.job_log_rows(snapshots, failed), "DATAFRAME", "SQL").first()
    assert (row["diff_ms"], row["slower_pct"]) == (30, 30)


def test_csv_round_trip_keeps_quotes_commas_and_spaces(spark, folder):
    lines = [
        order_line(order_id='say "hi"', city="a,b", province=" padded "),
        order_line(order_id="2", city=None, province="", pay_type=" "),
    ]
    path = f"{folder}/orders"
    files.write_csv(orders_frame(spark, lines), path)
    back = {r["order_id"]: r for r in files.scan_orders(spark, path, escaped=True).collect()}
    assert (back['say "hi"']["city"], back['say "hi"']["province"]) == ("a,b", " padded ")
    assert (back["2"]["city"], back["2"]["province"], back["2"]["pay_type"]) == (None, None, " ")


def test_csv_doubles_quotes_and_keeps_records_on_a_line(spark, folder):
    from pathlib import Path

    from merchlake import schemas as S

    row = ('say "hi"', "a,b", "x\ny\\n", "plain", "\\")
    rows = spark.createDataFrame([row], "a string, b string, c string, d string, e string").coalesce(1)
    files.write_csv(rows, f"{folder}/export")
    (part,) = Path(f"{folder}/export").glob("part-*.csv")
    assert part.read_text(encoding="utf-8").count("\n") == 2
    assert '"say ""hi""","a,b",' in part.read_text(encoding="utf-8")
    back = files.scan_csv(spark, f"{folder}/export", S.all_strings(list("abcde")), escaped=True)
    assert tuple(back.first()) == row


def test_csv_parts_are_in_order(spark, folder):
    import csv
    from pathlib import Path

    rows = spark.range(0, 1000, 1, 8).select(F.col("id").cast("string").alias("v"), (-F.col("id")).alias("k"))
    files.write_csv(rows.orderBy("k"), f"{folder}/sorted")
    read = []
    for part in sorted(Path(f"{folder}/sorted").glob("part-*.csv")):
        read += [int(r["v"]) for r in csv.DictReader(part.open())]
    assert read == list(range(999, -1, -1))


def test_short_lines_are_kept(spark, folder):
    from pathlib import Path

    from merchlake import schemas as S

    path = Path(folder) / "orders.csv"
    path.write_text(",".join(S.ORDER_FIELDS) + "\nS1,2025-09-01 10:00:00,V1\n", encoding="utf-8")
    row = files.scan_orders(spark, str(path)).first()
    assert (row["order_id"], row["user_id"], row["product_id"]) == ("S1", "V1", None)


def test_empty_tables_stay_readable(spark, staged, folder):
    warehouse = Warehouse(spark, folder)
    nothing = cleanse.silver(staged.limit(0), products_frame(spark), "B")
    warehouse.overwrite("dwd_order_detail", nothing)
    warehouse.overwrite("ads_product_stat", gold.product_stat(warehouse.read("dwd_order_detail")))
    assert warehouse.rows("dwd_order_detail") == warehouse.rows("ads_product_stat") == 0


def test_jdbc_options(spark, staged):
    """The options only: writing needs a database, which these tests do not start."""
    options: dict = {}

    class Recorder:
        def mode(self, value):
            options["mode"] = value
            return self

        def option(self, key, value):
            options[key] = value
            return self

    class Frame:
        write = Recorder()

    jdbc_writer(Frame())
    assert options == {"mode": "append", "batchsize": 2000, "isolationLevel": "READ_COMMITTED"}


def test_scratch_folder(spark):
    from types import SimpleNamespace

    from merchlake.session import scratch_path, shared_root

    def session(master, named=None):
        conf = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": "file:/w"}
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default=None: conf[key] or default),
            sparkContext=SimpleNamespace(master=master),
        )

    assert shared_root(session("spark://host:7077", "hdfs://shared/scratch/")) == "hdfs://shared/scratch"
    assert shared_root(session("local[4]")) == "file:/w/_scratch"
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_root(session(master))
    first, second = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert first != second and spark.sparkContext.applicationId in first


def test_latest_quality_goes_by_time(spark):
    import datetime as dt

    from merchlake import schemas as S

    counts = (1,) * 9
    rows = [
        ("B9", dt.date(2025, 9, 1), *counts, None, 0, dt.datetime(2025, 9, 1, 8)),
        ("B10", dt.date(2025, 9, 1), *counts, None, 0, dt.datetime(2025, 9, 1, 9)),
    ]
    frame = spark.createDataFrame(rows, S.TABLES["ads_clean_stat"])
    assert quality.latest_quality(frame).first()["batch_id"] == "B10"
