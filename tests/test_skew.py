"""One key holding a third of all rows or more, against brute force."""

from __future__ import annotations

import random
from contextlib import contextmanager
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import order_line, orders_frame, products_frame
from pyspark.sql import functions as F

from merchlake import schemas as S
from merchlake.functions.measures import rollup_measures
from merchlake.operators import cleanse, gold, marketplace
from merchlake.sources.tables import Warehouse


@contextmanager
def conf(spark, **settings):
    names = {key.replace("__", "."): value for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def random_lines(seed: int, n: int) -> list[dict]:
    """A third of the lines share their day, channel, order, user and product."""
    rng = random.Random(seed)
    lines = []
    for _ in range(n):
        hot = rng.random() < 0.34
        lines.append(
            {
                "order_id": "hot" if hot else rng.choice([None, *map(str, range(40))]),
                "user_id": "hot" if hot else rng.choice([None, *map(str, range(15))]),
                "product_id": "T1" if hot else f"T{rng.randrange(6)}",
                "order_time": f"2025-09-{1 if hot else rng.randrange(1, 6):02d} 10:00:00",
                "channel": "hot" if hot else rng.choice(["a", "b", None]),
                "province": rng.choice(["x", "y"]),
                "quantity": str(rng.randrange(1, 9)),
                "unit_price": f"{rng.randrange(1, 5000) / 100:.2f}",
                "order_status": rng.choice([*S.LEGAL_STATUSES, "??"]),
            }
        )
    return lines


def brute_force(rows, dims):
    """Plain loops over the silver rows."""
    groups: dict[tuple, dict] = {}
    for r in rows:
        g = groups.setdefault(
            tuple(r[d] for d in dims),
            {"gmv": Decimal("0.00"), "qty": 0, "all": set(), "valid": set(), "buyers": set(), "refund": set()},
        )
        if r["order_id"] is not None:
            g["all"].add(r["order_id"])
            if r["order_status"] == S.STATUS_REFUNDED:
                g["refund"].add(r["order_id"])
        if r["is_valid_order"]:
            g["gmv"] += r["pay_amount"]
            g["qty"] += r["quantity"]
            if r["order_id"] is not None:
                g["valid"].add(r["order_id"])
            if r["user_id"] is not None:
                g["buyers"].add(r["user_id"])
    return {
        k: (g["gmv"], g["qty"], len(g["all"]), len(g["valid"]), len(g["buyers"]), len(g["refund"]))
        for k, g in groups.items()
    }


@pytest.fixture(scope="module")
def silver(spark):
    lines = [order_line(**fields) for fields in random_lines(7, 600)]
    staged = cleanse.stage(orders_frame(spark, lines))
    return cleanse.silver(staged, products_frame(spark), "B").cache()


@pytest.mark.parametrize("dims", [[], ["stat_date"], ["stat_date", "channel"], ["province", "product_id"]])
def test_measures_match_brute_force(silver, dims):
    names = ["gmv", "sales_qty", "order_cnt", "valid_order_cnt", "buyer_cnt", "refund_order_cnt"]
    got = rollup_measures(silver, dims, names).collect()
    assert {tuple(r[d] for d in dims): tuple(r[n] for n in names) for r in got} == brute_force(
        silver.collect(), dims
    )


def test_order_only_measures_match_brute_force(silver):
    dims = ["stat_date", "channel"]
    got = rollup_measures(silver, dims, ["gmv", "valid_order_cnt"]).collect()
    expected = {k: (v[0], v[3]) for k, v in brute_force(silver.collect(), dims).items()}
    assert {tuple(r[d] for d in dims): (r["gmv"], r["valid_order_cnt"]) for r in got} == expected


def test_first_exchange_is_not_keyed_by_the_group_alone(silver):
    """The hot day or channel must spread by order and user before it is counted."""
    for build, keys in ((gold.daily_trend, ["order_id", "user_id"]), (gold.paytype_stat, ["order_id"])):
        plan = build(silver)._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        # Plans read from the result down: the aggregate's last exchange, then its first; what
        # follows belongs to the cached input.
        last, first = exchanges[:2]
        assert not any(key in last for key in keys)
        assert all(key in first for key in keys)
        below = plan[plan.index(first) : plan.index("InMemoryTableScan")]
        assert "partial_sum" in below


def test_copies_fold_before_the_exchange(spark):
    frame = orders_frame(spark, [order_line()] * 3)
    plan = cleanse.deduplicate(frame)._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "partial_count" in plan[exchange:]


def test_rules_run_after_the_fold(spark):
    """A filter on the rules must not be copied below the de-duplication."""
    frame = spark.range(10).select(*[F.col("id").cast("string").alias(c) for c in S.ORDER_FIELDS])
    kept = cleanse.stage(frame).where("rule_code IS NULL")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "gettimestamp" not in plan[plan.index("Aggregate") :].split("\n", 1)[1]


def test_hot_product_is_split_in_a_large_join(spark):
    """With a dimension too large to broadcast, the partition of a hot product is split."""
    n = 60_000
    hot_or_own = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    facts = spark.range(0, n, 1, 8).select(
        hot_or_own.alias("product_id"), F.sha2(F.col("id").cast("string"), 512).alias("filler")
    )
    dimension = (
        spark.range(0, n, 1, 8)
        .select(F.col("id").cast("string").alias("dim_product_id"))
        .unionByName(spark.range(1).select(F.lit("hot").alias("dim_product_id")))
    )
    with conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
    ):
        joined = cleanse.attach_products(facts, dimension)
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert len(rows) == n and all(r["product_id"] == r["dim_product_id"] for r in rows)


def test_main_payment_of_a_hot_order(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        order = "hot" if i % 3 == 0 else str(rng.randrange(30))
        value = rng.choice([None, "x", f"{rng.randrange(1, 60)}.00"])
        rows.append((order, str(rng.randrange(1, 20)), rng.choice("abc"), "1", value))
    best: dict[str, tuple] = {}
    for order, seq, kind, _, value in rows:
        amount = float("-inf") if value in (None, "x") else float(value)
        key = (-amount, int(seq), kind)
        best[order] = min(best.get(order, key), key)
    payments = spark.createDataFrame(rows, S.MARKET_RAW["payments"])
    got = marketplace.main_payment(payments)
    # One candidate per order survives each task, before and after the exchange.
    assert got._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert {r["order_id"]: r["payment_type"] for r in got.collect()} == {k: v[2] for k, v in best.items()}


def test_hot_day_is_written_by_several_tasks(spark, folder):
    """Two thirds of the rows on one day: its directory gets several files. Quiet days get one,
    unless they hash to the same partition."""
    day = F.when(F.col("id") % 3 > 0, F.lit("2025-09-01")).otherwise(
        F.concat(F.lit("2025-10-0"), F.col("id") % 9 + 1)
    )
    values = {"stat_date": day.cast("date"), "order_id": F.sha2(F.col("id").cast("string"), 512)}
    rows = spark.range(0, 30_000, 1, 8).select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.SILVER.fields]
    )
    warehouse = Warehouse(spark, folder)
    with conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="500KB"):
        warehouse.overwrite("dwd_order_detail", rows)
    days = Path(warehouse.path("dwd_order_detail")).glob("version=*/stat_date=*")
    files = {day.name: len(list(day.glob("part-*"))) for day in days}
    assert files.pop("stat_date=2025-09-01") > 1
    assert 1 in files.values()
    assert warehouse.rows("dwd_order_detail") == 30_000
