"""Cross-checks: gold against silver, one build against another, and level against level."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake import schemas as S
from merchlake.functions.measures import rollup_measures

MONEY = "decimal(24,2)"


# Stores a frame under a label and reads it back, or leaves it as it is. With one that stores, every
# result is had on its own, instead of all of them in one plan whose shuffles lie on disk together.
Keep = Callable[[DataFrame, str], DataFrame]


def as_it_is(df: DataFrame, label: str) -> DataFrame:
    return df


def facts(one_row: DataFrame, **columns: Column) -> DataFrame:
    """A one-row aggregate as (metric, value) rows, so that facts of several frames can be
    stacked and compared without a join."""
    aggregated = one_row.select(*[c.cast(MONEY).alias(n) for n, c in columns.items()])
    rows = [F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in columns]
    return aggregated.select(F.inline(F.array(*rows)))


def stack(*frames: DataFrame) -> DataFrame:
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked


def spread(stacked: DataFrame, metrics: list[str]) -> DataFrame:
    """Stacked facts as one row with a column per metric; absent facts count as 0."""
    zero = F.lit(0).cast(MONEY)
    return stacked.agg(
        *[
            F.coalesce(F.max(F.when(F.col("metric") == m, F.col("value"))), zero).alias(m)
            for m in metrics
        ]
    )


def check_rows(
    one_row: DataFrame,
    checks: list[tuple[str, str, str, str, str]],
    names: tuple[str, str, str] = ("check_name", "actual", "expected"),
) -> DataFrame:
    """Checks as rows. Each is (name, actual metric, expected metric, tolerance, unit)."""
    rows = []
    for place, (name, actual, expected, tolerance, unit) in enumerate(checks, start=1):
        diff = F.abs(F.col(actual) - F.col(expected))
        rows.append(
            F.struct(
                F.lit(place).alias("check_no"),
                F.lit(name).alias(names[0]),
                F.col(actual).alias(names[1]),
                F.col(expected).alias(names[2]),
                diff.alias("diff"),
                F.lit(unit).alias("unit"),
                (diff <= F.lit(tolerance).cast(MONEY)).alias("passed"),
            )
        )
    return one_row.select(F.inline(F.array(*rows)))


# --- gold against silver --------------------------------------------------------------------


def silver_sums(silver: DataFrame) -> DataFrame:
    return rollup_measures(silver, [], ["gmv", "sales_qty", "valid_order_cnt", "order_cnt"])


def trend_sums(trend: DataFrame) -> DataFrame:
    return trend.agg(
        F.sum("gmv").alias("gmv"),
        F.sum("sales_qty").alias("sales_qty"),
        F.sum("valid_order_cnt").alias("valid_order_cnt"),
    )


def consistency(
    silver: DataFrame, trend: DataFrame, category: DataFrame, currency: str = S.DEFAULT_CURRENCY
) -> DataFrame:
    """Four checks of stored sums against the detail: a cent for money, nothing for counts.

    Daily valid orders add up to the distinct count only if no order spans days; that check
    informs rather than judges.
    """
    c = F.col
    stacked = stack(
        facts(
            silver_sums(silver),
            detail_gmv=c("gmv"),
            detail_qty=c("sales_qty"),
            detail_orders=c("valid_order_cnt"),
        ),
        facts(
            trend_sums(trend),
            trend_gmv=c("gmv"),
            trend_qty=c("sales_qty"),
            trend_orders=c("valid_order_cnt"),
        ),
        facts(category.agg(F.sum("gmv").alias("gmv")), category_gmv=c("gmv")),
    )
    metrics = ["detail_gmv", "detail_qty", "detail_orders"]
    metrics += ["trend_gmv", "trend_qty", "trend_orders", "category_gmv"]
    # The names of the checks, here and in ``reconcile_levels``.
    checks = [
        ("GMV 合计", "trend_gmv", "detail_gmv", "0.01", currency),
        ("销售件数合计", "trend_qty", "detail_qty", "0", "件"),
        ("有效订单量合计", "trend_orders", "detail_orders", "0", "单"),
        ("类目 GMV 合计", "category_gmv", "detail_gmv", "0.01", currency),
    ]
    return check_rows(spread(stacked, metrics), checks, ("item", "ads_value", "detail_value"))


def row_counts(tables: dict[str, DataFrame], metric: str, keep: Keep = as_it_is) -> DataFrame:
    """Rows of several tables added up to one fact."""
    n = F.count(F.lit(1)).alias("n")
    counts = stack(*[keep(df.agg(n), "count") for df in tables.values()])
    return facts(counts.agg(F.sum("n").alias("n")), **{metric: F.col("n")})


# --- build against build --------------------------------------------------------------------

SNAPSHOT_METRICS = ["silver_rows", "reject_rows", "trend_gmv", "trend_valid_orders"]


def build_snapshot(silver: DataFrame, rejected: DataFrame, trend: DataFrame, prefix: str = "") -> DataFrame:
    """Four totals of one build as facts."""
    n = F.count(F.lit(1)).alias("n")
    c = F.col
    return stack(
        facts(silver.agg(n), **{f"{prefix}silver_rows": c("n")}),
        facts(rejected.agg(n), **{f"{prefix}reject_rows": c("n")}),
        facts(
            trend_sums(trend),
            **{f"{prefix}trend_gmv": c("gmv"), f"{prefix}trend_valid_orders": c("valid_order_cnt")},
        ),
    )


def compare_builds(first: DataFrame, second: DataFrame) -> DataFrame:
    """Verdict over the totals of two builds, snapshots prefixed ``a_`` and ``b_``: one row with
    both sides of each total, the totals that differ, and PASS or FAIL."""
    sides = [f"{side}{m}" for side in ("a_", "b_") for m in SNAPSHOT_METRICS]
    differing = F.array_compact(
        F.array(
            *[
                F.when(F.col(f"a_{m}") != F.col(f"b_{m}"), F.lit(m)).otherwise(F.lit(None).cast("string"))
                for m in SNAPSHOT_METRICS
            ]
        )
    )
    both = spread(stack(first, second), sides).withColumn("differences", F.concat_ws(",", differing))
    return both.withColumn(
        "verdict", F.when(F.col("differences") == "", F.lit("PASS")).otherwise(F.lit("FAIL"))
    )


def differing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of two frames that do not pair up, with how many more times they occur in ``a``.

    Both sides are folded into one aggregate over all columns: NULLs pair up, no join is needed,
    and a row repeated any number of times folds on the map side.
    """
    columns = a.columns
    tagged = a.withColumn("side", F.lit(1)).unionByName(b.select(*columns).withColumn("side", F.lit(-1)))
    return (
        tagged.groupBy(*columns)
        .agg(F.sum("side").alias("surplus"))
        .where(F.col("surplus") != 0)
    )


# Parts of a table without days that are told apart by their digests.
DIGEST_BUCKETS = 256


def digests(a: DataFrame, b: DataFrame, part: Column) -> DataFrame:
    """Per part of two frames (``part``): rows of each side, and whether the sums of two independent
    row hashes agree. Neither depends on the order of rows; one row per part and task is exchanged."""
    # Nulls do not enter a hash by themselves.
    columns = [F.col(c) for c in a.columns]
    cells = [*columns, *[c.isNull() for c in columns]]
    hashes = [F.xxhash64(*cells), F.xxhash64(F.lit(1), *reversed(cells))]

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(part.alias("part"), F.lit(sign).alias("side"), *[h.alias(f"h{i}") for i, h in enumerate(hashes)])

    def balance(name: str) -> Column:
        return F.sum(F.col(name).cast("decimal(20,0)") * F.col("side"))

    both = side(a, 1).unionByName(side(b.select(*a.columns), -1))
    return both.groupBy("part").agg(
        F.count_if(F.col("side") == 1).alias("a_rows"),
        F.count_if(F.col("side") == -1).alias("b_rows"),
        ((balance("h0") == 0) & (balance("h1") == 0) & (F.sum("side") == 0)).alias("agree"),
    )


def compare_tables(
    first: dict[str, DataFrame], second: dict[str, DataFrame], ignore: set[str], keep: Keep = as_it_is
) -> DataFrame:
    """Per table: rows on both sides and how many do not pair up, over all columns but ``ignore``.

    Sides are compared by digests first, per day where a table has days; only rows of parts that
    differ are then compared with each other, so rows that agree never meet in an exchange. With a
    ``keep`` that stores the digests, the planner knows how few parts differ before it joins them.
    """
    reports = []
    for name, a in first.items():
        columns = [c for c in a.columns if c not in ignore]
        left, right = a.select(*columns), second[name].select(*columns)
        cells = [F.col(c) for c in columns]
        part = F.pmod(F.xxhash64(*cells), F.lit(DIGEST_BUCKETS))
        if "stat_date" in columns:
            part = F.datediff("stat_date", F.lit("1970-01-01")).cast("bigint")
        part = F.coalesce(part, F.lit(-(1 << 62)))
        sums = keep(digests(left, right, part), "digests")
        differing = sums.where(~F.col("agree")).select("part")
        unpaired = differing_rows(
            left.withColumn("part", part).join(differing, "part", "left_semi").drop("part"),
            right.withColumn("part", part).join(differing, "part", "left_semi").drop("part"),
        )
        counted = sums.agg(
            F.coalesce(F.sum("a_rows"), F.lit(0)).alias("a_rows"), F.coalesce(F.sum("b_rows"), F.lit(0)).alias("b_rows")
        )
        missing = unpaired.agg(F.coalesce(F.sum(F.abs("surplus")), F.lit(0)).alias("unpaired_rows"))
        both = counted.unionByName(missing, allowMissingColumns=True)
        reports.append(
            both.agg(*[F.max(c).alias(c) for c in both.columns]).select(
                F.lit(name).alias("table_name"), "a_rows", "b_rows", "unpaired_rows"
            )
        )
    return stack(*reports).withColumn("passed", F.col("unpaired_rows") == 0)


# --- level against level --------------------------------------------------------------------

LEVEL_METRICS = [
    "raw_item_rows",
    "raw_order_rows",
    "raw_item_orders",
    "raw_item_groups",
    "raw_price",
    "raw_freight",
    "raw_payment",
    "converted_rows",
    "converted_pay",
    "silver_rows",
    "silver_pay",
    "silver_gmv",
    "silver_orders",
    "silver_valid_orders",
    "reject_rows",
    "trend_gmv",
    "trend_orders",
    "category_gmv",
    "overview_gmv",
    "overview_orders",
    "overview_valid_orders",
]


def raw_facts(market: dict[str, DataFrame]) -> DataFrame:
    """Rows and money of the source as published. Payments include freight and stand apart."""
    c = F.col
    n = F.count(F.lit(1))
    amount = c("price").try_cast("decimal(20,4)")
    freight = c("freight_value").try_cast("decimal(20,4)")
    # Folding to (order, product) and then to order counts both without an exact distinct.
    pairs = market["items"].groupBy("order_id", "product_id").agg(
        n.alias("rows"), F.sum(amount).alias("price"), F.sum(freight).alias("freight")
    )
    per_order = pairs.groupBy("order_id").agg(
        n.alias("pairs"),
        F.sum("rows").alias("rows"),
        F.sum("price").alias("price"),
        F.sum("freight").alias("freight"),
    )
    items = per_order.agg(
        F.sum("rows").alias("rows"),
        F.count("order_id").alias("orders"),
        F.sum("pairs").alias("pairs"),
        F.sum("price").alias("price"),
        F.sum("freight").alias("freight"),
    )
    orders = market["orders"].agg(n.alias("rows"))
    paid = market["payments"].agg(F.sum(c("payment_value").try_cast("decimal(20,4)")).alias("paid"))
    return stack(
        facts(
            items,
            raw_item_rows=c("rows"),
            raw_item_orders=c("orders"),
            raw_item_groups=c("pairs"),
            raw_price=c("price"),
            raw_freight=c("freight"),
        ),
        facts(orders, raw_order_rows=c("rows")),
        facts(paid, raw_payment=c("paid")),
    )


def level_facts(
    market: dict[str, DataFrame],
    converted: DataFrame,
    silver: DataFrame,
    rejected: DataFrame,
    trend: DataFrame,
    category: DataFrame,
    overview: DataFrame,
    keep: Keep = as_it_is,
) -> DataFrame:
    """Rows, money and order counts of every level as facts. Those of the source are not kept."""
    c = F.col
    n = F.count(F.lit(1)).alias("n")

    def kpi(code: str) -> Column:
        return F.max(F.when(c("kpi_code") == code, c("kpi_value"))).alias(code)

    levels = [
        facts(
            converted.agg(n, F.sum(c("pay_amount").try_cast(S.PAY)).alias("pay")),
            converted_rows=c("n"),
            converted_pay=c("pay"),
        ),
        facts(silver.agg(n, F.sum("pay_amount").alias("pay")), silver_rows=c("n"), silver_pay=c("pay")),
        facts(
            silver_sums(silver),
            silver_gmv=c("gmv"),
            silver_orders=c("order_cnt"),
            silver_valid_orders=c("valid_order_cnt"),
        ),
        facts(rejected.agg(n), reject_rows=c("n")),
        facts(
            trend.agg(F.sum("gmv").alias("gmv"), F.sum("order_cnt").alias("orders")),
            trend_gmv=c("gmv"),
            trend_orders=c("orders"),
        ),
        facts(category.agg(F.sum("gmv").alias("gmv")), category_gmv=c("gmv")),
        facts(
            overview.agg(kpi("GMV"), kpi("ORDER_CNT"), kpi("VALID_ORDER_CNT")),
            overview_gmv=c("GMV"),
            overview_orders=c("ORDER_CNT"),
            overview_valid_orders=c("VALID_ORDER_CNT"),
        ),
    ]
    return stack(raw_facts(market), *[keep(level, "facts") for level in levels])


def reconcile_levels(stacked: DataFrame, unit: str = "BRL") -> DataFrame:
    """Nine checks from the source through conversion and detail to the stored metrics."""
    checks = [
        ("原始 items 行数 → 分组数", "raw_item_groups", "converted_rows", "0", "行"),
        ("原始 Σprice → 转换 Σpay_amount", "converted_pay", "raw_price", "0.01", unit),
        ("转换 CSV 行数 → DWD 行数", "silver_rows", "converted_rows", "0", "行"),
        ("转换 Σpay_amount → DWD Σpay_amount", "silver_pay", "converted_pay", "0.01", unit),
        ("DWD 有效 Σpay_amount → ADS 趋势 Σgmv", "trend_gmv", "silver_gmv", "0.01", unit),
        ("DWD 有效 Σpay_amount → ADS 类目 Σgmv", "category_gmv", "silver_gmv", "0.01", unit),
        ("ADS 类目 Σgmv → ads_overview GMV", "overview_gmv", "category_gmv", "0.01", unit),
        ("DWD 唯一订单数 → ads_overview 下单量", "overview_orders", "silver_orders", "0", "单"),
        (
            "DWD 有效唯一订单 → ads_overview 有效订单量",
            "overview_valid_orders",
            "silver_valid_orders",
            "0",
            "单",
        ),
    ]
    return check_rows(spread(stacked, LEVEL_METRICS), checks)


def metric_sheet(measures: DataFrame) -> DataFrame:
    """Numerator, denominator and value of each metric, from ``gold.overview_measures``."""
    c = F.col
    one = F.lit(None).cast(MONEY)
    sheet = [
        ("GMV", c("gmv"), one),
        ("ORDER_CNT", c("order_cnt"), one),
        ("VALID_ORDER_CNT", c("valid_order_cnt"), one),
        ("SALES_QTY", c("sales_qty"), one),
        ("BUYER_CNT", c("buyer_cnt"), one),
        ("AVG_ORDER_AMOUNT", c("gmv"), c("valid_order_cnt")),
        ("AVG_ITEM_PRICE", c("gmv"), c("sales_qty")),
        ("REFUND_RATE", c("refund_order_cnt"), c("order_cnt")),
        ("DISCOUNT_RATE", c("discount_amount"), c("gross_amount")),
    ]
    rows = []
    for name, top, bottom in sheet:
        numerator, denominator = top.cast(MONEY), bottom.cast(MONEY)
        value = F.when(denominator.isNull(), numerator.cast("decimal(28,6)")).when(
            denominator != 0, F.round(numerator / denominator, 6).cast("decimal(28,6)")
        )
        rows.append(
            F.struct(
                F.lit(name).alias("metric"),
                numerator.alias("numerator"),
                denominator.alias("denominator"),
                F.coalesce(value, F.lit(0).cast("decimal(28,6)")).alias("measured"),
            )
        )
    return measures.select(F.inline(F.array(*rows)))
