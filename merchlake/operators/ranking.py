"""Rank numbers, shares of a total and pages, without sorting an open-ended result in one task.

Everything here is a lazy plan, and nothing runs before the answer is asked for, except that a page
of the detail looks up where it begins and ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlake.functions.measures import ratio
from merchlake.session import ensure_checkpoint_dir


def number_rows(df: DataFrame, bucket: Column, order: list[Column], name: str) -> DataFrame:
    """Add consecutive numbers from 1 in the given order, whatever the size of ``df``.

    ``bucket`` must never fall along the order. Rows are counted per bucket, and a row's number is
    its place in its bucket plus the sizes of the buckets before; only these sizes, one row per
    bucket, meet in one task. Both uses of ``df`` share its last exchange.
    """
    placed = df.withColumn("_bucket", bucket)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(F.col("_bucket").alias("_key"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    return (
        placed.withColumn("_place", inside)
        .join(offsets, F.col("_bucket").eqNullSafe(F.col("_key")))
        .withColumn(name, F.col("_before") + F.col("_place"))
        .drop("_bucket", "_key", "_before", "_place")
    )


def falling_money(money: Column) -> Column:
    """A bucket for ``number_rows`` over falling money: some sixteen buckets per doubling."""
    size = F.greatest(money.cast("double"), F.lit(1.0))
    return -F.floor(F.log2(size) * 16)


def top_ranked(df: DataFrame, order: list[Column], limit: int, name: str = "rank_no") -> DataFrame:
    """The first ``limit`` rows with rank numbers. The window runs over at most ``limit`` rows."""
    first = df.orderBy(*order).limit(limit)
    return first.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def with_total(groups: DataFrame, key: str) -> DataFrame:
    """The groups plus one row holding their total money, marked by ``is_total``.

    The total is taken before any cut, so a share does not depend on how many rows are shown.
    """
    return groups.rollup(key).agg(
        F.grouping(key).cast("int").alias("is_total"),
        F.sum("gmv").alias("gmv"),
        *[F.sum(c).alias(c) for c in groups.columns if c not in (key, "gmv")],
    )


def ranked_shares(groups: DataFrame, key: str, limit: int | None) -> DataFrame:
    """Rank by money (ties by key) and share of the grand total in percent, 2 digits.

    ``limit`` None ranks every group.
    """
    order = [F.desc("gmv"), F.asc_nulls_last(key)]
    if limit is None:
        numbered = number_rows(groups, falling_money(F.col("gmv")), order, "rank_no")
        total = groups.agg(F.sum("gmv")).scalar()
    else:
        marked = with_total(groups, key)
        ranked = top_ranked(marked, [F.desc("is_total"), *order], limit + 1, "_no")
        # At most limit + 1 rows, the total first.
        total = F.max(F.when(F.col("is_total") == 1, F.col("gmv"))).over(Window.partitionBy())
        numbered = ranked.withColumn("_total", total).where("is_total = 0").withColumn("rank_no", F.col("_no") - 1)
        total = F.col("_total")
    money = F.col("gmv").cast("decimal(20,2)")
    return numbered.select(
        F.col("rank_no").cast("int").alias("rank_no"),
        key,
        money.alias("gmv"),
        *[c for c in groups.columns if c not in (key, "gmv")],
        ratio(money * 100, F.coalesce(F.round(total, 2), F.lit(0)), 2)
        .cast("decimal(10,2)")
        .alias("ratio"),
    )


# Rows of one moment that one task still numbers.
FEW_ROWS = 100_000


def newest_rows(
    df: DataFrame,
    day: str,
    time: str,
    ties: list[Column],
    start: int,
    size: int | None,
    moments: DataFrame | None = None,
) -> DataFrame:
    """``size`` rows after the first ``start`` in falling order of ``time``, then by ``ties``; every
    row after them without a size. ``day`` is the day of ``time``; the answer is in order.

    Where the page begins and ends is looked up when the plan is made: rows per day, a row per
    calendar day, then rows per moment of the days of its first and last row. Both come from
    ``moments`` (``day``, ``time``, ``_rows``) where a table of them is stored, else from ``df``. The
    answer is then a plan with constant bounds, which open the days and the row groups of the page
    only and are sorted over all tasks. Of the first and the last moment, rows that belong to other
    pages are cut off by their number among the ties.
    """
    order = [F.desc(time), *ties]
    if start == 0 and size is None:
        return df.orderBy(*order)
    counted = df.groupBy(day).agg(F.count(F.lit(1)).alias("_rows")) if moments is None else (
        moments.groupBy(day).agg(F.sum("_rows").alias("_rows"))
    )
    days, before = [], 0
    for held_day, rows in sorted(((r[day], r["_rows"]) for r in counted.collect() if r[day] is not None), reverse=True):
        if before + rows > start and (size is None or before < start + size):
            days.append((held_day, before))
        before += rows
    if not days:
        return df.where(F.lit(False))
    end = before if size is None else min(before, start + size)
    (first_day, newer), (last_day, newer_last) = days[0], days[-1]
    on_edge = (F.col(day) == F.lit(first_day)) | (F.col(day) == F.lit(last_day))
    if moments is None:
        each = df.where(on_edge).groupBy(day, time).agg(F.count(F.lit(1)).alias("_rows"))
    else:
        each = moments.where(on_edge)
    # The moments of two days at most, a row per second.
    later = Window.partitionBy(day).orderBy(F.desc(time)).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.when(F.col(day) == F.lit(first_day), F.lit(newer)).otherwise(F.lit(newer_last))
    placed = each.withColumn("_before", ahead + F.coalesce(F.sum("_rows").over(later), F.lit(0)))
    held = placed.where((F.col("_before") + F.col("_rows") > start) & (F.col("_before") < end))
    edge = F.struct(time, "_before", "_rows")
    bounds = held.agg(F.max(edge).alias("first"), F.min(edge).alias("last")).first()
    first, last = bounds["first"], bounds["last"]

    inside = (F.col(day) <= F.lit(first_day)) & (F.col(day) >= F.lit(last_day))
    page = df.where(inside & (F.col(time) <= F.lit(first[time])) & (F.col(time) >= F.lit(last[time])))
    # Moments that the page holds in part.
    parts = {m[time]: m for m in (first, last) if m["_before"] < start or m["_before"] + m["_rows"] > end}
    if not parts:
        return page.orderBy(*order)
    whole = page.where(~F.col(time).isin([F.lit(t) for t in parts]))
    for moment, m in parts.items():
        rows = page.where(F.col(time) == F.lit(moment))
        whole = whole.unionByName(_slice(rows, ties, start - m["_before"], end - m["_before"], m["_rows"]))
    return whole.orderBy(*order)


def _slice(rows: DataFrame, order: list[Column], start: int, end: int, count: int) -> DataFrame:
    """The rows from place ``start`` up to ``end`` in the given order, of ``count`` rows."""
    if count <= FEW_ROWS:
        nth = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
        return rows.withColumn("_nth", nth).where((F.col("_nth") > start) & (F.col("_nth") <= end)).drop("_nth")
    # Sorted over all tasks, in parts that follow the order; a row's place is its number in its part
    # plus the sizes of the parts before.
    ensure_checkpoint_dir(rows.sparkSession)
    numbered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = numbered.withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_id", 33)
    # A row per task.
    sizes = sorted(map(tuple, numbered.groupBy(part.alias("p")).agg(F.count(F.lit(1))).collect()))
    kept, before = F.lit(False), 0
    for number, many in sizes:
        low, high = max(start - before, 0), min(end - before, many)
        if low < high:
            place = F.col("_id") - F.lit(number << 33)
            kept = kept | ((part == number) & (place >= low) & (place < high))
        before += many
    return numbered.where(kept).drop("_id")
