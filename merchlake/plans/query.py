"""The dashboard's query object and its predicates."""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(value: str | None) -> str | None:
    stripped = (value or "").strip()
    return stripped or None


def _positive(value: int | None, default: int | None) -> int | None:
    return default if value is None or value <= 0 else value


@dataclasses.dataclass
class AnalysisQuery:
    """Optional filters, all of which must hold, plus paging.

    Blank text means no filter, reversed dates are swapped, sizes that are not positive fall back
    to the default. Sizes have no upper limit; an export without ``export_limit`` holds every row.
    """

    start_date: str | None = None
    end_date: str | None = None
    channel: str | None = None
    category_name: str | None = None
    province: str | None = None
    pay_type: str | None = None
    order_status: str | None = None
    only_valid: int | None = 1
    limit: int | None = 10
    page_num: int | None = 1
    page_size: int | None = 20
    export_limit: int | None = None

    def __post_init__(self) -> None:
        for name in (
            "start_date",
            "end_date",
            "channel",
            "category_name",
            "province",
            "pay_type",
            "order_status",
        ):
            setattr(self, name, _text(getattr(self, name)))
        if self.start_date and self.end_date and self.start_date > self.end_date:
            self.start_date, self.end_date = self.end_date, self.start_date
        self.limit = _positive(self.limit, 10)
        self.page_size = _positive(self.page_size, 20)
        self.export_limit = _positive(self.export_limit, None)
        self.page_num = max(self.page_num or 1, 1)

    @property
    def has_dates(self) -> bool:
        return bool(self.start_date or self.end_date)

    @property
    def has_dimensions(self) -> bool:
        return bool(self.channel or self.category_name or self.province or self.pay_type)

    @property
    def valid_only(self) -> bool:
        return self.only_valid == 1


def _all_of(predicates: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates, F.lit(True))


def date_filter(query: AnalysisQuery) -> Column:
    """The date range alone; on tables laid out by day it prunes partitions."""
    day = F.col("stat_date")
    predicates = []
    if query.start_date:
        predicates.append(day >= F.lit(query.start_date).cast("date"))
    if query.end_date:
        predicates.append(day <= F.lit(query.end_date).cast("date"))
    return _all_of(predicates)


def row_filter(query: AnalysisQuery) -> Column:
    """Dates and dimensions, whatever the order's status. For order counts, which keep
    cancelled and refunded orders."""
    wanted = {
        "channel": query.channel,
        "category_name": query.category_name,
        "province": query.province,
        "pay_type": query.pay_type,
    }
    equal = [F.col(name) == value for name, value in wanted.items() if value]
    return _all_of([date_filter(query), *equal])


def counted_filter(query: AnalysisQuery) -> Column:
    """``row_filter``, and valid orders only where the query asks for them (the default)."""
    valid = F.col("is_valid_order") == 1 if query.valid_only else F.lit(True)
    return row_filter(query) & valid


def detail_filter(query: AnalysisQuery) -> Column:
    """``counted_filter`` plus an order status."""
    status = F.col("order_status") == query.order_status if query.order_status else F.lit(True)
    return counted_filter(query) & status


def filtered(silver: DataFrame, query: AnalysisQuery) -> DataFrame:
    return silver.where(counted_filter(query))
