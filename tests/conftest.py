"""Shared session and small frames."""

from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from merchlake import schemas as S  # noqa: E402
from merchlake.session import build_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = build_session(
        "merchlake-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture()
def folder() -> str:
    return tempfile.mkdtemp(prefix="merchlake-test-")


def order_line(**fields: str | None) -> tuple:
    """A clean order line with some fields replaced."""
    line = {
        "order_id": "S1",
        "order_time": "2025-09-01 10:00:00",
        "user_id": "V1",
        "product_id": "T1",
        "channel": "线下门店",
        "province": "浙江",
        "city": "宁波",
        "quantity": "1",
        "unit_price": "100.00",
        "discount_amount": "0.00",
        "pay_amount": "100.00",
        "order_status": "已完成",
        "pay_type": "现金",
    }
    line.update(fields)
    return tuple(line[name] for name in S.ORDER_FIELDS)


def orders_frame(spark: SparkSession, lines: list[tuple]) -> DataFrame:
    return spark.createDataFrame(lines, S.ORDER_RAW)


def products_frame(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    rows = rows or [
        ("T1", "茶壶", "K10", "壶类", "青瓷", "48.50", "2024-05-20"),
        ("T2", "茶杯", "K20", "杯类", "白瓷", "12.80", "2024-05-20"),
    ]
    return spark.createDataFrame(rows, S.PRODUCT_RAW)
