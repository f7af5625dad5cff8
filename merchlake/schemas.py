"""Table layouts and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. They appear in the data, so they are kept literally.
# ---------------------------------------------------------------------------
STATUS_DONE = "已完成"
STATUS_PAID = "已支付"
STATUS_UNPAID = "待付款"
STATUS_CANCELLED = "已取消"
STATUS_REFUNDED = "已退款"
STATUS_UNFULFILLED = "无法履约"
STATUS_OTHER = "其他"
LEGAL_STATUSES = [
    STATUS_DONE,
    STATUS_PAID,
    STATUS_UNPAID,
    STATUS_CANCELLED,
    STATUS_REFUNDED,
    STATUS_UNFULFILLED,
]
VALID_STATUSES = [STATUS_DONE, STATUS_PAID]

MAX_QUANTITY = 999
AMOUNT_TOLERANCE = "0.01"

UNKNOWN = "未知"
UNKNOWN_CATEGORY = "未知类目"
UNKNOWN_CATEGORY_ID = "UNKNOWN"
UNKNOWN_PRODUCT = "未知商品"

TIME_FORMAT_DASH = "yyyy-MM-dd HH:mm:ss"
TIME_FORMAT_SLASH = "yyyy/MM/dd HH:mm"
TIME_FORMAT_T = "yyyy-MM-dd'T'HH:mm:ss"

DEFAULT_CURRENCY = "元"

RULE_TEXT = {
    "R03": "R03 下单时间无法解析，记录被丢弃",
    "R04": "R04 购买数量小于等于 0 或超过 999，记录被丢弃",
    "R05": "R05 商品单价小于等于 0，记录被丢弃",
}

# code, name, unit (None = the session's currency), description
KPIS = [
    ("GMV", "成交金额", None, "有效订单（已完成/已支付）的实付金额之和"),
    ("ORDER_CNT", "下单量", "单", "去重后的订单编号数量，含取消与退款订单"),
    ("VALID_ORDER_CNT", "有效订单量", "单", "订单状态为已完成或已支付的订单数量"),
    ("SALES_QTY", "销售件数", "件", "有效订单中的商品购买数量之和"),
    ("BUYER_CNT", "下单用户数", "人", "产生有效订单的去重用户数量"),
    ("AVG_ORDER_AMOUNT", "客单价", None, "GMV ÷ 有效订单量"),
    ("AVG_ITEM_PRICE", "件单价", None, "GMV ÷ 销售件数"),
    ("REFUND_RATE", "退款率", "%", "退款订单量 ÷ 下单量"),
    ("DISCOUNT_RATE", "折扣率", "%", "优惠金额 ÷ 原价金额"),
]
# ---------------------------------------------------------------------------


def all_strings(names: list[str]) -> T.StructType:
    """Raw layers keep every field as text, so that dirty values survive the scan."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column layouts of the raw, detail, metric and tracking tables.
ORDER_FIELDS = [
    "order_id",
    "order_time",
    "user_id",
    "product_id",
    "channel",
    "province",
    "city",
    "quantity",
    "unit_price",
    "discount_amount",
    "pay_amount",
    "order_status",
    "pay_type",
]
PRODUCT_FIELDS = [
    "product_id",
    "product_name",
    "category_id",
    "category_name",
    "brand",
    "cost_price",
    "launch_date",
]
ORDER_RAW = all_strings(ORDER_FIELDS)
PRODUCT_RAW = all_strings(PRODUCT_FIELDS)

PRICE = "decimal(12,2)"
PAY = "decimal(14,2)"
GMV = "decimal(20,2)"
KPI_VALUE = "decimal(20,4)"
RATE = "decimal(10,4)"

SILVER = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("order_time", T.TimestampType()),
        T.StructField("stat_date", T.DateType()),
        T.StructField("stat_month", T.StringType()),
        T.StructField("stat_week", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("category_name", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DecimalType(12, 2)),
        T.StructField("discount_amount", T.DecimalType(12, 2)),
        T.StructField("pay_amount", T.DecimalType(14, 2)),
        T.StructField("order_status", T.StringType()),
        T.StructField("pay_type", T.StringType()),
        T.StructField("is_valid_order", T.IntegerType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("create_time", T.TimestampType()),
    ]
)

REJECT_COLUMNS = [
    "batch_id",
    "rule_code",
    "rule_desc",
    "order_id",
    "product_id",
    "raw_record",
    "create_time",
]

# Gold tables: column order as published. Every one ends with update_time.
GOLD_COLUMNS = {
    "ads_overview": [
        "kpi_code",
        "kpi_name",
        "kpi_value",
        "kpi_unit",
        "kpi_desc",
        "stat_date",
        "batch_id",
        "update_time",
    ],
    "ads_daily_trend": [
        "stat_date",
        "order_cnt",
        "valid_order_cnt",
        "gmv",
        "sales_qty",
        "buyer_cnt",
        "avg_order_amount",
        "refund_order_cnt",
        "refund_rate",
        "update_time",
    ],
    "ads_category_stat": [
        "stat_date",
        "category_id",
        "category_name",
        "gmv",
        "sales_qty",
        "order_cnt",
        "buyer_cnt",
        "update_time",
    ],
    "ads_product_stat": [
        "stat_date",
        "product_id",
        "product_name",
        "category_name",
        "brand",
        "gmv",
        "sales_qty",
        "order_cnt",
        "update_time",
    ],
    "ads_channel_stat": [
        "stat_date",
        "channel",
        "gmv",
        "order_cnt",
        "sales_qty",
        "buyer_cnt",
        "update_time",
    ],
    "ads_paytype_stat": ["stat_date", "pay_type", "gmv", "order_cnt", "update_time"],
    "ads_region_stat": ["stat_date", "province", "gmv", "order_cnt", "buyer_cnt", "update_time"],
    "ads_channel_category_stat": [
        "stat_date",
        "channel",
        "category_name",
        "gmv",
        "order_cnt",
        "update_time",
    ],
}

CLEAN_STAT_COLUMNS = [
    "batch_id",
    "run_date",
    "raw_cnt",
    "null_field_cnt",
    "dup_record_cnt",
    "invalid_time_cnt",
    "invalid_amount_cnt",
    "invalid_status_cnt",
    "missing_dim_cnt",
    "valid_cnt",
    "discard_cnt",
    "quality_score",
    "duration_ms",
    "update_time",
]
JOB_LOG_COLUMNS = [
    "batch_id",
    "job_name",
    "compute_mode",
    "start_time",
    "end_time",
    "duration_ms",
    "input_rows",
    "output_rows",
    "job_status",
    "remark",
]

SNAPSHOT_COLUMNS = [
    "batch_id",
    "compute_mode",
    "start_time",
    "end_time",
    "duration_ms",
    "clean_ms",
    "raw_rows",
    "silver_rows",
    "reject_rows",
    "gold_rows",
    "trend_gmv",
    "trend_valid_orders",
]

# Types of the columns that are not text.
_COLUMN_TYPES = {
    "date": ("stat_date", "run_date"),
    "timestamp": ("create_time", "update_time", "start_time", "end_time"),
    KPI_VALUE: ("kpi_value",),
    GMV: ("gmv", "trend_gmv"),
    PAY: ("avg_order_amount",),
    RATE: ("refund_rate", "quality_score"),
    "bigint": (
        "order_cnt",
        "valid_order_cnt",
        "sales_qty",
        "buyer_cnt",
        "refund_order_cnt",
        "raw_cnt",
        "null_field_cnt",
        "dup_record_cnt",
        "invalid_time_cnt",
        "invalid_amount_cnt",
        "invalid_status_cnt",
        "missing_dim_cnt",
        "valid_cnt",
        "discard_cnt",
        "duration_ms",
        "clean_ms",
        "input_rows",
        "output_rows",
        "raw_rows",
        "silver_rows",
        "reject_rows",
        "gold_rows",
        "trend_valid_orders",
    ),
}
_TYPE_OF = {name: kind for kind, names in _COLUMN_TYPES.items() for name in names}


def _ddl(columns: list[str]) -> str:
    return ", ".join(f"{name} {_TYPE_OF.get(name, 'string')}" for name in columns)


# Distinct raw rows as the first build stages them, by the day of their time (null: unparsable).
STAGED = T.StructType(
    [
        *all_strings(ORDER_FIELDS).fields,
        T.StructField("copies", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("qty", T.IntegerType()),
        T.StructField("price", T.DecimalType(12, 2)),
        T.StructField("discount", T.DecimalType(12, 2)),
        T.StructField("paid", T.DecimalType(14, 2)),
        T.StructField("is_bad_status", T.BooleanType()),
        T.StructField("has_blank", T.BooleanType()),
        T.StructField("pay", T.DecimalType(14, 2)),
        T.StructField("is_bad_time", T.BooleanType()),
        T.StructField("is_bad_qty", T.BooleanType()),
        T.StructField("is_bad_price", T.BooleanType()),
        T.StructField("is_bad_amount", T.BooleanType()),
        T.StructField("rule_code", T.StringType()),
        T.StructField("stat_date", T.DateType()),
    ]
)

# Counters of the rules, per day in ``dws_clean_counter`` and added up in ``ads_clean_stat``.
COUNTERS = [
    "raw_cnt",
    "null_field_cnt",
    "dup_record_cnt",
    "invalid_time_cnt",
    "invalid_amount_cnt",
    "invalid_status_cnt",
    "missing_dim_cnt",
    "valid_cnt",
    "discard_cnt",
]

# Tables that questions over ranges of days and pages are answered from, all by day.
SERVING: dict[str, str] = {
    "dws_day_sum": (
        "stat_date date, row_cnt bigint, gmv decimal(24,2), sales_qty bigint, gross_amount decimal(33,2), "
        "discount_amount decimal(24,2)"
    ),
    "dws_order_key": "stat_date date, order_id string, is_valid boolean, is_refunded boolean",
    "dws_user_key": "stat_date date, user_id string",
    "dws_order_moment": "stat_date date, order_time timestamp, row_cnt bigint, valid_cnt bigint",
}

# Stored tables by name; declaring them keeps empty tables readable.
TABLES: dict[str, str | T.StructType] = {
    "ods_order_detail": all_strings([*ORDER_FIELDS, "batch_id"]),
    "ods_product": all_strings([*PRODUCT_FIELDS, "batch_id"]),
    "dwd_order_detail": SILVER,
    "dwd_staged": STAGED,
    "dwd_clean_reject": _ddl(REJECT_COLUMNS),
    **{name: _ddl(columns) for name, columns in GOLD_COLUMNS.items()},
    "ads_clean_stat": _ddl(CLEAN_STAT_COLUMNS),
    "dws_clean_counter": _ddl(["stat_date", *COUNTERS]),
    **SERVING,
    "etl_job_log": _ddl(JOB_LOG_COLUMNS),
    "etl_snapshot": _ddl(SNAPSHOT_COLUMNS),
}


def table_columns(name: str) -> list[str]:
    declared = TABLES[name]
    if isinstance(declared, str):
        return T.StructType.fromDDL(declared).fieldNames()
    return declared.fieldNames()


# Column layouts of the marketplace dump, six text tables.
MARKET_FIELDS = {
    "orders": [
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "items": [
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ],
    "customers": [
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ],
    "products": [
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ],
    "payments": [
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ],
    "categories": ["product_category_name", "product_category_name_english"],
}
MARKET_RAW = {name: all_strings(fields) for name, fields in MARKET_FIELDS.items()}
