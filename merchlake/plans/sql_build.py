"""The same silver, rejects, gold, rule counters and quality row as one Spark SQL statement each.

A second, separately written build of the same results that uses nothing of the first one's;
``reconcile.compare_tables`` sets the two against each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from merchlake import schemas as S

_FIELDS = ", ".join(S.ORDER_FIELDS)
_LEGAL = ", ".join(f"'{s}'" for s in S.LEGAL_STATUSES)
_VALID = ", ".join(f"'{s}'" for s in S.VALID_STATUSES)

# Nested selects rather than WITH: a frame built on a WITH clause carries its definition's id,
# and a plan using such a frame several times mixes the copies up.
STAGED = f"""
SELECT *,
       CASE WHEN ts IS NULL THEN 'R03'
            WHEN qty IS NULL OR qty NOT BETWEEN 1 AND {S.MAX_QUANTITY} THEN 'R04'
            WHEN price IS NULL OR price <= 0 THEN 'R05' END AS rule_code
FROM (
    SELECT *,
           coalesce(try_to_timestamp(order_time, 'yyyy-MM-dd HH:mm:ss'),
                    try_to_timestamp(order_time, 'yyyy/MM/dd HH:mm'),
                    try_to_timestamp(order_time, "yyyy-MM-dd'T'HH:mm:ss")) AS ts,
           try_cast(quantity AS int) AS qty,
           try_cast(unit_price AS decimal(12,2)) AS price,
           coalesce(try_cast(discount_amount AS decimal(12,2)), 0) AS discount
    FROM (SELECT {_FIELDS}, count(*) AS copies FROM {{orders}} GROUP BY {_FIELDS})
)
"""

REJECTS = f"""
SELECT :batch_id AS batch_id, rule_code,
       CASE rule_code WHEN 'R03' THEN '{S.RULE_TEXT["R03"]}'
                      WHEN 'R04' THEN '{S.RULE_TEXT["R04"]}'
                      ELSE '{S.RULE_TEXT["R05"]}' END AS rule_desc,
       order_id, product_id,
       concat_ws('|', order_id, order_time, quantity, unit_price, pay_amount) AS raw_record,
       current_timestamp() AS create_time
FROM {{staged}}
WHERE rule_code IS NOT NULL
"""

SILVER = f"""
SELECT order_id, ts AS order_time, to_date(ts) AS stat_date,
       date_format(ts, 'yyyy-MM') AS stat_month,
       concat(year(ts), '-W', lpad(weekofyear(ts), 2, '0')) AS stat_week,
       user_id, product_id,
       coalesce(pname, '{S.UNKNOWN_PRODUCT}') AS product_name,
       coalesce(cid, '{S.UNKNOWN_CATEGORY_ID}') AS category_id,
       coalesce(cname, '{S.UNKNOWN_CATEGORY}') AS category_name,
       coalesce(pbrand, '{S.UNKNOWN}') AS brand,
       channel,
       coalesce(nullif(trim(province), ''), '{S.UNKNOWN}') AS province,
       coalesce(nullif(trim(city), ''), '{S.UNKNOWN}') AS city,
       qty AS quantity, price AS unit_price, cast(discount AS decimal(12,2)) AS discount_amount,
       try_cast(round(qty * price - discount, 2) AS decimal(14,2)) AS pay_amount,
       CASE WHEN order_status IN ({_LEGAL}) THEN order_status ELSE '{S.STATUS_OTHER}' END AS order_status,
       coalesce(nullif(trim(pay_type), ''), '{S.UNKNOWN}') AS pay_type,
       CASE WHEN order_status IN ({_VALID}) THEN 1 ELSE 0 END AS is_valid_order,
       :batch_id AS batch_id, current_timestamp() AS create_time
FROM {{staged}} LEFT JOIN (
    SELECT *, row_number() OVER (PARTITION BY pid ORDER BY pname NULLS LAST, cid NULLS LAST,
                                 cname NULLS LAST, pbrand NULLS LAST) AS choice
    FROM (
        SELECT product_id AS pid, nullif(trim(product_name), '') AS pname,
               nullif(trim(category_id), '') AS cid, nullif(trim(category_name), '') AS cname,
               nullif(trim(brand), '') AS pbrand
        FROM {{products}}
    )
) ON product_id = pid AND choice = 1
WHERE rule_code IS NULL
"""

_EXPECTED = "try_cast(round(qty * price - discount, 2) AS decimal(14,2))"
COUNTERS = f"""
SELECT coalesce(sum(copies), 0) AS raw_cnt,
       count_if(coalesce(trim(province), '') = '' OR coalesce(trim(city), '') = ''
                OR coalesce(trim(pay_type), '') = '') AS null_field_cnt,
       coalesce(sum(copies - 1), 0) AS dup_record_cnt,
       count_if(ts IS NULL) AS invalid_time_cnt,
       count_if(qty IS NULL OR qty NOT BETWEEN 1 AND {S.MAX_QUANTITY} OR price IS NULL OR price <= 0
                OR paid IS NULL OR {_EXPECTED} IS NULL
                OR abs(paid - {_EXPECTED}) > {S.AMOUNT_TOLERANCE}) AS invalid_amount_cnt,
       count_if(order_status IS NULL OR order_status NOT IN ({_LEGAL})) AS invalid_status_cnt,
       count_if(rule_code IS NULL AND pid IS NULL) AS missing_dim_cnt,
       count_if(rule_code IS NULL) AS valid_cnt,
       count_if(rule_code IS NOT NULL) AS discard_cnt
FROM (SELECT *, try_cast(pay_amount AS decimal(14,2)) AS paid FROM {{staged}})
LEFT JOIN (SELECT DISTINCT product_id AS pid FROM {{products}}) ON product_id = pid
"""

SUMMED = f"SELECT {', '.join(f'coalesce(sum({c}), 0) AS {c}' for c in S.COUNTERS)} FROM {{counters}}"

QUALITY = """
SELECT :batch_id AS batch_id, current_date() AS run_date, raw_cnt, null_field_cnt, dup_record_cnt,
       invalid_time_cnt, invalid_amount_cnt, invalid_status_cnt, missing_dim_cnt, valid_cnt,
       raw_cnt - dup_record_cnt - valid_cnt AS discard_cnt,
       cast(CASE WHEN raw_cnt > 0
                 THEN round(cast(valid_cnt AS decimal(20,0)) / cast(raw_cnt AS decimal(20,0)), 4)
                 ELSE 0 END AS decimal(10,4)) AS quality_score,
       cast(:duration_ms AS bigint) AS duration_ms, current_timestamp() AS update_time
FROM {counters}
"""

_MONEY = "cast(sum(CASE WHEN is_valid_order = 1 THEN pay_amount ELSE 0 END) AS decimal(20,2)) AS gmv"
_PIECES = "sum(CASE WHEN is_valid_order = 1 THEN quantity ELSE 0 END) AS sales_qty"
_ORDERS = "count(DISTINCT CASE WHEN is_valid_order = 1 THEN order_id END) AS order_cnt"
_BUYERS = "count(DISTINCT CASE WHEN is_valid_order = 1 THEN user_id END) AS buyer_cnt"
_STAMP = "current_timestamp() AS update_time"


def _daily(keys: str, *measures: str) -> str:
    return f"SELECT {keys}, {', '.join(measures)}, {_STAMP} FROM {{silver}} GROUP BY {keys}"


GOLD = {
    "ads_daily_trend": f"""
        SELECT stat_date, order_cnt, valid_order_cnt, gmv, sales_qty, buyer_cnt,
               cast(coalesce(round(gmv / nullif(valid_order_cnt, 0), 2), 0) AS decimal(14,2))
                   AS avg_order_amount,
               refund_order_cnt,
               cast(coalesce(round(cast(refund_order_cnt AS decimal(20,0)) / nullif(order_cnt, 0), 4), 0)
                   AS decimal(10,4)) AS refund_rate,
               {_STAMP}
        FROM (
            SELECT stat_date, count(DISTINCT order_id) AS order_cnt,
                   count(DISTINCT CASE WHEN is_valid_order = 1 THEN order_id END) AS valid_order_cnt,
                   {_MONEY}, {_PIECES}, {_BUYERS},
                   count(DISTINCT CASE WHEN order_status = '{S.STATUS_REFUNDED}' THEN order_id END)
                       AS refund_order_cnt
            FROM {{silver}} GROUP BY stat_date
        )""",
    "ads_category_stat": _daily(
        "stat_date, category_id, category_name", _MONEY, _PIECES, _ORDERS, _BUYERS
    ),
    "ads_product_stat": _daily(
        "stat_date, product_id, product_name, category_name, brand", _MONEY, _PIECES, _ORDERS
    ),
    "ads_channel_stat": _daily("stat_date, channel", _MONEY, _ORDERS, _PIECES, _BUYERS),
    "ads_paytype_stat": _daily("stat_date, pay_type", _MONEY, _ORDERS),
    "ads_region_stat": _daily("stat_date, province", _MONEY, _ORDERS, _BUYERS),
    "ads_channel_category_stat": _daily(
        "stat_date, channel, category_name", _MONEY, _ORDERS
    ),
}


def _share(top: str, bottom: str, digits: int) -> str:
    quotient = f"round(cast({top} AS decimal(24,4)) / cast(nullif({bottom}, 0) AS decimal(24,4)), {digits})"
    return f"cast(coalesce({quotient}, 0) AS decimal(20,4))"


_KPI_VALUES = {
    "GMV": "money",
    "ORDER_CNT": "orders",
    "VALID_ORDER_CNT": "valid_orders",
    "SALES_QTY": "pieces",
    "BUYER_CNT": "buyers",
    "AVG_ORDER_AMOUNT": _share("money", "valid_orders", 2),
    "AVG_ITEM_PRICE": _share("money", "pieces", 2),
    "REFUND_RATE": _share("refunds * 100", "orders", 4),
    "DISCOUNT_RATE": _share("discounts * 100", "gross", 4),
}


def _overview() -> str:
    rows = ", ".join(
        f"named_struct('kpi_code', '{code}', 'kpi_name', '{name}', "
        f"'kpi_value', cast({_KPI_VALUES[code]} AS decimal(20,4)), "
        f"'kpi_unit', {f"'{unit}'" if unit else ':currency'}, 'kpi_desc', '{text}', 'stat_date', last_day)"
        for code, name, unit, text in S.KPIS
    )
    return f"""
SELECT kpi_code, kpi_name, kpi_value, kpi_unit, kpi_desc, stat_date, :batch_id AS batch_id, {_STAMP}
FROM (SELECT inline(array({rows})) FROM (
    SELECT coalesce(sum(CASE WHEN is_valid_order = 1 THEN pay_amount END), 0) AS money,
           count(DISTINCT order_id) AS orders,
           count(DISTINCT CASE WHEN is_valid_order = 1 THEN order_id END) AS valid_orders,
           coalesce(sum(CASE WHEN is_valid_order = 1 THEN quantity END), 0) AS pieces,
           count(DISTINCT CASE WHEN is_valid_order = 1 THEN user_id END) AS buyers,
           count(DISTINCT CASE WHEN order_status = '{S.STATUS_REFUNDED}' THEN order_id END) AS refunds,
           coalesce(sum(CASE WHEN is_valid_order = 1 THEN discount_amount END), 0) AS discounts,
           coalesce(sum(CASE WHEN is_valid_order = 1 THEN quantity * unit_price END), 0) AS gross,
           max(stat_date) AS last_day
    FROM {{silver}}))
"""


OVERVIEW = _overview()


def staged(spark: SparkSession, orders: DataFrame) -> DataFrame:
    return spark.sql(STAGED, orders=orders)


def rejects(spark: SparkSession, staged_rows: DataFrame, batch_id: str) -> DataFrame:
    return spark.sql(REJECTS, args={"batch_id": batch_id}, staged=staged_rows)


def silver(spark: SparkSession, staged_rows: DataFrame, products: DataFrame, batch_id: str) -> DataFrame:
    return spark.sql(
        SILVER, args={"batch_id": batch_id}, staged=staged_rows, products=products
    )


def daily_gold(spark: SparkSession, silver_rows: DataFrame) -> dict[str, DataFrame]:
    return {name: spark.sql(text, silver=silver_rows) for name, text in GOLD.items()}


def overview(spark: SparkSession, silver_rows: DataFrame, batch_id: str, currency: str) -> DataFrame:
    return spark.sql(OVERVIEW, args={"batch_id": batch_id, "currency": currency}, silver=silver_rows)


def counters(spark: SparkSession, staged_rows: DataFrame, products: DataFrame) -> DataFrame:
    return spark.sql(COUNTERS, staged=staged_rows, products=products)


def summed_counters(spark: SparkSession, counted: DataFrame) -> DataFrame:
    """``counters`` from those of several parts."""
    return spark.sql(SUMMED, counters=counted)


def clean_stat(spark: SparkSession, counted: DataFrame, batch_id: str, duration_ms: int = 0) -> DataFrame:
    return spark.sql(QUALITY, args={"batch_id": batch_id, "duration_ms": duration_ms}, counters=counted)
