"""DuckDB SQL that answers every catalog query from the same files, written independently.

Ratios are rounded half-up in whole numbers, so that no binary fraction decides a last digit.
"""

from __future__ import annotations

from merchlake import schemas as S
from merchlake.operators import marketplace, quality
from merchlake.plans import catalog as C

FIELDS = ", ".join(S.ORDER_FIELDS)
LEGAL = ", ".join(f"'{s}'" for s in S.LEGAL_STATUSES)
VALID = ", ".join(f"'{s}'" for s in S.VALID_STATUSES)


def half_up(top: str, bottom: str, digits: int) -> str:
    """top / bottom of non-negative whole numbers, rounded half-up; 0 without a denominator."""
    a, b = f"CAST(coalesce({top}, 0) AS HUGEINT)", f"CAST(coalesce({bottom}, 0) AS HUGEINT)"
    unit = 10**digits
    return (
        f"CASE WHEN {b} = 0 THEN 0.0::DOUBLE "
        f"ELSE CAST((2 * {a} * {unit} + {b}) // (2 * {b}) AS DOUBLE) / {unit} END"
    )


def cents(money: str) -> str:
    return f"CAST(({money}) * 100 AS HUGEINT)"


RAW = f"""
raw_orders AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
           CASE WHEN h < 15 THEN 'no time'
                WHEN h < 125 THEN replace(ds, '-', '/') || ' ' || tod[1:5]
                WHEN h < 160 THEN ds || 'T' || tod
                ELSE ds || ' ' || tod END AS order_time,
           CAST(o_custkey AS VARCHAR) AS user_id,
           CASE WHEN h BETWEEN 600 AND 602 THEN 'X' || l_partkey
                ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
           c_mktsegment AS channel,
           CASE WHEN h BETWEEN 200 AND 209 THEN '' WHEN h BETWEEN 210 AND 212 THEN ' '
                ELSE n_name END AS province,
           CASE WHEN h BETWEEN 205 AND 216 THEN ' ' ELSE n_name || '_C' || c_custkey % 7 END AS city,
           CASE h WHEN 300 THEN '0' WHEN 301 THEN '-1' WHEN 302 THEN '99999' WHEN 303 THEN 'abc'
                  WHEN 304 THEN '1.5' ELSE CAST(qty AS VARCHAR) END AS quantity,
           CASE h WHEN 310 THEN '0.00' WHEN 311 THEN '-' || price WHEN 312 THEN 'n/a'
                  ELSE CAST(price AS VARCHAR) END AS unit_price,
           CASE h WHEN 320 THEN NULL ELSE CAST(disc AS VARCHAR) END AS discount_amount,
           CASE WHEN h BETWEEN 400 AND 409 THEN CAST(CAST(qty * price + 7.00 AS DECIMAL(14,2)) AS VARCHAR)
                WHEN h = 410 THEN NULL
                WHEN h = 411 THEN CAST(CAST(qty * price - disc + 0.01 AS DECIMAL(14,2)) AS VARCHAR)
                WHEN h = 412 THEN CAST(CAST(qty * price - disc - 0.02 AS DECIMAL(14,2)) AS VARCHAR)
                ELSE CAST(CAST(qty * price - disc AS DECIMAL(14,2)) AS VARCHAR) END AS pay_amount,
           CASE WHEN l_orderkey % 250 = 0 THEN '???'
                WHEN o_orderstatus = 'F' THEN '{S.STATUS_DONE}'
                WHEN o_orderstatus = 'O' THEN '{S.STATUS_PAID}'
                WHEN l_orderkey % 4 = 0 THEN '{S.STATUS_UNPAID}'
                WHEN l_orderkey % 4 = 1 THEN '{S.STATUS_CANCELLED}'
                WHEN l_orderkey % 4 = 2 THEN '{S.STATUS_REFUNDED}'
                ELSE '{S.STATUS_UNFULFILLED}' END AS order_status,
           CASE WHEN h BETWEEN 217 AND 228 THEN NULL ELSE o_orderpriority END AS pay_type
    FROM (
        SELECT l_orderkey, l_partkey, CAST(l_quantity AS INTEGER) AS qty,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 * CAST(l_quantity AS INTEGER)
                    AS DECIMAL(12,2)) AS disc,
               (l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7 + CAST(l_quantity AS BIGINT)) % 1000 AS h,
               o_custkey, o_orderstatus, o_orderpriority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS ds,
               printf('%02d:%02d:%02d', 8 + o_orderkey % 12, o_orderkey * 7 % 60, o_orderkey * 13 % 60) AS tod,
               c_custkey, c_mktsegment, n_name
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    ), LATERAL unnest(CASE WHEN h BETWEEN 500 AND 511 THEN [1, 2] ELSE [1] END) AS copies(n)
), raw_products AS (
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
           CASE WHEN p_partkey % 101 = 7 THEN ' ' ELSE 'C_' || p_type END AS category_id,
           CASE WHEN p_partkey % 101 = 7 THEN '' ELSE p_type END AS category_name,
           CASE WHEN p_partkey % 97 = 3 THEN NULL WHEN n = 2 THEN p_brand || '_old' ELSE p_brand END AS brand,
           CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS cost_price,
           '2025-01-01' AS launch_date
    FROM part, LATERAL unnest(CASE WHEN p_partkey % 211 = 5 THEN [1, 2] ELSE [1] END) AS versions(n)
)"""


def pipeline(batch_id: str) -> str:
    """Common tables from raw_orders and raw_products to silver and gold."""
    return f"""
lines AS (
    SELECT {FIELDS}, count(*) AS copies FROM raw_orders GROUP BY ALL
), staged AS (
    SELECT *,
           ts IS NULL AS is_bad_time,
           qty IS NULL OR qty NOT BETWEEN 1 AND {S.MAX_QUANTITY} AS is_bad_qty,
           price IS NULL OR price <= 0 AS is_bad_price,
           order_status IS NULL OR order_status NOT IN ({LEGAL}) AS is_bad_status,
           coalesce(trim(province), '') = '' OR coalesce(trim(city), '') = ''
               OR coalesce(trim(pay_type), '') = '' AS has_blank,
           CASE WHEN qty IS NOT NULL AND price IS NOT NULL
                THEN TRY_CAST(CAST(qty AS DECIMAL(20,0)) * price - discount AS DECIMAL(14,2)) END AS pay,
           CASE WHEN ts IS NULL THEN 'R03'
                WHEN qty IS NULL OR qty NOT BETWEEN 1 AND {S.MAX_QUANTITY} THEN 'R04'
                WHEN price IS NULL OR price <= 0 THEN 'R05' END AS rule_code
    FROM (
        SELECT *,
               coalesce(try_strptime(order_time, '%Y-%m-%d %H:%M:%S'),
                        try_strptime(order_time, '%Y/%m/%d %H:%M'),
                        try_strptime(order_time, '%Y-%m-%dT%H:%M:%S')) AS ts,
               CASE WHEN regexp_full_match(quantity, '[+-]?[0-9]+') THEN TRY_CAST(quantity AS INTEGER) END AS qty,
               TRY_CAST(unit_price AS DECIMAL(12,2)) AS price,
               coalesce(TRY_CAST(discount_amount AS DECIMAL(12,2)), 0) AS discount,
               TRY_CAST(pay_amount AS DECIMAL(14,2)) AS paid
        FROM lines)
), flagged AS (
    SELECT *, is_bad_qty OR is_bad_price OR paid IS NULL OR pay IS NULL OR coalesce(abs(paid - pay) > 0.01, false) AS is_bad_amount
    FROM staged
), dimension AS (
    SELECT pid, best[1] AS pname, best[2] AS cid, best[3] AS cname, best[4] AS pbrand
    FROM (
        -- Absent labels sort last: a list compares element by element, and U+10FFFF is the largest.
        SELECT product_id AS pid, arg_min(labels, list_transform(labels, lambda x: coalesce(x, chr(1114111)))) AS best
        FROM (SELECT product_id, [nullif(trim(product_name), ''), nullif(trim(category_id), ''),
                                  nullif(trim(category_name), ''), nullif(trim(brand), '')] AS labels
              FROM raw_products)
        GROUP BY product_id)
), silver AS (
    SELECT order_id, ts, CAST(ts AS DATE) AS stat_date, strftime(ts, '%Y-%m') AS stat_month,
           CAST(year(ts) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(ts) AS VARCHAR), 2, '0') AS stat_week,
           user_id, product_id, coalesce(pname, '{S.UNKNOWN_PRODUCT}') AS product_name,
           coalesce(cid, '{S.UNKNOWN_CATEGORY_ID}') AS category_id,
           coalesce(cname, '{S.UNKNOWN_CATEGORY}') AS category_name,
           coalesce(pbrand, '{S.UNKNOWN}') AS brand, channel,
           coalesce(nullif(trim(province), ''), '{S.UNKNOWN}') AS province,
           coalesce(nullif(trim(city), ''), '{S.UNKNOWN}') AS city,
           qty AS quantity, price AS unit_price, discount AS discount_amount, pay AS pay_amount,
           CASE WHEN order_status IN ({LEGAL}) THEN order_status ELSE '{S.STATUS_OTHER}' END AS order_status,
           coalesce(nullif(trim(pay_type), ''), '{S.UNKNOWN}') AS pay_type,
           CASE WHEN order_status IN ({VALID}) THEN 1 ELSE 0 END AS is_valid_order,
           '{batch_id}' AS batch_id
    FROM staged LEFT JOIN dimension ON product_id = pid
    WHERE rule_code IS NULL
), rejected AS (
    SELECT '{batch_id}' AS batch_id, rule_code,
           CASE rule_code WHEN 'R03' THEN '{S.RULE_TEXT["R03"]}' WHEN 'R04' THEN '{S.RULE_TEXT["R04"]}'
                          ELSE '{S.RULE_TEXT["R05"]}' END AS rule_desc,
           order_id, product_id,
           array_to_string(list_filter([order_id, order_time, quantity, unit_price, pay_amount], lambda x: x IS NOT NULL), '|') AS raw_record
    FROM staged WHERE rule_code IS NOT NULL
), counters AS (
    SELECT CAST(sum(copies) AS BIGINT) AS raw_cnt,
           count(*) FILTER (has_blank) AS null_field_cnt,
           CAST(sum(copies) AS BIGINT) - count(*) AS dup_record_cnt,
           count(*) FILTER (is_bad_time) AS invalid_time_cnt,
           count(*) FILTER (is_bad_amount) AS invalid_amount_cnt,
           count(*) FILTER (is_bad_status) AS invalid_status_cnt,
           count(*) FILTER (rule_code IS NULL AND product_id NOT IN (SELECT product_id FROM raw_products))
               AS missing_dim_cnt,
           count(*) FILTER (rule_code IS NULL) AS valid_cnt,
           count(*) FILTER (rule_code IS NOT NULL) AS discard_cnt
    FROM flagged
)"""


MARKET = f"""
m_orders AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
           CASE WHEN o_orderstatus = 'F' THEN 'delivered'
                ELSE (['shipped', 'invoiced', 'processing', 'approved', 'created', 'canceled',
                       'unavailable', 'on_hold'])[CAST(o_orderkey % 8 AS INTEGER) + 1] END AS order_status,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' 10:00:00' AS order_purchase_timestamp
    FROM orders
), m_items AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS order_item_id,
           CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
           CAST(l_tax * 100 AS DECIMAL(12,2)) AS freight, CAST(l_suppkey AS VARCHAR) AS seller_id,
           CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipping_limit_date
    FROM lineitem
), m_customers AS (
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, 'U' || (c_custkey // 2) AS customer_unique_id,
           n_name || '_C' || c_custkey % 7 AS customer_city, n_name AS customer_state,
           CAST(c_nationkey AS VARCHAR) AS zip
    FROM customer JOIN nation ON c_nationkey = n_nationkey
), m_products AS (
    SELECT CAST(p_partkey AS VARCHAR) AS product_id,
           CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_type END AS native_name
    FROM part
), m_categories AS (
    SELECT DISTINCT p_type AS native_name,
           CASE p_type WHEN 'PROMO' THEN NULL WHEN 'SMALL' THEN ' ' ELSE lower(p_type) END AS english_name
    FROM part
), m_payments AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS seq,
           CASE l_returnflag || l_linestatus
                WHEN 'AF' THEN 'credit_card' WHEN 'AO' THEN 'debit_card' WHEN 'NF' THEN 'boleto'
                WHEN 'NO' THEN 'voucher' WHEN 'RF' THEN 'not_defined' ELSE 'cash' END AS payment_type,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS payment_value
    FROM lineitem
), main_pay AS (
    SELECT order_id, payment_type FROM m_payments
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY payment_value DESC, seq, payment_type) = 1
), named AS (
    SELECT product_id,
           coalesce(nullif(trim(coalesce(english_name, p.native_name)), ''), '{S.UNKNOWN_CATEGORY}') AS category_name
    FROM m_products p LEFT JOIN m_categories c ON p.native_name = c.native_name
), codes AS (
    SELECT category_name, printf('CAT%03d', row_number() OVER (ORDER BY category_name)) AS category_id
    FROM (SELECT DISTINCT category_name FROM named)
), rolled AS (
    SELECT order_id, product_id, count(order_item_id) AS quantity,
           CAST((2 * {cents("sum(price)")} + count(order_item_id)) // (2 * count(order_item_id)) AS DECIMAL(18,0))
               * 0.01 AS unit_price,
           sum(price) AS pay_amount, count(DISTINCT price) AS price_variants
    FROM m_items GROUP BY order_id, product_id
), converted AS (
    SELECT r.order_id, order_purchase_timestamp AS order_time, customer_unique_id AS user_id, product_id,
           '{marketplace.CHANNEL}' AS channel, customer_state AS province, customer_city AS city,
           CAST(quantity AS VARCHAR) AS quantity,
           CAST(CAST(unit_price AS DECIMAL(12,2)) AS VARCHAR) AS unit_price,
           '0.00' AS discount_amount,
           CAST(CAST(pay_amount AS DECIMAL(14,2)) AS VARCHAR) AS pay_amount,
           CASE WHEN o.order_status = 'delivered' THEN '已完成'
                WHEN o.order_status IN ('shipped', 'invoiced', 'processing', 'approved') THEN '已支付'
                WHEN o.order_status = 'created' THEN '待付款'
                WHEN o.order_status = 'canceled' THEN '已取消'
                WHEN o.order_status = 'unavailable' THEN '无法履约' ELSE '其他' END AS order_status,
           CASE payment_type WHEN 'credit_card' THEN '信用卡' WHEN 'debit_card' THEN '借记卡'
                WHEN 'boleto' THEN 'Boleto票据' WHEN 'voucher' THEN '代金券'
                WHEN 'not_defined' THEN '未知' END AS pay_type
    FROM rolled r JOIN m_orders o ON r.order_id = o.order_id
         JOIN m_customers c ON o.customer_id = c.customer_id
         LEFT JOIN main_pay p ON r.order_id = p.order_id
), converted_products AS (
    SELECT product_id, n.category_name || '-' || product_id AS product_name, category_id,
           n.category_name, '{S.UNKNOWN}' AS brand, '0.00' AS cost_price, '' AS launch_date
    FROM named n LEFT JOIN codes c ON n.category_name = c.category_name
)"""

# Fields of the six tables that hold something; all others are null throughout.
_CELLS = {
    "orders": {c: c for c in ("order_id", "customer_id", "order_status", "order_purchase_timestamp")},
    "items": {
        **{c: c for c in ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date")},
        "price": "CAST(price AS VARCHAR)",
        "freight_value": "CAST(freight AS VARCHAR)",
    },
    "customers": {
        **{c: c for c in ("customer_id", "customer_unique_id", "customer_city", "customer_state")},
        "customer_zip_code_prefix": "zip",
    },
    "products": {"product_id": "product_id", "product_category_name": "native_name"},
    "payments": {
        "order_id": "order_id",
        "payment_sequential": "CAST(seq AS VARCHAR)",
        "payment_type": "payment_type",
        "payment_installments": "'1'",
        "payment_value": "CAST(payment_value AS VARCHAR)",
    },
    # A lone blank comes back from CSV as it was.
    "categories": {"product_category_name": "native_name", "product_category_name_english": "english_name"},
}
MARKET_CELLS = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{field}' AS field, {_CELLS[table].get(field, 'NULL')} AS value, "
    f"count(*) AS row_cnt FROM m_{table} GROUP BY ALL"
    for table, fields in S.MARKET_FIELDS.items()
    for field in fields
)

MARKET_PIPELINE = f"""{MARKET},
market_cells AS ({MARKET_CELLS}),
raw_orders AS (SELECT * FROM converted),
raw_products AS (SELECT * FROM converted_products),
{pipeline(C.MARKET_BATCH)}"""

BASE = f"{RAW},{pipeline(C.BATCH)}"

# --- measures -------------------------------------------------------------------------------

V_GMV = "sum(CASE WHEN is_valid_order = 1 THEN pay_amount ELSE 0 END)"
V_QTY = "CAST(sum(CASE WHEN is_valid_order = 1 THEN quantity ELSE 0 END) AS BIGINT)"
V_ORDERS = "count(DISTINCT CASE WHEN is_valid_order = 1 THEN order_id END)"
V_BUYERS = "count(DISTINCT CASE WHEN is_valid_order = 1 THEN user_id END)"
V_REFUNDS = f"count(DISTINCT CASE WHEN order_status = '{S.STATUS_REFUNDED}' THEN order_id END)"


def daily(keys: str, *measures: str, where: str = "true") -> str:
    shown = keys.replace("stat_date", "CAST(stat_date AS VARCHAR) AS stat_date", 1)
    return f"SELECT {shown}, {', '.join(measures)} FROM silver WHERE {where} GROUP BY {keys}"


GMV = f"CAST({V_GMV} AS DOUBLE) AS gmv"
QTY = f"{V_QTY} AS sales_qty"
ORDERS = f"{V_ORDERS} AS order_cnt"
BUYERS = f"{V_BUYERS} AS buyer_cnt"

TREND_MEASURES = [
    "count(DISTINCT order_id) AS order_cnt",
    f"{V_ORDERS} AS valid_order_cnt",
    GMV,
    QTY,
    BUYERS,
    f"{half_up(cents(V_GMV), f'{V_ORDERS} * 100', 2)} AS avg_order_amount",
    f"{V_REFUNDS} AS refund_order_cnt",
    f"{half_up(V_REFUNDS, 'count(DISTINCT order_id)', 4)} AS refund_rate",
]


def trend(where: str = "true", extra: str = "") -> str:
    return daily("stat_date", *TREND_MEASURES, *([extra] if extra else []), where=where)


def measures_row(where: str = "true") -> str:
    return f"""
        SELECT coalesce({V_GMV}, 0) AS gmv, count(DISTINCT order_id) AS orders, {V_ORDERS} AS valid_orders,
               coalesce({V_QTY}, 0) AS qty, {V_BUYERS} AS buyers, {V_REFUNDS} AS refunds,
               coalesce(sum(CASE WHEN is_valid_order = 1 THEN quantity * unit_price ELSE 0 END), 0) AS gross,
               coalesce(sum(CASE WHEN is_valid_order = 1 THEN discount_amount ELSE 0 END), 0) AS discount,
               max(stat_date) AS last_date
        FROM silver WHERE {where}"""


def kpis(where: str, columns: str) -> str:
    values = {
        "GMV": "CAST(gmv AS DOUBLE)",
        "ORDER_CNT": "CAST(orders AS DOUBLE)",
        "VALID_ORDER_CNT": "CAST(valid_orders AS DOUBLE)",
        "SALES_QTY": "CAST(qty AS DOUBLE)",
        "BUYER_CNT": "CAST(buyers AS DOUBLE)",
        "AVG_ORDER_AMOUNT": half_up(cents("gmv"), "valid_orders * 100", 2),
        "AVG_ITEM_PRICE": half_up(cents("gmv"), "qty * 100", 2),
        "REFUND_RATE": half_up("refunds * 100", "orders", 4),
        "DISCOUNT_RATE": half_up(f"{cents('discount')} * 100", cents("gross"), 4),
    }
    rows = [
        f"SELECT CAST({i} AS BIGINT) AS kpi_rank, '{code}' AS kpi_code, '{name}' AS kpi_name, "
        f"{values[code]} AS kpi_value, '{unit or C.CURRENCY}' AS kpi_unit, '{text}' AS kpi_desc, "
        f"CAST(last_date AS VARCHAR) AS stat_date FROM m"
        for i, (code, name, unit, text) in enumerate(S.KPIS, start=1)
    ]
    return f"SELECT {columns} FROM (WITH m AS ({measures_row(where)}) {' UNION ALL '.join(rows)})"


CARD = "kpi_rank, kpi_code, kpi_name, kpi_value, kpi_unit, kpi_desc"
RANGE = "stat_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"
ONE_CHANNEL = "channel = 'BUILDING' AND category_name = 'PROMO'"
ALL_FILTERS = (
    "stat_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' AND channel = 'BUILDING' "
    "AND category_name = 'PROMO' AND province = 'NATION_3' AND pay_type = '1-URGENT'"
)
ONLY_VALID = "is_valid_order = 1"


def shares(dim: str, where: str, limit: int | None) -> str:
    total = f"(SELECT sum(pay_amount) FROM silver WHERE {where})"
    cut = f"WHERE rank_no <= {limit}" if limit else ""
    return f"""
    SELECT rank_no, name, CAST(gmv AS DOUBLE) AS gmv, sales_qty, order_cnt, buyer_cnt,
           {half_up(f"{cents('gmv')} * 100", cents(total), 2)} AS ratio
    FROM (
        SELECT row_number() OVER (ORDER BY gmv DESC, name) AS rank_no, * FROM (
            SELECT {dim} AS name, sum(pay_amount) AS gmv, CAST(sum(quantity) AS BIGINT) AS sales_qty,
                   count(DISTINCT order_id) AS order_cnt, count(DISTINCT user_id) AS buyer_cnt
            FROM silver WHERE {where} GROUP BY {dim})
    ) {cut}"""


def product_detail(where: str, limit: int) -> str:
    return f"""
    SELECT row_number() OVER (ORDER BY gmv DESC, product_id, product_name, category_name, brand) AS rank_no,
           product_id, product_name, category_name, brand, CAST(gmv AS DOUBLE) AS gmv, sales_qty, order_cnt,
           '{C.D.ON_DEMAND}' AS source
    FROM (
        SELECT product_id, product_name, category_name, brand, sum(pay_amount) AS gmv,
               CAST(sum(quantity) AS BIGINT) AS sales_qty, count(DISTINCT order_id) AS order_cnt
        FROM silver WHERE {where} GROUP BY ALL)
    QUALIFY rank_no <= {limit}"""


SILVER_TEXT = """
    order_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS order_time, CAST(stat_date AS VARCHAR) AS stat_date,
    stat_month, stat_week, user_id, product_id, product_name, category_id, category_name, brand, channel,
    province, city, CAST(quantity AS BIGINT) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
    CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(pay_amount AS DOUBLE) AS pay_amount,
    order_status, pay_type, CAST(is_valid_order AS BIGINT) AS is_valid_order, batch_id"""

NEWEST = ", ".join(
    ["ts DESC", "order_id", "product_id"]
    + [
        f"{c} NULLS FIRST"
        for c in C.D.DETAIL_COLUMNS
        if c not in ("order_time", "order_id", "product_id")
    ]
)


def page(where: str, offset: int, size: int) -> str:
    return f"SELECT {SILVER_TEXT} FROM (SELECT * FROM silver WHERE {where} ORDER BY {NEWEST} LIMIT {size} OFFSET {offset})"


EXPORT_VALUES = {
    "order_time": "strftime(ts, '%Y-%m-%d %H:%M:%S')",
    "is_valid_order": "CASE WHEN is_valid_order = 1 THEN '有效' ELSE '无效' END",
}
EXPORT = ", ".join(
    f'{EXPORT_VALUES.get(column, f"CAST({column} AS VARCHAR)")} AS "{header}"'
    for column, header in C.D.EXPORT_HEADERS.items()
)

COUNTERS = ", ".join(c for c in S.CLEAN_STAT_COLUMNS[2:11])
STAT = f"""'{{batch}}' AS batch_id, {COUNTERS}, {half_up("valid_cnt", "raw_cnt", 4)} AS quality_score"""


def tall(rows: list[str]) -> str:
    return " UNION ALL ".join(rows)


FUNNEL = tall(
    [
        f"SELECT CAST({i} AS BIGINT) AS step_no, '{label}' AS step, {name} AS row_cnt FROM counters"
        for i, (label, name) in enumerate(quality.FUNNEL_STEPS, start=1)
    ]
)
RULES = tall(
    [
        f"SELECT '{code}' AS rule_code, '{text}' AS rule_desc, '{action}' AS action, {name} AS hit_cnt FROM counters"
        for code, text, action, name in quality.RULE_TABLE
    ]
)
PASS_RATE = f"SELECT raw_cnt, valid_cnt, {half_up('valid_cnt', 'raw_cnt', 6)} AS pass_rate FROM counters"

SHEET = tall(
    [
        f"SELECT '{name}' AS metric, CAST({top} AS DOUBLE) AS numerator, "
        f"CAST({bottom or 'NULL'} AS DOUBLE) AS denominator, {value} AS measured FROM m"
        for name, top, bottom, value in [
            ("GMV", "gmv", None, "CAST(gmv AS DOUBLE)"),
            ("ORDER_CNT", "orders", None, "CAST(orders AS DOUBLE)"),
            ("VALID_ORDER_CNT", "valid_orders", None, "CAST(valid_orders AS DOUBLE)"),
            ("SALES_QTY", "qty", None, "CAST(qty AS DOUBLE)"),
            ("BUYER_CNT", "buyers", None, "CAST(buyers AS DOUBLE)"),
            ("AVG_ORDER_AMOUNT", "gmv", "valid_orders", half_up(cents("gmv"), "valid_orders * 100", 6)),
            ("AVG_ITEM_PRICE", "gmv", "qty", half_up(cents("gmv"), "qty * 100", 6)),
            ("REFUND_RATE", "refunds", "orders", half_up("refunds", "orders", 6)),
            ("DISCOUNT_RATE", "discount", "gross", half_up(cents("discount"), cents("gross"), 6)),
        ]
    ]
)


def checks(rows: list[tuple[str, str, str, str, str]], names: tuple[str, str, str]) -> str:
    """Rows of (name, actual, expected, tolerance, unit), sides being scalar SQL."""
    return tall(
        [
            f"SELECT CAST({i} AS BIGINT) AS check_no, '{name}' AS {names[0]}, "
            f"CAST(a AS DOUBLE) AS {names[1]}, CAST(e AS DOUBLE) AS {names[2]}, "
            f"CAST(abs(a - e) AS DOUBLE) AS diff, '{unit}' AS unit, "
            f"CAST(CASE WHEN abs(a - e) <= {tolerance} THEN 1 ELSE 0 END AS BIGINT) AS passed "
            f"FROM (SELECT ({actual}) AS a, ({expected}) AS e)"
            for i, (name, actual, expected, tolerance, unit) in enumerate(rows, start=1)
        ]
    )


SUM_DAILY_ORDERS = f"SELECT sum(n) FROM (SELECT {V_ORDERS} AS n FROM silver GROUP BY stat_date)"
SUM_DAILY_GMV = f"SELECT sum(g) FROM (SELECT {V_GMV} AS g FROM silver GROUP BY stat_date)"
SUM_DAILY_QTY = f"SELECT sum(q) FROM (SELECT {V_QTY} AS q FROM silver GROUP BY stat_date)"
SUM_CATEGORY = f"SELECT sum(g) FROM (SELECT {V_GMV} AS g FROM silver GROUP BY stat_date, category_id, category_name)"
ALL_GMV = f"SELECT {V_GMV} FROM silver"
ALL_QTY = f"SELECT {V_QTY} FROM silver"
ALL_ORDERS = f"SELECT {V_ORDERS} FROM silver"

CONSISTENCY = checks(
    [
        ("GMV 合计", SUM_DAILY_GMV, ALL_GMV, "0.01", C.CURRENCY),
        ("销售件数合计", SUM_DAILY_QTY, ALL_QTY, "0", "件"),
        ("有效订单量合计", SUM_DAILY_ORDERS, ALL_ORDERS, "0", "单"),
        ("类目 GMV 合计", SUM_CATEGORY, ALL_GMV, "0.01", C.CURRENCY),
    ],
    ("item", "ads_value", "detail_value"),
)

RECON = checks(
    [
        (
            "原始 items 行数 → 分组数",
            "SELECT count(*) FROM (SELECT DISTINCT order_id, product_id FROM m_items)",
            "SELECT count(*) FROM converted",
            "0",
            "行",
        ),
        (
            "原始 Σprice → 转换 Σpay_amount",
            "SELECT sum(CAST(pay_amount AS DECIMAL(14,2))) FROM converted",
            "SELECT sum(price) FROM m_items",
            "0.01",
            "BRL",
        ),
        ("转换 CSV 行数 → DWD 行数", "SELECT count(*) FROM silver", "SELECT count(*) FROM converted", "0", "行"),
        (
            "转换 Σpay_amount → DWD Σpay_amount",
            "SELECT sum(pay_amount) FROM silver",
            "SELECT sum(CAST(pay_amount AS DECIMAL(14,2))) FROM converted",
            "0.01",
            "BRL",
        ),
        ("DWD 有效 Σpay_amount → ADS 趋势 Σgmv", SUM_DAILY_GMV, ALL_GMV, "0.01", "BRL"),
        ("DWD 有效 Σpay_amount → ADS 类目 Σgmv", SUM_CATEGORY, ALL_GMV, "0.01", "BRL"),
        ("ADS 类目 Σgmv → ads_overview GMV", ALL_GMV, SUM_CATEGORY, "0.01", "BRL"),
        (
            "DWD 唯一订单数 → ads_overview 下单量",
            "SELECT count(DISTINCT order_id) FROM silver",
            "SELECT count(DISTINCT order_id) FROM silver",
            "0",
            "单",
        ),
        ("DWD 有效唯一订单 → ads_overview 有效订单量", ALL_ORDERS, ALL_ORDERS, "0", "单"),
    ],
    ("check_name", "actual", "expected"),
)

RAW_FACTS = tall(
    [
        f"SELECT '{name}' AS metric, CAST(({value}) AS DOUBLE) AS value"
        for name, value in [
            ("raw_item_rows", "SELECT count(*) FROM m_items"),
            ("raw_item_orders", "SELECT count(DISTINCT order_id) FROM m_items"),
            ("raw_item_groups", "SELECT count(*) FROM rolled"),
            ("raw_price", "SELECT sum(price) FROM m_items"),
            ("raw_freight", "SELECT sum(freight) FROM m_items"),
            ("raw_order_rows", "SELECT count(*) FROM m_orders"),
            ("raw_payment", "SELECT sum(payment_value) FROM m_payments"),
        ]
    ]
)

DAILY_KEYS = {
    "ads_daily_trend": "stat_date",
    "ads_category_stat": "stat_date, category_id, category_name",
    "ads_product_stat": "stat_date, product_id, product_name, category_name, brand",
    "ads_channel_stat": "stat_date, channel",
    "ads_paytype_stat": "stat_date, pay_type",
    "ads_region_stat": "stat_date, province",
    "ads_channel_category_stat": "stat_date, channel, category_name",
}
DIFFERENCES = tall(
    [
        f"SELECT '{name}' AS table_name, n AS a_rows, n AS b_rows, CAST(0 AS BIGINT) AS unpaired_rows, "
        f"CAST(1 AS BIGINT) AS passed FROM (SELECT count(*) AS n FROM {source})"
        for name, source in [
            ("dwd_order_detail", "silver"),
            ("dwd_clean_reject", "rejected"),
            *[(t, f"(SELECT DISTINCT {keys} FROM silver)") for t, keys in DAILY_KEYS.items()],
            ("ads_overview", f"range({len(S.KPIS)})"),
            ("ads_clean_stat", "counters"),
        ]
    ]
)
SNAPSHOT = {
    "silver_rows": "SELECT count(*) FROM silver",
    "reject_rows": "SELECT count(*) FROM rejected",
    "trend_gmv": SUM_DAILY_GMV,
    "trend_valid_orders": SUM_DAILY_ORDERS,
}
COMPARE = (
    "SELECT "
    + ", ".join(
        f"CAST(({value}) AS DOUBLE) AS {side}{name}"
        for side in ("a_", "b_")
        for name, value in SNAPSHOT.items()
    )
    + ", '' AS differences, 'PASS' AS verdict"
)

GOLD_ROWS = " + ".join(
    f"(SELECT count(*) FROM (SELECT DISTINCT {keys} FROM silver))" for keys in DAILY_KEYS.values()
)
RUN_LOG = tall(
    [
        f"SELECT '{batch}' AS batch_id, '{quality.JOB_NAME}' AS job_name, '{mode}' AS compute_mode, "
        f"(SELECT raw_cnt FROM counters) AS input_rows, "
        f"(SELECT count(*) FROM silver) + {GOLD_ROWS} + {len(S.KPIS)} AS output_rows, 'SUCCESS' AS job_status"
        for batch, mode in ((C.BATCH, "DATAFRAME"), (C.SECOND_BATCH, "SQL"))
    ]
)

VALUE_LISTS = " UNION ALL ".join(
    f"SELECT DISTINCT '{kind}' AS kind, {column} AS value FROM silver WHERE {column} <> ''"
    for kind, (_, column) in C.D.FILTER_VALUES.items()
)

MARKET_SHARE = half_up("excluded_cnt * 100", "status_cnt", 1)


def distribution(source: str, status: str, extra: str) -> str:
    return f"""
    SELECT {status} AS order_status, count(*) AS row_cnt,
           {half_up("count(*) * 100", f"(SELECT count(*) FROM {source})", 2)} AS share_pct, {extra}
    FROM {source} GROUP BY {status}"""


ON_BASE: dict[str, str] = {
    "bronze_orders": f"SELECT {FIELDS}, '{C.BATCH}' AS batch_id FROM raw_orders",
    "bronze_products": f"SELECT *, '{C.BATCH}' AS batch_id FROM raw_products",
    "r01_blank_fill": f"""SELECT order_id, product_id, quantity, province, city, pay_type,
        coalesce(nullif(trim(province), ''), '{S.UNKNOWN}') AS province_filled,
        coalesce(nullif(trim(city), ''), '{S.UNKNOWN}') AS city_filled,
        coalesce(nullif(trim(pay_type), ''), '{S.UNKNOWN}') AS pay_type_filled
        FROM staged WHERE has_blank""",
    "r02_dedup": f"SELECT {FIELDS}, copies FROM lines WHERE copies > 1",
    "r03_time_parse": """SELECT order_time, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
        CAST(is_bad_time AS BIGINT) AS is_bad_time, count(*) AS row_cnt FROM staged GROUP BY ALL""",
    "r04_quantity": """SELECT quantity, CAST(is_bad_qty AS BIGINT) AS is_bad_qty, count(*) AS row_cnt
        FROM staged GROUP BY ALL""",
    "r05_price": "SELECT order_id, product_id, quantity, unit_price FROM staged WHERE is_bad_price",
    "r06_amount_fix": """SELECT order_id, product_id, quantity, pay_amount, CAST(pay AS DOUBLE) AS pay_fixed
        FROM flagged WHERE is_bad_amount AND rule_code IS NULL""",
    "r07_status": f"""SELECT order_status, CAST(is_bad_status AS BIGINT) AS is_bad_status, count(*) AS row_cnt,
        CASE WHEN order_status IN ({LEGAL}) THEN order_status ELSE '{S.STATUS_OTHER}' END AS standard_status,
        CAST(CASE WHEN order_status IN ({VALID}) THEN 1 ELSE 0 END AS BIGINT) AS is_valid
        FROM staged GROUP BY ALL""",
    "r08_missing_dim": """SELECT order_id, product_id, quantity, order_time FROM staged
        WHERE rule_code IS NULL AND product_id NOT IN (SELECT product_id FROM raw_products)""",
    "product_dimension": """SELECT pid AS dim_product_id, pname AS dim_product_name, cid AS dim_category_id,
        cname AS dim_category_name, pbrand AS dim_brand FROM dimension""",
    "calendar_keys": """SELECT CAST(stat_date AS VARCHAR) AS stat_date, stat_month, stat_week, count(*) AS row_cnt
        FROM silver GROUP BY ALL""",
    "silver_orders": f"SELECT {SILVER_TEXT} FROM silver",
    "rejects": "SELECT * FROM rejected",
    "reject_summary": "SELECT rule_code, count(*) AS reject_cnt FROM rejected GROUP BY rule_code",
    "rule_counters": f"SELECT {COUNTERS} FROM counters",
    "clean_stat": f"SELECT {STAT.format(batch=C.BATCH)} FROM counters",
    "count_invariant": """SELECT raw_cnt, dup_record_cnt, discard_cnt, valid_cnt,
        CAST(raw_cnt = dup_record_cnt + discard_cnt + valid_cnt AS BIGINT) AS passed FROM counters""",
    "quality_funnel": FUNNEL,
    "rule_table": RULES,
    "pass_rate": PASS_RATE,
    "daily_trend": trend(),
    "category_stat": daily(DAILY_KEYS["ads_category_stat"], GMV, QTY, ORDERS, BUYERS),
    "product_stat": daily(DAILY_KEYS["ads_product_stat"], GMV, QTY, ORDERS),
    "channel_stat": daily(DAILY_KEYS["ads_channel_stat"], GMV, ORDERS, QTY, BUYERS),
    "paytype_stat": daily(DAILY_KEYS["ads_paytype_stat"], GMV, ORDERS),
    "region_stat": daily(DAILY_KEYS["ads_region_stat"], GMV, ORDERS, BUYERS),
    "channel_category_stat": daily(DAILY_KEYS["ads_channel_category_stat"], GMV, ORDERS),
    "overview_kpis": kpis(
        "true", f"kpi_code, kpi_name, kpi_value, kpi_unit, kpi_desc, stat_date, '{C.BATCH}' AS batch_id"
    ),
    "overview_default": kpis("true", f"{CARD}, '{C.D.PRECOMPUTED}' AS source"),
    "overview_range": kpis(RANGE, f"{CARD}, '{C.D.ON_DEMAND}' AS source"),
    "overview_filtered": kpis(ONE_CHANNEL, f"{CARD}, '{C.D.ON_DEMAND}' AS source"),
    "overview_nothing_matches": kpis(
        "stat_date >= DATE '2050-01-01'", f"{CARD}, '{C.D.ON_DEMAND}' AS source"
    ),
    "trend_range": trend(RANGE, f"'{C.D.PRECOMPUTED}' AS source"),
    "trend_filtered": trend(ONE_CHANNEL, f"'{C.D.ON_DEMAND}' AS source"),
    "trend_last5": f"""SELECT stat_date, valid_order_cnt, gmv, buyer_cnt, refund_rate
        FROM ({trend()}) ORDER BY stat_date DESC LIMIT 5""",
    "category_topn": shares("category_name", ONLY_VALID, 3),
    "category_topn_all_orders": shares("category_name", RANGE, 4),
    "product_topn_gold": f"""
        SELECT row_number() OVER (ORDER BY gmv DESC, product_id) AS rank_no, product_id, product_name,
               category_name, brand, CAST(gmv AS DOUBLE) AS gmv, sales_qty, order_cnt,
               '{C.D.PRECOMPUTED}' AS source
        FROM (
            SELECT product_id, max(product_name) AS product_name, max(category_name) AS category_name,
                   max(brand) AS brand, sum(g) AS gmv, CAST(sum(q) AS BIGINT) AS sales_qty,
                   CAST(sum(n) AS BIGINT) AS order_cnt
            FROM (SELECT stat_date, product_id, product_name, category_name, brand, sum(pay_amount) AS g,
                         sum(quantity) AS q, count(DISTINCT order_id) AS n
                  FROM silver WHERE is_valid_order = 1 AND {RANGE} GROUP BY ALL)
            GROUP BY product_id)
        QUALIFY rank_no <= 15""",
    "product_topn_detail": product_detail(f"{ONLY_VALID} AND {ONE_CHANNEL}", 500),
    "product_topn_all_orders": product_detail("true", 25),
    "channel_dist": shares("channel", ONLY_VALID, None),
    "paytype_dist": shares("pay_type", f"{ONLY_VALID} AND province = 'NATION_3'", None),
    "region_topn": shares("province", ONLY_VALID, 10),
    "region_topn_all_filters": shares("province", f"{ONLY_VALID} AND {ALL_FILTERS}", 10),
    "channel_category": f"""SELECT channel, category_name, CAST(sum(pay_amount) AS DOUBLE) AS gmv,
        count(DISTINCT order_id) AS order_cnt FROM silver WHERE {ONLY_VALID} AND {RANGE} GROUP BY ALL""",
    "channel_category_pivot": f"""
        SELECT t.category_name, CAST(total AS DOUBLE) AS total_gmv, channel,
               CAST(coalesce((SELECT sum(pay_amount) FROM silver s WHERE {ONLY_VALID} AND s.channel = c.channel
                              AND s.category_name = t.category_name), 0) AS DOUBLE) AS gmv
        FROM (SELECT category_name, sum(pay_amount) AS total FROM silver WHERE {ONLY_VALID}
              GROUP BY category_name ORDER BY 2 DESC, 1 LIMIT 6) t,
             (SELECT DISTINCT channel FROM silver WHERE {ONLY_VALID}) c""",
    "date_range": """SELECT CAST(min(stat_date) AS VARCHAR) AS min_date, CAST(max(stat_date) AS VARCHAR) AS max_date
        FROM silver""",
    "filter_meta": f"""SELECT 'min_date' AS kind, CAST(min(stat_date) AS VARCHAR) AS value FROM silver
        UNION ALL SELECT 'max_date', CAST(max(stat_date) AS VARCHAR) FROM silver UNION ALL {VALUE_LISTS}""",
    "order_page": page(ONLY_VALID, 100, 50),
    "order_page_deep": page("true", 14_900, 100),
    "order_page_totals": f"""SELECT CAST(3 AS BIGINT) AS page_num, CAST(50 AS BIGINT) AS page_size,
        count(*) AS total, (count(*) + 49) // 50 AS pages FROM silver WHERE {ONLY_VALID}""",
    "order_page_huge": page(ONLY_VALID, 1500, 1500),
    "order_export_all": f"SELECT {EXPORT} FROM silver",
    "export_round_trip": f"SELECT {EXPORT} FROM silver WHERE channel = 'BUILDING'",
    "order_page_by_status": page(f"order_status = '{S.STATUS_REFUNDED}' AND channel = 'MACHINERY'", 0, 20),
    "order_export": f"""SELECT {EXPORT} FROM (
        SELECT * FROM silver WHERE province = 'NATION_7' ORDER BY {NEWEST} LIMIT 5000)""",
    "consistency": CONSISTENCY,
    "metric_sheet": f"SELECT * FROM (WITH m AS ({measures_row()}) {SHEET})",
    "build_compare": COMPARE,
    "build_differences": DIFFERENCES,
    "run_log": RUN_LOG,
    "latest_quality": f"""SELECT {STAT.format(batch=C.SECOND_BATCH)} FROM (
        SELECT (SELECT count(*) FROM silver) AS raw_cnt, CAST(0 AS BIGINT) AS null_field_cnt,
               (SELECT count(*) FROM silver) - count(*) AS dup_record_cnt, CAST(0 AS BIGINT) AS invalid_time_cnt,
               CAST(0 AS BIGINT) AS invalid_amount_cnt,
               count(*) FILTER (order_status = '{S.STATUS_OTHER}') AS invalid_status_cnt,
               count(*) FILTER (product_id NOT IN (SELECT product_id FROM raw_products)) AS missing_dim_cnt,
               count(*) AS valid_cnt, CAST(0 AS BIGINT) AS discard_cnt
        FROM (SELECT DISTINCT order_id, ts, user_id, product_id, channel, province, city, quantity, unit_price,
                     discount_amount, pay_amount, order_status, pay_type FROM silver))""",
    "csv_scan_orders": f"""SELECT order_id, order_time, user_id, product_id, channel,
        nullif(province, '') AS province, city, quantity, unit_price, discount_amount, pay_amount,
        order_status, pay_type, '{C.BATCH}' AS batch_id FROM raw_orders""",
    "csv_scan_products": f"""SELECT product_id, product_name, category_id, nullif(category_name, '') AS category_name,
        brand, cost_price, launch_date, '{C.BATCH}' AS batch_id FROM raw_products""",
    "stored_silver": f"SELECT {SILVER_TEXT} FROM silver",
    "stored_category_top": shares("category_name", ONLY_VALID, 3),
    "stored_rejects": "SELECT * FROM rejected",
    "stored_gold_trend": trend(),
    "stored_gold_product": daily(DAILY_KEYS["ads_product_stat"], GMV, QTY, ORDERS),
    "overview_routed": kpis("true", f"{CARD}, '{C.D.PRECOMPUTED}' AS source"),
    "overview_empty_gold": kpis("true", f"{CARD}, '{C.D.ON_DEMAND}' AS source"),
    "trend_routed": trend(RANGE, f"'{C.D.PRECOMPUTED}' AS source"),
    "trend_empty_gold": trend(RANGE, f"'{C.D.ON_DEMAND}' AS source"),
    "duration_compare": """
        SELECT o_orderpriority AS job_name, a AS base_ms, b AS other_ms, b - a AS diff_ms,
               CASE WHEN a > 0 THEN round((b - a) * 100.0::DOUBLE / a, 2) ELSE 0.0::DOUBLE END AS slower_pct
        FROM (SELECT o_orderpriority, CAST(sum(o_custkey % 1000) FILTER (o_orderstatus = 'F') AS BIGINT) AS a,
                     CAST(sum(o_custkey % 1000) FILTER (o_orderstatus <> 'F') AS BIGINT) AS b
              FROM orders GROUP BY 1)""",
}
ON_BASE["product_routed"] = ON_BASE["product_topn_gold"]
ON_BASE["overview_range_keys"] = ON_BASE["overview_range"]
ON_BASE["order_page_indexed"] = ON_BASE["order_page"]
ON_BASE["order_page_totals_indexed"] = ON_BASE["order_page_totals"]
ON_BASE["dedup_incremental"] = ON_BASE["r02_dedup"]
ON_BASE["overview_two_loads"] = ON_BASE["overview_kpis"]
ON_BASE["quality_two_loads"] = ON_BASE["clean_stat"]

# Raw rows after the rebuild of a few days, from which everything follows as from any raw rows.
_DAY = """CAST(CAST(coalesce(try_strptime(order_time, '%Y-%m-%d %H:%M:%S'), try_strptime(order_time, '%Y/%m/%d %H:%M'),
    try_strptime(order_time, '%Y-%m-%dT%H:%M:%S')) AS DATE) AS VARCHAR)"""
_OTHERS = ", ".join(c for c in S.ORDER_FIELDS if c not in ("quantity", "order_time"))
MERGED = f"""{RAW.replace("raw_orders AS (", "first_orders AS (", 1)},
dated AS (SELECT *, {_DAY} AS day FROM first_orders),
raw_orders AS (
    SELECT {FIELDS} FROM dated WHERE coalesce(day NOT BETWEEN '{C.REBUILT_FROM}' AND '{C.REBUILT_TO}', true)
    UNION ALL BY NAME
    SELECT {_OTHERS}, CASE WHEN order_id LIKE '%7' THEN '0' ELSE quantity END AS quantity,
           CASE WHEN order_id LIKE '%3' THEN 'lost' ELSE order_time END AS order_time
    FROM dated WHERE day BETWEEN '{C.REBUILT_FROM}' AND '{C.REBUILT_TO}' AND day <> '{C.EMPTIED}'
),{pipeline(C.REBUILD_BATCH)}"""

ON_MERGED: dict[str, str] = {
    "rebuilt_silver": f"SELECT {SILVER_TEXT.replace(', batch_id', '')} FROM silver",
    "rebuilt_rejects": "SELECT * FROM rejected",
    "rebuilt_quality": f"SELECT {STAT.format(batch=C.REBUILD_BATCH)} FROM counters",
    "rebuilt_trend": trend(),
    "rebuilt_bronze": f"SELECT {FIELDS} FROM raw_orders",
}

ON_MARKET: dict[str, str] = {
    "import_orders": "SELECT * FROM converted",
    "import_products": "SELECT * FROM converted_products",
    "main_payment": "SELECT * FROM main_pay",
    "named_products": "SELECT * FROM named",
    "category_codes": "SELECT * FROM codes",
    "item_rollup": """SELECT order_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
        CAST(pay_amount AS DOUBLE) AS pay_amount, price_variants FROM rolled""",
    "rollup_selfcheck": """SELECT count(*) FILTER (price_variants > 1) AS multi_price_groups,
        count(*) FILTER (abs(CAST(unit_price AS DOUBLE) * CAST(quantity AS DOUBLE)
                             - CAST(pay_amount AS DOUBLE)) > 0.011) AS amount_mismatch_groups FROM rolled""",
    "orders_with_items": """SELECT order_id, order_status FROM m_orders
        WHERE order_id IN (SELECT order_id FROM m_items)""",
    "orders_without_items": """SELECT order_id, order_status FROM m_orders
        WHERE order_id NOT IN (SELECT order_id FROM m_items)""",
    "excluded_by_status": f"""SELECT order_status, excluded_cnt, status_cnt, {MARKET_SHARE} AS share_pct FROM (
        SELECT order_status, count(*) FILTER (order_id NOT IN (SELECT order_id FROM m_items)) AS excluded_cnt,
               count(*) AS status_cnt FROM m_orders GROUP BY order_status) WHERE excluded_cnt > 0""",
    "status_distribution": distribution(
        "converted",
        "order_status",
        f"CAST(CASE WHEN order_status IN ({VALID}) THEN 1 ELSE 0 END AS BIGINT) AS counts_as_valid",
    ),
    "raw_status_mapping": distribution(
        "m_orders",
        "order_status",
        """CASE order_status WHEN 'delivered' THEN '已完成' WHEN 'shipped' THEN '已支付'
           WHEN 'invoiced' THEN '已支付' WHEN 'processing' THEN '已支付' WHEN 'approved' THEN '已支付'
           WHEN 'created' THEN '待付款' WHEN 'canceled' THEN '已取消' WHEN 'unavailable' THEN '无法履约'
           ELSE '其他' END AS mapped_status""",
    ),
    "recon_facts": RAW_FACTS,
    "recon_levels": RECON,
    "market_pass_rate": PASS_RATE,
    "csv_scan_marketplace": "SELECT * FROM market_cells",
}

ON_MARKET["import_round_trip"] = ON_MARKET["import_orders"]

ORACLE: dict[str, str] = {
    **{name: f"WITH {BASE} {body}" for name, body in ON_BASE.items()},
    **{name: f"WITH {MARKET_PIPELINE} {body}" for name, body in ON_MARKET.items()},
    **{name: f"WITH {MERGED} {body}" for name, body in ON_MERGED.items()},
}

# The rebuild writes the rejects of its days and those of no day; the rest stay as the first batch wrote them.
_WRITTEN_BY = f"""CASE WHEN ts IS NULL OR CAST(ts AS DATE) BETWEEN DATE '{C.REBUILT_FROM}' AND DATE '{C.REBUILT_TO}'
    THEN '{C.REBUILD_BATCH}' ELSE '{C.BATCH}' END"""
ORACLE["rebuilt_rejects"] = ORACLE["rebuilt_rejects"].replace(
    f"SELECT '{C.REBUILD_BATCH}' AS batch_id, rule_code", f"SELECT {_WRITTEN_BY} AS batch_id, rule_code", 1
)
