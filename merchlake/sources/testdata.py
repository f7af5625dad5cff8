"""The raw order, product and marketplace tables derived from the given star-schema tables.

Orders come from lineitem, orders, customer and nation, products from part. Defects are put in
by integer arithmetic over the keys, one class per cleansing rule, so that another engine can
derive the same rows from the same files. All rows of the given tables take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake import schemas as S

# Spreads the defect classes over the rows.
DEFECT_KEY = (
    "(l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7 + cast(l_quantity as bigint)) % 1000"
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """13 text columns, one row per order line, plus exact copies for R02."""
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.expr("cast(l_quantity as int)").alias("qty"),
        F.expr("cast(l_extendedprice as decimal(12,2))").alias("price"),
        F.expr(
            "cast(cast(l_discount as decimal(4,2)) * 100 * cast(l_quantity as int) as decimal(12,2))"
        ).alias("disc"),
        F.expr(DEFECT_KEY).alias("h"),
    )
    heads = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        F.expr("cast(cast(o_orderdate as date) as string)").alias("ds"),
        F.expr(
            "format_string('%02d:%02d:%02d', 8 + o_orderkey % 12, o_orderkey * 7 % 60, o_orderkey * 13 % 60)"
        ).alias("tod"),
    )
    buyers = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # Buyers join the orders, which are fewer than their lines, so that lines move once.
    bought = heads.join(buyers, heads.o_custkey == buyers.c_custkey).join(
        nations, buyers.c_nationkey == nations.n_nationkey
    )
    wide = lines.join(bought, lines.l_orderkey == bought.o_orderkey)
    return wide.selectExpr(
        "cast(l_orderkey as string) AS order_id",
        """case when h < 15 then 'no time'
                when h < 125 then concat(replace(ds, '-', '/'), ' ', left(tod, 5))
                when h < 160 then concat(ds, 'T', tod)
                else concat(ds, ' ', tod) end AS order_time""",
        "cast(o_custkey as string) AS user_id",
        """case when h between 600 and 602 then concat('X', l_partkey)
                else cast(l_partkey as string) end AS product_id""",
        "c_mktsegment AS channel",
        """case when h between 200 and 209 then '' when h between 210 and 212 then ' '
                else n_name end AS province""",
        """case when h between 205 and 216 then ' '
                else concat(n_name, '_C', c_custkey % 7) end AS city""",
        """case h when 300 then '0' when 301 then '-1' when 302 then '99999'
                when 303 then 'abc' when 304 then '1.5' else cast(qty as string) end AS quantity""",
        """case h when 310 then '0.00' when 311 then concat('-', price)
                when 312 then 'n/a' else cast(price as string) end AS unit_price""",
        "case h when 320 then cast(null as string) else cast(disc as string) end AS discount_amount",
        """case when h between 400 and 409 then cast(cast(qty * price + 7.00 as decimal(14,2)) as string)
                when h = 410 then cast(null as string)
                when h = 411 then cast(cast(qty * price - disc + 0.01 as decimal(14,2)) as string)
                when h = 412 then cast(cast(qty * price - disc - 0.02 as decimal(14,2)) as string)
                else cast(cast(qty * price - disc as decimal(14,2)) as string) end AS pay_amount""",
        f"""case when l_orderkey % 250 = 0 then '???'
                when o_orderstatus = 'F' then '{S.STATUS_DONE}'
                when o_orderstatus = 'O' then '{S.STATUS_PAID}'
                when l_orderkey % 4 = 0 then '{S.STATUS_UNPAID}'
                when l_orderkey % 4 = 1 then '{S.STATUS_CANCELLED}'
                when l_orderkey % 4 = 2 then '{S.STATUS_REFUNDED}'
                else '{S.STATUS_UNFULFILLED}' end AS order_status""",
        """case when h between 217 and 228 then cast(null as string)
                else o_orderpriority end AS pay_type""",
        "explode(sequence(1, case when h between 500 and 511 then 2 else 1 end)) AS copy_no",
    ).select(*S.ORDER_FIELDS)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """7 text columns. Some products come twice with different brands, some labels are blank."""
    return (
        _table(spark, sf_dir, "part")
        .selectExpr(
            "p_partkey",
            "p_name",
            "p_type",
            "p_brand",
            "cast(p_retailprice as decimal(12,2)) AS cost",
            "explode(sequence(1, case when p_partkey % 211 = 5 then 2 else 1 end)) AS version",
        )
        .selectExpr(
            "cast(p_partkey as string) AS product_id",
            "p_name AS product_name",
            "case when p_partkey % 101 = 7 then ' ' else concat('C_', p_type) end AS category_id",
            "case when p_partkey % 101 = 7 then '' else p_type end AS category_name",
            """case when p_partkey % 97 = 3 then cast(null as string)
                    when version = 2 then concat(p_brand, '_old') else p_brand end AS brand""",
            "cast(cost as string) AS cost_price",
            "'2025-01-01' AS launch_date",
        )
    )


def market_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six marketplace tables, all columns text."""
    lines = _table(spark, sf_dir, "lineitem")
    nothing = "cast(null as string) AS {}"
    items = lines.selectExpr(
        "cast(l_orderkey as string) AS order_id",
        "cast(l_linenumber as string) AS order_item_id",
        "cast(l_partkey as string) AS product_id",
        "cast(l_suppkey as string) AS seller_id",
        "cast(cast(l_shipdate as date) as string) AS shipping_limit_date",
        "cast(cast(l_extendedprice as decimal(12,2)) as string) AS price",
        "cast(cast(l_tax * 100 as decimal(12,2)) as string) AS freight_value",
    )
    orders = _table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) AS order_id",
        "cast(o_custkey as string) AS customer_id",
        """case when o_orderstatus = 'F' then 'delivered'
                else element_at(array('shipped', 'invoiced', 'processing', 'approved', 'created',
                                      'canceled', 'unavailable', 'on_hold'),
                                cast(o_orderkey % 8 as int) + 1) end AS order_status""",
        "concat(cast(cast(o_orderdate as date) as string), ' 10:00:00') AS order_purchase_timestamp",
        nothing.format("order_approved_at"),
        nothing.format("order_delivered_carrier_date"),
        nothing.format("order_delivered_customer_date"),
        nothing.format("order_estimated_delivery_date"),
    )
    buyers = _table(spark, sf_dir, "customer")
    nations = _table(spark, sf_dir, "nation")
    customers = buyers.join(nations, buyers.c_nationkey == nations.n_nationkey).selectExpr(
        "cast(c_custkey as string) AS customer_id",
        "concat('U', cast(floor(c_custkey / 2) as bigint)) AS customer_unique_id",
        "cast(c_nationkey as string) AS customer_zip_code_prefix",
        "concat(n_name, '_C', c_custkey % 7) AS customer_city",
        "n_name AS customer_state",
    )
    part = _table(spark, sf_dir, "part")
    sizes = [f for f in S.MARKET_FIELDS["products"] if f not in ("product_id", "product_category_name")]
    products = part.selectExpr(
        "cast(p_partkey as string) AS product_id",
        "case when p_partkey % 50 = 0 then cast(null as string) else p_type end AS product_category_name",
        *[nothing.format(f) for f in sizes],
    )
    # One native name has no translation, one has a blank one.
    categories = (
        part.select("p_type")
        .distinct()
        .selectExpr(
            "p_type AS product_category_name",
            """case p_type when 'PROMO' then cast(null as string) when 'SMALL' then ' '
                    else lower(p_type) end AS product_category_name_english""",
        )
    )
    payments = lines.selectExpr(
        "cast(l_orderkey as string) AS order_id",
        "cast(l_linenumber as string) AS payment_sequential",
        """case concat(l_returnflag, l_linestatus)
                when 'AF' then 'credit_card' when 'AO' then 'debit_card' when 'NF' then 'boleto'
                when 'NO' then 'voucher' when 'RF' then 'not_defined' else 'cash' end AS payment_type""",
        "'1' AS payment_installments",
        "cast(cast(l_extendedprice as decimal(12,2)) as string) AS payment_value",
    )
    return {
        "orders": orders,
        "items": items,
        "customers": customers,
        "products": products,
        "payments": payments,
        "categories": categories,
    }
