"""Wide stand-in tables built from the driver's star schema.

``blocks``  -- one row per order, regression-shaped (numeric label, a string
               category, natural nulls from orders without line items).
``clients`` -- one row per order, classification-shaped (integer-coded
               categories, a six-step wide series, a 0/1 label), every
               attribute an independent md5-derived value of the order key.

Both are plain joins and aggregations; Catalyst plans them.  The line-item
aggregate is keyed by ``l_orderkey`` so its output is already hash-partitioned
on the join key of the following join with ``orders`` (one exchange fewer).
Hot keys: the aggregate is partial (map-side) first, so a key holding a third
of all line items costs one row per map task; a hot customer in the
orders-customer join is split by AQE's skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.functions.expr import hex_hash_sql, safe_ratio
from tablefit.sources.tables import load, spread, spread_rows

SERIES = range(1, 7)  # six monthly steps, step 1 = newest


def blocks(spark: SparkSession, base_dir: str) -> DataFrame:
    orders = load(spark, base_dir, "orders")
    customer = load(spark, base_dir, "customer")
    lineitem = load(spark, base_dir, "lineitem")
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("qty"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_extendedprice").alias("ext"),
    )
    joined = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    )
    return joined.select(
        F.col("o_orderkey").alias("block_id"),
        F.col("o_totalprice").alias("total_value"),
        F.col("c_acctbal").alias("balance"),
        F.col("qty").alias("total_qty"),
        F.col("n_lines").alias("lines"),
        F.col("ext").alias("ext_price"),
        F.col("c_mktsegment").alias("category"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        safe_ratio("qty", "n_lines").alias("qty_per_line"),
        safe_ratio("ext", "qty").alias("price_per_qty"),
        safe_ratio("o_totalprice", "n_lines").alias("value_per_line"),
    )


def clients(spark: SparkSession, base_dir: str) -> DataFrame:
    orders = spread(load(spark, base_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    customer = load(spark, base_dir, "customer").select("c_custkey", "c_acctbal")
    # the count is of the file footers
    base = spread_rows(orders.join(customer, orders.o_custkey == customer.c_custkey), load(spark, base_dir, "orders").count())

    def hx(tag: str) -> str:
        return hex_hash_sql("o_orderkey", tag)

    # One projection written as SQL text: a single call composes all ~40
    # hash expressions (column-by-column composition costs a driver round
    # trip per function and dominated the planning time).
    cols = {
        "id": "o_orderkey",
        "limit_bal": "c_acctbal",
        "sex": f"CAST({hx('sex')} % 2 + 1 AS INT)",
        "education": f"CAST({hx('edu')} % 7 AS INT)",
        "marriage": f"CAST({hx('mar')} % 4 AS INT)",
        "age": f"CAST(18 + {hx('age')} % 52 AS INT)",
    }
    for i in SERIES:
        cols[f"pay_{i}"] = f"CAST({hx(f'pay{i}')} % 11 - 2 AS INT)"
    for i in SERIES:
        cols[f"bill_amt{i}"] = (f"CAST(CASE WHEN {hx(f'zero{i}')} % 10 = 0 THEN 0 "
                                f"ELSE {hx('bill')} % 100000 + {hx(f'bill{i}')} % 20000 END AS INT)")
    for i in SERIES:
        cols[f"pay_amt{i}"] = f"CAST({hx(f'amt{i}')} % 5000 AS INT)"
    draw = f"{hx('l')} % 10"
    cols["label"] = (f"CAST(CASE WHEN ({cols['pay_1']} >= 3 AND {draw} < 7) OR {draw} = 9 "
                     "THEN 1 ELSE 0 END AS INT)")
    return base.selectExpr(*[f"{expr} AS {name}" for name, expr in cols.items()])
