"""Catalogue: loading, profiling, derived columns and splits (SQL oracles)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.operators import derive, profile, split
from tablefit.plans.registry import query
from tablefit.session import scratch_path
from tablefit.sources import (
    blocks,
    cast_like,
    clients,
    load,
    read_table,
    rename_strict,
    schema_frame,
    write_csv,
)

PAY = [f"pay_{i}" for i in range(1, 7)]
BILL = [f"bill_amt{i}" for i in range(1, 7)]


def prepared_clients(spark: SparkSession, base: str) -> DataFrame:
    """Clients after the recodes: education >3 -> 0, marriage 0 -> 3, pay <0 -> 0."""
    df = clients(spark, base)
    df = derive.recode_above_threshold(df, "education", 3, 0)
    df = derive.recode_values(df, "marriage", {0: 3})
    return derive.clamp_columns(df, PAY, 0)


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- sources ----

@query("row_count", "A1", "SELECT count(*) AS n_rows FROM orders")
def q_row_count(spark, base):
    return profile.row_count(load(spark, base, "orders"))


@query("csv_roundtrip", "S1,S2,P4", "SELECT * FROM clients")
def q_csv_roundtrip(spark, base):
    """Write clients as a raw CSV (headers as delivered: pay_0, default), read it
    back with header + inference, repair the schema by strict rename + cast."""
    src = clients(spark, base)
    raw = src.withColumnsRenamed({"pay_1": "pay_0", "label": "default"})
    path = write_csv(raw, scratch_path(spark, "clients-csv"))
    loaded = read_table(spark, path, fmt="csv", header=True, infer_schema=True)
    repaired = rename_strict(loaded, {"pay_0": "pay_1",
                                      "label": ["default", "default.payment.next.month"]})
    return cast_like(repaired, src.schema)


@query("csv_schema_read", "S1", "SELECT * FROM clients")
def q_csv_schema_read(spark, base):
    """The production route: a ';'-separated CSV read with an explicit schema
    (no inference pass over the file)."""
    src = clients(spark, base)
    path = write_csv(src, scratch_path(spark, "clients-csv-sep"), sep=";")
    return read_table(spark, path, fmt="csv", schema=src.schema, header=True, sep=";")


@query("csv_reordered_header", "S1",
       "SELECT o_orderkey AS id, o_totalprice AS total, o_orderstatus AS status FROM orders")
def q_csv_reordered_header(spark, base):
    """A file whose header has the schema's columns in another order: they are taken by name."""
    src = load(spark, base, "orders").selectExpr("o_orderstatus AS status", "o_totalprice AS total", "o_orderkey AS id")
    path = write_csv(src, scratch_path(spark, "orders-csv"))
    return read_table(spark, path, fmt="csv", schema="id BIGINT, total DOUBLE, status STRING", header=True)


@query("schema_orders", "S5",
       "SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS column, "
       "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' "
       "WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS type, "
       "\"null\" = 'YES' AS nullable FROM (DESCRIBE SELECT * FROM orders)")
def q_schema_orders(spark, base):
    return schema_frame(spark, load(spark, base, "orders"))


@query("preview_first", "S7,O3,P2", "SELECT * FROM clients ORDER BY id LIMIT 5")
def q_preview_first(spark, base):
    return profile.preview(clients(spark, base), 5, order_by=["id"])


# ---------------------------------------------------------------- profile ----

@query("filtered_count", "P1,A2", "SELECT count(*) AS n_rows FROM blocks WHERE total_value > 200000")
def q_filtered_count(spark, base):
    return profile.where_count(blocks(spark, base), "total_value > 200000")


@query("filtered_counts", "A2,P6",
       "SELECT count(*) AS n_total, count(*) FILTER (WHERE total_value > 200000) AS n_large, "
       "count(*) FILTER (WHERE lines IS NULL) AS n_no_lines, "
       "count(*) FILTER (WHERE balance < 0) AS n_negative_balance FROM blocks")
def q_filtered_counts(spark, base):
    return profile.filtered_counts(blocks(spark, base), {
        "n_large": "total_value > 200000",
        "n_no_lines": F.col("lines").isNull(),
        "n_negative_balance": "balance < 0",
    })


SUMMARY_COLS = ["total_value", "balance", "total_qty", "lines"]


@query("summary_stats", "A3", _union([
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM blocks"
    for c in SUMMARY_COLS]))
def q_summary_stats(spark, base):
    out = profile.summary(blocks(spark, base), SUMMARY_COLS)
    return profile.with_rounded(out, {"mean": 6, "stddev": 6})


@query("global_extremes", "A4",
       "SELECT max(total_value) AS max_value, min(balance) AS min_balance, "
       "round(avg(total_qty), 6) AS avg_qty FROM blocks")
def q_global_extremes(spark, base):
    out = profile.aggregate(blocks(spark, base), [
        ("max", "total_value", "max_value"), ("min", "balance", "min_balance"), ("avg", "total_qty", "avg_qty")])
    return profile.with_rounded(out, {"avg_qty": 6})


@query("category_counts", "A5,O1",
       "SELECT category, count(*) AS count FROM blocks GROUP BY category ORDER BY count DESC, category")
def q_category_counts(spark, base):
    return profile.category_counts(blocks(spark, base), "category")


GROUP_MEAN_SQL = "SELECT category, round(avg(total_value), 6) AS avg_value FROM blocks GROUP BY category"


@query("group_mean", "A6,P12", GROUP_MEAN_SQL)
def q_group_mean(spark, base):
    out = profile.group_mean(blocks(spark, base), "category", "total_value", "avg_value")
    return profile.with_rounded(out, {"avg_value": 6})


@query("group_mean_sql", "A7,S3,S4", GROUP_MEAN_SQL)
def q_group_mean_sql(spark, base):
    out = profile.group_mean_sql(spark, blocks(spark, base), "category", "total_value", "avg_value")
    return profile.with_rounded(out, {"avg_value": 6})


CLIENT_SUMMARY_COLS = ["limit_bal", "age", "pay_1"]


@query("summary_clients", "A3", _union([
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM clients_prep"
    for c in CLIENT_SUMMARY_COLS]))
def q_summary_clients(spark, base):
    out = profile.summary(prepared_clients(spark, base), CLIENT_SUMMARY_COLS)
    return profile.with_rounded(out, {"mean": 6, "stddev": 6})


@query("group_mean_education", "A6,P7",
       "SELECT education, round(avg(limit_bal), 6) AS limit_bal_mean FROM clients_prep GROUP BY education")
def q_group_mean_education(spark, base):
    out = profile.group_mean(prepared_clients(spark, base), "education", "limit_bal", "limit_bal_mean")
    return profile.with_rounded(out, {"limit_bal_mean": 6})


CONTINGENCY_ATTRS = ["education", "marriage", "sex"]


@query("contingency", "A8,O2", _union([
    f"SELECT label, '{a}' AS attribute, {a} AS value, count(*) AS count FROM clients_prep GROUP BY label, {a}"
    for a in CONTINGENCY_ATTRS]))
def q_contingency(spark, base):
    return profile.contingency(prepared_clients(spark, base), "label", CONTINGENCY_ATTRS)


BLOCK_COLS = ["block_id", "total_value", "balance", "total_qty", "lines", "ext_price", "category",
              "status", "priority", "qty_per_line", "price_per_qty", "value_per_line"]
_FLOATING = {"total_value", "balance", "total_qty", "ext_price", "qty_per_line", "price_per_qty",
             "value_per_line"}


@query("missing_counts", "A9,P6,S6", _union([
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
    + (f"count(*) FILTER (WHERE isnan({c})) AS n_nan" if c in _FLOATING else "0::BIGINT AS n_nan")
    + " FROM blocks" for c in BLOCK_COLS]))
def q_missing_counts(spark, base):
    df = blocks(spark, base)
    return profile.missing(df, df.columns)


DISTINCT_COLS = ["sex", "education", "marriage", "age", "pay_1", "bill_amt1"]


@query("distinct_counts", "A10", _union([
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM clients" for c in DISTINCT_COLS]))
def q_distinct_counts(spark, base):
    return profile.distinct_counts(clients(spark, base), DISTINCT_COLS)


CORR_COLS = PAY + ["label"]


@query("correlation_long", "A11,F1,S8", _union([
    f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 10) AS corr FROM clients_prep"
    for x in CORR_COLS for y in CORR_COLS]))
def q_correlation_long(spark, base):
    out = profile.correlation_long(prepared_clients(spark, base), CORR_COLS, via="matrix")
    return profile.with_rounded(out, {"corr": 10})


# The four correlation blocks of the credit analysis (attributes,
# repayment status, bill amounts, payment amounts), each with the label.
CORR_BLOCKS = {
    "attributes": ["limit_bal", "age", "education", "sex", "marriage", "label"],
    "pay": PAY + ["label"],
    "bill": BILL + ["label"],
    "pay_amt": [f"pay_amt{i}" for i in range(1, 7)] + ["label"],
}


@query("correlation_blocks", "A11,F1,S8", _union([
    f"SELECT '{b}' AS block, '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 10) AS corr FROM clients_prep"
    for b, cols in CORR_BLOCKS.items() for x in cols for y in cols]))
def q_correlation_blocks(spark, base):
    out = profile.correlation_blocks(prepared_clients(spark, base), CORR_BLOCKS)
    return profile.with_rounded(out, {"corr": 10})


@query("correlation_agg", "A11", _union([
    f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 10) AS corr FROM clients"
    for x in BILL for y in BILL]))
def q_correlation_agg(spark, base):
    out = profile.correlation_long(clients(spark, base), BILL, via="agg")
    return profile.with_rounded(out, {"corr": 10})


# ----------------------------------------------------------------- derive ----

@query("ratio_columns", "P3",
       "SELECT block_id, round(total_qty / nullif(lines, 0), 6) AS qty_per_line, "
       "round(ext_price / nullif(total_qty, 0), 6) AS price_per_qty, "
       "round(total_value / nullif(lines, 0), 6) AS value_per_line FROM blocks")
def q_ratio_columns(spark, base):
    df = blocks(spark, base).select("block_id", "total_qty", "lines", "ext_price", "total_value")
    out = derive.ratios(df, {
        "qty_per_line": ("total_qty", "lines"),
        "price_per_qty": ("ext_price", "total_qty"),
        "value_per_line": ("total_value", "lines"),
    }).select("block_id", "qty_per_line", "price_per_qty", "value_per_line")
    return profile.with_rounded(out, {"qty_per_line": 6, "price_per_qty": 6, "value_per_line": 6})


@query("rename_label", "P2,P4,P12", "SELECT block_id, total_value AS label, category FROM blocks")
def q_rename_label(spark, base):
    df = rename_strict(blocks(spark, base), {"total_value": "label"})
    return df.select("block_id", "label", "category")


@query("recode_education", "P7",
       "SELECT id, CASE WHEN education > 3 THEN 0 ELSE education END AS education FROM clients")
def q_recode_education(spark, base):
    return derive.recode_above_threshold(clients(spark, base), "education", 3, 0).select("id", "education")


@query("recode_marriage", "P8",
       "SELECT id, CASE WHEN marriage = 0 THEN 3 ELSE marriage END AS marriage FROM clients")
def q_recode_marriage(spark, base):
    return derive.recode_values(clients(spark, base), "marriage", {0: 3}).select("id", "marriage")


@query("clamp_pay", "P9,P10,P11",
       "SELECT id, " + ", ".join(f"CASE WHEN pay_{i} < 0 THEN 0 ELSE pay_{i} END AS pay_{i}" for i in range(1, 7))
       + " FROM clients")
def q_clamp_pay(spark, base):
    return derive.clamp_columns(clients(spark, base), PAY, 0).select("id", *PAY)


@query("age_class", "P13",
       "SELECT id, age, CASE WHEN age >= 55 THEN 4 WHEN age >= 45 THEN 3 WHEN age >= 35 THEN 2 "
       "WHEN age >= 25 THEN 1 WHEN age >= 20 THEN 0 END AS age_class FROM clients")
def q_age_class(spark, base):
    return derive.age_class(clients(spark, base)).select("id", "age", "age_class")


@query("pay_mean", "P14",
       "SELECT id, round((pay_1 + pay_2 + pay_3 + pay_4 + pay_5 + pay_6) / 6.0::DOUBLE, 6) AS pay_mean FROM clients_prep")
def q_pay_mean(spark, base):
    out = derive.row_mean(prepared_clients(spark, base), PAY, "pay_mean").select("id", "pay_mean")
    return profile.with_rounded(out, {"pay_mean": 6})


@query("bill_change", "P15,P16",
       "SELECT id, " + ", ".join(
           f"round(CASE WHEN bill_amt{i} = 0 THEN -2.0::DOUBLE ELSE (bill_amt{i + 1} - bill_amt{i}) / bill_amt{i} END, 8)"
           f" AS bill_change{i}" for i in range(1, 6)) + " FROM clients")
def q_bill_change(spark, base):
    out = derive.relative_change(clients(spark, base), BILL, "bill_change", newest_first=True)
    cols = [f"bill_change{i}" for i in range(1, 6)]
    return profile.with_rounded(out.select("id", *cols), {c: 8 for c in cols})


# ------------------------------------------------------------------ split ----

@query("hash_split", "D2",
       "SELECT block_id, bucket, CASE WHEN bucket < 80 THEN 'train' ELSE 'test' END AS split FROM blocks_split")
def q_hash_split(spark, base):
    df = blocks(spark, base).select("block_id")
    df = df.withColumn("bucket", split.split_bucket("block_id"))
    return split.with_split(df, "block_id")


@query("hash_folds", "D2,T2",
       "SELECT id, CAST(('0x' || substr(md5(id::VARCHAR || ':fold'), 1, 8))::BIGINT % 4 AS INTEGER) AS fold "
       "FROM clients")
def q_hash_folds(spark, base):
    return split.with_folds(clients(spark, base).select("id"), "id", 4)


@query("random_split", "D1", "SELECT count(*) AS n_rows, 0::BIGINT AS n_overlap FROM clients")
def q_random_split(spark, base):
    """Rows of both parts together, and keys that are in both."""
    train, test = split.random_split(clients(spark, base).select("id"), [0.8, 0.2], seed=1234)
    parts = train.withColumn("part", F.lit(1)).unionAll(test.withColumn("part", F.lit(2)))
    by_key = parts.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("part").alias("k"))
    return by_key.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("k") > 1).alias("n_overlap"))


@query("correlation_agg_nulls", "A11",
       "SELECT 'ext_price' AS x, 'total_value' AS y, round(corr(ext_price, total_value), 8) AS corr FROM blocks "
       "UNION ALL SELECT 'total_value', 'ext_price', round(corr(ext_price, total_value), 8) FROM blocks "
       "UNION ALL SELECT 'ext_price', 'ext_price', 1.0 UNION ALL SELECT 'total_value', 'total_value', 1.0")
def q_correlation_agg_nulls(spark, base):
    """A column with nulls: each pair over the rows that have both values."""
    out = profile.correlation_long(blocks(spark, base), ["ext_price", "total_value"], via="agg")
    return profile.with_rounded(out, {"corr": 8})
