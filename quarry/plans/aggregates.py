"""Registered queries for the descriptive aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import agg
from quarry.operators.sample import kfold
from quarry.plans.registry import SIG, register
from quarry.plans.sqlhelp import sql_hash_bits, union_all
from quarry.session import table

LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _describe_sql(tbl: str, cols: list[str], by: str | None = None) -> str:
    parts = []
    for c in cols:
        stats = [("count", f"count({c})"), ("mean", f"avg({c})"), ("std", f"stddev_samp({c})"),
                 ("min", f"min({c})"), ("25%", f"quantile_cont({c}, 0.25)"),
                 ("50%", f"quantile_cont({c}, 0.5)"), ("75%", f"quantile_cont({c}, 0.75)"),
                 ("max", f"max({c})")]
        for s, e in stats:
            key = f"{by}, " if by else ""
            grp = f" GROUP BY {by}" if by else ""
            parts.append(f"SELECT {key}'{c}' AS col_name, '{s}' AS stat, "
                         f"CAST({e} AS DOUBLE) AS value FROM {tbl}{grp}")
    return union_all(parts)


@register("describe_lineitem", _describe_sql("lineitem", LINE_MEASURES), {"value": SIG})
def describe_lineitem(spark, sf):
    return agg.describe(table(spark, sf, "lineitem"), LINE_MEASURES)


@register("describe_by_returnflag",
          _describe_sql("lineitem", ["l_quantity", "l_extendedprice"], "l_returnflag"),
          {"value": SIG})
def describe_by_returnflag(spark, sf):
    return agg.describe_by(table(spark, sf, "lineitem"), ["l_returnflag"],
                           ["l_quantity", "l_extendedprice"])


def _describe_basic_sql() -> str:
    parts = []
    for c in ["c_custkey", "c_nationkey", "c_acctbal"]:
        for s, e in (("count", f"count({c})"), ("mean", f"avg({c})"), ("std", f"stddev_samp({c})"),
                     ("min", f"min({c})"), ("max", f"max({c})")):
            parts.append(f"SELECT '{c}' AS col_name, '{s}' AS stat, CAST({e} AS DOUBLE) AS num_value, "
                         f"CAST(NULL AS VARCHAR) AS str_value FROM customer")
    for c in ["c_name", "c_mktsegment"]:
        parts.append(f"SELECT '{c}', 'count', CAST(count({c}) AS DOUBLE), CAST(NULL AS VARCHAR) FROM customer")
        parts.append(f"SELECT '{c}', 'min', CAST(NULL AS DOUBLE), min({c}) FROM customer")
        parts.append(f"SELECT '{c}', 'max', CAST(NULL AS DOUBLE), max({c}) FROM customer")
    return union_all(parts)


@register("describe_basic_customer", _describe_basic_sql(), {"num_value": SIG})
def describe_basic_customer(spark, sf):
    return agg.describe_basic(table(spark, sf, "customer"))


@register("summary_orders", """
SELECT 'o_totalprice' AS col_name, stat, value FROM (
  SELECT min(o_totalprice) AS "min", quantile_cont(o_totalprice, 0.25) AS q1,
         quantile_cont(o_totalprice, 0.5) AS median, avg(o_totalprice) AS mean,
         quantile_cont(o_totalprice, 0.75) AS q3, max(o_totalprice) AS "max" FROM orders
) UNPIVOT (value FOR stat IN ("min", q1, median, mean, q3, "max"))
""", {"value": SIG})
def summary_orders(spark, sf):
    return agg.summary(table(spark, sf, "orders"), ["o_totalprice"])


@register("col_sd_lineitem", union_all(
    [f"SELECT '{c}' AS col_name, stddev_samp({c}) AS sd FROM lineitem" for c in LINE_MEASURES]),
    {"sd": SIG})
def col_sd_lineitem(spark, sf):
    return agg.col_sd(table(spark, sf, "lineitem"), LINE_MEASURES)


@register("class_balance_lineitem", """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL
""")
def class_balance_lineitem(spark, sf):
    return agg.class_balance(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@register("crosstab_flag_status", """
PIVOT (SELECT l_returnflag, coalesce(l_linestatus, 'null') AS l_linestatus FROM lineitem)
ON l_linestatus USING count(*) GROUP BY l_returnflag
""")
def crosstab_flag_status(spark, sf):
    """Every level of the data is a column; a missing one counts as the level 'null'."""
    li = table(spark, sf, "lineitem").withColumn("l_linestatus", F.coalesce("l_linestatus", F.lit("null")))
    return agg.crosstab(li, "l_returnflag", "l_linestatus")


def _pair_sql(fn: str, name: str) -> str:
    parts = []
    for a in LINE_MEASURES:
        for b in LINE_MEASURES:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {fn}({a}, {b}) AS {name} FROM lineitem")
    return union_all(parts)


@register("corr_matrix_lineitem", _pair_sql("corr", "corr"), {"corr": 9})
def corr_matrix_lineitem(spark, sf):
    return agg.corr_matrix(table(spark, sf, "lineitem"), LINE_MEASURES)


@register("cov_matrix_lineitem", _pair_sql("covar_pop", "cov"), {"cov": SIG})
def cov_matrix_lineitem(spark, sf):
    return agg.cov_matrix(table(spark, sf, "lineitem"), LINE_MEASURES)


@register("mean_vector_lineitem", union_all(
    [f"SELECT '{c}' AS col_name, avg({c}) AS mean FROM lineitem" for c in LINE_MEASURES]),
    {"mean": SIG})
def mean_vector_lineitem(spark, sf):
    return agg.mean_vector(table(spark, sf, "lineitem"), LINE_MEASURES)


@register("filtered_mean_orders_since_1998", """
SELECT CAST(trunc(avg(o_totalprice)) AS BIGINT) AS mean_trunc, count(o_totalprice) AS n
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
""")
def filtered_mean_orders_since_1998(spark, sf):
    o = table(spark, sf, "orders")
    return agg.filtered_mean(o, "o_totalprice",
                             F.col("o_orderdate") >= F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))


@register("shape_lineitem", """
SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_cols FROM lineitem
""")
def shape_lineitem(spark, sf):
    return agg.shape(table(spark, sf, "lineitem"))


@register("tally_events", """
PIVOT (SELECT user_id, coalesce(event_type, 'null') AS event_type FROM events) ON event_type USING count(*) GROUP BY user_id
""")
def tally_events(spark, sf):
    """Every event type of the data is a column; a missing one counts as 'null'."""
    ev = table(spark, sf, "events").withColumn("event_type", F.coalesce("event_type", F.lit("null")))
    return agg.tally(ev, "user_id", "event_type")


@register("group_means_events", """
SELECT user_id, avg(value) AS mean, count(value) AS n FROM events GROUP BY user_id
""", {"mean": SIG})
def group_means_events(spark, sf):
    return agg.group_means(table(spark, sf, "events"), "user_id", "value")


@register("histogram_extendedprice", """
WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (
  SELECT CAST(least(CASE WHEN hi = lo THEN 0 ELSE floor((l_extendedprice - lo) / ((hi - lo) / 10)) END, 9)
              AS INTEGER) AS bin, count(*) AS n
  FROM lineitem, r WHERE l_extendedprice IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(unnest(range(0, CASE WHEN hi = lo THEN 1 ELSE 10 END)) AS INTEGER) AS bin, lo, hi FROM r)
SELECT g.bin, lo + g.bin * (CASE WHEN hi = lo THEN 0.0 ELSE (hi - lo) / 10 END) AS bin_lo,
       lo + (g.bin + 1) * (CASE WHEN hi = lo THEN 0.0 ELSE (hi - lo) / 10 END) AS bin_hi,
       CAST(coalesce(b.n, 0) AS BIGINT) AS n
FROM g LEFT JOIN b ON g.bin = b.bin
""", {"bin_lo": SIG, "bin_hi": SIG})
def histogram_extendedprice(spark, sf):
    return agg.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 10)


@register("bayesian_average_events", """
SELECT user_id, count(value) AS n, sum(value) AS total,
       (5.0 * 10.0 + coalesce(sum(value), 0)) / (5.0 + count(value)) AS bayes_avg
FROM events GROUP BY user_id
""", {"total": SIG, "bayes_avg": SIG})
def bayesian_average_events(spark, sf):
    return agg.bayesian_average(table(spark, sf, "events"), "user_id", "value", 10.0, 5.0)


C_GRID = [float(c) for c in range(0, 8)]
N_GRID = list(range(1, 8))


@register("bayesian_surface_events", f"""
WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
           FROM events),
ns AS (SELECT unnest({N_GRID}) AS n_cap),
cells AS (SELECT user_id, n_cap, count(*) AS n, sum(value) AS total
          FROM r JOIN ns ON r.rn <= ns.n_cap GROUP BY ALL),
cs AS (SELECT CAST(unnest({[int(c) for c in C_GRID]}) AS DOUBLE) AS C)
SELECT user_id, n_cap, C, n, (C * 10.0 + total) / (C + n) AS bayes_avg
FROM cells, cs WHERE C + n <> 0
""", {"bayes_avg": SIG})
def bayesian_surface_events(spark, sf):
    return agg.bayesian_surface(table(spark, sf, "events"), "user_id", "value", ["ts", "event_id"],
                                10.0, C_GRID, N_GRID)


@register("mean_std_error_events", """
SELECT user_id, count(value) AS n, avg(value) AS mean, stddev_pop(value) AS sd_pop,
       stddev_pop(value) / sqrt(count(value)) AS std_error
FROM events GROUP BY user_id
""", {"mean": SIG, "sd_pop": SIG, "std_error": SIG})
def mean_std_error_events(spark, sf):
    return agg.mean_std_error(table(spark, sf, "events"), "user_id", "value")


@register("chunk_mean_events", """
SELECT CAST(floor((rn - 1) / 100) AS BIGINT) AS chunk, avg(value) AS mean, count(*) AS n
FROM (SELECT value, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events) GROUP BY 1
""", {"mean": SIG})
def chunk_mean_events(spark, sf):
    return agg.chunk_mean(table(spark, sf, "events"), ["ts", "event_id"], "value", 100)


@register("best_order_by_price", """
SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1
""")
def best_order_by_price(spark, sf):
    return agg.best_by(table(spark, sf, "orders"), "o_totalprice", ["o_orderkey"])


@register("best_customer_per_nation", """
SELECT * FROM customer
QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) = 1
""")
def best_customer_per_nation(spark, sf):
    return agg.best_by(table(spark, sf, "customer"), "c_acctbal", ["c_custkey"], by=["c_nationkey"])


GRAM_X = ["l_quantity", "l_discount", "l_tax"]


def _gram_sql() -> str:
    fold = f"CAST({sql_hash_bits(42, LINE_KEY)} % 10 AS INTEGER)"
    base = f"SELECT {fold} AS fold, " + ", ".join(GRAM_X + ["l_extendedprice"]) + " FROM lineitem"
    names = GRAM_X + ["l_extendedprice"]
    parts = [f"SELECT fold, '{a}' AS col_a, '{b}' AS col_b, sum(CAST({a} AS DOUBLE) * {b}) AS s "
             f"FROM base GROUP BY fold" for a in names for b in names]
    parts.append("SELECT fold, '_n', '_n', CAST(count(*) AS DOUBLE) FROM base GROUP BY fold")
    return f"WITH base AS ({base})\n" + union_all(parts)


@register("gram_lineitem_folds", _gram_sql(), {"s": SIG})
def gram_lineitem_folds(spark, sf):
    li = kfold(table(spark, sf, "lineitem"), LINE_KEY, 10, seed=42)
    return agg.gram(li, GRAM_X, "l_extendedprice", fold="fold")
