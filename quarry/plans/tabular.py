"""Registered queries for projections, filters, reshaping and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.numeric import claim_error_pct, rate
from quarry.functions.text import era_year, numeric_cast
from quarry.operators import project as P
from quarry.plans.registry import SIG, register
from quarry.session import table


@register("reorder_orders_target_last", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus FROM orders
""")
def reorder_orders_target_last(spark, sf):
    o = table(spark, sf, "orders")
    return P.reorder(o, ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                         "o_orderpriority"], target="o_orderstatus")


@register("features_of_customer", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer
""")
def features_of_customer(spark, sf):
    return P.features_of(table(spark, sf, "customer"), "c_mktsegment")


@register("numeric_columns_part", """
SELECT p_partkey, p_size, p_retailprice FROM part
""")
def numeric_columns_part(spark, sf):
    return P.numeric_columns(table(spark, sf, "part"))


@register("orders_since_1998", """
SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
""")
def orders_since_1998(spark, sf):
    o = table(spark, sf, "orders")
    return P.since(o, "o_orderdate", F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))


_CUST_ORDERS = """
SELECT c.c_custkey, c.c_nationkey, s.n_orders, s.total_price
FROM customer c LEFT JOIN (
  SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total_price FROM orders GROUP BY o_custkey
) s ON c.c_custkey = s.o_custkey
"""


def _cust_orders(spark, sf):
    stats = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total_price"))
    c = table(spark, sf, "customer")
    return c.join(stats, c.c_custkey == stats.o_custkey, "left").select(
        "c_custkey", "c_nationkey", "n_orders", "total_price")


@register("drop_nulls_customer_orders", f"""
SELECT * FROM ({_CUST_ORDERS}) WHERE n_orders IS NOT NULL AND total_price IS NOT NULL
""", {"total_price": SIG})
def drop_nulls_customer_orders(spark, sf):
    return P.drop_nulls(_cust_orders(spark, sf))


@register("fill_nulls_customer_orders", f"""
SELECT c_custkey, c_nationkey, coalesce(n_orders, 0) AS n_orders, coalesce(total_price, 0.0) AS total_price
FROM ({_CUST_ORDERS})
""", {"total_price": SIG})
def fill_nulls_customer_orders(spark, sf):
    return P.fill_nulls(_cust_orders(spark, sf), 0)


@register("binary_label_lineitem", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(l_returnflag = 'R', false) AS label FROM lineitem
""")
def binary_label_lineitem(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                            "l_returnflag")
    return P.binary_label(li, F.col("l_returnflag") == "R").drop("l_returnflag")


_NATION_RATES = """
SELECT n.n_name, coalesce(o.n_orders, 0) AS n_orders, coalesce(c.n_customers, 0) AS n_customers
FROM nation n
LEFT JOIN (SELECT c_nationkey, count(*) AS n_customers FROM customer GROUP BY c_nationkey) c
  ON n.n_nationkey = c.c_nationkey
LEFT JOIN (SELECT c_nationkey, count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey
           GROUP BY c_nationkey) o ON n.n_nationkey = o.c_nationkey
"""


def nation_counts(spark, sf):
    """Orders and customers per nation (both aggregated before the joins)."""
    c = table(spark, sf, "customer")
    o = table(spark, sf, "orders")
    per_c = c.groupBy(F.col("c_nationkey").alias("_nk_c")).agg(F.count(F.lit(1)).alias("n_customers"))
    per_o = (o.join(c.select("c_custkey", "c_nationkey"), o.o_custkey == c.c_custkey)
             .groupBy(F.col("c_nationkey").alias("_nk_o")).agg(F.count(F.lit(1)).alias("n_orders")))
    n = table(spark, sf, "nation")
    return (n.join(per_c, n.n_nationkey == per_c._nk_c, "left")
            .join(per_o, n.n_nationkey == per_o._nk_o, "left")
            .select("n_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
                    F.coalesce("n_customers", F.lit(0)).alias("n_customers")))


@register("rate_orders_per_customer", f"""
SELECT n_name, n_orders, n_customers,
       n_orders / nullif(CAST(n_customers AS DOUBLE), 0) AS rate,
       round_even(n_orders / nullif(CAST(n_customers AS DOUBLE), 0), 4) AS rate_rounded
FROM ({_NATION_RATES})
""", {"rate": SIG})
def rate_orders_per_customer(spark, sf):
    d = nation_counts(spark, sf)
    return d.select("n_name", "n_orders", "n_customers", rate("n_orders", "n_customers").alias("rate"),
                    rate("n_orders", "n_customers", 4).alias("rate_rounded"))


@register("claim_error_nation_rates", f"""
SELECT n_name, claimed, actual,
       (claimed - actual) / (CASE WHEN claimed <> 0 THEN claimed END) * 100 AS error_pct,
       claimed = 0 AS zero_claim
FROM (SELECT n_name, round_even(n_orders / nullif(CAST(n_customers AS DOUBLE), 0), 1) AS claimed,
             n_orders / nullif(CAST(n_customers AS DOUBLE), 0) AS actual FROM ({_NATION_RATES}))
""", {"actual": SIG, "error_pct": SIG})
def claim_error_nation_rates(spark, sf):
    d = nation_counts(spark, sf)
    r = d.select("n_name", rate("n_orders", "n_customers", 1).alias("claimed"),
                 rate("n_orders", "n_customers").alias("actual"))
    return r.select("n_name", "claimed", "actual", claim_error_pct("claimed", "actual").alias("error_pct"),
                    (F.col("claimed") == 0).alias("zero_claim"))


DAILY_SQL = "SELECT o_orderdate, sum(o_totalprice) AS total, count(*) AS n FROM orders GROUP BY o_orderdate"


def daily(spark, sf):
    """The order book as a daily series: one row per date."""
    return table(spark, sf, "orders").groupBy("o_orderdate").agg(
        F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n"))


@register("head_tail_daily", f"""
WITH d AS ({DAILY_SQL}),
r AS (SELECT *, row_number() OVER (ORDER BY o_orderdate) - 1 AS i, count(*) OVER () AS cnt FROM d)
SELECT o_orderdate, total, n, CAST(CASE WHEN i < 3 THEN i ELSE i - cnt END AS INTEGER) AS pos
FROM r WHERE i < 3 OR (i >= cnt - 4 AND i < cnt - 1)
""", {"total": SIG})
def head_tail_daily(spark, sf):
    return P.head_tail(daily(spark, sf), ["o_orderdate"], 3, -4, -1)


@register("bind_columns_documents", """
SELECT doc_id, lang = 'en' AS label, translate(text, '!"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~', '') AS text
FROM documents
""")
def bind_columns_documents(spark, sf):
    from quarry.functions.text import strip_punctuation
    d = table(spark, sf, "documents")
    return P.bind_columns(d, {"doc_id": F.col("doc_id"), "label": F.col("lang") == "en",
                              "text": strip_punctuation("text")})


@register("numeric_cast_orders", """
SELECT o_orderkey, txt, CAST(replace(trim(txt), ',', '') AS BIGINT) AS parsed
FROM (SELECT o_orderkey, format('{:,}', o_orderkey * 1000 + o_custkey) AS txt FROM orders)
""")
def numeric_cast_orders(spark, sf):
    o = table(spark, sf, "orders")
    t = o.select("o_orderkey", F.format_number(F.col("o_orderkey") * 1000 + F.col("o_custkey"), 0).alias("txt"))
    return t.withColumn("parsed", numeric_cast("txt"))


@register("expand_grid_customer", """
SELECT c_mktsegment, -1000.0 + i * (11000.0 / 99) AS c_acctbal,
       (SELECT avg(CAST(c_nationkey AS DOUBLE)) FROM customer) AS c_nationkey
FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL), range(0, 100) t(i)
""", {"c_acctbal": SIG, "c_nationkey": SIG})
def expand_grid_customer(spark, sf):
    return P.expand_grid(table(spark, sf, "customer"), "c_acctbal", -1000.0, 10000.0, 100,
                         "c_mktsegment", ["c_nationkey"])


@register("unpivot_pairs_lineitem", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, slot, amount, share FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 0 AS slot, l_quantity AS amount, l_discount AS share
  FROM lineitem
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 1, l_extendedprice, l_tax FROM lineitem
) WHERE amount IS NOT NULL OR share IS NOT NULL
""")
def unpivot_pairs_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    return P.unpivot_pairs(li, [("l_quantity", "l_discount"), ("l_extendedprice", "l_tax")],
                           ["amount", "share"], ids=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@register("transpose_yearly_orders", """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS name, CAST(count(*) AS VARCHAR) AS value
FROM orders GROUP BY year(o_orderdate)
""")
def transpose_yearly_orders(spark, sf):
    o = table(spark, sf, "orders").withColumn(
        "_col", F.concat(F.year("o_orderdate").cast("string"), F.lit(" Census")))
    wide = o.groupBy().pivot("_col").agg(F.count(F.lit(1)))
    return P.transpose_row(wide, wide.columns, suffix=" Census")


@register("preview_orders_by_price", """
SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5
""")
def preview_orders_by_price(spark, sf):
    return P.preview(table(spark, sf, "orders"), [F.desc("o_totalprice"), "o_orderkey"], 5)


@register("rank_nations_by_rate", f"""
SELECT n_name, rate, CAST(rank() OVER (ORDER BY rate DESC) AS BIGINT) AS rank FROM (
  SELECT n_name, n_orders / nullif(CAST(n_customers AS DOUBLE), 0) AS rate FROM ({_NATION_RATES}))
WHERE rate IS NOT NULL
UNION ALL
SELECT n_name, NULL, NULL FROM ({_NATION_RATES}) WHERE n_customers = 0
""", {"rate": SIG})
def rank_nations_by_rate(spark, sf):
    d = nation_counts(spark, sf).select("n_name", rate("n_orders", "n_customers").alias("rate"))
    return P.rank_desc(d, "rate", ["n_name"])


@register("era_year_orders", """
SELECT o_orderkey, txt, CAST(regexp_replace(trim(txt), '(\\d+)\\s*BC', '-\\1') AS INTEGER) AS year
FROM (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT'
                              THEN concat(' ', CAST(year(o_orderdate) AS VARCHAR), ' BC ')
                              ELSE concat(' ', CAST(year(o_orderdate) AS VARCHAR), ' ') END AS txt
      FROM orders)
""")
def era_year_orders(spark, sf):
    o = table(spark, sf, "orders")
    y = F.year("o_orderdate").cast("string")
    t = o.select("o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT",
                                      F.concat(F.lit(" "), y, F.lit(" BC ")))
                 .otherwise(F.concat(F.lit(" "), y, F.lit(" "))).alias("txt"))
    return t.withColumn("year", era_year("txt"))
