"""Registered queries for ordered sequences, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import sample as S
from quarry.operators import window as W
from quarry.plans.registry import SIG, register
from quarry.plans.sqlhelp import sql_hash_bits, sql_hash_unit
from quarry.plans.tabular import DAILY_SQL, daily
from quarry.session import table

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@register("diff_daily_total", f"""
WITH d AS ({DAILY_SQL})
SELECT o_orderdate, total, n, coalesce(total - lag(total) OVER (ORDER BY o_orderdate), 0.0) AS total_diff
FROM d
""", {"total": SIG, "total_diff": SIG})
def diff_daily_total(spark, sf):
    return W.diff(daily(spark, sf), ["o_orderdate"], "total")


@register("diff_events_per_user", """
SELECT event_id, ts, user_id, value,
       coalesce(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0.0) AS value_diff
FROM events
""", {"value_diff": SIG})
def diff_events_per_user(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    return W.diff(ev, ["ts", "event_id"], "value", by=["user_id"])


@register("sliding_sequences_daily", f"""
WITH d AS ({DAILY_SQL}),
r AS (SELECT row_number() OVER (ORDER BY o_orderdate) - 1 AS i, total FROM d)
SELECT s.i AS start, CAST(x.i - s.i AS BIGINT) AS step, x.total AS value, t.total AS target
FROM r s JOIN r x ON x.i BETWEEN s.i AND s.i + 4 JOIN r t ON t.i = s.i + 5
""", {"value": SIG, "target": SIG})
def sliding_sequences_daily(spark, sf):
    seqs = W.sliding_sequences(daily(spark, sf), ["o_orderdate"], ["total"], 5, "total")
    return seqs.select("start", F.posexplode("inputs").alias("step", "_x"), "target").select(
        "start", F.col("step").cast("bigint").alias("step"), F.col("_x.total").alias("value"), "target")


@register("chronological_split_daily", f"""
WITH d AS ({DAILY_SQL}),
r AS (SELECT o_orderdate, row_number() OVER (ORDER BY o_orderdate) - 1 AS pos, count(*) OVER () AS cnt FROM d)
SELECT o_orderdate, pos, CASE WHEN pos < floor(cnt * 0.9) THEN 'train' ELSE 'test' END AS split FROM r
""")
def chronological_split_daily(spark, sf):
    d = daily(spark, sf).select("o_orderdate")
    return W.chronological_split(d, ["o_orderdate"], 0.9)


@register("top3_customers_per_nation", """
SELECT c_custkey, c_nationkey, c_acctbal, CAST(rank AS INTEGER) AS rank FROM (
  SELECT c_custkey, c_nationkey, c_acctbal,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank
  FROM customer) WHERE rank <= 3
""")
def top3_customers_per_nation(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return W.top_k_per_key(c, ["c_nationkey"], "c_acctbal", 3, ["c_custkey"])


@register("hash_split_lineitem", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN {sql_hash_unit(42, LINE_KEY)} < 0.8 THEN 0 ELSE 1 END AS split
FROM lineitem
""")
def hash_split_lineitem(spark, sf):
    li = table(spark, sf, "lineitem").select(*LINE_KEY)
    return S.hash_split(li, LINE_KEY, [0.8, 0.2], seed=42)


@register("kfold_orders", f"""
SELECT o_orderkey, CAST({sql_hash_bits(42, ['o_orderkey'])} % 10 AS INTEGER) AS fold FROM orders
""")
def kfold_orders(spark, sf):
    return S.kfold(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 10, seed=42)


@register("sample_fraction_customer", f"""
SELECT * FROM customer WHERE {sql_hash_unit(7, ['c_custkey'])} < 0.8
""")
def sample_fraction_customer(spark, sf):
    return S.sample_fraction(table(spark, sf, "customer"), ["c_custkey"], 0.8, seed=7)


@register("sample_n_events", f"""
SELECT event_id, user_id, value, replicate FROM (
  SELECT e.event_id, e.user_id, e.value, CAST(r.replicate AS INTEGER) AS replicate,
         {sql_hash_bits(3, ['r.replicate', 'e.event_id'])} AS h
  FROM events e, (SELECT unnest(range(1, 51)) AS replicate) r)
QUALIFY row_number() OVER (PARTITION BY replicate ORDER BY h, event_id) <= 5
""")
def sample_n_events(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "value")
    return S.sample_n(ev, ["event_id"], 5, seed=3, replicates=50)


@register("sample_balanced_documents", f"""
SELECT doc_id, lang, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {sql_hash_bits(11, ['doc_id'])}, doc_id) <= 10
""")
def sample_balanced_documents(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return S.sample_balanced(d, "lang", ["doc_id"], 10, seed=11)
