"""Registered queries for data preparation (SURVEY S6, S7, F3, J1, U1, W4-W6,
X1, X2, X4-X6, Q1, Q8)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.numeric import claim_error_pct, hash_unit
from quarry.operators import features as X
from quarry.operators import window as W
from quarry.operators.classify import index_categories, one_hot
from quarry.operators.project import rank_desc
from quarry.operators.reconcile import reconcile, reconcile_many
from quarry.operators.sample import hash_split
from quarry.plans.registry import SIG, register
from quarry.plans.sqlhelp import sql_hash_unit
from quarry.plans.text import _sql_basic_tokens
from quarry.session import table
from quarry.sources.files import materialize

# ------------------------------------------ language-model dataset (Q8: W4-W6)

BSZ = 20
BPTT = 35

_BATCH_SQL = f"""
tok AS (SELECT doc_id, unnest({_sql_basic_tokens('text')}) AS token,
               CAST(generate_subscripts({_sql_basic_tokens('text')}, 1) - 1 AS INTEGER) AS tpos FROM documents),
idx AS (SELECT *, row_number() OVER (ORDER BY doc_id, tpos) - 1 AS i FROM tok),
sl AS (SELECT floor(count(*) / {BSZ}) AS sl FROM tok),
b AS (SELECT doc_id, tpos, token, CAST(floor(i / sl) AS INTEGER) AS batch, CAST(i % sl AS BIGINT) AS pos
      FROM idx, sl WHERE i < sl * {BSZ})
"""


def _token_lines(spark, sf):
    """Each document's tokens in one string: they hold no blank, and an array takes several times the room."""
    docs = table(spark, sf, "documents")
    return materialize(docs.select("doc_id", F.array_join(T.basic_tokens("text"), " ").alias("tokens")), "token-lines")


def batches(spark, sf, runs=False):
    """The corpus as one token stream in (doc_id, tpos) order, cut into BSZ columns; ``runs`` are stored, as
    they are read twice."""
    out = W.batchify_documents(_token_lines(spark, sf), ["doc_id"], "tokens", BSZ, sep=" ", runs=runs)
    return materialize(out.select("batch", "pos", "token"), "token-runs") if runs else out


@register("batchify_corpus", f"WITH {_BATCH_SQL} SELECT * FROM b")
def batchify_corpus(spark, sf):
    return batches(spark, sf).select("doc_id", "tpos", "token", "batch", "pos")


@register("next_token_pairs_corpus", f"""
WITH {_BATCH_SQL}
SELECT * FROM (SELECT batch, pos, token, lead(token) OVER (PARTITION BY batch ORDER BY pos) AS target FROM b)
WHERE target IS NOT NULL
""")
def next_token_pairs_corpus(spark, sf):
    return W.next_token_pairs(batches(spark, sf, runs=True), ["batch"], "pos", "token", runs=True)


@register("bptt_chunks_corpus", f"""
WITH {_BATCH_SQL}
SELECT batch, CAST(floor(pos / {BPTT}) AS BIGINT) AS chunk, list(token ORDER BY pos) AS tokens,
       count(*) AS n FROM b GROUP BY ALL
""")
def bptt_chunks_corpus(spark, sf):
    return W.bptt_chunks(batches(spark, sf, runs=True), ["batch"], "pos", "token", BPTT, runs=True)


_IDS_SQL = f"""
{_BATCH_SQL},
c AS (SELECT token, count(*) AS n FROM tok WHERE {sql_hash_unit(42, ['doc_id'])} < 0.85 AND token <> '<unk>' GROUP BY token),
v AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS id FROM c),
ids AS (SELECT batch, pos, CAST(coalesce(v.id, 0) AS BIGINT) AS token_id FROM b LEFT JOIN v USING (token))
"""


def batched_ids(spark, sf):
    """Q8: the corpus as runs of ids of the training documents' vocabulary, in BSZ columns; texts are tokenised once."""
    lines = _token_lines(spark, sf)
    train = lines.where((hash_unit(42, ["doc_id"]) < 0.85) & (F.col("tokens") != ""))
    vocab = materialize(X.vocabulary(train.select(F.explode(F.split("tokens", " ")).alias("token"))), "vocabulary")
    stream = W.batchify_documents(lines, ["doc_id"], "tokens", BSZ, sep=" ", runs=True).select("batch", "pos", "token")
    return materialize(X.numericalise(stream, vocab).select("batch", "pos", "token_id"), "id-runs")


@register("next_id_pairs_corpus", f"""
WITH {_IDS_SQL}
SELECT * FROM (SELECT batch, pos, token_id, lead(token_id) OVER (PARTITION BY batch ORDER BY pos) AS target FROM ids)
WHERE target IS NOT NULL
""")
def next_id_pairs_corpus(spark, sf):
    return W.next_token_pairs(batched_ids(spark, sf), ["batch"], "pos", "token_id", runs=True)


@register("bptt_id_chunks_corpus", f"""
WITH {_IDS_SQL}
SELECT batch, CAST(floor(pos / {BPTT}) AS BIGINT) AS chunk, list(token_id ORDER BY pos) AS tokens,
       count(*) AS n FROM ids GROUP BY ALL
""")
def bptt_id_chunks_corpus(spark, sf):
    return W.bptt_chunks(batched_ids(spark, sf), ["batch"], "pos", "token_id", BPTT, runs=True)


# ------------------------------------------------ encoders and scalers

def _freq_index_sql(col: str) -> str:
    return (f"(SELECT {col} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS DOUBLE) AS ix "
            f"FROM orders GROUP BY {col})")


@register("index_categories_orders", f"""
SELECT o_orderkey, p.ix AS o_orderpriority_idx, s.ix AS o_orderstatus_idx
FROM orders JOIN {_freq_index_sql('o_orderpriority')} p ON o_orderpriority = p.v
            JOIN {_freq_index_sql('o_orderstatus')} s ON o_orderstatus = s.v
""")
def index_categories_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return index_categories(o, ["o_orderpriority", "o_orderstatus"]).select(
        "o_orderkey", "o_orderpriority_idx", "o_orderstatus_idx")


@register("one_hot_orders", f"""
WITH p AS {_freq_index_sql('o_orderpriority')}, k AS (SELECT count(*) AS k FROM p)
SELECT o_orderkey, list_transform(range(k), lambda j: CASE WHEN j = p.ix THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
       AS o_orderpriority_hot
FROM orders JOIN p ON o_orderpriority = p.v, k
""")
def one_hot_orders(spark, sf):
    o = index_categories(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"),
                         ["o_orderpriority"])
    h = one_hot(o, ["o_orderpriority_idx"])
    return h.select("o_orderkey", vector_to_array("o_orderpriority_idx_vec").alias("o_orderpriority_hot"))


SCALE_COLS = ["l_quantity", "l_extendedprice"]
_TRAIN_SQL = f"{sql_hash_unit(42, ['l_orderkey'])} < 0.8"


def _lines(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *SCALE_COLS)
    return hash_split(li, ["l_orderkey"], [0.8, 0.2], name="split")


@register("min_max_scale_lineitem", f"""
WITH s AS (SELECT min(l_quantity) AS a0, max(l_quantity) AS a1, min(l_extendedprice) AS b0,
                  max(l_extendedprice) AS b1 FROM lineitem WHERE {_TRAIN_SQL})
SELECT l_orderkey, l_linenumber, l_partkey, (l_quantity - a0) / (a1 - a0) AS l_quantity,
       (l_extendedprice - b0) / (b1 - b0) AS l_extendedprice FROM lineitem, s
""", {"l_quantity": SIG, "l_extendedprice": SIG})
def min_max_scale_lineitem(spark, sf):
    li = _lines(spark, sf)
    return X.min_max_scale(li, SCALE_COLS, fit_on=li.where("split = 0")).drop("split")


@register("standardise_lineitem", f"""
WITH s AS (SELECT avg(l_quantity) AS a0, stddev_pop(l_quantity) AS a1, avg(l_extendedprice) AS b0,
                  stddev_pop(l_extendedprice) AS b1 FROM lineitem WHERE {_TRAIN_SQL})
SELECT l_orderkey, l_linenumber, l_partkey, (l_quantity - a0) / a1 AS l_quantity,
       (l_extendedprice - b0) / b1 AS l_extendedprice FROM lineitem, s
""", {"l_quantity": SIG, "l_extendedprice": SIG})
def standardise_lineitem(spark, sf):
    li = _lines(spark, sf)
    return X.standardise(li, SCALE_COLS, fit_on=li.where("split = 0")).drop("split")


@register("max_scale_lineitem", """
WITH s AS (SELECT max(abs(l_quantity)) AS a, max(abs(l_extendedprice)) AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity / a AS l_quantity, l_extendedprice / b AS l_extendedprice
FROM lineitem, s
""", {"l_quantity": SIG, "l_extendedprice": SIG})
def max_scale_lineitem(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *SCALE_COLS)
    return X.max_scale(li, SCALE_COLS)


# ------------------------------------------------------------ J1 reconcile

@register("reconcile_order_totals", """
WITH a AS (SELECT o_orderkey AS orderkey, o_totalprice AS reported FROM orders),
b AS (SELECT l_orderkey AS orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS recomputed
      FROM lineitem GROUP BY l_orderkey)
SELECT orderkey, reported, recomputed,
       (reported - recomputed) / (CASE WHEN recomputed <> 0 THEN recomputed END) * 100 AS diff_pct,
       CASE WHEN recomputed IS NULL THEN 'only_a' WHEN reported IS NULL THEN 'only_b'
            WHEN abs(reported - recomputed) <= 0.01 * abs(recomputed) THEN 'match' ELSE 'differs' END AS status
FROM a FULL JOIN b USING (orderkey)
""", {"recomputed": SIG, "diff_pct": 6})
def reconcile_order_totals(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"),
                                          F.col("o_totalprice").alias("reported"))
    li = table(spark, sf, "lineitem")
    b = li.groupBy(F.col("l_orderkey").alias("orderkey")).agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("recomputed"))
    return reconcile(a, b, ["orderkey"], "reported", "recomputed", tol=0.01)


_YEARLY = """
WITH s AS (
  SELECT o_custkey AS custkey, 'orders' AS source, avg(o_totalprice) AS v FROM orders WHERE year(o_orderdate) >= 1995 GROUP BY 1
  UNION ALL
  SELECT o_custkey, 'lines', avg(x) FROM (
    SELECT o_orderkey, o_custkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS x
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE year(o_orderdate) >= 1995 GROUP BY ALL) GROUP BY 1
  UNION ALL
  SELECT c_custkey, 'balance', avg(c_acctbal) FROM customer GROUP BY 1
), w AS (
  SELECT custkey, max(v) FILTER (source = 'orders') AS orders, max(v) FILTER (source = 'lines') AS lines,
         max(v) FILTER (source = 'balance') AS balance, count(v) AS n_sources, min(v) AS lo, max(v) AS hi FROM s GROUP BY custkey
)
SELECT custkey, orders, lines, balance, n_sources,
       concat_ws(',', CASE WHEN orders IS NULL THEN 'orders' END, CASE WHEN lines IS NULL THEN 'lines' END,
                 CASE WHEN balance IS NULL THEN 'balance' END) AS missing,
       abs(hi / CASE WHEN lo <> 0 THEN lo END - 1) * 100 AS spread_pct,
       CASE WHEN n_sources < 2 THEN 'single' WHEN hi - lo <= 0.01 * abs(lo) THEN 'match' ELSE 'differs' END AS status FROM w
"""


@register("reconcile_three_sources", _YEARLY, {"orders": SIG, "lines": SIG, "balance": SIG, "spread_pct": 6})
def reconcile_three_sources(spark, sf):
    """J1 with three sources: a customer's mean order since 1995 as reported, as recomputed from the lines,
    and the account balance; customers that only one source knows stay."""
    o = table(spark, sf, "orders").where(F.year("o_orderdate") >= 1995)
    li = table(spark, sf, "lineitem").select("l_orderkey", (
        F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("x"))
    lines = (o.join(li, o.o_orderkey == li.l_orderkey).groupBy("o_orderkey", "o_custkey").agg(F.sum("x").alias("x"))
             .groupBy(F.col("o_custkey").alias("custkey")).agg(F.avg("x").alias("v")))
    sources = {"orders": o.groupBy(F.col("o_custkey").alias("custkey")).agg(F.avg("o_totalprice").alias("v")), "lines": lines,
               "balance": table(spark, sf, "customer").groupBy(F.col("c_custkey").alias("custkey")).agg(F.avg("c_acctbal").alias("v"))}
    return reconcile_many(sources, ["custkey"], "v", tol=0.01)


# ------------------------------------------------------- text to rows

@register("text_to_rows_documents", """
SELECT * FROM (SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS line_no,
                      unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE length(line) > 0
""")
def text_to_rows_documents(spark, sf):
    from quarry.sources.text import text_to_rows
    return text_to_rows(table(spark, sf, "documents"), "text", ["doc_id"])


_NATION_CUSTOMERS = """
SELECT n_regionkey, n_name, count(c_custkey) AS customers
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_regionkey, n_name
"""


@register("pipe_table_region_report", f"""
SELECT n_regionkey AS region, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) - 1 AS INTEGER)
       AS row_no, n_name AS nation, CAST(customers AS VARCHAR) AS customers
FROM ({_NATION_CUSTOMERS})
""")
def pipe_table_region_report(spark, sf):
    """Each region's nations written as a Markdown table (one text per region,
    bounded by its nation count), then parsed back by S7."""
    from quarry.sources.text import pipe_table_to_rows
    c = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    n = table(spark, sf, "nation").join(c, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    line = F.concat(F.lit("| "), F.col("n_name"), F.lit(" | "),
                    F.coalesce(F.col("customers"), F.lit(0)).cast("string"), F.lit(" |"))
    rows = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_name", line.alias("l")))).alias("_r"))
    text = F.concat_ws("\n", F.lit("| nation | customers |"), F.lit("|---|---:|"),
                       F.transform("_r", lambda r: r["l"]))
    docs = rows.select(F.col("n_regionkey").alias("region"), text.alias("text"))
    return pipe_table_to_rows(docs, "text", ["nation", "customers"], keys=["region"])


# ------------------------------------------------ claim audit

#: fixed values: separators of a claim line and what stands for them, in their order
_CLAIM_REPLACEMENTS = [(":", ","), ("=", ","), ("/", ",")]
_CLAIM_SQL_BASE = """
WITH o AS (SELECT c_nationkey, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
           GROUP BY c_nationkey),
c AS (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY c_nationkey),
f AS (SELECT n_name, orders, customers FROM nation JOIN o ON o.c_nationkey = n_nationkey
      JOIN c ON c.c_nationkey = n_nationkey),
lines AS (SELECT n_name || ': ' || orders || ' / ' || customers || ' = ' ||
                 CAST(round_even(orders / customers, 1) AS VARCHAR) AS line FROM f)
"""


@register("claim_audit_nations", _CLAIM_SQL_BASE + """,
clean AS (SELECT string_split(regexp_replace(trim(replace(replace(replace(line, ':', ','), '/', ','), '=', ',')),
                                             ' *, *', ',', 'g'), ',') AS p FROM lines),
parsed AS (SELECT p[1] AS nation, CAST(p[2] AS BIGINT) AS orders, CAST(p[3] AS BIGINT) AS customers,
                  CAST(p[4] AS DOUBLE) AS claimed FROM clean),
audit AS (SELECT *, orders / CAST(customers AS DOUBLE) AS actual,
                 (claimed - orders / CAST(customers AS DOUBLE)) / (CASE WHEN claimed <> 0 THEN claimed END) * 100
                 AS error_pct FROM parsed)
SELECT nation, orders, customers, claimed, actual, error_pct,
       CAST(CASE WHEN error_pct IS NOT NULL THEN rank() OVER (ORDER BY abs(error_pct) DESC NULLS LAST) END
            AS BIGINT) AS rank
FROM audit
""", {"actual": SIG, "error_pct": SIG})
def claim_audit_nations(spark, sf):
    """Q1: claims written as text lines from the tables, parsed back (F3),
    recomputed from the parsed figures, error percentage (P9), ranked (L2)."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    per = (o.join(c, o.o_custkey == c.c_custkey).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("orders"))
           .join(c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers")), "c_nationkey"))
    f = table(spark, sf, "nation").join(per, F.col("c_nationkey") == F.col("n_nationkey"))
    claimed = F.bround(F.col("orders") / F.col("customers"), 1).cast("string")
    lines = f.select(F.concat(F.col("n_name"), F.lit(": "), F.col("orders").cast("string"), F.lit(" / "),
                              F.col("customers").cast("string"), F.lit(" = "), claimed).alias("line"))
    p = F.split(T.clean_claim_line("line", _CLAIM_REPLACEMENTS), ",")
    parsed = lines.select(p[0].alias("nation"), p[1].cast("bigint").alias("orders"),
                          p[2].cast("bigint").alias("customers"), p[3].cast("double").alias("claimed"))
    audit = parsed.withColumn("actual", F.col("orders") / F.col("customers").cast("double")) \
        .withColumn("error_pct", claim_error_pct("claimed", "actual"))
    return rank_desc(audit.withColumn("_abs", F.abs("error_pct")), "_abs", ["nation"]).drop("_abs")


# ------------------------------------------------------------------------ U1

@register("first_element_embeddings", """
SELECT vec_id, round(CAST(embedding[1] AS DOUBLE) * 1000.0) / 1000.0 AS first FROM embeddings
""")
def first_element_embeddings(spark, sf):
    """The first vector element rounded to 3 places, as a JVM expression
    (no Python UDF): scale, round half away from zero, unscale."""
    e = table(spark, sf, "embeddings")
    x = F.col("embedding")[0].cast("double")
    return e.select("vec_id", (F.round(x * F.lit(1000.0), 0) / F.lit(1000.0)).alias("first"))
