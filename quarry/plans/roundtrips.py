"""Registered round trips of the readers, the pandas edge and saved models.

The driver gives Parquet, so each query writes a given table in the reader's own format to the shared
folder and reads it back: the rows must be those of the table.
"""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.operators.classify import assemble, feature_pipeline
from quarry.plans.registry import SIG, register
from quarry.plans.tabular import DAILY_SQL, daily
from quarry.session import table
from quarry.sources import files as S


@register("read_table_csv_orders", """
SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders
""")
def read_table_csv_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice",
                                          F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")
    path = S.scratch_path(spark, "orders-csv")
    o.write.option("header", True).csv(path)
    return S.read_table_csv(spark, path, o.schema)


@register("read_named_tsv_events", "SELECT event_id, user_id, event_type, value, props FROM events")
def read_named_tsv_events(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    path = S.scratch_path(spark, "events-tsv")
    # the reader takes quotes as they are, so the lines are written without any
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ev.columns]
    ev.select(F.concat_ws("\t", *cells).alias("value")).write.text(path)
    return S.read_named_tsv(spark, path, ev.schema)


@register("read_series_csv_daily", f"""
SELECT CAST(o_orderdate AS DATE) AS o_orderdate, total, n FROM ({DAILY_SQL}) AS d
""", {"total": SIG})
def read_series_csv_daily(spark, sf):
    d = daily(spark, sf).select(F.col("o_orderdate").cast("date").alias("o_orderdate"), "total", "n")
    path = S.scratch_path(spark, "series-csv")
    d.write.option("header", True).option("dateFormat", "dd.MM.yyyy").csv(path)
    return S.read_series_csv(spark, path, d.schema, "dd.MM.yyyy")


_LINES_SQL = """
SELECT {label} unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS line FROM documents
WHERE text IS NOT NULL AND lang IS NOT NULL
"""


@register("read_labelled_lines_documents", f"""
SELECT * FROM ({_LINES_SQL.format(label="lang AS label,")}) AS q WHERE length(line) > 0
""")
def read_labelled_lines_documents(spark, sf):
    d = table(spark, sf, "documents").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    path = S.scratch_path(spark, "labelled-lines")
    d.select(F.col("text").alias("value"), "lang").write.partitionBy("lang").text(path)
    return S.read_labelled_lines(spark, f"{path}/*", r"lang=([^/]+)/").select("label", "line")


@register("read_corpus_documents", f"""
SELECT * FROM ({_LINES_SQL.format(label="")}) AS q WHERE length(line) > 0
""")
def read_corpus_documents(spark, sf):
    d = table(spark, sf, "documents").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    path = S.scratch_path(spark, "corpus-lines")
    d.select(F.col("text").alias("value")).write.text(path)
    return S.read_corpus(spark, path)


@register("pandas_priority_means", """
SELECT o_orderpriority, avg(o_totalprice) AS mean, avg(o_totalprice) / sum(avg(o_totalprice)) OVER () AS share
FROM orders GROUP BY o_orderpriority
""", {"mean": SIG, "share": SIG})
def pandas_priority_means(spark, sf):
    """A result of one row for each priority goes to pandas and back."""
    means = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("mean"))
    pdf = S.to_pandas(means, max_rows=10_000)
    pdf["share"] = pdf["mean"] / pdf["mean"].sum()
    return S.from_pandas(spark, pdf, "o_orderpriority string, mean double, share double")


LINE_NUMBERS = ["l_quantity", "l_discount", "l_tax"]


@register("assemble_lineitem", f"""
SELECT l_orderkey, l_linenumber, l_partkey, list_value({", ".join(f"CAST({c} AS DOUBLE)" for c in LINE_NUMBERS)}) AS features
FROM lineitem
""")
def assemble_lineitem(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *LINE_NUMBERS)
    return assemble(li, LINE_NUMBERS).select("l_orderkey", "l_linenumber", "l_partkey",
                                             vector_to_array("features").alias("features"))


@register("saved_pipeline_lineitem", f"""
WITH s AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in LINE_NUMBERS)} FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, {", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in LINE_NUMBERS)}
FROM lineitem, s
""", {c: 6 for c in LINE_NUMBERS})
def saved_pipeline_lineitem(spark, sf):
    """Assembler and scaler fitted as one pipeline, saved, and applied by the model that was read back."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *LINE_NUMBERS)
    stages = [VectorAssembler(inputCols=LINE_NUMBERS, outputCol="raw"),
              StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True)]
    path = S.save_model(feature_pipeline(stages).fit(li), S.scratch_path(spark, "pipeline"))
    scaled = vector_to_array(F.col("scaled"))
    return S.load_model(path).transform(li).select("l_orderkey", "l_linenumber", "l_partkey",
                                                   *[scaled[i].alias(c) for i, c in enumerate(LINE_NUMBERS)])
