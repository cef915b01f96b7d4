"""Registered queries for model evaluation over a deterministic scored table.

The scored table is derived from ``lineitem``: a binary label (returned
lines), a score (discount plus tax) and threshold / multiclass predictions
from plain rules, so every metric is reproducible in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.numeric import logistic
from quarry.operators import evaluate as E
from quarry.plans.registry import SIG, register
from quarry.session import table

SCORED_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount + l_tax AS score,
       CAST(l_discount >= 0.05 AS INTEGER) AS yhat,
       l_returnflag AS label,
       CASE WHEN l_quantity < 17 THEN 'A' WHEN l_quantity < 34 THEN 'N' ELSE 'R' END AS pred,
       l_extendedprice, l_quantity, l_discount
FROM lineitem
"""


def scored(spark, sf):
    li = table(spark, sf, "lineitem")
    q = F.col("l_quantity")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_discount") + F.col("l_tax")).alias("score"),
        (F.col("l_discount") >= 0.05).cast("int").alias("yhat"),
        F.col("l_returnflag").alias("label"),
        F.when(q < 17, "A").when(q < 34, "N").otherwise("R").alias("pred"),
        "l_extendedprice", "l_quantity", "l_discount")


@register("confusion_lineitem", f"""
SELECT label, pred AS prediction, count(*) AS n FROM ({SCORED_SQL}) GROUP BY ALL
""")
def confusion_lineitem(spark, sf):
    return E.confusion(scored(spark, sf), "label", "pred")


@register("confusion_normalised_lineitem", f"""
SELECT label, prediction, n, n / sum(n) OVER (PARTITION BY label) AS share FROM (
  SELECT label, pred AS prediction, count(*) AS n FROM ({SCORED_SQL}) GROUP BY ALL)
""", {"share": SIG})
def confusion_normalised_lineitem(spark, sf):
    return E.confusion_normalised(scored(spark, sf), "label", "pred")


_PER_CLASS = f"""
WITH s AS ({SCORED_SQL}),
c AS (SELECT label, pred, count(*) AS n FROM s GROUP BY ALL),
cls AS (SELECT label AS class FROM c UNION SELECT pred FROM c),
k AS (
  SELECT class,
         coalesce((SELECT sum(n) FROM c WHERE label = class AND pred = class), 0) AS tp,
         coalesce((SELECT sum(n) FROM c WHERE pred = class), 0)
           - coalesce((SELECT sum(n) FROM c WHERE label = class AND pred = class), 0) AS fp,
         coalesce((SELECT sum(n) FROM c WHERE label = class), 0)
           - coalesce((SELECT sum(n) FROM c WHERE label = class AND pred = class), 0) AS fn,
         coalesce((SELECT sum(n) FROM c WHERE label = class), 0) AS support,
         (SELECT sum(n) FROM c) AS total
  FROM cls)
"""


def _r(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


@register("classification_report_lineitem", _PER_CLASS + f"""
, per AS (SELECT class, {_r('tp', 'tp + fp')} AS precision, {_r('tp', 'tp + fn')} AS recall,
                 CAST(support AS BIGINT) AS support, tp, total FROM k),
per2 AS (SELECT *, {_r('2 * precision * recall', 'precision + recall')} AS f1 FROM per)
SELECT class, precision, recall, f1, support FROM per2
UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / first(total), CAST(sum(support) AS BIGINT) FROM per2
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per2
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                 sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per2
""", {"precision": SIG, "recall": SIG, "f1": SIG})
def classification_report_lineitem(spark, sf):
    return E.classification_report(scored(spark, sf), "label", "pred")


@register("accuracy_lineitem", f"""
SELECT avg(CAST(label = pred AS DOUBLE)) AS accuracy, count(*) AS n FROM ({SCORED_SQL})
""", {"accuracy": SIG})
def accuracy_lineitem(spark, sf):
    return E.accuracy(scored(spark, sf), "label", "pred")


@register("accuracy_by_class_lineitem", f"""
SELECT label, avg(CAST(label = pred AS DOUBLE)) AS accuracy, count(*) AS n FROM ({SCORED_SQL}) GROUP BY label
""", {"accuracy": SIG})
def accuracy_by_class_lineitem(spark, sf):
    return E.accuracy_by_class(scored(spark, sf), "label", "pred")


@register("rates_by_label_lineitem", _PER_CLASS + f"""
SELECT class AS label, {_r('tp', 'support')} AS tpr, {_r('fp', 'total - support')} AS fpr FROM k
""", {"tpr": SIG, "fpr": SIG})
def rates_by_label_lineitem(spark, sf):
    return E.rates_by_label(scored(spark, sf), "label", "pred")


_THRESH = f"""
WITH s AS ({SCORED_SQL}),
g AS (SELECT CAST(score AS DOUBLE) AS threshold, CAST(sum(CASE WHEN y > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
             CAST(sum(CASE WHEN y > 0.5 THEN 0 ELSE 1 END) AS BIGINT) AS neg FROM s
      WHERE y IS NOT NULL AND score IS NOT NULL GROUP BY 1),
t AS (SELECT threshold,
             coalesce(sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS tp0,
             coalesce(sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fp0,
             sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
             sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N
      FROM g)
"""


@register("roc_curve_lineitem", _THRESH + f"""
SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL SELECT threshold, {_r('fp', 'N')}, {_r('tp', 'P')} FROM t
""", {"fpr": SIG, "tpr": SIG})
def roc_curve_lineitem(spark, sf):
    return E.roc_curve(scored(spark, sf), "y", "score")


@register("auroc_lineitem", _THRESH + """
SELECT sum(((fp - fp0) / N) * ((tp + tp0) / (2 * P))) AS auroc FROM t
""", {"auroc": SIG})
def auroc_lineitem(spark, sf):
    return E.auroc(scored(spark, sf), "y", "score")


@register("pr_curve_lineitem", _THRESH + f"""
SELECT threshold, {_r('tp', 'P')} AS recall, {_r('tp', 'tp + fp')} AS precision FROM t
""", {"recall": SIG, "precision": SIG})
def pr_curve_lineitem(spark, sf):
    return E.pr_curve(scored(spark, sf), "y", "score")


@register("aupr_lineitem", _THRESH + """
SELECT sum(((tp - tp0) / P) * (tp / (tp + fp) + CASE WHEN tp0 + fp0 = 0 THEN tp / (tp + fp)
                                                       ELSE tp0 / (tp0 + fp0) END) / 2) AS aupr FROM t
""", {"aupr": SIG})
def aupr_lineitem(spark, sf):
    return E.aupr(scored(spark, sf), "y", "score")


@register("f_by_threshold_lineitem", _THRESH + f"""
, pr AS (SELECT threshold, {_r('tp', 'tp + fp')} AS p, {_r('tp', 'P')} AS r FROM t)
SELECT threshold, {_r('2 * p * r', 'p + r')} AS f_measure FROM pr
""", {"f_measure": SIG})
def f_by_threshold_lineitem(spark, sf):
    return E.f_by_threshold(scored(spark, sf), "y", "score")


_PRICED_SQL = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice AS y,
       l.l_quantity * p.p_retailprice AS pred
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""


def priced(spark, sf):
    li = table(spark, sf, "lineitem")
    p = table(spark, sf, "part")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("pred"))


@register("regression_metrics_price", f"""
SELECT count(*) AS n, 1 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(*)) AS r2,
       sum((y - pred) * (y - pred)) / count(*) AS mse, sqrt(sum((y - pred) * (y - pred)) / count(*)) AS rmse,
       avg(abs(y - pred)) AS mae
FROM ({_PRICED_SQL}) WHERE y IS NOT NULL AND pred IS NOT NULL
""", {"r2": SIG, "mse": SIG, "rmse": SIG, "mae": SIG})
def regression_metrics_price(spark, sf):
    return E.regression_metrics(priced(spark, sf), "y", "pred")


@register("residuals_price", f"""
SELECT *, abs(y - pred) AS abs_error, y / (CASE WHEN pred <> 0 THEN pred END) - 1 AS rel_error
FROM ({_PRICED_SQL})
""", {"pred": SIG, "abs_error": SIG, "rel_error": SIG})
def residuals_price(spark, sf):
    return E.residuals(priced(spark, sf), "y", "pred")


@register("log_loss_lineitem", f"""
SELECT avg(-(y * ln(q) + (1 - y) * ln(1 - q))) AS log_loss, count(*) AS n FROM (
  SELECT CAST(y AS DOUBLE) AS y,
         least(greatest(1.0 / (1.0 + exp(-(score * 10.0 - 1.0))), 1e-15), 1 - 1e-15) AS q
  FROM ({SCORED_SQL}))
""", {"log_loss": SIG})
def log_loss_lineitem(spark, sf):
    s = scored(spark, sf).withColumn("p", logistic(F.col("score") * 10.0 - 1.0))
    return E.log_loss(s, "y", "p")
