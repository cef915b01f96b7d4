"""The tabular classifier study: models of the orders evaluated on rows they did not see."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import classify as C
from quarry.operators import evaluate as E
from quarry.operators import oof as O
from quarry.plans.models import ORDER_FEATURES, ORDER_FEATURES_SQL, _folds, order_features
from quarry.plans.registry import SIG, SIG6, register
from quarry.plans.sqlhelp import sql_hash_bits
from quarry.sources.files import materialize

K = 5


def predictions(spark, sf) -> DataFrame:
    """(o_orderkey, fold, label, prediction, probability) by Gaussian naive Bayes, each order by the
    model that was fitted without its fold."""
    df = _folds(order_features(spark, sf), K)
    out = O.oof_predict(O.GaussianNB("label", ORDER_FEATURES).fit, df, "fold", K)
    return materialize(O.positive_score(out).select("o_orderkey", "fold", "label", "prediction", "probability"), "oof")


def _nb_sql() -> str:
    moments = ", ".join(f"avg({f}) AS m{i}, var_pop({f}) AS v{i}" for i, f in enumerate(ORDER_FEATURES))
    largest = ", ".join(f"var_pop({f})" for f in ORDER_FEATURES)
    joint = " ".join(f"- 0.5 * ln(2 * pi() * (v{i} + e)) - ({f} - m{i}) * ({f} - m{i}) / (2 * (v{i} + e))" for i, f in enumerate(ORDER_FEATURES))
    return f"""
WITH {ORDER_FEATURES_SQL},
d AS MATERIALIZED (SELECT *, CAST({sql_hash_bits(42, ['o_orderkey'])} % {K} AS INTEGER) AS fold FROM of),
k AS (SELECT unnest(range({K})) AS f),
e AS (SELECT f, 1e-9 * greatest({largest}) AS e, count(*) AS n FROM d JOIN k ON fold <> f GROUP BY f),
g AS (SELECT f, label AS c, count(*) AS nc, {moments} FROM d JOIN k ON fold <> f GROUP BY f, label),
s AS (SELECT o_orderkey, fold, label, c, ln(nc / n) {joint} AS s FROM d JOIN g ON g.f = d.fold JOIN e ON e.f = d.fold),
p AS MATERIALIZED (SELECT o_orderkey, fold, label, arg_max(c, (s, -c)) AS prediction,
      max(CASE WHEN c = 1 THEN exp(s - m) ELSE 0 END) / sum(exp(s - m)) AS probability
      FROM (SELECT *, max(s) OVER (PARTITION BY o_orderkey) AS m FROM s) GROUP BY o_orderkey, fold, label)
"""


_P = _nb_sql()
_CLASSES = """,
k2 AS (SELECT DISTINCT c FROM (SELECT label AS c FROM p UNION ALL SELECT prediction FROM p)),
t AS (SELECT c, count(*) FILTER (label = c AND prediction = c) AS tp, count(*) FILTER (label = c) AS sup,
             count(*) FILTER (prediction = c) AS pr, count(*) AS n FROM p, k2 GROUP BY c),
r AS (SELECT *, CASE WHEN pr = 0 THEN 0.0 ELSE tp / pr END AS p, CASE WHEN sup = 0 THEN 0.0 ELSE tp / sup END AS r FROM t),
h AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM r)
"""
#: probabilities are rounded before they become thresholds, so that both sides tie the same rows
_DIGITS = 6
_THRESHOLDS = f""",
q AS (SELECT round(probability * 1e{_DIGITS}) / 1e{_DIGITS} AS threshold, label FROM p),
c0 AS (SELECT threshold, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg FROM q GROUP BY threshold),
c1 AS (SELECT threshold, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, pos, neg, sum(pos) OVER () AS pp, sum(neg) OVER () AS nn
       FROM c0 WINDOW w AS (ORDER BY threshold DESC))
"""


def _rounded(pred: DataFrame) -> DataFrame:
    k = F.lit(float(10 ** _DIGITS))
    return pred.withColumn("probability", F.round(F.col("probability") * k, 0) / k)


@register("oof_predictions_orders", _P + "SELECT * FROM p", {"probability": SIG6})
def oof_predictions_orders(spark, sf):
    return predictions(spark, sf)


@register("oof_confusion_orders", _P + """
SELECT label, prediction, n, n / sum(n) OVER (PARTITION BY label) AS share
FROM (SELECT label, prediction, count(*) AS n FROM p GROUP BY ALL)
""", {"share": SIG})
def oof_confusion_orders(spark, sf):
    """E1, E2 on out-of-fold predictions."""
    return E.confusion_normalised(predictions(spark, sf), "label", "prediction")


@register("oof_report_orders", _P + _CLASSES + """
SELECT CAST(c AS VARCHAR) AS class, p AS precision, r AS recall, f AS f1, CAST(sup AS BIGINT) AS support FROM h
UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(sup), CAST(sum(sup) AS BIGINT) FROM h
UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), CAST(sum(sup) AS BIGINT) FROM h
UNION ALL SELECT 'weighted avg', sum(p * sup) / sum(sup), sum(r * sup) / sum(sup), sum(f * sup) / sum(sup), CAST(sum(sup) AS BIGINT) FROM h
""", {"precision": SIG, "recall": SIG, "f1": SIG})
def oof_report_orders(spark, sf):
    """E3 on out-of-fold predictions."""
    return E.classification_report(predictions(spark, sf), "label", "prediction")


@register("oof_rates_orders", _P + _CLASSES + """
SELECT c AS label, r AS tpr, CASE WHEN n = sup THEN 0.0 ELSE (pr - tp) / (n - sup) END AS fpr FROM h
""", {"tpr": SIG, "fpr": SIG})
def oof_rates_orders(spark, sf):
    """E5 on out-of-fold predictions."""
    return E.rates_by_label(predictions(spark, sf), "label", "prediction")


@register("oof_roc_orders", _P + _THRESHOLDS + """
SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr UNION ALL SELECT threshold, fp / nn, tp / pp FROM c1
""", {"fpr": SIG, "tpr": SIG})
def oof_roc_orders(spark, sf):
    """E6 on out-of-fold probabilities."""
    return E.roc_curve(_rounded(predictions(spark, sf)), "label", "probability")


@register("oof_pr_orders", _P + _THRESHOLDS + "SELECT threshold, tp / pp AS recall, tp / (tp + fp) AS precision FROM c1",
          {"recall": SIG, "precision": SIG})
def oof_pr_orders(spark, sf):
    """E7 on out-of-fold probabilities."""
    return E.pr_curve(_rounded(predictions(spark, sf)), "label", "probability")


@register("oof_f_by_threshold_orders", _P + _THRESHOLDS + """
SELECT threshold, CASE WHEN tp = 0 THEN 0.0 ELSE 2 * (tp / (tp + fp)) * (tp / pp) / (tp / (tp + fp) + tp / pp) END AS f_measure FROM c1
""", {"f_measure": SIG})
def oof_f_by_threshold_orders(spark, sf):
    """E8 on out-of-fold probabilities."""
    return E.f_by_threshold(_rounded(predictions(spark, sf)), "label", "probability")


@register("oof_fold_scores_orders", _P + f""",
q AS (SELECT fold, label, prediction, round(probability * 1e{_DIGITS}) / 1e{_DIGITS} AS z FROM p),
c0 AS (SELECT fold, z, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg FROM q GROUP BY fold, z),
a AS (SELECT fold, sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)) AS auroc
      FROM (SELECT *, sum(pos) OVER (PARTITION BY fold ORDER BY z DESC) AS tp FROM c0) GROUP BY fold),
b AS (SELECT fold, count(*) AS n, avg(CAST(label = prediction AS DOUBLE)) AS accuracy,
             2 * count(*) FILTER (label = 1 AND prediction = 1) / (2 * count(*) FILTER (label = 1 AND prediction = 1)
             + count(*) FILTER (label <> prediction)) AS f1 FROM q GROUP BY fold)
SELECT fold, n, accuracy, f1, auroc FROM b JOIN a USING (fold)
""", {"accuracy": SIG, "f1": SIG, "auroc": SIG})
def oof_fold_scores_orders(spark, sf):
    """Accuracy, F1 and AUROC of every fold."""
    return O.fold_scores(_rounded(predictions(spark, sf)), "label", "fold")


@register("gaussian_nb_accuracy_orders", _P + """
SELECT count(*) AS n, avg(CAST(label = prediction AS DOUBLE)) AS accuracy FROM p WHERE fold = 0
""", {"accuracy": SIG})
def gaussian_nb_accuracy_orders(spark, sf):
    """Accuracy on the first fold of the model fitted on the others."""
    df = _folds(order_features(spark, sf), K)
    pred = C.gaussian_nb_predict(C.gaussian_nb_fit(df.where("fold <> 0"), "label", ORDER_FEATURES), df.where("fold = 0"))
    return E.accuracy(pred, "label", "prediction")


@register("cv_scores_orders")
def cv_scores_orders(spark, sf):
    """Accuracy, F1 and AUROC of every fold of a logistic model."""
    from pyspark.ml.classification import LogisticRegression
    df = C.assemble(_folds(order_features(spark, sf), K), ORDER_FEATURES)
    est = LogisticRegression(labelCol="label", featuresCol="features", regParam=0.01, maxIter=50)
    return O.cv_scores(est, df, "label", "fold", K)


@register("best_cv_model_orders")
def best_cv_model_orders(spark, sf):
    """Elastic-net logistic grid over hash folds of the training rows by AUROC; the best model,
    fitted on all of them, is applied to the held-out rows and measured by E4, E6, E7, E8 and E11."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = C.assemble(_folds(order_features(spark, sf), K + 1), ORDER_FEATURES).persist()
    train, test = df.where(F.col("fold") < K), df.where(F.col("fold") == K)
    est = LogisticRegression(labelCol="label", featuresCol="features", maxIter=50)
    model, points = O.best_of_grid(est, {"regParam": [0.001, 0.01, 0.1], "elasticNetParam": [0.0, 0.5]},
                                   BinaryClassificationEvaluator(labelCol="label"), train, "fold", K)
    pred = materialize(O.positive_score(model.transform(test).select("label", "prediction", "probability")), "best-cv")
    best = max(score for _, score in points)
    one = lambda d, c: d.select(F.col(c).cast("double").alias("value"))
    parts = {"cv auroc": spark.range(1).select(F.lit(float(best)).alias("value")),
             "accuracy": one(E.accuracy(pred, "label", "prediction"), "accuracy"),
             "auroc": one(E.auroc(pred, "label", "probability"), "auroc"),
             "aupr": one(E.aupr(pred, "label", "probability"), "aupr"),
             "best f1": one(E.f_by_threshold(pred, "label", "probability").limit(1), "f_measure"),
             "log loss": one(E.log_loss(pred, "label", "probability"), "log_loss")}
    out = None
    for name, d in parts.items():
        d = d.select(F.lit(name).alias("metric"), "value")
        out = d if out is None else out.unionByName(d)
    return out
