"""Model evaluation as aggregates over scored rows.

Inputs are DataFrames of (label, prediction) or (label, score).  Counts are
partial aggregates; curves group rows by distinct score and take running sums
in a range-partitioned order, never a whole-table window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ordering import running_sums


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(label, prediction, n) for every observed pair."""
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_normalised(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Each actual-label row divided by its sum (the table is classes x classes)."""
    c = confusion(df, label, pred)
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("label")))


def _per_class(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(class, tp, fp, fn, support, total) from the small confusion table."""
    c = confusion(df, label, pred)
    actual = c.groupBy(F.col("label").alias("class")).agg(F.sum("n").alias("support"))
    predicted = c.groupBy(F.col("prediction").alias("class")).agg(F.sum("n").alias("_pred"))
    tp = c.where(F.col("label") == F.col("prediction")).select(
        F.col("label").alias("class"), F.col("n").alias("tp"))
    total = c.agg(F.sum("n")).scalar()
    return (actual.join(predicted, "class", "full").join(tp, "class", "left")
            .select("class", F.coalesce("tp", F.lit(0)).alias("tp"),
                    (F.coalesce("_pred", F.lit(0)) - F.coalesce("tp", F.lit(0))).alias("fp"),
                    (F.coalesce("support", F.lit(0)) - F.coalesce("tp", F.lit(0))).alias("fn"),
                    F.coalesce("support", F.lit(0)).alias("support"),
                    total.alias("total")))


def _ratio(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), F.when(b != 0, b).cast("double")), F.lit(0.0))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then 'accuracy',
    'macro avg' and 'weighted avg' rows (0 / 0 counts as 0)."""
    k = _per_class(df, label, pred)
    p = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    r = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    per = k.select(F.col("class").cast("string").alias("class"), p.alias("precision"),
                   r.alias("recall"), "support", "tp", "total")
    per = per.withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"),
                                      F.col("precision") + F.col("recall")))
    summ = per.agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
        (F.sum("tp") / F.first("total")).alias("acc"), F.sum("support").alias("n"))
    rows = F.array(
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), F.col("acc").alias("f1"),
                 F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"),
                 F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"),
                 F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").alias("support")))
    tail = summ.select(F.explode(rows).alias("_r")).select("_r.*")
    return per.select("class", "precision", "recall", "f1", "support").unionByName(tail)


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Share of rows with prediction = label; a NULL on either side is a miss."""
    hit = F.coalesce((F.col(label) == F.col(pred)).cast("double"), F.lit(0.0))
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def accuracy_by_class(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Accuracy within each actual class; a NULL on either side is a miss."""
    hit = F.coalesce((F.col(label) == F.col(pred)).cast("double"), F.lit(0.0))
    return df.groupBy(F.col(label).alias("label")).agg(
        F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def rates_by_label(df: DataFrame, label: str, pred: str) -> DataFrame:
    """E5: true- and false-positive rate with each label taken as the positive class."""
    k = _per_class(df, label, pred)
    neg = F.col("total") - F.col("support")
    return k.select(F.col("class").alias("label"),
                    _ratio(F.col("tp"), F.col("support")).alias("tpr"),
                    _ratio(F.col("fp"), neg).alias("fpr"))


def _threshold_table(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score (descending): cumulative true / false positives when
    predicting positive at score >= threshold, before and including the row.
    Rows with a NULL label or score take no part."""
    y = F.col(label).cast("double")
    df = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    g = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(F.when(y > 0.5, 1).otherwise(0)).cast("long").alias("_pos"),
        F.sum(F.when(y > 0.5, 0).otherwise(1)).cast("long").alias("_neg"))
    g = g.withColumn("_desc", -F.col("threshold"))
    cum = running_sums(g, ["_desc"], ["_pos", "_neg"], ["_tp0", "_fp0"])
    tot = g.agg(F.sum("_pos").alias("P"), F.sum("_neg").alias("N"))
    P, N = tot.select("P").scalar(), tot.select("N").scalar()
    return cum.select("threshold", "_tp0", "_fp0",
                      (F.col("_tp0") + F.col("_pos")).alias("tp"),
                      (F.col("_fp0") + F.col("_neg")).alias("fp"),
                      P.alias("P"), N.alias("N"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, plus the (0, 0) start
    (threshold +inf); ties move together; ends at (1, 1)."""
    t = _threshold_table(df, label, score)
    pts = t.select("threshold", _ratio(F.col("fp"), F.col("N")).alias("fpr"),
                   _ratio(F.col("tp"), F.col("P")).alias("tpr"))
    start = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"),
                                            F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def auroc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Trapezoid area under the ROC curve."""
    t = _threshold_table(df, label, score)
    area = ((F.col("fp") - F.col("_fp0")) / F.col("N")) * (
        (F.col("tp") + F.col("_tp0")) / (2 * F.col("P")))
    return t.agg(F.sum(area).alias("auroc"))


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, recall, precision) per distinct score, by recall."""
    t = _threshold_table(df, label, score)
    return t.select("threshold", _ratio(F.col("tp"), F.col("P")).alias("recall"),
                    _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))


def aupr(df: DataFrame, label: str, score: str) -> DataFrame:
    """Trapezoid area under the PR curve, starting at (0, first precision)."""
    t = _threshold_table(df, label, score)
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    prev = F.when(F.col("_tp0") + F.col("_fp0") == 0, prec).otherwise(
        F.col("_tp0") / (F.col("_tp0") + F.col("_fp0")))
    area = ((F.col("tp") - F.col("_tp0")) / F.col("P")) * (prec + prev) / 2
    return t.agg(F.sum(area).alias("aupr"))


def f_by_threshold(df: DataFrame, label: str, score: str, beta: float = 1.0) -> DataFrame:
    """F-measure at each distinct threshold (positive at score >= threshold), best first."""
    t = _threshold_table(df, label, score)
    p = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    r = _ratio(F.col("tp"), F.col("P"))
    b2 = beta * beta
    f = _ratio((1 + b2) * p * r, b2 * p + r)
    return t.select("threshold", f.alias("f_measure")).orderBy(F.desc("f_measure"), F.desc("threshold"))


def regression_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    """R2, MSE, RMSE, MAE in one aggregate (SST from the population variance),
    over the rows in which neither side is NULL."""
    df = df.where(F.col(y).isNotNull() & F.col(pred).isNotNull())
    e = F.col(y).cast("double") - F.col(pred).cast("double")
    m = df.agg(F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("sse"),
               F.avg(F.abs(e)).alias("mae"), F.var_pop(F.col(y).cast("double")).alias("_v"))
    return m.select("n", (1 - F.col("sse") / (F.col("_v") * F.col("n"))).alias("r2"),
                    (F.col("sse") / F.col("n")).alias("mse"),
                    F.sqrt(F.col("sse") / F.col("n")).alias("rmse"), "mae")


def residuals(df: DataFrame, y: str, pred: str) -> DataFrame:
    """``abs(y - pred)`` and ``y / pred - 1`` (NULL when pred is 0)."""
    yv, pv = F.col(y).cast("double"), F.col(pred).cast("double")
    return df.withColumn("abs_error", F.abs(yv - pv)).withColumn(
        "rel_error", F.try_divide(yv, F.when(pv != 0, pv)) - 1)


def log_loss(df: DataFrame, label: str, p: str, eps: float = 1e-15) -> DataFrame:
    """Mean binary cross-entropy with probabilities clipped to [eps, 1-eps]."""
    q = F.least(F.greatest(F.col(p).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    # greatest() and least() pass over a NULL, so a missing p must be left out here
    loss = F.when(F.col(p).isNotNull(), -(y * F.ln(q) + (1 - y) * F.ln(1 - q)))
    return df.agg(F.avg(loss).alias("log_loss"), F.count(loss).alias("n"))


def perplexity(df: DataFrame, nll: str, weight: str | None = None,
               by: list[str] | None = None) -> DataFrame:
    """``exp(sum(w * loss) / sum(w))``: weights are segment lengths."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    aggs = [(F.sum(w * F.col(nll)) / F.sum(w)).alias("mean_loss")]
    g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return g.withColumn("perplexity", F.exp("mean_loss"))
