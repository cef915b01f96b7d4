"""Out-of-fold evaluation: every row is scored by the model that did not see it.

Rows are stored once, one folder for each fold.  Fitting model f reads all folders but one, scoring
it reads that one, so all k models together score in one pass over the rows.  Fold metrics are
grouped aggregates over all folds at once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.classify import gaussian_nb_fit
from quarry.operators.evaluate import _ratio
from quarry.operators.ordering import running_sums
from quarry.sources.files import materialize, scratch_path


def by_fold(df: DataFrame, fold: str) -> DataFrame:
    """``df`` stored with one folder for each value of ``fold``."""
    path = scratch_path(df.sparkSession, "folds")
    df.write.partitionBy(fold).parquet(path)
    # the schema is given: a folder's name alone would make another type of the column
    return df.sparkSession.read.schema(df.schema).parquet(path)


def oof_predict(fit: Callable, df: DataFrame, fold: str, k: int) -> DataFrame:
    """``df`` with the columns that the models add, each row once, by the model fitted without its fold.

    ``fit(train)`` returns something with ``transform(rows)`` (an ML model, a naive Bayes model);
    folds are 0 .. k - 1, rows of other folds or without one are left out as they have no such model.
    """
    rows = by_fold(df, fold)
    out = None
    for f in range(k):
        part = fit(rows.where(F.col(fold) != f)).transform(rows.where(F.col(fold) == f))
        out = part if out is None else out.unionByName(part)
    return out


class GaussianNB:
    """M14 as an estimator: ``fit`` is one grouped aggregate, ``transform`` plain expressions."""

    def __init__(self, label: str, features: Sequence[str]):
        self.label, self.features = label, list(features)

    def fit(self, df: DataFrame) -> GaussianNBModel:
        return GaussianNBModel(self.features, gaussian_nb_fit(df, self.label, self.features).collect())


class GaussianNBModel:
    def __init__(self, features: Sequence[str], rows: Sequence):
        self.features = list(features)
        self.classes = sorted({r["label"] for r in rows})
        self.prior = {r["label"]: r["prior"] for r in rows}
        self.moments = {(r["label"], r["feature"]): (r["mean"], r["var"]) for r in rows}

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` and ``probability`` (one for each class, in the order of the classes);
        both are NULL where a feature is."""
        scores = []
        for c in self.classes:
            s = F.lit(math.log(self.prior[c]))
            for f in self.features:
                m, v = self.moments[c, f]
                x = F.col(f).cast("double")
                s = s - 0.5 * math.log(2 * math.pi * v) - (x - m) * (x - m) / (2 * v)
            scores.append(s)
        out = df.withColumn("_s", F.array(*scores)).withColumn("_m", F.array_max("_s"))
        whole = ~F.exists("_s", lambda x: x.isNull())
        shares = F.transform("_s", lambda x: F.exp(x - F.col("_m")))
        out = out.withColumn("_e", F.when(whole, shares))
        total = F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)
        classes = F.array(*[F.lit(c) for c in self.classes])
        return out.withColumn("probability", F.transform("_e", lambda x: x / total)).withColumn(
            "prediction", F.when(whole, F.element_at(classes, F.array_position("_s", F.col("_m")).cast("int")))).drop("_s", "_m", "_e")


def positive_score(df: DataFrame, name: str = "probability") -> DataFrame:
    """Replaces a vector or array of class probabilities by that of the second class."""
    kind = df.schema[name].dataType.typeName()
    return df.withColumn(name, (F.col(name) if kind == "array" else vector_to_array(name))[1])


def auroc_by(df: DataFrame, label: str, score: str, by: str) -> DataFrame:
    """(by, auroc): E6 within every group, from running counts over (group, falling score) that
    no group has to sit in one task for.  Rows with a NULL label or score take no part; a group with
    one class only has a NULL area."""
    df = df.where(F.col(label).isNotNull() & F.col(score).isNotNull() & F.col(by).isNotNull())
    y = F.col(label).cast("double") > 0.5
    g = materialize(df.groupBy(F.col(by), (-F.col(score).cast("double")).alias("_d")).agg(
        F.sum(y.cast("long")).alias("_pos"), F.sum((~y).cast("long")).alias("_neg")), "score-counts")
    cum = running_sums(g, [by, "_d"], ["_pos", "_neg"], ["_tp", "_fp"])
    total = cum.groupBy(by).agg(F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"), F.min("_tp").alias("_t0"))
    # a negative beats the positives that come after its threshold and half of those at it
    lost = F.col("_neg") * ((F.col("_tp") - F.col("_t0")) + F.col("_pos") / 2)
    return (cum.join(total, by).groupBy(by).agg(F.sum(lost).alias("_a"), F.first("_P").alias("_P"), F.first("_N").alias("_N"))
            .select(by, F.try_divide(F.col("_a"), (F.col("_P") * F.col("_N")).cast("double")).alias("auroc")))


def fold_scores(pred: DataFrame, label: str, fold: str, prediction: str = "prediction", score: str = "probability") -> DataFrame:
    """(fold, n, accuracy, f1, auroc) of out-of-fold predictions; F1 is that of class 1.  A row
    without a prediction is a miss."""
    real, known = F.col(label).cast("double") > 0.5, F.col(prediction).isNotNull()
    up = F.coalesce(F.col(prediction).cast("double") > 0.5, F.lit(False))
    count = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
    c = pred.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), count(real & up).alias("tp"), count(real & ~up).alias("fn"),
                               count(~real & up).alias("fp"), count(~real & ~up & known).alias("tn"))
    f1 = _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return c.select(fold, "n", _ratio(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"), f1.alias("f1")).join(
        auroc_by(pred, label, score, fold), fold, "left")


def cv_scores(estimator, df: DataFrame, label: str, fold: str, k: int) -> DataFrame:
    """:func:`fold_scores` of an ML estimator, each fold scored by the model fitted without it."""
    pred = positive_score(oof_predict(estimator.fit, df, fold, k).select(fold, label, "prediction", "probability"))
    return fold_scores(materialize(pred, "cv-scores"), label, fold)


def best_of_grid(estimator, grid: dict, evaluator, train: DataFrame, fold: str, k: int, parallelism: int = 4):
    """(best model fitted on all of ``train``, [(params, mean metric)])."""
    from quarry.operators.classify import cross_validate
    model, points = cross_validate(estimator, grid, evaluator, train, fold, k=k, parallelism=parallelism)
    return model.bestModel, points
