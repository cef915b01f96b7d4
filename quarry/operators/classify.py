"""Classifiers and GLM inference.

Naive Bayes models are closed forms over grouped counts and score by joins and
aggregates.  The other models use Spark ML estimators (distributed fits);
only coefficients, p x p matrices and per-class parameters reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_CLASSES = 10_000


# ---------------------------------------------------------------- naive Bayes

def multinomial_nb_fit(train: DataFrame, doc: str, label: str, alpha: float = 1.0) -> dict:
    """Multinomial naive Bayes from (doc, label, term, weight) rows.

    ``log theta(c, t) = ln((N_tc + alpha) / (N_c + alpha * V))``, prior from
    document counts.  Returns the model as DataFrames: ``priors`` (label,
    log_prior, log_unseen) and ``seen`` (label, term, delta) where ``delta``
    is what an observed term adds over an unseen one, plus ``vocab`` (term).
    """
    vocab = train.select("term").distinct()
    V = vocab.select(F.count(F.lit(1))).scalar()
    docs = train.select(doc, label).distinct()
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    per_class = train.groupBy(label).agg(F.sum("weight").alias("_Nc"))
    priors = (docs.groupBy(label).agg(F.count(F.lit(1)).alias("_nd")).join(per_class, label)
              .select(F.col(label).alias("label"), F.ln(F.col("_nd") / n_docs).alias("log_prior"),
                      F.ln(F.lit(alpha) / (F.col("_Nc") + F.lit(alpha) * V)).alias("log_unseen")))
    seen = (train.groupBy(label, "term").agg(F.sum("weight").alias("_Ntc"))
            .select(F.col(label).alias("label"), "term",
                    (F.ln(F.col("_Ntc") + alpha) - F.lit(math.log(alpha))).alias("delta")))
    return {"priors": priors, "seen": seen, "vocab": vocab}


def multinomial_nb_scores(model: dict, apply: DataFrame, doc: str) -> DataFrame:
    """Log joint score and normalised log posterior of every class for every
    document: (doc, label, score, log_prob).  Terms outside the training
    vocabulary are ignored.  Classes are few (checked), so each document
    meets every class without a join against the class table's size."""
    priors = model["priors"]
    classes = priors.collect()
    if len(classes) > MAX_CLASSES:
        raise ValueError("too many classes for per-document scoring")
    dv = apply.join(model["vocab"], "term")
    W = dv.groupBy(doc).agg(F.sum("weight").alias("_W"))
    cls = F.explode(F.array(*[F.struct(F.lit(r["label"]).alias("label"),
                                       F.lit(float(r["log_prior"])).alias("lp"),
                                       F.lit(float(r["log_unseen"])).alias("lu")) for r in classes]))
    base = W.select(doc, "_W", cls.alias("_c")).select(
        doc, F.col("_c.label").alias("label"), (F.col("_c.lp") + F.col("_W") * F.col("_c.lu")).alias("_base"))
    corr = (dv.join(model["seen"], "term")
            .groupBy(doc, "label").agg(F.sum(F.col("weight") * F.col("delta")).alias("_corr")))
    scored = base.join(corr, [doc, "label"], "left").select(
        doc, "label", (F.col("_base") + F.coalesce("_corr", F.lit(0.0))).alias("score"))
    # log-sum-exp over a document's classes (bounded by the class count)
    w = Window.partitionBy(doc)
    mx = F.max("score").over(w)
    lse = mx + F.ln(F.sum(F.exp(F.col("score") - mx)).over(w))
    return scored.withColumn("log_prob", F.col("score") - lse)


def top_classes(scores: DataFrame, doc: str, k: int = 1) -> DataFrame:
    """The k best classes per document (ties by label): (doc, rank, label, log_prob)."""
    w = Window.partitionBy(doc).orderBy(F.desc("score"), "label")
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .select(doc, "rank", "label", "log_prob")


def gaussian_nb_fit(df: DataFrame, label: str, features: Sequence[str],
                    var_smoothing: float = 1e-9) -> DataFrame:
    """Per class prior, mean and population variance of every feature, the
    variance floored by ``var_smoothing`` x the largest feature variance.

    Returns (label, feature, prior, mean, var) - classes x features rows.
    """
    feats = list(features)
    eps = var_smoothing * max(
        v or 0.0 for v in df.agg(*[F.var_pop(F.col(f).cast("double")) for f in feats]).first())
    n = df.select(F.count(F.lit(1))).scalar()
    aggs = [F.count(F.lit(1)).alias("_n")]
    for f in feats:
        aggs += [F.avg(F.col(f).cast("double")).alias(f"{f}__m"), F.var_pop(F.col(f).cast("double")).alias(f"{f}__v")]
    g = df.groupBy(F.col(label).alias("label")).agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"{f}__m").alias("mean"),
                                        (F.col(f"{f}__v") + F.lit(eps)).alias("var")) for f in feats]))
    return g.select("label", (F.col("_n") / n).alias("prior"), rows.alias("_r")).select(
        "label", "_r.feature", "prior", "_r.mean", "_r.var")


def gaussian_nb_predict(params: DataFrame, df: DataFrame, name: str = "prediction") -> DataFrame:
    """Score rows with fitted Gaussian NB parameters as plain expressions
    (classes x features literals), adding the best class and its log joint."""
    rows = params.collect()
    if len({r["label"] for r in rows}) > MAX_CLASSES:
        raise ValueError("too many classes")
    by_class: dict = {}
    for r in rows:
        by_class.setdefault(r["label"], {"prior": r["prior"], "f": []})["f"].append(
            (r["feature"], r["mean"], r["var"]))
    scores = []
    for c, d in sorted(by_class.items(), key=lambda kv: str(kv[0])):
        e = F.lit(math.log(d["prior"]))
        for f, m, v in d["f"]:
            x = F.col(f).cast("double")
            e = e - F.lit(0.5 * math.log(2 * math.pi * v)) - (x - F.lit(m)) * (x - F.lit(m)) / F.lit(2 * v)
        scores.append(F.struct(e.alias("s"), F.lit(c).alias("c")))
    best = F.array_max(F.array(*scores)) if len(scores) > 1 else scores[0]
    return df.withColumn("_best", best).withColumn(name, F.col("_best.c")).withColumn(
        "log_joint", F.col("_best.s")).drop("_best")


# ------------------------------------------------------------- Spark ML models

def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Columns to one vector column."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def feature_pipeline(stages: Sequence) -> Pipeline:
    """Stages chained and fitted once."""
    return Pipeline(stages=list(stages))


def index_categories(df: DataFrame, cols: Sequence[str], suffix: str = "_idx") -> DataFrame:
    """Value -> index by descending frequency, ties alphabetical; a NULL raises."""
    from pyspark.ml.feature import StringIndexer
    si = StringIndexer(inputCols=list(cols), outputCols=[c + suffix for c in cols],
                       stringOrderType="frequencyDesc", handleInvalid="error")
    return si.fit(df).transform(df)


def one_hot(df: DataFrame, cols: Sequence[str], suffix: str = "_vec") -> DataFrame:
    """Index to 0/1 vector, no level dropped."""
    from pyspark.ml.feature import OneHotEncoder
    enc = OneHotEncoder(inputCols=list(cols), outputCols=[c + suffix for c in cols], dropLast=False)
    return enc.fit(df).transform(df)


def logistic_regression(df: DataFrame, label: str, features: str = "features", reg: float = 0.0,
                        elastic_net: float = 0.0, weight: str | None = None, max_iter: int = 100):
    """M9: binary / multinomial logistic regression (Spark ML)."""
    from pyspark.ml.classification import LogisticRegression
    lr = LogisticRegression(labelCol=label, featuresCol=features, regParam=reg,
                            elasticNetParam=elastic_net, maxIter=max_iter)
    if weight:
        lr.setWeightCol(weight)
    return lr.fit(df)


def random_forest_regressor(df: DataFrame, label: str, features: str = "features",
                            trees: int = 20, seed: int = 42):
    """M7: random forest regression (Spark ML)."""
    from pyspark.ml.regression import RandomForestRegressor
    return RandomForestRegressor(labelCol=label, featuresCol=features, numTrees=trees, seed=seed).fit(df)


def random_forest_classifier(df: DataFrame, label: str, features: str = "features",
                             trees: int = 20, weight: str | None = None, seed: int = 42, depth: int = 5):
    """Random forest classifier, optionally with balanced weights."""
    from pyspark.ml.classification import RandomForestClassifier
    rf = RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=trees, maxDepth=depth, seed=seed)
    if weight:
        rf.setWeightCol(weight)
    return rf.fit(df)


def feature_importance(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """M8: importances zipped with the assembler's input order, largest first."""
    imp = model.featureImportances.toArray()
    return sorted(zip(names, map(float, imp)), key=lambda t: -t[1])


def cross_validate(estimator, grid: dict, evaluator, df: DataFrame, fold_col: str,
                   k: int | None = None, parallelism: int = 2):
    """Grid x folds with the folds given as a column; the grid is built on
    the estimator that is passed (so it cannot silently miss), every grid
    point's mean metric is returned with the best model.

    Returns (cv_model, [(params, mean_metric)]).
    """
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(estimator.getParam(name), list(values))
    maps = b.build()
    if k is None:  # folds are 0 .. k-1; one scalar aggregate
        k = int(df.agg(F.max(fold_col)).scalar()) + 1
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator,
                        foldCol=fold_col, numFolds=k, parallelism=parallelism)
    model = cv.fit(df)
    points = [({p.name: v for p, v in m.items()}, float(score)) for m, score in zip(maps, model.avgMetrics)]
    return model, points


# ------------------------------------------------------------ tail probabilities

Z95 = 1.959963984540054


def _norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi2_sf(x: float, df: int) -> float:
    """Upper tail of chi-squared (regularised upper incomplete gamma)."""
    if x <= 0:
        return 1.0
    a, xx = df / 2.0, x / 2.0
    if xx < a + 1:
        term = s = 1.0 / a
        ap = a
        for _ in range(1000):
            ap += 1
            term *= xx / ap
            s += term
            if abs(term) < abs(s) * 1e-16:
                break
        return 1 - s * math.exp(-xx + a * math.log(xx) - math.lgamma(a))
    b, c, d = xx + 1 - a, 1e300, 1 / (xx + 1 - a)
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / d if abs(d) > 1e-300 else 1e300
        c = b + an / c if abs(b + an / c) > 1e-300 else 1e-300
        de = d * c
        h *= de
        if abs(de - 1) < 1e-16:
            break
    return math.exp(-xx + a * math.log(xx) - math.lgamma(a)) * h


def _norm_ppf(p: float) -> float:
    lo, hi = -40.0, 40.0
    for _ in range(200):
        mid = (lo + hi) / 2
        if 1 - _norm_sf(mid) < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


def _chi2_ppf1(level: float) -> float:
    return _norm_ppf(0.5 + level / 2) ** 2
