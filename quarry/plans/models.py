"""Registered queries for the fitted models and tests.

Tabular models use one row per order: line aggregates of ``lineitem``
joined to ``orders`` (a co-partitioned join on the order key), label
``o_totalprice`` above its mean.  Fits that SQL can state (least squares
with one feature, F statistics, Gaussian NB parameters, normal fits, the
KS distance, attention pooling) carry a DuckDB oracle; the others are
checked by rows here and by closed forms in ``tests/test_models.py``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import boosting as B
from quarry.operators import classify as C
from quarry.operators import linear as L
from quarry.operators import stats as S
from quarry.operators.sample import kfold
from quarry.plans.registry import SIG, SIG6, register
from quarry.plans.sqlhelp import sql_eliminate, sql_hash_bits, sql_kfold_regression
from quarry.session import table
from quarry.sources.files import materialize

NUMERIC_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORDER_FEATURES = ["n_lines", "sum_qty", "avg_discount", "avg_tax"]


def order_features(spark, sf) -> DataFrame:
    """(o_orderkey, n_lines, sum_qty, avg_discount, avg_tax, o_orderpriority,
    o_totalprice, label) - label is 1.0 when the price is above the mean."""
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"), F.sum("l_quantity").alias("sum_qty"),
        F.avg("l_discount").alias("avg_discount"), F.avg("l_tax").alias("avg_tax"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    j = o.join(li, o.o_orderkey == li.l_orderkey, "left").drop("l_orderkey")
    bare = F.col("n_lines").isNull()  # an order without lines has zeros; one with lines keeps a missing average
    j = j.select("o_orderkey", "o_totalprice", "o_orderpriority",
                 *[F.when(bare, 0.0).otherwise(F.col(c)).alias(c) for c in ORDER_FEATURES])
    mean = table(spark, sf, "orders").agg(F.avg("o_totalprice")).scalar()
    return j.withColumn("label", (F.col("o_totalprice") > mean).cast("double"))


ORDER_FEATURES_SQL = """
of AS (SELECT o_orderkey, o_totalprice, o_orderpriority, CAST(count(l_orderkey) AS DOUBLE) AS n_lines,
              CASE WHEN count(l_orderkey) = 0 THEN 0 ELSE sum(l_quantity) END AS sum_qty,
              CASE WHEN count(l_orderkey) = 0 THEN 0 ELSE avg(l_discount) END AS avg_discount,
              CASE WHEN count(l_orderkey) = 0 THEN 0 ELSE avg(l_tax) END AS avg_tax,
              CAST(o_totalprice > (SELECT avg(o_totalprice) FROM orders) AS DOUBLE) AS label
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)
"""


def _folds(df: DataFrame, k: int = 5) -> DataFrame:
    return kfold(df, ["o_orderkey"], k, name="fold")


# ----------------------------------------------------- least squares (M1-M6)

@register("linear_regression_price", """
WITH s AS (SELECT regr_intercept(l_extendedprice, l_quantity) AS b0,
                  regr_slope(l_extendedprice, l_quantity) AS b1,
                  regr_r2(l_extendedprice, l_quantity) AS r2 FROM lineitem),
m AS (SELECT avg(power(l_extendedprice - (b0 + b1 * l_quantity), 2)) AS mse FROM lineitem, s)
SELECT '_intercept' AS term, b0 AS coef FROM s UNION ALL SELECT 'l_quantity', b1 FROM s
UNION ALL SELECT '_r2', r2 FROM s UNION ALL SELECT '_mse', mse FROM m
""", {"coef": SIG6})
def linear_regression_price(spark, sf):
    return L.linear_regression(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity"])


_LINE_XS = ["l_quantity", "l_discount", "l_tax"]
_NORMAL_SQL = f"""
WITH g AS MATERIALIZED (SELECT {", ".join(f"sum(CAST({a} AS DOUBLE) * {b}) AS a_{i}_{j}" for i, a in enumerate(_LINE_XS)
                                          for j, b in enumerate([*_LINE_XS, "l_extendedprice"]))} FROM lineitem),
{sql_eliminate("g", "e", 3)}
{" UNION ALL ".join(f"SELECT '{x}' AS term, a_{i}_3 AS theta FROM e2" for i, x in enumerate(_LINE_XS))}
"""


@register("normal_equation_lineitem", _NORMAL_SQL, {"theta": SIG6})
def normal_equation_lineitem(spark, sf):
    return L.normal_equation(table(spark, sf, "lineitem"), "l_extendedprice",
                             ["l_quantity", "l_discount", "l_tax"])


_FOLDED_LINES = (f"f AS MATERIALIZED (SELECT CAST({sql_hash_bits(42, ['l_orderkey'])} % 10 AS INTEGER) AS fold, "
                 f"{', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in NUMERIC_LINE)} FROM lineitem)")


@register("kfold_regress_price", f"""
WITH {_FOLDED_LINES},
{sql_kfold_regression("p", "f", _LINE_XS, "l_extendedprice")}
SELECT fold, n_test, r2, mse, b0 AS b__intercept, {", ".join(f"b{i + 1} AS b_{x}" for i, x in enumerate(_LINE_XS))} FROM p_k
""", {c: SIG6 for c in ["r2", "mse", "b__intercept", *(f"b_{x}" for x in _LINE_XS)]})
def kfold_regress_price(spark, sf):
    return L.kfold_regress(table(spark, sf, "lineitem"), "l_extendedprice",
                           ["l_quantity", "l_discount", "l_tax"], ["l_orderkey"], k=10)


@register("f_regression_price", """
WITH c AS (SELECT count(*) AS n, corr(l_quantity, l_extendedprice) AS q,
                  corr(l_discount, l_extendedprice) AS d, corr(l_tax, l_extendedprice) AS t FROM lineitem)
SELECT 'l_quantity' AS feature, q AS r, q * q / (1 - q * q) * (n - 2) AS F FROM c
UNION ALL SELECT 'l_discount', d, d * d / (1 - d * d) * (n - 2) FROM c
UNION ALL SELECT 'l_tax', t, t * t / (1 - t * t) * (n - 2) FROM c
""", {"r": SIG6, "F": SIG6})
def f_regression_price(spark, sf):
    # the p value has no DuckDB counterpart; tests check it against closed forms
    return L.f_regression(table(spark, sf, "lineitem"), "l_extendedprice",
                          ["l_quantity", "l_discount", "l_tax"]).select("feature", "r", "F")


@register("f_regression_pvalues")
def f_regression_pvalues(spark, sf):
    return L.f_regression(table(spark, sf, "lineitem"), "l_extendedprice",
                          ["l_quantity", "l_discount", "l_tax"])


def _best_target_sql(cols: list[str]) -> str:
    fits = [sql_kfold_regression(f"t{i}", "f", [c for c in cols if c != t], t) for i, t in enumerate(cols)]
    means = " UNION ALL ".join(f"SELECT '{t}' AS target, avg(r2) AS mean_r2, stddev_samp(r2) AS sd_r2 FROM t{i}_k" for i, t in enumerate(cols))
    return (f"WITH {_FOLDED_LINES},\n" + ",\n".join(fits) + f",\nm AS MATERIALIZED ({means})\n"
            "SELECT *, row_number() OVER (ORDER BY mean_r2 DESC, target DESC) = 1 AS best FROM m")


# a column that the others do not explain has an R2 near 0, so places are fixed here
@register("best_target_lineitem", _best_target_sql(NUMERIC_LINE), {"mean_r2": 8, "sd_r2": 8})
def best_target_lineitem(spark, sf):
    return L.best_target(table(spark, sf, "lineitem"), NUMERIC_LINE, ["l_orderkey"], k=10)


@register("elastic_net_search_lineitem")
def elastic_net_search_lineitem(spark, sf):
    return L.elastic_net_search(table(spark, sf, "lineitem"), [*NUMERIC_LINE, "l_linenumber"], ["l_orderkey"],
                                sizes=(2, 3, 4), alphas=(0.0, 0.01, 0.1), k=10)


# --------------------------------------------------- Gaussian NB

@register("gaussian_nb_params_orders", f"""
WITH {ORDER_FEATURES_SQL},
eps AS (SELECT 1e-9 * greatest(var_pop(n_lines), var_pop(sum_qty), var_pop(avg_discount),
                               var_pop(avg_tax)) AS e FROM of),
g AS (SELECT label, count(*) / (SELECT count(*) FROM of) AS prior,
             avg(n_lines) AS m1, var_pop(n_lines) AS v1, avg(sum_qty) AS m2, var_pop(sum_qty) AS v2,
             avg(avg_discount) AS m3, var_pop(avg_discount) AS v3, avg(avg_tax) AS m4,
             var_pop(avg_tax) AS v4 FROM of GROUP BY label)
SELECT label, 'n_lines' AS feature, prior, m1 AS mean, v1 + e AS var FROM g, eps
UNION ALL SELECT label, 'sum_qty', prior, m2, v2 + e FROM g, eps
UNION ALL SELECT label, 'avg_discount', prior, m3, v3 + e FROM g, eps
UNION ALL SELECT label, 'avg_tax', prior, m4, v4 + e FROM g, eps
""", {"prior": SIG, "mean": SIG, "var": SIG6})
def gaussian_nb_params_orders(spark, sf):
    return C.gaussian_nb_fit(order_features(spark, sf), "label", ORDER_FEATURES)


# ------------------------------------------- Spark ML classifiers

def _assembled(spark, sf):
    return C.assemble(_folds(order_features(spark, sf)), ORDER_FEATURES)


@register("logistic_cv_orders")
def logistic_cv_orders(spark, sf):
    """Every grid point's mean AUROC over hash folds, with
    balanced class weights; the grid is built on the estimator passed."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from quarry.operators.features import with_class_weights
    # every fold reads the rows; the orders' features are worked out once
    df = with_class_weights(materialize(_assembled(spark, sf), "order-features"), "label", "w")
    est = LogisticRegression(labelCol="label", featuresCol="features", weightCol="w", maxIter=50)
    _, points = C.cross_validate(est, {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]},
                                 BinaryClassificationEvaluator(labelCol="label"), df, "fold", k=5)
    rows = [(float(p["regParam"]), float(p["elasticNetParam"]), m) for p, m in points]
    return spark.createDataFrame(rows, "reg_param double, elastic_net double, mean_auroc double")


@register("random_forest_importance_orders")
def random_forest_importance_orders(spark, sf):
    """M15 + M8: weighted random forest classifier, importances by input name."""
    from quarry.operators.features import with_class_weights
    df = with_class_weights(_assembled(spark, sf), "label", "w")
    m = C.random_forest_classifier(df.where("fold <> 0"), "label", trees=20, weight="w")
    return spark.createDataFrame(C.feature_importance(m, ORDER_FEATURES), "feature string, importance double")


@register("random_forest_regression_orders")
def random_forest_regression_orders(spark, sf):
    """M7: random forest regression of the order price, held-out RMSE and R2."""
    from pyspark.ml.evaluation import RegressionEvaluator
    df = _assembled(spark, sf)
    m = C.random_forest_regressor(df.where("fold <> 0"), "o_totalprice", trees=20)
    pred = m.transform(df.where("fold = 0"))
    ev = RegressionEvaluator(labelCol="o_totalprice")
    return spark.createDataFrame([(ev.evaluate(pred, {ev.metricName: "rmse"}),
                                   ev.evaluate(pred, {ev.metricName: "r2"}))], "rmse double, r2 double")


#: fixed values: (trees, depth, rate) of the grid
BOOST_SETTINGS = [(2, 2, 1.0), (15, 15, 1.0), (20, 20, 1.0), (35, 35, 1.0), (20, 20, 0.25), (20, 20, 0.5),
                  (20, 20, 2.0), (20, 20, 10.0), (25, 25, 0.5), (25, 25, 2.0), (100, 100, 0.25)]


@register("boosted_trees_grid_orders")
def boosted_trees_grid_orders(spark, sf):
    """All 11 settings of trees, depth and rate, fitted together and scored on held-out orders."""
    df = _folds(order_features(spark, sf))
    settings = [{"trees": n, "depth": d, "rate": r} for n, d, r in BOOST_SETTINGS]
    model = B.fit_grid(df.where("fold <> 0"), "label", ORDER_FEATURES, settings)
    grid = spark.createDataFrame([(k, *s) for k, s in enumerate(BOOST_SETTINGS)], "setting int, trees int, depth int, rate double")
    # eleven rows
    return F.broadcast(grid).join(B.grid_report(model, df.where("fold = 0"), "label"), "setting").drop("setting")


# -------------------------------------------------- normality

@register("fit_normal_events", """
SELECT user_id % 10 AS bucket, count(value) AS n, avg(value) AS mean, stddev_pop(value) AS sd
FROM events GROUP BY ALL
""", {"mean": SIG, "sd": SIG})
def fit_normal_events(spark, sf):
    ev = table(spark, sf, "events").withColumn("bucket", F.col("user_id") % 10)
    return S.fit_normal(ev, "value", ["bucket"])


def _sql_norm_cdf(x: str) -> str:
    """DuckDB twin of :func:`quarry.operators.stats.norm_cdf` (same steps, same constants)."""
    z = f"(-({x}) / {math.sqrt(2.0)!r})"
    t = f"(1.0 / (1.0 + 0.5 * abs({z})))"
    poly = repr(S.ERFC_COEFFS[-1])
    for c in reversed(S.ERFC_COEFFS[:-1]):
        poly = f"({c!r} + {t} * {poly})"
    ans = f"({t} * exp(-{z} * {z} + {poly}))"
    return f"(0.5 * CASE WHEN {z} >= 0 THEN {ans} ELSE 2.0 - {ans} END)"


@register("ks_statistic_events", f"""
WITH b AS (SELECT CAST(value AS DOUBLE) AS x, event_id AS k FROM events WHERE value IS NOT NULL),
f AS (SELECT avg(x) AS m, stddev_pop(x) AS s, count(*) AS n FROM b),
r AS (SELECT x, row_number() OVER (ORDER BY x, k) - 1 AS i FROM b),
c AS (SELECT i, n, {_sql_norm_cdf("(x - m) / s")} AS cdf FROM r, f)
SELECT max(n) AS n, max(greatest((i + 1) / n - cdf, cdf - i / n)) AS d FROM c
""", {"d": SIG6})
def ks_statistic_events(spark, sf):
    return S.ks_statistic(table(spark, sf, "events"), "value", "event_id")


@register("ks_test_spark_events")
def ks_test_spark_events(spark, sf):
    ev = table(spark, sf, "events")
    fit = S.fit_normal(ev, "value").first()
    d, p = S.ks_test_spark(ev, "value", fit["mean"], fit["sd"])
    return spark.createDataFrame([(d, p)], "statistic double, p_value double")


def _sql_horner(coeffs, x: str) -> str:
    acc = repr(coeffs[0])
    for c in coeffs[1:]:
        acc = f"({acc} * {x} + {c!r})"
    return acc


def _sql_norm_ppf(p: str) -> str:
    """DuckDB twin of :func:`quarry.operators.stats.norm_ppf`."""
    q = f"({p} - 0.5)"
    r = f"({q} * {q})"
    central = f"({_sql_horner(S.ACKLAM_A, r)} * {q} / ({_sql_horner(S.ACKLAM_B, r)} * {r} + 1.0))"
    ql = f"sqrt(-2.0 * ln({p}))"
    low = f"({_sql_horner(S.ACKLAM_C, ql)} / ({_sql_horner(S.ACKLAM_D, ql)} * {ql} + 1.0))"
    qh = f"sqrt(-2.0 * ln(1.0 - {p}))"
    high = f"(-{_sql_horner(S.ACKLAM_C, qh)} / ({_sql_horner(S.ACKLAM_D, qh)} * {qh} + 1.0))"
    return (f"(CASE WHEN {p} < {S.ACKLAM_LOW!r} THEN {low} WHEN {p} > {1 - S.ACKLAM_LOW!r} THEN {high} "
            f"ELSE {central} END)")


def _sql_anderson_darling_p(a: str) -> str:
    """DuckDB twin of :func:`quarry.operators.stats.anderson_darling_p`."""
    e = [f"exp({c[0]!r} + {c[1]!r} * {a} + {c[2]!r} * {a} * {a})" for _, c in S.AD_PIECES]
    return (f"(CASE WHEN {a} >= {S.AD_FAR!r} THEN {S.AD_LEAST!r} WHEN {a} >= 0.6 THEN {e[0]} WHEN {a} >= 0.34 THEN {e[1]} "
            f"WHEN {a} >= 0.2 THEN 1.0 - {e[2]} ELSE 1.0 - {e[3]} END)")


def _sql_ln(p: str) -> str:
    return f"ln(greatest({p}, {S.TINY!r}))"


def _normality_sql(bucket: str) -> str:
    return f"""
WITH b AS (SELECT {bucket} AS bucket, CAST(value AS DOUBLE) AS x, event_id AS k FROM events WHERE value IS NOT NULL),
f AS (SELECT bucket, count(*) AS nn, avg(x) AS mean, stddev_samp(x) AS sd FROM b GROUP BY bucket),
r AS (SELECT bucket, x, (x - mean) / nullif(sd, 0) AS z, nn, row_number() OVER (PARTITION BY bucket ORDER BY x, k) - 1 AS i
      FROM b JOIN f USING (bucket)),
m AS (SELECT *, {_sql_norm_ppf("((i + 1 - 0.375) / (nn + 0.25))")} AS m,
             (2 * i + 1) * {_sql_ln(_sql_norm_cdf("z"))} + (2 * (nn - i) - 1) * {_sql_ln(_sql_norm_cdf("(-z)"))} AS t FROM r),
g AS (SELECT bucket, count(*) AS n, corr(x, m) * corr(x, m) AS w, -CAST(count(*) AS DOUBLE) - sum(t) / count(*) AS a2 FROM m GROUP BY bucket),
s AS (SELECT *, a2 * (1.0 + 0.75 / n + 2.25 / (CAST(n AS DOUBLE) * n)) AS a FROM g),
p AS (SELECT bucket, n, w, a2, 'anderson-darling' AS test, CASE WHEN n >= 8 THEN {_sql_anderson_darling_p("a")} END AS p_value FROM s)
SELECT *, p_value < 0.01 AS reject FROM p
"""


@register("shapiro_francia_events", _normality_sql("user_id % 10"), {"w": SIG6, "a2": SIG6, "p_value": SIG6})
def shapiro_francia_events(spark, sf):
    ev = table(spark, sf, "events").withColumn("bucket", F.col("user_id") % 10)
    return S.shapiro_francia(ev, "value", "event_id", by=["bucket"])


@register("normality_all_events", _normality_sql("0"), {"w": SIG6, "a2": SIG6, "p_value": SIG6})
def normality_all_events(spark, sf):
    """M25 on the whole table as one group."""
    ev = table(spark, sf, "events").withColumn("bucket", F.lit(0))
    return S.shapiro_francia(ev, "value", "event_id", by=["bucket"])


# ------------------------------------------------ attention pooling

@register("attention_pool_embeddings", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT label, i, avg(x) AS x
      FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e) GROUP BY label, i),
q AS (SELECT label AS qid, list(x ORDER BY i) AS qv FROM d GROUP BY label),
s AS (SELECT qid, vec_id, v, list_dot_product(qv, v) / sqrt(len(qv)) AS s FROM q, e),
w AS (SELECT qid, vec_id, v, exp(s - max(s) OVER (PARTITION BY qid)) AS ew FROM s),
z AS (SELECT qid, sum(ew) AS z FROM w GROUP BY qid),
num AS (SELECT qid, i - 1 AS dim, sum(ew * x) AS num
        FROM (SELECT qid, ew, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM w) GROUP BY qid, i)
SELECT num.qid AS label, CAST(dim AS INTEGER) AS dim, num / z AS value FROM num JOIN z USING (qid)
""", {"value": SIG6})
def attention_pool_embeddings(spark, sf):
    """Queries are the mean embedding of each label (one per label); keys and
    values are every embedding."""
    e = table(spark, sf, "embeddings")
    v = F.col("embedding").cast("array<double>")
    means = (e.select("label", F.posexplode(v).alias("i", "x"))
             .groupBy("label", "i").agg(F.avg("x").alias("x"))
             .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("_s"))
             .select("label", F.transform("_s", lambda t: t["x"]).alias("qv")))
    return S.attention_pool(means, e, "label", "qv", "embedding").withColumn("dim", F.col("dim").cast("int"))
