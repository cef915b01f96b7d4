"""Fitted models against closed forms and Spark's own estimators (SURVEY 5 (d))."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.operators import classify as C
from quarry.operators import glm as G
from quarry.operators import linear as L
from quarry.operators import stats as S
from quarry.operators.sample import kfold
from quarry.session import table

XS = ["l_quantity", "l_discount", "l_tax"]


def test_gram_ols_equals_spark_linear_regression(spark):
    from pyspark.ml.regression import LinearRegression
    li = table(spark, SF_SMALL, "lineitem")
    ours = {r.term: r.coef for r in L.linear_regression(li, "l_extendedprice", XS).collect()}
    m = LinearRegression(featuresCol="f", labelCol="l_extendedprice", regParam=0.0,
                         solver="normal", standardization=False).fit(C.assemble(li, XS, "f"))
    assert math.isclose(ours["_intercept"], m.intercept, rel_tol=1e-7)
    for x, b in zip(XS, m.coefficients.toArray()):
        assert math.isclose(ours[x], b, rel_tol=1e-6, abs_tol=1e-6)
    assert math.isclose(ours["_r2"], m.summary.r2, rel_tol=1e-9)


def test_kfold_training_fit_equals_direct_fit(spark):
    li = kfold(table(spark, SF_SMALL, "lineitem"), ["l_orderkey"], 4, name="_fold")
    folds = L.kfold_regress(table(spark, SF_SMALL, "lineitem"), "l_extendedprice", XS,
                            ["l_orderkey"], k=4).where("fold = 2").first()
    direct = {r.term: r.coef for r in
              L.linear_regression(li.where("_fold <> 2"), "l_extendedprice", XS).collect()}
    # training sums are total - fold, so the last digits differ by cancellation
    assert math.isclose(folds["b__intercept"], direct["_intercept"], rel_tol=1e-6)
    for x in XS:
        assert math.isclose(folds[f"b_{x}"], direct[x], rel_tol=1e-6, abs_tol=1e-8)


def test_normal_equation_matches_numpy_on_a_small_system(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 14.0), (2.0, 1.0, 1.0, 7.0), (0.0, 1.0, 4.0, 14.0)],
                               "a double, b double, c double, y double")
    got = {r.term: r.theta for r in L.normal_equation(df, "y", ["a", "b", "c"]).collect()}
    x = np.array([[1, 2, 3], [2, 1, 1], [0, 1, 4]], dtype=float)
    want = np.linalg.solve(x, np.array([14.0, 7.0, 14.0]))
    assert np.allclose([got["a"], got["b"], got["c"]], want)


def test_f_tail_closed_forms():
    # F(1, 1): P(F > f) = 1 - 2/pi * atan(sqrt f); F(2, d): (1 + 2f/d)^(-d/2)
    for f in (0.1, 1.0, 7.5):
        assert math.isclose(L.f_sf(f, 1, 1), 1 - 2 / math.pi * math.atan(math.sqrt(f)), rel_tol=1e-9)
        assert math.isclose(L.f_sf(f, 2, 10), (1 + 2 * f / 10) ** -5, rel_tol=1e-9)


def test_glm_equals_spark_summary(spark):
    from pyspark.ml.feature import RFormula
    from pyspark.ml.regression import GeneralizedLinearRegression
    o = table(spark, SF_SMALL, "orders").withColumn(
        "label", (F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).cast("double")).withColumn(
        "price", F.col("o_totalprice") / 1e5)
    g = G.BinomialGLM(o, "label", ["price", "o_orderstatus"])
    x = RFormula(formula="label ~ price + o_orderstatus", stringIndexerOrderType="alphabetDesc", labelCol="y").fit(o).transform(o)
    s = GeneralizedLinearRegression(family="binomial", labelCol="y", tol=1e-12, maxIter=50).fit(x)
    price, status_p, status_o = s.coefficients  # levels in descending order
    assert np.allclose(g.coef, [s.intercept, price, status_o, status_p], rtol=1e-6)
    spark_se = [list(s.summary.coefficientStandardErrors)[k] for k in (0, 2, 1, 3)]  # intercept last
    ours = [se for _, _, se, _, _ in g.coefficients()]
    assert np.allclose(ours, [spark_se[-1], *spark_se[:-1]], rtol=1e-5)
    t = g.lr_test()
    assert math.isclose(t["deviance"], s.summary.deviance, rel_tol=1e-9) and math.isclose(t["aic"], s.summary.aic, rel_tol=1e-9)
    assert math.isclose(t["null_deviance"], s.summary.nullDeviance, rel_tol=1e-9) and t["df"] == 3
    chi2, df, p = g.wald_test([g.terms[1]])
    z = g.coefficients()[1][3]
    assert df == 1 and math.isclose(chi2, z * z, rel_tol=1e-9)
    a, b = g.wald_test(["o_orderstatus_O", "o_orderstatus_P"]), g.wald_test(contrast=[[0, 0, 1, 0], [0, 0, 0, 1]])
    assert a == b
    one = g.wald_test(contrast=[0, 0, 1, -1])
    want = (g.coef[2] - g.coef[3]) ** 2 / (g.cov[2, 2] + g.cov[3, 3] - 2 * g.cov[2, 3])
    assert one[1] == 1 and math.isclose(one[0], want, rel_tol=1e-9)


def test_ks_distance_equals_spark_statistic(spark):
    ev = table(spark, SF_SMALL, "events")
    fit = S.fit_normal(ev, "value").first()
    ours = S.ks_statistic(ev, "value", "event_id", fit["mean"], fit["sd"]).first()["d"]
    d, _ = S.ks_test_spark(ev, "value", fit["mean"], fit["sd"])
    assert math.isclose(ours, d, rel_tol=1e-6)


def test_norm_cdf_and_ppf_are_inverse(spark):
    ps = [0.001, 0.02, 0.3, 0.5, 0.77, 0.999]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    back = [r[0] for r in df.select(S.norm_cdf(S.norm_ppf(F.col("p")))).collect()]
    assert np.allclose(back, ps, atol=1e-7)


def test_gaussian_nb_params_are_group_moments(spark):
    li = table(spark, SF_SMALL, "lineitem")
    params = {(r.label, r.feature): r for r in C.gaussian_nb_fit(li, "l_returnflag", ["l_quantity"]).collect()}
    r = li.where("l_returnflag = 'R'").agg(F.avg("l_quantity"), F.var_pop("l_quantity"), F.count("*")).first()
    p = params[("R", "l_quantity")]
    assert math.isclose(p.mean, r[0], rel_tol=1e-12)
    assert math.isclose(p.var, r[1], rel_tol=1e-6)
    assert math.isclose(p.prior, r[2] / li.count(), rel_tol=1e-12)


def test_grid_has_the_eleven_settings(spark):
    from quarry.plans import models
    rows = models.boosted_trees_grid_orders(spark, SF_SMALL).collect()
    assert sorted((r.trees, r.depth, r.rate) for r in rows) == sorted(models.BOOST_SETTINGS) and len(rows) == 11
    assert all(r.n > 0 and 0 <= r.accuracy <= 1 and 0 <= r.f1 <= 1 for r in rows)


def test_profile_interval_of_intercept_and_slope(spark):
    import random
    rnd = random.Random(4)
    rows = [(x, int(rnd.random() < 1 / (1 + math.exp(0.5 - x)))) for x in (rnd.uniform(-2, 2) for _ in range(150))]
    g = G.BinomialGLM(spark.createDataFrame(rows, "x double, y int"), "y", ["x"])
    x, y = np.array(rows).T

    def deviance(fixed, value):
        free, beta = 1 - fixed, np.zeros(2)
        beta[fixed] = value
        design = np.stack([np.ones_like(x), x])
        for _ in range(50):
            p = 1 / (1 + np.exp(-beta @ design))
            beta[free] += (design[free] @ (y - p)) / (design[free] ** 2 @ (p * (1 - p)))
        p = 1 / (1 + np.exp(-beta @ design))
        return -2 * (y * np.log(p) + (1 - y) * np.log(1 - p)).sum()
    for j, (_, lo, hi, converged) in enumerate(g.profile_confint()):
        assert converged and lo < g.coef[j] < hi
        for b in (lo, hi):
            assert math.isclose(deviance(j, b) - g.deviance, 3.841458820694124, rel_tol=1e-4)
    assert g.profile_passes <= 30


def test_glm_missing_values_unseen_levels_and_separation(spark):
    rows = [(float(i % 7), "a" if i % 3 else "b", float((i * 7 % 11) > 4)) for i in range(60)] + [(None, "a", 1.0), (1.0, None, 0.0), (1.0, "a", None)]
    df = spark.createDataFrame(rows, "x double, f string, y double")
    g = G.BinomialGLM(df, "y", ["x", "f"])
    assert g.n == 60 and g.terms == ["(Intercept)", "x", "f_b"]
    new = spark.createDataFrame([(1, 2.0, "a"), (2, None, "a"), (3, 2.0, "zz"), (4, 2.0, None)], "id int, x double, f string")
    out = {r.id: r for r in g.predict_with_se(new).collect()}
    assert len(out) == 4 and out[1].prob_lo < out[1].prob < out[1].prob_hi
    assert all(out[k].prob is None and out[k].se_fit is None for k in (2, 3, 4))
    with pytest.raises(ValueError):
        G.BinomialGLM(df.where("false"), "y", ["x"])
    # one side has no bound: every b has y = 1
    apart = spark.createDataFrame([("a", float(i % 2)) for i in range(30)] + [("b", 1.0)] * 10, "f string, y double")
    s = G.BinomialGLM(apart, "y", ["f"], max_passes=12)
    (_, lo, hi, _) = s.profile_confint()[1]
    assert not s.converged and 0 < lo < s.coef[1] and hi > 10


def test_elastic_net_search_has_subsets_of_four(spark):
    from quarry.plans import models
    rows = models.elastic_net_search_lineitem(spark, SF_SMALL).collect()
    sizes = {len(r.features.split(",")) for r in rows}
    assert sizes == {2, 3, 4} and sum(r.best for r in rows) == 5
