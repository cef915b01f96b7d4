"""Operators on rows with NULLs, decimals and unseen settings."""

import pytest

from quarry.operators import agg, classify, evaluate, linear, project


def test_gram_and_regression_use_complete_rows(spark):
    rows = [(float(x), 1 + 2.0 * x) for x in range(8)] + [(None, 5.0), (100.0, None)]
    df = spark.createDataFrame(rows, "x double, y double")
    n = agg.gram(df, ["x"], "y", intercept=True).where("col_a = '_n'").first().s
    assert n == 8
    coef = {r.term: r.coef for r in linear.linear_regression(df, "y", ["x"]).collect() if r.term in ("_intercept", "x")}
    assert coef["x"] == pytest.approx(2) and coef["_intercept"] == pytest.approx(1)


def test_evaluation_with_nulls(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (0, 0, 0.2), (1, None, 0.8), (None, 1, 0.95), (0, 0, None)],
                               "y int, p int, s double")
    assert evaluate.accuracy(df, "y", "p").first().accuracy == pytest.approx(3 / 5)
    assert evaluate.auroc(df, "y", "s").first().auroc == pytest.approx(1.0)
    m = evaluate.regression_metrics(spark.createDataFrame(
        [(1.0, 2.0), (3.0, 4.0), (None, 9.0), (5.0, None)], "y double, p double"), "y", "p").first()
    assert (m.n, m.mse, m.r2) == (2, 1.0, 0.0)
    assert evaluate.log_loss(df, "y", "s").first().n == 3


def test_decimals_are_numeric(spark):
    df = spark.sql("SELECT 1 AS a, CAST(2.5 AS DECIMAL(10, 2)) AS price, 'x' AS t")
    assert project.numeric_columns(df).columns == ["a", "price"]
    got = {(r.col_name, r.stat) for r in agg.describe_basic(df).collect()}
    assert ("price", "mean") in got


def test_quantile_labels_stay_apart(spark):
    names = agg.stat_names([0.02, 0.025, 0.25])
    got = spark.range(1).select(*[names[x] for x in (0.02, 0.025, 0.25)]).first()
    assert list(got) == ["2%", "2.5%", "25%"]


def test_one_hot_has_a_slot_per_level(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    out = classify.one_hot(classify.index_categories(df, ["c"]), ["c_idx"])
    assert {r.c_idx_vec.size for r in out.collect()} == {2}


def test_smallest_numbers_are_rounded(spark, tmp_path):
    """exp(value - max) may be the smallest number above 0, whose power of ten is 0."""
    from quarry.plans import catalog
    rows = [(k, 1, v) for k, v in enumerate((0.0, 0.3, 0.6, 1.0, 745.1))]
    spark.createDataFrame(rows, "event_id long, user_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.event_id: r.softmax for r in catalog.REGISTRY["softmax_events_per_user"].run(spark, str(tmp_path)).collect()}
    assert len(got) == 5 and got[4] == 1.0 and 0 < got[0] < 1e-322
