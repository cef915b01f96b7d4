"""Out-of-fold prediction and fold metrics against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import classify as C
from quarry.operators import oof as O


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(2)
    n = 120
    x = rng.normal(size=(n, 2))
    y = (x[:, 0] + 0.5 * rng.normal(size=n) > 0).astype(float)
    rows = [(i, i % 4, float(y[i]), float(x[i, 0]), float(x[i, 1])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, fold int, y double, a double, b double"), x, y


class Seen:
    """A model that remembers which folds it was fitted on."""

    def __init__(self, train):
        self.folds = sorted(r[0] for r in train.select("fold").distinct().collect())

    def transform(self, df):
        return df.withColumn("by", F.array(*[F.lit(f) for f in self.folds]))


def test_each_row_once_by_the_model_without_its_fold(frame):
    df, x, _ = frame
    rows = O.oof_predict(Seen, df, "fold", 4).collect()
    assert sorted(r.id for r in rows) == list(range(len(x)))
    assert all(sorted([*r.by, r.fold]) == [0, 1, 2, 3] for r in rows)
    assert rows[0].asDict().keys() >= {"id", "fold", "y", "a", "b"}


def test_gaussian_model_by_hand(frame):
    df, x, y = frame
    pred = O.positive_score(O.oof_predict(O.GaussianNB("y", ["a", "b"]).fit, df, "fold", 4))
    got = {r.id: r for r in pred.collect()}
    fold = np.arange(len(y)) % 4
    for f in range(4):
        own = fold != f
        eps = 1e-9 * x[own].var(axis=0).max()
        s = []
        for c in (0, 1):
            z = x[own & (y == c)]
            m, v = z.mean(axis=0), z.var(axis=0) + eps
            s.append(np.log((own & (y == c)).sum() / own.sum()) - (0.5 * np.log(2 * np.pi * v) + (x - m) ** 2 / (2 * v)).sum(axis=1))
        p = 1 / (1 + np.exp(s[0] - s[1]))
        for i in np.flatnonzero(~own):
            assert got[i].probability == pytest.approx(p[i], rel=1e-9) and got[i].prediction == (p[i] > 0.5)


def test_missing_features_stay_with_null_predictions(spark, frame):
    df, _, _ = frame
    model = O.GaussianNB("y", ["a", "b"]).fit(df)
    out = model.transform(spark.createDataFrame([(1, None, 0.0), (2, 1.0, 0.0)], "id int, a double, b double"))
    rows = {r.id: r for r in out.collect()}
    assert rows[1].prediction is None and rows[1].probability is None
    assert rows[2].prediction in (0.0, 1.0) and sum(rows[2].probability) == pytest.approx(1)


def test_fold_scores(spark):
    rng = np.random.default_rng(3)
    rows = [(int(f), float(rng.integers(0, 2)), float(rng.integers(0, 6)) / 5) for f in rng.integers(0, 3, 400)]
    rows += [(7, 1.0, 0.3), (7, 1.0, 0.9)]  # a fold of one class
    pred = [(f, y, float(s > 0.5), s) for f, y, s in rows] + [(0, 1.0, None, None)]
    df = spark.createDataFrame(pred, "fold int, y double, prediction double, probability double")
    for r in O.fold_scores(df, "y", "fold").collect():
        own = [(y, p, s) for f, y, p, s in pred if f == r.fold]
        tp = sum(y == 1 and p == 1 for y, p, _ in own)
        wrong = sum(p is not None and y != p for y, p, _ in own)
        pos, neg = [s for y, _, s in own if y == 1 and s is not None], [s for y, _, s in own if y == 0]
        wins = [(a > b) + 0.5 * (a == b) for a in pos for b in neg]
        assert r.n == len(own)
        assert r.auroc == (pytest.approx(np.mean(wins)) if wins else None)
        missed = sum(p is None for _, p, _ in own)
        assert r.f1 == pytest.approx(2 * tp / (2 * tp + wrong + missed))


def test_ml_estimators_and_best_model(frame):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df, x, y = frame
    df = C.assemble(df, ["a", "b"])
    est = LogisticRegression(labelCol="y", maxIter=20)
    scores = O.cv_scores(est, df, "y", "fold", 4).collect()
    assert len(scores) == 4 and all(r.n == 30 and r.auroc > 0.7 for r in scores)
    model, points = O.best_of_grid(est, {"regParam": [0.01, 100.0]}, BinaryClassificationEvaluator(labelCol="y"), df, "fold", 4)
    assert len(points) == 2 and model.transform(df).where("prediction = y").count() > 90
