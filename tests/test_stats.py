"""Normality decisions, attention blocks and pivot levels on small hand-made frames."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import agg
from quarry.operators import stats as S


def test_normality_has_a_decision_at_any_size(spark):
    rng = np.random.default_rng(1)
    groups = {"normal": rng.normal(3, 2, 9000), "uniform": rng.random(9000), "small": rng.normal(0, 1, 40),
              "skewed": rng.exponential(1, 300), "few": np.array([1.0, 2.0, 4.0]), "same": np.full(20, 5.0)}
    rows = [(g, i, float(v)) for g, x in groups.items() for i, v in enumerate(x)] + [("small", 999, None)]
    out = {r.g: r for r in S.shapiro_francia(spark.createDataFrame(rows, "g string, k long, x double"), "x", "k", by=["g"]).collect()}
    assert out["normal"].reject is False and out["small"].reject is False
    assert out["uniform"].reject is True and out["skewed"].reject is True
    assert out["few"].reject is None and out["same"].reject is None and out["small"].n == 40
    for g in ("normal", "skewed"):
        x = np.sort(groups[g])
        z = (x - x.mean()) / x.std(ddof=1)
        p = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in z])
        i, n = np.arange(1, len(x) + 1), len(x)
        a2 = -n - ((2 * i - 1) * (np.log(p) + np.log(1 - p[::-1]))).sum() / n
        assert out[g].a2 == pytest.approx(a2, rel=1e-3, abs=1e-3)


def test_p_values_fall_with_the_statistic(spark):
    a = [0.01 * k for k in range(1, 1500)]
    p = [r[0] for r in spark.createDataFrame([(x,) for x in a], "a double").select(S.anderson_darling_p(F.col("a"))).collect()]
    assert all(0 <= x <= 1 for x in p) and all(x >= y - 2e-3 for x, y in zip(p, p[1:]))


@pytest.mark.parametrize("blocks", [(4096, 256), (7, 3)])
def test_attention_blocks(spark, monkeypatch, blocks):
    monkeypatch.setattr(S, "KEY_BLOCK", blocks[0])
    monkeypatch.setattr(S, "QUERY_BLOCK", blocks[1])
    rng = np.random.default_rng(2)
    k, v, q = rng.normal(size=(50, 4)) * 20, rng.normal(size=(50, 3)), rng.normal(size=(11, 4)) * 20
    keys = spark.createDataFrame([(k[i].tolist(), v[i].tolist()) for i in range(50)] + [(None, [0.0] * 3)], "k array<double>, v array<double>")
    qs = spark.createDataFrame([(f"q{i}", q[i].tolist()) for i in range(11)] + [("none", None)], "name string, q array<double>")
    got = {(r["name"], r.dim): r.value for r in S.attention_pool(qs, keys, "name", "q", "k", "v").collect()}
    s = q @ k.T / 2
    w = np.exp(s - s.max(axis=1, keepdims=True))
    want = (w / w.sum(axis=1, keepdims=True)) @ v
    assert len(got) == 33
    assert all(got[f"q{i}", j] == pytest.approx(want[i, j], rel=1e-9) for i in range(11) for j in range(3))


def test_pivot_levels_come_from_the_data(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "new"), ("b", None)], "g string, v string")
    rows = {r.g: r.asDict() for r in agg.tally(df, "g", "v").collect()}
    assert rows["a"]["x"] == 1 and rows["a"]["new"] == 0 and rows["b"]["new"] == 1
    assert set(agg.tally(df, "g", "v", ["x"]).columns) == {"g", "x"}


def test_three_sources_are_reconciled(spark):
    from quarry.operators.reconcile import reconcile_many
    one = lambda rows: spark.createDataFrame(rows, "k string, v double")
    out = {r.k: r for r in reconcile_many({"a": one([("x", 100.0), ("y", 1.0), ("z", 0.0)]), "b": one([("x", 100.5), ("y", 2.0), ("z", 0.0)]),
                                           "c": one([("x", 100.2), ("w", 5.0), ("z", None)])}, ["k"], "v").collect()}
    assert len(out) == 4
    assert (out["x"].status, out["x"].missing, out["x"].n_sources) == ("match", "", 3)
    assert (out["y"].status, out["y"].missing) == ("differs", "c") and out["y"].spread_pct == pytest.approx(100)
    assert (out["w"].status, out["w"].missing) == ("single", "a,b") and out["w"].c == 5.0
    assert out["z"].status == "match" and out["z"].spread_pct is None
