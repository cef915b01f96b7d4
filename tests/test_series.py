"""Series datasets against frames built in numpy; sample means against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import series as D


def brute(v, w, n, frac):
    diff = np.concatenate([[0.0], np.diff(v)])
    data = np.stack([v, w, diff], axis=1)
    frames = np.stack([data[i:i + n + 1] for i in range(len(v) - n)])
    train = round(len(frames) * frac)
    mean, sd = frames[:train].mean(axis=0), frames[:train].std(axis=0)
    # no spread, but for what rounding leaves of it
    flat = sd < 1e-9
    return train, np.where(flat, 0.0, (frames - mean) / np.where(flat, 1.0, sd)), frames[:, n, 2]


@pytest.mark.parametrize("rows,n,frac", [(80, 5, 0.9), (40, 30, 0.9), (25, 3, 0.5), (6, 5, 1.0)])
def test_frames_and_scaler(spark, rows, n, frac):
    rng = np.random.default_rng(3)
    v, w = rng.normal(1e6, 3, rows), rng.normal(size=rows)
    df = spark.createDataFrame([(int(i), float(a), float(b), 7.0) for i, (a, b) in enumerate(zip(v, w))],
                               "t long, v double, w double, c double").repartition(5)
    train, want, diffs = brute(v, w, n, frac)
    got = D.series_dataset(df, ["t"], ["v", "w", "c"], n, "v", frac).orderBy("start").collect()
    assert [r.start for r in got] == list(range(rows - n))
    for r in got:
        assert r.split == ("train" if r.start < train else "test")
        assert [x.c for x in r.inputs] == [0.0] * n
        if train > 1:  # one training frame has no spread at all
            mine = np.array([[x.v, x.w, x.v_diff] for x in r.inputs])
            assert mine == pytest.approx(want[r.start, :n], rel=1e-6, abs=1e-6)
            assert r.target == pytest.approx(want[r.start, n, 2], rel=1e-6, abs=1e-6)
        assert r.up == (diffs[r.start] >= 0) and r.target_diff == pytest.approx(diffs[r.start], abs=1e-9)


def test_series_shorter_than_a_frame(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "t long, v double")
    assert D.series_dataset(df, ["t"], ["v"], 4, "v").count() == 0
    assert D.series_dataset(df.limit(0), ["t"], ["v"], 4, "v").count() == 0


def cdf(x):
    return 0.5 * math.erfc(-x / math.sqrt(2))


def test_sample_means(spark):
    rng = np.random.default_rng(5)
    rows = [(g, s, float(x)) for g in ("a", None) for s in range(40) for x in rng.exponential(size=int(rng.integers(1, 30)))]
    rows += [("flat", s, 2.0) for s in range(9)] + [("a", 3, None)]
    df = spark.createDataFrame(rows, "g string, s long, x double").repartition(7)
    got = {r.g: r for r in D.sampling_distribution(df, ["s"], "x", by=["g"]).collect()}
    assert set(got) == {"a", None, "flat"}
    assert got["flat"].n_samples == 9 and got["flat"].sigma == 0 and got["flat"].ks_d is None and got["flat"].reject is None
    for g in ("a", None):
        values = [x for k, _, x in rows if k == g and x is not None]
        per = {}
        for k, s, x in rows:
            if k == g and x is not None:
                per.setdefault(s, []).append(x)
        mu, sigma = np.mean(values), np.std(values)
        z = sorted((np.mean(xs) - mu) / (sigma / math.sqrt(len(xs))) for xs in per.values())
        d = max(max((i + 1) / len(z) - cdf(x), cdf(x) - i / len(z)) for i, x in enumerate(z))
        r = got[g]
        assert (r.n_samples, r.mu, r.sigma) == (40, pytest.approx(mu), pytest.approx(sigma))
        assert r.sd_of_means == pytest.approx(np.std([np.mean(xs) for xs in per.values()], ddof=1))
        assert r.ks_d == pytest.approx(d, abs=1e-6) and 0 <= r.ks_p <= 1 and 0 < r.w <= 1
        own = [(x - np.mean(z)) / np.std(z, ddof=1) for x in z]
        a2 = -len(z) - sum((2 * i + 1) * (math.log(cdf(own[i])) + math.log(1 - cdf(own[-1 - i]))) for i in range(len(z))) / len(z)
        assert r.a2 == pytest.approx(a2, abs=1e-4)


@pytest.mark.parametrize("t,p", [(1.3581, 0.05), (1.2239, 0.10), (1.6276, 0.01), (0.1, 1.0)])
def test_kolmogorov_points(spark, t, p):
    n = 10000
    d = t / (math.sqrt(n) + 0.12 + 0.11 / math.sqrt(n))
    got = spark.range(1).select(D.kolmogorov_p(F.lit(d), F.lit(n)).alias("p")).first().p
    assert got == pytest.approx(p, abs=1e-4)
