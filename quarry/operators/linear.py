"""Regression from sums of cross-products.

One Spark aggregate (:func:`quarry.operators.agg.gram`) gives X'X, X'y, y'y
and n per fold; that is p x p numbers per fold whatever the row count, so the
solves run on the driver with numpy.  k-fold training sets are ``total - fold``
and held-out errors come from the fold's own sums, so 10 folds, every target
and every feature subset reuse the same single pass over the data.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.agg import gram
from quarry.operators.sample import kfold


class GramSet:
    """Per-fold sums of cross-products over named columns (``_one`` is the constant)."""

    def __init__(self, names: list[str], mats: dict[int, np.ndarray], n: dict[int, float]):
        self.names, self.mats, self.n = names, mats, n
        self.pos = {c: i for i, c in enumerate(names)}

    @classmethod
    def collect(cls, g_long: DataFrame) -> GramSet:
        rows = g_long.collect()  # p x p values per fold: bounded by the column count
        names = sorted({r["col_a"] for r in rows if r["col_a"] != "_n"},
                       key=lambda c: (c != "_one", c))
        pos = {c: i for i, c in enumerate(names)}
        mats: dict[int, np.ndarray] = {}
        n: dict[int, float] = {}
        for r in rows:
            f = int(r["fold"])
            if r["col_a"] == "_n":
                n[f] = float(r["s"])
                continue
            m = mats.setdefault(f, np.zeros((len(names), len(names))))
            m[pos[r["col_a"]], pos[r["col_b"]]] = float(r["s"] or 0.0)
        return cls(names, mats, n)

    def total(self) -> tuple[np.ndarray, float]:
        return sum(self.mats.values()), sum(self.n.values())

    def block(self, m: np.ndarray, rows: Sequence[str], cols: Sequence[str]) -> np.ndarray:
        return m[np.ix_([self.pos[r] for r in rows], [self.pos[c] for c in cols])]


def gram_set(df: DataFrame, cols: Sequence[str], fold: str | Column | None = None) -> GramSet:
    """Collect the Gram table of ``cols`` (plus ``_one``) per fold."""
    return GramSet.collect(gram(df, list(cols), None, fold=fold, intercept=True))


def _solve(xtx: np.ndarray, xty: np.ndarray) -> np.ndarray:
    return np.linalg.pinv(xtx) @ xty


def _held_out(gs: GramSet, m: np.ndarray, n: float, xs: list[str], y: str, b: np.ndarray):
    xtx = gs.block(m, xs, xs)
    xty = gs.block(m, xs, [y])[:, 0]
    yty = gs.block(m, [y], [y])[0, 0]
    sy = gs.block(m, ["_one"], [y])[0, 0]
    sse = yty - 2 * b @ xty + b @ xtx @ b
    sst = yty - sy * sy / n if n else float("nan")
    r2 = 1 - sse / sst if sst else float("nan")
    return float(r2), float(sse / n) if n else float("nan")


def _coef_frame(spark, rows, cols):
    return spark.createDataFrame(rows, cols)


def linear_regression(df: DataFrame, y: str, xs: Sequence[str], intercept: bool = True) -> DataFrame:
    """M1: least squares from one Gram pass: (term, coef), intercept as ``_intercept``;
    plus ``r2`` and ``mse`` on the fitted rows."""
    gs = gram_set(df, [*xs, y])
    m, n = gs.total()
    terms = (["_one"] if intercept else []) + list(xs)
    b = _solve(gs.block(m, terms, terms), gs.block(m, terms, [y])[:, 0])
    r2, mse = _held_out(gs, m, n, terms, y, b)
    rows = [("_intercept" if t == "_one" else t, float(v)) for t, v in zip(terms, b)]
    rows += [("_r2", r2), ("_mse", mse)]
    return _coef_frame(df.sparkSession, rows, "term string, coef double")


def normal_equation(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """M2: ``pinv(X'X) X'y`` without an intercept: (term, theta)."""
    gs = gram_set(df, [*xs, y])
    m, _ = gs.total()
    b = _solve(gs.block(m, xs, xs), gs.block(m, xs, [y])[:, 0])
    return _coef_frame(df.sparkSession, [(t, float(v)) for t, v in zip(xs, b)], "term string, theta double")


def predict_linear(df: DataFrame, coefs: dict[str, float], name: str = "prediction") -> DataFrame:
    """Apply fitted coefficients as a column expression (no UDF)."""
    e = F.lit(float(coefs.get("_intercept", 0.0)))
    for t, v in coefs.items():
        if not t.startswith("_"):
            e = e + F.lit(float(v)) * F.col(t).cast("double")
    return df.withColumn(name, e)


def _folded(df: DataFrame, keys: Sequence[str], k: int, seed: int) -> DataFrame:
    return kfold(df, keys, k, seed, name="_fold")


def kfold_regress(df: DataFrame, y: str, xs: Sequence[str], keys: Sequence[str], k: int = 10,
                  seed: int = 42) -> DataFrame:
    """M3: k fold models from one pass: (fold, n_test, r2, mse, coefficients...)."""
    gs = gram_set(_folded(df, keys, k, seed), [*xs, y], fold="_fold")
    return _kfold_table(df.sparkSession, gs, y, list(xs))


def _kfold_rows(gs: GramSet, y: str, xs: list[str]):
    total, n_all = gs.total()
    terms = ["_one", *xs]
    out = []
    for f in sorted(gs.mats):
        train = total - gs.mats[f]
        b = _solve(gs.block(train, terms, terms), gs.block(train, terms, [y])[:, 0])
        r2, mse = _held_out(gs, gs.mats[f], gs.n[f], terms, y, b)
        out.append((f, int(gs.n[f]), r2, mse, [float(v) for v in b]))
    return out


def _kfold_table(spark, gs: GramSet, y: str, xs: list[str]) -> DataFrame:
    rows = [(f, n, r2, mse, *b) for f, n, r2, mse, b in _kfold_rows(gs, y, xs)]
    cols = ["fold int", "n_test long", "r2 double", "mse double", "b__intercept double"] + \
        [f"b_{x} double" for x in xs]
    return spark.createDataFrame(rows, ", ".join(cols))


def best_target(df: DataFrame, cols: Sequence[str], keys: Sequence[str], k: int = 10,
                seed: int = 42) -> DataFrame:
    """M5: regress each column on all the others (k-fold, one shared Gram pass):
    (target, mean_r2, sd_r2, best) with ``best`` true for the highest mean R2."""
    cols = list(cols)
    gs = gram_set(_folded(df, keys, k, seed), cols, fold="_fold")
    rows = []
    for t in cols:
        r2s = [r2 for _, _, r2, _, _ in _kfold_rows(gs, t, [c for c in cols if c != t])]
        rows.append((t, float(np.mean(r2s)), float(np.std(r2s, ddof=1)) if len(r2s) > 1 else None))
    top = max(rows, key=lambda r: (r[1], r[0]))[0]
    return df.sparkSession.createDataFrame(
        [(t, m, s, t == top) for t, m, s in rows], "target string, mean_r2 double, sd_r2 double, best boolean")


def enet_gram(xtx: np.ndarray, xty: np.ndarray, sx: np.ndarray, sy: float, n: float,
              alpha: float, l1_ratio: float, iters: int = 1000, tol: float = 1e-10):
    """Elastic net by coordinate descent on centred sums.

    Minimises ``1/(2n) |y - b0 - Xb|^2 + alpha*l1*|b|_1 + alpha*(1-l1)/2*|b|^2``;
    returns (b0, b).
    """
    mx, my = sx / n, sy / n
    c = xtx - n * np.outer(mx, mx)
    r = xty - n * mx * my
    p = len(r)
    b = np.zeros(p)
    l1, l2 = n * alpha * l1_ratio, n * alpha * (1 - l1_ratio)
    for _ in range(iters):
        biggest = 0.0
        for j in range(p):
            if c[j, j] <= 0:
                continue
            rho = r[j] - c[j] @ b + c[j, j] * b[j]
            new = math.copysign(max(abs(rho) - l1, 0.0), rho) / (c[j, j] + l2)
            biggest = max(biggest, abs(new - b[j]))
            b[j] = new
        if biggest < tol:
            break
    return my - mx @ b, b


def elastic_net_search(df: DataFrame, cols: Sequence[str], keys: Sequence[str],
                       sizes: Sequence[int] = (2, 3, 4), alphas: Sequence[float] = (0.0, 0.01, 0.1, 1.0),
                       l1_ratio: float = 0.5, k: int = 10, seed: int = 42) -> DataFrame:
    """M6: every target x feature subset (of the given sizes) x alpha, k-fold
    held-out R2, all from one Gram pass: (target, features, alpha, mean_r2, best)."""
    cols = list(cols)
    gs = gram_set(_folded(df, keys, k, seed), cols, fold="_fold")
    total, _ = gs.total()
    rows = []
    for t in cols:
        others = [c for c in cols if c != t]
        for size in sizes:
            for sub in itertools.combinations(others, size):
                sub = list(sub)
                for a in alphas:
                    r2s = []
                    for f in sorted(gs.mats):
                        tr = total - gs.mats[f]
                        ntr = sum(gs.n.values()) - gs.n[f]
                        b0, b = enet_gram(gs.block(tr, sub, sub), gs.block(tr, sub, [t])[:, 0],
                                          gs.block(tr, ["_one"], sub)[0], gs.block(tr, ["_one"], [t])[0, 0],
                                          ntr, a, l1_ratio)
                        r2s.append(_held_out(gs, gs.mats[f], gs.n[f], ["_one", *sub], t,
                                             np.concatenate([[b0], b]))[0])
                    rows.append((t, ",".join(sub), float(a), float(np.mean(r2s))))
    best = {}
    for t, s, a, r in rows:
        if t not in best or r > best[t][2]:
            best[t] = (s, a, r)
    out = [(t, s, a, r, best[t][:2] == (s, a)) for t, s, a, r in rows]
    return df.sparkSession.createDataFrame(
        out, "target string, features string, alpha double, mean_r2 double, best boolean")


def _betacf(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1, a - 1
    c, d = 1.0, 1 - qab * x / qap
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 300):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1 + aa * d
        d = 1 / (d if abs(d) > tiny else tiny)
        c = 1 + aa / c if abs(1 + aa / c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1 + aa * d
        d = 1 / (d if abs(d) > tiny else tiny)
        c = 1 + aa / c if abs(1 + aa / c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1) < 1e-15:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b) (continued fraction)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lb = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lb) * _betacf(a, b, x) / a
    return 1 - math.exp(lb) * _betacf(b, a, 1 - x) / b


def f_sf(f: float, d1: float, d2: float) -> float:
    """Upper tail of the F distribution."""
    if f is None or not math.isfinite(f) or f <= 0:
        return 1.0 if (f is not None and f <= 0) else 0.0
    return betainc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def f_regression(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """M4: univariate F test of each feature against ``y``: (feature, r, F, p_value).

    ``F = r^2 / (1 - r^2) * (n - 2)`` from one correlation aggregate; the p value
    (F with 1 and n - 2 degrees of freedom) is a driver-side scalar per feature.
    """
    aggs = [F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias(x) for x in xs]
    row = df.agg(F.count(F.lit(1)).alias("_n"), *aggs).first()
    n = row["_n"]
    out = []
    for x in xs:
        r = row[x]
        fval = None if r is None or abs(r) >= 1 else r * r / (1 - r * r) * (n - 2)
        out.append((x, r, fval, f_sf(fval, 1, n - 2) if fval is not None else None))
    return df.sparkSession.createDataFrame(out, "feature string, r double, F double, p_value double")
