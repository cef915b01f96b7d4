"""Binomial GLM with its inference.

Every pass over the rows evaluates many coefficient vectors at once and adds up the information
matrix, the score and the log likelihood of each; only these p x p sums reach the driver.  The
fit is Newton's method on one vector; the profile intervals of all terms advance together, both
sides of every term one vector each, so their number of passes does not grow with the terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import logistic
from quarry.operators.classify import Z95, _chi2_ppf1, _chi2_sf, _norm_ppf, _norm_sf
from quarry.sources.files import materialize

MAX_LEVELS = 1000


class Design:
    """Columns of the model matrix: an intercept, numeric terms as they are, and for a text term one
    0/1 column for each level but the first in alphabetical order, which is the reference."""

    def __init__(self, df: DataFrame, terms: Sequence[str]):
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        self.names, self.columns, self.terms = ["(Intercept)"], [lambda: F.lit(1.0)], list(terms)
        for t in terms:
            if kinds[t] != "string":
                self.names.append(t)
                self.columns.append(lambda t=t: F.col(t).cast("double"))
                continue
            levels = sorted(r[0] for r in df.select(t).where(F.col(t).isNotNull()).distinct().limit(MAX_LEVELS + 1).collect())
            if len(levels) > MAX_LEVELS:
                raise ValueError(f"{t} has more than {MAX_LEVELS} levels")
            known = lambda t=t, levels=tuple(levels): F.col(t).isin(*levels)
            for level in levels[1:]:
                self.names.append(f"{t}_{level}")
                # a level that the fit has not seen has no value, like NULL
                self.columns.append(lambda t=t, v=level, known=known: F.when(known(), (F.col(t) == v).cast("double")))

    def vector(self) -> Column:
        """The row of the model matrix; NULL where a term is missing."""
        own = [c() for c in self.columns]
        whole = F.lit(True)
        for c in own:
            whole = whole & c.isNotNull()
        return F.when(whole, F.array(*own))


def evaluate(rows: DataFrame, betas: np.ndarray) -> list[tuple]:
    """(information, score, log likelihood) at every row of ``betas``, from one pass over (a, y)."""
    m, p = betas.shape
    sent = rows.sparkSession.sparkContext.broadcast(betas)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beta = sent.value
        total = np.zeros((m, p * p + p + 1))
        for batch in batches:
            x = np.asarray(batch.column(batch.schema.get_field_index("a")).flatten()).reshape(-1, p)
            y = np.asarray(batch.column(batch.schema.get_field_index("y")))
            eta = x @ beta.T
            mu = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
            like = y[:, None] * eta - np.logaddexp(0, eta)
            for k in range(m):
                w = mu[:, k] * (1 - mu[:, k])
                total[k, :p * p] += ((x * w[:, None]).T @ x).ravel()
                total[k, p * p:-1] += x.T @ (y - mu[:, k])
                total[k, -1] += like[:, k].sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(m), total.shape[1]), pa.int32()), pa.array(np.tile(np.arange(total.shape[1]), m), pa.int32()),
             pa.array(total.ravel())], ["k", "i", "v"])
    sums = np.zeros((m, p * p + p + 1))
    for r in rows.select("a", "y").mapInArrow(run, "k int, i int, v double").groupBy("k", "i").agg(F.sum("v").alias("v")).collect():
        sums[r["k"], r["i"]] = r["v"]
    sent.unpersist()
    return [(s[:p * p].reshape(p, p), s[p * p:-1], s[-1]) for s in sums]


class BinomialGLM:
    """Logit model of ``label`` (0 / 1) on ``terms``.

    Rows with a NULL label or term take no part in the fit (complete rows, as a GLM does);
    :meth:`predict_with_se` keeps them, with a NULL prediction.
    """

    def __init__(self, df: DataFrame, label: str, terms: Sequence[str], max_passes: int = 50):
        self.design = Design(df, terms)
        self.terms = self.design.names
        self.rows = materialize(df.select(self.design.vector().alias("a"), F.col(label).cast("double").alias("y"))
                                .where("a IS NOT NULL AND y IS NOT NULL"), "glm-rows")
        n, positive = self.rows.agg(F.count(F.lit(1)), F.sum("y")).first()
        if not n:
            raise ValueError("there is no complete row to fit")
        self.n, p = n, len(self.terms)
        beta, self.passes, self.converged, before = np.zeros(p), 0, False, math.inf
        while self.passes < max_passes:
            self.passes += 1
            (info, score, self.log_likelihood), = evaluate(self.rows, beta[None, :])
            step = np.linalg.solve(info, score)
            self.coef, self.cov = beta, np.linalg.inv(info)
            left = float(score @ step)  # the square of the step in standard errors
            if left < 1e-18 or left < 1e-9 and left >= before:  # settled, or down to rounding
                self.converged = True
                break
            beta, before = beta + step, left
        mean, self.log_likelihood = positive / n, float(self.log_likelihood)
        self.deviance = -2 * self.log_likelihood
        self.null_deviance = -2 * (positive * math.log(mean) + (n - positive) * math.log(1 - mean)) if 0 < mean < 1 else 0.0
        self.aic = self.deviance + 2 * p

    def _se(self) -> np.ndarray:
        return np.sqrt(np.diag(self.cov))

    def coefficients(self) -> list[tuple]:
        """(term, estimate, std_error, z, p_value)."""
        return [(t, float(b), float(s), float(b / s), float(2 * _norm_sf(abs(b / s))))
                for t, b, s in zip(self.terms, self.coef, self._se())]

    def confint_wald(self, level: float = 0.95) -> list[tuple]:
        """Estimate +- z * SE."""
        z = Z95 if level == 0.95 else _norm_ppf(0.5 + level / 2)
        return [(t, float(b - z * s), float(b + z * s)) for t, b, s in zip(self.terms, self.coef, self._se())]

    def odds_ratios(self, level: float = 0.95, profile: bool = False) -> list[tuple]:
        """Exp of the estimates and of the bounds, Wald or profile."""
        bounds = [(t, lo, hi) for t, lo, hi, _ in self.profile_confint(level)] if profile else self.confint_wald(level)
        return [(t, math.exp(b), math.exp(lo), math.exp(hi)) for (t, lo, hi), b in zip(bounds, self.coef)]

    def wald_test(self, terms: Sequence[str] | None = None, contrast: Sequence[float] | None = None):
        """Joint test that the named coefficients are 0, or that ``contrast`` . b = 0:
        (chi2, df, p_value)."""
        if contrast is not None:
            rule = np.atleast_2d(np.asarray(contrast, dtype=float))
        else:
            rule = np.eye(len(self.coef))[[self.terms.index(t) for t in terms]]
        lb = rule @ self.coef
        chi2 = float(lb @ np.linalg.inv(rule @ self.cov @ rule.T) @ lb)
        return chi2, len(rule), _chi2_sf(chi2, len(rule))

    def lr_test(self) -> dict:
        """Deviance against the null model, its degrees of freedom and p value, log likelihood, AIC."""
        chi2, df = self.null_deviance - self.deviance, len(self.coef) - 1
        return {"null_deviance": self.null_deviance, "deviance": self.deviance, "chi2": chi2, "df": df,
                "p_value": _chi2_sf(chi2, df) if df else 1.0, "log_likelihood": self.log_likelihood, "aic": self.aic}

    def predict_with_se(self, grid: DataFrame, level: float = 0.95) -> DataFrame:
        """``fit``, ``se_fit``, ``prob``, ``prob_lo``, ``prob_hi`` for every row of ``grid``; NULL where
        a term is missing or has a level that the fit has not seen."""
        z = Z95 if level == 0.95 else _norm_ppf(0.5 + level / 2)
        p = len(self.coef)
        a = F.col("_a")
        eta = sum((F.lit(float(b)) * a[j] for j, b in enumerate(self.coef)), F.lit(0.0))
        var = sum((F.lit(float(self.cov[i, j]) * (1 if i == j else 2)) * a[i] * a[j] for i in range(p) for j in range(i, p)), F.lit(0.0))
        out = grid.withColumn("_a", self.design.vector()).withColumn("fit", eta).withColumn("se_fit", F.sqrt(var))
        return out.withColumns({"prob": logistic(F.col("fit")), "prob_lo": logistic(F.col("fit") - z * F.col("se_fit")),
                                "prob_hi": logistic(F.col("fit") + z * F.col("se_fit"))}).drop("_a")

    def profile_confint(self, level: float = 0.95, max_passes: int = 30, tol: float = 1e-6) -> list[tuple]:
        """(term, lo, hi, converged) of every coefficient, from profile likelihoods.

        A bound is where the deviance, minimised over the other coefficients, lies the chi-squared
        quantile above the minimum.  Each pass evaluates one point for every open bound: a Newton step of
        the others, or once these have settled a secant step of the bound.  A bound that the deviance
        never reaches is infinite; ``converged`` is false if ``max_passes`` did not suffice.
        """
        crit = 3.841458820694124 if level == 0.95 else _chi2_ppf1(level)
        sides = [_Side(self, j, sign, math.sqrt(crit), tol) for j in range(len(self.coef)) for sign in (-1, 1)]
        self.profile_passes = 0
        while self.profile_passes < max_passes and any(not s.done for s in sides):
            self.profile_passes += 1
            open_ = [s for s in sides if not s.done]
            for s, (info, score, like) in zip(open_, evaluate(self.rows, np.stack([s.beta for s in open_]))):
                s.take(info, score, like)
        return [(t, sides[2 * j].value, sides[2 * j + 1].value, sides[2 * j].done and sides[2 * j + 1].done)
                for j, t in enumerate(self.terms)]


class _Side:
    """One bound: the next point to evaluate and what is known of the deviance's signed root."""

    def __init__(self, model: BinomialGLM, j: int, sign: int, target: float, tol: float):
        self.model, self.j, self.sign, self.target, self.tol = model, j, sign, target, tol
        self.se = math.sqrt(model.cov[j, j])
        self.free = [i for i in range(len(model.coef)) if i != j]
        self.inner, self.outer = (model.coef[j], -target), None
        self.done, self.value, self.doublings, self.side = False, math.nan, 0, 0
        self._go(model.coef[j] + sign * target * self.se)

    def _go(self, b: float) -> None:
        """Start at ``b``, the others moved along as the covariance says."""
        m, j = self.model, self.j
        self.value = b
        self.beta = m.coef + m.cov[:, j] / m.cov[j, j] * (b - m.coef[j])
        self.beta[j] = b
        self.last = None

    def take(self, info, score, like: float) -> None:
        if self.last is not None and not like >= self.last[1] - 1e-9 * abs(self.last[1]):
            self.beta = (self.beta + self.last[0]) / 2  # a step too far
            return
        f = self.free
        step = np.zeros(len(self.beta))
        if f:
            step[f] = np.linalg.lstsq(info[np.ix_(f, f)], score[f], rcond=None)[0]
        rise = 0.5 * float(score @ step)  # what the others can still gain, to second order
        if rise > 1e-8:
            self.last, self.beta = (self.beta, like), self.beta + step
            return
        over = max(0.0, -2 * (like + rise) - self.model.deviance)
        self._move(math.sqrt(over) - self.target)

    def _move(self, root: float) -> None:
        if abs(root) * self.se < self.tol * max(1.0, abs(self.model.coef[self.j])) * 0.1:
            self.done = True
            return
        here = (self.value, root)
        if self.outer is None and root < 0:
            self.doublings += 1
            slope = (root - self.inner[1]) / (self.value - self.inner[0])
            self.inner = here
            if self.doublings > 20:
                self.done, self.value = True, self.sign * math.inf
                return
            reach = abs(root / slope) * 1.5 if slope * self.sign > 1e-12 else math.inf
            self._go(self.value + self.sign * min(reach, 2 * abs(self.value - self.model.coef[self.j])))
            return
        if root >= 0:
            self.outer = here
            self.inner = (self.inner[0], self.inner[1] / 2) if self.side > 0 else self.inner
            self.side = 1
        else:
            self.inner = here
            self.outer = (self.outer[0], self.outer[1] / 2) if self.side < 0 else self.outer
            self.side = -1
        (a, ra), (b, rb) = self.inner, self.outer
        self._go(a - ra * (b - a) / (rb - ra))
