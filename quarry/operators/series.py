"""Series datasets for sequence models and the distribution of sample means (Q9)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordering import group_row_index, with_groups
from quarry.operators.stats import TINY, anderson_darling_p, norm_cdf, norm_ppf
from quarry.operators.window import _diff_of, _frames_of, positions
from quarry.sources.files import materialize


def step_scaler(idx: DataFrame, pos: str, cols: Sequence[str], n: int, train: int) -> list[dict]:
    """Mean and population sd of every column at each of the n + 1 steps of the first ``train`` frames.

    Step j of those frames covers the positions [j, j + train), so no frame is built: the rows that
    all steps share are one group and each of the at most 2 n edge positions is its own.  Returns
    n + 1 dictionaries ``{col: (mean, sd)}``; a column without a value there has (None, None).
    """
    p = F.col(pos)
    cls = F.when((p >= n) & (p < train), -1).otherwise(p)
    x = {c: F.col(c).cast("double") for c in cols}
    aggs = [f(x[c]).alias(f"{c}\u0001{k}") for c in cols for k, f in (("n", F.count), ("m", F.avg), ("v", F.var_pop))]
    parts = idx.where(p < n + train).groupBy(cls.alias("_cls")).agg(*aggs).collect()  # at most 2 n + 1 rows
    out = []
    for j in range(n + 1):
        mine = [r for r in parts if r["_cls"] == -1 or j <= r["_cls"] < j + train]
        step = {}
        for c in cols:
            seen = [(r[f"{c}\u0001n"], r[f"{c}\u0001m"], r[f"{c}\u0001v"]) for r in mine if r[f"{c}\u0001n"]]
            total = sum(k for k, _, _ in seen)
            if not total:
                step[c] = (None, None)
                continue
            mean = math.fsum(k * m for k, m, _ in seen) / total
            step[c] = (mean, math.sqrt(math.fsum(k * (v + (m - mean) ** 2) for k, m, v in seen) / total))
        out.append(step)
    return out


def series_dataset(df: DataFrame, order: Sequence[str], cols: Sequence[str], n: int, value: str,
                   frac: float = 0.9) -> DataFrame:
    """Q7: scaled frames of ``n`` rows, the next row's difference of ``value`` and its direction.

    The columns are ``cols`` and ``<value>_diff`` (first difference, 0 for the first row), scaled at each
    step with the mean and sd of that step over the training frames only, which are the first
    ``frac`` of all frames.  A step without spread scales to 0 and NULLs stay NULL.  Returns
    (start, split, inputs: array<struct<pos, cols..., value_diff>>, target, target_diff, up): ``target`` is the
    scaled difference, ``up`` whether it is not negative.  The input is read and ordered once.
    """
    d = f"{value}_diff"
    idx = materialize(_diff_of(positions(df, order, (), "_p"), "_p", value, (), d), "series")
    allc = [*cols, d]
    frames = max(idx.count() - n, 0)
    train = round(frames * frac)
    scaler = step_scaler(idx, "_p", allc, n, train)

    def scaled(x: Column, mean: Column, sd: Column) -> Column:
        return F.when(sd == 0, x * 0.0).otherwise((x.cast("double") - mean) / sd)

    def table(c: str, k: int) -> Column:
        return F.array(*[F.lit(s[c][k]).cast("double") for s in scaler[:n]])

    inputs = F.transform("inputs", lambda x, i: F.struct(
        x["pos"].alias("pos"), *[scaled(x[c], table(c, 0)[i], table(c, 1)[i]).alias(c) for c in allc]))
    mean, sd = (F.lit(v).cast("double") for v in scaler[n][d])
    return _frames_of(idx, "_p", allc, n, d, ()).select(
        "start", F.when(F.col("start") < train, "train").otherwise("test").alias("split"), inputs.alias("inputs"),
        scaled(F.col("target"), mean, sd).alias("target"), F.col("target").alias("target_diff"),
        (F.col("target") >= 0).alias("up"))


#: terms of the Kolmogorov series; below KS_NEAR its sum is 1 to more digits than it can be computed
KS_TERMS, KS_NEAR = 20, 0.3


def kolmogorov_p(d: Column, n: Column) -> Column:
    """p value of a KS distance, with the size correction of Stephens."""
    root = F.sqrt(n.cast("double"))
    t = (root + F.lit(0.12) + F.lit(0.11) / root) * d
    total = F.lit(0.0)
    for k in range(1, KS_TERMS + 1):
        total = total + F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * t * t)
    return F.when(t < KS_NEAR, 1.0).otherwise(F.greatest(F.least(total, F.lit(1.0)), F.lit(0.0)))


def sampling_distribution(df: DataFrame, sample: Sequence[str], value: str, by: Sequence[str] = (),
                          alpha: float = 0.01) -> DataFrame:
    """Q9: do the means of the samples look normal, about the mean and with the error that theory gives?

    A sample is a (by, sample) group; ``mu`` and ``sigma`` are the mean and population sd of all values of a
    ``by`` group and every sample mean is standardised by ``mu`` and ``sigma / sqrt(n)``, so samples may
    differ in size.  The KS distance of these scores is to N(0, 1), nothing fitted; W' and Anderson-Darling
    (mean and sd fitted) are of the same scores.  Returns (by..., n_samples, mu, sigma, mean_of_means,
    sd_of_means, expected_se, ks_d, ks_p, w, a2, p_value, reject): ``expected_se`` is the root mean square of
    sigma / sqrt(n).  One row per ``by`` group; sigma of 0 leaves the tests NULL, as do
    fewer than 8 samples the Anderson-Darling decision.  NULL values take no part.
    """
    by, sample = list(by), list(sample)
    x = F.col(value).cast("double")
    keys = by or ["_all"]
    src = df.where(x.isNotNull()) if by else df.where(x.isNotNull()).withColumn("_all", F.lit(0))
    per = materialize(src.groupBy(*keys, *sample).agg(F.count(x).alias("_n"), F.avg(x).alias("_m"), F.var_pop(x).alias("_v")),
                      "sample-means")
    # all values of a group from its samples: weighted mean, then squares about it
    centre = per.groupBy(*keys).agg(F.sum("_n").alias("_t"), (F.sum(F.col("_n") * F.col("_m")) / F.sum("_n")).alias("_mu"))
    centred = with_groups(per, centre, keys)
    squares = F.sum(F.col("_n") * (F.col("_v") + F.pow(F.col("_m") - F.col("_mu"), 2)))
    spread = centred.groupBy(*keys).agg(F.sqrt(squares / F.first("_t")).alias("_sigma"))
    z = (F.col("_m") - F.col("_mu")) / (F.when(F.col("_sigma") > 0, F.col("_sigma")) / F.sqrt("_n"))
    scored = materialize(with_groups(centred, spread, keys).withColumn("_z", z), "sample-scores")

    fit = scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_samples"), F.first("_mu").alias("mu"), F.first("_sigma").alias("sigma"),
        F.avg("_m").alias("mean_of_means"), F.stddev_samp("_m").alias("sd_of_means"),
        F.sqrt(F.avg(F.col("_sigma") * F.col("_sigma") / F.col("_n"))).alias("expected_se"),
        F.avg("_z").alias("_zm"), F.stddev_samp("_z").alias("_zs"))
    idx = group_row_index(scored.where(F.col("_z").isNotNull()).select(*keys, *sample, "_z"), keys, ["_z", *sample], name="_i")
    ranked = with_groups(idx, fit, keys)
    n, i = F.col("n_samples"), F.col("_i")
    cdf = norm_cdf(F.col("_z"))
    own = (F.col("_z") - F.col("_zm")) / F.when(F.col("_zs") > 0, F.col("_zs"))
    low, high = (F.ln(F.greatest(norm_cdf(v), F.lit(TINY))) for v in (own, -own))
    tests = ranked.groupBy(*keys).agg(
        F.max(F.greatest((i + 1) / n - cdf, cdf - i / n)).alias("ks_d"),
        F.corr(own, norm_ppf((i + 1 - F.lit(0.375)) / (n + F.lit(0.25)))).alias("_r"),
        F.sum(F.when(own.isNotNull(), (2 * i + 1) * low + (2 * (n - i) - 1) * high)).alias("_s"))
    size = n.cast("double")
    star = F.col("a2") * (F.lit(1.0) + F.lit(0.75) / size + F.lit(2.25) / (size * size))
    # a group without spread has no ranks: its tests are NULL
    untested = fit.where(~(F.col("sigma") > 0)).select(*keys, *[F.lit(None).cast("double").alias(c) for c in ("ks_d", "_r", "_s")])
    out = (with_groups(fit, tests.unionByName(untested), keys)
           .withColumn("a2", -size - F.col("_s") / size)
           .withColumn("p_value", F.when(n >= 8, anderson_darling_p(star))))
    return out.select(*by, "n_samples", "mu", "sigma", "mean_of_means", "sd_of_means",
                      "expected_se", "ks_d", F.when(F.col("ks_d").isNotNull(), kolmogorov_p(F.col("ks_d"), n)).alias("ks_p"),
                      (F.col("_r") * F.col("_r")).alias("w"), "a2", "p_value", (F.col("p_value") < alpha).alias("reject"))
