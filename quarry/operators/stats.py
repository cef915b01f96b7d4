"""Distribution tests and fits and attention pooling.

Normal CDF and quantile have no built-in Spark expression; they are written
as published rational approximations over column expressions, so they stay
inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordering import group_row_index, row_index
from quarry.sources.files import materialize

# Complementary error function, Chebyshev fit with fractional
# error below 1.2e-7 (Numerical Recipes ``erfcc``), constant term first.
ERFC_COEFFS = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
               0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)

# Inverse normal CDF, rational approximation with relative error
# below 1.15e-9 (P. J. Acklam); a, b for the central region, c, d for the tails.
ACKLAM_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
            1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
ACKLAM_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
            6.680131188771972e+01, -1.328068155288572e+01)
ACKLAM_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
            -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
ACKLAM_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
            3.754408661907416e+00)
ACKLAM_LOW = 0.02425


def _horner(coeffs: Sequence[float], x: Column) -> Column:
    acc = F.lit(coeffs[0])
    for c in coeffs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def erfc(z: Column) -> Column:
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * F.abs(z))
    poly = F.lit(ERFC_COEFFS[-1])
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = F.lit(c) + t * poly
    ans = t * F.exp(-z * z + poly)
    return F.when(z >= 0, ans).otherwise(F.lit(2.0) - ans)


def norm_cdf(x: Column) -> Column:
    """Standard normal CDF (absolute error below about 1e-7)."""
    return F.lit(0.5) * erfc(-x / F.lit(math.sqrt(2.0)))


def norm_ppf(p: Column) -> Column:
    """Standard normal quantile (relative error below 1.15e-9)."""
    q = p - F.lit(0.5)
    r = q * q
    central = _horner(ACKLAM_A, r) * q / (_horner(ACKLAM_B, r) * r + F.lit(1.0))
    ql = F.sqrt(F.lit(-2.0) * F.ln(p))
    low = _horner(ACKLAM_C, ql) / (_horner(ACKLAM_D, ql) * ql + F.lit(1.0))
    qh = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - p))
    high = -_horner(ACKLAM_C, qh) / (_horner(ACKLAM_D, qh) * qh + F.lit(1.0))
    return (F.when(p < ACKLAM_LOW, low).when(p > 1 - ACKLAM_LOW, high).otherwise(central))


def fit_normal(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Maximum-likelihood normal fit: (by..., n, mean, sd) with population sd."""
    x = F.col(col).cast("double")
    aggs = [F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("sd")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def ks_statistic(df: DataFrame, col: str, key: str, mean: float | Column | None = None,
                 sd: float | Column | None = None) -> DataFrame:
    """One-sample Kolmogorov-Smirnov D against N(mean, sd) by ranks.

    With no parameters the fitted mean and population sd are used.  Ranks come
    from the global row index (``key`` breaks ties); D is one max aggregate.
    Returns (n, d).
    """
    x = F.col(col).cast("double")
    base = df.select(x.alias("_x"), F.col(key).alias("_k")).where(F.col("_x").isNotNull())
    if mean is None or sd is None:
        fit = base.agg(F.avg("_x").alias("m"), F.stddev_pop("_x").alias("s"))
        mean = fit.select("m").scalar() if mean is None else mean
        sd = fit.select("s").scalar() if sd is None else sd
    mean = mean if isinstance(mean, Column) else F.lit(float(mean))
    sd = sd if isinstance(sd, Column) else F.lit(float(sd))
    n = base.select(F.count(F.lit(1))).scalar()
    idx = row_index(base, ["_x", "_k"], name="_i")
    cdf = norm_cdf((F.col("_x") - mean) / sd)
    d = F.greatest((F.col("_i") + 1) / n - cdf, cdf - F.col("_i") / n)
    return idx.agg(F.first(n).alias("n"), F.max(d).alias("d"))


def ks_test_spark(df: DataFrame, col: str, mean: float, sd: float):
    """Spark ML's Kolmogorov-Smirnov test against N(mean, sd): (statistic, p_value)."""
    from pyspark.ml.stat import KolmogorovSmirnovTest
    r = KolmogorovSmirnovTest.test(df.select(F.col(col).cast("double").alias(col)), col, "norm",
                                   float(mean), float(sd)).first()
    return float(r.statistic), float(r.pValue)


#: fixed values: lowest modified A^2 of each piece and the coefficients of its exponent (Stephens 1986)
AD_PIECES = [(0.6, (1.2937, -5.709, 0.0186)), (0.34, (0.9177, -4.279, -1.38)),
             (0.2, (-8.318, 42.796, -59.938)), (None, (-13.436, 101.14, -223.73))]
#: beyond this A^2 the formula no longer holds; its p value there is a bound
AD_FAR, AD_LEAST = 10.0, 3.7e-24
#: probabilities are kept above this before their logarithm is taken
TINY = 1e-300


def anderson_darling_p(a: Column) -> Column:
    """p value of the modified A^2 for a normal with fitted mean and deviation."""
    def piece(c):
        return F.exp(F.lit(c[0]) + F.lit(c[1]) * a + F.lit(c[2]) * a * a)
    (one, c1), (two, c2), (three, c3), (_, c4) = AD_PIECES
    return (F.when(a >= AD_FAR, F.lit(AD_LEAST)).when(a >= one, piece(c1)).when(a >= two, piece(c2))
            .when(a >= three, F.lit(1.0) - piece(c3)).otherwise(F.lit(1.0) - piece(c4)))


def shapiro_francia(df: DataFrame, col: str, key: str, by: Sequence[str] = (),
                    alpha: float = 0.01) -> DataFrame:
    """Normality from ranks, the same way at any number of rows.

    ``w`` is Shapiro-Francia's W' = corr(x_(i), m_i)^2, m_i = Phi^-1((i - 3/8) / (n + 1/4)).  Its
    p value is only known for some thousand rows, so the decision comes from the Anderson-Darling
    statistic of the same ranks, ``a2``, modified for the fitted mean and deviation:
    ``reject`` is p < ``alpha`` (True means the data do not look normal), ``test`` names the test.
    Groups of fewer than 8 rows or of one value have no decision.
    Returns (by..., n, w, a2, test, p_value, reject).
    """
    by = list(by)
    base = df.select(*by, F.col(col).cast("double").alias("_x"), F.col(key).alias("_k")) \
        .where(F.col("_x").isNotNull())
    stats = [F.count(F.lit(1)).alias("_n"), F.avg("_x").alias("_mean"), F.stddev_samp("_x").alias("_sd")]
    if by:
        idx = group_row_index(base, by, ["_x", "_k"], name="_i").join(base.groupBy(*by).agg(*stats), by)
        n, mean, sd = F.col("_n"), F.col("_mean"), F.col("_sd")
    else:
        idx = row_index(base, ["_x", "_k"], name="_i")
        n, mean, sd = (base.agg(c).scalar() for c in stats)
    z = (F.col("_x") - mean) / F.when(sd > 0, sd)
    low, high = (F.ln(F.greatest(norm_cdf(v), F.lit(TINY))) for v in (z, -z))
    # the sum over both ends of the order, written for one row of rank i (from 0)
    term = (2 * F.col("_i") + 1) * low + (2 * (n - F.col("_i")) - 1) * high
    # on the scaled values, which are missing in a group of one value: there is no correlation then
    scored = idx.withColumns({"_z": z, "_m": norm_ppf((F.col("_i") + 1 - F.lit(0.375)) / (n + F.lit(0.25))),
                              "_t": F.when(z.isNotNull(), term)})
    agg = [F.count(F.lit(1)).alias("n"), (F.corr("_z", "_m") * F.corr("_z", "_m")).alias("w"), F.sum("_t").alias("_t")]
    g = scored.groupBy(*by).agg(*agg) if by else scored.agg(*agg)
    size = F.col("n").cast("double")
    g = g.withColumn("a2", -size - F.col("_t") / size)
    star = F.col("a2") * (F.lit(1.0) + F.lit(0.75) / size + F.lit(2.25) / (size * size))
    p = F.when(F.col("n") >= 8, anderson_darling_p(star))
    return g.select(*by, "n", "w", "a2", F.lit("anderson-darling").alias("test"), p.alias("p_value")).withColumn(
        "reject", F.col("p_value") < alpha)


# ------------------------------------------------------------- attention

#: keys and queries of one block
KEY_BLOCK, QUERY_BLOCK = 4096, 256


def _blocks(rows: DataFrame, cols: Sequence[str], size: int, name: str) -> DataFrame:
    """(name, one binary matrix for each of ``cols``, [ids]) of runs of at most ``size`` rows as they are read;
    rows with a NULL vector or component take no part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, size):
                part = batch.slice(first, size)
                out = [pa.array([np.stack(part.column(i).to_numpy(zero_copy_only=False)).astype(float).tobytes()], pa.binary())
                       for i in range(len(cols))]
                ids = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), pa.concat_arrays([part.column(i)]))
                       for i in range(len(cols), part.num_columns)]
                yield pa.RecordBatch.from_arrays([*out, *ids], [*cols, *(["ids"] if ids else [])])
    vectors = rows.select(*[F.col(c).cast("array<double>").alias(c) for c in cols], *[c for c in rows.columns if c not in cols])
    for c in cols:
        vectors = vectors.where(F.col(c).isNotNull() & ~F.exists(c, lambda x: x.isNull()))
    more = "".join(f", ids array<{rows.schema[c].dataType.simpleString()}>" for c in rows.columns if c not in cols)
    return materialize(vectors.mapInArrow(run, ", ".join(f"{c} binary" for c in cols) + more), name)


def attention_pool(queries: DataFrame, keys: DataFrame, qid: str, qvec: str, kvec: str,
                   vvec: str | None = None) -> DataFrame:
    """Softmax-weighted mean of value vectors by scaled dot product, ``q . k / sqrt(d)``.

    Keys and queries are packed into blocks.  A pair of blocks gives each query the largest score of
    the block, the sum of exp(score - largest) and the weighted sum of the values; such triples merge,
    so one row for each query and key block is shuffled, never a row for each pair, and neither side is
    collected or limited.  Returns (qid, dim, value).
    """
    same = vvec is None or vvec == kvec
    kb = _blocks(keys.select(F.col(kvec).alias("k"), *([] if same else [F.col(vvec).alias("v")])),
                 ["k"] if same else ["k", "v"], KEY_BLOCK, "key-blocks")
    qb = _blocks(queries.select(F.col(qvec).alias("q"), F.col(qid).alias("id")), ["q"], QUERY_BLOCK, "query-blocks")
    qb = qb.withColumn("b", F.monotonically_increasing_id())
    qb = materialize(qb, "query-blocks")  # the numbers stay as they are
    d_type = queries.schema[qid].dataType.simpleString()
    # a stated set of queries against all keys, block by block
    numbers = [r[0] for r in qb.select("b").collect()]
    pairs = kb.withColumn("part", F.pmod(F.xxhash64("k"), F.lit(64))).withColumn(
        "b", F.explode(F.array(*[F.lit(b) for b in numbers]).cast("array<bigint>"))).join(qb, "b")

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                q = np.frombuffer(row.q).reshape(len(row.ids), -1)
                k = np.frombuffer(row.k).reshape(-1, q.shape[1])
                v = k if same else np.frombuffer(row.v).reshape(len(k), -1)
                s = q @ k.T / math.sqrt(q.shape[1])
                top = s.max(axis=1)
                e = np.exp(s - top[:, None])
                yield pd.DataFrame({"id": list(row.ids), "part": row.part, "top": top, "total": e.sum(axis=1), "sums": list(e @ v)})

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        top = frame["top"].max()
        w = np.exp(frame["top"].to_numpy() - top)
        sums = (np.stack(frame["sums"]) * w[:, None]).sum(axis=0)
        return pd.DataFrame({"id": [frame["id"].iloc[0]], "part": [0], "top": [top], "total": [(frame["total"].to_numpy() * w).sum()],
                             "sums": [sums]})
    schema = f"id {d_type}, part long, top double, total double, sums array<double>"
    kept = ["ids", "q", "k", "part"] + ([] if same else ["v"])
    parts = pairs.select(*kept).mapInPandas(score, schema)
    # merged in two steps, so that no task holds all blocks of a query
    whole = parts.groupBy("id", "part").applyInPandas(merge, schema).groupBy("id").applyInPandas(merge, schema)
    return whole.select(F.col("id").alias(qid), "total", F.posexplode("sums").alias("dim", "x")).select(
        qid, "dim", (F.col("x") / F.col("total")).alias("value"))
