"""Registered flows: the series dataset and the distribution of sample means (Q9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import series as D
from quarry.plans.models import _sql_anderson_darling_p, _sql_ln, _sql_norm_cdf, _sql_norm_ppf
from quarry.plans.registry import SIG, SIG6, register
from quarry.plans.tabular import DAILY_SQL, daily
from quarry.session import table

STEPS = 30


def _scaled(c: str, table: str) -> str:
    return f"CASE WHEN {table}.s_{c} = 0 THEN 0.0 ELSE ({{x}}.{c} - {table}.m_{c}) / {table}.s_{c} END"


_SERIES_SQL = f"""
WITH d AS ({DAILY_SQL}),
r AS (SELECT row_number() OVER (ORDER BY o_orderdate) - 1 AS i, total, CAST(n AS DOUBLE) AS n,
             coalesce(total - lag(total) OVER (ORDER BY o_orderdate), 0.0) AS total_diff FROM d),
k AS (SELECT count(*) - {STEPS} AS f, CAST(round_even((count(*) - {STEPS}) * CAST(0.9 AS DOUBLE), 0) AS BIGINT) AS t FROM r),
w AS (SELECT a.i AS start, x.i - a.i AS step, x.total, x.n, x.total_diff, t
      FROM r a JOIN r x ON x.i BETWEEN a.i AND a.i + {STEPS}, k WHERE a.i < f),
s AS (SELECT step, avg(total) AS m_total, stddev_pop(total) AS s_total, avg(n) AS m_n, stddev_pop(n) AS s_n,
             avg(total_diff) AS m_total_diff, stddev_pop(total_diff) AS s_total_diff FROM w WHERE start < t GROUP BY step)
SELECT w.start, CASE WHEN w.start < w.t THEN 'train' ELSE 'test' END AS split, CAST(w.step AS BIGINT) AS step,
       {_scaled("total", "s").format(x="w")} AS total, {_scaled("n", "s").format(x="w")} AS n,
       {_scaled("total_diff", "s").format(x="w")} AS total_diff,
       {_scaled("total_diff", "z").format(x="y")} AS target, y.total_diff >= 0 AS up
FROM w JOIN s ON w.step = s.step JOIN w y ON y.start = w.start AND y.step = {STEPS} JOIN s z ON z.step = {STEPS}
WHERE w.step < {STEPS}
"""


@register("series_dataset_daily", _SERIES_SQL, {"total": 6, "n": 6, "total_diff": 6, "target": 6})
def series_dataset_daily(spark, sf):
    frames = D.series_dataset(daily(spark, sf), ["o_orderdate"], ["total", "n"], STEPS, "total")
    return frames.select("start", "split", F.posexplode("inputs").alias("step", "x"), "target", "up").select(
        "start", "split", F.col("step").cast("bigint").alias("step"), "x.total", "x.n", "x.total_diff", "target", "up")


_KS_T = "((sqrt(n_samples) + 0.12 + 0.11 / sqrt(n_samples)) * ks_d)"
_KS_P = " + ".join(f"({2.0 * (-1) ** (k - 1)}) * exp({-2.0 * k * k} * {_KS_T} * {_KS_T})" for k in range(1, D.KS_TERMS + 1))


def _sampling_sql(by: str, sample: str) -> str:
    return f"""
WITH v AS (SELECT {by} AS grp, {sample} AS sample, CAST(value AS DOUBLE) AS x FROM events WHERE value IS NOT NULL),
t AS (SELECT grp, avg(x) AS mu, stddev_pop(x) AS sigma FROM v GROUP BY grp),
m AS (SELECT grp, sample, count(*) AS n, avg(x) AS m FROM v GROUP BY ALL),
z AS (SELECT m.*, mu, sigma, (m - mu) / (nullif(sigma, 0) / sqrt(n)) AS z FROM m JOIN t USING (grp)),
f AS (SELECT grp, count(*) AS n_samples, any_value(mu) AS mu, any_value(sigma) AS sigma, avg(m) AS mean_of_means,
             stddev_samp(m) AS sd_of_means, sqrt(avg(sigma * sigma / n)) AS expected_se, avg(z) AS zm,
             stddev_samp(z) AS zs FROM z GROUP BY grp),
r AS (SELECT grp, z, n_samples, (z - zm) / nullif(zs, 0) AS o, row_number() OVER (PARTITION BY grp ORDER BY z, sample) - 1 AS i
      FROM z JOIN f USING (grp)),
c AS (SELECT *, {_sql_norm_cdf("z")} AS cdf, {_sql_norm_ppf("((i + 1 - 0.375) / (n_samples + 0.25))")} AS q,
             (2 * i + 1) * {_sql_ln(_sql_norm_cdf("o"))} + (2 * (n_samples - i) - 1) * {_sql_ln(_sql_norm_cdf("(-o)"))} AS ad FROM r),
g AS (SELECT grp, max(greatest((i + 1) / n_samples - cdf, cdf - i / n_samples)) AS ks_d, corr(o, q) * corr(o, q) AS w,
             sum(ad) AS ad FROM c GROUP BY grp),
a AS (SELECT *, -CAST(n_samples AS DOUBLE) - ad / n_samples AS a2 FROM f JOIN g USING (grp)),
b AS (SELECT *, a2 * (1.0 + 0.75 / n_samples + 2.25 / (CAST(n_samples AS DOUBLE) * n_samples)) AS st FROM a),
p AS (SELECT grp, n_samples, mu, sigma, mean_of_means, sd_of_means, expected_se, ks_d,
             CASE WHEN {_KS_T} < {D.KS_NEAR} THEN 1.0 ELSE greatest(least({_KS_P}, 1.0), 0.0) END AS ks_p, w, a2,
             CASE WHEN n_samples >= 8 THEN {_sql_anderson_darling_p("st")} END AS p_value FROM b)
SELECT *, p_value < 0.01 AS reject FROM p
"""


_PLACES = {"mu": SIG, "sigma": SIG, "mean_of_means": SIG, "sd_of_means": SIG, "expected_se": SIG, "ks_d": SIG6, "ks_p": 8,
           "w": SIG6, "a2": SIG6, "p_value": 8}


@register("sampling_distribution_users", _sampling_sql("event_type", "user_id"), _PLACES)
def sampling_distribution_users(spark, sf):
    """Q9: a user's events are one sample; one test for each type of event."""
    ev = table(spark, sf, "events").withColumnRenamed("event_type", "grp")
    return D.sampling_distribution(ev, ["user_id"], "value", by=["grp"])


@register("sampling_distribution_hours", _sampling_sql("0", "epoch_us(ts) // 3600000000"), _PLACES)
def sampling_distribution_hours(spark, sf):
    """Q9 over the whole table: the events of an hour are one sample."""
    ev = table(spark, sf, "events").select(F.lit(0).alias("grp"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3600000000).alias("hour"), "value")
    return D.sampling_distribution(ev, ["hour"], "value", by=["grp"])
