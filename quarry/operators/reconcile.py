"""Reconcile one measure reported by two or more sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(a: DataFrame, b: DataFrame, key: Sequence[str], value_a: str, value_b: str,
              tol: float = 0.01) -> DataFrame:
    """Full outer join on ``key``: (key..., value_a, value_b, diff_pct, status).

    ``diff_pct = (a - b) / b * 100`` (NULL when b is 0 or missing); status is
    'match' within ``tol`` (relative), 'differs', 'only_a' or 'only_b'.  Both
    sides should be unique on ``key`` (aggregate them first), so the join is a
    plain shuffle join on the key, never a fan-out.
    """
    key = list(key)
    j = a.select(*key, F.col(value_a).cast("double").alias(value_a)).join(
        b.select(*key, F.col(value_b).cast("double").alias(value_b)), key, "full")
    va, vb = F.col(value_a), F.col(value_b)
    pct = F.try_divide(va - vb, F.when(vb != 0, vb)) * 100
    status = (F.when(vb.isNull(), "only_a").when(va.isNull(), "only_b")
              .when(F.abs(va - vb) <= F.lit(float(tol)) * F.abs(vb), "match").otherwise("differs"))
    return j.select(*key, va, vb, pct.alias("diff_pct"), status.alias("status"))


def reconcile_many(sources: dict[str, DataFrame], key: Sequence[str], value: str, tol: float = 0.01) -> DataFrame:
    """J1 for any number of sources: (key..., one column a source, n_sources, missing, spread_pct, status).

    The sources are stacked and meet in one grouped aggregate on ``key``, so the number of shuffles
    does not grow with them and a key that only one source knows is kept.  ``missing`` names the sources
    without a value; ``spread_pct = |largest / smallest - 1| * 100`` (NULL when the smallest is 0); status is
    'match' when all values lie within ``tol`` of the smallest, 'differs', or 'single' when there is nothing to
    compare.  A source with several rows for a key counts with its largest value.
    """
    key = list(key)
    stacked = None
    for name, df in sources.items():
        part = df.select(*key, F.lit(name).alias("_s"), F.col(value).cast("double").alias("_v"))
        stacked = part if stacked is None else stacked.unionByName(part)
    own = [F.max(F.when(F.col("_s") == name, F.col("_v"))).alias(name) for name in sources]
    g = stacked.groupBy(*key).agg(*own)
    values = [F.col(f"`{name}`") for name in sources]
    lo, hi = (F.least(*values), F.greatest(*values)) if len(values) > 1 else (values[0], values[0])
    n = sum((v.isNotNull().cast("int") for v in values), F.lit(0))
    absent = F.concat_ws(",", *[F.when(v.isNull(), name) for v, name in zip(values, sources)])
    status = F.when(n < 2, "single").when(hi - lo <= F.lit(float(tol)) * F.abs(lo), "match").otherwise("differs")
    return g.select(*key, *values, n.cast("long").alias("n_sources"), absent.alias("missing"),
                    (F.abs(F.try_divide(hi, F.when(lo != 0, lo)) - 1) * 100).alias("spread_pct"), status.alias("status"))
