"""Registry of named queries over the driver tables.

Each entry is a Spark callable ``(spark, sf_dir) -> DataFrame`` plus, where
SQL can express the same rows, an equivalent DuckDB query over the views
``region nation customer ... conversations``.  Floating columns listed in
``rounding`` are rounded to a fixed number of places on both sides, so sums
taken in a different order compare equal.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


SIG = "sig"  # round to 9 significant digits instead of fixed places
SIG6 = "sig6"  # 6 significant digits: values from a matrix solve or an iterative fit


def _spark_round(c: str, d) -> "F.Column":
    # the same IEEE steps as the SQL side (scale, round half away from zero, unscale)
    x = F.col(c)
    if d in (SIG, SIG6):
        k = 1e8 if d == SIG else 1e5
        e = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))))
        # below 1e-323 the power of ten is 0 and there is nothing to round
        return F.when(x == 0, F.lit(0.0)).when(e == 0, x).otherwise(
            F.round(x / e * F.lit(k), 0) / F.lit(k) * e).alias(c)
    return (F.round(x * F.lit(float(10 ** d)), 0) / F.lit(float(10 ** d))).alias(c)


def _sql_round(c: str, d) -> str:
    if d in (SIG, SIG6):
        k = "1e8" if d == SIG else "1e5"
        e = f"pow(10.0, floor(log10(abs({c}))))"
        return f"CASE WHEN {c} = 0 THEN 0.0 ELSE round({c} / {e} * {k}) / {k} * {e} END AS {c}"
    return f"round({c} * {float(10 ** d)}) / {float(10 ** d)} AS {c}"


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    rounding: dict[str, int] = field(default_factory=dict)

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.fn(spark, sf_dir)
        if self.rounding:
            df = df.select(*[_spark_round(c, self.rounding[c]) if c in self.rounding
                             else F.col(c) for c in df.columns])
        return df

    def oracle(self) -> str | None:
        if self.sql is None or not self.rounding:
            return self.sql
        rep = ", ".join(_sql_round(c, d) for c, d in self.rounding.items())
        return f"SELECT * REPLACE ({rep}) FROM ({self.sql.strip().rstrip(';')}) AS _q"


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, rounding: dict[str, int] | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, dict(rounding or {}))
        return fn
    return deco
