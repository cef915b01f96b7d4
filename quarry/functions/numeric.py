"""Scalar numeric functions and the seeded hash used by splits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def logistic(x: str | Column) -> Column:
    """F8: ``1 / (1 + exp(-x))``."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def rate(num: str | Column, den: str | Column, digits: int | None = None) -> Column:
    """Ratio, NULL when the denominator is 0; optionally half-even rounded."""
    r = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return F.bround(r, digits) if digits is not None else r


def claim_error_pct(claimed: str | Column, actual: str | Column) -> Column:
    """``(claimed - actual) / claimed * 100``; NULL when the claim is 0."""
    c = _c(claimed).cast("double")
    return F.try_divide(c - _c(actual).cast("double"), F.when(c != 0, c)) * 100


def hash_bits(seed: int, keys: Sequence[str | Column]) -> Column:
    """32 bits from md5 of ``seed|k1|k2...``: the same (seed, key) always maps to
    the same value, whatever the partitioning."""
    parts = [F.lit(f"{seed}|")]
    for i, k in enumerate(keys):
        if i:
            parts.append(F.lit("|"))
        parts.append(_c(k).cast("string"))
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 8), 16, 10).cast("bigint")


def hash_unit(seed: int, keys: Sequence[str | Column]) -> Column:
    """Deterministic pseudo-uniform value in [0, 1) from (seed, keys)."""
    return hash_bits(seed, keys) / F.lit(4294967296.0)


def softmax(df: DataFrame, group: Sequence[str], score: str, name: str = "softmax") -> DataFrame:
    """``exp(x - max) / sum(exp(x - max))`` within each group.

    Written as two partial aggregates joined back rather than a whole-group
    window, so one large group is not buffered in a single task.
    """
    g = list(group)
    mx = df.groupBy(*g).agg(F.max(score).alias("_mx"))
    shifted = df.join(mx, g).withColumn("_e", F.exp(F.col(score) - F.col("_mx")))
    tot = shifted.groupBy(*g).agg(F.sum("_e").alias("_z"))
    return shifted.join(tot, g).withColumn(name, F.col("_e") / F.col("_z")).drop("_mx", "_e", "_z")
