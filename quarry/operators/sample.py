"""Seeded splits and samples.

Every decision is a function of md5(seed | key), never of row layout, so the
same key lands on the same side at any partitioning and after task retries.
Rows with equal keys stay together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.numeric import hash_bits, hash_unit


def hash_split(df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int = 42,
               name: str = "split") -> DataFrame:
    """Add ``split`` = index of the weight bucket the key's hash falls in."""
    total = float(sum(weights))
    u = hash_unit(seed, keys)
    edges, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        edges.append(acc)
    expr = F.lit(len(weights) - 1)
    for i in reversed(range(len(edges))):
        expr = F.when(u < F.lit(edges[i]), F.lit(i)).otherwise(expr)
    return df.withColumn(name, expr.cast("int"))


def split_frames(df: DataFrame, keys: Sequence[str], weights: Sequence[float],
                 seed: int = 42) -> list[DataFrame]:
    marked = hash_split(df, keys, weights, seed, "_split")
    return [marked.where(F.col("_split") == i).drop("_split") for i in range(len(weights))]


def kfold(df: DataFrame, keys: Sequence[str], k: int, seed: int = 42,
          name: str = "fold") -> DataFrame:
    """R2: fold number in [0, k) per key."""
    return df.withColumn(name, F.pmod(hash_bits(seed, keys), F.lit(k)).cast("int"))


def sample_fraction(df: DataFrame, keys: Sequence[str], fraction: float,
                    seed: int = 42) -> DataFrame:
    """Keep keys whose hash is below ``fraction`` (without replacement)."""
    return df.where(hash_unit(seed, keys) < F.lit(float(fraction)))


#: groups of keys, per wanted row, whose smallest hashes bound the hashes that can be drawn, and the share
#: of the keys (one in so many) that the bound is taken from
GROUPS, BOUND_SHARE = 8, 16


def sample_n(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42,
             replicates: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """``n`` rows without replacement for each of ``replicates`` draws (per
    ``by`` group if given).  Replicate r ranks rows by hash(seed, r, key) and
    keeps the first n.

    One in ``BOUND_SHARE`` keys falls into a fixed number of groups; the n-th smallest of the groups'
    smallest hashes is a bound that at least n rows keep, so all other rows are compared with it, and
    those above it are never sorted or shuffled."""
    from quarry.sources.files import materialize
    rep = F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate")
    draw = hash_bits(seed, [F.col("replicate"), *keys])
    part = [F.col(c).alias(f"_s{i}") for i, c in enumerate(by)]
    groups = GROUPS * max(1, n)
    least = (df.select(*part, *keys, F.pmod(F.xxhash64(*keys), F.lit(groups * BOUND_SHARE)).alias("_b"))
             .where(F.col("_b") < groups).select("*", rep)
             .groupBy("replicate", *[f"_s{i}" for i in range(len(by))], "_b").agg(F.min(draw).alias("_m")))
    # no bound where fewer than n groups have a hash; the bounds are stored, so that their size decides how they are joined
    bound = materialize(least.groupBy(F.col("replicate").alias("_r"), *[f"_s{i}" for i in range(len(by))])
                        .agg(F.get(F.array_sort(F.collect_list("_m")), n - 1).alias("_t")), "sample-bounds")
    x = df.select("*", rep).withColumn("_h", draw)
    same = [F.col("replicate") == F.col("_r"), *[x[c].eqNullSafe(bound[f"_s{i}"]) for i, c in enumerate(by)]]
    # a NULL hash sorts first, as in the window
    kept = (x.join(bound, same).where("_h IS NULL OR _t IS NULL OR _h <= _t")
            .drop("_r", "_t", *[f"_s{i}" for i in range(len(by))]))
    w = Window.partitionBy("replicate", *by).orderBy("_h", *keys)
    return kept.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn", "_h")


def sample_balanced(df: DataFrame, category: str, keys: Sequence[str], n: int,
                    seed: int = 42) -> DataFrame:
    """``n`` items from every category (each category equally likely)."""
    w = Window.partitionBy(category).orderBy(hash_bits(seed, keys), *keys)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
