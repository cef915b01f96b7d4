"""Global order without a single-partition window.

Several operators need the position of a row in a total order over the whole
table (first differences, sliding frames, chronological splits, quantiles,
batching, curves).  ``Window.orderBy`` without a partition key moves every row
into one task.  Instead:

1. a deterministic hash sample of the order key (bounded: about 64 rows per
   bucket) gives bucket boundaries, collected to the driver;
2. each row gets its bucket from a binary search over those boundaries (a
   plain expression, so recomputation after a lost executor gives the same
   bucket; Spark's own range partitioner samples with a per-job seed and
   would not);
3. a window partitioned by bucket numbers rows (or sums weights) inside each
   bucket, and per-bucket totals (one row per bucket, so bounded) are
   broadcast back as offsets.

Order keys must be ascending column names forming a total order (end with a
unique key); NULLs come first; negate numeric keys for a descending order.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_PER_BUCKET = 64


def _num_buckets(df: DataFrame, num_buckets: int | None) -> int:
    if num_buckets:
        return num_buckets
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _literal(v, dtype) -> Column:
    if isinstance(v, (_dt.datetime, _dt.date)):
        return F.lit(v.isoformat(sep=" ") if isinstance(v, _dt.datetime) else v.isoformat()).cast(dtype)
    return F.lit(v).cast(dtype)


def _place(key: tuple) -> tuple:
    return tuple((v is not None, v) for v in key)  # NULLs first, as in the windows


def _boundaries(df: DataFrame, keys: Sequence[str], buckets: int, seed: int = 17) -> list[tuple]:
    """Up to ``buckets - 1`` ascending key tuples splitting ``df`` evenly."""
    if buckets <= 1:
        return []
    total = df.count()
    if total == 0:
        return []
    want = SAMPLE_PER_BUCKET * buckets
    frac = min(1.0, 1.2 * want / total)
    sample = df.select(*keys)
    if frac < 1.0:
        from quarry.functions.numeric import hash_unit
        sample = sample.where(hash_unit(seed, keys) < F.lit(frac))
    # bounded collect: about SAMPLE_PER_BUCKET rows per bucket
    rows = [tuple(r) for r in sample.orderBy(*keys).limit(int(2 * want)).collect()]
    out: list[tuple] = []
    for i in range(1, buckets):
        if not rows:
            break
        b = rows[min(len(rows) - 1, (i * len(rows)) // buckets)]
        if not out or _place(b) > _place(out[-1]):
            out.append(b)
    return out


def bucket_expr(df: DataFrame, keys: Sequence[str], bounds: list[tuple]) -> Column:
    """Bucket number: how many boundaries are <= the row's key (binary search)."""
    if not bounds:
        return F.lit(0)
    types = dict(df.dtypes)
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    lits = [F.struct(*[_literal(v, types[k]).alias(f"k{i}") for i, (k, v) in enumerate(zip(keys, b))])
            for b in bounds]

    def search(lo: int, hi: int) -> Column:
        # answer lies in [lo, hi]: number of bounds <= key
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(key >= lits[mid - 1], search(mid, hi)).otherwise(search(lo, mid - 1))

    return search(0, len(bounds))


def _bucketed(df: DataFrame, keys: Sequence[str], num_buckets: int | None) -> DataFrame:
    bounds = _boundaries(df, keys, _num_buckets(df, num_buckets))
    return df.withColumn("_bkt", bucket_expr(df, keys, bounds).cast("int"))


def running_sums(df: DataFrame, order: Sequence[str], weights: Sequence[str],
                 names: Sequence[str], *, num_buckets: int | None = None) -> DataFrame:
    """Exclusive running sums of ``weights`` in ``order`` over the whole table."""
    b = _bucketed(df, order, num_buckets)
    w_in = Window.partitionBy("_bkt").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = b
    for i, wt in enumerate(weights):
        local = local.withColumn(f"_loc{i}", F.coalesce(F.sum(F.col(wt).cast("long")).over(w_in), F.lit(0)))
    sizes = b.groupBy("_bkt").agg(*[F.sum(F.col(wt).cast("long")).alias(f"_w{i}")
                                    for i, wt in enumerate(weights)])
    before = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bkt", *[F.coalesce(F.sum(f"_w{i}").over(before), F.lit(0)).alias(f"_off{i}")
                                     for i in range(len(weights))])
    # one row per bucket: the broadcast is bounded by the bucket count
    out = local.join(F.broadcast(offsets), "_bkt")
    for i, nm in enumerate(names):
        out = out.withColumn(nm, (F.col(f"_off{i}") + F.col(f"_loc{i}")).cast("long"))
    return out.drop("_bkt", *[f"_loc{i}" for i in range(len(weights))],
                    *[f"_off{i}" for i in range(len(weights))])


def row_index(df: DataFrame, order: Sequence[str], *, weight: str | None = None,
              name: str = "_rid", num_buckets: int | None = None) -> DataFrame:
    """Add ``name``: the 0-based position of each row in ``order``.

    With ``weight`` the position is the sum of the weights of all earlier
    rows, so a table of (value, count) pairs yields the first position each
    value occupies.
    """
    if weight is not None:
        return running_sums(df, order, [weight], [name], num_buckets=num_buckets)
    b = _bucketed(df, order, num_buckets)
    local = b.withColumn("_loc", F.row_number().over(Window.partitionBy("_bkt").orderBy(*order)) - 1)
    sizes = b.groupBy("_bkt").agg(F.count(F.lit(1)).alias("_w"))
    before = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bkt", F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offsets), "_bkt")
            .withColumn(name, (F.col("_off") + F.col("_loc")).cast("long"))
            .drop("_bkt", "_loc", "_off"))


def with_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Rows with the columns of their group (``groups`` has one row a group); a NULL key is a group too."""
    g = groups.select(*[F.col(k).alias(f"_wg{i}") for i, k in enumerate(keys)],
                      *[c for c in groups.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_wg{i}")) for i, k in enumerate(keys)]
    return df.join(g, same, how).drop(*[f"_wg{i}" for i in range(len(keys))])


def group_row_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], *,
                    name: str = "_pos", num_buckets: int | None = None) -> DataFrame:
    """Position of each row inside its ``keys`` group, in ``order``.

    Works for a group holding a large share of the table: rows are numbered by
    :func:`row_index` over (keys, order), which splits a large group over many
    buckets, and each group's first position (one aggregate row per group)
    is subtracted.
    """
    idx = row_index(df, [*keys, *order], name="_grid", num_buckets=num_buckets)
    starts = idx.groupBy(*keys).agg(F.min("_grid").alias("_gstart"))
    return (with_groups(idx, starts, keys)
            .withColumn(name, F.col("_grid") - F.col("_gstart"))
            .drop("_grid", "_gstart"))
