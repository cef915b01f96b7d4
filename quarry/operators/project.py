"""Projections, filters and reshaping."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.agg import NUMERIC_TYPES, is_numeric


def reorder(df: DataFrame, cols: Sequence[str], target: str | None = None) -> DataFrame:
    """Project ``cols`` in order, with ``target`` (if given) last."""
    cols = [c for c in cols if c != target]
    return df.select(*cols, *([target] if target else []))


def features_of(df: DataFrame, target: str | Sequence[str]) -> DataFrame:
    """Every column except the target(s), in schema order."""
    drop = {target} if isinstance(target, str) else set(target)
    return df.select([c for c in df.columns if c not in drop])


def numeric_columns(df: DataFrame, kinds: Sequence[str] = tuple(NUMERIC_TYPES)) -> DataFrame:
    """Only the columns whose type is one of ``kinds``."""
    return df.select([c for c, t in df.dtypes if is_numeric(t, frozenset(kinds))])


def since(df: DataFrame, col: str, v) -> DataFrame:
    """Rows with ``col >= v``."""
    return df.where(F.col(col) >= F.lit(v))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """P5: drop rows with any NULL (in ``subset`` if given)."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def fill_nulls(df: DataFrame, value, subset: Sequence[str] | None = None) -> DataFrame:
    """Replace NULLs with a constant."""
    return df.na.fill(value, subset=list(subset) if subset else None)


def binary_label(df: DataFrame, predicate: Column, name: str = "label") -> DataFrame:
    """Boolean target from a predicate (NULL input gives False)."""
    return df.withColumn(name, F.coalesce(predicate, F.lit(False)))


def bind_columns(df: DataFrame, named: dict[str, Column]) -> DataFrame:
    """Derived columns side by side, renamed (one frame, no positional join)."""
    return df.select(*[e.alias(n) for n, e in named.items()])


def head_tail(df: DataFrame, order: Sequence[str], head: int = 3,
              tail_from: int = -4, tail_to: int = -1) -> DataFrame:
    """P10: first ``head`` rows and the Python slice ``[tail_from:tail_to]`` of the
    ordered table.  Both sides are top-k sorts (one candidate set per task),
    not a full sort.  Adds ``pos``: the row's position (negative from the end).
    """
    keys = [F.col(o) for o in order]
    first = df.orderBy(*keys).limit(head).withColumn("_side", F.lit(0))
    k = -tail_from
    rev = [F.col(o).desc() for o in order]
    last = df.orderBy(*rev).limit(k).withColumn("_side", F.lit(1))
    # number both sides by a window over at most max(head, k) rows
    from pyspark.sql import Window
    both = first.unionByName(last)
    w = Window.partitionBy("_side").orderBy(*keys)
    numbered = both.withColumn("_rn", F.row_number().over(w))
    pos = F.when(F.col("_side") == 0, F.col("_rn") - 1).otherwise(F.col("_rn") - 1 - k)
    keep = (F.col("_side") == 0) | (pos < tail_to)
    return numbered.withColumn("pos", pos.cast("int")).where(keep).drop("_side", "_rn")


def expand_grid(df: DataFrame, value: str, lo: float, hi: float, num: int, factor: str,
                means: Sequence[str], levels: Sequence | None = None) -> DataFrame:
    """``num`` evenly spaced values of ``value`` from lo to hi for every level
    of ``factor``; every column in ``means`` held at its mean.

    The means enter as scalar subqueries; the levels come from the data (a
    distinct aggregate) unless given.
    """
    mean_cols = [df.agg(F.avg(F.col(m).cast("double"))).scalar().alias(m) for m in means]
    if levels is None:
        base = df.select(factor).where(F.col(factor).isNotNull()).distinct()
    else:
        base = df.sparkSession.range(1).select(
            F.explode(F.array(*[F.lit(v) for v in levels])).alias(factor))
    step = (hi - lo) / (num - 1) if num > 1 else 0.0
    grid = F.explode(F.sequence(F.lit(0), F.lit(num - 1))).alias("_i")
    return (base.select(factor, grid)
            .select(factor, (F.lit(float(lo)) + F.col("_i") * F.lit(step)).alias(value), *mean_cols))


def unpivot_pairs(df: DataFrame, groups: Sequence[Sequence[str]], names: Sequence[str],
                  ids: Sequence[str] = (), slot: str = "slot") -> DataFrame:
    """column groups such as (Year0, Population0), (Year1, Population1) become
    rows with columns ``names``; ``slot`` says which group a row came from.
    Rows whose values are all NULL are dropped."""
    structs = [F.struct(F.lit(i).alias(slot), *[F.col(c).alias(n) for c, n in zip(g, names)])
               for i, g in enumerate(groups)]
    out = df.select(*ids, F.explode(F.array(*structs)).alias("_p")).select(*ids, "_p.*")
    cond = None
    for n in names:
        c = F.col(n).isNotNull()
        cond = c if cond is None else (cond | c)
    return out.where(cond)


def transpose_row(df: DataFrame, cols: Sequence[str], suffix: str = "",
                  ids: Sequence[str] = (), name: str = "name", value: str = "value") -> DataFrame:
    """wide columns to (name, value) rows, ``suffix`` stripped from the names,
    NULL values dropped."""
    long = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        list(ids), list(cols), name, value)
    if suffix:
        long = long.withColumn(name, F.regexp_replace(name, re.escape(suffix) + "$", ""))
    return long.where(F.col(value).isNotNull())


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 5) -> DataFrame:
    """L1: first n rows after an explicit order (a top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)


def rank_desc(df: DataFrame, col: str, tie: Sequence[str] = ()) -> DataFrame:
    """L2: sort by numeric ``col`` descending (ties by ``tie``) with a 1-based rank.

    The rank is the number of rows with a strictly greater value plus one,
    computed from a (value, count) aggregate, so no single-task window runs
    over the whole table.
    """
    from quarry.operators.ordering import row_index
    counts = (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_desc", -F.col(col)))
    idx = row_index(counts, ["_desc"], weight="_c", name="_before")
    ranked = df.join(idx.select(col, "_before"), col, "left")
    return ranked.withColumn("rank", (F.col("_before") + 1).cast("bigint")).drop("_before") \
        .orderBy(F.col(col).desc_nulls_last(), *tie)
