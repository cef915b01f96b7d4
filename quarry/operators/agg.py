"""Descriptive aggregates.

Every statistic is one partial/final aggregate per pass.  Exact quantiles take
two scans: sketches bracket every wanted rank, then values outside the brackets
are counted by the gap they fall in and only those inside are counted one by one
(map-side combine, so a hot value is one row).  The rows left are numbered in a
range-partitioned global order and those at the wanted ranks are kept.
``exact=False`` returns the sketches' values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ordering import row_index

QUARTILES = (0.25, 0.5, 0.75)

#: the sketches' accuracy (a rank is off by at most n / SKETCH) and half a bracket's width
SKETCH = 10000
MARGIN = 4.0 / SKETCH


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
                name: str = "col_name", value: str = "value") -> DataFrame:
    """Unpivot numeric ``cols`` to (by..., col_name, value double); nulls dropped."""
    cast = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    return (cast.unpivot(list(by), list(cols), name, value)
            .where(F.col(value).isNotNull()))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = QUARTILES,
              by: Sequence[str] = (), exact: bool = True,
              accuracy: int = 10000) -> DataFrame:
    """Linear-interpolated quantiles (pandas / R type 7), long form.

    Returns (by..., col_name, prob, value).
    """
    by = list(by)
    long = long_values(df, cols, by)
    if not exact:
        arr = F.percentile_approx("value", list(probs), accuracy)
        return (long.groupBy(*by, "col_name").agg(arr.alias("_q"))
                .select(*by, "col_name", F.posexplode("_q").alias("_i", "value"))
                .select(*by, "col_name",
                        F.element_at(F.array(*[F.lit(float(p)) for p in probs]),
                                     F.col("_i") + 1).alias("prob"), "value"))
    from quarry.sources.files import materialize
    keys = [*by, "col_name"]
    counts = materialize(_bracketed_counts(df, cols, probs, by), "bracketed-counts")
    res = materialize(quantiles_from_counts(counts, keys, probs, region="_r"), "quantiles")
    found = res.select(*keys, "prob", "value").where(res["_inside"])
    missed = res.where(~F.col("_inside")).select(*keys).distinct()
    if missed.isEmpty():
        return found
    # a sketch off by more than its bound: every value of these columns is counted
    again = _null_safe_semi(long, missed, keys).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_cnt"))
    full = quantiles_from_counts(materialize(again, "value-counts"), keys, probs)
    return _null_safe_semi(found, missed, keys, "left_anti").unionByName(full)


def _null_safe_semi(df: DataFrame, keep: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    k = keep.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)])
    return df.join(k, [df[c].eqNullSafe(k[f"_k{i}"]) for i, c in enumerate(keys)], how)


def _bracketed_counts(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                      by: Sequence[str]) -> DataFrame:
    """(by..., col_name, _r, value, _cnt): odd ``_r`` numbers the values inside a bracket, even
    ``_r`` the gaps between brackets, whose values are one row; ``_r``, ``value`` follow the order
    of the values.  Groups too small for a bracket of a few rows keep all their values."""
    by, cols = list(by), list(cols)
    xs = [F.col(c).cast("double") for c in cols]
    edges = [max(p - MARGIN, 0.0) for p in probs] + [min(p + MARGIN, 1.0) for p in probs]
    sketch = [F.struct(F.count(x).alias("n"), F.percentile_approx(x, edges, SKETCH).alias("q")).alias(f"_q{i}")
              for i, x in enumerate(xs)]
    k = len(probs)
    if by:
        # one row for each group; stored first, so that its known size decides how it is joined: few
        # groups are broadcast and the rows are not dealt by group
        from quarry.sources.files import materialize
        g = materialize(df.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)]).agg(*sketch), "group-sketches")
        rows = df.join(g, [df[c].eqNullSafe(g[f"_g{i}"]) for i, c in enumerate(by)])
        size = [F.col(f"_q{i}.n") for i in range(len(cols))]
        edge = [[F.col(f"_q{i}.q")[j] for j in range(2 * k)] for i in range(len(cols))]
    else:
        rows = df
        row = df.agg(*sketch).first()  # a few numbers a column
        size = [F.lit(row[i]["n"]) for i in range(len(cols))]
        edge = [[F.lit(v).cast("double") for v in (row[i]["q"] or [None] * 2 * k)] for i in range(len(cols))]

    def placed(x: Column, n: Column, e: list[Column]) -> Column:
        inside, above = F.lit(False), F.lit(0)
        for lo, hi in zip(e[:k], e[k:]):
            inside = inside | ((x >= lo) & (x <= hi))
            above = above + F.when(x > hi, 2).otherwise(0)
        inside = (n * F.lit(MARGIN) < 2) | inside
        r = F.when(n * F.lit(MARGIN) < 2, 1).otherwise(above + inside.cast("int"))
        return F.when(x.isNotNull(), F.struct(r.alias("_r"), F.when(inside, x).otherwise(0.0).alias("value")))

    wide = rows.select(*by, *[placed(*t).alias(c) for c, t in zip(cols, zip(xs, size, edge))])
    long = wide.unpivot(by, cols, "col_name", "_p").where(F.col("_p").isNotNull())
    return (long.groupBy(*by, "col_name", F.col("_p._r").alias("_r"), F.col("_p.value").alias("value"))
            .agg(F.count(F.lit(1)).alias("_cnt")))


def quantiles_from_counts(counts: DataFrame, keys: Sequence[str],
                          probs: Sequence[float] = QUARTILES, region: str | None = None) -> DataFrame:
    """Exact type-7 quantiles from a (keys..., value, _cnt) table with unique
    (keys, value): returns (keys..., prob, value).

    With ``region`` the order is (region, value); rows of an even region stand for many
    values, and ``_inside`` tells whether a quantile needed none of them.
    """
    keys = list(keys)
    idx = row_index(counts, [*keys, *([region] if region else []), "value"], weight="_cnt")
    # one row per (group, column): start rank in the global order and size
    info = idx.groupBy(*keys).agg(F.min("_rid").alias("_start"), F.sum("_cnt").alias("_n"))
    pos = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")
    targets = (info.select(*keys, "_start", "_n", pos)
               .withColumn("_h", (F.col("_n") - 1) * F.col("prob"))
               .withColumn("_lo", F.col("_start") + F.floor("_h"))
               .withColumn("_hi", F.col("_start") + F.ceil("_h"))
               .withColumn("_frac", F.col("_h") - F.floor("_h")))
    t, i = targets.alias("t"), idx.alias("i")
    lo_in = (F.col("t._lo") >= F.col("i._rid")) & (F.col("t._lo") < F.col("i._rid") + F.col("i._cnt"))
    hi_in = (F.col("t._hi") >= F.col("i._rid")) & (F.col("t._hi") < F.col("i._rid") + F.col("i._cnt"))
    cond = [F.col(f"t.{k}").eqNullSafe(F.col(f"i.{k}")) for k in keys]
    cond_all = cond[0]
    for c in cond[1:]:
        cond_all = cond_all & c
    # targets hold (groups x columns x probs) rows; the join is on the group key,
    # so AQE picks broadcast or shuffle by their measured size
    hit = i.join(t, cond_all & (lo_in | hi_in))
    res = hit.groupBy(*[F.col(f"t.{k}").alias(k) for k in keys], F.col("t.prob").alias("prob")).agg(
        F.min(F.when(lo_in, F.col("i.value"))).alias("_vlo"),
        F.min(F.when(hi_in, F.col("i.value"))).alias("_vhi"),
        F.first("t._frac").alias("_frac"),
        F.bool_and(F.col(f"i.{region}") % 2 == 1 if region else F.lit(True)).alias("_inside"))
    return res.select(*keys, "prob",
                      (F.col("_vlo") + F.col("_frac") * (F.col("_vhi") - F.col("_vlo"))).alias("value"),
                      *(["_inside"] if region else []))


def stat_names(probs: Sequence[float]) -> Column:
    """Map from probability to its label: 0.25 to ``25%``, 0.025 to ``2.5%``."""
    return F.create_map(*[F.lit(x) for p in probs for x in (float(p), f"{p * 100:g}%")])


def _moments(df: DataFrame, cols: Sequence[str], by: Sequence[str], stats: dict) -> DataFrame:
    aggs = [fn(F.col(c).cast("double")).alias(f"{c}\u0001{name}")
            for c in cols for name, fn in stats.items()]
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    pairs = [F.struct(F.lit(c).alias("col_name"), F.lit(name).alias("stat"),
                      F.col(f"`{c}\u0001{name}`").cast("double").alias("value"))
             for c in cols for name in stats]
    return wide.select(*by, F.explode(F.array(*pairs)).alias("_s")).select(*by, "_s.*")


_DESCRIBE = {
    "count": F.count,
    "mean": F.avg,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
}


def describe(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """A1: count, mean, sample std, min, quartiles, max per column (long form)."""
    return describe_by(df, [], cols, exact)


def describe_by(df: DataFrame, by: Sequence[str], cols: Sequence[str],
                exact: bool = True) -> DataFrame:
    """A2: :func:`describe` per group: (by..., col_name, stat, value)."""
    by = list(by)
    mom = _moments(df, cols, by, _DESCRIBE)
    q = quantiles(df, cols, QUARTILES, by, exact)
    stat = stat_names(QUARTILES)[F.col("prob")]
    return mom.unionByName(q.select(*by, "col_name", stat.alias("stat"), "value"))


def describe_basic(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A3: count, mean, std, min, max for numeric and string columns.

    Long form (col_name, stat, num_value, str_value): numeric columns fill
    ``num_value``; string columns report count in ``num_value`` and min / max
    in ``str_value`` (mean and std are NULL for them, as Spark's ``describe``).
    """
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    numeric = [c for c in cols if is_numeric(types[c])]
    strings = [c for c in cols if types[c] == "string"]
    aggs, pairs = [], []
    for c in numeric:
        x = F.col(c).cast("double")
        for name, e in (("count", F.count(x)), ("mean", F.avg(x)), ("std", F.stddev_samp(x)),
                        ("min", F.min(x)), ("max", F.max(x))):
            aggs.append(e.cast("double").alias(f"{c}\u0001{name}"))
            pairs.append((c, name, f"{c}\u0001{name}", None))
    for c in strings:
        aggs.append(F.count(c).cast("double").alias(f"{c}\u0001count"))
        aggs.append(F.min(c).alias(f"{c}\u0001min"))
        aggs.append(F.max(c).alias(f"{c}\u0001max"))
        pairs += [(c, "count", f"{c}\u0001count", None), (c, "min", None, f"{c}\u0001min"),
                  (c, "max", None, f"{c}\u0001max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("col_name"), F.lit(s).alias("stat"),
                     (F.col(f"`{n}`") if n else F.lit(None).cast("double")).alias("num_value"),
                     (F.col(f"`{t}`") if t else F.lit(None).cast("string")).alias("str_value"))
            for c, s, n, t in pairs]
    return wide.select(F.explode(F.array(*rows)).alias("_s")).select("_s.*")


NUMERIC_TYPES = {"tinyint", "smallint", "int", "bigint", "float", "double", "decimal"}


def is_numeric(kind: str, kinds=frozenset(NUMERIC_TYPES)) -> bool:
    """Whether a type string such as ``int`` or ``decimal(10,2)`` is one of ``kinds``."""
    return kind.split("(")[0] in kinds


def summary(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """A4: R's ``summary``: min, 1st quartile, median, mean, 3rd quartile, max."""
    mom = _moments(df, cols, [], {"min": F.min, "mean": F.avg, "max": F.max})
    names = F.element_at(F.create_map(F.lit(0.25), F.lit("q1"), F.lit(0.5), F.lit("median"),
                                      F.lit(0.75), F.lit("q3")), F.col("prob"))
    q = quantiles(df, cols, QUARTILES, exact=exact)
    return mom.unionByName(q.select("col_name", names.alias("stat"), "value"))


def col_sd(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5: sample standard deviation per column: (col_name, sd)."""
    return _moments(df, cols, [], {"sd": F.stddev_samp}).select(
        "col_name", F.col("value").alias("sd"))


def class_balance(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows per class."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, a: str, b: str, levels: Sequence | None = None) -> DataFrame:
    """Contingency table, zero cells kept.  Pass ``levels`` to skip the
    distinct-value job and fix the output columns."""
    g = df.groupBy(a)
    piv = g.pivot(b, list(levels)) if levels is not None else g.pivot(b)
    return piv.agg(F.count(F.lit(1))).na.fill(0)


def _pairs(cols: Sequence[str], upper: bool):
    for i, x in enumerate(cols):
        for j, y in enumerate(cols):
            if upper and j < i:
                continue
            yield x, y


def _pair_table(df: DataFrame, cols: Sequence[str], fn, name: str) -> DataFrame:
    cols = list(cols)
    done = {}
    aggs = []
    for x, y in _pairs(cols, upper=True):
        alias = f"{x}\u0001{y}"
        aggs.append(fn(F.col(x).cast("double"), F.col(y).cast("double")).alias(alias))
        done[(x, y)] = done[(y, x)] = alias
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(x).alias("col_a"), F.lit(y).alias("col_b"),
                     F.col(f"`{done[(x, y)]}`").alias(name))
            for x, y in _pairs(cols, upper=False)]
    return wide.select(F.explode(F.array(*rows)).alias("_s")).select("_s.*")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, long form (col_a, col_b, corr)."""
    return _pair_table(df, cols, F.corr, "corr")


def cov_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population covariance of every pair, long form (col_a, col_b, cov)."""
    return _pair_table(df, cols, F.covar_pop, "cov")


def mean_vector(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The mean vector that goes with :func:`cov_matrix`."""
    return _moments(df, cols, [], {"mean": F.avg}).select("col_name", F.col("value").alias("mean"))


def filtered_mean(df: DataFrame, value: str, predicate: Column, by: Sequence[str] = ()) -> DataFrame:
    """A10: mean over rows matching ``predicate``, truncated to an integer."""
    f = df.where(predicate)
    aggs = [F.avg(value).cast("bigint").alias("mean_trunc"), F.count(value).alias("n")]
    return f.groupBy(*by).agg(*aggs) if by else f.agg(*aggs)


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("bigint"))


def tally(df: DataFrame, group: str, value: str, values: Sequence | None = None) -> DataFrame:
    """Occurrences of each value per group, one column per value; all values of the data, unless
    ``values`` names the ones wanted."""
    return crosstab(df, group, value, values)


def group_means(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean per group, ordered by the mean (the sampling distribution)."""
    return (df.groupBy(group).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))
            .orderBy("mean", group))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over [min, max]; last bin closed; empty bins kept."""
    x = F.col(col).cast("double")
    rng = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    # min / max enter the binning as scalar subqueries (one value each)
    lo, hi = rng.select("_lo").scalar(), rng.select("_hi").scalar()
    raw = F.when(hi == lo, F.lit(0)).otherwise(F.floor((x - lo) / ((hi - lo) / bins)))
    counted = (df.where(x.isNotNull())
               .select(F.least(raw, F.lit(bins - 1)).cast("int").alias("bin"))
               .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    width = (F.col("_hi") - F.col("_lo")) / bins
    nb = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(F.lit(bins))
    frame = rng.select("_lo", "_hi", F.explode(F.sequence(F.lit(0), nb - 1)).alias("bin"))
    w = F.when(F.col("_hi") == F.col("_lo"), F.lit(0.0)).otherwise(width)
    return (frame.join(counted, "bin", "left")
            .select("bin", (F.col("_lo") + F.col("bin") * w).alias("bin_lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_hi"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def bayesian_average(df: DataFrame, group: str, value: str, m: float | Column,
                     C: float) -> DataFrame:
    """``(C*m + sum x) / (C + n)`` per group; NULL only when C + n = 0."""
    m = m if isinstance(m, Column) else F.lit(float(m))
    g = df.groupBy(group).agg(F.count(value).alias("n"), F.sum(F.col(value).cast("double")).alias("total"))
    den = F.lit(float(C)) + F.col("n")
    return g.select(group, "n", "total",
                    F.try_divide(F.lit(float(C)) * m + F.coalesce("total", F.lit(0.0)),
                                 F.when(den != 0, den)).alias("bayes_avg"))


def bayesian_surface(df: DataFrame, group: str, value: str, order: Sequence[str], m: float,
                     C_grid: Sequence[float], n_grid: Sequence[int]) -> DataFrame:
    """Bayesian average of each group's first n rows for every (C, n) cell.

    Cells with no sample (n = 0) or C + n = 0 are skipped.  Only the first
    max(n_grid) rows of a group are kept (a window group limit, so at most
    that many rows per group and map task cross the shuffle).
    """
    n_grid = sorted({int(n) for n in n_grid if int(n) > 0})
    top = max(n_grid)
    w = Window.partitionBy(group).orderBy(*order)
    first = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= top)
    ns = F.array(*[F.lit(n) for n in n_grid])
    cells = (first.select(group, F.col(value).cast("double").alias("_x"),
                          F.explode(F.filter(ns, lambda n: n >= F.col("_rn"))).alias("n_cap"))
             .groupBy(group, "n_cap").agg(F.count(F.lit(1)).alias("n"), F.sum("_x").alias("total")))
    cs = F.explode(F.array(*[F.lit(float(c)) for c in C_grid])).alias("C")
    out = cells.select(group, "n_cap", "n", "total", cs)
    return (out.where(F.col("C") + F.col("n") != 0)
            .select(group, "n_cap", "C", "n",
                    ((F.col("C") * F.lit(float(m)) + F.col("total")) / (F.col("C") + F.col("n"))).alias("bayes_avg")))


def mean_std_error(df: DataFrame, sample: str, value: str) -> DataFrame:
    """Per sample mean, population sd and sd / sqrt(n)."""
    x = F.col(value).cast("double")
    return df.groupBy(sample).agg(F.count(x).alias("n"), F.avg(x).alias("mean"),
                                  F.stddev_pop(x).alias("sd_pop")).withColumn(
        "std_error", F.col("sd_pop") / F.sqrt("n"))


def chunk_mean(df: DataFrame, order: Sequence[str], value: str, k: int) -> DataFrame:
    """Mean of each run of k consecutive values in ``order``."""
    idx = row_index(df.select(*order, value), order)
    return (idx.groupBy(F.floor(F.col("_rid") / k).cast("bigint").alias("chunk"))
            .agg(F.avg(F.col(value).cast("double")).alias("mean"), F.count(F.lit(1)).alias("n")))


def best_by(df: DataFrame, score: str, tie: Sequence[str | Column] = (),
            by: Sequence[str] = ()) -> DataFrame:
    """The row with the highest ``score`` (ties broken by ``tie`` ascending).

    Without ``by`` this is a top-1 (TakeOrderedAndProject: one candidate per
    task).  With ``by`` it is ``row_number() = 1`` per group, which Spark
    limits per map task before the shuffle.
    """
    order = [F.col(score).desc_nulls_last(), *[F.col(t) if isinstance(t, str) else t for t in tie]]
    if not by:
        return df.orderBy(*order).limit(1)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def gram(df: DataFrame, xs: Sequence[str], y: str | None = None,
         fold: str | Column | None = None, intercept: bool = False) -> DataFrame:
    """Sums of cross-products per fold, long form (fold, col_a, col_b, s).

    Rows cover X'X (upper triangle and mirror), X'y, y'y and n (as
    col_a = col_b = '_n').  With ``intercept`` a constant column ``_one`` is
    part of X.  Rows with a NULL in any used column
    take no part.  One pass, one partial aggregate; p x p values per fold.
    """
    names = (["_one"] if intercept else []) + list(xs)
    exprs = {c: F.col(c).cast("double") for c in xs}
    exprs["_one"] = F.lit(1.0)
    if y:
        exprs[y] = F.col(y).cast("double")
    allv = names + ([y] if y else [])
    aggs, mirror = [], {}
    for i, a in enumerate(allv):
        for b in allv[i:]:
            alias = f"{a}\u0001{b}"
            aggs.append(F.sum(exprs[a] * exprs[b]).alias(alias))
            mirror[(a, b)] = mirror[(b, a)] = alias
    aggs.append(F.count(F.lit(1)).cast("double").alias("_n"))
    fcol = (F.col(fold) if isinstance(fold, str) else fold) if fold is not None else F.lit(0)
    # sums, counts and the constant column all run over the same rows: those without a NULL
    for c in allv:
        if c != "_one":
            df = df.where(F.col(c).isNotNull())
    wide = df.groupBy(fcol.cast("int").alias("fold")).agg(*aggs)
    rows = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                     F.col(f"`{mirror[(a, b)]}`").alias("s"))
            for a in allv for b in allv]
    rows.append(F.struct(F.lit("_n").alias("col_a"), F.lit("_n").alias("col_b"), F.col("_n").alias("s")))
    return wide.select("fold", F.explode(F.array(*rows)).alias("_s")).select("fold", "_s.*")
