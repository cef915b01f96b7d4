"""Two-scan quantiles against numpy, and the tables they leave to be shuffled."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.operators import agg

PROBS = (0.0, 0.25, 0.5, 0.9, 1.0)


def frame(spark, n, groups):
    """x spread evenly, y one value in 90 % of rows, z NULL in a third."""
    i = F.col("id")
    return spark.range(0, n, 1, 6).select(
        F.when(i % groups != 0, i % groups).alias("g"), (F.pmod(F.xxhash64("id"), F.lit(10 ** 9)) / 7).alias("x"),
        F.when(i % 10 != 3, 5.0).otherwise(-i.cast("double")).alias("y"), F.when(i % 3 != 0, F.sin("id")).alias("z"))


def expected(pdf, cols):
    kept = {c: pdf[c].dropna().astype(float) for c in cols}
    return {(c, p): float(np.quantile(x, p)) for c, x in kept.items() if len(x) for p in PROBS}


def got(rows, by=()):
    return {(*[r[b] for b in by], r.col_name, r.prob): r.value for r in rows.collect()}


@pytest.mark.parametrize("n", [1, 7, 3000, 60000])
def test_whole_table(spark, n):
    df = frame(spark, n, 3)
    want = expected(df.toPandas(), ["x", "y", "z"])
    have = got(agg.quantiles(df, ["x", "y", "z"], PROBS))
    assert have.keys() == want.keys()
    assert all(have[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_groups_with_a_null_key(spark):
    df = frame(spark, 40000, 4)
    pdf = df.toPandas()
    have = got(agg.quantiles(df, ["x", "z"], PROBS, by=["g"]), ["g"])
    for g, part in pdf.groupby("g", dropna=False):
        key = None if pd.isna(g) else int(g)
        for k, v in expected(part, ["x", "z"]).items():
            assert have[(key, *k)] == pytest.approx(v, rel=1e-12)
    assert len(have) == 4 * 2 * len(PROBS)


def test_few_values_are_counted_one_by_one(spark):
    n = 200000
    counts = agg._bracketed_counts(frame(spark, n, 3), ["x"], (0.25, 0.5, 0.75), [])
    rows = counts.agg(F.count("_r").alias("rows"), F.sum("_cnt").alias("n")).first()
    # three brackets of about 2 * MARGIN of the rows each
    assert rows["n"] == n and rows["rows"] < 3 * 3 * agg.MARGIN * n


def test_a_bracket_beside_its_rank_is_mended(spark, monkeypatch):
    df = frame(spark, 60000, 3)
    want = expected(df.toPandas(), ["x", "y"])
    monkeypatch.setattr(agg, "MARGIN", 4e-5)
    monkeypatch.setattr(agg, "SKETCH", 20)  # ranks off by up to a twentieth of the rows
    have = got(agg.quantiles(df, ["x", "y"], PROBS))
    assert have.keys() == want.keys()
    assert all(have[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_empty_and_special_values(spark):
    empty = spark.createDataFrame([], "g int, x double")
    assert got(agg.quantiles(empty, ["x"])) == {} and got(agg.quantiles(empty, ["x"], by=["g"]), ["g"]) == {}
    odd = spark.createDataFrame([(float("-inf"),), (-0.0,), (0.0,), (3.0,), (float("inf"),)], "x double")
    have = got(agg.quantiles(odd, ["x"], (0.0, 0.25, 0.5, 1.0)))
    assert [have[("x", p)] for p in (0.25, 0.5)] == [0.0, 0.0]
