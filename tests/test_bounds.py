"""What a task holds, sends or shuffles does not follow from the size of its input."""

import pandas as pd
from pyspark.sql import functions as F

from quarry.operators import features as X


def test_gram_counts_leave_in_bounded_pieces(monkeypatch):
    monkeypatch.setattr(X, "HELD_GRAMS", 50, raising=False)
    rows = pd.DataFrame({"k": range(200), "_t": ["abcdefghij" + str(i) for i in range(200)]})
    frames = list(X._gram_counter(["k"], 3, "g")(iter([rows])))
    assert max(map(len, frames)) < 50 + 11
    got = pd.concat(frames)
    assert got["count"].sum() == sum(len(t) - 2 for t in rows["_t"])
    assert not got.duplicated(["k", "g"]).any()


def test_drawn_rows_are_bounded_before_they_are_sorted(spark, monkeypatch):
    from quarry.operators import sample as S
    rows = [(i % 3000, i % 7 if i % 50 else None) for i in range(4000)] + [(None, 1)]
    df = spark.createDataFrame(rows, "k long, g long")
    got = S.sample_n(df, ["k"], 5, seed=3, replicates=4)
    kept = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "_t#" in line and "<=" in line]
    assert kept
    whole = df.selectExpr("*", "explode(sequence(1, 4)) AS replicate").withColumn("h", S.hash_bits(3, ["replicate", "k"]))
    whole.createOrReplaceTempView("whole_draw")
    for by in ("", ", g"):
        want = spark.sql(f"SELECT k, replicate FROM (SELECT *, row_number() OVER (PARTITION BY replicate{by} ORDER BY h, k) AS r "
                         "FROM whole_draw) WHERE r <= 5")
        found = S.sample_n(df, ["k"], 5, seed=3, replicates=4, by=["g"] if by else [])
        assert sorted(((r.replicate, r.k) for r in found.collect()), key=lambda t: (t[0], t[1] is not None, t[1] or 0)) == sorted(
            ((r.replicate, r.k) for r in want.collect()), key=lambda t: (t[0], t[1] is not None, t[1] or 0))


def test_few_groups_do_not_deal_the_rows(spark):
    from quarry.operators import agg
    df = spark.range(20_000).selectExpr("id % 3 AS g", "CAST(id AS double) AS x").withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    plan = agg._bracketed_counts(df, ["x"], (0.5,), ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    got = {(r.g, r.stat): r.value for r in agg.describe_by(df, ["g"], ["x"]).collect()}
    assert got[None, "50%"] == 9999 and got[1, "50%"] == 10000 - 0.0 and got[2, "count"] == 6666


def _stored(monkeypatch, module):
    """What ``module`` stores, by name."""
    found, real = {}, module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: found.setdefault(name, real(df, name)), raising=False)
    return found


def test_training_documents_are_counted_by_token_only(spark, tmp_path, monkeypatch):
    from quarry.plans import text
    rows = [(i, "en", f"a b b w{i}") for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = _stored(monkeypatch, text)
    got = text.perplexity_by_language(spark, str(tmp_path)).first()
    part = {r.doc_id: r.part for r in text.split_documents(spark, str(tmp_path)).collect()}
    train, test = [[i for i in part if part[i] == p] for p in ("train", "test")]
    assert train and {r.doc_id for r in found["token-counts"].collect()} == set(test)
    import math
    N, V = 4 * len(train), len(train) + 3
    loss = -(math.log((len(train) + 1) / (N + V)) + 2 * math.log((2 * len(train) + 1) / (N + V)) + math.log(1 / (N + V))) / 4
    assert abs(got.mean_loss - loss) < 1e-9


def test_folds_read_stored_features(spark, tmp_path, monkeypatch):
    from quarry.plans import models
    spark.range(40).selectExpr("id AS o_orderkey", "id AS o_custkey", "if(id % 2 = 0, 'F', 'O') AS o_orderstatus", "id * 1.5D AS o_totalprice",
                               "timestamp'2020-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(120).selectExpr("id % 40 AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "CAST(id AS int) AS l_linenumber",
                                "id * 1.0D AS l_quantity", "id * 2.0D AS l_extendedprice", "0.1D AS l_discount", "0.2D AS l_tax",
                                "'A' AS l_returnflag", "'F' AS l_linestatus", "timestamp'2020-01-01' AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = _stored(monkeypatch, models)

    def stop(estimator, grid, evaluator, df, fold_col, k=None, parallelism=2):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "l_extendedprice" not in plan and "l_tax" not in plan
        return None, [({"regParam": 0.1, "elasticNetParam": 0.0}, 0.5)]
    monkeypatch.setattr(models.C, "cross_validate", stop)
    assert models.logistic_cv_orders(spark, str(tmp_path)).count() == 1
    assert found["order-features"].count() > 0


def test_models_of_a_grid_are_held_in_bounded_groups(spark, monkeypatch):
    from quarry.operators import logit as L
    rows = [(float(j % 2), j % 3, [j % 2, 2 + j % 5], [1.0, 0.5]) for j in range(60)]
    df = spark.createDataFrame(rows, "label double, fold int, i array<int>, x array<double>").coalesce(2).persist()
    w, points = L.cv_balanced(df, 8, [0.1, 1.0], k=3, max_passes=4)
    sizes, fit = [], L.fit_many
    monkeypatch.setattr(L, "FITTED", 4 * 10, raising=False)
    monkeypatch.setattr(L, "fit_many", lambda rows, size, specs, *a: sizes.append(len(specs)) or fit(rows, size, specs, *a))
    again, same = L.cv_balanced(df, 8, [0.1, 1.0], k=3, max_passes=4)
    assert sizes == [4, 2, 1] and same == points and (again == w).all()
