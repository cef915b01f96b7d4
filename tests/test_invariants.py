"""Properties that hold whatever the data: SURVEY section 5 (c)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.operators import agg as A
from quarry.operators import evaluate as E
from quarry.operators import features as X
from quarry.operators import sample as R
from quarry.operators import window as W
from quarry.operators.ordering import group_row_index, row_index
from quarry.session import table


def _events(spark):
    return table(spark, SF_SMALL, "events")


def test_row_index_is_dense_and_layout_free(spark):
    ev = _events(spark)
    n = ev.count()
    one = {r.event_id: r._rid for r in row_index(ev, ["ts", "event_id"], num_buckets=1).collect()}
    many = {r.event_id: r._rid for r in
            row_index(ev.repartition(7), ["ts", "event_id"], num_buckets=13).collect()}
    assert one == many
    assert sorted(one.values()) == list(range(n))
    ordered = [r.event_id for r in ev.orderBy("ts", "event_id").collect()]
    assert [one[e] for e in ordered] == list(range(n))


def test_group_row_index_restarts_per_group(spark):
    ev = _events(spark)
    got = group_row_index(ev, ["user_id"], ["ts", "event_id"]).groupBy("user_id").agg(
        F.min("_pos").alias("lo"), F.max("_pos").alias("hi"), F.count("*").alias("n"))
    assert got.where("lo <> 0 OR hi <> n - 1").count() == 0


def test_weighted_row_index_gives_first_positions(spark):
    df = spark.createDataFrame([(1, 3), (2, 1), (5, 2)], "v int, c long")
    got = {r.v: r._rid for r in row_index(df, ["v"], weight="c", num_buckets=2).collect()}
    assert got == {1: 0, 2: 3, 5: 4}


def test_kfold_disjoint_complete_and_layout_free(spark):
    o = table(spark, SF_SMALL, "orders")
    a = R.kfold(o, ["o_orderkey"], 5).select("o_orderkey", "fold")
    b = R.kfold(o.repartition(3), ["o_orderkey"], 5).select("o_orderkey", "fold")
    assert a.exceptAll(b).count() == 0
    assert a.count() == o.count()
    assert {r.fold for r in a.select("fold").distinct().collect()} == set(range(5))


def test_hash_split_keeps_duplicate_keys_together(spark):
    li = table(spark, SF_SMALL, "lineitem")
    s = R.hash_split(li, ["l_orderkey"], [0.8, 0.2])
    assert s.groupBy("l_orderkey").agg(F.countDistinct("split").alias("k")).where("k > 1").count() == 0


def test_confusion_sums_to_rows(spark):
    li = table(spark, SF_SMALL, "lineitem")
    c = E.confusion(li, "l_returnflag", "l_linestatus")
    assert c.agg(F.sum("n")).first()[0] == li.count()


def test_roc_monotone_from_origin_to_one(spark):
    li = table(spark, SF_SMALL, "lineitem").withColumn(
        "y", (F.col("l_returnflag") == "R").cast("int"))
    pts = sorted((-r.threshold, r.fpr, r.tpr) for r in E.roc_curve(li, "y", "l_discount").collect())
    assert pts[0][1:] == (0.0, 0.0) and pts[-1][1:] == (1.0, 1.0)
    for (_, f0, t0), (_, f1, t1) in zip(pts, pts[1:]):
        assert f1 >= f0 and t1 >= t0


def test_gram_total_equals_sum_of_folds(spark):
    li = R.kfold(table(spark, SF_SMALL, "lineitem"), ["l_orderkey"], 4)
    xs = ["l_quantity", "l_discount"]
    folds = A.gram(li, xs, "l_extendedprice", fold="fold").groupBy("col_a", "col_b").agg(F.sum("s").alias("s"))
    total = A.gram(li, xs, "l_extendedprice")
    joined = folds.join(total.withColumnRenamed("s", "t"), ["col_a", "col_b"])
    assert joined.count() == total.count()
    for r in joined.collect():
        assert abs(r.s - r.t) <= 1e-9 * max(1.0, abs(r.t))


def test_describe_equals_describe_by_on_one_group(spark):
    li = table(spark, SF_SMALL, "lineitem").where("l_returnflag = 'R'")
    cols = ["l_quantity", "l_discount"]
    a = {(r.col_name, r.stat): r.value for r in A.describe(li, cols).collect()}
    b = {(r.col_name, r.stat): r.value for r in A.describe_by(li, ["l_returnflag"], cols).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None and b[k] is None) or abs(a[k] - b[k]) <= 1e-9 * max(1.0, abs(a[k]))


def test_histogram_of_equal_values_is_one_bin(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "x double")
    rows = A.histogram(df, "x").collect()
    assert len(rows) == 1 and rows[0].n == 5


def test_histogram_keeps_empty_bins_and_closes_last(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (1.0,)], "x double")
    rows = sorted(A.histogram(df, "x", bins=4).collect())
    assert [r.n for r in rows] == [2, 0, 0, 1]


def test_bayesian_average_null_only_when_prior_and_n_cancel(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "g string, v double")
    assert A.bayesian_average(df, "g", "v", 2.0, 2.0).first().bayes_avg == 2.0
    assert A.bayesian_average(df, "g", "v", 2.0, -2.0).first().bayes_avg is None


def test_diff_first_row_zero(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 13.0), (3, 11.0)], "t int, v double")
    got = [r.v_diff for r in W.diff(df, ["t"], "v").orderBy("t").collect()]
    assert got == [0.0, 3.0, -2.0]


def test_sliding_sequences_keep_every_full_window(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(6)], "t int, v double")
    frames = W.sliding_sequences(df, ["t"], ["v"], 3, "v").orderBy("start").collect()
    # 6 rows, frames of 3 inputs plus a target: starts 0, 1, 2 (n - L + 1 with L = 4)
    assert [f.start for f in frames] == [0, 1, 2]
    assert [x.v for x in frames[0].inputs] == [0.0, 1.0, 2.0] and frames[0].target == 3.0


def test_batchify_drops_remainder(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "t int")
    rows = W.batchify(df, ["t"], 3).collect()
    assert len(rows) == 9
    assert {(r.t, r.batch, r.pos) for r in rows if r.t in (0, 3, 8)} == {(0, 0, 0), (3, 1, 0), (8, 2, 2)}


def test_char_ngrams_whole_string(spark):
    df = spark.createDataFrame([(1, "abcab"), (2, "ab")], "k int, s string")
    got = {(r.k, r.gram): r["count"] for r in X.char_ngrams(df, ["k"], "s", 2).collect()}
    assert got == {(1, "ab"): 2, (1, "bc"): 1, (1, "ca"): 1, (2, "ab"): 1}


def test_sample_balanced_takes_n_per_category(spark):
    d = table(spark, SF_SMALL, "documents")
    got = R.sample_balanced(d, "lang", ["doc_id"], 5).groupBy("lang").count().collect()
    assert all(r["count"] == 5 for r in got)
