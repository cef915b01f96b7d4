"""The forest on sparse rows against a plain recursion, Spark's tree and Spark's forest."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from quarry.operators import forest as R
from quarry.operators import textmodels as M
from quarry.plans import bakeoff


@pytest.fixture(scope="module")
def corpus(spark):
    """(docs, weights, terms, rows, dense matrix, labels); document 0 has no term, documents 90 on are not trained on."""
    rng = np.random.default_rng(5)
    n, V = 120, 14
    x = np.where(rng.random((n, V)) < 0.4, rng.integers(1, 9, (n, V)) / 8, 0.0)
    x[:, 3] = rng.permutation(np.arange(n) + 1) / 128  # more values than bins, no zeros
    x[0] = 0
    y = (x[:, 0] + x[:, 1] - x[:, 2] + x[:, 3] + 0.3 * rng.standard_normal(n) > 0.6).astype(float)
    docs = spark.createDataFrame([(i, i, float(y[i])) for i in range(n)], "doc_id long, r long, label double")
    weights = spark.createDataFrame([(i, f"t{j:02d}", float(x[i, j])) for i in range(n) for j in range(V) if x[i, j]],
                                    "doc_id long, term string, weight double")
    terms = R.term_bins(weights.where("doc_id < 90"), "doc_id", 90)
    return docs, weights, terms, R.binned_rows(docs, weights, terms, "doc_id"), x, y


def _bins(terms, x):
    edges = [r.edges for r in terms.orderBy("id").collect()]
    return np.stack([np.searchsorted(e, x[:, j]) - np.searchsorted(e, 0.0) for j, e in enumerate(edges)], axis=1)


def _plain(forest, b, y, count, depth):
    """Splits {path: (term, cut)} of every tree by a recursion over dense bins."""
    out = []
    w = forest.weights

    def score(own, n):
        s = np.array([n[own & (y == k)].sum() for k in (0, 1)]) * w
        return (s ** 2).sum() / s.sum()

    def grow(found, t, own, n, key, path):
        if len(path) == depth or len({*y[own & (n > 0)]}) < 2:
            return
        factor, shift = (int(v[0]) for v in _steps(forest, key))
        best = (score(own, n) * (1 + 1e-9), 0, 0)
        for f in range(forest.size):
            at = (factor * f + shift) % forest.prime
            while at >= forest.size:
                at = (factor * at + shift) % forest.prime
            values = sorted({*b[own & (n > 0), f]} | {0}) if at < forest.tried else []
            for cut in values[:-1]:
                left = own & (b[:, f] <= cut)
                if n[left].sum() and n[own & ~left].sum() and (s := score(left, n) + score(own & ~left, n)) > best[0] + 1e-9:
                    best = (s, f, cut)
        if best[0] > score(own, n) * (1 + 1e-9):
            found[path] = best[1:]
            for side, part in enumerate((b[:, best[1]] <= best[2], b[:, best[1]] > best[2])):
                grow(found, t, own & part, n, R._mix(key ^ np.uint64(2 + side)), path + str(side))
    for t in range(forest.trees):
        found = {}
        grow(found, t, np.ones(len(y), bool), count[:, t], forest.key[t:t + 1], "")
        out.append(found)
    return out


def _steps(forest, key):
    p = np.uint64(forest.prime)
    return R._mix(key) % (p - np.uint64(1)) + np.uint64(1), R._mix(key ^ np.uint64(1)) % p


def _splits(forest, t):
    found, todo = {}, [(t, "")]
    while todo:
        node, path = todo.pop()
        if forest.feature[node] >= 0:
            found[path] = (forest.feature[node], forest.cut[node])
            todo += [(forest.left[node] + side, path + str(side)) for side in (0, 1)]
    return found


def test_forest_is_that_of_a_plain_recursion(corpus):
    _, _, terms, rows, x, y = corpus
    train = rows.where("r < 90")
    forest = R.fit(train, 14, "label", "r", trees=6, depth=4)
    assert forest.tried == 4 and forest.prime == 17
    b, count = _bins(terms, x), R._bootstrap(42, np.arange(90), 6)
    assert [_splits(forest, t) for t in range(6)] == _plain(forest, b[:90], y[:90].astype(int), count, 4)
    votes = np.zeros((120, 2))
    for t in range(6):
        for i in range(120):
            node = t
            while forest.feature[node] >= 0:
                node = forest.left[node] + (b[i, forest.feature[node]] > forest.cut[node])
            votes[i] += forest.shares()[node]
    got = {r.doc_id: r.prediction for r in R.predict(rows, forest, ["doc_id"]).collect()}
    assert got == {i: float(votes[i].argmax()) for i in range(120)}


def test_layout_does_not_matter(corpus):
    train = corpus[3].where("r < 90")
    a, b = (R.fit(f, 14, "label", "r", trees=20, depth=6) for f in (train.coalesce(1), train.repartition(7)))
    assert all(np.array_equal(getattr(a, c), getattr(b, c)) for c in ("feature", "cut", "left", "counts"))


def test_tree_of_all_terms_splits_as_spark_does(corpus):
    """Spark's tree with the bootstrap counts as weights takes the same splits at the top."""
    docs, weights, terms, rows, x, y = corpus
    forest = R.fit(rows.where("r < 90"), 14, "label", "r", trees=1, depth=1, tried=14)
    count = R._bootstrap(42, np.arange(90), 1)[:, 0]
    vec = M.sparse_vectors(docs, weights, terms.select("term", "id"), 14, "doc_id").where("r < 90")
    share = F.element_at(F.array(*[F.lit(float(c)) for c in count]), F.col("r").cast("int") + 1)
    own = M.balanced(vec, "label").withColumn("w", F.col("w") * share).where("w > 0")
    tree = DecisionTreeClassifier(weightCol="w", maxDepth=1).fit(own)
    split = tree._call_java("rootNode").split()
    assert split.featureIndex() == forest.feature[0]
    # the same rows go left, whichever of the values between is the threshold
    b = _bins(terms, x)[:90]
    used = count > 0
    assert np.array_equal((x[:90, forest.feature[0]] <= split.threshold())[used], (b[:, forest.feature[0]] <= forest.cut[0])[used])


def test_rows_do_not_hold_the_terms_they_lack(corpus, spark):
    """2^30 terms: a dense row of bins would take 4 GB."""
    train = corpus[3].where("r < 90")
    wide = train.withColumn("i", F.transform("i", lambda i: i + F.lit((1 << 30) - 14)))
    forest = R.fit(wide, 1 << 30, "label", "r", trees=10, depth=5, tried=1 << 30)
    assert (forest.feature[:10] >= 0).all()
    assert R.predict(wide, forest, ["label"]).where("label = prediction").count() > 80


def test_negative_weights_and_edges(spark):
    assert R._strided(None, 1.0) is None
    docs = spark.createDataFrame([(i, i, float(i % 2)) for i in range(40)], "doc_id long, r long, label double")
    weights = spark.createDataFrame([(i, "t", (-1.0 - i) if i % 2 else 1.0 + i) for i in range(40)], "doc_id long, term string, weight double")
    terms = R.term_bins(weights, "doc_id", 40)
    rows = R.binned_rows(docs, weights, terms, "doc_id")
    forest = R.fit(rows, 1, "label", "r", trees=5, depth=3)
    got = R.predict(rows, forest, ["label"])
    assert got.where("label = prediction").count() == 40
    with pytest.raises(ValueError):
        R.fit(rows.where("false"), 1, "label", "r")


def test_report_grows_the_sparse_forest_beyond_the_dense_cells(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    small = {r["class"]: r for r in bakeoff.text_forest_report(spark, sf).collect()}
    monkeypatch.setattr(bakeoff, "DENSE_CELLS", 0)
    monkeypatch.setattr(M, "sparse_vectors", None)
    large = {r["class"]: r for r in bakeoff.text_forest_report(spark, sf).collect()}
    assert large["accuracy"].support == small["accuracy"].support
    assert abs(large["accuracy"].f1 - small["accuracy"].f1) < 0.2
