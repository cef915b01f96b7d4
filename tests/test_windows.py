"""Window operators across block edges, token streams, the join with a hot token and n-grams."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import features as X
from quarry.operators import window as W


@pytest.fixture(params=[4, 4096])
def block(request, monkeypatch):
    monkeypatch.setattr(W, "BLOCK", request.param)


def series(spark, n, groups):
    i = F.col("id")
    return spark.range(n).select((i % groups).alias("g"), i.alias("t"), (i * i % 17).cast("double").alias("v"))


def lists(n, groups):
    return {g: [float(i * i % 17) for i in range(n) if i % groups == g] for g in range(groups)}


def test_diff_in_groups(spark, block):
    rows = W.diff(series(spark, 61, 3), ["t"], "v", by=["g"]).orderBy("g", "t").collect()
    want = [b - a if k else 0.0 for g, xs in sorted(lists(61, 3).items())
            for k, (a, b) in enumerate(zip([0.0, *xs], xs))]
    assert [r.v_diff for r in rows] == want


@pytest.mark.parametrize("n", [1, 4, 7])
def test_frames_in_groups(spark, block, n):
    rows = W.sliding_sequences(series(spark, 61, 3), ["t"], ["v"], n, "v", by=["g"]).collect()
    got = {(r.g, r.start): ([x.v for x in r.inputs], r.target) for r in rows}
    want = {(g, s): (xs[s:s + n], xs[s + n]) for g, xs in lists(61, 3).items() for s in range(len(xs) - n)}
    assert got == want and len(rows) == len(want)


def test_pairs_skip_gaps(spark, block):
    df = spark.createDataFrame([("a", p, f"t{p}") for p in range(20) if p != 9] + [("b", 0, "x")], "s string, p long, t string")
    got = {(r.s, r.p): r.target for r in W.next_token_pairs(df, ["s"], "p", "t").collect()}
    assert got == {("a", p): f"t{p + 1}" for p in range(19) if p not in (8, 9)}


@pytest.mark.parametrize("sep", [None, "|"])
def test_documents_as_one_stream(spark, sep):
    docs = spark.createDataFrame([(3, ["a", "b"]), (1, ["c"]), (2, None), (4, []), (5, ["d", "e", "f", "g"])],
                                 "doc_id long, toks array<string>")
    if sep:
        docs = docs.withColumn("toks", F.array_join("toks", sep))
    rows = W.batchify_documents(docs, ["doc_id"], "toks", 3, sep=sep).collect()
    got = {(r.batch, r.pos): (r.doc_id, r.tpos, r.token) for r in rows}
    assert got == {(0, 0): (1, 0, "c"), (0, 1): (3, 0, "a"), (1, 0): (3, 1, "b"), (1, 1): (5, 0, "d"),
                   (2, 0): (5, 1, "e"), (2, 1): (5, 2, "f")}


def test_hot_token_is_spread(spark, monkeypatch):
    monkeypatch.setattr(X, "HOT_KEYS", 3)
    i = F.col("id")
    token = F.when(i % 10 != 0, "hot").when(i % 100 == 0, F.lit(None)).otherwise(F.concat(F.lit("w"), (i % 70).cast("string")))
    tokens = spark.range(5000).select(i.alias("k"), token.alias("token"))
    vocab = X.vocabulary(tokens.where("token is not null and token <> 'w10'"))
    ids = {r.token: r.id for r in vocab.collect()}
    out = X.numericalise(tokens, vocab)
    assert out.columns == ["k", "token", "token_id"]
    rows = out.collect()
    assert len(rows) == 5000 and all(r.token_id == ids.get(r.token, 0) for r in rows)


def test_join_terms_keeps_or_drops(spark, monkeypatch):
    monkeypatch.setattr(X, "HOT_KEYS", 1)
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a"), (3, "b"), (4, None), (5, "z")], "k int, t string")
    lookup = spark.createDataFrame([("a", 9, 1.0), ("b", 1, None)], "t string, n int, x double")
    inner = sorted(map(tuple, X.join_terms(rows, lookup, "t", -F.col("n")).collect()))
    assert inner == [(1, "a", 9, 1.0), (2, "a", 9, 1.0), (2, "a", 9, 1.0), (3, "b", 1, None)]
    left = X.join_terms(rows, lookup, "t", -F.col("n"), "left").collect()
    assert len(left) == 6 and {r.k for r in left if r.n is None} == {4, 5}


@pytest.mark.parametrize("unique", [False, True])
def test_ngrams_of_code_points(spark, unique):
    texts = ["", "ab", "abcabc", "a\nb\r\nc", "\U0001f600\U0001f601\u00e9x\U0001f600", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, s string")
    want = {}
    for k, s in enumerate(texts):
        for i in range(len(s or "") - 2):
            want[(k, s[i:i + 3])] = want.get((k, s[i:i + 3]), 0) + 1
    got = {(r.k, r.gram): r["count"] for r in X.char_ngrams(df, ["k"], "s", 3, unique_rows=unique).collect()}
    assert got == want


@pytest.mark.parametrize("sep", [None, " "])
def test_runs_equal_rows(spark, monkeypatch, sep):
    """Runs of tokens give the pairs, chunks and ids of single tokens."""
    monkeypatch.setattr(X, "HELD_KEYS", 2)
    texts = [(k, [f"w{(k * 7 + j * j) % 11}" for j in range((k * 5) % 23)]) for k in range(40)] + [(40, None)]
    docs = spark.createDataFrame(texts, "doc_id long, toks array<string>")
    if sep:
        docs = docs.withColumn("toks", F.array_join("toks", sep))
    rows = W.batchify_documents(docs, ["doc_id"], "toks", 3, sep=sep).select("batch", "pos", "token").persist()
    runs = W.batchify_documents(docs, ["doc_id"], "toks", 3, sep=sep, runs=True)
    assert runs.count() <= 42
    runs = runs.select("batch", "pos", "token").persist()
    vocab = X.vocabulary(rows.where("token <> 'w3'")).persist()
    ids = X.numericalise(rows, vocab).select("batch", "pos", "token_id")
    id_runs = X.numericalise(runs, vocab)
    assert id_runs.columns == ["batch", "pos", "token_id"]
    for a, b, col in ((rows, runs, "token"), (ids, id_runs, "token_id")):
        pairs = sorted(map(tuple, W.next_token_pairs(a, ["batch"], "pos", col).collect()))
        assert pairs and pairs == sorted(map(tuple, W.next_token_pairs(b, ["batch"], "pos", col, runs=True).collect()))
        chunks = sorted(map(tuple, W.bptt_chunks(a, ["batch"], "pos", col, 6).collect()))
        assert chunks and chunks == sorted(map(tuple, W.bptt_chunks(b, ["batch"], "pos", col, 6, runs=True).collect()))


def test_no_tokens_no_runs(spark):
    docs = spark.createDataFrame([(1, ["a"]), (2, [])], "doc_id long, toks array<string>")
    assert W.batchify_documents(docs, ["doc_id"], "toks", 3, runs=True).count() == 0
    assert W.batchify_documents(docs.where("false"), ["doc_id"], "toks", 3, runs=True).count() == 0


def test_term_lists_equal_term_rows(spark, monkeypatch):
    """Documents whose key repeats or is null are added up as before; lists and rows give the same weights."""
    monkeypatch.setattr(X, "HELD_KEYS", 2)
    docs = spark.createDataFrame([(1, "red red blue the"), (2, "blue green"), (2, "blue Red"), (None, "green"), (None, "green tea"),
                                  (3, ""), (4, None), (5, "unseen tea red")], "doc_id long, text string")
    counts = X.term_counts(docs, ["doc_id"], "text").persist()
    lists = X.term_lists(docs, ["doc_id"], "text")
    order = lambda rows: sorted(map(str, rows))
    flat = lists.select("doc_id", F.explode(F.arrays_zip("terms", "tfs")).alias("z")).select("doc_id", "z.terms", "z.tfs")
    assert order(map(tuple, flat.collect())) == order(map(tuple, counts.collect()))
    known = (F.col("doc_id") < 4) | F.col("doc_id").isNull()
    a, b = ({(r.doc_id, r.term): r.weight for r in X.tfidf(t.where(known), t, "doc_id").collect()} for t in (counts, lists))
    assert a.keys() == b.keys() and (5, "unseen") not in b and all(a[k] == pytest.approx(b[k]) for k in a)


def test_summary_ranks_only_terms_that_need_it(spark, monkeypatch):
    from quarry.operators import agg
    import numpy as np
    entries = {"rare": [0.5], "half": [0.25] * 6, "most": [0.1 * k for k in range(1, 10)], "below": [-0.5] * 4, "mixed": [-1.0, -1.0, 2.0, 2.0]}
    w = spark.createDataFrame([(k, t, v) for t, vs in entries.items() for k, v in enumerate(vs)], "doc int, term string, weight double")
    ranked, plain = [], agg.quantiles_from_counts
    monkeypatch.setattr(agg, "quantiles_from_counts", lambda c, *a: ranked.extend(r.term for r in c.select("term").distinct().collect()) or plain(c, *a))
    got = {(r.term, r.stat): r.value for r in X.feature_summary(w, "doc", 10).collect()}
    assert sorted(ranked) == ["below", "half", "most"]
    for t, vs in entries.items():
        for p in (25, 50, 75):
            assert got[t, f"{p}%"] == pytest.approx(np.percentile(vs + [0.0] * (10 - len(vs)), p)), (t, p)
