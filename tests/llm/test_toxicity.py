import numpy as np
from pyspark.sql import functions as F

from llm_cases import docs_of, nasty, no_docs  # noqa: F401
from quarry.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_quality(spark):
    got = queries.op7_toxicity(spark, SF)
    lab = spark.read.parquet(f"{SF}/labels.parquet").select(F.col("doc_id").alias("i"), "toxic")
    r = got.join(lab, F.col("doc_id") == F.col("i")).where("held_out").groupBy("toxic").agg(
        F.avg("predicted").alias("p"), F.count("*").alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi"))
    by = {x.toxic: x for x in r.collect()}
    # the labels of these rows are noisy: some toxic rows hold no word of their own
    assert by[1].n > 50 and by[1].p >= 0.7 and by[0].p <= 0.02
    assert 0 <= min(by[0].lo, by[1].lo) and max(by[0].hi, by[1].hi) <= 1


def test_block_max_equals_brute_force():
    rng = np.random.default_rng(4)
    vocab, idf = np.arange(60, dtype=np.uint64), rng.uniform(1, 6, 60)

    def vector():
        t = np.sort(rng.choice(60, rng.integers(1, 9), replace=False))
        return t, toxicity._weights(t, rng.integers(1, 5, len(t)), idf)
    examples = [(1000 - j, int(rng.integers(0, 2)), *vector()) for j in range(300)]
    examples += [(5000 + j, 1, *examples[3][2:]) for j in range(40)]  # ties
    index = toxicity.Index(vocab, idf, examples)
    by_id = sorted(examples, key=lambda e: e[0])
    for _ in range(100):
        t, w = vector()
        dense = np.zeros(60)
        dense[t] = w
        sims = [(round(-float(dense[e[2]] @ e[3]), 12), j) for j, e in enumerate(by_id)]
        want = sorted(s for s in sims if s[0] < 0)[:5]
        got = index.nearest(t, w, 5)
        assert [round(s, 9) for _, s in got] == [round(-s, 9) for s, _ in want]
        assert [j for j, _ in got] == [j for _, j in want]


def test_edges(spark, nasty, no_docs, docs_of):
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (5, None)],
                                   "doc_id long, toxic int")
    train_docs = docs_of([(i, f"plain text number {i}" + (" you awful fool" if i % 2 else "")) for i in range(200)])
    index, share = toxicity.train(train_docs, labels)
    out = toxicity.score(nasty, index, share).collect()
    assert len(out) == nasty.count() and all(r.predicted == 0 and 0 <= r.score <= 1 for r in out)
    bad = toxicity.score(docs_of([(1, "What an AWFUL fool"), (2, "plain")]), index, share).collect()
    assert [r.predicted for r in bad] == [1, 0] and bad[0].evidence[0].toxic == 1
    assert toxicity.score(no_docs, index, share).count() == 0
    for lab in (labels.where("false"), labels.where("toxic = 0")):
        ix, sh = toxicity.train(train_docs, lab)
        assert ix is None and {r.score for r in toxicity.score(nasty, ix, sh).collect()} == {0.0}


def test_every_term_of_every_text_counts(spark, docs_of):
    rng = np.random.default_rng(9)
    names = [f"word{i}" for i in range(400)]
    texts = {i: " ".join(rng.choice(names, rng.integers(3, 40))) + (" awful" if i % 2 and i % 5 else "")
             for i in range(300)}
    texts |= {i: " ".join(rng.choice(names, 20)) + f" own{i} own{i} alone{i}" for i in range(300, 400)}
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    index, share = toxicity.train(docs_of(list(texts.items())), labels)
    got = {r.doc_id: r for r in toxicity.score(docs_of(list(texts.items())), index, share).collect()}

    def terms(text):
        out = {}
        for w in text.split():
            for t in [w] + [(n, w[:n]) for n in toxicity.PREFIXES if len(w) > n]:
                out[t] = out.get(t, 0) + 1
        return out
    bags = {i: terms(t) for i, t in texts.items()}
    ids, label = index.ids.tolist(), dict(zip(index.ids.tolist(), index.label.tolist()))
    size = [sum(v == x for v in label.values()) for x in (0, 1)]
    df, by = {}, ({}, {})
    for i, bag in bags.items():
        for t in bag:
            df[t] = df.get(t, 0) + 1
            if i in label:
                by[label[i]][t] = by[label[i]].get(t, 0) + 1

    def weight(t):
        a, b = by[1].get(t, 0), by[0].get(t, 0)
        p = (a + b) / sum(size)
        z = abs(a / size[1] - b / size[0]) / (p * (1 - p) * (1 / size[0] + 1 / size[1])) ** 0.5 if 0 < p < 1 else 0
        return (np.log((1 + len(texts)) / (1 + df[t])) + 1) * max(1, z)

    def vector(bag):
        w = {t: (1 + np.log(n)) * weight(t) for t, n in bag.items()}
        norm = sum(x * x for x in w.values()) ** 0.5
        return {t: x / norm for t, x in w.items()}
    vec = {i: vector(bag) for i, bag in bags.items()}
    for i in texts:
        want = sorted((-sum(x * vec[j].get(t, 0) for t, x in vec[i].items()), j) for j in ids)[:5]
        assert np.allclose([-s for s, _ in want], [e.cosine for e in got[i].evidence], atol=1e-9)
    assert len(got) == len(texts) and all(len(r.evidence) == 5 for r in got.values())


def test_matrix_and_postings_agree(monkeypatch):
    rng = np.random.default_rng(5)
    vocab, idf = np.arange(80, dtype=np.uint64), rng.uniform(1, 6, 80)

    def vector():
        t = np.sort(rng.choice(80, rng.integers(1, 20), replace=False))
        return t, toxicity._weights(t, rng.integers(1, 5, len(t)), idf)
    examples = [(j, j % 2, *vector()) for j in range(200)] + [(300 + j, 1, *vector()) for j in range(3)] * 2
    queries, found = [vector() for _ in range(40)], []
    for common in (0, 8, 10 ** 6):
        monkeypatch.setattr(toxicity, "COMMON", common)
        index = toxicity.Index(vocab, idf, examples)
        found.append([index.nearest(t, w, 5) for t, w in queries])
        assert (len(index.matrix) == 0) == (common == 0)
    for own in found[1:]:
        assert [[j for j, _ in n] for n in own] == [[j for j, _ in n] for n in found[0]]
