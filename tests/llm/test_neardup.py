import random
from collections import Counter

import numpy as np
import pytest

from conftest import SF_SMALL
from llm_cases import docs_of, nasty, no_docs  # noqa: F401
from quarry.llm import neardup, queries

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bag(text):
    w = [x for x in text.translate(LOW).replace("\x0b", " ").replace("\x0c", " ").split(" ")]
    w = " ".join(w).replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ")
    w = [x for x in w if x]
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def jaccard(x, y):
    return sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())


def brute(rows):
    bags = {i: bag(t) for i, t in rows}
    parent = {i: i for i in bags}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    holders = {}
    for i, x in bags.items():
        for d in x:
            holders.setdefault(d, []).append(i)
    pairs = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    for a, b in sorted(pairs):
        if root(a) != root(b) and jaccard(bags[a], bags[b]) >= 0.8 - 1e-12:
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    return {i: root(i) for i in bags}


def classes(df):
    return {r.doc_id: r.class_id for r in df.collect()}


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = classes(queries.op1_near_dedup(spark, SF_SMALL))
    assert got == brute(rows) and len(set(got.values())) < len(got)


def test_chains_and_crossing_buckets(docs_of):
    """Copies with growing numbers of edits, so that links run through chains."""
    rnd = random.Random(1)
    vocab = [f"w{i}" for i in range(500)]
    rows = []
    for base in range(6):
        words = [rnd.choice(vocab) for _ in range(60)]
        for _ in range(12):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            words[rnd.randrange(len(words))] = rnd.choice(vocab)
    rows += [(100 + i, " ".join(rnd.choice(vocab) for _ in range(60))) for i in range(10)]
    rnd.shuffle(rows)
    assert classes(neardup.near_duplicates(docs_of(rows))) == brute(rows)


def test_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(3)
    element = rng.integers(0, 2 ** 63, 60, dtype=np.uint64)
    x, y = rng.integers(0, 5, 60), rng.integers(0, 5, 60)
    cx, cy = Counter(dict(enumerate(x[x > 0]))), None
    cx = Counter({i: int(c) for i, c in enumerate(x) if c})
    cy = Counter({i: int(c) for i, c in enumerate(y) if c})
    want = jaccard(cx, cy)
    e = np.concatenate([element[x > 0], element[y > 0]])
    w = np.concatenate([x[x > 0], y[y > 0]])
    d = np.repeat([0, 1], [(x > 0).sum(), (y > 0).sum()])
    sig = neardup.signatures(e, w, d, 2, 6000)
    assert (sig[0] == sig[1]).mean() == pytest.approx(want, abs=0.03)
    order = np.argsort(element)
    keep_x, keep_y = order[x[order] > 0], order[y[order] > 0]
    assert neardup.similarity(element[keep_x], x[keep_x], element[keep_y], y[keep_y])[0] == pytest.approx(want)


def test_edges(nasty, no_docs, docs_of):
    got = classes(neardup.near_duplicates(nasty))
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8}
    assert neardup.near_duplicates(no_docs).count() == 0
    copies = docs_of([(i, "one two three four five six seven") for i in range(50)] + [(60, "One  two")] * 2 + [(61, "one two")])
    got = classes(neardup.near_duplicates(copies))
    assert {got[i] for i in range(50)} == {0} and got[60] == got[61] == 60
    kept = neardup.keep_one(copies)
    assert kept.columns == copies.columns and sorted(r.doc_id for r in kept.collect()) == [0, 60, 60]
    assert sum(r.doc_id is None for r in neardup.keep_one(nasty).collect()) == 2
