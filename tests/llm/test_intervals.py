import math
import re
from collections import Counter

import numpy as np
import pytest

from conftest import SF_SMALL
from llm_cases import docs_of, nasty, no_docs  # noqa: F401
from quarry.llm import intervals, queries
from tools_compare import same_rows

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k):
    found = [(i, Counter(TERM.findall((t or "").translate(LOW)))) for i, t in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    N, L = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall((t or "").translate(LOW)))
    out = []
    for i, terms in asked.items():
        scored = []
        for d, c, n in found:
            m = 100 - 90 + ((90 * n * N) // L)
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in terms if c[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(i, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


def run(spark, docs, items, k):
    rows = spark.createDataFrame(items, "item_id long, text string")
    return Counter(map(tuple, intervals.search(docs, rows, k).collect()))


def test_query_equals_sql(spark, duck):
    df = queries.op13_ranked_search(spark, SF_SMALL)
    rel = duck.execute(intervals.SQL)
    ok, why = same_rows(df.columns, [tuple(r) for r in df.collect()], [c[0] for c in rel.description], rel.fetchall())
    assert ok, why


def test_edges(spark, nasty, no_docs):
    rows = [(r.doc_id, r.text) for r in nasty.collect()]
    items = [(1, "a first LINE of text"), (1, "hello"), (2, None), (3, ""), (None, "café 你好"), (4, "nowhere"), (5, "1234 x" + "x" * 2999)]
    for k in (1, 3, 20):
        assert run(spark, nasty, items, k) == brute(rows, items, k)
    assert not run(spark, no_docs, items, 3)
    assert not run(spark, nasty, [], 3)


def test_ties_and_long_texts(spark):
    rows = [(i, f"alpha beta w{i % 3}") for i in range(120)] + [(7, "alpha beta w0")] * 3 + [(None, "alpha beta w0")]
    rows += [(500, "alpha gamma " * 60_000), (501, "z" * 300_000 + " alpha")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, score long, item string")
    items = [(1, "alpha"), (2, "beta w0 w0"), (3, "gamma w2"), (4, "z" * 300_000)]
    assert run(spark, docs, items, 10) == brute(rows, items, 10)


def test_groups_of_items_and_small_shards(spark, monkeypatch):
    monkeypatch.setattr(intervals, "MAX_TERMS", 5)
    rows = [(i, " ".join(f"w{(i * j) % 17}" for j in range(i % 11))) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(j, f"w{j} w{j + 1} w{j + 5}") for j in range(9)]
    assert run(spark, docs, items, 4) == brute(rows, items, 4)


@pytest.mark.parametrize("leaf", [1, 16])
def test_shard_search_is_exact(monkeypatch, leaf):
    monkeypatch.setattr(intervals, "LEAF", leaf)
    rng = np.random.default_rng(3)
    for docs, terms in ((1, 1), (50, 5), (700, 12)):
        own = [np.sort(rng.choice(docs, rng.integers(1, docs + 1), replace=False)) for _ in range(terms)]
        term = np.repeat(np.arange(terms), [len(x) for x in own])
        doc = np.concatenate(own)
        impact = rng.integers(1, 6, len(doc))  # many ties
        shard = intervals.Shard(docs, term.astype(np.int64), doc.astype(np.int32), impact)
        weights = rng.integers(0, 4, terms)
        full = np.zeros(docs, np.int64)
        np.add.at(full, doc, weights[term] * impact)
        for k in (1, 3, 10):
            order = [d for d in np.lexsort((np.arange(docs), -full)) if full[d] > 0][:k]
            assert [tuple(x) for x in shard.search(np.arange(terms), weights, k)] == [(-full[d], d) for d in order]
            floor = int(full[order[-1]]) if order else 0
            assert [tuple(x) for x in shard.search(np.arange(terms), weights, k, floor)] == [(-full[d], d) for d in order]


def test_bounds_save_work():
    rng = np.random.default_rng(4)
    doc = np.tile(np.arange(5000), 3)
    term = np.repeat(np.arange(3), 5000)
    impact = rng.pareto(1.5, 15000).astype(np.int64) * 10 + 1
    shard = intervals.Shard(5000, term, doc.astype(np.int32), impact)
    shard.search(np.arange(3), np.ones(3, np.int64), 5)
    assert shard.scored < 1500


def test_range_maxima():
    rng = np.random.default_rng(5)
    impact = rng.integers(0, 50, 333)
    shard = intervals.Shard(333, np.zeros(333, np.int64), np.arange(333, dtype=np.int32), impact)
    a = rng.integers(0, 333, 500)
    b = np.minimum(333, a + 1 + rng.integers(0, 333, 500))
    assert all(impact[p] == impact[x:y].max() and x <= p < y for p, x, y in zip(shard.maxima(a, b), a, b))


def test_norm_beyond_64_bits():
    n = np.array([1, 10 ** 12], np.int64)
    assert intervals.norm(n, 10 ** 9, 10 ** 13).tolist() == [10 + 90 * int(x) * 10 ** 9 // 10 ** 13 for x in n]
