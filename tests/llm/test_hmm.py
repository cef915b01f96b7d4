import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from llm_cases import docs_of, nasty, no_docs  # noqa: F401
from quarry.llm import hmm, queries
from quarry.llm.common import remainder

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TOK = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """Base columns of (doc_id, text) rows."""
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    seqs = [TOK.findall((t or "").translate(LOW)) + [None] for _, t in rows]
    c = Counter(w for s, h in zip(seqs, held) if not h for w in s)
    n, v = sum(c.values()), len(c)
    return [(i, h, len(s), sum(c[w] > 0 for w in s), n,
             sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in s)) for (i, _), s, h in zip(rows, seqs, held)]


def test_base_equals_brute_force_and_model_is_better(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.op5_hidden_markov(spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    for i, h, n, known, total, base in brute(rows):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score <= 0 and math.isfinite(r.score)
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_forward_equals_enumeration():
    rng = np.random.default_rng(1)
    chain = hmm.Chain(3, np.full(5, 0.2), 4)
    n = np.array([4, 1, 6])
    sym = rng.integers(0, 5, n.sum()).astype(np.uint16)
    got = chain.log10_likelihood(sym, n)
    at = 0
    for k, length in enumerate(n):
        s = sym[at:at + length]
        at += length
        total = 0.0
        for path in np.ndindex(*[3] * length):
            p = chain.start[path[0]] * chain.emit[s[0], path[0]]
            for t in range(1, length):
                p *= chain.move[path[t - 1], path[t]] * chain.emit[s[t], path[t]]
            total += p
        assert got[k] == pytest.approx(math.log10(total))


def test_expected_counts_equal_enumeration_and_likelihood_rises():
    rng = np.random.default_rng(2)
    chain = hmm.Chain(2, np.full(4, 0.25), 4)
    n = np.array([3, 5])
    sym = rng.integers(0, 4, 8).astype(np.uint16)
    c = chain.segments(sym, n)
    want = np.zeros_like(c)
    at = 0
    for length in n:
        s = sym[at:at + length]
        at += length
        paths = []
        for path in np.ndindex(*[2] * length):
            p = chain.start[path[0]] * chain.emit[s[0], path[0]]
            for t in range(1, length):
                p *= chain.move[path[t - 1], path[t]] * chain.emit[s[t], path[t]]
            paths.append((path, p))
        total = sum(p for _, p in paths)
        for path, p in paths:
            want[path[0]] += p / total
            for t in range(length):
                want[8 + s[t] * 2 + path[t]] += p / total
                if t:
                    want[4 + path[t - 1] * 2 + path[t]] += p / total
    assert np.allclose(c, want, atol=1e-4)
    big_n = np.full(40, 100)
    big = np.repeat(rng.integers(0, 2, 400), 10)  # slow switching between two regimes
    big = (big * 2 + rng.integers(0, 2, 4000)).astype(np.uint16)
    before = chain.log10_likelihood(big, big_n).sum()
    for _ in range(5):
        chain.update(chain.segments(big, big_n), np.full(4, 0.25))
        after = chain.log10_likelihood(big, big_n).sum()
        assert after >= before - 1e-3
        before = after


def test_many_ranges_and_edges(spark, nasty, no_docs):
    rows = [(r.doc_id, r.text) for r in nasty.collect()]
    got = hmm.score_corpus(nasty, remainder("doc_id", 5) == 1, range_words=3).collect()
    key = lambda t: tuple((x is None, x) for x in t[:5])
    have = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    for a, b in zip(have, sorted(brute(rows), key=key)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
    assert len(have) == len(rows)
    assert hmm.score_corpus(no_docs, remainder("doc_id", 5) == 1).count() == 0
    alone = hmm.score_corpus(nasty, F.lit(True)).collect()
    assert {r.train_tokens for r in alone} == {0} and all(r.base_score == 0 and math.isfinite(r.score) for r in alone)
