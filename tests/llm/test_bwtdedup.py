import hashlib
import random
from collections import Counter

import numpy as np

from conftest import SF_SMALL
from llm_cases import docs_of, nasty, no_docs  # noqa: F401
from quarry.llm import bwtdedup, queries


def brute(rows, length=200):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p:p + length] for _, b in raw for p in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(df, **kw):
    return [tuple(r) for r in bwtdedup.remove_repeats(df, **kw).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op4_repeated_bytes(spark, SF_SMALL).collect()]
    assert Counter(got) == Counter(brute(rows)) and sum(r[2] for r in got) > 0


def test_hard_repeats(spark, docs_of, monkeypatch):
    """Edited copies, shared passages at several borders, periodic text, many ranges and shards."""
    rnd = random.Random(8)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    base, passage = text(900), text(260)
    rows = [(0, base), (1, base), (2, "ab" * 300), (3, "ab" * 120 + passage), (4, "é" * 250), (5, passage[:199]),
            (6, passage[1:201]), (7, "x" * 199), (8, "y" * 200), (9, "z" * 201)]
    for i in range(10, 60):
        copy = list(base)
        for _ in range(rnd.randrange(1, 6)):
            copy[rnd.randrange(len(copy))] = rnd.choice("XYZ")
        rows.append((i, "".join(copy)))
    rows += [(i, text(rnd.randrange(0, 300)) + passage + text(rnd.randrange(0, 300))) for i in range(60, 100)]
    df = docs_of(rows).repartition(7)
    assert Counter(run(df)) == Counter(brute(rows))
    assert Counter(run(df, range_bytes=4000)) == Counter(brute(rows))


def test_hot_anchors(spark, docs_of):
    """A short line in many contexts, with and without copies of the contexts."""
    rnd = random.Random(9)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    line = text(90)
    rows = [(i, text(rnd.randrange(100, 400)) + line + text(rnd.randrange(100, 400))) for i in range(260)]
    rows += [(300 + i, text(30) + rows[i][1][20:-20] + text(30)) for i in range(0, 40)]
    df = docs_of(rows).repartition(16)
    assert Counter(run(df)) == Counter(brute(rows))


def test_shorter_length_and_edges(nasty, no_docs, docs_of):
    rows = [(r.doc_id, r.text) for r in nasty.collect()]
    assert Counter(run(nasty)) == Counter(brute(rows))
    assert Counter(run(nasty, length=100)) == Counter(brute(rows, 100))
    assert run(no_docs) == []
    copies = [(i % 3, "the same words again and again in every copy. " * 9) for i in range(40)]
    assert Counter(run(docs_of(copies))) == Counter(brute(copies))


def test_interleave_equals_sorting():
    """After d rounds the merged order is the order of all suffixes by d blocks, and the
    intervals are the runs of equal prefixes."""
    rng = np.random.default_rng(6)
    common = rng.integers(97, 99, 130).astype(np.uint8)
    shards, texts = [], []
    for k in range(4):
        parts = [np.concatenate([rng.integers(97, 99, rng.integers(0, 40)).astype(np.uint8), common,
                                 rng.integers(97, 99, 60 + 10 * k).astype(np.uint8)]) for _ in range(3)]
        texts.append([p.tobytes() for p in parts])
        shards.append(bwtdedup.Shard(np.concatenate(parts), np.array([len(p) for p in parts])))
    for rounds in (1, 2, 3):
        source, interval = bwtdedup.merge(shards, rounds)
        groups = {}
        place = [0] * 4
        for s, i in zip(source, interval):
            shard = shards[s]
            j = shard.order[place[s]]
            place[s] += 1
            t = texts[s][shard.snippet[j]][shard.offset[j]:shard.offset[j] + rounds * bwtdedup.BLOCK]
            groups.setdefault(int(i), []).append(t)
        full = [g for g in groups.values() if len(g[0]) == rounds * bwtdedup.BLOCK]
        assert all(len(set(g)) == 1 for g in full)
        assert len({g[0] for g in full}) == len(full)
        assert all(len(g) == 1 for g in groups.values() if len(g[0]) < rounds * bwtdedup.BLOCK)
