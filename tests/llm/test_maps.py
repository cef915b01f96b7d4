"""Language ID, BPE and decontamination: map-only operators."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from conftest import SF_SMALL
from llm_cases import docs_of, nasty, no_docs  # noqa: F401
from quarry.llm import bpe, decontam, langid, queries

PATH = public_tokenizers.path(queries.RANKS)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_library(spark, library):
    got = {r.doc_id: r for r in queries.op9_byte_bpe(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d.text)
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()


def test_bpe_hard_pieces(library):
    rnd = random.Random(3)
    texts = ["", None, "aaaa" * 60, "a" * 999, " \n\t  x", "ab" * 300, "你好" * 50, "\U0001f600\U0001f600!",
             "".join(rnd.choice("abcdeoéü") for _ in range(2000)), "<|endoftext|>", "it's we'll 1234567"]
    texts += ["".join(rnd.choice("ab éx") for _ in range(rnd.randint(1, 40))) for _ in range(300)]
    enc = bpe.encoder(PATH, public_tokenizers.PATTERN)
    for t, (ids, n, raw) in zip(texts, enc.encode(texts)):
        want = library.encode_ordinary(t or "")
        assert ids == ",".join(map(str, want)) and n == len(want)
        assert raw == (t or "").encode()


def test_bpe_long_words(library):
    """Unspaced words of some KB, and a text of many long ones."""
    import random
    rnd = random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    texts = ["".join(rnd.choice(letters) for _ in range(n)) for n in (3_000, 8_000)]
    texts += ["ab" * 10_000, "".join(chr(rnd.randrange(0x4E00, 0x9FA0)) for _ in range(1_500)), " ".join(t[:700] for t in texts)]
    enc = bpe.encoder(PATH, public_tokenizers.PATTERN)
    for t, (ids, n, raw) in zip(texts, enc.encode(texts)):
        want = library.encode_ordinary(t)
        assert [int(x) for x in ids.split(",")] == want and n == len(want) and raw == t.encode()


def test_bpe_generations(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    enc = bpe.Encoder(PATH, public_tokenizers.PATTERN)
    texts = [f"xqj{k} zqxw{k % 4} the {k % 3}qq" for k in range(40)]
    for t in texts + texts:
        (ids, _, raw), = enc.encode([t])
        assert [int(x) for x in ids.split(",")] == library.encode_ordinary(t) and raw == t.encode()
    assert len(enc.pieces.ids) + len(enc.pieces.old) < 30


def test_bpe_edges(nasty, no_docs):
    out = bpe.encode(nasty, PATH, public_tokenizers.PATTERN, with_ids=True).collect()
    assert len(out) == nasty.count()
    empty = hashlib.sha256(b"").hexdigest()
    for r in out:
        assert len(r.ids) == r.n_tokens
        if r.doc_id in (2, 3):
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (0, empty, empty)
    assert bpe.encode(no_docs, PATH, public_tokenizers.PATTERN).count() == 0


def test_language_id_held_out(spark):
    got = queries.op6_language_id(spark, "/root/testdata/sf0.01").alias("p")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = got.join(docs, "doc_id").where("held_out and lang is not null").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*"), F.min("score"), F.max("score")).first()
    assert r[1] > 100 and r[0] >= 0.97
    assert 0 <= r[2] <= r[3] <= 1


def test_language_id_edges(spark, nasty, no_docs):
    train = spark.createDataFrame([(i, t, lang) for i in range(30) for t, lang in
                                   (("the quick brown fox", "en"), ("le renard était brun", "fr"))],
                                  "doc_id long, text string, lang string")
    net = langid.train(train, steps=60)
    out = langid.predict(nasty, net).collect()
    assert len(out) == nasty.count()
    assert {r.lang_pred for r in out if r.doc_id in (2, 3, 5, 7)} == {"und"}
    assert all(r.score == 0 for r in out if r.lang_pred == "und")
    assert langid.predict(no_docs, net).count() == 0
    assert langid.train(train.where("false")) is None
    assert {r.lang_pred for r in langid.predict(nasty, None).collect()} == {"und"}
    kept = langid.keep_identified(nasty, net, min_score=0.0)
    assert kept.columns == nasty.columns
    assert {r.doc_id for r in kept.collect()} == {1, None, 4, 6, 8}


def _ngrams(words, n):
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def test_leaks_equal_brute_force(spark):
    import re
    tok = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    want = set()
    for d in docs:
        w = tok.findall(d.text.translate(low))
        grams = _ngrams(w, 5)
        for it in items:
            parts = [tok.findall(x.translate(low)) for x in decontam.split_item(it.text)]
            gs = [_ngrams(p, min(5, len(p))) if p else set() for p in parts]
            hit = [len(g & (grams if len(p) >= 5 else _ngrams(w, max(1, len(p))))) for g, p in zip(gs, parts)]
            if sum(hit) / sum(map(len, gs)) >= 0.6:
                want.add((d.doc_id, it.item_id))
    got = decontam.leaks(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"),
                         spark.read.parquet(f"{SF_SMALL}/benchmark.parquet"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and want


def test_block_max_loses_nothing():
    """Every (passage, item) score at or above the threshold is found."""
    import numpy as np
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(3, 45)))) for i in range(50)]
    df = {}
    for _, t in items:
        for x in set(decontam._hashes(t).tolist()):
            df[x] = df.get(x, 0) + 1
    index = decontam.Index(items, len(items), 20.0, df, 5)
    text = " ".join(rnd.choice(vocab) for _ in range(3000))
    text = text + " " + items[7][1] + " " + text[:500] + " " + items[31][1]
    h = decontam._hashes(text)
    got = {(j): s for _, j, s in index.candidates(h, np.zeros(len(h), int), 1, 0.3)}
    half, want = max(32, index.longest), {}
    for p in range(max(1, -(-len(h) // half) - 1)):
        seen = np.unique(h[p * half:(p + 2) * half])
        rows = index.weight[np.searchsorted(index.terms, np.intersect1d(seen, index.terms))].sum(axis=0)
        for j in np.flatnonzero(rows[:len(items)] >= 0.3):
            want[j] = max(want.get(j, 0), rows[j])
    assert set(got) == set(want) and {7, 31} <= set(got)
    assert all(abs(got[j] - want[j]) < 1e-4 for j in want)


def test_leaks_edges(spark, nasty, no_docs):
    items = spark.createDataFrame(
        [(1, "a first line of text"), (2, None), (3, ""), (None, "hello there"), (4, "hello there. a first line of text")],
        "item_id int, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(nasty, items).collect()}
    assert got == {(1, 1), (4, 1), (None, 1), (1, 4), (4, 4)}
    kept = decontam.drop_leaked(nasty, items)
    assert kept.columns == nasty.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "5", "6", "7", "8", "None"]
    assert decontam.leaks(no_docs, items).count() == 0
    assert decontam.leaks(nasty, items.where("false")).count() == 0
    assert decontam.drop_leaked(nasty, items.where("false")).count() == nasty.count()


def test_question_or_answer_alone_leaks(spark):
    rnd = random.Random(8)
    text = lambda n: " ".join(f"w{rnd.randrange(5000)}" for _ in range(n))
    items = [(i, text(q) + ". " + text(a) + ".") for i, (q, a) in enumerate([(12, 40), (40, 12), (5, 30), (30, 6), (3, 30)])]
    parts = [decontam.split_item(t) for _, t in items]
    docs = [(10 * i + k, text(90) + " " + p + " " + text(300)) for i, own in enumerate(parts) for k, p in enumerate(own)]
    # 70 % and 40 % of a question, and a bare question
    words = parts[1][0].split()
    docs += [(100, text(50) + " " + " ".join(words[:30])), (101, text(50) + " " + " ".join(words[:16])), (102, parts[0][0])]
    rows = decontam.leaks(spark.createDataFrame(docs, "doc_id int, text string"),
                          spark.createDataFrame(items, "item_id int, text string")).collect()
    # parts of 6 and 3 words are too short to count alone
    want = {(0, 0), (1, 0), (10, 1), (11, 1), (20, 2), (21, 2), (30, 3), (41, 4), (100, 1), (102, 0)}
    assert {(r.doc_id, r.item_id) for r in rows} == want
    assert {r.doc_id: r.question_overlap for r in rows}[0] == 1.0 and all(0 < r.score <= 1.0001 for r in rows)
    kept = decontam.drop_leaked(spark.createDataFrame(docs, "doc_id int, text string"),
                                spark.createDataFrame(items, "item_id int, text string"))
    assert {r.doc_id for r in kept.collect()} == {31, 40, 101}
