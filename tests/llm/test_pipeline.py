import hashlib

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from llm_cases import docs_of, nasty, no_docs  # noqa: F401
from quarry.llm import bpe, decontam, queries
from test_linededup import brute as brute_lines
from test_neardup import brute as brute_classes
import public_tokenizers


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    kept = cp.language_id(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    lines = {i: t for i, t, _, _ in brute_lines(rows)}
    roots = brute_classes(list(lines.items()))
    rows = {i: lines[i] for i in lines if roots[i] == i}
    grams = lambda h: set(decontam.sequence_hash(h, 5).tolist())
    bad = set()
    for i, t in rows.items():
        own = grams(decontam._hashes(t))
        for it in items:
            parts = [decontam._hashes(p) for p in decontam.split_item(it)]
            if all(len(p) >= 5 or not len(p) for p in parts):
                want = [grams(p) for p in parts if len(p)]
                if sum(len(g & own) for g in want) >= 0.6 * sum(map(len, want)):
                    bad.add(i)
            elif it in t:
                bad.add(i)
    enc = bpe.encoder(public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN)
    want = {(i, n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(raw).hexdigest())
            for (i, _), (ids, n, raw) in zip([(i, t) for i, t in rows.items() if i not in bad],
                                             enc.encode([t for i, t in rows.items() if i not in bad]))}
    got = {tuple(r) for r in cp.run(spark, SF_SMALL).collect()}
    assert got == want and bad and len(got) > 100


@pytest.mark.parametrize("k", range(4))
def test_stage_edges(spark, nasty, no_docs, k):
    name, stage = cp.STAGES[k]
    labelled = nasty.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de"))
    for df in (nasty, labelled, no_docs):
        out = stage(spark, df, SF_SMALL)
        assert out.columns == df.columns
        have = sorted(str(r.doc_id) for r in out.collect())
        if df is no_docs:
            assert have == []
        elif name in ("line_dedup", "decontamination"):
            assert len(have) == df.count()
        elif name == "near_dedup":
            assert have.count("None") == 2 and len(have) == df.count()
    assert cp.STAGES[4][1](spark, no_docs, SF_SMALL).count() == 0


def test_filters_keep_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = cp.language_id(spark, docs, SF_SMALL)
    with_words = docs.where(F.col("text").rlike(r"\p{L}{3}"))
    assert with_words.join(kept, "doc_id", "left_anti").count() <= 0.002 * docs.count()
