"""The registered queries of the text-corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (bpe, bwtdedup, decontam, divergence, hmm, intervals, langid, licenses, linededup, neardup, toxicity,
                        urlfilter, vptree)
from quarry.llm.common import documents, remainder, table
from quarry.session import ensure_checkpoint_dir

RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir))


def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vptree.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5, factor=1.0)


OP2_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(q.e, v.e) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 5
"""


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir)).drop("spans")


def op4_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwtdedup.remove_repeats(documents(spark, sf_dir))


def op5_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_corpus(documents(spark, sf_dir), remainder("doc_id", 5) == 1)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "lang")
    net = langid.train(docs.where(remainder("doc_id", 4) != 2))
    return langid.predict(docs, net).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    learn = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    index, share = toxicity.train(docs, learn)
    return toxicity.score(docs, index, share).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted",
        F.concat_ws(",", F.col("evidence.doc_id")).alias("evidence"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_dedup(documents(spark, sf_dir)).select(
        "doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = linededup.SQL + "SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM g"


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir, "lang", "source"))


#: fixed values: the rules of the URL filter, host, path and verdict
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of addresses holds those that more than one row of ``pages`` gives."""
    ensure_checkpoint_dir(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    repeated = (pages.groupBy(urlfilter.canonical(F.col("url")).alias("c"))
                .agg(F.min("url").alias("url"), F.count("*").alias("n")).where("n >= 2").select("url"))
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.filter_urls(pages, rules, repeated).select("page.page_id", "host", "path", "rule", "verdict", "listed")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_near_dedup, op2_nearest_vectors, op3_license_scan, op4_repeated_bytes, op5_hidden_markov, op6_language_id, op7_toxicity,
                            op8_line_dedup, op9_byte_bpe, op10_decontamination, op11_source_divergence, op12_url_filter,
                            op13_ranked_search)}

ORACLE: dict[str, str] = {"op2_nearest_vectors": OP2_SQL, "op8_line_dedup": OP8_SQL, "op11_source_divergence": divergence.SQL,
                          "op12_url_filter": urlfilter.SQL, "op13_ranked_search": intervals.SQL}
