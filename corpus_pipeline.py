"""The corpus pipeline: five stages over ``documents``, each by an operator of ``quarry.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; ``run`` writes each stage's rows as Parquet in the shared
checkpoint folder and reads them back.  All stages but the last return the
columns of ``docs`` as they come, extra ones included.

Defined results: rows with a null or letterless text go in the first stage.
Rows with a null id pass line dedup and near-dedup as they are.  A document
that loses all its lines stays with an empty text.  ``n_chars``, where there is
such a column, follows the text.  Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, decontam, langid, linededup, neardup
from quarry.llm.common import materialize, remainder, table
from quarry.llm.queries import RANKS
from quarry.session import ensure_checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the byte network identifies; it learns from three
    quarters of the documents that have a language."""
    net = langid.train(docs.select("doc_id", "text", "lang").where(remainder("doc_id", 4) != 2))
    return langid.keep_identified(docs, net)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document of smaller id holds."""
    out = linededup.line_dedup(docs)
    text = F.when(F.col("doc.text").isNotNull(), F.col("kept"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length(text)).otherwise(
            F.col("doc.n_chars")).cast(docs.schema["n_chars"].dataType)
    quoted = {c: c.replace("`", "``") for c in docs.columns}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"doc.`{quoted[c]}`").alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate class: that of the smallest id."""
    return neardup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    return decontam.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    return bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontaminate), ("byte_bpe", byte_bpe)]

#: SQL expresses neither the network nor the signatures; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
