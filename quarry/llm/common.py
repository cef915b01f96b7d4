"""Shared pieces of the text operators: tables, splits and checkpoints."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir, table
from quarry.sources.files import materialize

__all__ = ["documents", "filter_rows", "materialize", "named", "remainder", "row_key", "saved", "table"]


def documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return table(spark, sf_dir, "documents").select("doc_id", "text", *more)


def remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def named(name: str) -> Column:
    """The column of exactly this name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def filter_rows(docs: DataFrame, judge: Callable) -> DataFrame:
    """The rows, with all their columns, for whose texts (an Arrow column) ``judge`` gives true.
    Columns travel under plain names, as ``mapInArrow`` takes a dot for a field of a struct."""
    at = docs.columns.index("text")
    flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(judge(batch.column(at)), pa.bool_()))
    return flat.mapInArrow(run, flat.schema).toDF(*docs.columns)


def row_key(text: str) -> Column:
    """Tells rows apart that share an id but not a text."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage in the cluster's shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
