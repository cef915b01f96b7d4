"""File sources and model sinks.

Every reader takes an explicit schema: inference reads the data twice and
changes types with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table_csv(spark: SparkSession, path: str, schema: StructType | str,
                   sep: str = ",") -> DataFrame:
    """CSV with a header row; a UTF-8 byte-order mark before the first name is ignored."""
    return (spark.read.schema(schema).option("header", True).option("sep", sep)
            .option("enforceSchema", True).option("mode", "PERMISSIVE").csv(path))


def read_named_tsv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Tab-separated lines without a header; names come from ``schema``."""
    return (spark.read.schema(schema).option("header", False).option("sep", "\t")
            .option("quote", "\u0000").csv(path))


def read_series_csv(spark: SparkSession, path: str, schema: StructType | str,
                    date_format: str = "yyyy-MM-dd") -> DataFrame:
    """S3: a dated series; the date column is typed by the schema and parsed
    with ``date_format`` (order is kept as a column, not an index)."""
    return (spark.read.schema(schema).option("header", True).option("dateFormat", date_format)
            .csv(path))


def read_labelled_lines(spark: SparkSession, path: str, label_pattern: str = r"([^/]+?)(\.[^./]*)?$",
                        group: int = 1, drop_empty: bool = True) -> DataFrame:
    """One row per line of many text files; the label comes from the file path.

    By default the label is the file stem (``Arabic.txt`` -> ``Arabic``); pass
    another ``label_pattern`` for labels held in directory names.
    Returns (label, line, file).
    """
    df = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    out = df.select(F.regexp_extract("file", label_pattern, group).alias("label"), "line", "file")
    return out.where(F.length("line") > 0) if drop_empty else out


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a text corpus with empty lines dropped: (line)."""
    return spark.read.text(path).select(F.col("value").alias("line")).where(F.length("line") > 0)


def to_pandas(df: DataFrame, max_rows: int = 1_000_000):
    """Bring a *result* to the driver; refuses (never truncates) a result
    larger than ``max_rows``."""
    n = df.count()
    if n > max_rows:
        raise ValueError(f"result has {n} rows, more than max_rows={max_rows}; write it instead")
    return df.toPandas()


def from_pandas(spark: SparkSession, pdf, schema: StructType | str | None = None) -> DataFrame:
    """A small local table into Spark (Arrow transfer)."""
    return spark.createDataFrame(pdf, schema=schema)


def save_model(model, path: str) -> str:
    """Write a fitted model or pipeline (overwriting) to shared storage."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str, kind=None):
    """Read a model back; ``kind`` defaults to ``PipelineModel``."""
    if kind is None:
        from pyspark.ml import PipelineModel
        kind = PipelineModel
    return kind.load(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for derived files."""
    import uuid

    from quarry.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/quarry-io/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: downstream jobs that read it several times (boundary sampling,
    windows, per-bucket sizes) then share one computation, and a lost
    executor re-reads files instead of recomputing the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
