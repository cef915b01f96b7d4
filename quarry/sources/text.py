"""Tables held in text: lines and Markdown pipe tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def text_to_rows(df: DataFrame, col: str, keys: Sequence[str] = (), name: str = "line",
                 drop_empty: bool = True) -> DataFrame:
    """One row per line of each whole text: (keys..., line_no, line)."""
    out = df.select(*keys, F.posexplode(F.split(F.col(col), "\n")).alias("line_no", name))
    return out.where(F.length(name) > 0) if drop_empty else out


def pipe_table_to_rows(df: DataFrame, col: str, names: Sequence[str], keys: Sequence[str] = (),
                       header_rows: int = 1) -> DataFrame:
    """A Markdown pipe table inside a text column to string columns.

    The header line(s) and the rule row (``|---|---|``) are dropped, the empty
    cells outside the outer pipes are dropped, cells are trimmed and taken by
    position.  Returns (keys..., row_no, names...) with ``row_no`` counting
    body rows from 0 within each text.
    """
    keys = list(keys)
    src = df if keys else df.withColumn("_tid", F.monotonically_increasing_id())
    part = keys or ["_tid"]
    lines = text_to_rows(src, col, part)
    rule = r"^\s*\|?(\s*:?-+:?\s*\|)+\s*(:?-+:?)?\s*$"
    body = lines.where(F.trim("line").startswith("|") & ~F.col("line").rlike(rule))
    # one window per text: bounded by the size of that text
    w = Window.partitionBy(*part).orderBy("line_no")
    numbered = body.withColumn("row_no", F.row_number().over(w) - 1 - header_rows).where("row_no >= 0")
    cells = F.split(F.regexp_replace(F.trim("line"), r"^\||\|$", ""), r"\|")
    out = numbered.select(*part, "row_no", cells.alias("_cells"))
    return out.select(*keys, "row_no",
                      *[F.trim(F.get(F.col("_cells"), i)).alias(n) for i, n in enumerate(names)])
