"""Line dedup in DataFrame functions only.

Lines are exploded, normalised and hashed; hashes found in enough documents
lose their lines everywhere but in the smallest document that holds them, and
texts are put together again by position.  Only (document, position, hash)
rows are shuffled for the counts, never the lines.  A hash that a third of
all documents share is counted by a distinct aggregate that is spread over
(hash, document) first, and the join on it is a sort-merge join whose large
partitions AQE splits.

Defined results: a null or empty text is one empty line.  Rows with a null id
take no part: their lines are neither counted nor dropped.  Rows that repeat
an id count as one document; each of them loses its own lines.  A document
that loses all lines keeps an empty text.  Other columns are kept as they are, whatever
their names.  Very long texts are split whole; a line of any length is known by the 128 bits of its hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialize, named, row_key

#: bytes that count as white space at the ends of a line
SPACE = "\t\n\x0b\x0c\r "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_dedup(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """(doc, kept, n_lines, n_dropped): ``doc`` is a struct of the input row,
    ``kept`` the text that is left."""
    lines = materialize(
        docs.select(F.col("doc_id").alias("d"), F.col("text").alias("t")).where(F.col("d").isNotNull())
        .select("d", row_key("t").alias("h"), F.posexplode(_lines(F.col("t"))).alias("p", "line"))
        .select("d", "h", "p", line_key(F.col("line")).alias("k"))
        .where(F.char_length("k") >= min_chars)
        .select("d", "h", "p", F.unhex(F.md5(F.col("k").cast("binary"))).alias("k")), "line-keys")
    shared = (lines.groupBy("k").agg(F.count_distinct("d").alias("n"), F.min("d").alias("keep"))
              .where(F.col("n") >= min_docs).select("k", "keep"))
    drops = (lines.join(shared, "k").where(F.col("d") != F.col("keep"))
             .groupBy("d", "h").agg(F.collect_set("p").alias("drop")))
    rows = docs.select(F.struct(*map(named, docs.columns)).alias("doc"), F.col("doc_id").alias("d0"),
                       row_key("text").alias("h0"))
    out = rows.join(drops, (F.col("d0") == F.col("d")) & (F.col("h0") == F.col("h")), "left")
    # the split text is a column of its own that is read more than once, so that the
    # planner keeps it instead of splitting again for every line
    out = out.select("doc", "drop", _lines(F.col("doc.text")).alias("line"))
    left = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size("line") - 1), F.col("drop")))
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("line"), i)), "\n")
    return out.select(
        "doc",
        F.when(F.col("drop").isNull(), F.array_join("line", "\n")).otherwise(kept).alias("kept"),
        F.size("line").cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"))


SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(a, 1) AS p, unnest(a) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)
), k AS (
  SELECT doc_id, p, line,
         translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM l
), s AS (
  SELECT k, min(doc_id) AS keep FROM k WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), j AS (
  SELECT k.doc_id, k.p, k.line, (s.keep IS NOT NULL AND s.keep <> k.doc_id) AS dropped
  FROM k LEFT JOIN s ON k.k = s.k
), g AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT dropped), '') AS kept
  FROM j GROUP BY doc_id
)
"""
