"""Source divergence audit: how far each source's words lie from the other sources of its language.

Texts are tokenised by one ``bytes.translate`` (A-Z lowered, every separator
blanked) and ``bytes.split``; a ``Counter`` per document gives frequencies and
the document's terms.  A task sums them per (language, source) and hands on
(term, count, documents) rows whenever its tables reach a fixed size, so the
shuffle carries sums and a task's memory does not follow its input.

A language keeps the terms of at least ``min_docs`` of its documents.  With
count c in a group of N kept tokens and V kept terms the smoothed share is
p = 1 + floor(10^9 (c + 2) / (N + 2 V)), and two shares differ by
f = floor((p - q)^2 / (p + q)).  All of it is integer arithmetic: decimals of 38
digits for p, 64 bits for f.

Sources are compared over blocks of terms: a group of the pair stage holds the
cells of at most two chunks of sources for one block of terms, whatever the
number of terms, sources or documents of a language.  Terms that neither chunk
has are added at the end, as they all give the same f.  The pairs of sources
themselves are the result, one row for each ordered pair.

Defined results: null text, lang and source count as the empty text.  Rows
repeat as they occur (a repeated id is another document).  A group without terms
still has its pairs; a language without kept terms has pairs of value 0 and no
terms.  A language of one source has no pair.  Ties rank by the item's UTF-8
bytes.  Long texts are split in pieces of ``PIECE`` bytes at separators, and no
word is cut.  Other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialize
from quarry.llm.words import column

#: A-Z to a-z; letters and bytes from 0x80 stay; everything else becomes a blank
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
PIECE = 1 << 20
#: entries of a task's tables before they are handed on
HELD = 200_000
SCALE = 1_000_000_000
#: about so many sources in a chunk, and terms in a block, of the pair stage
CHUNK, BLOCK = 128, 2048

_COUNTS = "lang string, source string, term string, n long, docs long"


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """The terms of one text, in lists that cover about ``PIECE`` bytes each."""
    if len(text) <= PIECE:
        yield text.translate(FOLD).split()
        return
    folded, start = text.translate(FOLD), 0
    while start < len(folded):
        end = folded.find(b" ", start + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[start:end].split()
        start = end


def term_counts(text: bytes) -> Counter:
    """Frequencies of one document's terms."""
    counts: Counter = Counter()
    for piece in tokens(text):
        counts.update(piece)
    return counts


def _sums(groups: dict) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "docs"]
    for (lang, source), (freq, docs) in groups.items():
        if freq:
            m = len(freq)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * m, pa.string()), pa.array([source] * m, pa.string()),
                 pa.array(freq, pa.binary()).cast(pa.string()), pa.array(freq.values(), pa.int64()),
                 pa.array([docs[t] for t in freq], pa.int64())], names)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict = {}
    held = 0
    for batch in batches:
        lang, source = column(batch, "lang").to_pylist(), column(batch, "source").to_pylist()
        text = column(batch, "text").cast(pa.large_binary())
        for i in range(batch.num_rows):
            counts = term_counts(text[i].as_py())
            freq, docs = groups.setdefault((lang[i], source[i]), ({}, Counter()))
            before = len(freq)
            for term, n in counts.items():
                freq[term] = freq.get(term, 0) + n
            docs.update(counts.keys())
            held += len(freq) - before
            if held >= HELD:
                yield from _sums(groups)
                groups, held = {}, 0
    yield from _sums(groups)


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term in every group."""
    return (docs.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(count: Column, tokens_of: Column, terms: Column) -> Column:
    """p of a term with ``count`` occurrences in a group of ``tokens_of`` kept tokens."""
    wide = (count + 2).cast("decimal(38,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", wide, (tokens_of + 2 * terms).cast("decimal(38,0)")) + 1


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def compare_block(part: pd.DataFrame) -> pd.DataFrame:
    """Sum of f over the block's terms for every pair of sources of chunks ``a`` and ``b``.

    Rows with a null term carry a source and its share ``p`` of a term it does not
    have; the others carry the share of one term.
    """
    a, b = int(part["a"].iloc[0]), int(part["b"].iloc[0])
    own = part[part["term"].isna()].sort_values("source", kind="stable")
    names, chunk = own["source"].to_numpy(object), own["chunk"].to_numpy(np.int64)
    zero = own["p"].to_numpy(np.int64)
    cells = part[part["term"].notna()]
    place, terms = pd.factorize(cells["term"])
    dense = np.repeat(zero[:, None], len(terms), axis=1)
    at = {s: i for i, s in enumerate(names)}
    dense[cells["source"].map(at).to_numpy(np.int64), place] = cells["p"].to_numpy(np.int64)
    left, right = np.flatnonzero(chunk == a), np.flatnonzero(chunk == b)
    out = []
    for g in left:
        others = right[right > g] if a == b else right
        if len(others):
            gap, total = dense[others] - dense[g], dense[others] + dense[g]
            out.append(pd.DataFrame({"x": names[g], "y": names[others], "f": (gap * gap // total).sum(axis=1),
                                     "seen": len(terms), "x0": zero[g], "y0": zero[others]}))
    kinds = {"x": object, "y": object, "f": np.int64, "seen": np.int64, "x0": np.int64, "y0": np.int64}
    found = pd.concat(out, ignore_index=True) if out else pd.DataFrame({k: pd.Series(dtype=t) for k, t in kinds.items()})
    found.insert(0, "lang", part["lang"].iloc[0])
    return found


def _pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of sources of a language."""
    size = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    shaped = groups.join(size, "lang").select(
        "lang", "source", "terms", F.when(F.col("terms") > 0, share(F.lit(0), F.col("tokens"), F.col("terms")))
        .otherwise(0).alias("p0"), F.ceil(F.col("sources") / CHUNK).alias("chunks"),
        F.greatest(F.ceil(F.col("terms") / BLOCK), F.lit(1)).alias("blocks"))
    shaped = shaped.withColumn("chunk", F.pmod(F.xxhash64("source"), F.col("chunks")))
    meets = F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda c: F.named_struct(
        F.lit("a"), F.least(c, F.col("chunk")), F.lit("b"), F.greatest(c, F.col("chunk"))))
    blank = shaped.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), "chunk",
                          F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
                          meets.alias("m"))
    full = cells.join(shaped.select("lang", "source", "chunk", "chunks", "blocks"), ["lang", "source"]).select(
        "lang", "source", "term", "p", "chunk",
        F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), meets.alias("m"))
    names = ["lang", "source", "term", "p", "chunk", "block", "m.a", "m.b"]
    rows = blank.withColumn("m", F.explode("m")).select(*names).union(full.withColumn("m", F.explode("m")).select(*names))
    sums = (rows.groupBy("lang", "block", "a", "b").applyInPandas(
                compare_block, "lang string, x string, y string, f long, seen long, x0 long, y0 long")
            .groupBy("lang", "x", "y").agg(F.sum("f").alias("f"), F.sum("seen").alias("seen"),
                                           F.max("x0").alias("x0"), F.max("y0").alias("y0")))
    of_lang = groups.select("lang", "terms").distinct()
    value = F.col("f") + F.when(F.col("terms") > 0, (F.col("terms") - F.col("seen"))
                                * distance(F.col("x0"), F.col("y0"))).otherwise(0)
    both = F.explode(F.array(F.struct(F.col("x").alias("source"), F.col("y").alias("item")),
                             F.struct(F.col("y").alias("source"), F.col("x").alias("item"))))
    return sums.join(of_lang, "lang").select("lang", both.alias("s"), value.alias("value")).select(
        "lang", "s.source", "s.item", "value")


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` ranks the other sources of
    the language by divergence, part ``term`` the ``top`` terms that a source overuses."""
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = materialize(count_terms(docs), "term-counts")
    kept = (counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
            .where(F.col("docs") >= min_docs).select("lang", "term", "total"))
    cells = materialize(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "total"), "term-cells")
    of_group = cells.groupBy("lang", "source").agg(F.sum("n").alias("tokens"))
    of_lang = (cells.groupBy("lang", "term").agg(F.first("total").alias("total"))
               .groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_tokens")))
    zero = F.lit(0).cast("long")
    groups = materialize(
        docs.select("lang", "source").distinct().join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("tokens", "terms", "lang_tokens")]), "term-groups")

    shares = cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("tokens"), F.col("terms")).alias("p"),
        share(F.col("total"), F.col("lang_tokens"), F.col("terms")).alias("q"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    over = (shares.where(F.col("p") > F.col("q"))
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    distance(F.col("p"), F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top))
    apart = (_pairs(shares.drop("q"), groups)
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
             .withColumn("rank", F.row_number().over(by_value)))
    return apart.unionByName(over)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents
), w AS (
  SELECT k, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 10
), c AS (
  SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL
), lt AS (
  SELECT lang, count(*) AS v, sum(total) AS ln FROM kept GROUP BY lang
), g AS (
  SELECT e.lang, e.source, coalesce(s.n, 0)::HUGEINT AS n, coalesce(lt.v, 0)::HUGEINT AS v, coalesce(lt.ln, 0)::HUGEINT AS ln
  FROM (SELECT DISTINCT lang, source FROM d) e
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) s USING (lang, source) LEFT JOIN lt USING (lang)
), p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * g.v) AS p,
         1 + (1000000000::HUGEINT * (kept.total + 2)) // (g.ln + 2 * g.v) AS q
  FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(pair.value, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN pair ON pair.lang = x.lang AND pair.source = x.source AND pair.item = y.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p WHERE n > 0 AND p > q
), r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= 10
"""
