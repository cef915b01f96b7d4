"""Ordered-sequence operators.

Positions come from :mod:`quarry.operators.ordering`, so no operator runs a
window over the whole table (or a whole large group) in one task.  Neighbours
are met by windows inside blocks of positions whose edge rows are copied.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ordering import group_row_index, row_index, running_sums


def positions(df: DataFrame, order: Sequence[str], by: Sequence[str] = (),
              name: str = "pos") -> DataFrame:
    """0-based position in ``order`` (within each ``by`` group if given)."""
    if by:
        return group_row_index(df, list(by), order, name=name)
    return row_index(df, order, name=name)


#: positions of one block: a window over neighbours runs inside a block, never over a table or a group
BLOCK = 4096


def _blocked(idx: DataFrame, pos: str, before: int = 0, after: int = 0) -> DataFrame:
    """Rows with ``_blk``, the block of ``BLOCK`` (or more, for a longer reach) positions that they belong
    to; a row within ``before`` of a block's end or ``after`` of its start is copied into the next or the
    last block as well, with ``_own`` false.  Only these edge rows are copied."""
    size = max(BLOCK, before, after)
    blk, off = F.floor(F.col(pos) / size).cast("long"), F.col(pos) % size
    copies = [F.struct(blk.alias("_blk"), F.lit(True).alias("_own"))]
    if before:
        copies.append(F.when(off >= size - before, F.struct((blk + 1).alias("_blk"), F.lit(False).alias("_own"))))
    if after:
        copies.append(F.when((off < after) & (blk > 0), F.struct((blk - 1).alias("_blk"), F.lit(False).alias("_own"))))
    return (idx.select("*", F.explode(F.array(*copies)).alias("_b")).where(F.col("_b").isNotNull())
            .select(*idx.columns, "_b._blk", "_b._own"))


def _diff_of(idx: DataFrame, pos: str, col: str, by: Sequence[str], name: str) -> DataFrame:
    w = Window.partitionBy(*by, "_blk").orderBy(pos)
    prev = _blocked(idx, pos, before=1).withColumn("_prev", F.lag(col).over(w)).where("_own")
    zero = F.lit(0).cast(idx.schema[col].dataType)
    return prev.withColumn(name, F.coalesce(F.col(col) - F.col("_prev"), zero)).drop("_prev", "_blk", "_own")


def diff(df: DataFrame, order: Sequence[str], col: str, by: Sequence[str] = (),
         name: str | None = None) -> DataFrame:
    """First difference of ``col`` in ``order``; the first row (per group) is 0.

    The row before comes from ``lag`` inside blocks of positions, so the input is ordered once
    and nothing is joined."""
    by = list(by)
    return _diff_of(positions(df, order, by, "_p"), "_p", col, by, name or f"{col}_diff").drop("_p")


def _frames_of(idx: DataFrame, pos: str, cols: Sequence[str], n: int, target: str,
               by: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*by, "_blk").orderBy(pos).rowsBetween(0, n)
    row = F.struct(F.col(pos).alias("pos"), *cols, F.col(target).alias("_y"))
    framed = (_blocked(idx, pos, after=n).withColumn("_rows", F.collect_list(row).over(w))
              .where(F.col("_own") & (F.size("_rows") == n + 1)))
    inputs = F.transform(F.slice("_rows", 1, n), lambda x: F.struct(x["pos"].alias("pos"), *[x[c].alias(c) for c in cols]))
    return framed.select(*by, F.col(pos).alias("start"), inputs.alias("inputs"),
                         F.element_at("_rows", n + 1)["_y"].alias("target"))


def sliding_sequences(df: DataFrame, order: Sequence[str], cols: Sequence[str],
                      n: int, target: str, by: Sequence[str] = ()) -> DataFrame:
    """Every run of ``n`` consecutive rows plus the next row's ``target``.

    Returns (by..., start, inputs: array<struct<pos, cols...>>, target).  Only
    full frames are kept (all windows, including the last one).  Frames are
    gathered by a window inside blocks of positions; only the first n rows of
    a block are shuffled twice.
    """
    by = list(by)
    return _frames_of(positions(df, order, by, "_p"), "_p", cols, n, target, by)


def chronological_split(df: DataFrame, order: Sequence[str], frac: float = 0.9,
                        by: Sequence[str] = (), gap: int = 0) -> DataFrame:
    """First ``frac`` of rows (per group) are 'train', the rest 'test'.

    ``gap`` drops that many rows after the cut so test rows do not overlap the
    last training frame.
    """
    by = list(by)
    idx = positions(df, order, by, "_p")
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")) if by else None
    if by:
        idx = idx.join(sizes, by)
        n = F.col("_n")
    else:
        n = df.select(F.count(F.lit(1))).scalar()
    cut = F.floor(n * F.lit(frac))
    split = F.when(F.col("_p") < cut, F.lit("train")).when(
        F.col("_p") >= cut + gap, F.lit("test"))
    out = idx.withColumn("split", split).where(F.col("split").isNotNull())
    return out.drop("_n").withColumnRenamed("_p", "pos")


def _cut(idx: DataFrame, total: Column, bsz: int) -> DataFrame:
    seq_len = F.floor(total / F.lit(bsz))
    return (idx.where(F.col("_i") < seq_len * bsz)
            .withColumn("batch", F.floor(F.col("_i") / seq_len).cast("int"))
            .withColumn("pos", (F.col("_i") % seq_len).cast("long"))
            .drop("_i"))


def batchify(df: DataFrame, order: Sequence[str], bsz: int) -> DataFrame:
    """Cut the ordered sequence into ``bsz`` equal columns; the remainder is dropped.

    Element i goes to ``batch = i div seq_len`` at ``pos = i mod seq_len`` with
    ``seq_len = N div bsz``.
    """
    return _cut(row_index(df, order, name="_i"), df.select(F.count(F.lit(1))).scalar(), bsz)


def batchify_documents(docs: DataFrame, order: Sequence[str], tokens: str, bsz: int,
                       token: str = "token", at: str = "tpos", sep: str | None = None, runs: bool = False) -> DataFrame:
    """W6 for documents that hold their tokens: the stream of all tokens by document, then place.

    ``tokens`` is an array, or with ``sep`` a string of tokens joined by it ('' for none), which is
    far smaller to shuffle.
    A document's first position is the sum of the sizes before it, so documents are ordered
    (``order`` must be unique) and tokens never are.  NULL counts as empty.  Returns the other
    columns of ``docs`` with (at, token, batch, pos).  With ``runs`` a row is a run, all tokens of a document
    in one column: ``token`` is their array, ``at`` and ``pos`` are the places of the first one.
    """
    held = F.col(tokens)
    if sep is not None:
        held = F.when(held != "", F.split(held, re.escape(sep)))
    n = F.size(held)
    if sep is not None:  # separators are counted without splitting
        n = F.when(F.col(tokens) != "", F.floor((F.octet_length(tokens) - F.octet_length(F.replace(F.col(tokens), F.lit(sep), F.lit(""))))
                                                / len(sep.encode())).cast("int") + 1)
    sized = docs.withColumn("_n", F.greatest(F.coalesce(n, F.lit(0)), F.lit(0)))
    first = running_sums(sized, order, ["_n"], ["_first"])
    kept = [c for c in docs.columns if c != tokens]
    if runs:
        return _runs(first, sized.select(F.sum("_n")).scalar(), bsz, kept, held, token, at)
    idx = (first.select(*kept, "_first", F.posexplode(held).alias(at, token))
           .withColumn("_i", F.col("_first") + F.col(at)).drop("_first"))
    return _cut(idx, sized.select(F.sum("_n")).scalar(), bsz)


def _runs(first: DataFrame, total: Column, bsz: int, kept: Sequence[str], held: Column, token: str, at: str) -> DataFrame:
    """Documents with ``_first`` and ``_n`` cut at the ends of the columns."""
    step = F.greatest(F.col("_len"), F.lit(1))
    cut = (first.withColumn("_len", F.floor(total / F.lit(bsz)))
           .withColumn("_end", F.least(F.col("_first") + F.col("_n"), F.col("_len") * bsz)).where("_first < _end"))
    parts = cut.select(*kept, "_first", "_end", step.alias("_step"), held.alias("_held"),
                       F.explode(F.sequence(F.floor(F.col("_first") / step), F.floor((F.col("_end") - 1) / step))).alias("_b"))
    start = F.greatest(F.col("_first"), F.col("_b") * F.col("_step"))
    stop = F.least(F.col("_end"), (F.col("_b") + 1) * F.col("_step"))
    skip = (start - F.col("_first")).cast("int")
    return parts.select(*kept, skip.alias(at), F.slice("_held", skip + 1, (stop - start).cast("int")).alias(token),
                        F.col("_b").cast("int").alias("batch"), (start - F.col("_b") * F.col("_step")).cast("long").alias("pos"))


def next_token_pairs(df: DataFrame, seq: Sequence[str], pos: str, token: str,
                     name: str = "target", runs: bool = False) -> DataFrame:
    """Target is the token one position later in the same sequence; a position without a
    next one is dropped.  ``lead`` runs inside blocks of positions, so a sequence may be of
    any length.  Positions must be unique in a sequence.

    With ``runs`` a row holds an array of consecutive tokens from ``pos`` on: pairs are made inside it, and only
    the first and last token of a run are shuffled.  Returns (seq..., pos, token, target); ``df`` is read twice."""
    seq = list(seq)
    if runs:
        return _pairs_of_runs(df, seq, pos, token, name)
    w = Window.partitionBy(*seq, "_blk").orderBy(pos)
    nxt = _blocked(df, pos, after=1).withColumns({name: F.lead(token).over(w), "_next": F.lead(pos).over(w)})
    return nxt.where(F.col("_own") & (F.col("_next") == F.col(pos) + 1)).drop("_blk", "_own", "_next")


def _pairs_of_runs(df: DataFrame, seq: list[str], pos: str, token: str, name: str) -> DataFrame:
    inner = (df.select(*seq, F.col(pos).alias("_p"), F.col(token).alias("_run"), F.posexplode(token).alias("_i", "_t"))
             .where(F.col("_i") < F.size("_run") - 1)
             .select(*seq, (F.col("_p") + F.col("_i")).alias(pos), F.col("_t").alias(token),
                     F.get("_run", F.col("_i") + 1).alias(name)))
    n = F.size(token)
    end = F.struct((F.col(pos) + n).alias("at"), F.lit(True).alias("end"), F.get(token, n - 1).alias("t"))
    start = F.struct(F.col(pos).alias("at"), F.lit(False).alias("end"), F.get(token, F.lit(0)).alias("t"))
    edges = df.where(n > 0).select(*seq, F.explode(F.array(end, start)).alias("_e")).select(*seq, "_e.*")
    met = edges.groupBy(*seq, "at").agg(
        F.bool_or("end").alias("_l"), F.bool_or(~F.col("end")).alias("_r"),
        F.first(F.when(F.col("end"), F.col("t")), True).alias(token), F.first(F.when(~F.col("end"), F.col("t")), True).alias(name))
    return inner.unionByName(met.where("_l AND _r").select(*seq, (F.col("at") - 1).alias(pos), token, name))


def bptt_chunks(df: DataFrame, seq: Sequence[str], pos: str, token: str,
                bptt: int = 35, runs: bool = False) -> DataFrame:
    """Consecutive chunks of ``bptt`` positions (the last one shorter), as
    ordered token arrays: (seq..., chunk, tokens, n).

    With ``runs`` a row holds an array of consecutive tokens from ``pos`` on: whole chunks are cut out of it and
    only the rest is shuffled.  ``df`` is read twice."""
    seq = list(seq)
    if runs:
        return _chunks_of_runs(df, seq, pos, token, bptt)
    g = df.groupBy(*seq, F.floor(F.col(pos) / bptt).cast("long").alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(token).alias("t")))).alias("_s"))
    return g.select(*seq, "chunk", F.transform("_s", lambda x: x["t"]).alias("tokens"),
                    F.size("_s").cast("long").alias("n"))


def _chunks_of_runs(df: DataFrame, seq: list[str], pos: str, token: str, bptt: int) -> DataFrame:
    p, n = F.col(pos), F.size(token)

    def piece(c):
        start, stop = F.greatest(p, c * bptt), F.least(p + n, (c + 1) * bptt)
        return F.struct(c.alias("chunk"), start.alias("p"),
                        F.slice(token, (start - p + 1).cast("int"), (stop - start).cast("int")).alias("t"))
    chunks = F.sequence(F.floor(p / bptt), F.floor((p + n - 1) / bptt))
    cut = df.where(n > 0).select(*seq, F.explode(F.transform(chunks, piece)).alias("_c")).select(*seq, "_c.*")
    whole = cut.where(F.size("t") == bptt).select(*seq, "chunk", F.col("t").alias("tokens"))
    rest = cut.where(F.size("t") < bptt).groupBy(*seq, "chunk").agg(F.array_sort(F.collect_list(F.struct("p", "t"))).alias("_s"))
    joined = rest.select(*seq, "chunk", F.flatten(F.transform("_s", lambda x: x["t"])).alias("tokens"))
    return whole.unionByName(joined).withColumn("n", F.size("tokens").cast("long"))


def top_k_per_key(df: DataFrame, key: Sequence[str], score: str, k: int,
                  tie: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """The ``k`` best rows per key (score descending, ties by ``tie``).

    ``row_number() <= k`` is planned with a window group limit, so every map
    task forwards at most k rows per key before the shuffle.
    """
    w = Window.partitionBy(*key).orderBy(F.col(score).desc_nulls_last(), *tie)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
