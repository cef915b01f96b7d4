"""Feature engineering in long (sparse) form.

Documents stay as (doc, term, weight) rows: no dense matrix is built.
Vocabulary-sized tables (document frequency, IDF, vocabulary ids) are joined
without a broadcast hint; AQE converts the join to a broadcast only when the
measured size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from quarry.functions.text import STOP_WORDS, word_tokens
from quarry.operators.ordering import row_index, with_groups


def terms(df: DataFrame, doc: str | Sequence[str], text: str, stop_words: Sequence[str] | None = STOP_WORDS,
          min_len: int = 2) -> DataFrame:
    """(doc..., pos, term): lower-cased word tokens of each whole text, stop words removed."""
    toks = _word_lists(text, stop_words, min_len)
    return df.select(*([doc] if isinstance(doc, str) else doc), F.posexplode(toks).alias("pos", "term"))


def _word_lists(text: str, stop_words: Sequence[str] | None, min_len: int) -> Column:
    toks = word_tokens(text, min_len)
    if stop_words:
        # IN over literals becomes a hash-set lookup (array_contains would scan the list)
        stop = list(stop_words)
        toks = F.filter(toks, lambda t: ~t.isin(stop))
    return toks


def bag_of_words(term_rows: DataFrame, doc: str) -> DataFrame:
    """Term counts per document: (doc, term, tf)."""
    return term_rows.groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf"))


def term_counts(df: DataFrame, keep: Sequence[str], text: str, stop_words: Sequence[str] | None = STOP_WORDS,
                min_len: int = 2) -> DataFrame:
    """X8 in one pass: (keep..., term, tf).  ``keep`` holds the document's key and whatever else of the
    document is wanted later, so nothing is joined back."""
    toks = terms(df, list(keep), text, stop_words, min_len)
    return toks.groupBy(*keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def term_lists(df: DataFrame, keep: Sequence[str], text: str, stop_words: Sequence[str] | None = STOP_WORDS,
               min_len: int = 2) -> DataFrame:
    """X8 in one row a document: (keep..., terms, tfs), the different terms of its text and their counts.

    The terms of an Arrow batch are counted as pairs of row and code, so nothing is shuffled; only the rows of
    a key that comes more than once are added up by a shuffle."""
    from quarry.sources.files import materialize
    keep = list(keep)
    src = df.select(*keep, _word_lists(text, stop_words, min_len).alias("_t"))
    schema = StructType([*src.schema.fields[:-1], StructField("terms", ArrayType(StringType())), StructField("tfs", ArrayType(LongType()))])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        for batch in batches:
            lists = batch.column(len(keep))
            coded = lists.flatten().dictionary_encode()
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            width = max(1, len(coded.dictionary))
            pairs, tf = np.unique(np.repeat(np.arange(batch.num_rows), sizes) * np.int64(width) + coded.indices.to_numpy(), return_counts=True)
            offsets = pa.array(np.searchsorted(pairs, np.arange(batch.num_rows + 1) * np.int64(width)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.ListArray.from_arrays(offsets, coded.dictionary.take(pa.array(pairs % width))),
                 pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int64()))], schema.names)
    lists = materialize(src.mapInArrow(run, schema), "term-lists")
    again = materialize(lists.groupBy(*keep).agg(F.count(F.lit(1)).alias("_k")).where("_k > 1"), "repeated-keys")
    if again.isEmpty():
        return lists
    marked = with_groups(lists, again, keep, "left")
    merged = (marked.where("_k IS NOT NULL").select(*keep, F.explode(F.arrays_zip("terms", "tfs")).alias("_z"))
              .groupBy(*keep, F.col("_z.terms").alias("t")).agg(F.sum("_z.tfs").alias("n"))
              .groupBy(*keep).agg(F.collect_list(F.struct("t", "n")).alias("_z"))
              .select(*keep, F.col("_z.t").alias("terms"), F.col("_z.n").alias("tfs")))
    return materialize(marked.where("_k IS NULL").select(*lists.columns).unionByName(merged), "term-lists")


#: keys of a lookup that are broadcast; the next one holds at most one row in so many
HOT_KEYS = 1000


def join_terms(rows: DataFrame, lookup: DataFrame, key: str, first: Column, how: str = "inner") -> DataFrame:
    """``rows`` with the other columns of ``lookup`` (unique on ``key``) when few keys hold most rows.

    The ``HOT_KEYS`` keys that come first by ``first`` (the most frequent) are broadcast, so that table's
    size is fixed, and their rows are not shuffled; all other rows meet the lookup in a shuffle join.  ``rows`` is
    read by both parts.  Rows whose key is NULL or not in the lookup are dropped by ``how="inner"`` and kept
    with NULLs by ``"left"``.
    """
    values = [c for c in lookup.columns if c != key]
    packed = lookup.select(F.col(key).alias("_jk"), F.struct(*values).alias("_jv"), first.alias("_jo"))
    hot = F.broadcast(packed.orderBy("_jo", "_jk").limit(HOT_KEYS).select("_jk", "_jv"))
    same = F.col(key) == F.col("_jk")
    out = [*rows.columns, *[F.col("_jv")[c].alias(c) for c in values]]
    keyed = rows.where(F.col(key).isNotNull())
    cold = keyed.join(hot, same, "left_anti").join(packed.select("_jk", "_jv"), same, how)
    found = keyed.join(hot, same).select(*out).unionByName(cold.select(*out))
    if how == "inner":
        return found
    return found.unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True)


#: entries of a lookup that tasks hold (:func:`look_up_lists`)
HELD_KEYS = 1 << 17


def look_up_lists(rows: DataFrame, name: str, keys: str, lookup: DataFrame, key: str, value: str, first: Column,
                  default: Column | None = None, drop: bool = False) -> DataFrame:
    """``rows`` (with ``drop`` without ``keys``) and ``name``: for every element of the string array ``keys`` its ``value`` in ``lookup`` (unique on
    ``key``), or ``default``.

    The ``HELD_KEYS`` entries that come first by ``first`` (the most frequent) are sent to every task, so their
    size is fixed; only the elements that are not among them are shuffled, once by key and once by row.
    """
    from quarry.sources.files import materialize
    entries = lookup.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(value).alias("v"), first.alias("o"))
    held = rows.sparkSession.sparkContext.broadcast(entries.orderBy("o", "k").limit(HELD_KEYS).select("k", "v").toArrow())
    kinds = {f.name: f.dataType for f in lookup.schema.fields}
    kept = [c for c in rows.columns if not (drop and c == keys)]
    schema = StructType([*(rows.schema[c] for c in kept), StructField("_r", LongType()), StructField("_v", ArrayType(kinds[value])),
                         StructField("_o", ArrayType(IntegerType())), StructField("_c", ArrayType(StringType()))])
    at, own = rows.columns.index(keys), [rows.columns.index(c) for c in kept]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext
        known = held.value.column("k").combine_chunks()
        values = held.value.column("v").combine_chunks()
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            lists = batch.column(at)
            flat, n = lists.flatten(), batch.num_rows
            starts = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy()))
            found = pc.index_in(flat, value_set=known)
            open_ = found.is_null().to_numpy(zero_copy_only=False) & flat.is_valid().to_numpy(zero_copy_only=False)
            before = np.append(0, np.cumsum(open_))  # open elements before each element
            order = (before[:-1] - np.repeat(before[starts[:-1]], np.diff(starts))).astype(np.int32)
            offsets = pa.array(starts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in own), pa.array(np.arange(row, row + n)), pa.ListArray.from_arrays(offsets, values.take(found)),
                 pa.ListArray.from_arrays(offsets, pa.array(order, mask=~open_)),
                 pa.ListArray.from_arrays(pa.array(before[starts], pa.int32()), flat.filter(pa.array(open_)))], schema.names)
            row += n
    # read by the open elements and by the join that brings their values back
    stored = materialize(rows.mapInArrow(run, schema), "looked-up")
    rest = (stored.select("_r", F.posexplode("_c").alias("_i", "k")).join(entries.select("k", "v"), "k", "left")
            .groupBy("_r").agg(F.array_sort(F.collect_list(F.struct("_i", "v"))).alias("_m")))
    fill = [] if default is None else [default]
    values = F.transform("_v", lambda x, i: F.coalesce(x, F.get("_m", F.get("_o", i))["v"], *fill))
    return stored.join(rest, "_r", "left").withColumn(name, values).select(*kept, name)


def idf_table(counts: DataFrame, doc: str, smooth: bool = True) -> DataFrame:
    """Smoothed inverse document frequency ``ln((1 + n) / (1 + df)) + 1`` from one row per
    (doc, term), or per document as :func:`term_lists` gives it: (term, df, idf)."""
    if "terms" in counts.columns:
        n = counts.where(F.size("terms") > 0).select(F.countDistinct(doc)).scalar()
        # the documents of a batch are added up before their terms become rows
        dfreq = counts.select("terms").mapInArrow(_batch_counts, "term string, n long").groupBy("term").agg(F.sum("n").alias("df"))
    else:
        n = counts.select(F.countDistinct(doc)).scalar()
        dfreq = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    if smooth:
        idf = F.ln((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1.0
    else:
        idf = F.ln(n / F.col("df")) + 1.0
    return dfreq.withColumn("idf", idf)


def _batch_counts(batches):
    import pyarrow as pa
    import pyarrow.compute as pc
    for batch in batches:
        found = pc.value_counts(batch.column(0).flatten())
        yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["term", "n"])


def tfidf(train: DataFrame, apply: DataFrame, doc: str) -> DataFrame:
    """Term count x IDF learned on ``train``, L2-normalised per document.

    Both are (doc, term, tf) with one row per pair, as :func:`term_counts` or :func:`bag_of_words`
    give them, or one row per document, as :func:`term_lists` gives them.  Terms never seen in training are
    ignored (J2: the IDF join is inner).  Returns (doc, term, weight).
    """
    from quarry.sources.files import materialize
    # as large as the vocabulary; read by both parts of the join
    idf = materialize(idf_table(train, doc), "idf")
    if "terms" in apply.columns:
        found = look_up_lists(apply.select(doc, "terms", "tfs"), "_idf", "terms", idf, "term", "idf", -F.col("df"))
        w = found.select(doc, "terms", F.zip_with("tfs", "_idf", lambda n, x: n * x).alias("_w"))
        norm = F.sqrt(F.aggregate("_w", F.lit(0.0), lambda s, x: s + F.coalesce(x * x, F.lit(0.0))))
        # a select of its own: beside explode the norm would be worked out for every term
        w = w.withColumn("_norm", norm)
        each = w.select(doc, "_norm", F.explode(F.arrays_zip("terms", "_w")).alias("_z"))
        return each.where("_z._w IS NOT NULL").select(doc, F.col("_z.terms").alias("term"), (F.col("_z._w") / F.col("_norm")).alias("weight"))
    seen = join_terms(apply.select(doc, "term", "tf"), idf, "term", -F.col("df"))
    raw = seen.select(doc, "term", (F.col("tf") * F.col("idf")).alias("_w"))
    # a document's terms are bounded by its length, so a per-document window is fine
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(doc)))
    return raw.select(doc, "term", (F.col("_w") / norm).alias("weight"))


def feature_summary(weights: DataFrame, doc: str, n_docs: Column | int | None = None,
                    probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Describe of every term column of a sparse (doc, term, weight) table.

    Absent entries are zeros: they are counted as ``n - nnz`` and enter the
    quantiles as one weighted zero value, never materialised.  Where all quantiles fall among the zeros, as for
    every term that few documents have, they are known from counts; only the other terms' values are ranked.
    Returns (term, stat, value).
    """
    from quarry.operators.agg import quantiles_from_counts, stat_names
    from quarry.sources.files import materialize
    # read by the moments, the value counts and the default of n
    weights = materialize(weights.select(doc, "term", "weight"), "term-weights")
    n = n_docs if n_docs is not None else weights.select(F.countDistinct(doc)).scalar()
    n = n if isinstance(n, Column) else F.lit(n)
    w = F.col("weight").cast("double")
    g = weights.groupBy("term").agg(F.count(F.lit(1)).alias("nnz"), F.sum(w).alias("s"), F.avg(w).alias("m"),
                                    F.var_pop(w).alias("v"), F.min(w).alias("mn"), F.max(w).alias("mx"),
                                    F.count_if(w < 0).alias("below"), F.count_if(w == 0).alias("at"), F.count(w).alias("known"))
    g = materialize(g.withColumn("n", n), "term-moments")
    n = F.col("n")
    zeros = n - F.col("nnz")
    mean = F.col("s") / n
    # squares about the entries' own mean, then what the zeros add
    var = (F.col("nnz") * F.col("v") + F.col("nnz") * F.col("m") * F.col("m") * zeros / n) / (n - 1)
    mom = g.select("term", F.explode(F.array(
        F.struct(F.lit("count").alias("stat"), n.cast("double").alias("value")),
        F.struct(F.lit("mean").alias("stat"), mean.alias("value")),
        F.struct(F.lit("std").alias("stat"), F.sqrt(F.greatest(var, F.lit(0.0))).alias("value")),
        F.struct(F.lit("min").alias("stat"), F.when(zeros > 0, F.least(F.col("mn"), F.lit(0.0)))
                 .otherwise(F.col("mn")).alias("value")),
        F.struct(F.lit("max").alias("stat"), F.when(zeros > 0, F.greatest(F.col("mx"), F.lit(0.0)))
                 .otherwise(F.col("mx")).alias("value")))).alias("_s")).select("term", "_s.*")
    absent = F.greatest(zeros, F.lit(0)).cast("long")
    among = F.col("known") == F.col("nnz")
    for p in probs:
        h = (F.col("nnz") + absent - 1) * F.lit(float(p))
        among = among & (F.floor(h) >= F.col("below")) & (F.ceil(h) < F.col("below") + F.col("at") + absent)
    ranked = materialize(g.where(~among).select("term", zeros.cast("long").alias("_zeros")), "ranked-terms")
    known = g.where(among).select("term", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"), F.lit(0.0).alias("value"))
    counts = with_groups(weights, ranked, ["term"]).groupBy("term", w.alias("value")).agg(F.count(F.lit(1)).alias("_cnt"))
    zero_rows = ranked.select("term", F.lit(0.0).alias("value"), F.col("_zeros").alias("_cnt")).where("_cnt > 0")
    merged = counts.unionByName(zero_rows).groupBy("term", "value").agg(F.sum("_cnt").alias("_cnt"))
    merged = materialize(merged, "term-value-counts")
    q = quantiles_from_counts(merged, ["term"], probs).unionByName(known)
    stat = stat_names(probs)[F.col("prob")]
    return mom.unionByName(q.select("term", stat.alias("stat"), "value"))


def vocabulary(tokens: DataFrame, token: str = "token", specials: Sequence[str] = ("<unk>",),
               min_freq: int = 1) -> DataFrame:
    """Token -> id by descending frequency (ties by token), specials first.

    Returns (token, id, n); ``<unk>`` (the first special) is id 0 and the
    default for unknown tokens.
    """
    from quarry.sources.files import materialize
    counts = (tokens.groupBy(F.col(token).alias("token")).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= min_freq)
              .where(~F.col("token").isin(list(specials)))
              .withColumn("_negn", -F.col("n")))
    # the ordering reads the counts four times; tokenize the corpus once
    counts = materialize(counts, "vocab-counts")
    ranked = row_index(counts, ["_negn", "token"], name="_i")
    words = ranked.select("token", (F.col("_i") + len(specials)).alias("id"), "n")
    spark = tokens.sparkSession
    head = spark.createDataFrame([(s, i, 0) for i, s in enumerate(specials)], "token string, id long, n long")
    return head.unionByName(words)


def numericalise(tokens: DataFrame, vocab: DataFrame, token: str = "token",
                 unk_id: int = 0, name: str = "token_id") -> DataFrame:
    """X11: tokens to ids; tokens missing from the vocabulary get ``unk_id``.  Ids go by frequency, so
    those of the most frequent tokens are the ones that :func:`join_terms` broadcasts.  Where ``token`` is an
    array of tokens, ``name`` is the array of their ids and takes its place."""
    if isinstance(tokens.schema[token].dataType, ArrayType):
        return look_up_lists(tokens, name, token, vocab, "token", "id", F.col("id"), F.lit(unk_id).cast("long"), drop=True)
    ids = vocab.select(F.col("token").alias(token), F.col("id").alias("_vid"))
    found = join_terms(tokens, ids, token, F.col("_vid"), "left")
    return found.withColumn(name, F.coalesce("_vid", F.lit(unk_id)).cast("long")).drop("_vid")


#: (key, gram) counts that a task holds before it hands them on; a row's own are never split
HELD_GRAMS = 200_000


def _gram_counter(key: list[str], n: int, name: str):
    def count(batches):
        import collections

        import pandas as pd

        def frame(per_key):
            cols = {k: [] for k in key}
            grams, counts = [], []
            for kv, c in per_key.items():
                grams.extend(c.keys())
                counts.extend(c.values())
                for j, k in enumerate(key):
                    cols[k].extend([kv[j]] * len(c))
            return pd.DataFrame({**cols, name: pd.Series(grams, dtype=object), "count": pd.Series(counts, dtype="int64")})
        for pdf in batches:
            # one Counter per distinct key: a partial aggregate before the shuffle
            # (per document, or per language, ...), handed on in bounded pieces
            per_key: dict = collections.defaultdict(collections.Counter)
            held = 0
            keyvals = zip(*[pdf[k].tolist() for k in key]) if key else iter([()] * len(pdf))
            for kv, s in zip(keyvals, pdf["_t"]):
                if not isinstance(s, str) or len(s) < n:
                    continue
                own = per_key[kv]
                held -= len(own)
                own.update([s[i:i + n] for i in range(len(s) - n + 1)])
                held += len(own)
                if held >= HELD_GRAMS:
                    yield frame(per_key)
                    per_key.clear()
                    held = 0
            if held:
                yield frame(per_key)
    return count


def char_ngrams(df: DataFrame, key: Sequence[str], text: str | Column, n: int = 3,
                name: str = "gram", unique_rows: bool = False) -> DataFrame:
    """Counts of every character n-gram of each whole string: (key..., gram, count).

    One match a code point, with the n-gram it starts seen by look-ahead; Spark counts the grams by
    (key, gram) before and after the shuffle.  With ``unique_rows`` (one row per key) a Counter in Python
    counts each whole string instead: no gram is shuffled, and over one key a row that was faster.
    """
    key = list(key)
    s = F.col(text) if isinstance(text, str) else text
    if not unique_rows:
        grams = F.regexp_extract_all(s, F.lit(f"(?s)(?=(.{{{n}}}))."), 1)
        return df.select(*key, F.explode(grams).alias(name)).groupBy(*key, name).agg(F.count(F.lit(1)).alias("count"))
    src = df.select(*key, s.alias("_t"))
    fields = [f for f in src.schema.fields if f.name in key]
    schema = StructType([*[StructField(f.name, f.dataType, f.nullable) for f in fields],
                         StructField(name, StringType(), False), StructField("count", LongType(), False)])
    # one input row per key: counts are final, no shuffle
    return src.mapInPandas(_gram_counter(key, n, name), schema)


def class_weights(df: DataFrame, label: str, name: str = "class_weight") -> DataFrame:
    """Balanced weights ``n / (k * n_c)`` as a per-class table (label, n_c, weight)."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    n = df.select(F.count(F.lit(1))).scalar()
    k = per.select(F.count(F.lit(1))).scalar()
    return per.withColumn(name, n / (k * F.col("n_c")))


def with_class_weights(df: DataFrame, label: str, name: str = "class_weight") -> DataFrame:
    """Attach :func:`class_weights` to every row (the table has one row per class)."""
    return df.join(F.broadcast(class_weights(df, label, name).drop("n_c")), label)


def min_max_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None,
                  suffix: str = "") -> DataFrame:
    """``(x - min) / (max - min)`` per column, bounds from ``fit_on`` (default df).

    All bounds come from one aggregate; a constant column scales to 0.
    """
    src = fit_on if fit_on is not None else df
    stats = src.agg(*[F.min(F.col(c).cast("double")).alias(f"{c}__min") for c in cols],
                    *[F.max(F.col(c).cast("double")).alias(f"{c}__max") for c in cols])
    row = stats.first()  # one aggregate job for every bound
    out = df
    for c in cols:
        lo, hi = F.lit(row[f"{c}__min"]), F.lit(row[f"{c}__max"])
        scaled = F.when(hi == lo, F.lit(0.0)).otherwise((F.col(c).cast("double") - lo) / (hi - lo))
        out = out.withColumn(c + suffix, scaled)
    return out


def standardise(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None,
                suffix: str = "") -> DataFrame:
    """``(x - mean) / population sd`` with statistics from ``fit_on`` only."""
    src = fit_on if fit_on is not None else df
    stats = src.agg(*[F.avg(F.col(c).cast("double")).alias(f"{c}__mu") for c in cols],
                    *[F.stddev_pop(F.col(c).cast("double")).alias(f"{c}__sd") for c in cols])
    row = stats.first()
    out = df
    for c in cols:
        mu, sd = F.lit(row[f"{c}__mu"]), F.lit(row[f"{c}__sd"])
        out = out.withColumn(c + suffix, F.try_divide(F.col(c).cast("double") - mu,
                                                       F.when(sd != 0, sd)))
    return out


def max_scale(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """Divide by the column's maximum absolute value."""
    stats = df.agg(*[F.max(F.abs(F.col(c).cast("double"))).alias(f"{c}__m") for c in cols])
    row = stats.first()
    out = df
    for c in cols:
        m = F.lit(row[f"{c}__m"])
        out = out.withColumn(c + suffix, F.try_divide(F.col(c).cast("double"), F.when(m != 0, m)))
    return out
