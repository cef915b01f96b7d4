"""Ranked lexical search by best-first intervals over range-maximum sparse tables.

Documents are dealt into shards as they are read.  A shard keeps, for every term
that some item asks for, its posting list in document order: the document's place,
the frequency and, once the corpus sums are known, the impact
``(10^9 tf) div (1000 tf + 8 m)``.  A sparse table over the postings holds the place
of the largest impact of every run of 2^j postings, so the maximum of any range takes
two lookups.

An item is answered from intervals of documents.  An interval's bound is the sum of
weight times range maximum over the item's terms.  The intervals of the largest bounds
go first, some at a time; each is split at the document where the term that adds most
has its maximum: that document is scored, and both sides get bounds of their own.
Intervals of few documents are scored whole.  An interval ends when its bound is below
the k-th score found, or equal to it with larger ids only.  Scores are 64-bit integers and bounds
are sums of the same products, so the result is exact.

The texts are read once, for frequencies and lengths.  The driver holds the terms and
weights of one group of items (at most ``MAX_TERMS`` terms; more items make
more groups, each with a pass over the texts).  A task holds one shard of at most
``SHARD_DOCS`` documents and ``SHARD_POSTINGS`` postings (one longer document
is a shard of its own).  A shard hands on at most k rows an item, and a task only
such as may still be among the item's best.

Defined results: null texts have no terms, items without known terms have no rows. Rows
that repeat an id are documents of their own; so are rows with a null id, which come
after all others of the same score.  Items that share an id are answered as one item
with the terms of all; a null item id is an id like any other.  Ids are whole numbers.
Terms are told apart by 64-bit hashes, compared with the items' terms only.
Very long texts are whole rows of their own slices.  Other columns are ignored.
Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialize
from quarry.llm.words import WORD, column, lookup, text_slices, words

SHARD_DOCS, SHARD_POSTINGS = 8192, 2_000_000
MAX_TERMS = 2_000_000
#: an interval of at most so many documents is scored whole
LEAF = 16
#: intervals split at once: first, and at most
WAVE, MAX_WAVE = 16, 1024
#: (interval, term) cells that are held at once
CELLS = 2_000_000

_SHARD = ("docs long, tokens long, terms array<int>, df array<long>, "
          "ids binary, has_id binary, lengths binary, term binary, doc binary, tf binary")
_HIT = "item int, doc_id long, score long"


# ------------------------------------------------------------------ corpus side

def _pack(parts: list) -> pa.RecordBatch:
    """One shard: documents in order of their ids, postings by (term, document)."""
    ids, has, lengths, term, doc, tf, base = [], [], [], [], [], [], 0
    for i, h, n, t, d, f in parts:
        ids.append(i), has.append(h), lengths.append(n), term.append(t), doc.append(d + base), tf.append(f)
        base += len(i)
    ids, has, lengths, term, doc, tf = map(np.concatenate, (ids, has, lengths, term, doc, tf))
    order = np.lexsort((ids, ~has))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    doc = place[doc]
    by = np.lexsort((doc, term))
    found, df = np.unique(term, return_counts=True)
    row = {"docs": len(ids), "tokens": int(lengths.sum()), "terms": found.astype(np.int32), "df": df.astype(np.int64),
           "ids": ids[order].tobytes(), "has_id": has[order].tobytes(), "lengths": lengths[order].tobytes(),
           "term": term[by].astype(np.int32).tobytes(), "doc": doc[by].astype(np.int32).tobytes(), "tf": tf[by].tobytes()}
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())] + [pa.binary()] * 6
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)], list(row))


def _read(known):
    """Map function: texts to shards; ``known`` are the sorted hashes of the terms asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = known.value
        parts, docs, postings = [], 0, 0
        for batch in batches:
            ids = column(batch, "doc_id")
            has = np.asarray(ids.is_valid())
            ids = np.asarray(ids.fill_null(0)).astype(np.int64)
            for first, last, data, offs in text_slices(column(batch, "text")):
                h, d, _, _ = words(data, offs, WORD)
                n = np.bincount(d, minlength=last - first)
                at = lookup(keys, h)
                hit = at >= 0
                # (document, term) pairs of the slice and how often each occurs
                pair, tf = np.unique(d[hit] * np.int64(max(1, len(keys))) + at[hit], return_counts=True)
                own = np.flatnonzero(n > 0)
                place = np.cumsum(n > 0) - 1
                parts.append((ids[first:last][own], has[first:last][own], n[own].astype(np.int64),
                              pair % max(1, len(keys)), place[pair // max(1, len(keys))], tf.astype(np.int64)))
                docs, postings = docs + len(own), postings + len(pair)
                if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                    yield _pack(parts)
                    parts, docs, postings = [], 0, 0
        if docs:
            yield _pack(parts)
    return run


def impacts(tf, m):
    """``(10^9 tf) div (1000 tf + 8 m)`` in 64 bits."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def norm(lengths, docs: int, tokens: int):
    """m of documents with ``lengths`` terms, in a corpus of ``docs`` documents and ``tokens`` terms."""
    if len(lengths) and 90 * int(lengths.max()) * docs >= 1 << 63:
        return np.array([10 + 90 * int(n) * docs // tokens for n in lengths], np.int64)
    return 10 + (90 * lengths * docs) // tokens


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


# ------------------------------------------------------------------- one shard

class Shard:
    """Posting lists of one shard with a range-maximum sparse table over all of them.

    ``term``, ``doc`` and ``impact`` are sorted by (term, document); documents are places
    0 .. docs - 1 in the order of their ids.
    """

    def __init__(self, docs: int, term, doc, impact):
        self.docs, self.impact = docs, impact
        self.key = term * np.int64(max(1, docs)) + doc
        self.doc = doc
        self.terms, self.start = np.unique(term, return_index=True)
        self.end = np.append(self.start[1:], len(term))
        longest = int((self.end - self.start).max()) if len(term) else 1
        # table[j, i]: place of the largest impact among i .. i + 2^j - 1, the first one of equals
        self.table = np.empty((longest.bit_length(), len(term)), np.int32)
        self.table[0] = np.arange(len(term))
        for j in range(1, len(self.table)):
            half, below = 1 << (j - 1), self.table[j - 1]
            self.table[j] = below
            other = below[half:]
            larger = impact[other] > impact[below[:len(other)]]
            self.table[j, :len(other)][larger] = other[larger]
        self.level = np.zeros(longest + 1, np.int64)
        for j in range(1, len(self.table)):
            self.level[1 << j:] = j

    def maxima(self, a, b):
        """Place of the largest impact in each range a .. b - 1 (any place where it is empty)."""
        j = self.level[np.maximum(b - a, 1)]
        last = len(self.impact) - 1
        left = self.table[j, np.minimum(a, last)]
        right = self.table[j, np.clip(b - (1 << j), 0, last)]
        return np.where(self.impact[right] > self.impact[left], right, left)

    def search(self, terms, weights, k: int, floor: int = 0):
        """(score, document place) of the best k documents with a score above 0, best first and
        ties by place.  ``floor``: documents with a smaller score are not looked for."""
        at = lookup(self.terms, terms)
        own = at >= 0
        at, w = at[own], weights[own]
        best = np.zeros((0, 2), np.int64)  # (-score, place)
        self.scored = 0
        if not len(at):
            return best
        keys = self.terms[at] * np.int64(max(1, self.docs))
        a, b = self.start[at][None, :], self.end[at][None, :]
        lo, hi = np.zeros(1, np.int64), np.full(1, self.docs, np.int64)
        top = self.maxima(a, b)
        value = w * self.impact[top]
        wave, most = WAVE, max(1, min(MAX_WAVE, CELLS // len(at)))
        while len(lo):
            bound = value.sum(axis=1)
            worst, last = (-best[-1, 0], best[-1, 1]) if len(best) == k else (0, self.docs)
            stay = (bound > 0) & (bound >= floor) & ((bound > worst) | (bound == worst) & (lo < last))
            if not stay.all():
                a, b, lo, hi, top, value, bound = (x[stay] for x in (a, b, lo, hi, top, value, bound))
            if not len(lo):
                break
            size = min(wave, most)
            if len(lo) > size:
                chosen = np.zeros(len(lo), bool)
                chosen[np.argpartition(-bound, size - 1)[:size]] = True
            else:
                chosen = np.ones(len(lo), bool)
            wave *= 2
            parts = [[x[~chosen] for x in (a, b, lo, hi, top, value)]]
            a, b, lo, hi, top, value = (x[chosen] for x in (a, b, lo, hi, top, value))
            small = hi - lo <= LEAF
            found = []
            if small.any():
                found.append(self._whole(a[small], b[small], w))
                a, b, lo, hi, top, value = (x[~small] for x in (a, b, lo, hi, top, value))
            if len(lo):
                split = self.doc[top[np.arange(len(lo)), value.argmax(axis=1)]].astype(np.int64)
                wanted = keys + split[:, None]
                place = np.searchsorted(self.key, wanted.ravel()).reshape(wanted.shape)
                near = np.minimum(place, len(self.key) - 1)
                hit = (place < b) & (self.key[near] == wanted)
                score = np.where(hit, w * self.impact[near], 0).sum(axis=1)
                self.scored += len(split)
                found.append(np.stack([-score, split], axis=1))
                parts += [self._side(a, place, lo, split, w), self._side(place + hit, b, split + 1, hi, w)]
            best = np.concatenate([best, *found])
            best = best[(best[:, 0] < 0) & (-best[:, 0] >= floor)]
            best = best[np.lexsort((best[:, 1], best[:, 0]))][:k]
            a, b, lo, hi, top, value = (np.concatenate(x) for x in zip(*parts))
        return best

    def _side(self, a, b, lo, hi, w):
        """What is left of intervals on one side of their split, with new maxima."""
        some = (hi > lo) & (b > a).any(axis=1)
        a, b = a[some], b[some]
        top = self.maxima(a, b)
        return a, b, lo[some], hi[some], top, np.where(b > a, w * self.impact[top], 0)

    def _whole(self, a, b, w):
        """Scores of every document that has a posting in the intervals."""
        n = (b - a).ravel()
        at = np.repeat(a.ravel() - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        gain = np.repeat(np.broadcast_to(w, a.shape).ravel(), n) * self.impact[at]
        docs, where = np.unique(self.doc[at], return_inverse=True)
        score = np.zeros(len(docs), np.int64)
        np.add.at(score, where, gain)
        self.scored += len(docs)
        return np.stack([-score, docs.astype(np.int64)], axis=1)


def _search(asked, docs: int, tokens: int, k: int):
    """Map function: shards to the best documents of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, all_weights = asked.value
        reached: dict[int, np.ndarray] = {}  # the k best scores of an item in this task so far
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, has = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["has_id"], bool)
                term, doc = np.frombuffer(row["term"], np.int32).astype(np.int64), np.frombuffer(row["doc"], np.int32)
                m = norm(np.frombuffer(row["lengths"], np.int64), docs, tokens)
                shard = Shard(len(ids), term, doc, impacts(np.frombuffer(row["tf"], np.int64), m[doc]))
                hits = []
                for item, terms in items:
                    have = reached.get(item, np.zeros(0, np.int64))
                    floor = int(have[-1]) if len(have) == k else 0
                    best = shard.search(terms, all_weights[terms], k, floor)
                    if len(best):
                        reached[item] = np.sort(np.concatenate([have, -best[:, 0]]))[::-1][:k]
                        hits.append((np.full(len(best), item), best[:, 1], -best[:, 0]))
                if hits:
                    item, at, score = map(np.concatenate, zip(*hits))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(item, pa.int32()), pa.array(ids[at], pa.int64(), mask=~has[at]), pa.array(score, pa.int64())],
                        ["item", "doc_id", "score"])
    return run


# ------------------------------------------------------------------- item side

def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offs in text_slices(column(batch, "text")):
            h, d, _, _ = words(data, offs, WORD)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "item_id").slice(first, last - first).cast(pa.int64()).take(pa.array(d)), pa.array(h.view(np.int64))],
                ["item_id", "term"])


def _parts(terms: DataFrame) -> int:
    """How many groups of items there are, so that each has about ``MAX_TERMS`` terms or fewer."""
    return -(-terms.count() // MAX_TERMS)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the best k documents of every item."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    terms = materialize(
        items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_item_terms, "item_id long, term long").distinct(), "item-terms")
    parts = _parts(terms)
    found = None
    for part in range(parts):
        mine = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        one = _search_group(spark, docs, mine, k)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def _search_group(spark, docs: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    rows = terms.groupBy("item_id").agg(F.collect_list("term").alias("terms")).orderBy("item_id").collect()
    own = [np.array(r["terms"], np.int64).view(np.uint64) for r in rows]
    known = np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64)
    shards = materialize(docs.mapInArrow(_read(spark.sparkContext.broadcast(known)), _SHARD), "search-shards")
    n, tokens = shards.agg(F.sum("docs"), F.sum("tokens")).first()
    df = dict(shards.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).groupBy("t.terms")
              .agg(F.sum("t.df")).collect()) if n else {}
    weights = np.array([weight(n, df[t]) if t in df else 0 for t in range(len(known))], np.int64)
    asked = [(i, np.sort(np.searchsorted(known, h))) for i, h in enumerate(own)]
    asked = spark.sparkContext.broadcast((asked, weights))
    ids = [r["item_id"] for r in rows]
    hits = shards.select("ids", "has_id", "lengths", "term", "doc", "tf").mapInArrow(
        _search(asked, n or 0, tokens or 0, k), _HIT)
    names = spark.createDataFrame(list(enumerate(ids)), "item int, item_id long")
    # the table of ids is as bounded as the terms above
    return hits.join(F.broadcast(names), "item").select("item_id", "doc_id", "score")


SQL = r"""
WITH w AS (
  SELECT k, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS k, doc_id, text FROM documents)
), d AS (
  SELECT k, any_value(doc_id) AS doc_id, count(*) AS n FROM w GROUP BY k
), s AS (
  SELECT count(*)::HUGEINT AS nn, sum(n)::HUGEINT AS l FROM d
), q AS (
  SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
), t AS (
  SELECT k, term, count(*) AS tf FROM w SEMI JOIN q USING (term) GROUP BY ALL
), i AS (
  SELECT term, floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE)))::BIGINT AS wt
  FROM t, s GROUP BY term, nn
), p AS (
  SELECT t.k, t.term, wt * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // l))) AS v
  FROM t JOIN i USING (term) JOIN d USING (k), s
), r AS (
  SELECT item_id, k, sum(v)::BIGINT AS score FROM q JOIN p USING (term) GROUP BY ALL HAVING sum(v) > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM r JOIN d USING (k))
WHERE rank <= 10
"""
