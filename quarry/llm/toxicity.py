"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

The classifier is fitted on a bounded sample of labelled rows (``per_class``
documents of each label, in hash order).  Its terms are all words, and the
first 4 and 6 bytes of longer words; nothing is filtered.  Document
frequencies are counted over all documents and kept as a distributed table.
Seven tenths of the sample become the index: postings per term, cut into
blocks of examples with the largest weight of each block.  A query visits
blocks by falling bound and stops when the bound is below its k-th best, so
the k nearest examples are exact.  Terms that a sixteenth of the examples or more
hold are a matrix instead of postings: their share of the cosines is one product for many
queries, and exact in the bounds.  The rest of the sample calibrates: the
similarity-weighted vote of the k neighbours goes through a logistic fitted on
it, weighted to the labels' shares among all labelled rows.

A term's weight is its IDF, times the standard deviations by which its document
frequency differs between the labels of the index, where these are above one.
Norms take every term of a text.  Terms outside the sample are in no example,
so they cannot change which examples are nearest, only the norm: tasks send
them, split by ranges of term hashes, to the frequency table, and the sums of
squares are added up per document afterwards.

Defined results: a null text is the empty text.  A document that shares no
term with an example has no neighbours and gets the calibrated score of vote
zero.  Ties between examples go to the smaller doc_id.  Without labelled rows,
or with one label only, all scores are the share of that label (0 without
rows).  Rows with a null id are scored but never learnt from; a labelled id
that occurs several times counts as often as it occurs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quarry.llm.common import saved
from quarry.llm.words import LOWER, WORD, bounds, column, lookup, prefix_hash, span_hash, spans, text_slices

PREFIXES = (4, 6)
BLOCK = 64
#: a term of at least one in so many examples is kept as a row of the matrix
COMMON = 16
#: documents whose shares are held at once
DOCS = 512
RANGES = 256
RANGE_PAIRS = 2_000_000
HELD_TERMS = 1_000_000


def _terms(data, offs):
    """(hash, document) of every word and of the prefixes of longer words."""
    start, end, doc = spans(data, offs, WORD)
    if not len(start):
        return np.zeros(0, np.uint64), doc
    pre = prefix_hash(LOWER[data])
    out, owner = [span_hash(pre, start, end)], [doc]
    for n in PREFIXES:
        long = end - start > n
        out.append(span_hash(pre, start[long], start[long] + n) ^ np.uint64(0xA5A5 * n))
        owner.append(doc[long])
    return np.concatenate(out), np.concatenate(owner)


def _counts(doc, term, width: int):
    """(document, term, count) of the pairs, sorted; terms are below ``width``."""
    key, count = np.unique(doc * np.int64(width) + term, return_counts=True)
    doc, term = np.divmod(key, width)
    return doc, term, count


def _vectors(data, offs, vocabulary):
    """Term counts (document, term, count), sorted, within the vocabulary and, as
    (document, hash, count), outside it."""
    h, doc = _terms(data, offs)
    at = lookup(vocabulary, h)
    used = at >= 0
    rare, where = np.unique(h[~used], return_inverse=True)
    d, t, n = _counts(doc[~used], where, len(rare) + 1)
    return _counts(doc[used], at[used], len(vocabulary) + 1), (d, rare[t], n)


def _weights(term, count, idf):
    """Unit vector of log-scaled counts times IDF."""
    w = (1 + np.log(count)) * idf[term]
    norm = math.sqrt(float((w * w).sum()))
    return w / norm if norm else w


def _idf(df, n_docs: int):
    return np.log((1 + n_docs) / (1 + df)) + 1


class Index:
    """Postings of the examples; ``examples`` are (doc_id, label, terms, weights).

    ``idf`` holds the weight of every term of the sample; ``frequencies`` is the
    table (h, n) of all terms of the ``n_docs`` documents and stays on the driver.
    """

    def __init__(self, vocabulary, idf, examples):
        examples = sorted(examples, key=lambda e: e[0])
        self.vocabulary, self.idf = vocabulary, idf
        self.ids = np.array([e[0] for e in examples], np.int64)
        self.label = np.array([e[1] for e in examples], np.int64)
        self.blocks = -(-len(examples) // BLOCK)
        j = np.repeat(np.arange(len(examples)), [len(e[2]) for e in examples])
        term = np.concatenate([e[2] for e in examples]).astype(np.int64)
        w = np.concatenate([e[3] for e in examples])
        often = np.bincount(term, minlength=len(vocabulary)) * COMMON >= max(1, len(examples))
        self.row = np.where(often, np.cumsum(often) - 1, -1)
        self.matrix = np.zeros((int(often.sum()), self.blocks * BLOCK))
        self.matrix[self.row[term[often[term]]], j[often[term]]] = w[often[term]]
        # equal examples take the share of their first, so that they stay equal to the last bit
        seen: dict = {}
        first = [seen.setdefault((e[2].tobytes(), e[3].tobytes()), k) for k, e in enumerate(examples)]
        self.first = np.append(first, np.arange(len(examples), self.blocks * BLOCK)).astype(np.int64)
        j, w, term = j[~often[term]], w[~often[term]], term[~often[term]]
        cell = term * self.blocks + j // BLOCK
        order = np.argsort(cell, kind="stable")
        self.example, self.weight = j[order].astype(np.int32), w[order]
        size = np.bincount(cell, minlength=len(vocabulary) * self.blocks)
        self.start = np.append(0, np.cumsum(size)).astype(np.int32)
        block_max = np.zeros(len(vocabulary) * self.blocks)
        np.maximum.at(block_max, cell, w)
        self.block_max = block_max.reshape(len(vocabulary), self.blocks)
        self.calibration = (0.0, 0.0)
        self.frequencies, self.n_docs = None, 0

    def __getstate__(self):
        return self.__dict__ | {"frequencies": None}

    def shares(self, doc, terms, weights, n: int):
        """(n, examples): what the matrix's terms add to the cosines of ``n`` documents."""
        at = self.row[terms]
        x = np.zeros((n, len(self.matrix)))
        x[doc[at >= 0], at[at >= 0]] = weights[at >= 0]
        return (x @ self.matrix)[:, self.first]

    def nearest(self, terms, weights, k: int, share=None):
        """The k examples of largest cosine above zero: (position, cosine), nearest first.
        With weights of any norm the cosines are multiplied by that norm.  ``share`` is the document's row of
        :meth:`shares`, worked out here if it is not given."""
        if share is None:
            share = self.shares(np.zeros(len(terms), np.int64), terms, weights, 1)[0]
        rare = self.row[terms] < 0
        terms, weights = terms[rare], weights[rare]
        peak = self.block_max[terms]
        bound = share.reshape(self.blocks, BLOCK).max(axis=1) + weights @ peak
        order = np.argsort(-bound, kind="stable")
        best: list[tuple[float, int]] = []
        at, step = 0, 2
        while at < len(order):  # blocks by falling bound, twice as many each time
            group = order[at:at + step]
            group = group[bound[group] > 0]
            if len(best) == k:
                group = group[bound[group] >= -best[-1][0] * (1 - 1e-12) - 1e-12]
            if not len(group):
                break
            t, g = np.nonzero(peak[:, group])  # most cells are empty
            cell = terms[t] * self.blocks + group[g]
            lo = self.start[cell].astype(np.int64)
            size = self.start[cell + 1] - lo
            post = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
            rest = np.bincount(self.example[post], np.repeat(weights[t], size) * self.weight[post], len(share))
            own = (group[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            score = share[own] + rest[own]
            hit = np.flatnonzero(score > 0)
            if len(hit) > k:
                hit = hit[score[hit] >= -np.partition(-score[hit], k - 1)[k - 1]]
            best = sorted(best + [(-float(score[i]), int(own[i])) for i in hit])[:k]
            at, step = at + step, 2 * step
        return [(j, -s) for s, j in best]

    def vote(self, near, k: int) -> float:
        """Similarity-weighted share of toxic neighbours; a missing neighbour weighs zero."""
        return sum(s * (1 if self.label[j] == 1 else -1) for j, s in near) / k

    def score(self, vote: float) -> float:
        a, b = self.calibration
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a * vote + b))))


def _fit_logistic(x, y, share: float, ridge: float = 1e-3, rounds: int = 50):
    """Slope and offset by Newton's method, classes weighted to ``share`` of ones."""
    n1, n0 = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    wt = np.where(y == 1, share / n1, (1 - share) / n0)
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (wt * (y - p)) - ridge * np.array([beta[0] * 1e-3, 0])
        hess = (design * (wt * p * (1 - p))[:, None]).T @ design + np.diag([ridge * 1e-3, 1e-9])
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def _slices(texts):
    yield from text_slices(pa.array(texts, pa.large_string()))


def _frequencies(docs: DataFrame) -> DataFrame:
    """(h, n): in how many documents each term occurs; the row without h counts the documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, size = [], 0, 0

        def flush():
            h, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            n = np.bincount(at, np.concatenate([x for _, x in held]), len(h)).astype(np.int64)
            return h, n
        for batch in batches:
            for a, b, data, offs in text_slices(column(batch, "text")):
                docs += b - a
                h, doc = _terms(data, offs)
                if not len(h):
                    continue
                h, at = np.unique(h, return_inverse=True)
                pairs = np.unique(at * np.int64(b - a) + doc)
                held.append((h, np.bincount(pairs // (b - a), minlength=len(h))))
                size += len(h)
                if size > HELD_TERMS:
                    held = [flush()]
                    size = len(held[0][0])
                    if size > HELD_TERMS // 2:
                        yield pa.RecordBatch.from_pydict({"h": pa.array(held[0][0].view(np.int64)), "n": held[0][1]})
                        held, size = [], 0
        if held:
            h, n = flush()
            yield pa.RecordBatch.from_pydict({"h": pa.array(h.view(np.int64)), "n": n})
        yield pa.RecordBatch.from_pydict({"h": pa.array([None], pa.int64()), "n": pa.array([docs], pa.int64())})
    return saved(docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1000, k: int = 5) -> tuple[Index | None, float]:
    """Fit on ``labels`` (doc_id, toxic) joined with ``docs`` (doc_id, text).

    ``labels`` must hold only rows that may be learnt from; all of ``docs``
    counts for document frequencies.  Returns (index, share of label 1);
    the index is None without rows of both labels.
    """
    spark = docs.sparkSession
    lab = labels.select("doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    totals = {r.toxic: r.n for r in lab.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    if len(totals) < 2:
        return None, share
    picked = lab.withColumn("h", F.xxhash64("doc_id")).withColumn(
        "r", F.row_number().over(Window.partitionBy("toxic").orderBy("h", "doc_id"))).where(F.col("r") <= per_class)
    rows = (docs.select("doc_id", "text")
            .join(F.broadcast(picked.select(F.col("doc_id").alias("i"), "toxic", "h")), F.col("doc_id") == F.col("i"))
            .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic", "h").collect())
    rows.sort(key=lambda r: (r.h, r.doc_id, r.toxic, r.text))
    if len({r.toxic for r in rows}) < 2:
        return None, share
    toxic = np.array([r.toxic for r in rows])
    indexed = np.arange(len(rows)) % 10 < 7
    slices = [(a, b, *_terms(data, offs)) for a, b, data, offs in _slices([r.text for r in rows])]
    vocabulary = np.unique(np.concatenate([h for _, _, h, _ in slices]))
    parts = [_counts(doc, lookup(vocabulary, h), len(vocabulary) + 1) for _, _, h, doc in slices]
    owner = np.concatenate([doc + a for (a, *_), (doc, _, _) in zip(slices, parts)])
    term = np.concatenate([t for _, t, _ in parts])
    n = np.concatenate([c for _, _, c in parts])

    frequencies = _frequencies(docs)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = column(batch, "h")
            at = lookup(sent.value, h.fill_null(0).to_numpy().view(np.uint64))
            yield batch.filter(pa.array((at >= 0) | h.is_null().to_numpy(zero_copy_only=False)))
    sent = spark.sparkContext.broadcast(vocabulary)
    df, n_docs = np.zeros(len(vocabulary)), 0
    for r in frequencies.mapInArrow(known, "h long, n long").collect():
        if r.h is None:
            n_docs = r.n
        else:
            df[np.searchsorted(vocabulary, np.uint64(r.h % 2 ** 64))] = r.n
    # standard deviations between the labels of the index
    mine = indexed[owner]
    ones = np.bincount(term[mine], toxic[owner[mine]], len(vocabulary))
    zeros = np.bincount(term[mine], minlength=len(vocabulary)) - ones
    size = [max(1, int((indexed & (toxic == x)).sum())) for x in (0, 1)]
    pool = (ones + zeros) / sum(size)
    z = np.abs(ones / size[1] - zeros / size[0]) / np.sqrt(
        np.maximum(pool * (1 - pool), 1e-12) * (1 / size[0] + 1 / size[1]))
    weight = _idf(df, n_docs) * np.maximum(1, np.where(pool < 1, z, 0))

    examples, rest = [], []
    where = bounds(owner, len(rows))
    for d, r in enumerate(rows):
        cut = slice(where[d], where[d + 1])
        e = (r.doc_id, r.toxic, term[cut], _weights(term[cut], n[cut], weight))
        (examples if indexed[d] else rest).append(e)
    index = Index(vocabulary, weight, examples)
    index.frequencies, index.n_docs = frequencies, n_docs
    rest = rest or examples
    x = np.array([index.vote(index.nearest(t, w, k), k) if len(t) else 0.0 for _, _, t, w in rest])
    y = np.array([e[1] for e in rest], float)
    index.calibration = _fit_logistic(x, y, min(max(share, 1e-3), 1 - 1e-3))
    return index, share


def score(docs: DataFrame, index: Index | None, share: float, k: int = 5, cut: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted, evidence): ``evidence`` lists the neighbours as
    structs of doc_id, cosine and label."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    evidence = "array<struct<doc_id:long,cosine:double,toxic:int>>"
    if index is None:
        return docs.select("doc_id", F.lit(float(share)).alias("score"),
                           F.lit(int(share >= cut)).alias("predicted"), F.expr(f"cast(array() AS {evidence})").alias("evidence"))
    total = index.frequencies.where("h IS NOT NULL").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    ranges = RANGES + int(total) // RANGE_PAIRS
    n_docs = index.n_docs
    sent = docs.sparkSession.sparkContext.broadcast(index)
    found_type = pa.struct([("doc_id", to_arrow_type(docs.schema["doc_id"].dataType)), ("near", pa.list_(pa.struct(
        [("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())])))])
    found = f"found struct<doc_id:{kind},near:{evidence}>"
    fields = pa.schema([("r", pa.int32()), ("row", pa.int64()), ("norm", pa.float64()), ("found", found_type),
                        ("h", pa.binary()), ("doc", pa.binary()), ("count", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = sent.value
        first = TaskContext.get().partitionId() << 40  # rows of the task are numbered from here
        for batch in batches:
            for a, b, data, offs in text_slices(column(batch, "text")):
                (doc, term, n), (d2, h, n2) = _vectors(data, offs, ix.vocabulary)
                w = (1 + np.log(n)) * ix.idf[term]
                norm = np.bincount(doc, w * w, b - a)
                where = bounds(doc, b - a)
                near: list[list] = [[] for _ in range(b - a)]
                for c0 in range(0, b - a, DOCS):
                    c1 = min(c0 + DOCS, b - a)
                    some = slice(where[c0], where[c1])
                    share = ix.shares(doc[some] - c0, term[some], w[some], c1 - c0)
                    for d in np.unique(doc[some]):
                        s = slice(where[d], where[d + 1])
                        near[d] = [{"doc_id": int(ix.ids[j]), "cosine": c, "toxic": int(ix.label[j])}
                                   for j, c in ix.nearest(term[s], w[s], k, share[d - c0])]
                row = first + np.arange(b - a)
                none = pa.nulls(b - a, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row % ranges, pa.int32()), pa.array(row), pa.array(norm),
                     pa.StructArray.from_arrays([column(batch, "doc_id").slice(a, b - a),
                                                 pa.array(near, found_type.field("near").type)],
                                                fields=list(found_type)), none, none, none], schema=fields)
                # terms outside the sample: one row per range of hashes
                r = h.view(np.int64) % ranges
                order = np.argsort(r, kind="stable")
                cuts = bounds(r[order], ranges)
                has = np.flatnonzero(np.diff(cuts))
                part = [order[cuts[i]:cuts[i + 1]] for i in has]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(has, pa.int32()), pa.array(np.full(len(has), first)), pa.nulls(len(has), pa.float64()),
                     pa.nulls(len(has), found_type), pa.array([h[p].tobytes() for p in part], pa.binary()),
                     pa.array([d2[p].astype(np.uint32).tobytes() for p in part], pa.binary()),
                     pa.array([n2[p].astype(np.uint32).tobytes() for p in part], pa.binary())], schema=fields)
                first += b - a

    def resolve(sent: pa.Table, counted: pa.Table) -> pa.Table:
        """Result rows as they are, and the sums of squares of the range's terms per row."""
        h = counted.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        h, df = h[order], counted.column("n").to_numpy()[order]
        whole = sent.filter(sent.column("norm").is_valid()).select(["row", "norm", "found"])
        rows, sums = [np.zeros(0, np.int64)], [np.zeros(0)]
        parts = sent.filter(sent.column("h").is_valid()).select(["row", "h", "doc", "count"])
        for first, terms, doc, n in zip(*(c.to_pylist() for c in parts.columns)):
            at = lookup(h, np.frombuffer(terms, np.uint64))
            known = np.where(at >= 0, df[at], 0) if len(df) else np.zeros(len(at))
            w = (1 + np.log(np.frombuffer(n, np.uint32))) * _idf(known, n_docs)
            doc, at = np.unique(np.frombuffer(doc, np.uint32), return_inverse=True)
            rows.append(first + doc.astype(np.int64))
            sums.append(np.bincount(at, w * w))
        row, norm = np.concatenate(rows), np.concatenate(sums)
        return pa.concat_tables([whole, pa.table([pa.array(row), pa.array(norm), pa.nulls(len(row), found_type)],
                                                 schema=whole.schema)])

    split = docs.select("doc_id", "text").mapInArrow(
        run, f"r int, row long, norm double, {found}, h binary, doc binary, count binary")
    counted = index.frequencies.where("h IS NOT NULL").withColumn("r", F.pmod("h", F.lit(ranges)).cast("int"))
    near = F.transform("found.near", lambda e: F.struct(
        e["doc_id"].alias("doc_id"), (e["cosine"] / F.sqrt("norm")).alias("cosine"), e["toxic"].alias("toxic")))
    vote = F.aggregate("evidence", F.lit(0.0), lambda s, e: s + F.when(e["toxic"] == 1, e["cosine"]).otherwise(
        -e["cosine"])) / k
    slope, offset = index.calibration
    return (split.groupBy("r").cogroup(counted.groupBy("r"))
            .applyInArrow(resolve, f"row long, norm double, {found}")
            .groupBy("row").agg(F.sum("norm").alias("norm"), F.first("found", ignorenulls=True).alias("found"))
            .select(F.col("found.doc_id").alias("doc_id"), near.alias("evidence"))
            .withColumn("x", F.greatest(F.lit(-30.0), F.least(F.lit(30.0), slope * vote + offset)))
            .withColumn("score", 1 / (1 + F.exp(-F.col("x"))))
            .select("doc_id", "score", (F.col("score") >= cut).cast("int").alias("predicted"), "evidence"))
