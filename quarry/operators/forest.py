"""Random forests on sparse rows.

Spark's forest holds a row as one bin for every feature, which grows with documents x terms.  Here a
row is the list of its terms whose bin is not that of 0, so it grows with the text.  The method is that of
Spark's forest: Poisson counts as bootstrap, Gini gains weighted by class, at most ``BINS`` bins a
term, ceil(sqrt(terms)) terms tried at a node, votes by the leaves' class shares.  Random numbers are hashes
of the seed, the tree, the row number and the node, so a forest does not depend on the layout of its rows; it is not the
forest that Spark draws from the same seed.

All trees grow together, a level a job.  Tasks walk their rows down the trees and count, for the terms
that a node tries, (node, term, bin, class); counts are integers, added up in one shuffle, and the best split of a node
is picked from its own counts.  A row tries about sqrt of its share of the terms, so few counts are shuffled.
The driver holds the nodes (at most trees x 2^(depth + 1)), never rows, terms or counts of terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.numeric import hash_unit
from quarry.operators.ordering import row_index
from quarry.operators.textmodels import _classes
from quarry.sources.files import materialize

BINS = 32
#: a term's thresholds come from all its weights, or about this many, picked by a hash of the document, if it has more
VALUES = 10_000
#: (entry, tree) cells that a task holds at once
CELLS = 1 << 20
#: cells that are tried at once; these stay in a core's cache
BLOCK = 1 << 16
#: entries of a file of rows
FILE_ENTRIES = 1 << 21
#: gains below this are rounding
MIN_GAIN = 1e-12
#: P(count <= k) of the bootstrap
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])


# ------------------------------------------------------------------ bins

def _strided(values, share):
    """Thresholds between values, chosen as Spark's forest does: where the count comes nearest to the next multiple of
    a ``BINS``-th of all; ``share`` zeros come with each value."""
    if values is None:
        return None
    v, n = np.unique(np.append(values, 0.0), return_counts=True)
    n = n.astype(float)
    n[v == 0] += share * len(values) - 1
    v, n, step, out = v.tolist(), n.tolist(), float(n.sum()) / BINS, []
    count, target = n[0], step
    for k in range(1, len(v)):
        before, count = count, count + n[k]
        if abs(before - target) < abs(count - target):
            out.append((v[k - 1] + v[k]) / 2)
            target += step
    return out


def term_bins(weights: DataFrame, doc: str, n: int) -> DataFrame:
    """(term, id, edges), stored: thresholds of every term of the training ``weights`` of ``n`` documents, ids 0 .. in the
    order of the terms."""
    often = weights.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    per = (weights.join(often, "term").where(hash_unit(7, [doc]) * F.col("df") < VALUES)
           .groupBy("term").agg(F.sort_array(F.collect_list("weight")).alias("v"), F.first("df").alias("df")))
    per = per.withColumn("d", F.array_distinct(F.sort_array(F.concat("v", F.array(F.lit(0.0))))))
    many, last = F.size("d") > BINS, F.size("d") - 1
    between = F.zip_with(F.slice("d", F.lit(1), last), F.slice("d", F.lit(2), last), lambda a, b: (a + b) / 2)
    strided = F.udf(_strided, "array<double>")(
        F.when(many, F.col("v")), F.greatest(F.lit(0.0), (F.lit(float(n)) - F.col("df")) / F.col("df")))
    edges = per.select("term", F.coalesce(strided, between).alias("edges"))
    return materialize(row_index(materialize(edges, "forest-edges"), ["term"], name="id"), "forest-terms")


def binned_rows(docs: DataFrame, weights: DataFrame, terms: DataFrame, doc: str) -> DataFrame:
    """``docs``, stored, with ``i`` and ``b``: ids of a document's terms in order and their bins, counted from the bin of 0,
    whose entries are left out."""
    place = lambda x: F.size(F.filter("edges", lambda e: e < x))
    found = (weights.join(terms, "term")
             .select(doc, F.struct(F.col("id").cast("int").alias("i"), (place(F.col("weight")) - place(F.lit(0.0))).cast("int").alias("b")).alias("t"))
             .where("t.b <> 0").groupBy(doc).agg(F.array_sort(F.collect_list("t")).alias("t")))
    empty = F.array().cast("array<int>")
    rows = materialize(docs.join(found, doc, "left").select(
        *docs.columns, F.coalesce("t.i", empty).alias("i"), F.coalesce("t.b", empty).alias("b")), "forest-joined")
    entries = rows.select(F.sum(F.size("i"))).first()[0] or 0
    files = max(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-entries // FILE_ENTRIES))
    return materialize(rows.repartition(files, F.xxhash64(doc)), "forest-rows")


# ----------------------------------------------------------------- trees

def _mix(x):
    """splitmix64 of an array of uint64."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _prime(n: int) -> int:
    """The smallest prime from ``n`` on."""
    n = max(2, n)
    while any(n % k == 0 for k in range(2, math.isqrt(n) + 1)):
        n += 1
    return n


class Forest:
    """Nodes of all trees; node t < ``trees`` is the root of tree t.  A row goes left if its bin of ``feature`` is at most
    ``cut``; the right child follows the left one; ``feature`` -1 marks a leaf.  ``counts`` are the bootstrap counts of
    each class."""

    def __init__(self, size: int, classes: list, weights, trees: int, seed: int, tried: int | None = None):
        self.size, self.classes, self.weights, self.trees = size, classes, np.asarray(weights, float), trees
        self.prime, self.tried = _prime(size), tried or math.ceil(math.sqrt(size))
        self.key = _mix(np.arange(trees, dtype=np.uint64) + _mix(np.array([seed], np.uint64)))
        self.feature, self.cut, self.left = np.full(trees, -1), np.zeros(trees, int), np.full(trees, -1)
        self.counts, self.open = np.zeros((trees, len(classes)), int), np.ones(trees, bool)

    def shares(self):
        """Weighted class shares of every node; 0 for a tree without rows."""
        own = self.counts * self.weights
        return own / np.maximum(own.sum(axis=1, keepdims=True), 1e-300)

    def steps(self) -> tuple:
        """Factor and shift of every node: it tries the terms f with (factor * f + shift) mod ``prime`` below ``tried``."""
        p = np.uint64(self.prime)
        return _mix(self.key) % (p - np.uint64(1)) + np.uint64(1), _mix(self.key ^ np.uint64(1)) % p

    def split(self, node, feature, cut, right, last: bool) -> None:
        """Split ``node``s; ``right`` are the counts of their right children, which stay leaves if ``last``."""
        children = len(self.feature) + 2 * np.arange(len(node))
        self.feature[node], self.cut[node], self.left[node] = feature, cut, children
        new = np.stack([self.counts[node] - right, right], axis=1).reshape(-1, len(self.classes))
        side = np.array([2, 3], np.uint64)
        self.key = np.append(self.key, _mix(np.repeat(self.key[node], 2) ^ np.tile(side, len(node))))
        self.counts = np.concatenate([self.counts, new])
        self.feature, self.left = (np.append(c, np.full(len(new), -1)) for c in (self.feature, self.left))
        self.cut = np.append(self.cut, np.zeros(len(new), int))
        self.open = np.append(np.zeros(len(self.open), bool), ((new > 0).sum(axis=1) > 1) & (not last))


def _chunks(batch: pa.RecordBatch, trees: int) -> Iterator[tuple]:
    """(first row, last row + 1, row starts, ids, bins) of runs of rows that fill about ``CELLS`` with all trees."""
    i, b = (batch.column(batch.schema.get_field_index(c)) for c in ("i", "b"))
    sizes = np.diff(np.asarray(i.offsets).astype(np.int64))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    ids, bins = i.flatten().to_numpy().astype(np.int64), b.flatten().to_numpy().astype(np.int64)
    cost = np.concatenate([[0], np.cumsum(sizes + 1)])
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(cost, cost[first] + max(1, CELLS // trees), "right")) - 1
        last = min(max(first + 1, last), batch.num_rows)
        yield first, last, starts[first:last + 1] - starts[first], ids[starts[first]:starts[last]], bins[starts[first]:starts[last]]
        first = last


def _walk(forest: Forest, starts, ids, bins):
    """The node (rows, trees) where each row ends."""
    rows, trees = len(starts) - 1, forest.trees
    keys = np.repeat(np.arange(rows), np.diff(starts)) * forest.size + ids
    keys, bins = np.append(keys, np.iinfo(np.int64).max), np.append(bins, 0)
    at = np.tile(np.arange(trees), rows)
    live = np.flatnonzero(forest.feature[at] >= 0)
    while len(live):
        node = at[live]
        key = live // trees * forest.size + forest.feature[node]
        place = np.searchsorted(keys, key)
        at[live] = forest.left[node] + (np.where(keys[place] == key, bins[place], 0) > forest.cut[node])
        live = live[forest.feature[at[live]] >= 0]
    return at.reshape(rows, trees)


def _bootstrap(seed: int, row, trees: int):
    """Counts (rows, trees), Poisson of mean 1."""
    key = _mix(row.astype(np.uint64) + _mix(np.array([seed ^ 0x5EED], np.uint64)))
    u = _mix(key[:, None] + _mix(np.arange(trees, dtype=np.uint64))[None, :]) >> np.uint64(11)
    return np.searchsorted(POISSON, u.ravel() * 2.0 ** -53, "right").reshape(u.shape)


def _labels(batch: pa.RecordBatch, label: str, classes: list):
    return np.searchsorted(classes, batch.column(batch.schema.get_field_index(label)).to_numpy(zero_copy_only=False))


def _root_counts(label: str, row: str, classes: list, trees: int, seed: int):
    """Map function: (tree, class, bootstrap count)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((trees, len(classes)), np.int64)
        for batch in batches:
            own, r = _labels(batch, label, classes), batch.column(batch.schema.get_field_index(row)).to_numpy()
            for k in range(0, len(r), max(1, CELLS // trees)):
                n = _bootstrap(seed, r[k:k + max(1, CELLS // trees)], trees)
                for c in range(len(classes)):
                    total[:, c] += n[own[k:k + len(n)] == c].sum(axis=0)
        tree, c = np.divmod(np.arange(total.size), len(classes))
        yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int32()), pa.array(c, pa.int32()), pa.array(total.ravel())], ["node", "k", "n"])
    return run


def _level_counts(sent, label: str, row: str, seed: int):
    """Map function: (node, term, bin, class, count) of the open nodes and the terms that they try."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, factor, shift = sent.value
        size, prime, c = forest.size, np.uint64(forest.prime), len(forest.classes)
        codes, counts, held = [], [], 0

        def packed():
            code, place = np.unique(np.concatenate(codes), return_inverse=True)
            return code, np.bincount(place, np.concatenate(counts), len(code)).astype(np.int64)

        def out(code, n):
            code, k = np.divmod(code, c)
            code, b = np.divmod(code, 256)
            node, f = np.divmod(code, size)
            return pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in ((node, pa.int32()), (f, pa.int32()), (b - 128, pa.int32()), (k, pa.int32()), (n, pa.int64()))],
                ["node", "f", "b", "k", "n"])
        for batch in batches:
            own, r = _labels(batch, label, forest.classes), batch.column(batch.schema.get_field_index(row)).to_numpy()
            for first, last, starts, ids, bins in _chunks(batch, forest.trees):
                at, n = _walk(forest, starts, ids, bins), _bootstrap(seed, r[first:last], forest.trees)
                pair = np.flatnonzero((n > 0) & forest.open[at])
                lens = np.diff(starts)[pair // forest.trees]
                ends = np.cumsum(lens)
                terms = ids.astype(np.uint64)
                once = np.append(True, ids[1:] != ids[:-1])[:len(ids)]  # of a term that comes twice the first counts
                once[starts[:-1][np.diff(starts) > 0]] = True
                a = 0
                while a < len(pair):
                    z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BLOCK, "right")))
                    p, m = pair[a:z], lens[a:z]
                    a = z
                    node, upto = at.ravel()[p], np.cumsum(m)
                    entry = np.repeat(starts[p // forest.trees] - (upto - m), m)
                    entry += np.arange(len(entry))
                    place = np.repeat(factor[node], m)
                    place *= terms[entry]
                    place += np.repeat(shift[node], m)
                    rounds = place // prime
                    rounds *= prime
                    place -= rounds
                    if len(place) and place.max() >= size:
                        mul, add = np.repeat(factor[node], m), np.repeat(shift[node], m)
                        while len(over := np.flatnonzero(place >= size)):  # the walk goes on until it is at a term
                            place[over] = (mul[over] * place[over] + add[over]) % prime
                    hit = np.flatnonzero(place < forest.tried)
                    entry = entry[hit]
                    hit, entry = hit[once[entry]], entry[once[entry]]
                    q = p[np.searchsorted(upto, hit, "right")]
                    codes.append(((at.ravel()[q] * size + ids[entry]) * 256 + bins[entry] + 128) * c + own[first + q // forest.trees])
                    counts.append(n.ravel()[q])
                    held += len(hit)
                    if held > CELLS:
                        code, total = packed()
                        codes, counts, held = [code], [total], len(code)
                        if held > CELLS // 2:
                            yield out(code, total)
                            codes, counts, held = [], [], 0
        if held:
            yield out(*packed())
    return run


def _best_splits(parts: DataFrame, forest: Forest):
    """Arrow table (node, score, f, cut, r0 ..): the split of each open node with the largest
    ``sum over sides (sum of squared class weights / weight)``; equals go to the smaller term and cut."""
    spark, k = parts.sparkSession, range(len(forest.classes))
    node = np.flatnonzero(forest.open)
    whole = spark.createDataFrame(pa.table([pa.array(node, pa.int32()), *(pa.array(forest.counts[node, c]) for c in k)],
                                           names=["node", *(f"t{c}" for c in k)]))
    sums = parts.repartition("node", "f").groupBy("node", "f", "b").agg(
        *[F.sum(F.when(F.col("k") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in k])
    outward = Window.partitionBy("node", "f", F.signum("b")).orderBy(F.abs("b").desc())
    sofar = outward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    up = F.col("b") > 0
    cuts = sums.select("node", "f", F.when(up, F.coalesce(F.lead("b").over(outward), F.lit(0))).otherwise(F.col("b")).alias("cut"),
                       up.alias("up"), *[F.sum(f"n{c}").over(sofar).alias(f"o{c}") for c in k]).join(F.broadcast(whole), "node")

    def purity(counts):
        own = [n * F.lit(float(w)) for n, w in zip(counts, forest.weights)]
        return sum(x * x for x in own) / sum(own)
    outer, rest = [F.col(f"o{c}") for c in k], [F.col(f"t{c}") - F.col(f"o{c}") for c in k]
    scored = cuts.where(sum(rest) > 0).select(
        "node", "f", "cut", (purity(outer) + purity(rest)).alias("score"),
        *[F.when(F.col("up"), o).otherwise(r).alias(f"r{c}") for c, o, r in zip(k, outer, rest)])
    best = scored.groupBy("node").agg(F.max_by(F.struct("score", "f", "cut", *[f"r{c}" for c in k]), F.struct("score", -F.col("f"), -F.col("cut"))).alias("s"))
    return best.select("node", "s.*").orderBy("node").toArrow()


def fit(rows: DataFrame, size: int, label: str, row: str, trees: int = 100, depth: int = 10, seed: int = 42,
        tried: int | None = None) -> Forest:
    """M15 with balanced class weights on :func:`binned_rows` numbered by ``row``, of terms 0 .. ``size`` - 1; a node
    tries ``tried`` terms, ceil(sqrt(size)) if not given."""
    classes, n = _classes(rows, label)
    forest = Forest(max(1, size), classes, [sum(n) / (len(n) * m) for m in n], trees, seed, tried)
    need = rows.select(F.col(row).cast("long").alias(row), label, "i", "b")
    roots = need.select(row, label).mapInArrow(_root_counts(label, row, classes, trees, seed), "node int, k int, n long")
    for r in roots.groupBy("node", "k").agg(F.sum("n").alias("n")).collect():
        forest.counts[r["node"], r["k"]] = r["n"]
    forest.open = (forest.counts > 0).sum(axis=1) > 1
    for level in range(1, depth + 1):
        if not forest.open.any():
            break
        sent = rows.sparkSession.sparkContext.broadcast((forest, *forest.steps()))
        parts = need.mapInArrow(_level_counts(sent, label, row, seed), "node int, f int, b int, k int, n long")
        found = _best_splits(parts, forest)
        sent.unpersist()
        node, score, f, cut, *right = (found.column(c).to_numpy() for c in range(found.num_columns))
        own = forest.counts[node] * forest.weights
        gain = score / own.sum(axis=1) - (own ** 2).sum(axis=1) / own.sum(axis=1) ** 2
        good = gain > MIN_GAIN
        forest.split(node[good], f[good], cut[good], np.stack(right, axis=1)[good], level == depth)
    return forest


def predict(rows: DataFrame, forest: Forest, keep: Sequence[str]) -> DataFrame:
    """(*keep, prediction): the class with the largest sum of leaf shares over the trees, the smaller one of equals."""
    sent = rows.sparkSession.sparkContext.broadcast((forest, forest.shares()))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, shares = sent.value
        for batch in batches:
            votes = [shares[_walk(forest, starts, ids, bins)].sum(axis=1) for _, _, starts, ids, bins in _chunks(batch, forest.trees)]
            best = np.argmax(np.concatenate(votes), axis=1) if votes else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep),
                                              pa.array(np.asarray(forest.classes, float)[best])], [*keep, "prediction"])
    return rows.select(*keep, "i", "b").mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "prediction double"]))
