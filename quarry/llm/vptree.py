"""Nearest neighbours by vantage-point trees, one per shard of the vectors.

Vectors are scaled to length 1, where the angle-free distance
d = sqrt(2 - 2 cos) is a metric.  A shard's tree splits its vectors at the
median distance from a vantage point and keeps, for both halves, the smallest
and largest distance.  By the triangle inequality a half whose distances lie
further than t from the query's own distance to the vantage point holds
nothing nearer than t, the distance of the k-th best so far.  ``factor``
relaxes this: a half is skipped when it is further than t / factor, so factor
1 is exact search and larger factors skip more.  All queries of a block first
go down to the leaf nearest to each; then every other node is visited once, by
the queries that still need it.  A leaf compares unit vectors by a matrix
product, and only where that comes near the best so far a pair's cosine is
worked out.

Vectors are dealt out in shards and every query goes to each of them; a task
builds the trees of a few shards one after the other, and returns at most k
candidates a query.  The k best over all shards follow from a window with a
group limit.  The number of shards, and of turns in which very many queries
are asked, follows from the row counts, so a task's memory does not grow with
the table.  Neither vectors nor queries are broadcast.

Defined results: vectors that are null, of another length than the most common
one, of length zero, or hold null or non-finite components take no part, nor do
rows with a null id.  Ties go to the smaller id.  A repeated id is a candidate
as often as it occurs, but never for a query of the same id; a repeated query id
is asked once, with the vector that sorts first.  Fewer than k candidates give
fewer rows.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEAF = 64
#: a distance near zero is only known to about the root of the double precision
SLACK = 1e-7
#: cosines by matrix product are known to this
NEAR = 1e-9
#: shards beyond which a task takes more than one, and the most that it takes
MANY, TOGETHER = 32, 4
#: queries that a task holds at once
TURN = 1 << 16


class VPTree:
    """Tree over unit vectors; ``ids`` and ``vectors`` are stored in leaf order."""

    def __init__(self, ids, vectors, leaf: int = LEAF, seed: int = 5):
        rng = np.random.default_rng(seed)
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        order = np.argsort(ids, kind="stable")
        # per node: first row, last row + 1, vantage vector, (low, high) of both halves, children
        self.nodes: list[list] = []
        self.order = np.empty(len(ids), np.int64)
        stack = [(order, 0, None, 0)]
        while stack:
            own, start, parent, side = stack.pop()
            at = len(self.nodes)
            if parent is not None:
                self.nodes[parent][4 + side] = at
            if len(own) <= leaf:
                self.order[start:start + len(own)] = own
                self.nodes.append([start, start + len(own), None, None, -1, -1])
                continue
            point = unit[own[rng.integers(len(own))]]
            d = distance(1 - np.maximum(-1, np.minimum(1, unit[own] @ point)))
            rank = np.argsort(d, kind="stable")
            half = len(own) // 2
            near, far = rank[:half], rank[half:]
            self.nodes.append([start, start + len(own), point,
                               (d[near[0]], d[near[-1]], d[far[0]], d[far[-1]]), -1, -1])
            stack.append((own[far], start + half, at, 1))
            stack.append((own[near], start, at, 0))
        self.ids, self.vectors, self.unit = ids[self.order], vectors[self.order], unit[self.order]

    def search(self, query_ids, queries, k: int, factor: float = 1.0, best=None):
        """(cosine, id) arrays of shape (queries, k), best first; cosine -inf marks no candidate.
        ``best``: such arrays from other trees, to go on with."""
        n = len(query_ids)
        unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        score, found = best or none(n, k)
        self.visited = 0
        home = np.full(n, -1)
        stack = [(0, np.arange(n))]
        while stack:
            at, who = stack.pop()
            start, end, point, edges, near, far = self.nodes[at]
            if point is None:
                home[who] = at
                self._leaf(start, end, who, query_ids, queries, unit, score, found, k)
                continue
            to_near, to_far = self._gaps(point, edges, unit[who])
            first_near = to_near <= to_far
            for child, rows in ((near, first_near), (far, ~first_near)):
                if rows.any():
                    stack.append((child, who[rows]))
        stack = [(0, np.arange(n), np.zeros(n))]
        while stack:
            at, who, bound = stack.pop()
            limit = distance(1 - np.maximum(score[who, -1], -1.0))  # the best may have improved since the node was put aside
            who = who[((bound <= limit / factor + SLACK) | (score[who, -1] == -np.inf)) & (home[who] != at)]
            if not len(who):
                continue
            start, end, point, edges, near, far = self.nodes[at]
            if point is None:
                self._leaf(start, end, who, query_ids, queries, unit, score, found, k)
                continue
            to_near, to_far = self._gaps(point, edges, unit[who])
            stack += [(far, who, to_far), (near, who, to_near)]
        return score, found

    @staticmethod
    def _gaps(point, edges, unit):
        """How far both halves are at least."""
        d = distance(1 - np.maximum(-1, np.minimum(1, unit @ point)))
        return np.maximum(0, np.maximum(edges[0] - d, d - edges[1])), np.maximum(0, np.maximum(edges[2] - d, d - edges[3]))

    def _leaf(self, start, end, who, query_ids, queries, unit, score, found, k):
        self.visited += len(who) * (end - start)
        # a query without a candidate that may be among its best is done
        who = who[~(unit[who] @ self.unit[start:end].T < score[who, -1:] - NEAR).all(axis=1)]
        if not len(who):
            return
        c = cosine(queries[who], self.vectors[start:end])
        ids = np.broadcast_to(self.ids[start:end], c.shape)
        c = np.where(ids == query_ids[who][:, None], -np.inf, c)
        all_c = np.concatenate([score[who], c], axis=1)
        all_i = np.concatenate([found[who], np.where(np.isfinite(c), ids, np.iinfo(np.int64).max)], axis=1)
        best = np.lexsort((all_i, -all_c), axis=1)[:, :k]
        score[who] = np.take_along_axis(all_c, best, axis=1)
        found[who] = np.take_along_axis(all_i, best, axis=1)


def none(n: int, k: int) -> tuple:
    """No candidates yet, for n queries."""
    return np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)


def distance(one_minus_cosine):
    return np.sqrt(np.maximum(0, 2 * one_minus_cosine))


def cosine(a, b):
    """Cosine in double precision of every row of a with every row of b; a pair's value
    does not depend on the rows around it."""
    dot = np.einsum("ik,jk->ij", a, b, optimize=False)
    return dot / np.sqrt(np.einsum("ik,ik->i", a, a)[:, None] * np.einsum("ik,ik->i", b, b)[None, :])


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the vectors that take part, as arrays of doubles."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    v = v.where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    v = v.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
                & F.exists("v", lambda x: x != 0))
    sizes = v.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").limit(1).collect()
    return v.where(F.size("v") == sizes[0]["n"]) if sizes else v


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, factor: float = 1.0, id_col: str = "vec_id",
            vector_col: str = "embedding", shard_rows: int = 8192, block_rows: int = 16384) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query."""
    v, q = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col)
    q = q.groupBy("id").agg(F.min("v").alias("v"))
    n, m = v.count(), q.count()
    shards = max(1, -(-n // shard_rows))
    parts, turns = -(-shards // max(1, min(TOGETHER, shards // MANY))), max(1, -(-m // TURN))

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    held = (v.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
            .withColumn("part", F.col("shard") % parts).withColumn("turn", every(turns)))
    asked = q.withColumn("turn", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(turns)).cast("int")).withColumn("part", every(parts))

    def search(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        ids, (score, found) = asked["id"].to_numpy(np.int64), none(len(asked), k)
        qs = _matrix(asked["v"]) if len(asked) else None
        for _, own in held.groupby("shard") if len(asked) else ():
            tree = VPTree(own["id"].to_numpy(np.int64), _matrix(own["v"]))
            for first in range(0, len(ids), block_rows):
                b = slice(first, first + block_rows)
                tree.search(ids[b], qs[b], k, factor, (score[b], found[b]))
        hit = np.isfinite(score)
        return pd.DataFrame({"query_id": np.repeat(ids, k)[hit.ravel()], "vec_id": found[hit], "score": score[hit]})
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = (held.groupBy("turn", "part").cogroup(asked.groupBy("turn", "part"))
             .applyInPandas(search, "query_id long, vec_id long, score double"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
