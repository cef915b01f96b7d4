"""Hidden Markov language model: distributed Baum-Welch and exact likelihoods.

Tokens are lower-cased words and one end token a document.  A word's symbol is
the word itself if it is among the ``top_words`` most frequent training words,
else one of ``CLASSES`` classes by its first and last bytes.  The chain's
states emit symbols; a word follows from its symbol with add-half relative
frequency within the class (one slot for all unknown words), so
P(text) = P(symbols under the chain) * product of P(word | symbol).

1. A map pass turns the texts into batches: distinct words (64-bit hashes) and
   the sequence of positions in them, written once.
2. Each batch asks for its distinct words' counts, one row per range of hashes.
   A range's task adds up the training counts of all batches and answers each
   batch.  A word occurs once per batch there, so no word is a hot key, and the
   number of ranges follows from the number of distinct words.
3. Answers meet their batch; the batch becomes symbols and per-document sums.
4. Baum-Welch: every partition adds its expected counts over all its training
   documents, cut into segments of ``SEGMENT`` tokens; the counts are summed by
   a grouped aggregate and re-estimated, ``rounds`` times.
5. Scoring runs the scaled forward recursion over whole documents; the sum of
   the logarithms of the scales is the exact log likelihood.

The model has a fixed size (states x symbols) and is all that is sent to tasks.

Defined results: a null or empty text has the end token only.  Rows with a null
id, repeated rows and extra columns change nothing: each row is a document.
Without training rows every count is zero and the base score is that of the
formula with N = V = 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialize
from quarry.llm.words import LOWER, bounds, column, hash_text, rows_of, text_slices, words

CLASSES = 1024
SEGMENT = 128
STATES = 8
END = np.uint64(hash_text(b" end of document "))  # holds white space: no word has this hash's bytes
_SLICE = 4 << 20


def _pack(a) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpack(b: bytes, kind):
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _word_class(data, start, end):
    """Class of each word from its first byte and its last two."""
    first, last = data[start].astype(np.int64), data[end - 1].astype(np.int64)
    before = np.where(end - start > 1, data[np.maximum(end - 2, 0)], 0).astype(np.int64)
    return ((first * 131 + last * 31 + before * 17 + (end - start > 6)) * 2654435761 % (1 << 32) % CLASSES).astype(np.uint16)


_BATCH = "batch long, ids array<{}>, held array<boolean>, n array<int>, n_words long, words binary, cls binary, train binary, seq binary"


def _batches(id_type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, held_all = column(batch, "doc_id"), column(batch, "held").to_numpy(zero_copy_only=False)
            for a, b, data, offs in text_slices(column(batch, "text"), _SLICE):
                h, doc, start, end = words(data, offs)
                n = np.diff(bounds(doc, b - a)) + 1
                # the end token follows the words of its document
                full = np.empty(len(h) + b - a, np.uint64)
                stop = np.cumsum(n) - 1
                is_end = np.zeros(len(full), bool)
                is_end[stop] = True
                full[stop] = END
                full[~is_end] = h
                distinct, at, inverse = np.unique(full, return_index=True, return_inverse=True)
                cls = np.zeros(len(full), np.uint16)
                cls[~is_end] = _word_class(LOWER[data], start, end)
                held = held_all[a:b]
                train = np.bincount(inverse[~np.repeat(held, n)], minlength=len(distinct)).astype(np.uint32)
                yield pa.RecordBatch.from_pydict({
                    "batch": pa.array([number], pa.int64()),
                    "ids": pa.array([ids.slice(a, b - a).to_pylist()], pa.list_(id_type)),
                    "held": pa.array([held.tolist()], pa.list_(pa.bool_())),
                    "n": pa.array([n.tolist()], pa.list_(pa.int32())),
                    "n_words": pa.array([len(distinct)], pa.int64()),
                    "words": pa.array([distinct.tobytes()], pa.binary()),
                    "cls": pa.array([cls[at].tobytes()], pa.binary()),
                    "train": pa.array([_pack(train)], pa.binary()),
                    "seq": pa.array([_pack(inverse.astype(np.uint32))], pa.binary())})
                number += 1
    return run


def _requests(ranges: int):
    """One row per batch and range of hashes: the words, their classes and training counts."""
    edges = [np.uint64(i * 2 ** 64 // ranges) for i in range(1, ranges)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for batch, w, c, t in zip(*(column(rows, x).to_pylist() for x in ("batch", "words", "cls", "train"))):
                w, c, t = np.frombuffer(w, np.uint64), np.frombuffer(c, np.uint16), _unpack(t, np.uint32)
                cut = [0, *np.searchsorted(w, np.array(edges, np.uint64)).tolist(), len(w)]
                use = [i for i in range(ranges) if cut[i] < cut[i + 1]]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(use, pa.int32()), "batch": pa.array([batch] * len(use), pa.int64()),
                    **{k: pa.array([x[cut[i]:cut[i + 1]].tobytes() for i in use], pa.binary())
                       for k, x in (("w", w), ("c", c), ("t", t))}})
    return run


def _answer(top_words: int):
    """For one range: counts for every asking batch; on the first row the range's totals."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        w = [np.frombuffer(x, np.uint64) for x in part["w"]]
        distinct, at, inverse = np.unique(np.concatenate(w), return_index=True, return_inverse=True)
        cls = np.concatenate([np.frombuffer(x, np.uint16) for x in part["c"]])[at]
        t = np.concatenate([np.frombuffer(x, np.uint32) for x in part["t"]])
        count = np.bincount(inverse, t, len(distinct)).astype(np.uint64)
        cut = np.cumsum([0, *map(len, w)])
        out = pd.DataFrame({"batch": part["batch"].to_numpy(), "part": part["part"].to_numpy(),
                            "counts": [_pack(count[inverse[a:b]]) for a, b in zip(cut, cut[1:])]})
        top = np.lexsort((distinct, -count.astype(np.int64)))[:top_words]
        top = top[count[top] > 0]
        word = distinct != END
        none = [None] * (len(out) - 1)
        totals = {"tokens": int(count.sum()), "known": int((count > 0).sum()),
                  "top": [{"w": int(a), "c": int(b), "k": int(c)} for a, b, c in
                          zip(distinct[top].view(np.int64), count[top], cls[top])],
                  "class_tokens": np.bincount(cls[word], count[word].astype(float), CLASSES).astype(np.int64).tolist(),
                  "class_known": np.bincount(cls[word & (count > 0)], minlength=CLASSES).tolist()}
        for k, v in totals.items():
            out[k] = pd.Series([v, *none], dtype=object)
        return out
    return run


_ANSWER = ("batch long, part int, counts binary, tokens long, known long, top array<struct<w:long,c:long,k:int>>, "
           "class_tokens array<long>, class_known array<long>")


class Symbols:
    """Word to symbol and the probability of a word given its symbol."""

    def __init__(self, top, class_tokens, class_known):
        self.words = np.array([t[0] for t in top], np.int64).view(np.uint64)
        order = np.argsort(self.words)
        self.words = self.words[order]
        self.top_counts = np.array([t[1] for t in top], float)[order]
        self.class_tokens, self.class_known = class_tokens.astype(float), class_known.astype(float)
        for w, c, k in top:
            if np.array(w, np.int64).view(np.uint64) != END:
                self.class_tokens[k] -= c
                self.class_known[k] -= 1
        # END always has a symbol of its own, the one after the top words and the classes
        self.size = len(self.words) + CLASSES + 1
        self.frequency = np.concatenate([self.top_counts, self.class_tokens, [0.0]]) + 0.01
        self.frequency /= self.frequency.sum()

    def encode(self, w, cls, count):
        """(symbol, log10 P(word | symbol)) of distinct words."""
        at = np.searchsorted(self.words, w)
        at[at == len(self.words)] = 0
        own = (self.words[at] == w) if len(self.words) else np.zeros(len(w), bool)
        own_or_end = own | (w == END)
        sym = np.where(own, at, np.where(w == END, self.size - 1, len(self.words) + cls.astype(np.int64)))
        total = self.class_tokens[cls] + 0.5 * (self.class_known[cls] + 1)
        return sym.astype(np.uint16), np.where(own_or_end, 0.0, np.log10((count + 0.5) / total))


def _code(symbols: Symbols, id_type):
    """Batches with their answers become symbol sequences and per-document sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for r in rows_of(rows):
                w, cls = np.frombuffer(r["words"], np.uint64), np.frombuffer(r["cls"], np.uint16)
                count = np.concatenate([_unpack(x["counts"], np.uint64) for x in sorted(
                    r["answers"], key=lambda x: x["part"])]).astype(float)
                sym, inside = symbols.encode(w, cls, count)
                seq, n = _unpack(r["seq"], np.uint32), np.array(r["n"])
                at = np.cumsum(n) - n
                yield pa.RecordBatch.from_pydict({
                    "ids": pa.array([r["ids"]], pa.list_(id_type)), "held": pa.array([r["held"]], pa.list_(pa.bool_())),
                    "n": pa.array([r["n"]], pa.list_(pa.int32())),
                    "known": pa.array([np.add.reduceat((count > 0)[seq].astype(np.int64), at).tolist()], pa.list_(pa.int64())),
                    "base": pa.array([np.add.reduceat(np.log10(count + 0.5)[seq], at).tolist()], pa.list_(pa.float64())),
                    "inside": pa.array([np.add.reduceat(inside[seq], at).tolist()], pa.list_(pa.float64())),
                    "sym": pa.array([_pack(sym[seq])], pa.binary())})
    return run


class Chain:
    """start (K), middle (K: state where a later segment begins), move (K x K), emit (symbols x K)."""

    def __init__(self, states: int, frequency, seed: int):
        rng = np.random.default_rng(seed)
        self.start = np.full(states, 1 / states)
        self.middle = np.full(states, 1 / states)
        self.move = rng.dirichlet(np.full(states, 2.0), states) * 0.5 + np.eye(states) * 0.5
        noise = rng.gamma(2.0, 0.5, (len(frequency), states)) * frequency[:, None]
        self.emit = noise / noise.sum(axis=0)

    def segments(self, sym, n):
        """Expected counts of one batch of training documents, as one flat vector."""
        k, m = len(self.start), len(self.emit)
        pieces = -(-n // SEGMENT)
        doc = np.repeat(np.arange(len(n)), pieces)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = (np.cumsum(n) - n)[doc] + number * SEGMENT
        length = np.minimum(n[doc] - number * SEGMENT, SEGMENT)
        order = np.argsort(-length, kind="stable")
        begin, length, opening = begin[order], length[order], number[order] == 0
        steps = int(length[0])
        active = np.searchsorted(-length, -np.arange(steps), "left")  # segments longer than t
        alpha, seen = [], []
        move, emit = self.move.astype(np.float32), self.emit.astype(np.float32)
        scale = []
        for t in range(steps):
            e = emit[sym[begin[:active[t]] + t]]
            seen.append(e)
            a = (np.where(opening[:, None], self.start, self.middle).astype(np.float32) if t == 0
                 else alpha[-1][:active[t]] @ move) * e
            s = np.maximum(a.sum(axis=1, keepdims=True), 1e-30)
            alpha.append(a / s)
            scale.append(s)
        pairs = np.zeros((k, k))
        gamma = [None] * steps
        beta = np.ones((active[-1], k), np.float32)
        for t in range(steps - 1, -1, -1):
            if len(beta) < active[t]:
                beta = np.concatenate([beta, np.ones((active[t] - len(beta), k), np.float32)])
            g = alpha[t] * beta
            g /= np.maximum(g.sum(axis=1, keepdims=True), 1e-30)
            gamma[t] = g
            if t:
                back = seen[t] * beta / scale[t]
                pairs += alpha[t - 1][:active[t]].T.astype(np.float64) @ back * self.move
                beta = back @ move.T
        g0 = gamma[0].astype(np.float64)
        flat = np.concatenate([sym[begin[:active[t]] + t] for t in range(steps)])
        weights = np.concatenate(gamma)
        emitted = np.stack([np.bincount(flat, weights[:, j], m) for j in range(k)], axis=1)
        return np.concatenate([g0[opening].sum(axis=0), g0[~opening].sum(axis=0), pairs.ravel(), emitted.ravel()])

    def update(self, counts, frequency):
        k = len(self.start)
        start, middle, move, emit = np.split(counts, [k, 2 * k, 2 * k + k * k])
        self.start = (start + 0.1) / (start + 0.1).sum()
        self.middle = (middle + 0.1) / (middle + 0.1).sum()
        move = move.reshape(k, k) + 0.1
        self.move = move / move.sum(axis=1, keepdims=True)
        emit = emit.reshape(-1, k) + frequency[:, None] + 1e-6
        self.emit = emit / emit.sum(axis=0)

    def log10_likelihood(self, sym, n):
        """Exact log10 P of each sequence by the scaled forward recursion."""
        order = np.argsort(-n, kind="stable")
        begin, length = (np.cumsum(n) - n)[order], n[order]
        total = np.zeros(len(n))
        if not len(n):
            return total
        active = np.searchsorted(-length, -np.arange(int(length[0])), "left")
        a = np.tile(self.start, (len(n), 1))
        for t, m in enumerate(active):
            a = a[:m] @ self.move if t else a
            a = a * self.emit[sym[begin[:m] + t]]
            s = a.sum(axis=1)
            a /= s[:, None]
            total[:m] += np.log10(s)
        out = np.empty(len(n))
        out[order] = total
        return out


def _expected(chain: Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for rows in batches:
            for r in rows_of(rows):
                n, held = np.array(r["n"]), np.array(r["held"], bool)
                if held.all():
                    continue
                sym = _unpack(r["sym"], np.uint16)[np.repeat(~held, n)]
                c = chain.segments(sym, n[~held])
                counts = c if counts is None else counts + c
        if counts is not None:
            i = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "v": pa.array(counts[i], pa.float64())})
    return run


def _score(chain: Chain, n_all: float, v_all: float, id_type, flush: int = 6_000_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_back, size = [], 0

        def out():
            n = np.concatenate([np.array(r["n"]) for r in held_back])
            sym = np.concatenate([_unpack(r["sym"], np.uint16) for r in held_back])
            flat = {k: np.concatenate([np.array(r[k]) for r in held_back]) for k in ("held", "known", "base", "inside")}
            ids = [x for r in held_back for x in r["ids"]]
            return pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, id_type), "held_out": pa.array(flat["held"], pa.bool_()),
                "n_tokens": pa.array(n, pa.int64()), "n_known": pa.array(flat["known"], pa.int64()),
                "base_score": pa.array(flat["base"] - n * np.log10(n_all + 0.5 * (v_all + 1)), pa.float64()),
                "score": pa.array(chain.log10_likelihood(sym, n) + flat["inside"], pa.float64())})
        for rows in batches:
            for r in rows_of(rows):
                held_back.append(r)
                size += sum(r["n"])
                if size >= flush:  # long documents share their steps with all others held back
                    yield out()
                    held_back, size = [], 0
        if held_back:
            yield out()
    return run


def score_corpus(docs: DataFrame, held_out, states: int = STATES, top_words: int = 512, rounds: int = 4,
                 range_words: int = 400_000, seed: int = 11) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of
    ``docs``; ``held_out`` is a boolean column: rows where it is true are not learnt from."""
    from pyspark.sql.pandas.types import to_arrow_type
    spark = docs.sparkSession
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    kind = docs.schema["doc_id"].dataType.simpleString()
    d = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held"))
    tokens = materialize(d.mapInArrow(_batches(id_type), _BATCH.format(kind)), "hmm-tokens")
    total = tokens.agg(F.sum("n_words")).first()[0] or 0
    ranges = max(1, -(-total // range_words))
    answers = materialize(
        tokens.select("batch", "words", "cls", "train")
        .mapInArrow(_requests(ranges), "part int, batch long, w binary, c binary, t binary")
        .groupBy("part").applyInPandas(_answer(top_words), _ANSWER), "hmm-counts")
    sums = answers.agg(F.sum("tokens").alias("n"), F.sum("known").alias("v")).first()
    n_all, v_all = sums["n"] or 0, sums["v"] or 0
    top = [(r.w, r.c, r.k) for r in answers.select(F.explode("top").alias("t")).select("t.*")
           .orderBy(F.desc("c"), "w").limit(top_words).collect()]
    per_class = {c: np.zeros(CLASSES) for c in ("class_tokens", "class_known")}
    for c, out in per_class.items():
        for r in answers.select(F.posexplode(c)).groupBy("pos").agg(F.sum("col").alias("x")).collect():
            out[r.pos] = r.x
    symbols = Symbols(top, **per_class)

    grouped = answers.groupBy("batch").agg(F.collect_list(F.struct("part", "counts")).alias("answers"))
    coded = materialize(
        tokens.select("batch", "ids", "held", "n", "words", "cls", "seq").join(grouped, "batch")
        .mapInArrow(_code(symbols, id_type), f"ids array<{kind}>, held array<boolean>, n array<int>, known array<long>, "
                    "base array<double>, inside array<double>, sym binary"), "hmm-symbols")
    chain = Chain(states, symbols.frequency, seed)
    for _ in range(rounds if n_all else 0):
        counts = np.zeros(2 * states + states * states + symbols.size * states)
        for r in (coded.select("held", "n", "sym").mapInArrow(_expected(chain), "i int, v double")
                  .groupBy("i").agg(F.sum("v").alias("v")).collect()):
            counts[r.i] = r.v
        chain.update(counts, symbols.frequency)
    out = coded.mapInArrow(_score(chain, float(n_all), float(v_all), id_type),
                           f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(n_all).cast("long")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
