"""Benchmark decontamination: every training passage queries an index of test items.

The index holds each test item's words with BM25 weights, divided by the
item's score against itself, so that one threshold (a share of the full score)
serves items of every length.  Items are kept in blocks, and each term knows
its largest weight in every block.  A passage is a run of words twice as long
as the longest item, advancing by half of it, so that any copy of an item lies
wholly in some passage.  Pruning is that of block-max WAND: the sum of a
passage's largest weights bounds its score for any item, the sums per block
bound it within a block, and only blocks whose bound reaches the threshold are
scored.  Every (passage, item) pair at or above the threshold is kept; there
is no top-k.  A document that holds only the question or only the answer can
score less, so the n-grams of these parts have postings of their own, which
give every (document, part) pair with enough n-grams.

Each pair is then verified on the whole document: which share of the item's
word n-grams occurs in it, for the question, for the answer (the last sentence
of an item that has several) and for both together.  An item counts as leaked
when at least ``min_overlap`` of the n-grams of both together occur, or of a
question of at least ``ngram`` words, or of an answer of at least ``ANSWER``
words; shorter parts are no evidence on their own.  ``score`` is that of the
best passage, below the threshold where only a part was found.

The index is cut into parts of at most ``part_words`` words; each part is sent
to the tasks once and passed over all documents, so no broadcast outgrows that
bound.  All work on documents is in map tasks; only verified pairs are kept.

Defined results: null or wordless texts and items match nothing.  Repeated
items each report; items with a null id take no part.  Rows with a null or
repeated doc_id are each judged on their own text.  Extra columns are ignored
(``leaks``) or kept (``drop_leaked``).
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from quarry.llm.common import filter_rows
from quarry.llm.words import LOWER, WORD, bounds, column, lookup, sequence_hash, text_slices, words

K1, B = 1.2, 0.75
ANSWER = 8
_SENTENCE_END = re.compile(r"[.?!](?:\s+|$)|\n")


def split_item(text: str) -> tuple[str, str]:
    """(question, answer): the answer is the last sentence when there are several."""
    ends = [m.end() for m in _SENTENCE_END.finditer(text.rstrip())]
    cuts = [e for e in ends if text[e:].strip()]
    return (text[:cuts[-1]], text[cuts[-1]:]) if cuts else (text, "")


def _hashes(text: str):
    raw = np.frombuffer(text.encode(), np.uint8)
    return words(raw, np.array([0, len(raw)]), WORD, LOWER)[0]


class Index:
    """Inverted index of one part of the test items, in blocks of ``block`` items."""

    def __init__(self, items: list[tuple[object, str]], n_all: int, mean_len: float,
                 df: dict[int, int], ngram: int, block: int = 16):
        self.ids = [i for i, _ in items]
        self.ngram = ngram
        seqs = [_hashes(t) for _, t in items]
        self.longest = max((len(s) for s in seqs), default=0)
        self.terms = np.unique(np.concatenate(seqs)) if seqs else np.zeros(0, np.uint64)
        n_blocks = -(-len(items) // block)
        # one row per term, one column per item; the part size bounds it
        weight = np.zeros((len(self.terms) + 1, n_blocks * block), np.float32)
        for j, s in enumerate(seqs):
            t, tf = np.unique(s, return_counts=True)
            idf = np.array([math.log(1 + (n_all - df[int(x)] + 0.5) / (df[int(x)] + 0.5)) for x in t])
            w = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(s) / mean_len))
            if w.sum() > 0:
                weight[np.searchsorted(self.terms, t), j] = w / w.sum()
        self.block = block
        self.weight = weight
        self.block_max = weight.reshape(len(weight), n_blocks, block).max(axis=2)
        self.top = self.block_max.max(axis=1) if n_blocks else np.zeros(len(weight), np.float32)
        self.grams, self.alone = [], []
        for _, t in items:
            parts, size = [], []
            for part in split_item(t):
                h = _hashes(part)
                n = min(ngram, len(h))
                parts.append((n, np.unique(sequence_hash(h, n)) if n else np.zeros(0, np.uint64)))
                size.append(len(h))
            self.grams.append(parts)
            self.alone.append((size[1] > 0 and size[0] >= ngram, size[0] > 0 and size[1] >= max(ngram, ANSWER)))
        # postings of the n-grams of parts that count alone
        own = [(j, g) for j, (parts, alone) in enumerate(zip(self.grams, self.alone))
               for (_, g), a in zip(parts, alone) if a]
        self.part_item = np.array([j for j, _ in own], np.int64)
        self.part_size = np.array([len(g) for _, g in own], np.int64)
        keys = np.concatenate([g for _, g in own]) if own else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.part_post = np.repeat(np.arange(len(own)), self.part_size)[order]
        self.part_grams, first = np.unique(keys[order], return_index=True)
        self.part_start = np.append(first, len(keys))

    def candidates(self, h, doc, n_docs: int, threshold: float):
        """(document, item column, best score) of passages at or above the threshold."""
        half = max(32, self.longest)
        where = bounds(doc, n_docs)
        local = np.arange(len(h)) - where[doc]
        term = lookup(self.terms, h)
        used = np.flatnonzero(term >= 0)
        if not len(used):
            return []
        # passage p of a document covers words [p * half, (p + 2) * half)
        count = np.maximum(1, -(-np.diff(where) // half) - 1)
        base = np.cumsum(count) - count
        step = local[used] // half
        d = doc[used]
        last = count[d] - 1
        own = np.minimum(step, last)
        passage = [base[d] + own]
        terms = [term[used]]
        two = (step >= 1) & (step - 1 < own)
        passage.append(base[d[two]] + step[two] - 1)
        terms.append(term[used][two])
        key = np.unique(np.concatenate(passage) * np.int64(len(self.terms) + 1) + np.concatenate(terms))
        passage, terms = np.divmod(key, len(self.terms) + 1)
        starts = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
        bound = np.add.reduceat(self.top[terms], starts)
        alive = bound >= threshold - 1e-4
        if not alive.any():
            return []
        size = np.diff(np.append(starts, len(terms)))
        pick = np.repeat(alive, size)
        passage, terms = passage[pick], terms[pick]
        starts = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
        owner = np.searchsorted(base, passage[starts], "right") - 1
        best: dict[tuple[int, int], float] = {}
        size = np.diff(np.append(starts, len(terms)))
        step = max(1, (1 << 21) // max(1, self.block_max.shape[1]))
        first = 0
        while first < len(starts):  # in pieces of a bounded number of term rows
            stop = max(first + 1, int(np.searchsorted(starts, starts[first] + step)))
            stop = min(stop, len(starts))
            lo = starts[first]
            hi = starts[stop] if stop < len(starts) else len(terms)
            blocks = np.add.reduceat(self.block_max[terms[lo:hi]], starts[first:stop] - lo, axis=0)
            for b in np.flatnonzero((blocks >= threshold - 1e-4).any(axis=0)):
                rows = np.flatnonzero(blocks[:, b] >= threshold - 1e-4) + first
                take = np.concatenate([np.arange(starts[r], starts[r] + size[r]) for r in rows])
                cut = np.cumsum(size[rows]) - size[rows]
                cols = slice(b * self.block, (b + 1) * self.block)
                score = np.add.reduceat(self.weight[terms[take], cols], cut, axis=0)
                for r, c in zip(*np.nonzero(score >= threshold - 1e-6)):
                    k = (int(owner[rows[r]]), int(b * self.block + c))
                    best[k] = max(best.get(k, 0.0), float(score[r, c]))
            first = stop
        return [(d, j, s) for (d, j), s in sorted(best.items()) if j < len(self.ids)]

    def parts_found(self, h, doc, min_overlap: float):
        """(document, item) where enough n-grams of a part that counts alone occur."""
        gram = sequence_hash(h, self.ngram)
        if not len(gram) or not len(self.part_item):
            return []
        at = lookup(self.part_grams, gram)
        used = np.flatnonzero((at >= 0) & (doc[:len(gram)] == doc[self.ngram - 1:]))
        d, at = np.divmod(np.unique(doc[used] * np.int64(len(self.part_grams)) + at[used]), len(self.part_grams))
        size = self.part_start[at + 1] - self.part_start[at]
        post = np.repeat(self.part_start[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        key, hit = np.unique(np.repeat(d, size) * np.int64(len(self.part_item)) + self.part_post[post],
                             return_counts=True)
        d, part = np.divmod(key, len(self.part_item))
        good = hit / self.part_size[part] >= min_overlap
        return list(zip(d[good].tolist(), self.part_item[part[good]].tolist()))

    def best_passage(self, h, item: int) -> float:
        """Largest score of the item in a passage of word hashes ``h``."""
        half, term = max(32, self.longest), lookup(self.terms, h)
        count = max(1, -(-len(h) // half) - 1)
        seen = (np.unique(term[p * half:(p + 2) * half if p < count - 1 else None]) for p in range(count))
        return max(float(self.weight[t[t >= 0], item].sum()) for t in seen)

    def overlap(self, item: int, grams_of):
        """Share of the item's n-grams found in a text: (question, answer, both);
        ``grams_of(n)`` gives the text's sorted n-grams."""
        found = total = 0
        shares = []
        for n, grams in self.grams[item]:
            hit = int((lookup(grams_of(n), grams) >= 0).sum()) if n else 0
            shares.append(hit / len(grams) if len(grams) else None)
            found += hit
            total += len(grams)
        return shares[0], shares[1], found / total if total else 0.0

    def leaked(self, item: int, shares, min_overlap: float) -> bool:
        return shares[2] >= min_overlap or any(
            a and x >= min_overlap for a, x in zip(self.alone[item], shares))


def build_index(items: DataFrame, id_col: str = "item_id", part_words: int = 200_000,
                part_items: int = 400, ngram: int = 5) -> list[Index]:
    """Index parts of bounded size; document frequencies are over all items."""
    rows = (items.select(id_col, "text").where(f"{id_col} IS NOT NULL AND text IS NOT NULL")
            .orderBy(id_col, "text").toLocalIterator())
    texts = [(r[0], r[1]) for r in rows]
    df: dict[int, int] = {}
    lens = []
    for _, t in texts:
        h = _hashes(t)
        lens.append(len(h))
        for x in np.unique(h):
            df[int(x)] = df.get(int(x), 0) + 1
    texts = [(t, n) for t, n in zip(texts, lens) if n]
    mean = sum(n for _, n in texts) / max(1, len(texts))
    parts: list[Index] = []
    part: list[tuple[object, str]] = []
    size = 0
    for t, n in texts:
        if part and (size + n > part_words or len(part) >= part_items):
            parts.append(Index(part, len(texts), mean, df, ngram))
            part, size = [], 0
        part.append(t)
        size += n
    if part:
        parts.append(Index(part, len(texts), mean, df, ngram))
    return parts


def _found(index: Index, texts, threshold: float, min_overlap: float):
    """(row, item, score, question, answer, both) of verified leaks in an Arrow column."""
    for a, b, data, offs in text_slices(texts):
        h, doc, _, _ = words(data, offs, WORD, LOWER)
        if not len(h):
            continue
        where = bounds(doc, b - a)
        scores = {(d, j): s for d, j, s in index.candidates(h, doc, b - a, threshold)}
        last, grams_of = None, None
        for d, j in sorted({*scores, *index.parts_found(h, doc, min_overlap)}):
            if d != last:
                last, own = d, h[where[d]:where[d + 1]]
                grams_of = functools.cache(lambda n, own=own: np.unique(sequence_hash(own, n)))
            shares = index.overlap(j, grams_of)
            if index.leaked(j, shares, min_overlap):
                yield a + d, index.ids[j], scores[d, j] if (d, j) in scores else index.best_passage(own, j), *shares


def leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.4,
          min_overlap: float = 0.6) -> DataFrame:
    """One row per document and test item found in it: (doc_id, item_id, score,
    question_overlap, answer_overlap, overlap)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = items.schema["item_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, item_id {item_kind}, score double, question_overlap double, "
              "answer_overlap double, overlap double")
    item_type = to_arrow_type(items.schema["item_id"].dataType)
    d = docs.select("doc_id", "text")
    out = docs.sparkSession.createDataFrame([], schema)
    for index in build_index(items):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = column(batch, "doc_id")
                rows = list(_found(sent.value, column(batch, "text"), threshold, min_overlap))
                at, item, *rest = zip(*rows) if rows else ([],) * 6
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at, pa.int64())), pa.array(item, item_type),
                     *[pa.array(x, pa.float64()) for x in rest]],
                    names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "overlap"])
        out = out.unionByName(d.mapInArrow(run, schema))
    return out


def drop_leaked(docs: DataFrame, items: DataFrame, threshold: float = 0.4,
                min_overlap: float = 0.6) -> DataFrame:
    """The rows, with all their columns, in which no test item was found."""
    for index in build_index(items):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def judge(texts, sent=sent):
            good = np.ones(len(texts), bool)
            for at, *_ in _found(sent.value, texts, threshold, min_overlap):
                good[at] = False
            return good
        docs = filter_rows(docs, judge)
    return docs
