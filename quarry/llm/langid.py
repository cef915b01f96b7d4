"""Language identification with a byte convolutional network.

Filters of several widths slide over the lower-cased bytes of fixed-length
windows; the largest response of each filter in a window goes through a ReLU
and a softmax layer.  The network is trained in numpy on a bounded sample of
labelled texts and then applied to every window of every text, in map tasks
without a shuffle.  A document's probabilities are the length-weighted mean of
its windows'.

Defined results: a null text, an empty text or one without a letter gives
``und`` with score 0.  With no labelled row to learn from, every text is
``und``.  Ties between languages go to the first in sorted order.  Repeated
rows are predicted each on its own; extra columns are ignored (``predict``) or
kept (``keep_identified``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quarry.llm.common import filter_rows
from quarry.llm.words import LOWER, column, text_slices

WIDTHS = (2, 3, 4)
REACH = max(WIDTHS)
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")


def _windows(data, offs, size: int):
    """Non-overlapping windows over every byte of the slice, each with the
    REACH - 1 bytes that follow it, padded with zero: (bytes, document, length)."""
    lengths = np.diff(offs)
    count = np.maximum(1, -(-lengths // size))
    doc = np.repeat(np.arange(len(lengths)), count)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = offs[:-1][doc] + number * size
    left = offs[1:][doc] - start
    at = start[:, None] + np.arange(size + REACH - 1)
    padded = np.append(LOWER[data], np.uint8(0))
    win = np.where(np.arange(size + REACH - 1) < left[:, None], padded[np.minimum(at, len(data))], 0)
    return win.astype(np.uint8), doc, np.minimum(left, size)


class ByteNet:
    """Filter tables ``taps`` [offset, byte, filter], bias, softmax layer."""

    def __init__(self, languages, filters: int, seed: int):
        rng = np.random.default_rng(seed)
        n = filters * len(WIDTHS)
        self.languages = list(languages)
        self.width = np.repeat(WIDTHS, filters)
        self.used = (np.arange(REACH)[:, None] < self.width).astype(np.float32)
        self.taps = (rng.normal(0, 0.3, (REACH, 256, n)) * self.used[:, None]).astype(np.float32)
        self.taps[:, 0] = 0
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.1, (n, len(self.languages))).astype(np.float32)
        self.out_bias = np.zeros(len(self.languages), np.float32)

    def responses(self, win):
        size = win.shape[1] - REACH + 1
        total = self.taps[0][win[:, :size]]
        for j in range(1, REACH):
            total += self.taps[j][win[:, j:j + size]]
        return total

    def probabilities(self, win):
        parts = []
        for i in range(0, len(win), 128):
            top = np.maximum(self.responses(win[i:i + 128]).max(axis=1) + self.bias, 0)
            z = top @ self.out + self.out_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            parts.append(z / z.sum(axis=1, keepdims=True))
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)), np.float32)

    def fit(self, win, label, steps: int, seed: int, batch: int = 64, rate: float = 4e-3):
        """Adam on the cross entropy for about ``steps`` batches; gradients reach only the winning position of a filter."""
        rng = np.random.default_rng(seed)
        params = [self.taps, self.bias, self.out, self.out_bias]
        first = [np.zeros_like(p) for p in params]
        second = [np.zeros_like(p) for p in params]
        n_f, step = len(self.bias), 0
        filt = np.arange(n_f)
        epochs = max(1, -(-steps * batch // len(win)))
        total = epochs * -(-len(win) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(win))
            for i in range(0, len(order), batch):
                rows = order[i:i + batch]
                x, y = win[rows], label[rows]
                r = self.responses(x)
                at = r.argmax(axis=1)
                pre = np.take_along_axis(r, at[:, None], axis=1)[:, 0] + self.bias
                top = np.maximum(pre, 0)
                z = top @ self.out + self.out_bias
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(y)), y] -= 1
                p /= len(y)
                d_top = (p @ self.out.T) * (pre > 0)
                d_taps = np.zeros_like(self.taps)
                for j in range(REACH):
                    np.add.at(d_taps[j], (x[np.arange(len(y))[:, None], at + j], filt), d_top * self.used[j])
                d_taps[:, 0] = 0
                step += 1
                lr = rate * (1 - (step - 1) / total)
                for k, g in enumerate((d_taps, d_top.sum(axis=0), top.T @ p, p.sum(axis=0))):
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    params[k] -= lr * (first[k] / (1 - 0.9 ** step)
                                       / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self


def _sample_windows(size: int, per_doc: int):
    """Up to ``per_doc`` windows spread over a text, and one short crop of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = column(batch, "lang").to_pylist()
            for a, b, data, offs in text_slices(column(batch, "text")):
                win, doc, _ = _windows(data, offs, size)
                where = np.searchsorted(doc, np.arange(b - a + 1))
                lang, out = [], []
                for d in range(b - a):
                    n = where[d + 1] - where[d]
                    pick = np.unique(np.linspace(0, n - 1, min(per_doc, n)).astype(int))
                    rows = [win[where[d] + k] for k in pick]
                    crop = win[where[d]].copy()
                    crop[24:] = 0
                    for w in [*rows, crop]:
                        lang.append(langs[a + d])
                        out.append(w.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(out, pa.binary())],
                                                 names=["lang", "win"])
    return run


def train(labelled: DataFrame, window: int = 256, filters: int = 12, per_language: int = 1000,
          max_docs: int = 12000, per_doc: int = 3, steps: int = 1200, seed: int = 7) -> ByteNet | None:
    """Fit on (doc_id, text, lang) rows with a non-null language.

    The sample is bounded: ``per_language`` documents of each language, and
    ``max_docs`` in all, taken in the order of a hash of id and text.
    Returns None when there is nothing to learn from.
    """
    d = labelled.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    n = d.select("lang").distinct().count()
    if not n:
        return None
    each = max(1, min(per_language, max_docs // n))
    key = F.xxhash64("doc_id", "text")
    ids = d.select("lang", key.alias("k")).withColumn(
        "r", F.row_number().over(Window.partitionBy("lang").orderBy("k"))).where(F.col("r") <= each)
    picked = d.withColumn("k", key).join(F.broadcast(ids.select("lang", "k").distinct()), ["lang", "k"])
    rows = picked.select("text", "lang").mapInArrow(
        _sample_windows(window, per_doc), "lang string, win binary").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["win"])))
    languages = sorted({r["lang"] for r in rows})
    win = np.frombuffer(b"".join(bytes(r["win"]) for r in rows), np.uint8).reshape(len(rows), -1)
    label = np.array([languages.index(r["lang"]) for r in rows])
    return ByteNet(languages, filters, seed).fit(win, label, steps, seed)


def _judge(net: ByteNet | None, texts, size: int):
    """(language, score) of every text of an Arrow column."""
    langs, scores = [], []
    for a, b, data, offs in text_slices(texts):
        known = np.array([_LETTER.search(t or "") is not None for t in texts.slice(a, b - a).to_pylist()], bool)
        if net is None or not known.any():
            langs += [UNDETERMINED] * (b - a)
            scores += [0.0] * (b - a)
            continue
        win, doc, length = _windows(data, offs, size)
        p = net.probabilities(win) * np.maximum(length, 1)[:, None]
        mean = np.add.reduceat(p, np.searchsorted(doc, np.arange(b - a)), axis=0)
        mean /= mean.sum(axis=1, keepdims=True)
        best = mean.argmax(axis=1)
        for d in range(b - a):
            langs.append(net.languages[best[d]] if known[d] else UNDETERMINED)
            scores.append(min(1.0, float(mean[d, best[d]])) if known[d] else 0.0)
    return langs, scores


def predict(docs: DataFrame, net: ByteNet | None, window: int = 256) -> DataFrame:
    """(doc_id, lang_pred, score) for every row; only the text is an input."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = _judge(net, column(batch, "text"), window)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, net: ByteNet | None, min_score: float = 0.4,
                    window: int = 256) -> DataFrame:
    """The rows, with all their columns, whose language was identified.  Without a
    network (nothing to learn from) every text with a letter is kept."""
    def judge(texts):
        if net is None:
            return [_LETTER.search(t or "") is not None for t in texts.to_pylist()]
        langs, scores = _judge(net, texts, window)
        return [x != UNDETERMINED and s >= min_score for x, s in zip(langs, scores)]
    return filter_rows(docs, judge)
