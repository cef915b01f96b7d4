"""Repeated byte strings across documents by merging shard Burrows-Wheeler transforms.

Every byte covered by a string of ``length`` bytes that also starts elsewhere
is removed.  Equal strings have to meet in one task, and strings without a
copy should not travel, so the transforms are built per range of anchors:

1. The anchor of a string of ``length`` bytes is its smallest-hash 32-gram
   (leftmost of equals).  Consecutive starts with one anchor form a run; its
   snippet is all bytes of its strings.  Equal strings have equal anchors.
2. Each batch of documents asks, per range of anchor hashes, how often its
   distinct (anchor, snippet) pairs occur.  An anchor with one snippet is
   settled: repeated if that snippet occurs twice, unique otherwise.  Copies
   are thus counted once a batch, and only anchors with several different
   snippets (where copies begin, end or differ) are open.  An anchor with more
   than HOT of them (a line that very many documents hold, each in another
   context) would bring them all to one range.  It is split: its strings are
   counted under a hash of their own, spread over all ranges.
3. For open anchors each batch sends its distinct snippets; a batch is a shard
   of the range.  A shard (or some
   small ones together) sorts its suffixes over an alphabet of 100-byte
   blocks (every byte offset starts a suffix; its predecessor is 100 bytes
   earlier) and so has its own transform.  The shards are merged by interleave
   refinement: starting from shard order, each round puts the suffixes in the
   order of the block before them, reading every shard's transform in turn, so
   after round d the merged order is right for d blocks.  Boundaries appear in
   the round in which neighbours first differ; they are the common prefix
   lengths, in blocks.  After length / 100 rounds an interval of two or more
   suffixes is a repeated string.  No suffix is compared or sorted again.
4. Answers return to their batch, and documents are cut.

Blocks, anchors and snippets are compared by 64-bit hashes.  All tables
between the steps are written to the shared folder.  Ranges follow from the
size of the input, so a task's memory does not grow with it; snippets of one
anchor are sent once a batch however many documents hold them.

Defined results: a null text is the empty text, with nothing to remove.  Each
input row is one document: rows that repeat are copies of each other, and rows
with a null id take part like any other.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quarry.llm.common import materialize
from quarry.llm.words import column, mix, prefix_hash, rows_of, span_hash, text_slices

GRAM = 32
BLOCK = 100
#: bytes of text in a batch: a task holds some thirty times as much in hashes
SLICE = 1 << 20
SHARD = 32 << 10
#: snippets of one anchor in the corpus, or in one batch, beyond which its strings are spread
HOT, HOT_BATCH = 32, 8
_POS = np.uint64((1 << 28) - 1)


def _pack(a) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes())


def _unpack(b: bytes, kind):
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _sliding_min(x, width: int):
    """Minimum of every ``width`` consecutive values, by block prefixes and suffixes."""
    n = len(x) - width + 1
    pad = -len(x) % width
    full = np.concatenate([x, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    front = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], front[width - 1:width - 1 + n])


class Runs:
    """Runs of one slice: ``start`` and ``stop`` (last start + 1) of their strings in the
    slice's bytes, ``doc``, anchor hash ``g`` and snippet hash ``c``."""

    def __init__(self, data, offs, length: int):
        empty = np.zeros(0, np.int64)
        self.start = self.stop = self.doc = empty
        self.g = self.c = np.zeros(0, np.uint64)
        if len(data) < length:
            return
        prefix = prefix_hash(data)
        p = np.arange(len(data) - GRAM + 1)
        gram = span_hash(prefix, p, p + GRAM)
        low = _sliding_min((gram & ~_POS) | p.astype(np.uint64), length - GRAM + 1)
        doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:len(low)]
        at = np.flatnonzero(np.arange(len(low)) + length <= offs[1:][doc])
        if not len(at):
            return
        anchor, doc = (low[at] & _POS).astype(np.int64), doc[at]
        new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])))
        self.start, self.doc = at[new], doc[new]
        self.stop = at[np.append(new[1:], len(at)) - 1] + 1
        # anchors are minima, so their hashes crowd near zero; mixed again they spread over the ranges
        self.g = mix(gram[anchor[new]])
        # the place of the anchor in the snippet is part of the pair
        self.c = mix(span_hash(prefix, self.start, self.stop + length - 1)
                     + (anchor[new] - self.start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def entries(self):
        """Distinct (g, c) sorted by g then c: (g, c, seen, first run, entry of each run).
        ``seen`` is 1 for a pair that occurs twice; an anchor with more than HOT_BATCH snippets
        is one entry with ``seen`` 2."""
        order = np.lexsort((self.c, self.g))
        g, c = self.g[order], self.c[order]
        new_g = np.append(True, g[1:] != g[:-1]) if len(g) else np.zeros(0, bool)
        new = new_g.copy()
        new[1:] |= c[1:] != c[:-1]
        anchor = np.cumsum(new_g) - 1
        many = (np.bincount(anchor, new) > HOT_BATCH)[anchor] if len(g) else np.zeros(0, bool)
        new &= new_g | ~many
        first = np.flatnonzero(new)
        entry = np.empty(len(g), np.int64)
        entry[order] = np.cumsum(new) - 1
        seen = np.where(many[first], 2, np.diff(np.append(first, len(g))) > 1).astype(np.uint8)
        return g[first], np.where(many[first], np.uint64(0), c[first]), seen, order[first], entry


def _edges(ranges: int):
    return np.array([i * 2 ** 64 // ranges for i in range(1, ranges)], np.uint64)


def _cuts(g, ranges: int):
    cut = [0, *np.searchsorted(g, _edges(ranges)).tolist(), len(g)]
    return [(i, cut[i], cut[i + 1]) for i in range(ranges) if cut[i] < cut[i + 1]]


def _batches(id_type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = column(batch, "doc_id")
            for a, b, data, offs in text_slices(column(batch, "text"), SLICE):
                yield pa.RecordBatch.from_pydict({
                    "batch": pa.array([number], pa.int64()),
                    "ids": pa.array([ids.slice(a, b - a).to_pylist()], pa.list_(id_type)),
                    "offs": pa.array([offs.astype(np.int64).tobytes()], pa.binary()),
                    "n_bytes": pa.array([len(data)], pa.int64()),
                    "data": pa.array([_pack(data)], pa.binary())})
                number += 1
    return run


def _ask(length: int, ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for r in rows_of(rows):
                batch = r["batch"]
                g, c, twice, _, _ = Runs(_unpack(r["data"], np.uint8), np.frombuffer(r["offs"], np.int64), length).entries()
                use = _cuts(g, ranges)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([i for i, _, _ in use], pa.int32()), "batch": pa.array([batch] * len(use), pa.int64()),
                    **{k: pa.array([x[a:b].tobytes() for _, a, b in use], pa.binary())
                       for k, x in (("g", g), ("c", c), ("twice", twice))}})
    return run


def _count(part: pd.DataFrame) -> pd.DataFrame:
    """Codes of all pairs of one range: 0 unique, 1 repeated, 2 open, 3 repeated and open,
    4 of a hot anchor."""
    g = [np.frombuffer(x, np.uint64) for x in part["g"]]
    cut = np.cumsum([0, *map(len, g)])
    g = np.concatenate(g)
    c = np.concatenate([np.frombuffer(x, np.uint64) for x in part["c"]])
    seen = np.concatenate([np.frombuffer(x, np.uint8) for x in part["twice"]])
    order = np.lexsort((c, g))
    gs, cs = g[order], c[order]
    new_g = np.append(True, gs[1:] != gs[:-1])
    new = new_g | np.append(True, cs[1:] != cs[:-1])
    pair, anchor = np.cumsum(new) - 1, np.cumsum(new_g) - 1
    often = np.bincount(pair, 1 + seen[order])[pair] > 1
    snippets = np.bincount(anchor, new)[anchor]
    hot = (snippets > HOT) | (np.bincount(anchor, seen[order] == 2)[anchor] > 0)
    code = np.empty(len(g), np.uint8)
    code[order] = np.where(hot, 4, often + 2 * (snippets > 1))
    return pd.DataFrame({"batch": part["batch"].to_numpy(), "part": part["part"].to_numpy(),
                         "code": [_pack(code[a:b]) for a, b in zip(cut, cut[1:])]})


def _together(answers, name: str, kind):
    """The answers of all ranges of a batch, in range order."""
    got = sorted(answers or [], key=lambda x: x["part"])
    return np.concatenate([_unpack(x[name], kind) for x in got]) if got else np.zeros(0, kind)


def _cut(data, covered):
    """(bytes, removed bytes, removed runs, sha256 of the rest, the rest) of one document."""
    edge = np.diff(np.concatenate([[0], covered.view(np.int8), [0]]))
    rest = data[~covered].tobytes()
    return len(data), int(covered.sum()), int((edge == 1).sum()), hashlib.sha256(rest).hexdigest(), rest


def _covered(repeated, length: int):
    """Bytes under a repeated string, from the marks at its first byte."""
    total = np.cumsum(np.concatenate([[0], repeated]))
    at = np.arange(len(repeated))
    return total[at + 1] > total[np.maximum(at + 1 - length, 0)]


_RESULT = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]


def _results(ids, rows, id_type, keep: bool):
    cols = list(zip(*rows)) if rows else [[]] * 5
    out = {"ids": pa.array([ids], pa.list_(id_type))}
    for name, kind, values in zip(_RESULT, _TYPES, cols):
        if name != "kept" or keep:
            out[name] = pa.array([list(values)], pa.list_(kind))
    return out


def _strings(data, start, stop, length: int):
    """Hashes of all strings of some runs, in run order."""
    if not len(start):
        return np.zeros(0, np.uint64)
    n = stop - start
    at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return span_hash(prefix_hash(data), at, at + length)


def _settle(length: int, id_type, keep: bool):
    """Cut documents without open pairs; hand on the others and the distinct open snippets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for r in rows_of(rows):
                data, offs = _unpack(r["data"], np.uint8), np.frombuffer(r["offs"], np.int64)
                runs = Runs(data, offs, length)
                g, _, _, first, entry = runs.entries()
                code = _together(r["answers"], "code", np.uint8)
                mine = code[entry] if len(entry) else np.zeros(0, np.uint8)
                mark = np.zeros(len(data) + 1, np.int64)
                for edge, step in ((runs.start, 1), (runs.stop, -1)):
                    np.add.at(mark, edge[(mine == 1) | (mine == 3)], step)
                repeated = np.cumsum(mark)[:-1] > 0
                waiting = np.zeros(len(offs) - 1, bool)
                waiting[runs.doc[(mine == 2) | (mine == 4)]] = True
                done = [_cut(data[a:b], _covered(repeated[a:b], length))
                        for a, b, w in zip(offs, offs[1:], waiting) if not w]
                ids = r["ids"]
                is_sent = (code == 2) | (code == 3)
                sent = np.flatnonzero(is_sent)
                at = first[sent]
                size = (runs.stop[at] - runs.start[at] + length - 1).astype(np.int32)
                snippets = (np.concatenate([data[a:a + n] for a, n in zip(runs.start[at], size)])
                            if len(at) else np.zeros(0, np.uint8))
                # each open run: start, stop and the place of its snippet among those sent
                place = np.cumsum(is_sent) - 1
                opened = np.flatnonzero(mine == 2)
                todo = np.stack([runs.start[opened], runs.stop[opened], place[entry[opened]]]).astype(np.int64)
                hot = np.stack([runs.start[mine == 4], runs.stop[mine == 4]]).astype(np.int64)
                string, times = np.unique(_strings(data, *hot, length), return_counts=True)
                has = bool(waiting.any())
                yield pa.RecordBatch.from_pydict({
                    "batch": pa.array([r["batch"]], pa.int64()),
                    **_results([x for x, w in zip(ids, waiting) if not w], done, id_type, keep),
                    "wait_ids": pa.array([[x for x, w in zip(ids, waiting) if w]], pa.list_(id_type)),
                    "wait": pa.array([waiting.tobytes() if has else None], pa.binary()),
                    "offs": pa.array([r["offs"] if has else None], pa.binary()),
                    "data": pa.array([_pack(np.where(np.repeat(waiting, np.diff(offs)), data, 0).astype(np.uint8))
                                      if has else None], pa.binary()),
                    "repeated": pa.array([_pack(np.packbits(repeated)) if has else None], pa.binary()),
                    "todo": pa.array([_pack(todo) if has else None], pa.binary()),
                    "hot": pa.array([_pack(hot) if has else None], pa.binary()),
                    "hot_g": pa.array([string.tobytes() if len(string) else None], pa.binary()),
                    "hot_twice": pa.array([(times > 1).tobytes()], pa.binary()),
                    "n_hot": pa.array([len(string)], pa.int64()),
                    "g": pa.array([g[sent].tobytes()], pa.binary()), "size": pa.array([size.tobytes()], pa.binary()),
                    "twice": pa.array([(code[sent] == 3).tobytes()], pa.binary()),
                    "snippets": pa.array([_pack(snippets)], pa.binary()),
                    "n_open": pa.array([int(size.sum())], pa.int64())})
    return run


def _send(ranges: int):
    """One row per batch and range: the shard's open snippets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for r in rows_of(rows):
                g, size = np.frombuffer(r["g"], np.uint64), np.frombuffer(r["size"], np.int32)
                twice, data = np.frombuffer(r["twice"], bool), _unpack(r["snippets"], np.uint8)
                at = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
                use = _cuts(g, ranges)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([i for i, _, _ in use], pa.int32()),
                    "batch": pa.array([r["batch"]] * len(use), pa.int64()),
                    "size": pa.array([size[a:b].tobytes() for _, a, b in use], pa.binary()),
                    "twice": pa.array([twice[a:b].tobytes() for _, a, b in use], pa.binary()),
                    "data": pa.array([_pack(data[at[a]:at[b]]) for _, a, b in use], pa.binary())})
    return run


def _ask_strings(ranges: int):
    """The strings of hot anchors ask like pairs, each under its own hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for r in rows_of(rows):
                g, twice = np.frombuffer(r["hot_g"], np.uint64), np.frombuffer(r["hot_twice"], np.uint8)
                use = _cuts(g, ranges)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([i for i, _, _ in use], pa.int32()),
                    "batch": pa.array([r["batch"]] * len(use), pa.int64()),
                    "g": pa.array([g[a:b].tobytes() for _, a, b in use], pa.binary()),
                    "c": pa.array([np.zeros(b - a, np.uint64).tobytes() for _, a, b in use], pa.binary()),
                    "twice": pa.array([twice[a:b].tobytes() for _, a, b in use], pa.binary())})
    return run


class Shard:
    """Snippets of one batch, their suffixes over blocks, and the transform.

    Suffix (snippet, offset) for offsets 0 .. size; the last BLOCK offsets hold
    no whole block and end a chain of every BLOCK-th offset.  ``order`` lists the
    suffixes in order, ``before`` the block hash before each, and ``chain`` the
    chain that begins there (else -1).
    """

    def __init__(self, data, size):
        size = size.astype(np.int64)
        n = int(size.sum() + len(size))
        snippet = np.repeat(np.arange(len(size)), size + 1)
        base = np.cumsum(size + 1) - (size + 1)
        offset = np.arange(n) - base[snippet]
        byte = offset + (np.cumsum(size) - size)[snippet]
        whole = offset + BLOCK <= size[snippet]
        prefix = prefix_hash(data)
        block = np.zeros(n, np.uint64)
        block[whole] = span_hash(prefix, byte[whole], byte[whole] + BLOCK)
        # chains end in an order of their own, before every block
        last = np.flatnonzero(~whole)
        chain_of_end = np.empty(n, np.int64)
        chain_of_end[last] = np.arange(len(last))
        rank = np.empty(n, np.int64)
        rank[last] = np.arange(len(last))
        values, inverse = np.unique(block[whole], return_inverse=True)
        rank[whole] = len(last) + inverse
        reach, step = BLOCK, np.int64(n + 1)
        longest = int(size.max(initial=0))
        while True:  # double the sorted depth until every suffix is told apart by its chain's end
            nxt = np.minimum(np.arange(n) + reach, n - 1)
            inside = offset + reach <= size[snippet]
            key = rank * step + np.where(inside, rank[nxt] + 1, 0)
            _, rank = np.unique(key, return_inverse=True)
            reach *= 2
            if reach > longest + BLOCK:
                break
        self.order = np.argsort(rank, kind="stable")
        o = offset[self.order]
        first = o < BLOCK
        self.before = block[np.where(first, 0, self.order - BLOCK)]
        # the chain that begins at offset o ends at the largest offset of the same phase
        end = o + (size[snippet[self.order]] - o) // BLOCK * BLOCK
        self.chain = np.where(first, chain_of_end[np.where(first, base[snippet[self.order]] + end, last[0] if n else 0)], -1)
        self.chains, self.snippet, self.offset, self.size = len(last), snippet, offset, size


def merge(shards: list[Shard], rounds: int):
    """Interleave of the shards' suffixes after ``rounds`` refinements.

    Returns (shard of each place, interval of each place): places of one interval
    share their first ``rounds`` blocks; a suffix that ended earlier is alone.
    """
    count = np.array([len(s.order) for s in shards])
    first_chain = np.cumsum([0, *[s.chains for s in shards]])
    symbols = np.unique(np.concatenate([s.before[s.chain < 0] for s in shards]))
    # transform symbols: chain ends first, each its own, then blocks
    column_ = np.concatenate([np.where(s.chain >= 0, s.chain + first_chain[k],
                                       first_chain[-1] + np.searchsorted(symbols, s.before))
                              for k, s in enumerate(shards)])
    source = np.repeat(np.arange(len(shards)), count)
    interval = np.zeros(len(source), np.int64)
    for _ in range(rounds):
        # read each shard's transform in turn, as the interleave says
        by_shard = np.argsort(source, kind="stable")
        place = np.empty(len(source), np.int64)
        place[by_shard] = np.arange(len(source))
        symbol = column_[place]
        order = np.argsort(symbol, kind="stable")
        symbol, interval, source = symbol[order], interval[order], source[order]
        new = np.append(True, (symbol[1:] != symbol[:-1]) | (interval[1:] != interval[:-1]))
        new |= symbol < first_chain[-1]
        interval = np.cumsum(new) - 1
    return source, interval


def _repeats(length: int):
    """For one range: which strings of every shard's snippets are repeated."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("batch", kind="stable")
        data = [_unpack(x, np.uint8) for x in part["data"]]
        sizes = [np.frombuffer(x, np.int32) for x in part["size"]]
        flags = [np.frombuffer(x, bool) for x in part["twice"]]
        # small batches share a shard of about SHARD bytes
        group = np.cumsum([0, *map(len, data)])[:-1] // SHARD
        shards, twice = [], []
        for k in np.unique(group):
            a, b = np.searchsorted(group, [k, k + 1])
            shards.append(Shard(np.concatenate(data[a:b]), np.concatenate(sizes[a:b])))
            twice.append(np.concatenate(flags[a:b]))
        source, interval = merge(shards, length // BLOCK)
        by_shard = np.argsort(source, kind="stable")
        interval = interval[by_shard]
        # a snippet that occurs twice counts twice
        weight = np.concatenate([1 + t[s.snippet[s.order]] for s, t in zip(shards, twice)])
        full = np.concatenate([(s.offset + length <= s.size[s.snippet])[s.order] for s in shards])
        often = np.bincount(interval, weight * full)[interval] > 1
        out, at = [], 0
        for s in shards:
            n = len(s.order)
            hit = np.zeros(n, bool)
            hit[s.order] = (often & full)[at:at + n]
            out.append(hit[s.offset + length <= s.size[s.snippet]].astype(np.uint8))
            at += n
        strings = np.cumsum([0, *[int((x.astype(np.int64) - length + 1).sum()) for x in sizes]])
        hits = np.concatenate(out)
        out = [_pack(hits[a:b]) for a, b in zip(strings, strings[1:])]
        return pd.DataFrame({"batch": part["batch"].to_numpy(), "part": part["part"].to_numpy(), "hits": out})
    return run


def _finish(length: int, id_type, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for r in rows_of(rows):
                offs, data = np.frombuffer(r["offs"], np.int64), _unpack(r["data"], np.uint8)
                repeated = np.unpackbits(_unpack(r["repeated"], np.uint8), count=len(data)).astype(bool)
                hits = _together(r["answers"], "hits", np.uint8).astype(bool)
                size = np.frombuffer(r["size"], np.int32).astype(np.int64) - length + 1
                at = np.cumsum(size) - size
                for start, stop, place in _unpack(r["todo"], np.int64).reshape(3, -1).T:
                    repeated[start:stop] |= hits[at[place]:at[place] + stop - start]
                start, stop = _unpack(r["hot"], np.int64).reshape(2, -1)
                string = _strings(data, start, stop, length)
                again = _together(r["hot_answers"], "code", np.uint8)[np.searchsorted(np.unique(string), string)] == 1 \
                    if len(string) else np.zeros(0, bool)
                n = np.cumsum(np.concatenate([[0], stop - start]))
                for a, b, lo, hi in zip(start, stop, n, n[1:]):
                    repeated[a:b] |= again[lo:hi]
                waiting = np.frombuffer(r["wait"], bool)
                done = [_cut(data[a:b], _covered(repeated[a:b], length))
                        for a, b, w in zip(offs, offs[1:], waiting) if w]
                yield pa.RecordBatch.from_pydict(_results(r["wait_ids"], done, id_type, keep))
    return run


def remove_repeats(docs: DataFrame, length: int = 200, range_bytes: int = 16 << 20, keep_bytes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) per row; ``length``
    must be a multiple of the block of 100 bytes."""
    if length % BLOCK or length < BLOCK:
        raise ValueError(f"length must be a multiple of {BLOCK}")
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    kind = docs.schema["doc_id"].dataType.simpleString()
    result = f"ids array<{kind}>, n_bytes array<long>, n_removed array<long>, n_spans array<long>, kept_sha256 array<string>"
    if keep_bytes:
        result += ", kept array<binary>"
    batches = materialize(docs.select("doc_id", "text").mapInArrow(
        _batches(id_type), f"batch long, ids array<{kind}>, offs binary, n_bytes long, data binary"), "bwt-texts")
    ranges = max(1, -(-(batches.agg(F.sum("n_bytes")).first()[0] or 0) // range_bytes))
    codes = (batches.select("batch", "data", "offs")
             .mapInArrow(_ask(length, ranges), "part int, batch long, g binary, c binary, twice binary")
             .groupBy("part").applyInPandas(_count, "batch long, part int, code binary")
             .groupBy("batch").agg(F.collect_list(F.struct("part", "code")).alias("answers")))
    settled = materialize(
        batches.select("batch", "ids", "offs", "data").join(codes, "batch", "left")
        .mapInArrow(_settle(length, id_type, keep_bytes),
                    f"batch long, {result}, wait_ids array<{kind}>, wait binary, offs binary, data binary, "
                    "repeated binary, todo binary, hot binary, hot_g binary, hot_twice binary, n_hot long, g binary, size binary, "
                    "twice binary, snippets binary, n_open long"),
        "bwt-open")
    open_bytes, hot_strings = (x or 0 for x in settled.agg(F.sum("n_open"), F.sum("n_hot")).first())
    # a merge holds some 200 bytes of arrays for each byte of its range
    parts = max(1, -(-open_bytes // max(1, range_bytes // 32)))
    hits = (settled.where("n_open > 0").select("batch", "g", "size", "twice", "snippets")
            .mapInArrow(_send(parts), "part int, batch long, size binary, twice binary, data binary")
            .groupBy("part").applyInPandas(_repeats(length), "batch long, part int, hits binary")
            .groupBy("batch").agg(F.collect_list(F.struct("part", "hits")).alias("answers")))
    hot = (settled.where("hot_g IS NOT NULL").select("batch", "hot_g", "hot_twice")
           .mapInArrow(_ask_strings(max(1, -(-hot_strings // (range_bytes // 32)))), "part int, batch long, g binary, c binary, twice binary")
           .groupBy("part").applyInPandas(_count, "batch long, part int, code binary")
           .groupBy("batch").agg(F.collect_list(F.struct("part", "code")).alias("hot_answers")))
    late = (settled.where("wait IS NOT NULL")
            .select("batch", "wait_ids", "wait", "offs", "data", "repeated", "todo", "hot", "size")
            .join(hits, "batch", "left").join(hot, "batch", "left").mapInArrow(_finish(length, id_type, keep_bytes), result))
    names = [c for c in _RESULT if c != "kept" or keep_bytes]
    both = settled.select("ids", *names).unionByName(late)
    return both.select(F.explode(F.arrays_zip("ids", *names)).alias("r")).select(
        F.col("r.ids").alias("doc_id"), *[F.col(f"r.{c}").alias(c) for c in names])
