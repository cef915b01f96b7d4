"""Byte-level BPE encoding and decoding with recursive DuckDB queries in map tasks.

Every task cuts its texts into pieces with the pretokenizer pattern and sends
the distinct pieces it has not met yet to an in-process DuckDB connection.
There a piece is a set of (piece, position, token) rows.  A recursive query
joins them with the merge table and contracts each piece's leftmost pair of
minimum rank until no piece has a pair that merges.  Ordered aggregation turns
the token rows into id lists and into the decoded bytes.  A piece that is a token as a whole is that token, as
in the usual encoders.

The merge table follows from the rank file: tokens x and y merge into the
token spelt xy, with its rank.  It is built once per Python worker.  Pieces are
kept in two generations: when the young one is full (in entries or in characters)
it becomes the old one, and what is met again moves to the new young one, so that
frequent pieces stay and memory stays bounded; a task's pieces go with the task.
Nothing is shuffled.

Defined results: a null text is the empty text and has no ids.  Rows with a
null id and repeated rows are encoded like any other; extra columns are
ignored.  Texts are taken whole, whatever their length; a word of more than ``LONG``
bytes is contracted on its own, over the merges that can occur in it, and its time
grows faster than its length.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quarry.llm.words import column, text_slices

#: entries and characters of one generation of the caches, and pieces sent to one recursive query
CACHE, CACHE_CHARS = 250_000, 16 << 20
BLOCK = 30_000

#: pieces of more bytes than this take the query that contracts several pairs a step
LONG = 256

#: One contraction a step for each piece: rows (piece, position, token, next token) join the
#: merge table; the smallest (rank, position) is the leftmost pair of minimum rank.
_SHORT = """
WITH RECURSIVE r AS (
  SELECT piece, list(tok ORDER BY pos) AS toks, false AS last FROM start GROUP BY piece
  UNION ALL
  (WITH position AS (
     SELECT piece, toks, unnest(range(1, len(toks))) AS p FROM r WHERE NOT last),
   pair AS (
     SELECT piece, p, m.id FROM position JOIN merges m ON m.xy = toks[p]::BIGINT * 4294967296 + toks[p + 1]),
   best AS (
     SELECT piece, min(id::BIGINT * 4294967296 + p) AS b FROM pair GROUP BY piece)
   SELECT r.piece,
          CASE WHEN b IS NULL THEN toks
               ELSE toks[:b % 4294967296 - 1] || [(b // 4294967296)::INTEGER] || toks[b % 4294967296 + 2:] END,
          b IS NULL
   FROM r LEFT JOIN best USING (piece) WHERE NOT r.last)
)
SELECT f.piece, any_value(f.ids) AS ids, count(*) AS n, string_agg(t.hex, '' ORDER BY f.pos) AS hex
FROM (SELECT piece, array_to_string(toks, ',') AS ids, unnest(toks) AS tok,
             generate_subscripts(toks, 1) AS pos FROM r WHERE last) f
JOIN tokens t ON t.id = f.tok GROUP BY f.piece
"""

#: The same fixpoint for long pieces: all pairs of a piece's minimum rank that do not overlap
#: are contracted in one step, from the left.  No pair made by a merge has a lower rank.
_LONG = """
WITH RECURSIVE r AS (
  SELECT piece, pos, tok, false AS last FROM start
  UNION ALL
  (WITH pair AS (
     SELECT o.piece, o.pos, o.tok, m.id
     FROM (SELECT *, lead(tok) OVER (PARTITION BY piece ORDER BY pos) AS nxt FROM r WHERE NOT last) o
     LEFT JOIN own m ON m.xy = o.tok::BIGINT * 4294967296 + o.nxt),
   best AS (
     SELECT *, min(id) OVER (PARTITION BY piece) AS low,
            row_number() OVER (PARTITION BY piece ORDER BY pos) AS n FROM pair),
   hit AS (
     SELECT *, coalesce(id = low, false) AS h,
            n - row_number() OVER (PARTITION BY piece, coalesce(id = low, false) ORDER BY pos) AS island FROM best),
   odd AS (
     SELECT *, h AND row_number() OVER (PARTITION BY piece, h, island ORDER BY pos) % 2 = 1 AS go FROM hit),
   done AS (
     SELECT *, coalesce(lag(go) OVER (PARTITION BY piece ORDER BY pos), false) AS gone FROM odd)
   SELECT piece, pos, CASE WHEN go THEN id ELSE tok END, low IS NULL FROM done WHERE NOT gone)
)
SELECT r.piece, string_agg(CAST(r.tok AS VARCHAR), ',' ORDER BY r.pos) AS ids, count(*) AS n,
       string_agg(t.hex, '' ORDER BY r.pos) AS hex
FROM r JOIN tokens t ON t.id = r.tok WHERE r.last GROUP BY r.piece
"""


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of base64 token and rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Cache:
    """Pieces to ids as text in two generations.  A piece's decoded bytes are compared with its own
    when it is put in, and kept only where they differ."""

    def __init__(self):
        self.ids: dict[str, str] = {}
        self.odd: dict[str, bytes] = {}
        self.old: dict[str, str] = {}
        self.chars = 0

    def missing(self, wanted: set[str]) -> set[str]:
        """Which pieces are not known; those of the old generation become young again."""
        if len(self.ids) > CACHE or self.chars > CACHE_CHARS:
            self.old, self.ids, self.chars = self.ids, {}, 0
        absent = wanted.difference(self.ids)
        for p in absent.intersection(self.old):
            self.ids[p] = self.old[p]
            self.chars += len(p)
        return absent.difference(self.old)

    def put(self, piece: str, raw: bytes, ids: str, decoded: bytes) -> None:
        self.ids[piece] = ids
        self.chars += len(piece)
        if decoded != raw:
            self.odd[piece] = decoded


class Encoder:
    """Texts to (ids as text, number of ids, decoded bytes)."""

    def __init__(self, ranks_path: str, pattern: str):
        self.ranks = load_ranks(ranks_path)
        self.find = regex.compile(pattern).findall
        self.pieces = Cache()
        self.con = duckdb.connect(":memory:", config={
            "threads": "1", "memory_limit": "450MB", "temp_directory": "", "allocator_flush_threshold": "4MB"})
        self.con.execute("SET preserve_insertion_order=false")
        x, y, ids = [], [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    x.append(a)
                    y.append(b)
                    ids.append(rank)
        self._table("merges", {"xy": pa.array([a << 32 | b for a, b in zip(x, y)], pa.int64()),
                               "id": pa.array(ids, pa.int32())})
        self._table("tokens", {"id": pa.array(list(self.ranks.values()), pa.int32()),
                               "hex": pa.array([t.hex() for t in self.ranks], pa.string())})

    def _table(self, name: str, columns: dict[str, pa.Array]) -> None:
        self.con.register("arrow_in", pa.table(columns))
        self.con.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM arrow_in")
        self.con.unregister("arrow_in")

    def _contract(self, pieces: list[tuple[str, bytes]], query: str) -> None:
        single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        size = np.array([len(raw) for _, raw in pieces])
        start = np.cumsum(size) - size
        self._table("start", {"piece": pa.array(np.repeat(np.arange(len(pieces), dtype=np.int32), size)),
                              "pos": pa.array((np.arange(size.sum()) - np.repeat(start, size)).astype(np.int32)),
                              "tok": pa.array(single[np.frombuffer(b"".join([raw for _, raw in pieces]), np.uint8)])})
        for k, ids, _, hexed in self.con.execute(query).fetchall():
            self.pieces.put(*pieces[k], ids, bytes.fromhex(hexed))

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces by the recursive queries."""
        short, long = [], []
        for p in pieces:
            raw = p.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                self.pieces.put(p, raw, str(whole), raw)
            else:
                (short if len(raw) <= LONG else long).append((p, raw))
        for i in range(0, len(short), BLOCK):
            self._contract(short[i:i + BLOCK], _SHORT)
        for p, raw in long:
            # a merge can occur only if the bytes of its token do
            found = [rank for token, rank in self.ranks.items() if token in raw]
            self._table("found", {"id": pa.array(found, pa.int32())})
            self.con.execute("CREATE OR REPLACE TEMP TABLE own AS SELECT * FROM merges SEMI JOIN found USING (id)")
            self._contract([(p, raw)], _LONG)

    def encode(self, texts: list[str | None]):
        """For each text: ids joined by commas, number of ids, decoded bytes."""
        cut = [self.find(t) if t else [] for t in texts]
        self._learn(sorted(self.pieces.missing(set().union(*cut))))
        ids, odd = self.pieces.ids.__getitem__, self.pieces.odd
        for t, own in zip(texts, cut):
            if own:
                text = ",".join(map(ids, own))
                # every piece decodes to its own bytes, or is known not to; the pattern may leave text out
                whole = sum(map(len, own)) == len(t) and (not odd or odd.keys().isdisjoint(own))
                yield text, text.count(",") + 1, t.encode() if whole else b"".join([odd.get(p, p.encode()) for p in own])
            else:
                yield "", 0, b""


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(ranks_path: str, pattern: str) -> Encoder:
    """The worker's encoder; one is kept for the life of the Python worker."""
    key = (ranks_path, pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(ranks_path, pattern)
    return _encoders[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) per row.

    ``ids`` is an array of ints and ``decoded`` the bytes they spell.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>, decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks_path, pattern)
        for batch in batches:
            texts = column(batch, "text")
            n, ids_sha, dec_sha, ids, decoded = [], [], [], [], []
            for first, last, _, _ in text_slices(texts):  # what is held at once does not follow the batch's size
                for text, count, raw in enc.encode(texts.slice(first, last - first).to_pylist()):
                    n.append(count)
                    ids_sha.append(hashlib.sha256(text.encode()).hexdigest())
                    dec_sha.append(hashlib.sha256(raw).hexdigest())
                    if with_ids:
                        ids.append([int(x) for x in text.split(",")] if text else [])
                        decoded.append(raw)
            out = {"doc_id": column(batch, "doc_id"), "n_tokens": pa.array(n, pa.int64()),
                   "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(dec_sha, pa.string())}
            if with_ids:
                out |= {"ids": pa.array(ids, pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.binary())}
            yield pa.RecordBatch.from_pydict(out)
        # the merge table stays with the worker, the pieces of this task make room for other work
        enc.pieces = Cache()
        pa.default_memory_pool().release_unused()
    return docs.select("doc_id", "text").mapInArrow(run, schema)
