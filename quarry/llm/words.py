"""Words and hashes of Arrow text columns, computed for a slice of documents at once.

Operators that look at every word of every document call these helpers inside
``mapInArrow``.  A slice holds whole documents of a few MB together (one long
document is a slice of its own), so temporary arrays stay small at any size of
the table.  A null text counts as the empty text everywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MULT = 0x9E3779B97F4A7C15
_INV = pow(_MULT, -1, 2 ** 64)
_VALUES = np.random.default_rng(20240607).integers(0, 2 ** 64, 256, dtype=np.uint64) | np.uint64(1)

#: A-Z to a-z, every other byte as it is
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: bytes of ``[^\x20\x09-\x0D]+``
NON_SPACE = np.ones(256, bool)
NON_SPACE[[9, 10, 11, 12, 13, 32]] = False

#: bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower case
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True

SLICE_BYTES = 2 << 20


def mix(x):
    """Bijective 64-bit finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_text(data: bytes) -> int:
    """Hash of one byte string, equal to ``span_hash`` of the same bytes in a slice."""
    b = np.frombuffer(data, np.uint8)
    return int(span_hash(prefix_hash(b), np.array([0]), np.array([len(b)]))[0])


_powers = {_MULT: np.ones(1, np.uint64), _INV: np.ones(1, np.uint64)}


def _power(base: int, n: int):
    """base^0 .. base^n modulo 2^64, kept up to the size of a usual slice."""
    have = _powers[base]
    if len(have) <= n:
        have = np.full(max(n + 1, 2 * len(have)), base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if n <= 2 * SLICE_BYTES:
            _powers[base] = have
    return have


def prefix_hash(b):
    """Prefix sums of the polynomial hash of bytes ``b`` (length n + 1)."""
    out = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_VALUES[b] * _power(_MULT, len(b))[:len(b)], out=out[1:])
    return out


def span_hash(prefix, start, end):
    """64-bit hash of the bytes [start, end) for arrays of spans."""
    inv = _power(_INV, len(prefix))
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(np.uint64))


def sequence_hash(h, n: int):
    """Hash of every n consecutive values of ``h`` (length len(h) - n + 1)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out = out * np.uint64(_MULT) + h[j:j + m]
    return mix(out)


def text_slices(column, max_bytes: int = SLICE_BYTES):
    """Cut an Arrow string column into runs of whole rows.

    Yields (first row, last row + 1, bytes, offsets): ``bytes`` is a uint8 array
    over the texts without separators, ``offsets`` has one entry more than rows.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offs, offs[first] + max_bytes, "right")) - 1)
        last = min(last, len(column))
        yield first, last, raw[offs[first]:offs[last]], offs[first:last + 1] - offs[first]
        first = last


def spans(data, offs, keep):
    """Maximal runs of bytes in class ``keep``; runs never cross documents.

    Returns (start, end, document) arrays in text order.
    """
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    k = keep[data]
    cut = offs[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = k[:-1]
    before[cut] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = k[1:]
    after[cut - 1] = False
    start = np.flatnonzero(k & ~before)
    end = np.flatnonzero(k & ~after) + 1
    return start, end, np.searchsorted(offs[1:], start, "right")


def words(data, offs, keep=NON_SPACE, fold=LOWER):
    """Words of a slice: (hash, document, start, end); letters are folded first."""
    start, end, doc = spans(data, offs, keep)
    if not len(start):
        return np.zeros(0, np.uint64), doc, start, end
    return span_hash(prefix_hash(fold[data]), start, end), doc, start, end


def bounds(doc, n: int):
    """For sorted ``doc``: offsets (n + 1) of each document's entries."""
    return np.searchsorted(doc, np.arange(n + 1))


def lookup(sorted_keys, values):
    """Position of each value in ``sorted_keys``, -1 where it is absent."""
    if not len(sorted_keys):
        return np.full(len(values), -1, np.int64)
    at = np.searchsorted(sorted_keys, values)
    at[at == len(sorted_keys)] = 0
    return np.where(sorted_keys[at] == values, at, -1)


def column(batch: pa.RecordBatch, name: str):
    return batch.column(batch.schema.get_field_index(name))


def rows_of(batch: pa.RecordBatch):
    """Rows of a batch as dicts, one at a time: large binary values are not all copied at once."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]
