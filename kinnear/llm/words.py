"""Words of whole Arrow text columns, found and hashed with numpy.

A batch's texts lie one after another in one byte buffer; word boundaries,
hashes and per-document sums are array operations over that buffer, so no
Python code runs per word.  Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at a time; one longer document is handled alone.
CHUNK_BYTES = 2 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Word bytes of ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False

#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing A-Z).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = True
ALNUM[97:123] = True
ALNUM[128:] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column as large strings with nulls as empty texts."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(name)).cast(pa.large_string()), "")


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): text ``i`` is ``bytes[offsets[i]:offsets[i + 1]]``."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, name: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in row slices of about ``limit`` text bytes."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(name))), 0)
                     .to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < batch.num_rows:
        before = ends[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(row, end - row)
        row = end


def spans(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): word byte ranges; document i's words are ``first[i]:first[i + 1]``."""
    inside = word[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    cut = offsets[(offsets > 0) & (offsets < len(data))]  # a document's edge ends a word
    before[cut] = False
    after[cut - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _powers(base: np.uint64, n: int, kept: dict = {}) -> np.ndarray:  # noqa: B006
    """base**0 .. base**(n - 1); the longest so far up to 2 chunks is kept in the worker."""
    known = kept.get(int(base))
    if known is None or len(known) < n:
        known = np.full(n, base, np.uint64)
        known[0] = 1
        np.cumprod(known, out=known)
        if n <= 2 * CHUNK_BYTES:
            kept[int(base)] = known
    return known[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte range, from one polynomial prefix sum."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * _powers(_ODD, len(data) + 1)[:-1], out=total[1:])
    back = _powers(_INV, len(data) + 1)
    return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64) * _TABLE[0])


def gram_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): hashes of every ``size`` consecutive words inside a document."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(len(first), np.int64)
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = mix(h * _ODD + words[i:i + n])
    lengths = np.diff(first)
    counts = np.maximum(lengths - size + 1, 0)
    out = np.concatenate([[0], np.cumsum(counts)])
    where = np.repeat(first[:-1] - out[:-1], counts) + np.arange(out[-1])
    return h[where], out


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[i]:first[i + 1]]``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]
