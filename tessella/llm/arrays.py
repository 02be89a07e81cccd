"""Vectorised text primitives over Arrow batches, shared by the operators of this subpackage.

Texts stay UTF-8 bytes in Arrow's own buffers; words, word hashes and shingle hashes are computed for
a whole slice of documents at once, so that Python's cost is per slice and not per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_LIBC = ctypes.CDLL(None) if hasattr(ctypes.CDLL(None), "malloc_trim") else None
#: Bytes whose word hashes are computed at once: what the tables of powers have to reach, but for a single longer word.
HASH_BYTES = 256 << 10

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True

_RADIX = 0x9E3779B97F4A7C15 | 1
_BYTE_CODE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def powers(radix: int, n: int) -> np.ndarray:
    """radix**0 .. radix**(n-1) modulo 2**64; 2 MB of them are kept."""
    have = _powers.get(radix)
    if have is None or len(have) < n:
        have = np.full(max(n, HASH_BYTES), radix, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) == HASH_BYTES:
            _powers[radix] = have
    return have[:n]


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, codes: np.ndarray = _BYTE_CODE, radix: int = _RADIX, lengths: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans ascend and don't overlap. Blocks bound the memory, whatever raw's length."""
    out, a, inverse = np.zeros(len(start), dtype=np.uint64), 0, pow(radix, -1, 1 << 64)
    while a < len(start):
        base = int(start[a])
        b = max(a + 1, int(np.searchsorted(end, base + HASH_BYTES - 1, side="right")))
        first, last = start[a:b] - base, end[a:b] - base
        n = int(last[-1])
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(codes[raw[base : base + n]] * powers(radix, n), out=total[1:])
        found = (total[last] - total[first]) * powers(inverse, n)[first]
        out[a:b] = mix(found + (last - first).astype(np.uint64) if lengths else found)
        a = b
    return out


def trimmed() -> None:
    """Give memory that a task has freed back to the system, where the C library can: workers live on between tasks."""
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (SplitMix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string array's UTF-8 bytes and its n + 1 offsets, starting at 0. Nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch so that each part holds about `limit` bytes of text (one longer document stays whole)."""
    if not batch.num_rows:
        return
    raw, offs = text_buffers(batch.column(batch.schema.get_field_index(text)))
    at, n = 0, batch.num_rows
    while at < n:
        to = min(n, max(at + 1, int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1))
        yield batch.slice(at, to - at), raw[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        at = to


class Words:
    """The words of a slice of documents: byte spans, owner document and a 64-bit hash of each."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray):
        self.low = low = LOWER[raw]
        n = len(low)
        inside = WORD[low]
        cut = np.zeros(n + 1, dtype=bool)
        cut[offs] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | cut[1:n]
        last[:-1] &= ~inside[1:] | cut[1:n]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.doc = np.searchsorted(offs, self.start, side="right") - 1
        self.per_doc = np.bincount(self.doc, minlength=len(offs) - 1)
        self.first = np.concatenate(([0], np.cumsum(self.per_doc)))  # of each document, among all words
        self.hash = span_hashes(low, self.start, self.end)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of first word, hash) of every run of `size` words within one document."""
        n = len(self.hash)
        if n < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.zeros(n - size + 1, dtype=np.uint64)
        for k in range(size):
            h *= np.uint64(_RADIX)
            h += self.hash[k : n - size + 1 + k]
        at = np.flatnonzero(self.doc[: n - size + 1] == self.doc[size - 1 :])
        return at, mix(h[at])

    def text(self, a: int, b: int) -> list[bytes]:
        return [self.low[self.start[i] : self.end[i]].tobytes() for i in range(a, b)]


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each (start, count), end to end."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(total)
