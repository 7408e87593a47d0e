"""Vectorised text work on Arrow batches: UTF-8 buffers in, numpy arrays out, no Python string per word.

A slice is some rows of a batch whose texts lie one after another in one byte
array. Nulls count as empty texts. Memory is in proportion to the slice, which
holds about `SLICE` bytes, or one whole text if that is longer.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
U64 = np.uint64

_rng = np.random.Generator(np.random.PCG64(20240607))
#: A random odd word for each byte, and powers of an odd base: the hash of a run is the sum of byte words times powers.
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_PERIOD = 1 << 20
_POWER = np.full(_PERIOD, 0x9E3779B97F4A7C15, np.uint64)
_POWER[0] = 1
_POWER = np.cumprod(_POWER, dtype=np.uint64)


def tidy(rows: Iterator) -> Iterator:
    """The same rows; when they end, memory that the worker no longer uses goes back to the system."""
    yield from rows
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def byte_table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(chars, np.uint8)] = True
    return out


#: Space and \x09-\x0D.
SPACE = byte_table(b"\x20\x09\x0a\x0b\x0c\x0d")
NEWLINE = byte_table(b"\n")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that go on a code point.
CONT = np.zeros(256, bool)
CONT[0x80:0xC0] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets into them, one more than rows) for each slice of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and column.buffers()[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        hi = min(hi, len(column), lo + 20000)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


@dataclass
class Runs:
    """Maximal runs of bytes outside a set; none goes over the end of its text."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    #: Runs of each text lie in [first[d], first[d + 1]).
    first: np.ndarray

    @property
    def n(self) -> int:
        return len(self.start)


def runs(buf: np.ndarray, offs: np.ndarray, apart: np.ndarray) -> Runs:
    inside = ~apart[buf]
    n = len(buf)
    edge = np.zeros(n + 1, np.int8)
    edge[:n] = inside
    edge[1:] -= inside
    at = offs[1:-1]
    at = at[(at > 0) & (at < n)]
    at = at[inside[at] & inside[at - 1]]  # a run that goes over a text's end is two runs
    start = np.flatnonzero(edge[:n] == 1)
    end = np.flatnonzero(edge == -1)
    if len(at):
        start = np.sort(np.concatenate([start, np.unique(at)]))
        end = np.sort(np.concatenate([end, np.unique(at)]))
    first = np.searchsorted(start, offs)
    return Runs(start, end, np.repeat(np.arange(len(offs) - 1), np.diff(first)), first)


def run_hash(buf: np.ndarray, r: Runs, fold: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of the bytes of each run (through the byte map `fold`)."""
    if not r.n:
        return np.zeros(0, np.uint64)
    size = r.end - r.start
    before = np.cumsum(size) - size
    step = np.arange(int(size.sum())) - np.repeat(before, size)
    values = (_BYTE if fold is None else _BYTE[fold])[buf[step + np.repeat(r.start, size)]]
    values *= _POWER[step & (_PERIOD - 1)]
    return mix(np.add.reduceat(values, before) + size.astype(np.uint64))


def word_hash(word: str) -> int:
    """What run_hash gives for this word."""
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(run_hash(raw, Runs(np.array([0]), np.array([len(raw)]), np.array([0]), np.array([0, 1])))[0])


def hash_set(words) -> np.ndarray:
    return np.sort(np.array([word_hash(w) for w in set(words)], np.uint64))


def member(h: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which of h are in the sorted array."""
    if not len(among) or not len(h):
        return np.zeros(len(h), bool)
    at = np.searchsorted(among, h)
    at[at == len(among)] = 0
    return among[at] == h


def windows(h: np.ndarray, r: Runs, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive runs of one text, and the index of the first run of each."""
    if r.n < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(r.doc[: r.n - n + 1] == r.doc[n - 1 :])
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = out * U64(0xD6E8FEB86659FD93) + h[at + k]
    return mix(out), at


def per_doc(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of values[offs[d]:offs[d + 1]]."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offs[1:]] - total[offs[:-1]]


def per_doc_u64(values: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Sums modulo 2 ** 64 of values[bound[d]:bound[d + 1]]."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[bound[1:]] - total[bound[:-1]]


def repeated(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which keys occur twice or more in their text, which are no first occurrence in it)."""
    both = mix(key + (doc.astype(np.uint64) + U64(1)) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(both, kind="stable")
    same = both[order][1:] == both[order][:-1]
    twice, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:][same]] = True
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice, later
