"""Exact quantiles of columns of any length: radix selection in passes that count, with a bound on what comes to the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbatch as tb

#: Bits that a pass settles, and numbers among which all bits left are settled at once.
DIGIT, FEW = 10, 1 << 18
U64 = np.uint64


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _bits(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of x."""
    b = np.ascontiguousarray(x + 0.0).view(U64)
    return b ^ np.where(b >> U64(63) == 1, ~U64(0), U64(1 << 63))


def _digits(live: list[np.ndarray], used: int, step: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each column the numbers whose first `used` bits are live: for each of their next bits how many, the least and the largest."""
    for b in batches:
        if not b.num_rows:
            continue
        x, parts = matrix(b.column(0), len(live)), []
        for j, prefixes in enumerate(live):
            if not len(prefixes):
                continue
            v = np.sort(x[:, j])
            bits = _bits(v)
            if used:
                head = bits >> U64(64 - used)
                here = prefixes[np.minimum(np.searchsorted(prefixes, head), len(prefixes) - 1)] == head
                v, bits = v[here], bits[here]
            if len(v):
                head = bits >> U64(64 - used - step)
                first = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]]))
                last = np.append(first[1:], len(v)) - 1
                parts.append((np.full(len(first), j), head[first].view(np.int64), last - first + 1, v[first], v[last]))
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names=["j", "head", "n", "lo", "hi"])


def order_statistics(rows: DataFrame, n: int, ranks: list[list[int]]) -> list[dict[int, float]]:
    """Of each column of x (array<double>, no nulls or NaN; n rows) the numbers at these places, from 0, in order of size."""
    found: list[dict[int, float]] = [{} for _ in ranks]
    #: Of each column, by the bits that are settled: how many numbers have them, and (place wanted, place among these).
    live = [{0: (n, [(r, r) for r in sorted(set(some))])} if some else {} for some in ranks]
    used = 0
    while any(live):
        step = 64 - used if sum(m for p in live for m, _ in p.values()) <= FEW else min(DIGIT, 64 - used)
        heads = [np.array(sorted(p), U64) for p in live]
        counted = rows.select("x").mapInArrow(lambda b, heads=heads, used=used, step=step: tb.tidy(_digits(heads, used, step, b)), "j long, head long, n long, lo double, hi double")
        got = counted.groupBy("j", "head").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).toArrow()
        j, head, count, lo, hi = (got[c].to_numpy() for c in ("j", "head", "n", "lo", "hi"))
        head = head.astype(np.int64).view(U64)
        after: list[dict] = [{} for _ in ranks]
        for k, prefixes in enumerate(live):
            own = np.flatnonzero(j == k)
            own = own[np.argsort(lo[own], kind="stable")]
            before = head[own] >> U64(step) if used else np.zeros(len(own), U64)
            for prefix, (_, wanted) in prefixes.items():
                at = own[before == U64(prefix)]
                ends = np.cumsum(count[at])
                for rank, place in wanted:
                    i = int(np.searchsorted(ends, place, "right"))
                    if lo[at[i]] == hi[at[i]]:
                        found[k][rank] = float(lo[at[i]])
                    else:
                        after[k].setdefault(int(head[at[i]]), (int(count[at[i]]), []))[1].append((rank, place - int(ends[i] - count[at[i]])))
        live, used = after, used + step
    return found


def quantiles(rows: DataFrame, n: int, shares: list[np.ndarray]) -> list[np.ndarray]:
    """np.quantile of each column of x at its shares."""
    at = [np.asarray(q, float) * (n - 1) for q in shares]
    low = [np.floor(a).astype(int) for a in at]
    found = order_statistics(rows, n, [[*k.tolist(), *np.minimum(k + 1, n - 1).tolist()] for k in low])
    out = []
    for a, k, v in zip(at, low, found, strict=True):
        lo, hi = (np.array([v[r] for r in m.tolist()]) for m in (k, np.minimum(k + 1, n - 1)))
        out.append(lo + (hi - lo) * (a - k))
    return out
