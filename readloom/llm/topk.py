"""Exact top-k by inner product, block at a time.

Vectors become whole numbers floor(64 * x). They are ordered so that like ones stand together: by the nearest of some centres, which
come from a bounded sample, then by vec_id. Blocks are ranges of this order with a forward index (a matrix) and each dimension's
largest and smallest value: the terms' maxima. For a query, the sum over dimensions of the larger of q * max and q * min bounds every
score in a block; so does its product with the block's middle plus its length times the block's radius. The smaller of both counts. A
task goes through its blocks in order of their bounds and scores a block for the queries whose bound reaches their
threshold: the k-th best score so far, or the one found over the first blocks of all tasks. Scores equal to the threshold
stay, as a smaller vec_id may win the tie. Which centres there are changes how much is skipped, and no result.

Queries come in groups of bounded size, each sent to all blocks; the blocks stay where they are, a bounded number in a task. For the
threshold a task answers with few scores a query, the fewer the more tasks there are; then with those that reach it, k a query at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textbatch as tb
from .store import cut

SCALE, K, EVERY = 64, 20, 20
#: Vectors in a block, and queries in a group (with 64 dimensions a group is 8 MB).
BLOCK, GROUP = 2048, 16384
#: Blocks of one task, vectors of the sample that centres are fitted on, centres, and rounds of fitting them.
BLOCKS_A_TASK, SAMPLE, CENTRES, ROUNDS = 64, 4096, 64, 5


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id and v, an array of longs; vectors that are null or hold a null, NaN or infinite component are out, and so are null ids."""
    parts = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.col("vec_id").isNotNull() & F.forall(parts, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(parts, lambda c: F.floor(c * SCALE)).alias("v"))


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest type that holds them."""
    lo, hi = int(x.min(initial=0)), int(x.max(initial=0))
    return x.astype(next(t for t in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(t).min <= lo and hi <= np.iinfo(t).max))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one partition, which is sorted by vec_id: row numbers, ids, numbers of components, bytes and values of components."""

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        v = t["v"].combine_chunks()
        flat = _narrow(v.flatten().to_numpy())
        columns = (t["uid"].to_numpy().astype("<i8"), t["vec_id"].to_numpy().astype("<i8"), np.diff(v.offsets.to_numpy()).astype("<i4"))
        return pa.RecordBatch.from_arrays([*(pa.array([x.tobytes()], pa.binary()) for x in columns), pa.array([flat.itemsize], pa.int32()), pa.array([flat.tobytes()], pa.binary())], names=["uids", "ids", "size", "width", "flat"])

    held, n = [], 0
    for b in batches:
        while b.num_rows:
            part = b.slice(0, BLOCK - n)
            held.append(part)
            n += part.num_rows
            b = b.slice(part.num_rows)
            if n == BLOCK:
                yield block(held)
                held, n = [], 0
    if n:
        yield block(held)


_BLOCK_SCHEMA = "uids binary, ids binary, size binary, width int, flat binary"


def dense(size: np.ndarray, flat: np.ndarray, width: int) -> np.ndarray:
    """A matrix of `width` columns: missing components are 0, those beyond are cut (the other side has none there)."""
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    inside = col < width
    out[row[inside], col[inside]] = flat[inside]
    return out


def centres(v: np.ndarray) -> np.ndarray:
    """Middles of groups of like vectors of a sample."""
    rng = np.random.Generator(np.random.PCG64(3))
    v = v.astype(np.float64)
    c = v[np.sort(rng.choice(len(v), min(CENTRES, len(v)), replace=False))]
    for _ in range(ROUNDS):
        of = nearest(v, c)
        c = np.stack([v[of == k].mean(0) if (of == k).any() else c[k] for k in range(len(c))])
    return c


def nearest(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (v @ c.T - (c * c).sum(1) / 2).argmax(1)


def _with_cells(c: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        v = b.column("v")
        v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
        offsets = v.offsets.to_numpy()
        cell = nearest(dense(np.diff(offsets), v.flatten().to_numpy(), c.shape[1]).astype(np.float64), c) if b.num_rows else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32))], names=[*b.schema.names, "cell"])


def product(q: np.ndarray, b: np.ndarray) -> np.ndarray:
    """q @ b.T in whole numbers: by floating point as far as that is exact, else modulo 2 ** 64."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, q.shape[1])
    if most < 1 << 24:
        return (q.astype(np.float32) @ b.T.astype(np.float32)).astype(np.int64)
    if most < 1 << 53:
        return (q.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return q @ b.T


NEVER, LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class Group:
    """Queries of one group: their row numbers, ids, vectors, and a score that k candidates of each are known to reach."""

    def __init__(self, uid: np.ndarray, ids: np.ndarray, q: np.ndarray):
        self.uid, self.ids, self.q, self.floor = uid, ids, q, np.full(len(ids), NEVER)


class _Search:
    """Best k of every query of a group, over the blocks of one task."""

    def __init__(self, group: Group, k: int):
        self.group, self.k = group, k
        self.score, self.id = np.full((len(group.ids), k), NEVER), np.full((len(group.ids), k), LAST)
        self.positive, self.negative = np.maximum(group.q, 0), np.minimum(group.q, 0)
        self.length = np.sqrt((group.q.astype(np.float64) ** 2).sum(1))
        #: Pairs of a query and a block that were scored, and all of them.
        self.scored = self.pairs = 0

    def bounds(self, m: np.ndarray) -> np.ndarray:
        """Of each query: no vector of the block scores more."""
        by_terms = product(self.positive, m.max(0)[None])[:, 0] + product(self.negative, m.min(0)[None])[:, 0]
        if np.abs(m).max(initial=0) >= 1 << 20 or np.abs(self.group.q).max(initial=0) >= 1 << 20:
            return by_terms  # floating point would have to be exact further
        middle = m.mean(0)
        radius = np.sqrt(((m - middle) ** 2).sum(1).max())
        by_middle = self.group.q @ middle + self.length * radius
        return np.minimum(by_terms, np.ceil(by_middle + 1e-9 * np.abs(by_middle) + 1).astype(np.int64))

    def reach(self) -> np.ndarray:
        return np.maximum(self.group.floor, self.score[:, -1])

    def score_block(self, uids: np.ndarray, ids: np.ndarray, m: np.ndarray, rows: np.ndarray) -> None:
        for lo in range(0, len(rows), 512):
            some = rows[lo : lo + 512]
            s = product(self.group.q[some], m)
            fit = (s >= self.reach()[some][:, None]) & (uids[None] != self.group.uid[some][:, None])
            for r in np.flatnonzero(fit.any(1)):
                a, at = some[r], np.flatnonzero(fit[r])
                score, ident = np.concatenate([self.score[a], s[r, at]]), np.concatenate([self.id[a], ids[at]])
                best = np.lexsort((ident, -np.maximum(score, NEVER + 1)))[: self.k]
                self.score[a], self.id[a] = score[best], ident[best]


def _search(task: _Search, first_only: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """uid and id of a query, vec_id, score: the best of the task's blocks; with first_only, of the block with the best bound."""
    group, held, bound = task.group, [], []
    for b in batches:
        for uids, ids, size, width, flat in zip(*(b.column(c).to_pylist() for c in range(5)), strict=True):
            held.append((np.frombuffer(uids, "<i8"), np.frombuffer(ids, "<i8"), np.frombuffer(size, "<i4"), np.frombuffer(flat, f"<i{width}")))
            bound.append(task.bounds(dense(*held[-1][2:], group.q.shape[1])))
    if held:
        bound = np.stack(bound)
        task.pairs += bound.size
        order = np.argsort(-np.maximum(bound, NEVER + 1), 0, kind="stable")
        for turn in order[: 1 if first_only else len(held)]:
            for j in np.unique(turn):
                rows = np.flatnonzero((turn == j) & (bound[j] >= task.reach()))
                if len(rows):
                    task.scored += len(rows)
                    uids, ids, size, flat = held[j]
                    task.score_block(uids, ids, dense(size, flat, group.q.shape[1]), rows)
    row, place = np.nonzero((task.id != LAST) | (task.score != NEVER))
    yield pa.RecordBatch.from_arrays([pa.array(group.uid[row]), pa.array(group.ids[row]), pa.array(task.id[row, place]), pa.array(task.score[row, place])], names=["uid", "query_id", "vec_id", "score"])


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best k of each query; a task gives k rows a query at most, so a window holds k times the tasks."""
    rank = F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def topk(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: of every row whose vec_id is divisible by `every`, the k best of the other rows.

    Ties go to the smaller vec_id. Vectors that are null, or hold null or non-finite components, and rows without a
    vec_id take no part. Rows of one vec_id are rows of their own: each is a query, and a candidate of the others.
    Of two lengths the shorter vector counts as followed by zeros. With fewer other rows than k all of them are
    given, so one row alone and an empty table give none. Scores beyond 64 bits wrap. Other columns are not read. Runs jobs: the
    search is done when this returns. A group of queries and one score of each come to the driver at a time.
    """
    spark = vectors.sparkSession
    rows = cut(whole_numbers(vectors).withColumn("uid", F.monotonically_increasing_id()), "vectors")
    schema, out = "uid long, query_id long, vec_id long, score long", spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sample = rows.orderBy(F.xxhash64("vec_id", "uid"), "uid").limit(SAMPLE).collect()
    if not sample:
        return out
    size = np.array([len(r.v) for r in sample])
    like = centres(dense(size, np.array([c for r in sample for c in r.v], np.int64), max(1, int(size.max()))))
    ordered = rows.mapInArrow(lambda b: tb.tidy(_with_cells(like, b)), "vec_id long, v array<bigint>, uid long, cell int")
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-rows.count() // (BLOCK * BLOCKS_A_TASK)))
    order = ("cell", "vec_id", "uid")
    blocks = cut(ordered.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(lambda b: tb.tidy(_blocks(b)), _BLOCK_SCHEMA), "blocks")
    tasks = blocks.rdd.getNumPartitions()
    few = min(k, 2 * k // max(1, tasks) + 2)  # the best k of all tasks have hardly more than so many from one task
    queries = cut(rows.where(F.col("vec_id") % every == 0), "queries")
    groups = -(-queries.count() // GROUP)
    for g in range(groups):
        got = queries.where(F.pmod(F.xxhash64("uid"), F.lit(groups)) == g).orderBy("uid").collect()
        size = np.array([len(r.v) for r in got])
        flat = np.array([c for r in got for c in r.v], np.int64)
        group = Group(np.array([r.uid for r in got], np.int64), np.array([r.vec_id for r in got], np.int64), dense(size, flat, int(size.max(initial=0))))
        first = blocks.mapInArrow(lambda b, group=group: tb.tidy(_search(_Search(group, few), True, b)), schema)
        place = {u: n for n, u in enumerate(group.uid.tolist())}
        for r in _ranked(first, k).where(F.col("rank") == k).select("uid", "score").collect():
            group.floor[place[r.uid]] = r.score
        found = cut(blocks.mapInArrow(lambda b, group=group: tb.tidy(_search(_Search(group, k), False, b)), schema), "found")
        out = out.unionByName(_ranked(found, k).select("query_id", "rank", "vec_id", "score"))
    return out
