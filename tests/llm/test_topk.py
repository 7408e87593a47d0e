"""Exact top-k against all scores."""

import math

import numpy as np
import pytest

from readloom.llm import topk


def brute(rows, k, every):
    v = [(i, [math.floor(64 * float(c)) for c in x]) for i, x in rows if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x)]
    out = []
    for a, (i, x) in enumerate(v):
        if i % every == 0:
            best = sorted((-sum(p * q for p, q in zip(x, y)), j) for b, (j, y) in enumerate(v) if b != a)[:k]  # noqa: B905
            out += [(i, n, j, -s) for n, (s, j) in enumerate(best, 1)]
    return sorted(out)


def got(spark, rows, k, every):
    df = spark.createDataFrame([(i, x, i, 0.5) for i, x in rows], "vec_id long, embedding array<float>, uid long, score double")
    return sorted(tuple(r) for r in topk.topk(df, k, every).collect())


@pytest.mark.parametrize(("block", "group"), [(2048, 16384), (16, 7)])
def test_against_all_scores(spark, monkeypatch, block, group):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "GROUP", group)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(k, [float(c) for c in np.float32(centres[k % 6] + 0.1 * rng.normal(size=8))]) for k in range(300)]
    rows += [(k, rows[7][1]) for k in range(300, 420)]  # ties
    rows += [(40, rows[9][1]), (40, rows[9][1]), (501, None), (502, [1.0, None]), (520, [float("nan")] * 8), (540, [float("inf")] * 8), (None, rows[0][1]), (560, []), (561, [5.0]), (580, [1e6, -2e6, 3e5])]
    assert got(spark, rows, 20, 20) == brute(rows, 20, 20)


def test_few_rows(spark):
    assert got(spark, [], 20, 20) == []
    assert got(spark, [(20, [1.0])], 20, 20) == []
    rows = [(0, [1.0, -1.0]), (1, [0.5, 0.5]), (2, [-1.0, -1.0])]
    assert got(spark, rows, 20, 20) == brute(rows, 20, 20)


def blocks_of(v, order, size):
    """Blocks as the tasks have them."""
    import pyarrow as pa

    rows = [pa.RecordBatch.from_arrays([pa.array(order), pa.array([[int(c) for c in v[i]] for i in order], pa.list_(pa.int64())), pa.array(order)], names=["vec_id", "v", "uid"])]
    return list(topk._blocks(iter(rows)))


@pytest.mark.parametrize("spread", [0.05, 0.2])
def test_most_blocks_of_clustered_vectors_are_skipped(monkeypatch, spread):
    """Over half of the pairs of a query and a block are never scored, and the result is that of all scores."""
    monkeypatch.setattr(topk, "BLOCK", 50)
    rng = np.random.default_rng(9)
    middles = rng.normal(size=(40, 16))
    middles /= np.linalg.norm(middles, axis=1)[:, None]
    v = np.floor(64 * (middles[np.arange(2000) % 40] + spread * rng.normal(size=(2000, 16)) / 4)).astype(np.int64)
    cell = topk.nearest(v.astype(float), topk.centres(v[rng.choice(2000, 500, replace=False)]))
    order = np.lexsort((np.arange(2000), cell)).tolist()
    q = np.arange(0, 2000, 20)
    task = topk._Search(topk.Group(q, q, v[q]), 20)
    list(topk._search(task, False, iter(blocks_of(v, order, 50))))
    assert task.pairs == 100 * 40 and task.scored < 0.5 * task.pairs
    by = v[q] @ v.T
    for n, i in enumerate(q):
        best = sorted((-s, j) for j, s in enumerate(by[n].tolist()) if j != i)[:20]
        assert list(zip((-task.score[n]).tolist(), task.id[n].tolist(), strict=True)) == best
    plain = topk._Search(topk.Group(q, q, v[q]), 20)
    list(topk._search(plain, False, iter(blocks_of(v, list(range(2000)), 50))))
    assert (plain.score == task.score).all() and (plain.id == task.id).all() and plain.scored > task.scored


def test_bounds_hold_for_every_vector():
    rng = np.random.default_rng(10)
    for scale in (1, 100, 1 << 22):
        m, q = (rng.normal(size=(60, 9)) * scale).astype(np.int64), (rng.normal(size=(30, 9)) * scale).astype(np.int64)
        task = topk._Search(topk.Group(np.arange(30), np.arange(30), q), 5)
        assert (task.bounds(m) >= (q @ m.T).max(1)).all()
