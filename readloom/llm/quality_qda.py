"""Quality scores by regularised quadratic discriminant analysis over transformed document statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features as ft
from . import textbatch as tb
from .sampling import bounded, fold, labelled


def statistics(c: np.ndarray) -> np.ndarray:
    """Shares on a logit scale, the rest as it is: nearer to a normal distribution."""
    x, names = ft.ratios(c)
    share = [k for k, name in enumerate(names) if name not in ("log_words", "word_length", "words_a_line", "distinct")]
    x[:, share] = np.log(np.clip(x[:, share], 1e-4, None)) - np.log1p(-np.clip(x[:, share], 0, 0.95))
    return x


class Discriminant:
    """One Gaussian a class. Covariances shrink towards the pooled one and it towards its diagonal; the Cholesky factors are kept."""

    def __init__(self, to_pooled: float = 0.2, to_diagonal: float = 0.1):
        self.to_pooled, self.to_diagonal = to_pooled, to_diagonal

    def fit(self, x: np.ndarray, y: np.ndarray) -> Discriminant:
        self.mean, self.std = x.mean(0), x.std(0) + 1e-6
        z = np.clip((x - self.mean) / self.std, -8, 8)
        parts = [z[y == k] for k in (0, 1)]
        cov = [np.cov(p.T) if len(p) > 1 else np.zeros((z.shape[1],) * 2) for p in parts]
        pooled = sum(len(p) * c for p, c in zip(parts, cov, strict=True)) / len(z)
        self.centre, self.root, self.logdet = [p.mean(0) for p in parts], [], []
        self.prior = [np.log(len(p) / len(z)) for p in parts]
        for c in cov:
            c = (1 - self.to_pooled) * c + self.to_pooled * pooled
            c = (1 - self.to_diagonal) * c + self.to_diagonal * np.diag(np.diag(pooled)) + 1e-3 * np.eye(len(c))
            factor = np.linalg.cholesky(c)
            self.logdet.append(2 * np.log(np.diag(factor)).sum())
            self.root.append(np.linalg.inv(factor))
        self.slope, self.shift = 1.0, 0.0
        self._calibrate(self.difference(x), y)
        return self

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density and prior of class 1 less those of class 0."""
        z = np.clip((x - self.mean) / self.std, -8, 8)
        log = [p - (((z - m) @ r.T) ** 2).sum(1) / 2 - d / 2 for p, m, r, d in zip(self.prior, self.centre, self.root, self.logdet, strict=True)]
        return log[1] - log[0]

    def _calibrate(self, s: np.ndarray, y: np.ndarray) -> None:
        """A slope and a shift on the log odds, by Newton steps: labels hold errors, so raw densities are too sure."""
        s = np.clip(s, -20, 20)
        a = np.array([0.3, 0.0])
        m = np.column_stack([s, np.ones(len(s))])
        for _ in range(50):
            p = 1 / (1 + np.exp(-m @ a))
            h = (m * (p * (1 - p))[:, None]).T @ m + 1e-3 * np.eye(2)
            step = np.linalg.solve(h, m.T @ (y - p))
            a = a + np.clip(step, -0.5, 0.5)
        self.slope, self.shift = max(float(a[0]), 0.02), float(a[1])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        s = np.clip(self.difference(x), -20, 20)
        return 1 / (1 + np.exp(-np.clip(self.slope * s + self.shift, -30, 30)))


class Share:
    def __init__(self, value: float):
        self.value = value

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def fit(x: np.ndarray, y: np.ndarray, **how):
    if len(y) < 20 or min((y == 0).sum(), (y == 1).sum()) < 2:
        return Share(float(y.mean()) if len(y) else 0.5)
    return Discriminant(**how).fit(x, y)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, buf, offs in tb.slices(b.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array(list(statistics(ft.counts(buf, offs))), pa.list_(pa.float64())), *(b.column(k).slice(lo, hi - lo) for k in (1, 2))], names=["x", "label", "key"])


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", mod: int = 4, held: int = 2, limit: int = 20000, **how):
    """Fit on at most `limit` labelled documents outside the held-out fold; equal texts count once, with their largest label.

    Without two rows of each label the score is the share of label 1, or 0.5 without any.
    """
    rows = bounded(labelled(docs, labels, column, limit, mod, held).select("text", "label", "key").mapInArrow(lambda batches: tb.tidy(_rows(batches)), "x array<double>, label int, key long"), limit)
    return fit(np.array([r.x for r in rows]).reshape(len(rows), -1) if rows else np.zeros((0, 1)), np.array([r.label for r in rows], float), **how)


def _score_batches(model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = np.zeros(b.num_rows)
        for lo, hi, buf, offs in tb.slices(b.column(1)):
            out[lo:hi] = model(statistics(ft.counts(buf, offs)))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out)], names=["doc_id", "score"])


def quality(docs: DataFrame, labels: DataFrame, limit: int = 20000, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; labels are learnt from rows with crc32(doc_id) mod 4 other than 2.

    A null text counts as empty and gets the score of its statistics, as every text does; repeated rows stay;
    an empty table gives an empty one; columns other than doc_id and text are not read.
    """
    model = train(docs, labels, limit=limit)
    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda batches: tb.tidy(_score_batches(model, batches)), "doc_id long, score double")
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
