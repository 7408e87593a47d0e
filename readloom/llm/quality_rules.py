"""Quality rules: an isolation forest on rule statistics, with its threshold set from labelled rows.

All labelled rows are learnt from. Their statistics are a table; ranges and thresholds are exact quantiles of it, and only
they and the subsamples that the forest's trees take come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features as ft
from . import textbatch as tb
from .ranks import matrix, quantiles
from .store import cut

#: The statistics that the forest sees; the length of a text is none of them.
RULES = ["word_length", "symbols", "symbol_words", "pipes", "dup_lines", "repeat_words", "upper", "digits", "punct", "distinct", "no_alpha_words", "long_words"]
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_BASE_AT = [ft.COUNTS.index(x) for x in BASE]


def rule_statistics(c: np.ndarray) -> np.ndarray:
    x, names = ft.ratios(c)
    return x[:, [names.index(r) for r in RULES]]


class Excess:
    """How far each rule statistic lies outside the range of 96 % of the good rows, on a log scale: 0 inside it."""

    #: Shares of the good rows below the range, below its middle and up to its end.
    SHARES = (0.02, 0.5, 0.98)

    def fit(self, x: np.ndarray) -> Excess:
        return self.of(np.quantile(x, self.SHARES, axis=0))

    def of(self, quantiles: np.ndarray) -> Excess:
        self.low, self.mid, self.high = quantiles
        return self

    def __call__(self, x: np.ndarray) -> np.ndarray:
        over = (x - self.high) / (self.high - self.mid + 1e-3)
        under = (self.low - x) / (self.mid - self.low + 1e-3)
        return np.log1p(np.maximum(0, np.maximum(over, under)))


def _mean_path(n: float) -> float:
    """Mean depth of an unsuccessful search in a random tree of n rows."""
    return 0.0 if n <= 1 else 1.0 if n <= 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


class Forest:
    """Isolation forest: random splits over subsamples; short paths are anomalous. Trees are flat arrays.

    A split lies anywhere up to a width beyond the rows of its node (that of the rows, 1 at least), so that a text
    beyond all rows of the sample is cut off sooner than the oddest of them.
    """

    def __init__(self, trees: int = 100, sample: int = 256, seed: int = 11):
        self.trees, self.sample, self.seed = trees, sample, seed

    def fit(self, x: np.ndarray) -> Forest:
        rng = np.random.Generator(np.random.PCG64(self.seed))
        size = min(self.sample, len(x))
        return self._grow(rng, size, (x[rng.choice(len(x), size, replace=False)] for _ in range(self.trees)))

    def of(self, samples: list[np.ndarray]) -> Forest:
        """A tree for each subsample, all of one size."""
        return self._grow(np.random.Generator(np.random.PCG64(self.seed)), len(samples[0]), samples)

    def _grow(self, rng: np.random.Generator, size: int, samples: Iterable[np.ndarray]) -> Forest:
        self.depth = max(1, int(np.ceil(np.log2(max(2, size)))))
        self.scale, self.at = max(_mean_path(size), 1e-9), []
        for x in samples:
            nodes = 2 ** (self.depth + 1)
            feature, cut, path = np.zeros(nodes, np.int64), np.full(nodes, np.nan), np.zeros(nodes)
            todo = [(1, np.arange(len(x)), 0)]
            while todo:
                k, rows, depth = todo.pop()
                path[k] = depth + _mean_path(len(rows))
                if depth >= self.depth or len(rows) <= 1:
                    continue
                j = rng.integers(x.shape[1])
                part = x[rows, j]
                lo, hi = part.min(), part.max()
                feature[k], cut[k] = j, rng.uniform(lo, hi + max(hi - lo, 1.0))
                left = part <= cut[k]
                todo += [(2 * k, rows[left], depth + 1), (2 * k + 1, rows[~left], depth + 1)]
            self.at.append((feature, cut, path))
        return self

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """2 to the power of minus the mean path over the expected one: 0 to 1, higher is odder."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, path in self.at:
            node = np.ones(len(x), np.int64)
            for _ in range(self.depth):
                c = cut[node]
                go = ~np.isnan(c)
                node = np.where(go, 2 * node + (x[rows, feature[node]] > c), node)
            total += path[node]
        return 2.0 ** (-(total / len(self.at)) / self.scale)


class Verdict:
    """Keeps a text unless its anomaly is over the threshold."""

    def __init__(self, excess: Excess | None, forest: Forest | None, threshold: float):
        self.excess, self.forest, self.threshold = excess, forest, threshold

    def anomaly(self, c: np.ndarray) -> np.ndarray:
        return np.zeros(len(c)) if self.forest is None or not len(c) else self.forest.anomaly(self.excess(rule_statistics(c)))


#: Shares of the good rows that cuts leave, of those above 1 - max_false, and of the bad rows.
_TOP, _BOTTOM, _SLIGHT = np.linspace(0, 1, 200), np.linspace(0, 0.02, 40), 1e-9


def _cuts(top: np.ndarray, bottom: np.ndarray, most: float) -> np.ndarray:
    """From quantiles of good and of bad rows and the largest anomaly; none under the first of the good ones."""
    cuts = np.unique([*top, *(bottom - _SLIGHT), most + _SLIGHT])
    return cuts[cuts >= top[0]]


def _best(cuts: np.ndarray, good_over: np.ndarray, bad_over: np.ndarray, slack: float) -> float:
    gain = bad_over - good_over
    return float(cuts[np.flatnonzero(gain >= gain.max() - slack)[-1]])


def calibrate(c: np.ndarray, good: np.ndarray, max_false: float = 0.002, slack: float = 0.005) -> Verdict:
    """Forest over the rows labelled good that pass the base rules, and a threshold that rejects at most a share `max_false` of them.

    Of such cuts it takes the highest whose gain (share of bad rows rejected less that of good ones) is within
    `slack` of the best, and goes halfway down to the oddest good row below. Without both labels nothing is rejected.
    """
    fine = ~base_failed(c)
    c, good = c[fine], good[fine]
    if good.sum() < 20 or good.all():
        return Verdict(None, None, 1.0)
    x = rule_statistics(c)
    excess = Excess().fit(x[good])
    forest = Forest().fit(excess(x[good]))
    a = forest.anomaly(excess(x))
    cuts = _cuts(np.quantile(a[good], 1 - max_false + max_false * _TOP), np.quantile(a[~good], _BOTTOM), a.max())
    best = _best(cuts, *(np.array([(a[of] > t).mean() for t in cuts]) for of in (good, ~good)), slack)
    return Verdict(excess, forest, float((best + a[good & (a <= best)].max()) / 2))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id, key and rule statistics of the texts that pass the base rules."""
    for b in batches:
        for lo, hi, buf, offs in tb.slices(b.column(0)):
            c = ft.counts(buf, offs)
            fine = np.flatnonzero(~base_failed(c))
            yield pa.RecordBatch.from_arrays([*(b.column(k).slice(lo, hi - lo).take(pa.array(fine)) for k in (1, 2)), pa.array(list(rule_statistics(c[fine])), pa.list_(pa.float64()))], names=["id", "key", "x"])


def _labelled(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """key, x and label of every labelled text that passes the base rules: equal texts once, with their largest label. Null ids and labels take no part."""
    known = labels.select(F.col("doc_id").alias("__id"), (F.col(column) == 1).cast("int").alias("label")).where("__id is not null and label is not null")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.where("doc_id is not null").select(text.alias("text"), F.col("doc_id").alias("id"), F.xxhash64(F.lit(11), text).alias("key"))
    x = rows.mapInArrow(lambda batches: tb.tidy(_statistics(batches)), f"id {rows.schema['id'].dataType.simpleString()}, key long, x array<double>")
    rows = x.join(known.groupBy("__id").agg(F.max("label").alias("label")), F.col("id") == F.col("__id"))
    return rows.groupBy("key").agg(F.any_value("x").alias("x"), F.max("label").alias("label"))


def _draw(key: np.ndarray, tree: int) -> np.ndarray:
    """Of each key a random number of a tree's."""
    return tb.mix(key.astype(np.int64).view(np.uint64) ^ tb.mix(np.array([tree + 1], np.uint64)))


def _drawn(trees: int, below: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        key = b.column(0).to_numpy()
        some = np.zeros(len(key), bool)
        for tree in range(trees):
            some |= _draw(key, tree) <= np.uint64(below)
        yield b.filter(pa.array(some))


def subsamples(rows: DataFrame, n: int, trees: int, size: int) -> list[np.ndarray]:
    """x of `size` of the n rows (key, x) for each tree: those with its smallest draws. What comes to the driver does not grow with n."""
    share = 1.5 * size + 64
    while True:
        below = min((1 << 64) - 1, int(share / n * 2.0**64))
        got = rows.select("key", "x").mapInArrow(lambda b: tb.tidy(_drawn(trees, below, b)), "key long, x array<double>").orderBy("key").toArrow().combine_chunks()
        key, x = got["key"].to_numpy(), np.array(got["x"].to_pylist(), float)
        draws = [_draw(key, tree) for tree in range(trees)]
        if below == (1 << 64) - 1 or all((d <= np.uint64(below)).sum() >= size for d in draws):
            return [x[np.argsort(d, kind="stable")[:size]] for d in draws]
        share *= 2


def _anomalies(verdict: Verdict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        a = verdict.forest.anomaly(verdict.excess(matrix(b.column(0), len(RULES))))
        yield pa.RecordBatch.from_arrays([pa.array(a[:, None].tolist(), pa.list_(pa.float64())), b.column(1)], names=["x", "label"])


def _over(cuts: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many rows of each label lie over so many cuts."""
    for b in batches:
        code, n = np.unique(np.searchsorted(cuts, matrix(b.column(0), 1)[:, 0], "left") * 2 + b.column(1).to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(code % 2), pa.array(code // 2), pa.array(n)], names=["label", "at", "n"])


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", max_false: float = 0.002, slack: float = 0.005) -> Verdict:
    """`calibrate` on all labelled documents, as tables; equal texts count once, with their largest label. Runs jobs: statistics and anomalies are written."""
    rows = cut(_labelled(docs, labels, column), "rule_statistics")
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_bad, n_good = (sizes.get(k, 0) for k in (0, 1))
    if n_good < 20 or not n_bad:
        return Verdict(None, None, 1.0)
    good, forest = rows.where("label = 1"), Forest()
    excess = Excess().of(np.array(quantiles(good, n_good, [np.array(Excess.SHARES)] * len(RULES))).T)
    forest.of([excess(x) for x in subsamples(good, n_good, forest.trees, min(forest.sample, n_good))])
    verdict = Verdict(excess, forest, 1.0)
    a = cut(rows.select("x", "label").mapInArrow(lambda batches: tb.tidy(_anomalies(verdict, batches)), "x array<double>, label int"), "anomalies")
    top, bottom = (quantiles(a.where(f"label = {k}"), n, [q])[0] for k, n, q in ((1, n_good, 1 - max_false + max_false * _TOP), (0, n_bad, _BOTTOM)))
    value = F.get("x", F.lit(0))
    cuts = _cuts(top, bottom, a.agg(F.max(value).alias("m")).first().m)
    over = np.zeros((2, len(cuts) + 1))
    for r in a.mapInArrow(lambda batches: tb.tidy(_over(cuts, batches)), "label long, at long, n long").groupBy("label", "at").agg(F.sum("n").alias("n")).collect():
        over[r.label, r.at] = r.n
    over = np.cumsum(over[:, ::-1], 1)[:, ::-1][:, 1:]
    best = _best(cuts, over[1] / n_good, over[0] / n_bad, slack)
    below = a.where((F.col("label") == 1) & (value <= best)).agg(F.max(value).alias("m")).first().m
    return Verdict(excess, forest, float((best + below) / 2))


def base_failed(c: np.ndarray) -> np.ndarray:
    words, repeat = c[:, ft.COUNTS.index("n_words")], c[:, ft.COUNTS.index("n_repeat_words")]
    return (words < 50) | (100 * repeat > 50 * words)


def _judge_batches(verdict: Verdict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column(b.num_columns - 1)
        c, anomaly = np.zeros((b.num_rows, len(ft.COUNTS)), np.int64), np.zeros(b.num_rows)
        for lo, hi, buf, offs in tb.slices(texts):
            c[lo:hi] = ft.counts(buf, offs)
            anomaly[lo:hi] = verdict.anomaly(c[lo:hi])
        failed = base_failed(c)
        kept = ~failed & (anomaly <= verdict.threshold)
        added = [*(pa.array(c[:, k]) for k in _BASE_AT), pa.array(failed), pa.array(kept), pa.array(anomaly)]
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), *added], names=[*b.schema.names[:-1], *(f"__{k}" for k in range(len(added)))])


def judge(docs: DataFrame, verdict: Verdict) -> DataFrame:
    """The columns of docs as k0, k1, ..., then the five base counts, base_failed, kept and anomaly as __0 to __7.

    A null text has no words, so it fails the base rules like any text under 50 words. Repeated rows are judged
    alike, row by row; an empty table gives an empty one; other columns have no part.
    """
    kept = docs.toDF(*(f"k{n}" for n in range(len(docs.columns))))
    rows = kept.withColumn("text", F.col(f"k{docs.columns.index('text')}"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields)
    return rows.mapInArrow(lambda batches: tb.tidy(_judge_batches(verdict, batches)), schema + ", __0 long, __1 long, __2 long, __3 long, __4 long, __5 boolean, __6 boolean, __7 double")


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and anomaly of every document."""
    out = judge(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), train(docs, labels))
    return out.drop("k1").toDF("doc_id", *BASE, "base_failed", "kept", "anomaly")


def reject_anomalous(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, that the rules keep.

    Null and empty texts have no words and go, as all under 50 words do. Repeated rows stay or go together. Long texts are
    counted whole. Any column names may be there; only text is read. An empty table gives an empty one; without labels of both
    kinds only the base rules decide.
    """
    out = judge(docs, train(docs, labels)).where("__6")
    return out.select(*(f"k{n}" for n in range(len(docs.columns)))).toDF(*docs.columns)
