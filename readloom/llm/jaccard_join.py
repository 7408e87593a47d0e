"""N-gram Jaccard join by chosen paths: documents whose sets of five-word shingles are alike to 0.8 or more.

1. Every document gets its shingle set's size, a 128-bit sum of it and 32 minwise samples (a sampled token each).
   Documents of one set are one class representative from here on.
2. Chosen paths: each of RUNS runs puts a set in the bucket of one sampled token. Two sets of similarity s share the
   bucket of a run with probability s, so all runs miss a pair of 0.8 with 0.2 ** RUNS = 2.6e-6. A bucket of more than
   LEAF sets is split again by FAN further tokens, at most DEPTH times; a set goes on with each of them.
3. A pair counts in one place only: where it shares a token, if it shared none of the tokens tried before at that
   fork. So degrees add up over buckets without any list of pairs, and buckets whose sets all met before are dropped.
4. Buckets are cut into tiles of at most two blocks of BLOCK sets, whatever their size. In a tile, pairs that agree in
   fewer than AGREE of the 32 samples are left out (a pair of 0.8 does so with probability 1e-9); sets with a pair
   left get their shingles, and the pairs left are compared exactly.
5. A tile gives each set its number of partners and the root of its tree in the tile: no more rows than sets. Classes
   are the connected components of these trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbatch as tb
from .store import cut

SHINGLE, SAMPLES, AGREE = 5, 32, 10
LEAF, FAN, DEPTH, BLOCK = 4000, 6, 2, 512
#: Similarity as a fraction, for exact comparison in integers.
NUMERATOR, DENOMINATOR = 4, 5
#: Runs are repeated until all of them miss a pair of just that similarity with no more than this probability.
MISS = 1e-5
RUNS = math.ceil(math.log(MISS) / math.log(1 - NUMERATOR / DENOMINATOR))
#: Bits for each candidate set of the filter that picks candidates in the second scan, and its bits at least and at most: 128 MB
#: at the driver and at each worker. Beyond, it lets more through, which the join after it takes out.
BITS_A_SET, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 30

_A = np.random.Generator(np.random.PCG64(77)).integers(0, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, in order, and their bounds. A text of 1 to 4 words has one shingle: all its words."""
    r = tb.runs(buf, offs, tb.SPACE)
    h = tb.run_hash(buf, r, tb.LOWER)
    key, at = tb.windows(h, r, SHINGLE)
    doc = r.doc[at]
    words = np.diff(r.first)
    for n in range(1, SHINGLE):
        short = np.flatnonzero(words == n)
        k, a = tb.windows(h, r, n)
        mine = np.isin(r.doc[a], short)
        key, doc = np.concatenate([key, k[mine] + np.uint64(n)]), np.concatenate([doc, r.doc[a[mine]]])
    order = np.lexsort((key, doc))
    key, doc = key[order], doc[order]
    if len(key):
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])
        key, doc = key[new], doc[new]
    return key, np.searchsorted(doc, np.arange(len(offs)))


def _identity(key: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that name a set."""
    one = tb.per_doc_u64(tb.mix(key), bound)
    two = tb.per_doc_u64(tb.mix(key ^ np.uint64(0xA5A5A5A5A5A5A5A5)), bound)
    return tb.mix(one), tb.mix(two + np.diff(bound).astype(np.uint64))


def _samples(key: np.ndarray, bound: np.ndarray) -> np.ndarray:
    n = len(bound) - 1
    out = np.zeros((n, SAMPLES), np.int32)
    some = np.flatnonzero(np.diff(bound))
    if len(some):
        for k in range(SAMPLES):
            out[some, k] = (np.minimum.reduceat(key * _A[k], bound[some]) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, buf, offs in tb.slices(b.column(b.num_columns - 1)):
            key, bound = shingles(buf, offs)
            one, two = _identity(key, bound)
            sig = _samples(key, bound)
            sig = pa.ListArray.from_arrays(pa.array(np.arange(0, sig.size + 1, SAMPLES, dtype=np.int32)), pa.array(sig.ravel()))
            own = [b.column(k).slice(lo, hi - lo) for k in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(np.diff(bound)), sig], names=[*b.schema.names[:-1], "k1", "k2", "n", "sig"])


def _sets(bits: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """k1, k2 and shingles of the texts that the filter lets through, each set once a partition."""
    seen: set[tuple[int, int]] = set()
    for b in batches:
        for _, _, buf, offs in tb.slices(b.column(0)):
            key, bound = shingles(buf, offs)
            one, two = (x.view(np.int64) for x in _identity(key, bound))
            at = one & (8 * len(bits) - 1)
            rows = []
            for d in np.flatnonzero((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).tolist():
                name = (int(one[d]), int(two[d]))
                if name not in seen:
                    seen.add(name)
                    rows.append((*name, key[bound[d] : bound[d + 1]].tobytes()))
            if rows:
                k1, k2, blob = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(blob, pa.binary())], names=["k1", "k2", "shingles"])


def _possible(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs of a tile that may be links and have their place here."""
    sig = t["sig"].combine_chunks().flatten().to_numpy().reshape(-1, SAMPLES)
    n, side = t["n"].to_numpy(), t["side"].to_numpy()
    low, high = t["ta"][0].as_py(), t["tb"][0].as_py()
    forbid = t["forbid"][0].as_py()
    left = np.flatnonzero(side == low)
    right = left if low == high else np.flatnonzero(side == high)
    if not len(left) or not len(right):
        return left[:0], left[:0]
    ok = np.minimum.outer(n[left], n[right]) * DENOMINATOR >= np.maximum.outer(n[left], n[right]) * NUMERATOR
    if low == high:
        ok = np.triu(ok, 1)
    agree = np.zeros(ok.shape, np.uint8)
    for k in range(SAMPLES):
        same = sig[left, k][:, None] == sig[right, k][None, :]
        if forbid >> k & 1:
            ok &= ~same
        agree += same
    i, j = np.nonzero(ok & (agree >= AGREE))
    return left[i], right[j]


def _candidates(t: pa.Table) -> pa.Table:
    i, j = _possible(t)
    return t.take(pa.array(np.union1d(i, j)))


def _common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets[i] and sets[j]."""
    rows = np.union1d(i, j)
    size = np.array([len(sets[r]) for r in rows])
    every, col = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True)
    many = np.bincount(col, minlength=len(every)) > 1
    place = np.cumsum(many) - 1
    width = int(many.sum())
    if len(i) * (size.mean() * 2e-8 + 2e-5) < len(rows) ** 2 * width * 2e-10 + 1e-4:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
    row = np.repeat(np.arange(len(rows)), size)[many[col]]
    col = place[col[many[col]]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    both = np.zeros((len(rows),) * 2)
    for lo in range(0, width, 4096):
        a, b = np.searchsorted(col, [lo, lo + 4096])
        x = np.zeros((len(rows), min(4096, width - lo)), np.float32)
        x[row[a:b], col[a:b] - lo] = 1
        both += x @ x.T  # 4096 columns at most: exact in 32 bits, and so are the sums in 64
    return np.rint(both[np.searchsorted(rows, i), np.searchsorted(rows, j)]).astype(np.int64)


_LINK_SCHEMA = "rid long, root long, texts long, partners long"


def _links(t: pa.Table) -> pa.Table:
    """rid, root of its tree, number of partners here, and of the documents that they stand for."""
    i, j = _possible(t)
    rid, copies = t["rid"].to_numpy(), t["copies"].to_numpy()
    if len(i):
        sets = [np.frombuffer(x, np.uint64) for x in t["shingles"].to_pylist()]
        size = np.array([len(s) for s in sets])
        both = _common(sets, i, j)
        linked = both * DENOMINATOR >= (size[i] + size[j] - both) * NUMERATOR
        i, j = i[linked], j[linked]
    m = t.num_rows
    texts = np.bincount(i, minlength=m) + np.bincount(j, minlength=m)
    partners = np.bincount(i, copies[j], m) + np.bincount(j, copies[i], m)
    root = rid.copy()
    while len(i):  # labels go down along links until none changes
        before = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        if (before == root).all():
            break
    has = np.flatnonzero(texts)
    return pa.table({"rid": rid[has], "root": root[has], "texts": texts[has].astype(np.int64), "partners": partners[has].astype(np.int64)})


def _filter_bits(candidates: DataFrame) -> np.ndarray:
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_SET * candidates.count()).bit_length()))
    at = candidates.select((F.col("k1").bitwiseAND(F.lit(size - 1)) + 1).alias("at"))
    rows = at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    out = np.zeros(size // 8, np.uint8)
    for r in rows:
        lo = (r.bucket - 1) * 4096
        out[lo : lo + 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """rid and label of every end of the edges (a, b): the smallest rid of its component.

    Each round takes the smallest label among a vertex, its neighbours and its label's own label, and writes it. rows: about
    how many edges there are at most.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges", rows and 2 * rows)
    labels = cut(both.groupBy(F.col("a").alias("rid")).agg(F.least(F.col("rid"), F.min("b")).alias("label")), "labels", rows)
    while True:
        near = both.join(labels, both.b == labels.rid).groupBy(F.col("a").alias("rid")).agg(F.min("label").alias("near"))
        step = labels.join(near, "rid").select("rid", F.least("label", "near").alias("new"), F.col("label").alias("old"))
        up = labels.select(F.col("rid").alias("new"), F.col("label").alias("up"))
        labels = cut(step.join(up, "new", "left").select("rid", F.least("new", "up").alias("label"), "old"), "labels", rows)
        if not labels.where("label != old").limit(1).count():
            return labels.select("rid", "label")


def _paths(level: DataFrame, depth: int) -> DataFrame:
    """The sets of large buckets, on FAN further paths each: path, forbid, rid."""
    first = RUNS + FAN * (2 * depth + F.pmod(F.xxhash64("path"), F.lit(2)))
    fan = F.transform(F.sequence(F.lit(0), F.lit(FAN - 1)), lambda k: F.struct(
        F.xxhash64("path", first + k, F.get("sig", (first + k).cast("int"))).alias("path"),
        F.col("forbid").bitwiseOR(F.call_function("shiftleft", F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1, first.cast("int"))).alias("forbid"),
    ))
    return level.select("rid", "n", "copies", "sig", F.explode(fan).alias("to")).select("rid", "n", "copies", "sig", "to.path", "to.forbid")


def join(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, class_id, n_links, n_texts, n_copies.

    class_id: the smallest doc_id of the documents that links connect (-1 and below if all of them are null).
    n_links: other documents whose sets are alike to 0.8 or more, those of the same set among them. n_texts: different
    sets among these. n_copies: documents of the same set, itself among them. A text without words (null, empty) has
    no links, and a class of its own with the others without words only if its doc_id is the same. Repeated rows
    are documents of one set. An empty table gives an empty one; columns other than doc_id and text are not read.
    """
    return _classes(docs, ()).drop("__class")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents, all columns, one of each class: the smallest doc_id (null last), of repeated ids any one row.

    Texts without words (null, empty) are in no class and all stay. Long texts are compared whole. Any column names may be there;
    only doc_id and text are read. An empty table gives an empty one. Runs jobs: the rows and what is found are written.
    """
    names, own = docs.columns, [f"k{n}" for n in range(len(docs.columns))]
    held = cut(docs.toDF(*own).withColumn("uid", F.monotonically_increasing_id()), "documents")
    many = held.count()
    of = lambda name: F.col(own[names.index(name)]).alias(name)
    rows = cut(_classes(held.select(of("doc_id"), of("text"), "uid"), ("uid",)).where("__class is not null").select("__class", "doc_id", "uid"), "rows", many)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("first")
    several = cut(rows.groupBy("__class").agg(first, F.count("*").alias("n")).where("n > 1").select("__class", F.col("first.uid").alias("kept")), "first-rows", many)
    gone = rows.join(several, "__class").where("uid != kept").select("uid")
    return held.join(cut(gone, "gone", many), "uid", "left_anti").select(*own).toDF(*names)


def _classes(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The columns of `join` with `keep`, and __class, a number of the class (null without words)."""
    docs = docs.select(*keep, F.col("doc_id").cast("long").alias("doc_id"), "text")
    own = ", ".join(f"{c} {t}" for c, t in docs.dtypes[:-1])
    sketch = cut(docs.mapInArrow(lambda batches: tb.tidy(_sketch(batches)), own + ", k1 long, k2 long, n long, sig array<int>"), "sketches")
    many = sketch.count()  # rows of the tables below are in proportion to it
    worded = sketch.where("n > 0")
    sets = worded.groupBy("k1", "k2", "n", "sig").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    sets = cut(sets.withColumn("rid", F.monotonically_increasing_id()), "sets", many)

    # buckets of the runs; those whose sets all met in an earlier run have nothing to add
    run = F.posexplode(F.transform(F.slice("sig", 1, RUNS), lambda v, k: F.xxhash64(k, v))).alias("run", "path")
    in_runs = sets.select("rid", F.slice("sig", 1, RUNS - 1).alias("s"), run)
    stats = [f(F.get("s", F.lit(k))).alias(f"{name}{k}") for k in range(RUNS - 1) for name, f in (("lo", F.min), ("hi", F.max))]
    met = [(F.col("run") > k) & (F.col(f"lo{k}") == F.col(f"hi{k}")) for k in range(RUNS - 1)]
    nodes = in_runs.groupBy("path", "run").agg(F.count("*").alias("size"), *stats).where("size > 1")
    for m in met:
        nodes = nodes.where(~m)
    nodes = cut(nodes.select("path", F.expr("shiftleft(1L, run) - 1").alias("forbid"), "size"), "buckets", RUNS * many)
    level = in_runs.select("rid", "path").join(nodes, "path")
    level = cut(level.join(sets.select("rid", "n", "copies", "sig"), "rid"), "members", RUNS * many)
    leaves = []
    for depth in range(DEPTH + 1):
        leaves.append(level.where(F.col("size") <= LEAF) if depth < DEPTH else level)
        large = level.where(F.col("size") > LEAF)
        if depth == DEPTH or not large.limit(1).count():
            break
        split = cut(_paths(large, depth), "split", RUNS * many)
        size = cut(split.groupBy("path").agg(F.count("*").alias("size")).where("size > 1"), "buckets", RUNS * many)
        level = cut(split.join(size, "path"), "members", RUNS * many)
    columns = ["path", "forbid", "size", "rid", "n", "copies", "sig"]
    members = leaves[0].select(*columns)
    for more in leaves[1:]:
        members = members.unionByName(more.select(*columns))

    # tiles
    blocks = F.ceil(F.col("size") / BLOCK)
    tiled = members.withColumn("side", F.pmod(F.xxhash64("rid", "path"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
    tiled = tiled.select("path", F.least("side", "other").alias("ta"), F.greatest("side", "other").alias("tb"), "side", "forbid", "rid", "n", "copies", "sig")
    shape = "path long, ta int, tb int, side int, forbid long, rid long, n long, copies long, sig array<int>"
    chosen = cut(tiled.groupBy("path", "ta", "tb").applyInArrow(_candidates, shape), "candidates")

    # shingles of the candidates, from a second scan that a filter of fixed size keeps small
    wanted = sets.select("rid", "k1", "k2").join(chosen.select("rid").distinct(), "rid")
    wanted = cut(wanted, "wanted", many)
    bits = _filter_bits(wanted)
    found = docs.select("text").mapInArrow(lambda batches: tb.tidy(_sets(bits, batches)), "k1 long, k2 long, shingles binary").dropDuplicates(["k1", "k2"])
    found = cut(wanted.join(found, ["k1", "k2"]).select("rid", "shingles"), "shingles")
    links = cut(chosen.join(found, "rid").groupBy("path", "ta", "tb").applyInArrow(_links, _LINK_SCHEMA), "links")

    degree = links.groupBy("rid").agg(F.sum("texts").alias("texts"), F.sum("partners").alias("partners"))
    label = components(links.where("rid != root").select(F.col("rid").alias("a"), F.col("root").alias("b")), RUNS * many)
    named = sets.select("k1", "k2", "rid", "rep", "copies").join(degree, "rid", "left").join(label, "rid", "left").withColumn("label", F.coalesce("label", "rid"))
    named = cut(named, "named", many)
    least = cut(named.groupBy("label").agg(F.min("rep").alias("least")), "least", many)
    named = cut(named.join(least, "label").select(F.col("label").alias("__class"), "k1", "k2", F.coalesce("least", -1 - F.col("label")).alias("class_id"), (F.coalesce("partners", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_texts"), F.col("copies").alias("n_copies")), "classes", many)
    out = worded.select(*keep, "doc_id", "k1", "k2").join(named, ["k1", "k2"]).drop("k1", "k2")
    none = sketch.where("n = 0").select(*keep, "doc_id", F.lit(None).cast("long").alias("__class"), F.coalesce("doc_id", F.lit(-1)).alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_texts"), F.lit(1).cast("long").alias("n_copies"))
    return out.unionByName(none)
