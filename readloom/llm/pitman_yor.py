"""Language-model scores by a hierarchical Pitman-Yor model of word pairs.

Every previous word has a restaurant of its own, named by its 64-bit hash; all share one parent, the restaurant of single
words, which is of zero discount over the V known words and one unknown. A table of a context's restaurant is a customer of
the parent; the parent's own seating integrates out, so only its customers are kept.

Seating is sampled by Gibbs: a sweep takes customers out one by one and puts each back, at a table by its customers less
the discount, or at a new one by what the restaurant's strength and tables and the parent give it. A sweep reseats every customer
of a dish, from a random one on: those of many dishes side by side, the last ones of the few largest dishes one at a time. Within a
sweep the totals of the one before stand; then they are summed anew, and strength and discount of the contexts' restaurants are drawn,
given all seats, by the auxiliary variables that make their conditionals Gamma and Beta.

Pairs (word, previous word) are dealt to buckets so that what a bucket needs of others has a bound. Words of the head, the HEAD
most frequent ones of all texts, have two-byte codes; their totals are vectors of fixed length, summed over buckets. Other
words are the tail. Pairs of two head words (X) lie anywhere, by the hash of the pair; a tail word after a head word (Y)
lies with its word; what follows a tail word (Z, and Q if it is a tail word too) lies with that context. So all totals of a tail
context, and all customers of a tail word but those of Q, lie in one bucket; Q goes to the word's bucket as well, where it is called
R. Which words are head words changes where numbers are kept and how many bytes they take, and no probability. Of a repeated pair of Q
the context's bucket writes the context's tables to the word's bucket after each sweep, and that one the word's customers in the parent
to the context's. Both then reseat the dish under the same weight with random numbers that follow the pair, so they find the same seats.

Passes: (A) texts become chunks of different pairs by bucket, and for each chunk the documents of its pairs; (B) the chunks'
pairs of a bucket are merged, a pair's number in the merged list takes the pair's place; (C) sweeps, each of which writes the
buckets' seating for the next and what they tell each other, followed by the sums of its totals; (D) a bucket takes the numbers of
tables that the kept sweeps have written and answers each chunk with the probabilities of its pairs; (E) chunks add them up by document.
All counts cover all documents.
"""

from __future__ import annotations

import pickle
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import drop, forget
from . import textbatch as tb
from .sampling import fold
from .store import cut

#: Tokens and documents in a chunk; characters of text for each bucket; tokens of which a task counts the different words at a time.
CHUNK_TOKENS, CHUNK_DOCS, BUCKET_CHARS, COUNT_TOKENS = 2_000_000, 1 << 14, 24_000_000, 1 << 22
#: Codes of head words; the last one means none.
HEAD = 1 << 16
#: Sweeps before the first kept one, kept ones, and dishes from which on it pays to reseat a customer of each side by side.
BURN, KEPT, ABREAST = 2, 3, 64
#: Strength of the contexts' restaurants at the start; customers that the parent adds to each of V + 1 words, which is its strength by V + 1.
STRENGTH, PRIOR = 20.0, 0.5
#: Rate of the Gamma prior of the strength; sums of logarithms are kept in whole parts of this size, so that their order does not matter.
RATE, GRAIN = 0.05, 2.0**-20
#: Draws for larger numbers are those of a sum of rare events.
RARE = 1 << 16
#: Customers of a dish that are told apart; of larger dishes only the sizes of the tables are kept.
EXPLICIT = 1 << 14
#: Sums of one block of codes are added up in two steps, by this many parts first.
BLOCK, PARTS = 1 << 13, 64
BEGIN, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
U64 = np.uint64


def _pack(*arrays: np.ndarray) -> bytes:
    """Whole-number or float arrays as byte planes (sorted numbers have long runs in their high bytes), compressed."""
    import zstandard

    out = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        out.append(np.array([a.itemsize, len(a)], "<i8").tobytes() + a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpack(data: bytes, *types: str) -> list[np.ndarray]:
    import zstandard

    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    for t in types:
        size, n = np.frombuffer(raw, "<i8", 2, at)
        at += 16
        planes = np.frombuffer(raw, np.uint8, size * n, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(t).ravel())
        at += int(size * n)
    return out


def _steps(x: np.ndarray) -> np.ndarray:
    """Differences of numbers in order: smaller to write."""
    return np.diff(x, prepend=0).astype("<u4")


def tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hash, previous word's hash and text of every token: the words of each text in lower case, then its end."""
    r = tb.runs(buf, offs, tb.SPACE)
    h = tb.run_hash(buf, r, tb.LOWER)
    n = np.diff(r.first)
    at = r.first[1:] + np.arange(len(n))  # where each text's end comes
    inner = np.ones(r.n + len(n), bool)
    inner[at] = False
    word = np.full(len(inner), END)
    word[inner] = h
    context = np.empty(len(inner), np.uint64)
    context[np.flatnonzero(inner) + 1] = h
    context[at - n] = BEGIN
    return word, context, np.repeat(np.arange(len(n)), n + 1)


class Codes:
    """Codes of the head words, frequent ones first; BEGIN and END are always among them."""

    def __init__(self, frequent: np.ndarray):
        words = np.concatenate([np.array([BEGIN, END]), frequent[(frequent != BEGIN) & (frequent != END)]])[: HEAD - 1]
        self.code = np.argsort(words).astype(np.uint16)
        self.words = words[self.code]

    def __call__(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, self.code[at], np.uint16(HEAD - 1))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """In order of h."""
    return ((h >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


_CHUNKS = "bucket long, chunk long, data binary"


def _groups(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination starts in sorted columns."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _chunk(codes: Codes, buckets: int, word: np.ndarray, context: np.ndarray, mark: np.ndarray) -> tuple[list[tuple[int, bytes]], list[np.ndarray]]:
    """(bucket, its pairs) of a chunk, and the documents of the pairs in the order in which the buckets' answers follow one another.

    mark: a document's number, with the highest bit set if it is held out.
    """
    w, u = codes(word), codes(context)
    tail_w, tail_u = w == HEAD - 1, u == HEAD - 1
    parts, home = [], []

    def add(select: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The pairs of a class sorted by its keys: their rows, and training counts; what the chunk keeps goes to `home`."""
        rows = np.flatnonzero(select)
        order = np.lexsort((mark[rows], *(k[rows] for k in reversed(keys))))
        rows = rows[order]
        first = _groups(*(k[rows] for k in keys)) if len(rows) else np.zeros(0, np.int64)
        marks = mark[rows]
        n = np.add.reduceat((marks < 1 << 15).astype(np.int64), first) if len(first) else first
        home.extend([np.diff(np.append(first, len(rows))).astype("<i4"), marks])
        return rows[first], n.astype("<i4")

    x = ~tail_w & ~tail_u
    code = w.astype(np.uint32) << np.uint32(16) | u
    place = _bucket(tb.mix(code.astype(np.uint64)), buckets)
    rows, n = add(x, place, code)
    home.append(w[rows])
    parts.append((place[rows], (code[rows], n)))
    rows, n = add(tail_w & ~tail_u, word, u)
    parts.append((_bucket(word[rows], buckets), (word[rows], u[rows], n)))
    place = _bucket(context, buckets)
    rows, n = add(~tail_w & tail_u, place, w, context)
    home.append(w[rows])
    parts.append((place[rows], (w[rows], context[rows], n)))
    rows, n = add(tail_w & tail_u, context, word)
    parts.append((place[rows], (context[rows], word[rows], n)))
    turn = np.lexsort((context[rows], word[rows]))  # the same pairs, with their words
    home.append(np.argsort(turn).astype("<u4"))
    rows, n = rows[turn], n[turn]
    parts.append((_bucket(word[rows], buckets), (word[rows], context[rows], n)))

    edges = [np.searchsorted(place, np.arange(buckets + 1)) for place, _ in parts]
    cells = []
    for b in range(buckets):
        if any(e[b + 1] > e[b] for e in edges):
            cells.append((b, _pack(*(c[e[b] : e[b + 1]] for e, (_, columns) in zip(edges, parts, strict=True) for c in columns))))
    return cells, home


_CELL = ("<u4", "<i4", "<u8", "<u2", "<i4", "<u2", "<u8", "<i4", "<u8", "<u8", "<i4", "<u8", "<u8", "<i4")
_HOME = ("<i4", "<u2", "<u2", "<i4", "<u2", "<i4", "<u2", "<u2", "<i4", "<u2", "<u4")


def _chunks(codes: Codes, buckets: int, held: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each chunk of documents a row for each bucket, and one (bucket -1 - chunk) of what it keeps."""
    chunk = TaskContext.get().partitionId() << 24
    parts: list[tuple[np.ndarray, ...]] = []
    ids: list = []
    outs: list[np.ndarray] = []
    sizes: list[np.ndarray] = []

    def flush() -> Iterator[pa.RecordBatch]:
        held_out, count = np.concatenate(outs), np.concatenate(sizes)
        word, context, doc = (np.concatenate([p[k] for p in parts]) for k in range(3))
        cells, home = _chunk(codes, buckets, word, context, doc | (held_out[doc].astype(np.uint16) << np.uint16(15)))
        known = np.array([i is not None for i in ids])
        cells.append((-1 - chunk, _pack(np.array([i or 0 for i in ids], "<i8"), known.astype(np.uint8), held_out.astype(np.uint8), count.astype("<i4"), *home)))
        parts.clear(), ids.clear(), outs.clear(), sizes.clear()
        for lo in range(0, len(cells), 64):
            some = cells[lo : lo + 64]
            yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in some], pa.int64()), pa.array([chunk] * len(some), pa.int64()), pa.array([c[1] for c in some], pa.binary())], names=["bucket", "chunk", "data"])

    waiting = 0
    for b in batches:
        remainder = b.column(2).to_numpy(zero_copy_only=False)
        for lo, hi, buf, offs in tb.slices(b.column(1)):
            for a in range(lo, hi, CHUNK_DOCS // 2):
                z = min(hi, a + CHUNK_DOCS // 2)
                part = offs[a - lo : z - lo + 1]
                word, context, doc = tokens(buf[part[0] : part[-1]], part - part[0])
                if ids and (len(ids) + z - a > CHUNK_DOCS or waiting + len(word) > CHUNK_TOKENS):
                    yield from flush()
                    chunk, waiting = chunk + 1, 0
                parts.append((word, context, (doc + len(ids)).astype(np.uint16)))
                ids += b.column(0).slice(a, z - a).to_pylist()
                outs.append(remainder[a:z] == held)
                sizes.append(np.bincount(doc, minlength=z - a))
                waiting += len(word)
    if ids:
        yield from flush()


def _union(parts: list[list[np.ndarray]], keys: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Different keys of all parts with their summed counts (the last column), and each part's places among them."""
    columns = [np.concatenate([p[k] for p in parts]) for k in range(keys + 1)]
    n = len(columns[0])
    order = np.lexsort(columns[keys - 1 :: -1]) if keys > 1 else np.argsort(columns[0], kind="stable")
    first = _groups(*(c[order] for c in columns[:keys]))
    place = np.empty(n, np.int64)
    number = np.zeros(n, np.int64)
    number[first] = 1
    place[order] = np.cumsum(number) - 1
    total = np.add.reduceat(columns[keys][order].astype(np.int64), first) if n else np.zeros(0, np.int64)
    edges = np.cumsum([0, *(len(p[0]) for p in parts)])
    return [*(c[order][first] for c in columns[:keys]), total], [place[a:z] for a, z in zip(edges[:-1], edges[1:], strict=True)]


_MERGED = "bucket long, chunks array<long>, model binary, cells array<binary>"


def _peers(h: np.ndarray, turn: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Repeated pairs in a turn that the bucket of h, at the pair's other end, has too: the turn, these buckets, and how many pairs each shares."""
    return [turn.astype("<u4"), *(v.astype("<u4") for v in np.unique(_bucket(h[turn], buckets), return_counts=True))]


def _merge(t: pa.Table, buckets: int = 1) -> pa.Table:
    """One row of a bucket: its pairs with training counts, and of each chunk the numbers of its pairs. A chunk's own row stays."""
    bucket, chunks, data = t["bucket"][0].as_py(), t["chunk"].to_pylist(), t["data"].to_pylist()
    row = lambda model, cells: pa.table({"bucket": pa.array([bucket], pa.int64()), "chunks": pa.array([chunks], pa.list_(pa.int64())), "model": pa.array([model], pa.binary()), "cells": pa.array([cells], pa.list_(pa.binary()))})
    if bucket < 0:
        return row(data[0], [])
    cells = [_unpack(d, *_CELL) for d in data]
    (code, cx), at_x = _union([c[0:2] for c in cells], 1)
    (yw, yu, cy), at_y = _union([c[2:5] for c in cells], 2)
    (zw, zu, cz), at_z = _union([c[5:8] for c in cells], 2)
    (qu, qw, cq), at_q = _union([c[8:11] for c in cells], 2)
    (rw, ru, cr), at_r = _union([c[11:14] for c in cells], 2)
    # the pairs that two buckets share stand in order of context and word in both
    q, r = np.flatnonzero(cq > 1), np.flatnonzero(cr > 1)
    q, r = q[np.argsort(_bucket(qw[q], buckets), kind="stable")], r[np.lexsort((rw[r], ru[r]))]
    words, contexts = np.union1d(yw, rw), np.union1d(zu, qu)
    find = lambda among, x: np.searchsorted(among, x).astype("<u4")
    model = _pack(np.array([len(words), len(contexts), bucket], "<i8"), code, cx, find(words, yw), yu, cy, zw, find(contexts, zu), cz, find(contexts, qu), cq, find(words, rw), cr, *_peers(qw, q, buckets), *_peers(ru, r, buckets))
    return row(model, [_pack(*(_steps(p[k]) for p in (at_x, at_y, at_z, at_q, at_r))) for k in range(len(cells))])


_MODEL = ("<i8", "<u4", "<i8", "<u4", "<u2", "<i8", "<u2", "<u4", "<i8", "<u4", "<i8", "<u4", "<i8", *["<u4"] * 6)


class Totals:
    """What buckets know of each other: vectors by head code and some numbers, after one sweep."""

    def __init__(self, customers: np.ndarray, tables: np.ndarray, parent: np.ndarray, all_parent: float, strength: float, discount: float, known: float):
        #: Customers and tables of the head contexts, customers of the head words in the parent and of all words, and V.
        self.customers, self.tables, self.parent, self.all_parent, self.strength, self.discount, self.known = customers, tables, parent, all_parent, strength, discount, known

    def single(self, customers: np.ndarray) -> np.ndarray:
        """Probability of a word with so many customers in the parent."""
        return (customers + PRIOR) / (self.all_parent + PRIOR * (self.known + 1))

    def new(self, tables: np.ndarray) -> np.ndarray:
        """Weight of a new table in a restaurant with so many."""
        return self.strength + self.discount * tables


def successes(rng: np.random.Generator, sizes: np.ndarray, top: float, add: float) -> float:
    """Sum over sizes n of draws with probability top / (add + j), one for each j from 1 to n - 1."""
    sizes = sizes.astype(np.int64)
    low = np.minimum(sizes, RARE)
    if not len(low) or low.max() < 2:
        return 0.0
    over = np.cumsum(np.bincount(low)[::-1])[::-1][2:]  # how many sizes are over 1, over 2, ...
    got = float(rng.binomial(over, np.minimum(1.0, top / (add + np.arange(1, len(over) + 1)))).sum())
    large = sizes[sizes > RARE].astype(float)
    return got + float(rng.poisson(top * np.log((add + large - 0.5) / (add + RARE - 0.5))).sum()) if len(large) else got


def seats(rng: np.random.Generator, customers: np.ndarray, tables: np.ndarray, sizes: np.ndarray, strength: float, discount: float) -> np.ndarray:
    """Auxiliary draws of some restaurants (customers, tables) and of tables (sizes): for the strength a logarithm (in parts of
    GRAIN) and successes, for the discount failures and what the tables give."""
    some = tables > 1
    log = np.log(rng.beta(strength + 1, np.maximum(customers[some] - 1, 1e-9))).sum() if some.any() else 0.0
    yes = successes(rng, tables[some], strength / discount, strength / discount)
    return np.array([np.rint(log / GRAIN), yes, float((tables[some] - 1).sum()) - yes, successes(rng, sizes, 1 - discount, -discount)])


def parameters(rng: np.random.Generator, drawn: np.ndarray) -> tuple[float, float]:
    """Strength and discount given the auxiliary draws of all restaurants."""
    log, yes, no, inner = drawn
    strength = rng.gamma(1 + yes) / (RATE - log * GRAIN)
    return float(max(strength, 1e-3)), float(np.clip(rng.beta(1 + no, 1 + inner), 0.01, 0.99))


def seat(rng: np.random.Generator, customers: np.ndarray, new: np.ndarray, discount: float) -> np.ndarray:
    """Tables of each dish if its customers come one after another, by growing groups: where the sampler starts."""
    tables = np.minimum(customers, 1)
    live, n = np.flatnonzero(customers > 1), 1
    while len(live):
        step = max(1, n // 16)
        size = np.minimum(customers[live] - n, step)
        tables[live] += rng.binomial(size, new[live] / (new[live] + np.maximum(n + (size - 1) / 2 - discount * tables[live], 1e-9)))
        n += step
        live = live[customers[live] > n]
    return tables


def _reseat(rng: np.random.Generator, table: array, size: list[int], free: list[int], turn: Iterable[int], new: float, discount: float) -> None:
    """Customers of one dish leave their table and return, in turn. table: of each customer; size: of each table; free: numbers of empty ones."""

    def randoms() -> Iterator[float]:
        while True:
            yield from rng.random(1 << 12).tolist()

    n, draw = len(table), randoms().__next__
    t = len(size) - size.count(0)
    for who in turn:
        left = table[who]
        size[left] -= 1
        if not size[left]:
            t -= 1
            free.append(left)
        if draw() * (new + n - 1 - discount * t) < new:
            if not free:
                free.append(len(size))
                size.append(0)
            at = free.pop()
            t += 1
        else:  # that of another customer, who is taken with the probability that the discount leaves
            while True:
                at = table[(who + 1 + int(draw() * (n - 1))) % n]
                if t == 1 or draw() * size[at] < size[at] - discount:
                    break
        table[who] = at
        size[at] += 1


class Keyed:
    """Random numbers that follow a key of each dish: whoever holds the dish draws the same, whatever other dishes there are."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.drawn = keys, np.zeros(len(keys), np.uint64)

    def __call__(self, at: np.ndarray | slice) -> np.ndarray:
        self.drawn[at] += U64(1)
        return (tb.mix(self.keys[at] + self.drawn[at] * BEGIN) >> U64(11)).astype(float) * 2.0**-53


class Dishes:
    """Customers and tables of dishes, each of two customers or more.

    keys: of dishes that two buckets have. Their seats follow these keys, customers and weights alone; all sit at one table first.
    """

    def __init__(self, rng: np.random.Generator, customers: np.ndarray, new: np.ndarray, discount: float, keys: np.ndarray | None = None):
        self.discount, self.customers, self.keys, self.swept = discount, customers, keys, 0
        self.order = np.argsort(-np.minimum(customers, EXPLICIT + 1), kind="stable")  # largest first: those with a k-th move come first
        c = customers[self.order]
        start = seat(rng, c, new[self.order], discount) if keys is None else np.minimum(c, 1)
        self.large = int((c > EXPLICIT).sum())
        self.sizes = [1 + rng.multinomial(n - t, np.full(t, 1 / t)) for n, t in zip(c[: self.large].tolist(), start[: self.large].tolist(), strict=True)]
        self.c, t = c[self.large :], start[self.large :]
        self.first = np.cumsum(self.c) - self.c
        dish = np.repeat(np.arange(len(self.c)), self.c)
        place = np.arange(len(dish)) - self.first[dish]
        self.table = np.where(place < t[dish], place, (rng.random(len(dish)) * t[dish]).astype(np.int64)).astype(np.int32)
        self.size = np.bincount(self.first[dish] + self.table, minlength=len(dish)).astype(np.int32)
        self.t = np.bincount(dish[self.size > 0], minlength=len(self.c))

    def tables(self) -> np.ndarray:
        """Tables of each dish, in the order given."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.concatenate([np.array([len(s) for s in self.sizes], np.int64), self.t])
        return out

    def table_sizes(self) -> np.ndarray:
        """Of the tables with two customers or more, in no order."""
        return np.concatenate([self.size[self.size > 1].astype(np.int64), *(s[s > 1] for s in self.sizes)])

    def sweep(self, rng: np.random.Generator, new: np.ndarray, discount: float) -> None:
        """Take out and put back every customer of each dish, one after another; new: the weight of a new table."""
        new, self.discount, self.swept = new[self.order], discount, self.swept + 1
        keys = None if self.keys is None else tb.mix(self.keys[self.order] + U64(self.swept))
        for k in range(self.large):
            size = self.sizes[k].tolist()
            table = array("i", np.repeat(np.arange(len(size), dtype=np.int32), self.sizes[k]).tobytes())
            _reseat(rng if keys is None else np.random.Generator(np.random.PCG64(int(keys[k]))), table, size, [], range(len(table)), float(new[k]), discount)
            self.sizes[k] = np.array([s for s in size if s], np.int64)
        new = new[self.large :]
        if keys is None:
            draw = lambda at: rng.random(len(at))
            many = int(self.c[ABREAST]) if len(self.c) > ABREAST else 0  # more than ABREAST dishes have as many customers
        else:
            draw, many = Keyed(keys[self.large :]), int(self.c.max(initial=0))
        every = np.arange(len(self.c))
        begin = (draw(every) * self.c).astype(np.int64)
        for i in range(min(ABREAST, len(self.c))):
            c, first = int(self.c[i]), int(self.first[i])
            if c > many:
                table, size = array("i", self.table[first : first + c].tobytes()), self.size[first : first + c].tolist()
                free = [s for s in range(c - 1, -1, -1) if not size[s]]
                _reseat(rng, table, size, free, ((int(begin[i]) + k) % c for k in range(many, c)), float(new[i]), discount)
                self.table[first : first + c], self.size[first : first + c] = np.frombuffer(table, np.int32), size
                self.t[i] = c - size.count(0)
        for k in range(many):
            n = int(np.searchsorted(-self.c, -k, "left"))  # dishes with more than k customers
            c, first = self.c[:n], self.first[:n]
            who = (begin[:n] + k) % c
            left = first + self.table[first + who]
            self.size[left] -= 1
            t = self.t[:n]
            t -= self.size[left] == 0
            fresh = draw(every[:n]) * (new[:n] + c - 1 - self.discount * t) < new[:n]
            # an old table: that of another customer, who is taken with the probability that the discount leaves
            todo = np.flatnonzero(~fresh)
            while len(todo):
                other = who[todo] + 1 + (draw(todo) * (c[todo] - 1)).astype(np.int64)
                guess = self.table[first[todo] + other % c[todo]]
                size = self.size[first[todo] + guess]
                sits = (t[todo] == 1) | (draw(todo) * size < size - self.discount)
                at = todo[sits]
                self.table[first[at] + who[at]] = guess[sits]
                self.size[first[at] + guess[sits]] += 1
                todo = todo[~sits]
            # a new table: an empty number
            todo = np.flatnonzero(fresh)
            t[todo] += 1
            while len(todo):
                guess = (draw(todo) * c[todo]).astype(np.int32)
                empty = self.size[first[todo] + guess] == 0
                at = todo[empty]
                self.table[first[at] + who[at]] = guess[empty]
                self.size[first[at] + guess[empty]] = 1
                todo = todo[~empty]


class Bucket:
    """The pairs of one bucket by class, and their seating."""

    def __init__(self, data: bytes):
        (size, code, self.cx, self.yw, yu, self.cy, zw, self.zu, self.cz, self.qu, self.cq, self.rw, self.cr, self.q, self.q_to, self.q_n, self.r, self.r_to, self.r_n) = _unpack(data, *_MODEL)
        self.n_words, self.n_contexts, own = size.tolist()
        self.xw, self.xu, self.yu, self.zw = (code >> np.uint32(16)).astype(np.int64), (code & np.uint32(HEAD - 1)).astype(np.int64), yu.astype(np.int64), zw.astype(np.int64)
        by = lambda at, v, n: np.bincount(at, v, n)
        self.customers = by(self.zu, self.cz, self.n_contexts) + by(self.qu, self.cq, self.n_contexts)  # of the tail contexts
        self.count = by(self.yw, self.cy, self.n_words) + by(self.rw, self.cr, self.n_words)  # of the tail words
        #: Of the repeated pairs of two tail words, a key from the context's and the word's bucket and the place among what these share.
        key = lambda a, b, n: tb.mix(tb.mix(np.repeat(a << U64(32) | b, n)) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)).astype(np.uint64))
        self.q_key, self.r_key = key(U64(own), self.q_to.astype(np.uint64), self.q_n.astype(np.int64)), key(self.r_to.astype(np.uint64), U64(own), self.r_n.astype(np.int64))
        self.live = [*(np.flatnonzero(c > 1) for c in (self.cx, self.cy, self.cz)), self.q, self.r]
        self.put(*self._first())

    def _first(self) -> list[np.ndarray]:
        """One table a dish."""
        return [np.minimum(c, 1) for c in (self.cx, self.cy, self.cz, self.cq, self.cr)]

    def put(self, tx: np.ndarray, ty: np.ndarray, tz: np.ndarray, tq: np.ndarray, tr: np.ndarray) -> None:
        self.tx, self.ty, self.tz, self.tq, self.tr = tx, ty, tz, tq, tr
        #: Tables that pairs of two tail words add to their contexts, and to their words as customers of the parent.
        self.tables_q, self.parent_q = np.bincount(self.qu, tq, self.n_contexts), np.bincount(self.rw, tr, self.n_words)
        self.tables = self.tables_q + np.bincount(self.zu, tz, self.n_contexts)
        self.parent = self.parent_q + np.bincount(self.yw, ty, self.n_words)

    def counted(self) -> np.ndarray:
        """Training counts: customers by head context, words by head code, then N, V of the tail, pairs that occur once and twice."""
        every = [self.cx, self.cy, self.cz, self.cq]
        numbers = [float(sum(int(c.sum()) for c in every)), float((self.count > 0).sum()), *(float(sum(int((c == k).sum()) for c in every)) for k in (1, 2))]
        head = np.bincount(self.xu, self.cx, HEAD) + np.bincount(self.yu, self.cy, HEAD)
        words = np.bincount(self.xw, self.cx, HEAD) + np.bincount(self.zw, self.cz, HEAD)
        return np.concatenate([head, words, numbers])

    def summed(self) -> np.ndarray:
        """Tables by head context, customers of the parent by head code, then those of the tail words."""
        tables = np.bincount(self.xu, self.tx, HEAD) + np.bincount(self.yu, self.ty, HEAD)
        parent = np.bincount(self.xw, self.tx, HEAD) + np.bincount(self.zw, self.tz, HEAD)
        return np.concatenate([tables, parent, [float(self.parent.sum())]])

    def told(self) -> tuple[np.ndarray, np.ndarray]:
        """What the other ends of the repeated pairs of two tail words need: the tables of each context, the customers of each word in the parent."""
        return self.tables[self.qu[self.q]], self.parent[self.rw[self.r]]

    def mail(self) -> Iterator[tuple[int, int, bytes]]:
        """The same by buckets: to whom, kind, numbers."""
        for kind, numbers, to, n in zip((TABLES, CUSTOMERS), self.told(), (self.q_to, self.r_to), (self.q_n, self.r_n), strict=True):
            at = np.cumsum(n, dtype=np.int64)
            for bucket, a, z in zip(to.tolist(), (at - n).tolist(), at.tolist(), strict=True):
                yield bucket, kind, numbers[a:z].astype("<u4").tobytes()

    def sweeps(self, seed: int, after: list[Totals], state: bytes | None = None, heard: tuple[np.ndarray, np.ndarray] | None = None) -> Iterator[int]:
        """The seating after each sweep for which there are totals of the one before; after[0] has one table a dish, or is of the sweep that left the state.

        heard: what the other ends have told, for one sweep; without it the bucket is the only one, so it hears itself.
        """
        import zstandard

        x, y, z, q, r = self.live
        dishes: list[Dishes] | None = None
        if state is None:
            rng = np.random.Generator(np.random.PCG64([seed, 2024]))
            self.put(*self._first())
        else:
            rng, dishes = pickle.loads(zstandard.ZstdDecompressor().decompress(state))
            self.seated([d.tables() for d in dishes])
        for k, t in enumerate(after):
            context, single = t.new(t.tables), t.single(t.parent)
            own_context, own_single = t.new(self.tables), t.single(self.parent)
            there_tables, there_parent = heard or self.told()
            weight = [
                context[self.xu[x]] * single[self.xw[x]], context[self.yu[y]] * own_single[self.yw[y]], own_context[self.zu[z]] * single[self.zw[z]],
                own_context[self.qu[q]] * t.single(there_parent), t.new(there_tables) * own_single[self.rw[r]],
            ]
            if dishes is None:
                counts, keys = (self.cx, self.cy, self.cz, self.cq, self.cr), (None, None, None, self.q_key, self.r_key)
                dishes = [Dishes(rng, c[at], w, t.discount, key) for c, at, w, key in zip(counts, self.live, weight, keys, strict=True)]
            for d, w in zip(dishes, weight, strict=True):
                d.sweep(rng, w, t.discount)
            self.seated([d.tables() for d in dishes])
            self.rng, self.dishes = rng, dishes
            yield k

    def seated(self, tables: list[np.ndarray]) -> None:
        """Numbers of tables of the dishes of two customers or more, by class."""
        now = self._first()
        for mine, t, at in zip(now, tables, self.live, strict=True):
            mine[at] = t
        self.put(*now)

    def kept(self) -> bytes:
        """What `seated` takes."""
        return _pack(*(t[at].astype("<u4") for t, at in zip((self.tx, self.ty, self.tz, self.tq, self.tr), self.live, strict=True)))

    def state(self) -> bytes:
        """What the next sweep goes on from."""
        import zstandard

        return zstandard.ZstdCompressor(level=1).compress(pickle.dumps((self.rng, self.dishes), pickle.HIGHEST_PROTOCOL))

    def seats(self, seed: int, sweep: int, t: Totals) -> np.ndarray:
        """Auxiliary draws of the tail contexts and of all tables here, under this seating."""
        rng = np.random.Generator(np.random.PCG64([seed, sweep, 2025]))
        sizes = np.concatenate([d.table_sizes() for d in self.dishes[:4]])  # the last ones are those of Q, at the words' end
        return seats(rng, self.customers, self.tables, sizes, t.strength, t.discount)

    def probabilities(self, t: Totals) -> list[np.ndarray]:
        """Under this seating: of X, Y and Z; of Q, what its own customers give, and its context's share of the parent; of its words in the parent."""
        d = t.discount
        back, single = t.new(t.tables) / (t.strength + t.customers), t.single(t.parent)
        own_back, own_single = t.new(self.tables) / (t.strength + self.customers), t.single(self.parent)
        x = (self.cx - d * self.tx) / (t.strength + t.customers[self.xu]) + back[self.xu] * single[self.xw]
        y = (self.cy - d * self.ty) / (t.strength + t.customers[self.yu]) + back[self.yu] * own_single[self.yw]
        z = (self.cz - d * self.tz) / (t.strength + self.customers[self.zu]) + own_back[self.zu] * single[self.zw]
        q = (self.cq - d * self.tq) / (t.strength + self.customers[self.qu])
        return [x, y, z, q, own_back[self.qu], own_single[self.rw]]


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for k in range(b.num_rows):
            yield tuple(c[k].as_py() for c in b.columns)


def _blocks(total: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    if total is not None:
        part = TaskContext.get().partitionId() % PARTS
        cuts = [total[lo : lo + BLOCK] for lo in range(0, len(total), BLOCK)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cuts)), pa.int32()), pa.array([part] * len(cuts), pa.int32()), pa.array([c.tobytes() for c in cuts], pa.binary())], names=["block", "part", "data"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts and the first seating's sums of all buckets of a task."""
    total = None
    for _, data in _rows_of(batches):
        own = Bucket(data)
        got = np.concatenate([own.counted(), own.summed()])
        total = got if total is None else total + got
    yield from _blocks(total)


#: Rows of the sweeps: a bucket's pairs with its sums, its seating, what it keeps of a sweep (sender), and what another bucket (sender) tells it.
_SEATS = "bucket long, kind int, sender long, data binary, sums binary"
MODEL, STATE, SEATED, TABLES, CUSTOMERS = range(5)


def _seats_table(rows: list[tuple]) -> pa.Table:
    types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.table({name: pa.array([r[k] for r in rows], t) for k, (name, t) in enumerate(zip(("bucket", "kind", "sender", "data", "sums"), types, strict=True))})


def _begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each bucket, and what it tells others under the first seating."""
    for bucket, data in _rows_of(batches):
        yield from _seats_table([(bucket, MODEL, bucket, data, None), *((to, kind, bucket, v, None) for to, kind, v in Bucket(data).mail())]).to_batches()


def _sample(after: list[Totals], t: pa.Table) -> pa.Table:
    """A bucket after the next sweep, its sums, and what it tells others; after the last one its sums and what it kept only."""
    bucket, sweep = t["bucket"][0].as_py(), len(after) - 1
    rows = sorted(zip(t["kind"].to_pylist(), t["sender"].to_pylist(), t["data"].to_pylist(), strict=True), key=lambda r: r[:2])
    of = lambda kind: [r[2] for r in rows if r[0] == kind]
    own, heard = Bucket(of(MODEL)[0]), tuple(np.frombuffer(b"".join(of(kind)), "<u4").astype(float) for kind in (TABLES, CUSTOMERS))
    for _ in own.sweeps(bucket, after[-1:], next(iter(of(STATE)), None), heard):
        pass
    sums = _pack(np.concatenate([own.summed(), own.seats(bucket, len(after), after[-1])]))
    last = sweep == BURN + KEPT - 1
    out = [(bucket, MODEL, bucket, None if last else of(MODEL)[0], sums), *((bucket, *r, None) for r in rows if r[0] == SEATED)]
    if sweep >= BURN:
        out.append((bucket, SEATED, sweep, own.kept(), None))
    if not last:
        out += [(bucket, STATE, bucket, own.state(), None), *((to, kind, bucket, v, None) for to, kind, v in own.mail())]
    return next(tb.tidy(iter([_seats_table(out)])))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of all buckets of a task."""
    total = None
    for (data,) in _rows_of(batches):
        got = _unpack(data, "<f8")[0]
        total = got if total is None else total + got
    yield from _blocks(total)


def _add(t: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x, "<f8") for x in t["data"].to_pylist()], 0)
    return pa.table({"block": t["block"][:1], "part": t["part"][:1], "data": pa.array([total.tobytes()], pa.binary())})


def _collect(blocks: DataFrame) -> np.ndarray:
    """Sums over tasks, a fixed number of them: whole numbers, so their order does not matter."""
    schema = "block int, part int, data binary"
    parts = blocks.groupBy("block", "part").applyInArrow(_add, schema)
    got = sorted(parts.groupBy("block").applyInArrow(_add, schema).collect())
    return np.concatenate([np.frombuffer(r.data, "<f8") for r in got]) if got else np.zeros(0)


_KEPT = "bucket long, chunks array<long>, model binary, cells array<binary>, sweep long, kept binary"


def _answers(after: list[Totals], t: pa.Table) -> pa.Table:
    """Of each chunk that has pairs in a bucket: their probabilities, and training counts of tail words."""
    rows = sorted(t.to_pylist(), key=lambda r: -1 if r["sweep"] is None else r["sweep"])
    bucket, own, kept = rows[0]["bucket"], Bucket(rows[0]["model"]), []
    for k in range(BURN, BURN + KEPT):
        if len(rows) > 1:  # else there is nobody to seat
            own.seated(_unpack(rows[1 + k - BURN]["kept"], *["<u4"] * 5))
        kept.append(own.probabilities(after[k + 1]))
    x, y, z, q = (sum(p[k] for p in kept) / KEPT for k in range(4))
    logs = [np.log10(p).astype("<f4") for p in (x, y, z)]
    q, backs, singles = q.astype("<f4"), [p[4].astype("<f4") for p in kept], [p[5].astype("<f4") for p in kept]
    count_y, count_r = own.count[own.yw].astype("<i8"), own.count[own.rw].astype("<i8")
    out = []
    for cell in rows[0]["cells"]:
        ax, ay, az, aq, ar = (np.cumsum(s, dtype=np.int64) for s in _unpack(cell, *["<u4"] * 5))
        out.append(_pack(logs[0][ax], logs[1][ay], logs[2][az], count_y[ay], count_r[ar], q[aq], *(v[aq] for v in backs), *(v[ar] for v in singles)))
    return pa.table({"bucket": pa.array([bucket] * len(out), pa.int64()), "chunk": pa.array(rows[0]["chunks"], pa.int64()), "data": pa.array(out, pa.binary())})


_ANSWER = ("<f4", "<f4", "<f4", "<i8", "<i8", "<f4", *["<f4"] * (2 * KEPT))


def _finish(t: pa.Table, counts: np.ndarray, train_tokens: int, known: int) -> pa.Table:
    """The documents of a chunk: sums over their tokens, in 64 bits."""
    rows = sorted(zip(t["bucket"].to_pylist(), t["data"].to_pylist(), strict=True), key=lambda r: r[0])
    ids, has, held, size, nx, mx, wx, ny, my, nz, mz, wz, nq, mq, turn = _unpack(rows[0][1], "<i8", "u1", "u1", "<i4", *_HOME)
    got = [np.concatenate(c) for c in zip(*(_unpack(d, *_ANSWER) for _, d in rows[1:]), strict=True)]
    lx, ly, lz, cy, cr, q, *rest = got
    backs, singles = rest[:KEPT], [s[turn] for s in rest[KEPT:]]
    lq = np.log10(q.astype(float) + sum(b.astype(float) * s for b, s in zip(backs, singles, strict=True)) / KEPT)
    score, base, seen = (np.zeros(len(ids)) for _ in range(3))
    for n, marks, logs, c in ((nx, mx, lx, counts[wx]), (ny, my, ly, cy), (nz, mz, lz, counts[wz]), (nq, mq, lq, cr[turn])):
        doc = (marks & np.uint16((1 << 15) - 1)).astype(np.int64)
        for sums, v in ((score, logs.astype(float)), (base, np.log10(c + 1.0)), (seen, c > 0)):
            sums += np.bincount(doc, np.repeat(v, n), len(ids))
    return pa.table({
        "doc_id": pa.array(ids, pa.int64(), mask=has == 0), "held_out": pa.array(held == 1), "n_tokens": pa.array(size.astype(np.int64)), "n_known": pa.array(seen.astype(np.int64)),
        "train_tokens": pa.array(np.full(len(ids), train_tokens, np.int64)), "base_score": pa.array(base - size * np.log10(train_tokens + known + 1.0)), "score": pa.array(score),
    })


_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and how often they occur, each once in some COUNT_TOKENS tokens."""
    waiting: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        word, n = np.unique(np.concatenate(waiting), return_counts=True)
        waiting.clear()
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], names=["word", "n"])

    for b in batches:
        for _, _, buf, offs in tb.slices(b.column(0)):
            waiting.append(tokens(buf, offs)[0])
            if sum(map(len, waiting)) >= COUNT_TOKENS:
                yield flush()
    if waiting:
        yield flush()


def head_words(texts: DataFrame, most: int) -> np.ndarray:
    """Hashes of the most frequent words of all texts, so many at most, frequent ones first."""
    counts = texts.mapInArrow(lambda b: tb.tidy(_words(b)), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    first = cut(counts.orderBy(F.desc("n"), "word").limit(most), "head")  # written by one task: collected at once, each partition's first ones would come to the driver
    found = sorted(first.collect(), key=lambda r: (-r.n, r.word))
    drop(first)
    return np.array([r.word for r in found], np.int64).view(np.uint64)


def _discount(once: float, twice: float) -> float:
    """From the numbers of pairs that occur once and twice; between 0.1 and 0.95."""
    return float(np.clip(once / (once + 2 * twice) if once else 0.5, 0.1, 0.95))


def scores(docs: DataFrame, mod: int = 7, held: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    A null or empty text is its end alone. Repeated rows count each for itself, in training and in the result; a null
    doc_id counts as empty text for the fold. Without training rows all words are unknown and a score is 0. An empty table
    gives an empty one; columns other than doc_id and text are not read. log10 p is summed over a document's tokens; a long
    text is a chunk of its own. Calling it runs the passes up to the last sweep; the scores come when the result is read.
    """
    chars = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    codes, buckets = Codes(head_words(docs.select("text"), HEAD)), max(1, -(-chars // BUCKET_CHARS))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", fold("doc_id", mod).alias("fold"))
    dealt = rows.mapInArrow(lambda b: tb.tidy(_chunks(codes, buckets, held, b)), _CHUNKS).repartition(2 * buckets, "bucket")
    merged = cut(dealt.groupBy("bucket").applyInArrow(lambda t: _merge(t, buckets), _MERGED), "pairs")
    models = merged.where("bucket >= 0").select("bucket", "model")
    got = _collect(models.mapInArrow(lambda b: tb.tidy(_counts(b)), "block int, part int, data binary"))
    if not len(got):
        got = np.zeros(4 * HEAD + 5)
    customers, counts, (tokens_in, tail, once, twice), sums = got[:HEAD], got[HEAD : 2 * HEAD], got[2 * HEAD : 2 * HEAD + 4], got[2 * HEAD + 4 :]
    known = float(tail + (counts > 0).sum())
    totals = lambda s, strength, discount: Totals(customers, s[:HEAD], s[HEAD : 2 * HEAD], float(s[HEAD : 2 * HEAD + 1].sum()), strength, discount, known)
    after = [totals(sums, STRENGTH, _discount(once, twice))]
    seated = models.mapInArrow(lambda b: tb.tidy(_begin(b)), _SEATS)
    for sweep in range(BURN + KEPT if tokens_in else 0):
        forget(docs.sparkSession)  # the chunks' shuffle, larger than all that follows: Spark may refer to it for a while after its job
        asked = seated.where("data is not null").repartition(2 * buckets, "bucket").groupBy("bucket")
        stepped = cut(asked.applyInArrow(lambda t: _sample(after, t), _SEATS), "seats")
        if sweep:
            drop(seated)
        seated = stepped
        got = _collect(seated.where("sums is not null").select("sums").mapInArrow(lambda b: tb.tidy(_summed(b)), "block int, part int, data binary"))
        sums, last = got[: 2 * HEAD + 1], after[-1]
        rng = np.random.Generator(np.random.PCG64([sweep, 2026]))
        head = seats(rng, customers, sums[:HEAD].astype(np.int64), np.zeros(0, np.int64), last.strength, last.discount)
        after.append(totals(sums, *parameters(rng, got[2 * HEAD + 1 :] + head)))
    forget(docs.sparkSession)
    whole = merged.where("bucket >= 0").select("*", F.lit(None).cast("long").alias("sweep"), F.lit(None).cast("binary").alias("kept"))
    if tokens_in:
        kept = seated.where(F.col("kind") == SEATED).select("bucket", F.col("sender").alias("sweep"), F.col("data").alias("kept"))
        whole = whole.unionByName(kept, allowMissingColumns=True)
    after = after if tokens_in else after * (BURN + KEPT + 1)
    answers = whole.repartition(2 * buckets, "bucket").groupBy("bucket").applyInArrow(lambda t: _answers(after, t), _CHUNKS)
    homes = merged.where("bucket < 0").select("bucket", F.get("chunks", F.lit(0)).alias("chunk"), F.col("model").alias("data"))
    return homes.unionByName(answers).groupBy("chunk").applyInArrow(lambda t: _finish(t, counts, int(tokens_in), int(known)), _RESULT)
