"""Packing: texts become one long run of ids, cut into windows of equal length.

Two passes. The first tokenises every document once and writes its ids with the number of ids before it in its
partition. Sums over partitions, added up in partition order, then give every document its place in the whole run;
the second pass cuts at multiples of the window. A document cut by a window's edge has one record for each piece.
All windows are full but the last, which is padded to the window unless its length is a power of two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbatch as tb
from .store import cut

WINDOW, END = 4096, 2
#: Words kept with their ids in a Python worker (some 40 bytes each).
CACHED = 2_000_000
#: ASCII marks that the tokenizer cuts off behind an ASCII letter or digit. Not ', which begins endings of its own, nor < | >, which special tokens have.
_TRAIL = tb.byte_table(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")
_ALNUM = tb.byte_table(bytes([*range(48, 58), *range(65, 91), *range(97, 123)]))


class WordIds:
    """Ids of the parts of words that this tokenizer treats one by one; frequent parts are tokenised once.

    Parts are white-space separated words, and of those the marks at the end; ASCII parts count in lower case, as the
    tokenizer lowers them anyway. Parts go to the tokenizer many at a time with a special token between them.
    """

    _made: dict[str, WordIds] = {}

    @classmethod
    def of(cls, path: str) -> WordIds:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark_id, self.mark = min((k, t.content.encode()) for k, t in self.tokenizer.get_added_tokens_decoder().items())
        self.clear()

    def clear(self) -> None:
        #: Sorted hashes of the parts, and where each one's ids begin and how many there are.
        self.key, self.start, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat, self.n_flat = np.zeros(1 << 16, np.uint32), 0

    def _ids(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, np.uint32)

    def _tokenise(self, parts: list[bytes], special: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, and of each part where they begin and how many they are; parts that may hold a special token go alone."""
        sizes, out = np.zeros(len(parts), np.int32), []
        order = np.concatenate([np.flatnonzero(~special), np.flatnonzero(special)])
        plain = len(parts) - int(special.sum())
        for lo in range(0, plain, 4000):
            some = order[lo : min(lo + 4000, plain)]
            ids = self._ids(self.mark.join([parts[k] for k in some]))
            cuts = np.flatnonzero(ids == self.mark_id)
            sizes[some] = np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
            out.append(np.delete(ids, cuts))
        for k in order[plain:]:
            out.append(self._ids(parts[k]))
            sizes[k] = len(out[-1])
        start = np.zeros(len(parts), np.int64)
        start[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate(out) if out else np.zeros(0, np.uint32), start, sizes

    def _add(self, key: np.ndarray, ids: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> None:
        while self.n_flat + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        self.flat[self.n_flat : self.n_flat + len(ids)] = ids
        at = np.searchsorted(self.key, key)
        self.key, self.start, self.size = (np.insert(a, at, b) for a, b in ((self.key, key), (self.start, start + self.n_flat), (self.size, sizes)))
        self.n_flat += len(ids)

    def slice_ids(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts of a slice, and how many each text has."""
        r = tb.runs(buf, offs, tb.SPACE)
        if not r.n:
            return np.zeros(0, np.uint32), np.zeros(len(offs) - 1, np.int64)
        # the marks at a word's end, if an ASCII letter or digit stands before them
        stop = np.flatnonzero(~_TRAIL[buf])
        last = np.searchsorted(stop, r.end) - 1
        core = np.where(last >= 0, stop[np.maximum(last, 0)] + 1, 0)
        cut_off = (core > r.start) & (core < r.end) & _ALNUM[buf[np.maximum(core, 1) - 1]]
        start, end, doc = (np.concatenate([x, y]) for x, y in ((r.start, core[cut_off]), (np.where(cut_off, core, r.end), r.end[cut_off]), (r.doc, r.doc[cut_off])))
        order = np.argsort(start, kind="stable")
        parts = tb.Runs(start[order], end[order], doc[order], r.first)
        count = lambda mask: (lambda c: c[parts.end] - c[parts.start])(np.concatenate([[0], np.cumsum(mask)]))
        special, foreign = count(buf == 60) > 0, count(buf >= 128) > 0
        as_is = special | foreign
        h = np.where(as_is, tb.mix(tb.run_hash(buf, parts)), tb.run_hash(buf, parts, tb.LOWER))
        keys, first, of = np.unique(h, return_index=True, return_inverse=True)
        new = np.flatnonzero(~tb.member(keys, self.key))
        if len(self.key) + len(new) > CACHED or self.n_flat > 8 * CACHED:
            self.clear()
            new = np.arange(len(keys))
        if len(new):
            at, raw, low = first[new], buf.tobytes(), tb.LOWER[buf].tobytes()
            texts = [(raw if x else low)[a:b] for a, b, x in zip(parts.start[at].tolist(), parts.end[at].tolist(), as_is[at].tolist(), strict=True)]
            self._add(keys[new], *self._tokenise(texts, special[at]))
        at = np.searchsorted(self.key, keys)[of]
        size, begin = self.size[at].astype(np.int64), self.start[at]
        total = np.cumsum(size)
        ids = self.flat[np.repeat(begin - (total - size), size) + np.arange(total[-1])]
        return ids, np.bincount(parts.doc, weights=size, minlength=len(offs) - 1).astype(np.int64)


def _tokenise(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, partition, ids before the document in its partition, number of ids, ids as little-endian uint16 (uint32 if `wide`)."""
    words, before = WordIds.of(path), 0
    part = TaskContext.get().partitionId()
    for b in batches:
        for lo, hi, buf, offs in tb.slices(b.column(1), 2 * tb.SLICE):
            ids, sizes = words.slice_ids(buf, offs)
            upto = np.concatenate([[0], np.cumsum(sizes)])
            rows = [np.append(ids[upto[k] : upto[k + 1]], np.uint32(END)).astype("<u4") for k in range(hi - lo)]
            wide = [bool(len(x) and x.max() >= 1 << 16) for x in rows]
            blobs = [x.tobytes() if w else x.astype("<u2").tobytes() for x, w in zip(rows, wide, strict=True)]
            n = sizes + 1
            at = before + np.cumsum(n) - n
            before += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo), pa.array(np.full(hi - lo, part, np.int32)), pa.array(at), pa.array(n), pa.array(blobs, pa.binary()), pa.array(wide, pa.bool_())],
                names=["doc_id", "part", "before", "n", "ids", "wide"],
            )


def _pieces(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        doc, start, length, crc, total, seq, off, edge = ([] for _ in range(8))
        for doc_id, at, n, blob, wide in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
            ids = np.frombuffer(blob, "<u4" if wide else "<u2").astype("<u4")
            done = 0
            while done < n:
                here = (at + done) % window
                size = min(n - done, window - here)
                for column, value in zip((doc, start, length, crc, total, seq, off, edge), (doc_id, done, size, zlib.crc32(ids[done : done + size].tobytes()), n, (at + done) // window, here, size < n), strict=True):
                    column.append(value)
                done += size
        long = pa.int64()
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc, long), *(pa.array(x, long) for x in (start, length, crc, total, seq, off)), pa.array(edge, pa.bool_())],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "boundary"],
        )


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, boundary.

    A null or empty text is its end id alone. Repeated rows are packed each for itself, null ids too; an empty table
    gives no pieces; columns other than doc_id and text are not read. Sums over partitions, one number for each
    partition, come to the driver and go out again; nothing else does.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    ids = cut(rows.mapInArrow(lambda batches: tb.tidy(_tokenise(tokenizer, batches)), "doc_id long, part int, before long, n long, ids binary, wide boolean"), "packed-ids")
    first, total = [], 0
    for r in sorted(ids.groupBy("part").agg(F.sum("n").alias("n")).collect()):
        first.append((r.part, total))
        total += r.n
    begin = spark.createDataFrame(first, "part int, first long")
    placed = ids.join(F.broadcast(begin), "part").select("doc_id", (F.col("first") + F.col("before")).alias("at"), "n", "ids", "wide")
    return placed.mapInArrow(lambda batches: tb.tidy(_pieces(window, batches)), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, boundary boolean")
