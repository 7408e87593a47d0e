"""Encoding with a merge-type piece model under seeded merge-dropout, and decoding.

The agenda takes, among the merges that are possible, the one of the best score, the leftmost first. A candidate
merge is skipped if a hash of (seed, document, place of its left end, merged piece) falls under the dropout rate: so each
document gets another segmentation for each seed, and the same one for the same seed wherever it is computed.

White space: a text gets one space in front and spaces are the model's mark, as in the library. No piece has a
mark behind another character, so no merge crosses into a word's leading marks and the agenda runs word by word. Words
of one length are one matrix, a merge for all of them at a time; the few long words go through a heap.

Characters without a piece, and the mark itself where a text holds it, become their bytes; so every text comes back whole.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbatch as tb

MARK = "▁"
RATE, SEED = 0.1, 1
#: Words of more characters go through the heap.
LONG = 48
#: Agenda key of no merge; keys lose 1 with each place that they move, so all from _NEVER on are none.
_BIG, _NEVER = 1 << 30, 1 << 29
U64 = np.uint64


def _mix2(x: np.ndarray) -> np.ndarray:
    x = x * U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


class Pieces:
    """Pieces of a model file, and which pairs of them merge into which."""

    _made: dict[str, Pieces] = {}

    @classmethod
    def of(cls, path: str) -> Pieces:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        special = [sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k) or sp.is_byte(k) for k in range(n)]
        text = [sp.id_to_piece(k) for k in range(n)]
        known = {t: k for k, t in enumerate(text) if not special[k]}
        if any(MARK in t.lstrip(MARK) for t in known):
            raise ValueError("pieces with a mark inside are not supported")
        score = np.array([sp.get_score(k) for k in range(n)])
        #: 0 is the best score; equal scores have equal ranks.
        self.rank = np.unique(-score, return_inverse=True)[1].astype(np.int64)
        self.byte = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        self.char = np.full(0x110000, -1, np.int32)
        for t, k in known.items():
            if len(t) == 1:
                self.char[ord(t)] = k
        self.mark = known[MARK]
        self.char[ord(MARK)] = -1
        self.char[0x20] = self.mark
        self.size, self.unit = n, n + 1
        pairs = {known[t[:i]] * self.unit + known[t[i:]]: k for t, k in known.items() for i in range(1, len(t)) if t[:i] in known and t[i:] in known}
        self._table(pairs)
        # what a piece decodes to
        back = {int(b): bytes([v]) for v, b in enumerate(self.byte)}
        raw = [back.get(k, b"" if special[k] else text[k].replace(MARK, " ").encode()) for k in range(n)]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.array([len(x) for x in raw], np.int64)
        self.raw_at = np.cumsum(self.raw_size) - self.raw_size

    def _table(self, pairs: dict[int, int]) -> None:
        """Open addressing: keys and merged pieces, at most `probes` places from the hash."""
        self.bits = max(4, int(np.ceil(np.log2(max(2, 4 * len(pairs))))))
        self.keys, self.merged, self.probes = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32), 1
        keys = np.array(list(pairs), np.int64)
        for key, at in zip(keys.tolist(), self._slot(keys).tolist(), strict=True):
            tries = 1
            while self.keys[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
                tries += 1
            self.keys[at], self.merged[at], self.probes = key, pairs[key], max(self.probes, tries)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The merged piece of each pair, or -1. Negative symbols have none."""
        key = a.astype(np.int64) * self.unit + b
        key[(a < 0) | (b < 0)] = -2
        at = self._slot(key)
        got = self.keys[at]
        out = np.where(got == key, self.merged[at], -1)
        left = np.flatnonzero((got != key) & (got >= 0) & (key >= 0))
        at = at[left]
        while len(left):
            at = (at + 1) & ((1 << self.bits) - 1)
            got = self.keys[at]
            hit = got == key[left]
            out[left[hit]] = self.merged[at[hit]]
            on = ~hit & (got >= 0)
            left, at = left[on], at[on]
        return out

    def dropped(self, seed: np.ndarray, place: np.ndarray, merged: np.ndarray, rate: float) -> np.ndarray:
        h = _mix2(seed + place.astype(np.uint64) * U64(0xC2B2AE3D27D4EB4F) + merged.astype(np.uint64) * U64(0x165667B19E3779F9))
        return (h >> U64(40)).astype(np.float64) < rate * (1 << 24)

    def _keys_of(self, a: np.ndarray, b: np.ndarray, seed: np.ndarray, place: np.ndarray, slot: np.ndarray | int, rate: float) -> tuple[np.ndarray, np.ndarray]:
        """Agenda keys (rank, then slot; _BIG and more: no merge) and merged pieces of candidate pairs."""
        c = self.merge(a, b)
        key = np.where(c >= 0, self.rank[c] << 6 | slot, _BIG).astype(np.int32)
        if rate > 0:
            some = np.flatnonzero(c >= 0)
            gone = some[self.dropped(seed[some], place[some], c[some], rate)]
            key[gone] = _BIG
        return key, c

    def _words(self, sym: np.ndarray, seed: np.ndarray, place: np.ndarray, rate: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words of one length, a column each, place: of their first character in the text. Yields (columns, symbols) as they end."""
        length, n = sym.shape
        which = np.arange(n)
        start = np.repeat(np.arange(length, dtype=np.int64)[:, None], n, 1)
        key, to = np.empty((max(length - 1, 0), n), np.int32), np.empty((max(length - 1, 0), n), np.int32)
        for j in range(length - 1):
            key[j], to[j] = self._keys_of(sym[j], sym[j + 1], seed, place + j, j, rate)
        while length > 1:
            best = key.min(0)
            done = best >= _NEVER
            if done.any():
                yield which[done], sym[:, done]
                on = ~done
                if not on.any():
                    return
                which, sym, start, key, to, seed, place, best = which[on], sym[:, on], start[:, on], key[:, on], to[:, on], seed[on], place[on], best[on]
            at, col = (best & 63).astype(np.int64), np.arange(len(which))
            sym[at, col] = to[at, col]
            for j in range(1, length - 1):
                move = at < j
                np.copyto(sym[j], sym[j + 1], where=move)
                np.copyto(start[j], start[j + 1], where=move)
            for j in range(length - 2):
                move = at <= j
                np.copyto(key[j], key[j + 1] - 1, where=move)
                np.copyto(to[j], to[j + 1], where=move)
            length -= 1
            sym, start, key, to = sym[:length], start[:length], key[: length - 1], to[: length - 1]
            for side in (0, -1):
                j = at + side
                has = np.flatnonzero((j >= 0) & (j < length - 1))
                if len(has):
                    jj, cc = j[has], col[has]
                    key[jj, cc], to[jj, cc] = self._keys_of(sym[jj, cc], sym[jj + 1, cc], seed[has], place[has] + start[jj, cc], jj, rate)
        yield which, sym

    def _heap_word(self, sym: list[int], seed: int, place: int, rate: float) -> list[int]:
        """The same agenda for one long word."""
        n = len(sym)
        left, right = [*range(-1, n - 1)], [*range(1, n), -1]
        heap = []

        def push(pairs: list[tuple[int, int]]) -> None:
            if not pairs:
                return
            i, j = (np.array(x) for x in zip(*pairs, strict=True))
            a, b = np.array([sym[k] for k in i]), np.array([sym[k] for k in j])
            key, c = self._keys_of(a, b, np.full(len(i), seed, np.uint64), place + i, 0, rate)
            for k in np.flatnonzero(key < _BIG).tolist():
                heapq.heappush(heap, (int(key[k]) >> 6, int(i[k]), int(j[k]), sym[i[k]], sym[j[k]], int(c[k])))

        push([(k, k + 1) for k in range(n - 1)])
        while heap:
            _, i, j, a, b, c = heapq.heappop(heap)
            if sym[i] != a or sym[j] != b or right[i] != j or a is None:
                continue
            sym[i], sym[j] = c, None
            right[i] = right[j]
            if right[i] >= 0:
                left[right[i]] = i
            push([p for p in ((left[i], i), (i, right[i])) if p[0] >= 0 and p[1] >= 0])
        return [s for s in sym if s is not None]

    def encode(self, texts: list[str], seeds: np.ndarray, rate: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        texts = [" " + t if t else "" for t in texts]
        cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        if not len(cp):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        first = np.cumsum(size) - size
        sym = self.char[cp].astype(np.int32)
        unknown = sym < 0
        sym[unknown] = -1 - cp[unknown].astype(np.int32)
        space = cp == 0x20
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[first[size > 0]] = True
        at = np.flatnonzero(begins)
        width = np.diff(np.append(at, len(cp)))
        doc = np.searchsorted(first, at, "right") - 1
        place, seed = at - first[doc], seeds[doc]
        order = np.argsort(width, kind="stable")
        count, parts = np.zeros(len(at), np.int64), []
        ends = np.flatnonzero(np.diff(width[order], append=-1))
        lo = 0
        for hi in (ends + 1).tolist():
            words = order[lo:hi]
            lo = hi
            n = int(width[words[0]])
            if n > LONG:
                for w in words.tolist():
                    out = self._heap_word(sym[at[w] : at[w] + n].tolist(), int(seed[w]), int(place[w]), rate)
                    parts.append((np.array([w]), np.array(out, np.int32)[:, None]))
                continue
            for part in range(0, len(words), 1 << 15):
                some = words[part : part + (1 << 15)]
                block = sym[at[some][None] + np.arange(n)[:, None]]
                parts += [(some[k], s) for k, s in self._words(block, seed[some], place[some], rate)]
        for w, s in parts:
            count[w] = len(s)
        begin = np.cumsum(count) - count
        ids = np.empty(int(count.sum()), np.int64)
        for w, s in parts:
            ids[begin[w][None] + np.arange(len(s))[:, None]] = s
        of = np.repeat(doc, count)
        odd = ids < 0
        if odd.any():  # a character's bytes
            chars = [chr(c) for c in (-1 - ids[odd]).tolist()]
            raw = [c.encode("utf-8", "surrogatepass") for c in chars]
            wide = np.ones(len(ids), np.int64)
            wide[odd] = [len(x) for x in raw]
            ids, of, odd = np.repeat(ids, wide), np.repeat(of, wide), np.repeat(odd, wide)
            ids[odd] = self.byte[np.frombuffer(b"".join(raw), np.uint8)]
        return ids, np.bincount(of, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of the texts one after another, and how many each has: what encode was given, at any rate of dropout."""
        size = self.raw_size[ids]
        total = np.cumsum(size)
        raw = self.raw[np.repeat(self.raw_at[ids] - (total - size), size) + np.arange(int(total[-1]) if len(total) else 0)]
        upto = np.concatenate([[0], np.cumsum(count)])
        length = np.concatenate([[0], total])[upto]
        length = np.diff(length)
        first = np.cumsum(length) - length
        keep = np.ones(len(raw), bool)
        some = first[length > 0]
        keep[some[raw[some] == 0x20]] = False  # the space put in front
        short = np.zeros(len(length), np.int64)
        short[length > 0] = raw[some] == 0x20
        return raw[keep], length - short


def doc_seeds(ids: list, seed: int) -> np.ndarray:
    """A 64-bit seed of each document; a null id counts as empty text."""
    base = np.array([zlib.crc32(b"" if i is None else str(i).encode()) for i in ids], np.uint64)
    return tb.mix(base ^ (U64(seed & 0xFFFFFFFF) << U64(32)))


def _encode(path: str, rate: float, seed: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces = Pieces.of(path)
    for b in batches:
        for lo, hi, buf, offs in tb.slices(b.column(1)):
            raw = buf.tobytes()
            texts = [raw[x:y].decode() for x, y in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
            doc = b.column(0).slice(lo, hi - lo)
            ids, count = pieces.encode(texts, doc_seeds(doc.to_pylist(), seed), rate)
            back, size = pieces.decode(ids, count)
            whole = size == np.diff(offs)
            if whole.all():
                whole &= tb.per_doc(back != buf, offs) == 0
            else:  # not to be expected: compare one by one
                at = np.concatenate([[0], np.cumsum(size)])
                whole = np.array([back[at[k] : at[k + 1]].tobytes() == raw[offs[k] : offs[k + 1]] for k in range(hi - lo)])
            upto = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(upto), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([doc, listed, pa.array(count.astype(np.int32)), pa.array(whole)], names=["doc_id", "ids", "n_ids", "lossless"])


def encode(docs: DataFrame, model: str, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """doc_id, ids, n_ids, lossless (whether the ids decode to the very text) of every document.

    A null or empty text has no ids. Repeated rows of one id and text get the same ids; equal texts of different ids
    mostly get different ones. A null id is one id. An empty table gives an empty one; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda b: tb.tidy(_encode(model, rate, seed, b)), "doc_id long, ids array<int>, n_ids int, lossless boolean")


def _decode(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces = Pieces.of(path)
    for b in batches:
        ids = b.column(1).fill_null([]) if b.column(1).null_count else b.column(1)
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        raw, size = pieces.decode(flat, np.diff(ids.offsets.to_numpy()))
        at = np.concatenate([[0], np.cumsum(size)]).tolist()
        data = raw.tobytes()
        texts = [data[x:y].decode("utf-8", "replace") for x, y in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of encoded documents; null or no ids give an empty text."""
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(lambda b: tb.tidy(_decode(model, b)), "doc_id long, text string")
