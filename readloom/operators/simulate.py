"""Simulated reads with a label for every base.

Each read has a random generator of its own, seeded by its number, so the same reads come from any partitioning.
Transcripts of a table have running numbers in order of their names; a read draws numbers by a keyed hash, over all of them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.config import FORWARD, REVERSED, Structure
from .ranking import numbered

BASES = "ACGT"
_COMPLEMENT = str.maketrans("ACGT", "TGCA")
INSERT, TAILS = "cDNA", ("polyA", "polyT")
#: Bases of a tail and of a spacer at most.
TAIL, SPACER = 50, 50


@dataclass(frozen=True)
class Noise:
    mismatch: float = 0.05
    insertion: float = 0.05
    deletion: float = 0.06
    tail: float = 0.02
    max_insertions: int = 1

    def of(self, label: str) -> tuple[float, float, float]:
        """Rates of a base: tails have their own, inserts and ACC none."""
        if label in TAILS:
            return (self.tail,) * 3
        return (0.0, 0.0, 0.0) if label in (INSERT, "ACC") else (self.mismatch, self.insertion, self.deletion)


@dataclass(frozen=True)
class Shape:
    """Lengths of inserts (the upper one is not reached) and of spacers, and bases cut off the ends at most."""

    insert: tuple[int, int] = (100, 500)
    spacer: tuple[int, int] = (0, 50)
    cut_5p: int = 0
    cut_3p: int = 0


def reverse_complement(seq: str) -> str:
    return seq[::-1].translate(_COMPLEMENT)


def free(pattern: str) -> bool:
    """Patterns without a direction."""
    return bool(re.match(r"N\d+", pattern)) or pattern in ("NN", "RN")


def turned(pattern: str, complement: bool, mirror: bool) -> str:
    """A pattern complemented and mirrored; tails have no order, free patterns neither."""
    if free(pattern):
        return pattern
    out = pattern.translate(_COMPLEMENT) if complement else pattern
    return out[::-1] if mirror and len(out) > 1 else out


#: What each orientation does to a pattern: complement it, mirror it.
_DOES = {FORWARD: (False, False), REVERSED: (True, True), "reverse": (False, True)}


def change(pattern: str, now: str, then: str) -> str:
    """From one orientation to another: what only one of them does. A tail that is only complemented on the way from rev to reverse stays."""
    (c1, m1), (c2, m2) = _DOES[now], _DOES[then]
    if now == REVERSED and then == "reverse" and pattern in ("A", "T"):
        return pattern
    return turned(pattern, c1 != c2, m1 != m2)


def fragment(s: Structure, orientation: str) -> tuple[list[str], list[str]]:
    """Names and patterns of one copy. Segments with an orientation of their own have it whatever the copy's is."""
    order, patterns = list(s.order), list(s.patterns)
    if orientation != FORWARD:
        order, patterns = order[::-1], [turned(p, *_DOES[orientation]) for p in patterns[::-1]]
    return order, [change(p, orientation, s.rc_elements.get(n, orientation)) for n, p in zip(order, patterns, strict=True)]


def layout(s: Structure) -> tuple[list[str], list[str]]:
    """All copies, with spacers before, between and after them."""
    order, patterns = [INSERT], ["RN"]
    for turn in s.rc_pattern:
        names, own = fragment(s, turn)
        order, patterns = [*order, *names, INSERT], [*patterns, *own, "RN"]
    return order, patterns


def _random(rng: np.random.Generator, n: int) -> str:
    return "".join(BASES[k] for k in rng.integers(0, 4, n))


@dataclass
class Maker:
    """Draws the sequences of one read's segments. transcript: gives the next transcript; its argument is the length of a random one."""

    rng: np.random.Generator
    shape: Shape
    transcript: Callable[[int], str]

    def insert(self, lengths: tuple[int, int]) -> str:
        """An end of a transcript, either one alike."""
        n = int(self.rng.integers(*lengths))
        source = self.transcript(n)
        from_front = len(source) > n and bool(self.rng.integers(2))
        return source[:n] if from_front else source[-n:]

    def spacer(self) -> str:
        low, high = self.shape.spacer
        n = min(SPACER, int(self.rng.integers(low, high, endpoint=True)))
        return self.transcript(n)[:n]

    def of(self, pattern: str, lengths: tuple[int, int]) -> str:
        """A fixed sequence stays; NN, RN, a tail's base and N<length> stand for an insert, a spacer, a tail and random bases."""
        match pattern:
            case "NN":
                return self.insert(lengths)
            case "RN":
                return self.spacer()
            case "A" | "T":
                return pattern * int(self.rng.integers(TAIL))
        count = re.match(r"N(\d+)", pattern)
        return _random(self.rng, int(count[1])) if count else pattern

    def shortened(self, size: int, most: int, label: str) -> int:
        """Bases to cut off an end: none of an insert."""
        return int(self.rng.integers(most, endpoint=True)) if most and size and label != INSERT else 0


def assemble(rng: np.random.Generator, s: Structure, shape: Shape, transcript: Callable[[int], str]) -> tuple[str, list[str]]:
    maker = Maker(rng, shape, transcript)
    names, patterns = layout(s)
    pieces = [maker.of(p, s.length_range or shape.insert) for p in patterns]
    seq, labels = "".join(pieces), np.repeat(np.array(names, object), [len(x) for x in pieces]).tolist()
    front = maker.shortened(len(seq), shape.cut_5p, labels[0] if labels else "")
    seq, labels = seq[front:], labels[front:]
    back = maker.shortened(len(seq), shape.cut_3p, labels[-1] if labels else "")
    keep = len(seq) - back if back < len(seq) else len(seq)
    return seq[:keep], labels[:keep]


_LETTERS = np.frombuffer(BASES.encode(), np.uint8)
_PLACE = np.full(256, -1)
_PLACE[_LETTERS] = np.arange(len(BASES))


def with_noise(rng: np.random.Generator, seq: str, labels: list[str], noise: Noise) -> tuple[str, list[str]]:
    """The read with errors, all bases at a time: one draw decides whether a base becomes another, gets more behind it, goes, or stays.

    A base that gets more gets one, and a further one with the same rate each, up to the most that there may be.
    """
    n = len(seq)
    if not n:
        return "", []
    kinds, kind = np.unique(np.array(labels, object).astype(str), return_inverse=True)
    mismatch, insertion, deletion = np.array([noise.of(k) for k in kinds.tolist()])[kind].T
    draw = rng.random(n)
    changed, longer = draw < mismatch, (draw >= mismatch) & (draw < mismatch + insertion)
    gone = ~changed & ~longer & (draw < mismatch + insertion + deletion)
    raw = np.frombuffer(seq.encode("latin-1"), np.uint8)
    place = _PLACE[raw]
    other = np.where(place >= 0, (place + rng.integers(1, 4, n)) % 4, rng.integers(0, 4, n))
    shown = np.where(changed, _LETTERS[other], raw)
    more = np.where(longer, np.minimum(rng.geometric(1 - np.minimum(insertion, 0.999)), noise.max_insertions), 0)
    copies = np.where(gone, 0, 1 + more)
    out = np.repeat(shown, copies)
    first = np.zeros(len(out), bool)
    first[(np.cumsum(copies) - copies)[copies > 0]] = True
    out[~first] = _LETTERS[rng.integers(0, 4, int((~first).sum()))]
    return out.tobytes().decode("latin-1"), np.repeat(np.array(labels, object), copies).tolist()


_SCHEMA = "ReadName string, read string, labels array<string>, structure_type string, expected_fragments int"


def _numbered(transcripts: DataFrame) -> tuple[DataFrame, int]:
    """number (0 to count - 1, by ReadName and read) and read of each transcript, and their count."""
    rows = numbered(transcripts.select("ReadName", "read"), "ReadName", "read", name="number", first=0).select("number", "read")
    return rows, rows.count()


def simulate(spark: SparkSession, structures: list[Structure], n: int, noise: Noise | None = None, shape: Shape | None = None, transcripts: DataFrame | list[str] = (), twins: bool = False, seed: int = 0, prefix: str = "sim_") -> DataFrame:
    """ReadName, read, labels, structure_type, expected_fragments of n reads, structures drawn by their shares; with twins, each also reverse-complemented.

    transcripts: a table of ReadName and read of any size, or a list; if there are none, inserts and spacers are random.
    """
    noise, shape = noise or Noise(), shape or Shape()
    numbered, total = _numbered(transcripts) if isinstance(transcripts, DataFrame) else (None, 0)
    known = [] if isinstance(transcripts, DataFrame) else list(transcripts)
    share = np.array([s.proportion for s in structures], float)
    share /= share.sum()
    wanted = [sum(p in ("NN", "RN") for p in layout(s)[1]) for s in structures]

    def start(k: int) -> tuple[np.random.Generator, int]:
        rng = np.random.Generator(np.random.PCG64([seed, int(k)]))
        return rng, int(rng.choice(len(structures), p=share))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(k, j) for k in b["id"] for j in range(wanted[start(k)[1]])], columns=["id", "slot"])

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, own in zip(b["id"], b["own"] if "own" in b else [None] * len(b), strict=True):
                rng, kind = start(k)
                s = structures[kind]
                if own is not None:
                    drawn = iter(own)
                    transcript = lambda _, drawn=drawn: next(drawn)
                else:
                    transcript = lambda size, rng=rng: known[rng.integers(len(known))] if known else _random(rng, size)
                seq, labels = assemble(rng, s, shape, transcript)
                for tag, read, marks in [("", seq, labels), ("_rc", reverse_complement(seq), labels[::-1])][: 1 + twins]:
                    noisy, own_marks = with_noise(rng, read, marks, noise)
                    rows.append((f"{prefix}{k}{tag}", noisy, own_marks, s.name, s.repeat))
            yield pd.DataFrame(rows, columns=["ReadName", "read", "labels", "structure_type", "expected_fragments"])

    if not total:
        return spark.range(n).mapInPandas(make, _SCHEMA)
    asked = spark.range(n).mapInPandas(ask, "id long, slot int").withColumn("number", F.pmod(F.xxhash64(F.lit(seed), "id", "slot"), F.lit(total)))
    drawn = asked.join(numbered, "number").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("slot", "read"))).alias("own"))
    return drawn.select("id", F.col("own.read").alias("own")).mapInPandas(make, _SCHEMA)


def rescale(structures: list[Structure], concat_fraction: float) -> list[Structure]:
    """Shares of single and concatenated structures such that the latter have this part of the reads."""
    from dataclasses import replace

    sums = {many: sum(s.proportion for s in structures if (s.repeat > 1) == many) for many in (False, True)}
    part = {True: concat_fraction, False: 1 - concat_fraction}
    return [replace(s, proportion=s.proportion / sums[s.repeat > 1] * part[s.repeat > 1] if sums[s.repeat > 1] else 0.0) for s in structures]


def longest_insert(structures: list[Structure], longest_read: int, tail: int = 25, spacer: int = 50) -> int:
    """Bases that an insert may have so that no read is over longest_read."""
    room = []
    for s in structures:
        fixed = sum(int(m[1]) if (m := re.match(r"N(\d+)", p)) else tail if p in ("A", "T") else 0 if free(p) else len(p) for p in s.patterns)
        inserts = max(1, sum(p == "NN" for p in s.patterns))
        room.append((longest_read - (s.repeat + 1) * spacer - s.repeat * fixed) // (s.repeat * inserts))
    return max(1, min(room))
