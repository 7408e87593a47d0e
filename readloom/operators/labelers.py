"""Labellers: functions from reads to reads with `labels`, a name for every base.

A trained network is a callable of the user's; the others need no model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.batching import with_backoff

#: Codes of bases for a network; others, and padding, are 0.
CODES = {"A": 1, "C": 2, "G": 3, "T": 4, "N": 5}


def from_truth(reads: DataFrame, truth: DataFrame) -> DataFrame:
    """Labels that a simulator wrote."""
    return reads.join(truth.select("ReadName", "labels"), "ReadName")


def encode(reads: list[str], width: int) -> np.ndarray:
    """A row of codes for each read, cut or padded to `width`."""
    table = np.zeros(256, np.int32)
    for base, code in CODES.items():
        table[ord(base)] = code
    out = np.zeros((len(reads), width), np.int32)
    for k, r in enumerate(reads):
        raw = np.frombuffer(r.encode("ascii", "replace")[:width], np.uint8)
        out[k, : len(raw)] = table[raw]
    return out


def padded_width(bin_end: int, kernels: list[tuple[int, int]] | None = None) -> int:
    """Columns for reads of a bin: its end, one more, and half the widest reach of (kernel, dilation), 12 if unknown."""
    return bin_end + 1 + (max((k - 1) * d // 2 for k, d in kernels) if kernels else 12)


def with_model(reads: DataFrame, make: Callable[[], Callable[[np.ndarray], np.ndarray]], names: list[str], width: int | None = None, batch: int = 32) -> DataFrame:
    """Labels by a user's model: make() builds, once a worker, a function from codes (reads x width) to class ids of the same shape. Class names are sorted, as a binarizer sorts them. Where memory runs out, batches are halved."""
    known = sorted(names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()

        def label(texts: list[str], size: int) -> list[list[str]]:
            out: list[list[str]] = []
            for lo in range(0, len(texts), size):
                part = texts[lo : lo + size]
                ids = model(encode(part, width or max(map(len, part), default=1)))
                out += [[known[i] for i in row[: len(r)]] for r, row in zip(part, ids, strict=True)]
            return out

        for b in batches:
            labels = with_backoff(lambda size, texts=b["read"].tolist(): label(texts, size), batch)
            yield b.assign(labels=labels)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in reads.schema) + ", labels array<string>"
    return reads.mapInPandas(run, schema)


def by_adapters(reads: DataFrame, adapters: dict[str, str], inner: dict[str, int], order: list[str], tail: str | None = None, insert: str = "cDNA", least_tail: int = 6) -> DataFrame:
    """Labels from exact adapters of reads in forward order: first adapter, segments of fixed length after it, a tail, the insert, last adapter.

    adapters: sequences by name; inner: lengths of the segments behind the first one; order: the names. JVM expressions only. Reads
    without the first adapter are all insert.
    """
    first, last = next(n for n in order if n in adapters), [n for n in order if n in adapters][-1]
    at = F.instr("read", adapters[first])
    parts, pos = [F.repeat(F.lit(insert + ","), F.greatest(at - 1, F.lit(0))), F.repeat(F.lit(first + ","), F.lit(len(adapters[first])))], at + len(adapters[first])
    for name, n in inner.items():
        here = F.greatest(F.least(F.lit(n), F.length("read") - pos + 1), F.lit(0))
        parts.append(F.repeat(F.lit(name + ","), here))
        pos = pos + here
    rest = F.col("read").substr(pos, F.length("read"))
    run = F.length(F.regexp_extract(rest, f"^({'T' if tail == 'polyT' else 'A'}*)", 1)) if tail else F.lit(0)
    run = F.when(run >= least_tail, run).otherwise(0)
    if tail:
        parts.append(F.repeat(F.lit(tail + ","), run))
    body = F.col("read").substr(pos + run, F.length("read"))
    end = F.instr(body, adapters[last]) if last != first else F.lit(0)
    inside = F.when(end > 0, end - 1).otherwise(F.length(body))
    parts += [F.repeat(F.lit(insert + ","), inside), F.when(end > 0, F.repeat(F.lit(last + ","), F.lit(len(adapters[last])))).otherwise("")]
    after = F.when(end > 0, F.length(body) - inside - len(adapters[last])).otherwise(0)
    parts.append(F.repeat(F.lit(insert + ","), F.greatest(after, F.lit(0))))
    text = F.when(at > 0, F.concat(*parts)).otherwise(F.repeat(F.lit(insert + ","), F.length("read")))
    return reads.withColumn("labels", F.filter(F.split(text, ","), lambda x: x != ""))
