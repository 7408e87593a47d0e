"""UMI duplicates on a stream of alignments sorted by position.

State is kept for each key (contig, cell, strand, start bin, end bin): the leading UMIs. A watermark on event time drops keys that no
further alignment can fall in, as a sorted batch run drops position bins that lie behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.alignments import POSITION

OUT = "qname string, umi string, umi_leader string, is_dup boolean"


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance, or most + 1 if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def stream_duplicates(alignments: DataFrame, threshold: int = 2, time: str = "ts", late: str = "10 minutes") -> DataFrame:
    """qname, umi, umi_leader, is_dup of a stream with qname, rname, cb, strand, start, end, umi and an event time.

    Within a batch, rows of a key go in order of start and name; leaders stay until the watermark passes.
    """
    rows = alignments.withWatermark(time, late).withColumn("sb", F.floor(F.col("start") / POSITION)).withColumn("eb", F.floor(F.col("end") / POSITION))

    def decide(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        leaders = list(state.get[0]) if state.exists else []
        parts = list(batches)
        out = []
        for r in pd.concat(parts).sort_values(["start", "qname"]).itertuples():
            lead = next((u for u in leaders if edit_distance(u, r.umi, threshold) <= threshold), None)
            if lead is None:
                leaders.append(r.umi)
            out.append((r.qname, r.umi, lead or r.umi, lead is not None))
        state.update((leaders,))
        last = max(p[time].max() for p in parts)
        state.setTimeoutTimestamp(max(int(last.timestamp() * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["qname", "umi", "umi_leader", "is_dup"])

    keyed = rows.groupBy("rname", "cb", "strand", "sb", "eb")
    return keyed.applyInPandasWithState(decide, OUT, "leaders array<string>", "append", GroupStateTimeout.EventTimeTimeout)


def stream_counts(events: DataFrame, time: str = "ts", late: str = "10 minutes", width: str = "5 minutes", key: str = "event_type") -> DataFrame:
    """Rows in each window of `width` by key, with late data up to `late`."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"))
