"""Places of rows in a total order, without a task that holds all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut

#: Bits of monotonically_increasing_id for the place within a partition.
_WITHIN = 33


def numbered(rows: DataFrame, *order: Column | str, name: str = "rank", first: int = 1) -> DataFrame:
    """rows with `name`, their place in this order from `first` on (long). Runs jobs.

    Rows are sorted by ranges and written; a row's place is its place in its range plus the sizes of the ranges before it, of which
    a number each comes to the driver. Ties come in any order, so name enough columns.
    """
    at = "__place"
    placed = cut(rows.orderBy(*order).withColumn(at, F.monotonically_increasing_id()), "ordered")
    part = F.shiftright(at, _WITHIN)
    starts, total = [], first
    for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():
        starts.append((r.part, total))
        total += r.n
    offsets = rows.sparkSession.createDataFrame(starts, "__part long, __first long")
    within = F.col(at).bitwiseAND(F.lit((1 << _WITHIN) - 1))
    return placed.join(F.broadcast(offsets), part == F.col("__part")).withColumn(name, F.col("__first") + within).drop(at, "__part", "__first")
