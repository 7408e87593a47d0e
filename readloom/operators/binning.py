"""Length bins, merging of sparse bins, length histograms, samples of reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bin_width(length: Column, width: int = 500, threshold: int = 10000) -> Column:
    """Bins widen with length: `width` under the threshold, then 5 000, 10 000 and 25 000."""
    return F.when(length < threshold, width).when(length < 50000, 5000).when(length < 100000, 10000).otherwise(25000).cast("long")


def with_bin(reads: DataFrame, length: str = "read_length", width: int = 500, threshold: int = 10000) -> DataFrame:
    """Adds bin_start, bin_end (inclusive) and length_bin ("0_499bp"). Bins may overlap where widths change; a read is in the one its length gives."""
    w = bin_width(F.col(length).cast("long"), width, threshold)
    start = F.expr(f"cast(`{length}` as bigint)") - F.pmod(F.col(length).cast("long"), w)
    out = reads.withColumn("bin_start", start).withColumn("bin_end", start + w - 1)
    return out.withColumn("length_bin", F.concat(F.col("bin_start").cast("string"), F.lit("_"), F.col("bin_end").cast("string"), F.lit("bp")))


def merge_plan(bins: list[tuple[int, int, int]], least: int, fraction: float = 0.2, narrowest: int = 500) -> dict[tuple[int, int], tuple[int, int]]:
    """Which merged bin each (start, end, count) goes to.

    In ascending order a group takes the next existing bin while it has fewer than `least` reads and would not get
    wider than the larger of `narrowest` and `fraction` of its start. A group that may not grow stays as it is.
    """
    plan: dict[tuple[int, int], tuple[int, int]] = {}
    group: list[tuple[int, int, int]] = []

    def close() -> None:
        for start, end, _ in group:
            plan[start, end] = (group[0][0], group[-1][1])
        group.clear()

    for b in sorted(bins):
        if group:
            widest = max(narrowest, int(max(group[0][0], 1) * fraction))
            if sum(x[2] for x in group) >= least or b[1] - group[0][0] + 1 > widest:
                close()
        group.append(b)
    close()
    return plan


def merge_sparse_bins(binned: DataFrame, least: int, fraction: float = 0.2, narrowest: int = 500) -> DataFrame:
    """binned with length_bin, bin_start and bin_end of the merged bins. Bins are few (some hundreds): their counts come to the driver."""
    counts = [tuple(r) for r in binned.groupBy("bin_start", "bin_end").count().collect()]
    plan = merge_plan(counts, least, fraction, narrowest) if least > 0 else {(s, e): (s, e) for s, e, _ in counts}
    rows = [(s, e, a, z) for (s, e), (a, z) in plan.items()]
    mapping = binned.sparkSession.createDataFrame(rows, "bin_start long, bin_end long, to_start long, to_end long")
    out = binned.drop("length_bin").join(F.broadcast(mapping), ["bin_start", "bin_end"])
    out = out.withColumn("bin_start", F.col("to_start")).withColumn("bin_end", F.col("to_end")).drop("to_start", "to_end")
    return out.withColumn("length_bin", F.concat(F.col("bin_start").cast("string"), F.lit("_"), F.col("bin_end").cast("string"), F.lit("bp")))


def length_histogram(reads: DataFrame, length: str = "read_length", longest: float = 6000.0, bins: int = 100) -> DataFrame:
    """bin (0 to bins - 1), lower, upper, count of lengths over 0 and under `longest`, in bins of equal width between the smallest and largest of these; the last is closed.

    Lengths that are no numbers are left out. Empty bins have no row. log10 limits of plots follow from lower and upper.
    """
    kept = reads.select(F.col(length).cast("string").try_cast("double").alias("x")).where((F.col("x") > 0) & (F.col("x") < longest))
    span = kept.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0).cast("long")
    counted = kept.crossJoin(F.broadcast(span)).groupBy(place.alias("bin"), "lo", "hi").agg(F.count("*").alias("count"))
    return counted.select("bin", (F.col("lo") + F.col("bin") * width).alias("lower"), (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"), "count")


def read_index(binned: DataFrame) -> DataFrame:
    """One row a read name with its bin; of repeated names the largest bin label stays."""
    return binned.groupBy("ReadName").agg(F.max("length_bin").alias("length_bin"))


def sample_reads(reads: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n reads, drawn by a keyed hash of their names: the same ones on any cluster."""
    return reads.orderBy(F.xxhash64(F.lit(seed), "ReadName"), "ReadName").limit(n)


def reads_by_name(reads: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """Reads with these names, and the names that none has."""
    wanted = reads.sparkSession.createDataFrame([(x,) for x in dict.fromkeys(names)], "ReadName string")
    return reads.join(F.broadcast(wanted), "ReadName", "left_semi"), wanted.join(reads.select("ReadName"), "ReadName", "left_anti")
