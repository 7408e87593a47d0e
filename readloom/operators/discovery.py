"""Whitelist discovery: counts of canonical barcodes, a knee, near copies merged, a whitelist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import canonical, deletions, usable
from ..plans.lineage import cut
from .ranking import numbered


def count_barcodes(reads: DataFrame, columns: list[str], lengths: dict[str, int | None] | None = None) -> DataFrame:
    """columns (canonical barcodes) and read_count of valid reads; rows with a missing barcode or one of another length than expected are out."""
    if "architecture" in reads.columns:
        reads = reads.where(F.col("architecture") == "valid")
    kept = reads.select(*(usable(f"{x}_Sequences").alias(x) for x in columns)).dropna()
    kept = kept.select(*(canonical(x).alias(x) for x in columns))
    for x, n in (lengths or {}).items():
        if n is not None:
            kept = kept.where(F.length(x) == n)
    return kept.groupBy(*columns).agg(F.count("*").alias("read_count"))


def ranked(counts: DataFrame) -> DataFrame:
    """counts with rank (1: most reads); ties go by barcode. Runs jobs; nearly all barcodes may have the same count."""
    columns = [c for c in counts.columns if c != "read_count"]
    return numbered(counts, F.desc("read_count"), *columns)


def knee(counts: DataFrame, min_reads: int = 3, ratio: float = 0.01, expected: int | None = None) -> DataFrame:
    """One row: cliff_rank, cliff_count, threshold, n_knee.

    Of the barcodes with min_reads or more, ranked by count, the cliff is where log10 rank and log10 count, each scaled to 0..1,
    have the largest sum (the first such place; the first rank if one of the scales has no width); or it is the rank `expected`. The threshold is
    the larger of min_reads and ratio times the count there. Counts of one value have one point each, at their last rank, where the sum is largest.
    """
    kept = counts.where(F.col("read_count") >= min_reads)
    by = kept.groupBy("read_count").agg(F.count("*").alias("n"))
    steps = by.select("read_count", "n", F.sum("n").over(Window.orderBy(F.desc("read_count"))).alias("last"))
    span = steps.agg(F.max("last").alias("rows"), F.max("read_count").alias("hi"), F.min("read_count").alias("lo"))
    if expected:
        at = steps.crossJoin(span).where(F.col("last") >= F.least(F.lit(expected), F.col("rows"))).agg(F.max("read_count").alias("cliff_count"), F.least(F.lit(expected), F.max("rows")).alias("cliff_rank"))
    else:
        x = F.log10("last") / F.log10("rows")
        y = (F.log10("read_count") - F.log10("lo")) / (F.log10("hi") - F.log10("lo"))
        flat = (F.col("rows") <= 1) | (F.col("hi") == F.col("lo"))
        score = F.when(flat, -F.col("last").cast("double")).otherwise(x + y - 1)
        points = steps.crossJoin(span).select(score.alias("score"), F.when(flat, 1).otherwise(F.col("last")).alias("rank"), "read_count")
        best = points.agg(F.max_by(F.struct("rank", "read_count"), F.struct("score", -F.col("rank"))).alias("b"))
        at = best.where("b is not null").select(F.col("b.read_count").alias("cliff_count"), F.col("b.rank").alias("cliff_rank"))
    cut = at.where("cliff_count is not null").withColumn("threshold", F.greatest(F.lit(float(min_reads)), F.col("cliff_count") * ratio))
    return kept.crossJoin(F.broadcast(cut)).where("read_count >= threshold").groupBy(F.col("cliff_rank").cast("long"), "cliff_count", "threshold").agg(F.count("*").alias("n_knee"))


def above_knee(counts: DataFrame, **how) -> DataFrame:
    return counts.crossJoin(F.broadcast(knee(counts, **how).select("threshold"))).where("read_count >= threshold").drop("threshold")


def near_pairs(barcodes: DataFrame, columns: list[str], distance: int = 1) -> DataFrame:
    """(a, b, dist): pairs of different barcodes (arrays, one element a column) whose distances add up to no more than `distance` (1).

    Two such share a variant with one character deleted in one column, or one is a variant of the other: an equi-join.
    """
    if distance != 1:
        raise ValueError("deletion variants of one character find pairs of distance 1")
    rows = barcodes.select(F.array(*columns).alias("a"))
    replaced = lambda k, v: F.array(*(v if i == k else F.get("a", F.lit(i)) for i in range(len(columns))))
    variants = F.concat(F.array(F.col("a")), *(_variants(k, replaced) for k in range(len(columns))))
    keyed = rows.select("a", F.explode(F.array_distinct(variants)).alias("key"))
    pairs = keyed.join(keyed.withColumnRenamed("a", "b"), "key").where("a != b").select("a", "b").distinct()
    total = sum((F.levenshtein(F.get("a", F.lit(k)), F.get("b", F.lit(k))) for k in range(len(columns))), F.lit(0))
    return pairs.withColumn("dist", total).where(F.col("dist") <= distance)


def _variants(k: int, replaced) -> Column:
    return F.transform(deletions(F.get("a", F.lit(k))), lambda v: replaced(k, v))


def merge_near(barcodes: DataFrame, columns: list[str], distance: int = 1) -> DataFrame:
    """columns, read_count, canonical (array): barcodes in order of their counts (ties by barcode); each joins the first canonical one next to it, or is canonical itself.

    A barcode's fate depends on those with more reads, so rounds settle it: a barcode is canonical once none of its larger neighbours can
    be, and merged once one of them is. Each round is a join on the pairs; no barcode list comes to the driver.
    """
    base = barcodes.select(*columns, "read_count", F.array(*columns).alias("a"))
    pairs = near_pairs(barcodes, columns, distance).select("a", "b")
    order = base.select("a", F.struct((-F.col("read_count")).alias("c"), F.col("a").alias("name")).alias("o"))
    larger = pairs.join(order.withColumnRenamed("o", "oa"), "a").join(order.select(F.col("a").alias("b"), F.col("o").alias("ob")), "b").where("ob < oa").select("a", "b", "ob")
    larger = cut(larger, "merge-pairs")
    state = base.select("a").withColumn("state", F.lit(None).cast("string")).withColumn("to", F.lit(None).cast("array<string>"))
    while True:
        open_ = state.where("state is null")
        seen = open_.select("a").join(larger, "a", "left").join(state.select(F.col("a").alias("b"), F.col("state").alias("sb")), "b", "left")
        verdict = seen.groupBy("a").agg(
            F.min(F.when(F.col("sb") == "canonical", F.struct("ob", F.col("b").alias("to")))).alias("into"),
            F.coalesce(F.sum(F.when(F.col("b").isNotNull() & F.col("sb").isNull(), 1)), F.lit(0)).alias("unsettled"),
            F.min(F.when(F.col("b").isNotNull() & F.col("sb").isNull(), F.col("ob"))).alias("first_open"),
        )
        # the first canonical neighbour counts once no open neighbour comes before it
        merged = F.col("into").isNotNull() & (F.col("first_open").isNull() | (F.col("into.ob") < F.col("first_open")))
        verdict = verdict.select("a", F.when(merged, "merged").when(F.col("into").isNull() & (F.col("unsettled") == 0), "canonical").alias("s2"), F.when(merged, F.col("into.to")).alias("t2"))
        state = state.join(verdict, "a", "left").select("a", F.coalesce("state", "s2").alias("state"), F.coalesce("to", "t2").alias("to"))
        state = cut(state, "merge-state")
        if not state.where("state is null").limit(1).count():
            break
    out = base.join(state, "a").select(*columns, "read_count", F.coalesce("to", "a").alias("canonical"))
    return out


def whitelist(merged: DataFrame, columns: list[str]) -> DataFrame:
    """cell_id from 1 in order of reads (merged ones added), the columns, and cell: the different barcodes joined by "-"."""
    total = merged.groupBy("canonical").agg(F.sum("read_count").alias("reads"))
    rows = total.select(*(F.get("canonical", F.lit(k)).alias(x) for k, x in enumerate(columns)), "reads", F.array_join(F.array_distinct("canonical"), "-").alias("cell"))
    rank = ranked(rows.select(*columns, "cell", F.col("reads").alias("read_count"))).withColumnRenamed("read_count", "reads")
    return rank.select(F.col("rank").cast("long").alias("cell_id"), *columns, "cell", "reads")


def statuses(counts: DataFrame, merged: DataFrame, columns: list[str]) -> DataFrame:
    """columns, read_count (canonical ones with the reads merged into them) and status: canonical, merged_into:X or below_knee."""
    name = F.array_join("canonical", "-")
    same = F.col("canonical") == F.array(*columns)
    added = merged.where(~same).groupBy("canonical").agg(F.sum("read_count").alias("more"))
    mark = merged.select(*columns, F.when(same, "canonical").otherwise(F.concat(F.lit("merged_into:"), name)).alias("status"))
    out = counts.join(mark, columns, "left").withColumn("status", F.coalesce("status", F.lit("below_knee")))
    out = out.join(added, (F.array(*columns) == F.col("canonical")) & (F.col("status") == "canonical"), "left")
    return out.select(*columns, (F.col("read_count") + F.coalesce("more", F.lit(0))).alias("read_count"), "status")


def statistics(counts: DataFrame, merged: DataFrame, columns: list[str]) -> DataFrame:
    """name, value rows: barcodes and reads observed, those over the knee, cells, and for each column different and canonical barcodes."""
    c = counts.agg(F.count("*").alias("unique_barcode_tuples_observed"), F.sum("read_count").alias("total_reads_with_barcodes"), *(F.countDistinct(x).alias(f"{x}_unique_observed") for x in columns))
    m = merged.agg(F.count("*").alias("tuples_above_knee"), F.countDistinct("canonical").alias("canonical_cells_after_merge"), *(F.countDistinct(F.get("canonical", F.lit(k))).alias(f"{x}_canonical") for k, x in enumerate(columns)))
    wide = c.crossJoin(m)
    return wide.select(F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).cast("long").alias("value")) for n in wide.columns))).alias("r")).select("r.*")


def discover(reads: DataFrame, columns: list[str], min_reads: int = 3, ratio: float = 0.5, expected: int | None = None, lengths: dict[str, int | None] | None = None) -> dict[str, DataFrame]:
    """counts, ranked, knee, merged, whitelist, statuses and statistics of the barcodes of reads."""
    counts = count_barcodes(reads, columns, lengths)
    top = above_knee(counts, min_reads=min_reads, ratio=ratio, expected=expected)
    merged = merge_near(top, columns)
    return {
        "counts": counts, "ranked": ranked(counts), "knee": knee(counts, min_reads, ratio, expected), "merged": merged,
        "whitelist": whitelist(merged, columns), "statuses": statuses(counts, merged, columns), "statistics": statistics(counts, merged, columns),
    }
