"""Quality-control tables. Each function gives one small table from reads, alignments or a long count matrix.

Reads: valid and invalid annotations (with cell_id, corrected_X_min_dist where there are cells). Percentages are rounded to two
digits by halves up.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import fragment, known_cell, percent, remainder
from .ranking import numbered

#: Order of segments in reports, and numbers of bins that reports offer.
SEGMENT_ORDER = ["5p", "CBC", "UMI", "SLS", "polyT", "cDNA", "polyA", "3p", "random_s", "random_e"]
BIN_PRESETS = [50, 100, 200, 500, 1000, 2000, 5000, 10000, 20000, 50000, 100000, 200000, 300000, 400000, 500000, 1000000]
FAR = 5
COVERAGE_BINS, SHORTEST = 100, 100


def cell_column(columns: list[str]) -> str | None:
    return next((c for c in ("cell_id", "corrected_CBC") if c in columns), None)


def barcode_types(columns: list[str]) -> list[str]:
    return [m[1] for c in columns if (m := re.fullmatch(r"corrected_(.+)_min_dist", c)) and not m[1].endswith("_counts_with")]


def segments(columns: list[str]) -> list[str]:
    """Segments with coordinates: those of the fixed order first, others by name."""
    found = {c[: -len("_Starts")] for c in columns if c.endswith("_Starts") and f"{c[:-7]}_Ends" in columns}
    return [s for s in SEGMENT_ORDER if s in found] + sorted(found - set(SEGMENT_ORDER))


def _stack(row: DataFrame, pairs: list[tuple[Column, str, Column]]) -> DataFrame:
    """(keep, category, count) entries of a one-row table as rows with a place."""
    entries = F.array(*(F.struct(F.lit(k).alias("place"), keep.alias("keep"), F.lit(name).alias("category"), count.cast("long").alias("count")) for k, (keep, name, count) in enumerate(pairs)))
    return row.select("*", F.explode(entries).alias("e")).where("e.keep").select(*row.columns, "e.place", "e.category", "e.count")


def summary(valid: DataFrame, invalid: DataFrame) -> DataFrame:
    """One row: physical reads (total, valid, invalid, parents of fragments), fragments, valid with fragments, demuxed and ambiguous rows."""
    cell = cell_column(valid.columns)
    v = valid.agg(
        F.count("*").alias("rows"), F.count_if(fragment("ReadName")).alias("n_fragments"),
        (F.count_if(known_cell(cell)) if cell else F.lit(0).cast("long")).alias("n_demuxed"), (F.count_if(F.col(cell).cast("string") == "ambiguous") if cell else F.lit(0).cast("long")).alias("n_ambiguous"),
    )
    i = invalid.agg(F.count("*").alias("irows"), F.count_if(remainder("ReadName")).alias("n_concat_parents"))
    natural, wrong = F.col("rows") - F.col("n_fragments"), F.col("irows") - F.col("n_concat_parents")
    return v.crossJoin(i).select((natural + F.col("n_concat_parents") + wrong).alias("n_total"), natural.alias("n_valid"), wrong.alias("n_invalid"), "n_concat_parents", "n_fragments", F.col("rows").alias("n_effective_valid"), "n_demuxed", "n_ambiguous")


def read_architecture(totals: DataFrame) -> DataFrame:
    """category, count, percent of all reads; rows for concatenated reads and effective valid ones if reads were split."""
    yes, split = F.lit(True), F.col("n_fragments") > 0
    rows = _stack(totals, [(yes, "Total", F.col("n_total")), (yes, "Valid", F.col("n_valid")), (split, "Concatenated", F.col("n_concat_parents")), (yes, "Invalid", F.col("n_invalid")), (split, "Effective Valid", F.col("n_effective_valid"))])
    return rows.select("category", "count", percent(F.col("count"), F.col("n_total")).alias("percent"))


def barcode_assignment(totals: DataFrame) -> DataFrame:
    """category, count, percent of effective valid reads (valid ones if none was split)."""
    rows = _stack(totals, [(F.lit(True), "Demuxed", F.col("n_demuxed")), (F.lit(True), "Ambiguous", F.col("n_ambiguous"))])
    return rows.select("category", "count", percent(F.col("count"), F.when(F.col("n_fragments") > 0, F.col("n_effective_valid")).otherwise(F.col("n_valid"))).alias("percent"))


def invalid_reasons(invalid: DataFrame, top: int | None = None) -> DataFrame:
    """reason, count, percent, most frequent first; remainders of split reads do not count."""
    counts = invalid.where(F.col("reason").isNotNull() & ~remainder("ReadName")).groupBy("reason").agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count").alias("total"))
    out = counts.crossJoin(F.broadcast(total)).select("reason", "count", percent(F.col("count"), F.col("total")).alias("percent")).orderBy(F.desc("count"), "reason")
    return out.limit(top) if top else out


def edit_distances(valid: DataFrame, barcode: str) -> DataFrame:
    """edit_distance (5 and more as one, -1 as it is), count, percent."""
    d = F.col(f"corrected_{barcode}_min_dist")
    counts = valid.where(d.isNotNull()).groupBy(F.least(d.cast("long"), F.lit(FAR)).alias("edit_distance")).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("edit_distance", "count", percent(F.col("count"), F.col("total")).alias("percent"))


def box_stats(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, n, min, q1, median, q3, max of a whole-number column, quartiles by midpoint.

    Equal values are counted before anything is gathered: a group is its different values with the rows up to each.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(key, F.col(value).alias("x")).agg(F.count("*").alias("c"))
    grouped = counted.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("x", "c"))).alias("v"), F.sum("c").alias("n"))

    def at(place: Column) -> Column:
        # the value at a place of the sorted rows
        step = lambda acc, s: F.struct((acc["left"] - s["c"]).alias("left"), F.when((acc["left"] >= 0) & (acc["left"] < s["c"]), s["x"].cast("double")).otherwise(acc["x"]).alias("x"))
        return F.aggregate("v", F.struct(place.cast("long").alias("left"), F.lit(None).cast("double").alias("x")), step, lambda acc: acc["x"])

    def quantile(q: float) -> Column:
        where = (F.col("n") - 1) * F.lit(q)
        return (at(F.floor(where)) + at(F.ceil(where))) / 2

    first, last = F.get("v", F.lit(0))["x"], F.element_at("v", -1)["x"]
    return grouped.select(key, "n", first.alias("min"), quantile(0.25).alias("q1"), quantile(0.5).alias("median"), quantile(0.75).alias("q3"), last.alias("max"))


def distance_box_stats(valid: DataFrame, demuxed: bool = False) -> DataFrame:
    """segment and box statistics of edit distances: of barcodes to the whitelist, of known adapters to their pattern, each occurrence."""
    rows = _demuxed(valid) if demuxed else valid
    parts = [F.struct(F.lit(b).alias("segment"), F.array(F.col(f"corrected_{b}_min_dist").cast("long")).alias("d")) for b in barcode_types(rows.columns)]
    parts += [F.struct(F.lit(c[: -len("_edit_dist")]).alias("segment"), F.col(c).cast("array<bigint>").alias("d")) for c in rows.columns if c.endswith("_edit_dist")]
    long = rows.select(F.explode(F.array(*parts)).alias("p")).select("p.segment", F.explode("p.d").alias("distance"))
    return box_stats(long, "segment", "distance")


def _demuxed(valid: DataFrame) -> DataFrame:
    cell = cell_column(valid.columns)
    return valid.where(known_cell(cell)) if cell else valid.limit(0)


def _groups(valid: DataFrame, invalid: DataFrame | None, length: str) -> DataFrame:
    """x and whether a row is of each group."""
    cell = cell_column(valid.columns)
    x = F.col(length).cast("string").try_cast("double").cast("long").alias("x")
    v = valid.select(x, F.lit(False).alias("invalid"), F.lit(True).alias("valid"), fragment("ReadName").alias("split"), (F.coalesce(known_cell(cell), F.lit(False)) if cell else F.lit(False)).alias("demuxed"), (F.coalesce(F.col(cell).cast("string") == "ambiguous", F.lit(False)) if cell else F.lit(False)).alias("ambiguous"))
    if invalid is None:
        return v
    no = F.lit(False)
    return v.unionByName(invalid.select(x, F.lit(True).alias("invalid"), no.alias("valid"), no.alias("split"), no.alias("demuxed"), no.alias("ambiguous")))


def length_distribution(valid: DataFrame, invalid: DataFrame | None, bin_width: int = 100, length: str = "read_length") -> DataFrame:
    """bin_center and a count for each group of reads, in bins as the report shows them at first.

    The offered number of bins nearest to the longest read over bin_width gives the width; counts are made at the finest width
    and added up by where the fine bins begin.
    """
    rows = _groups(valid, invalid, length)
    rows = rows.where(F.col("x") > 0) if length == "cDNA_length" else rows.where(F.col("x").isNotNull())
    most = rows.agg(F.max("x")).first()[0] or 0
    offered = [n for n in BIN_PRESETS if most // n >= 1] or [100]
    wanted = most / bin_width
    width = max(1, most // min(offered, key=lambda n: abs(n - wanted)))
    fine = max(1, most // offered[-1])
    names = ["invalid", "valid", "split", "demuxed", "ambiguous"]
    at_fine = rows.groupBy((F.floor(F.col("x") / fine) * fine).alias("f")).agg(F.count("*").alias("total"), *(F.count_if(n).alias(n) for n in names))
    out = at_fine.groupBy((F.floor(F.col("f") / width) * width + width // 2).cast("long").alias("bin_center"))
    return out.agg(*(F.sum(n).alias(n) for n in ["total", *names]))


def reads_per_cell(valid: DataFrame) -> DataFrame:
    """cell_id, read_count, rank from the cell with most reads; ties by cell_id. Runs jobs."""
    counts = _demuxed(valid).groupBy(F.col("cell_id").cast("string").alias("cell_id")).agg(F.count("*").alias("read_count"))
    return numbered(counts, F.desc("read_count"), "cell_id").withColumn("rank", F.col("rank").cast("int"))


def barcode_discovery(ranked: DataFrame, knee: DataFrame) -> DataFrame:
    """rank, read_count, above_knee."""
    return ranked.crossJoin(F.broadcast(knee.select("n_knee"))).select("rank", "read_count", (F.col("rank") <= F.col("n_knee")).alias("above_knee"))


def length_per_cell(valid: DataFrame, length: str = "read_length") -> DataFrame:
    """cell_id, n, q1, median, q3 of lengths; ambiguous reads are a cell of their own."""
    rows = valid.where(F.col("cell_id").isNotNull() & (F.col("cell_id").cast("string") != "")).select(F.col("cell_id").cast("string").alias("cell_id"), F.col(length).cast("string").try_cast("double").cast("long").alias("x"))
    if length == "cDNA_length":
        rows = rows.where("x > 0")
    return box_stats(rows, "cell_id", "x").select("cell_id", "n", "q1", "median", "q3")


def segment_lengths(valid: DataFrame, demuxed: bool = False) -> DataFrame:
    """segment and box statistics of lengths.

    Of segments with sequences it is the length of their comma-joined text, of others the bases of all occurrences.
    """
    rows = _demuxed(valid) if demuxed else valid
    kinds = dict(rows.dtypes)
    parts = []
    for s in segments(rows.columns):
        seq = f"{s}_Sequences"
        if seq in kinds:
            size = F.length(F.array_join(F.col(seq), ", ") if kinds[seq].startswith("array") else F.col(seq))
            size = F.when(size > 0, size)
        else:
            size = F.when(F.size(f"{s}_Starts") > 0, F.aggregate(F.zip_with(f"{s}_Ends", f"{s}_Starts", lambda z, a: (z - a).cast("long")), F.lit(0).cast("long"), lambda acc, x: acc + x))
        parts.append(F.struct(F.lit(s).alias("segment"), size.cast("long").alias("length")))
    long = rows.select(F.explode(F.array(*parts)).alias("p")).select("p.*")
    return box_stats(long, "segment", "length")


def alignment_stats(cells: DataFrame) -> DataFrame:
    """category, count, percent of primary reads, over all cells (rows of classes_per_cell)."""
    total = cells.agg(*(F.sum(c).alias(c) for c in ("total", "unique", "secondary", "supplementary", "unmapped", "duplicates")))
    yes = F.lit(True)
    rows = _stack(total, [(yes, "total", F.col("total")), (yes, "unique", F.col("unique")), (yes, "secondary", F.col("secondary")), (yes, "supplementary", F.col("supplementary")), (yes, "unmapped", F.col("unmapped"))])
    return rows.select("category", "count", percent(F.col("count"), F.col("total")).alias("percent"))


def duplication_stats(totals: DataFrame) -> DataFrame:
    """category, count, percent of unique and duplicate reads (duplicate_totals)."""
    rows = _stack(totals, [(F.lit(True), "unique", F.col("unique")), (F.lit(True), "duplicate", F.col("duplicate"))])
    return rows.select("category", "count", percent(F.col("count"), F.col("unique") + F.col("duplicate")).alias("percent"))


def mapping_per_cell(cells: DataFrame) -> DataFrame:
    """rank (by total), cell and its classes. Runs jobs."""
    return numbered(cells, F.desc("total"), "cb").select(F.col("rank").cast("int").alias("rank"), F.col("cb").alias("cell_id"), "total", "unique", "secondary", "supplementary", "unmapped")


def duplicates_per_cell(cells: DataFrame) -> DataFrame:
    """cell_id and its share of duplicates, four digits."""
    return cells.select(F.col("cb").alias("cell_id"), F.when(F.col("total") > 0, F.round(F.col("duplicates") / F.col("total"), 4)).otherwise(0.0).alias("dup_rate"))


def strip_version(gene: Column | str) -> Column:
    return F.substring_index(gene, ".", 1)


def _genes(info: DataFrame) -> DataFrame:
    """One row a gene id (without version): the first by name."""
    return info.select(strip_version("gene_id").alias("gene_id"), "gene_name", "biotype").groupBy("gene_id").agg(F.min_by(F.struct("gene_name", "biotype"), F.struct("gene_name", "biotype")).alias("g")).select("gene_id", "g.*")


def cell_metrics(counts: DataFrame, info: DataFrame) -> DataFrame:
    """cell_id, total_counts, n_genes, mito_pct, ribo_pct, complexity = log10 genes / log10 counts (0 unless there are genes and over one count).

    counts: gene_id, cell_id, count (long; cells with zero counts only need a row to be listed). info: gene_id, gene_name, biotype.
    """
    rows = counts.withColumn("__g", strip_version("gene_id")).join(_genes(info).withColumnRenamed("gene_id", "__g"), "__g", "left")
    name = F.coalesce("gene_name", F.lit(""))
    total, genes = F.sum("count"), F.count_if(F.col("count") > 0)
    part = lambda pattern: F.sum(F.when(name.rlike(pattern), F.col("count")).otherwise(0))
    out = rows.groupBy("cell_id").agg(total.alias("total_counts"), genes.alias("n_genes"), part("^(MT-|mt-)").alias("m"), part("^(RPS|RPL|rps|rpl)").alias("r"))
    share = lambda x: F.when(F.col("total_counts") > 0, F.lit(100.0) * x / F.col("total_counts")).otherwise(0.0)
    complexity = F.when((F.col("n_genes") > 0) & (F.col("total_counts") > 1), F.log10("n_genes") / F.log10("total_counts")).otherwise(0.0)
    return out.select("cell_id", "total_counts", "n_genes", share(F.col("m")).alias("mito_pct"), share(F.col("r")).alias("ribo_pct"), complexity.alias("complexity"))


def cell_metric_summary(metrics: DataFrame) -> DataFrame:
    """One row: cells, median complexity over 0, median mito share, cells over 10 and 20 % mito."""
    return metrics.agg(
        F.count("*").alias("n_cells"), F.median(F.when(F.col("complexity") > 0, F.col("complexity"))).alias("median_complexity"), F.median("mito_pct").alias("median_mito_pct"),
        F.count_if(F.col("mito_pct") > 10).alias("over_10"), F.count_if(F.col("mito_pct") > 20).alias("over_20"),
    )


def assignment_totals(assigned: DataFrame) -> DataFrame:
    """status, count, percent from (cell_id, status, count); statuses without a count are left out."""
    counts = assigned.groupBy("status").agg(F.sum("count").alias("count")).where("count > 0")
    total = counts.agg(F.sum("count").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("status", "count", percent(F.col("count"), F.col("total")).alias("percent"))


def top_genes(counts: DataFrame, info: DataFrame, n: int = 20) -> DataFrame:
    """gene (name, else id), gene_id, total of the genes with most counts; ties by id."""
    top = counts.groupBy("gene_id").agg(F.sum("count").alias("total")).orderBy(F.desc("total"), "gene_id").limit(n)
    named = top.withColumn("__g", strip_version("gene_id")).join(_genes(info).withColumnRenamed("gene_id", "__g"), "__g", "left")
    return named.select(F.coalesce(F.when(F.col("gene_name") != "", F.col("gene_name")), F.col("gene_id")).alias("gene"), "gene_id", "total")


def genes_per_biotype(counts: DataFrame, info: DataFrame, most: int = 15) -> DataFrame:
    """biotype, n of detected genes; those after the first `most` are added up as "other". Ties by name; biotypes are few."""
    found = counts.where("count > 0").select(strip_version("gene_id").alias("gene_id"), F.col("gene_id").alias("full")).distinct()
    by = found.join(_genes(info), "gene_id", "left").groupBy(F.coalesce("biotype", F.lit("unknown")).alias("biotype")).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "biotype"))
    return by.withColumn("r", rank).groupBy(F.when(F.col("r") <= most, F.col("biotype")).otherwise("other").alias("biotype")).agg(F.sum("n").alias("n"))


def gene_positions(exons: DataFrame, bins: int = COVERAGE_BINS, shortest: int = SHORTEST) -> DataFrame:
    """gene_id, rname, strand, place (0 to bins - 1), position (1-based): evenly spaced bases of the longest transcript of each gene, in genomic order.

    exons: transcript_id, gene_id, rname, strand, start (0-based), end. Transcripts under `shortest` bases are left out. Places come
    from running lengths of exons: no base is expanded.
    """
    good = exons.where((F.trim("transcript_id") != "") & (F.trim("gene_id") != "")).withColumn("gene_id", strip_version("gene_id"))
    size = good.groupBy("gene_id", "transcript_id").agg(F.sum(F.col("end") - F.col("start")).alias("bases"))
    best = size.groupBy("gene_id").agg(F.max_by(F.struct("transcript_id", "bases"), F.struct("bases", "transcript_id")).alias("b")).select("gene_id", "b.*").where(F.col("bases") >= shortest)
    own = good.join(best, ["gene_id", "transcript_id"])
    before = F.sum(F.col("end") - F.col("start")).over(Window.partitionBy("gene_id").orderBy("start", "end")) - (F.col("end") - F.col("start"))
    own = own.withColumn("before", before)
    places = own.select("gene_id", "bases").distinct().withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).withColumn("offset", F.floor(F.col("place") * (F.col("bases") - 1) / (bins - 1)).cast("long"))
    hit = places.join(own.select("gene_id", "rname", "strand", "start", "end", "before"), "gene_id").where((F.col("offset") >= F.col("before")) & (F.col("offset") < F.col("before") + F.col("end") - F.col("start")))
    return hit.select("gene_id", "rname", "strand", "place", (F.col("start") + F.col("offset") - F.col("before") + 1).alias("position"))


def gene_body_coverage(blocks: DataFrame, exons: DataFrame, bins: int = COVERAGE_BINS, width: int = 100_000) -> DataFrame:
    """percentile (0 to bins - 1, 5' to 3'), coverage: aligned blocks over the positions, added up over genes.

    blocks: rname, start, end (half open) of counted alignments. Positions meet blocks on windows of `width` bases.
    """
    points = gene_positions(exons, bins).withColumn("w", F.floor((F.col("position") - 1) / width))
    per_gene = points.groupBy("gene_id", "rname", "strand", "position").agg(F.min("place").alias("place"))
    order = F.row_number().over(Window.partitionBy("gene_id").orderBy(F.when(F.col("strand") == "-", -F.col("position")).otherwise(F.col("position")))) - 1
    per_gene = per_gene.withColumn("percentile", order).withColumn("w", F.floor((F.col("position") - 1) / width))
    spread = blocks.where("end > start").select("rname", F.col("start").alias("s"), F.col("end").alias("e"), F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))).alias("w"))
    hit = per_gene.join(spread, ["rname", "w"]).where((F.col("s") < F.col("position")) & (F.col("position") <= F.col("e"))).groupBy("percentile").agg(F.count("*").alias("coverage"))
    every = blocks.sparkSession.range(bins).select(F.col("id").cast("int").alias("percentile"))
    return every.join(hit, "percentile", "left").na.fill(0, ["coverage"])


def blocks_of(alignments: DataFrame, without: int = 0x4 | 0x100 | 0x200 | 0x400) -> DataFrame:
    """Aligned blocks (M, =, X) of alignments with none of the flags: unmapped, secondary, failed, duplicate."""
    from .alignments import has

    kept = alignments.where(~has(without))
    ops = F.transform(F.regexp_extract_all("cigar", F.lit(r"([0-9]+)([MIDNSHP=X])"), F.lit(0)), lambda c: F.struct(F.regexp_extract(c, "^([0-9]+)", 1).cast("long").alias("n"), F.substring(c, -1, 1).alias("op")))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(acc: Column, c: Column) -> Column:
        moves, counts = c["op"].isin("M", "D", "N", "=", "X"), c["op"].isin("M", "=", "X")
        end = F.when(moves, acc["at"] + c["n"]).otherwise(acc["at"])
        return F.struct(end.alias("at"), F.when(counts, F.concat(acc["out"], F.array(F.struct(acc["at"].alias("start"), end.alias("end"))))).otherwise(acc["out"]).alias("out"))

    blocks = F.aggregate(ops, F.struct(F.col("start").cast("long").alias("at"), empty.alias("out")), step, lambda acc: acc["out"])
    more = [c for c in ("cb",) if c in kept.columns]
    strand = F.when(has(0x10), "-").otherwise("+").alias("strand")
    return kept.select("qname", "rname", *more, strand, F.explode(blocks).alias("b")).select("qname", "rname", *more, "strand", "b.start", "b.end")
