"""Operators on alignments: names, UMI duplicates, splitting by cell, count matrices, per-cell classes.

Alignments: qname, flag, rname, start, end (half open), mapq, cigar, cb, ub, dt (tags, null if absent), ord (file order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import deletions2
from ..plans.lineage import cut

UNMAPPED, REVERSE, SECONDARY, DUPLICATE, SUPPLEMENTARY = 0x4, 0x10, 0x100, 0x400, 0x800
#: Width of the position bins in which duplicates are sought.
POSITION = 10
#: Different UMIs of one key that are folded in one row.
FOLDED = 1000
_NAME = "^(.*)_([^_]*)_([^_]*)$"


def has(flag: int) -> Column:
    return F.col("flag").bitwiseAND(flag) != 0


def pass_flags(alignments: DataFrame, without: int = 260, mapq: int = 0) -> DataFrame:
    """Alignments with none of these flags and at least this mapping quality."""
    return alignments.where(~has(without) & (F.col("mapq") >= mapq))


def with_name_parts(alignments: DataFrame) -> DataFrame:
    """Adds read, name_cb and name_umi from names read_cell_umi (the last two parts; null for shorter names)."""
    good = F.col("qname").rlike(_NAME)
    part = lambda k: F.when(good, F.regexp_extract("qname", _NAME, k))
    return alignments.withColumn("read", F.coalesce(part(1), F.col("qname"))).withColumn("name_cb", part(2)).withColumn("name_umi", part(3))


def position_key(per_cell: bool = True, stranded: bool = True) -> list[Column]:
    out = [F.col("rname"), F.floor(F.col("start") / POSITION).alias("start_bin"), F.floor(F.col("end") / POSITION).alias("end_bin")]
    if per_cell:
        out.append(F.coalesce("name_cb", F.lit("")).alias("key_cb"))
    if stranded:
        out.append(has(REVERSE).alias("key_strand"))
    return out


def leaders(umis: Column, threshold: int) -> Column:
    """Of an ordered array of UMIs, those that no earlier leader is near to (Levenshtein)."""
    none = F.array().cast("array<string>")
    return F.aggregate(umis, none, lambda acc, u: F.when(F.exists(acc, lambda k: F.levenshtein(k, u, threshold) >= 0), acc).otherwise(F.concat(acc, F.array(u))))


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    same = F.lit(True)
    for n in names:
        same &= left[n] == right[n]
    return same


def _settled(umis: DataFrame, threshold: int) -> DataFrame:
    """umis (key, name_umi, at) with umi_leader, as `leaders` decides it, for keys with so many UMIs that none can be folded in one row.

    UMIs near each other meet through a variant with deletions. A UMI leads once all those before it near it are known not to, and
    has a leader once one of them leads; rounds of joins settle it.
    """
    keyed = umis.withColumn("variant", F.explode(deletions2("name_umi")))
    other = keyed.select("key", "variant", F.col("name_umi").alias("before"), F.col("at").alias("at_before"))
    near = keyed.join(other, ["key", "variant"]).where("at_before < at or (at_before = at and before < name_umi)").select("key", "name_umi", "before", "at_before").distinct()
    near = cut(near.where(F.levenshtein("name_umi", "before", threshold) >= 0), "near-umis")
    state = cut(umis.withColumn("leader", F.lit(None).cast("string")), "umis")
    while True:
        known = state.select("key", F.col("name_umi").alias("before"), F.col("leader").alias("leader_before"))
        order = F.struct("at_before", "before")
        leads = F.col("leader_before") == F.col("before")
        seen = state.where("leader is null").select("key", "name_umi").join(near, ["key", "name_umi"], "left").join(known, ["key", "before"], "left")
        verdict = seen.groupBy("key", "name_umi").agg(F.min(F.when(leads, order)).alias("first"), F.min(F.when(F.col("before").isNotNull() & F.col("leader_before").isNull(), order)).alias("open"))
        # the earliest leader counts once nothing open comes before it
        mine = F.when(F.col("first").isNotNull() & (F.col("open").isNull() | (F.col("first") < F.col("open"))), F.col("first.before")).when(F.col("first").isNull() & F.col("open").isNull(), F.col("name_umi"))
        state = state.join(verdict.select("key", "name_umi", mine.alias("mine")), ["key", "name_umi"], "left")
        state = cut(state.select("key", "name_umi", "at", F.coalesce("leader", "mine").alias("leader")), "umis")
        if not state.where("leader is null").limit(1).count():
            return state.withColumnRenamed("leader", "umi_leader")


def umi_decisions(alignments: DataFrame, threshold: int = 2, per_cell: bool = True, stranded: bool = True) -> DataFrame:
    """Primary alignments with a UMI: read, position key, ord, name_umi, umi_leader, is_dup.

    Within a key (contig, cell, strand, start and end each by 10), UMIs come in order of start, then file order. One that is
    near a leader is its duplicate (the earliest such leader is reported), else it leads. Equal UMIs are collapsed first. The UMIs of a
    key are folded in one row; keys with more than FOLDED different ones are settled by joins, with the same result, for thresholds
    up to 2. Runs a job to find these keys.
    """
    rows = with_name_parts(alignments).where(~has(UNMAPPED | SECONDARY | SUPPLEMENTARY) & F.col("name_umi").isNotNull())
    keys = position_key(per_cell, stranded)
    rows = rows.select("*", *[k for k in keys if k._jc.toString() != "rname"])
    names = ["rname", "start_bin", "end_bin", *(["key_cb"] if per_cell else []), *(["key_strand"] if stranded else [])]
    first = rows.groupBy(*names, "name_umi").agg(F.min(F.struct("start", "ord")).alias("at"))
    key = F.struct(*names)
    sizes = first.groupBy(*names).agg(F.count("*").alias("n"))
    crowded = cut(sizes.where(F.col("n") > FOLDED).select(*names), "crowded-keys") if threshold <= 2 else None
    few = first.join(crowded, _same(first, crowded, names), "left_anti") if crowded is not None else first
    folded = few.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("at", "name_umi"))).alias("seen"))
    folded = folded.withColumn("leaders", leaders(F.transform("seen", lambda x: x["name_umi"]), threshold))
    one = folded.select(*names, "leaders", F.explode("seen").alias("s")).select(*names, F.col("s.name_umi").alias("name_umi"), F.col("s.at").alias("at"), F.get(F.filter("leaders", lambda k: F.levenshtein(k, F.col("s.name_umi"), threshold) >= 0), F.lit(0)).alias("umi_leader"))
    if crowded is not None and crowded.limit(1).count():
        many = first.join(crowded, _same(first, crowded, names), "left_semi").select(key.alias("key"), "name_umi", "at")
        one = one.unionByName(_settled(many, threshold).select("key.*", "name_umi", "at", "umi_leader"))
    out = rows.join(one, [*names, "name_umi"])
    lead = (F.col("name_umi") == F.col("umi_leader")) & (F.struct("start", "ord") == F.col("at"))
    return out.withColumn("is_dup", ~lead).drop("at")


def mark_duplicates(alignments: DataFrame, threshold: int = 2, per_cell: bool = True, stranded: bool = True) -> DataFrame:
    """alignments with flag 0x400 set or cleared and tags cb, ub, dt ("Yes", "No").

    Primary alignments are decided; secondary and supplementary ones take the verdict of their read's latest primary one that comes before them
    in the contig. Others stay as they are.
    """
    done = umi_decisions(alignments, threshold, per_cell, stranded).select("ord", "rname", "read", "start", "is_dup")
    rows = with_name_parts(alignments)
    own = rows.join(done.select("ord", F.col("is_dup").alias("own")), "ord", "left")
    other = has(SECONDARY | SUPPLEMENTARY) & ~has(UNMAPPED)
    primary = done.select("rname", "read", F.struct("start", "ord").alias("at"), "is_dup")
    prior = own.where(other).select("ord", "rname", "read", F.struct("start", "ord").alias("here")).join(primary, ["rname", "read"]).where("at < here").groupBy("ord").agg(F.max_by("is_dup", "at").alias("inherited"))
    out = own.join(prior, "ord", "left").withColumn("dup", F.coalesce("own", "inherited"))
    flag = F.when(F.col("dup"), F.col("flag").bitwiseOR(DUPLICATE)).when(~F.col("dup"), F.col("flag").bitwiseAND(F.lit(~DUPLICATE))).otherwise(F.col("flag"))
    tag = lambda name, value: F.when(F.col("dup").isNotNull(), value).otherwise(F.col(name)).alias(name)
    kept = [c for c in alignments.columns if c not in ("flag", "cb", "ub", "dt")]
    return out.select(*kept, flag.cast(alignments.schema["flag"].dataType).alias("flag"), tag("cb", F.col("name_cb")), tag("ub", F.col("name_umi")), tag("dt", F.when(F.col("dup"), "Yes").otherwise("No")))


def duplicate_totals(marked: DataFrame) -> DataFrame:
    return marked.where(F.col("dt").isNotNull() & ~has(SECONDARY | SUPPLEMENTARY | UNMAPPED)).agg(F.count_if(F.col("dt") == "No").alias("unique"), F.count_if(F.col("dt") == "Yes").alias("duplicate"))


def split_by_cell(alignments: DataFrame, buckets: int = 256, secondary: bool = False, supplementary: bool = False, unmapped: bool = True, duplicates: bool = True, min_mapq: int = 0) -> DataFrame:
    """Alignments to keep, with their bucket (crc32 of the cell, mod `buckets`). The flags say which kinds are filtered out."""
    drop = UNMAPPED * unmapped | SECONDARY * secondary | SUPPLEMENTARY * supplementary | DUPLICATE * duplicates
    kept = alignments.where(~has(drop)) if drop else alignments
    return kept.where((F.col("mapq") >= min_mapq) & F.col("cb").isNotNull()).withColumn("bucket", F.pmod(F.crc32("cb"), F.lit(buckets)).cast("int"))


def split_counters(alignments: DataFrame, **how) -> DataFrame:
    """n_in, n_filtered, n_no_tag, n_kept of split_by_cell."""
    secondary, supplementary, unmapped, duplicates = (how.get(k, d) for k, d in (("secondary", False), ("supplementary", False), ("unmapped", True), ("duplicates", True)))
    drop = UNMAPPED * unmapped | SECONDARY * secondary | SUPPLEMENTARY * supplementary | DUPLICATE * duplicates
    out = (has(drop) if drop else F.lit(False)) | (F.col("mapq") < how.get("min_mapq", 0))
    return alignments.agg(F.count("*").alias("n_in"), F.count_if(out).alias("n_filtered"), F.count_if(~out & F.col("cb").isNull()).alias("n_no_tag"), F.count_if(~out & F.col("cb").isNotNull()).alias("n_kept"))


def write_cells(kept: DataFrame, path: str) -> None:
    """A folder a cell, sorted by position; the writer sorts, so no task holds many open files."""
    kept.repartition("bucket").sortWithinPartitions("cb", "rname", "start").write.partitionBy("cb").mode("overwrite").parquet(path)


def gene_counts(blocks: DataFrame, features: DataFrame, width: int = 100_000, overlapping: bool = True, stranded: bool = False) -> DataFrame:
    """gene_id, cell_id (cb), count: reads with a block over a feature of the gene, each read once a gene.

    blocks: qname, cb, rname, start, end (half open; `qc.blocks_of`), strand for `stranded`: introns are in none, so a read
    spliced over an exon does not count for it. features: rname, start, end, gene_id, strand. overlapping: a read over several genes
    counts for each of them, else for none. Overlap is an equi-join on windows of `width` bases, then a check of the ranges.
    """
    windows = lambda a, z: F.explode(F.sequence(F.floor(a / width), F.floor((z - 1) / width)))
    own = ["strand"] if stranded else []
    a = blocks.select("qname", "rname", "cb", *own, F.col("start").alias("s"), F.col("end").alias("e")).where("s < e").withColumn("w", windows(F.col("s"), F.col("e")))
    x = features.select("rname", "gene_id", *own, "start", "end").where("start < end").withColumn("w", windows(F.col("start"), F.col("end")))
    hit = a.join(x, ["rname", "w", *own]).where("s < end and start < e")
    once = hit.groupBy("qname", "cb", "gene_id").agg(F.lit(1).alias("one"))
    if not overlapping:
        once = once.groupBy("qname", "cb").agg(F.min("gene_id").alias("gene_id"), F.count("*").alias("n")).where("n = 1")
    return once.groupBy("gene_id", F.col("cb").alias("cell_id")).agg(F.count("*").alias("count"))


def merge_matrices(tables: list[DataFrame]) -> DataFrame:
    """One long table (gene_id, cell_id, count) of several; cells of one name are added up."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.groupBy("gene_id", "cell_id").agg(F.sum("count").alias("count"))


def wide_matrix(counts: DataFrame, cells: list[str], gene: str = "gene_id") -> DataFrame:
    """A row a gene, a column a cell, 0 where there is no count: for export."""
    return counts.groupBy(gene).pivot("cell_id", cells).agg(F.sum("count")).na.fill(0)


def natural_key(name: str) -> list:
    """Sorts names with numbers by the numbers."""
    import re

    return [int(x) if x.isdigit() else x.lower() for x in re.split(r"(\d+)", name)]


def classes_per_cell(alignments: DataFrame) -> DataFrame:
    """cb, total, unmapped, secondary, supplementary, unique, duplicates, unique_umis by primary alignments of cells.

    A read is of the first class that holds: unmapped, has a secondary alignment, has a supplementary one, unique. It is a
    duplicate if dt is "Yes" or the flag says so; where dt is absent and the flag clear, that is unknown, and the read
    adds to neither duplicates nor unique_umis (different ub of reads known to be unique).
    """
    second = alignments.where(has(SECONDARY)).select("qname").distinct().withColumn("sec", F.lit(True))
    supp = alignments.where(has(SUPPLEMENTARY)).select("qname").distinct().withColumn("sup", F.lit(True))
    primary = alignments.where(~has(SECONDARY | SUPPLEMENTARY) & F.col("cb").isNotNull())
    rows = primary.join(second, "qname", "left").join(supp, "qname", "left")
    kind = F.when(has(UNMAPPED), "unmapped").when(F.col("sec"), "secondary").when(F.col("sup"), "supplementary").otherwise("unique")
    dup = (F.col("dt") == "Yes") | F.when(has(DUPLICATE), F.lit(True)).otherwise(F.when(F.col("dt").isNull(), F.lit(None)).otherwise(F.lit(False)))
    rows = rows.withColumn("kind", kind).withColumn("dup", dup)
    counted = [F.count_if(F.col("kind") == k).alias(k) for k in ("unmapped", "secondary", "supplementary", "unique")]
    return rows.groupBy("cb").agg(F.count("*").alias("total"), *counted, F.count_if("dup").alias("duplicates"), F.countDistinct(F.when(~F.col("dup"), F.col("ub"))).alias("unique_umis"))


def saturation(alignments: DataFrame, fractions: int = 10, seed: int = 0) -> DataFrame:
    """fraction, reads, saturation = 1 - different (cb, ub) / reads, and mean reads a cell, of growing samples of primary reads.

    A read is in the sample of fraction f if a keyed hash of its name falls under f, so samples grow into each other and
    one pass gives all: each (cb, ub) counts from the smallest sample that has it.
    """
    rows = alignments.where(~has(SECONDARY | SUPPLEMENTARY) & F.col("cb").isNotNull() & F.col("ub").isNotNull())
    place = F.ceil((F.pmod(F.crc32(F.concat(F.lit(f"{seed}:"), "qname")), F.lit(1_000_000)) + 1) * fractions / F.lit(1_000_000.0)).cast("int")
    rows = rows.select("cb", "ub", place.alias("step"))
    reads = rows.groupBy("step").agg(F.count("*").alias("reads"))
    first = rows.groupBy("cb", "ub").agg(F.min("step").alias("step")).groupBy("step").agg(F.count("*").alias("umis"))
    cells = rows.agg(F.countDistinct("cb").alias("n_cells"))
    steps = reads.sparkSession.range(1, fractions + 1).select(F.col("id").cast("int").alias("step"))
    sums = steps.join(reads, "step", "left").join(first, "step", "left").na.fill(0)
    upto = Window.orderBy("step")  # as many rows as fractions
    sums = sums.withColumn("reads", F.sum("reads").over(upto)).withColumn("umis", F.sum("umis").over(upto)).crossJoin(cells)
    return sums.select((F.col("step") / fractions).alias("fraction"), "reads", F.when(F.col("reads") > 0, 1 - F.col("umis") / F.col("reads")).otherwise(0.0).alias("saturation"), F.when(F.col("n_cells") > 0, F.col("reads") / F.col("n_cells")).otherwise(0.0).alias("reads_per_cell"))
