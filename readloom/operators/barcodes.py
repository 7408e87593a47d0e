"""Barcode correction against a whitelist, cells, and records of demultiplexed reads.

Work is done once for each different barcode, not for each read. Exact and reverse-complement hits are equi-joins. The
rest meets the whitelist by equi-joins too, and distances are checked on the pairs found: first those of one edit, then, of the
sequences still without a barcode, those of more. Pairs meet through halves of which one has few edits, through an unchanged piece, or,
where the whitelist is so large that these are shared by many, through a variant with deletions. All find all pairs. Whitelist and
different barcodes are written first, so Spark knows their sizes and broadcasts a whitelist only if it is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import deletions2, reverse_complement, slice_half_open, usable
from ..plans.lineage import cut

NO_MATCH, AMBIGUOUS = "NMF", "ambiguous"


#: Whitelists of more rows than this meet through deletion variants, if the threshold allows.
MANY = 50_000


def _near(left: DataFrame, right: DataFrame, threshold: int) -> DataFrame:
    """(seq, probe, side, barcode, place, dist): pairs of probe and barcode within the threshold, by Levenshtein distance."""
    if threshold == 2 and right.count() > MANY:
        # two sequences within 2 edits have a variant of at most 2 deletions each in common
        a = left.withColumn("key", F.explode(deletions2("probe")))
        b = right.withColumn("key", F.explode(deletions2("barcode")))
    else:
        lengths = [r.n for r in right.select(F.length("barcode").alias("n")).distinct().orderBy("n").collect()]
        if threshold <= 3:
            near = F.filter(F.array(*(F.lit(n) for n in lengths)).cast("array<int>"), lambda n: F.abs(F.length("probe") - n) <= threshold)
            a = left.withColumn("__n", F.explode(near)).withColumn("key", F.explode(_half_keys("probe", F.col("__n"), threshold, False)))
            b = right.withColumn("key", F.explode(_half_keys("barcode", F.length("barcode"), threshold, True)))
        else:
            a = left.withColumn("key", F.explode(F.array_distinct(_probes("probe", lengths, threshold))))
            b = right.withColumn("key", F.explode(F.array(*(_piece(F.length("barcode"), k, "barcode", *_bounds(F.length("barcode"), k, threshold)) for k in range(threshold + 1)))))
    pairs = a.join(b, "key").withColumn("dist", F.levenshtein("probe", "barcode", threshold)).where("dist >= 0")
    return pairs.select("seq", "probe", "side", "barcode", "place", "dist").distinct()


def _half_keys(text: str, n: Column, threshold: int, whole: bool) -> Column:
    """Keys that a barcode of length n (`whole`) and a probe within 3 edits (1 edit) share: an alignment cuts both in two, and a half has at most one (none) of the edits.

    A half of size h as the probe has it begins (the second: ends) the probe and has h letters, one of them changed: without it
    both are alike; or h - 1, which is the half without a letter; or h + 1, of which one is too many.
    """
    no_key = F.array().cast("array<bigint>")

    def half(side: int, t: Column, h: Column) -> list[Column]:
        key = lambda kind, at, part: F.xxhash64(n, F.lit(2 * kind + side), at, part)
        first = lambda size: F.substring(t, F.lit(1), size)
        has = lambda size, keys: F.when((size >= 0) & (F.length(t) >= size), keys).otherwise(no_key)
        none = F.lit(-1)
        if threshold <= 1:
            return [has(h, F.array(key(0, none, first(h))))]

        def without(size: Column, kind: int, placed: bool) -> Column:
            """Keys of the first letters, so many of them, without one, for each; with the place of that one."""
            one = lambda i: key(kind, i if placed else none, F.concat(first(i), F.substring(t, i + 2, size - i - 1)))
            return F.when(size > 0, F.transform(F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))), one)).otherwise(no_key)

        same = has(h, without(h, 0, True))
        if whole:
            return [same, without(h, 1, False), F.array(key(2, none, first(h)))]
        return [same, has(h - 1, F.array(key(1, none, first(h - 1)))), has(h + 1, without(h + 1, 2, False))]

    h = F.floor(n / 2).cast("int")
    return F.array_distinct(F.concat(*half(0, F.col(text), h), *half(1, F.reverse(F.col(text)), n - h)))


def _nearest(left: DataFrame, right: DataFrame, threshold: int) -> DataFrame:
    """Of _near all pairs of each sequence at its smallest distance: more than one edit is looked for only where one gave nothing. Writes tables."""
    one = cut(_near(left, right, min(1, threshold)), "near")
    if threshold <= 1:
        return one
    far = left.join(one.select("seq").distinct(), "seq", "left_anti")
    return one.unionByName(_near(cut(far, "far"), right, threshold))


def _bounds(length, k: int, threshold: int):
    """Start and size of the k-th of threshold + 1 pieces: threshold edits leave one of them as it is."""
    at = lambda j: F.floor(length * j / F.lit(threshold + 1)).cast("int") if isinstance(length, Column) else length * j // (threshold + 1)
    return at(k), at(k + 1) - at(k)


def _piece(length, k: int, text: str, start, size) -> Column:
    of = length if isinstance(length, Column) else F.lit(length)
    start, size = (x if isinstance(x, Column) else F.lit(x) for x in (start, size))
    return F.xxhash64(of, F.lit(k), F.col(text).substr(start + 1, size))


def _probes(probe: str, lengths: list[int], threshold: int) -> Column:
    """Keys of the pieces that barcodes of these lengths may share with a probe: at their places, moved by up to the threshold."""
    keys = []
    for n in lengths:
        near = F.abs(F.length(probe) - n) <= threshold
        for k in range(threshold + 1):
            start, size = _bounds(n, k, threshold)
            keys += [F.when(near & (F.length(probe) >= start + move + size), _piece(n, k, probe, start + move, size)) for move in range(-threshold, threshold + 1) if start + move >= 0]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<bigint>")


def correct(observed: DataFrame, whitelist: DataFrame, threshold: int = 2, limit: int = 5, distinct: bool = False) -> DataFrame:
    """seq, corrected, min_dist, n_min, candidates (array) of every different observed sequence.

    observed: seq. whitelist: barcode, place (row order). In the whitelist: itself, 0, 1. Its reverse complement there: that, 0, 1.
    Else the barcodes at the smallest distance up to the threshold, of the `limit` nearest of the sequence and
    then of its reverse complement, comma-joined in order of place; a barcode near to both is named twice, unless
    `distinct`. None: NMF, threshold + 1, 0. A missing sequence: NMF, -1, 0. Runs jobs: both sides and the result are written.
    """
    white = cut(whitelist.where(usable("barcode").isNotNull()).groupBy("barcode").agg(F.min("place").alias("place")), "whitelist")
    seqs = cut(observed.select(F.col("seq").cast("string").alias("seq")).distinct(), "observed")
    known = F.coalesce(~F.col("seq").isin("", "nan", "None", "NaN"), F.lit(False))
    there = white.select("barcode")
    found = seqs.where(known).withColumn("rc", reverse_complement("seq"))
    found = found.join(there.withColumnRenamed("barcode", "seq").withColumn("__own", F.lit(True)), "seq", "left")
    found = found.join(there.withColumnRenamed("barcode", "rc").withColumn("__rc", F.lit(True)), "rc", "left")
    exact = found.where("__own or __rc").select("seq", F.array(F.when(F.col("__own"), F.col("seq")).otherwise(F.col("rc"))).alias("candidates"), F.lit(0).alias("min_dist"))
    left = found.where("__own is null and __rc is null").select("seq", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("seq").alias("probe")), F.struct(F.lit(1).alias("side"), F.col("rc").alias("probe")))).alias("p")).select("seq", "p.*")
    near = _nearest(cut(left, "unmatched"), white, threshold)
    ranked = near.withColumn("__n", F.row_number().over(Window.partitionBy("seq", "side").orderBy("dist", "place"))).where(F.col("__n") <= limit)
    least = F.min("dist").over(Window.partitionBy("seq"))
    best = ranked.withColumn("min_dist", least).where("dist = min_dist").groupBy("seq", "min_dist").agg(F.array_sort(F.collect_list(F.struct("side", "place", "barcode"))).alias("c"))
    names = F.transform("c", lambda x: x["barcode"])
    fuzzy = best.select("seq", (F.array_distinct(names) if distinct else names).alias("candidates"), "min_dist")
    every = exact.unionByName(fuzzy).withColumn("n_min", F.size("candidates")).withColumn("corrected", F.array_join("candidates", ","))
    none = F.array().cast("array<string>")
    out = seqs.where(known).join(every, "seq", "left").select(
        "seq",
        F.coalesce("corrected", F.lit(NO_MATCH)).alias("corrected"),
        F.coalesce("min_dist", F.lit(threshold + 1)).alias("min_dist"),
        F.coalesce("n_min", F.lit(0)).alias("n_min"),
        F.coalesce("candidates", none).alias("candidates"),
    )
    missing = seqs.where(~known).select("seq", F.lit(NO_MATCH).alias("corrected"), F.lit(-1).alias("min_dist"), F.lit(0).alias("n_min"), none.alias("candidates"))
    return cut(out.unionByName(missing), "corrected")


def whitelist_barcodes(whitelist: DataFrame, column: str) -> DataFrame:
    return whitelist.select(F.col(column).alias("barcode"), F.col("cell_id").alias("place"))


def with_corrections(reads: DataFrame, whitelist: DataFrame, columns: list[str], threshold: int = 2, **how) -> DataFrame:
    """reads with corrected_X, corrected_X_min_dist, corrected_X_counts_with_min_dist and corrected_X_candidates for each barcode column X, read from X_Sequences.

    whitelist: cell_id (row order from 1) and a column for each barcode.
    """
    for x in columns:
        fixed = correct(reads.select(F.col(f"{x}_Sequences").alias("seq")), whitelist_barcodes(whitelist, x), threshold, **how)
        fixed = fixed.toDF("__seq", f"corrected_{x}", f"corrected_{x}_min_dist", f"corrected_{x}_counts_with_min_dist", f"corrected_{x}_candidates")
        reads = reads.join(fixed, F.col(f"{x}_Sequences").eqNullSafe(F.col("__seq")), "left").drop("__seq")
    return reads


def cells(corrected: DataFrame, whitelist: DataFrame) -> DataFrame:
    """corrected with cell_id (text) and match_type, one barcode: the corrected text is looked up, so ties are ambiguous. Of repeated whitelist rows the last counts."""
    x = next(c for c in whitelist.columns if c != "cell_id")
    lookup = whitelist.groupBy(F.col(x).alias("__b")).agg(F.max("cell_id").alias("__cell"))
    out = corrected.join(lookup, F.col(f"corrected_{x}") == F.col("__b"), "left")
    return _named(out, F.col("__cell")).drop("__b", "__cell")


def _named(rows: DataFrame, cell: Column) -> DataFrame:
    rows = rows.withColumn("cell_id", F.coalesce(cell.cast("string"), F.lit(AMBIGUOUS)))
    return rows.withColumn("match_type", F.when(F.col("cell_id") == AMBIGUOUS, "Ambiguous").otherwise("Exact match"))


def cells_unique(corrected: DataFrame, whitelist: DataFrame) -> DataFrame:
    """The other rule for one barcode: a cell if exactly one whitelist row is among the candidates, named twice or not."""
    x = next(c for c in whitelist.columns if c != "cell_id")
    key = corrected.select(f"corrected_{x}").distinct()
    hit = key.withColumn("__b", F.explode(F.array_distinct(F.split(F.col(f"corrected_{x}"), ",")))).join(whitelist.select(F.col(x).alias("__b"), "cell_id"), "__b")
    one = hit.groupBy(f"corrected_{x}").agg(F.count("*").alias("n"), F.min("cell_id").alias("__cell")).where("n = 1").drop("n")
    return _named(corrected.join(one, f"corrected_{x}", "left"), F.col("__cell")).drop("__cell")


def cells_multi(corrected: DataFrame, whitelist: DataFrame, columns: list[str]) -> DataFrame:
    """corrected with cell_id and match_type, several barcodes: the cell that agrees with the candidates in most columns, if it is the only one with as many.

    A column without a candidate makes the read ambiguous. Different candidate sets are looked up once. A cell meets the
    candidates by equi-joins of single columns, and agreements are added up.
    """
    sets = [F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.coalesce(F.col(f"corrected_{x}"), F.lit("")), ","), lambda t: F.trim(t)), lambda t: ~t.isin("", NO_MATCH)))).alias(f"__{x}") for x in columns]
    rows = corrected.select("*", *sets)
    keys = rows.select(*(f"__{x}" for x in columns)).distinct()
    for x in columns:
        keys = keys.where(F.size(f"__{x}") > 0)
    hits = None
    for x in columns:
        one = keys.withColumn("candidate", F.explode(f"__{x}")).join(whitelist.select(F.col(x).alias("candidate"), "cell_id"), "candidate").select(*(f"__{c}" for c in columns), "cell_id")
        hits = one if hits is None else hits.unionByName(one)
    agree = hits.groupBy(*(f"__{x}" for x in columns), "cell_id").agg(F.count("*").alias("n"))
    best = agree.groupBy(*(f"__{x}" for x in columns), "n").agg(F.count("*").alias("ties"), F.min("cell_id").alias("__cell"))
    best = best.groupBy(*(f"__{x}" for x in columns)).agg(F.max_by(F.struct("ties", "__cell"), "n").alias("b")).where("b.ties = 1").select(*(f"__{x}" for x in columns), F.col("b.__cell").alias("__cell"))
    return _named(rows.join(best, [f"__{x}" for x in columns], "left"), F.col("__cell")).drop("__cell", *(f"__{x}" for x in columns))


def _first(name: str, reads: DataFrame) -> Column:
    if name not in reads.columns:
        return F.lit(None).cast("int")
    return F.get(F.col(name), F.lit(0))


def demux_records(reads: DataFrame, columns: list[str], strand: str, fmt: str = "fasta", barcode_quals: bool = False, poly: bool = False, by_barcode: bool = False) -> DataFrame:
    """reads with demux_header, demux_sequence, demux_quality, demux_bucket; null where the insert's coordinates are not good.

    Needs ReadName, read, orientation, cell_id, corrected_X, and *_Starts, *_Ends as arrays. Where orientation and strand
    disagree, insert, UMI and tail are reverse-complemented (qualities keep their order). by_barcode: name and
    bucket hold the corrected barcodes, not the number of the cell.
    """
    at = lambda x: (_first(f"{x}_Starts", reads), _first(f"{x}_Ends", reads))
    (cs, ce), (us, ue) = at("cDNA"), at("UMI")
    tail_s, tail_e = F.coalesce(at("polyA")[0], at("polyT")[0]), F.coalesce(at("polyA")[1], at("polyT")[1])
    turn = (F.col("orientation") == "-") & F.lit(strand == "fwd") | (F.col("orientation") == "+") & F.lit(strand == "rev")
    turned = lambda x: F.when(turn, reverse_complement(x)).otherwise(x)
    cut = lambda a, z, text="read": F.when(z > a, slice_half_open(text, a, z))
    umi = F.coalesce(turned(cut(us, ue)), F.lit(""))
    tail = F.coalesce(turned(cut(tail_s, tail_e)), F.lit("")) if poly else F.lit("")
    corrected = F.concat_ws(";", *(F.concat(F.lit(f"{x}:"), F.col(f"corrected_{x}")) for x in columns))
    name = F.when(F.col("cell_id") == AMBIGUOUS, F.lit(AMBIGUOUS)).otherwise(F.concat_ws("-", *(F.col(f"corrected_{x}") for x in columns)) if by_barcode else F.col("cell_id").cast("string"))
    has_umi = F.length(umi) > 0
    head = F.concat(
        F.lit("@" if fmt == "fastq" else ">"), F.col("ReadName"), F.lit("_"), name, F.when(has_umi, F.concat(F.lit("_"), umi)).otherwise(""),
        F.lit(" cell_id:"), name, F.lit("|Barcodes:"), corrected, F.when(has_umi, F.concat(F.lit("|UMI:"), umi)).otherwise(""),
        F.lit("|orientation:"), F.coalesce("orientation", F.lit("")),
    )
    if fmt == "fastq":
        if barcode_quals:
            marks = [F.when(at(x)[1] > at(x)[0], F.concat(F.lit(f"{x}:"), slice_half_open("base_qualities", *at(x)))) for x in [*columns, "UMI"]]
            listed = F.concat_ws(";", *marks)
            head = F.concat(head, F.when(F.length(listed) > 0, F.concat(F.lit("|BQ:"), listed)).otherwise(""))
        quality = F.coalesce(slice_half_open("base_qualities", cs, ce), F.lit(""))
        if poly:
            quality = F.concat(quality, F.coalesce(cut(tail_s, tail_e, "base_qualities"), F.lit("")))
    else:
        quality = F.lit(None).cast("string")
    good = (ce > cs) & (F.length("read") > 0)
    when = lambda x: F.when(F.coalesce(good, F.lit(False)), x)
    return reads.select(
        "*", when(head).alias("demux_header"), when(F.concat(turned(slice_half_open("read", cs, ce)), tail)).alias("demux_sequence"),
        when(quality).alias("demux_quality"), when(name).alias("demux_bucket"),
    )


def poly_length(reads: DataFrame) -> DataFrame:
    """Adds polyA_lengths: of the polyA coordinates, else of the polyT ones."""
    length = lambda x: _first(f"{x}_Ends", reads) - _first(f"{x}_Starts", reads)
    return reads.withColumn("polyA_lengths", F.coalesce(length("polyA"), length("polyT")))


def has_qualities(reads: DataFrame) -> bool:
    """Whether any read has base qualities."""
    if "base_qualities" not in reads.columns:
        return False
    return bool(reads.where(F.length(F.trim("base_qualities")) > 0).limit(1).count())


def bulk_records(reads: DataFrame, fmt: str = "fasta", poly: bool = False) -> DataFrame:
    """ReadName, header, sequence, quality, record of the insert of each read with good coordinates; qualities are cut or padded with "!" to the sequence's length."""
    cs, ce = _first("cDNA_Starts", reads), _first("cDNA_Ends", reads)
    tail_s = F.coalesce(_first("polyA_Starts", reads), _first("polyT_Starts", reads))
    tail_e = F.coalesce(_first("polyA_Ends", reads), _first("polyT_Ends", reads))
    whole = (tail_e > tail_s) & (tail_e <= F.length("read"))
    seq = slice_half_open("read", cs, ce)
    qual = slice_half_open("base_qualities", cs, ce) if "base_qualities" in reads.columns else F.lit("")
    if poly:
        seq = F.concat(seq, F.coalesce(F.when(whole, slice_half_open("read", tail_s, tail_e)), F.lit("")))
        if "base_qualities" in reads.columns:
            qual = F.concat(qual, F.coalesce(F.when(whole, slice_half_open("base_qualities", tail_s, tail_e)), F.lit("")))
    orientation = F.coalesce("orientation", F.lit("")) if "orientation" in reads.columns else F.lit("NA")
    good = reads.where((ce > cs) & (F.length("read") > 0))
    head = F.concat(F.lit("@" if fmt == "fastq" else ">"), F.col("ReadName"), F.lit(" orientation:"), orientation)
    out = good.select("ReadName", head.alias("header"), seq.alias("sequence"), F.rpad(F.coalesce(qual, F.lit("")), F.length(seq), "!").alias("quality"))
    lines = ["header", "sequence", F.lit("+"), "quality"] if fmt == "fastq" else ["header", "sequence"]
    return out.withColumn("record", F.concat_ws("\n", *lines))
