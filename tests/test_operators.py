"""Operators against plain Python on small tables, and queries against SQL in the other engine."""

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from readloom import queries
from readloom.functions import sequences as sq
from readloom.operators import alignments as al
from readloom.operators import barcodes, binning, discovery, qc

SF = "/root/testdata/sf0.001"


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def one(spark, expr, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(expr.alias("x")).collect()[0].x


def test_expressions(spark):
    assert one(spark, sq.reverse_complement("s"), s="AACGTN") == "NACGTT"
    assert one(spark, sq.first_int("s"), s=" 12.0, 30") == 12 and one(spark, sq.first_int("s"), s="None") is None
    assert one(spark, sq.coordinates("s"), s="1, x, 3.0") == [1, 3]
    assert one(spark, sq.midpoint_quantile("v", 0.25), v=[1, 2, 3, 10]) == 1.5
    assert one(spark, sq.hamming("a", "b"), a="ACGT", b="AGG") == 2 and one(spark, sq.hamming("a", "b"), a="", b="AG") == 2
    assert sorted(one(spark, sq.deletions("s"), s="AAC")) == ["AA", "AC"]
    assert one(spark, sq.slice_half_open("s", F.lit(1), F.lit(3)), s="ACGT") == "CG"


@pytest.mark.parametrize(("n", "label"), [(0, "0_499bp"), (499, "0_499bp"), (500, "500_999bp"), (9999, "9500_9999bp"), (10000, "10000_14999bp"), (50000, "50000_59999bp"), (100000, "100000_124999bp")])
def test_bins(spark, n, label):
    assert binning.with_bin(spark.createDataFrame([(n,)], "read_length long")).collect()[0].length_bin == label


def test_sparse_bins_merge():
    plan = binning.merge_plan([(0, 499, 5), (500, 999, 5), (5000, 5499, 3), (5500, 5999, 3), (6500, 6999, 20)], 10)
    assert plan[0, 499] == (0, 499)  # may be 500 wide at most
    assert plan[5000, 5499] == plan[5500, 5999] == (5000, 5999) and plan[6500, 6999] == (6500, 6999)


def white(spark, seqs):
    return spark.createDataFrame([(k, s) for k, s in enumerate(seqs, 1)], "cell_id long, CBC string")


def brute_correct(seq, seqs, t=2, limit=5):
    if seq in (None, "", "nan"):
        return ("NMF", -1, 0)
    if seq in seqs:
        return (seq, 0, 1)
    if rc(seq) in seqs:
        return (rc(seq), 0, 1)
    every = []
    for probe in (seq, rc(seq)):
        near = sorted((lev(probe, w), k, w) for k, w in enumerate(seqs) if lev(probe, w) <= t)[:limit]
        every += [(d, w) for d, _, w in near]
    if not every:
        return ("NMF", t + 1, 0)
    best = min(d for d, _ in every)
    names = [w for d, w in every if d == best]
    return (",".join(names), best, len(names))


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_correction(spark, threshold):
    rng = random.Random(threshold)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    seqs = list(dict.fromkeys(dna(6) for _ in range(60)))
    seen = [None, "", "nan", *seqs[:5], *map(rc, seqs[5:8]), *(dna(rng.choice((5, 6, 7))) for _ in range(120))]
    got = barcodes.correct(spark.createDataFrame([(s,) for s in seen], "seq string"), barcodes.whitelist_barcodes(white(spark, seqs), "CBC"), threshold)
    assert {r.seq: (r.corrected, r.min_dist, r.n_min) for r in got.collect()} == {s: brute_correct(s, seqs, threshold) for s in seen}


def test_three_edits_compare_few_pairs(spark):
    """Barcodes of 16 bases, three edits: results as by brute force, and halves with one edit leave under 1 % of the pairs to compare."""
    rng = random.Random(9)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    seqs = [dna(16) for _ in range(200)]

    def changed(s):
        for _ in range(rng.randrange(1, 5)):
            k = rng.randrange(len(s))
            s = s[:k] + rng.choice(("", rng.choice("ACGT"), s[k] + rng.choice("ACGT"))) + s[k + 1 :]
        return s

    seen = list(dict.fromkeys([*(changed(rng.choice(seqs)) for _ in range(80)), *(rc(changed(rng.choice(seqs))) for _ in range(20)), *(dna(16) for _ in range(20))]))
    w, s = barcodes.whitelist_barcodes(white(spark, seqs), "CBC"), spark.createDataFrame([(x,) for x in seen], "seq string")
    assert {r.seq: (r.corrected, r.min_dist, r.n_min) for r in barcodes.correct(s, w, 3).collect()} == {x: brute_correct(x, seqs, 3) for x in seen}
    probes = s.withColumn("key", F.explode(barcodes._half_keys("seq", F.lit(16), 3, False)))
    pairs = probes.join(w.withColumn("key", F.explode(barcodes._half_keys("barcode", F.length("barcode"), 3, True))), "key").select("seq", "barcode").distinct().count()
    near = sum(lev(x, b) <= 3 for x in seen for b in seqs)
    assert near <= pairs < near + 0.01 * len(seen) * len(seqs)


def test_cells_and_records(spark):
    w = white(spark, ["AAAACCCC", "GGGGTTTT"])
    rows = [("r1", "AAAAGGGGCCCCAAAATTTT", "ABCDEFGHIJKLMNOPQRST", "+", "AAAACCCC", [0], [12], [0], [4], [12], [20]), ("r2", "ACGTACGTACGTACGTACGT", "ABCDEFGHIJKLMNOPQRST", "-", "TTTTTTTT", [0], [4], [4], [8], None, None), ("r3", "ACGT", None, "+", None, [3], [2], None, None, None, None)]
    schema = "ReadName string, read string, base_qualities string, orientation string, CBC_Sequences string, cDNA_Starts array<int>, cDNA_Ends array<int>, UMI_Starts array<int>, UMI_Ends array<int>, polyA_Starts array<int>, polyA_Ends array<int>"
    done = barcodes.cells(barcodes.with_corrections(spark.createDataFrame(rows, schema), w, ["CBC"], 0), w)
    got = {r.ReadName: r for r in barcodes.demux_records(done, ["CBC"], "fwd", "fastq", poly=True).collect()}
    assert got["r1"].cell_id == "1" and got["r1"].demux_header == "@r1_1_AAAA cell_id:1|Barcodes:CBC:AAAACCCC|UMI:AAAA|orientation:+"
    assert got["r1"].demux_sequence == "AAAAGGGGCCCCAAAATTTT" and got["r1"].demux_quality == "ABCDEFGHIJKLMNOPQRST"
    assert got["r2"].demux_bucket == "ambiguous" and got["r2"].demux_sequence == rc("ACGT") and "_ambiguous_" in got["r2"].demux_header
    assert got["r3"].demux_header is None and got["r3"].corrected_CBC_min_dist == -1
    unique = {r.ReadName: r.cell_id for r in barcodes.cells_unique(done.drop("cell_id", "match_type"), w).collect()}
    assert unique == {"r1": "1", "r2": "ambiguous", "r3": "ambiguous"}
    assert barcodes.bulk_records(spark.createDataFrame(rows, schema), "fastq").where("ReadName = 'r1'").collect()[0].quality == "ABCDEFGHIJKL"


def test_several_barcodes(spark):
    w = spark.createDataFrame([(1, "AA", "CC", "GG"), (2, "AA", "CC", "TT"), (3, "TT", "CC", "AA")], "cell_id long, a string, b string, c string")
    rows = [("AA", "CC", "GG"), ("AA", "CC", "NMF"), ("AA", "CC", "CC"), ("TT", "GG", "AA"), ("AA,TT", "CC", "AA")]
    got = [r.cell_id for r in barcodes.cells_multi(spark.createDataFrame(rows, "corrected_a string, corrected_b string, corrected_c string"), w, ["a", "b", "c"]).orderBy("corrected_a", "corrected_b", "corrected_c").collect()]
    want = {("AA", "CC", "GG"): "1", ("AA", "CC", "NMF"): "ambiguous", ("AA", "CC", "CC"): "ambiguous", ("TT", "GG", "AA"): "3", ("AA,TT", "CC", "AA"): "3"}
    assert got == [want[k] for k in sorted(want)]


def brute_merge(counts):
    canon, out = [], {}
    for b, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        out[b] = next((c for c in canon if lev(b, c) <= 1), b)
        if out[b] == b:
            canon.append(b)
    return out


def test_merge_of_near_copies(spark):
    rng = random.Random(8)
    counts = {"".join(rng.choice("AC") for _ in range(rng.choice((5, 6)))): rng.randrange(1, 9) for _ in range(60)}
    df = spark.createDataFrame(list(counts.items()), "CBC string, read_count long")
    got = {r.CBC: r.canonical[0] for r in discovery.merge_near(df, ["CBC"]).collect()}
    assert got == brute_merge(counts)
    white_ = discovery.whitelist(discovery.merge_near(df, ["CBC"]), ["CBC"]).collect()
    assert sorted(r.cell_id for r in white_) == list(range(1, len(set(got.values())) + 1))
    status = {r.CBC: r.status for r in discovery.statuses(df, discovery.merge_near(df.where("read_count > 2"), ["CBC"]), ["CBC"]).collect()}
    assert set(status.values()) >= {"canonical", "below_knee"}


def test_knee_edges(spark):
    same = spark.createDataFrame([("A", 5), ("C", 5)], "CBC string, read_count long")
    assert discovery.knee(same, 3, 0.5).collect()[0].threshold == 3.0
    assert discovery.knee(same, 9, 0.5).count() == 0
    some = spark.createDataFrame([(str(k), 100 - k) for k in range(50)], "CBC string, read_count long")
    assert discovery.knee(some, 3, 0.5, expected=10).collect()[0].cliff_count == 91


def test_duplicates_inherit_in_order(spark):
    rows = [("x_7_AAAA", 0, "c", 5, 105, 0), ("y_7_AAAT", 0, "c", 6, 106, 1), ("y_7_AAAT", 256, "c", 7, 300, 2), ("y_7_AAAT", 256, "c", 1, 300, 3), ("noumi", 0, "c", 5, 105, 4), ("z_7_CCCC", 4, "c", 5, 105, 5), ("w_8_AAAA", 0, "c", 5, 105, 6), ("v_7_AAAA", 16, "c", 5, 105, 7)]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], "qname string, flag int, rname string, start long, end long, ord long, cb string, ub string, dt string")
    got = {r.ord: (r.flag, r.dt) for r in al.mark_duplicates(df, 1).collect()}
    assert got == {0: (0, "No"), 1: (1024, "Yes"), 2: (1280, "Yes"), 3: (256, None), 4: (0, None), 5: (4, None), 6: (0, "No"), 7: (16, "No")}
    loose = {r.ord: r.dt for r in al.mark_duplicates(df, 1, per_cell=False, stranded=False).collect()}
    assert loose[6] == loose[7] == "Yes"


def test_box_stats(spark):
    rng = random.Random(1)
    rows = [(g, rng.randrange(20)) for g in "ab" for _ in range(rng.randrange(5, 40))] + [("one", 4)]
    got = {r.g: tuple(r)[1:] for r in qc.box_stats(spark.createDataFrame(rows, "g string, x long"), "g", "x").collect()}
    for g in ("a", "b", "one"):
        v = sorted(x for k, x in rows if k == g)
        mid = lambda q, v=v: (v[int((len(v) - 1) * q)] + v[-int(-(len(v) - 1) * q // 1)]) / 2
        assert got[g] == (len(v), v[0], mid(0.25), mid(0.5), mid(0.75), v[-1])


def test_blocks(spark):
    df = spark.createDataFrame([("q", 0, "c", 100, "5S10M2D3M100N4M1I2M")], "qname string, flag int, rname string, start long, cigar string")
    assert [(r.start, r.end) for r in qc.blocks_of(df).collect()] == [(100, 110), (112, 115), (215, 219), (219, 221)]


def _plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", ["length_bins", "label_runs", "structure_match", "annotations", "split_concatenated", "barcode_correction", "canonical_counts", "knee_threshold", "near_duplicate_pairs", "merged_barcodes", "multi_barcode_cells", "umi_leaders", "marked_duplicates", "alignment_classes_per_cell", "alignment_stats", "gene_body_coverage", "cell_metrics", "label_scores", "segment_edits"])
def test_query_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    want = con.sql(queries.ORACLES[name])
    columns = sorted(df.columns)
    assert sorted(want.columns) == columns
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    at = [want.columns.index(c) for c in columns]
    assert got == sorted((tuple(_plain(r[k]) for k in at) for r in want.fetchall()), key=repr) and got


def test_gene_body_coverage_of_whole_tables(spark):
    """Genes beyond the first 200 count: sf0.01 has 2 000 parts."""
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for name in ("part", "lineitem"):
        con.sql(f"create view {name} as select * from '{d}/{name}.parquet'")
    got = sorted((r.percentile, r.coverage) for r in queries.QUERIES["gene_body_coverage"](spark, d).collect())
    assert got == sorted(con.sql(queries.ORACLES["gene_body_coverage"]).fetchall())
    first = con.sql(queries.ORACLES["gene_body_coverage"]).fetchall()
    assert sum(n for _, n in got) > 5 * sum(n for _, n in first)


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_near_barcodes_by_pieces_and_by_deletions(spark, monkeypatch, threshold):
    """Both ways find every pair within the threshold, of barcodes of several lengths, and no other; none compares all pairs."""
    rng = random.Random(threshold)
    seqs = sorted({"".join(rng.choice("ACGT") for _ in range(rng.choice([5, 7, 8]))) for _ in range(60)})
    probes = sorted({"".join(rng.choice("ACGT") for _ in range(rng.choice([0, 3, 6, 7, 9]))) for _ in range(120)})
    left = spark.createDataFrame([(p, 0, p) for p in probes], "seq string, side int, probe string")
    right = spark.createDataFrame([(s, k) for k, s in enumerate(seqs)], "barcode string, place int")
    want = sorted((p, s, lev(p, s)) for p in probes for s in seqs if lev(p, s) <= threshold)
    for many in (0, 10**6):
        monkeypatch.setattr(barcodes, "MANY", many)
        pairs = barcodes._near(left, right, threshold)
        assert sorted((r.seq, r.barcode, r.dist) for r in pairs.collect()) == want
        assert "CartesianProduct" not in (plan := pairs._jdf.queryExecution().toString()) and "NestedLoop" not in plan


def test_crowded_keys_have_the_leaders_of_the_fold(spark, monkeypatch):
    """Keys with more UMIs than are folded in one row: rounds of joins, with ties of place and UMIs near several leaders."""
    rng = random.Random(5)
    rows = [(k, f"r{k}_{rng.choice('12')}_" + "".join(rng.choice("AC") for _ in range(7)), 0, rng.choice(["x", "y"]), 10 + rng.randrange(9), 100 + rng.randrange(9)) for k in range(400)]
    df = spark.createDataFrame(rows, "ord long, qname string, flag int, rname string, start long, end long")
    for threshold in (0, 1, 2):
        monkeypatch.setattr(al, "FOLDED", 10**6)
        want = sorted(map(tuple, al.umi_decisions(df, threshold).select("ord", "name_umi", "umi_leader", "is_dup").collect()))
        monkeypatch.setattr(al, "FOLDED", 5)
        assert sorted(map(tuple, al.umi_decisions(df, threshold).select("ord", "name_umi", "umi_leader", "is_dup").collect())) == want
        assert len({w[2] for w in want}) > 1


def test_ranks_need_no_single_task(spark):
    """Places over many partitions, nearly all of one count; no window over all rows."""
    rng = random.Random(6)
    rows = [(f"b{k:05d}", 1 if rng.random() < 0.95 else rng.randrange(2, 9)) for k in range(5000)]
    rng.shuffle(rows)
    ranked = discovery.ranked(spark.createDataFrame(rows, "CBC string, read_count long").repartition(9))
    want = {b: k for k, (b, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1)}
    assert {r.CBC: r["rank"] for r in ranked.collect()} == want
    assert "Window" not in ranked._jdf.queryExecution().toString()
    assert discovery.ranked(spark.createDataFrame([], "CBC string, read_count long")).count() == 0


def test_a_spliced_read_does_not_count_for_what_it_jumps(spark):
    rows = [("a", 0, "c", 100, "10M90N10M", "1"), ("b", 16, "c", 150, "20M", "1"), ("d", 256, "c", 150, "20M", "1"), ("e", 4, "c", 150, "20M", "1")]
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, start long, cigar string, cb string")
    genes = spark.createDataFrame([("c", 95, 130, "left", "+"), ("c", 140, 180, "inside", "+"), ("c", 160, 220, "right", "-")], "rname string, start long, end long, gene_id string, strand string")
    count = lambda **how: {r.gene_id: r["count"] for r in al.gene_counts(qc.blocks_of(df, al.UNMAPPED), genes, 50, **how).collect()}
    assert count() == {"left": 1, "right": 3, "inside": 2}
    assert count(stranded=True) == {"left": 1, "inside": 1, "right": 1} and count(overlapping=False) == {}


def test_structures_are_judged_once_an_order_and_reads_are_not_moved(spark):
    from readloom.operators import structure

    s = structure.Segments((("5p", "5"), ("cDNA", "D"), ("3p", "3")), (("5p", "cDNA", "3p"),))
    reads = spark.createDataFrame([(f"r{k}", "ACGT" * 5, ("5" * 8 + "D" * 10 + "33") if k % 3 else "D" * 20) for k in range(300)], "ReadName string, read string, labels string")
    done = structure.with_structure(structure.with_runs(reads, "labels", s), s)
    assert done.where("structure.valid").count() == 200
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan and "SortMergeJoin" not in plan and "MapInPandas" not in plan and "ArrowEvalPython" not in plan
