"""Configuration, batch sizes, progress, sources, commands, streaming."""

import gzip
import random
import struct
import zlib

import pytest
import yaml
from pyspark.sql import functions as F

from readloom.plans import batching, commands, config, progress
from readloom.sources import alignments as sam
from readloom.sources import fastx, tables

PIECES = {"lead": "GATTACAGG", "well": "N9", "tag": "N7", "cDNA": "NN", "stop": "CCTTAGC"}


def configuration(**model):
    """One library of five pieces and a model `small` over it, which changes what is given."""
    library = {
        "strand": "rev", "barcodes": ["well"], "umis": ["tag"], "segments": [{"name": n, "pattern": p} for n, p in PIECES.items()],
        "training_structures": {"whole": {"order": list(PIECES), "proportion": 0.55}, "no_stop": {"order": list(PIECES)[:-1], "proportion": 0.25}, "pair": {"order": list(PIECES), "repeat": 2, "rc_pattern": ["fwd", "rev"], "proportion": 0.2}},
    }
    return {"libraries": {"plate": library}, "models": {"small": {"library": "plate", **model}}}


def test_a_model_has_what_its_library_has():
    lib = config.library(configuration(), "small")
    assert dict(zip(lib.names, lib.patterns, strict=True)) == PIECES and lib.valid == [list(PIECES)]
    assert (lib.strand, lib.barcodes, lib.umis) == ("rev", ["well"], ["tag"])
    assert lib.known_adapters() == {n: PIECES[n] for n in ("lead", "stop")}
    assert lib.barcode_lengths(["well", "tag", "cDNA", "none"]) == {"well": 9, "tag": 7, "cDNA": None, "none": None}
    plans = config.structures(configuration(), "small")
    assert [(s.name, s.proportion, s.repeat, s.length_range) for s in plans] == [("whole", 0.55, 1, None), ("no_stop", 0.25, 1, None), ("pair", 0.2, 2, None)]


@pytest.mark.parametrize(("changes", "want"), [
    ({"no_stop": None, "pair": {"proportion": 0.45}}, {"whole": 0.55, "pair": 0.45}),
    ({"whole": {"proportion": 0.15}, "late": {"order": ["stop"], "proportion": 0.4}}, {"whole": 0.15, "no_stop": 0.25, "pair": 0.2, "late": 0.4}),
    ({}, {"whole": 0.55, "no_stop": 0.25, "pair": 0.2}), (None, {"default": 1.0}),
])
def test_structures_are_merged_by_name(changes, want):
    c = configuration(training_structures=changes)
    assert {s.name: s.proportion for s in config.structures(c, "small")} == want
    assert c["libraries"] == configuration()["libraries"]  # the library stays


def test_what_a_structure_says_of_itself():
    odd = {"order": ["stop:reverse", "tag", "lead:rev"], "repeat": 3, "rc_pattern": ["rev", "fwd", "reverse"], "proportion": 1.0, "length_range": [30, 60]}
    c = configuration(strand="fwd", segments=[{"name": n, "pattern": p} for n, p in PIECES.items()], training_structures={"whole": None, "no_stop": None, "pair": None, "odd": odd})
    s = config.structures(c, "small")[0]
    assert (s.order, s.rc_elements, s.rc_pattern, s.length_range) == (("stop", "tag", "lead"), {"stop": "reverse", "lead": "rev"}, ("rev", "fwd", "reverse"), (30, 60))
    assert s.patterns == ("CCTTAGC", "N7", "GATTACAGG") and config.library(c, "small").strand == "fwd"
    assert [x.name for x in config.structures(c, "small", "assessment")] == ["default"]


@pytest.mark.parametrize(("c", "model", "word"), [
    (configuration(), "large", "large"), (configuration(library="bowl"), "small", "bowl"), ({"libraries": {}, "models": {"m": {}}}, "m", "library"), ({"flat": {}}, "other", "other"),
    (configuration(training_structures={"pair": {"rc_pattern": ["fwd"]}}), "small", "rc_pattern"), (configuration(training_structures={"pair": {"rc_pattern": ["fwd", "up"]}}), "small", "'up'"),
])
def test_wrong_configurations_are_named(c, model, word):
    with pytest.raises(ValueError, match=word):
        config.structures(c, model)


def test_other_configurations(tmp_path):
    with pytest.warns(UserWarning, match="0.9500"):
        config.structures(configuration(training_structures={"whole": {"proportion": 0.5}}), "small")
    with pytest.raises(FileNotFoundError):
        config.load(str(tmp_path / "none.yaml"))
    flat = {"alone": {"strand": "reverse", "barcodes": [], "segments": [{"name": "body", "pattern": "NN"}]}, "second": {}}
    assert config.models(flat) == ["alone", "second"] and config.models(configuration()) == ["small"]
    assert (config.library(flat, "alone").strand, config.library(flat, "alone").valid) == ("reverse", [["body"]])


def test_grid():
    g = config.grid({"lr": [0.1, 0.2], "conv_filters": [64, 64], "lstm_units": [[1, 2], [3]], "epochs": 3})
    assert len(g) == 4 and all(x["conv_filters"] == [64, 64] for x in g)


def test_batches():
    assert batching.average_length("500_999bp") == 749.5 and batching.dynamic_chunk(100000, "0_499bp") == 200400 and batching.dynamic_chunk(100000, "0_9bp") == 500_000
    assert batching.by_tokens(1000) == 1200 and batching.by_tokens(0) == 1 and batching.memory_of("48,24", 3) == [48 * batching.GIB] * 3
    assert round(batching.bytes_a_token()) == 6644 and batching.usable([100], [20], 0.5) == [40]
    assert batching.batch_size(1000, 6644, None) == 1200 and batching.batch_size(1000, 6644, [10**9] * 2) == 2 * (10**9 // 6644000)
    calls = []

    def run(n):
        calls.append(n)
        if n > 3:
            raise MemoryError
        return n

    assert batching.with_backoff(run, 16) == 2 and calls == [16, 8, 4, 2]


def test_progress(tmp_path):
    file = tmp_path / "at.txt"
    progress.save(str(file), 1, "500_999bp", 7, 100000)
    assert progress.load(str(file), 100000) == (1, "500_999bp", 7)
    with pytest.raises(ValueError, match="chunk_size mismatch"):
        progress.load(str(file), 5)
    file.write_text("1\t0_499bp\t11\n")
    with pytest.warns(UserWarning):
        assert progress.load(str(file), 100000) == (1, "0_499bp", 11)
    assert progress.load(str(tmp_path / "none")) is None
    for k in (0, 1, 2):
        (tmp_path / f"pass1_0_499bp_chunk{k}.tsv").write_text("")
    assert progress.rewind(str(tmp_path), (1, "0_499bp", 2)) == (1, "0_499bp", 1)
    assert progress.clear_after(str(tmp_path), (1, "0_499bp", 1), ["0_499bp"]) == ["pass1_0_499bp_chunk2.tsv"]


def test_sequence_files(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">r1 x\nACG\nT\n>r2\nGG\n")
    with gzip.open(tmp_path / "b.fastq.gz", "wt") as f:
        f.write("@r3 y\nACGT\n+\nIIII\n@r4\n\n+\n\n")
    (tmp_path / "c.txt").write_text("no")
    (tmp_path / "d.fq").write_text("@r5\nAC\n+\n!!\n")
    got = {r.ReadName: (r.read, r.base_qualities, r.read_length) for r in fastx.read_sequences(spark, str(tmp_path)).collect()}
    assert got == {"r1": ("ACGT", None, 4), "r2": ("GG", None, 2), "r3": ("ACGT", "IIII", 4), "r4": ("", "", 0), "r5": ("AC", "!!", 2)}


def bgzf(data):
    """One block of a compressed alignment file."""
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    packed = z.compress(data) + z.flush()
    return sam.BLOCK_MARK + struct.pack("<H", len(packed) + 25) + packed + struct.pack("<II", zlib.crc32(data), len(data))


def test_alignment_files(spark, tmp_path):
    text = "@SQ\tSN:c\tLN:1000\nq_1_AC\t16\tc\t11\t60\t5M2D3M1I2S\t*\t0\t0\tACGTACGTACG\t*\tCB:Z:7\tUB:Z:AC\tDT:Z:No\nu\t4\t*\t0\t0\t*\t*\t0\t0\tAC\t*\n"
    (tmp_path / "a.sam").write_text(text)
    rows = sam.read_sam(spark, str(tmp_path / "a.sam")).drop("ord").collect()
    assert tuple(rows[0]) == ("q_1_AC", 16, "c", 10, 20, 60, "5M2D3M1I2S", "ACGTACGTACG", "7", "AC", "No")
    cigar = [(5, 0), (2, 2), (3, 0), (1, 1), (2, 4)]
    body = struct.pack("<iiBBHHHiiii", 0, 10, 7, 60, 0, len(cigar), 16, 11, -1, -1, 0) + b"q_1_AC\0" + b"".join(struct.pack("<I", n << 4 | o) for n, o in cigar)
    codes = [1, 2, 4, 8] * 3
    body += bytes(codes[k] << 4 | (codes[k + 1] if k + 1 < 11 else 0) for k in range(0, 11, 2)) + b"\xff" * 11 + b"CBZ7\0UBZAC\0NMi\x01\0\0\0DTZNo\0"
    data = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 2) + b"c\0" + struct.pack("<i", 1000) + struct.pack("<i", len(body)) + body
    (tmp_path / "a.bam").write_bytes(bgzf(data[:30]) + bgzf(data[30:]) + bgzf(b""))
    got = sam.read_bam(spark, str(tmp_path / "a.bam")).drop("ord").collect()
    assert [tuple(r) for r in got] == [tuple(rows[0])]
    assert sam.sam_lines(sam.read_sam(spark, str(tmp_path / "a.sam"))).collect()[0].value.startswith("q_1_AC\t16\tc\t11\t60\t5M2D3M1I2S\t*\t0\t0\tACGTACGTACG\t*\tCB:Z:7")


@pytest.fixture
def small_parts(spark):
    """Files are cut into parts of some hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k in names:
        spark.conf.unset(k)


def test_sequence_files_in_many_parts(spark, tmp_path, small_parts):
    """Qualities that begin like headers, records over part boundaries, gzip beside plain, lines of any length."""
    rng = random.Random(8)
    want, files = [], {"a.fastq": "", "b.fq": "", "c.fq.gz": "", "d.fa": "", "e.fasta.gz": ""}
    for k in range(700):
        name = rng.choice(list(files))
        seq = "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 90)))
        if ".fa." in name or name.endswith((".fa", ".fasta.gz")):
            files[name] += f">r{k} more\n" + "".join(seq[i : i + 30] + "\n" for i in range(0, len(seq), 30))
            want.append((f"r{k}", seq, None))
        else:
            quality = ("@" + "".join(rng.choice("@!I+>") for _ in seq))[: len(seq)] if rng.random() < 0.5 else "I" * len(seq)
            files[name] += f"@r{k} more\n{seq}\n+{rng.choice(['', 'r'])}\n{quality}\n"
            want.append((f"r{k}", seq, quality))
    files["b.fq"] = files["b.fq"].replace("\n", "\r\n").rstrip()  # no line end after the last record
    for name, text in files.items():
        (tmp_path / name).write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
    df = fastx.read_sequences(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() > 20
    assert sorted(((r.ReadName, r.read, r.base_qualities) for r in df.collect()), key=repr) == sorted(want, key=repr)


def bam_bytes(records, contigs=("chr1", "chr2"), rng=None):
    """A BAM file in blocks that end anywhere."""
    header = b"@HD\tVN:1.6\n"
    data = b"BAM\1" + struct.pack("<i", len(header)) + header + struct.pack("<i", len(contigs))
    for c in contigs:
        data += struct.pack("<i", len(c) + 1) + c.encode() + b"\0" + struct.pack("<i", 1 << 20)
    for name, flag, ref, pos, length, tag in records:
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 30, 0, 1, flag, length, -1, -1, 0) + name.encode() + b"\0" + struct.pack("<I", length << 4) + bytes([0x12] * ((length + 1) // 2)) + b"\xff" * length + b"CBZ" + tag.encode() + b"\0"
        data += struct.pack("<i", len(body)) + body
    out, at = b"", 0
    while at < len(data):
        n = rng.randrange(40, 400) if at else 200
        out += bgzf(data[at : at + n])
        at += n
    return out + bgzf(b"")


def test_alignments_in_many_parts(spark, tmp_path, small_parts):
    """Records over blocks and parts, some longer than a part; two files of different contigs; order kept; a region."""
    rng = random.Random(9)
    want = {}
    for f, contigs in (("x.bam", ("chr1", "chr2")), ("y.bam", ("c9", "c8", "c7"))):
        records = [(f"{f[0]}{k}_7_ACGT", 16 * (k % 2), rng.randrange(-1, len(contigs)), 100 * k, rng.choice([20, 50, 300, 6000 if k % 50 == 7 else 20]), f"cell{k % 5}") for k in range(300)]
        want |= {n: (flag, contigs[ref] if ref >= 0 else "*", pos, pos + length, "AC" * (length // 2), tag) for n, flag, ref, pos, length, tag in records}
        (tmp_path / f).write_bytes(bam_bytes(records, contigs, rng))
    df = sam.read_bam(spark, str(tmp_path))
    rows = df.collect()
    assert {r.qname: (r.flag, r.rname, r.start, r.end, r.seq, r.cb) for r in rows} == want and len(rows) == 600
    assert len({r.ord for r in rows}) == 600
    for f in "xy":
        assert [r.qname for r in sorted(rows, key=lambda r: r.ord) if r.qname[0] == f] == [n for n in want if n[0] == f]
    near = sam.read_bam(spark, str(tmp_path / "x.bam"), ("chr2", 5000, 9000)).collect()
    assert {r.qname for r in near} == {n for n, w in want.items() if w[1] == "chr2" and w[2] < 9000 and w[3] > 5000}
    assert sam.by_region(df, 3).rdd.getNumPartitions() == 3


def test_part_files_become_one(spark, tmp_path):
    spark.range(500).selectExpr("cast(id as string) value").repartition(4).write.option("compression", "gzip").text(str(tmp_path / "parts"))
    assert fastx.concatenate(spark, str(tmp_path / "parts"), (tmp_path / "one.txt.gz").as_uri()) == 4
    assert sorted(map(int, gzip.decompress((tmp_path / "one.txt.gz").read_bytes()).split())) == list(range(500))


def test_annotation_tables(spark, tmp_path):
    (tmp_path / "g.gtf").write_text('#!x\nc\ts\tgene\t1\t90\t.\t+\t.\tgene_id "G1.5"; gene_name "MT-A"; gene_type "rna";\nc\ts\texon\t11\t20\t.\t+\t.\tgene_id "G1.5"; transcript_id "T1";\nc\ts\tgene\t1\t9\t.\t-\t.\tgene_id "G2"; gene_biotype "p";\n')
    assert [tuple(r) for r in tables.gtf_genes(spark, str(tmp_path / "g.gtf")).collect()] == [("G1", "MT-A", "rna"), ("G2", "G2", "p")]
    assert [tuple(r) for r in tables.gtf_exons(spark, str(tmp_path / "g.gtf")).collect()] == [("T1", "G1", "c", "+", 10, 20)]
    (tmp_path / "w.tsv").write_text("# made\nCBC\ti5\nAA\tCC\nGG\tTT\n")
    assert [tuple(r) for r in tables.read_whitelist(spark, str(tmp_path / "w.tsv")).collect()] == [(1, "AA", "CC"), (2, "GG", "TT")]
    (tmp_path / "f.txt").write_text("# cmd\nGeneid\tChr\tStart\tEnd\tStrand\tLength\tc1.bam\nG1\tc\t1\t2\t+\t2\t7\n")
    assert [tuple(r) for r in tables.read_matrix(spark, str(tmp_path / "f.txt")).collect()] == [("G1", "c1.bam", 7)]
    (tmp_path / "s1").write_text("Status\t/x/a.bam\nAssigned\t3\n")
    (tmp_path / "s2").write_text("Status\t/y/a.bam\t/y/b.bam\nAssigned\t9\t4\n")
    assert sorted(tuple(r) for r in tables.read_assignments(spark, [str(tmp_path / "s1"), str(tmp_path / "s2")]).collect()) == [("a", "Assigned", 3), ("b", "Assigned", 4)]
    both = tables.combine([spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x",)], "b string")], "v1")
    assert sorted(map(str, (tuple(r) for r in both.collect()))) == ["(1, None, 'v1')", "(None, 'x', 'v1')"]


def test_commands_end_to_end(spark, tmp_path):
    lib = configuration()
    long = PIECES | {"lead": "CTACACGACGCTCTTCCGATCT", "well": "N16", "stop": "CCCATGTACTCTGCGTTG"}
    lib["libraries"]["plate"]["segments"] = [{"name": n, "pattern": p} for n, p in long.items()]
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(lib))
    run = lambda *a: commands.main([str(x) for x in a], spark)
    base = ["--config", tmp_path / "c.yaml", "--model", "small"]
    run("simulate-data", *base, "--num-reads", 40, "--out", tmp_path / "sim", "--mismatch-rate", 0, "--insertion-rate", 0, "--deletion-rate", 0, "--no-rc")
    truth = spark.read.parquet(str(tmp_path / "sim"))
    truth.select("ReadName", "read", F.length("read").alias("read_length")).write.parquet(str(tmp_path / "reads"))
    run("annotate-reads", *base, "--reads", tmp_path / "reads", "--labels", tmp_path / "sim", "--out", tmp_path / "ann")
    (tmp_path / "out").mkdir()
    run("generate-whitelist", "--annotations", tmp_path / "ann/annotations", "--columns", "well", "--out", tmp_path / "out", "--min-reads-per-barcode", 1)
    run("barcode-correct", "--annotations", tmp_path / "ann/annotations", "--whitelist", tmp_path / "out/whitelist.tsv", "--out", tmp_path / "cor", "--demux")
    done = spark.read.parquet(str(tmp_path / "cor/corrected"))
    full = truth.where("structure_type = 'whole'").count()
    assert done.count() == full and done.where("cell_id != 'ambiguous'").count() == full
    assert spark.read.text(str(tmp_path / "cor/demuxed")).count() == 2 * full
    rows = spark.read.parquet(str(tmp_path / "ann/annotations"))
    done.write.parquet(str(tmp_path / "valid"))
    rows.where("architecture = 'invalid'").write.parquet(str(tmp_path / "invalid"))
    run("qc-metrics", "--valid", tmp_path / "valid", "--invalid", tmp_path / "invalid", "--out", tmp_path / "out")
    assert (tmp_path / "out/read_architecture.tsv").read_text().splitlines()[2].startswith("Total\t40")
    run("assess-model", *base, "--truth", tmp_path / "sim", "--annotations", tmp_path / "ann/annotations", "--out", tmp_path / "out")
    assert "whole" in (tmp_path / "out/structure_accuracy.tsv").read_text()
    assert all((tmp_path / f"out/{n}").exists() for n in ("barcode_discovery.tsv", "cdna_length_per_cell.tsv", "report.html"))


NETWORK = """
def parity(codes):
    return codes % 2

def make_parity():
    return parity

def trained(path, classes, entry):
    return {"loss": entry["lr"], "classes": len(classes)}
"""


def test_networks_bins_and_trainers(spark, tmp_path):
    """A network in annotate-reads, bin by bin; a run that stopped after the first bin goes on with the second; a trainer gets every entry."""
    (tmp_path / "own_network.py").write_text(NETWORK)
    spark.sparkContext.addPyFile(str(tmp_path / "own_network.py"))
    lib = configuration()
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(lib))
    (tmp_path / "p.yaml").write_text(yaml.safe_dump({"small": {"lr": [0.1, 0.2], "epochs": 2}}))
    base = ["--config", str(tmp_path / "c.yaml"), "--model", "small"]
    rows = [("a", "ACGT" * 10, 40, "0_499bp"), ("b", "GGCC" * 150, 600, "500_999bp")]
    spark.createDataFrame(rows, "ReadName string, read string, read_length long, length_bin string").write.partitionBy("length_bin").parquet(str(tmp_path / "reads"))
    run = ["annotate-reads", *base, "--reads", str(tmp_path / "reads"), "--out", str(tmp_path / "out"), "--network", "own_network:make_parity", "--classes", "cDNA,lead", "--by-bin"]
    commands.main(run, spark)
    done = spark.read.parquet(str(tmp_path / "out/annotations"))
    assert {(r.ReadName, r.length_bin, r.architecture) for r in done.collect()} == {("a", "0_499bp", "invalid"), ("b", "500_999bp", "invalid")}
    assert {r.ReadName: r.lead_Starts[:2] for r in done.collect()} == {"a": [0, 2], "b": [0, 4]}
    progress.save(str(tmp_path / "out/checkpoint.txt"), 1, "0_499bp", 0, 8192)
    before = {f: (tmp_path / "out/annotations" / f / "_SUCCESS").stat().st_mtime_ns for f in ("length_bin=0_499bp", "length_bin=500_999bp")}
    commands.main(run, spark)
    after = {f: (tmp_path / "out/annotations" / f / "_SUCCESS").stat().st_mtime_ns for f in before}
    assert after["length_bin=0_499bp"] == before["length_bin=0_499bp"] and after["length_bin=500_999bp"] > before["length_bin=500_999bp"]
    spark.createDataFrame([("a", "ACG", ["x", "y", "y"])], "ReadName string, read string, labels array<string>").write.parquet(str(tmp_path / "data"))
    commands.main(["train-model", *base, "--params", str(tmp_path / "p.yaml"), "--data", str(tmp_path / "data"), "--out", str(tmp_path / "batches"), "--trainer", "own_network:trained"], spark)
    import json

    plan = json.loads((tmp_path / "batches.json").read_text())
    assert plan["classes"] == ["x", "y"] and plan["history"] == [{"loss": 0.1, "classes": 2}, {"loss": 0.2, "classes": 2}]
    assert spark.read.parquet(str(tmp_path / "batches")).first().ids == [0, 1, 1]


def test_assessment_in_stages(spark, tmp_path):
    """Simulated, binned, annotated by their labels and scored; a second run does only what is missing."""
    lib = configuration()
    long = PIECES | {"lead": "CTACACGACGCTCTTCCGATCT", "well": "N16", "stop": "CCCATGTACTCTGCGTTG"}
    lib["libraries"]["plate"]["segments"] = [{"name": n, "pattern": p} for n, p in long.items()]
    lib["libraries"]["plate"]["assessment_structures"] = {k: lib["libraries"]["plate"]["training_structures"][k] | {"proportion": 0.5} for k in ("whole", "pair")}
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(lib))
    run = ["assess-model", "--config", str(tmp_path / "c.yaml"), "--model", "small", "--out", str(tmp_path / "out"), "--num-reads", "40", "--concat-fraction", "0.25", "--max-read-length", "900", "--mismatch-rate", "0", "--insertion-rate", "0", "--deletion-rate", "0"]
    (tmp_path / "out").mkdir()
    commands.main(run, spark)
    sims = spark.read.parquet(str(tmp_path / "out/simulated"))
    kinds = {r.structure_type: r["count"] for r in sims.groupBy("structure_type").count().collect()}
    assert sum(kinds.values()) == 40 and 3 <= kinds["pair"] <= 18 and sims.agg(F.max(F.length("read"))).first()[0] <= 900
    scores = {x.split("\t")[0]: x.split("\t")[1:] for x in (tmp_path / "out/label_scores.tsv").read_text().splitlines()[1:]}
    assert scores["lead"][:3] == ["1.0", "1.0", "1.0"]
    edits = [x.split("\t") for x in (tmp_path / "out/edit_distance.tsv").read_text().splitlines()[1:]]
    assert {e[0] for e in edits} == {"lead", "well", "tag", "stop"} and all(float(v) == 0 for e in edits for v in e[2:])
    before = (tmp_path / "out/simulated/_SUCCESS").stat().st_mtime_ns
    commands.main(run, spark)
    assert (tmp_path / "out/simulated/_SUCCESS").stat().st_mtime_ns == before


def test_inputs_are_found(spark, tmp_path):
    """Parquet before text, the first of the names that is there; chunks that lack columns of others; text becomes arrays."""
    (tmp_path / "chunks").mkdir()
    (tmp_path / "chunks/a.tsv").write_text("ReadName\tread_length\tlead_Starts\tlead_Ends\nr1\t20\t0, 9\t4, 12\n")
    (tmp_path / "chunks/b.tsv").write_text("ReadName\tread_length\treason\nr2\t7\tshort\n")
    got = {r.ReadName: (r.read_length, r.lead_Starts, r.reason) for r in tables.read_annotations(spark, str(tmp_path), ["none", "chunks"]).collect()}
    assert got == {"r1": (20, [0, 9], None), "r2": (7, [], "short")}
    spark.createDataFrame([("p",)], "ReadName string").write.parquet(str(tmp_path / "chunks/x"))
    spark.createDataFrame([("p",)], "ReadName string").write.parquet(str(tmp_path / "corrected"))
    assert [r.ReadName for r in tables.read_annotations(spark, str(tmp_path), ["corrected", "chunks"]).collect()] == ["p"]
    assert tables.find(spark, str(tmp_path), ["no", "chunks", "corrected"]).endswith("/chunks") and tables.find(spark, str(tmp_path), ["no"]) is None


def test_whitelist_rows_keep_their_order(spark, tmp_path, small_parts):
    (tmp_path / "w.tsv").write_text("# note\nA\tB\n\n" + "".join(f"a{k * 7919 % 1000}\tb{k}\n" for k in range(500)))
    got = tables.read_whitelist(spark, str(tmp_path / "w.tsv")).orderBy("cell_id").collect()
    assert [tuple(r) for r in got] == [(k + 1, f"a{k * 7919 % 1000}", f"b{k}") for k in range(500)]


def test_stream_of_alignments(spark, tmp_path):
    from readloom.streaming.dedup import edit_distance, stream_duplicates

    assert [edit_distance("ACGT", x, 2) for x in ("ACGT", "AGT", "TTTT", "A")] == [0, 1, 3, 3]
    schema = "qname string, rname string, cb string, strand string, start long, end long, umi string, ts timestamp"
    rows = [("a", "c", "1", "+", 5, 105, "AAAA", "2024-01-01 00:00:00"), ("b", "c", "1", "+", 6, 106, "AAAT", "2024-01-01 00:00:01"), ("d", "c", "1", "+", 7, 107, "CCCC", "2024-01-01 00:00:02"), ("e", "c", "2", "+", 5, 105, "AAAA", "2024-01-01 00:00:03")]
    spark.createDataFrame(rows, schema.replace("timestamp", "string")).withColumn("ts", F.to_timestamp("ts")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = stream_duplicates(stream, 1).writeStream.format("memory").queryName("dups").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(120)
    assert {r.qname: r.is_dup for r in spark.table("dups").collect()} == {"a": False, "b": True, "d": False, "e": False}
