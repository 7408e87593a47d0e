"""Commands: each reads tables or files, applies operators, and writes tables.

    python -m readloom.plans.commands annotate --reads FOLDER --labels labels.parquet --model 10x3p --config library.yaml --out DIR
"""

from __future__ import annotations

import argparse
import importlib
import json
import os
import shutil
import subprocess
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import alignments, assess, barcodes, binning, discovery, labelers, qc, simulate, structure
from ..sources import alignments as sam
from ..sources import fastx, tables
from . import batching, config, lineage, progress

#: Tables that commands look for in a folder, in this order.
VALID = ["corrected", "annotations", "annotations_valid_bc_corrected.parquet", "annotations_valid.parquet", "valid_chunks", "annotations_valid.tsv"]
INVALID = ["annotations", "annotations_invalid.parquet", "invalid_chunks", "annotations_invalid.tsv"]
COMMANDS: dict[str, tuple] = {}


def command(**options):
    """A command with its options: name=default; a default that is a type means that the option is required."""

    def register(f):
        COMMANDS[f.__name__.replace("_", "-")] = (f, options)
        return f

    return register


def _load(a) -> tuple[config.Library, structure.Segments]:
    lib = config.library(config.load(a.config), a.model)
    return lib, structure.Segments.of(lib.names, lib.valid, lib.barcodes, lib.known_adapters())


def _save(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _loaded(name: str):
    """An object named module:attribute."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def _listed(text: str) -> list[str]:
    return [x for x in text.split(",") if x]


def read_alignments(spark: SparkSession, path: str) -> DataFrame:
    return sam.read_bam(spark, path) if path.endswith(".bam") else sam.read_sam(spark, path) if path.endswith(".sam") else spark.read.parquet(path)


@command(config=str)
def available_models(spark, a):
    """Models of a configuration."""
    for name in config.models(config.load(a.config)):
        print(name)


@command()
def available_gpus(spark, a):
    """Devices that Spark's tasks can have."""
    print(json.dumps({k: list(v.addresses) for k, v in spark.sparkContext.resources.items()}))


@command(reads=str, out=str, bin_size=500, adaptive_bin_threshold=10000, min_reads_per_bin=0, max_padding_fraction=0.2, qualities=False)
def preprocess(spark, a):
    """Sequence files to a table of reads partitioned by length bin."""
    rows = fastx.read_sequences(spark, a.reads)
    rows = rows if a.qualities else rows.drop("base_qualities")
    binned = binning.with_bin(rows, "read_length", a.bin_size, a.adaptive_bin_threshold)
    if a.min_reads_per_bin:
        binned = binning.merge_sparse_bins(binned, a.min_reads_per_bin, a.max_padding_fraction, a.bin_size)
    binned.drop("bin_start", "bin_end").write.mode("overwrite").option("compression", "snappy").partitionBy("length_bin").parquet(a.out)


@command(reads=str, out=str)
def read_length_dist(spark, a):
    _save(binning.length_histogram(spark.read.parquet(a.reads)), a.out)


@command(annotations=str, out=str, n=20, names="", seed=0)
def visualize(spark, a):
    """Annotations of a sample of reads, or of named ones, as text."""
    rows = spark.read.parquet(a.annotations)
    if a.names:
        rows, missing = binning.reads_by_name(rows, a.names.split(","))
        for r in missing.collect():
            print(f"not found: {r.ReadName}")
    else:
        rows = binning.sample_reads(rows, a.n, a.seed)
    tables.write_report(structure.to_text(rows), a.out)


@command(reads=str, config=str, model=str, out=str, labels="", network="", classes="", kernels="", target_tokens=1200000, max_batch_size=8192, device_memory="", vram_headroom=0.35, split_concatenated=False, whitelist="", bc_lv_threshold=2, output_fmt="fasta", include_barcode_quals=False, include_polya=False, demux=False, by_bin=False)
def annotate_reads(spark, a):
    """Labels (a table, a network, or exact adapters) to valid and invalid annotations; with a whitelist corrected, with demux exported.

    network: module:function that builds, in a worker, a function from codes of bases to class ids; classes: their names. by_bin: one length
    bin after another; a run that was interrupted goes on after the last bin that it finished.
    """
    lib, segments = _load(a)
    rows, target = spark.read.parquet(a.reads), f"{a.out}/annotations"
    if a.by_bin:
        order = sorted((r.length_bin for r in rows.select("length_bin").distinct().collect()), key=batching.average_length)
        for name in _unfinished(a, order):
            _annotate(spark, a, lib, segments, rows.where(F.col("length_bin") == name), name).withColumn("length_bin", F.lit(name)).write.mode("overwrite").parquet(f"{target}/length_bin={name}")
            progress.marker(a.out, 1, name, 0).touch()
            progress.save(_checkpoint(a), 1, name, 0, a.max_batch_size)
    else:
        _save(_annotate(spark, a, lib, segments, rows, None), target)
    if a.whitelist:
        a.annotations, a.strand = target, lib.strand
        barcode_correct(spark, a)


def _checkpoint(a) -> str:
    return f"{a.out}/checkpoint.txt"


def _unfinished(a, order: list[str]) -> list[str]:
    """Bins after the last one that a run before finished; what it left of others goes."""
    os.makedirs(a.out, exist_ok=True)
    at = progress.rewind(a.out, progress.load(_checkpoint(a), a.max_batch_size))
    progress.clear_after(a.out, at, order)
    return order[order.index(at[1]) + 1 :] if at and at[1] in order else order


def _annotate(spark, a, lib: config.Library, segments: structure.Segments, rows: DataFrame, length_bin: str | None) -> DataFrame:
    if a.labels:
        rows = labelers.from_truth(rows, spark.read.parquet(a.labels))
    elif a.network:
        names, width, batch = _listed(a.classes) or lib.names, None, 32
        if length_bin:
            width = labelers.padded_width(int(length_bin.removesuffix("bp").split("_")[1]), [tuple(map(int, x.split(":"))) for x in _listed(a.kernels)] or None)
            room = batching.usable(batching.memory_of(a.device_memory, 1), None, a.vram_headroom) if a.device_memory else None
            batch = batching.batch_size(width, batching.bytes_a_token(labels=len(names)), room, a.target_tokens, 1, min(a.max_batch_size, batching.dynamic_chunk(100_000, length_bin)))
        rows = labelers.with_model(rows, _loaded(a.network), names, width, batch)
    else:
        inner = {n: int(p[1:]) for n, p in zip(lib.names, lib.patterns, strict=True) if p.startswith("N") and p[1:].isdigit()}
        rows = labelers.by_adapters(rows, lib.known_adapters(), inner, lib.names, next((n for n in lib.names if n in structure.POLY), None))
    rows = rows.withColumn("labels", structure.as_codes(F.col("labels"), segments))
    return structure.annotate(rows.drop("length_bin"), segments, split=a.split_concatenated)


@command(annotations=str, whitelist=str, out=str, strand="fwd", bc_lv_threshold=2, output_fmt="fasta", include_barcode_quals=False, include_polya=False, demux=False)
def barcode_correct(spark, a):
    rows = structure.valid_reads(tables.read_annotations(spark, a.annotations, VALID[1:]))
    white = tables.read_whitelist(spark, a.whitelist)
    columns = config.barcode_columns([c for c in white.columns if c != "cell_id"], rows.columns)
    white = tables.select_present(white, ["cell_id", *columns])
    rows = barcodes.with_corrections(rows, white, columns, a.bc_lv_threshold)
    rows = barcodes.cells(rows, white) if len(columns) == 1 else barcodes.cells_multi(rows, white, columns)
    fmt = a.output_fmt if barcodes.has_qualities(rows) else "fasta"
    rows = barcodes.demux_records(barcodes.poly_length(rows), columns, a.strand, fmt, a.include_barcode_quals, a.include_polya)
    _save(rows, f"{a.out}/corrected")
    if a.demux:
        fastx.write_records(fastx.demux_text(spark.read.parquet(f"{a.out}/corrected"), fmt), f"{a.out}/demuxed")


@command(annotations=str, columns=str, out=str, config="", model="", expected_cells=0, min_cell_ratio=0.5, min_reads_per_barcode=3)
def generate_whitelist(spark, a):
    columns = a.columns.split(",")
    lengths = _load(a)[0].barcode_lengths(columns) if a.config else None
    found = discovery.discover(tables.read_annotations(spark, a.annotations, VALID[1:]), columns, a.min_reads_per_barcode, a.min_cell_ratio, a.expected_cells or None, lengths)
    for name in ("statuses", "statistics", "ranked"):
        _save(found[name], f"{a.out}/{name}")
    tables.write_report(found["whitelist"].orderBy("cell_id").select(*columns), f"{a.out}/whitelist.tsv", "whitelist")


@command(annotations=str, out=str, output_fmt="fasta", include_polya=False, one_file=False)
def demux_reads(spark, a):
    """Records of corrected annotations, or of all valid reads if they have no cells; FASTA if there are no qualities. one_file: parts are joined."""
    rows = tables.read_annotations(spark, a.annotations, VALID)
    fmt = a.output_fmt if barcodes.has_qualities(rows) else "fasta"
    if "demux_header" in rows.columns:
        fastx.write_records(fastx.demux_text(rows, fmt), a.out)
        kinds = ["demuxed", "ambiguous"]
    else:
        fastx.write_records(barcodes.bulk_records(structure.valid_reads(rows), fmt, a.include_polya), a.out, None)
        kinds = [""]
    for kind in kinds if a.one_file else []:
        folder = f"{a.out}/kind={kind}" if kind else a.out
        if tables.exists(spark, folder):
            fastx.concatenate(spark, folder, f"{a.out}/{kind or 'reads'}.{fmt}.gz")


@command(valid=str, invalid="", out=str, read_len_bin_width=100, bam="", counts="", gtf="", summaries="", columns="", min_cell_ratio=0.5, min_reads_per_barcode=3)
def qc_metrics(spark, a):
    """All tables that the inputs allow, and a page of their first rows. valid and invalid may be folders that hold the annotations."""
    if a.counts and not a.gtf:
        raise SystemExit("--counts needs --gtf")
    valid, invalid = tables.read_annotations(spark, a.valid, VALID), tables.read_annotations(spark, a.invalid or a.valid, INVALID)
    if "architecture" in valid.columns:
        valid = structure.valid_reads(valid)
    if "architecture" in invalid.columns:
        invalid = structure.invalid_reads(invalid)
    totals = qc.summary(valid, invalid)
    out = {"read_architecture": qc.read_architecture(totals), "invalid_reasons": qc.invalid_reasons(invalid), "read_length_dist": qc.length_distribution(valid, invalid, a.read_len_bin_width), "segment_lengths_all": qc.segment_lengths(valid)}
    if "cDNA_length" in valid.columns:
        out["cdna_length_dist"] = qc.length_distribution(valid, None, a.read_len_bin_width, "cDNA_length")
    if qc.cell_column(valid.columns):
        out |= {"barcode_assignment": qc.barcode_assignment(totals), "reads_per_cell": qc.reads_per_cell(valid), "read_length_per_cell": qc.length_per_cell(valid), "segment_lengths_demuxed": qc.segment_lengths(valid, True)}
        if "cDNA_length" in valid.columns:
            out["cdna_length_per_cell"] = qc.length_per_cell(valid, "cDNA_length")
        out |= {f"edit_distance_{b}": qc.edit_distances(valid, b) for b in qc.barcode_types(valid.columns)}
        out |= {f"edit_distance_boxplot_{n}": qc.distance_box_stats(valid, n == "demuxed") for n in ("all", "demuxed")}
    names = _listed(a.columns) or [b for b in qc.barcode_types(valid.columns) if f"{b}_Sequences" in valid.columns]
    if names:
        found = discovery.count_barcodes(valid, names)
        out["barcode_discovery"] = qc.barcode_discovery(discovery.ranked(found), discovery.knee(found, a.min_reads_per_barcode, a.min_cell_ratio))
    if a.bam:
        rows = read_alignments(spark, a.bam)
        cells = alignments.classes_per_cell(rows)
        out |= {"alignment_stats": qc.alignment_stats(cells), "mapping_rate_per_cell": qc.mapping_per_cell(cells), "dup_rate_per_cell": qc.duplicates_per_cell(cells), "duplication_stats": qc.duplication_stats(alignments.duplicate_totals(rows)), "saturation_curve": alignments.saturation(rows)}
        if a.gtf:
            out["gene_body_coverage"] = qc.gene_body_coverage(qc.blocks_of(rows), tables.gtf_exons(spark, a.gtf))
    if a.counts:
        long, info = tables.read_matrix(spark, a.counts), tables.gtf_genes(spark, a.gtf)
        metrics = qc.cell_metrics(long, info)
        out |= {"cell_metrics": metrics, "cell_metric_summary": qc.cell_metric_summary(metrics), "top_expressed_genes": qc.top_genes(long, info), "genes_per_biotype": qc.genes_per_biotype(long, info)}
    if a.summaries:
        out["featurecounts_assignment"] = qc.assignment_totals(tables.read_assignments(spark, _listed(a.summaries)))
    for name, df in out.items():
        tables.write_report(df, f"{a.out}/{name}.tsv", name)
    tables.write_page(f"{a.out}/report.html", "Quality control", out)


@command(reads=str, ref=str, out=str, preset="splice", filt_flag=260, mapq=0, threads=12, extra="")
def align(spark, a):
    """An external aligner; its output goes to the shared folder, and is filtered by flags and quality."""
    if not shutil.which("minimap2"):
        raise SystemExit("minimap2 is not installed")
    with tempfile.TemporaryDirectory() as folder:
        own = f"{folder}/aligned.sam"
        with open(own, "wb") as f:
            subprocess.run(["minimap2", "-ax", a.preset, "-t", str(a.threads), *a.extra.split(), a.ref, a.reads], stdout=f, check=True)
        shared = lineage.share(spark, own, "aligned.sam")
    _save(alignments.pass_flags(sam.read_sam(spark, shared), a.filt_flag, a.mapq), a.out)


@command(bam=str, out=str, lv_threshold=2, stranded=True, per_cell=True, sam_out="")
def dedup(spark, a):
    """Alignments with duplicates marked; sam_out: as SAM lines too, by contig and place, in one file."""
    marked = alignments.mark_duplicates(read_alignments(spark, a.bam), a.lv_threshold, a.per_cell, a.stranded)
    _save(marked, a.out)
    marked = spark.read.parquet(a.out)
    tables.write_report(alignments.duplicate_totals(marked), f"{a.out}.tsv", "duplicates")
    if a.sam_out:
        sam.sam_lines(marked, by_place=True).write.mode("overwrite").text(f"{a.out}.sam-parts")
        fastx.concatenate(spark, f"{a.out}.sam-parts", a.sam_out)


@command(bam=str, out=str, nbuckets=256, filter_secondary=False, filter_supplementary=False, filter_unmapped=True, filter_duplicates=True, min_mapq=0)
def split_bam(spark, a):
    rows = read_alignments(spark, a.bam)
    kept = alignments.split_by_cell(rows, a.nbuckets, a.filter_secondary, a.filter_supplementary, a.filter_unmapped, a.filter_duplicates, a.min_mapq)
    alignments.write_cells(kept, a.out)


@command(bam=str, gtf=str, out=str, overlapping=True, stranded=False, matrix="")
def featurecounts(spark, a):
    """Reads of each gene and cell by overlap of their blocks with exons; matrix: a row a gene, a column a cell, as a file."""
    exons = tables.gtf_exons(spark, a.gtf).select("rname", "start", "end", "gene_id", "strand")
    blocks = qc.blocks_of(read_alignments(spark, a.bam), alignments.UNMAPPED)
    _save(alignments.gene_counts(blocks, exons, overlapping=a.overlapping, stranded=a.stranded), a.out)
    if a.matrix:
        counts = spark.read.parquet(a.out)
        cells = sorted((r.cell_id for r in counts.select("cell_id").distinct().collect()), key=alignments.natural_key)
        tables.write_report(alignments.wide_matrix(counts.withColumnRenamed("gene_id", "Geneid"), cells, "Geneid"), a.matrix)


@command(config=str, model=str, out=str, num_reads=50000, mismatch_rate=0.05, insertion_rate=0.05, deletion_rate=0.06, polyt_error_rate=0.02, max_insertions=1, min_cdna=100, max_cdna=500, rc=True, max_trunc_5p=0, max_trunc_3p=0, min_spacer=0, max_spacer=50, transcriptome="", seed=0, kind="training")
def simulate_data(spark, a):
    plans = config.structures(config.load(a.config), a.model, a.kind)
    transcripts = fastx.read_sequences(spark, a.transcriptome).select("ReadName", "read") if a.transcriptome else []
    noise = simulate.Noise(a.mismatch_rate, a.insertion_rate, a.deletion_rate, a.polyt_error_rate, a.max_insertions)
    shape = simulate.Shape((a.min_cdna, a.max_cdna), (a.min_spacer, a.max_spacer), a.max_trunc_5p, a.max_trunc_3p)
    _save(simulate.simulate(spark, plans, a.num_reads, noise, shape, transcripts, a.rc, a.seed), a.out)


@command(config=str, params=str, model=str, data=str, out=str, trainer="")
def train_model(spark, a):
    """Encoded batches by length bin, classes in order, and the parameter grid, for a trainer.

    trainer: module:function that gets the table's path, the classes and one entry of the grid at a time, and gives a row of its history.
    """
    data = spark.read.parquet(a.data)
    classes = sorted(r.x for r in data.select(F.explode("labels").alias("x")).distinct().collect())
    rows = data.withColumn("ids", F.transform("labels", lambda x: F.array_position(F.array(*map(F.lit, classes)), x).cast("int") - 1))
    _save(binning.with_bin(rows.withColumn("read_length", F.length("read"))), a.out)
    grid = config.grid(config.parameters(config.load(a.params), a.model))
    plan = {"classes": classes, "grid": grid, "bytes_a_token": batching.bytes_a_token(labels=len(classes))}
    if a.trainer:
        plan["history"] = [_loaded(a.trainer)(a.out, classes, entry) for entry in grid]
    with open(f"{a.out}.json", "w", encoding="utf-8") as f:
        json.dump(plan, f)


@command(config=str, model=str, out=str, truth="", annotations="", network="", classes="", num_reads=10000, concat_fraction=-1.0, max_read_length=0, seed=0, mismatch_rate=0.05, insertion_rate=0.05, deletion_rate=0.06)
def assess_model(spark, a):
    """Structure accuracy, edit distances and label scores of annotations of simulated reads.

    Without truth, reads are simulated by the model's assessment structures; without annotations, they are binned and annotated by the
    network, or by their true labels. Stages that are there already are not done again. Edit distances are those of reads of one fragment.
    """
    lib, _ = _load(a)
    done = lambda path: tables.exists(spark, f"{path}/_SUCCESS")
    sim, binned = a.truth or f"{a.out}/simulated", f"{a.out}/binned"
    if not done(sim):
        plans = config.structures(config.load(a.config), a.model, "assessment")
        if a.concat_fraction >= 0:
            plans = simulate.rescale(plans, a.concat_fraction)
        shape = simulate.Shape()
        if a.max_read_length:
            most = max(shape.insert[0] + 1, min(shape.insert[1], simulate.longest_insert(plans, a.max_read_length)))
            shape = simulate.Shape((shape.insert[0], most))
        noise = simulate.Noise(a.mismatch_rate, a.insertion_rate, a.deletion_rate)
        _save(simulate.simulate(spark, plans, a.num_reads, noise, shape, seed=a.seed, prefix="assess_"), sim)
    if not a.annotations and not done(binned):
        reads = spark.read.parquet(sim).select("ReadName", "read", F.length("read").cast("long").alias("read_length"))
        binning.with_bin(reads, "read_length").drop("bin_start", "bin_end").write.mode("overwrite").partitionBy("length_bin").parquet(binned)
    if not a.annotations and not done(f"{a.out}/annotations"):
        own = ["--reads", binned, "--config", a.config, "--model", a.model, "--out", a.out, "--split-concatenated"]
        own += ["--network", a.network, "--classes", a.classes] if a.network else ["--labels", sim]
        main(["annotate-reads", *own], spark)
    truth, found = spark.read.parquet(sim), tables.read_annotations(spark, a.annotations or f"{a.out}/annotations")
    names = [n for n in lib.names if f"{n}_Starts" in found.columns]
    whole = found.where(~F.col("ReadName").rlike("__(frag[0-9]+|remainder)$"))
    pred = assess.labels_of(whole, [n for n in names if n != "cDNA"])
    pairs = truth.select("ReadName", F.col("labels").alias("truth")).join(pred.withColumnRenamed("labels", "pred"), "ReadName")
    edits = assess.segment_edits(assess.true_occurrences(truth.where("expected_fragments = 1"), [n for n in names if n not in assess.FREE]), assess.occurrences(whole, names))
    tables.write_report(assess.structure_accuracy(truth, structure.valid_reads(found)), f"{a.out}/structure_accuracy.tsv")
    tables.write_report(assess.label_scores(pairs), f"{a.out}/label_scores.tsv")
    _save(edits, f"{a.out}/edit_distances")
    for value in ("distance", "normalised"):
        tables.write_report(assess.distance_summary(edits, value), f"{a.out}/edit_{value}.tsv")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="readloom")
    subs = top.add_subparsers(dest="command", required=True)
    for name, (f, options) in COMMANDS.items():
        p = subs.add_parser(name, help=f.__doc__)
        for o, default in options.items():
            flag = "--" + o.replace("_", "-")
            if isinstance(default, bool):
                p.add_argument(flag, action=argparse.BooleanOptionalAction, default=default)
            elif isinstance(default, type):
                p.add_argument(flag, type=default, required=True)
            else:
                p.add_argument(flag, type=type(default), default=default)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("readloom").config("spark.sql.adaptive.enabled", "true").getOrCreate()
    COMMANDS[a.command][0](spark, a)


if __name__ == "__main__":
    main()
