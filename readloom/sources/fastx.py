"""FASTA and FASTQ, plain or gzip, read by Spark's text reader, and records written as text.

The reader cuts files at record marks, so plain files of any size are many tasks and gzip is inflated as a stream; nothing is
held but single records, and no record passes through Python.
"""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Extensions of sequence files, without and with qualities.
FASTA, FASTQ = (".fa", ".fasta"), (".fq", ".fastq")


def format_of(path: str) -> str | None:
    """fasta or fastq by extension, with or without .gz."""
    name = PurePosixPath(path).name.lower().removesuffix(".gz")
    return "fasta" if name.endswith(FASTA) else "fastq" if name.endswith(FASTQ) else None


def _pieces(spark: SparkSession, folder: str, extensions: tuple[str, ...], mark: str) -> DataFrame:
    """value: the text between two line starts with `mark`, without carriage returns; its file, where its part of the file starts, and its place in order."""
    pattern = "*.{" + ",".join(x[1:] + z for x in extensions for z in ("", ".gz")) + "}"
    rows = spark.read.option("lineSep", "\n" + mark).option("pathGlobFilter", pattern).option("recursiveFileLookup", "false").text(folder)
    return rows.select(F.translate("value", "\r", "").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))


def _name(head: Column, mark: str) -> Column:
    """The first word of a header; that of the first record of a file still has its mark."""
    return F.regexp_extract(head, rf"^{mark}?\s*(\S*)", 1)


def read_fasta(spark: SparkSession, folder: str) -> DataFrame:
    """ReadName, read, base_qualities (null) of FASTA files; sequences may span lines. Files begin with a header or blank lines."""
    rows = _pieces(spark, folder, FASTA, ">").where(F.trim("value") != "").withColumn("line", F.split("value", "\n"))
    seq = F.array_join(F.transform(F.slice("line", F.lit(2), F.size("line")), F.trim), "")
    return rows.select(_name(F.get("line", F.lit(0)), ">").alias("ReadName"), seq.alias("read"), F.lit(None).cast("string").alias("base_qualities"))


def read_fastq(spark: SparkSession, folder: str) -> DataFrame:
    """ReadName, read, base_qualities of FASTQ files of four lines a record.

    A quality line may begin like a header. Then it was cut off its record and is the next piece; such pieces, a few in a
    hundred, are put together in order of their places in the file. A last record without its quality line has an empty one.
    """
    rows = _pieces(spark, folder, FASTQ, "@").withColumn("line", F.split("value", "\n")).withColumn("breaks", F.size("line") - 1)
    at = lambda k: F.coalesce(F.get("line", F.lit(k)), F.lit(""))
    head = F.when(F.col("block") == 0, _name(at(0), "@")).otherwise(_name(at(0), ""))
    whole = rows.where((F.col("breaks") >= 3) & (F.trim("value") != "")).select(head.alias("ReadName"), at(1).alias("read"), at(3).alias("base_qualities"))
    order = Window.partitionBy("file").orderBy("block", "at")
    odd = rows.where("breaks < 3").withColumn("before", F.lag("breaks").over(order)).withColumn("after", F.lead("breaks").over(order)).withColumn("next", F.lead(F.rtrim(F.translate("value", "\n", ""))).over(order))
    cut_off = F.coalesce((F.col("breaks") <= 1) & (F.col("before") == 2), F.lit(False))
    quality = F.when((F.col("breaks") == 2) & (F.col("after") <= 1), F.concat(F.lit("@"), "next")).otherwise("")
    split = odd.where(~cut_off & (F.trim("value") != "")).select(head.alias("ReadName"), at(1).alias("read"), quality.alias("base_qualities"))
    return whole.unionByName(split)


def read_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """Reads of all sequence files of a folder (not of folders in it), with read_length."""
    return read_fasta(spark, folder).unionByName(read_fastq(spark, folder)).withColumn("read_length", F.length("read").cast("long"))


def write_records(records: DataFrame, path: str, bucket: str | None = "demux_bucket", text: str = "record") -> None:
    """Records as gzip text: a folder for demultiplexed and one for ambiguous reads (all in one without `bucket`)."""
    if bucket:
        kind = F.when(F.col(bucket) == "ambiguous", "ambiguous").otherwise("demuxed")
        records.where(F.col(text).isNotNull()).select(kind.alias("kind"), F.col(text).alias("value")).write.partitionBy("kind").option("compression", "gzip").mode("overwrite").text(path)
    else:
        records.where(F.col(text).isNotNull()).select(F.col(text).alias("value")).write.option("compression", "gzip").mode("overwrite").text(path)


def demux_text(rows: DataFrame, fmt: str = "fasta") -> DataFrame:
    """rows with `record`, the lines of a demultiplexed read."""
    lines = ["demux_header", "demux_sequence", F.lit("+"), "demux_quality"] if fmt == "fastq" else ["demux_header", "demux_sequence"]
    return rows.withColumn("record", F.when(F.col("demux_header").isNotNull(), F.concat_ws("\n", *lines)))


def concatenate(spark: SparkSession, folder: str, path: str) -> int:
    """The part files of a folder one after another in one file, by the driver; gzip members may follow one another. Gives their number."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    source, target = hadoop.fs.Path(folder), hadoop.fs.Path(path)
    files = source.getFileSystem(conf)
    parts = sorted((x.getPath() for x in files.listStatus(source) if x.getPath().getName().startswith("part-")), key=lambda x: x.getName())
    out = target.getFileSystem(conf).create(target, True)
    try:
        for part in parts:
            reader = files.open(part)
            try:
                hadoop.io.IOUtils.copyBytes(reader, out, conf, False)
            finally:
                reader.close()
    finally:
        out.close()
    return len(parts)
