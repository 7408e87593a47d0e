"""SAM text and BAM files as tables of alignments: qname, flag, rname, start, end, mapq, cigar, seq, cb, ub, dt, ord."""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "qname string, flag int, rname string, start long, end long, mapq int, cigar string, seq string, cb string, ub string, dt string, ord long"
#: Fixed values of the BAM format: operations of a CIGAR, bases in four bits, sizes of tag values.
_OPS, _BASES = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"
_SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}


def reference_length(cigar: Column) -> Column:
    """Bases of the reference that a CIGAR covers."""
    moves = F.regexp_extract_all(cigar, F.lit("([0-9]+)[MDN=X]"), F.lit(1))
    return F.aggregate(moves, F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM text; tags CB, UB (or UR), DT. ord keeps the order of a file's lines as far as its parts are read in order."""
    rows = spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != "")).withColumn("ord", F.monotonically_increasing_id())
    f = F.split("value", "\t")
    at = lambda k: F.get(f, F.lit(k))
    tag = lambda name: F.nullif(F.regexp_extract("value", rf"\t{name}:[A-Za-z]:([^\t]*)", 1), F.lit(""))
    start = at(3).cast("long") - 1
    return rows.select(at(0).alias("qname"), at(1).cast("int").alias("flag"), at(2).alias("rname"), start.alias("start"), (start + reference_length(at(5))).alias("end"), at(4).cast("int").alias("mapq"), at(5).alias("cigar"), at(9).alias("seq"), tag("CB").alias("cb"), F.coalesce(tag("UB"), tag("UR")).alias("ub"), tag("DT").alias("dt"), "ord")


def _tags(raw: bytes) -> dict[str, str | int | float]:
    out, at = {}, 0
    while at + 3 <= len(raw):
        name, kind = raw[at : at + 2].decode(), chr(raw[at + 2])
        at += 3
        if kind in "ZH":
            end = raw.index(b"\0", at)
            out[name], at = raw[at:end].decode(), end + 1
        elif kind == "B":
            n = struct.unpack_from("<i", raw, at + 1)[0]
            at += 5 + n * _SIZES[chr(raw[at])]
        else:
            size = _SIZES[kind]
            value = raw[at : at + size]
            out[name] = value.decode() if kind == "A" else struct.unpack("<" + {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}[kind], value)[0]
            at += size
    return out


def header_end(data: bytes) -> tuple[int, list[str]] | None:
    """Where the records of a BAM file start in its inflated bytes, and the names of its contigs; None if there are too few bytes."""
    if len(data) >= 4 and data[:4] != b"BAM\1":
        raise ValueError("not a BAM file")
    number = lambda at: struct.unpack_from("<i", data, at)[0] if at + 4 <= len(data) else None
    if (text := number(4)) is None or (n := number(8 + text)) is None:
        return None
    at, names = 12 + text, []
    for _ in range(n):
        if (size := number(at)) is None or at + 8 + size > len(data):
            return None
        names.append(data[at + 4 : at + 3 + size].decode())
        at += 8 + size
    return at, names


def parse_record(data: bytes, at: int, size: int) -> tuple:
    """qname, flag, number of the contig (-1: none), start, end, mapq, cigar, seq, cb, ub, dt of the record whose size stands at `at`."""
    ref, pos, l_name, mapq, _, n_cigar, flag, l_seq = struct.unpack_from("<iiBBHHHi", data, at + 4)
    p = at + 36
    qname = data[p : p + l_name - 1].decode()
    p += l_name
    cigar = struct.unpack_from(f"<{n_cigar}I", data, p)
    p += 4 * n_cigar
    packed = data[p : p + (l_seq + 1) // 2]
    seq = "".join(_BASES[b >> 4] + _BASES[b & 15] for b in packed)[:l_seq]
    tags = _tags(data[p + (l_seq + 1) // 2 + l_seq : at + 4 + size])
    end = pos + sum(c >> 4 for c in cigar if _OPS[c & 15] in "MDN=X")
    text = "".join(f"{c >> 4}{_OPS[c & 15]}" for c in cigar) or "*"
    return qname, flag, ref, pos, end, mapq, text, seq or "*", tags.get("CB"), tags.get("UB", tags.get("UR")), tags.get("DT")


def _size_at(data: bytes, at: int) -> int | None:
    """Size of the record that starts here; None if none can, by what its fields must be; -1 if too few bytes tell."""
    if at + 36 > len(data):
        return -1
    size, ref, pos, l_name, _, _, n_cigar, _, l_seq, mate, mate_pos = struct.unpack_from("<iiiBBHHHiii", data, at)
    fixed = 32 + l_name + 4 * n_cigar + (l_seq + 1) // 2 + l_seq
    if not (l_name >= 1 and l_seq >= 0 and min(ref, mate, pos, mate_pos) >= -1 and fixed <= size < 1 << 28):
        return None
    name = data[at + 36 : at + 36 + l_name]
    if len(name) < l_name:
        return -1
    return size if name[-1] == 0 and all(33 <= c <= 126 for c in name[:-1]) else None


def first_record(data: bytes, chain: int = 4) -> int | None:
    """Where a record starts in bytes from the middle of a file: the first place from which `chain` records follow each other, or fewer up to the end of the bytes."""
    for start in range(len(data)):
        at, found = start, 0
        while found < chain and (size := _size_at(data, at)) is not None:
            if size < 0 or at + 4 + size > len(data):
                break
            at, found = at + 4 + size, found + 1
        if found == chain or found and size is not None:
            return start
    return None


#: Fixed value of the format: how every block of a compressed file begins, up to its size.
BLOCK_MARK = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0"
_PARSED = "file string, part long, place long, kind int, qname string, flag int, ref int, start long, end long, mapq int, cigar string, seq string, cb string, ub string, dt string, bytes binary"
#: Kinds of rows: a record; the end of one that began before the part; a part within one record; the beginning of one.
_RECORD, _HEAD, _MIDDLE, _TAIL = range(4)
#: Inflated bytes in which the first record of a part is sought at first, and records of a batch.
SEEK, ROWS = 1 << 20, 20_000
#: No byte of a compressed file holds as many records as this.
PLACES = 32


def _table(rows: list[tuple]):
    import pandas as pd

    whole = {"flag": "Int32", "ref": "Int32", "start": "Int64", "end": "Int64", "mapq": "Int32"}
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _PARSED.split(", ")]).astype(whole)


def _records(data: bytes, at: int) -> tuple[list[tuple], int]:
    """The whole records from here on, and where the bytes after them start."""
    out = []
    while at + 4 <= len(data) and at + 4 + (size := struct.unpack_from("<i", data, at)[0]) <= len(data):
        out.append(parse_record(data, at, size))
        at += 4 + size
    return out, at


def _parts(batches) -> Iterator[tuple[str, int, Iterator[bytes]]]:
    """(file, where the part starts, its inflated blocks in order) of each part of a file among the rows of a task."""
    rows = ((f, p, bytes(v)) for b in batches for f, p, v in zip(b["file"], b["part"], b["value"], strict=True))
    for (file, part), own in itertools.groupby(rows, key=lambda r: (r[0], r[1])):
        yield file, int(part), (zlib.decompress(v[2:-8], -15) for _, _, v in own if len(v) > 10)


def _parse(batches):
    """Records of each part, and the bytes of records that begin or end in another one. A part's bytes are held a block at a time."""
    for file, part, blocks in _parts(batches):
        fragment = lambda kind, data: (file, part, 0, kind, *[None] * 11, data)  # noqa: B023, E731
        data, at, place, seek, rows = b"", None, 0, SEEK, []
        for block in itertools.chain(blocks, [None]):
            data += block or b""
            if at is None and part == 0:
                at = (header_end(data) or [None])[0]
            elif at is None and (block is None or len(data) >= seek):
                at, seek = first_record(data), 2 * seek
                if at is not None:
                    rows.append(fragment(_HEAD, data[:at]))
            if at is not None:
                new, end = _records(data, at)
                rows += [(file, part, place + k, _RECORD, *r, None) for k, r in enumerate(new)]
                data, at, place = data[end:], 0, place + len(new)
            if len(rows) >= ROWS:
                yield _table(rows)
                rows = []
        if data:
            rows.append(fragment(_MIDDLE if at is None and part else _TAIL, data))
        if rows:
            yield _table(rows)


def _joined(pieces):
    """The records of one file that lie over two parts or more."""
    rows, held = [], b""
    for part, kind, data in sorted(zip(pieces["part"], pieces["kind"], map(bytes, pieces["bytes"]), strict=True)):
        held = data if kind == _TAIL else held + data
        if kind == _HEAD:
            new, _ = _records(held, (header_end(held) or [0])[0] if held[:4] == b"BAM\1" else 0)
            rows += [(pieces["file"].iloc[0], int(part), k - len(new), _RECORD, *r, None) for k, r in enumerate(new)]
    return _table(rows)


def _contigs(batches):
    import pandas as pd

    for file, part, blocks in _parts(batches):
        data = b""
        for block in blocks if part == 0 else ():
            data += block
            if found := header_end(data):
                yield pd.DataFrame({"file": file, "ref": range(len(found[1])), "rname": found[1]})
                break


def read_bam(spark: SparkSession, path: str, region: tuple[str, int, int] | None = None) -> DataFrame:
    """Alignments of BAM files, or those of them that overlap a region (contig, start, end).

    Spark's text reader cuts files at the marks of their blocks, so a file of any size is many tasks. A task finds the
    first record of its part by what records must look like; bytes that belong to a record over two parts are put together after.
    The header of a file lies in its first part. ord keeps the order of a file's records. File sizes are listed when this is called.
    """
    files = lambda r: r.option("pathGlobFilter", "*.bam")
    name = F.col("_metadata.file_path").alias("file")
    sizes, base = [], 0
    for r in files(spark.read.format("binaryFile")).load(path).select(name, "length").orderBy("file").collect():
        sizes.append((r.file, base))
        base += PLACES * (r.length + 1)
    blocks = files(spark.read.option("lineSep", BLOCK_MARK.decode("latin-1")).option("encoding", "ISO-8859-1")).text(path)
    blocks = blocks.select(name, F.col("_metadata.file_block_start").alias("part"), F.col("value").cast("binary").alias("value"))
    parsed = blocks.mapInPandas(_parse, _PARSED)
    pieces = parsed.where(F.col("kind") != _RECORD).select("file", "part", "kind", "bytes")
    rows = parsed.where(F.col("kind") == _RECORD).unionByName(pieces.groupBy("file").applyInPandas(_joined, _PARSED))
    contigs = blocks.where("part = 0").mapInPandas(_contigs, "file string, ref int, rname string")
    rows = rows.join(spark.createDataFrame(sizes, "file string, base long"), "file").join(contigs, ["file", "ref"], "left")
    ord_ = F.col("base") + PLACES * F.col("part") + F.col("place")
    out = rows.select("qname", "flag", F.coalesce("rname", F.lit("*")).alias("rname"), "start", "end", "mapq", "cigar", "seq", "cb", "ub", "dt", ord_.alias("ord"))
    if region:
        contig, start, end = region
        out = out.where((F.col("rname") == contig) & (F.col("start") < end) & (F.col("end") > start))
    return out


def by_region(alignments: DataFrame, parts: int | None = None) -> DataFrame:
    """Alignments in parts of like size, each a stretch of the contigs."""
    order = ["rname", "start"]
    return alignments.repartitionByRange(parts, *order) if parts else alignments.repartitionByRange(*order)


def sam_lines(alignments: DataFrame, by_place: bool = False) -> DataFrame:
    """value: SAM lines (qualities unknown) with the tags that are there, in file order, or by contig and place with unmapped ones last."""
    star = lambda c: F.coalesce(F.col(c), F.lit("*"))
    tags = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c.upper()}:Z:"), F.col(c))) for c in ("cb", "ub", "dt")]
    line = F.concat_ws("\t", "qname", F.col("flag").cast("string"), star("rname"), (F.col("start") + 1).cast("string"), F.col("mapq").cast("string"), star("cigar"), F.lit("*"), F.lit("0"), F.lit("0"), star("seq"), F.lit("*"), *tags)
    order = [F.col("rname") == "*", "rname", "start", "ord"] if by_place else ["ord"]
    return alignments.orderBy(*order).select(line.alias("value"))
