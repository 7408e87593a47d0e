"""Registered queries of the engine's own operators, each with the SQL that gives the same rows.

The tables hold no reads, so reads are derived from `events` by SQL that runs on both engines: DNA is hexadecimal md5 with its
digits renamed to bases. One read in ten has an exact, reversed, substituted, shortened or unknown barcode by event_id % 10, and
event_id % 7 says how its labels are laid out (plain, reversed, flanked, concatenated, broken).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import sequences as sq
from .operators import alignments as al
from .operators import assess, barcodes, binning, discovery, qc, simulate, structure
from .plans.lineage import cut

SEGMENTS = structure.Segments(
    codes=(("5p", "5"), ("CBC", "C"), ("UMI", "U"), ("polyT", "T"), ("cDNA", "D"), ("3p", "3"), ("polyA", "A")),
    valid=(("5p", "CBC", "UMI", "polyT", "cDNA", "3p"), ("5p", "CBC", "UMI", "cDNA", "3p")),
    barcodes=("CBC",),
    patterns=(("5p", "CTACACGACGCTCTTCCGATCT"), ("3p", "CCCATGTACTCTGCGTTGATACCACTGCTT")),
)

READS = """
with b as (
  select event_id, user_id, event_type,
    translate(md5(cast(user_id + 1000 as varchar(20))), '0123456789abcdef', 'ACGTACGTACGTACGT') as cell_dna,
    translate(md5(concat('u', cast(event_id % 997 as varchar(20)))), '0123456789abcdef', 'ACGTACGTACGTACGT') as umi_dna,
    translate(md5(concat('x', cast(event_id as varchar(20)))), '0123456789abcdef', 'ACGTACGTACGTACGT') as rnd
  from {events}
), c as (
  select event_id, user_id, event_type, rnd, substring(cell_dna, 1, 16) as cbc0, substring(umi_dna, 1, 12) as umi, cast(event_id % 10 as int) as m, cast(event_id % 16 as int) as p,
    repeat('T', cast(event_id % 30 as int)) as tail, substring(repeat(rnd, 40), 1, cast(50 + (event_id * 37) % 1200 as int)) as cdna
  from b
), d as (
  select *, case when m < 6 then cbc0
    when m = 6 then reverse(translate(cbc0, 'ACGT', 'TGCA'))
    when m = 7 then concat(substring(cbc0, 1, p), translate(substring(cbc0, p + 1, 1), 'ACGT', 'CGTA'), substring(cbc0, p + 2, 16))
    when m = 8 then concat(substring(cbc0, 1, p), substring(cbc0, p + 2, 16))
    else substring(rnd, 1, 16) end as cbc
  from c
), e as (
  select *, concat('CTACACGACGCTCTTCCGATCT', cbc, umi, tail, cdna, 'CCCATGTACTCTGCGTTGATACCACTGCTT') as one,
    concat(repeat('5', 22), repeat('C', cast(length(cbc) as int)), repeat('U', 12), repeat('T', cast(length(tail) as int)), repeat('D', cast(length(cdna) as int)), repeat('3', 30)) as lab,
    concat('5CU', case when length(tail) > 0 then 'T' else '' end, 'D3') as ord, cast(event_id % 7 as int) as kind
  from d
)
select event_id, concat('r', cast(event_id as varchar(20))) as ReadName, user_id, event_type, cbc0, cbc, umi, tail, cdna, m, kind,
  case when kind = 3 then reverse(translate(one, 'ACGT', 'TGCA')) when kind = 4 then concat('ACGTACGTAC', one) when kind = 5 then concat(one, one) when kind = 6 then concat('CTACACGACGCTCTTCCGATCT', cdna) else one end as read,
  case when kind = 3 then reverse(lab) when kind = 4 then concat('DDDDDDDDDD', lab) when kind = 5 then concat(lab, lab) when kind = 6 then concat(repeat('5', 22), repeat('D', cast(length(cdna) as int))) else lab end as labels,
  case when kind = 3 then reverse(ord) when kind = 4 then concat('D', ord) when kind = 5 then concat(ord, ord) when kind = 6 then '5D' else ord end as order_built
from e
"""
ORACLE_READS = READS.format(events="events")
#: A whitelist: the true cell barcodes in order.
ORACLE_WHITE = f"select cbc0 as barcode, row_number() over (order by cbc0) as place from (select distinct cbc0 from ({ORACLE_READS}))"
RC = "reverse(translate({0}, 'ACGT', 'TGCA'))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(READS, events=table(spark, sf_dir, "events"))


def whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell_id in order of barcodes, CBC."""
    known = reads(spark, sf_dir).select(F.col("cbc0").alias("CBC"), F.lit(1).alias("read_count")).distinct()
    return cut(discovery.ranked(known).select(F.col("rank").cast("long").alias("cell_id"), "CBC"), "whitelist")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


# ---- preprocessing

_BIN = "case when n < 10000 then 500 when n < 50000 then 5000 when n < 100000 then 10000 else 25000 end"


@query(f"""
with b as (select n_chars as n, {_BIN} as w from documents), s as (select n - n % w as s, w from b)
select concat(cast(s as varchar), '_', cast(s + w - 1 as varchar), 'bp') as length_bin, cast(s as bigint) as bin_start, cast(s + w - 1 as bigint) as bin_end, count(*) as n from s group by all""")
def length_bins(spark, sf_dir):
    return binning.with_bin(table(spark, sf_dir, "documents"), "n_chars").groupBy("length_bin", "bin_start", "bin_end").agg(F.count("*").alias("n"))


@query()
def sparse_bin_merge(spark, sf_dir):
    binned = binning.with_bin(table(spark, sf_dir, "documents").select("n_chars"), "n_chars")
    return binning.merge_sparse_bins(binned, 50).groupBy("length_bin").agg(F.count("*").alias("n"))


@query(f"""
with x as (select cast(length(read) as double) as x from ({ORACLE_READS}) where length(read) > 0 and length(read) < 6000),
s as (select min(x) as lo, max(x) as hi from x)
select cast(least(floor((x - lo) / ((hi - lo) / 100)), 99) as bigint) as bin, count(*) as count from x, s group by 1""")
def read_length_histogram(spark, sf_dir):
    return binning.length_histogram(reads(spark, sf_dir).select(F.length("read").alias("read_length"))).select("bin", "count")


@query("select concat('r', cast(event_id as varchar)) as \"ReadName\", case when event_type = 'click' then 'a' else 'b' end as length_bin from events")
def read_index(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("ReadName"), F.when(F.col("event_type") == "click", "a").otherwise("b").alias("length_bin"))
    return binning.read_index(rows.unionByName(rows.withColumn("length_bin", F.lit(""))))


@query()
def sample_of_reads(spark, sf_dir):
    return binning.sample_reads(reads(spark, sf_dir).select("ReadName", "read"), 100, seed=3)


# ---- structure


@query(f"""select "ReadName", order_built as "order", cast(length(order_built) as int) as n_runs, cast(length(read) as int) as last_end from ({ORACLE_READS})""")
def label_runs(spark, sf_dir):
    runs = structure.with_runs(reads(spark, sf_dir), "labels", SEGMENTS)
    return runs.select("ReadName", "order", F.size("run_starts").alias("n_runs"), F.element_at("run_ends", -1).alias("last_end"))


_REASON = "case kind when 5 then 'concatenated reads x2 (+:2)' when 6 then 'Unexpected pattern: [5p_cDNA]' else 'valid' end"


@query(f"""select "ReadName", kind < 5 as valid, case kind when 3 then '-' when 6 then '' else '+' end as orientation, {_REASON} as reason from ({ORACLE_READS})""")
def structure_match(spark, sf_dir):
    found = structure.with_structure(structure.with_runs(reads(spark, sf_dir), "labels", SEGMENTS), SEGMENTS)
    return found.select("ReadName", "structure.valid", "structure.orientation", "structure.reason")


def annotated(spark, sf_dir, split=False) -> DataFrame:
    return structure.annotate(reads(spark, sf_dir).select("ReadName", "read", "labels", "kind"), SEGMENTS, split=split)


@query(f"""
select "ReadName", case when kind < 5 then 'valid' else 'invalid' end as architecture, case when kind < 5 then case when kind = 3 then {RC.format("cbc")} else cbc end end as barcode,
  case when kind < 5 then cast(length(cdna) as int) end as cdna_length, case when kind = 4 then 10 else 0 end as flank, case when kind = 5 then '0, 0' else '0' end as dist_5p
from ({ORACLE_READS})""")
def annotations(spark, sf_dir):
    a = annotated(spark, sf_dir)
    flank = F.coalesce(F.get("random_s_Ends", F.lit(0)) - F.get("random_s_Starts", F.lit(0)), F.lit(0))
    return a.select("ReadName", "architecture", F.col("CBC_Sequences").alias("barcode"), F.col("cDNA_length").alias("cdna_length"), flank.alias("flank"), sq.joined("5p_edit_dist").alias("dist_5p"))


@query(f"""
with r as ({ORACLE_READS}), k as (select unnest([1, 2]) as k)
select concat("ReadName", '__frag', cast(k as varchar)) as "ReadName", 'valid' as architecture, concat('split from concatenated (frag ', cast(k as varchar), '/2) — parent read in invalid annotations') as reason, cbc as barcode from r, k where kind = 5
union all select concat("ReadName", '__remainder'), 'invalid', 'concatenated reads x2 (+:2) — 2 fragment(s) extracted to valid annotations', null from r where kind = 5""")
def split_concatenated(spark, sf_dir):
    a = annotated(spark, sf_dir, split=True)
    return a.where(sq.fragment("ReadName") | sq.remainder("ReadName")).select("ReadName", "architecture", "reason", F.col("CBC_Sequences").alias("barcode"))


_LEAD_BASE = "translate(substring(read, p + 1, 1), 'ACGT', 'GTAC')"
_NOISY = f"""
select "ReadName", kind, case when kind = 3 then read else concat(substring(read, 1, p), case event_id % 3 when 0 then {_LEAD_BASE} when 1 then '' else concat({_LEAD_BASE}, substring(read, p + 1, 1)) end, substring(read, p + 2, 5000)) end as read,
  case when event_id % 2 = 0 then translate(lab, 'T', 'A') else lab end as labels, case when kind = 3 then 22 when event_id % 3 = 1 then 21 when event_id % 3 = 2 then 23 else 22 end as lead
from (select *, cast(event_id % 22 as int) as p, case when kind = 3 or event_id % 3 = 0 then labels when event_id % 3 = 1 then substring(labels, 2, 5000) else concat('5', labels) end as lab from ({{reads}}) where kind < 4)"""
_FIRST_PIECE = "case when kind = 3 then substring(read, cast(length(read) - 21 as int), 22) else substring(read, 1, lead) end"


@query(f"""
with r as ({_NOISY.format(reads=ORACLE_READS)}), s as (select *, {_FIRST_PIECE} as piece, 'CTACACGACGCTCTTCCGATCT' as adapter, cast(position('A' in labels) as int) as a, cast(position('T' in labels) as int) as t from r)
select "ReadName", 'valid' as architecture, case when kind = 3 then '-' else '+' end as orientation, cast(least(levenshtein(piece, adapter), levenshtein(piece, {RC.format("adapter")})) as int) as distance, case when a + t > 0 then greatest(a, t) - 1 end as tail_start from s""")
def noisy_annotations(spark, sf_dir):
    """First adapters with a base changed, lost or added, and tails labelled as either kind."""
    rows = spark.sql(_NOISY.replace('"ReadName"', "ReadName").replace("{reads}", "{r}"), r=reads(spark, sf_dir)).select("ReadName", "read", "labels")
    a = structure.annotate(rows, SEGMENTS)
    return a.select("ReadName", "architecture", "orientation", F.get("5p_edit_dist", F.lit(0)).alias("distance"), F.get("polyT_Starts", F.lit(0)).alias("tail_start"))


@query("""select event_id, cast(event_id % 50 as int) as first, [cast(event_id % 50 as int), cast(user_id as int)] as every from events where event_id % 4 > 0
union all select event_id, null, [cast(user_id as int)] from events where event_id % 4 = 0""")
def coordinate_text(spark, sf_dir):
    """Coordinates as files have them: numbers with a fraction, spaces, and tokens that are none."""
    text = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("x, "), F.col("user_id").cast("string"))).otherwise(F.concat((F.col("event_id") % 50).cast("string"), F.lit(".0, "), F.col("user_id").cast("string")))
    return table(spark, sf_dir, "events").select("event_id", sq.first_int(text).alias("first"), sq.coordinates(text).alias("every"))


# ---- barcodes

_CORRECT = f"""
with o as (select distinct cbc as seq, {RC.format("cbc")} as rc from ({ORACLE_READS})), w as ({ORACLE_WHITE}),
x as (select o.*, a.barcode as own, b.barcode as turned from o left join w a on a.barcode = seq left join w b on b.barcode = rc),
n as (select seq, side, barcode, place, dist, row_number() over (partition by seq, side order by dist, place) as k from (
  select seq, 0 as side, barcode, place, levenshtein(seq, barcode) as dist from x, w where own is null and turned is null
  union all select seq, 1, barcode, place, levenshtein(rc, barcode) from x, w where own is null and turned is null) where dist <= 2),
t as (select * from n where k <= 5), g as (select seq, min(dist) as d from t group by seq),
f as (select t.seq, string_agg(barcode, ',' order by side, place) as corrected, d, count(*) as c from t join g on t.seq = g.seq and t.dist = g.d group by t.seq, d)
select x.seq, coalesce(own, turned, f.corrected, 'NMF') as corrected, cast(case when coalesce(own, turned) is not null then 0 else coalesce(d, 3) end as int) as min_dist,
  cast(case when coalesce(own, turned) is not null then 1 else coalesce(c, 0) end as int) as n_min
from x left join f on f.seq = x.seq"""


def corrections(spark, sf_dir) -> DataFrame:
    white = whitelist(spark, sf_dir)
    return barcodes.correct(reads(spark, sf_dir).select(F.col("cbc").alias("seq")), barcodes.whitelist_barcodes(white, "CBC"))


@query(_CORRECT)
def barcode_correction(spark, sf_dir):
    return corrections(spark, sf_dir).drop("candidates")


@query(f"""
with o as (select event_id, case event_id % 9 when 0 then null when 1 then 'nan' when 2 then '' when 3 then 'None' else cbc end as seq from ({ORACLE_READS})), c as ({_CORRECT}), d as (select seq, count(*) as n from o group by 1)
select d.seq, n, coalesce(corrected, 'NMF') as corrected, coalesce(min_dist, -1) as min_dist from d left join c on c.seq = d.seq""")
def missing_barcodes(spark, sf_dir):
    """Reads of which some have no barcode, in all the ways that files say so."""
    e = F.col("event_id") % 9
    seen = reads(spark, sf_dir).select(F.when(e == 0, F.lit(None)).when(e == 1, "nan").when(e == 2, "").when(e == 3, "None").otherwise(F.col("cbc")).alias("seq"))
    fixed = barcodes.correct(seen, barcodes.whitelist_barcodes(whitelist(spark, sf_dir), "CBC"))
    each = seen.groupBy("seq").agg(F.count("*").alias("n"))
    return each.join(fixed.withColumnRenamed("seq", "s"), F.col("seq").eqNullSafe(F.col("s"))).select("seq", "n", "corrected", "min_dist")


@query(f"""
with o as (select distinct cbc as seq, {RC.format("cbc")} as rc from ({ORACLE_READS})), w as ({ORACLE_WHITE}), x as (select o.* from o left join w a on a.barcode = seq left join w b on b.barcode = rc where a.barcode is null and b.barcode is null)
select seq, cast(min(least(levenshtein(seq, barcode), levenshtein(rc, barcode), 4)) as int) as min_dist from x, w group by 1""")
def distant_barcodes(spark, sf_dir):
    """Three edits: distances of the barcodes that are in no whitelist as they are."""
    white = barcodes.whitelist_barcodes(whitelist(spark, sf_dir), "CBC")
    fixed = barcodes.correct(reads(spark, sf_dir).select(F.col("cbc").alias("seq")), white, threshold=3)
    return fixed.where("min_dist > 0").select("seq", "min_dist")


_CELLS = f"""
with c as ({_CORRECT}), w as ({ORACLE_WHITE}), r as ({ORACLE_READS})
select "ReadName", c.corrected, coalesce(cast(place as varchar), 'ambiguous') as cell_id, case when place is null then 'Ambiguous' else 'Exact match' end as match_type, c.min_dist
from r join c on c.seq = r.cbc left join w on w.barcode = c.corrected"""


def assigned(spark, sf_dir) -> DataFrame:
    """All reads with a single plain layout's coordinates, corrected and assigned."""
    white = whitelist(spark, sf_dir)
    r = reads(spark, sf_dir).withColumn("CBC_Sequences", F.col("cbc"))
    return barcodes.cells(barcodes.with_corrections(r, white, ["CBC"]), white)


@query(_CELLS)
def cell_assignment(spark, sf_dir):
    return assigned(spark, sf_dir).select("ReadName", F.col("corrected_CBC").alias("corrected"), "cell_id", "match_type", F.col("corrected_CBC_min_dist").alias("min_dist"))


@query(f"""with c as ({_CELLS}) select cell_id, count(*) as read_count, cast(row_number() over (order by count(*) desc, cell_id) as int) as rank from c where cell_id <> 'ambiguous' group by cell_id""")
def reads_per_cell(spark, sf_dir):
    return qc.reads_per_cell(assigned(spark, sf_dir))


@query("""
with w as (select distinct s_suppkey % 40 as a, s_nationkey as b from supplier), n as (select cast(row_number() over (order by a, b) as bigint) as cell_id, cast(a as varchar) as a, cast(b as varchar) as b from w),
o as (select distinct cast(l_suppkey % 40 as varchar) as a1, cast((l_suppkey + 1) % 40 as varchar) as a2, cast(l_partkey % 25 as varchar) as b1, l_linenumber > 5 as two from lineitem),
x as (select o.*, n.cell_id, cast(n.a = a1 or (two and n.a = a2) as int) + cast(n.b = b1 as int) as k from o, n),
m as (select a1, b1, two, max(k) as k from x group by a1, b1, two), f as (select x.a1, x.b1, x.two, count(*) as c, min(cell_id) as cell_id from x join m on x.a1 = m.a1 and x.b1 = m.b1 and x.two = m.two and x.k = m.k where m.k > 0 group by x.a1, x.b1, x.two)
select case when o.two then concat(o.a1, ',', a2) else o.a1 end as corrected_a, o.b1 as corrected_b, coalesce(cast(case when c = 1 then f.cell_id end as varchar), 'ambiguous') as cell_id from o left join f on f.a1 = o.a1 and f.b1 = o.b1 and f.two = o.two""")
def multi_barcode_cells(spark, sf_dir):
    pairs = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 40).alias("a"), F.col("s_nationkey").alias("b")).distinct().withColumn("read_count", F.lit(1))
    white = discovery.ranked(pairs).select(F.col("rank").cast("long").alias("cell_id"), F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"))
    li = table(spark, sf_dir, "lineitem")
    one, two = (F.col("l_suppkey") % 40).cast("string"), ((F.col("l_suppkey") + 1) % 40).cast("string")
    rows = li.select(F.when(F.col("l_linenumber") > 5, F.concat(one, F.lit(","), two)).otherwise(one).alias("corrected_a"), (F.col("l_partkey") % 25).cast("string").alias("corrected_b")).distinct()
    return barcodes.cells_multi(rows, white, ["a", "b"]).select("corrected_a", "corrected_b", "cell_id")


_DEMUX = f"""
with r as ({ORACLE_READS} ), c as ({_CELLS})
select r."ReadName", concat('>', r."ReadName", '_', cell_id, '_', case when kind = 3 then {RC.format("umi")} else umi end, ' cell_id:', cell_id, '|Barcodes:CBC:', corrected, '|UMI:', case when kind = 3 then {RC.format("umi")} else umi end, '|orientation:', case when kind = 3 then '-' else '+' end) as demux_header,
  case when kind = 3 then {RC.format("cdna")} else cdna end as demux_sequence, cell_id as demux_bucket
from r join c on c."ReadName" = r."ReadName" where kind < 5"""


@query(_DEMUX.replace(RC.format("umi"), "umi").replace(RC.format("cdna"), "cdna"))
def demux_records(spark, sf_dir):
    """Strand "fwd": of reversed reads insert and UMI are turned back."""
    white = whitelist(spark, sf_dir)
    valid = structure.valid_reads(annotated(spark, sf_dir))
    done = barcodes.cells(barcodes.with_corrections(valid.join(reads(spark, sf_dir).select("ReadName", "cbc"), "ReadName").withColumn("CBC_Sequences", F.col("cbc")), white, ["CBC"]), white)
    return barcodes.demux_records(done, ["CBC"], "fwd").select("ReadName", "demux_header", "demux_sequence", "demux_bucket")


_QUAL = "translate(read, 'ACGT', '!5IF')"
#: Half-open places of the segments of valid reads; reversed reads have them mirrored.
_PLACES = f"""
select *, {_QUAL} as bq, length(read) as size, 22 + o as c0, 22 + o + length(cbc) as u0, 34 + o + length(cbc) as t0, 34 + o + length(cbc) + length(tail) as d0, 34 + o + length(cbc) + length(tail) + length(cdna) as d1 from (select *, case when kind = 4 then 10 else 0 end as o from ({ORACLE_READS}) where kind < 5)"""


def _slice(a: str, z: str, text: str) -> str:
    return f"case when kind = 3 then substring({text}, cast(size - {z} + 1 as int), cast({z} - {a} as int)) else substring({text}, cast({a} + 1 as int), cast({z} - {a} as int)) end"


def with_qualities(spark, sf_dir) -> DataFrame:
    """Valid reads with a quality for every base."""
    r = reads(spark, sf_dir).select("ReadName", "read", "labels", "cbc", F.expr(_QUAL).alias("base_qualities"))
    return structure.valid_reads(structure.annotate(r, SEGMENTS))


@query(f"""
with p as ({_PLACES}), c as ({_CELLS}), x as (select p.*, c.corrected, c.cell_id, case when c.cell_id = 'ambiguous' then 'ambiguous' else c.corrected end as name, case when kind = 3 then '-' else '+' end as orientation from p join c on c."ReadName" = p."ReadName")
select "ReadName", concat('@', "ReadName", '_', name, '_', umi, ' cell_id:', name, '|Barcodes:CBC:', corrected, '|UMI:', umi, '|orientation:', orientation, '|BQ:CBC:', {_slice("c0", "u0", "bq")}, ';UMI:', {_slice("u0", "t0", "bq")}) as demux_header,
  concat(cdna, tail) as demux_sequence, concat({_slice("d0", "d1", "bq")}, {_slice("t0", "d0", "bq")}) as demux_quality, name as demux_bucket from x""")
def demux_fastq(spark, sf_dir):
    """FASTQ records named by barcodes, with qualities of barcode and UMI, tails appended."""
    white = whitelist(spark, sf_dir)
    done = barcodes.cells(barcodes.with_corrections(with_qualities(spark, sf_dir).withColumn("CBC_Sequences", F.col("cbc")), white, ["CBC"]), white)
    return barcodes.demux_records(done, ["CBC"], "fwd", "fastq", True, True, True).select("ReadName", "demux_header", "demux_sequence", "demux_quality", "demux_bucket")


@query(f"""with p as ({_PLACES}) select "ReadName", concat('@', "ReadName", ' orientation:', case when kind = 3 then '-' else '+' end) as header, {_slice("d0", "d1", "read")} as sequence, rpad(substring({_slice("d0", "d1", "bq")}, 1, cast(event_id % 300 as int)), cast(length(cdna) as int), '!') as quality from p""")
def bulk_fastq(spark, sf_dir):
    """FASTQ records of all valid reads; qualities that end early are filled up."""
    r = with_qualities(spark, sf_dir)
    number, start = F.regexp_extract("ReadName", "([0-9]+)", 1).cast("int"), F.get("cDNA_Starts", F.lit(0))
    short = r.withColumn("base_qualities", F.substring("base_qualities", F.lit(1), start + number % 300))
    return barcodes.bulk_records(short, "fastq").select("ReadName", "header", "sequence", "quality")


@query(f"""select "ReadName", concat('>', "ReadName", ' orientation:', case when kind = 3 then '-' else '+' end) as header, case when kind = 3 then {RC.format("cdna")} else cdna end as sequence from ({ORACLE_READS}) where kind < 5""")
def bulk_records(spark, sf_dir):
    return barcodes.bulk_records(structure.valid_reads(annotated(spark, sf_dir))).select("ReadName", "header", "sequence")


@query(f"""select "ReadName", case when kind < 5 and length(tail) > 0 then cast(length(tail) as int) end as "polyA_lengths" from ({ORACLE_READS}) where kind < 5""")
def poly_lengths(spark, sf_dir):
    return barcodes.poly_length(structure.valid_reads(annotated(spark, sf_dir))).select("ReadName", "polyA_lengths")


# ---- discovery

_COUNTS = f"""select least(cbc, {RC.format("cbc")}) as "CBC", count(*) as read_count from ({ORACLE_READS}) where length(cbc) = 16 group by 1"""


def counts(spark, sf_dir) -> DataFrame:
    return discovery.count_barcodes(reads(spark, sf_dir).withColumn("CBC_Sequences", F.col("cbc")), ["CBC"], {"CBC": 16})


@query(_COUNTS)
def canonical_counts(spark, sf_dir):
    return counts(spark, sf_dir)


@query(f"""select "CBC", read_count, row_number() over (order by read_count desc, "CBC") as rank from ({_COUNTS})""")
def barcode_rank(spark, sf_dir):
    return discovery.ranked(counts(spark, sf_dir)).select("CBC", "read_count", F.col("rank").cast("long").alias("rank"))


_KNEE = f"""
with c as (select read_count, row_number() over (order by read_count desc) as r from ({_COUNTS}) where read_count >= 3),
s as (select max(r) as n, max(read_count) as hi, min(read_count) as lo from c),
p as (select r, read_count, log10(r) / log10(n) + (log10(read_count) - log10(lo)) / (log10(hi) - log10(lo)) - 1 as d from c, s),
b as (select r, read_count from p order by d desc, r limit 1)
select cast(b.r as bigint) as cliff_rank, b.read_count as cliff_count, greatest(3.0::double, b.read_count * 0.5::double) as threshold, (select count(*) from c where read_count >= greatest(3.0::double, b.read_count * 0.5::double)) as n_knee from b"""


@query(_KNEE)
def knee_threshold(spark, sf_dir):
    return discovery.knee(counts(spark, sf_dir), 3, 0.5)


@query(f"""with c as ({_COUNTS}) select a."CBC" as a, b."CBC" as b from c a, c b where a."CBC" <> b."CBC" and levenshtein(a."CBC", b."CBC") = 1""")
def near_duplicate_pairs(spark, sf_dir):
    pairs = discovery.near_pairs(counts(spark, sf_dir), ["CBC"])
    return pairs.select(F.get("a", F.lit(0)).alias("a"), F.get("b", F.lit(0)).alias("b"))


_DNA = "substring(translate(md5(cast({0} as varchar(20))), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 4)"
_TWO = f"select distinct {_DNA.format('p_partkey % 97')} as a, {_DNA.format('p_size')} as b from {{part}}"


@query(f"""with t as ({_TWO.format(part="part")}) select concat(x.a, '-', x.b) as one, concat(y.a, '-', y.b) as other from t x, t y where levenshtein(x.a, y.a) + levenshtein(x.b, y.b) = 1""")
def near_pairs_of_two_columns(spark, sf_dir):
    pairs = discovery.near_pairs(spark.sql(_TWO, part=table(spark, sf_dir, "part")), ["a", "b"])
    return pairs.select(F.array_join("a", "-").alias("one"), F.array_join("b", "-").alias("other"))


_MERGE = """
with recursive c as materialized (select *, row_number() over (order by read_count desc, "CBC") as o from ({counts})),
q as (select a.o, list(b.o order by b.o) as nb from c a join c b on b.o < a.o and levenshtein(a."CBC", b."CBC") = 1 group by a.o),
w as materialized (select o, coalesce(nb, []) as nb from c left join q using (o)),
t as (select 0::bigint as o, []::bigint[] as canon, 0::bigint as target union all
  select w.o, case when len(list_intersect(w.nb, t.canon)) = 0 then list_append(t.canon, w.o) else t.canon end, coalesce(list_min(list_intersect(w.nb, t.canon)), w.o) from t join w on w.o = t.o + 1)
select c."CBC", c.read_count, d."CBC" as canonical from t join c on c.o = t.o join c d on d.o = t.target"""


@query(_MERGE.format(counts=_COUNTS))
def merged_barcodes(spark, sf_dir):
    merged = discovery.merge_near(counts(spark, sf_dir), ["CBC"])
    return merged.select("CBC", "read_count", F.get("canonical", F.lit(0)).alias("canonical"))


_MERGED = _MERGE.format(counts=f"select a.* from ({_COUNTS}) a, ({_KNEE}) k where a.read_count >= k.threshold")


def discovered(spark, sf_dir) -> dict[str, DataFrame]:
    return discovery.discover(reads(spark, sf_dir).withColumn("CBC_Sequences", F.col("cbc")), ["CBC"], lengths={"CBC": 16})


@query(f"""select row_number() over (order by reads desc, "CBC") as cell_id, "CBC", "CBC" as cell, reads from (select canonical as "CBC", cast(sum(read_count) as bigint) as reads from ({_MERGED}) group by 1)""")
def discovered_whitelist(spark, sf_dir):
    return discovered(spark, sf_dir)["whitelist"]


@query(f"""with m as ({_MERGED}), x as (select canonical, cast(sum(read_count) as bigint) as more from m where "CBC" <> canonical group by 1)
select a."CBC", a.read_count + case when m.canonical = a."CBC" then coalesce(x.more, 0) else 0 end as read_count, case when m.canonical is null then 'below_knee' when m.canonical = a."CBC" then 'canonical' else concat('merged_into:', m.canonical) end as status
from ({_COUNTS}) a left join m on m."CBC" = a."CBC" left join x on x.canonical = a."CBC" """)
def barcode_statuses(spark, sf_dir):
    return discovered(spark, sf_dir)["statuses"]


@query(f"""with a as ({_COUNTS}), m as ({_MERGED}), t as (select (select count(*) from a) as n, (select cast(sum(read_count) as bigint) from a) as r, (select count(*) from m) as above, (select count(distinct canonical) from m) as cells)
select unnest(['unique_barcode_tuples_observed', 'total_reads_with_barcodes', 'CBC_unique_observed', 'tuples_above_knee', 'canonical_cells_after_merge', 'CBC_canonical']) as name, unnest([n, r, n, above, cells, cells]) as value from t""")
def discovery_statistics(spark, sf_dir):
    return discovered(spark, sf_dir)["statistics"]


# ---- alignments

#: Alignments: contig by event type, places and UMIs with many near copies, flags that mark some as secondary or supplementary.
_ALN = f"""
select event_id as ord, concat(ReadName, '_', cast(user_id % 20 as varchar(20)), '_', case when m = 7 then concat(substring(umi, 1, 5), translate(substring(umi, 6, 1), 'ACGT', 'CGTA'), substring(umi, 7, 6)) else umi end) as qname,
  cast(case when event_id % 17 = 0 then 256 when event_id % 19 = 0 then 2048 when event_id % 23 = 0 then 4 when event_id % 2 = 0 then 16 else 0 end as int) as flag,
  event_type as rname, cast((event_id % 997) % 7 * 10 + m as int) as s, cast(1000 + (event_id % 997) % 5 * 10 + m as int) as e, cast(event_id % 60 as int) as mapq
from ({{reads}})"""
ORACLE_ALN = _ALN.format(reads=ORACLE_READS)


def alignments(spark, sf_dir) -> DataFrame:
    rows = spark.sql(_ALN.replace("{reads}", "{r}"), r=reads(spark, sf_dir).drop("read", "labels"))
    null = F.lit(None).cast("string")
    return rows.withColumnRenamed("s", "start").withColumnRenamed("e", "end").withColumn("cb", null).withColumn("ub", null).withColumn("dt", null)


_LEAD = f"""
with a as (select *, regexp_extract(qname, '^(.*)_([^_]*)_([^_]*)$', 2) as cb, regexp_extract(qname, '^(.*)_([^_]*)_([^_]*)$', 3) as u from ({ORACLE_ALN}) where flag & 2308 = 0),
k as (select *, rname || '|' || cb || '|' || cast(flag & 16 as varchar) || '|' || cast(s // 10 as varchar) || '|' || cast(e // 10 as varchar) as key from a),
g as (select key, list_reduce(list_prepend([]::varchar[], list([u] order by s, ord)), lambda acc, x: case when len(list_filter(acc, lambda y: levenshtein(y, x[1]) <= 2)) > 0 then acc else list_concat(acc, x) end) as leaders from k group by key),
f as (select k.*, list_filter(leaders, lambda y: levenshtein(y, u) <= 2)[1] as lead, row_number() over (partition by k.key, u order by s, ord) as n from k join g on g.key = k.key)
select ord, u as name_umi, lead as umi_leader, not (u = lead and n = 1) as is_dup from f"""


@query(_LEAD)
def umi_leaders(spark, sf_dir):
    return al.umi_decisions(alignments(spark, sf_dir)).select("ord", "name_umi", "umi_leader", "is_dup")


@query(f"""select count(*) filter (not is_dup) as "unique", count(*) filter (is_dup) as duplicate from ({_LEAD})""")
def duplicate_totals(spark, sf_dir):
    return al.duplicate_totals(al.mark_duplicates(alignments(spark, sf_dir)))


@query(f"""with l as ({_LEAD}) select a.ord, cast(case when is_dup then a.flag | 1024 else a.flag end as int) as flag, case when is_dup is null then null when is_dup then 'Yes' else 'No' end as dt from ({ORACLE_ALN}) a left join l on l.ord = a.ord""")
def marked_duplicates(spark, sf_dir):
    return al.mark_duplicates(alignments(spark, sf_dir)).select("ord", "flag", "dt")


@query(f"""select qname, regexp_extract(qname, '^(.*)_([^_]*)_([^_]*)$', 1) as read, regexp_extract(qname, '^(.*)_([^_]*)_([^_]*)$', 2) as name_cb, regexp_extract(qname, '^(.*)_([^_]*)_([^_]*)$', 3) as name_umi from ({ORACLE_ALN})""")
def name_parts(spark, sf_dir):
    return al.with_name_parts(alignments(spark, sf_dir)).select("qname", "read", "name_cb", "name_umi")


_TAGGED = """select l_orderkey * 10 + l_linenumber as ord, concat('q', cast(l_orderkey as varchar(20))) as qname, cast(case when l_linenumber = 2 and l_returnflag = 'R' then 256 when l_linenumber = 3 and l_returnflag = 'A' then 2048 when l_linenumber = 4 then 4 else 0 end
  + case when l_linenumber = 5 then 1024 else 0 end as int) as flag, concat('c', cast(l_suppkey as varchar(20))) as cb, cast(l_partkey % 50 as varchar(20)) as ub, case when l_returnflag = 'N' then null when l_linenumber > 5 then 'Yes' else 'No' end as dt from {lineitem}"""
_CLASSES = """
with a as (""" + _TAGGED.format(lineitem="lineitem") + """), s as (select distinct qname from a where flag & 256 <> 0), p as (select distinct qname from a where flag & 2048 <> 0),
k as (select a.*, case when flag & 4 <> 0 then 'unmapped' when s.qname is not null then 'secondary' when p.qname is not null then 'supplementary' else 'unique' end as kind, (dt = 'Yes') or (case when flag & 1024 <> 0 then true when dt is null then null else false end) as dup
  from a left join s on s.qname = a.qname left join p on p.qname = a.qname where flag & 2304 = 0)
select cb, count(*) as total, count(*) filter (kind = 'unmapped') as unmapped, count(*) filter (kind = 'secondary') as secondary, count(*) filter (kind = 'supplementary') as supplementary, count(*) filter (kind = 'unique') as "unique",
  count(*) filter (dup) as duplicates, count(distinct case when not dup then ub end) as unique_umis from k group by cb"""


def tagged(spark, sf_dir) -> DataFrame:
    return spark.sql(_TAGGED, lineitem=table(spark, sf_dir, "lineitem"))


def classes(spark, sf_dir) -> DataFrame:
    return al.classes_per_cell(tagged(spark, sf_dir))


@query(_CLASSES)
def alignment_classes_per_cell(spark, sf_dir):
    return classes(spark, sf_dir)


def _pct(count: str, total: str) -> str:
    return f"case when {total} > 0 then round(100.0::double * {count} / {total}, 2) else 0.0::double end"


@query(f"""with c as ({_CLASSES}), t as (select cast(sum(total) as bigint) as t, cast(sum("unique") as bigint) as u, cast(sum(secondary) as bigint) as s, cast(sum(supplementary) as bigint) as p, cast(sum(unmapped) as bigint) as m from c),
r as (select unnest([struct_pack(category := 'total', count := t), struct_pack(category := 'unique', count := u), struct_pack(category := 'secondary', count := s), struct_pack(category := 'supplementary', count := p), struct_pack(category := 'unmapped', count := m)]) as r, t from t)
select r.category as category, r.count as count, {_pct("r.count", "t")} as percent from r""")
def alignment_stats(spark, sf_dir):
    return qc.alignment_stats(classes(spark, sf_dir))


@query(f"""select cast(row_number() over (order by total desc, cb) as int) as rank, cb as cell_id, total, "unique", secondary, supplementary, unmapped from ({_CLASSES})""")
def mapping_per_cell(spark, sf_dir):
    return qc.mapping_per_cell(classes(spark, sf_dir))


@query(f"""select cb as cell_id, case when total > 0 then round(duplicates / total, 4) else 0.0 end as dup_rate from ({_CLASSES})""")
def duplicates_per_cell(spark, sf_dir):
    return qc.duplicates_per_cell(classes(spark, sf_dir))


def crc32_sql(text: str) -> str:
    """CRC-32 of ASCII text in SQL: eight shifts for each byte."""
    bits = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)), lambda c, b: {bits}), 4294967295)"


@query("with a as (" + _TAGGED.format(lineitem="lineitem") + ") select count(*) as reads, 1 - count(distinct concat(cb, '|', ub)) / count(*) as saturation from a where flag & 2304 = 0")
def saturation_full(spark, sf_dir):
    return al.saturation(tagged(spark, sf_dir)).where("fraction = 1").select("reads", "saturation")


@query(f"""
with a as ({_TAGGED.format(lineitem="lineitem")}), r as (select cb, ub, qname from a where flag & 2304 = 0), h as (select qname, {crc32_sql("concat('0:', qname)")} as h from (select distinct qname from r)),
s as (select cb, ub, cast(ceil((h % 1000000 + 1) * 10 / 1000000.0::double) as int) as step from r join h using (qname)), n as (select step, count(*) as reads from s group by 1), f as (select step, count(*) as umis from (select min(step) as step from s group by cb, ub) group by 1),
k as (select unnest(range(1, 11)) as step), t as (select k.step, sum(coalesce(reads, 0)) over (order by k.step) as reads, sum(coalesce(umis, 0)) over (order by k.step) as umis from k left join n using (step) left join f using (step))
select step / 10.0::double as fraction, cast(reads as bigint) as reads, case when reads > 0 then round(1 - umis / reads, 9) else 0.0 end as saturation, round(reads / (select count(distinct cb) from r), 9) as reads_per_cell from t""")
def saturation_curve(spark, sf_dir):
    return al.saturation(tagged(spark, sf_dir)).withColumn("saturation", F.round("saturation", 9)).withColumn("reads_per_cell", F.round("reads_per_cell", 9))


@query("with a as (" + _TAGGED.format(lineitem="lineitem") + ") select count(*) as n_in, count(*) filter (flag & 1028 <> 0 or ord % 60 < 10) as n_filtered, count(*) filter (flag & 1028 = 0 and ord % 60 >= 10 and cb is null) as n_no_tag, count(*) filter (flag & 1028 = 0 and ord % 60 >= 10 and cb is not null) as n_kept from a")
def split_counters(spark, sf_dir):
    return al.split_counters(tagged(spark, sf_dir).withColumn("mapq", F.col("ord") % 60), min_mapq=10)


@query("with a as (" + _TAGGED.format(lineitem="lineitem") + f"), b as (select cb, cast({crc32_sql('cb')} % 256 as int) as bucket from (select distinct cb from a)) select bucket, a.cb, count(*) as n from a join b on a.cb = b.cb where flag & 1028 = 0 and ord % 60 >= 10 group by 1, 2")
def cell_buckets(spark, sf_dir):
    kept = al.split_by_cell(tagged(spark, sf_dir).withColumn("mapq", F.col("ord") % 60), min_mapq=10)
    return kept.groupBy("bucket", "cb").agg(F.count("*").alias("n"))


@query(f"""with a as ({ORACLE_ALN}), x as (select unnest(['click', 'view', 'purchase', 'signup', 'login', 'error']) as rname, unnest(range(0, 6)) as k), g as (select rname, 'g' || cast(j as varchar) as gene_id, j * 150 as gs, j * 150 + 90 as ge from x, unnest(range(0, 8)) t(j))
select gene_id, split_part(qname, '_', 2) as cell_id, count(distinct qname) as count from a join g on a.rname = g.rname and a.s < ge and gs < a.e where a.flag & 4 = 0 group by all""")
def gene_counts(spark, sf_dir):
    exons = spark.sql("select rname, concat('g', cast(j as string)) as gene_id, j * 150 as start, j * 150 + 90 as end from (select explode(array('click', 'view', 'purchase', 'signup', 'login', 'error')) as rname) lateral view explode(sequence(0, 7)) t as j")
    mapped = al.with_name_parts(al.pass_flags(alignments(spark, sf_dir), al.UNMAPPED)).withColumn("cb", F.col("name_cb"))
    return al.gene_counts(mapped, exons, width=200)


_BLOCKS = """select concat('q', cast(l_orderkey as varchar(20))) as qname, concat('c', cast(l_suppkey % 50 as varchar(20))) as cb, l_returnflag as rname, case when l_linenumber % 2 = 0 then '-' else '+' end as strand,
  cast(l_partkey % 300 * 10 + k * 400 as bigint) as s, cast(l_partkey % 300 * 10 + k * 400 + 20 + cast(l_quantity as bigint) as bigint) as e from {lineitem}, {two}"""
_FEATURES = "select r as rname, concat(r, cast(j as varchar(20))) as gene_id, case when j % 3 = 0 then '-' else '+' end as strand, cast(j * 70 as bigint) as fs, cast(j * 70 + 90 as bigint) as fe from {flags}, {numbers}"


@query(f"""
with b as ({_BLOCKS.format(lineitem="lineitem", two="(select unnest([0, 1]) as k)")}), g as ({_FEATURES.format(flags="(select unnest(['A', 'N', 'R']) as r)", numbers="(select unnest(range(0, 50)) as j)")}),
h as (select distinct qname, cb, gene_id from b join g on b.rname = g.rname and b.strand = g.strand and s < fe and fs < e), o as (select qname, cb, min(gene_id) as gene_id from h group by 1, 2 having count(*) = 1) select gene_id, cb as cell_id, count(*) as count from o group by 1, 2""")
def gene_counts_of_blocks(spark, sf_dir):
    """Stranded counts of reads over one gene alone: a gene within a read's gap has no part of it."""
    blocks = spark.sql(_BLOCKS, lineitem=table(spark, sf_dir, "lineitem"), two=spark.range(2).withColumnRenamed("id", "k")).withColumnsRenamed({"s": "start", "e": "end"})
    flags = spark.createDataFrame([("A",), ("N",), ("R",)], "r string")
    features = spark.sql(_FEATURES, flags=flags, numbers=spark.range(50).withColumnRenamed("id", "j")).withColumnsRenamed({"fs": "start", "fe": "end"})
    return al.gene_counts(blocks, features, width=500, overlapping=False, stranded=True)


@query("""with e as (select 'g' || cast(p_partkey as varchar) as gene_id, case when p_partkey % 2 = 0 then '+' else '-' end as strand, p_partkey * 1000 as a, p_partkey * 1000 + 60 + p_size as b, p_partkey * 1000 + 500 as c, p_partkey * 1000 + 500 + 70 as d from part),
x as (select gene_id, strand, a, b - a as n1, c, d - c as n2 from e), p as (select gene_id, strand, unnest(range(0, 100)) as place, a, n1, c, n2 from x),
o as (select *, cast(floor(place * (n1 + n2 - 1) / 99) as bigint) as off from p), q as (select gene_id, strand, place, case when off < n1 then a + off + 1 else c + off - n1 + 1 end as pos from o),
u as (select gene_id, strand, pos, row_number() over (partition by gene_id order by case when strand = '-' then -pos else pos end) - 1 as percentile from (select distinct gene_id, strand, pos from q)),
r as (select l_partkey * 1000 + l_linenumber * 10 as s, l_partkey * 1000 + l_linenumber * 10 + cast(l_quantity as bigint) * 12 as e from lineitem)
select cast(k as int) as percentile, count(r.s) as coverage from (select unnest(range(0, 100)) as k) left join u on u.percentile = k left join r on r.s < u.pos and u.pos <= r.e group by k""")
def gene_body_coverage(spark, sf_dir):
    return _coverage(table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem"))


def _coverage(p: DataFrame, li: DataFrame) -> DataFrame:
    """Genes are parts with two exons, blocks are lineitems."""
    gene, base = F.concat(F.lit("g"), F.col("p_partkey").cast("string")), F.col("p_partkey") * 1000
    two = F.explode(F.array(F.struct(base.alias("start"), (base + 60 + F.col("p_size")).alias("end")), F.struct((base + 500).alias("start"), (base + 570).alias("end")))).alias("x")
    exons = p.select(gene.alias("gene_id"), F.concat(F.lit("t"), gene).alias("transcript_id"), F.lit("c").alias("rname"), F.when(F.col("p_partkey") % 2 == 0, "+").otherwise("-").alias("strand"), two).select("gene_id", "transcript_id", "rname", "strand", "x.start", "x.end")
    s = F.col("l_partkey") * 1000 + F.col("l_linenumber") * 10
    return qc.gene_body_coverage(li.select(F.lit("c").alias("rname"), s.alias("start"), (s + F.col("l_quantity").cast("long") * 12).alias("end")), exons, width=5000)


# ---- count matrix: genes are parts, cells are suppliers

_MATRIX = "select cast(l_partkey as varchar) as gene_id, cast(l_suppkey as varchar) as cell_id, cast(sum(cast(l_quantity as bigint)) as bigint) as count from lineitem group by 1, 2"
_INFO = "select cast(p_partkey as varchar) as gene_id, case when p_partkey % 10 = 0 then 'MT-' || p_name when p_partkey % 7 = 0 then 'RPS' || p_name else p_name end as gene_name, p_type as biotype from part"


def matrix(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("gene_id"), F.col("l_suppkey").cast("string").alias("cell_id"), F.col("l_quantity").cast("long").alias("count"))
    return al.merge_matrices([li.where("count <= 25"), li.where("count > 25")])


def gene_info(spark, sf_dir) -> DataFrame:
    name = F.when(F.col("p_partkey") % 10 == 0, F.concat(F.lit("MT-"), "p_name")).when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("RPS"), "p_name")).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("gene_id"), name.alias("gene_name"), F.col("p_type").alias("biotype"))


@query(_MATRIX)
def counts_matrix(spark, sf_dir):
    return matrix(spark, sf_dir)


_METRICS = f"""with m as ({_MATRIX}), i as ({_INFO}), j as (select m.*, coalesce(gene_name, '') as n from m left join i on i.gene_id = m.gene_id),
t as (select cell_id, cast(sum(count) as bigint) as total_counts, count(*) filter (count > 0) as n_genes, sum(case when n like 'MT-%' or n like 'mt-%' then count else 0 end) as mi, sum(case when n like 'RPS%' or n like 'RPL%' or n like 'rps%' or n like 'rpl%' then count else 0 end) as ri from j group by 1)
select cell_id, total_counts, n_genes, case when total_counts > 0 then 100.0::double * mi / total_counts else 0 end as mito_pct, case when total_counts > 0 then 100.0::double * ri / total_counts else 0 end as ribo_pct,
  round(case when n_genes > 0 and total_counts > 1 then log10(n_genes) / log10(total_counts) else 0 end, 9) as complexity from t"""


@query(_METRICS)
def cell_metrics(spark, sf_dir):
    return qc.cell_metrics(matrix(spark, sf_dir), gene_info(spark, sf_dir)).withColumn("complexity", F.round("complexity", 9))


@query(f"""select count(*) as n_cells, median(case when complexity > 0 then complexity end) as median_complexity, median(mito_pct) as median_mito_pct, count(*) filter (mito_pct > 10) as over_10, count(*) filter (mito_pct > 20) as over_20 from ({_METRICS})""")
def cell_metric_summary(spark, sf_dir):
    return qc.cell_metric_summary(cell_metrics(spark, sf_dir))


@query(f"""with t as (select gene_id, cast(sum(count) as bigint) as total from ({_MATRIX}) group by 1 order by 2 desc, 1 limit 20) select coalesce(gene_name, t.gene_id) as gene, t.gene_id, total from t left join ({_INFO}) i on i.gene_id = t.gene_id""")
def top_genes(spark, sf_dir):
    return qc.top_genes(matrix(spark, sf_dir), gene_info(spark, sf_dir))


@query(f"""with b as (select biotype, count(*) as n from (select distinct gene_id from ({_MATRIX}) where count > 0) m join ({_INFO}) i on i.gene_id = m.gene_id group by 1), r as (select *, row_number() over (order by n desc, biotype) as r from b)
select case when r <= 15 then biotype else 'other' end as biotype, cast(sum(n) as bigint) as n from r group by 1""")
def genes_per_biotype(spark, sf_dir):
    return qc.genes_per_biotype(matrix(spark, sf_dir), gene_info(spark, sf_dir))


@query(f"""with s as (select l_returnflag as status, count(*) as count from lineitem group by 1), t as (select cast(sum(count) as bigint) as t from s) select status, count, {_pct("count", "t")} as percent from s, t""")
def assignment_totals(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("cell_id"), F.col("l_returnflag").alias("status")).agg(F.count("*").alias("count"))
    return qc.assignment_totals(rows)


# ---- reports on reads

_SPLIT = f"""
with r as ({ORACLE_READS}), c as ({_CELLS}), a as (select r.*, c.cell_id, c.min_dist from r join c on c."ReadName" = r."ReadName"),
v as (select "ReadName" as name, cell_id, min_dist, cast(length(read) as bigint) as len, cast(length(cdna) as bigint) as ins from a where kind < 5 union all select concat("ReadName", '__frag', cast(k as varchar)), cell_id, min_dist, cast(length(read) as bigint), cast(length(cdna) as bigint) from a, (select unnest([1, 2]) as k) where kind = 5),
i as (select concat("ReadName", '__remainder') as name, 'concatenated' as reason, cast(length(read) as bigint) as len from a where kind = 5 union all select "ReadName", 'Unexpected pattern: [5p_cDNA]', cast(length(read) as bigint) from a where kind = 6)
"""


def reports(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Valid reads with cells, split fragments among them, and invalid ones."""
    white = whitelist(spark, sf_dir)
    a = annotated(spark, sf_dir, split=True)
    valid = structure.valid_reads(a).withColumn("__r", F.regexp_replace("ReadName", "__frag[0-9]+$", ""))
    valid = valid.join(reads(spark, sf_dir).select(F.col("ReadName").alias("__r"), "cbc"), "__r").withColumn("CBC_Sequences", F.col("cbc")).drop("__r", "cbc")
    return barcodes.cells(barcodes.with_corrections(valid, white, ["CBC"]), white), structure.invalid_reads(a)


_SUM = _SPLIT + """, t as (select (select count(*) from i where name not like '%remainder') as n_invalid, (select count(*) from i where name like '%remainder') as n_concat_parents, (select count(*) from v where name like '%frag%') as n_fragments, (select count(*) from v) as n_effective_valid,
  (select count(*) from v where cell_id <> 'ambiguous') as n_demuxed, (select count(*) from v where cell_id = 'ambiguous') as n_ambiguous)"""


@query(_SUM + "select n_effective_valid - n_fragments + n_concat_parents + n_invalid as n_total, n_effective_valid - n_fragments as n_valid, * from t")
def read_summary(spark, sf_dir):
    return qc.summary(*reports(spark, sf_dir))


@query(_SUM + f""", x as (select n_effective_valid - n_fragments + n_concat_parents + n_invalid as n, * from t), y as (select n, unnest([struct_pack(c := 'Total', k := n), struct_pack(c := 'Valid', k := n_effective_valid - n_fragments), struct_pack(c := 'Concatenated', k := n_concat_parents), struct_pack(c := 'Invalid', k := n_invalid), struct_pack(c := 'Effective Valid', k := n_effective_valid)]) as r from x)
select y.r.c as category, y.r.k as count, {_pct("y.r.k", "n")} as percent from y""")
def read_architecture(spark, sf_dir):
    return qc.read_architecture(qc.summary(*reports(spark, sf_dir)))


@query(_SUM + f"""select 'Demuxed' as category, n_demuxed as count, {_pct("n_demuxed", "n_effective_valid")} as percent from t union all select 'Ambiguous', n_ambiguous, {_pct("n_ambiguous", "n_effective_valid")} from t""")
def barcode_assignment(spark, sf_dir):
    return qc.barcode_assignment(qc.summary(*reports(spark, sf_dir)))


@query(_SPLIT + f""", g as (select reason, count(*) as count from i where name not like '%remainder' group by 1), t as (select sum(count) as t from g) select reason, count, {_pct("count", "t")} as percent from g, t""")
def invalid_reasons(spark, sf_dir):
    return qc.invalid_reasons(reports(spark, sf_dir)[1])


@query(_SPLIT + f""", g as (select cast(least(min_dist, 5) as bigint) as edit_distance, count(*) as count from v group by 1), t as (select sum(count) as t from g) select edit_distance, count, {_pct("count", "t")} as percent from g, t""")
def edit_distances(spark, sf_dir):
    return qc.edit_distances(reports(spark, sf_dir)[0], "CBC")


def _box(rows: str, key: str, value: str) -> str:
    mid = lambda q: f"(v[cast(floor((len(v) - 1) * {q}) as bigint) + 1] + v[cast(ceil((len(v) - 1) * {q}) as bigint) + 1]) / 2"
    return f"select {key}, cast(len(v) as bigint) as n, v[1] as min, {mid(0.25)} as q1, {mid(0.5)} as median, {mid(0.75)} as q3, v[-1] as max from (select {key}, list_sort(list(cast({value} as bigint))) as v from ({rows}) where {value} is not null group by 1)"


@query(_SPLIT + ", w as (select 'CBC' as segment, cast(min_dist as bigint) as d from v union all select '5p', 0 from v union all select '3p', 0 from v) " + _box("select * from w", "segment", "d"))
def distance_box_stats(spark, sf_dir):
    return qc.distance_box_stats(reports(spark, sf_dir)[0])


@query(_SPLIT + ", w as (select * from (" + _box("select cell_id, len from v", "cell_id", "len") + ")) select cell_id, n, q1, median, q3 from w")
def read_length_per_cell(spark, sf_dir):
    return qc.length_per_cell(reports(spark, sf_dir)[0])


@query(_SPLIT + ", w as (select * from (" + _box("select cell_id, ins from v", "cell_id", "ins") + ")) select cell_id, n, q1, median, q3 from w")
def insert_length_per_cell(spark, sf_dir):
    return qc.length_per_cell(reports(spark, sf_dir)[0], "cDNA_length")


@query(_SPLIT + """, x as (select len, true as valid, name, cell_id from v union all select len, false, name, null from i), s as (select max(len) as most from x),
p as (select unnest([50, 100, 200, 500, 1000, 2000, 5000, 10000, 20000, 50000, 100000]) as nb), o as (select nb, most from p, s where most // nb >= 1), w as (select greatest(1, most // arg_min(nb, abs(nb - most / 100.0))) as w, greatest(1, max(most) // max(nb)) as f from o group by most),
f as (select len // f * f as f0, w, valid, name, cell_id from x, w)
select cast(f0 // w * w + w // 2 as bigint) as bin_center, count(*) as total, count(*) filter (not valid) as invalid, count(*) filter (valid) as valid, count(*) filter (valid and name like '%frag%') as split, count(*) filter (valid and cell_id <> 'ambiguous') as demuxed, count(*) filter (valid and cell_id = 'ambiguous') as ambiguous from f group by 1""")
def read_length_distribution(spark, sf_dir):
    return qc.length_distribution(*reports(spark, sf_dir))


@query(
    _SPLIT.replace("cast(length(cdna) as bigint) as ins from a", "cast(length(cdna) as bigint) as ins, length(cbc) as bc, length(tail) as tl, case when kind = 4 then 10 end as fl from a").replace(
        "cast(length(read) as bigint), cast(length(cdna) as bigint) from a", "cast(length(read) as bigint), cast(length(cdna) as bigint), length(cbc), length(tail), null from a"
    )
    + ", w as (select '5p' as segment, 22 as d from v union all select 'CBC', bc from v union all select 'UMI', 12 from v union all select 'polyT', nullif(tl, 0) from v union all select 'cDNA', ins from v union all select '3p', 30 from v union all select 'random_s', fl from v) "
    + _box("select * from w", "segment", "d")
)
def segment_lengths(spark, sf_dir):
    return qc.segment_lengths(reports(spark, sf_dir)[0])


@query(_SPLIT + ", y as (select * from v where cell_id <> 'ambiguous'), w as (select 'CBC' as segment, cast(min_dist as bigint) as d from y union all select '5p', 0 from y union all select '3p', 0 from y) " + _box("select * from w", "segment", "d"))
def distance_box_stats_demuxed(spark, sf_dir):
    return qc.distance_box_stats(reports(spark, sf_dir)[0], True)


@query(ORACLES["segment_lengths"].replace(", w as (select '5p'", ", v2 as (select * from v where cell_id <> 'ambiguous'), w as (select '5p'").replace(" from v union", " from v2 union").replace("fl from v)", "fl from v2)"))
def segment_lengths_demuxed(spark, sf_dir):
    return qc.segment_lengths(reports(spark, sf_dir)[0], True)


@query(_SPLIT + """, x as (select ins as len, name, cell_id from v where ins > 0), s as (select max(len) as most from x),
p as (select unnest([50, 100, 200, 500, 1000, 2000, 5000, 10000, 20000, 50000, 100000]) as nb), o as (select nb, most from p, s where most // nb >= 1), w as (select greatest(1, most // arg_min(nb, abs(nb - most / 100.0))) as w, greatest(1, max(most) // max(nb)) as f from o group by most),
f as (select len // f * f as f0, w, name, cell_id from x, w)
select cast(f0 // w * w + w // 2 as bigint) as bin_center, count(*) as total, count(*) filter (name like '%frag%') as split, count(*) filter (cell_id <> 'ambiguous') as demuxed, count(*) filter (cell_id = 'ambiguous') as ambiguous from f group by 1""")
def insert_length_distribution(spark, sf_dir):
    return qc.length_distribution(reports(spark, sf_dir)[0], None, 100, "cDNA_length").select("bin_center", "total", "split", "demuxed", "ambiguous")


@query(f"""with t as (select count(*) filter (not is_dup) as u, count(*) filter (is_dup) as d from ({_LEAD})) select 'unique' as category, u as count, {_pct("u", "(u + d)")} as percent from t union all select 'duplicate', d, {_pct("d", "(u + d)")} from t""")
def duplication_stats(spark, sf_dir):
    return qc.duplication_stats(al.duplicate_totals(al.mark_duplicates(alignments(spark, sf_dir))))


@query(f"""with a as (select *, regexp_extract(qname, '^(.*)_([^_]*)_([^_]*)$', 2) as cb, regexp_extract(qname, '^(.*)_([^_]*)_([^_]*)$', 3) as u from ({ORACLE_ALN}) where flag & 2308 = 0)
select ord, row_number() over (partition by rname, cb, flag & 16, s // 10, e // 10, u order by s, ord) > 1 as is_dup from a""")
def exact_duplicates(spark, sf_dir):
    return al.umi_decisions(alignments(spark, sf_dir), threshold=0).select("ord", "is_dup")


@query(f"""with r as (select read_count, row_number() over (order by read_count desc, "CBC") as rank from ({_COUNTS})), k as ({_KNEE}) select rank, read_count, rank <= n_knee as above_knee from r, k""")
def barcode_discovery(spark, sf_dir):
    c = counts(spark, sf_dir)
    return qc.barcode_discovery(discovery.ranked(c).withColumn("rank", F.col("rank").cast("long")), discovery.knee(c, 3, 0.5))


@query(f"""with c as ({_CORRECT}), w as ({ORACLE_WHITE}), u as (select distinct seq, unnest(string_split(corrected, ',')) as b from c), n as (select seq, count(*) as n, min(place) as place from u join w on w.barcode = u.b group by seq)
select c.seq, coalesce(cast(case when n = 1 then place end as varchar), 'ambiguous') as cell_id from c left join n on n.seq = c.seq""")
def cells_by_candidates(spark, sf_dir):
    fixed = corrections(spark, sf_dir).select("seq", F.col("corrected").alias("corrected_CBC"))
    return barcodes.cells_unique(fixed, whitelist(spark, sf_dir)).select("seq", "cell_id")


@query(f"""with r as (select 'CBC' as segment, levenshtein(cbc, cbc0) as d from ({ORACLE_READS})) select segment, count(*) as n, cast(min(d) as int) as min, quantile_cont(d, 0.25) as q1, quantile_cont(d, 0.5) as median, quantile_cont(d, 0.75) as q3, cast(max(d) as int) as max from r group by 1""")
def edit_summary(spark, sf_dir):
    r = reads(spark, sf_dir).select("ReadName", F.levenshtein("cbc", "cbc0").alias("distance"), F.lit("CBC").alias("segment"))
    return assess.distance_summary(r)


@query("select event_id, list_aggregate(list_transform(range(0, least(event_id % 7, 5)), lambda k: ['3p', '5p', 'cDNA'][(event_id + k) % 3 + 1]), 'string_agg', ',') as labels from events")
def label_decode(spark, sf_dir):
    ids = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: ((F.col("event_id") + k) % 3).cast("int"))
    rows = table(spark, sf_dir, "events").select("event_id", structure.decode(ids, ["cDNA", "5p", "3p"], F.least(F.col("event_id") % 7, F.lit(5))).alias("l"))
    return rows.select("event_id", F.when(F.size("l") > 0, F.array_join("l", ",")).alias("labels"))


@query(f"""select event_id, {RC.format("cbc")} as rc, least(cbc, {RC.format("cbc")}) as canonical, cast(length(list_filter(range(1, least(length(cbc), 16) + 1), lambda i: substring(cbc, i, 1) <> substring(cbc0, i, 1))) + abs(16 - length(cbc)) as int) as hamming from ({ORACLE_READS})""")
def sequence_expressions(spark, sf_dir):
    return reads(spark, sf_dir).select("event_id", sq.reverse_complement("cbc").alias("rc"), sq.canonical("cbc").alias("canonical"), sq.hamming("cbc", "cbc0").alias("hamming"))


@query()
def simulated_reads(spark, sf_dir):
    """Reads of a built-in layout with noise, annotated from their labels: rows by structure and verdict."""
    names, patterns = ["5p", "CBC", "UMI", "polyT", "cDNA", "3p"], ["CTACACGACGCTCTTCCGATCT", "N16", "N12", "T", "NN", "CCCATGTACTCTGCGTTGATACCACTGCTT"]
    plans = [simulate.Structure("single", tuple(names), tuple(patterns), 0.7), simulate.Structure("two", tuple(names), tuple(patterns), 0.3, 2, ("fwd", "rev"))]
    sims = simulate.simulate(spark, plans, 2000, seed=1)
    s = structure.Segments.of(names, [names, [n for n in names if n != "polyT"]], ["CBC"])
    done = structure.annotate(sims.withColumn("labels", structure.as_codes(F.col("labels"), s)), s)
    return done.groupBy("structure_type", "architecture").agg(F.count("*").alias("n"))


# ---- assessment

_PAIRS = "select event_id as id, concat(repeat('5', 4), repeat('C', cast(event_id % 5 as int)), repeat('D', 6)) as truth, concat(repeat('5', cast(3 + event_id % 3 as int)), repeat('C', cast(event_id % 4 as int)), repeat('D', 12)) as pred from {events}"


def label_pairs(spark, sf_dir) -> DataFrame:
    rows = spark.sql(_PAIRS, events=table(spark, sf_dir, "events"))
    return rows.select(F.split("truth", "").alias("truth"), F.split("pred", "").alias("pred"))


@query("""
with r as (""" + _PAIRS.format(events="events") + """), b as (select id, truth, pred, unnest(range(1, least(length(truth), length(pred)) + 1)) as k from r), c as (select substring(truth, k, 1) as t, substring(pred, k, 1) as p, count(*) as n from b group by 1, 2),
l as (select t as label from c union select p from c), s as (select label, sum(case when t = label and p = label then n else 0 end) as tp, sum(case when p = label then n else 0 end) as pp, sum(case when t = label then n else 0 end) as support from l, c group by 1),
q as (select label, case when pp > 0 then tp / pp else 0.0 end as pr, case when support > 0 then tp / support else 0.0 end as re, support from s),
m as (select label, round(pr, 4) as precision, round(re, 4) as recall, round(case when pr + re > 0 then 2 * pr * re / (pr + re) else 0.0 end, 4) as f1, cast(support as bigint) as support from q)
select * from m union all select 'macro avg', round(avg(precision), 4), round(avg(recall), 4), round(avg(f1), 4), cast(sum(support) as bigint) from m
union all select 'weighted avg', round(sum(precision * support) / sum(support), 4), round(sum(recall * support) / sum(support), 4), round(sum(f1 * support) / sum(support), 4), cast(sum(support) as bigint) from m""")
def label_scores(spark, sf_dir):
    return assess.label_scores(label_pairs(spark, sf_dir))


@query(f"""with c as (select unnest(['5p', 'CBC', 'UMI', 'polyT', 'cDNA', '3p']) as label, unnest(['5', 'C', 'U', 'T', 'D', '3']) as code)
select kind, label, cast(sum(length(labels) - length(replace(labels, code, ''))) as bigint) as bases from ({ORACLE_READS}), c where kind < 5 group by 1, 2""")
def rebuilt_labels(spark, sf_dir):
    """Labels of every base from the coordinates of valid reads, counted."""
    valid = structure.valid_reads(annotated(spark, sf_dir))
    found = assess.labels_of(valid, ["5p", "CBC", "UMI", "polyT", "3p"]).join(valid.select("ReadName", "kind"), "ReadName")
    return found.select("kind", F.explode("labels").alias("label")).groupBy("kind", "label").agg(F.count("*").alias("bases"))


@query(f"""with r as ({ORACLE_READS}) select case when kind = 5 then 'concat' else 'single' end as structure_type, count(*) as n_reads, cast(sum(case when kind = 5 then 2 else 1 end) as bigint) as expected, cast(sum(case when kind < 5 then 1 when kind = 5 then 2 else 0 end) as bigint) as recovered, count(*) filter (kind < 6) as n_correct from r group by 1""")
def fragment_recovery(spark, sf_dir):
    truth = reads(spark, sf_dir).select("ReadName", F.when(F.col("kind") == 5, "concat").otherwise("single").alias("structure_type"), F.when(F.col("kind") == 5, 2).otherwise(1).alias("expected_fragments"))
    return assess.structure_accuracy(truth, structure.valid_reads(annotated(spark, sf_dir, split=True))).select("structure_type", "n_reads", "expected", "recovered", "n_correct")


@query(f"""with r as ({ORACLE_READS}) select m, count(*) as n, cast(sum(levenshtein(cbc, cbc0)) as bigint) as edits from r group by 1""")
def segment_edits(spark, sf_dir):
    r = reads(spark, sf_dir).select("ReadName", "m", "cbc", "cbc0")
    pair = lambda c: r.select("ReadName", F.lit("CBC").alias("segment"), F.lit(0).alias("k"), F.col(c).alias("seq"))
    e = assess.segment_edits(pair("cbc0"), pair("cbc"))
    return e.join(r.select("ReadName", "m"), "ReadName").groupBy("m").agg(F.count("*").alias("n"), F.sum("distance").cast("long").alias("edits"))
