"""Assessment of predicted structure against simulated truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Segments without a fixed sequence, which edit distances leave out.
FREE = ("cDNA", "random_s", "random_e")


def structure_accuracy(truth: DataFrame, valid: DataFrame) -> DataFrame:
    """structure_type, n_reads, n_correct, accuracy, expected, recovered, recovery.

    truth: ReadName, structure_type, expected_fragments. A single read is right with one predicted fragment or more; others need as
    many as expected. Recovery may be over 1.
    """
    found = valid.groupBy(F.regexp_replace("ReadName", "__frag[0-9]+$", "").alias("ReadName")).agg(F.count("*").alias("found"))
    rows = truth.join(found, "ReadName", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    right = F.when(F.col("expected_fragments") == 1, F.col("found") >= 1).otherwise(F.col("found") == F.col("expected_fragments"))
    out = rows.groupBy("structure_type").agg(F.count("*").alias("n_reads"), F.count_if(right).alias("n_correct"), F.sum("expected_fragments").alias("expected"), F.sum("found").alias("recovered"))
    return out.withColumn("accuracy", F.col("n_correct") / F.col("n_reads")).withColumn("recovery", F.col("recovered") / F.col("expected"))


def occurrences(reads: DataFrame, columns: list[str], with_parts: bool = False) -> DataFrame:
    """ReadName, segment, k, seq of the k-th occurrence of each segment, from *_Starts and *_Ends; free segments and fragments are left out."""
    kept = reads if with_parts else reads.where(~F.col("ReadName").contains("__frag"))
    parts = [F.struct(F.lit(c).alias("segment"), F.zip_with(f"{c}_Starts", f"{c}_Ends", lambda a, z: F.col("read").substr(a + 1, z - a)).alias("seqs")) for c in columns if c not in FREE]
    return kept.select("ReadName", F.explode(F.array(*parts)).alias("p")).select("ReadName", "p.segment", F.posexplode("p.seqs").alias("k", "seq"))


def true_occurrences(truth: DataFrame, columns: list[str]) -> DataFrame:
    """ReadName, segment, k, seq of the k-th run of bases with each label, from read and labels (names, one a base)."""
    n = F.size("labels")
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get("labels", i) != F.get("labels", i - 1)))
    ends = F.concat(F.slice(F.col("__s"), F.lit(2), F.size("__s")), F.array(n))
    runs = truth.where(n > 0).withColumn("__s", starts)
    runs = runs.withColumn("__r", F.zip_with("__s", ends, lambda a, z: F.struct(F.get("labels", a).alias("segment"), F.col("read").substr(a + 1, z - a).alias("seq"))))
    seqs = lambda c: F.transform(F.filter("__r", lambda r: r["segment"] == c), lambda r: r["seq"]).alias("seqs")
    of = [F.struct(F.lit(c).alias("segment"), seqs(c)) for c in columns]
    return runs.select("ReadName", F.explode(F.array(*of)).alias("p")).select("ReadName", "p.segment", F.posexplode("p.seqs").alias("k", "seq"))


def segment_edits(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """ReadName, segment, k, distance, normalised: Levenshtein distance of the k-th occurrences; a missing one counts as empty. Normalised by the true length, 1 if that is 0."""
    keys = ["ReadName", "segment", "k"]
    both = truth.select(*keys, F.col("seq").alias("t")).join(predicted.select(*keys, F.col("seq").alias("p")), keys, "full")
    t, p = F.coalesce("t", F.lit("")), F.coalesce("p", F.lit(""))
    d = F.levenshtein(t, p)
    return both.select(*keys, d.alias("distance"), F.when(F.length(t) > 0, d / F.length(t)).otherwise(1.0).alias("normalised"))


def distance_summary(edits: DataFrame, value: str = "distance") -> DataFrame:
    """segment, n, min, q1, median, q3, max (quartiles interpolated linearly)."""
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = edits.groupBy("segment").agg(F.count("*").alias("n"), F.min(value).alias("min"), q.alias("q"), F.max(value).alias("max"))
    return out.select("segment", "n", "min", *(F.get("q", F.lit(k)).alias(name) for k, name in enumerate(("q1", "median", "q3"))), "max")


def labels_of(reads: DataFrame, columns: list[str], default: str = "cDNA") -> DataFrame:
    """ReadName and labels (array, one a base) rebuilt from coordinates; of overlapping segments the later column wins.

    Labels are painted as a text of one character a base, a segment at a time, and become names at the end.
    """
    code = {name: chr(0x4E00 + k) for k, name in enumerate(dict.fromkeys([default, *columns]))}
    none = F.array().cast("array<int>")
    text = F.repeat(F.lit(code[default]), F.length("read"))
    for c in columns:
        spans = F.arrays_zip(F.coalesce(f"{c}_Starts", none).alias("a"), F.coalesce(f"{c}_Ends", none).alias("z"))
        char = F.lit(code[c])
        text = F.aggregate(spans, text, lambda acc, x: F.overlay(acc, F.repeat(char, x["z"] - x["a"]), x["a"] + 1, x["z"] - x["a"]))  # noqa: B023
    names = F.create_map(*(F.lit(x) for name, char in code.items() for x in (char, name)))
    painted = reads.select("ReadName", text.substr(F.lit(1), F.length("read")).alias("__t"))
    chars = F.filter(F.split("__t", ""), lambda x: x != "")
    return painted.select("ReadName", F.transform(chars, lambda x: names[x]).alias("labels"))


def label_scores(pairs: DataFrame) -> DataFrame:
    """label, precision, recall, f1, support (rounded to 4 digits), and macro and weighted averages of the rounded rows.

    pairs: truth and pred (arrays of labels); bases beyond the shorter one do not count.
    """
    n = F.least(F.size("truth"), F.size("pred"))
    bases = pairs.select(F.explode(F.arrays_zip(F.slice("truth", F.lit(1), n).alias("t"), F.slice("pred", F.lit(1), n).alias("p"))).alias("b")).groupBy("b.t", "b.p").agg(F.count("*").alias("n"))
    sides = F.explode(F.array(F.struct(F.col("t").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("said"), F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("hit")), F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("said"), F.lit(0).cast("long").alias("hit")))).alias("s")
    by = bases.select(sides).select("s.*").groupBy("label").agg(F.sum("support").alias("support"), F.sum("said").alias("said"), F.sum("hit").alias("hit"))
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    raw = by.select("label", share("hit", "said").alias("pr"), share("hit", "support").alias("re"), "support")
    f1 = F.when(F.col("pr") + F.col("re") > 0, 2 * F.col("pr") * F.col("re") / (F.col("pr") + F.col("re"))).otherwise(0.0)
    rows = raw.select("label", F.round("pr", 4).alias("precision"), F.round("re", 4).alias("recall"), F.round(f1, 4).alias("f1"), "support")
    names = ("precision", "recall", "f1")
    macro = rows.agg(*(F.round(F.avg(c), 4).alias(c) for c in names), F.sum("support").alias("support")).select(F.lit("macro avg").alias("label"), *names, "support")
    heavy = rows.agg(*(F.round(F.sum(F.col(c) * F.col("support")) / F.sum("support"), 4).alias(c) for c in names), F.sum("support").alias("support")).select(F.lit("weighted avg").alias("label"), *names, "support")
    return rows.unionByName(macro).unionByName(heavy)
