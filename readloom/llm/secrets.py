"""Secret scans with DataFrame functions only, and corpus-wide ownership of what they find.

Matches come from one regular expression a kind: the texts between the matches (`split`) and the matches
(`regexp_extract_all`) alternate. Matches become rows, and their lengths add up to every start and end, in code points, by a window over
those of one text and kind. So work is in proportion to the matches, however many one text has.

Ownership: a value is hashed and its hash counted by distinct owners (sources). A value of many owners is a copied
example; one that only a few have looks live, in however many documents of theirs it stands. Long mixed tokens of no
known kind are spans only if they look live; copied ones are listed apart, as examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import cut

#: Kinds in their order, each with a pattern (Java syntax) and the group that is the secret itself.
BASE_KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2),
    "access": (r"AKIA[A-Z0-9]{16,}", 0),
    "hex": (r"[0-9a-f]{24,}", 0),
}
#: Up to its END line, before which no other key begins; without one, headers and what looks like base64. Possessive: no length is too much.
_PEM = r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END [A-Z ]*PRIVATE KEY-----|(?:\s*+[A-Za-z][A-Za-z0-9-]*+:[^\n]*+)*+[A-Za-z0-9+/=\s]*+)"
MORE_KINDS = {
    "pem": (_PEM, 0),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0),
    "github": (r"gh[pousr]_[A-Za-z0-9]{36,}", 0),
    "slack": (r"xox[abprs]-[A-Za-z0-9-]{10,}", 0),
    "google": (r"AIza[A-Za-z0-9_-]{35}", 0),
    "stripe": (r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}", 0),
    "url": (r"[a-z]://[^\s:/@]++:([^\s:/@]{3,}+)@", 1),
}
GENERIC = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}+"
KINDS = [*BASE_KINDS, *MORE_KINDS, "generic"]
#: What `assign` needs in group 2, and a generic token in distinct characters.
ASSIGNED, DISTINCT = 6, 10
#: A value of more owners is a copied example.
OWNERS = 2
MASK = "[SECRET]"

_FOUND = "struct<rank:int,place:int,gap:int,size:int,hash:bigint,good:boolean>"


def _found(text: Column, kind: str, pattern: str, group: int) -> Column:
    """Leftmost non-overlapping matches of a kind: rank of the kind, number, characters before it since the last one, its characters, hash of the value, and whether it counts."""
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("0"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("1"))

    def row(x: Column, place: Column) -> Column:
        value = F.regexp_extract(x["1"], pattern, group) if group else x["1"]
        good = F.lit(True)
        if kind == "assign":
            good = F.length(value) >= ASSIGNED
        if kind == "generic":
            good = F.size(F.array_distinct(F.split(value, ""))) >= DISTINCT
        return F.struct(F.lit(KINDS.index(kind)).alias("rank"), place.alias("place"), F.length(x["0"]).alias("gap"), F.length(x["1"]).alias("size"), F.xxhash64(value).alias("hash"), good.alias("good"))

    rows = F.transform(F.filter(zipped, lambda x: x["1"].isNotNull()), row)
    return F.when(text.rlike(pattern), rows).otherwise(F.array().cast(f"array<{_FOUND}>"))


def _scan(docs: DataFrame, keep: list[str], text: str, owner: str | None) -> DataFrame:
    """`keep`, __uid, __owner and __found, the matches of all kinds, written to the shared folder. No column of `keep` begins with two underscores."""
    who = F.coalesce(F.col(owner).cast("string"), F.lit("")) if owner else F.lit("")
    rows = docs.select(*keep, F.monotonically_increasing_id().alias("__uid"), who.alias("__owner"), F.coalesce(F.col(text), F.lit("")).alias("__t"))
    kinds = {**BASE_KINDS, **MORE_KINDS, "generic": (GENERIC, 0)}
    found = F.concat(*(_found(F.col("__t"), k, p, g) for k, (p, g) in kinds.items()))
    return cut(rows.select(*keep, "__uid", "__owner", found.alias("__found")), "secret-matches")


def _placed(scanned: DataFrame) -> DataFrame:
    """__uid, __owner, start, rank, stop, hash of every span; of generic ones the parts that no other covers."""
    rows = scanned.where(F.size("__found") > 0).select("__uid", "__owner", F.explode("__found").alias("f")).select("__uid", "__owner", "f.*")
    upto = Window.partitionBy("__uid", "rank").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum((F.col("gap") + F.col("size")).cast("long")).over(upto)
    spans = rows.withColumn("stop", stop).where("good").select("__uid", "__owner", (F.col("stop") - F.col("size")).alias("start"), "rank", "stop", "hash")
    generic = F.col("rank") == KINDS.index("generic")
    # a sweep over all starts and ends of a text: a stretch between two of them is a part if a generic span is open and no other
    both = F.array(*(F.struct(F.col(at).alias("at"), F.when(generic, 0).otherwise(way).alias("known"), F.when(generic, way).otherwise(0).alias("generic"), F.when(generic & F.lit(way > 0), F.col("hash")).alias("of")) for at, way in (("start", 1), ("stop", -1))))
    events = spans.select("__uid", "__owner", F.explode(both).alias("e")).select("__uid", "__owner", "e.*")
    order = Window.partitionBy("__uid").orderBy("at")
    sofar = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = events.select("__uid", "__owner", F.col("at").alias("start"), F.lead("at").over(order).alias("stop"), F.sum("known").over(sofar).alias("known"), F.sum("generic").over(sofar).alias("generic"), F.last("of", True).over(sofar).alias("hash"))
    parts = swept.where("generic > 0 and known = 0 and stop > start").select("__uid", "__owner", "start", F.lit(KINDS.index("generic")).alias("rank"), "stop", "hash")
    return spans.where(~generic).unionByName(parts)


def _judged(scanned: DataFrame) -> DataFrame:
    """__uid, __all, the spans of a row in order with `copied`, and __examples, its copied generic ones; only rows with spans.

    Values of few owners, nearly all, are no rows of the ownership table; a value that a third of the rows
    hold is counted in parts first, and the join's large partition is split by adaptive execution.
    """
    one = cut(_placed(scanned), "secret-spans")
    owned = one.select("hash", "__owner").distinct().groupBy("hash").agg(F.count("*").alias("owners"))
    copied = cut(owned.where(F.col("owners") > OWNERS), "secret-owners")
    seen = one.join(copied, "hash", "left").withColumn("copied", F.col("owners").isNotNull())
    rows = seen.groupBy("__uid").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "stop", "copied"))).alias("__every"))
    example = lambda s: (s["rank"] == KINDS.index("generic")) & s["copied"]
    return rows.select("__uid", F.filter("__every", lambda s: ~example(s)).alias("__all"), F.filter("__every", example).alias("__examples"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def secrets(docs: DataFrame, owner: str = "source") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, examples, one row for each row of docs.

    examples lists the copied generic tokens, as spans does the rest; n_copied counts both kinds of copies.

    A null or empty text has no spans (base_sha256 is that of the empty string). A null owner or id counts as the empty
    one; without a column of owners all rows have one owner, so nothing is copied. Repeated rows are scanned each for itself. Long
    texts are scanned whole. An empty table gives an empty one; columns other than doc_id, text and the owner have no part.
    Runs jobs: matches, spans and copied values are written.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *([owner] if owner in docs.columns else []))
    scanned = _scan(rows, ["doc_id"], "text", owner if owner in docs.columns else None)
    judged = _judged(scanned)
    empty = F.array().cast(judged.schema["__all"].dataType)
    some = scanned.where(F.size("__found") > 0).select("doc_id", "__uid").join(judged, "__uid", "left").select("doc_id", *(F.coalesce(c, empty).alias(c) for c in ("__all", "__examples")))
    none = scanned.where(F.size("__found") == 0).select("doc_id", empty.alias("__all"), empty.alias("__examples"))
    out = some.unionByName(none)
    base = F.filter("__all", lambda s: s["rank"] < len(BASE_KINDS))
    number = lambda test: F.size(F.filter("__all", test)).cast("long")
    of_kind = lambda k: lambda s: s["rank"] == k
    return out.select(
        "doc_id",
        *(number(of_kind(k)).alias(f"n_{kind}") for k, kind in enumerate(BASE_KINDS)),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("__all")).alias("spans"),
        number(lambda s: ~s["copied"]).alias("n_live"),
        (number(lambda s: s["copied"]) + F.size("__examples")).alias("n_copied"),
        _joined(F.col("__examples")).alias("examples"),
    )


def redact(docs: DataFrame, owner: str = "source") -> DataFrame:
    """The documents, all columns, with every span of `secrets` masked in text, and n_chars (if there) of the new text.

    Null and empty texts stay as they are, and so does every text without a span. Spans that touch or overlap have one mask. Repeated
    rows are masked each for itself. Any column names may be there; without a column of owners all rows have one
    owner. An empty table gives an empty one. Runs jobs, as `secrets` does.
    """
    names = docs.columns
    own = [f"k{n}" for n in range(len(names))]
    of = dict(zip(names, own, strict=True))
    scanned = _scan(docs.toDF(*own), own, of["text"], of.get(owner))
    judged = _judged(scanned).where(F.size("__all") > 0)
    text = F.col(of["text"])
    # each span's text since the furthest end before it; a span that begins before that end adds nothing but its own end
    spans = judged.select("__uid", F.posexplode("__all").alias("n", "s")).select("__uid", "n", "s.start", "s.stop")
    before = Window.partitionBy("__uid").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("from", F.coalesce(F.max("stop").over(before), F.lit(-1))).where(F.col("start") > F.col("from"))
    apart = spans.groupBy("__uid").agg(F.array_sort(F.collect_list(F.struct(F.greatest("from", F.lit(0)).alias("from"), "start"))).alias("__kept"))
    ends = judged.select("__uid", F.array_max(F.transform("__all", lambda s: s["stop"])).alias("__end"))
    pieces = F.transform("__kept", lambda k: text.substr((k["from"] + 1).cast("int"), (k["start"] - k["from"]).cast("int")))
    masked = F.concat(F.array_join(pieces, MASK), F.lit(MASK), text.substr((F.col("__end") + 1).cast("int"), F.length(text)))
    rows = scanned.where(F.size("__found") > 0).join(apart, "__uid", "left").join(ends, "__uid", "left")
    rows = rows.withColumn("__new", F.when(F.col("__kept").isNull(), text).otherwise(masked))
    changed = {of["text"]: F.col("__new")}
    if "n_chars" in of:
        length = F.length("__new").cast(docs.schema["n_chars"].dataType)
        changed[of["n_chars"]] = F.when(F.col("__kept").isNull(), F.col(of["n_chars"])).otherwise(length)
    some = rows.select(*(changed.get(c, F.col(c)).alias(c) for c in own))
    return scanned.where(F.size("__found") == 0).select(*own).unionByName(some).toDF(*names)
