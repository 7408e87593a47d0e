"""DNA and coordinate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tokens that mean "no value", in lower case.
MISSING = ("", "none", "nan")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def reverse_complement(seq: Column | str) -> Column:
    """Reverse complement; characters other than A, C, G, T stay as they are."""
    return F.reverse(F.translate(_c(seq), "ACGT", "TGCA"))


def canonical(seq: Column | str) -> Column:
    """The smaller of a sequence and its reverse complement."""
    return F.least(_c(seq), reverse_complement(seq))


def usable(token: Column | str) -> Column:
    """The trimmed token, or null if it means "no value" (any case)."""
    t = F.trim(_c(token))
    return F.when(~F.lower(t).isin(*MISSING), t)


def slice_half_open(seq: Column | str, start: Column, end: Column) -> Column:
    """seq[start:end]; empty where end is not over start, null where a bound is."""
    return F.when(start.isNull() | end.isNull(), F.lit(None)).otherwise(_c(seq).substr((start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int")))


def first_int(text: Column | str) -> Column:
    """First number of a comma-separated text ("12.0, 30" gives 12), null if it has none."""
    token = F.trim(F.get(F.split(_c(text), ","), F.lit(0)))
    return token.try_cast("double").cast("int")


def coordinates(text: Column | str) -> Column:
    """All numbers of a comma-separated text, as an array of ints; tokens that are no numbers are left out."""
    return F.filter(F.transform(F.split(_c(text), ","), lambda x: F.trim(x).try_cast("double").cast("int")), lambda x: x.isNotNull())


def joined(values: Column | str) -> Column:
    """The text form of an array of coordinates or sequences, as files have it."""
    return F.array_join(_c(values).cast("array<string>"), ", ")


def hamming(a: Column | str, b: Column | str) -> Column:
    """Number of places that differ, plus the difference of lengths."""
    a, b = _c(a), _c(b)
    same = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.least(F.length(a), F.length(b)), F.lit(1))),
        F.lit(0),
        lambda acc, i: acc + (a.substr(i, F.lit(1)) != b.substr(i, F.lit(1))).cast("int"),
    )
    return F.when(F.least(F.length(a), F.length(b)) == 0, F.greatest(F.length(a), F.length(b))).otherwise(same + F.abs(F.length(a) - F.length(b)))


def deletions(seq: Column | str) -> Column:
    """All distinct sequences with one character less."""
    s = _c(seq)
    one = F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), lambda i: F.concat(s.substr(F.lit(1), i - 1), s.substr(i + 1, F.length(s))))
    return F.when(F.length(s) > 0, F.array_distinct(one)).otherwise(F.array().cast("array<string>"))


def deletions2(seq: Column | str) -> Column:
    """The sequence and all distinct ones with one or two characters less."""
    s = _c(seq)
    return F.array_distinct(F.concat(F.array(s), deletions(s), F.flatten(F.transform(deletions(s), deletions))))


def midpoint_quantile(values: Column | str, q: float) -> Column:
    """Mean of the values at floor and ceiling of q (n - 1) of an array; null if it is empty. Nulls take no part."""
    a = F.array_sort(F.filter(_c(values), lambda x: x.isNotNull()))
    at = (F.size(a) - 1) * F.lit(q)
    pick = lambda place: F.get(a, place.cast("int")).cast("double")
    return F.when(F.size(a) > 0, (pick(F.floor(at)) + pick(F.ceil(at))) / 2)


def percent(count: Column, total: Column, digits: int = 2) -> Column:
    """100 count / total, rounded; 0 where the total is."""
    return F.when(total > 0, F.round(F.lit(100.0) * count / total, digits)).otherwise(F.lit(0.0))


def known_cell(cell: Column | str) -> Column:
    """Assigned to a cell: neither null nor empty nor "ambiguous"."""
    return _c(cell).isNotNull() & ~_c(cell).cast("string").isin("", "ambiguous")


def fragment(name: Column | str) -> Column:
    return _c(name).rlike("__frag[0-9]+$")


def remainder(name: Column | str) -> Column:
    return _c(name).endswith("__remainder")
