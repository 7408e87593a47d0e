"""Toxicity scores: gradient-boosted trees over dense features with isotonic calibration.

Two lexicons give densities: a fixed one, and one learnt from the labelled sample (words and beginnings of words that
occur almost only in toxic rows). For the rows that the trees are fitted on, the learnt one is made from the other
parts of the sample, so that its density means the same there as on new texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features as ft
from . import textbatch as tb
from .boosting import fit_scores
from .sampling import bounded, fold, labelled
from .store import cut

#: Insults, threats and contempt in English, French, German and Spanish.
INSULTS = """idiot idiots idiotic moron morons moronic stupid stupidity dumb dumbass imbecile cretin fool fools foolish
loser losers scum scumbag trash garbage filth filthy pathetic worthless useless disgusting disgrace vile clown clowns
jerk jerks bastard bastards bitch bitches asshole assholes ass arse crap crappy shit shitty bullshit fuck fucking fucked
fucker motherfucker damn damned bloody cunt dick dickhead prick twat wanker whore slut hate hated hateful despise
ugly freak freaks creep creepy pervert retard retarded lunatic psycho insane crazy coward cowards liar liars fraud
parasite parasites vermin rat rats pig pigs swine dog cockroach maggot maggots leech subhuman savage savages
kill die dead murder hang burn rot choke suffer shut hell
imbécile débile crétin connard connards connasse salaud salope merde putain ordure abruti minable pauvre
dumm dummkopf trottel arschloch scheiße scheisse verdammt wichser schlampe abschaum drecksau widerlich erbärmlich
estúpido estupido imbécil idiota tonto pendejo cabrón cabron mierda puta basura asqueroso inútil patético""".split()
#: Second persons in the same languages.
SECOND = """you your yours yourself yourselves u ur ya tu te toi ton ta tes vous votre vos du dich dir dein deine euch
ihr usted ustedes ti tuyo vosotros""".split()
#: Characters that stand for letters.
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_INSULTS, _SECOND = tb.hash_set(INSULTS), tb.hash_set(SECOND)
#: All but letters come between words; a case-folded byte.
_APART = ~(tb.byte_table(bytes([*range(65, 91), *range(97, 123)])) | (np.arange(256) >= 0x80))
_PLAIN = tb.LOWER.copy()
for _a, _b in STAND_INS.items():
    _PLAIN[ord(_a)] = ord(_b)
_APART_PLAIN = _APART.copy()
_APART_PLAIN[[ord(c) for c in STAND_INS]] = False
_BANG, _STAR = tb.byte_table(b"!?"), tb.byte_table(b"*#@$%^&")
#: Words before and after an insult in which a second person counts as near.
NEAR = 5

#: Parts of the sample, letters in a beginning, and what a learnt term needs: toxic rows with it, and their share of all rows with it.
PARTS, STEM, LEAST_ROWS, LEAST_SHARE = 5, 4, 5, 0.8

NAMES = ["insults", "insult_density", "any_insult", "distinct_insults", "near_second", "second_density", "obfuscated", "spelt", "bangs", "stars_in_words", "learnt", "learnt_density", "learnt_distinct"]


def terms(buf: np.ndarray, r: tb.Runs, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and texts of the words and of the beginnings of the words longer than STEM letters."""
    lead = np.flatnonzero(~tb.CONT[buf])
    letter = np.searchsorted(lead, r.start)
    long = (letter + STEM < len(lead)) & (lead[np.minimum(letter + STEM, len(lead) - 1)] < r.end) if len(lead) else np.zeros(0, bool)
    stem = tb.Runs(r.start[long], lead[letter[long] + STEM], r.doc[long], r.first)
    return np.concatenate([h, tb.run_hash(buf, stem, tb.LOWER) ^ np.uint64(1)]), np.concatenate([r.doc, stem.doc])


def feature_matrix(buf: np.ndarray, offs: np.ndarray, learnt: np.ndarray) -> np.ndarray:
    """Dense features of each text; empty texts get zeros and the smoothed ratios."""
    n = len(offs) - 1
    r = tb.runs(buf, offs, _APART)
    h = tb.run_hash(buf, r, tb.LOWER)
    term, of = terms(buf, r, h)
    known = tb.member(term, learnt)
    term, of = term[known], of[known]
    found = np.bincount(of, minlength=n)
    _, again = tb.repeated(term, of)
    hit, second = tb.member(h, _INSULTS), tb.member(h, _SECOND)
    total = lambda doc, v: np.bincount(doc, weights=v, minlength=n)
    words = np.diff(r.first)
    hits, seconds = total(r.doc, hit), total(r.doc, second)
    upto = np.concatenate([[0], np.cumsum(second)])
    at = np.flatnonzero(hit)
    lo, hi = np.maximum(at - NEAR, r.first[r.doc[at]]), np.minimum(at + NEAR + 1, r.first[r.doc[at] + 1])
    near = total(r.doc[at], upto[hi] > upto[lo])
    _, later = tb.repeated(h[at], r.doc[at])
    # a word that is an insult only after its stand-ins are read as letters
    plain = tb.runs(buf, offs, _APART_PLAIN)
    odd = np.concatenate([[0], np.cumsum(~_APART_PLAIN[buf] & _APART[buf])])
    mixed = odd[plain.end] > odd[plain.start]
    plain = tb.Runs(plain.start[mixed], plain.end[mixed], plain.doc[mixed], plain.first)
    hidden = total(plain.doc, tb.member(tb.run_hash(buf, plain, _PLAIN), _INSULTS))
    # single letters in a row: w o r d s
    single = (r.end - r.start) == 1
    spelt = np.zeros(n)
    if r.n >= 3:
        three = single[:-2] & single[1:-1] & single[2:] & (r.doc[:-2] == r.doc[2:])
        spelt = total(r.doc[:-2], three)
    stars = np.concatenate([[0], np.cumsum(_STAR[buf])])
    white = tb.runs(buf, offs, tb.SPACE)
    inner = stars[np.maximum(white.end - 1, white.start)] - stars[np.minimum(white.start + 1, white.end)]
    masked = total(white.doc, inner > 0)
    w = words + 10.0
    own = np.column_stack([
        np.log1p(hits), hits / w, hits > 0, hits - total(r.doc[at], later), near / w, seconds / w,
        hidden / w, spelt / w, tb.per_doc(_BANG[buf], offs) / w, masked / w,
        np.log1p(found), found / w, found - np.bincount(of, weights=again, minlength=n),
    ])
    shared, _ = ft.ratios(ft.counts(buf, offs))
    return np.column_stack([own, shared])


class Model:
    """Scores from the trees, with the learnt lexicon that they look up."""

    def __init__(self, learnt: np.ndarray, scores):
        self.learnt, self.scores = learnt, scores

    def __call__(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        return self.scores(feature_matrix(buf, offs, self.learnt))


def _score_batches(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = np.zeros(b.num_rows)
        for lo, hi, buf, offs in tb.slices(b.column(b.num_columns - 1)):
            out[lo:hi] = model(buf, offs)
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), pa.array(out)], names=[*b.schema.names[:-1], "score"])


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term, then for each part of the sample the toxic rows with it, then all rows with it."""
    for b in batches:
        for lo, hi, buf, offs in tb.slices(b.column(0)):
            label, part = (b.column(k).slice(lo, hi - lo).to_numpy(zero_copy_only=False) for k in (1, 2))
            r = tb.runs(buf, offs, _APART)
            term, of = terms(buf, r, tb.run_hash(buf, r, tb.LOWER))
            _, again = tb.repeated(term, of)
            term, at = np.unique(term[~again], return_inverse=True)
            of = of[~again]
            count = lambda w, k: np.bincount(at, weights=w * (part[of] == k), minlength=len(term)).astype(np.int64)
            toxic = label[of] == 1
            columns = [count(toxic, k) for k in range(PARTS)] + [count(np.ones(len(of)), k) for k in range(PARTS)]
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), *map(pa.array, columns)], names=["term", *(f"c{k}" for k in range(2 * PARTS))])


def _lexicon(term: np.ndarray, toxic: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.sort(term[(toxic >= LEAST_ROWS) & (toxic >= LEAST_SHARE * rows)])


def _feature_batches(learnt: list[np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, buf, offs in tb.slices(b.column(0)):
            part = b.column(2).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
            x = np.zeros((hi - lo, 0))
            for k in np.unique(part):
                rows = feature_matrix(buf, offs, learnt[k])
                x = rows if not x.size else np.where((part == k)[:, None], rows, x)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), *(b.column(k).slice(lo, hi - lo) for k in (1, 3))], names=["x", "label", "key"])


def train(docs: DataFrame, labels: DataFrame, column: str = "toxic", mod: int = 5, held: int = 0, limit: int = 20000, **how) -> Model:
    """Fit on at most `limit` labelled documents outside the held-out fold; equal texts count once, with their largest label.

    The sample is written to the shared folder; its features, some 30 numbers a row, and its learnt terms come to the
    driver: every term that one of the lexicons holds, of which a sample of bounded rows has few. Rows are taken in order
    of a hash of their text, so the model does not depend on files or partitions. Without rows of both labels the score is
    the share of label 1, or 0.
    """
    spark = docs.sparkSession
    rows = labelled(docs, labels, column, limit, mod, held).groupBy("key", "text").agg(F.max("label").alias("label"))
    part = F.pmod(F.xxhash64("text"), F.lit(PARTS)).cast("int")
    # dealt by key before they are written, so that features are made by many tasks; the keys of a bounded sample are few
    dealt = rows.select("text", "label", part.alias("part"), "key").repartition(4 * spark.sparkContext.defaultParallelism, "key")
    sample = cut(dealt, "toxic-sample")
    last = sample.select("key").orderBy("key").limit(limit).agg(F.max("key")).first()[0]
    sample = sample.where(F.col("key") <= F.lit(last or 0))
    names = [f"c{k}" for k in range(2 * PARTS)]
    found = sample.mapInArrow(lambda batches: tb.tidy(_term_batches(batches)), "term long, " + ", ".join(f"{c} long" for c in names)).groupBy("term").agg(*(F.sum(c).alias(c) for c in names))
    of = lambda k, out: sum((F.col(c) for j, c in enumerate(names[k : k + PARTS]) if j != out), F.lit(0))
    wanted = F.lit(False)
    for out in range(PARTS + 1):  # the lexicons without a part, and the whole one
        wanted |= (of(0, out) >= LEAST_ROWS) & (of(0, out) >= LEAST_SHARE * of(PARTS, out))
    kept = found.where(wanted).collect()
    term = np.array([r.term for r in kept], np.int64).view(np.uint64)
    c = np.array([tuple(r)[1:] for r in kept], np.int64).reshape(len(kept), 2, PARTS)
    every = _lexicon(term, c[:, 0].sum(1), c[:, 1].sum(1))
    learnt = [_lexicon(term, c[:, 0].sum(1) - c[:, 0, k], c[:, 1].sum(1) - c[:, 1, k]) for k in range(PARTS)]
    got = bounded(sample.mapInArrow(lambda batches: tb.tidy(_feature_batches(learnt, batches)), "x array<double>, label int, key long"), limit)
    x = np.array([r.x for r in got]).reshape(len(got), -1) if got else np.zeros((0, 1))
    return Model(every, fit_scores(x, np.array([r.label for r in got], float), **how))


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of docs as k0, k1, ... and score: no name can clash."""
    kept = docs.toDF(*(f"k{n}" for n in range(len(docs.columns))))
    rows = kept.withColumn("text", F.col(f"k{docs.columns.index('text')}"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields) + ", score double"
    return rows.mapInArrow(lambda batches: tb.tidy(_score_batches(model, batches)), schema)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, higher: toxic likelier) of every row.

    A null text counts as empty; empty texts get the score of their features; repeated rows stay, each with the
    same score; the score depends on the text alone; an empty table gives an empty one; other columns are not read.
    """
    return _scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).select(F.col("k0").alias("doc_id"), "score")


def toxicity(docs: DataFrame, labels: DataFrame, limit: int = 20000, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; labels are learnt from rows with crc32(doc_id) mod 5 other than 0."""
    out = score(docs, train(docs, labels, limit=limit))
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents, all columns, whose score is under the threshold.

    Null and empty texts have the score of their features and stay where that is low. Repeated rows stay or go together. Long
    texts are read whole. Any column names may be there; only text is read. An empty table gives an empty one; without labels of
    both kinds all stay, or all go if every label is 1.
    """
    out = _scored(docs, train(docs, labels)).where(F.col("score") < threshold)
    return out.drop("score").toDF(*docs.columns)
