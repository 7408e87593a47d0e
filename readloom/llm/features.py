"""Counts over whole texts that rules and classifiers share."""

from __future__ import annotations

import numpy as np

from . import textbatch as tb

#: Frequent function words of English, French, German and Spanish.
STOPWORDS = """the of and to in a is that it for on with as was be by an are this or from at not have which
le la les de des et un une que pour dans est pas sur avec par du en au qui ne se
der die das und ist ein eine nicht mit von zu den auf im dem sich des für
el los las y que del por con una para su al lo como más pero sus""".split()

_STOP = tb.hash_set(STOPWORDS)
_SYMBOL = tb.byte_table(b"#*$%&|<>")
_UPPER = tb.byte_table(bytes(range(65, 91)))
_ALPHA = tb.byte_table(bytes([*range(65, 91), *range(97, 123)])) | (np.arange(256) >= 0xC0)
_DIGIT = tb.byte_table(b"0123456789")
_PUNCT = tb.byte_table(bytes(c for c in range(33, 127) if not chr(c).isalnum()))
_END = tb.byte_table(b".!?")

COUNTS = (
    "n_chars", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_alpha",
    "n_digits", "n_punct", "n_stop", "n_distinct", "n_short", "n_long", "n_symbol_words", "n_no_alpha_words", "n_ends", "n_pipes",
)


def counts(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row a text, one column for each of COUNTS (int64).

    Words are `[^\\x20\\x09-\\x0D]+`. n_lines: \\n-split lines with a word; n_dup_lines: those equal to an
    earlier one; n_repeat_words: words in 3-word windows that the text has twice or more.
    """
    n_docs = len(offs) - 1
    out = np.zeros((n_docs, len(COUNTS)), np.int64)
    put = lambda name, values: out.__setitem__((slice(None), COUNTS.index(name)), values)
    by_doc = lambda mask: tb.per_doc(mask, offs)
    r = tb.runs(buf, offs, tb.SPACE)
    lead = ~tb.CONT[buf]
    points = np.concatenate([[0], np.cumsum(lead)])
    put("n_chars", by_doc(lead))
    put("n_words", np.diff(r.first))
    size = points[r.end] - points[r.start]
    of_runs = lambda values: np.bincount(r.doc, weights=values, minlength=n_docs).astype(np.int64)
    put("word_chars", of_runs(size))
    for name, chars in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_alpha", _ALPHA), ("n_digits", _DIGIT), ("n_punct", _PUNCT)):
        put(name, by_doc(chars[buf]))
    put("n_pipes", by_doc(buf == 124))
    h = tb.run_hash(buf, r, tb.LOWER)
    put("n_stop", of_runs(tb.member(h, _STOP)))
    _, later = tb.repeated(h, r.doc)
    put("n_distinct", np.diff(r.first) - of_runs(later))
    put("n_short", of_runs(size <= 2))
    put("n_long", of_runs(size >= 20))
    some = np.concatenate([[0], np.cumsum(_SYMBOL[buf])])
    put("n_symbol_words", of_runs(some[r.end] > some[r.start]))
    some = np.concatenate([[0], np.cumsum(_ALPHA[buf])])
    put("n_no_alpha_words", of_runs(some[r.end] == some[r.start]))
    put("n_ends", of_runs(_END[buf[r.end - 1]]) if r.n else 0)

    key, at = tb.windows(tb.run_hash(buf, r), r, 3)
    twice, _ = tb.repeated(key, r.doc[at])
    covered = np.zeros(r.n, bool)
    for k in range(3):
        covered[at[twice] + k] = True
    put("n_repeat_words", of_runs(covered))

    lines = tb.runs(buf, offs, tb.NEWLINE)
    visible = np.concatenate([[0], np.cumsum(~tb.SPACE[buf])])
    has = visible[lines.end] > visible[lines.start]
    lines = tb.Runs(lines.start[has], lines.end[has], lines.doc[has], lines.first)
    put("n_lines", np.bincount(lines.doc, minlength=n_docs))
    _, later = tb.repeated(tb.run_hash(buf, lines), lines.doc)
    put("n_dup_lines", np.bincount(lines.doc, weights=later, minlength=n_docs).astype(np.int64))
    return out


def ratios(c: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Rule statistics of each text, smoothed so that short texts stay near the middle; all finite."""
    get = lambda name: c[:, COUNTS.index(name)].astype(float)
    words, chars, lines = get("n_words"), get("n_chars"), get("n_lines")
    share = lambda a, b, mean, weight: (a + mean * weight) / (b + weight)
    cols = {
        "log_words": np.log1p(words),
        "word_length": share(get("word_chars"), words, 5.5, 5),
        "symbols": share(get("n_symbols"), words, 0.01, 10),
        "symbol_words": share(get("n_symbol_words"), words, 0.01, 10),
        "pipes": share(get("n_pipes"), words, 0.0, 10),
        "dup_lines": share(get("n_dup_lines"), lines, 0.01, 3),
        "repeat_words": share(get("n_repeat_words"), words, 0.02, 20),
        "upper": share(get("n_upper"), get("n_alpha"), 0.03, 100),
        "digits": share(get("n_digits"), chars, 0.005, 100),
        "punct": share(get("n_punct"), chars, 0.03, 100),
        "stop": share(get("n_stop"), words, 0.2, 20),
        "distinct": np.log1p(get("n_distinct")) / np.log1p(np.maximum(words, 1)),
        "short_words": share(get("n_short"), words, 0.25, 20),
        "long_words": share(get("n_long"), words, 0.01, 20),
        "no_alpha_words": share(get("n_no_alpha_words"), words, 0.01, 20),
        "ends": share(get("n_ends"), words, 0.1, 20),
        "words_a_line": np.log1p(share(words, lines, 20, 1)),
    }
    return np.column_stack(list(cols.values())), list(cols)
