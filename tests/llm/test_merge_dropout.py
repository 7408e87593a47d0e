"""Encoding against the library without dropout, and against a plain agenda with it; decoding gives back every text."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from readloom.llm import merge_dropout as md

PATH = public_tokenizers.path("piece_bpe_32k.model")


def some_texts(n=600):
    rng = random.Random(2)
    parts = [*"abcdet  \n\t.,é▁日x\x00", "hello", " the ", "ing", "\U0001f600", "▁▁", "    ", "<s>", "<0x41>"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randrange(80))) for _ in range(n)]
    return [*out, "", " ", "▁", "a" * 300, " " * 200, "the " * 500, "internationalisation" * 12]


def split(ids, count):
    return [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])]


def plain(p, text, seed, rate):
    """One agenda over the whole text, as defined: best rank, then leftmost; dropped candidates never come in."""
    sym = [md.Pieces.of(PATH).char[ord(c)].item() for c in " " + text] if text else []
    sym = [(s if s >= 0 else -1 - ord(c), i, c) for i, (s, c) in enumerate(zip(sym, " " + text, strict=False))]
    while True:
        best = None
        for k in range(len(sym) - 1):
            c = int(p.merge(np.array([sym[k][0]]), np.array([sym[k + 1][0]]))[0])
            if c >= 0 and (best is None or p.rank[c] < best[0]):
                if rate and p.dropped(np.array([seed]), np.array([sym[k][1]]), np.array([c]), rate)[0]:
                    continue
                best = (p.rank[c], k, c)
        if best is None:
            break
        _, k, c = best
        sym[k : k + 2] = [(c, sym[k][1], "")]
    out = []
    for s, _, c in sym:
        out += [s] if s >= 0 else [int(p.byte[b]) for b in c.encode()]
    return out


def test_no_dropout_is_the_library():
    p, sp = md.Pieces.of(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [t for t in some_texts() if "▁" not in t]
    got = split(*p.encode(texts, md.doc_seeds(list(range(len(texts))), 1), 0.0))
    assert got == [sp.encode(t) for t in texts]
    assert [sp.decode(g) for g, t in zip(got, texts, strict=True) if "\x00" not in t] == [t for t in texts if "\x00" not in t]


@pytest.mark.parametrize("rate", [0.1, 0.6])
def test_dropout_is_the_agenda(rate):
    p = md.Pieces.of(PATH)
    texts = [t for t in some_texts(120) if len(t) < 330]
    seeds = md.doc_seeds(list(range(len(texts))), 3)
    assert split(*p.encode(texts, seeds, rate)) == [plain(p, t, s, rate) for t, s in zip(texts, seeds, strict=True)]


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 1.0])
def test_round_trip(rate):
    p, texts = md.Pieces.of(PATH), some_texts()
    ids, count = p.encode(texts, md.doc_seeds(list(range(len(texts))), 9), rate)
    raw, size = p.decode(ids, count)
    at = np.concatenate([[0], np.cumsum(size)])
    assert [raw[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:], strict=True)] == texts


def test_tables(spark):
    rows = [(k, t, "x", 1) for k, t in enumerate(some_texts(100))] + [(None, "no id", "x", 1), (500, None, None, None), (501, "the same words again"), (502, "the same words again"), (501, "the same words again")]
    rows = [(*r, None, None)[:4] for r in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_ids int")
    enc = md.encode(docs, PATH, rate=0.5)
    got = enc.collect()
    assert len(got) == len(rows) and all(r.lossless and len(r.ids) == r.n_ids for r in got)
    back = md.decode(enc, PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(r[0]), r[1] or "") for r in rows)
    same = [r.ids for r in got if r.doc_id == 501]
    assert same[0] == same[1] != next(r.ids for r in got if r.doc_id == 502)
    other = {r.doc_id: r.ids for r in md.encode(docs, PATH, rate=0.5, seed=2).collect()}
    assert sum(other[r.doc_id] != r.ids for r in got) > 50
    assert md.encode(docs.limit(0), PATH).count() == 0
