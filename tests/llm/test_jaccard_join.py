"""The join against all pairs."""

import random
import re

import duckdb
import pytest

from readloom.llm import jaccard_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets(t):
    w = [x.lower() if x.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(t or "")]
    return frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[i : i + 5]) for i in range(len(w) - 4)))


def brute(rows):
    s = [(d, sets(t)) for d, t in rows]
    near = [set() for _ in s]
    post = {}
    for i, (_, x) in enumerate(s):
        for g in x:
            post.setdefault(g, []).append(i)
    for i, (_, x) in enumerate(s):
        for j in {j for g in x for j in post[g] if j > i}:
            c = len(x & s[j][1])
            if 5 * c >= 4 * (len(x) + len(s[j][1]) - c):
                near[i].add(j)
                near[j].add(i)
    out, label = [], list(range(len(s)))
    for i in range(len(s)):
        todo, seen = [i], {i}
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [s[j][0] for j in seen if s[j][0] is not None]
        label[i] = min(ids, default=None)
        out.append((s[i][0], label[i], len(near[i]), len({s[j][1] for j in near[i]} - {s[i][1]})))
    return sorted(out, key=repr)


def got(spark, rows):
    df = jaccard_join.join(spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, class_id string, n long"))
    return sorted(((r.doc_id, r.class_id if r.class_id >= 0 else None, r.n_links, r.n_texts) for r in df.collect()), key=repr)


def near_copies(n, words, seed, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_documents_against_all_pairs(spark):
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    rows += [(None, rows[0][1]), (None, None), (7001, ""), (7002, ""), (7003, "one two"), (7004, "One  two"), (7005, None), (rows[5][0], rows[5][1]), (7006, "one two three four five")]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize(("leaf", "block"), [(4000, 512), (30, 16)])
def test_groups_of_near_copies(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(jaccard_join, "LEAF", leaf)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    shared = " ".join(f"p{k}" for k in range(60))
    rng = random.Random(4)
    texts = near_copies(150, 120, 1, 6) + near_copies(40, 300, 2, 20) + [shared + " " + " ".join(f"u{rng.randrange(9**9)}" for _ in range(80)) for _ in range(120)]
    texts += [texts[0]] * 30 + [texts[3].upper()]
    rows = list(enumerate(texts))
    want, have = brute(rows), got(spark, rows)
    assert [r[:2] for r in have] == [r[:2] for r in want]
    lost = sum(w[2] - h[2] for w, h in zip(want, have, strict=True))
    assert all(h[2] <= w[2] for w, h in zip(want, have, strict=True)) and lost <= 0.001 * sum(w[2] for w in want)


def test_no_rows(spark):
    assert got(spark, []) == []
    assert got(spark, [(4, None)]) == [(4, 4, 0, 0)]


def test_one_row_of_each_class_whatever_the_columns_are_named(spark):
    names = "`__uid` long, `__class` string, uid long, kept long, k0 long, doc_id long, text string, rid long"
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(1, "a", 2, 3, 4, 9, text, 5), (1, "b", 2, 3, 4, 7, text.upper(), 5), (1, "c", 2, 3, 4, None, text, 5), (0, "d", 0, 0, 0, 3, None, 0), (0, "e", 0, 0, 0, 3, None, 0), (None,) * 8]
    out = jaccard_join.deduplicate(spark.createDataFrame(rows, names))
    assert out.columns == [c.split()[0].strip("`") for c in names.split(", ")]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([rows[1], *rows[3:]], key=repr)


def test_recall_of_buckets_that_are_split(spark, monkeypatch):
    """A cluster of pairs around the threshold, in buckets far over LEAF: links lost against all pairs."""
    monkeypatch.setattr(jaccard_join, "LEAF", 25)
    rows = list(enumerate(near_copies(400, 100, 7, 5)))
    want, have = brute(rows), got(spark, rows)
    found, every = sum(h[2] for h in have), sum(w[2] for w in want)
    assert [h[1] for h in have] == [w[1] for w in want] and every > 10_000 and found >= 0.999 * every
