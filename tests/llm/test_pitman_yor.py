"""The language model against plain counts, and its probabilities against 1."""

import math
import random
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from readloom.llm import pitman_yor as py

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(t):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t or "")] + [None]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def test_base_counts(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()] + [(None, "a b"), (None, None), (900, ""), (901, None), (902, "The THE the É é"), (902, "The THE the É é"), (903, "x" * 3000 + " y")]
    docs = spark.createDataFrame([(i, t, 0, "z") for i, t in rows], "doc_id long, text string, n long, data string")
    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for i, t in rows)
    out = py.scores(docs).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)
    test = [r for r in out if r.held_out]
    assert sum(r.score for r in test) > sum(r.base_score for r in test)


def test_no_training_rows_and_no_rows(spark):
    one = next(i for i in range(100) if held(i))
    r = py.scores(spark.createDataFrame([(one, "a b")], "doc_id long, text string")).collect()[0]
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0) and abs(r.score) < 1e-9
    assert py.scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def texts(n=60, words=30, seed=5):
    rng = random.Random(seed)
    names = [f"w{k}" for k in range(words)]
    out = []
    for _ in range(n):
        at, t = rng.randrange(words), []
        for _ in range(40):
            t.append(names[at])
            at = (at * 7 + 1) % words if rng.random() < 0.6 else rng.randrange(words)
        out.append(" ".join(t))
    return out


@pytest.fixture(params=[2, 12, py.HEAD])
def small(monkeypatch, request):
    """One bucket over texts of 30 words, of which few, some or all are head words."""
    monkeypatch.setattr(py, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(py, "EXPLICIT", 40)
    rows = texts()
    batch = pa.RecordBatch.from_arrays([pa.array(range(60), pa.int64()), pa.array(rows), pa.array([0] * 60, pa.int32())], names=["doc_id", "text", "fold"])
    found = next(py._words(iter([pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"])])))
    frequent = found.column(0).to_numpy().view(np.uint64)[np.argsort(-found.column(1).to_numpy(), kind="stable")]
    dealt = pa.Table.from_batches(py._chunks(py.Codes(frequent[: request.param]), 1, 2, iter([batch])))
    merged = py._merge(dealt.filter(pa.compute.equal(dealt["bucket"], 0)))
    own = py.Bucket(merged["model"][0].as_py())
    counted, h = own.counted(), py.HEAD
    known = counted[2 * h + 1] + (counted[h : 2 * h] > 0).sum()
    totals = lambda s: py.Totals(counted[:h], s[:h], s[h : 2 * h], float(s[h:].sum()), 20.0, py._discount(*counted[2 * h + 2 :]), known)
    return own, totals, counted


def test_seating_is_consistent_and_repeats(small):
    own, totals, counted = small
    assert counted[2 * py.HEAD] == 60 * 41
    after, seen = [totals(own.summed())], []
    for _ in range(4):
        for _ in own.sweeps(3, after):
            pass
        for t, c in ((own.tx, own.cx), (own.ty, own.cy), (own.tz, own.cz)):
            assert (t >= 1).all() and (t <= c).all()
        assert (own.tables >= own.tables_q).all() and (own.parent >= own.parent_q).all()
        after.append(totals(own.summed()))
        seen.append((own.tx.copy(), own.ty.copy(), own.tz.copy()))
    for k in own.sweeps(3, after[:-1]):
        assert all((a == b).all() for a, b in zip(seen[k], (own.tx, own.ty, own.tz), strict=True))
    assert any((a != b).any() for a, b in zip(seen[2], seen[3], strict=True))


def test_a_written_seating_goes_on_as_if_kept(small):
    own, totals, _ = small
    after, state, seen = [totals(own.summed())], None, []
    for _ in range(3):
        for _ in own.sweeps(3, after[-1:], state):
            pass
        state = own.state()
        after.append(totals(own.summed()))
        seen.append((own.tx, own.ty, own.tz, own.summed()))
    for k in own.sweeps(3, after[:-1]):
        assert all((a == b).all() for a, b in zip(seen[k], (own.tx, own.ty, own.tz, own.summed()), strict=True))


def test_probabilities_sum_to_one_in_every_context(small):
    own, totals, _ = small
    after = [totals(own.summed())]
    for _ in own.sweeps(0, after):
        pass
    t = totals(own.summed())
    x, y, z, q, back, single = own.probabilities(t)
    # of all words: a head context's share of the parent, and what its own customers add
    whole = t.new(t.tables) / (t.strength + t.customers)
    own_part = np.zeros(py.HEAD)
    np.add.at(own_part, own.xu, (own.cx - t.discount * own.tx) / (t.strength + t.customers[own.xu]))
    np.add.at(own_part, own.yu, (own.cy - t.discount * own.ty) / (t.strength + t.customers[own.yu]))
    assert np.allclose(whole + own_part, 1)
    tail = np.zeros(own.n_contexts)
    np.add.at(tail, own.zu, (own.cz - t.discount * own.tz) / (t.strength + own.customers[own.zu]))
    np.add.at(tail, own.qu, q)
    assert np.allclose(tail + t.new(own.tables) / (t.strength + own.customers), 1)
    # and the parent's: V known words and one unknown
    known = np.concatenate([t.parent[t.parent > 0], own.parent[own.parent > 0]])
    assert len(known) == t.known and abs(t.single(known).sum() + t.single(np.zeros(1))[0] - 1) < 1e-9
    assert (x > 0).all() and (y > 0).all() and (z > 0).all() and (back > 0).all() and (single > 0).all()


def ways(n, d):
    """Weights of the numbers of tables of n customers: each table of m weighs (1 - d)(2 - d)...(m - 1 - d)."""
    out = np.zeros(n + 2)
    out[1] = 1
    for c in range(1, n):
        t = np.arange(n + 2)
        out = np.concatenate([[0], out[:-1]]) + out * np.maximum(c - d * t, 0) * (t > 0)
    return out


@pytest.mark.parametrize("explicit", [1 << 14, 1])
@pytest.mark.parametrize(("n", "new", "d"), [(2, 0.7, 0.5), (3, 2.0, 0.8), (9, 1.5, 0.6), (30, 3.0, 0.3)])
def test_sweeps_have_the_exact_distribution_of_tables(monkeypatch, n, new, d, explicit):
    """Of a dish alone with a fixed weight of a new table, tables t weigh new ** t times the seatings with t tables."""
    monkeypatch.setattr(py, "EXPLICIT", explicit)
    rng, m = np.random.default_rng(4), 3000 if explicit > 1 else 150
    dishes = py.Dishes(rng, np.full(m, n), np.full(m, new), d)
    got = np.zeros(n + 2)
    for k in range(25):
        dishes.sweep(rng, np.full(m, new), d)
        if k >= 5:
            got += np.bincount(dishes.tables(), minlength=n + 2)
    want = ways(n, d) * new ** np.arange(n + 2)
    assert np.abs(got / got.sum() - want / want.sum()).max() < (0.015 if explicit > 1 else 0.06)


@pytest.mark.parametrize("explicit", [1 << 14, 1])
def test_a_sweep_reseats_every_customer(monkeypatch, explicit):
    """All at one table first; then a new table is all but certain for each who is reseated, of small and large dishes, few and many."""
    monkeypatch.setattr(py, "EXPLICIT", explicit)
    rng = np.random.default_rng(3)
    for customers in (np.array([2, 700, 90, 90, 1500]), np.concatenate([[3000], np.full(80, 200), [65]])):
        dishes = py.Dishes(rng, customers, np.full(len(customers), 1e-15), 0.5)
        assert (dishes.tables() == 1).all()
        dishes.sweep(rng, np.full(len(customers), 1e15), 0.5)
        assert (dishes.tables() == customers).all() and len(dishes.table_sizes()) == 0


def plain_scores(rows, sweeps, keep, seed):
    """The same model with a list of tables for each dish, every customer reseated in turn under live totals."""
    rng = random.Random(seed)
    end, begin = "</s>", "<s>"
    split = [[*t.split(), end] for _, t in rows]
    train = [held(i) is False for i, _ in rows]
    pairs = [(u, w) for words, use in zip(split, train, strict=True) if use for u, w in zip([begin, *words], words, strict=False)]
    c = Counter(pairs)
    cu = Counter()
    for (u, _), n in c.items():
        cu[u] += n
    known = len({w for _, w in pairs})
    d = py._discount(sum(n == 1 for n in c.values()), sum(n == 2 for n in c.values()))
    dishes = {p: [n] for p, n in c.items()}
    tables, parent = Counter(u for u, _ in c), Counter(w for _, w in c)
    single = lambda w: (parent[w] + py.PRIOR) / (sum(parent.values()) + py.PRIOR * (known + 1))
    out = np.zeros(len(rows))
    total = np.zeros((len(rows), max(map(len, split))))
    for s in range(sweeps):
        for (u, w), seats in dishes.items():
            for _ in range(sum(seats) if sum(seats) > 1 else 0):
                k = rng.choices(range(len(seats)), seats)[0]
                seats[k] -= 1
                if not seats[k]:
                    del seats[k]
                    tables[u] -= 1
                    parent[w] -= 1
                k = rng.choices(range(len(seats) + 1), [*(n - d for n in seats), (py.STRENGTH + d * tables[u]) * single(w)])[0]
                if k == len(seats):
                    seats.append(1)
                    tables[u] += 1
                    parent[w] += 1
                else:
                    seats[k] += 1
        if s >= sweeps - keep:
            for i, words in enumerate(split):
                for j, (u, w) in enumerate(zip([begin, *words], words, strict=False)):
                    seats = dishes.get((u, w), [])
                    total[i, j] += ((sum(seats) - d * len(seats)) + (py.STRENGTH + d * tables[u]) * single(w)) / (py.STRENGTH + cu[u]) / keep
    for i, words in enumerate(split):
        out[i] = np.log10(total[i, : len(words)]).sum()
    return out


@pytest.mark.parametrize(("head", "chars"), [(1 << 16, 24_000_000), (12, 3000)])
def test_scores_against_a_plain_sampler(spark, monkeypatch, head, chars):
    """Head words only in one bucket, and mostly tail words over several; averages of both samplers agree."""
    monkeypatch.setattr(py, "BUCKET_CHARS", chars)
    rows = list(enumerate(texts(40, 20)))
    counts = Counter(p for i, t in rows if not held(i) for p in zip(["<s>", *t.split()], [*t.split(), "</s>"], strict=True))
    fixed = (py.STRENGTH, py._discount(sum(n == 1 for n in counts.values()), sum(n == 2 for n in counts.values())))
    monkeypatch.setattr(py, "parameters", lambda rng, drawn: fixed)
    whole = py.head_words
    monkeypatch.setattr(py, "head_words", lambda t, n: whole(t, n)[:head])
    want = np.mean([plain_scores(rows, 12, 8, seed) for seed in (1, 2)], 0)
    out = {r.doc_id: r for r in py.scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    got = np.array([out[i].score for i, _ in rows])
    assert np.abs(got / want - 1).max() < 0.02
    test = [r for r in out.values() if r.held_out]
    assert test and sum(r.score for r in test) > sum(r.base_score for r in test)


def test_a_long_text_and_rare_pairs(spark, monkeypatch):
    """A text over several slices, all of whose words are tail words; n_known and base as counted."""
    monkeypatch.setattr(py, "head_words", lambda t, n: np.zeros(0, np.uint64))
    long = " ".join(f"x{k % 977}" for k in range(300_000))
    rows = [(0, long), (1, "x1 x2 x3"), (3, "x3 x2 zz"), (5, None)]
    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    for r in py.scores(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        t = tokens(dict(rows)[r.doc_id])
        assert (r.n_tokens, r.n_known) == (len(t), sum(c[w] > 0 for w in t))
        assert abs(r.base_score - sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) < 1e-4
        assert math.isfinite(r.score) and r.score < 0


@pytest.mark.parametrize(("strength", "discount"), [(3.0, 0.3), (40.0, 0.7)])
def test_strength_and_discount_are_found(monkeypatch, strength, discount):
    """Restaurants filled by the process itself: draws given their seats lie around what filled them."""
    monkeypatch.setattr(py, "RARE", 50)
    rng = np.random.default_rng(7)
    customers, tables, sizes = np.full(60, 300), np.zeros(60, np.int64), []
    for k in range(60):
        seated = []
        for n in range(300):
            x = rng.random() * (strength + n) - (strength + discount * len(seated))
            if x < 0:
                seated.append(1)
            else:
                seated[min(int(np.searchsorted(np.cumsum(np.array(seated) - discount), x, "right")), len(seated) - 1)] += 1
        tables[k] = len(seated)
        sizes += seated
    now, seen = (20.0, 0.5), []
    for k in range(400):
        drawn = py.seats(rng, customers, tables, np.array(sizes), *now)
        assert drawn[0] == np.rint(drawn[0])
        now = py.parameters(rng, drawn)
        seen.append(now)
    got = np.mean(seen[50:], 0)
    assert abs(got[1] - discount) < 0.05 and abs(got[0] / strength - 1) < 0.35


def test_sums_of_draws():
    rng = np.random.default_rng(8)
    sizes = np.array([1, 2, 5, 200_000])
    got = np.mean([py.successes(rng, sizes, 3.0, 4.0) for _ in range(4000)])
    assert abs(got - sum(min(1, 3 / (4 + j)) for n in sizes.tolist() for j in range(1, n))) < 0.3


def test_head_words_are_counted_over_all_texts(spark, monkeypatch):
    """However many characters there are, no text is left out: a sample of so few held nearly none of these."""
    monkeypatch.setattr(py, "SAMPLE_CHARS", 10, raising=False)
    rows = texts(200, 300)
    want = Counter(w for t in rows for w in [*t.split(), None])
    found = py.head_words(spark.createDataFrame([(t,) for t in rows], "text string"), py.HEAD)
    hashed = {}
    for w in want:
        h = py.tokens(np.frombuffer((w or "").encode(), np.uint8), np.array([0, len(w or "")]))[0]
        hashed[int(h[0])] = want[w]
    assert len(found) == len(want)
    assert [hashed[h] for h in found.tolist()] == sorted(want.values(), reverse=True)
    assert py.head_words(spark.createDataFrame([(t,) for t in rows], "text string"), 5).tolist() == found[:5].tolist()


def test_pairs_of_rare_words_are_reseated_alike_in_both_buckets(monkeypatch):
    """All words are tail words, over three buckets that tell each other the totals: repeated pairs get further tables, the same at both ends."""
    monkeypatch.setattr(py, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(py, "EXPLICIT", 25)
    rows = texts(60, 12)
    batch = pa.RecordBatch.from_arrays([pa.array(range(60), pa.int64()), pa.array(rows), pa.array([0] * 60, pa.int32())], names=["doc_id", "text", "fold"])
    dealt = pa.Table.from_batches(py._chunks(py.Codes(np.zeros(0, np.uint64)), 3, 2, iter([batch])))
    of = {b: py._merge(dealt.filter(pa.compute.equal(dealt["bucket"], b)), 3)["model"][0].as_py() for b in range(3)}
    buckets = {b: py.Bucket(m) for b, m in of.items()}
    counted, h = sum(b.counted() for b in buckets.values()), py.HEAD
    assert sum(len(b.q) for b in buckets.values()) > 100

    def totals():
        s = sum(b.summed() for b in buckets.values())
        return py.Totals(counted[:h], s[:h], s[h : 2 * h], float(s[h:].sum()), 20.0, 0.5, counted[2 * h + 1] + (counted[h : 2 * h] > 0).sum())

    seating, sent = {}, [(to, kind, b, data) for b, own in buckets.items() for to, kind, data in own.mail()]
    for _ in range(3):
        now, after = [], [totals()]
        for b, own in buckets.items():
            heard = tuple(np.frombuffer(b"".join(data for to, k, _, data in sorted(sent) if (to, k) == (b, kind)), "<u4").astype(float) for kind in (py.TABLES, py.CUSTOMERS))
            assert [len(v) for v in heard] == [len(own.r), len(own.q)]
            for _ in own.sweeps(b, after, seating.get(b), heard):
                pass
            seating[b] = own.state()
            now += [(to, kind, b, data) for to, kind, data in own.mail()]
        sent = now
        # tables by pair, as the contexts' buckets and as the words' buckets have them
        q = {(b, to, k): t for b, own in buckets.items() for to, k, t in zip(np.repeat(own.q_to, own.q_n).tolist(), [k for n in own.q_n.tolist() for k in range(n)], own.tq[own.q].tolist(), strict=True)}
        r = {(to, b, k): t for b, own in buckets.items() for to, k, t in zip(np.repeat(own.r_to, own.r_n).tolist(), [k for n in own.r_n.tolist() for k in range(n)], own.tr[own.r].tolist(), strict=True)}
        assert q == r and sum(t > 1 for t in q.values()) > len(q) / 4
        assert sum(b.tables_q.sum() for b in buckets.values()) == sum(b.parent_q.sum() for b in buckets.values())


@pytest.mark.parametrize("explicit", [1 << 14, 1])
def test_keyed_seats_follow_their_dish_and_have_the_exact_distribution(monkeypatch, explicit):
    monkeypatch.setattr(py, "EXPLICIT", explicit)
    n, new, d, m = 9, 1.5, 0.6, 3000 if explicit > 1 else 300
    keys = np.arange(m).astype(np.uint64) * py.END
    rng = np.random.default_rng(4)
    dishes = py.Dishes(rng, np.full(m, n), np.full(m, new), d, keys)
    some = py.Dishes(rng, np.append(np.full(50, n), 7), np.full(51, new), d, np.append(keys[50:100], py.BEGIN))
    got = np.zeros(n + 2)
    for k in range(25):
        dishes.sweep(rng, np.full(m, new), d)
        some.sweep(rng, np.full(51, new), d)
        assert (dishes.tables()[50:100] == some.tables()[:50]).all()
        if k >= 5:
            got += np.bincount(dishes.tables(), minlength=n + 2)
    want = ways(n, d) * new ** np.arange(n + 2)
    assert np.abs(got / got.sum() - want / want.sum()).max() < (0.015 if explicit > 1 else 0.06)
