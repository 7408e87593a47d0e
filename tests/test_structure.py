"""Read structure: runs, matches, flanks, fragments; simulated reads come back as they were made."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom.operators import assess, labelers, simulate, structure
from readloom.plans import config

FULL = ["5p", "CBC", "UMI", "polyT", "cDNA", "3p"]
S = structure.Segments((("5p", "5"), ("CBC", "C"), ("UMI", "U"), ("polyT", "T"), ("cDNA", "D"), ("3p", "3"), ("polyA", "A")), (tuple(FULL), ("5p", "CBC", "UMI", "cDNA", "3p")), ("CBC",))


def test_matches_have_what_the_definition_asks():
    """Every match is the pattern, none overlap, and nothing between them holds another one."""
    rng = random.Random(3)
    for _ in range(3000):
        order = "".join(rng.choice("5CUTD3") for _ in range(rng.randrange(12)))
        pattern = "".join(rng.choice("5CD") for _ in range(rng.randrange(1, 4)))
        got = structure.find(order, pattern, "D")
        flanks = re.fullmatch("(D*)(.*?)(D*)", order)
        begin, end = flanks.end(1), flanks.start(3)
        free = begin  # where the next match may start: after the last one and its inserts
        for a, z in got:
            assert order[a : z + 1] == pattern and a >= free and z < end
            assert pattern not in order[free : z]  # none that ends before this one does
            free = z + 1 + len(re.match("D*", order[z + 1 : end])[0])
        assert pattern not in order[free:end]


@pytest.mark.parametrize(("order", "valid", "orientation", "reason"), [
    ("5CUTD3", True, "+", "valid"), ("3DTUC5", True, "-", "valid"), ("5CUD3", True, "+", "valid"), ("D5CUTD3", True, "+", "valid"),
    ("5CUTD35CUTD3", False, "+", "concatenated reads x2 (+:2)"), ("5CUTD33DTUC5", False, "+", "concatenated reads x2 (+:1, -:1)"),
    ("5CUTD3DTUC5", False, "+", "concatenated reads x2 (+:1, -:1)"), ("5CUTD3C", False, "+", "concatenated reads x1 (+:1) — extra segments: [CBC]"),
    ("5D", False, "", "Unexpected pattern: [5p_cDNA]"), ("", False, "", "Unexpected pattern: []"), ("5CUD35CUTD3", False, "+", "concatenated reads x2 (+:2)"),
])
def test_judge(order, valid, orientation, reason):
    assert structure.judge(order, S)[:3] == (valid, orientation, reason)


@pytest.mark.parametrize(("order", "s", "e", "inner"), [
    ("D5CUTD3", (0,), (), (5,)), ("5CUTD3D", (), (6,), (4,)), ("D5CUTD3D", (0,), (7,), (5,)),
    ("D3DTUC5", (), (0,), (2,)), ("3DTUC5D", (6,), (), (1,)), ("D3DTUC5D", (7,), (0,), (2,)), ("5CUTD35CUTD3", (), (), (4, 10)),
])
def test_flanks(order, s, e, inner):
    at = dict(zip(structure.listed(S), structure.places(order, S), strict=True))
    assert (at["random_s"], at["random_e"], at["cDNA"]) == (s, e, inner)


def test_runs(spark):
    rows = [("a", "AAAAAA", "55CCCT"), ("b", "ACG", "555"), ("c", "", ""), ("d", "ACGT", "ATAT")]
    got = {r.ReadName: (r.order, r.run_starts, r.run_ends) for r in structure.with_runs(spark.createDataFrame(rows, "ReadName string, read string, labels string"), "labels", S).collect()}
    assert got["a"] == ("5CT", [0, 2, 5], [2, 5, 6]) and got["b"] == ("5", [0], [3]) and got["c"][1:] == ([], [])
    assert got["d"] == ("TTTT", [0, 1, 2, 3], [1, 2, 3, 4])  # the tails count as one, neighbours stay apart


def test_simulated_reads_are_recovered(spark):
    lib = {"libraries": {"l": {"strand": "fwd", "barcodes": ["CBC"], "umis": ["UMI"], "segments": [{"name": n, "pattern": p} for n, p in zip(FULL, ["CTACACGACGCTCTTCCGATCT", "N16", "N12", "T", "NN", "CCCATGTACTCTGCGTTG"], strict=True)], "valid_structures": [FULL, [n for n in FULL if n != "polyT"]],
        "training_structures": {"single": {"order": FULL, "proportion": 0.5}, "back": {"order": FULL, "proportion": 0.25, "rc_pattern": ["rev"]}, "two": {"order": FULL, "repeat": 2, "rc_pattern": ["fwd", "rev"], "proportion": 0.25}}}}, "models": {"m": {"library": "l"}}}
    plans, library = config.structures(lib, "m"), config.library(lib, "m")
    none = simulate.Noise(0, 0, 0, 0, 0)
    sims = simulate.simulate(spark, plans, 80, none, simulate.Shape(spacer=(5, 20)), seed=4).cache()
    s = structure.Segments.of(library.names, library.valid, library.barcodes, library.known_adapters())
    done = structure.annotate(sims.withColumn("labels", structure.as_codes(F.col("labels"), s)), s, split=True)
    acc = {r.structure_type: r for r in assess.structure_accuracy(sims, structure.valid_reads(done)).collect()}
    assert all(r.n_correct == r.n_reads and r.recovered == r.expected for r in acc.values()) and set(acc) == {"single", "back", "two"}
    rows = done.where("architecture = 'valid'").collect()
    assert all(d == 0 for r in rows for d in [*r["5p_edit_dist"], *r["3p_edit_dist"]])
    assert all(r["CBC_Sequences"] == r.read[r.CBC_Starts[0] : r.CBC_Ends[0]] and len(r["CBC_Sequences"]) == 16 for r in rows)
    twins = simulate.simulate(spark, plans, 10, none, twins=True, seed=4).collect()
    by = {r.ReadName: r for r in twins}
    assert all(simulate.reverse_complement(by[f"sim_{k}"].read) == by[f"sim_{k}_rc"].read and by[f"sim_{k}"].labels[::-1] == by[f"sim_{k}_rc"].labels for k in range(10))
    noisy = simulate.simulate(spark, plans, 20, seed=4).collect()
    assert all(len(r.read) == len(r.labels) for r in noisy)


def test_orientation_of_patterns():
    assert simulate.change("AACG", "fwd", "rev") == "CGTT" and simulate.change("AACG", "fwd", "reverse") == "GCAA"
    assert simulate.change(simulate.change("AACG", "fwd", "rev"), "rev", "reverse") == "GCAA"
    assert simulate.change("GCAA", "reverse", "rev") == "CGTT" and simulate.change("A", "fwd", "rev") == "T" and simulate.change("N16", "fwd", "rev") == "N16"


def test_adapter_labels(spark):
    read = "GG" + "CTACACGACG" + "ACGTACGT" + "TTTTTTTT" + "GATTACAGAT" + "CCCATG" + "A"
    rows = spark.createDataFrame([("r", read), ("none", "ACGT")], "ReadName string, read string")
    got = {r.ReadName: r.labels for r in labelers.by_adapters(rows, {"5p": "CTACACGACG", "3p": "CCCATG"}, {"CBC": 4, "UMI": 4}, FULL, "polyT").collect()}
    assert got["r"] == ["cDNA"] * 2 + ["5p"] * 10 + ["CBC"] * 4 + ["UMI"] * 4 + ["polyT"] * 8 + ["cDNA"] * 10 + ["3p"] * 6 + ["cDNA"] and got["none"] == ["cDNA"] * 4


def test_model_labels(spark):
    rows = spark.createDataFrame([("r", "ACGTN"), ("s", "AC")], "ReadName string, read string")
    got = {r.ReadName: r.labels for r in labelers.with_model(rows, lambda: lambda codes: codes % 2, ["x", "y"]).collect()}
    assert got == {"r": ["y", "x", "y", "x", "y"], "s": ["y", "x"]}
    assert labelers.padded_width(999) == 1012 and labelers.padded_width(999, [(25, 1), (9, 4)]) == 1016


def test_every_transcript_can_be_drawn(spark, tmp_path):
    """150 000 records, of which a third come after the first 100 000, give a third of the inserts."""
    from readloom.sources import fastx

    (tmp_path / "fa").mkdir()
    (tmp_path / "fa/t.fa").write_text("".join(f">t{k:06d}\n{'A' * 40 if k < 100_000 else 'G' * 40}\n" for k in range(150_000)))
    one = simulate.Structure("one", ("5p", "cDNA", "3p"), ("CTACACGACGCTCTTCCGATCT", "NN", "CCCATGTACTCTGCGTTGATACCACTGCTT"), 1.0)
    source = fastx.read_sequences(spark, str(tmp_path / "fa")).select("ReadName", "read")
    draw = lambda rows: {r.ReadName: r.read for r in simulate.simulate(spark, [one], 300, simulate.Noise(0, 0, 0, 0), simulate.Shape((20, 30), (0, 0)), rows, seed=3).collect()}
    got = draw(source)
    assert len(got) == 300 and got == draw(source.repartition(7))
    late = sum("G" * 20 in x for x in got.values())
    assert 60 < late < 140 and sum("A" * 20 in x for x in got.values()) == 300 - late
    numbered, total = simulate._numbered(source)
    assert total == 150_000 and sorted(r.number for r in numbered.select("number").collect()) == list(range(total))
    assert [r.read[0] for r in numbered.where("number in (99999, 100000)").orderBy("number").collect()] == ["A", "G"]
    assert simulate.simulate(spark, [one], 5, transcripts=source.limit(0), seed=3).count() == 5


def test_noise_has_its_rates():
    rng = np.random.default_rng(5)
    labels = ["5p"] * 20_000 + ["cDNA"] * 5_000 + ["polyT"] * 10_000
    seq = "".join(rng.choice(list("ACGT"), len(labels)))
    share = lambda read, marks, label: sum(m == label for m in marks) / labels.count(label)
    read, marks = simulate.with_noise(rng, seq, labels, simulate.Noise(0, 0.2, 0, 0.1, 1))
    assert len(read) == len(marks) and abs(share(read, marks, "5p") - 1.2) < 0.02 and share(read, marks, "cDNA") == 1
    read, marks = simulate.with_noise(rng, seq, labels, simulate.Noise(0, 0.5, 0, 0, 3))
    assert abs(share(read, marks, "5p") - (1 + 0.5 * (1 + 0.5 + 0.25))) < 0.03
    read, marks = simulate.with_noise(rng, seq, labels, simulate.Noise(0, 0, 0.3, 0, 1))
    assert abs(share(read, marks, "5p") - 0.7) < 0.02 and share(read, marks, "polyT") == 1
    read, marks = simulate.with_noise(rng, seq, labels, simulate.Noise(0.25, 0, 0, 0, 1))
    assert marks == labels and abs(np.mean([a != b for a, b in zip(read[:20_000], seq, strict=False)]) - 0.25) < 0.02 and read[20_000:] == seq[20_000:]
    assert simulate.with_noise(rng, "", [], simulate.Noise()) == ("", [])


def test_a_structure_may_have_its_own_insert_lengths(spark):
    one = simulate.Structure("one", ("5p", "cDNA"), ("CTACACG", "NN"), length_range=(7, 9))
    rows = simulate.simulate(spark, [one], 40, simulate.Noise(0, 0, 0, 0), simulate.Shape((100, 200), (0, 0)), seed=1).collect()
    assert {len(r.read) - 7 for r in rows} == {7, 8}


def test_cut_ends_are_no_inserts(spark):
    rng = np.random.default_rng(2)
    one = simulate.Structure("one", ("5p", "cDNA", "3p"), ("C" * 30, "NN", "G" * 30))
    shape = simulate.Shape((50, 60), (0, 0), 10, 20)
    sizes = [(m.count("5p"), m.count("3p"), m.count("cDNA")) for _, m in (simulate.assemble(rng, one, shape, lambda n: "A" * n) for _ in range(300))]
    assert {a for a, _, _ in sizes} == set(range(20, 31)) and {b for _, b, _ in sizes} == set(range(10, 31)) and {c for *_, c in sizes} <= set(range(50, 60))
