"""Coverage is dealt to more tasks where files are larger, with the same result."""

from __future__ import annotations

import random

from psmlake.operators import coverage, lineage


def test_larger_files_get_more_tasks(spark, monkeypatch):
    found = lineage.cut(spark.createDataFrame([(f"p{i % 20}", "s", f"K.A{'CDEF'[i % 4]}.R", 1.0) for i in range(80)], "Protein string, sample string, PeptideFlanked string, intensity double"))
    proteins = lineage.cut(spark.createDataFrame([(f"p{i}", "MKACRKADRKAERKAFR") for i in range(20)], "Protein string, Sequence string"))
    usual = coverage.coverage(found, proteins, min_num_pep=1)
    monkeypatch.setattr(lineage, "PART_BYTES", 200)
    more = coverage.coverage(found, proteins, min_num_pep=1)
    assert more.rdd.getNumPartitions() == lineage.parts_for(found.join(proteins, "Protein")) > 4
    assert sorted(more.collect()) == sorted(usual.collect())


def test_many_peptides_are_sought_at_once(monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice("ABC") for _ in range(700)) + "ABCABCABCABCA" * 5
    cores = {text[i : i + n] for n in (*range(1, 14), 60) for i in (rng.randrange(690) for _ in range(3))} | {"ABCABCABC", "ABA", "ZZ", "ABCABCABCZ", "Z" * 12}
    for block in (7, 64, 1 << 16):
        monkeypatch.setattr(coverage, "BLOCK", block)
        for some in (cores, {c for c in cores if len(c) > 7}, {"ABCABCABCABC", "CABC"}):
            mark, want = bytearray(len(text)), bytearray(len(text))
            for core in some:
                for at in coverage.hits(text, core, None, None):
                    want[at : at + len(core)] = b"\x01" * len(core)
            coverage.mark_all(text.encode(), [c.encode() for c in some], mark)
            assert mark == want


def test_coverage_is_the_same_for_few_and_many_peptides(spark, monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choice("ACDKR") for _ in range(300))
    cores = [text[i : i + n] for n in range(1, 12) for i in (rng.randrange(290) for _ in range(4))]
    rows = [("p", s, f"{a}.{c}.{b}", 1.0) for c in cores for s, a, b in (("x", "-", "-"), ("y", "K", "-"), ("y", "-", "-"))] + [("q", "x", "-.AA.-", 1.0), ("none", "x", "-.AA.-", 1.0)]
    found = spark.createDataFrame(rows, "Protein string, sample string, PeptideFlanked string, intensity double")
    proteins = spark.createDataFrame([("p", ""), ("p", text.lower()), ("p", None), ("q", "AAA"), ("empty", ""), (None, "AAA")], "Protein string, Sequence string")
    many = sorted(coverage.coverage(found, proteins, min_num_pep=1).collect())
    assert [r[:3] for r in many] == [("p", "x", len(set(cores))), ("p", "y", 2 * len(set(cores))), ("q", "x", 1)]
    marks = bytearray(len(text))
    for core in cores:
        for at in coverage.hits(text, core, None, None):
            marks[at : at + len(core)] = b"\x01" * len(core)
    assert many[0].coverage == many[1].coverage == 100.0 * sum(marks) / len(text) and many[2].coverage == 100.0
