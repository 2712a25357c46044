"""The jobs: whole results, reruns, growing input, failures between two writes."""

from __future__ import annotations

import json
import re
from collections import Counter

import pytest
from jobs import common, sample_report, sequence_index
from pyspark.sql import functions as F

from psmlake.operators import digest

PSM = "sample string, Scan long, Charge int, Peptide string, Protein string, score double, ParentIonIntensity double, is_decoy int"


def psms(spark, samples, shift=0):
    rows = [(s, i // 2, 2, f"PEP{i % 7}", f"Q{i % 5}", float((i * 37 + shift) % 101), float(i % 13), int(i % 9 == 0)) for s in samples for i in range(80)]
    return spark.createDataFrame(rows, PSM)


def rows_of(df):
    return sorted(tuple(sorted(r.asDict().items())) for r in df.collect())


SETTINGS = {**sample_report.DEFAULTS, "tie": ["Peptide", "Protein", "score"], "psm_q": 0.2, "peptide_q": 0.5}


def test_report_twice_and_one_sample_replaced(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    psms(spark, ["a", "b"]).write.parquet(source)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    first = rows_of(sample_report.run(spark, source, out, SETTINGS))
    assert first and {dict(r)["sample"] for r in first} == {"a", "b"}
    assert rows_of(sample_report.run(spark, source, out, SETTINGS)) == first
    later = str(tmp_path / "later")
    psms(spark, ["b", "c"], 5).write.parquet(later)
    now = rows_of(sample_report.run(spark, later, out, SETTINGS))
    assert [r for r in now if dict(r)["sample"] == "a"] == [r for r in first if dict(r)["sample"] == "a"]
    alone = rows_of(sample_report.run(spark, later, str(tmp_path / "other"), SETTINGS))
    assert [r for r in now if dict(r)["sample"] != "a"] == alone
    assert {r["sample"]: r["n_scans"] for r in spark.read.parquet(f"{out}/summary").collect()} == {"a": 40, "b": 40, "c": 40}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_report_says_what_is_missing(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="lacks sample"):
        sample_report.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), SETTINGS)


def plain_index(sequences, missed, low, high):
    holders, places = Counter(), Counter()
    for s in {s.upper() for s in sequences if s}:
        pieces = [p for p in re.split(r"(?<=[KR])(?!P)", s) if p]
        found = Counter("".join(pieces[i : i + k + 1]) for k in range(missed + 1) for i in range(len(pieces) - k))
        for p, n in found.items():
            if low <= len(p) <= high:
                holders[p] += 1
                places[p] += n
    return {p: (holders[p], places[p]) for p in holders}


def shown(df):
    return {r.peptide: (r.n_sequences, r.n_places) for r in df.collect()}


INDEX = {**sequence_index.DEFAULTS, "columns": {"id": "id", "sequence": "upper(sequence)"}, "missed": 2, "min_length": 2, "max_length": 12}
FIRST = ["AAKCCRPDDKAAK", "aakccrpddkaak", "MMMM", None, "", "KKKKRR", "GGGKAAK" * 9]
SECOND = ["AAKCCRPDDKAAK", "AAKPPRVVVK", "MMMM", "NNNKAAK"]


def sequences(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t) for i, t in enumerate(texts)], "id long, sequence string").coalesce(1)


def test_index_over_growing_input(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    sequences(spark, FIRST).write.parquet(source)
    assert shown(sequence_index.run(spark, source, out, mark, INDEX)) == plain_index(FIRST, 2, 2, 12)
    assert shown(sequence_index.run(spark, source, out, mark, INDEX)) == plain_index(FIRST, 2, 2, 12)  # nothing new
    sequences(spark, SECOND, 100).write.mode("append").parquet(source)
    assert shown(sequence_index.run(spark, source, out, mark, INDEX)) == plain_index(FIRST + SECOND, 2, 2, 12)
    told = spark.read.parquet(f"{out}/sequences")
    assert told.count() == told.select("digest").distinct().count() == len({s.upper() for s in FIRST + SECOND if s})
    assert {r.batch for r in told.select("batch").distinct().collect()} == {0, 1}


def test_index_batch_again_after_a_failure(spark, tmp_path, monkeypatch):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    sequences(spark, FIRST).write.parquet(source)
    sequence_index.run(spark, source, out, mark, INDEX)
    sequences(spark, SECOND, 100).write.mode("append").parquet(source)
    write = sequence_index.write

    def fails(df, path):
        if path.endswith("sequences"):
            raise RuntimeError("lost")
        write(df, path)

    monkeypatch.setattr(sequence_index, "write", fails)
    with pytest.raises(Exception, match="lost"):
        sequence_index.run(spark, source, out, mark, INDEX)
    monkeypatch.setattr(sequence_index, "write", write)
    assert shown(sequence_index.run(spark, source, out, mark, INDEX)) == plain_index(FIRST + SECOND, 2, 2, 12)


def test_index_of_a_table_that_is_one_file(spark, tmp_path):
    source = tmp_path / "in"
    sequences(spark, FIRST).write.parquet(str(source))
    part = next(source.glob("part-*.parquet"))
    (tmp_path / "all").mkdir()
    one = part.rename(tmp_path / "all" / "data base.parquet")
    (tmp_path / "all" / "other.parquet").write_bytes(one.read_bytes()[:4])  # not read
    args = (str(one), str(tmp_path / "out"), str(tmp_path / "mark"), INDEX)
    assert shown(sequence_index.run(spark, *args)) == shown(sequence_index.run(spark, *args)) == plain_index(FIRST, 2, 2, 12)


def test_index_of_nothing(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    sequences(spark, [None, ""]).write.parquet(source)
    assert shown(sequence_index.run(spark, source, out, mark, INDEX)) == {}


def test_peptides_of_a_sequence(spark):
    got = spark.createDataFrame([("AAKCCRPDDKAAK",), ("",), (None,), ("MM",)], "s string").select("s", digest.peptides(F.col("s"), 1, 1, 2, 10).alias("p")).collect()
    assert {r.s: sorted(r.p or []) for r in got} == {"AAKCCRPDDKAAK": sorted(["AAK", "CCRPDDK", "AAK", "AAKCCRPDDK", "CCRPDDKAAK"]), "": [], None: [], "MM": ["MM"]}


def test_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"missed": 3}))
    assert common.config(path, sequence_index.DEFAULTS)["missed"] == 3
    path.write_text(json.dumps({"mised": 3}))
    with pytest.raises(ValueError, match="mised"):
        common.config(path, sequence_index.DEFAULTS)
    for job in (sample_report, sequence_index):
        assert common.config(job.CONFIG, job.DEFAULTS)


@pytest.mark.parametrize("job", [sample_report, sequence_index])
def test_command_line_starts_and_stops_one_session(spark, tmp_path, monkeypatch, job):
    stopped, seen = [], {}
    monkeypatch.setattr(type(spark), "stop", lambda self: stopped.append(1))
    monkeypatch.setattr(job, "run", lambda session, *args: seen.update(args=args))
    argv = ["--out", "o", *(["--psms", "p"] if job is sample_report else ["--sequences", "s", "--checkpoint", "c"])]
    job.main(argv)
    assert stopped == [1] and seen["args"][:2] == (("p", "o") if job is sample_report else ("s", "o"))


def test_index_works_out_a_batch_once_and_adds_up_only_several(spark, tmp_path, monkeypatch):
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    plans, write = [], sequence_index.write
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(sequence_index, "write", lambda df, path: plans.append(plan(df)) or write(df, path))
    sequences(spark, FIRST).write.parquet(source)
    one = sequence_index.run(spark, source, out, mark, INDEX)
    assert shown(one) == plain_index(FIRST, 2, 2, 12) and "Exchange" not in plan(one)
    sequences(spark, SECOND, 100).write.mode("append").parquet(source)
    two = sequence_index.run(spark, source, out, mark, INDEX)
    assert shown(two) == plain_index(FIRST + SECOND, 2, 2, 12) and "Exchange" in plan(two)
    assert len(plans) == 4 and all("InMemoryTableScan" in p for p in plans)
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
