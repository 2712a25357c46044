from __future__ import annotations

import base64
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from psmlake import cli, preflight
from psmlake.operators import coverage, filtering
from psmlake.schemas import MissingColumns
from psmlake.sources import fasta, mzml, project, sinks, tsv
from psmlake.streaming.resume import run_new_files

HEAD = "Scan\tCharge\tPeptide\tProtein\tQValue\tMSGFDB_SpecEValue\n"


def test_tsv_types_tokens_and_samples(spark, tmp_path):
    (tmp_path / "run_1_fht_PlusSICStats.txt").write_text(HEAD + "1\t2\tK.A.R\tP1\tNA\t1e-5\n2\tx\tK.A.R\t\t0.01\tnan\n")
    (tmp_path / "run_2_fht_PlusSICStats.txt").write_text(HEAD + "7\t2\tK.A.R\tP1\t0.5\t1e-9\n")
    rows = tsv.read_first_hits(spark, str(tmp_path)).orderBy("sample", "Scan").collect()
    assert [(r.sample, r.Scan, r.Charge, r.Protein, r.QValue, r.MSGFDB_SpecEValue) for r in rows] == [("run_1", 1, 2, "P1", None, 1e-5), ("run_1", 2, None, None, 0.01, None), ("run_2", 7, 2, "P1", 0.5, 1e-9)]


def test_tsv_needs_its_columns(spark, tmp_path):
    (tmp_path / "a_syn.txt").write_text("Scan\tPeptide\n1\tA\n")
    with pytest.raises(MissingColumns):
        tsv.read_synopsis(spark, str(tmp_path))


def test_filterable_prefers_withsyn_and_keeps_other_samples(spark, tmp_path):
    for name, p in (("a_withsyn.tsv", "W"), ("a.tsv", "N"), ("b.tsv", "N")):
        (tmp_path / name).write_text(f"Peptide\tProtein\nX\t{p}\n")
    assert {(r.sample, r.Protein) for r in tsv.read_filterable(spark, str(tmp_path)).collect()} == {("a", "W"), ("b", "N")}


def test_fasta(spark, tmp_path):
    (tmp_path / "db.fasta").write_text(">A one OS=Homo GN=G1\nMKV\nLLK\n>B\nPEP\n>A two GN=G2\nQQ\n")
    path = str(tmp_path / "db.fasta")
    assert {r.Protein: r.Sequence for r in fasta.protein_sequences(spark, path).collect()} == {"A": "MKVLLKQQ", "B": "PEP"}
    info = {r.Protein: (r.Gene, r.Function) for r in fasta.protein_info(spark, path).collect()}
    assert info == {"A": ("G2", "two GN=G2"), "B": ("Unknown", "Unknown")}
    fasta.write_fasta(fasta.read_records(spark, path), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text.startswith(">A one OS=Homo GN=G1\nMKVLLK\n>B\nPEP")


def binary(values, name, accession):
    data = base64.b64encode(zlib.compress(np.asarray(values, "<f8").tobytes())).decode()
    return f'<binaryDataArray><cvParam accession="MS:1000523"/><cvParam accession="MS:1000574"/><cvParam accession="{accession}" name="{name}"/><binary>{data}</binary></binaryDataArray>'


def spectrum(scan, level, seconds, mz, intensity, precursor=None):
    selected = f'<selectedIon><cvParam accession="MS:1000744" value="{precursor}"/></selectedIon>' if precursor else ""
    return (
        f'<spectrum index="{scan - 1}" id="controller=0 scan={scan}"><cvParam accession="MS:1000511" value="{level}"/><scan><cvParam accession="MS:1000016" value="{seconds}" unitAccession="UO:0000010"/></scan>{selected}'
        f'<binaryDataArrayList>{binary(mz, "m/z array", "MS:1000514")}{binary(intensity, "intensity array", "MS:1000515")}</binaryDataArrayList></spectrum>'
    )


def test_mzml(spark, tmp_path):
    body = spectrum(1, 1, 60, [100.0, 200.0], [1.0, 2.0]) + spectrum(2, 2, 66, [150.5], [9.0], 500.25) + spectrum(3, 1, 120, [], []) + spectrum(4, 2, 126, [1.0], [1.0])
    (tmp_path / "run.mzML").write_text(f'<?xml version="1.0"?><mzML xmlns="http://psi.hupo.org/ms/mzml"><run><spectrumList>{body}</spectrumList></run></mzML>')
    got = {r.scan: r for r in mzml.read_mzml(spark, str(tmp_path)).collect()}
    assert (got[1].rt, got[1].mz, got[1].intensity) == (1.0, [100.0, 200.0], [1.0, 2.0])
    assert (got[2].ms1_scan, got[2].precursor_mz, got[4].ms1_scan, got[1].ms1_scan) == (1, 500.25, 3, None)
    assert mzml.read_mzml(spark, str(tmp_path), ms_level=1).count() == 2
    both = {r.scan: r.ms1.mz for r in mzml.with_ms1(mzml.read_mzml(spark, str(tmp_path))).collect()}
    assert both == {2: [100.0, 200.0], 4: []}


def test_project_files(spark, tmp_path):
    (tmp_path / "conf").write_text("# all\na = 1 # kept\nb=2\n#c = 3\nnone\n")
    assert project.parse_conf(tmp_path / "conf") == {"a": "1 # kept", "b": "2"}
    assert project.parse_conf(tmp_path / "missing") == {}
    raw, db = tmp_path / "raw", tmp_path / "db"
    raw.mkdir()
    db.mkdir()
    with pytest.raises(ValueError):
        project.update_manifest(raw, db, tmp_path / "m.tsv")
    (raw / "s1.raw").touch()
    (db / "ref.fasta").write_text(">A\nMK\n")
    assert project.update_manifest(raw, db, tmp_path / "m.tsv") == [{"msfilename": "s1", "protein_input": "s1", "database": "ref.fasta", "QCplot": "s1_tic"}]
    assert project.update_manifest(raw, db, tmp_path / "m.tsv")[0]["database"] == "ref.fasta"
    manifest = project.read_manifest(spark, str(tmp_path / "m.tsv"))
    files = project.spectrum_files(manifest, ["/x/s1.mgf", "/x/s1.mzML", "/x/s2.mzML"])
    assert [r.spectrum_file for r in files.collect()] == ["s1.mzML"]
    assert {(r.kind, r.name) for r in project.unmatched(manifest, ["other.fasta"], []).collect()} == {("database", "ref.fasta"), ("raw", "s1")}
    assert project.database_parts(["d_part10.fasta", "d_part2.faa", "e_part1.fasta"], "d") == [(2, "d_part2.faa"), (10, "d_part10.fasta")]
    with pytest.raises(ValueError):
        project.pair_parts(["r_part1.tsv"], [(1, "a"), (2, "b")])


def test_sample_columns_of_a_foreign_table(spark):
    rows = spark.createDataFrame([("A", "1", "0", "5", "x"), ("B", "2", "0", "6", "y")], "Protein string, s1 string, zero string, s_mean string, note string")
    assert coverage.guessed_samples(rows) == ["s1", "zero", "s_mean", "note"]
    assert coverage.guessed_samples(rows, "numeric") == ["s1", "zero"]
    assert coverage.guessed_samples(rows, "varied") == ["s1"]


def test_natural_order_and_missing_text(spark, tmp_path):
    assert sorted(["s10", "s2", "S1"], key=sinks.natural_key) == ["S1", "s2", "s10"]
    sinks.export_report(spark.createDataFrame([("P", None)], "Protein string, s1 double"), str(tmp_path / "r"))
    text = next((tmp_path / "r").glob("part-*")).read_text()
    assert text == "Protein\ts1\nP\tNA\n"


def test_new_files_only(spark, tmp_path):
    folder, seen = tmp_path / "in", []
    folder.mkdir()
    schema = "Scan string, Peptide string"
    from pyspark.sql import types as T

    run = lambda: run_new_files(spark, str(folder), "*.tsv", T.StructType.fromDDL(schema), lambda df, _: seen.extend(r.Peptide for r in df.collect()), str(tmp_path / "check"))
    (folder / "a.tsv").write_text("Scan\tPeptide\n1\tA\n")
    run()
    (folder / "b.tsv").write_text("Scan\tPeptide\n1\tB\n")
    run()
    assert seen == ["A", "B"]


def make_project(base):
    layout = project.ProjectLayout.at(base)
    layout.ensure(layout.input, layout.database, layout.first_hits, layout.synopsis)
    (layout.database / "ref.fasta").write_text(">P1 alpha OS=X GN=GA\nMKAAAAKRAAKLLLLKEEEEK\n>P2 beta OS=X GN=GB\nMKAAAAKCCCCK\n>P3 gamma\nDDDD\n")
    head = "\t".join(("Scan", "Charge", "PrecursorMZ", "DelM", "DelM_PPM", "MH", "Peptide", "Protein", "MSGFDB_SpecEValue", "QValue", "PepQValue", "ElutionTime", "ParentIonIntensity", "OptimalScanNumber"))
    for s, scale in (("one", 1), ("two", 2)):
        rows = [(1, 2, 400, 0, 1, 800, "K.AAAAK.R", "P1", 1e-12, 0.001, 0.001, 10, 5000 * scale, 1), (1, 2, 400, 0, 1, 800, "K.AAAAK.R", "P1", 1e-12, 0.001, 0.001, 10, 100, 1), (2, 2, 400, 0, -2, 800, "K.LLLLK.E", "P1", 1e-11, 0.002, 0.002, 11, 7000 * scale, 2), (3, 2, 400, 0, 1, 800, "K.DDDD.-", "XXX_P3", 1e-3, 0.004, 0.3, 12, 9000, 3), (4, 2, 400, 0, 1, 800, "K.CCCCK.-", "Contaminant_P2", 1e-9, 0.001, 0.001, 12, 9000, 4)]
        (layout.first_hits / f"{s}_fht_PlusSICStats.txt").write_text(head + "\n" + "\n".join("\t".join(map(str, r)) for r in rows) + "\n")
    (layout.synopsis / "one_syn.txt").write_text("Scan\tPeptide\tProtein\n1\tK.AAAAK.R\tP1\n1\tK.AAAAK.R\tP2\n")
    return layout


def test_quantify_from_files_to_report(spark, tmp_path, monkeypatch):
    make_project(tmp_path)
    monkeypatch.setattr(spark, "stop", lambda: None)
    assert cli.main(["quantify", "--base", str(tmp_path), "--num-pep", "1"]) == 0
    report = next((tmp_path / "output/rollup/report").glob("part-*")).read_text().splitlines()
    names = report[0].split("\t")
    rows = {r.split("\t")[0]: dict(zip(names, r.split("\t"), strict=True)) for r in report[1:]}
    assert set(rows) == {"P1", "P2"}
    assert (rows["P1"]["one"], rows["P1"]["two"], rows["P1"]["Gene"], rows["P1"]["peptide_number"]) == ("12000.0", "24000.0", "GA", "2")
    assert (rows["P2"]["one"], rows["P2"]["two"]) == ("5000.0", "0.0")
    covered = next((tmp_path / "output/coverage/coverage").glob("part-*")).read_text()
    assert "P1" in covered


def test_cli_codes(tmp_path, capsys):
    with pytest.raises(SystemExit):
        cli.main(["--help"])
    with pytest.raises(SystemExit):
        cli.main(["quantify", "--base", str(tmp_path), "--rollup", "mean"])
    assert cli.main(["check", "--base", str(tmp_path), "--for", "quantify"]) == 1
    assert "[fail]" in capsys.readouterr().out


def test_preflight_of_a_project(tmp_path):
    layout = make_project(tmp_path)
    assert preflight.run(layout, "quantify").passed
    layout.manifest.parent.mkdir(exist_ok=True)
    layout.manifest.write_text("msfilename\tdatabase\tQCplot\ns\tnone.fasta\tx\n")
    failed = [c.name for c in preflight.run(layout, "search").checks if c.status is preflight.Status.FAIL]
    assert failed == ["manifest databases"]
    with pytest.raises(ValueError):
        preflight.run(layout, "nonsense")
    with pytest.raises(FileNotFoundError):
        layout.require(layout.rescored)


def read_in_order(folder):
    """Rows of all files of a folder, the files one after the other by name, without their headers."""
    return [line.split("\t") for f in sorted(folder.glob("part-*.csv")) for line in f.read_text().splitlines()[1:]]


def test_files_one_after_the_other_are_in_order(spark, tmp_path):
    rows = [(i, float(i * 7919 % 1000) if i % 50 else None, f"P{i % 13}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, MSMSScore double, Protein string").repartition(5)
    order = filtering.report_order(df, ["id"])
    sinks.export_tsv(df, str(tmp_path / "r"), missing="NA", single=False, order=order)
    assert len(list((tmp_path / "r").glob("part-*.csv"))) > 1
    got = read_in_order(tmp_path / "r")
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[2], r[0]))
    assert [int(g[0]) for g in got] == [w[0] for w in want]
    assert [g[1] for g in got if g[1] == "NA"] == ["NA"] * 60
    sinks.export_report(df, str(tmp_path / "one"), order=order)
    assert read_in_order(tmp_path / "one") == got


def test_each_sample_s_file_is_in_order(spark, tmp_path):
    df = spark.createDataFrame([("ab"[i % 2], i * 37 % 101) for i in range(100)], "sample string, v int").repartition(4)
    sinks.export_tsv(df, str(tmp_path / "r"), by_sample=True, order=["v"])
    for s in "ab":
        got = [int(r[0]) for r in read_in_order(tmp_path / "r" / f"sample={s}")]
        assert len(got) == 50 and got == sorted(got)
