from __future__ import annotations

import math
import random
import re

import numpy as np
import plain_spectra
import pytest
from pyspark.sql import functions as F

from psmlake.functions import decoy, peptide, scores
from psmlake.operators import annotate, coverage, crosstab, digest, engineer, filtering, folds, grubbs, qc, rollup, sequences, shared, sic_merge, spectral
from psmlake.schemas import MissingColumns


def one(spark, column, **values):
    names = list(values)
    row = spark.createDataFrame([tuple(values[n] for n in names)], ", ".join(f"{n} {'int' if isinstance(values[n], int) else 'double' if isinstance(values[n], float) else 'string'}" for n in names))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("name", "first", "some", "all_"), [("XXX_P1", 1, 1, 1), ("P1", 0, 0, 0), ("rev_P1", 0, 1, 0), ("XXX_P1;XXX_P2", 1, 1, 1), ("XXX_P1;P2", 1, 1, 0), (None, 0, 0, 0)])
def test_decoys(spark, name, first, some, all_):
    p = F.col("p")
    assert [one(spark, f(p), p=name) for f in (decoy.by_prefix, decoy.anywhere, decoy.all_of)] == [first, some, all_]


@pytest.mark.parametrize(("kind", "values", "want"), [("boolean", [True, False, None], [1, 0, 0]), ("string", ["True", "no", "yes"], [1, 0, 1]), ("int", [1, 0, None], [1, 0, 0])])
def test_is_decoy_of_any_type(spark, kind, values, want):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, is_decoy {kind}")
    assert [r.is_decoy for r in decoy.with_is_decoy(rows).orderBy("i").collect()] == want


@pytest.mark.parametrize(("text", "core", "both"), [("K.PEPM+15.99K.R", "PEPMK", "PEPMK"), ("-.PEP.-", "PEP", "PEP"), ("PEP.R", "PEP", "PEPR"), ("pep", "PEP", "PEP")])
def test_cores(spark, text, core, both):
    assert one(spark, peptide.core(F.col("p")), p=text) == core
    assert one(spark, peptide.core_both_flanks(F.col("p")), p=text) == both


def test_parsed_modifications():
    assert peptide.parsed("K.PEM+15.995C*K.R") == ("PEMCK", {2: 15.995, 3: 15.994915})
    assert peptide.parsed("+42.01PEP")[1] == {0: 42.01}
    assert peptide.parsed(None) == ("", {})


def test_scores_of_zero_and_missing(spark):
    assert one(spark, scores.msms_score(F.col("e")), e=0.0) == 0
    assert one(spark, scores.msms_score_strict(F.col("e")), e=0.0) is None
    assert one(spark, scores.msms_score(F.col("e")), e=1e-10) == pytest.approx(10)


def test_metric_directions_and_errors(spark):
    rows = spark.createDataFrame([(0.01, 10.0), (0.02, 9.0), (None, None)], "QValue double, MSMSScore double")
    assert filtering.metric_filter(rows, "QValue", 0.01).count() == 1
    assert filtering.metric_filter(rows, "MSMSScore").count() == 1
    assert filtering.metric_filter(rows, "xpec_q").count() == 3
    with pytest.raises(ValueError):
        filtering.metric_filter(rows, "nonsense")
    with pytest.raises(ValueError):
        filtering.metric_filter(rows, "MSGFScore")


def test_filter_needs_columns(spark):
    with pytest.raises(MissingColumns):
        filtering.filter_psms(spark.createDataFrame([(1.0,)], "MSMSScore double"), "QValue")


def test_best_per_scan_ties_and_nulls(spark):
    rows = spark.createDataFrame([("s", 1, 5.0, 2), ("s", 1, 5.0, 1), ("s", 1, None, 0), ("s", 2, None, 3)], "sample string, Scan int, ParentIonIntensity double, id int")
    assert {r.Scan: r.id for r in filtering.best_per_scan(rows, ["id"]).collect()} == {1: 1, 2: 3}


def test_shared_pairs_keep_a_row_for_each_scan(spark):
    psms = spark.createDataFrame([("s", 1, "A", "P1", 0.01, 0), ("s", 2, "A", "P1", 0.001, 0), ("s", 3, "B", "P2", 0.01, 0)], "sample string, Scan int, Peptide string, Protein string, QValue double, is_decoy int")
    syn = spark.createDataFrame([("s", 1, "A", "P1"), ("s", 1, "A", "P9"), ("s", 2, "A", "P9"), ("s", 3, "C", "P3"), ("s", 3, "B", "XXX_P2"), ("s", 3, "B", "XXX_P2")], "sample string, Scan int, Peptide string, Protein string")
    got = shared.merge_shared(psms, syn, ["Scan"]).where("Protein in ('P9', 'XXX_P2')").collect()
    assert sorted((r.Protein, r.Scan, r.QValue, r.is_decoy) for r in got) == [("P9", 2, 0.001, 0), ("P9", 2, 0.001, 0), ("XXX_P2", 3, 0.01, 1)]


def test_crosstab_drops_missing_and_takes_the_largest(spark):
    rows = spark.createDataFrame([(" A ", "K.A.R", "P", "s1", "10"), ("A", "K.A.R", "P", "s1", "20"), ("A", "K.A.R", None, "s1", "9"), ("A", "K.A.R", "P", "s2", "NA")], "Peptide string, PeptideFlanked string, Protein string, sample string, ParentIonIntensity string")
    assert [(r.Peptide, r.intensity) for r in crosstab.peptide_crosstab(rows).collect()] == [("A", 20.0)]


def test_function_and_gene(spark):
    got = one(spark, annotate.function_and_gene(F.col("d")), d="Heat shock COSMO protein OS=Homo sapiens GN=HSP1 PE=1")
    assert (got["function"], got["gene"]) == ("Heat shock COSMO protein", "HSP1")
    got = one(spark, annotate.function_and_gene(F.col("d"), compat=True), d="COSMO GN=X")
    assert (got["function"], got["gene"]) == ("C", "X")
    assert one(spark, annotate.function_and_gene(F.col("d")), d="")["function"] == "Unknown"


def test_coverage_overlap_flanks_and_modified(spark):
    proteins = spark.createDataFrame([("P", "MKAAAAKRAAK")], "Protein string, Sequence string")
    rows = spark.createDataFrame([("P", "s", "-.AA.-", 1.0), ("P", "s", "R.AA.K", 1.0), ("P", "s", "K.A+15.99A.A", 1.0), ("P", "t", "R.AA.Q", 1.0)], "Protein string, sample string, PeptideFlanked string, intensity double")
    got = {r.sample: (r.num_pep, r.coverage) for r in coverage.coverage(rows, proteins, min_num_pep=1).collect()}
    assert got["s"][0] == 3
    assert got["s"][1] == pytest.approx(100 * 6 / 11)
    assert got["t"] == (1, 0.0)


@pytest.mark.parametrize("n", range(6))
def test_hits_by_brute_force(n):
    rng = np.random.default_rng(n)
    sequence = "".join(rng.choice(list("AK"), 30))
    for core in ("A", "AA", "AKA", ""):
        for before in (None, "A", "K"):
            for after in (None, "K"):
                want = [i for i in range(len(sequence) - len(core) + 1) if core and sequence[i : i + len(core)] == core and (before is None or i > 0 and sequence[i - 1] == before) and (after is None or sequence[i + len(core) : i + len(core) + 1] == after)]
                assert list(coverage.hits(sequence, core, before, after)) == want


def test_cores_that_overlap_themselves():
    assert [c for c in ("A", "AB", "AA", "ABA", "ABCAB", "ABCD") if coverage.overlaps_itself(c)] == ["AA", "ABA", "ABCAB"]


def covered_plainly(rows, proteins):
    """{(protein, sample): (peptides, percent)} residue by residue."""
    out = {}
    for protein, sample in {(p, s) for p, s, *_ in rows}:
        sequence = proteins[protein].upper()
        peptides = {f for p, s, f in rows if (p, s) == (protein, sample)}
        marks = [False] * len(sequence)
        for f in peptides:
            before, core, after = (x.upper() for x in f.split("."))
            for i in range(len(sequence) - len(core) + 1):
                if sequence.startswith(core, i) and (before == "-" or sequence[:i].endswith(before)) and (after == "-" or sequence.startswith(after, i + len(core))):
                    marks[i : i + len(core)] = [True] * len(core)
        out[protein, sample] = (len(peptides), 100 * sum(marks) / len(marks))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_coverage_by_brute_force_in_any_parts(spark, parts):
    rng = np.random.default_rng(3)
    proteins = {f"P{k}": "".join(rng.choice(list("ACKr"), 60 if k else 2000)) for k in range(8)}
    flank = lambda: str(rng.choice(["-", "A", "K"]))
    rows = []
    for p, sequence in proteins.items():
        for _ in range(3 if p != "P0" else 200):
            at, n = rng.integers(0, len(sequence) - 6), rng.integers(1, 6)
            peptide = f"{flank()}.{sequence[at : at + n].upper()}.{flank()}"
            rows += [(p, str(s), peptide) for s in rng.choice(["s", "t", "u"], 2)]
    annotated = spark.createDataFrame([(*r, 1.0) for r in rows] + [("gone", "s", "-.A.-", 1.0), ("P1", "s", "-.C.-", 0.0)], "Protein string, sample string, PeptideFlanked string, intensity double")
    database = spark.createDataFrame([*proteins.items(), ("P9", ""), ("P10", None)], "Protein string, Sequence string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10 if parts > 1 else 10_000)
    try:
        got = {(r.Protein, r.sample): (r.num_pep, r.coverage) for r in coverage.coverage(annotated.repartition(parts), database, min_num_pep=1).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = covered_plainly(rows, proteins)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert {k: v[1] for k, v in got.items()} == pytest.approx({k: v[1] for k, v in want.items()})


@pytest.mark.parametrize("compat", [False, True])
def test_flanks_of_one_peptide_are_those_of_the_expression(spark, compat):
    texts = ["K.AC+57.02D.R", "-.ACD.-", "ACD", "k.acd.r", ".ACD.", "K.ACD", "ACD.R", "K.A.C.D.R", " K.ACD.R ", "", "1.ACD.2"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", peptide.flanks(F.col("t"), compat).alias("f")).collect()
    upper = lambda x: None if x is None else x.upper()
    # in compat mode only three parts have flanks, and an empty one is none
    assert {r.t: coverage.flanked(r.t, compat) for r in rows} == {r.t: (upper(r.f.before), upper(r.f.core), upper(r.f.after)) for r in rows}


def test_coverage_looks_into_the_sample_s_own_database(spark):
    proteins = spark.createDataFrame([("a", "P", "MKAA"), ("b", "P", "MKAAAAAA"), ("c", "P", "AA")], "database string, Protein string, Sequence string")
    databases = spark.createDataFrame([("one.fasta", "a"), (" TWO_rescored", "b")], "sample string, database string")
    rows = spark.createDataFrame([("P", s, "-.AA.-", 1.0) for s in ("One", "two", "three")], "Protein string, sample string, PeptideFlanked string, intensity double")
    got = {r.sample: r.coverage for r in coverage.coverage(rows, proteins, min_num_pep=1, databases=databases).collect()}
    assert got == {"One": 50.0, "two": 75.0}  # "three" has no database


@pytest.mark.parametrize(("sequence", "compat", "want"), [("AAAAAAKBBBBBBK", False, 3), ("AAAAAAKBBBBBBK", True, 4), ("AAAAAAKBBBBBB", False, 3)])
def test_digest(spark, sequence, compat, want):
    proteins = spark.createDataFrame([(sequence,)], "Sequence string")
    assert digest.candidate_peptides(proteins, 6, 40, 1, compat=compat).first()["n_peptides"] == want


def test_digest_any_substring(spark):
    proteins = spark.createDataFrame([("ABCDEFGH",), ("ABC",), (None,)], "Sequence string")
    assert digest.candidate_peptides(proteins, 6, 40, enzyme=0).first()["n_peptides"] == 3 + 2 + 1


def semi_specific(sequence, missed, low, high):
    pieces = [p for p in re.split(r"(?<=[KR])(?!P)", sequence) if p]
    runs = [sum(map(len, pieces[i:j])) for i in range(len(pieces)) for j in range(i + 1, (len(pieces) if missed < 0 else min(len(pieces), i + missed + 1)) + 1)]
    return sum(max(0, min(high, n) - low + 1) for n in runs)


@pytest.mark.parametrize("missed", [-1, 0, 2, 9])
def test_semi_specific_digest_counts_lengths_within_runs(spark, missed):
    rng = np.random.default_rng(8)
    sequences = ["".join(rng.choice(list("AKRPG"), n)) for n in (0, 1, 5, 40, 300)] + ["K" * 30]
    proteins = spark.createDataFrame([(s,) for s in [*sequences, None]], "Sequence string")
    got = digest.candidate_peptides(proteins, 3, 8, missed, termini=1).first()["n_peptides"]
    assert got == sum(semi_specific(s, missed, 3, 8) for s in sequences)



def test_grubbs_critical_values():
    # published two-sided values at 5 %
    for n, want in ((3, 1.1543), (5, 1.7150), (10, 2.2900), (20, 2.7082)):
        assert grubbs.critical(n, 0.05) == pytest.approx(want, abs=2e-4)
    assert math.isinf(grubbs.critical(2, 0.05))


def numpy_rollup(values, method, alpha=None):
    """values: peptides x samples with nan, raw."""
    logs = np.where(values > 0, np.log2(np.where(values > 0, values, 1)), np.nan)
    if method == "rrollup":
        if len(logs) > 1:
            missing = np.isnan(logs).sum(1)
            middle = np.nanmedian(logs, 1)
            ref = min(range(len(logs)), key=lambda i: (missing[i], -middle[i], i))
            moved = []
            for i, row in enumerate(logs):
                both = ~np.isnan(row) & ~np.isnan(logs[ref])
                moved.append(row if i == ref else row + np.median(logs[ref][both] - row[both]) if both.any() else row * np.nan)
            logs = np.array(moved)
            if alpha is not None:
                for j in range(logs.shape[1]):
                    col = logs[:, j]
                    ok = np.flatnonzero(~np.isnan(col))
                    if len(ok) >= 3 and col[ok].std(ddof=1) > 0:
                        far = np.abs(col[ok] - col[ok].mean())
                        if far.max() / col[ok].std(ddof=1) > grubbs.critical(len(ok), alpha):
                            logs[ok[far.argmax()], j] = np.nan
        return 2 ** np.nanmedian(logs, 0)
    if method == "qrollup":
        means = np.nanmean(logs, 1)
        return 2 ** np.nanmean(logs[means >= np.percentile(means, 100 * 2 / 3)], 0)
    z = (logs - np.nanmean(logs, 1, keepdims=True)) / np.nanstd(logs, 1, ddof=1, keepdims=True)
    return np.nanmedian(z, 0)


@pytest.mark.parametrize(("method", "alpha"), [("rrollup", None), ("rrollup", 0.05), ("qrollup", None), ("zrollup", None)])
def test_rollups_against_numpy(spark, method, alpha):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for p in range(6):
        values = rng.lognormal(10, 1, (4 + p, 5))
        values[rng.random(values.shape) < 0.15] = np.nan
        values[0] = rng.lognormal(10, 1, 5)
        if p == 2:
            values[1, 3] = 1e12
        want[f"P{p}"] = numpy_rollup(values, method, alpha)
        rows += [(f"P{p}", f"pep{i}", f"pep{i}", f"s{j}", float(values[i, j]), True) for i in range(len(values)) for j in range(5) if not np.isnan(values[i, j])]
    table = spark.createDataFrame(rows, "Protein string, PeptideFlanked string, Peptide string, sample string, intensity double, Unique boolean")
    got = {(r.Protein, r.sample): r.value for r in rollup.rollup_values(table, method, outlier_alpha=alpha).collect()}
    for p, values in want.items():
        for j, v in enumerate(values):
            assert got[p, f"s{j}"] == pytest.approx(v, rel=1e-9)


def test_rollup_unknown_method(spark):
    with pytest.raises(ValueError):
        rollup.rollup_values(spark.createDataFrame([], "Protein string, PeptideFlanked string, sample string, intensity double"), "mean")


def test_z_rollup_needs_two_peptides(spark):
    rows = spark.createDataFrame([("P", "a", "a", "s1", 5.0, True), ("P", "a", "a", "s2", 6.0, True)], "Protein string, PeptideFlanked string, Peptide string, sample string, intensity double, Unique boolean")
    assert [r.value for r in rollup.rollup_values(rows, "zrollup").collect()] == [None, None]


def test_sic_merge_widths_and_repeats(spark):
    hits = spark.createDataFrame([("s", 1, "A"), ("s", 2, "B")], "sample string, Scan int, Peptide string")
    scans = spark.createDataFrame([("s", n, n / 7, "MS", 1.0, 1.0, 1.0) for n in (1, 2, 3, 9)], "sample string, ScanNumber int, ScanTime double, ScanType string, TotalIonIntensity double, BasePeakIntensity double, BasePeakMZ double")
    sics = spark.createDataFrame([("s", 1, 2, *[1.0] * 7, 1, 9), ("s", 2, 2, *[1.0] * 7, 1, 8)], "sample string, FragScanNumber int, OptimalPeakApexScanNumber int, PeakMaxIntensity double, PeakSignalToNoiseRatio double, FWHMInScans double, PeakArea double, ParentIonIntensity double, MZ double, StatMomentsArea double, PeakScanStart int, PeakScanEnd int")
    got = {r.Scan: r.PeakWidthMinutes for r in sic_merge.merge_sics(hits, scans, sics).collect()}
    assert got == {1: round(8 / 7, 4), 2: 0.0}
    with pytest.raises(sic_merge.RepeatedKey):
        sic_merge.merge_sics(hits, scans.union(scans), sics)


def test_sequences(spark):
    records = spark.createDataFrame([(0, "A", "first", "MK"), (1, "B", "b", "MK"), (2, "A", "last", "RR")], "ord long, Protein string, Description string, Sequence string")
    assert {r.Protein: r.Sequence for r in sequences.joined_by_id(records).collect()} == {"A": "MKRR", "B": "MK"}
    assert {r.Protein: r.Description for r in sequences.last_by_id(records).collect()} == {"A": "last", "B": "b"}
    assert sorted(r.ord for r in sequences.without_redundancy(records).collect()) == [0, 2]


def test_folds_keep_scans_together_and_classes_even(spark):
    rows = spark.createDataFrame([(s, d) for s in range(60) for d in ((0,), (1,), (0, 1))[s % 3]], "OptimalScanNumber int, is_decoy int")
    got = folds.with_folds(rows, 5).collect()
    assert all(len({r.fold for r in got if r.OptimalScanNumber == s}) == 1 for s in range(60))
    scans = {(r.OptimalScanNumber, r.fold) for r in got}
    for kind in range(3):
        counts = [sum(1 for s, f in scans if s % 3 == kind and f == k) for k in range(5)]
        assert max(counts) - min(counts) <= 1


def test_learned_features_see_training_rows_only(spark):
    schema = "Peptide string, Charge int, is_decoy int, MSGFDB_SpecEValue double, DelM_PPM double, sample string, OptimalScanNumber int"
    train = engineer.stateless(spark.createDataFrame([("K.AAA.R", 2, 0, 1e-10, 1.0, "s", 1), ("K.CCC.R", 2, 0, 1e-20, 3.0, "s", 2), ("K.DDD.R", 2, 1, 1e-5, -9.0, "s", 3)], schema))
    test = engineer.stateless(spark.createDataFrame([("K.AAA.R", 2, 0, 1e-99, 50.0, "s", 4), ("K.NEW.R", 2, 0, 1e-98, 60.0, "s", 5), ("K.NEW.R", 3, 1, 1e-2, -7.0, "s", 5)], schema))
    got = {(r.PeptideCore, r.is_decoy): r for r in engineer.transform(test, engineer.fit(train)).collect()}
    a, new, decoy = got["AAA", 0], got["NEW", 0], got["NEW", 1]
    assert (a.pep_best_specev, new.pep_best_specev, decoy.pep_best_specev) == (pytest.approx(10), pytest.approx(12.5), pytest.approx(5))
    assert (a.pep_n_observations, new.pep_n_observations) == (pytest.approx(np.log(2)), 0.0)
    assert a.pep_score_relative_to_best == pytest.approx(89)
    assert a.mass_error_zscore == pytest.approx(47 / (np.std([1, 3, 9]) + 1e-6))  # of absolute errors, decoys too
    assert decoy.mass_error_zscore == pytest.approx(7 / (1 + 1e-6))  # a charge that was not seen
    assert (a.peptide_reliability, new.peptide_reliability) == (pytest.approx(10 / (1 + 1e-6)), 0.0)
    assert (new.peptide_best_score, new.peptide_median_score) == (pytest.approx(17.5), pytest.approx(15))
    assert (a.is_best_for_peptide, a.peptide_observation_count) == (1, 1)
    assert a.specEval_pctrank_in_class == 0.5  # three rows are too few for a class
    assert (new.delta_score, a.delta_score, a.is_singleton_scan) == (pytest.approx(96), -1.0, 1)


def test_missing_evalues_count_as_a_tenth_of_the_smallest(spark):
    rows = spark.createDataFrame([("AA", 1e-8, "s"), ("AA", 0.0, "s"), ("AA", None, "s"), ("AA", 1e-3, "t"), ("AA", 0.0, "u")], "Peptide string, MSGFDB_SpecEValue double, sample string")
    got = sorted(round(r.neg_log_specEvalue, 6) for r in engineer.stateless(rows, rank=True).collect())
    assert got == [3.0, 8.0, 9.0, 9.0, 101.0]


def test_balanced_and_paired_features(spark):
    rows = spark.createDataFrame([("K.ACWPE.R", 0.2, 0.5, 3, 5, 4.0, 2.0, "s")], "Peptide string, b_ion_coverage double, y_ion_coverage double, longest_b_series int, longest_y_series int, DelM_PPM double, mean_fragment_mass_error_ppm double, sample string")
    r = engineer.stateless(rows).first()
    assert (r.by_coverage_ratio, r.by_ion_balance) == (pytest.approx(0.2 / (0.5 + 1e-6)), pytest.approx(0.3))
    assert (r.series_length_ratio, r.precursor_fragment_error_ratio) == (1.0, pytest.approx(4 / 3))
    assert r.c_half_hydro == 0.0  # W, P and E; C counts, W does not


def test_spectral_features_by_hand():
    # GAG K: b1 58.03 and y fragments; all b and y ions above 100 are there
    own = spectral.chem.residue_masses("GAGK", {})
    b, y = spectral.chem.fragments(own)
    mz = np.sort(np.concatenate([b[1:], y, [250.0]]))
    got = spectral.features("R.GAGK.A", 2, mz, np.full(len(mz), 10.0))
    assert got["spectral_feature_error"] is None
    assert (got["num_matched_b_ions"], got["num_matched_y_ions"]) == (2, 3)
    assert (got["b_ion_coverage"], got["y_ion_coverage"]) == (1.0, 1.0)
    assert (got["longest_b_series"], got["longest_y_series"]) == (2, 3)
    assert got["num_complementary_ion_pairs"] == 2
    assert got["complementary_ion_ratio"] == pytest.approx(2 / 5)
    assert got["matched_intensity_fraction"] == pytest.approx(5 / 6)
    assert got["spectral_angle"] == pytest.approx(np.arccos((5 / 6) ** 0.5), abs=1e-6)  # five of six equal peaks explained
    assert abs(got["mean_fragment_mass_error_ppm"]) < 1e-6


@pytest.mark.parametrize("ppm", [False, True])
@pytest.mark.parametrize("compat", [False, True])
def test_spectral_features_against_plain_steps(ppm, compat):
    rng = np.random.default_rng(3)
    peptides, charges, mzs, heights, precursors, ms1s, want = [], [], [], [], [], [], []
    tolerance = 60.0 if ppm else 0.05
    for _ in range(150):
        core = "".join(rng.choice(list("GASPVTCLNDQKEMHFRYWX"), rng.integers(2, 18)))
        at = int(rng.integers(0, len(core)))
        mods = {at: 15.994915} if rng.random() < 0.4 else {}
        text = core[: at + 1] + "+15.994915" + core[at + 1 :] if mods else core
        masses = spectral.chem.residue_masses(core, mods)
        told = np.concatenate([*spectral.chem.fragments(masses), *spectral.chem.fragments(masses, 2)])
        near = told[rng.random(len(told)) < 0.6]
        near = near + rng.normal(0, 0.03, len(near))
        mz = np.concatenate([near, rng.uniform(50, 2000, rng.integers(0, 90)), near[:3]])
        mz = mz if len(mz) else np.array([500.0])
        height = np.round(rng.gamma(1, 50, len(mz)), 3) + np.arange(len(mz)) * 1e-6 + 0.001
        charge, precursor = int(rng.integers(1, 5)), float(rng.uniform(300, 900))
        ms1 = [(precursor + k * 1.003355 / charge + rng.normal(0, 0.012), float(rng.gamma(2, 50))) for k in range(3)] + [(float(rng.uniform(200, 1200)), 5.0) for _ in range(5)]
        peptides.append(f"K.{text}.R")
        charges.append(charge)
        mzs.append(mz)
        heights.append(height)
        precursors.append(precursor)
        ms1s.append(ms1)
        want.append(plain_spectra.plain(core, mods, charge, list(zip(mz.tolist(), height.tolist(), strict=True)), precursor, ms1, tolerance, ppm, compat))
    got = spectral.batch_features(peptides, np.array(charges), mzs, heights, np.array(precursors), [np.array([p[0] for p in m]) for m in ms1s], [np.array([p[1] for p in m]) for m in ms1s], tolerance, ppm, compat)
    for i, w in enumerate(want):
        assert got["spectral_feature_error"][i] is None
        for c, v in w.items():
            assert got[c][i] == pytest.approx(v, rel=1e-6, abs=1e-7), (i, c)


@pytest.mark.parametrize(("mz", "intensity", "peptide_", "error"), [(None, None, "PEPK", "scan_not_found"), ([], [], "PEPK", "empty_spectrum"), ([1.0], [1.0], "P", "peptide_too_short"), ([1.0], [], "PEPK", "missing_spectrum_data")])
def test_spectral_errors_are_values(mz, intensity, peptide_, error):
    assert spectral.features(peptide_, 2, mz, intensity)["spectral_feature_error"] == error


def test_coverage_of_benchmark_takes_all_languages_and_benchmark_words(spark, tmp_path):
    from psmlake.queries import relational

    docs = [(1, "Ein Haus, zwei Hausboote", "de", "s"), (2, "haus", None, "s"), (3, "nothing here", "en", "t"), (4, None, "en", "t")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "Haus! BOOT")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.Protein: (r.sample, r.num_pep, r.coverage) for r in relational.coverage_of_benchmark(spark, str(tmp_path)).collect()}
    assert got == {"1": ("s", 1, pytest.approx(100 * 8 / 20, abs=1e-5)), "2": ("s", 1, 100.0)}


def test_density_curve_near_the_kernel_estimate(spark):
    rng = np.random.default_rng(5)
    values = {"a": rng.normal(3, 2, 400), "b": rng.exponential(4, 150), "c": np.full(7, 5.0)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in values.items() for v in vs] + [("a", None), ("a", float("nan"))], "g string, v double")
    got = qc.density_curve(df, "v", ("g",), points=400).toPandas()
    for g, vs in values.items():
        own = got[got.g == g].sort_values("point")
        h = np.std(vs, ddof=1) * len(vs) ** -0.2 or 1.0
        assert own.bandwidth.iloc[0] == pytest.approx(h)
        want = np.exp(-0.5 * ((own.x.to_numpy()[:, None] - vs) / h) ** 2).sum(1) / (len(vs) * h * np.sqrt(2 * np.pi))
        assert np.abs(own.density.to_numpy() - want).max() < 0.002 * want.max()
        assert np.trapezoid(own.density, own.x) == pytest.approx(1, abs=0.01)
    alone = qc.density_curve(df.where("g = 'a'"), "v", points=50)
    assert alone.count() == 50 and qc.density_curve(df.where("g = 'z'"), "v").count() == 0


def test_top_rollup_holds_the_means_against_their_own_bound(spark):
    # every evaluation gives other last digits, as sums in another order do; the third of four means is the bound and stays
    jitter = F.udf(lambda x: x * (1 + 1e-9 * random.random()), "double").asNondeterministic()
    rows = spark.createDataFrame([(f"P{p}", f"pep{i}", f"s{j}", 1000.0 * 2**i) for p in range(40) for i in range(4) for j in range(3)], "Protein string, PeptideFlanked string, sample string, intensity double")
    got = rollup.rollup_values(rows.withColumn("intensity", jitter("intensity")), "qrollup").collect()
    assert len(got) == 120 and all(r.value == pytest.approx(1000 * 2**2.5, rel=1e-6) for r in got)


def test_sic_merge_broadcasts_no_lookup_table(spark, capsys):
    samples = F.explode(F.array(*[F.lit(s) for s in "ab"])).alias("sample")
    scans = spark.range(9).select(samples, F.col("id").alias("ScanNumber"), *[F.lit(1.0).alias(c) for c in ("ScanTime", "TotalIonIntensity", "BasePeakIntensity", "BasePeakMZ")], F.lit("MS").alias("ScanType"))
    sics = spark.range(9).select(samples, F.col("id").alias("FragScanNumber"), *[F.lit(1.0).alias(c) for c in sic_merge.FROM_SICS if not c.startswith("PeakScan")], F.col("id").alias("PeakScanStart"), F.col("id").alias("PeakScanEnd"))
    hits = spark.range(9).select(F.lit("a").alias("sample"), F.col("id").alias("Scan"))
    sic_merge.merge_sics(hits, scans, sics).explain()
    plan = capsys.readouterr().out
    assert plan.count("SortMergeJoin") == 4 and "Broadcast" not in plan


def test_coelution_counts_crowded_times_without_meeting_them(spark):
    rng = np.random.default_rng(3)
    own, seen = rng.integers(0, 40, 60) / 4, rng.integers(0, 40, 300) / 4  # many equal ones, and ends that meet times
    rows = spark.createDataFrame([("s", k, float(t)) for k, t in enumerate(own)] + [("s", 60, None), ("none", 61, 1.0)], "sample string, id int, t double")
    times = spark.createDataFrame([("s", float(t)) for t in seen], "sample string, value double").groupBy("sample", "value").agg(F.count("*").alias("n"))
    got = {r.id: r.rt_coelution_density for r in engineer.coelution(rows, times, F.col("t"), F.lit(0.5)).collect()}
    assert got == {k: int((abs(seen - t) <= 0.5).sum()) for k, t in enumerate(own)} | {60: 0, 61: 0}
