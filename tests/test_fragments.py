"""Matching by joins against the plain steps, modifications, ties and both tolerances included."""

from __future__ import annotations

import numpy as np
import plain_spectra
import pytest
from pyspark.sql import functions as F

from psmlake.functions import chem, peptide
from psmlake.operators import fragments

PEPTIDES = ["K.ACDEFGHIK.R", "K.+42.011ACM+15.995DK.R", "PEPT*IDE@R", "K.AC+57.021DX+1.5-0.5K.-", "K.A.R", "K.GGGGGGGG.R", "acdK"]


@pytest.mark.parametrize("ppm", [False, True])
def test_figures_equal_the_plain_steps(spark, ppm):
    rng = np.random.default_rng(6)
    tolerance = 900.0 if ppm else 0.4
    rows, spectra, want = [], [], {}
    for i in range(40):
        p = PEPTIDES[i % len(PEPTIDES)]
        residues, mods = peptide.parsed(p)
        near = [x + rng.normal(0, 0.3) for kind in plain_spectra.ions(residues, mods, 1, 100.0) for _, x in kind for _ in range(2)]
        mz = np.round(sorted([*near, *rng.uniform(100, 900, 30)]), 2)
        height = rng.integers(1, 900, len(mz)).astype(float)
        rows.append((i, "s", i, p))
        spectra.append(("s", i, mz.tolist(), height.tolist()))
        if len(residues) > 1:
            want[i] = plain_spectra.plain(residues, mods, 2, list(zip(mz.tolist(), height.tolist(), strict=True)), 500.0, [(500.0, 1.0)], tolerance, ppm, False)
    rows.append((99, "s", 99, PEPTIDES[0]))  # no spectrum
    psms = spark.createDataFrame(rows, "psm_id long, sample string, Scan long, Peptide string")
    found = fragments.match_figures(psms, spark.createDataFrame(spectra, "sample string, scan long, mz array<double>, intensity array<double>"), tolerance=tolerance, ppm=ppm)
    got = {r.psm_id: r.asDict() for r in found.collect()}
    assert len(got) == 41 and got[99]["num_matched_ions_total"] == 0 and got[99]["total_ion_current"] == 0
    for i, w in want.items():
        for c in found.columns[1:]:
            assert got[i][c] == pytest.approx(w[c], abs=1e-9), (i, c)


def test_ladder_by_parsed_masses(spark):
    rows = spark.createDataFrame([(p,) for p in [*PEPTIDES, "", "123", None]], "p string").select("p", fragments.residue_masses(F.col("p")).alias("m"), fragments.ladder(F.col("p"), 0.0).alias("l")).collect()
    for r in rows:
        masses = chem.residue_masses(*peptide.parsed(r.p))
        assert (r.m or []) == pytest.approx(masses.tolist())
        b, y = chem.fragments(masses) if len(masses) else ([], [])
        assert [i.mz for i in r.l or [] if i.kind == "b"] == pytest.approx(list(b)) and [i.mz for i in r.l or [] if i.kind == "y"] == pytest.approx(list(y))


def test_left_neighbour_before_the_nearer_one(spark):
    ions = spark.createDataFrame([("s", 1, 200.0), ("s", 2, 300.0), ("s", 3, 400.0)], "sample string, number int, mz double")
    peaks = spark.createDataFrame([("s", 199.7, 1.0, 0), ("s", 199.8, 2.0, 1), ("s", 200.01, 3.0, 2), ("s", 300.0, 4.0, 3), ("s", 300.0, 5.0, 4), ("s", 400.5, 6.0, 5)], "sample string, mz double, intensity double, ord int")
    got = {r.number: r.peak.intensity for r in fragments.matched(ions, peaks, ("sample",), ("number",), 0.4).collect()}
    assert got == {1: 2.0, 2: 4.0}


def test_nearest_from_both_sides(spark):
    rng = np.random.default_rng(1)
    peaks = [(g, float(x), float(h)) for g in (1, 2) for x, h in zip(np.unique(rng.integers(0, 100, 40)), rng.integers(1, 99, 40), strict=False)]
    targets = [(g, k, float(x)) for g in (1, 2, 3) for k, x in enumerate(rng.integers(-5, 210, 60) / 2)]
    got = fragments.nearest(spark.createDataFrame(targets, "g int, k int, mz double"), spark.createDataFrame(peaks, "g int, mz double, intensity double"), ("g",), ("k",)).collect()
    assert len(got) == len(targets)
    for r in got:
        own = [p for p in peaks if p[0] == r.g]
        if not own:
            assert r.peak is None and r.off == float("inf")
        else:
            best = min(own, key=lambda p: (abs(p[1] - r.mz), p[1]))  # of two as near the lower
            assert (r.peak.mz, r.peak.intensity, r.off) == (best[1], best[2], abs(best[1] - r.mz))


def test_ions_and_peaks_cross_no_exchange_one_by_one(spark):
    psms = spark.createDataFrame([(i, "s", i, PEPTIDES[i % 7]) for i in range(40)], "psm_id long, sample string, Scan long, Peptide string")
    spectra = spark.createDataFrame([("s", i, [100.0 + k for k in range(50)], [float(k) for k in range(50)]) for i in range(40)], "sample string, scan long, mz array<double>, intensity array<double>")
    found = fragments.match_figures(psms, spectra, tolerance=0.4)
    plan = found._jdf.queryExecution().toString()
    assert "Generate" not in plan and "Explode" not in plan
    assert found.count() == 40
