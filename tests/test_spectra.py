"""Spectra of many rows at once: by matrices as by plain sorting, and without an order of spectra."""

from __future__ import annotations

import numpy as np
import pytest

from psmlake.functions import chem
from psmlake.operators import spectral


@pytest.mark.parametrize("lengths", [(7, 7, 7), (9, 6, 0, 8), (1, 40, 2, 3)])
def test_rows_of_any_length_sort_alike(monkeypatch, lengths):
    rng = np.random.default_rng(3)
    mz, height = ([rng.integers(1, 9, n).astype(float) for n in lengths] for _ in range(2))
    chosen = rng.integers(0, 2, sum(lengths)).astype(bool)
    told = lambda p: [p.mz.tolist(), p.intensity.tolist(), p.medians(chosen, 1.0).tolist(), p.largest(3).tolist()]
    got = told(spectral.Peaks(mz, height))
    monkeypatch.setattr(spectral, "_wide", lambda *_: None)
    assert got == told(spectral.Peaks(mz, height))


@pytest.mark.parametrize("charge", [1, 2])
def test_ions_of_long_and_short_peptides(charge):
    rng = np.random.default_rng(4)
    masses = [rng.uniform(50, 200, n) for n in (0, 1, 2, 33, 5, 31, 32, 90)]
    for k, kind in enumerate("by"):
        ions = spectral.Ions(masses, kind, charge, 0.0)
        want = [x.tolist() if len(m) else [] for m in masses for x in [chem.fragments(m, charge)[k]]]
        assert [ions.mz[ions.row == r].tolist() for r in range(len(masses))] == want


def test_spectra_are_not_sorted_for_their_psms(spark):
    psms = spark.createDataFrame([(i, "s", i // 2, "K.ACDEK.R", 2) for i in range(9)], "psm_id long, sample string, Scan long, Peptide string, Charge int")
    spectra = spark.createDataFrame([("s", i, [200.0, 300.0], [1.0, 2.0], 500.0) for i in range(4)], "sample string, scan long, mz array<double>, intensity array<double>, precursor_mz double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = spectral.extract(psms, spectra, tolerance=0.5)
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
        assert {r.psm_id: r.spectral_feature_error for r in found.collect()} == {**dict.fromkeys(range(8)), 8: "scan_not_found"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
