"""A batch's ions are sought at once: the same ions by the same sums as the expression's, the same peaks as a plain search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from psmlake.operators import fragments
from psmlake.queries import features

PEPTIDES = ["K.ACDEFGHIK.R", "K.+42.011ACM+15.995DK.R", "PEPT*IDE@R", "K.A.R", "K.GGGGGGGG.R", "acdK", "", None, "K." + "GASPVTC" * 40 + ".R", "K.AC+57.021DX+1.5-0.5K.-", "acdK"]


def test_ladders_of_a_batch(spark):
    rows = spark.createDataFrame(list(enumerate(PEPTIDES)), "i int, p string").select("i", fragments.ladder(F.col("p")).alias("l")).orderBy("i").collect()
    row, is_y, mz = fragments._ladders(PEPTIDES)
    want = [(r.i, x.kind == "y", x.mz) for r in rows for x in r.l or []]
    assert list(zip(row.tolist(), is_y.tolist(), strict=True)) == [w[:2] for w in want]
    assert np.abs(mz - [w[2] for w in want]).max() < 1e-10


def test_peaks_of_a_batch():
    rng = np.random.default_rng(3)
    near = fragments._ladders(["K.ACDEFGHIK.R"])[2]
    mz = [np.sort(np.concatenate([near + rng.choice([-1e-9, 0.0, 1e-9, 0.3, -0.4, 0.5], len(near)), rng.uniform(100, 900, k)])) for k in rng.integers(0, 40, 300)]
    mz[7], mz[8], mz[9] = [], None, mz[9][::-1]
    high = [None if x is None else rng.integers(1, 900, len(x)).astype(float).tolist() for x in mz]
    high[11] = high[11][:-3]
    mz[12] = [None, *mz[12][1:]]
    of = pa.list_(pa.float64())
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(["K.ACDEFGHIK.R"] * 300), pa.array(mz, of), pa.array(high, of)], names=["id", "p", "mz", "intensity"])
    got = next(fragments._met(iter([batch]), 1, 0.5, False)).to_pylist()
    kinds = fragments._ladders(["K.ACDEFGHIK.R"])[1]
    for r, own, h in zip(got, mz, high, strict=True):
        peaks = sorted((x, i, h[i] if i < len(h) else None) for i, x in enumerate(own if own is not None else []) if x is not None)
        hits = {False: [], True: []}
        for y, x in zip(kinds, near, strict=True):
            close = [p for p in peaks if abs(p[0] - x) <= 0.5]
            below = [p for p in close if p[0] < x]
            if close:
                hits[bool(y)].append((max(below) if below else min(close))[2])
        assert (r["nb"], r["ny"], r["tic"]) == (len(hits[False]), len(hits[True]), sum(h or []))
        for c, kind in (("ib", False), ("iy", True)):
            assert r[c] == pytest.approx(0.0 if None in hits[kind] else sum(hits[kind]))


def test_spectra_of_the_queries_are_made_once_a_kind(spark):
    rows, spectra = features._spectra(spark, "/root/testdata/sf0.001")
    plan = spectra._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (0, 97" in plan and "Range (0, 1013" in plan
    for r in spectra.limit(50).collect():
        assert r.mz == [100.0 + k * 7.3 + (r.scan * k % 97) / 10 for k in range(1, 121)] and r.intensity == [10.0 + r.scan * k * k % 1013 for k in range(1, 121)]
    assert spectra.count() == rows.select("sample", "Scan").distinct().count()
