"""Fragment and isotope matching: ion ladders as prefix sums, matching within a row's arrays or as an interval join, a two-sided as-of join.

The figures that need no more than matched peaks, for tables whose spectra are rows or arrays already, and to hold spectral.py's batches against.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from psmlake.functions import chem, peptide
from psmlake.functions.arrays import let, total
from psmlake.operators.spectral import CHIMERIC, ISOTOPE_PER_DALTON, ISOTOPE_REACH, MOST_ISOTOPE

#: A residue with what is written behind it; before the first one, what is written there too.
_RESIDUE = r"(?:^[^A-Za-z]+)?[A-Za-z][^A-Za-z]*"
_MASS = r"[+-][0-9]+(?:\.[0-9]*)?|[+-]\.[0-9]+"
#: What matching tells of a PSM: ions of either kind, total intensity, matched ions and their intensity.
_FIGURES = ("__b", "__y", "tic", "nb", "ib", "ny", "iy")


def residue_masses(written: Column) -> Column:
    """Masses of a peptide's residues, modifications with the residue before them; flanks on both sides go, letters that name no residue weigh 0."""
    text = F.trim(written)
    inner = F.regexp_extract(text, r"^[A-Za-z-]\.(.+)\.[A-Za-z-]$", 1)
    parts = F.regexp_extract_all(F.when(inner != "", inner).otherwise(text), F.lit(_RESIDUE), F.lit(0))

    def mass(part: Column) -> Column:
        own = peptide.lookup(F.upper(F.regexp_extract(part, "[A-Za-z]", 0)), chem.RESIDUES)
        put_on = total(F.transform(F.regexp_extract_all(part, F.lit(_MASS), F.lit(0)), lambda m: m.cast("double")))
        for mark, m in peptide.MARKS.items():
            put_on = put_on + m * (F.length(part) - F.length(F.replace(part, F.lit(mark), F.lit(""))))
        return own + put_on

    return F.transform(parts, mass)


def ladder(written: Column, smallest: float = chem.SMALLEST_FRAGMENT) -> Column:
    """Singly charged b and y ions above `smallest`: array of struct(kind, number, mz), from one array of prefix sums."""

    def ions(sums: Column) -> Column:
        n = F.size(sums) - 1
        numbers = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
        at = lambda k: F.element_at(sums, k + 1)
        b = F.transform(numbers, lambda k: F.struct(F.lit("b").alias("kind"), k.alias("number"), (at(k) + chem.PROTON).alias("mz")))
        y = F.transform(numbers, lambda k: F.struct(F.lit("y").alias("kind"), k.alias("number"), (at(n) - at(n - k) + chem.WATER + chem.PROTON).alias("mz")))
        return F.filter(F.concat(b, y), lambda i: i["mz"] > smallest)

    start = F.array(F.lit(0.0))
    sums = F.aggregate(residue_masses(written), start, lambda a, m: F.concat(a, F.array(F.element_at(a, -1) + m)))
    return let(sums, ions)


def _width(mz: Column, tolerance: float, ppm: bool) -> Column:
    return mz * (tolerance * 1e-6) if ppm else F.lit(float(tolerance))


def _bucket(mz: Column, tolerance: float, ppm: bool) -> Column:
    """Buckets as wide as the tolerance, by the logarithm for one in ppm: what is within it lies in the own bucket or beside it."""
    return F.floor(F.ln(mz) / -math.log1p(-tolerance * 1e-6) if ppm else mz / tolerance).cast("long")


def matched(ions: DataFrame, peaks: DataFrame, by: Sequence[str], keys: Sequence[str], tolerance: float = chem.TOLERANCE, ppm: bool = False) -> DataFrame:
    """`keys` of the ions (by, keys, mz) that a peak (by, mz, intensity, ord) is within the tolerance of, with `peak`: the largest below the ion's m/z, else the smallest from it on.

    An equi-join on spectrum and bucket: an ion asks its own bucket and the two beside it, a peak stands in one.
    """
    asked = ions.select(*by, *[c for c in keys if c not in by], F.col("mz").alias("__told"), F.explode(F.array(*[_bucket(F.col("mz"), tolerance, ppm) + k for k in (-1, 0, 1)])).alias("__bucket"))
    seen = peaks.select(*by, F.struct("mz", "ord", "intensity").alias("__peak"), _bucket(F.col("mz"), tolerance, ppm).alias("__bucket"))
    close = asked.join(seen, [*by, "__bucket"]).where(F.abs(F.col("__peak.mz") - F.col("__told")) <= _width(F.col("__told"), tolerance, ppm))
    below = F.col("__peak.mz") < F.col("__told")
    out = close.groupBy(*keys).agg(F.max(F.when(below, F.col("__peak"))).alias("__low"), F.min(F.when(~below, F.col("__peak"))).alias("__high"))
    return out.select(*keys, F.coalesce("__low", "__high").alias("peak"))


def exploded(spectra: DataFrame) -> DataFrame:
    """(sample, Scan, mz, intensity, ord) of spectra with arrays."""
    return spectra.select("sample", F.col("scan").alias("Scan"), F.posexplode(F.arrays_zip("mz", "intensity")).alias("ord", "p")).select("sample", "Scan", "p.mz", "p.intensity", "ord")


def _ladders(peptides: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, whether y, mz) of ladder()'s ions, in its order and by its sums."""
    place = {p: i for i, p in enumerate(dict.fromkeys(peptides))}
    masses = [chem.residue_masses(*peptide.parsed(p)) for p in place]
    size = np.array([len(m) for m in masses], np.int64)
    kinds, mz, of = [], [], []
    for part in np.unique(size >> 5):  # sums along the rows of a matrix, of peptides of like length
        own = np.flatnonzero(size >> 5 == part)
        n = size[own]
        sums = np.zeros((len(own), int(n.max()) + 1))
        sums[:, 1:][np.arange(n.max()) < n[:, None]] = np.concatenate([masses[i] for i in own])
        sums = np.cumsum(sums, axis=1)
        inner = np.maximum(0, n - 1)
        row = np.repeat(np.arange(len(own)), inner)
        number = np.arange(len(row)) - (np.cumsum(inner) - inner)[row] + 1
        mz += [sums[row, number] + chem.PROTON, sums[row, n[row]] - sums[row, n[row] - number] + chem.WATER + chem.PROTON]
        kinds += [np.zeros(len(row), bool), np.ones(len(row), bool)]
        of += [own[row]] * 2
    kind, told, which = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((kinds, bool), (mz, float), (of, np.int64)))
    keep = told > chem.SMALLEST_FRAGMENT
    kind, told, which = kind[keep], told[keep], which[keep]
    order = np.argsort(which * 2 + kind, kind="stable")
    count = np.bincount(which, minlength=len(masses))
    ask = np.array([place[p] for p in peptides], np.int64)
    row = np.repeat(np.arange(len(ask)), count[ask])
    at = order[np.arange(len(row)) - (np.cumsum(count[ask]) - count[ask])[row] + (np.cumsum(count) - count)[ask][row]]
    return row, kind[at], told[at]


def _laid_end_to_end(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, value) of the arrays of a column; not a number where a value is missing, nothing for a missing array."""
    size = np.nan_to_num(np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), float)).astype(np.int64)
    row = np.repeat(np.arange(len(column)), size)
    return row, np.arange(len(row)) - (np.cumsum(size) - size)[row], column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)


def _first_from(key: np.ndarray, row: np.ndarray, mz: np.ndarray, span: float, at_row: np.ndarray, told: np.ndarray) -> np.ndarray:
    """Number of the first peak of the row or of later rows that is not below each m/z; rows and m/z share a key that rounds, so its neighbours are compared themselves."""
    at = np.searchsorted(key, at_row * span + told)
    below = lambda i: (row[i] < at_row) | ((row[i] == at_row) & (mz[i] < told))
    last = len(mz) - 1
    while len(mz):
        back = (at > 0) & ~below(np.clip(at - 1, 0, last))
        on = ~back & (at <= last) & below(np.clip(at, 0, last))
        if not (back | on).any():
            break
        at = at - back + on
    return at


def _met(batches: Iterator[pa.RecordBatch], n_keys: int, tolerance: float, ppm: bool) -> Iterator[pa.RecordBatch]:
    """(keys, ions of either kind, total intensity, matched ions and their intensity) of (keys, Peptide, mz, intensity).

    By the rule of matched(): an ion takes the last peak below it within the tolerance, else the first one from it on.
    """
    for batch in batches:
        rows = len(batch)
        at_row, is_y, told = _ladders(batch.column(n_keys).to_pylist())
        row, place, mz = _laid_end_to_end(batch.column(n_keys + 1))
        high_row, high_place, high = _laid_end_to_end(batch.column(n_keys + 2))
        tic = np.bincount(high_row, high, rows)
        # heights by row and place; a peak without one has none
        width = int(max(place.max(initial=-1), high_place.max(initial=-1))) + 1
        if len(mz) == len(high) and np.array_equal(row, high_row):
            intensity = high
        else:
            held = np.searchsorted(high_row * width + high_place, row * width + place)
            there = np.clip(held, 0, max(0, len(high) - 1))
            intensity = np.where((held < len(high)) & (high_row[there] == row) & (high_place[there] == place), high[there], np.nan) if len(high) else np.full(len(mz), np.nan)
        known = np.isfinite(mz)
        row, mz, intensity = row[known], mz[known], intensity[known]
        if len(mz) and ((mz[1:] < mz[:-1]) & (row[1:] == row[:-1])).any():
            order = np.lexsort((mz, row))
            row, mz, intensity = row[order], mz[order], intensity[order]
        span = float(max(np.abs(mz).max(initial=0.0), told.max(initial=0.0))) * 2 + 1.0
        right = _first_from(row * span + mz, row, mz, span, at_row, told)
        reach = told * (tolerance * 1e-6) if ppm else np.full(len(told), float(tolerance))
        hit = np.full(len(told), -1)
        for at in (right, right - 1):  # the later one wins: the peak below
            inside = np.clip(at, 0, max(0, len(mz) - 1))
            near = (at >= 0) & (at < len(mz))
            if len(mz):
                near &= (row[inside] == at_row) & (np.abs(mz[inside] - told) <= reach)
            hit[near] = at[near]
        out = [np.bincount(at_row[~is_y], minlength=rows), np.bincount(at_row[is_y], minlength=rows), tic]
        some = hit >= 0
        for kind in (~is_y & some, is_y & some):
            out += [np.bincount(at_row[kind], minlength=rows), np.bincount(at_row[kind], intensity[hit[kind]], rows)]
        types = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.float64(), pa.int32(), pa.float64()]
        # a sum with a missing height says nothing
        columns = [pa.array(np.nan_to_num(v, nan=0.0) if t == pa.float64() else v.astype(np.int32), t) for v, t in zip(out, types, strict=True)]
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(n_keys)], *columns], names=[*batch.schema.names[:n_keys], *_FIGURES])



def match_figures(psms: DataFrame, spectra: DataFrame, key: Sequence[str] = ("psm_id",), tolerance: float = chem.TOLERANCE, ppm: bool = False) -> DataFrame:
    """(key, matched b and y ions, coverages, intensity figures) of every PSM (key, sample, Scan, Peptide); 0 where its scan has no spectrum.

    A PSM meets its spectrum once; neither ions nor peaks cross an exchange one by one, and a batch's ions are sought among its peaks at once.  PSMs are held and spectra stream by,
    as those are larger and would have to be sorted for a merge.
    """
    key = list(key)
    rows = psms.select(*key, *[c for c in ("sample", "Scan", "Peptide") if c not in key])
    own = spectra.select(F.col("sample").alias("__sample"), F.col("scan").alias("__scan"), F.col("mz").cast("array<double>").alias("mz"), F.col("intensity").cast("array<double>").alias("intensity"))
    both = rows.hint("shuffle_hash").join(own, (F.col("sample") == F.col("__sample")) & (F.col("Scan") == F.col("__scan")), "left")
    kinds = {c: psms.schema[c].dataType.simpleString() for c in key} | {c: "double" if c[0] in "ti" else "int" for c in _FIGURES}
    wide = both.select(*key, F.col("Peptide").alias("__peptide"), "mz", "intensity").mapInArrow(partial(_met, n_keys=len(key), tolerance=tolerance, ppm=ppm), ", ".join(f"`{c}` {t}" for c, t in kinds.items()))
    least = lambda c: F.greatest(c, F.lit(1))
    n, i = F.col("nb") + F.col("ny"), F.col("ib") + F.col("iy")
    return wide.select(
        *key, F.col("nb").alias("num_matched_b_ions"), F.col("ny").alias("num_matched_y_ions"), n.alias("num_matched_ions_total"), (F.col("nb") / least(F.col("__b"))).alias("b_ion_coverage"), (F.col("ny") / least(F.col("__y"))).alias("y_ion_coverage"),
        (n / least(F.col("__b") + F.col("__y"))).alias("total_ion_coverage"), F.col("tic").alias("total_ion_current"), (i / least(F.col("tic"))).alias("matched_intensity_fraction"), (i / least(n)).alias("mean_matched_ion_intensity"),
        (F.col("ib") / least(F.col("iy"))).alias("b_to_y_intensity_ratio"), (F.col("iy") / least(i)).alias("y_to_total_ratio"),
    )


def nearest(targets: DataFrame, peaks: DataFrame, by: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """`targets` (by, keys, mz) with `peak`, the nearest of `peaks` (by, mz, intensity) in its group, and `off`, its distance; of two as near the lower.

    An as-of join from both sides: targets and peaks in one order of m/z, the last peak carried up and the next one carried down.  A group is one spectrum.
    """
    none = F.lit(None)
    kinds = {c: targets.schema[c].dataType for c in keys}
    asked = targets.select(*by, *keys, F.col("mz").alias("__at"), none.cast("struct<mz: double, intensity: double>").alias("__peak"))
    seen = peaks.select(*by, *[none.cast(t).alias(c) for c, t in kinds.items()], F.col("mz").cast("double").alias("__at"), F.struct(F.col("mz").cast("double").alias("mz"), F.col("intensity").cast("double").alias("intensity")).alias("__peak"))
    both = asked.unionByName(seen)
    up = Window.partitionBy(*by).orderBy("__at", F.col("__peak").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*by).orderBy(F.col("__at").desc(), F.col("__peak").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    told = both.withColumns({"__low": F.last("__peak", True).over(up), "__high": F.last("__peak", True).over(down)}).where("__peak IS NULL")
    d_low, d_high = (F.coalesce(F.abs(F.col(f"{c}.mz") - F.col("__at")), F.lit(float("inf"))) for c in ("__low", "__high"))
    return told.select(*by, *keys, F.col("__at").alias("mz"), F.when(d_low <= d_high, F.col("__low")).otherwise(F.col("__high")).alias("peak"), F.least(d_low, d_high).alias("off"))


def isotope_figures(precursors: DataFrame, peaks: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, isotope_pattern_score, chimeric_indicator) of precursors (by, precursor_mz, Charge), one to a survey spectrum, and its peaks (by, mz, intensity)."""
    step = F.lit(chem.ISOTOPE_STEP) / F.greatest(F.col("Charge"), F.lit(1))
    wanted = precursors.select(*by, "precursor_mz", "Charge", F.explode(F.array(*[F.lit(k) for k in range(3)])).alias("__k")).withColumn("mz", F.col("precursor_mz") + F.col("__k") * step)
    found = nearest(wanted, peaks, by, ("precursor_mz", "Charge", "__k"))
    seen = [F.coalesce(F.max(F.when((F.col("__k") == k) & (F.col("off") < ISOTOPE_REACH), F.col("peak.intensity"))), F.lit(0.0)).alias(f"__i{k}") for k in range(3)]
    rows = found.groupBy(*by, "precursor_mz", "Charge").agg(*seen)
    expected = F.least(ISOTOPE_PER_DALTON * F.col("precursor_mz") * F.col("Charge"), F.lit(MOST_ISOTOPE))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.abs(F.col("__i1") / (F.col("__i0") + 1e-10) - expected)))
    some = F.col("__i0") != 0
    return rows.select(*by, F.when(some, score).otherwise(0.0).alias("isotope_pattern_score"), F.when(some & (F.col("__i2") / (F.col("__i1") + 1e-10) > CHIMERIC), 1.0).otherwise(0.0).alias("chimeric_indicator"))
