"""Features of PSMs from their spectra, one Arrow crossing for all of them.

PSMs are grouped by scan, so a spectrum travels once; a batch's ions and peaks are laid end to end and matched together.

Ions keep their numbers where small fragments are left out, doubly charged ions are chosen by their charge, and a tolerance in ppm counts as
ppm throughout; with `compat`, ions are numbered from the first one that is large enough, of the ions of both charges only those behind as many as there are of one
charge count as doubly charged, and peaks are compared in dalton where only the ions' matching knows ppm.  What is wrong with a spectrum is a value,
`spectral_feature_error`, not an exception.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from psmlake.functions import chem
from psmlake.functions.peptide import parsed

COUNTS = (
    "n_mods", "has_oxidation", "has_phospho", "has_carbamido", "has_deamidation", "has_acetyl", "num_peaks", "num_matched_b_ions", "num_matched_y_ions", "num_matched_ions_total",
    "longest_b_series", "longest_y_series", "num_complementary_ion_pairs", "n_theoretical_ions_charged",
)
VALUES = (
    "total_mod_mass", "mod_mass_per_res", "total_ion_current", "base_peak_intensity", "b_ion_coverage", "y_ion_coverage", "total_ion_coverage", "matched_intensity_fraction",
    "mean_matched_ion_intensity", "b_to_y_intensity_ratio", "y_to_total_ratio", "intensity_contrast", "explained_intensity_top50", "signal_to_noise", "noise_floor_normalized_tic",
    "mean_fragment_mass_error_ppm", "std_fragment_mass_error_ppm", "kmd_variance", "complementary_ion_ratio", "spectral_angle", "spectral_sim2", "spectral_pearson",
    "charge_weighted_spectral_angle", "charge_weight_sim2", "isotope_pattern_score", "chimeric_indicator",
)
SCHEMA = ", ".join([*(f"{c} int" for c in COUNTS), *(f"{c} double" for c in VALUES), "spectral_feature_error string"])
#: Weight and smallest m/z of doubly charged ions, share of the second isotope peak per dalton and its bound, reach around an isotope peak, mass of a CH2 step.
DOUBLE_WEIGHT, SMALLEST_DOUBLE, ISOTOPE_PER_DALTON, MOST_ISOTOPE, ISOTOPE_REACH, KENDRICK = 0.6, 200.0, 0.0011, 0.8, 0.02, 14.0 / 14.01565
TOP, CHIMERIC = 50, 1.5
#: Peaks that are matched at once.
BATCH_PEAKS = 400_000
Arrays = Sequence[np.ndarray | None]


def _wide(flat: np.ndarray, size: np.ndarray, begin: np.ndarray, row: np.ndarray) -> np.ndarray | None:
    """Rows of values as a matrix, infinite behind a row's end; none where lengths differ so much that most of it would be empty, or where an infinite or missing value would be lost in it."""
    most = int(size.max(initial=0))
    if not len(flat) or most * len(size) > 2 * len(flat) or not np.isfinite(flat).all():
        return None
    if most * len(size) == len(flat):
        return flat.reshape(len(size), most)
    out = np.full((len(size), most), np.inf)
    out[row, np.arange(len(flat)) - begin[row]] = flat
    return out


class Peaks:
    """Peaks of several rows, each row's in order of m/z."""

    def __init__(self, mz: Arrays, intensity: Arrays):
        size = np.array([len(x) for x in mz], np.int64)
        self.rows, self.size = len(size), size
        self.begin = np.cumsum(size) - size
        row = np.repeat(np.arange(len(size)), size)
        flat = np.concatenate([np.asarray(x, float) for x in mz]) if len(size) else np.zeros(0)
        order = self._order(flat, row)
        self.row, self.mz = row, flat[order]
        self.intensity = (np.concatenate([np.asarray(x, float) for x in intensity]) if len(size) else np.zeros(0))[order]
        self.span = float(np.nanmax(np.abs(self.mz), initial=0.0)) + 1e5
        self.key = row * self.span + self.mz

    def _order(self, values: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Each row's places by its values, equal ones as they stand."""
        wide = _wide(values, self.size, self.begin, row)
        if wide is None:
            return np.lexsort((values, row))
        at = np.argsort(wide, axis=1, kind="stable") + self.begin[:, None]
        return at.ravel() if wide.size == len(values) else at[np.arange(wide.shape[1]) < self.size[:, None]]

    def beside(self, row: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The neighbours below and above each wanted m/z in its row, and their distances; infinite where there is none."""
        right = np.searchsorted(self.key, row * self.span + wanted)
        out = []
        for at in (right - 1, right):
            inside = (at >= self.begin[row]) & (at < self.begin[row] + self.size[row])
            at = np.where(inside, at, 0)
            far = np.abs(self.mz[at] - wanted) if len(self.mz) else np.full(len(at), np.inf)
            out += [at, np.where(inside, far, np.inf)]
        return out[0], out[2], out[1], out[3]

    def within(self, row: np.ndarray, wanted: np.ndarray, width: np.ndarray) -> np.ndarray:
        """A peak within the width, the lower neighbour before the upper one, else -1."""
        low, high, d_low, d_high = self.beside(row, wanted)
        return np.where(d_low <= width, low, np.where(d_high <= width, high, -1))

    def nearest(self, row: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, high, d_low, d_high = self.beside(row, wanted)
        return np.where(d_low <= d_high, low, high), np.minimum(d_low, d_high)

    def over_rows(self, step: np.ufunc, values: np.ndarray) -> np.ndarray:
        """Each row's values put together by `step`; 0 for a row without peaks."""
        out, some = np.zeros(self.rows), self.size > 0
        if len(values):
            out[some] = step.reduceat(values, self.begin[some])
        return out

    def sums(self, values: np.ndarray) -> np.ndarray:
        return self.over_rows(np.add, values)

    def medians(self, chosen: np.ndarray, default: float) -> np.ndarray:
        """Each row's median intensity of the chosen peaks."""
        out = np.full(self.rows, default)
        wide = _wide(self.intensity, self.size, self.begin, self.row)
        if wide is not None:
            wide = wide.copy()
            wide[self.row[~chosen], (np.arange(len(self.row)) - self.begin[self.row])[~chosen]] = np.inf
            wide.sort(axis=1)
            n = np.bincount(self.row[chosen], minlength=self.rows)
            some = np.flatnonzero(n)
            out[some] = (wide[some, (n[some] - 1) // 2] + wide[some, n[some] // 2]) / 2
            return out
        at = np.flatnonzero(chosen)
        at = at[np.lexsort((self.intensity[at], self.row[at]))]
        n = np.bincount(self.row[at], minlength=self.rows)
        first = np.cumsum(n) - n
        some = np.flatnonzero(n)
        out[some] = (self.intensity[at[first[some] + (n[some] - 1) // 2]] + self.intensity[at[first[some] + n[some] // 2]]) / 2
        return out

    def largest(self, n: int) -> np.ndarray:
        """Whether each peak is one of its row's `n` most intense."""
        order = self._order(-self.intensity, self.row)
        out = np.zeros(len(order), bool)
        out[order] = np.arange(len(order)) - self.begin[self.row] < n
        return out

    def likeness(self, theory: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Angle, squared cosine and correlation of the intensities and a theoretical value for each peak."""
        dot = self.sums(self.intensity * theory)
        seen, told = np.sqrt(self.sums(self.intensity**2)), np.sqrt(self.sums(theory**2))
        cosine = np.clip(dot / ((seen + 1e-10) * (told + 1e-10)), -1, 1)
        size = np.maximum(1, self.size)
        x, y = (v - (self.sums(v) / size)[self.row] for v in (self.intensity, theory))
        sx, sy = np.sqrt(self.sums(x * x) / size), np.sqrt(self.sums(y * y) / size)
        good = (told > 0) & (self.size > 2) & (sx > 1e-10) & (sy > 1e-10)
        pearson = np.where(good, self.sums(x * y) / size / np.where(good, sx * sy, 1), 0.0)
        return np.arccos(cosine), cosine**2, np.clip(pearson, -1, 1)


class Ions:
    """The b or y ions of several peptides: row, number and m/z of those above `smallest`."""

    def __init__(self, masses: list[np.ndarray], kind: str, charge: int = 1, smallest: float = chem.SMALLEST_FRAGMENT):
        size = np.array([len(m) for m in masses], np.int64)
        begin = np.cumsum(size) - size
        row, flat = np.repeat(np.arange(len(size)), size), np.concatenate(masses) if len(masses) else np.zeros(0)
        place = np.arange(len(flat)) - begin[row]
        # sums along the rows of a matrix are those of each row by itself; a few long peptides among short ones are summed in parts of like length
        sums = np.empty(len(flat))
        turned = flat if kind == "b" else flat[begin[row] + size[row] - 1 - place]
        for part in np.unique(size >> 5):
            own = np.flatnonzero(size >> 5 == part)
            wide = np.zeros((len(own), int(size[own].max())))
            inside = np.arange(wide.shape[1]) < size[own][:, None]
            at = (begin[own][:, None] + np.arange(wide.shape[1]))[inside]
            wide[inside] = turned[at]
            sums[at] = np.cumsum(wide, axis=1)[inside]
        whole = place < size[row] - 1  # the whole peptide is no fragment
        self.row, self.number = row[whole], place[whole] + 1
        self.mz = ((sums[whole] + (0.0 if kind == "b" else chem.WATER)) + charge * chem.PROTON) / charge
        keep = self.mz > smallest
        self.row, self.number, self.mz = self.row[keep], self.number[keep], self.mz[keep]
        self.count = np.bincount(self.row, minlength=len(masses))

    def places(self) -> np.ndarray:
        """1, 2, ... within each row, small ions left out."""
        return np.arange(len(self.row)) - (np.cumsum(self.count) - self.count)[self.row] + 1


def _longest(ions: Ions, hit: np.ndarray, rows: int) -> np.ndarray:
    """Length of each row's longest run of neighbouring matched ions."""
    out = np.zeros(rows, np.int64)
    if hit.any():
        row, place = ions.row[hit], ions.places()[hit]
        run = np.cumsum(np.concatenate([[True], (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)])) - 1
        np.maximum.at(out, row, np.bincount(run)[run])
    return out


def _mean_and_spread(row: np.ndarray, x: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, mean and variance of each row's values; 0 where there are none."""
    n = np.bincount(row, minlength=rows)
    mean = np.bincount(row, x, rows) / np.maximum(1, n)
    return n, mean, np.bincount(row, (x - mean[row]) ** 2, rows) / np.maximum(1, n)


def matched_features(masses: list[np.ndarray], charge: np.ndarray, peaks: Peaks, tolerance: float, ppm: bool, compat: bool) -> dict[str, np.ndarray]:
    """Features of PSMs, one for each row of `peaks`, from their residues' masses."""
    rows = len(masses)

    def width(mz: np.ndarray, loose: bool = False) -> np.ndarray:
        return mz * tolerance * 1e-6 if ppm and not loose else np.full(len(mz), tolerance)

    b, y = Ions(masses, "b"), Ions(masses, "y")
    at_b, at_y = (peaks.within(i.row, i.mz, width(i.mz)) for i in (b, y))
    hit_b, hit_y = at_b >= 0, at_y >= 0
    row = np.concatenate([b.row[hit_b], y.row[hit_y]])
    told, at = np.concatenate([b.mz[hit_b], y.mz[hit_y]]), np.concatenate([at_b[hit_b], at_y[hit_y]])
    nb, ny = np.bincount(b.row[hit_b], minlength=rows), np.bincount(y.row[hit_y], minlength=rows)
    ib, iy = np.bincount(b.row[hit_b], peaks.intensity[at_b[hit_b]], rows), np.bincount(y.row[hit_y], peaks.intensity[at_y[hit_y]], rows)
    n, total = nb + ny, peaks.sums(peaks.intensity)
    base = np.maximum(0.0, peaks.over_rows(np.maximum, peaks.intensity))
    _, mean, variance = _mean_and_spread(peaks.row, peaks.intensity, rows)

    hit = np.zeros(len(peaks.mz), bool)
    hit[at] = True
    noise = np.maximum(1.0, peaks.medians(~hit, 1.0))
    signal = np.bincount(peaks.row[hit], peaks.intensity[hit], rows) / np.maximum(1, np.bincount(peaks.row[hit], minlength=rows))

    # a peak is explained where some matched ion is within the tolerance, on either side
    top = np.flatnonzero(peaks.largest(TOP))
    by_row = np.argsort(row, kind="stable")
    of_row = np.split(told[by_row], np.cumsum(np.bincount(row, minlength=rows))[:-1]) if len(told) else []
    ions_at = Peaks(of_row, of_row) if len(told) else None
    explained = np.zeros(len(top), bool)
    if ions_at is not None:
        close = ions_at.nearest(peaks.row[top], peaks.mz[top])[1]
        explained = close <= width(peaks.mz[top], compat)
    shown = np.bincount(peaks.row[top], peaks.intensity[top] * explained, rows) / np.maximum(1.0, np.bincount(peaks.row[top], peaks.intensity[top], rows))

    near, off = peaks.nearest(row, told)
    inside = off <= width(told)
    _, error, spread = _mean_and_spread(row[inside], off[inside] / told[inside] * 1e6, rows)
    kendrick = told * KENDRICK
    many, _, defect = _mean_and_spread(row, kendrick - np.floor(kendrick), rows)

    length = np.array([len(m) for m in masses], np.int64)
    number_b, number_y = (i.places() if compat else i.number for i in (b, y))
    key = int(length.max(initial=0)) + 1
    partner = b.row[hit_b] * key + length[b.row[hit_b]] - number_b[hit_b]
    paired = np.isin(partner, y.row[hit_y] * key + number_y[hit_y])
    pairs = np.bincount(b.row[hit_b][paired], minlength=rows)

    theory = np.zeros(len(peaks.mz))
    for i in (b, y):
        found = peaks.within(i.row, i.mz, width(i.mz, compat))
        theory[found[found >= 0]] = 1.0
    angle, sim2, pearson = peaks.likeness(theory)
    charged = b.count + y.count
    multiple = np.flatnonzero(charge >= 3)
    if len(multiple):
        for kind, single in (("b", b), ("y", y)):
            more = _doubly_charged([masses[r] for r in multiple], kind, single.count[multiple], compat)
            found = peaks.within(multiple[more[0]], more[1], width(more[1], compat))
            found = found[found >= 0]
            theory[found] = np.maximum(theory[found], DOUBLE_WEIGHT)
            charged = charged + np.bincount(multiple[more[0]], minlength=rows)
    weighted_angle, weighted_sim2, _ = peaks.likeness(theory)
    return {
        "total_ion_current": total,
        "base_peak_intensity": base,
        "num_peaks": peaks.size,
        "num_matched_b_ions": nb,
        "num_matched_y_ions": ny,
        "num_matched_ions_total": n,
        "b_ion_coverage": nb / np.maximum(1, b.count),
        "y_ion_coverage": ny / np.maximum(1, y.count),
        "total_ion_coverage": n / np.maximum(1, b.count + y.count),
        "matched_intensity_fraction": (ib + iy) / np.maximum(1.0, total),
        "mean_matched_ion_intensity": (ib + iy) / np.maximum(1, n),
        "b_to_y_intensity_ratio": ib / np.maximum(1.0, iy),
        "y_to_total_ratio": iy / np.maximum(1.0, ib + iy),
        "intensity_contrast": np.where(peaks.size > 1, np.sqrt(variance) / (mean + 1.0), 0.0),
        "explained_intensity_top50": shown,
        "signal_to_noise": signal / noise,
        "noise_floor_normalized_tic": total / (noise * np.maximum(1, peaks.size)),
        "longest_b_series": _longest(b, hit_b, rows),
        "longest_y_series": _longest(y, hit_y, rows),
        "mean_fragment_mass_error_ppm": error,
        "std_fragment_mass_error_ppm": np.sqrt(spread),
        "kmd_variance": np.where(many >= 3, defect, 0.0),
        "num_complementary_ion_pairs": pairs,
        "complementary_ion_ratio": pairs / np.maximum(1, n),
        "spectral_angle": angle,
        "spectral_sim2": sim2,
        "spectral_pearson": pearson,
        "charge_weighted_spectral_angle": weighted_angle,
        "charge_weight_sim2": weighted_sim2,
        "n_theoretical_ions_charged": charged,
    }


def _doubly_charged(masses: list[np.ndarray], kind: str, singles: np.ndarray, compat: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, m/z) of the doubly charged ions above SMALLEST_DOUBLE; compat: of both charges, by number then charge, those behind the first `singles`."""
    double = Ions(masses, kind, 2, SMALLEST_DOUBLE)
    if not compat:
        return double.row, double.mz
    single = Ions(masses, kind, 1, SMALLEST_DOUBLE)
    row, mz = np.concatenate([single.row, double.row]), np.concatenate([single.mz, double.mz])
    order = np.lexsort((np.repeat([1, 2], [len(single.row), len(double.row)]), np.concatenate([single.number, double.number]), row))
    row, mz = row[order], mz[order]
    count = np.bincount(row, minlength=len(masses))
    behind = np.arange(len(row)) - (np.cumsum(count) - count)[row] >= singles[row]
    return row[behind], mz[behind]


def isotope_features(precursor_mz: np.ndarray, charge: np.ndarray, ms1: Peaks) -> dict[str, np.ndarray]:
    """How near the second isotope peak is to its expected share of the first, and whether the third is higher than half again the second."""
    step = chem.ISOTOPE_STEP / np.maximum(1, charge)
    seen = []
    for k in range(3):
        at, off = ms1.nearest(np.arange(ms1.rows), precursor_mz + k * step)
        seen.append(np.where(off < ISOTOPE_REACH, ms1.intensity[at] if len(ms1.intensity) else 0.0, 0.0))
    expected = np.minimum(ISOTOPE_PER_DALTON * precursor_mz * charge, MOST_ISOTOPE)
    score = np.clip(1 - np.abs(seen[1] / (seen[0] + 1e-10) - expected), 0, 1)
    some = seen[0] != 0
    return {"isotope_pattern_score": np.where(some, score, 0.0), "chimeric_indicator": np.where(some & (seen[2] / (seen[1] + 1e-10) > CHIMERIC), 1.0, 0.0)}


def batch_features(
    peptides: Sequence[str | None], charge: np.ndarray, mz: Arrays, intensity: Arrays, precursor_mz: np.ndarray, ms1_mz: Arrays, ms1_intensity: Arrays, tolerance: float = chem.TOLERANCE, ppm: bool = False, compat: bool = False
) -> dict[str, np.ndarray]:
    """A value for each PSM and column of SCHEMA."""
    rows = len(peptides)
    read = {p: parsed(p) for p in set(peptides)}
    out: dict[str, np.ndarray] = {c: np.zeros(rows, np.int64) for c in COUNTS} | {c: np.zeros(rows) for c in VALUES}
    error = np.full(rows, None, object)
    for i, p in enumerate(peptides):
        residues, mods = read[p]
        if mods:
            masses = list(mods.values())
            out["n_mods"][i], out["total_mod_mass"][i] = len(masses), sum(masses)
            out["mod_mass_per_res"][i] = sum(masses) / max(1, len(residues))
            for name, flag in chem.modification_flags(masses).items():
                out[f"has_{name}"][i] = flag
        if mz[i] is None or intensity[i] is None:
            error[i] = "scan_not_found"
        elif len(residues) < 2:
            error[i] = "peptide_too_short"
        elif len(mz[i]) != len(intensity[i]):
            error[i] = "missing_spectrum_data"
        elif not len(mz[i]):
            error[i] = "empty_spectrum"
    good = np.flatnonzero(error == None)  # noqa: E711
    peaks = np.cumsum([len(mz[i]) for i in good])
    for part in np.split(good, np.searchsorted(peaks, np.arange(BATCH_PEAKS, peaks[-1], BATCH_PEAKS)) if len(good) else []):
        if len(part):
            own = matched_features([chem.residue_masses(*read[peptides[i]]) for i in part], charge[part], Peaks([mz[i] for i in part], [intensity[i] for i in part]), tolerance, ppm, compat)
            for c, values in own.items():
                out[c][part] = values
            known = np.array([i for i in part if ms1_mz[i] is not None and len(ms1_mz[i]) and len(ms1_mz[i]) == len(ms1_intensity[i]) and precursor_mz[i] > 0], np.int64)
            for c, values in isotope_features(precursor_mz[known], charge[known], Peaks([ms1_mz[i] for i in known], [ms1_intensity[i] for i in known])).items():
                out[c][known] = values
    return out | {"spectral_feature_error": error}


def features(peptide: str, charge: int, mz: np.ndarray | None, intensity: np.ndarray | None, precursor_mz: float | None = None, ms1: tuple[np.ndarray, np.ndarray] | None = None, **how: object) -> dict[str, object]:
    """The features of one PSM."""
    one = batch_features([peptide], np.array([charge]), [mz], [intensity], np.array([precursor_mz or 0.0]), [ms1[0] if ms1 else None], [ms1[1] if ms1 else None], **how)  # type: ignore[arg-type]
    return {c: v[0] for c, v in one.items()}


def _rows(column: pa.ListArray) -> list[np.ndarray | None]:
    """Each row's values, as views of the column's; none for null."""
    if column.null_count == len(column):
        return [None] * len(column)
    flat = column.values.to_numpy(zero_copy_only=False).astype(float, copy=False)
    ends, known = column.offsets.to_numpy().tolist(), column.is_valid().to_pylist()
    return [flat[a:b] if k else None for a, b, k in zip(ends, ends[1:], known, strict=False)]


def extract(psms: DataFrame, spectra: DataFrame, key: str = "psm_id", tolerance: float = chem.TOLERANCE, ppm: bool = False, compat: bool = False) -> DataFrame:
    """(key, features) for PSMs (key, sample, Scan, Peptide, Charge) and spectra (sample, scan, mz, intensity, precursor_mz, and ms1 where there is)."""
    has_ms1 = "ms1" in spectra.columns
    survey = [F.col(f"ms1.{c}").alias(f"ms1_{c}") if has_ms1 else F.lit(None).cast("array<double>").alias(f"ms1_{c}") for c in ("mz", "intensity")]
    own = spectra.select(F.col("sample").alias("__s"), F.col("scan").alias("__scan"), "mz", "intensity", "precursor_mz", *survey)
    scans = psms.groupBy("sample", "Scan").agg(F.collect_list(F.struct(F.col(key).alias("key"), "Peptide", "Charge")).alias("psms"))
    rows = scans.hint("shuffle_hash").join(own, (F.col("sample") == F.col("__s")) & (F.col("Scan") == F.col("__scan")), "left")
    rows = rows.select("psms", "mz", "intensity", "precursor_mz", "ms1_mz", "ms1_intensity")
    kind = psms.schema[key].dataType.simpleString()
    types = {**{c: pa.int32() for c in COUNTS}, **{c: pa.float64() for c in VALUES}, "spectral_feature_error": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0)
            scan = np.repeat(np.arange(len(batch)), np.asarray(held.value_lengths()))
            flat = held.flatten()
            arrays = [_rows(batch.column(k)) for k in (1, 2, 4, 5)]
            precursor = np.nan_to_num(np.array(batch.column(3).to_pylist(), float))[scan]
            charge = np.nan_to_num(np.array(flat.field(2).to_pylist(), float)).astype(np.int64)
            mz, intensity, ms1_mz, ms1_intensity = ([own[i] for i in scan] for own in arrays)
            out = batch_features(flat.field(1).to_pylist(), charge, mz, intensity, precursor, ms1_mz, ms1_intensity, tolerance, ppm, compat)
            yield pa.RecordBatch.from_arrays([flat.field(0), *[pa.array(out[c].tolist() if t == pa.string() else out[c], t) for c, t in types.items()]], names=[key, *types])

    return rows.mapInArrow(run, f"{key} {kind}, {SCHEMA}")


def with_spectral_features(psms: DataFrame, features_: DataFrame, key: str = "psm_id") -> DataFrame:
    """PSMs with their features, joined on the PSM so that several PSMs of a scan don't multiply."""
    return psms.join(features_, key, "left")
