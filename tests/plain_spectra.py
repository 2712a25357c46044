"""Spectral features of one PSM, step by step, to hold the batch kernel against."""

from __future__ import annotations

import math
import statistics

from psmlake.functions.chem import RESIDUES as MASS


def ions(residues: str, mods: dict[int, float], charge: int, least: float) -> tuple[list[tuple[int, float]], list[tuple[int, float]]]:
    each = [MASS.get(r, 0.0) + mods.get(i, 0.0) for i, r in enumerate(residues)]
    b = [(i, (sum(each[:i]) + charge * 1.007276) / charge) for i in range(1, len(each))]
    y = [(i, (sum(each[-i:]) + 18.010565 + charge * 1.007276) / charge) for i in range(1, len(each))]
    return [x for x in b if x[1] > least], [x for x in y if x[1] > least]


def plain(residues: str, mods: dict[int, float], charge: int, spectrum: list[tuple[float, float]], precursor: float, ms1: list[tuple[float, float]], tolerance: float, ppm: bool, compat: bool) -> dict[str, float]:
    peaks = sorted(spectrum, key=lambda p: p[0])
    mz, height = [p[0] for p in peaks], [p[1] for p in peaks]

    def reach(x: float, loose: bool = False) -> float:
        return x * tolerance / 1e6 if ppm and not (loose and compat) else tolerance

    def match(x: float, loose: bool = False) -> int | None:
        i = sum(m < x for m in mz)
        return next((j for j in (i - 1, i) if 0 <= j < len(mz) and abs(mz[j] - x) <= reach(x, loose)), None)

    b, y = ions(residues, mods, 1, 100.0)
    mb, my = [(k, x, match(x)) for k, x in b], [(k, x, match(x)) for k, x in y]
    hb, hy = [m for m in mb if m[2] is not None], [m for m in my if m[2] is not None]
    ib, iy = [height[m[2]] for m in hb], [height[m[2]] for m in hy]
    told = [m[1] for m in hb + hy]
    total = sum(height)
    out: dict[str, float] = {"total_ion_current": total, "base_peak_intensity": max(height), "num_peaks": len(mz), "num_matched_b_ions": len(hb), "num_matched_y_ions": len(hy), "num_matched_ions_total": len(told)}
    out |= {"b_ion_coverage": len(hb) / max(1, len(b)), "y_ion_coverage": len(hy) / max(1, len(y)), "total_ion_coverage": len(told) / max(1, len(b) + len(y))}
    out |= {"matched_intensity_fraction": sum(ib + iy) / max(total, 1), "mean_matched_ion_intensity": statistics.fmean(ib + iy) if told else 0.0}
    out |= {"b_to_y_intensity_ratio": sum(ib) / max(1, sum(iy)), "y_to_total_ratio": sum(iy) / max(1, sum(ib + iy))}
    out["intensity_contrast"] = statistics.pstdev(height) / (statistics.fmean(height) + 1) if len(height) > 1 else 0.0
    top = sorted(range(len(mz)), key=lambda i: -height[i])[:50]
    out["explained_intensity_top50"] = sum(height[i] for i in top if any(abs(mz[i] - x) <= (reach(mz[i]) if not compat else tolerance) for x in told)) / max(1, sum(height[i] for i in top))
    seen = {m[2] for m in hb + hy}
    rest = [h for i, h in enumerate(height) if i not in seen]
    noise = max(1.0, statistics.median(rest)) if rest else 1.0
    out["signal_to_noise"] = (statistics.fmean(height[i] for i in seen) if seen else 0.0) / noise
    out["noise_floor_normalized_tic"] = total / (noise * len(mz))

    def longest(all_: list, hits: list) -> int:
        best = run = 0
        for k in all_:
            run = run + 1 if k in hits else 0
            best = max(best, run)
        return best

    out["longest_b_series"] = longest([k for k, _ in b], [m[0] for m in hb])
    out["longest_y_series"] = longest([k for k, _ in y], [m[0] for m in hy])
    errors = [min(abs(m - x) for m in mz) / x * 1e6 for x in told]
    out["mean_fragment_mass_error_ppm"] = statistics.fmean(errors) if errors else 0.0
    out["std_fragment_mass_error_ppm"] = statistics.pstdev(errors) if errors else 0.0
    defects = [x * 14 / 14.01565 - math.floor(x * 14 / 14.01565) for x in told]
    out["kmd_variance"] = statistics.pvariance(defects) if len(defects) >= 3 else 0.0
    number_b = {k: (i + 1 if compat else k) for i, (k, _) in enumerate(b)}
    number_y = {k: (i + 1 if compat else k) for i, (k, _) in enumerate(y)}
    pairs = sum(1 for i in range(1, len(residues)) if i in {number_b[m[0]] for m in hb} and len(residues) - i in {number_y[m[0]] for m in hy})
    out["num_complementary_ion_pairs"], out["complementary_ion_ratio"] = pairs, pairs / max(1, len(told))

    def likeness(theory: list[float]) -> tuple[float, float, float]:
        no, nt = math.sqrt(sum(h * h for h in height)), math.sqrt(sum(t * t for t in theory))
        dot = max(-1.0, min(1.0, sum(h * t for h, t in zip(height, theory, strict=True)) / ((no + 1e-10) * (nt + 1e-10))))
        r = 0.0
        if sum(theory) > 0 and len(height) > 2 and statistics.pstdev(height) > 1e-10 and statistics.pstdev(theory) > 1e-10:
            r = statistics.correlation(height, theory)
        return math.acos(dot), dot * dot, r

    theory = [0.0] * len(mz)
    for _, x in b + y:
        if (j := match(x, True)) is not None:
            theory[j] = 1.0
    out["spectral_angle"], out["spectral_sim2"], out["spectral_pearson"] = likeness(theory)
    n = len(b) + len(y)
    if charge >= 3:
        for which, single in ((0, b), (1, y)):
            more = [x for _, x in ions(residues, mods, 2, 200.0)[which]]
            if compat:
                one, two = dict(ions(residues, mods, 1, 200.0)[which]), dict(ions(residues, mods, 2, 200.0)[which])
                both = [t[k] for k in range(1, len(residues)) for t in (one, two) if k in t]
                more = both[len(single) :]
            for x in more:
                if (j := match(x, True)) is not None:
                    theory[j] = max(theory[j], 0.6)
            n += len(more)
    out["charge_weighted_spectral_angle"], out["charge_weight_sim2"], _ = likeness(theory)
    out["n_theoretical_ions_charged"] = n
    iso = []
    for k in range(3):
        target = precursor + k * 1.003355 / max(1, charge)
        near = min(ms1, key=lambda p: abs(p[0] - target))
        iso.append(near[1] if abs(near[0] - target) < 0.02 else 0.0)
    out["isotope_pattern_score"] = out["chimeric_indicator"] = 0.0
    if iso[0]:
        out["isotope_pattern_score"] = min(1.0, max(0.0, 1 - abs(iso[1] / (iso[0] + 1e-10) - min(0.0011 * precursor * charge, 0.8))))
        out["chimeric_indicator"] = float(iso[2] / (iso[1] + 1e-10) > 1.5)
    return out
