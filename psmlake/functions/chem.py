"""Masses of peptides and fragments."""

from __future__ import annotations

import numpy as np

#: Fixed values, in dalton.
PROTON, WATER, ISOTOPE_STEP, SMALLEST_FRAGMENT = 1.007276, 18.010565, 1.003355, 100.0
RESIDUES = {"G": 57.021464, "A": 71.037114, "S": 87.032028, "P": 97.052764, "V": 99.068414, "T": 101.047670, "C": 103.009185, "L": 113.084064, "I": 113.084064, "N": 114.042927, "D": 115.026943, "Q": 128.058578, "K": 128.094963, "E": 129.042593, "M": 131.040485, "H": 137.058912, "F": 147.068414, "R": 156.101111, "Y": 163.063329, "W": 186.079313}
#: Fixed values, mass windows that name a modification, tried in this order.
MODIFICATIONS = {"oxidation": (14.99, 16.01), "phospho": (79.95, 79.98), "carbamido": (57.01, 57.04), "deamidation": (0.980, 0.990), "acetyl": (42.00, 42.02)}
TOLERANCE = 0.02
#: The masses by a letter's code; 0 for other characters.
_BY_CODE = np.array([RESIDUES.get(chr(c), 0.0) for c in range(128)])


def modification_flags(masses: list[float]) -> dict[str, int]:
    """Which modifications the masses name; each mass names one at most."""
    out = dict.fromkeys(MODIFICATIONS, 0)
    for m in masses:
        for name, (low, high) in MODIFICATIONS.items():
            if low < m < high:
                out[name] = 1
                break
    return out


def residue_masses(residues: str, modifications: dict[int, float]) -> np.ndarray:
    """Masses by residue; one that isn't known weighs 0."""
    out = _BY_CODE[np.frombuffer(residues.encode(), np.uint8)] if residues.isascii() else np.array([RESIDUES.get(r, 0.0) for r in residues])
    for at, mass in modifications.items():
        if 0 <= at < len(out):
            out[at] += mass
    return out


def fragments(masses: np.ndarray, charge: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """m/z of the b and y ions by ion number, from 1 on."""
    b = np.cumsum(masses)[:-1]
    y = np.cumsum(masses[::-1])[:-1] + WATER
    return (b + charge * PROTON) / charge, (y + charge * PROTON) / charge


def nearest(peaks: np.ndarray, wanted: np.ndarray, tolerance: float, ppm: bool = False) -> np.ndarray:
    """For each wanted m/z the number of a peak within the tolerance, the left neighbour before the right one, else -1.  Peaks are sorted."""
    if not len(peaks):
        return np.full(len(wanted), -1)
    width = wanted * tolerance * 1e-6 if ppm else np.full(len(wanted), tolerance)
    right = np.searchsorted(peaks, wanted)
    out = np.full(len(wanted), -1)
    for at in (right, right - 1):  # the later assignment wins: the left neighbour
        inside = (at >= 0) & (at < len(peaks))
        hit = inside & (np.abs(peaks[np.clip(at, 0, len(peaks) - 1)] - wanted) <= width)
        out[hit] = at[hit]
    return out
