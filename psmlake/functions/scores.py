"""Scores, thresholds' directions, evidence and transforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from psmlake.functions.coerce import number

#: Metrics where small values are good, and where large ones are; with default thresholds.
AT_MOST = {"QValue": 0.01, "PepQValue": 0.01, "xpec_q": 0.01, "xpec_pepq": 0.01}
AT_LEAST = {"MSMSScore": 10.0, "xpec_score": 0.6}
#: Offered as well, with an explicit threshold only.
AT_LEAST_EXPLICIT = ("rescore_prob", "MSGFScore")
INTENSITY_FLOOR = 1e3
NO_EVALUE = 1e-101


def msms_score(evalue: Column) -> Column:
    """-log10 of an expectation value; 0 or a missing one scores 0."""
    x = number(evalue)
    return -F.log10(F.coalesce(F.when(x != 0, x), F.lit(1.0)))


def msms_score_strict(evalue: Column) -> Column:
    """-log10 of a positive expectation value, else null."""
    x = number(evalue)
    return F.when(x > 0, -F.log10(x))


def abs_ppm(error: Column) -> Column:
    return F.abs(number(error))


def log2_safe(value: Column, zero_to_null: bool = True) -> Column:
    """log2 of positive values; others are null, or count as 1."""
    return F.when(value > 0, F.log2(value)) if zero_to_null else F.log2(F.when(value > 0, value).otherwise(1.0))


def back_from_log2(value: Column) -> Column:
    return F.pow(F.lit(2.0), value)


def log1p_positive(value: Column) -> Column:
    x = number(value)
    return F.log1p(F.when(x < 0, 0.0).otherwise(x))


def corrected_evalue(evalue: Column, full: Column, part: Column) -> Column:
    """An expectation value from a search of a part, for the whole database."""
    return evalue * (full / F.nullif(part, F.lit(0)))


def evidence(x: Column, median: Column) -> Column:
    """1 - exp(-x ln 2 / median), within 0 and 1; the scale is 1 where the median isn't positive; a missing x is no evidence."""
    scale = F.when(median > 0, F.log(F.lit(2.0)) / median).otherwise(1.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - F.exp(-scale * x)))


def noisy_or(chance: Column, evidence_: Column, alpha: float | Column = 1.0, beta: float | Column = 1.0) -> Column:
    """Either of two sources speaks for the match; strong evidence alone keeps 0.8 of itself."""
    a, b = (F.least(F.lit(1.0), x if isinstance(x, Column) else F.lit(float(x))) for x in (alpha, beta))
    both = 1 - (1 - a * chance) * (1 - b * evidence_)
    rescue = F.when(evidence_ >= 0.7, 0.8 * evidence_).otherwise(0.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), both, rescue))
