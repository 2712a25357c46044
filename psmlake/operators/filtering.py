"""Preparing, filtering and relabelling PSMs."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from psmlake.functions import decoy, peptide, scores
from psmlake.functions.coerce import number
from psmlake.operators import lineage
from psmlake.schemas import has, require

log = logging.getLogger(__name__)

#: Columns of the selected-ion table, and two that are renamed.
SELECTED = ("Scan", "Charge", "PrecursorMZ", "DelM", "DelM_PPM", "MH", "Peptide", "Protein", "MSGFDB_SpecEValue", "QValue", "PepQValue", "ElutionTime", "ParentIonIntensity", "OptimalScanNumber")
RENAMED = {"MSGFDB_SpecEValue": "SpecEValue", "Scan": "ScanNum"}
NUMERIC = ("SpecEValue", "MSGFDB_SpecEValue", "QValue", "PepQValue", "MSMSScore", "absPPM", "DelM_PPM", "xpec_q", "xpec_pepq", "xpec_score", "MSGFScore", "ParentIonIntensity", "PeakArea", "StatMomentsArea")


def best_per_scan(df: DataFrame, tie: Sequence[str], keys: Sequence[str] = ("sample", "Scan"), intensity: str = "ParentIonIntensity") -> DataFrame:
    """Of each scan, the row with the largest intensity; missing intensities last, ties by `tie`.

    A ranking column is added before the shuffle, so a scan costs one row a group after the window's limit is pushed down; large files are dealt to more tasks first.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(intensity).desc_nulls_last(), *tie)
    return lineage.dealt(df, *keys).withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def prepare_sics(df: DataFrame, tie: Sequence[str]) -> DataFrame:
    """Best row of each scan, the selected columns under their new names, with is_decoy, MSMSScore and absPPM."""
    require(df, "sample", *SELECTED)
    out = best_per_scan(df, tie).select("sample", *SELECTED).withColumnsRenamed(RENAMED)
    return out.withColumns({"is_decoy": decoy.by_prefix(F.col("Protein")), "MSMSScore": scores.msms_score(F.col("SpecEValue")), "absPPM": scores.abs_ppm(F.col("DelM_PPM"))})


def with_scores(df: DataFrame) -> DataFrame:
    """MSMSScore from MSGFDB_SpecEValue and absPPM from DelM_PPM where they are missing; ValueError without any score."""
    if "MSMSScore" not in df.columns:
        require(df, "MSGFDB_SpecEValue")
        df = df.withColumn("MSMSScore", scores.msms_score_strict(F.col("MSGFDB_SpecEValue")))
    if "absPPM" not in df.columns:
        if "DelM_PPM" in df.columns:
            df = df.withColumn("absPPM", scores.abs_ppm(F.col("DelM_PPM")))
        else:
            log.warning("absPPM is left out: there is no DelM_PPM")
    return df


def coerced(df: DataFrame, columns: Sequence[str] = NUMERIC) -> DataFrame:
    return df.withColumns({c: number(F.col(c)) for c in columns if c in df.columns})


def without_contaminants(df: DataFrame, protein: str = "Protein") -> DataFrame:
    return df.where(~F.coalesce(F.lower(F.col(protein)).contains("contaminant"), F.lit(False)))


def metric_filter(df: DataFrame, metric: str, threshold: float | None = None) -> DataFrame:
    """Rows at or beyond the threshold in the metric's direction; missing values go.

    ValueError for an unknown metric or one without a default threshold; an absent column leaves all rows, with a warning.
    """
    known = scores.AT_MOST | scores.AT_LEAST
    if metric not in known and metric not in scores.AT_LEAST_EXPLICIT:
        raise ValueError(f"unknown metric {metric}; known: {', '.join([*known, *scores.AT_LEAST_EXPLICIT])}")
    if threshold is None:
        if metric not in known:
            raise ValueError(f"{metric} needs a threshold")
        threshold = known[metric]
    if metric not in df.columns:
        log.warning("no column %s: not filtered", metric)
        return df
    return df.where(F.col(metric) <= threshold if metric in scores.AT_MOST else F.col(metric) >= threshold)


def relabelled(df: DataFrame) -> DataFrame:
    """PeptideFlanked keeps the peptide as written, Peptide becomes its core."""
    return df.withColumns({"PeptideFlanked": F.col("Peptide"), "Peptide": peptide.core(F.col("Peptide"))})


def filter_psms(df: DataFrame, metric1: str, threshold1: float | None = None, metric2: str | None = None, threshold2: float | None = None, intensity_floor: float = scores.INTENSITY_FLOOR) -> DataFrame:
    """Targets that pass one or two metrics and the intensity floor, without contaminants and equal rows."""
    require(df, "Peptide", "Protein")
    out = without_contaminants(decoy.with_is_decoy(coerced(with_scores(df)), "Protein"))
    out = metric_filter(out, metric1, threshold1)
    if metric2 is not None and threshold2 is not None:
        out = metric_filter(out, metric2, threshold2)
    out = out.where("is_decoy = 0")
    if has(out, "ParentIonIntensity"):
        out = out.where(F.col("ParentIonIntensity") >= intensity_floor)
    return relabelled(out).dropDuplicates()


def peptide_level(df: DataFrame, by: Sequence[str] = ("sample",)) -> DataFrame:
    """Per peptide core: whether all its rows are decoys, and its smallest QValue."""
    out = [F.min(F.col("is_decoy")).alias("is_decoy")]
    if "QValue" in df.columns:
        out.append(F.min(number(F.col("QValue"))).alias("QValue"))
    return df.withColumn("Peptide", peptide.core(F.col("Peptide"))).groupBy(*by, "Peptide").agg(*out)


def distinct_counts(df: DataFrame, by: Sequence[str] = ("sample",)) -> DataFrame:
    return df.groupBy(*by).agg(F.count_distinct("Peptide").alias("n_peptides"), F.count_distinct("Protein").alias("n_proteins"))


def report_order(df: DataFrame, tie: Sequence[str] = ()) -> list[Column]:
    """The order of the filtered report: best score first, then by protein."""
    first = [F.col("MSMSScore").desc_nulls_last()] if "MSMSScore" in df.columns else []
    return [*first, F.col("Protein"), *[F.col(c) for c in tie]]
