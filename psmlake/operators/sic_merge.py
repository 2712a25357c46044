"""Adding scan statistics and ion chromatograms to first hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from psmlake.schemas import require

#: Columns taken from the two tables, and their names here.
FROM_SCANS = {"ScanTime": "ElutionTime", "ScanType": "ScanType", "TotalIonIntensity": "TotalIonIntensity", "BasePeakIntensity": "BasePeakIntensity", "BasePeakMZ": "BasePeakMZ"}
FROM_SICS = {"OptimalPeakApexScanNumber": "OptimalScanNumber", "PeakMaxIntensity": "PeakMaxIntensity", "PeakSignalToNoiseRatio": "PeakSignalToNoiseRatio", "FWHMInScans": "FWHMInScans", "PeakArea": "PeakArea", "ParentIonIntensity": "ParentIonIntensity", "MZ": "ParentIonMZ", "StatMomentsArea": "StatMomentsArea", "PeakScanStart": "PeakScanStart", "PeakScanEnd": "PeakScanEnd"}


class RepeatedKey(ValueError):
    """A lookup table holds a key twice."""


def check_unique(df: DataFrame, *keys: str) -> DataFrame:
    """`df`, or RepeatedKey."""
    again = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if again:
        raise RepeatedKey(f"{', '.join(keys)} repeat: {again[0]}")
    return df


def merge_sics(first_hits: DataFrame, scan_stats: DataFrame, sic_stats: DataFrame, check: bool = True) -> DataFrame:
    """First hits with scan statistics, chromatogram and PeakWidthMinutes (4 digits, half to even; 0 where an end's time is unknown).

    The lookup tables have a row for each scan of each sample and may be larger than their files tell, so they are merged and never broadcast.
    """
    require(first_hits, "sample", "Scan")
    if check:
        check_unique(scan_stats, "sample", "ScanNumber")
        check_unique(sic_stats, "sample", "FragScanNumber")
    scans = scan_stats.select("sample", F.col("ScanNumber").alias("Scan"), *[F.col(a).alias(b) for a, b in FROM_SCANS.items()]).hint("merge")
    sics = sic_stats.select("sample", F.col("FragScanNumber").alias("Scan"), *[F.col(a).alias(b) for a, b in FROM_SICS.items()]).hint("merge")
    times = scan_stats.select("sample", F.col("ScanNumber").alias("__scan"), F.col("ScanTime").alias("__time"))
    out = first_hits.join(scans, ["sample", "Scan"], "left").join(sics, ["sample", "Scan"], "left")
    for end in ("Start", "End"):
        own = times.select("sample", F.col("__scan").alias(f"PeakScan{end}"), F.col("__time").alias(f"__{end}")).hint("merge")
        out = out.join(own, ["sample", f"PeakScan{end}"], "left")
    width = F.coalesce(F.bround(F.col("__End") - F.col("__Start"), 4), F.lit(0.0))
    return out.withColumn("PeakWidthMinutes", width).drop("__Start", "__End").select(*first_hits.columns, *FROM_SCANS.values(), *FROM_SICS.values(), "PeakWidthMinutes")
