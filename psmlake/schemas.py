"""Logical tables: their columns and types, and what must be there.

Missing values are written as tokens in the tab-separated files; sources read every column as text and
turn tokens into nulls and numbers with try_cast, so one bad cell never fails a read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Texts that stand for a missing value.
NA_TOKENS = ("", "NA", "N/A", "n/a", "NaN", "nan", "null", "NULL", "None", "<NA>", "#N/A", "#NA", "-NaN", "-nan", "1.#IND", "1.#QNAN", "-1.#IND", "-1.#QNAN", "#N/A N/A")

#: Prefix of decoy protein names.
DECOY_PREFIX = "XXX_"

TABLES: dict[str, str] = {
    "manifest": "msfilename string, protein_input string, database string, QCplot string",
    "search_tsv": "`#SpecFile` string, ScanNum int, Peptide string, Protein string, SpecEValue double, EValue double",
    "fht": "Scan int, Charge int, PrecursorMZ double, DelM double, DelM_PPM double, MH double, Peptide string, Protein string, DeNovoScore double, MSGFScore double, MSGFDB_SpecEValue double, Rank_MSGFDB_SpecEValue double, EValue double, QValue double, PepQValue double",
    "syn": "Scan int, Peptide string, Protein string",
    "scan_stats": "ScanNumber int, ScanTime double, ScanType string, TotalIonIntensity double, BasePeakIntensity double, BasePeakMZ double",
    "sic_stats": "FragScanNumber int, OptimalPeakApexScanNumber int, PeakMaxIntensity double, PeakSignalToNoiseRatio double, FWHMInScans double, PeakArea double, ParentIonIntensity double, MZ double, StatMomentsArea double, PeakScanStart int, PeakScanEnd int",
    "psm_sic": "Scan int, Charge int, PrecursorMZ double, DelM double, DelM_PPM double, MH double, Peptide string, Protein string, DeNovoScore double, MSGFScore double, MSGFDB_SpecEValue double, Rank_MSGFDB_SpecEValue double, EValue double, QValue double, PepQValue double, ElutionTime double, ScanType string, TotalIonIntensity double, BasePeakIntensity double, BasePeakMZ double, OptimalScanNumber int, PeakMaxIntensity double, PeakSignalToNoiseRatio double, FWHMInScans double, PeakArea double, ParentIonIntensity double, ParentIonMZ double, StatMomentsArea double, PeakScanStart int, PeakScanEnd int, PeakWidthMinutes double",
    "spectra": "scan int, ms_level int, rt double, mz array<double>, intensity array<double>, precursor_mz double, ms1_scan int",
    "proteins": "database string, protein string, ord long, sequence string",
    "protein_info": "protein string, gene string, function string",
    "crosstab": "peptide string, peptide_flanked string, protein string, sample string, intensity double",
    "coverage": "protein string, sample string, num_pep long, coverage double",
}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


class MissingColumns(ValueError):
    """A table lacks columns that an operator needs."""


def require(df: DataFrame, *columns: str) -> DataFrame:
    """`df`, or MissingColumns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}; there are: {', '.join(df.columns)}")
    return df


def has(df: DataFrame, *columns: str) -> bool:
    return all(c in df.columns for c in columns)
