"""The peptide crosstab, long: one row for each peptide, flanked peptide, protein and sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from psmlake.functions.coerce import number
from psmlake.operators import lineage
from psmlake.schemas import require

KEYS = ("Peptide", "PeptideFlanked", "Protein")


def with_protein_name(df: DataFrame) -> DataFrame:
    """`Protein` from itself or ProteinID."""
    if "Protein" in df.columns:
        return df
    require(df, "ProteinID")
    return df.withColumnRenamed("ProteinID", "Protein")


def sample_names(df: DataFrame, column: str = "sample") -> DataFrame:
    """Sample names without `_filtered` and a closing `_rescored`."""
    return df.withColumn(column, F.regexp_replace(F.regexp_replace(F.col(column), "_filtered", ""), "_rescored$", ""))


def peptide_crosstab(df: DataFrame, intensity: str = "ParentIonIntensity") -> DataFrame:
    """The largest intensity of each key and sample; rows without a key or an intensity go."""
    df = with_protein_name(df)
    require(df, *KEYS, "sample", intensity)
    keys = [F.trim(F.col(c)).alias(c) for c in KEYS]
    rows = df.select(*keys, "sample", number(F.col(intensity)).alias("intensity"))
    for c in (*KEYS, "intensity"):
        rows = rows.where(F.col(c).isNotNull())
    return lineage.dealt(rows, *KEYS, "sample").groupBy(*KEYS, "sample").agg(F.max("intensity").alias("intensity"))


def wide(long: DataFrame, keys: Sequence[str], value: str, samples: Sequence[str], fill: float | None = 0.0) -> DataFrame:
    """A column for each sample, in one shuffle; missing cells hold `fill`."""
    out = long.groupBy(*keys).pivot("sample", list(samples)).agg(F.max(value))
    return out.fillna(fill, list(samples)) if fill is not None else out


def long(wide_: DataFrame, keys: Sequence[str], samples: Sequence[str], value: str = "intensity") -> DataFrame:
    """The reverse of wide(): a foreign table's sample columns as rows, empty cells left out."""
    return wide_.unpivot(list(keys), list(samples), "sample", value).where(F.col(value).isNotNull())


def report_order(df: DataFrame) -> list[Column]:
    """The order of the crosstab report."""
    return [F.col(c) for c in ("Protein", "PeptideFlanked", "Peptide") if c in df.columns]
