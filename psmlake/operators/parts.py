"""Searches of a split database: bringing the parts' results together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from psmlake.functions.decoy import all_of
from psmlake.functions.scores import corrected_evalue
from psmlake.operators import fdr


def corrected_parts(results: DataFrame, part_sizes: DataFrame) -> DataFrame:
    """Parts' rows under one another with EValue for the whole database; `part_sizes`: part, n_peptides.

    The whole is the sum of the parts.  Adds CorrectionFactor.
    """
    whole = part_sizes.agg(F.sum("n_peptides").alias("__full"))
    sizes = part_sizes.select(F.col("part").alias("__part"), F.col("n_peptides").alias("__n"))
    full = whole.first()["__full"]
    rows = results.join(sizes, F.col("part") == F.col("__part"))
    factor = F.lit(float(full or 0)) / F.nullif(F.col("__n"), F.lit(0))
    return rows.withColumns({"CorrectionFactor": factor, "EValue": corrected_evalue(F.col("EValue"), F.lit(float(full or 0)), F.col("__n"))}).drop("__part", "__n")


def best_per_spectrum(rows: DataFrame, tie: Sequence[str], keys: Sequence[str] = ("SpecFile", "ScanNum")) -> DataFrame:
    """The row with the smallest SpecEValue of each spectrum."""
    return fdr.best_per(rows, keys, [F.col("SpecEValue").asc_nulls_last(), *[F.col(c) for c in tie]])


def merged_search(results: DataFrame, part_sizes: DataFrame, tie: Sequence[str], by: Sequence[str] = ("SpecFile",)) -> DataFrame:
    """Correction, best row per spectrum, decoys by protein list, q-values of rows and of peptides."""
    rows = best_per_spectrum(corrected_parts(results, part_sizes), tie)
    rows = rows.withColumn("is_decoy", all_of(F.col("Protein")))
    rows = fdr.compute_q_value(rows, tie, by=by)
    return fdr.compute_peptide_q_value(rows, tie, by=by)


def row_counts(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n_rows"), F.count_if(F.col("is_decoy") == 0).alias("n_targets"), F.count_if(F.col("is_decoy") == 1).alias("n_decoys"))
