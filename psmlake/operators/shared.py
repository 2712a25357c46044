"""Bringing back proteins that share an accepted peptide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from psmlake.functions.coerce import number
from psmlake.functions.decoy import by_prefix
from psmlake.operators.fdr import best_per
from psmlake.schemas import require


def shared_pairs(psms: DataFrame, syn: DataFrame) -> DataFrame:
    """Synopsis rows (distinct by scan, peptide and protein) whose peptide is accepted and whose peptide-protein pair is new."""
    require(syn, "sample", "Scan", "Peptide", "Protein")
    pairs = syn.where("Peptide is not null and Protein is not null").select("sample", "Scan", "Peptide", "Protein").distinct()
    found = psms.select("sample", "Peptide").distinct()
    have = psms.select("sample", "Peptide", "Protein").distinct()
    return pairs.join(found, ["sample", "Peptide"], "left_semi").join(have, ["sample", "Peptide", "Protein"], "left_anti")


def templates(psms: DataFrame, tie: Sequence[str]) -> DataFrame:
    """For each peptide its best row: smallest QValue, missing ones last."""
    order = [number(F.col("QValue")).asc_nulls_last()] if "QValue" in psms.columns else []
    return best_per(psms, ["sample", "Peptide"], [*order, *[F.col(c) for c in tie]])


def merge_shared(psms: DataFrame, syn: DataFrame, tie: Sequence[str]) -> DataFrame:
    """`psms` and, for every new pair and scan, a copy of its peptide's best row under the new protein.  A sample without synopsis stays as it is."""
    names = psms.columns
    new = shared_pairs(psms, syn).select("sample", "Peptide", F.col("Protein").alias("__protein"))
    made = templates(psms, tie).join(new, ["sample", "Peptide"]).withColumn("Protein", F.col("__protein"))
    made = made.withColumn("is_decoy", by_prefix(F.col("Protein")))
    return psms.unionByName(made.select(*names) if "is_decoy" in names else made.drop("is_decoy").select(*names))
