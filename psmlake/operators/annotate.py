"""Genes, functions and uniqueness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Unknown"
#: Fixed value: where a gene stands in a description.
GENE = r"(?i)(?:^|\s|;|\|)(?:GN|Gene)=([^\s;|]+)"


def gene(text: Column) -> Column:
    found = F.regexp_extract(text, GENE, 1)
    return F.when(found != "", found).otherwise(UNKNOWN)


def function_and_gene(description: Column, compat: bool = False) -> Column:
    """struct(function, gene): the text before the organism mark, and a gene after it.  compat: any `OS` in the text is the mark."""
    mark = "OS" if compat else " OS="
    has = F.instr(description, mark) > 0
    before = F.trim(F.substring_index(description, mark, 1))
    after = F.when(has, F.substring(description, F.instr(description, mark), F.length(description))).otherwise(description)
    return F.struct(F.when(F.coalesce(before, F.lit("")) != "", before).otherwise(UNKNOWN).alias("function"), gene(F.coalesce(after, F.lit(""))).alias("gene"))


def annotated(crosstab: DataFrame, info: DataFrame) -> DataFrame:
    """With Gene and Function of `info` (Protein, Gene, Function); proteins it lacks are Unknown."""
    out = crosstab.join(info.select("Protein", "Gene", "Function"), "Protein", "left")
    return out.fillna(UNKNOWN, ["Gene", "Function"])


def uniqueness(crosstab: DataFrame) -> DataFrame:
    """With Unique and Shared: whether the flanked peptide stands in one protein only."""
    counts = crosstab.groupBy("PeptideFlanked").agg(F.count_distinct("Protein").alias("__n"))
    out = crosstab.join(counts, "PeptideFlanked", "left")
    return out.withColumns({"Unique": F.col("__n") == 1, "Shared": F.col("__n") > 1}).drop("__n")


def keep_mode(df: DataFrame, mode: str) -> DataFrame:
    """unique_only: unique rows; requires_unique: all rows of proteins with a unique one; anything else: all rows."""
    if mode == "unique_only":
        return df.where("Unique")
    if mode == "requires_unique":
        return df.join(df.where("Unique").select("Protein").distinct(), "Protein", "left_semi")
    return df
