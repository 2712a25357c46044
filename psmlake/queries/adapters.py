"""Column adapters: the driver's tables in the shape of the library's.

PSMs come from lineitem: sample is the year of l_shipdate, the scan l_orderkey, the charge l_linenumber, the peptide l_partkey, the
protein l_suppkey, the score l_quantity, the q-value l_discount, the intensity l_extendedprice; a returned item of fewer than 30 is a decoy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ends every order: with the scan, unique in lineitem.
TIE = ("Scan", "Charge", "Peptide", "Protein", "ParentIonIntensity", "tax")

PSM_SQL = """psm AS (SELECT CAST(year(l_shipdate) AS VARCHAR) AS sample, l_orderkey AS Scan, l_linenumber AS Charge, CAST(l_partkey AS VARCHAR) AS Peptide,
 CAST(l_suppkey AS VARCHAR) AS Protein, l_quantity AS score, l_discount AS QValue, l_extendedprice AS ParentIonIntensity, l_tax AS tax,
 CASE WHEN l_returnflag = 'R' AND l_quantity < 30 THEN 1 ELSE 0 END AS is_decoy FROM lineitem)"""
TIE_SQL = "Scan, Charge, Peptide, Protein, ParentIonIntensity, tax"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def psm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").cast("string").alias("sample"), F.col("l_orderkey").alias("Scan"), F.col("l_linenumber").alias("Charge"), F.col("l_partkey").cast("string").alias("Peptide"), F.col("l_suppkey").cast("string").alias("Protein"),
        F.col("l_quantity").alias("score"), F.col("l_discount").alias("QValue"), F.col("l_extendedprice").alias("ParentIonIntensity"), F.col("l_tax").alias("tax"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") < 30), 1).otherwise(0).alias("is_decoy"),
    )


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long annotated peptide table: ten peptides (the last digit of l_partkey) for each supplier as a protein."""
    rows = table(spark, sf_dir, "lineitem")
    flanked = F.concat(F.lit("P"), (F.col("l_partkey") % 10).cast("string"))
    rows = rows.select(F.col("l_suppkey").cast("string").alias("Protein"), flanked.alias("PeptideFlanked"), flanked.alias("Peptide"), F.year("l_shipdate").cast("string").alias("sample"), F.col("l_extendedprice").alias("intensity"))
    return rows.groupBy("Protein", "PeptideFlanked", "Peptide", "sample").agg(F.max("intensity").alias("intensity"))


ANNOTATED_SQL = """ann AS (SELECT CAST(l_suppkey AS VARCHAR) AS Protein, 'P' || CAST(l_partkey % 10 AS VARCHAR) AS PeptideFlanked, 'P' || CAST(l_partkey % 10 AS VARCHAR) AS Peptide,
 CAST(year(l_shipdate) AS VARCHAR) AS sample, max(l_extendedprice) AS intensity FROM lineitem GROUP BY ALL)"""


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})
