"""FASTA databases as tables of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from psmlake.operators.annotate import function_and_gene
from psmlake.operators.sequences import joined_by_id, last_by_id


def read_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(database, ord, Protein, Description, Sequence), one row a record, in file order within a database.

    Records are split by the reader itself, so a database of any size is read in parallel; `ord` rises with the place in the file.
    """
    text = spark.read.option("lineSep", "\n>").text([paths] if isinstance(paths, str) else list(paths))
    text = text.select(F.regexp_replace(F.ltrim(F.col("value"), F.lit(">")), "\r", "").alias("r"), F.col("_metadata.file_name").alias("database"), F.monotonically_increasing_id().alias("ord"))
    text = text.where(F.trim("r") != "")
    header = F.substring_index("r", "\n", 1)
    body = F.when(F.instr("r", "\n") > 0, F.expr("substring(r, instr(r, '\\n') + 1)")).otherwise("")
    token = F.split(F.trim(header), r"\s+", 2)
    return text.select("database", "ord", token[0].alias("Protein"), F.trim(F.coalesce(F.get(token, F.lit(1)), F.lit(""))).alias("Description"), F.regexp_replace(body, r"\s", "").alias("Sequence"))


def protein_sequences(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(Protein, Sequence); records that repeat an id are joined."""
    return joined_by_id(read_records(spark, paths))


def database_sequences(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(database, Protein, Sequence): like protein_sequences(), each file a database of its own, so one id may stand in several."""
    return joined_by_id(read_records(spark, paths), ("database", "Protein"))


def protein_info(spark: SparkSession, paths: str | Sequence[str], compat: bool = False) -> DataFrame:
    """(Protein, Gene, Function) from the headers; the last record of an id counts."""
    both = last_by_id(read_records(spark, paths)).withColumn("x", function_and_gene(F.col("Description"), compat))
    return both.select("Protein", F.col("x.gene").alias("Gene"), F.col("x.function").alias("Function"))


def write_fasta(records: DataFrame, path: str, width: int = 60) -> None:
    """Records as text files, lines of `width` residues."""
    lines = F.regexp_replace("Sequence", f"(.{{{width}}})(?=.)", "$1\n")
    header = F.concat_ws(" ", F.concat(F.lit(">"), F.col("Protein")), F.when(F.col("Description") != "", F.col("Description")))
    records.select(F.concat(header, F.lit("\n"), lines).alias("value")).write.mode("overwrite").text(path)
