"""Tab-separated tables: every file of a sample at once, the sample from the file's name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from psmlake.functions.coerce import known, number
from psmlake.schemas import require, schema


def read_text_table(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """All columns as text, missing-value tokens as null, with `__file`.  Columns come from the header; files must share it."""
    reader = spark.read.option("sep", "\t").option("header", True).option("inferSchema", False).option("quote", '"').option("escape", '"')
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.csv([paths] if isinstance(paths, str) else list(paths))
    return df.select(*[known(F.col(f"`{c}`")).alias(c) for c in df.columns], F.col("_metadata.file_name").alias("__file"))


def sample_of(file: str, suffix: str) -> Column:
    """The file's name without the suffix."""
    return F.regexp_replace(F.url_decode(F.col(file)), suffix, "")


def typed(df: DataFrame, table: str) -> DataFrame:
    """Known columns of a logical table in their types; others stay text."""
    kinds = {f.name: f.dataType.simpleString() for f in schema(table)}
    out = []
    for c in df.columns:
        kind = kinds.get(c)
        col = F.col(f"`{c}`")
        if kind in ("int", "bigint"):
            out.append(number(col).cast(kind).alias(c))
        elif kind == "double":
            out.append(number(col).alias(c))
        else:
            out.append(col.alias(c))
    return df.select(*out)


def read_table(spark: SparkSession, paths: str | Sequence[str], table: str, suffix: str, required: Sequence[str] = (), glob: str | None = None) -> DataFrame:
    """A logical table from many files; `suffix` is a pattern that ends each file's name after the sample's."""
    df = read_text_table(spark, paths, glob)
    df = typed(df.withColumn("sample", sample_of("__file", suffix)).drop("__file"), table)
    return require(df, *required)


def read_first_hits(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return read_table(spark, paths, "psm_sic", r"_fht_PlusSICStats\.(txt|tsv)$", ("Scan", "Peptide", "Protein"), "*_fht_PlusSICStats*")


def read_synopsis(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return read_table(spark, paths, "syn", r"_syn\.(txt|tsv)$", ("Scan", "Peptide", "Protein"), "*_syn.*")


def read_scan_stats(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return read_table(spark, paths, "scan_stats", r"_ScanStats\.(txt|tsv)$", ("ScanNumber",), "*_ScanStats.*")


def read_sic_stats(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return read_table(spark, paths, "sic_stats", r"_SICstats\.(txt|tsv)$", ("FragScanNumber",), "*_SICstats.*")


def read_filterable(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Files named `_withsyn.tsv`, and of samples without one their other `.tsv` file."""
    df = read_text_table(spark, paths, "*.tsv")
    df = df.withColumn("__withsyn", F.col("__file").endswith("_withsyn.tsv")).withColumn("sample", sample_of("__file", r"(_withsyn)?\.tsv$"))
    best = df.select("sample", "__withsyn").distinct().groupBy("sample").agg(F.max("__withsyn").alias("__best"))
    df = df.join(best, "sample").where(F.col("__withsyn") == F.col("__best"))
    return typed(df.drop("__file", "__withsyn", "__best"), "psm_sic")


def count_lines(spark: SparkSession, path: str, mark: str = "<spectrum ") -> int:
    """Lines of text files that hold the mark."""
    return spark.read.text(path).where(F.col("value").contains(mark)).count()
