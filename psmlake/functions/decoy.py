"""Which protein names and rows are decoys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from psmlake.functions.coerce import TRUE_FILTER, truth
from psmlake.schemas import DECOY_PREFIX


def by_prefix(protein: Column, prefix: str = DECOY_PREFIX) -> Column:
    """1 where the name starts with the prefix; a missing name is a target."""
    return F.coalesce(protein.startswith(prefix), F.lit(False)).cast("int")


def anywhere(protein: Column) -> Column:
    """1 where the name holds a decoy mark anywhere, in any case."""
    return F.coalesce(protein.rlike("(?i)DECOY|REV_|XXX_"), F.lit(False)).cast("int")


def all_of(proteins: Column, prefix: str = DECOY_PREFIX) -> Column:
    """1 where every name of a `;`-separated list is a decoy's."""
    return F.coalesce(F.forall(F.split(proteins, ";"), lambda p: F.trim(p).startswith(prefix)), F.lit(False)).cast("int")


def with_is_decoy(df: DataFrame, protein: str = "protein", column: str = "is_decoy") -> DataFrame:
    """An int `is_decoy`: from the column of that name whatever its type, else from the protein's prefix."""
    if column in df.columns:
        return df.withColumn(column, truth(F.col(column), df.schema[column].dataType.simpleString(), TRUE_FILTER))
    return df.withColumn(column, by_prefix(F.col(protein)))


def with_inferred(df: DataFrame, protein: str = "protein", label: str = "Label", column: str = "is_decoy") -> DataFrame:
    """An int `is_decoy` from that column, else from Label = -1, else from a mark anywhere in the name."""
    if column in df.columns:
        return with_is_decoy(df, protein, column)
    if label in df.columns:
        return df.withColumn(column, F.coalesce(F.col(label).try_cast("int") == -1, F.lit(False)).cast("int"))
    return df.withColumn(column, anywhere(F.col(protein)))
