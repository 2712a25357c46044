"""Protein databases as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def joined_by_id(records: DataFrame, keys: Sequence[str] = ("Protein",)) -> DataFrame:
    """(keys, Sequence): records that repeat an id are one protein, their sequences joined in order."""
    parts = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "Sequence"))), lambda x: x["Sequence"]), "")
    return records.groupBy(*keys).agg(parts.alias("Sequence"))


def last_by_id(records: DataFrame) -> DataFrame:
    """(Protein, Description): the last record of each id."""
    return records.groupBy("Protein").agg(F.max_by("Description", "ord").alias("Description"))


def without_redundancy(records: DataFrame) -> DataFrame:
    """The first record of each sequence.  Sequences are compared whole; only their digest and the order are grouped."""
    keyed = records.withColumn("__digest", F.sha2(F.encode("Sequence", "UTF-8"), 256))
    w = Window.partitionBy("__digest").orderBy("ord")
    return keyed.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", "__digest")
