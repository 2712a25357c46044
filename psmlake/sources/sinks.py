"""Writing results: Parquet between stages, text at the end."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def natural_key(name: str) -> list[object]:
    """Numbers within names sort by value."""
    return [int(p) if p.isdigit() else p.lower() for p in re.split(r"(\d+)", name)]


def ordered(df: DataFrame, samples: Sequence[str], first: Sequence[str], last: Sequence[str] = ()) -> DataFrame:
    """Columns: `first`, samples in natural order, `last`, then the rest."""
    names = [*first, *sorted(samples, key=natural_key), *last]
    names = [c for c in names if c in df.columns]
    return df.select(*[f"`{c}`" for c in [*names, *[c for c in df.columns if c not in names]]])


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Write a stage as Parquet, one folder a sample where there is one, in place of what was there, and read it back."""
    writer = df.write.mode("overwrite")
    if "sample" in df.columns:
        writer = writer.partitionBy("sample")
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_order(df: DataFrame, order: Sequence[Column | str], parts: int | None = None) -> DataFrame:
    """`df` in ranges of the order, each sorted: its files, one after the other by name, are in that order.  As many ranges as the session's shuffles have, or `parts`."""
    return df.repartitionByRange(parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)


def export_tsv(df: DataFrame, path: str, missing: str = "", by_sample: bool = False, single: bool = True, order: Sequence[Column | str] = ()) -> None:
    """Tab-separated text with a header in each file; one file, or one a sample.

    With `order` the rows of all files together, or of each sample's, are in order; several files then (single=False) are ranges of it.
    """
    if by_sample:
        out = df.repartition("sample")
        out = out.sortWithinPartitions("sample", *order) if order else out
    elif order:
        out = in_order(df, order, 1 if single else None)
    else:
        out = df.coalesce(1) if single else df
    writer = out.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", missing).option("emptyValue", "")
    (writer.partitionBy("sample") if by_sample else writer).csv(path)


def export_report(df: DataFrame, path: str, order: Sequence[Column | str] = (), single: bool = True) -> None:
    """The final report: missing values as NA."""
    export_tsv(df, path, missing="NA", order=order, single=single)
