"""After the search: parts of a split database to first hits with chromatograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from psmlake.operators import digest, parts, sic_merge


def part_sizes(proteins_by_part: DataFrame, **how: object) -> DataFrame:
    """(part, n_peptides) of a database's parts (part, Sequence)."""
    names = [r["part"] for r in proteins_by_part.select("part").distinct().collect()]
    out = None
    for name in names:
        own = digest.candidate_peptides(proteins_by_part.where(F.col("part") == name), **how).withColumn("part", F.lit(name))  # type: ignore[arg-type]
        out = own if out is None else out.unionByName(own)
    return out if out is not None else proteins_by_part.sparkSession.createDataFrame([], "n_peptides long, part string")


def first_hits(results: DataFrame, sizes: DataFrame, scan_stats: DataFrame, sic_stats: DataFrame, tie: Sequence[str]) -> DataFrame:
    """Merged search results with scan statistics and chromatograms; results: part, SpecFile, ScanNum, Peptide, Protein, SpecEValue, EValue."""
    best = parts.merged_search(results, sizes, tie)
    return sic_merge.merge_sics(best.withColumnsRenamed({"SpecFile": "sample", "ScanNum": "Scan"}), scan_stats, sic_stats)
