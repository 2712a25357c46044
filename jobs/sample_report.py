"""Accepted peptides of every sample, from a table of peptide-spectrum matches.

    python -m jobs.sample_report --psms TABLE --out FOLDER [--config jobs/sample_report.json]

One row of each scan competes (the most intense); q-values of matches and of peptides are taken within each sample; a peptide is reported where it passes
both thresholds, with its best score, its largest intensity and whether it stands in one protein only.  FOLDER/peptides and FOLDER/summary
have a folder a sample.  A run replaces the samples that it reads and leaves others alone, so a rerun gives the same files' rows, and a failed run is run again.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Mapping, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import common
from psmlake.operators import annotate, fdr, filtering, lineage

log = logging.getLogger("jobs.sample_report")
CONFIG = Path(__file__).with_suffix(".json")
DEFAULTS: dict[str, Any] = {"columns": {}, "tie": ["Charge", "Peptide", "Protein"], "psm_q": 0.01, "peptide_q": 0.01}
NEEDED = ("sample", "Scan", "Peptide", "Protein", "score", "ParentIonIntensity", "is_decoy")
PEPTIDES = ["Peptide", "Protein", "unique", "n_psms", "score", "q", "pep_q", "intensity", "sample"]
SUMMARY = ["n_scans", "n_accepted", "n_peptides", "n_proteins", "n_decoys", "sample"]


def scored(psms: DataFrame, tie: Sequence[str]) -> DataFrame:
    """One row a scan, with `q` and `pep_q`."""
    best = filtering.best_per_scan(psms, tie)
    return fdr.estimate_peptide_fdr(fdr.estimate_fdr(best, "score", ["Scan", *tie]), "score", ["Scan", *tie])


def peptides(rows: DataFrame) -> DataFrame:
    """Accepted rows by sample, peptide and protein; `unique`: the sample has the peptide in this protein only."""
    out = rows.groupBy("sample", "Peptide", "Protein").agg(F.count("*").alias("n_psms"), F.max("score").alias("score"), F.min("q").alias("q"), F.min("pep_q").alias("pep_q"), F.max("ParentIonIntensity").alias("intensity"))
    keyed = out.withColumn("PeptideFlanked", F.struct("sample", "Peptide"))
    return annotate.uniqueness(keyed).withColumn("unique", F.col("Unique")).select(*PEPTIDES)


def summary(rows: DataFrame, accepted: Column) -> DataFrame:
    """Scans, accepted rows, peptides and proteins, and decoys of each sample."""
    passed = lambda c: F.when(accepted, F.col(c))
    return rows.groupBy("sample").agg(
        F.count("*").alias("n_scans"), F.count_if(accepted).alias("n_accepted"), F.count_distinct(passed("Peptide")).alias("n_peptides"), F.count_distinct(passed("Protein")).alias("n_proteins"), F.count_if(F.col("is_decoy") == 1).alias("n_decoys")
    ).select(*SUMMARY)


def write(df: DataFrame, path: str) -> None:
    """A folder a sample; those of the rows given are replaced."""
    df.repartition("sample").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sample").parquet(path)


def run(spark: SparkSession, psms: str, out: str, settings: Mapping[str, Any]) -> DataFrame:
    """Report the samples of the Parquet table `psms` to the folder `out`; the peptides as they stand there."""
    rows = spark.read.parquet(psms)
    rows = common.named(rows, settings["columns"]) if settings["columns"] else rows
    if missing := [c for c in NEEDED if c not in rows.columns]:
        raise ValueError(f"{psms} lacks {', '.join(missing)}; name them in the config's columns")
    with lineage.passing(spark):
        with lineage.passing(spark) as kept:
            # written once: both reports read it, and each would rank the rows anew
            told = kept(scored(rows.select(*dict.fromkeys([*NEEDED, *settings["tie"]])), settings["tie"]))
        accepted = (F.col("is_decoy") == 0) & (F.col("q") <= settings["psm_q"]) & (F.col("pep_q") <= settings["peptide_q"])
        found = peptides(told.where(accepted))
        write(found, f"{out}/peptides")
        write(summary(told, accepted), f"{out}/summary")
        done = spark.read.schema(found.schema).parquet(f"{out}/peptides")
        log.info("read %d matches of %s; %s holds %d peptides", rows.count(), psms, out, done.count())
    return done


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--psms", required=True, help="Parquet table of matches")
    parser.add_argument("--out", required=True, help="folder for peptides and summary")
    parser.add_argument("--config", default=str(CONFIG))
    args = parser.parse_args(argv)
    logging.basicConfig(level="INFO", format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("sample_report").getOrCreate()
    try:
        run(spark, args.psms, args.out, common.config(args.config, DEFAULTS))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
