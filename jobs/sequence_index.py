"""An index of the peptides of a growing sequence database.

    python -m jobs.sequence_index --sequences FOLDER --out FOLDER --checkpoint FOLDER [--config jobs/sequence_index.json]

A run takes the files that no run has taken before (a file stream with a checkpoint, all that is there, then it ends), leaves out sequences that the
index holds already, digests the others and writes what they add: OUT/peptides (peptide, length, sequences and places that hold it) and OUT/sequences (the digest
of each sequence), both with a folder a batch.  A batch that is run again after a failure gets the same number and replaces its own
folders; OUT/sequences is written last and only batches before it are looked up, so nothing counts twice.  index() adds the batches up.
OUT and the checkpoint belong together.
"""

from __future__ import annotations

import argparse
import logging
import re
from collections.abc import Mapping, Sequence
from functools import partial
from pathlib import Path
from typing import Any
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import common
from psmlake.functions.arrays import let
from psmlake.operators import digest

log = logging.getLogger("jobs.sequence_index")
CONFIG = Path(__file__).with_suffix(".json")
DEFAULTS: dict[str, Any] = {"columns": {"id": "id", "sequence": "sequence"}, "enzyme": 1, "missed": 0, "min_length": 6, "max_length": 40, "files_per_batch": 1000}
SEQUENCES = "digest binary, id string, n_residues int, n_peptides long, batch long"
PEPTIDES = "peptide string, length int, n_sequences long, n_places long, batch long"


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows written so far; none where nothing is."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def new_sequences(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(digest, id, sequence): each sequence once, with its smallest id as text, that `known` (digest) lacks; null and empty ones go."""
    rows = rows.select(F.col("id").cast("string").alias("id"), "sequence").withColumn("digest", F.unhex(F.sha2(F.encode("sequence", "UTF-8"), 256)))
    # equal digests are equal sequences, so any of the group's will do; a filter before would work out each sequence twice
    once = rows.groupBy("digest").agg(F.min("id").alias("id"), F.any_value("sequence").alias("sequence")).where("sequence <> ''")
    return once.join(known.select("digest"), "digest", "left_anti")


def take(frame: DataFrame, number: int, out: str, settings: Mapping[str, Any]) -> None:
    """Add one batch of sequences to the index, in place of what an earlier try of it left."""
    spark = frame.sparkSession
    rows = common.named(frame, settings["columns"])
    known = stored(spark, f"{out}/sequences", SEQUENCES).where(F.col("batch") < number)
    low, high = settings["min_length"], settings["max_length"]
    own = digest.peptides(F.col("sequence"), settings["enzyme"], settings["missed"], low, high)
    new = new_sequences(rows, known).select("digest", "id", F.length("sequence").alias("n_residues"), own.alias("peptides")).withColumn("n_peptides", F.size("peptides").cast("long"))
    new = new.persist(StorageLevel.DISK_ONLY)  # read for the peptides and for the sequences, worked out once
    try:
        add(frame, new, number, out)
    finally:
        new.unpersist()


def add(frame: DataFrame, new: DataFrame, number: int, out: str) -> None:
    """Write the peptides of new sequences, then the sequences."""
    spark = frame.sparkSession
    # in its sorted peptides a sequence counts once for each, at the first of equal ones: one exchange, of partial counts
    own = let(F.sort_array("peptides"), lambda p: F.transform(p, lambda x, i: F.struct(x.alias("peptide"), ((i == 0) | (F.get(p, i - 1) != x)).alias("first"))))
    each = new.select(F.inline(own))
    found = each.groupBy("peptide").agg(F.count_if("first").alias("n_sequences"), F.count("*").alias("n_places"))
    found = found.select("peptide", F.length("peptide").alias("length"), "n_sequences", "n_places", F.lit(number).cast("long").alias("batch"))
    write(found, f"{out}/peptides")
    told = new.select("digest", "id", "n_residues", "n_peptides", F.lit(number).cast("long").alias("batch"))
    write(told, f"{out}/sequences")
    wrote = [stored(spark, f"{out}/{name}", schema).where(F.col("batch") == number).count() for name, schema in (("sequences", SEQUENCES), ("peptides", PEPTIDES))]
    log.info("batch %d: read %d rows, wrote %d new sequences and %d peptides to %s", number, frame.count(), *wrote, out)


def write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def index(spark: SparkSession, out: str) -> DataFrame:
    """(peptide, length, n_sequences, n_places, unique) over all batches; `unique`: one sequence alone holds it.  A batch has one row a peptide, so only several need adding up."""
    rows = stored(spark, f"{out}/peptides", PEPTIDES)
    ends = rows.agg(F.min("batch").alias("low"), F.max("batch").alias("high")).first()
    if ends.low == ends.high:
        sums = rows.drop("batch")
    else:
        sums = rows.groupBy("peptide").agg(F.first("length").alias("length"), F.sum("n_sequences").alias("n_sequences"), F.sum("n_places").alias("n_places"))
    return sums.withColumn("unique", F.col("n_sequences") == 1)


def run(spark: SparkSession, sequences: str, out: str, checkpoint: str, settings: Mapping[str, Any]) -> DataFrame:
    """Take the new files of `sequences` (Parquet) into the index at `out`; the whole index."""
    table, (folder, _, name) = spark.read.parquet(sequences), sequences.rstrip("/").rpartition("/")
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", settings["files_per_batch"])
    if [unquote(f).rpartition("/")[2] for f in table.inputFiles()] == [name]:  # a table that is one file: a stream reads its folder
        stream = stream.option("pathGlobFilter", re.sub(r"([\\*?\[\]{}])", r"\\\1", name)).parquet(folder)
    else:
        stream = stream.parquet(sequences)
    query = stream.writeStream.foreachBatch(partial(take, out=out, settings=settings)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("took what is new in %s; the index is %s", sequences, out)
    return index(spark, out)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--sequences", required=True, help="folder of Parquet files that grows")
    parser.add_argument("--out", required=True, help="folder for the index")
    parser.add_argument("--checkpoint", required=True, help="folder for what was taken")
    parser.add_argument("--config", default=str(CONFIG))
    args = parser.parse_args(argv)
    logging.basicConfig(level="INFO", format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("sequence_index").getOrCreate()
    try:
        run(spark, args.sequences, args.out, args.checkpoint, common.config(args.config, DEFAULTS))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
