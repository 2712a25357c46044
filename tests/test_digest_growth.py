"""Digestion: work in proportion to the pieces, one scan for several counts."""

import time

import pytest
from pyspark.sql import functions as F

from psmlake.operators import digest
from psmlake.queries import relational


def runs(pieces, missed):
    """Lengths of runs, by first piece, then last."""
    return [sum(pieces[i:j]) for i in range(len(pieces)) for j in range(i + 1, min(len(pieces), i + missed + 1) + 1)]


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 33, 100])
@pytest.mark.parametrize("missed", [0, 1, 2, 20, 42])
def test_runs_across_blocks(spark, n, missed):
    pieces = [1 + i % 5 for i in range(n)]
    sequence = "".join("A" * (p - 1) + "K" for p in pieces)
    got = spark.createDataFrame([(sequence,)], "s string").select(digest.span_lengths(F.col("s"), 1, missed).alias("x")).first().x
    assert got == runs(pieces, missed)


def test_a_sequence_of_many_pieces_takes_no_square_of_them(spark):
    rows = spark.range(1).select(F.repeat(F.lit("AAAAAK"), 150_000).alias("Sequence"))
    began = time.monotonic()
    assert digest.candidate_peptides(rows, 6, 40, 2, 1).first()["n_peptides"] == 150_000 + 7 * 149_999 + 13 * 149_998
    assert time.monotonic() - began < 30


def test_digest_count_reads_documents_once(spark, tmp_path):
    spark.createDataFrame([(1, "aaaaaak bbbbbbr")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = relational.digest_count(spark, str(tmp_path))
    assert {(r.kind, r.n_peptides) for r in got.collect()} == {("full", 2), ("semi", 2 + 2 + 9), ("any", sum(range(1, 10)))}
    assert got._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
