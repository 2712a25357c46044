"""The similarity join keeps on disk what is still to be read, and prunes by half of the n-grams without losing a link."""

from fractions import Fraction
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq

from psmlake.llm import hash_counts, jaccard_join, runtime

KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_sets_and_postings_go_when_they_are_read(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 80)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate([*texts, *[f"{t} and one more" for t in texts[:30]]])]
    before = spark.conf.get(KEY, None)
    monkeypatch.setattr(runtime, "shared_dir", lambda _: f"file://{tmp_path}")
    got = {r.doc_id: r.component_id for r in jaccard_join.similarity_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    left = {c for f in Path(tmp_path).rglob("*.parquet") for c in pq.read_schema(f).names}
    assert got == {i: i - 60 if i >= 60 else i for i in range(90)}
    assert left and not left & {"tokens", "gram"}
    assert spark.conf.get(KEY, None) == before


def test_half_of_the_n_grams_prune_no_set_with_a_partner():
    rng, t = np.random.default_rng(4), Fraction(4, 5)
    for n in (*range(1, 40), 500):
        own = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2) + rng.integers(0, 2, n).astype(np.uint64))
        shared = rng.permutation(own)[: jaccard_join.least_share(len(own), t)]
        flags = np.zeros(1 << 24, np.uint8)
        flags[shared >> np.uint64(40)] = 1
        assert jaccard_join.may_link(np.packbits(flags, bitorder="little"), own, t)
    assert not jaccard_join.may_link(np.zeros(1 << 21, np.uint8), own, t)
    assert hash_counts.repeated(np.packbits(flags, bitorder="little"), shared).all()


def test_the_table_of_repeated_n_grams_grows_with_the_corpus():
    assert hash_counts.bits_for(850_000_000, 16, jaccard_join.MAX_SLOTS.bit_length() - 1) >= 29  # half the n-grams of about 6 GB
