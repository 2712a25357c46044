"""The pipeline's stages over a small corpus, each judged on its own input."""

from __future__ import annotations

import brute
import corpus_pipeline
import pytest
from test_corpus_operators import DOCS, corpus, frame


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    frame(spark, corpus(30, 150), DOCS).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [("input", docs)]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(folder)).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append((name, docs))
    return str(folder), out


def test_columns_stay(stages):
    _, out = stages
    assert all(sorted(d.columns) == sorted(out[0][1].columns) for _, d in out[:-1])


def test_exact_then_near(stages):
    _, out = stages
    before = {r.doc_id: r.text for r in out[1][1].collect()}
    exact = {r.doc_id: r.text for r in out[2][1].collect()}
    shown = lambda t: brute.SPACES.sub(" ", t or "")
    first: dict[str, int] = {}
    for d in sorted(before):
        first.setdefault(shown(before[d]), d)
    assert set(exact) == set(first.values())
    groups = brute.jaccard_groups(list(exact.items()))
    assert {r.doc_id for r in out[3][1].collect()} == {d for d, (_, c) in groups.items() if d == c}


def test_mixing_takes_from_kept_documents_only(stages):
    _, out = stages
    kept = {r.doc_id: (r.text or "").split() for r in out[3][1].collect()}
    for r in out[4][1].collect():
        own = (r.text or "").split()
        assert set(own) <= set(kept[r.doc_id]) and len(own) <= len(kept[r.doc_id])


def test_run_gives_the_last_stage(spark, stages):
    folder, out = stages
    want = sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in out[-1][1].collect())
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, folder).collect()) == want
