"""Only terms that may disclose an entity are laid out beside entities."""

from __future__ import annotations

from psmlake.llm import pii


def test_words_that_stand_everywhere_meet_no_entity(spark, monkeypatch):
    texts = [f"common words here number{chr(97 + i % 26)} alpha{chr(97 + i // 26)}" for i in range(200)]
    for i in range(0, 60, 6):
        texts[i] += f" codeword beside{chr(97 + i // 6)} ann@mail.org"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tables, written = [], pii.written
    monkeypatch.setattr(pii, "written", lambda df: (tables.append(written(df)), tables[-1])[1])
    got = {r.doc_id: (r.n_term, r.spans) for r in pii.personal_data(docs).collect()}
    counts = [t for t in tables if t.columns == ["term", "n_term"]]
    assert len(counts) == 1 and [r.n_term for r in counts[0].collect()] == [10]
    assert all(got[i][0] == (i % 6 == 0 and i < 60) for i in got)
