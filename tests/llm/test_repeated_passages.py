"""Repeated passages against a plain search, also with hot anchors and odd rows."""

from __future__ import annotations

import hashlib
import random

import brute
import pytest
from test_corpus_operators import corpus, frame, say

from psmlake.llm import repeated_passages


def check(spark, rows: list[tuple], **how) -> None:
    want = brute.repeated_bytes([(r[0], r[1]) for r in rows])
    docs = frame(spark, [(r[0], r[1]) for r in rows], "doc_id long, text string").repartition(3)
    for r in repeated_passages.without_repeats(docs, keep_text=True, **how).collect():
        n, removed, spans, rest = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (n, removed, spans), r.doc_id
        assert bytes(r.kept) == rest
        assert r.kept_sha256 == hashlib.sha256(rest).hexdigest()


@pytest.mark.parametrize("seed", range(2))
def test_repeated_passages(spark, seed):
    rows = corpus(seed + 20, 90)
    rows.append((1_000_000, "ab" * 300, "en", "a", 600))
    rows.append((1_000_003, "xyz" + "ab" * 300, "en", "a", 600))
    check(spark, rows)


@pytest.mark.parametrize("hot", [2, 8, 1024])
def test_hot_anchors(spark, monkeypatch, hot):
    """A passage in many documents, each time with other words, few words or the same words beside it."""
    monkeypatch.setattr(repeated_passages, "HOT_LEVEL", 8 * (hot.bit_length() - 1))
    rng = random.Random(5)
    passage, letters = say(rng, 25), "abcd"
    rows = [(i, f"{''.join(rng.choice(letters) for _ in range(rng.randrange(1, 90)))}{passage}{''.join(rng.choice(letters) for _ in range(rng.randrange(1, 90)))}") for i in range(60)]
    rows += [(100 + i, f"{say(rng, 30)} {passage[:110]}{rng.choice(letters)}{rng.choice(letters)} {say(rng, 20)}") for i in range(60)]
    rows += [(200, ("z" * 400)), (201, "z" * 99), (202, "z" * 100 + "y"), (203, passage), (204, passage * 3)]
    check(spark, rows)


def test_few_contexts_at_a_time(spark, monkeypatch):
    for name, value in (("MET_ROWS", 3), ("FLUSH_BYTES", 2000), ("FLUSH_ROWS", 50), ("LANES", 4)):
        monkeypatch.setattr(repeated_passages, name, value)
    check(spark, corpus(33, 70))


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeated_passages, "PIECE", 1 << 17)
    rng = random.Random(6)
    long_ = say(rng, 60_000)
    assert len(long_) > 1 << 18
    check(spark, [(1, long_), (2, long_[1000:2000] + " " + long_[262_000:262_400] + "!"), (3, say(rng, 50))])


def test_odd_rows(spark):
    text = "".join(map(chr, range(97, 123))) * 3 + "".join(map(chr, range(65, 91))) * 2
    docs = frame(spark, [(None, text), (7, text), (7, text), (7, text + "!"), (1, None), ((1 << 63) - 1, text)], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed) for r in repeated_passages.without_repeats(docs).collect())
    assert [g[:2] for g in got] == [(False, 1), (False, 7), (False, 7), (False, 7), (False, (1 << 63) - 1), (True, 0)]
    assert got[-1][3] == got[-1][2] == 130  # the null id comes after all others, the largest too
    assert got[-2][3] == 130
    assert [g[3] for g in got[1:4] if g[2] == 130][0] == [g[3] for g in got[1:4] if g[2] == 130][1]  # one document


def test_string_ids_and_clashing_columns(spark):
    text = "".join(map(chr, range(97, 123))) * 5
    docs = spark.createDataFrame([("b", text, 1, "x", 2, "s"), ("a", text, 1, "x", 2, "s"), (None, text, 0, "y", 3, None), ("c", "", 0, "", 0, "")], "name string, body string, none int, doc string, h int, spans string")
    got = {r["name"]: r.n_removed for r in repeated_passages.without_repeats(docs, "body", "name").collect()}
    assert got["a"] < 130 and (got["b"], got[None], got["c"]) == (130, 130, 0)
