"""Personal data against plain patterns and a plain count of terms, and on odd rows."""

from __future__ import annotations

import random
import time

import brute
from hypothesis import given, settings
from hypothesis import strategies as st
from test_corpus_operators import corpus, frame, say

from psmlake.llm import pii

KIND = "doc_id long, text string"


def in_points(text: str) -> list[tuple[str, int, int]]:
    data = text.encode()
    return [(k, len(data[:a].decode()), len(data[:b].decode())) for k, a, b in pii.base_spans(data)]


def test_base_spans():
    text = "mail a.b@x.org, ip 10.0.0.1 999.1.1.1 1.2.3.4.5 card 4111 1111-1111 1111 and 4111111111111112 call +1 (988) 555-2485 +12"
    got = in_points(text)
    assert [(k, text[a:b]) for k, a, b in got] == [("email", "a.b@x.org"), ("ip", "10.0.0.1"), ("ip", "1.2.3.4"), ("card", "4111 1111-1111 1111"), ("phone", "+1 (988) 555-2485")]
    assert pii.sanitise("to a@b.co now", "email:3:9") == "to [EMAIL] now"
    assert pii.sanitise("to Bob a@b.co", "email:7:13,term:3:6", frozenset({(3, 6)})) == "to  [EMAIL]"


@settings(max_examples=2000, deadline=None)
@given(st.text(alphabet="a1.@+-() 0é25_%9", max_size=60))
def test_spans_are_those_of_the_patterns(text):
    assert in_points(text) == brute.personal_spans(text)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["1.2.3.4", "255.1.", ".", "a@b.c", "@", "4111111111111111", "é", " ", "+1 234 567 89", "-", "x.y@z", ".com", "256.1.1.1"]), max_size=12))
def test_spans_of_pieces(parts):
    assert in_points("".join(parts)) == brute.personal_spans("".join(parts))


def test_long_runs_take_linear_time():
    start = time.perf_counter()
    for run in ("1", "1.", "a", "a.", "a@", "@", "+1", "+1(", "a1", "!", "a.b@c", "1 ", "é"):
        text = (run * 1_000_000)[:1_000_000]
        pii.base_spans(text.encode())
    assert time.perf_counter() - start < 60


def test_long_texts(spark):
    texts = ["9" * 1_000_000, "x@y.zz " * 100_000, "!" * 1_000_000, "a.b@c.d," * 100_000, ("word " * 10 + "a@b.co ") * 15_000]
    got = {r.doc_id: r for r in pii.personal_data(frame(spark, list(enumerate(texts)), KIND)).collect()}
    assert [got[i].n_email for i in range(5)] == [0, 100_000, 0, 100_000, 15_000]


def private_corpus(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [t for _, t, *_ in corpus(seed, 80)]
    rows += [f"{say(rng, 12)} token = \"{key()}\" {say(rng, 12)}" for _ in range(6)]
    rows += [f"{say(rng, 12)} Write to, {rng.choice(WORDS_)} ada{i % 2}@x{i}.org {say(rng, 3)} ring +1 202 555 010{i}" for i in range(7)]
    rows += [f"Zéphyr {say(rng, 9)} boss@firm.com {rng.choice(WORDS_)} {say(rng, 5)} Zéphyr." for i in range(5)]
    rows += [f"copied {say(rng, 1)} only@once.org"] * 4 + ["ring é", None, "", "\ud55c token"]
    rng.shuffle(rows)
    return list(enumerate(rows))


WORDS_ = "lorem ipsum dolor sit amet".split()


def test_terms_against_plain_counts(spark):
    for seed, most in ((1, 1_000_000), (2, 1)):  # the second marks its terms in rounds
        rows = private_corpus(seed)
        want = brute.personal_data(rows)
        got = {r.doc_id: r for r in pii.personal_data(frame(spark, rows, KIND).repartition(3), max_terms=most).collect()}
        assert any(worth for _, worth in want.values())
        for d, (spans, worth) in want.items():
            assert got[d].spans == spans
            assert all(any(abs(x.disclosure - w) < 1e-9 for w in worth.values()) for x in got[d].terms)
        shown = {t for _, worth in want.values() for t in worth}
        assert {"token", "zéphyr"} <= shown and "copied" not in shown


def test_secrets(spark):
    rows = [(1, 'key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'), (2, "donaudampfschifffahrtsgesellschaft 4111111111111111"), (3, "aaaaaaaaaaaaaaaaaaaaaaaa1"), (4, "see /usr/share/doc/readme_first_of_all_files")]
    got = {r.doc_id: r for r in pii.personal_data(frame(spark, rows, KIND)).collect()}
    assert got[1].spans == "secret:7:47" and got[1].private and got[1].n_secret == 1
    assert got[2].spans == "card:35:51" and not got[3].private and not got[4].private


def test_sanitised_row_by_row(spark):
    rows = [(None, "write to a@b.org now"), (1, "one a@b.org"), (1, "two 4111111111111111"), (1, "two 4111111111111111"), (2, None), (3, "")]
    got = sorted(map(tuple, pii.sanitised(frame(spark, rows, KIND)).collect()), key=str)
    assert got == sorted([(None, "write to [EMAIL] now"), (1, "one [EMAIL]"), (1, "two [CARD]"), (1, "two [CARD]"), (2, None), (3, "")], key=str)


def test_clashing_columns_and_string_ids(spark):
    docs = spark.createDataFrame([("a", "p@q.rs", 1, "x", "y"), (None, None, 2, None, None)], "name string, body string, row int, terms string, held string")
    got = sorted(map(tuple, pii.personal_data(docs, "body", "name").select("name", "n_email", "spans").collect()), key=str)
    assert got == [("a", 1, "email:0:6"), (None, 0, "")]


def test_terms_that_disclose(spark):
    rng = random.Random(1)
    after = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    rows = [(i, f"{say(rng, 20)} codename Zanzibar reach me boss@firm.com {after()} {say(rng, 20)}") for i in range(6)]
    rows += [(100 + i, f"{say(rng, 30)} reach me at noon {say(rng, 9)}") for i in range(60)]
    rows += [(200, None), (None, "p@q.rs"), (201, "")]
    got = {r.doc_id: r for r in pii.personal_data(frame(spark, rows, "doc_id long, text string")).collect()}
    text = rows[0][1]
    shown = {text[int(a) : int(b)] for k, a, b in (s.split(":") for s in got[0].spans.split(",")) if k == "term"}
    assert "Zanzibar" in shown
    assert "reach" not in shown
    assert got[0].n_email == 1
    assert got[100].spans == "" and got[200].spans == ""
    assert got[None].spans == "email:0:6"
    clean = {r.doc_id: r.text for r in pii.sanitised(frame(spark, rows[:8], "doc_id long, text string")).collect()}
    assert "boss@firm.com" not in clean[0] and "Zanzibar" not in clean[0] and "[EMAIL]" in clean[0]
    assert clean[100] == rows[6][1]


def test_terms_that_disclose_anywhere(spark):
    rng = random.Random(4)
    after = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    rows = [(i, f"é Zanzibar, {say(rng, 30)}\n\nNext line. ZANZIBAR {say(rng, 200)} write to boss@firm.com {after()} {say(rng, 20)} (boss@firm.com)") for i in range(60)]
    rows += [(100 + i, f"{say(rng, 30)} next line write to noon") for i in range(600)] + [(900, f"ü {say(rng, 9)} (zanzibar) {say(rng, 9)}")]
    copied = f"Timbuktu {say(rng, 40)} mail to other@firm.com today"
    rows += [(1000 + i, f"{copied} {i}") for i in range(5)]
    got = {r.doc_id: r for r in pii.personal_data(frame(spark, rows, "doc_id long, text string")).collect()}
    shown = {i: [t[int(a) : int(b)] for k, a, b in (s.split(":") for s in got[i].spans.split(",") if s) if k == "term"] for i, t in rows}
    assert all(shown[i] == ["Zanzibar", "ZANZIBAR"] for i in range(60))
    assert shown[900] == ["zanzibar"]  # a document without the entity
    assert not any(shown[100 + i] for i in range(600))
    assert not any(shown[1000 + i] for i in range(5))  # copies disclose nothing
    assert got[0].n_email == 2 and all(0.9 <= x.disclosure <= 1 for i in range(60) for x in got[i].terms)
