"""Scores of the backoff automaton against formulas over plain counters, whatever the batches."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import pytest

from psmlake.llm import lm_scoring

DOCS = "doc_id long, text string"


def tokens(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")] + [None]


def model(rows, order):
    """(held out, counts by order, probability of an n-gram's last word after the others), by recursion over whole counters."""
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0 for d, _ in rows]
    counts = [Counter() for _ in range(order + 1)]
    for (_, text), out in zip(rows, held, strict=True):
        words = tokens(text)
        if not out:
            for m in range(1, order + 1):
                counts[m].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    n, v = sum(counts[1].values()), len(counts[1])
    followers = [Counter(g[:-1] for g in c) for c in counts]
    seen = [Counter(c.values()) for c in counts]
    discount = [(s[1] + 0.5) / (s[1] + 2 * s[2] + 1) for s in seen]

    def p(gram):
        if len(gram) == 1:
            return (counts[1][gram] + 0.1) / (n + 0.1 * (v + 1))
        m, context = len(gram), gram[:-1]
        total = counts[m - 1][context]
        if not total:
            return p(gram[1:])
        return max(0, counts[m][gram] - discount[m]) / total + discount[m] * followers[m][context] / total * p(gram[1:])

    return held, counts, p


def plain(rows, order):
    held, counts, p = model(rows, order)
    n, out = sum(counts[1].values()), []
    for (d, text), is_held in zip(rows, held, strict=True):
        words = tokens(text)
        score = sum(math.log10(p(tuple(words[max(0, i - order + 1) : i + 1]))) for i in range(len(words)))
        out.append((d, is_held, len(words), sum(counts[1][(w,)] > 0 for w in words), n, sum(math.log10(p((w,))) for w in words), score))
    return out


def got(spark, rows, schema=DOCS, **how):
    return [tuple(r) for r in lm_scoring.lm_scores(spark.createDataFrame(rows, schema).repartition(3), **how).collect()]


def same(a, b):
    key = lambda r: (str(r[0]), *map(str, r[1:5]), round(r[6], 6))
    a, b = sorted(a, key=key), sorted(b, key=key)
    assert [r[:5] for r in a] == [r[:5] for r in b]
    assert [x for r in a for x in r[5:]] == pytest.approx([x for r in b for x in r[5:]], rel=1e-9)


def corpus(seed, n=120):
    rng = random.Random(seed)
    texts = [None, "", " \n", "One", "one TWO é É", " ".join(f"w{rng.randrange(400)}" for _ in range(9000))]
    while len(texts) < n:
        texts.append(rng.choice(texts) if rng.random() < 0.2 else " ".join(f"w{min(rng.randrange(60), rng.randrange(60))}" for _ in range(rng.randrange(40))))
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_plain_formulas(spark, order):
    rows = corpus(order)
    same(got(spark, rows, order=order), plain(rows, order))


def test_any_batches_and_buckets(spark):
    rows = corpus(5)
    same(got(spark, rows, order=3, batch_bytes=200, bucket_keys=300), plain(rows, 3))


def test_probabilities_after_a_state_sum_to_one():
    _, counts, p = model(corpus(7), 3)
    for state in [(), *counts[1], *list(counts[2])[:50]]:
        state = state if None not in state else ()  # nothing follows an end
        assert sum(p((*state, w)) for w in [*(g[0] for g in counts[1]), "new"]) == pytest.approx(1)


def test_odd_rows(spark):
    assert got(spark, []) == []
    rows = [(None, "a b"), (None, None), (3, "a"), (3, "a"), (7, "")]
    same(got(spark, rows), plain(rows, 2))
    only_held = [(d, "x y") for d in range(200) if zlib.crc32(str(d).encode()) % 10 == 0]
    same(got(spark, only_held), plain(only_held, 2))
    assert {r[6] for r in got(spark, only_held)} == {0.0}


def test_extra_columns_with_clashing_names(spark):
    rows = corpus(6, 40)
    same(got(spark, [(*r, b"x", 1, "z") for r in rows], DOCS + ", held binary, batch long, words string"), plain(rows, 2))


def test_held_out_texts_gain_from_contexts(spark):
    rng = random.Random(8)
    follows = {w: rng.sample(range(200), 3) for w in range(200)}
    rows = []
    for i in range(400):
        w, words = rng.randrange(200), []
        for _ in range(60):
            words.append(f"w{w}")
            w = rng.choice(follows[w])
        rows.append((i, " ".join(words)))
    found = [r for r in got(spark, rows) if r[1]]
    assert len(found) > 20 and all(r[6] > r[5] for r in found)
    assert sum(r[6] for r in found) > 0.6 * sum(r[5] for r in found)
