"""What is learned, against plain versions: language posteriors, the ordinal model's likelihood, and both on odd rows."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_corpus_operators import frame

from psmlake.llm import language_id, toxicity

TALK = {"en": "the house and the garden with that old tree", "fr": "la maison et le jardin avec cet ancien arbre", "de": "das haus und der garten mit dem alten baum über ö"}


def some(rng: random.Random, lang: str, n: int) -> str:
    return " ".join(rng.choice(TALK[lang].split()) for _ in range(n))


def test_language_against_plain_posteriors(spark):
    rng = random.Random(3)
    docs = [(i, some(rng, lang, rng.randrange(1, 20)), lang) for i, lang in enumerate(list(TALK) * 12)]
    model = language_id.fit(frame(spark, docs, "doc_id long, text string, lang string"))
    rows = []
    for i in range(80):
        lang = rng.choice(list(TALK))
        text = some(rng, lang, rng.choice([0, 1, 1, 2, 5]))
        text = rng.choice([text, text, text.upper() + "!!", "".join(rng.choice("qxzjkvw ") for _ in range(30)), "12 ## 5%%", None])
        host = rng.choice([None, f"{lang}.site.org", "a.other.net", "b.other.net"])
        rows.append({"i": i, "text": text, "declared": rng.choice([None, lang, "en"]), "suffix": rng.choice([None, "org", lang]), "host": host, "parent": host and host.split(".", 1)[1]})
    want = brute.language_posteriors([(lang, t) for _, t, lang in docs], rows)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "i int, text string, declared string, suffix string, host string, parent string").repartition(3)
    got = {r.i: r for r in language_id.identify(df, model, *[F.col(c) for c in ("text", "declared", "suffix", "host", "parent")]).collect()}
    for r, (lang, chance) in zip(rows, want, strict=True):
        assert got[r["i"]].chance == pytest.approx(chance, abs=2e-5), r
        if chance > 0.501:
            assert got[r["i"]].language == lang, r


def test_filter_does_not_trust_the_label_and_drops_noise(spark):
    rng = random.Random(4)
    docs = [(i, some(rng, lang, 20), lang, "s", 1) for i, lang in enumerate(list(TALK) * 20)]
    docs += [(100 + i, "".join(rng.choice("qxzjkvw ") for _ in range(200)), "en", "s", 1) for i in range(3)]
    docs += [(200, "### ".join(some(rng, "en", 30).split()), "en", "s", 1), (201, some(rng, "en", 30) + " token = \"04dbebab91ab\" | a | b ...", None, None, 1)]
    docs += [(300, None, "en", "s", 1), (301, "", "en", "s", 1), (None, some(rng, "fr", 30), "", "s", 1), (7, some(rng, "de", 9), "de", "s", 1), (7, some(rng, "de", 9), "de", "s", 1)]
    docs += [(400, some(rng, "fr", 60_000), "en", "s", 1)]
    df = frame(spark, docs, "doc_id long, text string, lang string, source string, language int")
    kept = language_id.spoken(df)
    assert kept.columns == df.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda d: (d is None, d))
    assert ids == sorted([*range(60), 7, 7, 201, 400, None], key=lambda d: (d is None, d))


def test_null_ids_are_sampled_apart(spark):
    docs = frame(spark, [(None, f"word{i} and more of them", "en") for i in range(300)], "doc_id long, text string, lang string")
    few = language_id.fit(docs, sample_rows=10)
    all_ = language_id.fit(docs)
    assert not np.allclose(few.log_chance, all_.log_chance)


def test_too_many_languages(spark):
    docs = frame(spark, [(i, "some text", f"l{i}") for i in range(5)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        language_id.fit(docs, max_languages=4)


@pytest.mark.parametrize("seed", range(3))
def test_ordinal_fit_is_the_likeliest(seed):
    """No small step and no other start does better on a tiny table."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(60):
        own = {int(f) for f in np.flatnonzero(rng.random(4) < 0.4)}
        rows.append((own, int(np.clip(len(own & {0, 1}) + (rng.random() < 0.3) - (rng.random() < 0.3), 0, 3))))
    row = np.array([i for i, (own, _) in enumerate(rows) for _ in own])
    feature = np.array([f for own, _ in rows for f in sorted(own)])
    grade = np.array([g for _, g in rows])
    w, theta = toxicity.fit_ordinal(row, feature, grade, 4, np.ones(60), rounds=3000)
    assert (w >= 0).all() and (np.diff(theta) > 0).all()
    best = brute.ordinal_loss(rows, w.tolist(), theta.tolist(), 0.003)
    for _ in range(3000):
        step = rng.choice([0.3, 0.05, 0.01])
        w2 = np.maximum(0, w + step * rng.normal(size=4) * (rng.random(4) < 0.5))
        theta2 = np.sort(theta + step * rng.normal(size=len(theta)) * (rng.random(len(theta)) < 0.5))
        assert brute.ordinal_loss(rows, w2.tolist(), theta2.tolist(), 0.003) > best - 2e-4


def test_toxicity_scores_against_a_plain_sum(spark):
    """The score of a text is the sum of the weights of its distinct features, and the severity the sum of the chances."""
    rng = np.random.default_rng(5)
    weights = np.where(rng.random(toxicity.SLOTS) < 0.3, rng.random(toxicity.SLOTS), 0)
    model = toxicity.OrdinalModel(weights, np.array([1.0, 2.5, 4.0]), 1.5)
    texts = ["You rotter, you!", "a", None, "", "plain words here", "rotter " * 5000, "!!!", "plain words here"]
    docs = spark.createDataFrame([(i % 5 or None, t, "x", 1.0, True) for i, t in enumerate(texts)], "doc_id long, text string, toxic string, severity double, grade boolean")
    got = [r.severity for r in toxicity.severity(docs.coalesce(1), model).collect()]
    for severity, t in zip(got, texts, strict=True):
        own = {int(s) for _, _, _, slots in toxicity.feature_rows(__import__("pyarrow").array([t], "string")) for s in slots}
        score = sum(weights[s] for s in own)
        assert severity == pytest.approx(sum(1 / (1 + np.exp(k - score)) for k in (1.0, 2.5, 4.0)), abs=1e-8)
    assert got[4] == got[7]


def test_toxicity_repeated_labels_ties_and_rows(spark):
    rows = [(i, ("vile knave " if i % 2 else "kind friend ") * 3) for i in range(80)]
    docs = frame(spark, [*rows, *rows, (None, None)], "doc_id long, text string").withColumn("toxic", F.lit("x"))
    labels = frame(spark, [(i, i % 2) for i in range(80)] * 3 + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.severity(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == 161 and all(r.toxic == (r.doc_id is not None and r.doc_id % 2 == 1) for r in got)
