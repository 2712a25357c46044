"""The operators against plain versions, and what they do with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from psmlake.llm import components, embedding_dedup, exact_dedup, hash_counts, jaccard_join, language_id, mixing, packing, pii, repeated_passages, token_counts, toxicity
from psmlake.llm.run_length_index import RunLengthIndex

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the a of and to in that was for with this from are not they who what".split()


def say(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(n))


def corpus(seed: int = 0, n: int = 60) -> list[tuple]:
    """Random texts, exact and near copies, shared passages, empty, missing, short and long ones; unique ids."""
    rng = random.Random(seed)
    texts: list[str | None] = [None, "", "   \n", "one", "One", "two words here", "é ü 漢字 \t x", say(rng, 3000)]
    passage = say(rng, 60)
    while len(texts) < n:
        kind = rng.random()
        old = rng.choice([t for t in texts if t and len(t) > 30] or [say(rng, 40)])
        if kind < 0.2:
            texts.append(old.replace(" ", "  ", 1))
        elif kind < 0.5:
            words = old.split()
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
        elif kind < 0.7:
            texts.append(f"{say(rng, 30)} {passage} {say(rng, 30)}")
        else:
            texts.append(say(rng, rng.randrange(5, 120)))
    rng.shuffle(texts)
    return [(i * 3, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None]), len(t or "")) for i, t in enumerate(texts)]


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def test_exact_groups(spark):
    rows = corpus(1)
    groups: dict[str, list[int]] = {}
    for d, t, *_ in rows:
        groups.setdefault(hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest(), []).append(d)
    got = {r.doc_id: r for r in exact_dedup.exact_groups(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for h, ids in groups.items():
        for d in ids:
            r = got[d]
            assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (min(ids), len(ids), d == min(ids), h)


def test_exact_with_a_full_filter_is_still_exact(spark):
    rows = corpus(2)
    want = sorted(map(tuple, exact_dedup.exact_groups(frame(spark, rows)).collect()))
    assert sorted(map(tuple, exact_dedup.exact_groups(frame(spark, rows * 1), max_filter_bits=exact_dedup.ROW_BITS).collect())) == want


def test_exact_in_ranges(spark):
    rows = corpus(3, 100)
    docs = frame(spark, rows)
    want = sorted(map(tuple, exact_dedup.exact_groups(docs).collect()))
    assert sorted(map(tuple, exact_dedup.exact_groups(docs, max_filter_bits=1 << 9).collect())) == want  # seven ranges
    kept = sorted(r.doc_id for r in exact_dedup.drop_duplicates(docs, max_filter_bits=1 << 9).collect())
    assert kept == sorted(r[0] for r in want if r[3])


def test_exact_null_ids_repeats_and_clashing_names(spark):
    rows = [(None, "x", 1, 2), (None, "x", 1, 2), (4, "y", 1, 2), (4, "y", 1, 2), (2, "y", 3, 4), (9, None, 0, 0), (8, "", 0, 0)]
    docs = frame(spark, rows, "doc_id long, text string, keep_id int, digest int")
    got = exact_dedup.drop_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in got.collect()) == [(0, "x"), (2, "y"), (8, "")]
    sizes = exact_dedup.exact_groups(docs).where("doc_id = 4").select("group_size", "kept").collect()
    assert [tuple(r) for r in sizes] == [(3, False), (3, False)]


@pytest.mark.parametrize("seed", range(2))
def test_jaccard_groups(spark, seed):
    rows = corpus(seed + 10, 120)
    want = brute.jaccard_groups([(r[0], r[1]) for r in rows])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similarity_groups(frame(spark, rows)).collect()}
    assert got == want


def test_jaccard_chain_and_crowd(spark):
    """A chain of copies that drift away, and a crowd of copies that all differ."""
    rng = random.Random(4)
    words = say(rng, 200).split()
    rows, base = [], list(words)
    for i in range(30):
        rows.append((1000 - i, " ".join(words)))
        words[(i * 6) % 200] = f"drift{i}"
    for i in range(80):
        own = list(base)
        own[rng.randrange(200)] = f"own{i}"
        own[rng.randrange(200)] = f"two{i}"
        rows.append((i, " ".join(own)))
    want = brute.jaccard_groups(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similarity_groups(frame(spark, rows, "doc_id long, text string")).collect()}
    assert got == want


def test_jaccard_odd_rows(spark):
    docs = frame(spark, [(None, "a b c d e f g", 1), (3, "a b c d e f g", 1), (3, "zz", 1), (5, None, 1)], "doc_id long, text string, n long")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard_join.similarity_groups(docs).collect())
    assert got == [(False, 3, 1, 3), (False, 3, 3, 3), (False, 5, 0, 5), (True, 0, 3, 3)]
    kept = jaccard_join.first_of_groups(docs)
    assert kept.columns == docs.columns
    assert kept.count() == 4  # a row without an id stays


def test_trie_walk_is_exact():
    rng = np.random.default_rng(0)
    for _ in range(200):
        sets = [np.unique(rng.integers(0, 40, rng.integers(1, 30))).astype(np.uint64) for _ in range(8)]
        probe = np.unique(rng.integers(0, 40, rng.integers(1, 30))).astype(np.uint64)
        want = {i for i, s in enumerate(sets) if 10 * len(np.intersect1d(s, probe)) >= 8 * len(np.union1d(s, probe))}
        assert set(jaccard_join.OrderedSets(sets).reaching(probe, jaccard_join.Fraction(4, 5))) == want


def test_run_length_index():
    rng = np.random.default_rng(1)
    for _ in range(60):
        texts = [rng.integers(0, 3, rng.integers(1, 12)) for _ in range(rng.integers(1, 6))]
        asked = [rng.integers(0, 4, rng.integers(1, 12)) for _ in range(4)]
        index = RunLengthIndex(np.concatenate(texts), np.array([len(x) for x in texts]))
        got = index.matching_statistics(np.concatenate(asked), np.array([len(x) for x in asked]))
        there = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i, len(t) + 1)}
        for k, q in enumerate(asked):
            for i in range(len(q)):
                assert got[k, i] == max(n for n in range(len(q) - i + 1) if tuple(q[i : i + n]) in there)


def vectors(seed: int = 0) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    rows: list[tuple] = []
    for i in range(150):
        v = centres[rng.integers(12)] + rng.normal(size=16) * rng.choice([0.01, 0.08, 0.5])
        rows.append((i, v.astype(np.float32).astype(float).tolist(), int(rng.integers(3))))
    rows += [(200, rows[0][1], rows[0][2]), (201, [2 * x for x in rows[0][1]], rows[0][2]), (202, None, 1), (203, [0.0] * 16, 1), (204, [float("nan")] + [1.0] * 15, 1), (205, [None] + [1.0] * 15, 1), (206, rows[0][1], None), (207, [1.0, 2.0], 1), (208, [1.0, 2.0], 1), (209, [float("inf")] + [1.0] * 15, 1)]
    return rows


def test_trie_leaves_subtrees():
    rng = np.random.default_rng(2)
    left = 0
    for _ in range(200):
        stems = [np.unique(rng.integers(0, 3000, 200)) for _ in range(2)]
        sets = [np.unique(np.concatenate([stems[k % 2], rng.integers(3000, 4000, rng.integers(0, 90))])).astype(np.uint64) for k in range(12)]
        probe = np.unique(np.concatenate([stems[0], rng.integers(3000, 4000, 20)])).astype(np.uint64)
        want = {i for i, s in enumerate(sets) if 10 * len(np.intersect1d(s, probe)) >= 8 * len(np.union1d(s, probe))}
        trie = jaccard_join.OrderedSets(sets)
        assert set(trie.reaching(probe, jaccard_join.Fraction(4, 5))) == want
        left += trie.left
    assert left > 500


def test_jaccard_many_groups_in_one_list(spark):
    """Documents that share a passage and little else, next to copies and near copies: many components meet in one list."""
    rng = random.Random(8)
    passage = say(rng, 40)
    rows = []
    for k in range(12):
        stem = say(rng, 8)
        rows += [f"{passage} {stem} {say(rng, rng.randrange(1, 3))}" for _ in range(rng.randrange(1, 6))]
    rows += [rows[0]] * 3
    rng.shuffle(rows)
    rows = [(i, t) for i, t in enumerate(rows)]
    want = brute.jaccard_groups(rows)
    docs = frame(spark, rows, "doc_id long, text string").withColumn("n", F.lit("x")).withColumn("component", F.lit(1))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similarity_groups(docs).collect()}
    assert got == want


def test_first_of_groups_with_repeated_and_null_ids(spark):
    rng = random.Random(9)
    text, other = say(rng, 60), say(rng, 60)
    near = text.rsplit(" ", 1)[0] + " end"
    rows = [(1, text), (1, near), (1, other), (1, text), (2, near), (None, text), (None, other + " x"), (3, None), (3, None), (4, "few words"), (None, None)]
    docs = frame(spark, rows, "doc_id long, text string").withColumn("component", F.lit(0)).withColumn("h", F.lit("h"))
    kept = jaccard_join.first_of_groups(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len([g for g in got if g[0] and g[1] in (text, near)]) == 1 and (2, near) not in got
    assert (1, other) in got and (None, text) in got and (None, other + " x") in got
    assert got.count((3, None)) == 2 and (4, "few words") in got and (None, None) in got


@pytest.mark.parametrize("tile_rows", [2048, 8])
def test_embedding_groups(spark, tile_rows):
    rows = vectors()
    want = brute.embedding_groups(rows)
    got = embedding_dedup.embedding_groups(frame(spark, rows, "vec_id long, embedding array<double>, label int"), tile_rows=tile_rows).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_embedding_crowds_sizes_and_clashing_columns(spark):
    """Crowds that only later coordinates tell apart, or none does; huge and tiny components; columns with working names."""
    rng = np.random.default_rng(4)
    rows = []
    for centre in range(3):
        base = np.zeros(6)
        base[0], base[1 + centre] = 5, 2
        rows += [(base + 0.02 * rng.normal(size=6)).tolist() for _ in range(40)]
    rows += [[1.0] * 6] * 25 + [(np.array(rows[0]) * 1e200).tolist(), (np.array(rows[1]) * 1e-200).tolist(), [0.0] * 6, [1e-320] * 6, None, [1.0, None], [float("inf")] * 6]
    rows = [(i, v, 1 if i % 9 else None) for i, v in enumerate(rows)]
    fit = lambda v: v and all(x is not None and np.isfinite(x) for x in v)
    half = lambda v: np.ldexp(v, -int(np.frexp(max(map(abs, v)))[1])).tolist() if fit(v) else v
    want = brute.embedding_groups([(i, half(v), k) for i, v, k in rows])
    docs = frame(spark, rows, "vec_id long, embedding array<double>, label int").withColumn("tile", F.lit("x")).withColumn("node", F.lit(1)).withColumn("e", F.lit(2))
    for tile_rows in (4, 2048):
        got = embedding_dedup.embedding_groups(docs, tile_rows=tile_rows).collect()
        assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(60)]
    edges = frame(spark, [*chain, (100, 101), (5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


@pytest.fixture(scope="module")
def word_file() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def odd_texts() -> list[str]:
    rng = random.Random(3)
    letters = "abcdefghijklmnop ABC'\"!?.,012éÉßΣσ漢字🙂́\x85 \nİ<|startoftext|>"
    out = ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(400)]
    return [*out, "", "I've seen <|endoftext|> they're", "a" * 3000]


def test_token_counts_as_the_library(spark, word_file):
    exact = Tokenizer.from_file(word_file)
    texts = [*odd_texts(), None]
    got = {r.doc_id: r for r in token_counts.token_counts(frame(spark, list(enumerate(texts)), "doc_id long, text string"), word_file).collect()}
    for i, t in enumerate(texts):
        n = len(exact.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 2048)


def test_token_counts_of_every_code_point(word_file):
    """Alone, in runs of neighbours, and between letters, digits and marks."""
    exact, own = Tokenizer.from_file(word_file), token_counts.PrefixCounter(word_file)
    rng = random.Random(5)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 64):
        run = [chr(c) for c in points[k : k + 64]]
        if k > 0x30000 and k % 0x800:  # mostly unassigned or private: a run in 32
            continue
        texts = ["".join(run), "".join(f"{rng.choice('a1 .')}{c}{rng.choice(('b', '2', chr(0x301), c))}" for c in run)]
        for t, e in zip(texts, exact.encode_batch(texts, add_special_tokens=False), strict=True):
            assert own.count(t) == len(e.ids), ascii(t)


def test_token_counts_of_random_unicode(word_file):
    exact, own = Tokenizer.from_file(word_file), token_counts.PrefixCounter(word_file)
    rng = random.Random(6)
    blocks = [(32, 127), (0xA0, 0x250), (0x300, 0x370), (0x370, 0x600), (0x900, 0xA00), (0x1100, 0x1200), (0x2000, 0x2100), (0x3040, 0x3100), (0xA700, 0xA800), (0xAC00, 0xAD00), (0x1F600, 0x1F650), (0x1E900, 0x1E960)]
    texts = ["".join(chr(rng.randrange(*rng.choice(blocks))) for _ in range(rng.randrange(40))) for _ in range(4000)] + ["\U0001f61b\u0558\U0001f638", "\ua7cb\ua7dc"]
    for t, e in zip(texts, exact.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.count(t) == len(e.ids), ascii(t)


def test_cut_at_the_limit(spark, word_file):
    own = token_counts.PrefixCounter(word_file)
    rng = random.Random(7)
    texts = [*(say(rng, 40) for _ in range(30)), *odd_texts()[:100], "x" * 200_000, "ab " * 70_000, "!" * 30_000, "they're " * 30, "\u0558 caf\u00e9 " * 40]
    docs = frame(spark, [(i % 7 or None, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("n_tokens", F.lit("x")).coalesce(1)
    for limit in (5, 37):
        got = token_counts.token_counts(docs, word_file, limit=limit).collect()
        assert [r.doc_id for r in got] == [i % 7 or None for i in range(len(texts))]
        for t, r in zip(texts, got, strict=True):
            assert r.over_limit == (r.n_tokens > limit) == (r.cut_at is not None)
            if r.over_limit and len(t) < 3000 and "<|" not in t:
                counts = own.prefixes(t)
                assert r.cut_at == int(np.flatnonzero(counts > limit)[0]) - 1


def test_prefix_counts_and_budgets(word_file):
    exact = Tokenizer.from_file(word_file)
    own = token_counts.PrefixCounter(word_file)
    for text in ("Hello, the untokenizable words' they've 123 seen!", "antidisestablishmentarianism zzzyx é漢"):
        shown = own.normalised(text)
        want = [len(exact.encode(shown[:k], add_special_tokens=False).ids) for k in range(len(shown) + 1)]
        assert own.prefixes(text).tolist() == want
        fit = own.fits(text, 5)
        assert want[fit] <= 5 and max(want[: fit + 1]) <= 5 and (fit == len(shown) or want[fit + 1] > 5)


def test_packing_is_whole_and_fits(spark):
    path, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    exact = Tokenizer.from_file(path)
    rows = [*corpus(5), (999_999, "a <|endoftext|> b", "en", "a", 9), (None, "null id", "en", "a", 7), (0, "repeated id", "en", "a", 9)]
    got = packing.packed(frame(spark, rows), path, ranks).collect()
    by_doc: dict[tuple, list] = {}
    for d, t, *_ in rows:
        ids = np.array([*exact.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        by_doc.setdefault(d, []).append(ids)
    pieces: dict[tuple, list] = {}
    for r in got:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for d, many in by_doc.items():
        for ids in many:
            own = sorted(pieces[d, len(ids)], key=lambda r: r.start)
            assert sum(r.length for r in own) % len(ids) == 0
            if len(many) == 1:
                assert [r.start for r in own] == np.cumsum([0, *[r.length for r in own]])[:-1].tolist()
                assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in own)
    sequences: dict[int, list] = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist()
        assert sum(n for _, n in own) <= 1024


def test_packing_ids_of_every_code_point():
    """The fast encoder gives the library's ids for every code point, in runs and between others."""
    own = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = []
    for k in range(0, len(points), 64):
        if k < 0x30000 or k % 0x800 == 0:
            run = [chr(c) for c in points[k : k + 64]]
            texts += ["".join(run), "".join(f"a{c}1{c}{c} {c}!{c}" for c in run)]
    texts += odd_texts()
    for t, e in zip(texts, own.exact.encode_batch(texts, add_special_tokens=False), strict=True):
        assert own.ids(t).tolist() == e.ids, ascii(t)


def test_packing_hot_rows_and_clashing_columns(spark):
    rows = [(None, "", 1, 2, "x")] * 900 + [(i, "five words in a text", 1, 2, "y") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rest int, n int, bucket string").repartition(3)
    got = packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), bucket_rows=50, size=64).collect()
    assert len(got) == 1100 and sum(r.length for r in got) == 900 + sum(r.doc_tokens for r in got if r.doc_id is not None)
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert own[0][0] == 0 and sum(n for _, n in own) <= 64
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False))
    assert sorted(by) == list(range(len(by)))


def test_packing_pads_little():
    rng = np.random.default_rng(0)
    counts = {int(n): int(c) for n, c in enumerate(rng.integers(1, 50, 1023), 1)}
    patterns = packing.pack_histogram(counts, 1024)
    used = {n: sum(p.count(n) * c for p, c in patterns) for n in counts}
    assert used == counts
    assert all(sum(p) <= 1024 for p, _ in patterns)
    assert sum(n * c for n, c in counts.items()) / (1024 * sum(c for _, c in patterns)) > 0.98


def test_mixing_targets_and_quotas():
    assert [float(t) for t in mixing.targets([100, 100, 100], [5, 2, 1])] == [200.0, pytest.approx(500 / 3), pytest.approx(250 / 3)]
    assert mixing.targets([0, 10], [5, 2]) == [0, 15]
    seats = mixing.sainte_lague(100, [53.0, 24.0, 23.0], [1000] * 3)
    assert seats == [53, 24, 23]
    assert mixing.sainte_lague(10, [5.0, 5.0], [3, 100]) == [3, 7]
    brute_seats = [0] * 4
    weights = [3.3, 2.1, 9.9, 0.4]
    for _ in range(37):
        i = max(range(4), key=lambda i: weights[i] / (2 * brute_seats[i] + 1))
        brute_seats[i] += 1
    assert mixing.sainte_lague(37, weights, [1000] * 4) == brute_seats


def test_mixing_plan(spark):
    rng = random.Random(0)
    rows = [(i, say(rng, rng.randrange(20, 200)), "en", "a" if i % 3 else rng.choice(["b", "c", None]), 0) for i in range(400)]
    docs = frame(spark, [*rows, (1000, None, "en", "d", 0), (None, "x y", "en", "a", 3)])
    got = mixing.mix_plan(docs).collect()
    assert len(got) == 402
    assert all(0 <= r.taken <= 2 * r.size and r.size == r.epochs * 0 + r.size for r in got)
    assert all(r.taken == r.epochs * r.size + sum(x.end - x.begin for x in r.ranges) for r in got)
    for target in {r.target for r in got}:
        own = [r for r in got if r.target == target]
        if target:
            assert abs(sum(r.taken for r in own) - target) <= max(130, 0.02 * target)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_plan(docs).collect()))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    words = mixed.select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert words == sum(r.taken for r in got)


def test_mixing_takes_small_sources_whole_over_many_shards(spark):
    rng = random.Random(3)
    rows = [(i, say(rng, 100), "en", "small", 0) for i in range(300)] + [(1000 + i, say(rng, 150), "en", "big", 0) for i in range(1800)] + [(9000, say(rng, 10), "en", "tiny", 0)]
    got = mixing.mix_plan(frame(spark, rows), shard_rows=1).collect()
    assert {r.source_size for r in got} == {30_000, 270_000, 10}
    for size in (30_000, 270_000, 10):
        own = [r for r in got if r.source_size == size]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 64, size
    assert all(r.taken == r.epochs * r.size + sum(x.end - x.begin for x in r.ranges) and all(0 <= x.begin < x.end <= r.size for x in r.ranges) for r in got)


def test_cell_runs_against_a_plain_walk():
    rng = np.random.default_rng(0)
    for _ in range(300):
        words = rng.integers(0, 30, rng.integers(1, 12))
        width = int(rng.integers(1, 9))
        blocks = -(-int(words.sum()) // width)
        extra = int(rng.integers(0, blocks + 1))
        starts = rng.integers(0, 1 << 60, len(words)).astype(np.uint64)
        runs = mixing.cell_runs(words, extra, width, starts)
        edges = np.concatenate([[0], np.cumsum(words)])
        owned = [[b for b in range(blocks) if edges[k] <= b * width < edges[k + 1]] for k in range(len(words))]
        quota = mixing.sainte_lague(extra, [float(len(o)) for o in owned], [len(o) for o in owned])
        assert runs["quota"].tolist() == quota and sum(quota) == extra
        taken = set()
        for o, q, s in zip(owned, quota, starts.tolist(), strict=True):
            for i in range(q):
                b = o[(s % len(o) + i) % len(o)]
                taken |= set(range(b * width, min((b + 1) * width, int(words.sum()))))
        for k in range(len(words)):
            got = [w for r in range(3) for w in range(int(runs[f"a{r}"][k]), int(runs[f"b{r}"][k])) if edges[k] <= w < edges[k + 1]]
            assert sorted(got) == sorted(taken & set(range(edges[k], edges[k + 1]))), k


def test_mixed_cuts_the_text_as_it_is(spark):
    rows = [(i, f"  a{i}\n\tb{i}  c{i}\u00a0d{i}\n" * 40 + "end", "en", "abc"[i % 3], 5) for i in range(60)] + [(100, None, "en", "a", 0), (101, " \n", "en", None, 2)]
    docs = frame(spark, rows).withColumn("size", F.lit("x")).withColumn("target", F.lit(None).cast("string"))
    text = {r[0]: r[1] for r in rows}
    plan = {r.doc_id: r.taken for r in mixing.mix_plan(docs, shard_rows=10, block_words=7).collect()}
    got = mixing.mixed(docs, shard_rows=10, block_words=7)
    assert got.columns == docs.columns
    words: dict[int, int] = dict.fromkeys(plan, 0)
    cut = 0
    for r in got.collect():
        assert r.text in text[r.doc_id] and r.text and r["size"] == "x"
        assert r.n_chars == (5 if r.text == text[r.doc_id] else len(r.text))
        cut += r.text != text[r.doc_id]
        words[r.doc_id] += len(brute.SPACES.sub(" ", r.text).strip(" ").split(" "))
    assert words == plan and 0 < cut < 60


def test_mixing_hot_rows(spark):
    """Rows that repeat id and text are dealt to several cells."""
    rows = [(None, "the same text again", "en", "a", 0)] * 400 + [(i, "some other text of six words", "en", "b", 0) for i in range(50)]
    got = mixing.mix_plan(frame(spark, rows), shard_rows=5).collect()
    for size in {r.source_size for r in got}:
        own = [r for r in got if r.source_size == size]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 64
    assert len(got) == 450 and all(0 <= r.taken <= 2 * r.size for r in got)


def test_mix_of_a_hot_cell_is_the_same_however_the_table_is_split(spark):
    rows = [(i, say(random.Random(i), 5 + i % 30), "en", "hot", 1) for i in range(400)] + [(9, "the same words again and again", "en", "hot", 1)] * 200
    random.Random(1).shuffle(rows)
    takes = [sorted((r.doc_id, r.size, r.taken) for r in mixing.mix_plan(frame(spark, rows).repartition(n), shard_rows=5).collect()) for n in (1, 7)]
    assert takes[0] == takes[1]


def test_toxicity_learns_grades_and_holds_out(spark):
    rng = random.Random(2)
    insults = ["rotter", "blackguard", "knave"]

    def text(toxic: int) -> str:
        words = say(rng, 60).split()
        for _ in range(toxic * rng.randrange(1, 8)):
            words[rng.randrange(60)] = rng.choice(insults) + rng.choice(["", ",", "!"])
        return " ".join(words)

    rows = [(i, text(i % 4 == 0)) for i in range(600)]
    docs = frame(spark, [*rows, (None, None), (601, "")], "doc_id long, text string")
    labels = frame(spark, [(i, int(i % 4 == 0)) for i in range(400)] + [(1, None), (2, 7)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.severity(docs, model).collect()}
    test = range(400, 600)
    assert sum(got[i].toxic == (i % 4 == 0) for i in test) / len(test) > 0.97
    assert list(model.thresholds) == sorted(model.thresholds)
    worst = model.exceeding(np.array([0.0, 3.0, 9.0])).sum(1)
    assert worst[0] < worst[1] < worst[2]
    assert not got[None].toxic and not got[601].toxic
    nothing = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {r.toxic for r in toxicity.severity(docs, nothing).collect()} == {False}


def test_language_fuses_evidence(spark):
    english, french = "the house and the garden with that old tree", "la maison et le jardin avec cet ancien arbre"
    rng = random.Random(0)
    mix = lambda t: " ".join(rng.sample(t.split(), len(t.split())))
    docs = frame(spark, [(i, mix(english) if i % 2 else mix(french), "en" if i % 2 else "fr") for i in range(200)], "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert model.languages == ["en", "fr"]
    rows = [(i, f"http://{'a' if i % 2 else 'b'}.example.com/x", f'<html lang="{"en" if i % 2 else "fr"}"><body>{mix(english) if i % 2 else mix(french)}</body></html>') for i in range(60)]
    rows += [(100, "http://b.example.com/", "<html><p>le</p></html>"), (101, "http://a.example.com/", None), (102, None, f"<p>{mix(french)}</p>"), (103, "x", "<p>12345 67890 !!! 000</p>")]
    got = {r.page_id: r for r in language_id.page_languages(frame(spark, rows, "page_id long, url string, html string"), model).collect()}
    assert all(got[i].language == ("en" if i % 2 else "fr") and got[i].accepted for i in range(60))
    assert got[102].language == "fr" and got[102].accepted
    assert not got[101].accepted and not got[103].accepted
    kept = language_id.spoken(docs.withColumn("source", F.lit("s")).withColumn("chance", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "lang", "source", "chance"]
    assert kept.count() == 200


def test_hash_table_marks_all_repeats(spark):
    rng = np.random.default_rng(0)
    values = rng.integers(0, 2**63, 5000, dtype=np.int64)
    values[:300] = values[300:600]
    rows = frame(spark, [(int(v),) for v in values], "v long").repartition(5)
    table = hash_counts.hash_table(rows, lambda b: iter([b.column(0).to_numpy().view(np.uint64)]), 5000, 1 << 20, levels=False)
    flags = hash_counts.repeated(table, values.view(np.uint64))
    assert flags[:600].all()
    assert flags[600:].mean() < 0.1


EMPTY = {
    "exact": lambda s, d: exact_dedup.exact_groups(d), "drop": lambda s, d: exact_dedup.drop_duplicates(d), "jaccard": lambda s, d: jaccard_join.similarity_groups(d), "passages": lambda s, d: repeated_passages.without_repeats(d), "mix": lambda s, d: mixing.mix_plan(d), "mixed": lambda s, d: mixing.mixed(d),
    "pack": lambda s, d: packing.packed(d, public_tokenizers.path("byte_bpe_50k.json")), "tokens": lambda s, d: token_counts.token_counts(d, public_tokenizers.path("word_bpe_49k.json")), "pii": lambda s, d: pii.personal_data(d), "language": lambda s, d: language_id.spoken(d),
    "toxicity": lambda s, d: toxicity.severity(d, toxicity.fit(d, s.createDataFrame([], "doc_id long, toxic int"))),
}


@pytest.mark.parametrize("name", sorted(EMPTY))
def test_empty_tables(spark, name):
    assert EMPTY[name](spark, frame(spark, [])).count() == 0


def test_empty_vectors(spark):
    assert embedding_dedup.embedding_groups(frame(spark, [], "vec_id long, embedding array<float>, label int")).count() == 0
