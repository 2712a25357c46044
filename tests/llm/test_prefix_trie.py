"""The trie of conversations against a plain trie, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from psmlake.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(rows):
    """Nodes by their whole prefix, children walked down and up again."""
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - c % 100 if c >= 0 else c + -c % 100, [])
        paths[c] = tuple(t[2:] for t in sorted(base)[:h] + sorted(turns)[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[: d - 1]].add(path[:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) if children[node] else 1
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(saved[k] for k in children[node])
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if paths[c] == node)))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, schema=SCHEMA):
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, schema)).collect()), key=str)


def talk(seed, n=150):
    """Conversations that share first turns, whole copies, short ones, null turns, roles and texts, ties and repeated rows."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(600), n):
        turns = rng.choice([1, 1, 2, 3, 5, 9, 14])
        for t in range(turns):
            rows.append((c, None if rng.random() < 0.05 else t, rng.choice(["user", "assistant", None]) if rng.random() < 0.2 else "user", rng.choice(["é 漢", "", None, "a", "bb"])))
    rows += rng.choices(rows, k=20)  # repeated rows, and turns with equal numbers
    rows += [(c, t, r, "tie") for c, t, r, _ in rng.choices(rows, k=20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_trie(spark, seed):
    rows = talk(seed)
    assert got(spark, rows) == plain(rows)


def test_chains_on_chains_and_blocks(spark, monkeypatch):
    # each conversation goes one turn further along the one before it and then leaves: chains hang 30 high; blocks of 3 turns, pieces of 2 ids
    monkeypatch.setattr(prefix_trie.running, "__defaults__", (False, 3))
    monkeypatch.setattr(prefix_trie, "PIECE", 2)
    rows = [(100 * k, t, "user", f"x{t}" if t < k else f"own{k}") for k in range(30) for t in range(k + 4)]
    rows += [(100 * (200 + k), t, "user", f"x{t}") for k in range(9) for t in range(12)]  # nine that end at one node
    assert got(spark, rows) == plain(rows)


def test_odd_rows(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 0, "user", "gone")]) == []
    # 7 has fewer turns than its head and no first conversation: it ends at the root
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in range(1, 100)}
    c = next(k for k in h if h[k] >= 2)
    rows = [(c, 0, "user", "one")]
    assert got(spark, rows) == plain(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    far = [(-250, 0, "a", "x" * 70_000), (-200, 0, "a", "x" * 70_000), (-1, 3, None, None), (5, 0, "a", "b")]
    assert got(spark, far) == plain(far)


def test_extra_columns_with_clashing_names(spark):
    rows = talk(3, 30)
    wide = [(*r, 1, b"x", 2) for r in rows]
    assert got(spark, wide, SCHEMA + ", pos long, prefix binary, owner long") == plain(rows)
