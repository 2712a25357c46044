"""Plain single-process versions to hold the operators against."""

from __future__ import annotations

import re
from collections import defaultdict

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def roots(n: int, links: list[tuple[int, int]]) -> list[int]:
    up = list(range(n))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingles(text: str | None, width: int = 5) -> set[tuple[str, ...]]:
    words = [w for w in SPACES.split(lower(text or "")) if w]
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def jaccard_groups(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, smallest id reachable), for unique ids."""
    rows = sorted(rows)
    sets = [shingles(t) for _, t in rows]
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by[g].append(i)
    both: dict[tuple[int, int], int] = defaultdict(int)
    for own in by.values():
        for k, i in enumerate(own):
            for j in own[k + 1 :]:
                both[i, j] += 1
    links = [(i, j) for (i, j), n in both.items() if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n)]
    return {d: (len(s), rows[r][0]) for (d, _), s, r in zip(rows, sets, roots(len(rows), links), strict=True)}


def repeated_bytes(rows: list[tuple[int, str | None]], width: int = 100) -> dict[int, tuple[int, int, int, bytes]]:
    """doc_id -> (bytes, removed bytes, removed runs, remaining bytes), for unique ids."""
    seen: set[bytes] = set()
    out = {}
    for d, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            s = data[i : i + width]
            if s in seen:
                gone[i : i + width] = b"\1" * width
            else:
                seen.add(s)
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[d] = (len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone, strict=True) if not g))
    return out


def embedding_groups(rows: list[tuple[int, list[float] | None, object]], threshold: float = 0.98) -> dict[int, tuple[int, int]]:
    """vec_id -> (links, smallest id reachable), for unique ids."""
    import numpy as np

    rows = sorted(rows, key=lambda r: r[0])

    def fit(v: list[float] | None) -> bool:
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links, count = [], [0] * len(rows)
    by = defaultdict(list)
    for i, (_, v, label) in enumerate(rows):
        if label is not None and fit(v):
            by[label, len(v)].append(i)
    for own in by.values():
        x = np.asarray([rows[i][1] for i in own], np.float64)
        norm = np.linalg.norm(x, axis=1)
        cosine = (x @ x.T) / np.outer(norm, norm)
        for a, b in zip(*np.nonzero(np.triu(cosine >= threshold, 1)), strict=True):
            links.append((own[a], own[b]))
            count[own[a]] += 1
            count[own[b]] += 1
    return {r[0]: (c, rows[k][0]) for r, c, k in zip(rows, count, roots(len(rows), links), strict=True)}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KEY = re.compile(r"[A-Za-z0-9+/_-]{20,}")
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def luhn(digits: str) -> bool:
    doubled = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def personal_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns as they are written."""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def secret_spans(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    import math
    from collections import Counter

    out = []
    for m in KEY.finditer(text):
        s = m.group()
        bits = -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())
        if re.search("[0-9]", s) and re.search("[A-Za-z]", s) and bits >= 3 and not any(a < m.end() and m.start() < b for _, a, b in taken):
            out.append(("secret", *m.span()))
    return out


def personal_data(rows: list[tuple[int, str | None]], threshold: float = 0.9, support: int = 3, reach: int = 4) -> dict[int, tuple[str, dict[str, float]]]:
    """doc_id -> (spans, disclosure of the terms found), for unique ids."""
    import math

    docs = {}
    for d, text in rows:
        text = text or ""
        spans = personal_spans(text)
        spans += secret_spans(text, spans)
        terms = []
        for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
            a, b = m.span()
            while a < b and text[a] in PUNCTUATION:
                a += 1
            while a < b and text[b - 1] in PUNCTUATION:
                b -= 1
            if b - a >= 3 and not re.search("[0-9]", text[a:b]) and not any(x < b and a < y for _, x, y in spans):
                terms.append((lower(text[a:b]), a, b))
        held = defaultdict(set)
        for kind, x, y in spans:
            beside = tuple(t for t, _, b in terms if b <= x)[-reach:], tuple(t for t, a, _ in terms if a >= y)[:reach]
            held[kind, text[x:y].lower()].add(beside)
            held[kind].add((text[x:y].lower(), beside))
        docs[d] = spans, terms, {e: frozenset(c) for e, c in held.items()}
    n_term, n_entity = defaultdict(int), defaultdict(int)
    n_pair, contexts, pair_contexts = defaultdict(int), defaultdict(set), defaultdict(set)
    for _, terms, held in docs.values():
        for t in {t for t, _, _ in terms}:
            n_term[t] += 1
            for e, c in held.items():
                n_pair[t, e] += 1
                pair_contexts[t, e].add(c)
        for e, c in held.items():
            n_entity[e] += 1
            contexts[e].add(c)
    worth: dict[str, float] = {}
    for (t, e), n in n_pair.items():
        if len(contexts[e]) >= support and len(pair_contexts[t, e]) >= support and n_entity[e] < len(docs):
            share = math.log(n * len(docs) / (n_term[t] * n_entity[e])) / math.log(len(docs) / n_entity[e])
            if share >= threshold - 1e-12:
                worth[t] = max(worth.get(t, 0), share)
    out = {}
    for d, (spans, terms, _) in docs.items():
        own = [*spans, *(("term", a, b) for t, a, b in terms if t in worth)]
        out[d] = ",".join(f"{k}:{a}:{b}" for k, a, b in own), {t: worth[t] for t, _, _ in terms if t in worth}
    return out


def language_posteriors(docs: list[tuple[str, str]], rows: list[dict[str, str | None]]) -> list[tuple[str, float]]:
    """(best language, its chance) of each row: keys text, declared, suffix, host, parent; the model is fitted on all of `docs` (label, text)."""
    import math
    from collections import Counter

    def slots(text: str) -> list[int]:
        data = [32 if b < 65 or 91 <= b <= 96 or 123 <= b <= 127 else b + 32 if 65 <= b <= 90 else b for b in text.encode()]
        codes = [(x << 16) | (y << 8) | z for x, y, z in zip(data, data[1:], data[2:], strict=False)]
        return [(c * 0x9E3779B1 & 0xFFFFFFFF) >> 16 for c in codes if c != 0x202020]

    def noise(text: str) -> int:
        return sum(min(3, len(m)) for m in re.findall(r"[!-/:-@\[-`{-~]{2,}", text))

    names = sorted({lang for lang, _ in docs})
    counts = {n: Counter(s for lang, t in docs if lang == n for s in slots(t)) for n in names}

    def evidence(text: str | None) -> list[float]:
        own, bad = slots(text or ""), noise(text or "")
        if not own:
            return [0.0] * (len(names) + 1)
        scale = min(60, len(own) + bad) / (len(own) + bad)
        out = []
        for n in names:
            total = sum(counts[n].values()) + 0.5 * 65536
            out.append((sum(math.log((counts[n][s] + 0.5) / total) for s in own) - 20 * bad) * scale)
        return [*out, -math.log(65536) * len(own) * scale]

    def posterior(logs: list[float]) -> list[float]:
        top = max(logs)
        e = [math.exp(x - top) for x in logs]
        return [x / sum(e) for x in e]

    k = len(names) + 1
    texts = [evidence(r["text"]) for r in rows]
    own = [posterior(t) for t in texts]

    def votes(**where: str | None) -> list[float]:
        picked = [o for r, o in zip(rows, own, strict=True) if all(r[n] == v for n, v in where.items())]
        return [sum(p[i] for p in picked) for i in range(k)]

    everything = [sum(p[i] for p in own) for i in range(k)]
    overall = [(v + 1 / k) / (sum(everything) + 1) for v in everything]

    def smoothed(v: list[float], towards: list[float]) -> list[float]:
        return [(max(x, 0) + 4 * p) / (max(sum(v), 0) + 4) for x, p in zip(v, towards, strict=True)]

    out = []
    for r, t, p in zip(rows, texts, own, strict=True):
        prior = overall
        if r["host"] is not None:
            up = [sum(q[i] for s, q in zip(rows, own, strict=True) if s["host"] is not None and s["parent"] == r["parent"]) for i in range(k)]
            mine = votes(host=r["host"], parent=r["parent"])
            prior = smoothed([a - b for a, b in zip(mine, p, strict=True)], smoothed(up, overall))
        logs = [a + math.log(b) for a, b in zip(t, prior, strict=True)]
        for n in ("declared", "suffix"):
            if r[n] is not None:
                each = [sum(q[i] for s, q in zip(rows, own, strict=True) if s[n] is not None) for i in range(k)]
                mine = votes(**{n: r[n]})
                share = sum(mine) / sum(each)
                logs = [x + math.log((v + 4 * share) / (e + 4)) for x, v, e in zip(logs, mine, each, strict=True)]
        final = posterior(logs)
        best = max(range(k), key=lambda i: final[i])
        out.append(([*names, "und"][best], final[best]))
    return out


def ordinal_loss(rows: list[tuple[set[int], int]], weights: list[float], thresholds: list[float], penalty: float) -> float:
    """Penalised mean negative log-likelihood of cumulative-link regression: rows hold the features that are there and the grade."""
    import math

    total = 0.0
    for own, grade in rows:
        s = sum(weights[f] for f in own)
        above = [1.0, *(1 / (1 + math.exp(t - s)) for t in thresholds), 0.0]
        total -= math.log(max(above[grade] - above[grade + 1], 1e-300))
    return total / len(rows) + penalty / 2 * sum(w * w for w in weights) / max(1, len(weights)) ** 0.5
