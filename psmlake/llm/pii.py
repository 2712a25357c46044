"""Personal data: fixed patterns, and terms that disclose a protected entity.

Protected entities are what the patterns find (e-mail, IP, card and phone number) and secrets (runs of key characters with letters
and digits whose characters carry `SECRET_BITS` bits or more each), each by itself and each kind as a whole.  A term, a word
anywhere in a document outside those spans, discloses an entity as far as the corpus lets one infer the entity from it: with n(x)
documents holding x and N documents in all, the disclosure of t for e is

    PMI(t; e) / IC(e) = log(n(t, e) N / (n(t) n(e))) / log(N / n(e))

It is 1 where the term occurs with the entity only.  Terms at or above `threshold` for some entity, beside which they stand in
`support` or more distinct contexts, become spans of kind `term` at all their places in all documents, those without the entity
too; `sanitised` puts the kind's name in a span's place (generalisation) or takes terms at or above `removal` out.  A document's
context of an entity is the terms beside it, `reach` on either side of each of its places, and for a kind also which entities they are;
repeated contexts count once, so copies of a document alone disclose nothing.

One pass over all texts gives the entities, their documents' terms, and every term's number of documents (combined in the task,
then by term).  A term with n(t) > N (n(e) / N) ** threshold cannot disclose e, so common terms never meet rare entities; nor can one of whose
documents fewer than a share of (n(e) / N) ** (1 - threshold) hold any entity, so words that stand everywhere alike meet none.
Up to `max_terms` disclosing terms are broadcast, 16 bytes each; more are marked in rounds of that many.

Defined results: a null text counts as empty and holds nothing; ids may be null or repeat, each row gets its own spans; a text of any length is read in
time in proportion to it, as each pattern is extended from its '@', dots, digits or '+' and never from every character; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import MARK, bounded_batches, trim, written
from .text_kernels import U64, Words, slices

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")
LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(rb"[0-9]+(?:\.[0-9]+)+")
CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
KEY = re.compile(rb"[A-Za-z0-9+/_-]{20,}")
KEY_BYTES, SECRET_BITS = 20, 3.0
#: Terms that a task holds before it sends their counts.
FLUSH = 400_000
HELD = pa.list_(pa.struct([("entity", pa.int64()), ("context", pa.int64())]))
TERMS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("disclosure", pa.float64())]))
TERMS_DDL = "array<struct<start:int,end:int,disclosure:double>>"
Span = tuple[str, int, int]


def luhn(digits: bytes) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = (d - 48) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def emails(text: bytes) -> Iterator[Span]:
    """From each '@' back over the local part, which ends where the last match or the last '@' stands, and on over the domain."""
    done, at = 0, text.find(b"@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        done = domain.end() if domain else at + 1
        if domain:
            yield "email", start, done
        at = text.find(b"@", max(done, at + 1))


def addresses(text: bytes) -> Iterator[Span]:
    """Of a run of numbers with dots between, each four."""
    for m in DOTTED.finditer(text):
        parts, at = m.group().split(b"."), m.start()
        for k in range(0, len(parts) - 3, 4):
            own = parts[k : k + 4]
            end = at + sum(map(len, own)) + 3
            if all(len(p.lstrip(b"0")) <= 3 and int(p[-3:]) <= 255 for p in own):
                yield "ip", at, end
            at = end + 1


def base_spans(text: bytes) -> list[Span]:
    """(kind, start, end) in bytes of UTF-8, by kind as listed, then start."""
    out = list(emails(text)) if b"@" in text else []
    if b"." in text:
        out += addresses(text)
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(b" ", b"").replace(b"-", b"")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if b"+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum(48 <= c <= 57 for c in m.group()) <= 15]
    return out


def bits_each(key: bytes) -> float:
    """Shannon entropy of the characters."""
    share = np.bincount(np.frombuffer(key, np.uint8)) / len(key)
    share = share[share > 0]
    return float(-(share * np.log2(share)).sum())


def secrets(text: bytes, words: list[tuple[int, int]], taken: list[Span]) -> list[Span]:
    """High-entropy keys within the given long words, outside the spans taken."""
    out = []
    for a, b in words:
        for m in KEY.finditer(text, a, b):
            key = m.group()
            if any(48 <= c <= 57 for c in key) and any(c >= 65 and c != 95 for c in key) and bits_each(key) >= SECRET_BITS:
                if not any(x < m.end() and m.start() < y for _, x, y in taken):
                    out.append(("secret", m.start(), m.end()))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


class Slice:
    """A slice of the column: the spans of each row, and the terms outside them (row, byte span and hash of each)."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets
        w = Words(data, offsets)
        self.word_row = np.searchsorted(offsets, w.starts, "right") - 1
        long_, at = {}, w.starts - offsets[self.word_row] if len(w.starts) else w.starts
        for k in np.flatnonzero(w.ends - w.starts >= KEY_BYTES).tolist():
            long_.setdefault(int(self.word_row[k]), []).append((int(at[k]), int(at[k] + w.ends[k] - w.starts[k])))
        digit = (data >= 48) & (data <= 57)
        digits = np.concatenate([[0], np.cumsum(digit)])
        some = np.flatnonzero(digits[offsets[1:]] > digits[offsets[:-1]])
        at_sign = np.flatnonzero(data == 64)
        some = np.union1d(some, np.searchsorted(offsets, at_sign, "right") - 1)
        self.spans: dict[int, list[Span]] = {}
        for r in some.tolist():
            text = data[offsets[r] : offsets[r + 1]].tobytes()
            own = base_spans(text)
            own += secrets(text, long_.get(r, []), own)
            if own:
                self.spans[r] = own
        w.trim()
        self.points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        good = (w.ends > w.starts) & (digits[w.ends] == digits[w.starts])
        good &= self.points[w.ends] - self.points[w.starts] >= 3
        if self.spans:
            taken = np.zeros(len(data) + 1, np.int64)
            for r, own in self.spans.items():
                for _, a, b in own:
                    taken[offsets[r] + a] += 1
                    taken[offsets[r] + b] -= 1
            covered = np.concatenate([[0], np.cumsum(np.cumsum(taken[:-1]) > 0)])
            good &= covered[w.ends] == covered[w.starts]
        self.code = w.hashes()[good]
        self.row, self.starts, self.ends = self.word_row[good], w.starts[good], w.ends[good]

    def document_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct terms and in how many of the rows each stands, and in how many of those with entities."""
        order = np.lexsort((self.row, self.code))
        code, row = self.code[order], self.row[order]
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
        with_entities = np.zeros(len(self.offsets), np.int64)
        with_entities[list(self.spans)] = 1
        return summed(code[new], np.stack([np.ones(int(new.sum()), np.int64), with_entities[row[new]]], axis=1))

    def held(self, r: int, reach: int) -> tuple[list[dict[str, int]], np.ndarray]:
        """The row's entities with their contexts, and its distinct terms."""
        a, b = np.searchsorted(self.row, [r, r + 1])
        code, starts, ends = self.code[a:b], self.starts[a:b] - self.offsets[r], self.ends[a:b] - self.offsets[r]
        text = self.data[self.offsets[r] : self.offsets[r + 1]].tobytes()
        own: dict[int, set[bytes]] = {}
        kinds: dict[str, set[bytes]] = {}
        for kind, x, y in self.spans[r]:
            left, right = np.searchsorted(ends, x, "right"), np.searchsorted(starts, y)
            beside = code[max(0, left - reach) : left].tobytes() + b"|" + code[right : right + reach].tobytes()
            entity = _digest(f"{kind}:".encode() + text[x:y].lower())
            own.setdefault(entity, set()).add(beside)
            kinds.setdefault(kind, set()).add(entity.to_bytes(8, "little", signed=True) + beside)
        sets = [*own.items(), *((_digest(f"any {k}".encode()), c) for k, c in kinds.items())]
        return [{"entity": e, "context": _digest(b"\n".join(sorted(c)))} for e, c in sets], np.unique(code)


def summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes with the sums of their numbers, row by row."""
    if not len(code):
        return code, n
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    edge = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return code[edge], np.add.reduceat(n, edge, axis=0)


def scan(docs: DataFrame, text: str, reach: int) -> DataFrame:
    """Rows of two kinds: of a text with entities, the entities with their contexts and the hashes of all terms; of many texts, terms with their numbers of documents and of those with entities."""

    def rows(held: list, terms: list, code: list, n: list, near: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held, HELD), *[pa.array(x, pa.list_(pa.int64())) for x in (terms, code, n, near)]], names=["held", "terms", "code", "n", "n_near"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, ns, many = [], [], 0
        for batch in batches:
            for first, data, offsets in slices(batch.column(0)):
                own = Slice(first, data, offsets)
                found = [own.held(r, reach) for r in own.spans]
                if found:
                    yield rows([h for h, _ in found], [t.view(np.int64) for _, t in found], *[[None] * len(found)] * 3)
                code, n = own.document_counts()
                codes.append(code)
                ns.append(n)
                many += len(code)
                if many > FLUSH:
                    code, n = summed(np.concatenate(codes), np.concatenate(ns))
                    codes, ns, many = [code], [n], len(code)
                    if many > FLUSH // 2:
                        yield rows([None], [None], [code.view(np.int64)], [n[:, 0]], [n[:, 1]])
                        codes, ns, many = [], [], 0
        if codes:
            code, n = summed(np.concatenate(codes), np.concatenate(ns))
            yield rows([None], [None], [code.view(np.int64)], [n[:, 0]], [n[:, 1]])
        trim()

    slim = docs.select(F.col(f"`{text}`").alias(f"text{MARK}"))
    return slim.mapInArrow(find, "held array<struct<entity:bigint,context:bigint>>, terms array<bigint>, code array<bigint>, n array<bigint>, n_near array<bigint>").withColumn("row", F.monotonically_increasing_id())


def share(n_pair: Column, n_term: Column, n_entity: Column, total: int) -> Column:
    """PMI over information content."""
    return F.when(n_entity < total, F.log(n_pair * float(total) / (n_term * n_entity)) / F.log(float(total) / n_entity)).otherwise(0.0)


def disclosing(found: DataFrame, total: int, threshold: float, support: int) -> DataFrame:
    """(term, disclosure): terms at or above the threshold for some entity, with the highest."""
    held = found.where("held is not null").select("row", F.explode("held").alias("x")).select("row", "x.*")
    seen = held.groupBy("entity", "context").agg(F.count("*").alias("n")).groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count("*").alias("contexts"))
    entities = written(seen.where(F.col("contexts") >= support).select("entity", "n_entity"))
    # n(t, e) <= n(e), so a term above this number of documents is too common for the entity
    most = F.col("n_entity") ** threshold * float(max(1, total)) ** (1 - threshold) * (1 + 1e-9)
    known = held.join(entities, "entity").withColumn("most", most)
    known = written(known)
    widest, rarest = known.agg(F.max("most"), F.min("n_entity")).first()
    if widest is None:
        return found.sparkSession.createDataFrame([], "term long, disclosure double")
    counts = found.where("code is not null").select(F.explode(F.arrays_zip("code", "n", "n_near")).alias("x")).groupBy(F.col("x.code").alias("term")).agg(F.sum("x.n").alias("n_term"), F.sum("x.n_near").alias("n_near"))
    # n(t, e) is at most the number of the term's documents with entities, and to reach the threshold at least this share of all its documents
    least = (rarest / max(1, total)) ** (1 - threshold) * (1 - 1e-9)
    counts = written(counts.where((F.col("n_near") >= support) & (F.col("n_near") >= F.col("n_term") * F.lit(least)) & (F.col("n_term") <= F.lit(widest))).drop("n_near"))  # its size is known before terms are laid out beside it
    near = found.where("held is not null").join(known.select("row").distinct(), "row", "left_semi").select("row", F.explode("terms").alias("term")).join(counts, "term")
    both = near.join(known, "row").where("n_term <= most")
    # by context first: an entity in many documents is dealt out by its terms and contexts
    pairs = both.groupBy("entity", "term", "context").agg(F.count("*").alias("n"), F.first("n_term").alias("n_term"), F.first("n_entity").alias("n_entity"))
    pairs = pairs.groupBy("entity", "term").agg(F.sum("n").alias("n_pair"), F.count("*").alias("contexts"), F.first("n_term").alias("n_term"), F.first("n_entity").alias("n_entity"))
    pairs = pairs.where(F.col("contexts") >= support).withColumn("disclosure", share(F.col("n_pair"), F.col("n_term"), F.col("n_entity"), total))
    return written(pairs.where(F.col("disclosure") >= threshold).groupBy("term").agg(F.max("disclosure").alias("disclosure")))


def _sorted_terms(flagged: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    got = flagged.toArrow()
    code, worth = got.column("term").to_numpy().astype(np.int64).view(U64), got.column("disclosure").to_numpy()
    order = np.argsort(code)
    return code[order], worth[order]


def _places(own: Slice, known: np.ndarray, worth: np.ndarray) -> dict[int, list[tuple[int, int, float]]]:
    """By row of the column: (start, end, disclosure) of the known terms, in code points."""
    out: dict[int, list[tuple[int, int, float]]] = {}
    if len(known) and len(own.code):
        at = np.minimum(np.searchsorted(known, own.code), len(known) - 1)
        hit = np.flatnonzero(known[at] == own.code)
        base = own.points[own.offsets[own.row[hit]]]
        begin, end = own.points[own.starts[hit]] - base, own.points[own.ends[hit]] - base
        for r, a, b, d in zip((own.first + own.row[hit]).tolist(), begin.tolist(), end.tolist(), worth[at[hit]].tolist(), strict=True):
            out.setdefault(r, []).append((a, b, d))
    return out


def marked(docs: DataFrame, text: str, doc_id: str, flagged: DataFrame, max_terms: int, keep_text: bool) -> DataFrame:
    """One row per row: id, counts, spans, every place of the flagged terms outside those spans, and the text where wanted."""
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{doc_id}`").alias(f"id{MARK}"), F.col(f"`{text}`").alias(f"text{MARK}"))
    rounds = -(-flagged.count() // max_terms)
    wanted = spark.sparkContext.broadcast(_sorted_terms(flagged) if rounds <= 1 else (np.zeros(0, U64), np.zeros(0)))
    more = F.lit(None).cast(TERMS_DDL)
    if rounds > 1:  # more terms than a task may hold: each round marks its own, by row, and the rows bring them together
        slim = written(slim.withColumn("row", F.monotonically_increasing_id()))
        parts = None
        for k in range(rounds):
            part = _round(slim, spark.sparkContext.broadcast(_sorted_terms(flagged.where(F.pmod(F.xxhash64("term"), F.lit(rounds)) == k))))
            parts = part if parts is None else parts.unionByName(part)
        parts = parts.groupBy(F.col("row").alias("r")).agg(F.sort_array(F.flatten(F.collect_list("terms"))).alias("more"))
        slim = slim.join(parts, F.col("row") == F.col("r"), "left")
        more = F.col("more")
    slim = slim.select(f"id{MARK}", f"text{MARK}", more.alias("more"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, worth = wanted.value
        for batch in batches:
            n = len(batch)
            count = {k: np.zeros(n, np.int64) for k in ALL_KINDS}
            base, extra = [""] * n, [""] * n
            terms: list = [[] if x is None else x for x in batch.column(2).to_pylist()]
            for first, data, offsets in slices(batch.column(1)):
                own = Slice(first, data, offsets)
                for r, spans in own.spans.items():
                    at = own.points[offsets[r]]
                    spans = [(k, int(own.points[offsets[r] + a] - at), int(own.points[offsets[r] + b] - at)) for k, a, b in spans]
                    for k, _, _ in spans:
                        count[k][first + r] += 1
                    base[first + r] = joined([s for s in spans if s[0] != "secret"])
                    extra[first + r] = joined([s for s in spans if s[0] == "secret"])
                for r, found in _places(own, known, worth).items():
                    terms[r] = [{"start": a, "end": b, "disclosure": d} for a, b, d in found]
            cols = [batch.column(0), *[pa.array(count[k]) for k in ALL_KINDS], pa.array(base, pa.string()), pa.array(extra, pa.string()), pa.array(terms, TERMS)]
            yield pa.RecordBatch.from_arrays([*cols, *([batch.column(1)] if keep_text else [])], names=names)
        trim()

    names = [f"id{MARK}", *ALL_KINDS, "base", "extra", "terms", *([f"text{MARK}"] if keep_text else [])]
    kinds = ", ".join(f"{k} long" for k in ALL_KINDS)
    return slim.mapInArrow(find, f"id{MARK} {slim.schema[0].dataType.simpleString()}, {kinds}, base string, extra string, terms {TERMS_DDL}" + (f", text{MARK} string" if keep_text else ""))


def _round(slim: DataFrame, wanted: object) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, worth = wanted.value
        for batch in batches:
            found: dict[int, list[tuple[int, int, float]]] = {}
            for first, data, offsets in slices(batch.column(0)):
                found |= _places(Slice(first, data, offsets), known, worth)
            rows = batch.column(1).take(pa.array(list(found), pa.int64()))
            terms = [[{"start": a, "end": b, "disclosure": d} for a, b, d in x] for x in found.values()]
            yield pa.RecordBatch.from_arrays([rows, pa.array(terms, TERMS)], names=["row", "terms"])

    return written(slim.select(f"text{MARK}", "row").mapInArrow(find, f"row long, terms {TERMS_DDL}"))


def personal_data(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = 0.9, support: int = 3, reach: int = 4, max_terms: int = 1_000_000, keep_text: bool = False
) -> DataFrame:
    """One row per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, n_term, private (has any span), base, terms (array of start, end, disclosure)."""
    bounded_batches(docs.sparkSession)
    total = docs.count()
    flagged = disclosing(written(scan(docs, text, reach)), total, threshold, support)
    out = marked(docs, text, doc_id, flagged, max_terms, keep_text)
    more = F.expr("array_join(transform(terms, t -> concat('term:', t.start, ':', t.end)), ',')")
    spans = F.concat_ws(",", F.nullif("base", F.lit("")), F.nullif("extra", F.lit("")), F.nullif(more, F.lit("")))
    counts = [F.col(k).alias(f"n_{k}") for k in KINDS]
    last = [F.col("secret").alias("n_secret"), F.size("terms").cast("long").alias("n_term"), (spans != "").alias("private"), "base", "terms"]
    text_of = [F.col(f"text{MARK}")] if keep_text else []
    return out.select(F.col(f"id{MARK}").alias(doc_id), *counts, F.sha2(F.encode("base", "UTF-8"), 256).alias("base_sha256"), spans.alias("spans"), *last, *text_of)


def sanitise(text: str, spans: str, removed: frozenset[tuple[int, int]] = frozenset()) -> str:
    """The text with each span generalised to its kind, or taken out where it is in `removed`."""
    cuts = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s))
    out, at = [], 0
    for a, b, kind in cuts:
        if b <= at:
            continue
        out += [text[at : max(a, at)], "" if (a, b) in removed else f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", removal: float = 1.0, **how: object) -> DataFrame:
    """`docs`' ids and texts, row by row, with personal data generalised and the most disclosing terms removed; ids may be null or repeat, a null text stays null."""
    data = personal_data(docs, text, doc_id, keep_text=True, **how)  # type: ignore[arg-type]
    gone = F.expr(f"transform(filter(terms, t -> t.disclosure >= {float(removal)}), t -> struct(t.start, t.end))")
    both = data.select(F.col(f"`{doc_id}`").alias(doc_id), F.col(f"text{MARK}"), "spans", gone.alias(f"gone{MARK}"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True)
            texts = [sanitise(t, s, frozenset((g["start"], g["end"]) for g in gone_ or ())) if s and t else t for t, s, gone_ in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[doc_id, text])

    return both.mapInArrow(apply, f"`{doc_id}` {both.schema[0].dataType.simpleString()}, `{text}` string")
