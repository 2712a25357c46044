"""Log-probabilities of texts under a smoothed n-gram model of the corpus, read off a weighted backoff automaton.

A state is a context: up to `order` - 1 words that training texts hold.  An arc reads a word and carries the discounted, interpolated
log-probability of an n-gram seen in training; a failure arc leads to the context without its first word and carries
the log of the mass that discounting set free.  A text is read once from left to right from the empty state: failure arcs until an
arc reads the word, weights added up on the way.

The automaton of a large corpus fits nowhere whole.  Texts are dealt into batches of bounded size, and a batch gets the part of the
automaton that its own n-grams name.  For that, batches send sorted blocks of n-gram hashes to the buckets of the hash space, and a bucket
sends back the counts in the same order.  Orders go from the longest down: of all batches that hold an n-gram the first in training is told so, and
adds it to the followers of its context when that is counted in turn.  A hot n-gram costs a batch one hash, whatever its count.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import bounded_batches, partitions_for, trim, written
from .text_kernels import SHINGLE_STEP, U64, Words, mix, slices

#: Bytes of text for each batch, and hashes for each bucket.
BATCH_BYTES, BUCKET_KEYS = 8 << 20, 2_000_000
#: Fixed values of the base: what is added to each count; texts whose crc32 has this remainder are held out.
ADDED, HOLD_OUT, HELD = 0.1, 10, 0
#: The end of a text as a word; no word hashes to it but by chance.
END = U64(0xE7D2C9A1B3F58467)
_CODEC = pa.Codec("zstd", compression_level=1)

TOKENS = "batch long, doc_ids array<long>, held binary, lengths binary, codes binary, words binary, n_codes long, n_words long"
BLOCKS = "bucket int, batch long, n int, keys binary, counts binary, followers binary"
ANSWERS = "batch long, bucket int, n int, counts binary, followers binary, first binary, ones long, twos long, kinds long, tokens long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def pack(values: np.ndarray) -> bytes:
    """64-bit values byte plane by byte plane, compressed."""
    return _CODEC.compress(np.ascontiguousarray(values.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8).T), asbytes=True) if len(values) else b""


def unpack(data: bytes, n: int, kind: type = np.int64) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    return np.ascontiguousarray(np.frombuffer(_CODEC.decompress(data, 8 * n), np.uint8).reshape(8, n).T).view("<u8").reshape(n).astype(kind)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=U64(0)))


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(data, n, np.uint64), dtype=np.uint64)


def buckets_of(keys: np.ndarray, n: int) -> np.ndarray:
    """The bucket of each hash; sorted hashes give rising buckets."""
    return (((keys >> U64(32)) * U64(n)) >> U64(32)).astype(np.int64)


def tokenised(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows of TOKENS from doc_id, text and held: about `most` bytes of whole texts each."""
    part, made = TaskContext.get().partitionId() << 32, 0
    ids, held, lengths, hashes, size = [], [], [], [], 0

    def row() -> pa.RecordBatch:
        words, codes = np.unique(np.concatenate(hashes), return_inverse=True)
        n = np.concatenate(lengths)
        fields = [part + made, [x for a in ids for x in a], np.concatenate(held).astype(np.uint8).tobytes(), pack(n), pack(codes), pack_sorted(words), len(codes), len(words)]
        kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4, pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(fields, kinds, strict=True)], names=["batch", "doc_ids", "held", "lengths", "codes", "words", "n_codes", "n_words"])

    for batch in batches:
        own_ids, own_held = batch.column("doc_id").to_pylist(), batch.column("held").to_numpy(zero_copy_only=False)
        for first, data, offsets in slices(batch.column("text")):
            words, rows = Words(data, offsets), len(offsets) - 1
            hashes.append(np.insert(words.hashes(), words.first[1:], END))
            lengths.append(np.diff(words.first) + 1)
            ids.append(own_ids[first : first + rows])
            held.append(own_held[first : first + rows])
            size += len(data)
            if size >= most:
                yield row()
                ids, held, lengths, hashes, size, made = [], [], [], [], 0, made + 1
    if ids:
        yield row()
    trim()


class Grams:
    """The n-grams of one row of TOKENS up to an order: for each order m, at m - 1 in the lists

    ids: of the n-gram that ends at each token (-1: the text is too short there); keys: sorted hashes; counts: in training;
    context, suffix: the n-gram without its last and without its first word, as ids of the order below.
    """

    def __init__(self, row: dict, order: int):
        lengths = unpack(row["lengths"], len(row["doc_ids"]))
        held = np.frombuffer(row["held"], np.uint8).astype(bool)
        codes, words = unpack(row["codes"], row["n_codes"]), unpack_sorted(row["words"], row["n_words"])
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        place = np.arange(len(codes)) - np.repeat(self.starts, lengths)
        train = np.repeat(~held, lengths)
        self.ids, self.keys, self.counts = [codes], [words], [np.bincount(codes[train], minlength=len(words))]
        self.context, self.suffix = [None], [None]
        word = words[codes]
        key = word
        for m in range(2, order + 1):
            at = np.flatnonzero(place >= m - 1)
            key = np.concatenate([np.zeros(1, U64), mix(key[:-1] * SHINGLE_STEP + word[1:])]) if len(key) else key
            keys, own = np.unique(key[at], return_inverse=True)
            ids = np.full(len(codes), -1)
            ids[at] = own
            context, suffix = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
            context[own], suffix[own] = self.ids[-1][at - 1], self.ids[-1][at]
            self.ids.append(ids)
            self.keys.append(keys)
            self.counts.append(np.bincount(ids[at[train[at]]], minlength=len(keys)))
            self.context.append(context)
            self.suffix.append(suffix)


def answered(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts, followers, whether this batch is the first) of a batch's n-grams in the order of their keys, from its rows of ANSWERS."""
    parts = [(unpack(r["counts"], r["n"]), unpack(r["followers"], r["n"]), np.unpackbits(np.frombuffer(r["first"], np.uint8), count=r["n"]).astype(bool)) for r in rows.sort_by("bucket").to_pylist()]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def blocks(row: dict, m: int, buckets: int, above: pa.Table | None) -> pa.Table:
    """Rows of BLOCKS for the n-grams of order m; `above`: the answers of order m + 1, where there is one."""
    grams = Grams(row, m if above is None else m + 1)
    keys, counts = grams.keys[m - 1], grams.counts[m - 1]
    followers = np.zeros(len(keys), np.int64) if above is None else np.bincount(grams.context[m][answered(above)[2]], minlength=len(keys)) if len(above) else np.zeros(len(keys), np.int64)
    edges = np.searchsorted(buckets_of(keys, buckets), np.arange(buckets + 1))
    out = []
    for b in np.flatnonzero(np.diff(edges)).tolist():
        s = slice(edges[b], edges[b + 1])
        out.append((b, row["batch"], int(edges[b + 1] - edges[b]), pack_sorted(keys[s]), pack(counts[s]), pack(followers[s])))
    kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 3]
    return pa.table([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=["bucket", "batch", "n", "keys", "counts", "followers"])


def answer(group: pa.Table) -> pa.Table:
    """Rows of ANSWERS to the blocks of one bucket, the bucket's own figures in the first of them."""
    rows = group.sort_by("batch").to_pylist()
    keys = np.concatenate([unpack_sorted(r["keys"], r["n"]) for r in rows])
    counts, followers = (np.concatenate([unpack(r[c], r["n"]) for r in rows]) for c in ("counts", "followers"))
    order = np.argsort(keys, kind="stable")
    kind = np.empty(len(keys), np.int64)
    kind[order] = np.cumsum(np.concatenate([[0], keys[order][1:] != keys[order][:-1]]))
    n, then = (np.zeros(int(kind.max()) + 1, np.int64) for _ in range(2))
    np.add.at(n, kind, counts)
    np.add.at(then, kind, followers)
    seen = order[counts[order] > 0]  # by key, then batch
    first = np.zeros(len(keys), bool)
    first[seen[np.concatenate([[True], kind[seen][1:] != kind[seen][:-1]])] if len(seen) else seen] = True
    figures = [int((n == 1).sum()), int((n == 2).sum()), int((n > 0).sum()), int(n.sum())]
    out, a = [], 0
    for k, r in enumerate(rows):
        own = kind[a : a + r["n"]]
        out.append((r["batch"], r["bucket"], r["n"], pack(n[own]), pack(then[own]), np.packbits(first[a : a + r["n"]]).tobytes(), *(figures if k == 0 else [0] * 4)))
        a += r["n"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 3, *[pa.int64()] * 4]
    names = ["batch", "bucket", "n", "counts", "followers", "first", "ones", "twos", "kinds", "tokens"]
    return pa.table([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=names)


class Automaton:
    """The states and arcs that a batch's n-grams name.

    arc[m - 1]: log10 weights of the arcs that read an n-gram of order m, not a number where training does not hold it (order 1 reads every word).
    fall[l]: log10 weights of the failure arcs of the states of l words.
    """

    def __init__(self, grams: Grams, told: list[tuple], figures: list[dict]):
        total, kinds = figures[0]["tokens"], figures[0]["kinds"]
        counts = [t[0] for t in told]
        p = (counts[0] + ADDED) / (total + ADDED * (kinds + 1))
        self.known = counts[0] > 0
        self.arc, self.fall = [np.log10(p)], [None]
        for m in range(2, len(told) + 1):
            discount = discount_of(figures[m - 1])
            held, followers = counts[m - 2], told[m - 2][1]
            with np.errstate(divide="ignore", invalid="ignore"):
                free = discount * followers / held
                context, suffix = grams.context[m - 1], grams.suffix[m - 1]
                p = np.where(counts[m - 1] > 0, (counts[m - 1] - discount) / held[context] + free[context] * p[suffix], np.nan)
                self.arc.append(np.append(np.log10(p), np.nan))  # -1, where no n-gram ends, finds no arc
                self.fall.append(np.log10(free))

    def read(self, grams: Grams, a: int, b: int) -> float:
        """The log10 weight of the path that reads the tokens from a to b from the empty state."""
        arcs = [w[i[a:b]].tolist() for w, i in zip(self.arc, grams.ids, strict=True)]
        falls = [[], *[w[i[a : b - 1]].tolist() for w, i in zip(self.fall[1:], grams.ids, strict=False)]]
        known = self.known[grams.ids[0][a:b]].tolist()
        total, state, longest = 0.0, 0, len(arcs) - 1  # the state by its number of words; which they are, the place says
        for i in range(b - a):
            while (weight := arcs[state][i]) != weight:
                total += falls[state][i - 1]
                state -= 1
            total += weight
            state = min(state + 1, longest) if known[i] else 0
        return total


def discount_of(figures: dict) -> float:
    """Absolute discount from the n-grams seen once and twice, kept between 0 and 1 for corpora without any."""
    return (figures["ones"] + 0.5) / (figures["ones"] + 2 * figures["twos"] + 1)


def scored(row: dict, answers: list[pa.Table], figures: list[dict]) -> pa.Table:
    """Rows of SCORES for one row of TOKENS."""
    grams = Grams(row, len(answers))
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
    told = [answered(t) if len(t) else none for t in answers]  # no text may be long enough for an order
    automaton = Automaton(grams, told, figures)
    base = np.add.reduceat(automaton.arc[0][grams.ids[0]], grams.starts)
    known = np.add.reduceat(automaton.known[grams.ids[0]].astype(np.int64), grams.starts)
    score = [automaton.read(grams, a, b) for a, b in zip(grams.starts.tolist(), grams.ends.tolist(), strict=True)]
    n = len(score)
    held = np.frombuffer(row["held"], np.uint8).astype(bool)
    columns = [pa.array(row["doc_ids"], pa.int64()), held, grams.ends - grams.starts, known, np.full(n, figures[0]["tokens"]), base, pa.array(score, pa.float64())]
    return pa.table([pa.array(c) for c in columns], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def lm_scores(docs: DataFrame, order: int = 2, batch_bytes: int = BATCH_BYTES, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `score` is the text's log10 probability under a model of up to `order` words, learned from texts that are not held out.  Null text is empty and holds the end alone;
    a null doc_id counts as an empty id and so is held out; rows that repeat an id are documents of their own; further columns are ignored; an empty table gives no rows.
    Where nothing is in training every probability is that of the only unknown word, 1.  A text longer than `batch_bytes` is a batch of its own.
    Words and n-grams are told by 64 bits of a hash.
    """
    bounded_batches(docs.sparkSession)
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(HOLD_OUT)) == HELD
    tokens = written(docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), held.alias("held")).mapInArrow(partial(tokenised, most=batch_bytes), TOKENS))
    sizes = tokens.agg(F.sum("n_codes").alias("codes"), F.sum("n_words").alias("words")).first()
    answers: list[DataFrame] = []
    figures: list[dict] = []
    for m in range(order, 0, -1):
        buckets = partitions_for(sizes["codes"] if m > 1 else sizes["words"], bucket_keys)
        sent = _sent(tokens, m, buckets, answers[0] if answers else None)
        told = written(sent.groupBy("bucket").applyInArrow(answer, ANSWERS))
        sums = told.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("ones", "twos", "kinds", "tokens")]).first().asDict()
        answers, figures = [told, *answers], [sums, *figures]
    every = answers[0].select("*", F.lit(1).alias("m"))
    for m in range(2, order + 1):
        every = every.unionByName(answers[m - 1].select("*", F.lit(m).alias("m")))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        return scored(row, [right.filter(pc.equal(right["m"], m)) for m in range(1, order + 1)], figures)

    return tokens.groupBy("batch").cogroup(every.groupBy("batch")).applyInArrow(score, SCORES)


def _sent(tokens: DataFrame, m: int, buckets: int, above: DataFrame | None) -> DataFrame:
    if above is None:
        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield from blocks(row, m, buckets, None).to_batches()
            trim()

        return tokens.mapInArrow(send, BLOCKS)
    return tokens.groupBy("batch").cogroup(above.groupBy("batch")).applyInArrow(lambda left, right: blocks(left.to_pylist()[0], m, buckets, right), BLOCKS)

