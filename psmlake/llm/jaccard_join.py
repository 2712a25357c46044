"""Similarity join of documents by the Jaccard index of their word n-gram sets.

1. One pass finds n-grams that more than one document holds (`hash_counts`), among those with an odd hash.  A document with a partner shares
   `threshold` of its set with it, so only documents in which no more n-grams than the rest are known to be held once go on; equal sets become one class.
2. The classes' sets are put into one global order, rarest n-gram first.  A pair above the threshold shares
   one of the first n - ceil(threshold * n) + 1 n-grams; these prefixes meet in posting lists.
3. Pairs are proved by a prefix-tree join: the ordered sets that meet one probe form a trie, which is walked once,
   sharing the overlap counted along common paths; where no size below a node can lift the overlap to what a pair needs, the walk goes on
   at the node's next sibling.
4. First every class meets the leader of its lists; the links give components.  Then only pairs of a list that are not yet
   in one component meet, and of them only those with a side outside the list's most frequent component and with sizes that allow the threshold, so a
   group of copies costs links in proportion to its size.  Sets that meet a common leader are dealt over salted groups.

Sets are compared by 56 bits of a hash of each n-gram.  The broadcast tables grow with the corpus, up to `max_slots` bits and a 32nd of that in bytes; beyond that more documents
go on to step 2, up to all of them, and results stay the same.  Tables and shuffles go as soon as they are read for the last time.

Defined results: a null text counts as empty; an empty set links with nothing; a row with a null id takes its class's component, null where the class has no id; rows that repeat
an id are separate documents that report the same id; texts of any length are read whole; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hash_counts
from .components import components
from .runtime import MARK, bounded_batches, dropped, partitions_for, shuffles_dropped, trim, written
from .text_kernels import U64, mix, shingle_sets

GROUP_BYTES = 8 << 20
MEMBERS = 256
BLOCK = 64
#: Bits of the table of repeated n-grams: 64 MB.
MAX_SLOTS = 1 << 29


def least_share(n: int, t: Fraction) -> int:
    """ceil(t * n)"""
    return -(-n * t.numerator // t.denominator)


def least_overlap(n: int, m: int, t: Fraction) -> int:
    """Smallest overlap of sets of n and m that reaches t."""
    return -(-(n + m) * t.numerator // (t.numerator + t.denominator))


class OrderedSets:
    """Sets in trie order: each with the length of the path it shares with the one before."""

    def __init__(self, sets: list[np.ndarray]):
        spelled = [s.astype(">u8").tobytes() for s in sets]
        self.order = sorted(range(len(sets)), key=spelled.__getitem__)
        self.sets = [sets[i] for i in self.order]
        self.shared = [0] * len(sets)
        for k in range(1, len(sets)):
            x, y = self.sets[k - 1], self.sets[k]
            m = min(len(x), len(y))
            differ = np.flatnonzero(x[:m] != y[:m])
            self.shared[k] = int(differ[0]) if len(differ) else m
        self.depths, self.sizes = np.asarray(self.shared, np.int64), np.asarray([len(x) for x in self.sets], np.int64)

    def reaching(self, probe: np.ndarray, t: Fraction) -> list[int]:
        """Numbers of the sets that reach t with the probe, by one walk over the trie."""
        out = []
        n = len(probe)
        counted = np.zeros(1, np.int64)  # overlap of the current path's prefixes; its length is how far the path was walked
        walked = k = 0
        self.left = 0  # sets that were left with their subtree
        while k < len(self.sets):
            own = self.sets[k]
            m = len(own)
            need = least_overlap(n, m, t)
            walked = min(walked, self.shared[k])
            if len(counted) < m + 1:
                counted = np.concatenate([counted, np.zeros(m + 1 - len(counted), np.int64)])
            while True:
                # what is left on either side bounds what the overlap can still gain
                passed = int(np.searchsorted(probe, own[walked - 1], "right")) if walked else 0
                if counted[walked] + min(m - walked, n - passed) < need:
                    break
                if walked == m:
                    out.append(self.order[k])
                    break
                step = min(m, walked + BLOCK)
                piece = own[walked:step]
                at = np.minimum(np.searchsorted(probe, piece), n - 1)
                counted[walked + 1 : step + 1] = counted[walked] + np.cumsum(probe[at] == piece)
                walked = step
            k += 1
            if walked and k < len(self.sets) and self.shared[k] >= walked:
                end = self.subtree_end(k, walked)
                if not self._can(counted[walked], walked, n, n - passed, k, end, t):
                    self.left += end - k
                    k = end
        return out

    def subtree_end(self, k: int, depth: int) -> int:
        """The first set after k that does not go through the node at `depth` of the path before k."""
        below = np.flatnonzero(self.depths[k:] < depth)
        return k + int(below[0]) if len(below) else len(self.sets)

    def _can(self, overlap: int, depth: int, n: int, rest: int, k: int, end: int, t: Fraction) -> bool:
        """Whether some size of the sets k to end can reach the threshold; what overlap can exceed need by is greatest where a set ends with the probe."""
        low, high = int(self.sizes[k:end].min()), int(self.sizes[k:end].max())
        m = min(max(depth + rest, low), high)
        return any(overlap + min(x - depth, rest) >= least_overlap(n, x, t) for x in {m, max(low, m - 1), min(high, m + 1)})


def ranked(table: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The tokens as numbers whose order is the global order: by count, then hash."""
    return np.sort((hash_counts.level(table, tokens).astype(U64) << U64(56)) | (tokens >> U64(8)))


def watched(own: np.ndarray) -> np.ndarray:
    """The n-grams that the table of repeated ones knows: those with an odd hash, half of them."""
    return own[(own & U64(1)) == 1]


def may_link(table: np.ndarray, own: np.ndarray, t: Fraction) -> bool:
    """Whether a set can have a partner: what it need not share holds all n-grams that are met once."""
    return int((~hash_counts.repeated(table, watched(own))).sum()) <= len(own) - least_share(len(own), t)


def _sets(docs: DataFrame, doc_id: str, text: str, width: int, t: Fraction, seen: Broadcast) -> DataFrame:
    """One row per row: id, n, class hash, whether it goes on, and the set where its class is new to the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, met = seen.value, set()
        for batch in batches:
            size, a, b = (np.zeros(len(batch), np.int64) for _ in range(3))
            on = np.zeros(len(batch), bool)
            held: list[bytes | None] = [None] * len(batch)
            ids, start, weight = batch.column(0), 0, 0

            def part(end: int, start_: int) -> pa.RecordBatch:
                cut = slice(start_, end)
                return pa.RecordBatch.from_arrays([ids.slice(start_, end - start_), batch.column(2).slice(start_, end - start_), pa.array(size[cut]), pa.array(a[cut]), pa.array(b[cut]), pa.array(on[cut]), pa.array(held[cut], pa.binary())], names=[f"id{MARK}", "h", "n", "ka", "kb", "goes_on", "tokens"])

            for i, own in shingle_sets(batch.column(1), width):
                size[i] = len(own)
                if len(own):
                    a[i], b[i] = np.array([own.sum(dtype=U64), mix(own ^ U64(0xA0761D6478BD642F)).sum(dtype=U64)]).view(np.int64)
                    on[i] = may_link(table, own, t)
                    if on[i] and (a[i], b[i]) not in met:
                        met.add((a[i], b[i]))
                        held[i] = own.astype("<u8").tobytes()
                        weight += 8 * len(own)
                if weight > GROUP_BYTES:
                    yield part(i + 1, start)
                    start, weight = i + 1, 0
            yield part(len(batch), start)
            trim()

    slim = docs.select(F.col(f"`{doc_id}`").alias(f"id{MARK}"), F.col(f"`{text}`").alias(f"text{MARK}"), F.xxhash64(f"`{text}`").alias("h"))
    return slim.mapInArrow(run, f"id{MARK} {slim.schema[0].dataType.simpleString()}, h long, n long, ka long, kb long, goes_on boolean, tokens binary")


def _postings(classes: DataFrame, t: Fraction, order: Broadcast) -> DataFrame:
    """(gram, node, n, at, common) of the prefixes' n-grams that may be repeated; common: how much of the set may be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = order.value
        for batch in batches:
            grams, nodes, sizes, places, common = [], [], [], [], []
            for node, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = ranked(table, np.frombuffer(blob.as_buffer(), "<u8"))
                prefix = own[: len(own) - least_share(len(own), t) + 1]
                at = np.flatnonzero(prefix >= U64(8 << 56))
                grams.append(prefix[at])
                places.append(at)
                nodes.append(np.full(len(at), node, np.int64))
                sizes.append(np.full(len(at), len(own), np.int64))
                common.append(np.full(len(at), (own >= U64(8 << 56)).sum() / len(own)))
            cols = [np.concatenate(c) if c else np.zeros(0) for c in (grams, nodes, sizes, places, common)]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0].astype(U64).view(np.int64)), *[pa.array(c.astype(np.int64)) for c in cols[1:4]], pa.array(cols[4].astype(np.float64))], names=["gram", "node", "n", "at", "common"])

    return classes.select("node", "tokens").mapInArrow(run, "gram long, node long, n long, at long, common double")


def _proved(pairs: DataFrame, classes: DataFrame, t: Fraction, order: Broadcast) -> DataFrame:
    """Of pairs (a, b, n of b), those that reach t.  a probes the trie of its partners, at most about MEMBERS to a salted group."""
    probes = pairs.groupBy("a").agg(F.count("*").alias("many"), F.sum("n").alias("weight")).withColumn("salts", F.ceil(F.col("many") / MEMBERS).cast("long"))
    probes = written(probes)
    parts = partitions_for(8 * 2 * (probes.agg(F.sum("weight")).first()[0] or 0), GROUP_BYTES)
    own = classes.select(F.col("node").alias("c"), "tokens")
    members = pairs.join(probes.select("a", "salts"), "a").join(own, F.col("b") == F.col("c")).select("a", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"), "b", "tokens")
    probe = probes.join(own, F.col("a") == F.col("c")).select("a", F.explode(F.expr("sequence(0L, salts - 1)")).alias("salt"), F.lit(None).cast("long").alias("b"), "tokens")
    rows = members.unionByName(probe).withColumn("part", F.pmod(F.xxhash64("a", "salt"), F.lit(parts)).cast("int"))

    def join(group: pa.Table) -> pa.Table:
        table = order.value
        a, salt = group.column("a").to_numpy(), group.column("salt").to_numpy()
        b, blobs = group.column("b").to_pylist(), group.column("tokens")
        by: dict[tuple[int, int], list[int]] = {}
        for i, key in enumerate(zip(a.tolist(), salt.tolist(), strict=True)):
            by.setdefault(key, []).append(i)
        out: list[tuple[int, int]] = []
        for (x, _), rows_ in by.items():
            sets = {i: ranked(table, np.frombuffer(blobs[i].as_buffer(), "<u8")) for i in rows_}
            probe_ = next(sets[i] for i in rows_ if b[i] is None)
            partners = [i for i in rows_ if b[i] is not None]
            trie = OrderedSets([sets[i] for i in partners])
            out += [(x, b[partners[k]]) for k in trie.reaching(probe_, t)]
        trim()
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})

    return rows.groupBy("part").applyInArrow(join, "a long, b long")


def _grouped(docs: DataFrame, text: str, doc_id: str, width: int, threshold: Fraction, max_slots: int) -> DataFrame:
    """One row per row: id, a hash of the text, set size, component (null: linked with nothing) and the smallest id in it."""
    bounded_batches(docs.sparkSession)
    with shuffles_dropped(docs.sparkSession):
        return _linked(docs, text, doc_id, width, threshold, max_slots)


def _linked(docs: DataFrame, text: str, doc_id: str, width: int, threshold: Fraction, max_slots: int) -> DataFrame:
    spark, t = docs.sparkSession, threshold
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    texts = docs.select(F.col(f"`{text}`").alias(f"text{MARK}"))
    table = hash_counts.hash_table(texts, lambda batch: (watched(own) for _, own in shingle_sets(batch.column(0), width)), size // 12, max_slots, levels=False, spare=1)
    seen = spark.sparkContext.broadcast(table)
    del table  # the broadcast has it
    sets = written(_sets(docs, doc_id, text, width, t, seen))
    seen.destroy()
    rows = written(sets.drop("tokens"))

    classes = sets.where("goes_on").groupBy("ka", "kb").agg(F.min(f"id{MARK}").alias("least"), F.first("tokens", ignorenulls=True).alias("tokens"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()))
    dropped(sets)
    weight = classes.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0
    counts = hash_counts.hash_table(classes.select("tokens"), lambda batch: (np.frombuffer(x.as_buffer(), "<u8") for x in batch.column(0)), weight // 8, max_slots >> 5, levels=True, spare=2)
    order = spark.sparkContext.broadcast(counts)
    del counts

    every = written(_postings(classes, t, order))
    lists = every.groupBy("gram").agg(F.count("*").alias("many"), F.max(F.struct("common", (-F.col("node")).alias("minus"))).alias("top")).where("many > 1")
    posted = written(every.join(lists.select("gram", (-F.col("top.minus")).alias("leader")), "gram").drop("common"))
    dropped(every)

    star = posted.where("node != leader").groupBy("node", "n", "leader").agg(F.count("*").alias("hits"))
    first = star.groupBy("node", "n").agg(F.max(F.struct("hits", "leader")).alias("best")).select(F.col("best.leader").alias("a"), F.col("node").alias("b"), "n")
    tried = written(first)
    links = _proved(tried, classes, t, order)

    for last in (False, True):
        comp = components(links)
        own = posted.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
        open_ = own.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("gram")
        still = own = written(own.join(open_, "gram", "left_semi"))
        if not last:  # once more with every leader of the lists that are still open
            lead = own.where("node = leader").select("gram", F.col("component").alias("other")).distinct()
            pairs = own.where("node != leader").join(lead, "gram").where("component != other").select(F.col("leader").alias("a"), F.col("node").alias("b"), "n").distinct()
        else:
            # a pair has a side outside the list's most frequent component, and sizes within a factor 1 / t: in the same step of it or the next
            counted = own.groupBy("gram", "component").agg(F.count("*").alias("many")).groupBy("gram").agg(F.max(F.struct("many", "component")).alias("top"))
            size = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(float(1 / t))) + 1e-9).cast("int")
            own = own.withColumn("size", size)
            x = own.join(counted.select(F.col("gram").alias("g"), F.col("top.component").alias("main")), (F.col("gram") == F.col("g")) & (F.col("component") != F.col("main"))).alias("x")
            y = own.withColumn("size", F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1))).alias("y")
            room = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
            need = F.ceil((F.col("x.n") + F.col("y.n")) * t.numerator / (t.numerator + t.denominator))
            near = (F.col("x.n") * t.numerator <= F.col("y.n") * t.denominator) & (F.col("y.n") * t.numerator <= F.col("x.n") * t.denominator)
            apart = (F.col("x.component") != F.col("y.component")) & (F.col("x.size") == F.col("y.size"))
            # of the n-grams that a pair shares, the first has room for the whole overlap
            pairs = x.join(y, (F.col("x.gram") == F.col("y.gram")) & apart & near & (room >= need)).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"), F.when(F.col("x.node") < F.col("y.node"), F.col("y.n")).otherwise(F.col("x.n")).alias("n")).distinct()
        both = tried.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        pairs = written(pairs.join(both, ["a", "b"], "left_anti"))
        dropped(still)
        # what is linked so far is a star of each component, so only what the new pairs join is sought again
        links = comp.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(_proved(pairs, classes, t, order))
        tried = tried.unionByName(pairs)

    comp = components(links)
    order.destroy()
    named = classes.select("node", "ka", "kb", "least").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = written(named)
    dropped(classes, posted)
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(smallest, "component").select(F.col("ka").alias("xa"), F.col("kb").alias("xb"), "component", "component_id")
    many = rows.where("goes_on").select(f"id{MARK}", "h", "n", "ka", "kb").join(named, (F.col("ka") == F.col("xa")) & (F.col("kb") == F.col("xb")))
    alone = rows.where("not goes_on").select(f"id{MARK}", "h", "n", F.lit(None).cast("long").alias("component"), F.col(f"id{MARK}").alias("component_id"))
    return many.select(f"id{MARK}", "h", "n", "component", "component_id").unionByName(alone)


def similarity_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 5, threshold: Fraction = Fraction(4, 5), max_slots: int = MAX_SLOTS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id."""
    return _grouped(docs, text, doc_id, width, threshold, max_slots).select(F.col(f"id{MARK}").alias(doc_id), F.col("n").alias("n_shingles"), "component_id")


def first_of_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 5, threshold: Fraction = Fraction(4, 5), max_slots: int = MAX_SLOTS) -> DataFrame:
    """One row of each group: that with the smallest id; of rows that share it, one text, and of rows that repeat id and text, one.  Rows without an id stay.  Columns as given."""
    one, i, h = f"one{MARK}", f"i{MARK}", f"h{MARK}"
    rows = written(_grouped(docs, text, doc_id, width, threshold, max_slots).where("component is not null").select(F.col(f"id{MARK}").alias(i), F.col("h").alias(h), "component"))
    first = rows.groupBy(F.col("component").alias(one)).agg(F.min(F.struct(F.col(i).isNull().alias("none"), F.col(i).alias("id"), F.col(h).alias("h"))).alias("first"))
    rows = rows.join(first, F.col("component") == F.col(one))
    is_first = F.col(i).eqNullSafe(F.col("first.id")) & (F.col(h) == F.col("first.h"))
    own = (F.col(f"`{doc_id}`") == F.col(i)) & (F.xxhash64(F.col(f"`{text}`")) == F.col(h))
    kept = docs.join(rows.where(~is_first & F.col(i).isNotNull()).select(i, h).distinct(), own, "left_anti")
    twice = written(rows.where(is_first & F.col(i).isNotNull()).groupBy(i, h).agg(F.count("*").alias("many")).where("many > 1").select(i, h))
    if twice.isEmpty():
        return kept
    again = kept.join(twice, own, "left_semi").withColumn(h, F.xxhash64(F.col(f"`{text}`"))).dropDuplicates([doc_id, h]).drop(h)
    return kept.join(twice, own, "left_anti").unionByName(again)
