"""Mixing sources to target weights by Sainte-Lague apportionment.

Every source's documents are dealt, by a seeded hash, over shards of about `shard_rows`; a shard of one source
is a cell.  A cell's documents stand in a seeded order, the cells of a source stand one behind the other, and all its words are cut into blocks of `block_words`,
only the last of them shorter; a block belongs to the cell where it starts.  Sainte-Lague apportionment (highest quotients
w / (2k + 1)) gives each source its number of blocks.  A source takes all its blocks once for every full epoch in that
number; the rest is apportioned to its cells, each of which takes as many blocks in a row, around its end if need be, from a seeded start: documents
come whole but for those at the ends of a cell's run.

The driver holds one number for each source, `max_sources` at most.  Cells are apportioned on executors, source by source, a few numbers for every
`shard_rows` documents.  A cell is sorted in one task; where an id and text repeat so often that cells grow beyond `MOST_IN_CELL` times
`shard_rows`, rows are numbered, written, and dealt by that number as well.

Defined results: a null text has size 0 and is taken 0 times; a null source is a source of its own,
sorted last; null ids and repeated rows are rows like any other; a document of any length is cut like any other; an empty table gives an empty table;
more than `max_sources` sources raise ValueError.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .runtime import MARK, bounded_batches, partitions_for, written
from .text_kernels import U64, mix

WEIGHTS = (5, 2, 1)
MOST_IN_CELL = 8
#: Working columns.
SOURCE, SIZE, KEY, SHARD, PLACE, AT, RID = (f"{n}{MARK}" for n in ("source", "size", "key", "shard", "place", "at", "rid"))
PIECES = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[int], share: Fraction = Fraction(3, 2), most: int = 2) -> list[Fraction]:
    """Shares of `share` times all sizes by weight; none above `most` times its size, the excess reshared."""
    out = [Fraction(0)] * len(sizes)
    left, open_ = share * sum(sizes), set(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if unit * weights[i] >= most * sizes[i]}
        for i in over:
            out[i] = Fraction(most * sizes[i])
            left -= out[i]
        open_ -= over
        if not over:
            for i in open_:
                out[i] = unit * weights[i]
            break
    return out


def _seats(seats: int, weights: np.ndarray, caps: np.ndarray) -> np.ndarray:
    caps = np.where(weights > 0, caps, 0)
    seats = min(seats, int(caps.sum()))
    if seats <= 0:
        return np.zeros(len(weights), np.int64)

    def given(divisor: float) -> np.ndarray:
        return np.minimum(caps, np.floor(weights / divisor + 0.5).astype(np.int64))

    low, high = float(weights.max()) / (4.0 * caps.sum() + 4.0), 2.0 * float(weights.max()) + 1.0
    for _ in range(100):
        middle = (low * high) ** 0.5
        if given(middle).sum() > seats:
            low = middle
        else:
            high = middle
    out = given(high)
    while (left := seats - int(out.sum())) > 0:  # ties at the last divisor: the highest quotients, the first of equal ones
        quotient = np.where(out < caps, weights / (2 * out + 1), -1.0)
        out[np.argsort(-quotient, kind="stable")[: min(left, int((out < caps).sum()))]] += 1
    return out


def sainte_lague(seats: int, weights: Sequence[float], caps: Sequence[int]) -> list[int]:
    """Seats by highest quotients weight / (2 * seats + 1), none above its cap, ties to the first.

    A divisor found by bisection places all but the last few seats at once.
    """
    return _seats(seats, np.asarray(weights, float), np.asarray(caps, np.int64)).tolist()


def cell_runs(words: np.ndarray, extra: int, width: int, start_hash: np.ndarray) -> dict[str, np.ndarray]:
    """Of a source's cells in order: where each begins, and the word ranges that it takes of one partial epoch, as three ranges in order.

    The first is what the block that an earlier cell owns reaches into this one, the others are the cell's own run, in two parts where it goes around the end.
    """
    at = np.cumsum(words) - words
    total = int(words.sum())
    first, last = -(-at // width), -(-(at + words) // width)
    many = last - first
    quota = _seats(extra, many.astype(float), many)
    start = (start_hash % np.maximum(many, 1).astype(U64)).astype(np.int64)
    around = np.maximum(0, start + quota - many)
    a = np.stack([np.zeros_like(at), first, first + start]) * width
    b = np.stack([np.zeros_like(at), first + around, first + np.minimum(start + quota, many)]) * width
    block = at // width
    owner = np.minimum(np.searchsorted(last, block, "right"), max(0, len(at) - 1))
    reaches = (at % width > 0) & ((block - first[owner] - start[owner]) % np.maximum(many[owner], 1) < quota[owner])
    a[0], b[0] = at, np.where(reaches, (block + 1) * width, at)
    for k in (0, 1):  # ranges that touch become one
        touch = (b[k] > a[k]) & (b[k] == a[k + 1]) & (b[k + 1] > a[k + 1])
        a[k + 1] = np.where(touch, a[k], a[k + 1])
        b[k] = np.where(touch, a[k], b[k])
    b = np.minimum(b, total)
    return {"at": at, "quota": quota, **{f"a{k}": a[k] for k in range(3)}, **{f"b{k}": np.maximum(a[k], b[k]) for k in range(3)}}


CELL = ("at", "a0", "b0", "a1", "b1", "a2", "b2")


def _numbered(docs: DataFrame) -> DataFrame:
    """`docs` with RID, 0 and up within rows that are equal in all columns.

    Equal rows are interchangeable, so whichever gets a number, the rows with their numbers are the same in each run and however the table is split.
    They are numbered within parts, and parts follow each other, so many equal rows are not one task's.
    """
    part, same, n, before = f"part{MARK}", f"same{MARK}", f"n{MARK}", f"before{MARK}"
    rows = written(docs.withColumn(part, F.spark_partition_id())).withColumn(same, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    counts = rows.groupBy(same, part).agg(F.count("*").alias(n))
    earlier = Window.partitionBy(same).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(same, part, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before))
    own = F.row_number().over(Window.partitionBy(same, part).orderBy(F.lit(0)))
    return written(rows.join(counts, [same, part]).withColumn(RID, F.col(before) + own - 1).drop(part, same, before))


def _mix(
    docs: DataFrame, text: str, doc_id: str, weights: Sequence[int], share: Fraction, most: int, block_words: int, seed: int, shard_rows: int, max_sources: int, numbered: bool = False
) -> DataFrame:
    """`docs`, which has SOURCE, SIZE and KEY, with source_size, target, epochs and ranges added under their marked names."""
    spark = docs.sparkSession
    sources = docs.groupBy(SOURCE).agg(F.count("*").alias("n")).limit(max_sources + 1).collect()
    if len(sources) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    sources = sorted(sources, key=lambda r: (r[SOURCE] is None, r[SOURCE] or ""))
    shards = [(i, r[SOURCE], partitions_for(r["n"], shard_rows)) for i, r in enumerate(sources)]
    many = spark.createDataFrame(shards, f"{PLACE} int, name{MARK} string, shards{MARK} int")
    placed = docs.join(F.broadcast(many), F.col(SOURCE).eqNullSafe(F.col(f"name{MARK}"))).drop(f"name{MARK}")
    spread = F.xxhash64(KEY, RID) if numbered else F.col(KEY)
    placed = placed.withColumn(SHARD, F.pmod(spread, F.col(f"shards{MARK}")).cast("int")).drop(f"shards{MARK}")
    cells = written(placed.groupBy(PLACE, SHARD).agg(F.sum(SIZE).alias("words"), F.count("*").alias("rows")))
    if not numbered and (cells.agg(F.max("rows")).first()[0] or 0) > MOST_IN_CELL * shard_rows:
        return _mix(_numbered(docs), text, doc_id, weights, share, most, block_words, seed, shard_rows, max_sources, True).drop(RID)

    sums = {r[PLACE]: r["words"] for r in cells.groupBy(PLACE).agg(F.sum("words").alias("words")).collect()}
    sizes = [sums.get(i, 0) for i in range(len(sources))]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, most)
    blocks = [-(-s // block_words) for s in sizes]
    wanted = [g * b / s if s else Fraction(0) for g, b, s in zip(goal, blocks, sizes, strict=True)]
    quota = sainte_lague(round(sum(wanted)), [float(w) for w in wanted], [most * b for b in blocks]) if sizes else []
    parts = [divmod(q, b) if b else (0, 0) for q, b in zip(quota, blocks, strict=True)]

    def apportion(group: pa.Table) -> pa.Table:
        place, shard, words = (group.column(c).to_numpy() for c in (PLACE, SHARD, "words"))
        order = np.argsort(shard)
        source = int(place[0])
        start = mix(shard[order].astype(U64) + U64((seed * 1_000_003 + source) << 32))
        runs = cell_runs(words[order], parts[source][1], block_words, start)
        return pa.table({"p": pa.array(place, pa.int32()), "s": pa.array(shard[order], pa.int32()), **{c: pa.array(runs[c].astype(np.int64)) for c in CELL}})

    runs = cells.groupBy(PLACE).applyInArrow(apportion, "p int, s int, " + ", ".join(f"{c} long" for c in CELL))
    runs = written(runs).select(F.col("p").alias(f"p{MARK}"), F.col("s").alias(f"s{MARK}"), *[F.col(c).alias(f"{c}{MARK}c") for c in CELL])
    facts = spark.createDataFrame([(i, sizes[i], float(goal[i]), parts[i][0]) for i in range(len(sizes))], f"q{MARK} int, source_size{MARK} long, target{MARK} double, epochs{MARK} long")
    rows = placed.join(runs, (F.col(PLACE) == F.col(f"p{MARK}")) & (F.col(SHARD) == F.col(f"s{MARK}"))).join(F.broadcast(facts), F.col(PLACE) == F.col(f"q{MARK}"))
    # equal rows but for other columns follow a hash of all, so that reruns agree
    order = Window.partitionBy(PLACE, SHARD).orderBy(KEY, F.col(f"`{doc_id}`"), SIZE, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    begin = F.col(f"at{MARK}c") + F.sum(SIZE).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col(SIZE)
    rows = rows.withColumn(AT, begin)
    hit = [F.struct(F.greatest(F.lit(0), F.col(f"a{k}{MARK}c") - F.col(AT)).alias("begin"), F.least(F.col(SIZE), F.col(f"b{k}{MARK}c") - F.col(AT)).alias("end")) for k in range(3)]
    rows = rows.withColumn(f"ranges{MARK}", F.filter(F.array(*hit), lambda x: x["begin"] < x["end"]))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], f"source_size{MARK}", f"target{MARK}", f"epochs{MARK}", f"ranges{MARK}")


def _marked(docs: DataFrame, text: str, doc_id: str, source: str, seed: int, *more: Column) -> DataFrame:
    body = F.col(f"`{text}`")
    return docs.select(*more, F.col(f"`{source}`").cast("string").alias(SOURCE), word_count(body).alias(SIZE), F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"), body).alias(KEY))


def mix_plan(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", weights: Sequence[int] = WEIGHTS, share: Fraction = Fraction(3, 2), most: int = 2,
    block_words: int = 64, seed: int = 7, shard_rows: int = 4_000, max_sources: int = 10_000,
) -> DataFrame:
    """One row per document: doc_id, key, size, source_size, target, taken, epochs, ranges.

    `key` is a hash of id and text; `epochs` counts whole takes; `ranges` holds the word ranges
    [begin, end) of one more, partial take; taken = epochs * size + the ranges' words.
    """
    bounded_batches(docs.sparkSession)
    slim = written(_marked(docs, text, doc_id, source, seed, F.col(f"`{doc_id}`").alias("doc_id")))
    rows = _mix(slim, text, "doc_id", weights, share, most, block_words, seed, shard_rows, max_sources)
    partial = F.aggregate(f"ranges{MARK}", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["begin"])
    epochs = F.col(f"epochs{MARK}")
    return rows.select(
        "doc_id", F.col(KEY).alias("key"), F.col(SIZE).alias("size"), F.col(f"source_size{MARK}").alias("source_size"), F.col(f"target{MARK}").alias("target"), (epochs * F.col(SIZE) + partial).alias("taken"), epochs.alias("epochs"), F.col(f"ranges{MARK}").alias("ranges")
    )


def mixed(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", weights: Sequence[int] = WEIGHTS, share: Fraction = Fraction(3, 2), most: int = 2,
    block_words: int = 64, seed: int = 7, shard_rows: int = 4_000, max_sources: int = 10_000,
) -> DataFrame:
    """The documents as the mix takes them, columns as given: a row for each whole take and one for each range of a partial take.

    A range that is the whole document is the document as it is; a shorter one is cut out of the text, which keeps its spacing, from its first word to its last; a column `n_chars` is then set
    to the new length.  Documents without words are not taken.
    """
    bounded_batches(docs.sparkSession)
    names = docs.columns
    marked = _marked(docs, text, doc_id, source, seed, *[F.col(f"`{c}`") for c in names])
    rows = _mix(marked, text, doc_id, weights, share, most, block_words, seed, shard_rows, max_sources)
    whole = F.struct(F.lit(0).cast("long").alias("begin"), F.col(SIZE).alias("end"))
    takes = F.when(F.col(SIZE) > 0, F.concat(F.array_repeat(whole, F.col(f"epochs{MARK}").cast("int")), F.col(f"ranges{MARK}")))
    rows = rows.select(*[F.col(f"`{c}`") for c in names], SIZE, F.explode(takes).alias(f"take{MARK}"))
    begin, end = F.col(f"take{MARK}.begin"), F.col(f"take{MARK}.end")
    partly = end - begin < F.col(SIZE)
    words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(PIECES), F.lit(0))
    cut = F.ltrim(F.array_join(F.slice(words, (begin + 1).cast("int"), (end - begin).cast("int")), ""), F.lit(" \t\n\x0b\x0c\r"))
    rows = rows.withColumn(text, F.when(partly, cut).otherwise(F.col(f"`{text}`")))
    if "n_chars" in names:
        rows = rows.withColumn("n_chars", F.when(partly, F.length(F.col(f"`{text}`")).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*[F.col(f"`{c}`") for c in names])
