"""Exact deduplication by two-pass Bloom filtering, in DataFrame functions only.

Pass one turns every normalised text into a digest and each digest into one slot for each of two hash functions.  The slots of the first, eight bytes a row, are
counted with map-side combining; those that more than one row has set form the first bitmaps.  The rows that they let through
set the slots of the second, counted the same way.  Pass two tests each row where it stands: a row whose slots are not both in the bitmaps is
unique and goes straight through, and only the others shuffle their digest.  False positives cost a little shuffling and never change the result.

Bitmaps are packed, 4 KB a piece, and broadcast.  A filter has `SPARE` slots or more a row and `max_filter_bits` at most; more rows than that are dealt
to ranges of another hash, each written by itself and filtered in a job of its own, so the filter is as sharp and the broadcast as small for any number of rows.

Defined results: a null text counts as empty; a null id never wins over another id, and a
group without ids keeps one of its rows; rows that repeat an id with the same text count
as rows, and `drop_duplicates` keeps one of them; texts of any length are hashed whole; an empty table gives an empty table; the caller's
other columns are untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .runtime import MARK, partitions_for, written

SPACES = r"[\x20\x09-\x0D]+"
SPARE = 32
#: Bits of one packed bitmap row, as bitmap_construct_agg makes it.
ROW_BITS = 32768
D, ID, GROUP, RANGE, FLAG = f"digest{MARK}", f"id{MARK}", f"group{MARK}", f"range{MARK}", f"again{MARK}"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def digest(text: Column) -> Column:
    return F.sha2(F.encode(normalised(text), "UTF-8"), 256)


def filter_bits(rows: int, max_filter_bits: int) -> int:
    """A power of two with SPARE slots or more a row, within the bound."""
    bits = ROW_BITS
    while bits < SPARE * rows and bits < max_filter_bits:
        bits *= 2
    return bits


def _slot(value: Column, k: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(value, F.lit(k)), F.lit(bits).cast("long"))


def repeated_slots(digests: DataFrame, column: str, k: int, bits: int) -> DataFrame:
    """The bitmaps of hash function `k`: (row, bitmap of the slots that two rows or more have set)."""
    twice = digests.groupBy(_slot(F.col(column), k, bits).alias("slot")).agg(F.count("*").alias("n")).where("n > 1")
    packed = twice.select(F.expr(f"slot div {ROW_BITS}").alias("row"), F.expr(f"slot % {ROW_BITS}").alias("bit"))
    return written(packed.groupBy("row").agg(F.expr("bitmap_construct_agg(bit)").alias("bits")))


def let_through(df: DataFrame, column: str, bitmaps: DataFrame, k: int, bits: int, flag: str) -> DataFrame:
    """`df` with boolean `flag`: whether the value's slot for hash function `k` is in the bitmaps."""
    names = df.columns
    slot = f"slot{k}{MARK}"
    own = bitmaps.select(F.col("row").alias(f"row{k}{MARK}"), F.col("bits").alias(f"bits{k}{MARK}"))
    df = df.withColumn(slot, _slot(F.col(column), k, bits)).join(F.broadcast(own), F.col(f"row{k}{MARK}") == F.expr(f"{slot} div {ROW_BITS}"), "left")
    byte = f"cast(conv(hex(substring(bits{k}{MARK}, cast(({slot} % {ROW_BITS}) div 8 + 1 as int), 1)), 16, 10) as int)"
    return df.select(*[F.col(f"`{c}`") for c in names], F.expr(f"coalesce(getbit({byte}, cast({slot} % 8 as int)), 0) = 1").alias(flag))


class Filter:
    """The two functions' bitmaps over some digests."""

    def __init__(self, digests: DataFrame, rows: int, max_filter_bits: int):
        self.bits = filter_bits(rows, max_filter_bits)
        self.maps = [repeated_slots(digests, D, 0, self.bits)]
        self.maps.append(repeated_slots(self._test(digests, 0, FLAG).where(FLAG), D, 1, self.bits))

    def _test(self, df: DataFrame, k: int, flag: str) -> DataFrame:
        return let_through(df, D, self.maps[k], k, self.bits, flag)

    def tested(self, df: DataFrame) -> DataFrame:
        """`df` with FLAG: whether the digest may be repeated."""
        other = f"other{MARK}"
        return self._test(self._test(df, 0, other), 1, FLAG).withColumn(FLAG, F.col(FLAG) & F.col(other)).drop(other)


def _counted(df: DataFrame) -> tuple[DataFrame, int]:
    """`df` written, and how many rows it has."""
    seen = Observation()
    whole = written(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return whole, seen.get.get("n") or 0


def _ranges(df: DataFrame, parts: int) -> list[DataFrame]:
    """`df`, which has digests, dealt to `parts` tables by a hash of the digest."""
    dealt = written(df.withColumn(RANGE, F.pmod(F.xxhash64(D, F.lit(-1)), F.lit(parts)).cast("int")), by=RANGE)
    return [dealt.where(F.col(RANGE) == k).drop(RANGE) for k in range(parts)]


def _in_ranges(df: DataFrame, rows: int, max_filter_bits: int, work: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """`work` range by range, one job after the other, so that one filter's broadcast is held at a time."""
    parts = partitions_for(SPARE * rows, max_filter_bits)
    if parts == 1:
        return work(df, rows)
    return reduce(DataFrame.unionByName, [written(work(part, -(-rows // parts))) for part in _ranges(df, parts)])


def _beside(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with their group.  A second key, made from the first, has both sides shuffled for the join itself, so that adaptive execution may split a group that holds many rows."""
    rows, groups = rows.withColumn(f"near{MARK}", F.xxhash64(D)), groups.withColumn(f"there{MARK}", F.xxhash64(GROUP))
    return rows.join(groups, (F.col(D) == F.col(GROUP)) & (F.col(f"near{MARK}") == F.col(f"there{MARK}")))


def exact_groups(df: DataFrame, text: str = "text", doc_id: str = "doc_id", max_filter_bits: int = 1 << 27) -> DataFrame:
    """One row per row of `df`: its id, keep_id, group_size, kept, text_sha256, id first."""

    def grouped(slim: DataFrame, rows: int) -> DataFrame:
        tested = Filter(slim, rows, max_filter_bits).tested(slim)
        once = tested.where(~F.col(FLAG)).select(ID, F.col(ID).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), D)
        again = written(tested.where(FLAG).select(ID, D))
        groups = again.groupBy(F.col(D).alias(GROUP)).agg(F.min(ID).alias("keep_id"), F.count("*").alias("group_size"))
        return once.unionByName(_beside(again, groups).select(ID, "keep_id", "group_size", D))

    slim, rows = _counted(df.select(F.col(f"`{doc_id}`").alias(ID), digest(F.col(f"`{text}`")).alias(D)))
    kept = F.coalesce(F.col(ID) == F.col("keep_id"), F.col("keep_id").isNull())
    return _in_ranges(slim, rows, max_filter_bits, grouped).select(F.col(ID).alias(doc_id), "keep_id", "group_size", kept.alias("kept"), F.col(D).alias("text_sha256"))


def drop_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id", max_filter_bits: int = 1 << 27) -> DataFrame:
    """The rows of `df` without later copies of a text; columns as given.

    The row with the smallest id stays (nulls last), one of them where ids tie.  Unique rows never shuffle.
    """
    names = [F.col(f"`{c}`") for c in df.columns]
    least = f"least{MARK}"
    marked = df.withColumn(D, digest(F.col(f"`{text}`")))
    digests, n = _counted(marked.select(D))

    def first_ones(rows_: DataFrame, rows: int) -> DataFrame:
        tested = Filter(digests if rows == n else rows_.select(D), rows, max_filter_bits).tested(rows_)
        again = tested.where(FLAG).drop(FLAG)
        groups = again.groupBy(F.col(D).alias(GROUP)).agg(F.min(f"`{doc_id}`").alias(least))
        kept = _beside(again, groups).where(F.col(f"`{doc_id}`").eqNullSafe(F.col(least))).dropDuplicates([D])
        return tested.where(~F.col(FLAG)).select(*names).unionByName(kept.select(*names))

    return _in_ranges(marked, n, max_filter_bits, first_ones)
