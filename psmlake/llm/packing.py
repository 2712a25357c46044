"""Packing documents into sequences by shortest-pack-first histogram packing.

A document's ids are cut into pieces of the full sequence length and one shorter rest.  Full pieces are
sequences of their own.  The rests go through a histogram of their lengths: lengths are placed longest first, each into
the pattern that is shortest so far and still has room, and only pattern counts are kept.  At last each
rest finds its place by its rank among the rests of its length; ranks come from two levels of counts, so no
length, however common, is ranked in one task: each is dealt over as many buckets as it has `bucket_rows`.  The driver holds the histogram, at most one number a length.

Defined results: a null text counts as empty and is one piece of the closing id; null ids and repeated rows are rows
like any other; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .runtime import MARK, bounded_batches, partitions_for, trim, written

CLOSING_ID = 0
_encoders: dict[tuple[str, str], object] = {}


class Encoder:
    """Ids of a text as the tokenizers library gives them; texts without special strings go through the same vocabulary as ranks."""

    def __init__(self, path: str, ranks_path: str | None):
        self.path, self.fast = path, None
        with open(path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def exact(self) -> object:
        """Loaded where a text needs it; it takes far more memory than the ranks."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special):
            return np.asarray(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.asarray(self.fast.encode_to_numpy(text), np.uint32)


def encoder(path: str, ranks_path: str | None = None) -> Encoder:
    """One encoder for each Python worker."""
    key = (path, ranks_path or "")
    if key not in _encoders:
        _encoders[key] = Encoder(path, ranks_path)
    return _encoders[key]  # type: ignore[return-value]


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths longest first) and how often each is used."""
    room: dict[int, list[list]] = {size: []}  # room left -> [pattern, count]
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left > 0:
            most = max((r for r, packs in room.items() if packs and r >= length), default=None)
            if most is None:
                room.setdefault(size - length, []).append([(length,), left])
                left = 0
                continue
            pattern, n = room[most][-1]
            used = min(n, left)
            room[most][-1][1] -= used
            if room[most][-1][1] == 0:
                room[most].pop()
            rest = room.setdefault(most - length, [])
            grown = (*pattern, length)
            same = next((p for p in rest if p[0] == grown), None)
            if same is not None:
                same[1] += used
            else:
                rest.append([grown, used])
            left -= used
    return sorted((pattern, n) for packs in room.values() for pattern, n in packs)


class Places:
    """Where the rest of a length and rank goes, from the patterns."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]]):
        slots: dict[int, list[tuple[int, int, int]]] = {}
        filled: dict[int, int] = {}
        base = 0
        for pattern, n in patterns:
            at = 0
            for length in pattern:
                slots.setdefault(length, []).append((filled.get(length, 0), base, at))
                filled[length] = filled.get(length, 0) + n
                at += length
            base += n
        self.sequences = base
        self.slots = {k: np.asarray(v, np.int64) for k, v in slots.items()}

    def find(self, length: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        table = self.slots[length]
        k = np.searchsorted(table[:, 0], rank, "right") - 1
        return table[k, 1] + rank - table[k, 0], table[k, 2]


def _tokenized(docs: DataFrame, text: str, doc_id: str, path: str, ranks_path: str | None, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, ranks_path)
        closing = np.array([CLOSING_ID], np.uint32)
        for batch in batches:
            n, sums, ends = np.zeros(len(batch), np.int64), [], np.zeros(len(batch) + 1, np.int32)
            for i, t in enumerate(batch.column(1)):
                ids = np.concatenate([own.ids(t.as_py() or ""), closing]).astype("<u4")
                n[i] = len(ids)
                sums += [zlib.crc32(ids[a : a + size].tobytes()) for a in range(0, len(ids), size)]
                ends[i + 1] = len(sums)
            trim()
            crcs = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.asarray(sums, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), crcs], names=[f"id{MARK}", "n", "crcs"])
        _encoders.clear()  # the worker lives on and may have other work
        trim()

    slim = docs.select(F.col(f"`{doc_id}`").alias(f"id{MARK}"), F.col(f"`{text}`").alias(f"text{MARK}"))
    return slim.mapInArrow(run, f"id{MARK} {slim.schema[0].dataType.simpleString()}, n long, crcs array<long>")


def packed(docs: DataFrame, path: str, ranks_path: str | None = None, text: str = "text", doc_id: str = "doc_id", size: int = 1024, bucket_rows: int = 500) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    bounded_batches(docs.sparkSession)
    rows = _tokenized(docs, text, doc_id, path, ranks_path, size)
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("rest", (F.col("n") % size).cast("int")).withColumn("full", F.expr(f"n div {size}")))
    hist = rows.groupBy("rest").agg(F.count("*").alias("rows"), F.sum("full").alias("full")).orderBy("rest").collect()
    places = Places(pack_histogram({h["rest"]: h["rows"] for h in hist if h["rest"]}, size))
    base = dict(zip((h["rest"] for h in hist), np.concatenate([[0], np.cumsum([h["full"] for h in hist])])[:-1].tolist() if hist else [], strict=True))

    # a common length is ranked in many buckets; the row's number deals out rows that repeat id and text
    many = docs.sparkSession.createDataFrame([(h["rest"], partitions_for(h["rows"], bucket_rows)) for h in hist], "rest int, buckets int")
    rows = rows.join(F.broadcast(many), "rest").withColumn("bucket", F.pmod(F.xxhash64(f"id{MARK}", "crcs", "row"), F.col("buckets")).cast("int")).drop("buckets")
    groups = rows.groupBy("rest", "bucket").agg(F.count("*").alias("rows"), F.sum("full").alias("fulls"))
    before = Window.partitionBy("rest").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("rest", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"), F.coalesce(F.sum("fulls").over(before), F.lit(0)).alias("full_before"))
    order = Window.partitionBy("rest", "bucket").orderBy(f"id{MARK}", "n", "crcs", "row")
    rows = rows.withColumn("rank", F.row_number().over(order)).withColumn("full_at", F.sum("full").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("full"))
    rows = rows.join(groups, ["rest", "bucket"]).select(
        f"id{MARK}", "n", "crcs", "rest", "full", (F.col("rank") - 1 + F.col("rows_before")).cast("long").alias("rank"), (F.col("full_at") + F.col("full_before")).cast("long").alias("full_at")
    )
    kind = rows.schema[0].dataType.simpleString()
    names = [f"id{MARK}", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, rest, full, rank, full_at = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 3, 4, 5, 6))
            pieces = full + (rest > 0)
            row = np.repeat(np.arange(len(n)), pieces)
            k = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            whole = k < full[row]
            length = np.where(whole, size, rest[row])
            sequence = np.where(whole, places.sequences + full_at[row] + k, 0)
            offset = np.zeros(len(row), np.int64)
            if len(rest):
                sequence += np.where(whole, np.array([base.get(r, 0) for r in rest.tolist()], np.int64)[row], 0)
            order = np.flatnonzero(~whole)
            for r in np.unique(length[order]):
                own = order[length[order] == r]
                sequence[own], offset[own] = places.find(int(r), rank[row[own]])
            ids = batch.column(0).take(pa.array(row))
            crc = batch.column(2).flatten()
            yield pa.RecordBatch.from_arrays([ids, pa.array(k * size), pa.array(length), crc, pa.array(n[row]), pa.array(sequence), pa.array(offset)], names=names)

    out = rows.mapInArrow(place, f"id{MARK} {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed(f"id{MARK}", doc_id)
