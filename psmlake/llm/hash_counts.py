"""Counts of 64-bit hashes over all rows, as bounded tables that tasks can look up.

Mappers send each bucket of the hash space one block of sorted 32-bit values, repeated values at most `cap` times, so
a hash that a third of all rows hold costs each batch `cap` values.  A bucket's task sorts its blocks and
fills its slice of the table: a bit for each hash met twice, or a byte with the logarithm of its count.  The slices, at most
`max_slots` slots together, are what the driver gathers and broadcasts.  Where hashes share a slot, the table errs
towards repeated, never the other way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .runtime import trim

CAP = 255
BUCKET_VALUES = 2_000_000
FLUSH = 500_000


def bits_for(n: int, least: int, most: int) -> int:
    return max(least, min(most, max(1, int(n) - 1).bit_length()))


class Blocks:
    """Gathers hashes and gives (bucket, block) rows."""

    def __init__(self, bucket_bits: int, cap: int):
        self.bits, self.cap, self.held, self.n = bucket_bits, cap, [], 0

    def add(self, hashes: np.ndarray) -> bool:
        self.held.append(hashes)
        self.n += len(hashes)
        return self.n >= FLUSH

    def flush(self) -> pa.RecordBatch:
        all_ = np.sort(np.concatenate(self.held)) if self.held else np.zeros(0, np.uint64)
        self.held, self.n = [], 0
        if len(all_) > self.cap:  # a value is kept where it differs from the one `cap` places before
            keep = np.ones(len(all_), bool)
            keep[self.cap :] = all_[self.cap :] != all_[: -self.cap]
            all_ = all_[keep]
        bucket = (all_ >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(all_), np.int64)
        value = ((all_ >> np.uint64(32 - self.bits)) & np.uint64(0xFFFFFFFF)).astype("<u4")
        edges = np.searchsorted(bucket, np.arange((1 << self.bits) + 1))
        some = np.flatnonzero(np.diff(edges))
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([value[edges[k] : edges[k + 1]].tobytes() for k in some], pa.binary())], names=["bucket", "block"])


def hash_table(rows: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], about: int, max_slots: int, levels: bool, spare: int = 4, least: int = 2, cap: int = CAP) -> np.ndarray:
    """A table over the hashes that `hashes` gives for each batch of `rows`; `about` is how many to expect.

    With `levels` it has a byte a slot, 8 * log2(count); else packed bits, set where the count is `least`, 1 or 2, or more.
    """
    bucket_bits = bits_for(about // BUCKET_VALUES + 1, 0, 16)
    slot_bits = bits_for(spare * about, 16, max_slots.bit_length() - 1)
    slice_bits = max(3, slot_bits - bucket_bits)
    cap = cap if levels else 2

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(bucket_bits, cap)
        for batch in batches:
            for h in hashes(batch):
                if blocks.add(h):
                    yield blocks.flush()
        yield blocks.flush()
        trim()

    def fill(group: pa.Table) -> pa.Table:
        values = np.sort(np.concatenate([np.frombuffer(b.as_buffer(), "<u4") for b in group.column("block")]))
        edge = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        n = np.diff(np.append(edge, len(values)))
        slot = values[edge] >> np.uint32(32 - slice_bits)
        if levels:
            counts = np.bincount(slot, n, 1 << slice_bits)
            out = np.minimum(255, 8 * np.log2(np.maximum(counts, 1))).astype(np.uint8)
        else:
            flags = np.zeros(1 << slice_bits, np.uint8)
            flags[slot[n >= least]] = 1
            out = np.packbits(flags, bitorder="little")
        return pa.table({"bucket": group.column("bucket")[:1], "slice": pa.array([out.tobytes()], pa.binary())})

    sent = rows.mapInArrow(send, "bucket int, block binary")
    slices = sent.groupBy("bucket").applyInArrow(fill, "bucket int, slice binary").toArrow()
    size = (1 << slice_bits) if levels else (1 << slice_bits) // 8
    table = np.zeros(size << bucket_bits, np.uint8)
    for b, s in zip(slices.column("bucket").to_pylist(), slices.column("slice"), strict=True):
        table[b * size : (b + 1) * size] = np.frombuffer(s.as_buffer(), np.uint8)
    return table


def repeated(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may have been met twice."""
    slot = hashes >> np.uint64(64 - (8 * len(table)).bit_length() + 1)
    return (table[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def level(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return table[hashes >> np.uint64(64 - len(table).bit_length() + 1)]
