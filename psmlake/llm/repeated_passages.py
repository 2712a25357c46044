"""Removing passages that stand earlier in the corpus, by a run-length index over the places where they can be.

A passage of `width` bytes has an anchor: of its `GRAM`-byte strings the one with the smallest hash.  Equal passages
have equal anchors at equal places, so only windows whose anchor occurs again can repeat.

1. One pass counts anchors (`hash_counts`).  The next takes the runs of windows that share an anchor which may repeat: a run is known by its
   anchor and a 128-bit hash of the bytes its windows cover (the context).  Of equal contexts each task keeps the first
   place; the others are repeats as a whole.  First places go to the bucket of their context's hash, which does the same for all
   tasks, so copies, however many, cost each task one row.
2. The contexts left are counted by anchor.  An anchor with one context has no further repeats.  Contexts of the others go, with their bytes, to the partition
   of their anchor and come in the anchors' order, some anchors at a time.  There they are ordered by place and met by halves: the earlier contexts form a run-length index, the later ones
   stream their matching statistics against it, and starts that match `width` bytes or more are repeats.  An anchor's byte carries a mark of its half
   in that index, so a match stays within its anchor and before its place; each index is built once, over `LANES` contexts at most.
3. An anchor with more than about `HOT` contexts would be long work for one task.  Its windows are dealt by narrower ranges of the places that the anchor takes in
   them; the windows of one range share more bytes than the anchor, and a hash of those takes the anchor's part in step 1
   again.  The ranges of `NARROW` places, then of one, where a window is all its context, split any anchor as far as its windows differ.
4. Repeats go back to their documents as spans, are merged, and cut from the text.

Inside the index bytes are compared; contexts are compared by their 128 bits.

Defined results: a null text counts as empty; texts shorter than `width` keep all; null ids come after all others, ids that are no integers in their own order; rows that
repeat an id come in the order of a hash of their text, and rows that repeat id and text count as one document and get one result; a very long text is read in
overlapping pieces; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from . import hash_counts
from .run_length_index import RunLengthIndex
from .runtime import MARK, bounded_batches, partitions_for, trim, written
from .text_kernels import BYTE_WORD, OTHER_WORD, U64, mix, powers, slices

GRAM = 40
PLACE_BITS = 24
PIECE = 1 << 18
LANES = 2048
HOT, NARROW, BLOCK = 128, 8, 16
#: Rows, or bytes of contexts, that a task gathers before it sends them, contexts that meet at once, and bytes of text for each partition.
FLUSH_ROWS, FLUSH_BYTES, MET_ROWS, PART_BYTES = 1 << 16, 4 << 20, 1 << 14, 32 << 20
BUCKET_ANCHORS = 100_000
PLACE = U64((1 << PLACE_BITS) - 1)


class Hashes:
    """Hashes of any byte span of `data`."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = powers(len(data) + 1)
        self.data = data
        self.sums = [self._sums(BYTE_WORD)]

    def _sums(self, words: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(1, U64), np.cumsum(words[self.data] * self.up[: len(self.data)], dtype=U64)])

    def of(self, begin: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        while len(self.sums) <= which:
            self.sums.append(self._sums(OTHER_WORD))
        own = self.sums[which]
        return mix((own[end] - own[begin]) * self.down[begin])


class Anchors(Hashes):
    """Anchored runs of windows in a slice: first and last window start, anchor place and hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int):
        n = len(data) - width + 1
        self.data = data
        self.low = self.high = self.at = np.zeros(0, np.int64)
        self.code = np.zeros(0, U64)
        if n <= 0:
            return
        super().__init__(data)
        grams = mix((self.sums[0][GRAM:] - self.sums[0][:-GRAM]) * self.down[: len(data) - GRAM + 1])
        ranked = (grams & ~PLACE) | np.arange(len(grams), dtype=U64)
        span, reach = width - GRAM + 1, 1
        while 2 * reach <= span:
            ranked = np.minimum(ranked[:-reach], ranked[reach:])
            reach *= 2
        if span > reach:
            ranked = np.minimum(ranked[: n], ranked[span - reach : span - reach + n])
        left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
        starts = np.flatnonzero(left[:n] >= width)
        if not len(starts):
            return
        place = (ranked[starts] & PLACE).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)]))
        self.low, self.at = starts[cut], place[cut]
        self.high = starts[np.append(cut[1:], len(starts)) - 1]
        self.code = mix(grams[self.at])  # the smallest of many hashes lie close together; mixed, they spread over slots and buckets


def anchored(texts: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, Anchors]]:
    """(first row, place of the slice in that row, offsets, anchors); a text over PIECE bytes comes in overlapping pieces."""
    for row, data, offsets in slices(texts):
        if len(offsets) == 2 and len(data) > PIECE:
            for at in range(0, len(data) - width + 1, PIECE):
                piece = data[at : at + PIECE + width - 1]
                yield row, at, np.array([0, len(piece)]), Anchors(piece, np.array([0, len(piece)]), width)
        else:
            yield row, 0, offsets, Anchors(data, offsets, width)


#: A run: its key (the anchor's hash), its context's hashes, its document, the place of the anchor in it, and the range of places that the anchor takes in the windows.
ROW = np.dtype([("code", "<u8"), ("context", "<u8"), ("check", "<u8"), ("doc", "<i8"), ("text", "<i8"), ("at", "<i4"), ("near", "<u2"), ("far", "<u2"), ("none", "u1")])
SPAN = np.dtype([("doc", "<i8"), ("text", "<i8"), ("begin", "<i4"), ("end", "<i4"), ("none", "u1")])
DOC = ("none", "doc", "text")
RUNS = "bucket long, rows binary"


def packed(rows: np.ndarray) -> bytes:
    """Field after field, which compresses better than row after row."""
    return b"".join(rows[f].tobytes() for f in rows.dtype.names)


def unpacked(blobs: pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    parts = []
    for blob in blobs:
        data = blob.as_buffer()
        out = np.zeros(data.size // kind.itemsize, kind)
        at = 0
        for f in kind.names:
            out[f] = np.frombuffer(data, kind[f], len(out), at)
            at += len(out) * kind[f].itemsize
        parts.append(out)
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def dealt(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, numbers of its rows)."""
    order = np.argsort(part, kind="stable")
    cut = 1 + np.flatnonzero(part[order][1:] != part[order][:-1])
    for own in np.split(order, cut) if len(part) else ():
        yield int(part[own[0]]), own


def same(rows: np.ndarray, fields: tuple[str, ...]) -> np.ndarray:
    """Whether each row has the fields of the one before."""
    out = np.zeros(len(rows), bool)
    out[1:] = True
    for f in fields:
        out[1:] &= rows[f][1:] == rows[f][:-1]
    return out


def spans_of(rows: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros(len(rows), SPAN)
    for f in DOC:
        out[f] = rows[f]
    out["begin"] = rows["at"] - rows["far"].astype(np.int64)
    out["end"] = rows["at"] - rows["near"].astype(np.int64) + width
    return out


def first_places(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows that are the first of their context, and of those that have an earlier place."""
    kind = ("context", "check", "code", "near", "far")
    order = np.argsort(rows["context"], kind="stable")
    code = rows["context"][order]
    twice = np.zeros(len(rows), bool)
    equal = code[1:] == code[:-1]
    twice[1:] |= equal
    twice[:-1] |= equal
    alone, many = order[~twice], order[twice]
    own = rows[many]
    place = np.lexsort(tuple(own[f] for f in ("at", "text", "doc", "none", "far", "near", "code", "check", "context")))
    many, own = many[place], own[place]
    follows = same(own, kind)
    twin = follows & same(own, ("at", *DOC))  # rows that repeat a document's id and text stand at its place
    head = ~follows
    lead = np.flatnonzero(~twin)
    later = ~head[lead[np.cumsum(~twin) - 1]] if len(own) else head
    return np.concatenate([alone, many[head]]), many[later]


def merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping or touching spans of a document as one."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["end"], spans["begin"], spans["text"], spans["doc"], spans["none"]))]
    new_doc = ~same(spans, DOC)
    base = (np.cumsum(new_doc) - 1) << 32
    reach = np.maximum.accumulate(base + spans["end"])
    new = np.concatenate([[True], base[1:] + spans["begin"][1:] > reach[:-1]]) | new_doc
    cut = np.flatnonzero(new)
    out = spans[cut]
    out["end"] = reach[np.append(cut[1:], len(spans)) - 1] - base[cut]
    return out


class Runs:
    """Runs with their bytes, gathered in a task."""

    def __init__(self, rows: np.ndarray, begin: np.ndarray, own: Hashes):
        self.rows, self.begin, self.own = rows, begin, own

    def bytes_of(self, pick: np.ndarray, width: int) -> np.ndarray:
        size = sizes(self.rows[pick], width)
        at = np.cumsum(size) - size
        return self.own.data[np.repeat(self.begin[pick] - at, size) + np.arange(size.sum())]


def sizes(rows: np.ndarray, width: int) -> np.ndarray:
    """Bytes of the rows' contexts."""
    return rows["far"].astype(np.int64) - rows["near"] + width


def chosen(rows: np.ndarray, data: np.ndarray, pick: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Some of the rows, and their contexts out of all rows' contexts laid end to end."""
    size = sizes(rows, width)
    at = np.cumsum(size) - size
    own = size[pick]
    lay = np.cumsum(own) - own
    return rows[pick], data[np.repeat(at[pick] - lay, own) + np.arange(own.sum())]


def sealed(rows: np.ndarray, data: np.ndarray, width: int) -> pa.Array:
    """One binary value for each row: the row, then its context."""
    size = sizes(rows, width)
    ends = np.cumsum(size + ROW.itemsize)
    at = ends - size
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[(at - ROW.itemsize)[:, None] + np.arange(ROW.itemsize)] = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), ROW.itemsize)
    out[np.repeat(at - (np.cumsum(size) - size), size) + np.arange(size.sum())] = data
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(out)])


def opened(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The rows and their contexts laid end to end, from sealed()."""
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    held = np.frombuffer(values.buffers()[2], np.uint8) if len(values) else np.zeros(0, np.uint8)
    rows = held[offsets[:-1, None] + np.arange(ROW.itemsize)].view(ROW).reshape(-1) if len(values) else np.zeros(0, ROW)
    size = np.diff(offsets) - ROW.itemsize
    return rows, held[np.repeat(offsets[:-1] + ROW.itemsize - (np.cumsum(size) - size), size) + np.arange(size.sum())]


Source = Callable[[Iterator[pa.RecordBatch]], Iterator[Runs]]


def from_texts(seen: Broadcast, width: int) -> Source:
    """The runs of texts whose anchor may repeat; columns: whether the id is null, the id as an integer, a hash of the text, the text."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Runs]:
        for batch in batches:
            none, ids, hashes = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            for first, shift, offsets, own in anchored(batch.column(3), width):
                pick = np.flatnonzero(hash_counts.repeated(seen.value, own.code)) if len(own.code) else []
                if not len(pick):
                    continue
                low, high = own.low[pick], own.high[pick]
                rows = np.zeros(len(pick), ROW)
                rows["code"], rows["near"], rows["far"] = own.code[pick], own.at[pick] - high, own.at[pick] - low
                rows["context"], rows["check"] = own.of(low, high + width), own.of(low, high + width, 1)
                doc = first + np.searchsorted(offsets, low, "right") - 1
                rows["none"], rows["doc"], rows["text"], rows["at"] = none[doc], ids[doc], hashes[doc], own.at[pick] - offsets[doc - first] + shift
                yield Runs(rows, low, own)

    return runs


def pieces(values: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and their contexts, about PIECE bytes at a time."""
    many = max(1, PIECE // 256)
    for a in range(0, len(values), many):
        yield opened(values.slice(a, many))


def from_runs(places: int, width: int) -> Source:
    """Runs cut to ranges of `places` places of the anchor in the windows; the bytes that a range's windows share are the key."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Runs]:
        for batch in batches:
            for held, data in pieces(batch.column(0)):
                size = sizes(held, width)
                anchor = np.cumsum(size) - size + held["far"]
                first, last = held["near"] // places, held["far"] // places
                many = (last - first + 1).astype(np.int64)
                rows, anchor = np.repeat(held, many), np.repeat(anchor, many)
                block = np.repeat(first, many).astype(np.int64) + np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)
                low, high = block * places, np.minimum((block + 1) * places - 1, width - GRAM)
                rows["near"], rows["far"] = np.maximum(rows["near"], low), np.minimum(rows["far"], high)
                own = Hashes(data)
                begin = anchor - rows["far"]
                end = anchor - rows["near"].astype(np.int64) + width
                rows["code"] = mix(own.of(anchor - low, anchor + width - high) + U64(1) + block.astype(U64))
                rows["context"], rows["check"] = own.of(begin, end), own.of(begin, end, 1)
                yield Runs(rows, begin, own)

    return runs


def _firsts(table: DataFrame, source: Source, width: int, bits: int, shards: int) -> DataFrame:
    """(bucket, rows): each task's first places by the bucket of their context, and its repeats, as spans, by -1 - shard."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            rows = np.concatenate(held) if held else np.zeros(0, ROW)
            held.clear()
            first, later = first_places(rows)
            firsts = rows[first]
            out = [(b, packed(firsts[own])) for b, own in dealt(top(firsts["context"], bits))]
            spans = merged(spans_of(rows[later], width))
            out += [(-1 - s, packed(spans[own])) for s, own in dealt(shard_of(spans, shards))]
            trim()
            return _blobs(out)

        many = 0
        for run in source(batches):
            held.append(run.rows)
            many += len(run.rows)
            if many >= FLUSH_ROWS:
                yield flush()
                many = 0
        yield flush()

    return table.mapInArrow(send, RUNS)


def _blobs(out: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], names=["bucket", "rows"])


def top(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def shard_of(spans: np.ndarray, shards: int) -> np.ndarray:
    return (mix(spans["doc"].astype(np.int64).view(U64) ^ spans["text"].astype(np.int64).view(U64)) % U64(shards)).astype(np.int64)


def _contexts(table: DataFrame, source: Source, width: int, counts: Broadcast) -> DataFrame:
    """(run, code, hot): contexts whose key has several, sealed, each once for some megabytes of them."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            rows, data = together(held)
            held.clear()
            rows, data = chosen(rows, data, np.sort(first_places(rows)[0]), width)
            hot = hash_counts.level(counts.value, rows["code"]) >= HOT_LEVEL
            return pa.RecordBatch.from_arrays([sealed(rows, data, width), pa.array(rows["code"].view(np.int64)), pa.array(hot)], names=["run", "code", "hot"])

        many = 0
        for run in source(batches):
            pick = np.flatnonzero(hash_counts.level(counts.value, run.rows["code"]) >= 8)
            if len(pick):
                held.append((run.rows[pick], run.bytes_of(pick, width)))
                many += len(held[-1][1])
                if many >= FLUSH_BYTES:
                    yield flush()
                    many = 0
        if held:
            yield flush()
        trim()

    return table.mapInArrow(send, "run binary, code long, hot boolean")


def together(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return (np.concatenate([r for r, _ in held]), np.concatenate([d for _, d in held])) if held else (np.zeros(0, ROW), np.zeros(0, np.uint8))


def met(width: int, shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """partial_repeats() over sealed runs that come in the order of their keys: some complete keys at a time, equal contexts collapsed as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        many, limit = 0, MET_ROWS

        def done(rows: np.ndarray, data: np.ndarray) -> pa.RecordBatch:
            spans = merged(partial_repeats(rows, data, width))
            trim()
            out = [(s, packed(spans[own])) for s, own in dealt(shard_of(spans, shards))]
            return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], names=["shard", "spans"])

        for batch in batches:
            for a in range(0, len(batch), MET_ROWS):
                held.append(opened(batch.column(0).slice(a, MET_ROWS)))
                many += len(held[-1][0])
                if many < limit:
                    continue
                rows, data = together(held)
                last = int(np.flatnonzero(rows["code"] != rows["code"][-1])[-1]) + 1 if (rows["code"] != rows["code"][-1]).any() else 0
                if last:
                    yield done(*chosen(rows, data, np.arange(last), width))
                rest = chosen(rows, data, np.arange(last, len(rows)), width)
                held = [chosen(*rest, np.sort(first_places(rest[0])[0]), width)]
                many = len(held[0][0])
                limit = max(MET_ROWS, 2 * many)
        if held:
            yield done(*together(held))

    return run


HOT_LEVEL = 8 * (HOT.bit_length() - 1)


def shared_ranges(rows: np.ndarray, byte_at: np.ndarray, data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The range of places outside which no window of the run can stand in another context of its key, (0, -1) where there is none.

    The windows of a block of `BLOCK` places share more bytes than the anchor; where no other context of the key has these, none of them repeats.
    """
    near, far = np.full(len(rows), width, np.int64), np.full(len(rows), -1, np.int64)
    at = byte_at + rows["far"]
    end = np.append(byte_at[1:], len(data))
    for low in range(0, width - GRAM + 1, BLOCK):
        high = min(low + BLOCK - 1, width - GRAM)
        own = np.flatnonzero((rows["near"] <= high) & (rows["far"] >= low))
        if not len(own):
            continue
        core = np.zeros(len(own), U64)
        edges = np.append(np.searchsorted(byte_at[own], np.arange(0, len(data), PIECE)), len(own))
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a:
                base = byte_at[own[a]]
                part = Hashes(data[base : end[own[b - 1]]])
                core[a:b] = part.of(at[own[a:b]] - low - base, at[own[a:b]] + width - high - base)
        core = mix(core + rows["code"][own])
        order = np.lexsort((rows["context"][own], core))
        code, context = core[order], rows["context"][own][order]
        # some other context of the same core beside it: the core's first and last contexts differ
        cut = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        last = np.append(cut[1:], len(code)) - 1
        several = np.repeat(context[cut] != context[last], last - cut + 1)
        some = own[order[several]]
        near[some] = np.minimum(near[some], np.maximum(rows["near"][some], low))
        far[some] = np.maximum(far[some], np.minimum(rows["far"][some], high))
    return near, far


def partial_repeats(rows: np.ndarray, data: np.ndarray, width: int) -> np.ndarray:
    """Spans of windows that stand in an earlier context of their key.  `data` holds the rows' contexts, one after another."""
    size = sizes(rows, width)
    byte_at = np.cumsum(size) - size
    near, far = shared_ranges(rows, byte_at, data, width)
    first = first_places(rows)[0]
    first = first[far[first] >= 0]
    byte_at = byte_at[first] + rows["far"][first] - far[first]
    rows = rows[first]
    rows["near"], rows["far"] = near[first], far[first]
    order = np.lexsort((rows["at"], rows["text"], rows["doc"], rows["none"], rows["code"]))
    rows, byte_at = rows[order], byte_at[order]
    key = np.cumsum(~same(rows, ("code",))) - 1
    keep = np.flatnonzero(np.bincount(key)[key] > 1) if len(rows) else []
    if not len(keep):
        return np.zeros(0, SPAN)
    rows, byte_at, key = rows[keep], byte_at[keep], np.unique(key[keep], return_inverse=True)[1]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    rank = np.arange(len(key)) - begin[key]
    gone = np.zeros((len(rows), 1 + int((rows["far"] - rows["near"]).max())), bool)

    def symbols(pick: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = sizes(rows[pick], width)
        lay = np.cumsum(size) - size
        out = data[np.repeat(byte_at[pick] - lay, size) + np.arange(size.sum())].astype(np.int32)
        out[lay + rows["far"][pick]] = 256 + mark
        return out, size

    for bit in range(int(rank.max()).bit_length()):
        half = np.unique(key * (1 << 32) + (rank >> (bit + 1)), return_inverse=True)[1]
        is_late = (rank >> bit) & 1 == 1
        asked = np.zeros(half.max() + 1, bool)
        asked[half[is_late]] = True
        early, late = np.flatnonzero(~is_late & asked[half]), np.flatnonzero(is_late)
        marks, at = half[early], 0
        while at < len(early):  # whole halves, together LANES contexts at most
            stop = min(at + LANES, len(early))
            if stop < len(early):
                edge = int(np.searchsorted(marks, marks[stop], "left"))
                stop = edge if edge > at else int(np.searchsorted(marks, marks[at], "right"))
            own = early[at:stop]
            base = half[own[0]]
            index = RunLengthIndex(*symbols(own, half[own] - base))
            a, b = np.searchsorted(half[late], [base, half[own[-1]] + 1])
            for k in range(a, b, LANES):
                asking = late[k : min(b, k + LANES)]
                found = index.matching_statistics(*symbols(asking, half[asking] - base)) >= width
                found = found[:, : gone.shape[1]]
                gone[asking, : found.shape[1]] |= found
            at = stop
            del index
    i, j = np.nonzero(gone)
    if not len(i):
        return np.zeros(0, SPAN)
    cut = np.flatnonzero(np.concatenate([[True], (i[1:] != i[:-1]) | (j[1:] != j[:-1] + 1)]))
    own = rows[i[cut]]
    out = spans_of(own, width)
    out["end"] = out["begin"] + j[np.append(cut[1:], len(i)) - 1] + width
    out["begin"] += j[cut].astype(np.int32)
    return out


def repeated_spans(docs: DataFrame, width: int, max_slots: int) -> DataFrame:
    """(none, doc, text, spans): the merged spans of each document that has any; `docs` holds these three and the text."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(docs.columns[3]))).first()[0] or 0
    about = 2 * size // (width - GRAM + 2)
    seen = spark.sparkContext.broadcast(hash_counts.hash_table(docs.select(docs.columns[3]), lambda batch: (own.code for _, _, _, own in anchored(batch.column(0), width)), about, max_slots, levels=False))
    shards = partitions_for(about, 1_000_000)

    def spans_only(spans: np.ndarray) -> list[tuple[int, bytes]]:
        return [(s, packed(spans[own])) for s, own in dealt(shard_of(spans, shards))]

    def shown(out: list[tuple[int, bytes]]) -> pa.Table:
        trim()
        return pa.table({"shard": pa.array([o[0] for o in out], pa.int64()), "spans": pa.array([o[1] for o in out], pa.binary())})

    def whole(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        if bucket < 0:
            return shown([(-1 - bucket, packed(merged(unpacked(group.column("rows"), SPAN))))])
        rows = unpacked(group.column("rows"), ROW)
        first, later = first_places(rows)
        return shown([*spans_only(merged(spans_of(rows[later], width))), (-1, rows["code"][first].tobytes())])

    def unite(group: pa.Table) -> pa.Table:
        spans = merged(unpacked(group.column("spans"), SPAN))
        cut = np.flatnonzero(~same(spans, DOC))
        edge = np.append(cut, len(spans))
        pairs = np.stack([spans["begin"], spans["end"]], 1).astype("<i4")
        trim()
        cols = {f: pa.array(spans[f][cut].astype(np.int64)) for f in DOC}
        return pa.table({**cols, "spans": pa.array([pairs[a:b].tobytes() for a, b in zip(edge, edge[1:], strict=False)], pa.binary())})

    found, table, source = [], docs, from_texts(seen, width)
    bits = hash_counts.bits_for(about // BUCKET_ANCHORS + 1, 0, 30)
    parts = partitions_for(size, PART_BYTES, 8)
    for narrower in (NARROW, 1, 0):
        firsts = _firsts(table, source, width, bits, shards).repartition(parts, "bucket").groupBy("bucket").applyInArrow(whole, "shard long, spans binary")
        firsts = written(firsts)
        found.append(firsts.where("shard >= 0"))
        if narrower == 0:  # ranges of one place: a window is all its context
            break
        keys = firsts.where("shard < 0").select("spans")
        many = (keys.agg(F.sum(F.octet_length("spans"))).first()[0] or 0) // 8
        table_of = hash_counts.hash_table(keys, lambda batch: (np.frombuffer(x.as_buffer(), "<u8") for x in batch.column(0)), many, max_slots >> 3, levels=True, cap=2 * HOT)
        if table_of.max(initial=0) < 8:
            break
        counts = spark.sparkContext.broadcast(table_of)
        sent = _contexts(table, source, width, counts)
        hot = bool(table_of.max() >= HOT_LEVEL)
        if hot:
            sent = written(sent)
        ordered = sent.where("not hot").select("run", "code").repartition(parts, "code").sortWithinPartitions("code")
        found.append(ordered.select("run").mapInArrow(met(width, shards), "shard long, spans binary"))
        if not hot:
            break
        table, source = sent.where("hot").select("run"), from_runs(narrower, width)
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionByName(more)
    return spans.repartition(max(8, shards), "shard").groupBy("shard").applyInArrow(unite, "none long, doc long, text long, spans binary")


def _numbered(docs: DataFrame, doc_id: str) -> DataFrame:
    """`docs` with the id as an integer in the ids' order."""
    column = F.col(f"`{doc_id}`")
    if isinstance(docs.schema[doc_id].dataType, ByteType | ShortType | IntegerType | LongType):
        return docs.withColumn(f"n{MARK}", column.cast("long"))
    ids = docs.select(column.alias(f"i{MARK}")).where(f"i{MARK} is not null").distinct().orderBy(f"i{MARK}")
    ids = written(ids.withColumn(f"n{MARK}", F.monotonically_increasing_id()))
    return docs.join(ids, column == F.col(f"i{MARK}"), "left").drop(f"i{MARK}")


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 100, max_slots: int = 1 << 26, keep_text: bool = False) -> DataFrame:
    """One row per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans ([begin, end) pairs, 32-bit), and kept (bytes) on request."""
    bounded_batches(docs.sparkSession)
    slim = _numbered(docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias(f"text{MARK}")), "id")
    body = F.col(f"text{MARK}")
    slim = slim.select("id", F.col("id").isNull().cast("int").alias("none"), F.coalesce(f"n{MARK}", F.lit(0)).cast("long").alias("doc"), F.xxhash64(F.coalesce(body, F.lit(""))).alias("h"), body)
    spans = written(repeated_spans(slim.drop("id"), width, max_slots))
    spans = spans.select(*[F.col(f).alias(f"{f}{MARK}s") for f in DOC], "spans")
    both = slim.join(spans, (F.col("none") == F.col(f"none{MARK}s")) & (F.col("doc") == F.col(f"doc{MARK}s")) & (F.col("h") == F.col(f"text{MARK}s")), "left").select("id", f"text{MARK}", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, count, sums, kept = [], [], [], [], []
            for t, s in zip(batch.column(1).cast(pa.binary()), batch.column(2), strict=True):
                data = t.as_py() or b""
                own = np.frombuffer(s.as_py() or b"", "<i4").reshape(-1, 2).tolist()
                size.append(len(data))
                count.append(len(own))
                removed.append(sum(b - a for a, b in own))
                at, rest = 0, []
                for a, b in own:
                    rest.append(data[at:a])
                    at = b
                data = b"".join([*rest, data[at:]])
                sums.append(hashlib.sha256(data).hexdigest())
                kept.append(data if keep_text else None)
            cols = [batch.column(0), *[pa.array(c, pa.int64()) for c in (size, removed, count)], pa.array(sums, pa.string()), batch.column(2), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    kind = both.schema[0].dataType.simpleString()
    out = both.mapInArrow(cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans binary, kept binary").withColumnRenamed("id", doc_id)
    return out if keep_text else out.drop("kept")
