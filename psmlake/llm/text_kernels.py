"""NumPy kernels over the contiguous UTF-8 buffer of an Arrow string column.

A batch is handled in slices of bounded size, so the working arrays stay small
however long the batch; a single longer text is one slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
#: One random odd word for each byte value, twice, and the base of the rolling sums.
BYTE_WORD = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
OTHER_WORD = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
SHINGLE_STEP = U64(0xD6E8FEB86659FD93)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

EDGE = np.zeros(256, bool)
EDGE[[ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True

_powers = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((BASE, BASE_INVERSE)):
            steps = np.full(size, U64(base))
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def slices(texts: pa.Array, most: int = (1 << 18) - 2) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows with at most `most` bytes, or one longer row."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, whole[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


class Words:
    """The words of a slice: byte spans, a 64-bit hash each, and each row's range of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True):
        data = LOWER[data] if lower else data
        solid = ~SPACE[data]
        begins, ends = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1]
        ends[:-1] &= ~solid[1:]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        begins[inner] = solid[inner]
        ends[inner - 1] = solid[inner - 1]
        self.data, self.starts, self.ends = data, np.flatnonzero(begins), np.flatnonzero(ends) + 1
        up, down = powers(len(data) + 1)
        self._sums = np.concatenate([np.zeros(1, U64), np.cumsum(BYTE_WORD[data] * up[: len(data)], dtype=U64)])
        self._down = down
        self.first = np.searchsorted(self.starts, offsets)

    def trim(self) -> None:
        """Cut edges of ASCII punctuation off; a word of nothing else gets an empty span."""
        inner = np.flatnonzero(~EDGE[self.data])
        bounds = np.append(inner, len(self.data))
        starts = np.minimum(bounds[np.searchsorted(inner, self.starts)], self.ends)
        before = np.searchsorted(inner, self.ends) - 1
        ends = inner[np.maximum(before, 0)] + 1 if len(inner) else self.starts
        self.starts, self.ends = starts, np.maximum(starts, np.where(before >= 0, ends, 0))

    def hashes(self, most: int | None = None) -> np.ndarray:
        """A hash for each word, or for its first `most` bytes."""
        ends = self.ends if most is None else np.minimum(self.ends, self.starts + most)
        return mix((self._sums[ends] - self._sums[self.starts]) * self._down[self.starts])


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of the runs of `width` words); shorter texts give one, empty ones none."""
    for row, data, offsets in slices(texts):
        words = Words(data, offsets)
        code = words.hashes()
        runs = np.zeros(max(0, len(code) - width + 1), U64)
        for k in range(width):
            runs = runs * SHINGLE_STEP + code[k : k + len(runs)]
        runs = mix(runs)
        for i in range(len(offsets) - 1):
            a, b = int(words.first[i]), int(words.first[i + 1])
            if b - a >= width:
                own = np.sort(runs[a : b - width + 1])
                keep = np.ones(len(own), bool)
                np.not_equal(own[1:], own[:-1], out=keep[1:])
                yield row + i, own[keep]
            elif b > a:
                own = U64(b - a)
                with np.errstate(over="ignore"):
                    for x in code[a:b]:
                        own = own * SHINGLE_STEP + x
                yield row + i, mix(np.array([own ^ U64(0x5851F42D4C957F2D)]))
            else:
                yield row + i, np.zeros(0, U64)
