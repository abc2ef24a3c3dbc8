"""Words of whole texts as numpy arrays, inside one Arrow batch of a task.

A batch is cut into chunks of a few megabytes (a longer text is a chunk of its own), so a
task's memory follows the chunk and the longest text, not the batch. Hashes are 64-bit
polynomials taken from prefix sums; they are the same in every task and run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh3_64_intdigest

U64 = np.uint64
CHUNK_BYTES = 2 << 20

SPACE = np.ones(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = False
AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd ``base`` and of its inverse, modulo 2^64."""
    up, down = _powers.get(base, (np.ones(0, U64), np.ones(0, U64)))
    if len(up) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, base, U64), np.full(size, pow(base, -1, 1 << 64), U64)
        up[0] = down[0] = 1
        up, down = np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)
        _powers[base] = up, down
    return up[:n], down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Words:
    """Words of the rows ``lo`` to ``hi`` of a column, numbered through all of them."""

    lo: int
    hi: int
    data: np.ndarray  # bytes of these rows
    offsets: np.ndarray  # of each row in data
    start: np.ndarray  # of each word in data
    end: np.ndarray
    first: np.ndarray  # number of each row's first word, and one more

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.hi - self.lo), self.count())

    def hashes(self, letters: np.ndarray = AS_IS) -> np.ndarray:
        """A hash of each word, after ``letters`` maps its bytes."""
        up, down = powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, U64)
        np.cumsum((letters[self.data].astype(U64) + U64(1)) * up[:-1], out=total[1:])
        value = (total[self.end] - total[self.start]) * down[self.start]
        return mix(value + (self.end - self.start).astype(U64))

    def digests(self, letters: np.ndarray = AS_IS) -> np.ndarray:
        """64 bits that stand for each word, after ``letters`` maps its bytes.

        Up to seven bytes are kept as they are, with their number, so short words never share a value.
        Longer words are hashed by XXH3; unlike ``hashes`` that follows no rule by which equal sums of
        different words can be written down.
        """
        data = letters[self.data]
        size = self.end - self.start
        out = np.minimum(size, 8).astype(U64) << U64(56)
        padded = np.concatenate([data, np.zeros(7, np.uint8)])
        for j in range(7):
            byte = np.where(size > j, padded[self.start + j], 0).astype(U64)
            out |= byte << U64(8 * j)
        long = np.flatnonzero(size > 7)
        text = data.tobytes()
        ends = zip(self.start[long].tolist(), self.end[long].tolist(), strict=True)
        out[long] = np.fromiter((xxh3_64_intdigest(text[a:b]) for a, b in ends), U64, len(long))
        return mix(out)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Words]:
    """The rows of a string column in order, a chunk at a time; a null has no words."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + chunk_bytes, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield _words(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def _words(lo: int, hi: int, data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = SPACE[data]
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = offsets[offsets < len(data)]
    before[cuts] = False
    after[offsets[offsets > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(lo, hi, data, offsets, start, end, np.searchsorted(start, offsets))


def grams(hashes: np.ndarray, n: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hash of each run of ``n`` hashes, whatever row they belong to."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    up, down = powers(len(hashes) + 1, base)
    total = np.zeros(len(hashes) + 1, U64)
    np.cumsum(hashes * up[:-1], out=total[1:])
    return mix((total[n:] - total[:-n]) * down[: len(hashes) - n + 1])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, in two passes over blocks of that width."""
    n = len(values)
    if n < width:
        return values[:0]
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    table = padded.reshape(blocks, width)
    left = np.minimum.accumulate(table, axis=1).reshape(-1)
    right = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def int64(values: np.ndarray) -> pa.Array:
    """Unsigned hashes as a column of Spark's long."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def text_column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    column = batch.column(name)
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def byte_slices(
    batches: Iterator[pa.RecordBatch], name: str, limit: int
) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in order, in slices of about ``limit`` bytes of a string column
    (a longer value is a slice of its own)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0)
        before = np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False))])
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(before, before[lo] + limit, side="right")) - 1
            hi = min(batch.num_rows, max(hi, lo + 1))
            yield batch.slice(lo, hi - lo)
            lo = hi
