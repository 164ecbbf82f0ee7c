"""Words and shingles of whole Arrow string columns, without a Python loop over words.

A column is handled in slices of about half a megabyte. Bytes A-Z are lowered
where asked, words are the runs between the bytes 0x20 and 0x09-0x0D, and every
word gets a 64-bit hash from one running sum over the bytes of its slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

U = np.uint64
SLICE_BYTES = 1 << 19

WHITE = np.zeros(256, bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def byte_table(seed: int) -> np.ndarray:
    """256 random 64-bit values, the same in every process."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


VALUES = byte_table(1)
#: An odd base and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


class Powers:
    """The powers of the base and of its inverse, kept for the life of a process and never pickled."""

    def __init__(self):
        self.held = [np.ones(1, U), np.ones(1, U)]

    def __reduce__(self):
        return Powers, ()

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.held[0]) < n:
            size = 1 << max(20, int(n - 1).bit_length())
            for k, base in enumerate((BASE, INVERSE)):
                out = np.full(size, base, U)
                out[0] = 1
                self.held[k] = np.multiply.accumulate(out)
        return self.held[0][:n], self.held[1][:n]


powers = Powers()


class Slice(NamedTuple):
    first: int  # row of the column
    data: np.ndarray  # bytes
    offsets: np.ndarray  # of each row, one more at the end


def slices(column: pa.Array, target: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string or binary column at row bounds. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, body = column.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + target, side="right")) - 1)
        end = min(end, len(column))
        yield Slice(row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


def tidy(scan):
    """A task's function over batches that gives unused memory back when it ends: workers are kept for other tasks."""

    def run(batches):
        yield from scan(batches)
        pa.default_memory_pool().release_unused()

    return run


class Words(NamedTuple):
    row: np.ndarray  # of the slice
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


#: Letters and digits; every byte of a character beyond ASCII counts as a letter.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[0x80:] = True
LETTER = ALNUM.copy()
LETTER[48:58] = False


def runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the longest runs of bytes for which the table ``inside`` holds."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = inside[data]
    opens, closes = np.ones(n, bool), np.ones(n, bool)
    opens[1:] = ~solid[:-1]
    closes[:-1] = ~solid[1:]
    bounds = offsets[(offsets > 0) & (offsets < n)]
    opens[bounds] = True
    closes[bounds - 1] = True
    start = np.flatnonzero(solid & opens)
    end = np.flatnonzero(solid & closes) + 1
    return np.searchsorted(offsets, start, side="right") - 1, start, end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return runs(data, offsets, ~WHITE)


def running(data: np.ndarray, table: np.ndarray = VALUES) -> np.ndarray:
    """Sums from which ``span_hash`` reads the hash of any span of bytes."""
    p, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(table[data] * p[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, inverse = powers(len(sums))
    return mix64((sums[end] - sums[start]) * inverse[start])


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    row, start, end = word_spans(data, offsets)
    return Words(row, start, end, span_hash(running(LOWER[data] if lower else data), start, end))


def shingles(w: Words, rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle, sorted by both.

    A shingle is ``k`` words in a row; a row of fewer words gives one for all of them.
    """
    n = len(w.row)
    per_row = np.bincount(w.row, minlength=rows)
    first = np.concatenate(([0], np.cumsum(per_row)))[:-1]
    with np.errstate(over="ignore"):
        value = np.zeros(max(0, n - k + 1), U)
        for j in range(k):
            value = mix64(value * U(BASE) + w.hash[j : n - k + 1 + j] + U(j + 1)) if len(value) else value
        keep = w.row[: n - k + 1] == w.row[k - 1 :] if len(value) else np.zeros(0, bool)
        few = np.flatnonzero((per_row > 0) & (per_row < k))
        whole = np.zeros(len(few), U)
        for j in range(k - 1):
            more = per_row[few] > j
            at = np.minimum(first[few] + j, max(0, n - 1))
            whole = np.where(more, mix64(whole * U(BASE) + w.hash[at] + U(j + 1)), whole) if len(few) else whole
        whole = mix64(whole + per_row[few].astype(U) * U(0xD6E8FEB86659FD93))
    row = np.concatenate((w.row[: n - k + 1][keep] if len(value) else np.zeros(0, np.int64), few))
    value = np.concatenate((value[keep], whole))
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    if len(row):
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        row, value = row[new], value[new]
    return row, value


class Bloom:
    """A set of 64-bit keys in a fixed number of bits. It may say yes wrongly, never no wrongly."""

    def __init__(self, bits: int = 1 << 23, hashes: int = 4):
        self.size, self.hashes = bits, hashes
        self.field = np.zeros(bits // 8, np.uint8)

    def places(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        with np.errstate(over="ignore"):
            x = mix64(keys.astype(U) + U(0x5851F42D4C957F2D))
            step = mix64(x) | U(1)
            for _ in range(self.hashes):
                yield (x % U(self.size)).astype(np.int64)
                x = x + step

    def add(self, keys: np.ndarray) -> None:
        for at in self.places(keys):
            np.bitwise_or.at(self.field, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in self.places(keys):
            out &= (self.field[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return out


#: Bits of a filter for each of its keys, and the most bits of one (16 megabytes); beyond, more keys are taken wrongly for members.
BITS_A_KEY, LEAST_BITS, MOST_BITS = 12, 1 << 16, 1 << 27


def bloom_of(df, column: str) -> Bloom:
    """The filter of a long column of a saved table, sized by its rows.

    Every task fills a filter and sends the words of it that aren't 0; they are joined by bit before they reach the driver.
    """
    keys = df.select(column).where(f"{column} is not null")
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << int(BITS_A_KEY * keys.count()).bit_length()))

    def fill(batches):
        b = Bloom(bits)
        for batch in batches:
            b.add(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U))
        found = b.field.view(np.int64)
        at = np.flatnonzero(found)
        for part in range(0, len(at), 1 << 16):
            some = at[part : part + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], names=["at", "bits"])

    got = keys.mapInArrow(fill, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = Bloom(bits)
    out.field.view(np.int64)[got.column("at").to_numpy()] = got.column("bits").to_numpy()
    return out
