"""Vectorised hashes of byte or code-point segments, and fixed-size bit filters.

A segment's hash is the polynomial sum of random 64-bit values of its symbols, read off
prefix sums, so all segments of a batch cost a few array operations. Powers are kept for
the longest batch seen; callers cut batches into slices of bounded size.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import table_writes

BASE = 0x9E3779B97F4A7C55  # odd, so powers have inverses modulo 2^64
SLICE_BYTES = 512 << 10
BITS_PER_ROW = 32_768

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_VALUES = np.random.default_rng(20_240_229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: a different one-to-one map for each salt."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & ((1 << 64) - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, n of each at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        made = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p))
        _powers[:] = made
    return _powers[0], _powers[1]


class Segments:
    """Hashes of segments of one symbol array."""

    def __init__(self, values: np.ndarray):
        powers, self.inverse = _up_to(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers[:len(values)], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def byte_values(data: np.ndarray) -> np.ndarray:
    return _VALUES[data]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text array and where each text starts (one more than texts); null counts as empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def shingle_hashes(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Per text the ascending distinct hashes of its ``size``-word shingles (A-Z lower-cased; a text of fewer words is one
    shingle; without words, none)."""
    data, offsets = buffers(texts)
    space = _SPACE[data]
    before = np.empty(len(data), bool)  # whether what stands before a byte ends a word
    before[1:] = space[:-1]
    after = np.empty(len(data), bool)
    after[:-1] = space[1:]
    inner = offsets[:-1][np.diff(offsets) > 0]
    before[inner] = True
    after[offsets[1:][np.diff(offsets) > 0] - 1] = True
    starts, ends = np.flatnonzero(before & ~space), np.flatnonzero(after & ~space)
    keep = ~space
    keep[1:] |= ~space[:-1]  # one blank after each word
    at = np.cumsum(keep) - keep
    stream = _LOWER[data[keep]]
    stream[space[keep]] = 0x20
    segments = Segments(byte_values(stream))
    starts, ends = at[starts], at[ends] + 1
    first = np.searchsorted(starts, np.concatenate([at, [len(stream)]])[offsets]) if len(data) else np.zeros(len(offsets), np.int64)
    out = []
    count = np.diff(first)
    from_word = np.arange(len(starts))
    last_word = np.minimum(from_word + size - 1, np.repeat(first[1:] - 1, count))
    hashes = segments.hashes(starts, ends[last_word]) if len(starts) else np.zeros(0, np.uint64)
    for a, n in zip(first[:-1].tolist(), count.tolist()):
        h = hashes[a:a + (n - size + 1 if n >= size else min(n, 1))]
        h = np.sort(h)
        out.append(h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) > 1 else h)
    return out


def tidy(run):
    """``run`` (batches to batches) with its task's freed memory given back to the system at the end, since workers stay."""
    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return wrapped


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES):
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def bit_filter(df: DataFrame, key: Column, log_bits: int) -> np.ndarray:
    """A filter of fixed size (2^log_bits bits) that holds every value of an integer key column.

    Built by Spark's bitmap aggregate; at most 2^log_bits / 32768 rows of 4 KB reach the driver, whatever the
    number of keys. A full filter lets more rows pass and loses none; an exact join follows each use.
    """
    place = F.shiftrightunsigned(key, 64 - log_bits) + 1  # buckets count from 1 and hold the places from 1 on
    with table_writes(df.sparkSession):
        rows = df.select(place.alias("_p")).groupBy(F.bitmap_bucket_number("_p").alias("b")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("_p")).alias("m")).collect()
    bits = np.zeros((1 << log_bits) // 8, np.uint8)
    for r in rows:
        start = (r["b"] - 1) * (BITS_PER_ROW // 8)
        part = bits[start:start + BITS_PER_ROW // 8]
        part |= np.frombuffer(r["m"], np.uint8)[:len(part)]
    return bits


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter holds each 64-bit key (the top bits are its place)."""
    log_bits = (len(bits) * 8).bit_length() - 1
    at = keys.view(np.uint64) >> np.uint64(64 - log_bits)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
