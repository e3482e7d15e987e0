"""Vectorised word and shingle hashing over Arrow string batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RNG = np.random.default_rng(20240601)
BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
# A-Z count as a-z; the bytes of \x20 and \x09-\x0D separate words.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.ones(256, bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False
LOWER_VALUE = BYTE_VALUE[LOWER]
STEP = int(_RNG.integers(1, 2**62)) * 2 + 1
BACK = pow(STEP, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64's)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_slices(column: pa.Array | pa.ChunkedArray, most_bytes: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) in runs of about `most_bytes`; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + most_bytes, "right"))
        end = min(max(end - 1, first + 1), n)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document index) of every word."""
    inside = IS_WORD[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the lower-cased words: differences of one running polynomial."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(data)
    up = np.full(n, STEP, np.uint64)
    down = np.full(n, BACK, np.uint64)
    up[0] = down[0] = 1
    np.multiply.accumulate(up, out=up)
    np.multiply.accumulate(down, out=down)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(LOWER_VALUE[data] * up, out=run[1:])
    return mix((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(document index, hash) of each document's distinct shingles, sorted by both.

    A document with fewer than `size` words has its whole sequence as its one
    shingle; one without words has none.
    """
    starts, ends, doc = words(data, offsets)
    h = word_hashes(data, starts, ends)
    weight = mix(np.arange(1, size + 1, dtype=np.uint64)) | U64(1)
    n = len(h)
    if n >= size:
        full = np.flatnonzero(doc[: n - size + 1] == doc[size - 1:])
        total = np.zeros(len(full), np.uint64)
        for j in range(size):
            total += h[full + j] * weight[j]
    else:
        full, total = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    count = np.bincount(doc, minlength=len(offsets) - 1)
    short = (count > 0) & (count < size)
    of_short = short[doc] if n else np.zeros(0, bool)
    at = np.arange(n) - (np.cumsum(count) - count)[doc] if n else np.zeros(0, np.int64)
    few = np.zeros(len(count), np.uint64)
    np.add.at(few, doc[of_short], h[of_short] * weight[at[of_short]])
    who = np.concatenate([doc[full], np.flatnonzero(short)])
    value = mix(np.concatenate([total, few[short] + count[short].astype(np.uint64)]))
    order = np.lexsort((value, who))
    who, value = who[order], value[order]
    new = np.ones(len(who), bool)
    new[1:] = (who[1:] != who[:-1]) | (value[1:] != value[:-1])
    return who[new], value[new]
