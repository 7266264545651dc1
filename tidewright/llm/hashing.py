"""Hashes of words and of runs of words, for whole Arrow columns of text at once.

Every hash has two lanes of 64 bits. A word is hashed eight bytes at a time by
a chain of mixing steps, a run of words by a tree of them; no step is linear in
what went in before, and the lanes use mixers of their own. Equality of both
lanes stands for equality of the words, at 128 bits; one lane alone only ever
proposes candidates."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at once; a longer document is hashed alone.
SLICE = 1 << 18
#: Words of more bytes are hashed by BLAKE2b, one by one.
LONG_WORD = 64
#: Multipliers and shifts of the mixers (fixed values: SplitMix64, MurmurHash3), and of the steps between them.
_MIX = ((30, 0xBF58476D1CE4E5B9, 27, 0x94D049BB133111EB, 31), (33, 0xFF51AFD7ED558CCD, 33, 0xC4CEB9FE1A85EC53, 33))
_STEP = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_WORD = np.ones(256, bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: The first n bytes of a little-endian integer.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(h: np.ndarray, salt: int = 0, lane: int = 0) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    a, m, b, n, c = _MIX[lane]
    h = h + np.uint64((salt + 1) * _STEP[lane] & 0xFFFFFFFFFFFFFFFF)
    h ^= h >> np.uint64(a)
    h *= np.uint64(m)
    h ^= h >> np.uint64(b)
    h *= np.uint64(n)
    h ^= h >> np.uint64(c)
    return h


def text_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, without a copy of its bytes; nulls have none."""
    a = column
    if a.null_count:
        a = a.fill_null("")
    kind = np.int64 if pa.types.is_large_string(a.type) else np.int32
    offsets = np.frombuffer(a.buffers()[1], kind)[a.offset : a.offset + len(a) + 1].astype(np.int64)
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` (SLICE) bytes together."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + (most or SLICE), "right")) - 1)
        yield first, last
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(both lanes, row, start, length) of every word of the rows that offsets
    delimit in data; starts are positions in data. Words are runs of bytes
    other than space and 0x09 to 0x0D; lower: A to Z count as a to z."""
    at = int(offsets[0])
    b = data[at : int(offsets[-1])]
    bounds = offsets[1:] - at
    if lower:
        b = _LOWER[b]
    word = _WORD[b]
    edge = bounds[:-1][bounds[:-1] < len(b)]  # rows begin here, without a space between
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    first[edge] = word[edge]
    edge = edge[edge > 0]
    last[edge - 1] = word[edge - 1]
    starts = np.flatnonzero(first)
    length = np.flatnonzero(last) + 1 - starts
    if not len(starts):
        z = np.zeros(0, np.int64)
        return (z.view(np.uint64), z.view(np.uint64)), z, z, z
    padded = np.concatenate([b, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(b) + 1, "<u8", padded.data, 0, (1,))  # the eight bytes from each position on
    n = length.astype(np.uint64)
    c = eight[starts] & _FIRST[np.minimum(length, 8)]
    h = [mix(mix(c, lane=k) + n, lane=k) for k in (0, 1)]
    more, i = np.flatnonzero((length > 8) & (length <= LONG_WORD)), 8
    while len(more):
        c = eight[starts[more] + i] & _FIRST[np.minimum(length[more] - i, 8)]
        for k in (0, 1):
            h[k][more] = mix(h[k][more] * np.uint64(_STEP[k]) + mix(c, i, k), lane=k)
        i += 8
        more = more[length[more] > i]
    for j in np.flatnonzero(length > LONG_WORD):
        digest = hashlib.blake2b(b[starts[j] : starts[j] + length[j]].tobytes(), digest_size=16).digest()
        h[0][j], h[1][j] = np.frombuffer(digest, np.uint64)
    return (h[0], h[1]), np.searchsorted(bounds, starts, "right"), starts + at, length


def windows(h: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """One lane of the hashes of all runs of k words; runs that cross rows are included."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    step = np.uint64(_STEP[lane])
    # doubling: a run of 2m words is two runs of m words
    out, have, block, size, left = None, 0, h, 1, k
    while left:
        if left & 1:
            part = block[have : have + n]
            out = mix(part, k, lane) if out is None else mix(out * step + part, k, lane)
            have += size
        left >>= 1
        if left:
            block = mix(block[: len(block) - size] * step + block[size:], size, lane)
            size *= 2
    return out
