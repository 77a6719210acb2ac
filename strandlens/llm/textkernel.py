"""Vectorised text kernels shared by the corpus operators.

Everything here works on the raw UTF-8 buffer of an Arrow string column: a
slice of documents is one ``uint8`` array plus document offsets, and words,
word hashes and word n-grams are numpy arrays over that buffer.  A slice never
holds more than ``max_bytes`` of text unless a single document is longer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that separate words: space and the five ASCII controls 9..13.
SPACE_BYTES = (32, 9, 10, 11, 12, 13)
SLICE_BYTES = 1 << 21


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (wraps modulo 2**64)."""
    x = np.asarray(x, dtype=np.uint64).copy()
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACE_BYTES)] = True
#: Everything in ASCII but letters and digits.
SIGNS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


#: Ranges longer than this are hashed by a cryptographic hash, one by one.
LONG = 64
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_SIZE_STEP, _CHUNK_STEP = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x9DDFEA08EB382D69)


def eights(data: np.ndarray) -> np.ndarray:
    """At each position the number that its eight bytes make (zeros after the end), without a copy for each."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each range: eight bytes a round, chained by a bijective mixer; a keyed hash for long ranges.

    No algebra over the bytes, so no structured texts collide; equality that a result depends on is still decided by
    bytes (`same_bytes`) or by two hashes of different seeds.
    """
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    view, size = eights(data), ends - starts
    h = mix64(size.astype(np.uint64) * _SIZE_STEP + np.uint64(seed))
    more, at = np.arange(len(starts)), 0
    while len(more) and at < LONG:
        left = size[more] - at
        h[more] = mix64(h[more] * _CHUNK_STEP + (view[starts[more] + at] & _MASKS[np.minimum(left, 8)]))
        at += 8
        more = more[left > 8]
    if len(more):
        key = seed.to_bytes(8, "little")
        for i, a, b in zip(more.tolist(), starts[more].tolist(), ends[more].tolist(), strict=True):
            h[i] = int.from_bytes(hashlib.blake2b(data[a:b].tobytes(), digest_size=8, key=key).digest(), "little")
    return h


def same_bytes(one: np.ndarray, at: np.ndarray, two: np.ndarray, where: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether size bytes from at in the first buffer equal those from where in the second, for each range; buffers are given as `eights`."""
    out = np.ones(len(at), dtype=bool)
    more, done = np.flatnonzero(size > 0), 0
    while len(more) and done < LONG:
        left = size[more] - done
        equal = (one[at[more] + done] ^ two[where[more] + done]) & _MASKS[np.minimum(left, 8)] == 0
        out[more[~equal]] = False
        done += 8
        more = more[equal & (left > 8)]
    for i in more.tolist():
        out[i] = np.array_equal(one.base[at[i] : at[i] + size[i]], two.base[where[i] : where[i] + size[i]])
    return out


def numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each range, an example of each number); numbers are equal exactly where the bytes are.

    Ranges are grouped by their hashes and compared with the first of their group; should a group hold different bytes,
    ranges are named by their bytes.
    """
    order = np.argsort(key)
    new = np.append(True, key[order][1:] != key[order][:-1])[: len(key)]
    first, back = order[new], np.empty(len(key), dtype=np.int64)
    back[order] = np.cumsum(new) - 1
    rest = np.flatnonzero(first[back] != np.arange(len(key)))
    lead = first[back[rest]]
    size, view = ends - starts, eights(data)
    if (size[rest] == size[lead]).all() and same_bytes(view, starts[rest], view, starts[lead], size[rest]).all():
        return back, first
    known: dict[bytes, int] = {}
    raw = data.tobytes()
    back = np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    return back, np.unique(back, return_index=True)[1]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of bounded size."""
    data, offsets = text_buffer(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


class Words:
    """The words of a slice: byte ranges, and each document's range of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, separators: np.ndarray = _SPACE):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        n = len(data)
        solid = ~separators[data]
        if n:
            edge = np.zeros(n + 1, dtype=bool)
            edge[offsets] = True
            after = solid.copy()
            after[1:] &= ~solid[:-1] | edge[1:-1]
            before = solid
            before[:-1] &= ~(solid[1:]) | edge[1:-1]
            self.starts = np.flatnonzero(after)
            self.ends = np.flatnonzero(before) + 1
        else:
            self.starts = self.ends = np.zeros(0, dtype=np.int64)
        self.bounds = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return range_hashes(self.data, self.starts, self.ends, seed)

    def numbers(self) -> np.ndarray:
        """A number of each word, equal exactly where the words are."""
        return numbers(self.data, self.starts, self.ends, self.hashes())[0]


def ngram_hashes(words: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hashes of all runs of n consecutive entries (len - n + 1 of them), by doubling: any n costs about log2(n) passes."""
    out, have, todo = None, 0, n
    power, width = words + np.uint64(salt), 1
    while todo:
        if todo & 1:
            if out is None:
                out, have = power, width
            else:
                m = len(words) - have - width + 1
                if m <= 0:
                    return np.zeros(0, dtype=np.uint64)
                out = mix64(out[:m] * np.uint64(0x9FB21C651E98DF25) + power[have : have + m])
                have += width
        todo >>= 1
        if todo:
            m = len(words) - 2 * width + 1
            if m <= 0:
                return np.zeros(0, dtype=np.uint64)
            power = mix64(power[:m] * np.uint64(0xD1342543DE82EF95) + power[width : width + m])
            width *= 2
    return out


def run_starts(bounds: np.ndarray, n: int) -> np.ndarray:
    """Indices i such that i .. i+n-1 are words of one document."""
    counts = np.maximum(np.diff(bounds) - n + 1, 0)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    first = np.repeat(bounds[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return first + np.arange(total)
