"""Distances and edit scripts of many pairs of texts at once, over the arrays of an Arrow batch.

Texts become a matrix of code points.  Distances keep one row of the edit table
as bits in 64-bit words, a bit for each place of the left text, and go through
the right texts place by place, for all pairs of a lot together.  Edit scripts
fill the whole table row by row and walk back through it, again all pairs
together.  No function is called for a pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

#: Cells (pairs times places) worked on at a time; one longer pair is a lot of its own.
CELLS = 1 << 21
ONE = np.uint64(1)
TOP = np.uint64(63)


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(a row of code points for each text, filled with zeros; the number of each)."""
    sizes = np.asarray(pa.compute.utf8_length(texts)).astype(np.int64)
    wide = max(int(sizes.max(initial=0)), 1)
    return np.array(texts.to_pylist(), dtype=f"<U{wide}").view("<u4").reshape(len(sizes), wide), sizes


def lots(a: pa.Array, b: pa.Array, cells: Callable[[int], int]) -> Iterator[np.ndarray]:
    """The numbers of pairs, in lots of about one size of text and at most CELLS cells."""
    size = np.maximum(np.asarray(pa.compute.utf8_length(a)), np.asarray(pa.compute.utf8_length(b))).astype(np.int64)
    order = np.argsort(size, kind="stable")[::-1]
    at = 0
    while at < len(order):
        many = max(1, CELLS // cells(int(size[order[at]]) + 1))
        yield order[at : at + many]
        at += many


class _Bits:
    """For every character, in which places of each left text it is: n pairs, some words of 64 places."""

    def __init__(self, left: np.ndarray, sizes: np.ndarray, right: np.ndarray) -> None:
        n, wide = left.shape
        self.words = -(-wide // 64)
        known, codes = np.unique(np.concatenate((left.ravel(), right.ravel())), return_inverse=True)
        self.left, self.right = codes[: left.size].reshape(left.shape), codes[left.size :].reshape(right.shape)
        self.pairs = np.arange(n)
        self.table = np.zeros((len(known), n, self.words), dtype=np.uint64)
        for i in range(wide):
            some = self.pairs[i < sizes]
            self.table[self.left[some, i], some, i // 64] |= ONE << np.uint64(i % 64)

    def places(self, j: int) -> np.ndarray:
        """Where the left texts have the character at place j of the right ones."""
        return self.table[self.right[:, j], self.pairs]


def common_subsequences(left: np.ndarray, m: np.ndarray, right: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each pair: places of the left text whose bit has been cleared."""
    bits = _Bits(left, m, right)
    state = np.full((len(m), bits.words), ~np.uint64(0))
    for j in range(int(n.max(initial=0))):
        matches = bits.places(j) * (j < n)[:, None].astype(np.uint64)
        carry = np.zeros(len(m), dtype=np.uint64)
        for w in range(bits.words):
            s = state[:, w]
            u = s & matches[:, w]
            total = s + u + carry
            carry = ((total < s) | ((carry == ONE) & (total == s))).astype(np.uint64)
            state[:, w] = total | (s - u)
    cleared = np.unpackbits((~state).view(np.uint8).reshape(len(m), -1), axis=1, bitorder="little")
    return (cleared.astype(bool) & (np.arange(cleared.shape[1]) < m[:, None])).sum(axis=1)


def edit_distances(left: np.ndarray, m: np.ndarray, right: np.ndarray, n: np.ndarray, swaps: bool = False) -> np.ndarray:
    """Edits between the texts of each pair; with swaps, two neighbours that changed places are one edit, each part edited once."""
    bits = _Bits(left, m, right)
    shape = (len(m), bits.words)
    # whether the table rises or falls from one place of the left text to the next
    up, down = np.full(shape, ~np.uint64(0)), np.zeros(shape, dtype=np.uint64)
    before, flat = np.zeros(shape, dtype=np.uint64), np.zeros(shape, dtype=np.uint64)
    score = m.copy()
    last, bit = np.maximum(m - 1, 0) // 64, (np.maximum(m - 1, 0) % 64).astype(np.uint64)
    for j in range(int(n.max(initial=0))):
        matches = bits.places(j)
        plus, minus = np.ones(len(m), dtype=np.uint64), np.zeros(len(m), dtype=np.uint64)
        swap_below = np.zeros(len(m), dtype=np.uint64)
        rises, falls, diagonal = np.empty(shape, np.uint64), np.empty(shape, np.uint64), np.empty(shape, np.uint64)
        for w in range(bits.words):
            match, u, d = matches[:, w], up[:, w], down[:, w]
            x = match | minus
            same = (((x & u) + u) ^ u) | x | d
            if swaps:
                open_ = ~flat[:, w] & match
                same |= ((open_ << ONE) | swap_below) & before[:, w]
                swap_below = open_ >> TOP
            rise, fall = d | ~(same | u), same & u
            rises[:, w], falls[:, w], diagonal[:, w] = rise, fall, same
            rise_in, fall_in = (rise << ONE) | plus, (fall << ONE) | minus
            plus, minus = rise >> TOP, fall >> TOP
            up[:, w], down[:, w] = fall_in | ~(same | rise_in), rise_in & same
        before, flat = matches, diagonal
        step = ((rises[bits.pairs, last] >> bit) & ONE).astype(np.int64) - ((falls[bits.pairs, last] >> bit) & ONE).astype(np.int64)
        score += np.where(j < n, step, 0)
    return np.where(m == 0, n, score)


def _hamming(left: np.ndarray, m: np.ndarray, right: np.ndarray, n: np.ndarray) -> np.ndarray:
    wide = min(left.shape[1], right.shape[1])
    return ((left[:, :wide] != right[:, :wide]) & (np.arange(wide) < np.minimum(m, n)[:, None])).sum(axis=1)


#: By name, for arrays of (left, sizes, right, sizes).
METRICS: dict[str, Callable[..., np.ndarray]] = {
    "levenshtein": edit_distances,
    "osa": lambda a, m, b, n: edit_distances(a, m, b, n, swaps=True),
    "indel": lambda a, m, b, n: m + n - 2 * common_subsequences(a, m, b, n),
    "lcsseq": lambda a, m, b, n: np.maximum(m, n) - common_subsequences(a, m, b, n),
    "hamming": _hamming,
}


def _pairs(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """(which pairs have both texts, those texts)."""
    both = np.asarray(pa.compute.is_valid(a)) & np.asarray(pa.compute.is_valid(b))
    keep = pa.array(both)
    return both, a.filter(keep), b.filter(keep)


def metric(a: pa.Array, b: pa.Array, name: str) -> pa.Array:
    """The distances of pairs of texts, null where one is missing."""
    both, x, y = _pairs(a, b)
    found = np.zeros(len(x), dtype=np.int32)
    for lot in lots(x, y, lambda size: size):
        found[lot] = METRICS[name](*code_points(x.take(pa.array(lot))), *code_points(y.take(pa.array(lot))))
    out = np.zeros(len(both), dtype=np.int32)
    out[both] = found
    return pa.array(out, mask=~both)


#: What a step of an edit script does: kept, replaced, lost from the left text, added by the right one.
STEPS = np.array(["=", "X", "D", "I"])


def _scripts(left: np.ndarray, m: np.ndarray, right: np.ndarray, n: np.ndarray) -> pa.Array:
    pairs, (rows, columns) = np.arange(len(m)), (left.shape[1], right.shape[1])
    table = np.empty((len(m), rows + 1, columns + 1), dtype=np.int32)
    across = np.arange(columns + 1, dtype=np.int32)
    table[:, 0], table[:, :, 0] = across, np.arange(rows + 1, dtype=np.int32)
    for i in range(1, rows + 1):
        above = table[:, i - 1]
        line = table[:, i]
        line[:, 1:] = np.minimum(above[:, :-1] + (right != left[:, i - 1 : i]), above[:, 1:] + 1)
        # adding from the left: the least of what stands before, plus the way from there
        line[:] = np.minimum.accumulate(line - across, axis=1) + across
    steps = np.full((len(m), rows + columns), -1, dtype=np.int8)
    i, j = m.copy(), n.copy()
    for k in range(rows + columns):
        here = table[pairs, i, j]
        up, back = np.maximum(i - 1, 0), np.maximum(j - 1, 0)
        other = left[pairs, up] != right[pairs, back]
        straight = (i > 0) & (j > 0) & (here == table[pairs, up, back] + other)
        lost = ~straight & (i > 0) & (here == table[pairs, up, j] + 1)
        going = (i > 0) | (j > 0)
        if not going.any():
            break
        steps[:, k] = np.where(~going, -1, np.where(straight, other, np.where(lost, 2, 3)))
        i, j = i - (straight | lost), j - (going & ~lost)
    # from the end of the texts to their beginning; runs of equal steps
    path = steps[:, ::-1]
    new = (path >= 0) & np.concatenate((np.ones((len(m), 1), dtype=bool), path[:, 1:] != path[:, :-1]), axis=1)
    row, at = np.nonzero(new)
    whole = np.append(at[1:], path.shape[1])
    whole[np.append(row[1:] != row[:-1], True)] = path.shape[1]
    runs = pa.compute.binary_join_element_wise(pa.array(whole - at).cast(pa.string()), pa.array(STEPS[path[row, at]]), "")
    ends = np.concatenate((np.zeros(1, np.int32), np.cumsum(new.sum(axis=1)))).astype(np.int32)
    return pa.compute.binary_join(pa.ListArray.from_arrays(pa.array(ends), runs), "")


def edit_scripts(a: pa.Array, b: pa.Array) -> pa.Array:
    """Shortest edit scripts in run-length form: = kept, X replaced, I added, D lost; replacing is preferred, then losing."""
    both, x, y = _pairs(a, b)
    found = np.empty(len(x), dtype=object)
    for lot in lots(x, y, lambda size: size * size):
        found[lot] = _scripts(*code_points(x.take(pa.array(lot))), *code_points(y.take(pa.array(lot)))).to_pylist()
    out = np.full(len(both), None, dtype=object)
    out[both] = found
    return pa.array(out.tolist(), pa.string())
