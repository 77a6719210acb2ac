"""Repeated passages, removed exactly, by sorted suffixes over words in groups.

The method dealt is prefix-partitioned suffix trees.  What is here differs in how
suffixes are grouped: by a run of words inside a suffix's window (step 3), which
need not be its beginning, and LCPs stop at ``words`` words.

Every word position with ``words`` words from it on is a suffix (a window is
its first ``words`` words).  Two suffixes meet in a node of the suffix tree at
depth ``words`` or more when they begin with the same words; all but the
earliest of such a node's leaves repeat a passage.

1. Texts are packed into slices of a few megabytes.
2. The anchor of a window is the one of its runs of ``ANCHOR`` words with the
   least hash, the leftmost of equal ones.  Equal windows have equal anchors at
   equal places, so a suffix can only share a deep node if its anchor occurs
   again.  Slices send their distinct anchors, each with the number of their
   distinct windows, and get back which ones other slices have too and which
   ones are too frequent.
3. The suffixes left are grouped by the words of their anchor, and where more than ``GROUP_WINDOWS`` windows have that anchor,
   all ``words`` words of the window.  Neighbouring suffixes of one anchor
   travel as one segment of text, of which every suffix is a part; a slice sends
   only the earliest of its equal windows.
4. Groups are dealt to parts of about ``PART_WINDOWS`` windows.  A part numbers
   the words by their bytes, sorts its suffixes by their words, takes the longest
   common prefixes (LCP) of neighbours, and so finds the nodes at depth ``words``;
   their leaves that another document, or an earlier start, precedes are reported.
   Suffixes of a frequent anchor first meet in parts that take about the square
   root of all slices each; those that no other precedes there meet again.
5. Neighbouring reported windows of a document make up a maximal repeat
   (`maximal_repeats`); its words are removed.

Hashes only deal and filter (a collision sends a suffix needlessly): every
equality a result rests on is one of words, in slices as in parts.

Nulls and edge cases: a null text has no words.  Ids are whole numbers; a null
id comes before all others.  Rows with one id are at the same place: equal
starts of such rows don't precede each other.  Words are compared unchanged.
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, id_and_text, shuffle_partitions, whole_ids
from .textkernel import Words, mix64, ngram_hashes, numbers, run_starts, slices

ANCHOR = 8
SLICE = 2 << 20
#: Windows of one anchor beyond which it is split by whole windows.
GROUP_WINDOWS = 1 << 16
#: Windows of a part, if every window of the corpus were sent.
PART_WINDOWS = 600_000
#: Starts of rows without an id are lower by this, which puts them before the rows of any id.
UNKNOWN = 1 << 40


def _pack(a: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a, dtype=kind).tobytes())


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=kind)


def suffix_order(words: np.ndarray, starts: np.ndarray, depth: int, ties: tuple[np.ndarray, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(the suffixes at starts in the order of their first depth words, then of ties; LCP of each with the one before).

    words are numbers; each suffix has depth words at least.  LCPs are counted up to depth; the first is 0.
    """
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = max(1, int(words.max()).bit_length())
    per = 63 // bits  # so many words make one sorting key
    keys = []
    for lo in range(0, depth, per):
        key = np.zeros(len(starts), dtype=np.int64)
        for k in range(lo, min(lo + per, depth)):
            key = (key << bits) | words[starts + k]
        keys.append(key)
    order = np.lexsort((*ties[::-1], *keys[::-1]))
    lcp = np.zeros(len(order), dtype=np.int64)
    a, b, same = starts[order[1:]], starts[order[:-1]], np.arange(1, len(order))
    for k in range(depth):
        same = same[words[a[same - 1] + k] == words[b[same - 1] + k]]
        if not len(same):
            break
        lcp[same] += 1
    return order, lcp


def later_leaves(words: np.ndarray, starts: np.ndarray, depth: int, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The suffixes that another leaf of their node at this depth precedes."""
    order, lcp = suffix_order(words, starts, depth, (ids, place))
    node = np.cumsum(lcp < depth) - 1
    lead = order[np.flatnonzero(lcp < depth)][node]
    late = (ids[order] > ids[lead]) | (ids[order] == ids[lead]) & (place[order] > place[lead])
    return order[late]


class Slice:
    """The words of a packed slice and its windows."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, data: np.ndarray, offsets: np.ndarray, words: int):
        self.ids, self.known, self.width = ids, known, words
        self.words = Words(data, offsets)
        self.starts = run_starts(self.words.bounds, words)
        self.doc = np.searchsorted(self.words.bounds, self.starts, side="right") - 1
        # the start within its document
        self.place = self.starts - self.words.bounds[self.doc] - np.where(known[self.doc], 0, UNKNOWN)

    @cached_property
    def hashes(self) -> np.ndarray:
        return self.words.hashes()

    @cached_property
    def labels(self) -> np.ndarray:
        """A hash of each window."""
        return ngram_hashes(self.hashes, self.width)[self.starts] if len(self.starts) else np.zeros(0, np.uint64)

    @cached_property
    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """(windows in an order that puts equal ones together, whether each begins a group); equal by their words."""
        order = np.argsort(self.labels)
        label = self.labels[order]
        new = np.append(True, label[1:] != label[:-1])[: len(order)]
        again = np.flatnonzero(~new)
        if len(again):
            a, b = self.starts[order[again]], self.starts[order[again - 1]]
            # only the words of windows with an equal label need a number
            cover = np.zeros(len(self.words) + 1, dtype=np.int32)
            for at in (a, b):
                np.add.at(cover, at, 1)
                np.add.at(cover, at + self.width, -1)
            used = np.flatnonzero(np.cumsum(cover)[:-1])
            number = np.zeros(len(self.words), dtype=np.int64)
            number[used] = numbers(self.words.data, self.words.starts[used], self.words.ends[used], self.hashes[used])[0]
            if not all((number[a + k] == number[b + k]).all() for k in range(self.width)):
                order, lcp = suffix_order(self.words.numbers(), self.starts, self.width)
                new = lcp < self.width
        return order, new

    @cached_property
    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(48 bits of the anchor of each window, the word it begins with)."""
        size = max(1, min(ANCHOR, self.width // 2))
        if not len(self.starts):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        runs = mix64(ngram_hashes(self.hashes, size))
        spread = np.lib.stride_tricks.sliding_window_view(runs, self.width - size + 1)
        at = np.empty(len(self.starts), dtype=np.int64)
        for lo in range(0, len(at), 1 << 15):
            at[lo : lo + (1 << 15)] = spread[self.starts[lo : lo + (1 << 15)]].argmin(axis=1)
        at += self.starts
        # mixed again, since the least of several hashes tend to be small ones
        return mix64(runs[at]) >> np.uint64(16), at

    def firsts(self) -> tuple[np.ndarray, np.ndarray]:
        """For each window, (the earliest window equal to it, whether that one precedes it)."""
        order, new = self.groups
        lead = np.arange(len(order))
        if new.all():
            return lead, np.zeros(len(order), dtype=bool)
        group = np.cumsum(new) - 1
        several = np.bincount(group) > 1
        some = np.flatnonzero(several[group])
        at, group = order[some], group[some]
        inner = np.lexsort((self.place[at], self.ids[self.doc[at]], group))
        at = at[inner]
        opens = np.append(True, group[1:] != group[:-1])
        lead[at] = at[np.flatnonzero(opens)][np.cumsum(opens) - 1]
        return lead, self.precedes(lead, np.arange(len(order)))

    def precedes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        one, two = self.ids[self.doc[a]], self.ids[self.doc[b]]
        return (one < two) | (one == two) & (self.place[a] < self.place[b])


def pack_slices(docs: DataFrame, words: int) -> DataFrame:
    """(slice, ids, known, ends, windows, text): texts in slices, with the number of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = batch.column("doc_id")
            known, keys = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
                windows = int(np.maximum(Words(data, offsets).counts() - words + 1, 0).sum())
                text = zstandard.ZstdCompressor(level=3).compress(data.tobytes())
                values = [[(part << 32) | seq], [_pack(keys[lo:hi], "<i8")], [np.packbits(known[lo:hi]).tobytes()], [_pack(np.diff(offsets), "<i8")], [windows], [text]]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["slice", "ids", "known", "ends", "windows", "text"])
                seq += 1

    return docs.mapInArrow(run, "slice long, ids binary, known binary, ends binary, windows long, text binary")


PACKED = ("slice", "ids", "known", "ends", "text")


def _slices_of(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, Slice]]:
    for i in range(batch.num_rows):
        ids, known, ends, text = (batch.column(c)[i].as_py() for c in PACKED[1:])
        offsets = np.concatenate(([0], np.cumsum(_unpack(ends, "<i8"))))
        data = np.frombuffer(zstandard.ZstdDecompressor().decompress(text), dtype=np.uint8)
        keys = _unpack(ids, "<i8")
        yield i, Slice(keys, np.unpackbits(np.frombuffer(known, np.uint8), count=len(keys)).astype(bool), data, offsets, words)


def _runs(key: np.ndarray) -> Iterator[tuple[int, int, int]]:
    if len(key):
        cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1])).tolist() + [len(key)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(key[a]), a, b


def _whole_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """One table for each part of rows sorted by part."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        for part, a, b in _runs(batch.column("part").to_numpy()):
            if part != now and held:
                yield pa.Table.from_batches(held)
                held = []
            now = part
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _part_of(high: np.ndarray, parts: int) -> np.ndarray:
    """The part, in their order, of 48-bit numbers."""
    return ((high >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def repeated_anchors(packed: DataFrame, words: int, parts: int) -> DataFrame:
    """(slice, bits): by part, which of the slice's sorted distinct anchors other slices have too, then which are frequent."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, own in _slices_of(batch, words):
                order, new = own.groups
                found, n = np.unique(own.anchors[0][order[new]], return_counts=True)
                rows = list(_runs(_part_of(found, parts)))
                # 48 bits each
                raw = [np.ascontiguousarray(found[a:b], "<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for _, a, b in rows]
                sizes = [_pack(n[a:b], "<u4") for _, a, b in rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _, _ in rows], pa.int64()), pa.array([batch.column("slice")[i].as_py()] * len(rows), pa.int64()), pa.array(raw, pa.binary()), pa.array(sizes, pa.binary())],
                    ["part", "slice", "anchors", "sizes"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_parts(batches):
            blobs = []
            for raw in table.column("anchors"):
                x = np.zeros((len(raw.as_py()) // 6, 8), dtype=np.uint8)
                x[:, :6] = np.frombuffer(raw.as_py(), dtype=np.uint8).reshape(-1, 6)
                blobs.append(x.view("<u8")[:, 0])
            sizes = np.concatenate([_unpack(r.as_py(), "<u4") for r in table.column("sizes")])
            _, back, n = np.unique(np.concatenate(blobs), return_inverse=True, return_counts=True)
            again = n[back] > 1
            frequent = np.bincount(back, sizes)[back] > GROUP_WINDOWS
            ends = np.cumsum([len(b) for b in blobs])
            bits = [np.packbits(np.concatenate((again[e - len(b) : e], frequent[e - len(b) : e]))).tobytes() for b, e in zip(blobs, ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([table.column("slice").combine_chunks(), table.column("part").combine_chunks(), pa.array(bits, pa.binary())], ["slice", "part", "bits"])

    sent = packed.select(*PACKED).mapInArrow(send, "part long, slice long, anchors binary, sizes binary")
    got = sent.repartition(shuffle_partitions(packed.sparkSession), "part").sortWithinPartitions("part", "slice").mapInArrow(compare, "slice long, part long, bits binary")
    return got.groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("part", "bits"))).alias("bits")).select("slice", F.col("bits.bits").alias("bits"))


def _candidates(own: Slice, bits: list[bytes] | None, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window, whether its anchor occurs in another slice, and whether it is frequent."""
    found, back = np.unique(own.anchors[0], return_inverse=True)
    again, frequent = np.zeros((2, len(found)), dtype=bool)
    for raw, (_, a, b) in zip(bits or [], _runs(_part_of(found, parts)), strict=True):
        flags = np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=2 * (b - a)).astype(bool)
        again[a:b], frequent[a:b] = flags[: b - a], flags[b - a :]
    return again[back], frequent[back]


SENT = "part long, slice long, facts binary, text binary"


def _segments(own: Slice, bits: list[bytes] | None, parts: int, slice_: int, salts: int) -> pa.RecordBatch:
    """The suffixes a slice sends, by part: segments of text with the id, the first start, the first window, the number of windows, and whether it is frequent."""
    again, frequent = _candidates(own, bits, parts)
    lead, _ = own.firsts()
    at = np.flatnonzero(again & (lead == np.arange(len(lead))))
    anchor, begins = own.anchors
    whole = frequent[at]
    # neighbours of one anchor are one segment; windows of a frequent anchor stand alone
    joins = (at[1:] == at[:-1] + 1) & (own.doc[at[1:]] == own.doc[at[:-1]]) & (begins[at[1:]] == begins[at[:-1]]) & ~whole[1:]
    opens = np.flatnonzero(np.append(True, ~joins)[: len(at)])
    n = np.diff(np.append(opens, len(at)))
    at, whole = at[opens], whole[opens]
    salt = mix64(mix64(np.array([slice_])) % np.uint64(salts))
    salted = mix64(own.labels[at] + salt) >> np.uint64(16)
    part = _part_of(np.where(whole, salted, anchor[at]), parts)
    order = np.argsort(part, kind="stable")
    part, at, whole, n = part[order], at[order], whole[order], n[order]
    facts = np.stack((own.ids[own.doc[at]], own.place[at], at, n, whole))
    text, ends = _spaced(own.words, own.starts[at], n + own.width - 1)
    ends = np.concatenate(([0], ends))
    runs = list(_runs(part))
    blobs = [zstandard.ZstdCompressor(level=1).compress(text[ends[a] : ends[b]].tobytes()) for _, a, b in runs]
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _, _ in runs], pa.int64()), pa.array([slice_] * len(runs), pa.int64()), pa.array([_pack(facts[:, a:b], "<i8") for _, a, b in runs], pa.binary()), pa.array(blobs, pa.binary())],
        ["part", "slice", "facts", "text"],
    )


def _spaced(words: Words, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n words from first on of each segment, each followed by a space, and the ends of the segments in these bytes."""
    total = np.cumsum(n)
    w = np.repeat(first - (total - n), n) + np.arange(int(total[-1]) if len(total) else 0)
    size = words.ends[w] - words.starts[w] + 1
    ends = np.cumsum(size)
    index = np.repeat(words.starts[w] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
    out = words.data[np.minimum(index, len(words.data) - 1)] if len(index) else np.zeros(0, np.uint8)
    out[ends - 1] = 32
    return out, ends[total - 1]


def subtrees(sent: DataFrame, words: int, parts: int, last: bool) -> DataFrame:
    """For the suffixes of each part: (slice, flags), the windows that an equal one precedes.

    Suffixes of frequent anchors that none precedes are sent again, unless this is the last round.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_parts(batches):
            facts = [_unpack(r.as_py(), "<i8").reshape(5, -1) for r in table.column("facts")]
            slices_ = np.repeat(table.column("slice").to_numpy(), [f.shape[1] for f in facts])
            ids, place, at, n, whole = np.concatenate(facts, axis=1)
            text = np.frombuffer(b"".join(zstandard.ZstdDecompressor().decompress(r.as_py()) for r in table.column("text")), dtype=np.uint8)
            found = Words(text, np.array([0, len(text)]))
            # the suffixes of the segments
            total = np.cumsum(n)
            of, step = np.repeat(np.arange(len(n)), n), np.arange(int(total[-1])) - np.repeat(total - n, n)
            begin = np.cumsum(n + words - 1) - (n + words - 1)
            late = later_leaves(found.numbers(), begin[of] + step, words, ids[of], place[of] + step)
            window = at[of[late]] + step[late]
            order = np.lexsort((window, slices_[of[late]]))
            late, window = late[order], window[order]
            runs = list(_runs(slices_[of[late]]))
            keys, blobs = [s for s, _, _ in runs], [_pack(np.diff(window[a:b], prepend=0), "<i4") for _, a, b in runs]
            none = [None] * len(keys)
            out = [(none, keys, none, none, blobs)]
            if not last:
                again = np.flatnonzero(whole.astype(bool))
                again = again[~np.isin(again, of[late])]  # such a segment is one window
                ends = found.ends[begin + n + words - 2] + 1
                to = _part_of(mix64(ngram_hashes(found.hashes(), words)[begin[again]]) >> np.uint64(16), parts) if len(again) else np.zeros(0, np.int64)
                again, to = (x[np.lexsort((slices_[again], to))] for x in (again, to))
                for p, a, b in _runs(to):
                    for s, c, d in _runs(slices_[again[a:b]]):
                        some = again[a:b][c:d]
                        raw = b"".join(text[found.starts[begin[k]] : ends[k]].tobytes() for k in some.tolist())
                        out.append(([p], [s], [_pack(np.stack((ids, place, at, n, whole))[:, some], "<i8")], [zstandard.ZstdCompressor(level=1).compress(raw)], [None]))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            columns = [pa.array([v for o in out for v in o[k]], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "slice", "facts", "text", "flags"])

    dealt = sent.repartition(shuffle_partitions(sent.sparkSession), "part").sortWithinPartitions("part", "slice")
    return dealt.mapInArrow(run, SENT + ", flags binary")


def repeated_windows(packed: DataFrame, words: int) -> DataFrame:
    """(slice, flags): the windows of each slice that occur earlier in another slice."""
    spark = packed.sparkSession
    facts = packed.agg(F.sum("windows").alias("windows"), F.count(F.lit(1)).alias("slices")).first()
    parts = min(1 << 31, max(4 * shuffle_partitions(spark), -(-(facts["windows"] or 0) // PART_WINDOWS)))
    salts = max(1, math.isqrt(facts["slices"]))
    joined = packed.select(*PACKED).join(repeated_anchors(packed, words, parts), "slice", "left")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, own in _slices_of(batch, words):
                yield _segments(own, batch.column("bits")[i].as_py(), parts, batch.column("slice")[i].as_py(), salts)

    once = cut(subtrees(joined.mapInArrow(send, SENT), words, parts, last=False), "subtrees")
    again = subtrees(once.filter("flags IS NULL").drop("flags"), words, parts, last=True)
    found = once.filter("flags IS NOT NULL").select("slice", "flags").unionByName(again.select("slice", "flags"))
    return found.groupBy("slice").agg(F.collect_list("flags").alias("flags"))


def _late(own: Slice, flags: list[bytes] | None) -> np.ndarray:
    """The windows that an equal one precedes."""
    lead, late = own.firsts()
    for raw in flags or []:
        late[np.cumsum(_unpack(raw, "<i4"))] = True
    # of equal windows only the earliest was sent: what precedes it precedes all, its own twins in repeated rows too
    return np.flatnonzero(late | late[lead])


def _kept(own: Slice, late: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words that stay, words removed of each document)."""
    n = len(own.words)
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, own.starts[late], 1)
    np.add.at(cover, own.starts[late] + own.width, -1)
    gone = np.cumsum(cover)[:n] > 0
    total = np.concatenate(([0], np.cumsum(gone)))
    bounds = own.words.bounds
    return ~gone, total[bounds[1:]] - total[bounds[:-1]]


def _joined_words(own: Slice, stays: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words that stay, each followed by a space, as (bytes, end of each document's)."""
    w = own.words
    size = w.ends[stays] - w.starts[stays] + 1
    ends = np.cumsum(size)
    index = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(w.starts[stays] - (ends - size), size)
    out = w.data[np.minimum(index, len(w.data) - 1)] if len(index) else np.zeros(0, np.uint8)
    out[ends - 1] = 32
    count = np.concatenate(([0], np.cumsum(stays)))[w.bounds[1:]]
    return out, np.concatenate(([0], ends))[count]


def _flagged(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    rows = whole_ids(id_and_text(docs, id_col, text_col))
    packed = cut(pack_slices(rows, words), "slices")
    return packed.select(*PACKED).join(repeated_windows(packed, words), "slice", "left")


def without_repeats(docs: DataFrame, words: int = 20, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words (and, if asked for, kept_text)."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, own in _slices_of(batch, words):
                stays, removed = _kept(own, _late(own, batch.column("flags")[i].as_py()))
                out, ends = _joined_words(own, stays)
                raw, lo, texts = memoryview(out), 0, []
                for hi in ends.tolist():
                    texts.append(raw[lo : max(lo, hi - 1)])
                    lo = hi
                values = [
                    pa.array(own.ids, mask=~own.known),
                    pa.array(own.words.counts()),
                    pa.array(removed),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                ]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    values.append(pa.array([bytes(t).decode() for t in texts], pa.string()))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(values, names)

    flagged = _flagged(docs, words, id_col, text_col)
    return flagged.mapInArrow(remove, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)


def maximal_repeats(docs: DataFrame, words: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, n_words: the longest runs of words of which every window occurs earlier, as places of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, own in _slices_of(batch, words):
                at = _late(own, batch.column("flags")[i].as_py())
                joins = (np.diff(at) == 1) & (own.doc[at[1:]] == own.doc[at[:-1]])
                opens = np.flatnonzero(np.append(True, ~joins)[: len(at)])
                n = np.diff(np.append(opens, len(at))) + own.width - 1
                doc = own.doc[at[opens]]
                values = [pa.array(own.ids[doc], mask=~own.known[doc]), pa.array(own.starts[at[opens]] - own.words.bounds[doc]), pa.array(n)]
                yield pa.RecordBatch.from_arrays(values, ["doc_id", "start", "n_words"])

    return _flagged(docs, words, id_col, text_col).mapInArrow(run, "doc_id long, start long, n_words long")
