"""Expressions over reads: qualities, strands, anchors and what lies beside them.

A read is (seq, qual) as text.  Positions are 1-based; 0 means not found.
Missing segments are null, never empty text (an empty span between two anchors
is legal and stays empty).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..profiles import ReadProfile
from . import metrics

#: Quality given to bases that a fill adds.
FILL_QUALITY = 30
#: Marks a barcode with a short insert.
SHORT_MOTIF = "ACTAGCATAA"


def phred(qual: Column) -> Column:
    """Qualities as an array of numbers."""
    return F.when(qual == "", F.array().cast("array<int>")).otherwise(F.transform(F.split(qual, ""), lambda c: F.ascii(c) - 33))


@F.arrow_udf(LongType())
def quality_sum(qual: pa.Array) -> pa.Array:
    """The sum of the qualities; 0 for no bases."""
    codes, offsets = _bytes_of(qual)
    return pa.array(np.diff(_sums(codes)[offsets]), mask=_nulls(qual))


def mean_quality(qual: Column) -> Column:
    """Arithmetic mean; 0 for no bases."""
    n = F.length(qual)
    return F.when(n == 0, F.lit(0.0)).otherwise(quality_sum(qual) / n)


def masked(seq: Column, qual: Column, least: int) -> Column:
    """Bases with a quality under least become N; bases without a quality stay."""

    @F.arrow_udf(StringType())
    def run(seqs: pa.Array, quals: pa.Array) -> pa.Array:
        data, offsets = _bytes_of(seqs)
        data = _masked(data, offsets, *_bytes_of(quals), least)
        return _texts(data, offsets[:-1], np.diff(offsets), ~(_nulls(seqs) | _nulls(quals)))

    return run(seq, qual)


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGT", "TGCA"))


def revcomp_text(seq: str) -> str:
    return seq[::-1].translate(str.maketrans("ACGT", "TGCA"))


def find_anchor(seq: Column, anchor: str, mismatches: int = 0) -> Column:
    """Start of the leftmost window that differs from the anchor in at most so many bases; 0 where there is none."""
    if mismatches <= 0:
        return F.locate(anchor, seq)
    return find_anchors(seq, {"at": (anchor, False)}, mismatches)["at"]


def find_anchors(seq: Column, anchors: dict[str, tuple[str, bool]], mismatches: int) -> Column:
    """A struct with the start of each anchor, by name; (text, True) looks on the reverse complement.

    An anchor with at most k bases changed has one of its k + 1 pieces unchanged: eight bytes of each piece are compared with
    the bytes of a batch of reads at once, and only where one fits, all bases are.  The function counts as not deterministic, so that the optimizer neither repeats it nor
    moves a filter on what is derived from it below.
    """
    kind = StructType([StructField(n, IntegerType()) for n in anchors])

    def run(texts: pa.Array) -> pa.Array:
        found = _anchor_places(*_bytes_of(texts), list(anchors.values()), mismatches)
        return pa.StructArray.from_arrays([pa.array(f, pa.int32(), mask=_nulls(texts)) for f in found], names=list(anchors))

    return F.arrow_udf(run, kind).asNondeterministic()(seq)


#: Reads compared at a time, so that a batch's counters stay in the processor's cache.
READS_AT_ONCE = 2048
_COMPLEMENT = np.arange(256, dtype=np.uint8)
_COMPLEMENT[[65, 67, 71, 84]] = [84, 71, 67, 65]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(one byte for each character, offsets); characters beyond ASCII, which no anchor has, become zero."""
    if texts.null_count:
        texts = texts.fill_null("")
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], dtype=np.uint8) if raw.buffers()[2] is not None else np.zeros(0, np.uint8)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    if len(data) and data.max() > 127:
        kept = (data & 0xC0) != 0x80
        offsets = np.concatenate(([0], np.cumsum(kept)))[offsets]
        data = np.where(data[kept] > 127, 0, data[kept]).astype(np.uint8)
    return data, offsets


def _nulls(texts: pa.Array) -> np.ndarray:
    return np.asarray(pa.compute.is_null(texts))


def _sums(codes: np.ndarray) -> np.ndarray:
    """The sum of the qualities before each place, and of all."""
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(codes.astype(np.int64) - 33)))


def _masked(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray, code_offsets: np.ndarray, least: int) -> np.ndarray:
    """The bases of a batch, N where the quality of the same place of the same read is under least."""
    size, row = np.diff(offsets), np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    place = np.arange(len(data)) - np.repeat(offsets[:-1], size)
    known = place < np.diff(code_offsets)[row]
    low = np.zeros(len(data), dtype=bool)
    low[known] = codes[(code_offsets[row] + place)[known]] < least + 33
    return np.where(low, ord("N"), data).astype(np.uint8)


def _texts(data: np.ndarray, start: np.ndarray, size: np.ndarray, there: np.ndarray, turned: bool = False) -> pa.Array:
    """The texts data[start : start + size], null where not there; turned: their reverse complements.  Bytes of zero are N."""
    size = np.where(there, size, 0)
    ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
    at = np.arange(ends[-1])
    if turned:
        out = _COMPLEMENT[data[np.repeat(start + size - 1 + ends[:-1], size) - at]]
    else:
        out = data[np.repeat(start - ends[:-1], size) + at]
    out = np.where(out == 0, ord("N"), out).astype(np.uint8)
    valid = pa.py_buffer(np.packbits(there, bitorder="little").tobytes())
    return pa.Array.from_buffers(pa.large_string(), len(size), [valid, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())]).cast(pa.string())


def _anchor_places(data: np.ndarray, offsets: np.ndarray, anchors: list[tuple[str, bool]], mismatches: int) -> list[np.ndarray]:
    """For each (anchor, on the reverse complement?) its place in every read, 0 where it isn't found."""
    reads = len(offsets) - 1
    found = [np.zeros(reads, dtype=np.int32) for _ in anchors]
    for lo in range(0, reads, READS_AT_ONCE):
        some = offsets[lo : lo + READS_AT_ONCE + 1]
        part, some = data[some[0] : some[-1]], some - some[0]
        sides = {False: (part, some), True: (_COMPLEMENT[part[::-1]], len(part) - some[::-1])}
        eights = {back: _eights(sides[back][0]) for back in {b for _, b in anchors}}
        for out, (anchor, back) in zip(found, anchors, strict=True):
            places = _first_places(*sides[back], eights[back], np.frombuffer(anchor.encode(), dtype=np.uint8), mismatches)
            out[lo : lo + READS_AT_ONCE] = places[::-1] if back else places
    return found


def _eights(data: np.ndarray) -> np.ndarray:
    """At each position the number that its eight bytes make, zeros after the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray(len(data), "<u8", padded, strides=(1,)).copy()


def _first_places(data: np.ndarray, offsets: np.ndarray, eights: np.ndarray, anchor: np.ndarray, mismatches: int) -> np.ndarray:
    out, n, piece = np.zeros(len(offsets) - 1, dtype=np.int32), len(data) - len(anchor) + 1, len(anchor) // (mismatches + 1)
    if n <= 0:
        return out
    if piece >= 8:
        some = np.zeros(n, dtype=bool)
        for start in range(0, piece * (mismatches + 1), piece):
            some |= eights[start : start + n] == anchor[start : start + 8].copy().view("<u8")[0]
        at = np.flatnonzero(some)
        at = at[(data[at[:, None] + np.arange(len(anchor))] != anchor).sum(axis=1) <= mismatches]
    else:
        wrong = np.zeros(n, dtype=np.uint8)
        for j, c in enumerate(anchor):
            wrong += data[j : j + n] != c
        at = np.flatnonzero(wrong <= mismatches)
    row = np.searchsorted(offsets, at, side="right") - 1
    inside = at + len(anchor) <= offsets[row + 1]
    at, row = at[inside], row[inside]
    new = np.append(True, row[1:] != row[:-1]) if len(row) else np.zeros(0, bool)
    out[row[new]] = at[new] - offsets[row[new]] + 1
    return out


def beside(text: Column, at: Column, anchor_len: int, direction: str, length: int) -> Column:
    """What lies next to an anchor found at `at`: all `length` bases before it, or up to `length` after it.

    Fewer bases than asked for before the anchor count as missing; after it, at the read's end, they are kept.
    """
    if direction == "upstream":
        return F.when(at > length, F.substring(text, at - length, F.lit(length)))
    if direction == "downstream":
        return F.when(at > 0, F.substring(text, at + anchor_len, F.lit(length)))
    raise ValueError(f"direction must be upstream or downstream, not {direction!r}")


def between(text: Column, first_at: Column, first_len: int, second_at: Column) -> Column:
    """What lies between the end of the first anchor and the start of the second; may be empty, null where they overlap."""
    start = first_at + first_len
    return F.when((first_at > 0) & (second_at > 0) & (start <= second_at), F.substring(text, start, second_at - start))


def padded(span: Column, length: int, fill: str | None) -> Column:
    """A short span with the end of the fill put before it."""
    if not fill:
        return span
    short = F.lit(length) - F.length(span)
    return F.when(short > 0, F.concat(F.substring(F.lit(fill), F.greatest(F.lit(len(fill)) - short + 1, F.lit(1)), short), span)).otherwise(span)


def padded_quality(span_qual: Column, length: int, fill: str | None) -> Column:
    """Mean quality of a padded span, the added bases counting FILL_QUALITY each."""
    if not fill:
        return mean_quality(span_qual)
    n = F.length(span_qual)
    added = F.least(F.greatest(F.lit(length) - n, F.lit(0)), F.lit(len(fill)))
    return F.coalesce(F.try_divide(quality_sum(span_qual) + added * FILL_QUALITY, n + added), F.lit(0.0)).cast("double")


#: What is cut out of a read.
SEGMENTS = "p5_seq string, p5_q double, p7_seq string, p7_q double, bc_seq string, bc_q double"


def anchors_of(profile: ReadProfile) -> dict[str, tuple[str, bool]]:
    """What has to be found in a read: P5 as it was read, the rest on the profile's strand."""
    back = profile.strand == "rev"
    found = {"p5": (profile.ref_p5, False), "bc": (profile.ref_bc, back)}
    return found | ({"p7": (profile.dual.ref_p7, back)} if profile.dual else {})


class _Side:
    """A batch of reads on one strand: bases, qualities and their sums, with the start and size of each read's."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, codes: np.ndarray, code_offsets: np.ndarray, back: bool) -> None:
        self.size, self.codes = np.diff(offsets), np.diff(code_offsets)
        if back:
            self.data, self.start = _COMPLEMENT[data[::-1]], len(data) - offsets[1:]
            self.sums, self.code_start = _sums(codes[::-1]), len(codes) - code_offsets[1:]
        else:
            self.data, self.start = data, offsets[:-1]
            self.sums, self.code_start = _sums(codes), code_offsets[:-1]

    def beside(self, at: np.ndarray, anchor: str, direction: str, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size, is it there) of what lies next to an anchor, as `beside` has it."""
        if direction == "upstream":
            return at - 1 - length, np.full(len(at), length), at > length
        start = at - 1 + len(anchor)
        return start, np.clip(self.size - start, 0, length), at > 0

    def texts(self, start: np.ndarray, size: np.ndarray, there: np.ndarray, turned: bool = False) -> pa.Array:
        return _texts(self.data, self.start + start, size, there, turned)

    def quality(self, start: np.ndarray, size: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sum, number) of the qualities of segments; those that aren't there have none."""
        lo = np.clip(np.where(there, start, 0), 0, self.codes)
        n = np.clip(np.where(there, start + size, 0), lo, self.codes) - lo
        lo = self.code_start + lo
        return self.sums[lo + n] - self.sums[lo], n


def _means(total: np.ndarray, n: np.ndarray, there: np.ndarray) -> pa.Array:
    return pa.array(np.where(n > 0, total / np.maximum(n, 1), 0.0), mask=~there)


def _cut(sides: dict[bool, _Side], places: dict[str, np.ndarray], profile: ReadProfile, known: np.ndarray, rated: np.ndarray) -> pa.Array:
    """The segments of one read structure of every read; known and rated: has the read bases, qualities?"""
    front, side, dual = sides[False], sides[profile.strand == "rev"], profile.dual
    p5 = front.beside(places["p5"], profile.ref_p5, profile.dir_p5, profile.len_p5)
    out = [front.texts(*p5[:2], p5[2] & known), _means(*front.quality(*p5), p5[2] & known & rated)]
    seen = known
    if dual is None:
        out += [pa.nulls(len(known), pa.string()), pa.nulls(len(known), pa.float64())]
    else:
        p7 = side.beside(places["p7"], dual.ref_p7, dual.dir_p7, dual.len_p7)
        seen = p7[2] & known
        out += [side.texts(*p7[:2], seen, dual.beside_bc), _means(*side.quality(*p7), seen & rated)]
    if dual is None or dual.beside_bc:
        start, size, there = side.beside(places["bc"], profile.ref_bc, profile.dir_bc, profile.len_bc)
    else:
        start = places["p7"] - 1 + len(dual.ref_p7)
        size = places["bc"] - 1 - start
        there = (places["p7"] > 0) & (places["bc"] > 0) & (size >= 0)
    there = there & seen
    text, (total, n) = side.texts(start, size, there), side.quality(start, size, there)
    if dual is not None and not dual.beside_bc and dual.fill:
        fills = pa.array([dual.fill[len(dual.fill) - k :] for k in range(len(dual.fill) + 1)])
        text = pa.compute.binary_join_element_wise(fills.take(pa.array(np.clip(profile.len_bc - size, 0, len(dual.fill)))), text, "")
        added = np.clip(profile.len_bc - n, 0, len(dual.fill))
        total, n = total + added * FILL_QUALITY, n + added
    out += [text, _means(total, n, there & rated)]
    return pa.StructArray.from_arrays(out, names=["p5_seq", "p5_q", "p7_seq", "p7_q", "bc_seq", "bc_q"])


def segments(seq: Column, qual: Column, profiles: dict[str, ReadProfile], mismatches: int, mask_below: int | None = None) -> Column:
    """A struct with the segments (`SEGMENTS`) of each read structure, by name: one pass over the bytes of an Arrow batch.

    Each different anchor is looked for once; sums of qualities before every base give the mean of any segment.  The P5
    anchor is found on the strand as read; a 'rev' profile turns the read before the rest.  With a second index nothing
    but P5 is reported unless P7 is found.  Reads are ASCII; other characters count as N.
    """
    anchors = list(dict.fromkeys(a for p in profiles.values() for a in anchors_of(p).values()))

    def run(seqs: pa.Array, quals: pa.Array) -> pa.Array:
        (data, offsets), (codes, code_offsets) = _bytes_of(seqs), _bytes_of(quals)
        if mask_below:
            data = _masked(data, offsets, codes, code_offsets, mask_below)
        found = dict(zip(anchors, (f.astype(np.int64) for f in _anchor_places(data, offsets, anchors, mismatches)), strict=True))
        sides = {back: _Side(data, offsets, codes, code_offsets, back) for back in {False} | {p.strand == "rev" for p in profiles.values()}}
        known, rated = ~_nulls(seqs), ~_nulls(quals)
        cut = [_cut(sides, {k: found[a] for k, a in anchors_of(p).items()}, p, known, rated) for p in profiles.values()]
        return pa.StructArray.from_arrays(cut, names=list(profiles))

    kind = ", ".join(f"{n} struct<{SEGMENTS.replace(' ', ':').replace(',:', ', ')}>" for n in profiles)
    return F.arrow_udf(run, kind).asNondeterministic()(seq, qual)


def windows(seq: Column, size: int) -> Column:
    """All runs of `size` bases, as an array; empty where the sequence is shorter."""
    n = F.length(seq)
    return F.when(n >= size, F.transform(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))), lambda i: F.substring(seq, i, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def count_n(seq: Column) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit("N"), F.lit("")))


def has_short_motif(seq: Column, motif: str = SHORT_MOTIF) -> Column:
    return F.coalesce(F.contains(seq, F.lit(motif)), F.lit(False))


def substitution_suffix(parent: Column, child: Column) -> Column:
    """Substitutions as position and new base joined by '-', 'indel' where bases were added or lost, 'other' for none.

    Texts of one length whose edit distance is less than their differing positions are also 'indel'.
    """
    places = F.sequence(F.lit(1), F.greatest(F.length(parent), F.lit(1)))
    other = F.filter(places, lambda i: F.substring(parent, i, F.lit(1)) != F.substring(child, i, F.lit(1)))
    subs = F.array_join(F.transform(other, lambda i: F.concat(i.cast("string"), F.substring(child, i, F.lit(1)))), "-")
    return (
        F.when((F.length(parent) != F.length(child)) | (F.levenshtein(parent, child) < F.size(other)), F.lit("indel"))
        .when(F.size(other) == 0, F.lit("other"))
        .otherwise(subs)
    )


@F.arrow_udf(StringType())
def edit_path_suffix(parents: pa.Array, children: pa.Array) -> pa.Array:
    """The shortest edit script from each parent to its child in run-length form: = kept, X replaced, I added, D lost."""
    return metrics.edit_scripts(parents, children)
