"""Edit-distance joins without comparing all pairs.

Two texts within a Levenshtein (or Hamming) distance of 2 have a form in common
for each way they can differ: a text with gaps, or without a character or two.
The join is an equi-join on these forms; each pair is found once, with its
distance, so nothing is compared or told apart afterwards.  For larger d a text is cut into d + 1
segments: d edits leave one of them as it is, at most d places from where it was,
so the join is an equi-join on (length, segment number, segment).  The other
metrics bound the Levenshtein distance and go the same way.  A function of the
caller's own that is a metric is joined by bands of the distances to a few
landmarks, which the triangle inequality keeps apart.  Whatever keys the caller
gives (sample, profile) are part of the equi-join, so one join serves all groups.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions import metrics
from ..session import settled

#: Distances up to this use deletion forms; beyond it the number of forms grows too fast.
MOST_DELETIONS = 2
#: Landmarks whose distances are compared before a caller's metric is asked, and how many of them make bands.
LANDMARKS = 48
BANDED = 1
#: Texts of a block, on average: each pair of blocks is compared apart, so that a band of most texts is many tasks' work.
BLOCK_TEXTS = 4096
#: Texts compared with a block at a time, and the landmarks that are compared for all of their pairs; the others only for what these leave.
ROWS_AT_ONCE = 256
DENSE = 8
Metric = str | Callable[[str, str], int]


def deletion_forms(seq: Column, d: int) -> Column:
    """The distinct texts that at most d deletions make of seq."""

    def once(s: Column) -> Column:
        n = F.length(s)
        cut = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, n)))
        return F.when(n > 0, cut).otherwise(F.array().cast("array<string>"))

    forms = F.array(seq)
    level = forms
    for _ in range(d):
        level = F.array_distinct(F.flatten(F.transform(level, once)))
        forms = F.array_union(forms, level)
    return forms


#: A distance of r by a metric is at most so many times r Levenshtein edits: deletions and insertions are edits; where only the
#: longer text's rest counts, there are at most as many insertions as deletions; a swap is two edits.
EDITS = {"levenshtein": 1, "indel": 1, "lcsseq": 2, "osa": 2}


def distance(metric: Metric, left: Column, right: Column, limit: int | None = None) -> Column:
    """The distance of two texts by a metric's name (in any case) or by a function of two texts; null beyond the limit.

    Hamming raises on texts of different lengths.
    """
    if callable(metric):

        @F.pandas_udf(IntegerType())
        def own(a: pd.Series, b: pd.Series) -> pd.Series:
            return pd.Series([None if x is None or y is None else int(metric(x, y)) for x, y in zip(a, b, strict=True)], dtype="Int32")

        found = own(left, right)
    else:
        name = metric.lower()
        if name == "levenshtein":
            found = F.levenshtein(left, right) if limit is None else F.levenshtein(left, right, limit)
            return found if limit is None else F.when(found >= 0, found)
        if name not in metrics.METRICS:
            raise ValueError(f"unknown distance {metric!r}")

        @F.arrow_udf(IntegerType())
        def known(a: pa.Array, b: pa.Array) -> pa.Array:
            return metrics.metric(a, b, name)

        found = known(left, right)
        if name == "hamming":
            found = F.when(F.length(left) != F.length(right), F.raise_error(F.lit("Hamming distance of different lengths")).cast("int")).otherwise(found)
    return found if limit is None else F.when(found <= limit, found)


def segments(seq: Column, d: int) -> Column:
    """array<(length, number, segment)>: the d + 1 segments of a text, as even as they go, longer ones last."""
    n = F.length(seq)
    size, longer = F.floor(n / (d + 1)).cast("int"), n % (d + 1)

    def segment(i: Column) -> Column:
        # segments from number d + 1 - longer on have one more
        start = i * size + F.greatest(i - (d + 1 - longer), F.lit(0)) + 1
        return F.struct(n.alias("length"), i.alias("number"), F.substring(seq, start, size + (i >= d + 1 - longer).cast("int")).alias("segment"))

    return F.transform(F.array(*map(F.lit, range(d + 1))), segment)


def segment_probes(seq: Column, d: int, shift: bool = True) -> Column:
    """array<(length, number, segment)> of which a text within d edits (substitutions only, without shift) of seq has one."""
    n = F.length(seq)
    lengths = F.sequence(F.greatest(n - d, F.lit(0)), n + d) if shift else F.array(n)
    moves = F.array(*map(F.lit, range(-d, d + 1))) if shift else F.array(F.lit(0))

    def of_length(length: Column) -> Column:
        size, longer = F.floor(length / (d + 1)).cast("int"), length % (d + 1)

        def of_segment(i: Column) -> Column:
            start = i * size + F.greatest(i - (d + 1 - longer), F.lit(0)) + 1
            many = size + (i >= d + 1 - longer).cast("int")
            places = F.filter(F.transform(moves, lambda m: start + m), lambda p: (p >= 1) & (p + many - 1 <= n))
            return F.transform(places, lambda p: F.struct(length.alias("length"), i.alias("number"), F.substring(seq, p, many).alias("segment")))

        return F.flatten(F.transform(F.array(*map(F.lit, range(d + 1))), of_segment))

    return F.array_distinct(F.flatten(F.transform(lengths, of_length)))


def _by_forms(name: str | None, radius: int) -> bool:
    return name in ("levenshtein", "hamming") and radius <= MOST_DELETIONS


def _forms(rows: DataFrame, seq: str, metric: str, radius: int, asked: bool) -> DataFrame:
    """rows with (form, kind, text, at, till), one row for each form of which two texts within the radius have one in common.

    asked: the side that looks for the other's segments in neighbouring places.  Texts with as many characters as edits or
    fewer have segments without a character, which say nothing: `_short` compares those.
    """
    name = metric.lower()
    if _by_forms(name, radius):
        return _keyed(rows, seq, name, radius, asked)
    edits = radius * EDITS.get(name, 1)
    parts = segment_probes(F.col(seq), edits, name != "hamming") if asked else segments(F.col(seq), edits)
    cut = rows.withColumn("part_", F.explode(parts)).filter("part_.segment <> ''")
    cut = cut.withColumn("text", F.concat_ws(":", "part_.length", "part_.number", "part_.segment")).drop("part_")
    return cut.withColumns({"form": F.xxhash64("text"), "kind": F.lit(0).cast("long"), "at": F.lit(0), "till": F.lit(0)})


def _short(q: DataFrame, r: DataFrame, keys: list[str], metric: str, radius: int) -> DataFrame | None:
    """Pairs of texts that are too short to be found by segments: different texts are compared once, then they get their ids."""
    name = metric.lower()
    if _by_forms(name, radius):
        return None
    edits = radius * EDITS.get(name, 1)
    few = r.filter(F.length("ref_seq") <= edits)
    near = q.filter(F.length("query_seq") <= 2 * edits)
    lengths = F.explode(F.sequence(F.greatest(F.length("query_seq") - edits, F.lit(0)), F.length("query_seq") + edits))
    texts = near.select(*keys, "query_seq").distinct().withColumn("length_", lengths)
    met = texts.join(few.select(*keys, "ref_seq", F.length("ref_seq").alias("length_")).distinct(), [*keys, "length_"]).drop("length_")
    met = _checked(met, metric, radius)
    return met.join(near, [*keys, "query_seq"]).join(few, [*keys, "ref_seq"]).select(*keys, "query_id", "query_seq", "ref_id", "ref_seq", "dist")


def _checked(pairs: DataFrame, metric: Metric, radius: int) -> DataFrame:
    """Pairs whose texts are within the radius, with dist."""
    if metric == "hamming":
        pairs = pairs.filter(F.length("query_seq") == F.length("ref_seq"))
    return pairs.withColumn("dist", distance(metric, F.col("query_seq"), F.col("ref_seq"), radius)).filter("dist IS NOT NULL")


def _shuffled(forms: DataFrame) -> DataFrame:
    """Forms to be joined by a shuffle: a table of texts may be small enough to broadcast, or to be one task's, where its forms and pairs aren't."""
    return forms.hint("shuffle_merge")


def _one_edit(q: DataFrame, r: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """Pairs within one Levenshtein or Hamming edit, each found once: nothing is checked, and no pair is shuffled to be told from itself.

    Texts that differ in one place agree in the text with a gap there and in no other; a text that lacks a character of
    another is one of its distinct shorter forms.  Kinds of keys: 0 equal, or the query longer; 1 the query shorter; a gap
    at n has kind n + 1.
    """

    def gaps(s: Column) -> Column:
        n = F.length(s)
        found = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.struct((i + 1).alias("kind"), F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, n)).alias("form")))
        return F.filter(found, lambda _: n > 0)

    def of_kind(kind: int, forms: Column) -> Column:
        return F.transform(forms, lambda f: F.struct(F.lit(kind).alias("kind"), f.alias("form")))

    def shorter(s: Column) -> Column:
        return F.filter(deletion_forms(s, 1), lambda f: F.length(f) < F.length(s))

    def keyed(rows: DataFrame, seq: str, zero: Column, one: Column) -> DataFrame:
        s = F.col(seq)
        parts = [of_kind(0, zero), gaps(s)] if metric == "hamming" else [of_kind(0, zero), of_kind(1, one), gaps(s)]
        return rows.withColumn("key_", F.explode(F.concat(*parts))).select(*rows.columns, "key_.kind", "key_.form")

    a, b = F.col("query_seq"), F.col("ref_seq")
    asked = keyed(q, "query_seq", F.array(a) if metric == "hamming" else F.concat(F.array(a), shorter(a)), F.array(a))
    given = keyed(r, "ref_seq", F.array(b), shorter(b))
    met = _shuffled(asked).join(given, [*keys, "kind", "form"]).filter((F.col("kind") < 2) | (a != b))
    return met.withColumn("dist", F.when(a == b, 0).otherwise(1)).drop("kind", "form")


def _one_edit_by_pieces(q: DataFrame, r: DataFrame, keys: list[str], metric: str, piece: int) -> DataFrame:
    """Pairs within one Levenshtein or Hamming edit, each found once, with few forms for each text.

    An edit is inside one piece of the reference, or at its edges: what is before the piece and after it is the same in
    both.  A text has a form for each piece instead of one or two for each base, so a form may be that of 4 ** piece
    references of its key, which are compared.
    """
    lengths = r.select(F.length("ref_seq").alias("length_")).distinct()  # one for each length at most

    def keyed(rows: DataFrame, seq: str, length: Column) -> DataFrame:
        s = F.col(seq)
        start = F.col("piece_") * piece
        after = length - F.least(start + piece, length)
        rest = F.concat(F.substring(s, F.lit(1), start), F.substring(s, F.length(s) - after + 1, after))
        rows = rows.withColumn("piece_", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(length / piece).cast("int") - 1, F.lit(0)))))
        return rows.withColumn("form_", F.xxhash64(*keys, length, "piece_", rest)).drop("length_")

    n = F.length("query_seq")
    near = F.array(n) if metric == "hamming" else F.sequence(F.greatest(n - 1, F.lit(0)), n + 1)
    asked = q.withColumn("length_", F.explode(near)).join(F.broadcast(lengths), "length_")  # no more rows than the longest reference has bases
    met = _shuffled(keyed(asked, "query_seq", F.col("length_"))).join(keyed(r, "ref_seq", F.length("ref_seq")), ["form_", "piece_", *keys])
    # texts that agree to the end of this piece meet in the next one as well
    a, b = F.col("query_seq"), F.col("ref_seq")
    end = F.least((F.col("piece_") + 1) * piece, F.length(b))
    once = (end == F.length(b)) | (F.substring(a, F.lit(1), end) != F.substring(b, F.lit(1), end))
    return _checked(met.filter(once).drop("form_", "piece_"), metric, 1)


#: A gap at place i is GAP + i, one at i and another at j that and (GAP + j) * TWO; smaller kinds are those of `_keyed`.
GAP = 8
TWO = 1 << 31


def _keyed(rows: DataFrame, seq: str, metric: str, radius: int, asked: bool) -> DataFrame:
    """rows with (form, kind, text, at, till), the form a hash of the two after it, by which rows are joined: what two texts within the radius (at most 2) have in common, by the way they differ.

    0: the query, without as many characters as the reference lacks; 1: the reference, without those the query lacks.
    Gaps: texts that differ in one place or two agree in the text with gaps there.  2: texts of one length without a
    character each (at..till: the run it is of).  3 and 4, each with a gap: the query (3) or the reference (4) is longer by
    one, and without that one (the last of its run: at) it differs from the other in the gap.
    """
    # texts are few bytes where their forms are many: adaptive execution would make the forms of all in one task
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), seq)
    s, places = F.col(seq), F.sequence(F.lit(1), F.greatest(F.length(seq), F.lit(1)))
    none = F.lit(0)

    def row(kind: Column, text: Column, at: Column = none, till: Column = none) -> Column:
        return F.struct(kind.cast("long").alias("kind"), text.alias("text"), at.cast("int").alias("at"), till.cast("int").alias("till"))

    def without(t: Column, i: Column) -> Column:
        return F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t)))

    def gaps(t: Column, kind: int, at: Column | None = None) -> Column:
        n = F.length(t)
        found = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: row(F.lit(kind) * TWO + GAP + i, without(t, i), i if at is None else at))
        return F.filter(found, lambda _: n > 0)

    n = F.length(s)
    kinds = [F.transform(F.array(s), lambda t: row(F.lit(0), t)), gaps(s, 0)]
    if metric != "hamming":
        shorter = F.filter(deletion_forms(s, radius), lambda f: F.length(f) < n)
        kinds.append(F.transform(shorter, lambda f: row(F.lit(0 if asked else 1), f)))
        if asked:
            kinds.append(F.array(row(F.lit(1), s)))
    if radius == 0:
        kinds = kinds[:1]
    if radius == 2:
        two = F.transform(places, lambda i: F.transform(F.filter(places, lambda j: j > i), lambda j: row(GAP + i + (GAP + j) * TWO, F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, j - i - 1), F.substring(s, j + 1, n)), i, j)))
        kinds.append(F.flatten(two))
        if metric != "hamming":
            ends = F.filter(places, lambda i: (i == n) | ((i < n) & (F.substring(s, i, F.lit(1)) != F.substring(s, i + 1, F.lit(1)))))
            rows = rows.withColumn("runs_", F.transform(ends, lambda e: row(F.lit(2), without(s, e), F.length(F.rtrim(F.substring(s, F.lit(1), e), F.substring(s, e, F.lit(1)))) + 1, e)))
            longer, other = (3, 4) if asked else (4, 3)
            kinds += [F.col("runs_"), gaps(s, other), F.flatten(F.transform("runs_", lambda r: gaps(r["text"], longer, r["till"])))]
    names = [c for c in rows.columns if c != "runs_"]
    return rows.withColumn("key_", F.explode(F.concat(*kinds))).select(*names, F.xxhash64("key_.kind", "key_.text").alias("form"), "key_.kind", "key_.text", "key_.at", "key_.till")


def _meeting(asked: DataFrame, given: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose forms are the same: they are shuffled and sorted by hashes, then told apart by kind and text."""
    ours = _shuffled(asked.withColumnsRenamed({"kind": "q_kind", "text": "q_text", "at": "q_at", "till": "q_till"}))
    met = ours.join(given, ["form", *keys])
    # not as equations, which would become keys of the join
    equal = (F.length("q_text") - F.length("text") == 0) & F.startswith(F.col("q_text"), F.col("text"))
    return met.filter((F.col("q_kind") - F.col("kind") == 0) & equal).drop("q_kind", "q_text")


def _paired(asked: DataFrame, given: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """Pairs within the radius of two tables of `_keyed`, each found once: nothing is checked, and no pair is shuffled to be told from itself."""
    met = _meeting(asked, given, keys).withColumnsRenamed({"at": "r_at", "till": "r_till"})
    a, b, kind = F.col("query_seq"), F.col("ref_seq"), F.col("kind")
    q_at, q_till, r_at, r_till = map(F.col, ("q_at", "q_till", "r_at", "r_till"))

    def part(t: Column, first: Column, last: Column) -> Column:
        return F.substring(t, first, F.greatest(last - first + 1, F.lit(0)))

    def differ(i: Column, j: Column | None = None) -> Column:
        return part(a, i, i) != part(b, i if j is None else j, i if j is None else j)

    # 2: what one text lacks is before what the other lacks; the places between are all that differ.  Texts that differ in
    # two places only are found by gaps; where both ways fit, the first counts
    low, high = F.when(q_till < r_at, q_till).otherwise(r_till), F.when(q_till < r_at, r_at).otherwise(q_at)
    apart = part(a, low + 1, high - 1) != part(b, low + 1, high - 1)
    once = (q_till < r_at) | ((r_till < q_at) & (part(a, low + 1, high) != part(b, low, high - 1)))
    shifted = (low < high) & apart & once

    def with_gap(short: Column, long: Column, i: Column, m: Column) -> Column:
        # neither one edit (all that follows, or precedes, is equal) nor found by the other order of the two
        before = (part(short, i, i) != part(long, i, i)) & (part(short, i, F.length(short)) != part(long, i + 1, F.length(long)))
        after = (part(short, i, i) != part(long, i + 1, i + 1)) & (part(short, F.lit(1), i) != part(long, F.lit(1), i)) & (part(short, m + 1, i) != part(long, m + 1, i))
        return F.when(i < m, before).otherwise(after)

    gap = F.floor(kind / TWO)
    fits = F.when(kind < 2, True).when(kind == 2, shifted).when(kind < TWO, a != b)
    fits = fits.when(gap == 3, with_gap(b, a, r_at, q_at)).when(gap == 4, with_gap(a, b, q_at, r_at)).otherwise(differ(q_at) & differ(q_till))
    dist = F.when(kind < 2, F.abs(F.length(a) - F.length(b))).when((kind > 2) & (kind < TWO), 1).otherwise(2)
    met = met.filter(fits).withColumn("dist", dist.cast("int")).filter(F.col("dist") <= radius)
    return met.drop("form", "kind", "text", "q_at", "q_till", "r_at", "r_till")


def _met(q: DataFrame, r: DataFrame, forms: DataFrame, keys: list[str], metric: str, radius: int, built: int | None = None) -> DataFrame:
    """Pairs within the radius, of queries and the forms of references; built: the radius the forms were made for."""
    made = radius if built is None else built
    if _by_forms(metric, made):
        return _paired(_keyed(q, "query_seq", metric, radius, True), forms, keys, radius)
    asked = _forms(q, "query_seq", metric, made, True)
    near = _meeting(asked, forms, keys)
    # each pair meets once for every common form: keep one before anything is counted
    pairs = _checked(near.select(*keys, "query_id", "query_seq", "ref_id", "ref_seq").distinct(), metric, radius)
    short = _short(q, r, keys, metric, made)
    if short is not None:
        pairs = pairs.unionByName(short.filter(F.col("dist") <= radius)).distinct()
    return pairs


def landmark_join(q: DataFrame, r: DataFrame, radius: int, keys: Sequence[str], metric: Callable[[str, str], int]) -> DataFrame:
    """Pairs within the radius by a metric that nothing else is known of.

    The distances of two such texts to any landmark differ by at most the radius.  Bands of radius + 1 of the distances to
    BANDED landmarks make an equi-join (the second text stands in its own bands and those beside), the others are compared
    before the metric is asked.  Landmarks are LANDMARKS texts of the references, by the order of a hash.  Each two
    different texts are compared once, whichever of them is the query, and however many ids they have.
    """
    keys = list(keys)
    marks = [x[0] for x in r.select("ref_seq").distinct().orderBy(F.xxhash64("ref_seq"), "ref_seq").limit(LANDMARKS).collect()]
    if not marks:
        return q.join(r, keys, "inner").limit(0).withColumn("dist", F.lit(0)) if keys else q.join(r, F.lit(False)).withColumn("dist", F.lit(0))

    @F.pandas_udf("array<int>")
    def places(texts: pd.Series) -> pd.Series:
        return pd.Series([[int(metric(t, m)) for m in marks] for t in texts])

    asked = q.select(*keys, F.col("query_seq").alias("text"), F.lit(True).alias("q_"), F.lit(False).alias("r_"))
    given = r.select(*keys, F.col("ref_seq").alias("text"), F.lit(False).alias("q_"), F.lit(True).alias("r_"))
    texts = asked.unionByName(given).groupBy(*keys, "text").agg(F.max("q_").alias("q_"), F.max("r_").alias("r_"))
    bands = min(BANDED, len(marks))
    names = [f"band_{i}" for i in range(bands)]
    texts = settled(texts.withColumn("at_", places("text")))  # read for both sides
    blocks = -(-texts.count() // BLOCK_TEXTS)
    texts = texts.withColumns({n: F.floor(F.col("at_")[i] / (radius + 1)) for i, n in enumerate(names)})
    texts = texts.withColumn("own_", F.pmod(F.xxhash64("text"), F.lit(max(blocks, 1))).cast("int"))
    # the lesser block is the left one
    left = texts.withColumn("block_a", F.col("own_")).withColumn("block_b", F.explode(F.sequence("own_", F.lit(max(blocks, 1) - 1))))
    beside = F.array(*(F.struct(*(F.lit(m).alias(f"move_{i}") for i, m in enumerate(moves))) for moves in itertools.product((-1, 0, 1), repeat=bands)))
    right = texts.withColumn("move_", F.explode(beside))
    right = right.withColumns({n: F.col(n) + F.col("move_")[f"move_{i}"] for i, n in enumerate(names)}).drop("move_")
    right = right.withColumn("block_b", F.col("own_")).withColumn("block_a", F.explode(F.sequence(F.lit(0), "own_")))

    def compared(a: pa.Table, b: pa.Table) -> pa.Table:
        b = b.rename_columns([c.removeprefix("b_") for c in b.column_names])
        if not len(a) or not len(b):  # a side without rows may have no columns either
            known = (a if len(a) else b).select(keys).slice(0, 0)
            return pa.table([*known.columns, pa.array([], pa.string()), pa.array([], pa.string()), pa.array([], pa.int32())], names=[*keys, "query_seq", "ref_seq", "dist"])
        ours, theirs = a["text"].to_pylist(), b["text"].to_pylist()
        (at, asked_a, given_a), (bt, asked_b, given_b) = (
            (np.array(t["at_"].to_pylist(), dtype=np.int64).reshape(len(t), len(marks)), np.array(t["q_"].to_pylist(), dtype=bool), np.array(t["r_"].to_pylist(), dtype=bool)) for t in (a, b)
        )
        out: tuple[list[str], list[str], list[int]] = ([], [], [])
        same = a["block_a"][0].as_py() == a["block_b"][0].as_py()
        for lo in range(0, len(ours), ROWS_AT_ONCE):
            part = at[lo : lo + ROWS_AT_ONCE]
            near = (asked_a[lo : lo + ROWS_AT_ONCE, None] & given_b) | (given_a[lo : lo + ROWS_AT_ONCE, None] & asked_b)
            for k in range(min(DENSE, len(marks))):
                near &= np.abs(part[:, k, None] - bt[:, k]) <= radius
            i, j = np.nonzero(near)
            for k in range(DENSE, len(marks)):
                kept = np.abs(part[i, k] - bt[j, k]) <= radius
                i, j = i[kept], j[kept]
            for x, y in zip((i + lo).tolist(), j.tolist(), strict=True):
                one, other = ours[x], theirs[y]
                if same and one > other:
                    continue
                d = int(metric(one, other))
                if d > radius:
                    continue
                for query, ref, is_ in ((one, other, asked_a[x] and given_b[y]), (other, one, one != other and asked_b[y] and given_a[x])):
                    if is_:
                        for column, value in zip(out, (query, ref, d), strict=True):
                            column.append(value)
        found = [pa.repeat(a[k][0], len(out[0])) for k in keys]
        return pa.table([*found, pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int32())], names=[*keys, "query_seq", "ref_seq", "dist"])

    cell = [*keys, *names, "block_a", "block_b"]
    kind = StructType([*(q.schema[k] for k in keys), StructField("query_seq", StringType()), StructField("ref_seq", StringType()), StructField("dist", IntegerType())])
    # cells are few bytes where their pairs are many: adaptive execution would make those of all in a few tasks
    parts = int(q.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # names of its own: columns of both sides that are the same ones would be taken for each other
    right = right.select(*(F.col(c).alias(f"b_{c}") for c in right.columns)).repartition(parts, *(f"b_{c}" for c in cell))
    pairs = left.repartition(parts, *cell).groupBy(*cell).cogroup(right.groupBy(*(f"b_{c}" for c in cell))).applyInArrow(compared, kind)
    return pairs.join(q, [*keys, "query_seq"]).join(r, [*keys, "ref_seq"])


def block_join(q: DataFrame, r: DataFrame, radius: int, keys: Sequence[str], metric: Callable[[str, str], int]) -> DataFrame:
    """Pairs within the radius by a function that is no metric: every query against all references of its key, in blocks of references, so that no key is one task's."""
    blocks = int(q.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = q.withColumn("block_", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = r.withColumn("block_", F.pmod(F.xxhash64("ref_id", "ref_seq"), F.lit(blocks)).cast("int"))
    return _checked(left.join(right, [*keys, "block_"]).drop("block_"), metric, radius)


def distance_join(
    queries: DataFrame,
    refs: DataFrame,
    radius: int,
    keys: Sequence[str] = (),
    scope: str = "radius",
    tie: str = "all",
    metric: Metric = "levenshtein",
    exclude_same_id: bool = False,
    query: tuple[str, str] = ("query_id", "query_seq"),
    ref: tuple[str, str] = ("ref_id", "ref_seq"),
    is_metric: bool | None = None,
    piece: int = 1,
) -> DataFrame:
    """(keys..., query_id, query_seq, ref_id, ref_seq, dist) of neighbours within the radius.

    scope: radius (all), min (only the nearest of each query) or exact (distance equal to the radius).  tie, for min: all,
    min_id or first (the same thing: the least id of the nearest).  Null texts and ids match nothing; an (id, text) that
    occurs twice counts once.  is_metric, of a function of the caller's: if unknown, some of the texts are probed.  piece, for
    a radius of 1: texts are cut into pieces of so many bases, which makes fewer forms of long texts; texts of a key that
    agree outside a piece are all compared, so it is for long texts and for keys with few of them.
    """
    if radius < 0:
        raise ValueError("the radius can't be negative")
    if scope not in ("radius", "min", "exact") or tie not in ("all", "min_id", "first"):
        raise ValueError("unknown scope or tie")
    keys = list(keys)
    q = queries.select(*keys, F.col(query[0]).alias("query_id"), F.col(query[1]).alias("query_seq")).dropna().distinct()
    r = refs.select(*keys, F.col(ref[0]).alias("ref_id"), F.col(ref[1]).alias("ref_seq")).dropna().distinct()
    metric = metric.lower() if isinstance(metric, str) else metric
    if scope == "min" and radius > 1 and metric in ("levenshtein", "hamming"):
        # the nearest of most queries are within less than the radius: only the others are looked for further
        inner = distance_join(q, r, radius - 1, keys, "min", tie, metric, exclude_same_id)
        kept = settled(inner)
        rest = q.join(kept.select(*keys, "query_id", "query_seq").distinct(), [*keys, "query_id", "query_seq"], "left_anti")
        outer = distance_join(rest, r, radius, keys, "exact", tie, metric, exclude_same_id)
        if tie != "all":
            first = Window.partitionBy(*keys, "query_id", "query_seq").orderBy("ref_id")
            outer = outer.withColumn("rank_", F.row_number().over(first)).filter("rank_ = 1").drop("rank_")
        return kept.unionByName(outer)
    if callable(metric):
        if is_metric is None:
            texts = q.select(F.col("query_seq").alias("s")).union(r.select("ref_seq"))
            is_metric = not any(probe_metric(texts, "s", metric).values())
        pairs = (landmark_join if is_metric else block_join)(q, r, radius, keys, metric)
    elif metric not in EDITS and metric != "hamming":
        raise ValueError(f"unknown distance {metric!r}")
    elif radius == 0 and metric in ("levenshtein", "hamming"):
        pairs = q.join(r.withColumn("query_seq", F.col("ref_seq")), [*keys, "query_seq"]).withColumn("dist", F.lit(0))
    elif radius == 1 and metric in ("levenshtein", "hamming"):
        if piece > 1 and query[0] == query[1]:
            # ids that are the texts themselves travel once
            pairs = _one_edit_by_pieces(q.drop("query_id"), r, keys, metric, piece).withColumn("query_id", F.col("query_seq"))
        else:
            pairs = _one_edit_by_pieces(q, r, keys, metric, piece) if piece > 1 else _one_edit(q, r, keys, metric)
    elif _by_forms(metric, radius):
        pairs = _met(q, r, _forms(r, "ref_seq", metric, radius, False), keys, metric, radius)
    else:
        # different texts are compared once, then they get their ids
        a = q.select(*keys, F.col("query_seq").alias("query_id"), "query_seq").distinct()
        b = r.select(*keys, F.col("ref_seq").alias("ref_id"), "ref_seq").distinct()
        pairs = _met(a, b, _forms(b, "ref_seq", metric, radius, False), keys, metric, radius).drop("query_id", "ref_id")
        pairs = pairs.join(q, [*keys, "query_seq"]).join(r, [*keys, "ref_seq"])
    return _scoped(pairs, keys, radius, scope, tie, exclude_same_id)


def _scoped(pairs: DataFrame, keys: Sequence[str], radius: int, scope: str, tie: str, exclude_same_id: bool) -> DataFrame:
    """Of the pairs within the radius those that a scope asks for."""
    if exclude_same_id:
        pairs = pairs.filter(F.col("query_id") != F.col("ref_id"))
    if scope == "exact":
        pairs = pairs.filter(F.col("dist") == radius)
    if scope == "min":
        order = Window.partitionBy(*keys, "query_id", "query_seq").orderBy("dist", *(["ref_id"] if tie != "all" else []))
        rank = F.row_number() if tie != "all" else F.rank()
        pairs = pairs.withColumn("rank_", rank.over(order)).filter("rank_ = 1").drop("rank_")
    return pairs.select(*keys, "query_id", "query_seq", "ref_id", "ref_seq", "dist")


def as_pairs(edges: DataFrame) -> DataFrame:
    """One row for each query with its neighbours as a sorted array of (dist, ref_id)."""
    return edges.groupBy("query_id").agg(F.sort_array(F.collect_set(F.struct("dist", "ref_id"))).alias("neighbours"))


def as_parallel(edges: DataFrame) -> DataFrame:
    """One row for each query with two arrays: the ids and their distances."""
    rows = as_pairs(edges)
    return rows.select("query_id", F.col("neighbours.ref_id").alias("ref_ids"), F.col("neighbours.dist").alias("dists"))


def as_map(edges: DataFrame) -> DataFrame:
    """One row for each query with a map of id to distance."""
    return as_pairs(edges).select("query_id", F.map_from_entries(F.transform("neighbours", lambda n: F.struct(n["ref_id"], n["dist"]))).alias("neighbours"))


class RefIndex:
    """References to search: ids and texts of a DataFrame, with the metric they are compared by.

    `build` writes the forms of the references once, as a table bucketed by form: queries read it as it is, without
    making forms of the references or shuffling them again, and `add` puts new references into the same buckets.
    """

    def __init__(self, refs: DataFrame, id_col: str, seq_col: str, metric: Metric = "levenshtein"):
        self.refs = refs.select(F.col(id_col).alias("ref_id"), F.col(seq_col).alias("ref_seq"))
        self.metric = metric.lower() if isinstance(metric, str) else metric
        self.forms: DataFrame | None = None

    @classmethod
    def build(cls, refs: DataFrame, id_col: str, seq_col: str, path: str, radius: int, metric: str = "levenshtein", buckets: int = 64) -> RefIndex:
        """A stored index at path (a folder of the cluster's store), for queries up to the radius."""
        if radius < 0:
            raise ValueError("the radius can't be negative")
        if callable(metric) or (metric.lower() not in EDITS and metric.lower() != "hamming"):
            raise ValueError("an index is stored for a known metric only")
        spark = refs.sparkSession
        about = spark.createDataFrame([(metric.lower(), radius, buckets, refs.schema[id_col].dataType.simpleString())], "metric string, radius int, buckets int, id_type string")
        about.coalesce(1).write.parquet(f"{path}/about")
        index = cls.open(spark, path)
        index.add(refs, id_col, seq_col)
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> RefIndex:
        """An index that `build` has stored, in this session or another."""
        about = spark.read.parquet(f"{path}/about").first()
        table = f"ref_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {table} (ref_id {about['id_type']}, ref_seq STRING, form BIGINT, kind BIGINT, text STRING, at INT, till INT) USING parquet CLUSTERED BY (form) INTO {about['buckets']} BUCKETS LOCATION '{path}/forms'")
        spark.sql(f"CREATE TABLE {table}_texts (ref_id {about['id_type']}, ref_seq STRING) USING parquet LOCATION '{path}/texts'")
        index = cls(spark.table(f"{table}_texts"), "ref_id", "ref_seq", about["metric"])
        index.table, index.radius, index.buckets, index.forms = table, about["radius"], about["buckets"], spark.table(table)
        return index

    def add(self, refs: DataFrame, id_col: str, seq_col: str) -> None:
        """More references for a stored index; what is in it already does no harm."""
        rows = settled(refs.select(F.col(id_col).alias("ref_id"), F.col(seq_col).alias("ref_seq")).dropna().distinct())
        forms = _forms(rows, "ref_seq", self.metric, self.radius, False).repartition(self.buckets, "form")  # a file for each bucket
        forms.select("ref_id", "ref_seq", "form", "kind", "text", "at", "till").write.insertInto(self.table)
        rows.write.insertInto(f"{self.table}_texts")
        spark = refs.sparkSession
        spark.catalog.refreshTable(self.table)
        spark.catalog.refreshTable(f"{self.table}_texts")
        self.refs, self.forms = spark.table(f"{self.table}_texts"), spark.table(self.table)

    def query(self, queries: DataFrame, id_col: str, seq_col: str, radius: int, **options) -> DataFrame:
        """Neighbours within the radius, as `distance_join` has them."""
        if self.forms is None:
            return distance_join(queries, self.refs, radius, metric=self.metric, query=(id_col, seq_col), **options)
        if not 0 <= radius <= self.radius:
            raise ValueError(f"this index serves a radius of 0 to {self.radius}")
        q = queries.select(F.col(id_col).alias("query_id"), F.col(seq_col).alias("query_seq")).dropna().distinct()
        pairs = _met(q, self.refs.distinct(), self.forms, [], self.metric, radius, self.radius)
        return _scoped(pairs, [], radius, options.get("scope", "radius"), options.get("tie", "all"), options.get("exclude_same_id", False))


def probe_metric(texts: DataFrame, seq_col: str, metric: Metric, samples: int = 200, seed: int = 0) -> dict[str, int]:
    """Violations of identity, symmetry and the triangle inequality among at most `samples` texts (a stated bound)."""
    some = texts.select(F.col(seq_col).alias("s")).dropna().distinct().orderBy(F.xxhash64("s", F.lit(seed))).limit(samples)
    numbered = some.withColumn("n", F.row_number().over(Window.orderBy("s")))
    x, y, z = (numbered.select(F.col("s").alias(c), F.col("n").alias(f"n{c}")) for c in "xyz")
    trips = x.join(y, F.col("nx") % samples == (F.col("ny") + 1) % samples).join(z, F.col("nx") % samples == (F.col("nz") + 2) % samples)
    d = trips.select(*(distance(metric, F.col(a), F.col(b)).alias(a + b) for a, b in ("xx", "xy", "yx", "yz", "xz")))
    row = d.agg(
        F.count_if(F.col("xx") != 0).alias("identity"), F.count_if(F.col("xy") != F.col("yx")).alias("symmetry"), F.count_if(F.col("xz") > F.col("xy") + F.col("yz")).alias("triangle")
    ).first()
    return row.asDict()


def assign_unique_best(observed: DataFrame, expected: DataFrame, most: int, seq_col: str = "idx_seq", name_col: str = "idx_name") -> DataFrame:
    """(idx_seq, idx_name, dist): an exact match wins, else the only nearest expected text within `most`; ties stay unassigned (null)."""
    near = distance_join(observed.select(F.col(seq_col).alias("q")), expected, most, scope="min", query=("q", "q"), ref=(name_col, seq_col))
    best = near.groupBy("query_seq").agg(F.count(F.lit(1)).alias("n"), F.min("ref_id").alias("name"), F.min("dist").alias("dist")).filter("n = 1")
    every = observed.select(F.col(seq_col).alias("query_seq")).distinct()
    return every.join(best, "query_seq", "left").select(F.col("query_seq").alias(seq_col), F.col("name").alias(name_col), "dist")
