"""Homomorphic multiset fingerprints of documents, with DataFrame functions only.

A text is the multiset of its paragraphs: pieces that end at line breaks or
sentence ends, long ones cut every ``PIECE`` code points, which together tile
the whole text.  Each piece hashes to a wide vector of 128 lanes of 0/1 and
four 32-bit lanes; a fingerprint is the sum of its pieces' vectors modulo
2**16 and 2**32, with the number of pieces.  Sums commute, so the order of pieces doesn't matter, and
pieces can be added or taken away (`combine`) without reading the rest.

Likeness is the cosine of the 128 lanes, each taken as +1/-1 (an unbiased estimate, with an error
near 1/sqrt(128), of the cosine of the piece counts), floored at 0.  It comes from two fingerprints
alone: a lane's difference of 1 bits and 0 bits is known modulo 2**16 and taken as the nearest to 0.

Nulls and edge cases: a null text is empty; the empty text has the zero vector,
likeness 1 to another empty text and 0 to anything else.  A null id sorts
first.  Ids are of any type with an order.  Repeated rows stay separate rows, ordered by text.  Extra columns are
ignored.  In a table of one row the next document is that row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, id_and_text, parts_for

PIECE = 40
#: Files that one range of ids takes about.
PART_BYTES = 32 << 20
#: Ranges at most, so that their bounds (a number and an id each) can be broadcast.
MOST_RANGES = 1 << 20
#: Runs of enders, or up to PIECE code points and the enders after them.
PIECES = r"[.!?\n]+|[^.!?\n]{1,%d}[.!?\n]*" % PIECE
LANES = 128
#: The number of 32-bit sums beside the lanes.
SUMS = 4
_LOW = 0xFFFFFFFF


def sketch(text: Column) -> Column:
    """The un-wrapped sums of a text: n, then 64 longs that each hold two lanes' counts of 1 bits, then four 32-bit sums.

    All are sums over pieces, so sketches add.  Two lanes share a long (32 bits each); pieces of one text number below 2**31.
    """
    pieces = F.regexp_extract_all(text, F.lit(PIECES), F.lit(0))

    def total(pairs: Column, side: str, shift: int, mask: int) -> Column:
        return F.aggregate(pairs, F.lit(0).cast("long"), lambda acc, p: acc + F.shiftrightunsigned(p[side], shift).bitwiseAND(F.lit(mask)))

    def of(pairs: Column) -> Column:
        bits = [total(pairs, side, j, 0x0000000100000001) for side in ("a", "b") for j in range(32)]
        sums = [total(pairs, side, j, _LOW) for side in ("a", "b") for j in (0, 32)]
        return F.array(F.size(pairs).cast("long"), *bits, *sums)

    pairs = F.transform(pieces, lambda p: F.struct(F.xxhash64(p).alias("a"), F.xxhash64(p, F.lit(1)).alias("b")))
    # a one-element array and transform evaluate the pairs once for all lanes
    return F.element_at(F.transform(F.array(pairs), of), 1)


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The sketch of a's pieces with b's pieces added (or, with sign -1, removed)."""
    return F.zip_with(a, b, lambda x, y: x + F.lit(sign) * y)


def wrapped(sketched: Column) -> Column:
    """The fingerprint of a sketch, in its layout: the number of pieces, the counts of 1 bits modulo 2**16, the sums modulo 2**32."""

    def of(s: Column) -> Column:
        counts = F.transform(F.slice(s, 2, 64), lambda x: x.bitwiseAND(F.lit(0x0000FFFF0000FFFF)))
        sums = F.transform(F.slice(s, 66, SUMS), lambda x: x.bitwiseAND(F.lit(_LOW)))
        return F.concat(F.slice(s, 1, 1), counts, sums)

    return F.element_at(F.transform(F.array(sketched), of), 1)  # evaluates the sketch once


def lanes(print_: Column) -> Column:
    """The 128 signed lanes of a fingerprint: twice the count of 1 bits less the number of pieces, modulo 2**16 from -2**15 on."""

    def signed(count: Column) -> Column:
        return (count * 2 - print_[0] + 0x8000).bitwiseAND(F.lit(0xFFFF)) - 0x8000

    packed = F.slice(print_, 2, 64)
    high = F.transform(packed, lambda x: signed(F.shiftrightunsigned(x, 32)))
    low = F.transform(packed, lambda x: signed(x.bitwiseAND(F.lit(_LOW))))
    return F.concat(low, high)


def text_form(print_: Column) -> Column:
    """A fingerprint as text: the number of pieces, the counts of 1 bits (four lanes to a number), the sums."""
    wide = F.zip_with(F.slice(print_, 2, 32), F.slice(print_, 34, 32), lambda x, y: x.bitwiseOR(F.shiftleft(y, 16)))
    return F.array_join(F.concat(F.slice(print_, 1, 1), wide, F.slice(print_, 66, SUMS)).cast("array<string>"), ",")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1, from two fingerprints alone; 1 where they are equal."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: (p * q).cast("double")), F.lit(0.0), lambda acc, v: acc + v)

    def of(x: Column) -> Column:
        both = F.struct(dot(x["a"], x["b"]).alias("ab"), dot(x["a"], x["a"]).alias("aa"), dot(x["b"], x["b"]).alias("bb"))
        return F.element_at(F.transform(F.array(both), cosine), 1)

    def cosine(x: Column) -> Column:
        norm = F.sqrt(x["aa"] * x["bb"])
        return F.when(norm > 0, x["ab"] / norm).otherwise(F.lit(0.0))

    # one-element arrays: the lanes, then the products, are evaluated once
    near = F.element_at(F.transform(F.array(F.struct(lanes(a).alias("a"), lanes(b).alias("b"))), of), 1)
    return F.when(a == b, F.lit(1.0)).otherwise(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), near)), 6))


def bounds(rows: DataFrame, order: str, parts: int) -> DataFrame:
    """bound_, the first value of each of up to ``parts`` ranges of ``order`` (nulls first), and n_, how many bounds that aren't null go up to it.

    Only the order's own column is dealt to ranges; the table is written, so that a lost executor can't move a bound.
    """
    dealt = rows.select(F.col(order).alias("bound_")).repartitionByRange(min(parts, MOST_RANGES), F.col("bound_").asc_nulls_first())
    firsts = dealt.groupBy(F.spark_partition_id().alias("range_")).agg(F.min(F.struct("bound_"))["bound_"].alias("bound_"))
    # one row for each range, MOST_RANGES at most
    upto = Window.orderBy(F.col("bound_").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cut(firsts.select("bound_", F.count("bound_").over(upto).alias("n_")), "ranges")


def placed(rows: DataFrame, order: str, firsts: DataFrame) -> DataFrame:
    """rows with bucket_: how many bounds that aren't null are at most the row's value; 0 for a null.

    Two steps, each among the square root of all bounds (1,024 at most): those that begin a stretch of bounds reach the
    driver, the stretches are broadcast.
    """
    known = firsts.filter("bound_ IS NOT NULL")
    count = known.count()
    if not count:
        return rows.withColumn("bucket_", F.lit(0))
    step = math.isqrt(count - 1) + 1
    stretches = known.groupBy(F.floor((F.col("n_") - 1) / step).cast("int").alias("stretch_")).agg(F.sort_array(F.collect_list("bound_")).alias("inner_"))
    starts = F.lit([r[0] for r in stretches.orderBy("stretch_").select(F.element_at("inner_", 1)).collect()])
    value = F.col(order)
    stretch = F.greatest(F.size(F.filter(starts, lambda s: s <= value)) - 1, F.lit(0))
    found = rows.withColumn("stretch_", stretch).join(F.broadcast(stretches), "stretch_")
    return found.select(*rows.columns, (F.col("stretch_") * step + F.size(F.filter("inner_", lambda s: s <= value))).alias("bucket_"))


def with_next(rows: DataFrame, order: str, tie: str, derived: dict[str, Column], parts: int) -> DataFrame:
    """Adds the derived columns, and for these and the tie column ``next_<c>``: that of the next row by (order, tie), after the last the first's.

    Rows are put in about ``parts`` ranges of ``order``, each a window partition; the first row of every range is added to
    the range before it and dropped again.  Rows with one value of ``order`` are in one range, which Spark sorts on disk
    where it is large.
    """
    firsts = bounds(rows, order, parts)
    spot = placed(rows, order, firsts)
    ahead = Window.orderBy("n_")  # one row for each range
    before = F.coalesce(F.lag("n_").over(ahead), F.max("n_").over(ahead.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    # a number and a value for each of at most MOST_RANGES ranges
    links = firsts.select(before.cast("int").alias("bucket_"), F.col("bound_").alias("head_"))
    heads = rows.join(F.broadcast(links), F.col(order).eqNullSafe(F.col("head_"))).groupBy("bucket_").agg(F.min_by(F.struct(*rows.columns), tie).alias("row_"))
    both = spot.withColumn("added_", F.lit(False)).unionByName(heads.select("row_.*", "bucket_", F.lit(True).alias("added_"))).withColumns(derived)
    window = Window.partitionBy("bucket_").orderBy("added_", F.col(order).asc_nulls_first(), tie)
    return both.select("*", *(F.lead(c).over(window).alias(f"next_{c}") for c in (tie, *derived))).filter(~F.col("added_")).drop("added_", "bucket_")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The fingerprint of every text and of its edited text (its last quarter replaced from the next document), and their likeness."""
    whole = id_and_text(docs, id_col, text_col)
    rows = with_next(whole, "doc_id", "text", {"print": wrapped(sketch(F.col("text")))}, parts_for(whole, PART_BYTES))
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("next_text"), F.lit(1), quarter))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "print", "next_print")
    rows = rows.withColumn("edited_print", wrapped(sketch(F.col("edited"))))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        text_form(F.col("print")).alias("fingerprint"),
        text_form(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
