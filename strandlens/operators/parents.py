"""Putative parents: the barcode a rarer, similar one probably came from."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.reads import substitution_suffix, windows
from ..session import stored
from .distance import distance_join
from .flags import is_unique

#: What an infinite or unknown input counts as when counts are adjusted.
OPEN_INPUT = 10.0
#: Rows that are compared at a time, on average: as many whole cells as hold them.
CELL_ROWS = 1 << 16
#: Buckets of groups whose rows are counted, to find those that may be too large for one cell.
BUCKETS = 1 << 16
#: Odd numbers that tell places, lengths and kinds of a hash apart; what meets by a hash is compared.
BASE, PLACE, LENGTH = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
Suffix = Callable[[Column, Column], Column]


def adjusted_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, bc_name, bc_seq, bc_count: ceil(proportion * input) summed over samples."""
    known = F.col("input").isNotNull() & ~F.isnan("input") & (F.col("input") != float("inf"))
    part = F.ceil(F.col("proportion") * F.when(known, F.col("input")).otherwise(F.lit(OPEN_INPUT))).cast("long")
    return df.groupBy(*keys, "bc_name", "bc_seq").agg(F.sum(part).alias("bc_count"))


def select_parents(hits: DataFrame, keys: Sequence[str], higher: bool, suffix: Suffix) -> DataFrame:
    """(keys, bc_name, parent): of hits(keys, name, seq, count, ref_name, ref_seq, ref_count) the reference with the
    largest count, ties by its sequence; never the barcode's own name, and with `higher` only one with a larger count."""
    fit = hits.filter(F.col("ref_name") != F.col("name"))
    if higher:
        fit = fit.filter(F.col("ref_count") > F.col("count"))
    first = Window.partitionBy(*keys, "name", "seq").orderBy(F.col("ref_count").desc(), "ref_seq", "ref_name")
    best = fit.withColumn("rank_", F.row_number().over(first)).filter("rank_ = 1")
    text = F.concat("ref_name", F.lit("_"), suffix(F.col("ref_seq"), F.col("seq")))
    best = best.select(*keys, "name", "seq", "count", text.alias("parent"))
    # a name with several sequences gets the parent of its most frequent one
    one = Window.partitionBy(*keys, "name").orderBy(F.col("count").desc(), "seq")
    return best.withColumn("rank_", F.row_number().over(one)).filter("rank_ = 1").select(*keys, F.col("name").alias("bc_name"), "parent")


def _cells(seq: Column) -> Column:
    """The beginnings and ends of a text of which two texts within one edit have one in common: an edit is behind the beginning or before the end."""
    n = F.length(seq)

    def parts(m: Column) -> Column:
        # of the shorter text's length; neighbouring lengths have the same ones as often as they can
        first = (F.floor(m / 4) * 2).cast("int")
        last = (F.floor((m - first) / 2) * 2).cast("int")
        return F.array(F.concat(F.lit("<"), F.substring(seq, F.lit(1), first)), F.concat(F.lit(">"), F.substring(seq, n - last + 1, last)))

    return F.array_distinct(F.concat(parts(F.greatest(n - 1, F.lit(0))), parts(n)))


def _best_in_cells(rows: pa.Table, keys: Sequence[str], core: int | None = None) -> pa.Table:
    """Of whole cells the rows that have a reference within one edit in their cell, each with the best of these.

    core: not the barcodes are compared but the texts in `part_`, of which a row that is no reference has every window of so many bases.
    """
    ref = rows["ref_"].to_numpy()
    if core is None:
        texts, source = rows["bc_seq"].to_pylist(), np.arange(len(ref))
    else:
        cut = [[t] if r else [t[i : i + core] for i in range(len(t) - core + 1)] for t, r in zip(rows["part_"].to_pylist(), ref, strict=True)]
        texts, source = [t for some in cut for t in some], np.repeat(np.arange(len(ref)), [len(some) for some in cut])
    seqs = np.array(texts, dtype=str)
    width = seqs.dtype.itemsize // 4
    text, n = seqs.view(np.uint32).reshape(len(seqs), width), pc.utf8_length(pa.array(texts, pa.string())).to_numpy()
    key = np.zeros(len(ref), dtype=np.int64)
    for k in keys:
        codes = pc.dictionary_encode(rows[k].combine_chunks(), null_encoding="encode")
        key = key * (len(codes.dictionary) + 1) + codes.indices.to_numpy()
    name = pc.dictionary_encode(rows["bc_name"].combine_chunks()).indices.to_numpy()
    known, count = rows["bc_count"].is_valid().to_numpy(), rows["bc_count"].fill_null(np.iinfo(np.int64).min).to_numpy()
    order = pc.sort_indices(rows, [("bc_count", "descending"), ("bc_seq", "ascending"), ("bc_name", "ascending")]).to_numpy()
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    none = len(order)
    best = np.full(len(order), none)
    asked = np.ones(len(ref), dtype=bool) if core is None else ~ref
    ref, asked, key, name, known, count, rank = (x[source] for x in (ref, asked, key, name, known, count, rank))  # of each text

    def noted(q: np.ndarray, r: np.ndarray, same: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> None:
        fit = ref[r] & asked[q] & (rank[r] < best[source[q]]) & (key[q] == key[r]) & (name[q] != name[r]) & (~ref[q] | ((count[r] > count[q]) & known[q]))
        q, r = q[fit], r[fit]
        fit = same(q, r)
        np.minimum.at(best, source[q[fit]], rank[r[fit]])

    def met(asked: np.ndarray, forms: np.ndarray, given: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of equal forms; theirs are sorted."""
        lo, hi = np.searchsorted(theirs, forms, "left"), np.searchsorted(theirs, forms, "right")
        many = hi - lo
        at = np.repeat(lo - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.repeat(asked, many), given[at]

    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(width, BASE, dtype=np.uint64))
        parts = np.where(np.arange(width) < n[:, None], (text.astype(np.uint64) + np.uint64(1)) * powers, np.uint64(0))
        before = np.concatenate([np.zeros((len(n), 1), dtype=np.uint64), np.cumsum(parts, axis=1, dtype=np.uint64)], axis=1)
        whole = before[:, -1]
        cell = rows["cell_"].to_numpy().astype(np.int64).view(np.uint64)[source] * PLACE
        own = whole * BASE + cell + n.astype(np.uint64) * LENGTH
        sorted_ = np.argsort(own)
        for i in range(width):
            # texts that agree but for place i
            has = np.flatnonzero((n > i) | ((n == 0) & (i == 0)))
            forms = (whole - parts[:, i] + cell + n.astype(np.uint64) * LENGTH)[has]
            given = has[ref[has]]
            theirs = forms[ref[has]]
            by = np.argsort(theirs)
            noted(*met(has, forms, given[by], theirs[by]), lambda q, r: (n[q] == n[r]) & ((text[q] != text[r]).sum(axis=1) <= 1))
            # a text without its character at i (the last of its run) is another
            end = np.flatnonzero((n == i + 1) | ((n > i + 1) & (text[:, i] != text[:, min(i + 1, width - 1)])))
            shorter = (before[:, i] * BASE + whole - before[:, i + 1] + cell + (n - 1).astype(np.uint64) * LENGTH)[end]
            long, short = met(end, shorter, sorted_, own[sorted_])

            def without(a: np.ndarray, b: np.ndarray, i: int = i) -> np.ndarray:
                return (n[a] == n[b] + 1) & (text[a, :i] == text[b, :i]).all(axis=1) & (text[a, i + 1 :] == text[b, i : width - 1]).all(axis=1)

            noted(long, short, without)
            noted(short, long, lambda q, r: without(r, q))
    found = np.flatnonzero(best < none)
    refs = order[best[found]]
    ours = [rows[c].take(found) for c in (*keys, "bc_name", "bc_seq", "bc_count")]
    theirs = [rows[c].take(refs) for c in ("bc_name", "bc_seq", "bc_count")]
    return pa.table([*ours, *theirs], names=[*keys, *HIT])


HIT = ("name", "seq", "count", "ref_name", "ref_seq", "ref_count")


def best_references(rows: DataFrame, keys: Sequence[str], whole: bool = False, core: int | None = None, once: bool = False) -> DataFrame:
    """(keys, name, seq, count, ref_name, ref_seq, ref_count): the best reference within one edit of rows(keys, bc_name, bc_seq, bc_count), up to three times.

    Texts within one edit have half a text in common.  Rows go to the cells of their halves, where each keeps the best reference
    it may have: so a row is shuffled three times at most, wherever its group has references, and its neighbours aren't.
    whole: a group with few rows (a sample) is one cell, where each row goes once.  core: rows have `part_` as well, a reference
    its core, the others what windows of so many bases are cut from, and these are compared.  once: a barcode that occurs twice
    counts once, by its largest count.
    """
    keys = list(keys)
    rows = rows.withColumn("ref_", ~is_unique(F.col("bc_name")))
    text = "bc_seq" if core is None else "part_"
    if whole and keys:
        # what a bucket of groups has is known before its rows move; in a full one, groups may be large
        bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
        full = rows.groupBy(bucket.alias("bucket_")).agg(F.count(F.lit(1)).alias("n_")).filter(F.col("n_") > CELL_ROWS).select("bucket_", F.lit(True).alias("full_"))
        rows = rows.withColumn("bucket_", bucket).join(F.broadcast(full), "bucket_", "left").withColumn("full_", F.coalesce("full_", F.lit(False)))  # no more rows than BUCKETS
    else:
        rows = rows.withColumn("full_", F.lit(True))
    if core is not None:
        parts_ = F.when(F.col("full_") & ~F.col("ref_"), F.array_distinct(windows(F.col("part_"), core))).otherwise(F.array("part_"))
        rows = rows.withColumn("part_", F.explode(parts_))
    cell = F.explode(F.when(F.col("full_"), _cells(F.col(text))).otherwise(F.array(F.lit("")))).alias("cell_")
    texts = ["bc_seq"] if core is None else ["bc_seq", "part_"]
    cut = rows.select(*keys, "bc_name", *texts, "bc_count", "ref_", cell)
    # cells are few bytes where their comparisons are many: adaptive execution would make those of all in a few tasks
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = cut.withColumn("cell_", F.xxhash64(*keys, "cell_")).repartition(parts, "cell_")
    if once:  # both are in the same cells, so this needs no shuffle of its own
        cells = cells.groupBy("cell_", *keys, "bc_name", *texts, "ref_").agg(F.max("bc_count").alias("bc_count"))
    cells = cells.sortWithinPartitions("cell_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        many, enough = 0, CELL_ROWS
        for batch in batches:
            held.append(batch)
            many += len(batch)
            if many < enough:
                continue
            table = pa.Table.from_batches(held)
            cell = table["cell_"].to_numpy()
            end = int(np.searchsorted(cell, cell[-1], "left"))  # the last cell may go on
            if end:
                yield from _best_in_cells(table.slice(0, end), keys, core).to_batches()
            held, many = table.slice(end).to_batches(), len(cell) - end
            enough = max(CELL_ROWS, 2 * many)
        if many:
            yield from _best_in_cells(pa.Table.from_batches(held), keys, core).to_batches()

    named = {c: rows.schema[c] for c in rows.columns}
    kinds = [named[k] for k in keys] + [StructField(c, named[f"bc_{c.removeprefix('ref_')}"].dataType) for c in HIT]
    return cells.mapInArrow(run, StructType(kinds))


def flag_parents(
    df: DataFrame,
    keys: Sequence[str] = ("sample_id",),
    radius: int = 1,
    core: tuple[int, int] | None = None,
    aggregated: bool = False,
    out: str = "putative_parent",
    suffix: Suffix = substitution_suffix,
    within: int | None = None,
) -> DataFrame:
    """Adds `out`: parent_suffix of each barcode within its group, null where it has none.

    A named barcode needs a parent with a larger count; a unique one takes its most frequent named neighbour.  With a core
    (start, length), unique barcodes without any neighbour are searched again: every window (of the first `within` bases, if
    that is given) against the references' cores.  suffix: what a parent's name gets, of its sequence and the child's; where
    it is null there is no parent.
    """
    keys = list(keys)
    df = stored(df)  # read for the barcodes, the references and the result
    rows = adjusted_counts(df, keys) if aggregated else df.select(*keys, "bc_name", "bc_seq", "bc_count")
    rows = rows.filter(F.col("bc_name").isNotNull() & F.col("bc_seq").isNotNull())
    unique = is_unique(F.col("name"))
    if radius == 1:
        # a group has most barcodes of all, so most neighbours of each; a sample has few, which meet in one place
        hits = best_references(rows, keys, whole=not aggregated, once=not aggregated)
        hits = hits if core is None else stored(hits)  # read for the parents and for what has none
        parents = select_parents(hits.repartition(*keys, "name"), keys, False, suffix)
    else:
        rows = rows.groupBy(*keys, "bc_name", "bc_seq").agg(F.max("bc_count").alias("bc_count"))
        asked = rows.select(*keys, F.struct("bc_name", "bc_count").alias("q"), "bc_seq")
        given = rows.filter(~is_unique(F.col("bc_name"))).select(*keys, F.struct("bc_name", "bc_count").alias("r"), "bc_seq")
        near = distance_join(asked, given, radius, keys=keys, query=("q", "bc_seq"), ref=("r", "bc_seq"))
        flat = [*keys, F.col("query_id.bc_name").alias("name"), F.col("query_seq").alias("seq"), F.col("query_id.bc_count").alias("count")]
        flat += [F.col("ref_id.bc_name").alias("ref_name"), F.col("ref_seq"), F.col("ref_id.bc_count").alias("ref_count")]
        hits = near.select(*flat)
        parents = select_parents(hits.filter(~unique), keys, True, suffix).unionByName(select_parents(hits.filter(unique), keys, False, suffix))
    if core is not None:
        found = hits.filter(unique).select(*keys, F.col("name").alias("bc_name"), F.col("seq").alias("bc_seq"))
        lone = rows.filter(is_unique(F.col("bc_name"))).join(found, [*keys, "bc_name", "bc_seq"], "left_anti")
        parents = parents.unionByName(core_parents(lone, rows.filter(~is_unique(F.col("bc_name"))), keys, core, within, not aggregated))
    return df.drop(out).join(parents.withColumnRenamed("parent", out), [*keys, "bc_name"], "left")


def core_parents(lone: DataFrame, refs: DataFrame, keys: Sequence[str], core: tuple[int, int], within: int | None = None, whole: bool = False) -> DataFrame:
    """(keys, bc_name, parent): references whose core (0-based start, length) is within one edit of any window of a barcode (of its first `within` bases)."""
    start, length = core
    keys = list(keys)
    seq = F.col("bc_seq")
    asked = lone.withColumn("part_", seq if within is None else F.substring(seq, 1, within)).filter(F.length("part_") >= length)
    given = refs.withColumn("part_", F.substring(seq, start + 1, length)).filter(F.length("part_") > 0)
    hits = best_references(asked.unionByName(given), keys, whole, length, once=True)
    return select_parents(hits.repartition(*keys, "name"), keys, False, lambda parent, child: F.lit("core"))
