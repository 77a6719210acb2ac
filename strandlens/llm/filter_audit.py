"""How five filters of a corpus overlap, in every order they could be applied in.

A text is measured once for four conditions.  The fifth, a copy of an earlier
text, is settled by an RDD routed by fingerprint: texts go to the partition of
their xxhash, which keeps a chain of the different texts of each fingerprint
with the smallest id of each, compares them byte for byte and emits the ids that
aren't the smallest.  A map task sends one row for each different text it holds,
and copies it can tell itself travel by their id, so that a text with a third of
all rows is no task's alone.  The conditions a document fails make a mask of
five bits; counts of masks are combined by key as vectors, and all orders are
read off the vector of a part.

Nulls and edge cases: a null text is empty; a null part is the empty name.
Repeated rows are separate rows, and equal texts of one id are no copies of each
other; rows with a null id are copies of nothing and nothing's originals.  A
document labelled twice has a label if one of its rows says so; null labels
count as none.  An empty table gives no rows.  Extra columns are ignored.  Ids
must be whole numbers.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, parts_for, whole_ids

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
LEAST_WORDS = 50
LEAST_DISTINCT_PERCENT = 65
MOST_CAPITALS_PERCENT = 5
#: Fixed: characters of the fourth condition, and what separates words.
MARKS = b"#$%&*|"
SPACES = b"\t\n\x0b\x0c\r "
CAPITALS = bytes(range(65, 91))
#: Bytes of different texts that a map task holds before it sends them on.
HELD_BYTES = 32 << 20
#: Bytes of files whose texts meet in one partition.
PART_BYTES = 8 << 20
#: Documents measured at a time.
ROWS = 64
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20

MEASURED = "doc_id bigint, part string, digest binary, mask int"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
RESULT = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS)
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]


# ------------------------------------------------------------ conditions of one text


def pieces(data: bytes) -> Iterator[bytes]:
    """The text in pieces of about PIECE bytes that begin and end between words."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and data[end] not in SPACES:
            end += 1
        yield data[at:end]
        at = end


def condition_mask(data: bytes, n_chars: int) -> int:
    """Bits of the first four conditions that a text of n_chars code points fails."""
    n, distinct = 0, set()
    for piece in pieces(data):
        words = piece.split()
        n += len(words)
        distinct.update(words)
    capitals = len(data) - len(data.translate(None, CAPITALS))
    failed = (
        n < LEAST_WORDS,
        100 * len(distinct) < LEAST_DISTINCT_PERCENT * n,
        100 * capitals > MOST_CAPITALS_PERCENT * n_chars,
        any(m in data for m in MARKS),
    )
    return sum(1 << i for i, f in enumerate(failed) if f)


def measured(docs: DataFrame) -> DataFrame:
    """One row for each document: its id, part, the digest of its text and the mask of four conditions."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                texts = part.column(1).to_pylist()
                rows = [(hashlib.sha256(data := t.encode()).digest(), condition_mask(data, len(t))) for t in texts]
                yield pa.record_batch([part.column(0), part.column(2), pa.array([d for d, _ in rows], pa.binary()), pa.array([m for _, m in rows], pa.int32())], names=["doc_id", "part", "digest", "mask"])

    return docs.select("doc_id", "text", "part").mapInArrow(run, MEASURED)


# ------------------------------------------------------------ copies, routed by fingerprint


def route(doc_id: int) -> int:
    """Where the id of a known copy travels: anywhere, evenly."""
    return xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True))


class Chains:
    """The different texts of some fingerprints, each with the smallest id so far.  Texts of one fingerprint form a chain and are told apart by their bytes."""

    def __init__(self) -> None:
        self.chains: dict[int, list[list]] = {}
        self.held = 0

    def add(self, fingerprint: int, text: bytes, doc_id: int) -> int | None:
        """Takes a text; the id that is now known not to be the smallest of its text, if there is one."""
        chain = self.chains.setdefault(fingerprint, [])
        for link in chain:
            if link[0] == text:
                least, most = min(link[1], doc_id), max(link[1], doc_id)
                link[1] = least
                return most if most > least else None
        chain.append([text, doc_id])
        self.held += len(text)
        return None

    def each(self) -> Iterator[tuple[int, bytes, int]]:
        for fingerprint, chain in self.chains.items():
            for text, doc_id in chain:
                yield fingerprint, text, doc_id


def sent(rows: Iterable) -> Iterator[tuple[int, tuple]]:
    """Map side: (fingerprint, (text, smallest id)) of each different text, (any key, (digest, id)) of each known copy."""
    chains = Chains()
    for row in rows:
        text = (row.text or "").encode()
        copy = chains.add(xxhash.xxh64_intdigest(text), text, row.doc_id)
        if copy is not None:
            yield route(copy), (None, hashlib.sha256(text).digest(), copy)
        if chains.held > HELD_BYTES:
            yield from ((f, (t, None, i)) for f, t, i in chains.each())
            chains = Chains()
    yield from ((f, (t, None, i)) for f, t, i in chains.each())


def copies(rows: Iterable[tuple[int, tuple]]) -> Iterator[tuple[int, bytearray]]:
    """Reduce side: (id, digest of its text) of every document that an equal text of a smaller id precedes."""
    chains = Chains()
    for fingerprint, (text, digest, doc_id) in rows:
        if text is None:
            yield doc_id, bytearray(digest)
            continue
        copy = chains.add(fingerprint, text, doc_id)
        if copy is not None:
            yield copy, bytearray(hashlib.sha256(text).digest())


def copied_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of the copies among docs(doc_id, text), each once."""
    rows = docs.filter("doc_id IS NOT NULL").select("doc_id", "text")
    routed = rows.rdd.mapPartitions(sent).partitionBy(parts_for(docs, PART_BYTES), lambda k: k)
    return docs.sparkSession.createDataFrame(routed.mapPartitions(copies), "doc_id bigint, digest binary", verifySchema=False).distinct()


# ------------------------------------------------------------ orders


def order_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each order and step (rows) and mask (columns): is it kept after the step, removed there, failing but removed before, or failing this filter only."""
    masks = np.arange(1 << len(FILTERS))
    kept, removed, redundant, only = [], [], [], []
    for order in ORDERS:
        before = 0
        for f in order:
            bit = 1 << FILTERS.index(f)
            gone, fails = masks & before != 0, masks & bit != 0
            kept.append(~gone & ~fails)
            removed.append(~gone & fails)
            redundant.append(gone & fails)
            only.append(masks == bit)
            before |= bit
    return tuple(np.array(t, dtype=np.int64) for t in (kept, removed, redundant, only))


def interactions(rows: Iterable[tuple[str, np.ndarray]]) -> Iterator[tuple]:
    """All orders and steps of each part from its vector: documents of each mask, those labelled good, those labelled toxic."""
    kept, removed, redundant, only = order_tables()
    letters = np.array([FILTERS.index(f) for o in ORDERS for f in o])
    for part, counts in rows:
        every, good, toxic = counts.reshape(3, -1)
        gone = removed @ every
        by_filter = np.array([gone[letters == i].sum() for i in range(len(FILTERS))])
        columns = (kept @ every, gone, redundant @ every, only @ every, removed @ good, removed @ toxic, by_filter[letters])
        for n, values in enumerate(zip(*(c.tolist() for c in columns), strict=True)):
            yield (part, ORDERS[n // len(FILTERS)], n % len(FILTERS) + 1, *values)


def with_row(counts: np.ndarray, row) -> np.ndarray:
    counts[row.mask] += 1
    counts[len(counts) // 3 + row.mask] += row.good
    counts[2 * len(counts) // 3 + row.mask] += row.toxic
    return counts


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a += b
    return a


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every part, order and step."""
    rows = whole_ids(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part")))
    facts = measured(rows)
    copy = copied_ids(rows).withColumn("copy", F.lit(COPY))
    marked = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int").alias("good"), F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int").alias("toxic"))
    marked = marked.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    joined = facts.join(copy, ["doc_id", "digest"], "left").join(marked, "doc_id", "left")
    zero = F.lit(0)
    masks = cut(joined.select("part", (F.col("mask") + F.coalesce("copy", zero)).alias("mask"), F.coalesce("good", zero).alias("good"), F.coalesce("toxic", zero).alias("toxic")), "masks")
    size = 3 << len(FILTERS)
    vectors = masks.rdd.map(lambda r: (r.part, r)).combineByKey(lambda r: with_row(np.zeros(size, dtype=np.int64), r), with_row, merged)
    return docs.sparkSession.createDataFrame(vectors.mapPartitions(interactions), RESULT, verifySchema=False)


def sql() -> str:
    """The same in DuckDB's dialect: every order walked step by step."""
    words = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
    bits = ", ".join(f"('{f}', {1 << i})" for i, f in enumerate(FILTERS))
    return rf"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part, {words} AS w FROM documents),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
firsts AS (SELECT text, min(doc_id) AS least FROM docs GROUP BY 1),
failed AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  (CASE WHEN len(w) < {LEAST_WORDS} THEN 1 ELSE 0 END)
  + (CASE WHEN 100 * len(list_distinct(w)) < {LEAST_DISTINCT_PERCENT} * len(w) THEN 2 ELSE 0 END)
  + (CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > {MOST_CAPITALS_PERCENT} * length(text) THEN 4 ELSE 0 END)
  + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
  + (CASE WHEN doc_id > least THEN 16 ELSE 0 END) AS mask
  FROM docs JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)),
masks AS MATERIALIZED (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY 1, 2),
filters(f, bit) AS (VALUES {bits}),
walks AS (SELECT f AS done, f, bit, 0 AS before, 1 AS step FROM filters
  UNION ALL SELECT walks.done || filters.f, filters.f, filters.bit, walks.before + walks.bit, step + 1 FROM walks JOIN filters ON walks.done NOT LIKE '%' || filters.f || '%'),
orders AS (SELECT done AS filter_order FROM walks WHERE step = {len(FILTERS)}),
steps AS MATERIALIZED (SELECT filter_order, f, bit, before, step FROM orders JOIN walks ON starts_with(filter_order, done)),
counted AS (SELECT part, filter_order, step, f,
  sum(CASE WHEN mask & (before + bit) = 0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
  sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks CROSS JOIN steps GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in COUNTS[:-1])}, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM counted
"""
