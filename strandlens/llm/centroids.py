"""Clustering of integer vectors around k centroids, exact to the last unit.

Vectors are turned into whole numbers and packed in blocks of rows, which are
written once.  Squared distances of a block to all centroids come from the
expansion |x|^2 - 2 x.c + |c|^2 with one matrix product: in float64 (BLAS) where
the largest components bound every term and partial sum below 2^53, so that
nothing is rounded; in 64-bit integers where they bound them below 2^63; in
Python's integers beyond.  Each round sums and counts members by a treeAggregate
over the blocks; only k sums of one vector's size reach the driver.

Nulls and edge cases: vectors that are null, of another size, or hold a null or
a non-finite component are left out.  Rows with a null id are clustered, but
come last among the starting centroids; repeated rows stay separate rows, and
rows of one id start in the order of their components.  With fewer vectors than
k each is a centroid; an empty table gives an empty result.  Extra columns are
ignored.  Ids must be whole numbers.  A distance or inertia that no long can
hold is null.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, whole_ids

#: Rows of a block.
BLOCK = 1024
EXACT_DOUBLE = 1 << 53
EXACT_LONG = 1 << 63
BLOCKS = "ids array<bigint>, kind string, data binary"
RESULT = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


# ------------------------------------------------------------ blocks of integers


def scaled_floor(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles as int64, or as Python's integers where that could overflow or round."""
    most = float(np.abs(values).max(initial=0.0))
    if most * scale < 1 << 52:
        return np.floor(values * scale).astype(np.int64)

    def one(x: float) -> int:
        top, bottom = x.as_integer_ratio()
        return top * scale // bottom

    return np.array([one(x) for x in values.ravel().tolist()], dtype=object).reshape(values.shape)


def packed(values: np.ndarray) -> tuple[str, bytes]:
    """(kind, bytes): the narrowest integers that hold the values, or decimal texts."""
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    for kind in ("<i2", "<i4", "<i8"):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return kind, values.astype(kind).tobytes()
    return "text", ",".join(map(str, values.ravel().tolist())).encode()


def unpacked(kind: str, data: bytes, size: int) -> np.ndarray:
    if kind == "text":
        return np.array([int(x) for x in bytes(data).split(b",")], dtype=object).reshape(-1, size)
    return np.frombuffer(data, dtype=kind).astype(np.int64).reshape(-1, size)


def usable(vectors: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(which of the vectors are kept, their components as a matrix of doubles)."""
    lists = vectors.cast(pa.large_list(pa.float64()))
    offsets = np.asarray(lists.offsets)
    kept = np.asarray(pa.compute.is_valid(lists)) & (np.diff(offsets) == size)
    if not kept.any():
        return kept, np.zeros((0, size))
    whole = np.asarray(lists.values.fill_null(math.nan)) if lists.values.null_count else np.asarray(lists.values)
    values = whole[offsets[:-1][kept][:, None] + np.arange(size)]
    finite = np.isfinite(values).all(axis=1)
    kept[np.flatnonzero(kept)[~finite]] = False
    return kept, values[finite]


def blocks_of(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """Rows (ids, kind, data): up to BLOCK vectors of integers each."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, values = usable(batch.column(1), size)
            ids = batch.column(0).filter(pa.array(kept))
            for lo in range(0, len(ids), BLOCK):
                kind, data = packed(scaled_floor(values[lo : lo + BLOCK], scale))
                part = ids.slice(lo, BLOCK)
                yield pa.record_batch([pa.array([part.to_pylist()], pa.list_(pa.int64())), pa.array([kind]), pa.array([data], pa.binary())], names=["ids", "kind", "data"])

    return vectors.mapInArrow(pack, BLOCKS)


# ------------------------------------------------------------ distances


def largest(values: np.ndarray) -> int:
    return max(int(values.max(initial=0)), -int(values.min(initial=0)))


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to the rows of c, by |x|^2 - 2 x.c + |c|^2."""
    bound = x.shape[1] * (largest(x) + largest(c)) ** 2  # of each term, and of every sum of some of them
    kind = np.float64 if bound < EXACT_DOUBLE else np.int64 if bound < EXACT_LONG else object
    a, b = x.astype(kind), c.astype(kind)
    product = a @ b.T
    out = (a * a).sum(axis=1)[:, None] - 2 * product + (b * b).sum(axis=1)[None, :]
    return out.astype(np.int64) if kind is np.float64 else out


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, the smaller of equals; its squared distance)."""
    d = distances(x, c)
    at = d.argmin(axis=1)
    return at, d[np.arange(len(d)), at]


def added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a + b, in Python's integers where 64 bits could overflow."""
    if a.dtype != object and b.dtype != object and largest(a) + largest(b) < EXACT_LONG:
        return a + b
    return a.astype(object) + b.astype(object)


def members(x: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """For each centroid the sum of its vectors' components and, last, their number."""
    ones = np.concatenate((x, np.ones((len(x), 1), dtype=np.int64)), axis=1)
    out = np.zeros((k, ones.shape[1]), dtype=np.int64)
    if largest(x) * len(x) >= EXACT_LONG or ones.dtype == object:
        out, ones = out.astype(object), ones.astype(object)
    for j in range(k):
        out[j] = ones[at == j].sum(axis=0)
    return out


# ------------------------------------------------------------ rounds


def start(blocks: RDD, k: int, size: int, salt: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of `salt:id`, in its order."""

    def ranked(held: list, row) -> list:
        x = unpacked(row.kind, row.data, size)
        # '~' comes after all hexadecimal digits: null ids are last
        keys = ((hashlib.sha256(b"%d:%d" % (salt, i)).hexdigest() if i is not None else "~", n) for n, i in enumerate(row.ids))
        few = heapq.nsmallest(k, ((key, tuple(x[n].tolist())) for key, n in _firsts(keys, k)))
        return heapq.nsmallest(k, [*held, *few])

    def _firsts(keys: Iterable, k: int) -> list:
        """The k smallest keys and whatever equals the last of them."""
        every = sorted(keys)
        last = every[min(k, len(every)) - 1][0] if every else ""
        return [e for e in every if e[0] <= last]

    found = blocks.treeAggregate([], ranked, lambda a, b: heapq.nsmallest(k, [*a, *b]))
    big = any(abs(v) >= EXACT_LONG for _, vector in found for v in vector)
    return np.array([vector for _, vector in found], dtype=object if big else np.int64).reshape(-1, size)


def moved(blocks: RDD, centroids: np.ndarray) -> np.ndarray:
    """Each centroid replaced by the floor of the mean of its members; without members it stays."""
    k, size = centroids.shape
    here = blocks.context.broadcast(centroids)  # k vectors

    def gather(total: np.ndarray, row) -> np.ndarray:
        x = unpacked(row.kind, row.data, size)
        return added(total, members(x, nearest(x, here.value)[0], k))

    total = blocks.treeAggregate(np.zeros((k, size + 1), dtype=np.int64), gather, added)
    out = [[int(v) // int(row[-1]) for v in row[:-1]] if row[-1] else list(old) for row, old in zip(total.tolist(), centroids.tolist(), strict=True)]
    big = any(abs(v) >= EXACT_LONG for row in out for v in row)
    return np.array(out, dtype=object if big else np.int64)


def inertias(blocks: RDD, centroids: np.ndarray) -> list[int]:
    """The sum of the squared distances of each centroid's members."""
    k, size = centroids.shape
    here = blocks.context.broadcast(centroids)  # k vectors

    def gather(total: list[int], row) -> list[int]:
        at, d = nearest(unpacked(row.kind, row.data, size), here.value)
        if d.dtype != object and largest(d) * len(d) >= EXACT_LONG:
            d = d.astype(object)
        return [t + int(d[at == j].sum()) for j, t in enumerate(total)]

    return blocks.treeAggregate([0] * k, gather, lambda a, b: [x + y for x, y in zip(a, b, strict=True)])


def _long(n: int) -> int | None:
    return n if -EXACT_LONG <= n < EXACT_LONG else None


def clusters(vectors: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64, salt: int = 1, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector after `rounds` rounds."""
    rows = whole_ids(vectors.select(F.col(id_col).alias("doc_id"), F.col(vec_col).cast("array<double>").alias("vec")))
    packed_rows = cut(blocks_of(rows, size, scale), "vectors")
    blocks = packed_rows.rdd
    centroids = start(blocks, k, size, salt)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], RESULT)
    for _ in range(rounds):
        centroids = moved(blocks, centroids)
    sums = inertias(blocks, centroids)
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
    each, whole = [_long(s) for s in sums], _long(sum(sums))

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):  # a block at a time
                row = batch.slice(n, 1).to_pylist()[0]
                at, d = nearest(unpacked(row["kind"], row["data"], size), centroids)
                columns = [
                    pa.array(row["ids"], pa.int64()),
                    pa.array(at, pa.int32()),
                    pa.array([_long(int(v)) for v in d] if d.dtype == object else d, pa.int64()),
                    pa.array([each[j] for j in at], pa.int64()),
                    pa.array([whole] * len(at), pa.int64()),
                    pa.array([digests[j] for j in at]),
                ]
                yield pa.record_batch(columns, names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return packed_rows.mapInArrow(assign, RESULT)


def sql(k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64, salt: int = 1) -> str:
    """The same in DuckDB's dialect, by differences of components."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS HUGEINT)) AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS c, v AS m FROM (SELECT sha256('{salt}:' || vec_id) AS h, v FROM kept ORDER BY h NULLS LAST, v LIMIT {k}))"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""d{i} AS (SELECT r, vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM kept CROSS JOIN c{i}),
a{i} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, arg_min(c, (d, c)) AS c, min(d) AS d FROM d{i} GROUP BY r)""")
        if i < rounds:
            steps.append(f"""u{i} AS (SELECT c, j, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{i}) GROUP BY 1, 2),
n{i} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS m FROM u{i} GROUP BY 1),
c{i + 1} AS MATERIALIZED (SELECT c0.c, coalesce(n.m, o.m) AS m FROM c0 JOIN c{i} o USING (c) LEFT JOIN n{i} n USING (c))""")
    last = rounds
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(m, lambda x: CAST(x AS VARCHAR)), ',')) AS centroid_sha256
FROM a{last} a JOIN c{last} USING (c)"""
