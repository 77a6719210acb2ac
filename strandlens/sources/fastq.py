"""FASTQ files as a Spark data source.

``spark.read.format("fastq").load(path)`` gives header, seq, plus and qual.
Plain files are read in byte ranges: a range begins at the first place where
four lines look like a record (a header, a line, a '+', and a quality line as
long as the sequence), since '@' may begin a quality line too.  Gzipped files made
of blocks (members that say how long they are, at most 64 KB each) are read in
ranges too: a range begins at the first block whose header leads to another one.
Other files ending in ``.gz`` can't be entered in the middle and are one partition
each.  `write_fastq` writes files of blocks.

Files must be reachable by the executors as paths.  `read_fastq_text` reads
plain or gzipped files from any store that Spark reads, one task per file where
they are gzipped.
"""

from __future__ import annotations

import glob
import gzip
import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "header string, seq string, plus string, qual string"
RANGE_BYTES = 64 << 20
#: Tasks that a read has at most: small ranges of large files are read several by a task, since every task costs the driver its planning.
MOST_TASKS = 2000
#: Bytes parsed at a time; a record is never longer than what is held of the file.
BLOCK_BYTES = 8 << 20
NAMES = ["header", "seq", "plus", "qual"]
#: About how many bytes of text a byte of a gzipped file holds.
PACKED = 4
#: A block of a gzipped file with its header, at most, and the text that goes into one.
MOST_BLOCK = 1 << 16
BLOCK_TEXT = 0xFF00
#: Fixed: how a gzip member with extra fields begins, and the empty block that ends a file.
MEMBER = b"\x1f\x8b\x08\x04"
LAST_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


@dataclass
class FastqRange(InputPartition):
    path: str
    start: int
    end: int
    blocked: bool = False


@dataclass
class FastqRanges(InputPartition):
    """Neighbouring ranges that one task reads."""

    ranges: list[FastqRange]


def dealt(ranges: list[FastqRange]) -> list[FastqRanges]:
    """Ranges as at most MOST_TASKS partitions, each of as many neighbouring ones as that takes."""
    each = max(1, -(-len(ranges) // MOST_TASKS))
    return [FastqRanges(ranges[i : i + each]) for i in range(0, len(ranges), each)]


def paths_of(path: str) -> list[str]:
    """The files of a path: a file, a pattern, or a folder's *.fastq, *.fq and their gzipped forms."""
    path = path.removeprefix("file://")
    if os.path.isdir(path):
        return sorted(os.path.join(path, f) for f in os.listdir(path) if f.endswith((".fastq", ".fq", ".fastq.gz", ".fq.gz")))
    return sorted(glob.glob(path)) if glob.has_magic(path) else [path]


def ranges_of(path: str, size: int = RANGE_BYTES) -> list[FastqRange]:
    found = []
    for p in paths_of(path):
        n = os.path.getsize(p)
        blocked = p.endswith(".gz") and is_blocked(p)
        step = max(1, size // PACKED) if blocked else n if p.endswith(".gz") else size
        found += [FastqRange(p, a, min(n, a + step), blocked) for a in range(0, n, max(1, step))]
    return found


def block_size(head: bytes) -> int | None:
    """The size of the block that begins with these bytes, as the field BC of its header has it; None if they don't begin one."""
    if head[:4] != MEMBER or len(head) < 18:
        return None
    at, end = 12, 12 + struct.unpack_from("<H", head, 10)[0]
    while at + 4 <= min(end, len(head)):
        name, size = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if name == b"BC" and size == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return None


def is_blocked(path: str) -> bool:
    with open(path, "rb") as f:
        return block_size(f.read(64)) is not None


def first_block(f, start: int, size: int) -> int:
    """Where the first block that begins at or after start begins; the file's size if none does."""
    if start == 0 or start >= size:
        return min(start, size)
    f.seek(start)
    near = f.read(2 * MOST_BLOCK)
    at = near.find(MEMBER)
    while at >= 0:
        n = block_size(near[at : at + 64])
        if n:  # bytes of a block may look like a header: a real one leads to another, or to the end
            f.seek(start + at + n)
            if start + at + n == size or block_size(f.read(64)):
                return start + at
        at = near.find(MEMBER, at + 1)
    return size


def blocks_from(f, start: int) -> Iterator[tuple[int, bytes]]:
    """(where it begins, text) of the blocks from one on."""
    at = start
    while True:
        f.seek(at)
        raw = f.read(MOST_BLOCK)
        if not raw:
            return
        n = block_size(raw[:64])
        if not n or n > len(raw):
            raise ValueError(f"{f.name} isn't made of blocks at byte {at}")
        yield at, zlib.decompress(raw[:n], 31)
        at += n


def _shape(lines: list[bytes]) -> int | None:
    """The number of the first line that begins a record."""
    return next((k for k in range(len(lines) - 3) if lines[k][:1] == b"@" and lines[k + 2][:1] == b"+" and len(lines[k + 1]) == len(lines[k + 3])), None)


def read_blocks(part: FastqRange) -> Iterator[pa.RecordBatch]:
    """The records of a range of blocks.

    As with ranges of lines elsewhere, a range that isn't the first leaves out the line it begins in, and reads on to the end of
    the record that begins at its own end or before: so each record is read once, wherever blocks cut it.
    """
    with open(part.path, "rb") as f:
        size = os.path.getsize(part.path)
        start, stop = first_block(f, part.start, size), first_block(f, part.end, size)
        if start >= stop:
            return
        # held: text not yet given out; at: its place in the text of the range; end: where the text of the next range begins
        held, at, end, whole, synced = b"", 0, None, 0, start == 0
        for place, text in _with_end(blocks_from(f, start)):
            if end is None and (place is None or place >= stop):
                end = whole
            closing = place is None
            whole += len(text)
            held += text
            if closing and held and not held.endswith(b"\n"):
                held += b"\n"
            if not closing and len(held) < (BLOCK_BYTES if end is None and synced else MOST_BLOCK):
                continue
            if not synced:
                lines = held.split(b"\n")
                if len(lines) < 10 and not closing:
                    continue
                k = _shape([x.rstrip(b"\r") for x in lines[1:9]])
                if k is None:
                    if closing:
                        return
                    raise ValueError(f"{part.path} has no record near byte {part.start}")
                skipped = sum(len(x) + 1 for x in lines[: k + 1])
                held, at, synced = held[skipped:], at + skipped, True
            ends = np.flatnonzero(np.frombuffer(held, dtype=np.uint8) == 10) + 1
            n = len(ends) // 4
            if end is not None:  # records that begin after the end are the next range's
                n = int((np.concatenate(([0], ends[3::4]))[:n] + at <= end).sum())
            used = int(ends[4 * n - 1]) if n else 0
            if held[:used].strip():
                yield records_of(held[:used], n)
            held, at = held[used:], at + used
            if end is not None and at > end:
                return
            if closing and held.strip():
                raise ValueError(f"{part.path} ends inside a record")


def _with_end(blocks: Iterator[tuple[int, bytes]]) -> Iterator[tuple[int | None, bytes]]:
    yield from blocks
    yield None, b""


def block_of(text: bytes) -> bytes:
    """One block of a gzipped file."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(text) + packer.flush()
    head = MEMBER + bytes(5) + b"\xff" + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(text), len(text))


def write_fastq(df: DataFrame, folder: str) -> list[str]:
    """Writes header, seq, plus (or '+') and qual as a gzipped file of blocks for each partition; the names of the files.

    The folder must be reachable by the executors as a path.  A task that is run again replaces its file.
    """
    plus = F.col("plus") if "plus" in df.columns else F.lit("+")
    lines = df.select(F.concat(F.concat_ws("\n", "header", "seq", plus, "qual"), F.lit("\n")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name = os.path.join(folder, f"part-{TaskContext.get().partitionId():05d}.fastq.gz")
        os.makedirs(folder, exist_ok=True)
        own = f"{name}.{TaskContext.get().taskAttemptId()}"
        with open(own, "wb") as f:
            held = b""
            for batch in batches:
                held += "".join(batch.column(0).to_pylist()).encode()
                while len(held) >= BLOCK_TEXT:
                    f.write(block_of(held[:BLOCK_TEXT]))
                    held = held[BLOCK_TEXT:]
            f.write((block_of(held) if held else b"") + LAST_BLOCK)
        os.replace(own, name)
        yield pa.record_batch([pa.array([name])], names=["name"])

    return sorted(r["name"] for r in lines.mapInArrow(run, "name string").collect())  # one name for each partition


def _resync(f, start: int) -> int:
    """Where the first record that begins at or after `start` begins."""
    if start == 0:
        return 0
    f.seek(start - 1)
    if f.read(1) != b"\n":
        f.readline()
    at = f.tell()
    lines, places = [], []
    while len(lines) < 8:
        places.append(f.tell())
        line = f.readline()
        if not line:
            break
        lines.append(line.rstrip(b"\r\n"))
    for k in range(min(4, max(0, len(lines) - 3))):
        if lines[k][:1] == b"@" and lines[k + 2][:1] == b"+" and len(lines[k + 1]) == len(lines[k + 3]):
            return places[k]
    return at if not lines else places[-1] + len(lines[-1]) if len(lines) < 4 else at


def records_of(buffer: bytes, n: int) -> pa.RecordBatch:
    """The first n records of a buffer of whole lines, as columns, without a Python object for each."""
    data = np.frombuffer(buffer, dtype=np.uint8)
    ends = np.flatnonzero(data == 10)[: 4 * n] + 1
    offsets = pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32).tobytes())
    lines = pa.StringArray.from_buffers(len(ends), offsets, pa.py_buffer(buffer))
    lines = pc.utf8_rtrim(lines, characters="\r\n")
    return pa.RecordBatch.from_arrays([lines.take(pa.array(np.arange(k, 4 * n, 4))) for k in range(4)], NAMES)


def read_range(part: FastqRange) -> Iterator[pa.RecordBatch]:
    """The records that begin in a range, block by block; a record cut off by the file's end raises."""
    if part.blocked:
        yield from read_blocks(part)
        return
    packed = part.path.endswith(".gz")
    with gzip.open(part.path, "rb") if packed else open(part.path, "rb") as f:
        at = 0 if packed else _resync(f, part.start)
        if not packed:
            f.seek(at)
        held = b""
        while packed or at < part.end:
            block = f.read(BLOCK_BYTES)
            held += block if block or not held or held.endswith(b"\n") else b"\n"
            ends = np.flatnonzero(np.frombuffer(held, dtype=np.uint8) == 10) + 1
            n = len(ends) // 4
            if not packed:  # records that begin after the range are the next one's
                n = min(n, 1 + int(np.searchsorted(ends[3::4], part.end - at)))
            if not block and held[int(ends[4 * n - 1]) if n else 0 :].strip() and n == len(ends) // 4:
                raise ValueError(f"{part.path} ends inside a record")
            if n:
                size = int(ends[4 * n - 1])
                if held[:size].strip():
                    yield records_of(held[:size], n)
                held, at = held[size:], at + size
            if not block:
                return


class FastqReader(DataSourceReader):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size

    def partitions(self) -> list[InputPartition]:
        return dealt(ranges_of(self.path, self.size))

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for part in partition.ranges:
            yield from read_range(part)


class FastqSource(DataSource):
    """Options: path, and rangebytes (how much of a plain file a partition reads)."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FastqReader(self.options["path"], int(self.options.get("rangebytes", RANGE_BYTES)))


def read_fastq(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(FastqSource)
    reader = spark.read.format("fastq")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def read_fastq_text(spark: SparkSession, path: str) -> DataFrame:
    """The same from any store that Spark reads, split by split, as far as the files' form can be split.

    A split finds its first record by its shape, as ranges do.  What precedes that, and what follows its last whole record,
    are a few lines; these edges of a file's neighbouring splits are joined in order.  A file that ends inside a record
    raises.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))

    def batch_of(key: tuple[str, int], edges: list[tuple[int, list[str]]], records: list[str]) -> pa.RecordBatch:
        """Edges (which, lines) and the lines of whole records of a split as rows."""
        m, n = len(edges), len(records) // 4
        columns = [pa.repeat(pa.scalar(key[0], pa.string()), m + n), pa.repeat(pa.scalar(key[1], pa.int64()), m + n)]
        columns += [pa.array([e[0] for e in edges] + [None] * n, pa.int32()), pa.array([e[1] for e in edges] + [None] * n, pa.list_(pa.string()))]
        columns += [pa.array([None] * m + records[k::4], pa.string()) for k in range(4)]
        return pa.RecordBatch.from_arrays(columns, ["file", "start", "edge", "lines", *NAMES])

    def split(key: tuple[str, int], opening: bool, lines: list[str], closing: bool, wanted: bool) -> tuple[pa.RecordBatch, list[str]]:
        """(edges or records, lines held back) of a split's next lines; an opening has an edge before its records and a closing one after them."""
        edges, at = [], 0
        if opening and key[1] > 0:
            at = next((k for k in range(len(lines) - 3) if lines[k][:1] == "@" and lines[k + 2][:1] == "+" and len(lines[k + 1]) == len(lines[k + 3])), len(lines))
            edges.append((0, lines[:at]))
        end = at + (len(lines) - at) // 4 * 4
        if closing:
            edges.append((1, lines[end:]))
        return batch_of(key, *((edges, []) if wanted else ([], lines[at:end]))), lines[end:]

    def run(batches: Iterator[pa.RecordBatch], edges: bool) -> Iterator[pa.RecordBatch]:
        now, held, opening = None, [], True
        for batch in batches:
            if not len(batch):
                continue
            # splits follow each other: their places are looked at as columns, not line by line
            files, starts = batch.column("file").dictionary_encode(), batch.column("start").to_numpy()
            codes = files.indices.to_numpy()
            cuts = [0, *(np.flatnonzero((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])) + 1).tolist(), len(batch)]
            texts = pc.utf8_rtrim(batch.column("value"), characters="\r").to_pylist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                key = (files.dictionary[codes[a]].as_py(), int(starts[a]))
                if key != now:
                    if now is not None:
                        yield split(now, opening, held, True, edges)[0]
                    now, held, opening = key, [], True
                held += texts[a:b]
                if len(held) > 64:  # enough to find a record in
                    rows, held = split(now, opening, held, False, edges)
                    opening = False
                    yield rows
        if now is not None:
            yield split(now, opening, held, True, edges)[0]

    def passed(edges: bool) -> DataFrame:
        return lines.mapInArrow(lambda batches: run(batches, edges), "file string, start long, edge int, lines array<string>, header string, seq string, plus string, qual string")

    # a few lines of each split: the table of edges is small beside the reads, and a file's edges are put in order
    edges = passed(True).groupBy("file").agg(F.array_sort(F.collect_list(F.struct("start", "edge", "lines"))).alias("edges"))
    joined = edges.select(F.flatten(F.transform("edges", lambda e: e["lines"])).alias("lines"))
    joined = joined.withColumn("lines", F.filter("lines", lambda x: F.trim(x) != "")).withColumn("n", F.size("lines"))
    bad = F.when(F.col("n") % 4 != 0, F.raise_error(F.lit("a file ends inside a record"))).otherwise(F.col("n")).cast("int")
    starts = F.when(bad > 0, F.sequence(F.lit(1), F.greatest(bad, F.lit(1)), F.lit(4))).otherwise(F.array().cast("array<int>"))
    pieced = joined.select("lines", F.explode(starts).alias("i")).select(*(F.element_at("lines", F.col("i") + k).alias(c) for k, c in enumerate(NAMES)))
    return passed(False).select(*NAMES).unionByName(pieced)
