"""Gzipped FASTQ made of blocks, read from any byte on."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from strandlens.sources import fastq


def records(rng, n):
    out = []
    for i in range(n):
        size = rng.choice([0, 1, 30, 150]) if i % 50 else 4000
        # qualities may begin with '@' and with '+'
        out.append((f"@r{i} x", "".join(rng.choice("ACGT") for _ in range(size)), "+", "".join(rng.choice("@+I5") for _ in range(size))))
    return out


def blocked(text, size):
    return b"".join(fastq.block_of(text[i : i + size]) for i in range(0, len(text), size)) + fastq.LAST_BLOCK


def read(path, size):
    parts = fastq.ranges_of(str(path), size * fastq.PACKED)
    return parts, [tuple(r.values()) for p in parts for b in fastq.read_range(p) for r in b.to_pylist()]


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("block", [37, 512, 5000, 0xFF00])
def test_each_record_is_read_once_wherever_blocks_cut_it(tmp_path, block, ending):
    rng = random.Random(block)
    rows = records(rng, 300 if block > 100 else 60)
    text = "".join(line + ending for r in rows for line in r).encode()
    path = tmp_path / "a.fastq.gz"
    path.write_bytes(blocked(text, block))
    assert gzip.decompress(path.read_bytes()) == text  # any reader of gzip reads it
    for size in (50, 333, 4096, 100_000, 1 << 30):
        parts, found = read(path, size)
        assert found == rows
        assert len(parts) == max(1, -(-path.stat().st_size // size)) and all(p.blocked for p in parts)


def test_ends_of_files(tmp_path):
    rows = [*records(random.Random(1), 40), ("@z", "ACGT", "+", "IIII")]
    text = "".join(line + "\n" for r in rows for line in r).encode()
    path = tmp_path / "a.fq.gz"
    path.write_bytes(blocked(text[:-1], 700))  # no line end at the end
    assert read(path, 900)[1] == rows
    path.write_bytes(blocked(text[: text.rindex(b"+")], 700))
    with pytest.raises(ValueError, match="inside a record"):
        read(path, 900)
    path.write_bytes(fastq.LAST_BLOCK)
    assert read(path, 900)[1] == []
    plain = tmp_path / "b.fastq.gz"
    plain.write_bytes(gzip.compress(text))
    parts, found = read(plain, 100)
    assert len(parts) == 1 and not parts[0].blocked and found == rows
    assert fastq.block_size(b"\x1f\x8b\x08\x04") is None and fastq.block_size(gzip.compress(b"x")) is None


def test_bytes_that_look_like_a_block(tmp_path):
    """Stored blocks hold a whole file of blocks as their text: headers inside texts lead nowhere."""
    inner = fastq.block_of(b"x" * 50)
    outer = bytearray(fastq.block_of(b"y"))
    assert fastq.block_size(bytes(outer)) == len(outer)
    path = tmp_path / "f"
    path.write_bytes(fastq.block_of(b"a" * 9) + b"".join(fastq.block_of(bytes(random.Random(i).randbytes(200)) + fastq.MEMBER + inner[4:16]) for i in range(5)) + fastq.LAST_BLOCK)
    places, size = [], path.stat().st_size
    with open(path, "rb") as f:
        places = [at for at, _ in fastq.blocks_from(f, 0)]
        for start in range(size):
            assert fastq.first_block(f, start, size) == next((p for p in places if p >= start), size)


def test_written_files_are_read_in_several_partitions(spark, tmp_path):
    df = spark.range(20_000, numPartitions=2).select(F.format_string("@r%d", "id").alias("header"), F.rpad(F.hex(F.hash("id")), 100, "ACGT").alias("seq"), F.rpad(F.hex(F.xxhash64("id")), 100, "I@+").alias("qual"))
    names = fastq.write_fastq(df, str(tmp_path / "out"))
    assert len(names) == 2
    back = fastq.read_fastq(spark, str(tmp_path / "out"), rangebytes=str(1 << 17))
    assert back.rdd.getNumPartitions() >= 4
    assert back.filter("plus = '+'").select("header", "seq", "qual").exceptAll(df).isEmpty() and back.count() == 20_000


def test_many_ranges_are_few_tasks():
    ranges = [fastq.FastqRange("a", i, i + 1) for i in range(3 * fastq.MOST_TASKS + 5)]
    tasks = fastq.dealt(ranges)
    assert len(tasks) <= fastq.MOST_TASKS and [r for t in tasks for r in t.ranges] == ranges
    assert [t.ranges for t in fastq.dealt(ranges[:7])] == [[r] for r in ranges[:7]]


def test_text_form_over_splits_of_all_sizes(spark, tmp_path):
    """Records and edges are two passes, in which every record is found once, wherever files are split."""
    path = tmp_path / "r.fastq"
    n = 400
    path.write_text("".join(f"@r{i}\n{'ACGT' * (i % 9 + 1)}\n+\n{'@+I#' * (i % 9 + 1)}\r\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (700, 3001, 1 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            df = fastq.read_fastq_text(spark, str(path))
            assert "Filter isn" not in df._jdf.queryExecution().optimizedPlan().toString()  # no pass makes rows that it drops
            assert sorted(tuple(r) for r in df.collect()) == sorted((f"@r{i}", "ACGT" * (i % 9 + 1), "+", "@+I#" * (i % 9 + 1)) for i in range(n))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
