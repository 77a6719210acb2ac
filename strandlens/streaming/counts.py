"""Barcode counts of reads that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.counting import count_barcodes
from ..operators.screening import parse_reads, passing
from ..profiles import ReadProfile


def streaming_counts(reads: DataFrame, profile: ReadProfile, least: float = 0.0, mismatches: int = 1) -> DataFrame:
    """idx_seq, bc_seq, bc_count over a stream of reads(seq, qual); counting is the only state, one row for each pair."""
    good = passing(parse_reads(reads, profile, mismatches), least, profile.dual.len_p7 if profile.dual else None)
    return count_barcodes(good)


def start_counts(counts: DataFrame, checkpoint: str, table: str) -> StreamingQuery:
    """Keep a table of the changed counts, in memory, for whoever asks; the whole-run ranks stay batch work."""
    return counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).format("memory").queryName(table).start()
