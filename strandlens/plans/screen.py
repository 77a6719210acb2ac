"""Screen mode: the read structures and stocks a whole run consists of."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import screening
from ..profiles import ReadProfile, screen_profiles


@dataclass(frozen=True)
class ScreenSettings:
    mean_quality: float = 0.0
    anchor_mismatches: int = 1
    stock_distance: int = 0

    def __post_init__(self) -> None:
        if self.stock_distance < 0:
            raise ValueError("distance can't be negative")


@dataclass
class ScreenedRun:
    summary: DataFrame
    profiles: DataFrame
    stocks: DataFrame
    ambiguous: DataFrame
    barcodes: DataFrame
    ambiguous_barcodes: DataFrame


def screen_run(reads: DataFrame, refs: DataFrame, settings: ScreenSettings = ScreenSettings(), profiles: Sequence[ReadProfile] | None = None) -> ScreenedRun:
    """refs: profile, stock, ref_name, ref_seq.  Reads are read once; everything after is over distinct barcodes."""
    hits = screening.classify(reads, profiles or screen_profiles(), settings.mean_quality, settings.anchor_mismatches)
    found = screening.resolve(hits, refs, settings.stock_distance)
    total = screening._total(found)
    return ScreenedRun(
        screening.summary(found),
        screening.profile_counts(found, total),
        screening.stock_counts(found, total),
        screening.ambiguous_counts(found, total),
        screening.named_barcodes(found, total),
        screening.named_barcodes(found, total, ambiguous=True),
    )
