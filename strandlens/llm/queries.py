"""The queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import centroids, filter_audit, mixing, passages, toxicity
from .bytebpe import round_trip
from .fingerprints import fingerprint_edits
from .main_text import extract
from .neardup import near_duplicates
from .secret_scan import find_secrets
from .shared import cut, documents
from .sql import oracle_sql  # noqa: F401
from .substrings import without_repeats
from .telephony import describe_media, encode_payloads
from .tokenfiles import read_token_files, write_token_files


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), words=3, percent=85)


def op4_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(documents(spark, sf_dir))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=2, specials=True))


def op6_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_of(documents(spark, sf_dir))


def op7_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_media(cut(encode_payloads(documents(spark, sf_dir)), "media"))


def op8_passage_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return passages.score(docs, passages.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir), words=20)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OPERATORS = (op1_secret_scan, op2_toxicity, op3_near_duplicates, op4_multiset_fingerprint, op5_token_files, op6_temperature_mixing, op7_telephony, op8_passage_quality, op9_repeated_passages, op10_byte_bpe, op11_centroid_clusters, op12_main_text, op13_filter_audit)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}
