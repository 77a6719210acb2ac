"""A training-data pipeline: quality, near-duplicates, secrets, mixture, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written and read again as the next one's docs.  All but the last return the
columns of documents, whatever others there are.  Empty tables give empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strandlens.llm import bytebpe, mixing, neardup, passages, secret_scan
from strandlens.llm.shared import cut, documents


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the passage classifier rejects go.

    Null and empty texts are scored as texts without words; rows with a null id are scored like others.  Without labels of
    both kinds nothing can be learnt, so nothing is rejected: every document stays.
    """
    return passages.keep_good(docs, passages.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, a similarity of 0.8) stays.

    Texts without words and rows with a null id all stay; of rows with one id, different texts stay.
    """
    return neardup.one_of_each(docs, words=5, percent=80)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Values that look live and that few owners or repositories have are replaced in the texts; widely copied examples stay.

    Every row stays; a null text stays null; a null source is one owner of its own.
    """
    return secret_scan.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget has them.

    A null source is a source; documents without words cost nothing; if no document has words, each is taken once.
    """
    return mixing.mix(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests and ids of every text; a null text has no ids."""
    return bytebpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), with_ids=True)


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", without_copies),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", tokens),
]

#: The first stage is a trained model, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
