"""From raw documents to packed training sequences, in five stages.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; what it decides takes effect on the rows it passes on. All but
the last return the columns of ``documents``, so stages can be left out or put in another order. ``run`` writes what a stage
returns as a table in the shared folder, and the next stage reads that: nothing is computed twice, and after the loss of
an executor a stage starts from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfpair.llm.common import small_batches, table
from shelfpair.llm.language import keep_known
from shelfpair.llm.packing import bucketed, pack
from shelfpair.llm.pii import without_private_data
from shelfpair.llm.quality import keep_good
from shelfpair.llm.simhash import drop_near_copies
from shelfpair.session import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a score of at least 0.4; texts without a letter go."""
    small_batches(spark)
    return keep_known(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and read like the trusted ones rather than like the rest."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    small_batches(spark)
    return drop_near_copies(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets."""
    small_batches(spark)
    return without_private_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences of all documents: one row a piece, with its token ids and their checksum, laid out by length.

    Worker processes serve all stages, so this one remembers fewer chunks than it would alone.
    """
    small_batches(spark)
    return bucketed(pack(docs, remembered=100_000, given=("ids", "ids_crc32")))


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_copies", near_copies),
    ("private_data", private_data),
    ("packing", packing),
]

#: Tokens, the trained network and keyed surrogates are beyond SQL; tests/llm/test_pipeline.py holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
