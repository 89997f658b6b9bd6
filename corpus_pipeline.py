"""From raw documents to token ids. STAGES lists the stages in order; run() applies them.

Each stage gets what its predecessor kept, as a Parquet table read again. All but the last
return the columns of documents. SQL cannot express the fitted, iterative or hashed
stages, so there is no SQL counterpart; the tests hold run() against brute force.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from patronage.llm import bpe, exact_dedup, language, mixing, near_dedup
from patronage.llm.common import table
from patronage.llm.queries import SHARES, VOCABULARY
from patronage.session import durable, prepare

#: Documents that a Python task holds at a time, on its side and on Spark's: some of them are very long.
BATCH_ROWS = 1000


def stage(fn: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return fn(spark, docs, sf_dir)

    return run


@stage
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that are near one of the languages learned from docs itself."""
    return language.identify(docs, language.fit(docs), carry=True).where("NOT rejected").select("_row.*")


@stage
def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts, the one with the largest identifier."""
    return exact_dedup.drop_copies(docs)


@stage
def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near copies, the one with the smallest identifier."""
    return near_dedup.keep_one(docs)


@stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say: toxic and plain ones less, good ones once or twice."""
    return mixing.apply_copies(docs, mixing.mix(docs, table(spark, sf_dir, "labels"), SHARES))


@stage
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digests of ids and decoded text."""
    return bpe.encode(docs, VOCABULARY)


STAGES = [
    ("language ID", known_language),
    ("exact dedup", no_copies),
    ("MinHash near-dedup", no_near_copies),
    ("mixing to target weights", mixed),
    ("BPE encoding and decoding", token_ids),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), str(sf_dir).rstrip("/"), "documents")
    for _, step in STAGES[:-1]:
        docs = durable(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
