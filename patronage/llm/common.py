"""What several operators of this subpackage share."""

from __future__ import annotations

import functools
import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
#: A key is hot if it holds more than one in this many rows, so at most this many keys are hot.
HOT_SHARE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, and at its end the worker returns what Arrow keeps for reuse: it may wait, or go on to other steps."""

    @functools.wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return tidied


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes the faster way to the same result."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def hot_keys(rows: DataFrame, key: str, *aggregates: Column, share: int = HOT_SHARE) -> DataFrame:
    """The keys that hold at least two and more than 1/share of all rows: fewer than ``share``, whatever the data.

    Rows are counted before they are shuffled, so a hot key is one row per input task.
    The result is small by definition and may be broadcast.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("hot_rows"), *aggregates)
    least = max(1, rows.count() // share)
    return counts.where(F.col("hot_rows") > least)
