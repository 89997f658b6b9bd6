"""Token counts of the documents in flat, unindexed token files, by a scan for separators.

A flat file is a run of fixed-width token ids; an end-of-document id closes each
document and nothing says where documents begin. The file is read in blocks of equal
length, wherever documents lie. Each block is searched for the separator in one
vectorised comparison and becomes one small row: its tokens, its separators, the
tokens before the first, after the last and between them. A prefix scan in two levels
over these rows (inside runs of RUN blocks, then over runs) carries the open document
and the number of documents across blocks, so a file may be as long as one likes.

Defined cases: a block without separator only lengthens the open document. A document
of no tokens counts 0. Tokens after a file's last separator are one more document with
``closed`` false. Empty files and empty tables give no rows. A null text is an empty
document; repeated rows are documents of their own.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import durable

BLOCK_TOKENS = 1 << 16
RUN = 1024
#: shard, block: place of the block; tokens: little-endian ids; ids: documents closed in it, if known.
BLOCKS = "shard string, block long, tokens binary, ids array<long>"
SUMMARY = "shard string, block long, n_tokens long, n_seps long, head long, tail long, inner array<long>, ids array<long>"


@functools.lru_cache(maxsize=1)
def _encoding(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("flat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def bpe_tokens(path: str) -> Callable[[list[str]], Iterable[list[int]]]:
    """An encoder of texts by a rank file."""
    return lambda texts: map(_encoding(path).encode_ordinary, texts)


def flat_blocks(docs: DataFrame, encode: Callable[[list[str]], Iterable[list[int]]], eod: int, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS, width: str = "<u2") -> DataFrame:
    """The documents of each partition as one flat file, in blocks that know nothing of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, size, ids = 0, [], 0, []  # ids: (position of the separator, document)
        shard = None

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal at, held, size, ids
            flat = np.concatenate(held) if held else np.empty(0, width)
            full = len(flat) if last else len(flat) // block_tokens * block_tokens
            for i in range(0, full, block_tokens):
                part = flat[i : min(i + block_tokens, full)]
                start = at * block_tokens
                mine = [d for p, d in ids if start <= p < start + block_tokens]
                ids = [x for x in ids if x[0] >= start + block_tokens]
                yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([at], pa.int64()), pa.array([part.tobytes()], pa.binary()), pa.array([mine], pa.list_(pa.int64()))], ["shard", "block", "tokens", "ids"])
                at += 1
            held, size = [flat[full:]], len(flat) - full

        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                shard = str(part.column(2)[0].as_py())
                for doc, tokens in zip(part.column(0).to_pylist(), encode([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    held.append(np.array([*tokens, eod], width))
                    size += len(held[-1])
                    ids.append((at * block_tokens + size - 1, doc))
                yield from cut(False)
        yield from cut(True)

    given = docs.select(docs[id_col].cast("long"), docs[text_col], F.spark_partition_id())
    return given.mapInArrow(run, BLOCKS)


def read_flat_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS, width: str = "<u2") -> DataFrame:
    """Blocks of real flat files. Spark reads a file as one row, so a file must fit a task (2 GB at most)."""
    step = block_tokens * np.dtype(width).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = memoryview(content.as_buffer())
                if len(data) % np.dtype(width).itemsize:
                    raise ValueError(f"{name} is not a whole number of tokens")
                for i in range(0, len(data), step):
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([i // step], pa.int64()), pa.array([bytes(data[i : i + step])], pa.binary()), pa.array([None], pa.list_(pa.int64()))], ["shard", "block", "tokens", "ids"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, BLOCKS)


def scan_blocks(blocks: DataFrame, eod: int, width: str = "<u2") -> DataFrame:
    """One row per block: SUMMARY."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for data in b.column(2):
                tokens = np.frombuffer(data.as_buffer(), width)
                seps = np.flatnonzero(tokens == eod)
                n = len(tokens)
                head, tail = (seps[0], n - 1 - seps[-1]) if len(seps) else (n, n)
                out.append((n, len(seps), int(head), int(tail), np.diff(seps) - 1))
            n, k, head, tail, inner = zip(*out, strict=True) if out else ([],) * 5
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(x, pa.int64()) for x in (n, k, head, tail)), pa.array(inner, pa.list_(pa.int64())), b.column(3)], [x.split()[0] for x in SUMMARY.split(", ")])

    return blocks.select("shard", "block", "tokens", "ids").mapInArrow(run, SUMMARY)


def stitch(summary: DataFrame) -> DataFrame:
    """shard, doc_index, doc_id (null if not known), n_tokens, closed: one row per document."""
    rows = durable(summary)  # small, and read by both levels of the scan
    rows = rows.withColumn("run", F.floor(F.col("block") / RUN))
    inside = Window.partitionBy("shard", "run").orderBy("block")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    # level one: what lies before a block inside its run; the open document since the run's last separator
    rows = rows.select(
        "*",
        F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("t"),
        F.coalesce(F.sum("n_seps").over(before), F.lit(0)).alias("s"),
        F.lead("block").over(inside).isNull().alias("run_end"),
    ).withColumn("open_at", F.when(F.col("n_seps") > 0, F.col("t") + F.col("n_tokens") - F.col("tail")))
    rows = rows.withColumn("carried", F.max("open_at").over(before))
    # level two: one row per run
    runs = rows.groupBy("shard", "run").agg(F.sum("n_tokens").alias("rt"), F.sum("n_seps").alias("rs"), F.max("open_at").alias("ro"))
    along = Window.partitionBy("shard").orderBy("run")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("*", F.coalesce(F.sum("rt").over(earlier), F.lit(0)).alias("run_t"), F.coalesce(F.sum("rs").over(earlier), F.lit(0)).alias("run_s"), F.lead("run").over(along).isNull().alias("last_run"))
    runs = runs.withColumn("run_open", F.coalesce(F.max(F.col("run_t") + F.col("ro")).over(earlier), F.lit(0)))
    rows = rows.join(runs.select("shard", "run", "run_t", "run_s", "run_open", "last_run"), ["shard", "run"])
    start = F.col("run_t") + F.col("t")
    carry = start - F.coalesce(F.col("run_t") + F.col("carried"), F.col("run_open"))
    closed = F.when(F.col("n_seps") > 0, F.concat(F.array(F.col("head") + carry), F.col("inner"))).otherwise(F.array().cast("array<long>"))
    left = F.when(F.col("n_seps") > 0, F.col("tail")).otherwise(F.col("n_tokens") + carry)
    open_end = F.when(F.col("run_end") & F.col("last_run") & (left > 0), F.array(left)).otherwise(F.array().cast("array<long>"))
    each = rows.select("shard", (F.col("run_s") + F.col("s")).alias("base"), "n_seps", "ids", F.posexplode(F.concat(closed, open_end)).alias("i", "n_tokens"))
    is_closed = F.col("i") < F.col("n_seps")
    return each.select("shard", (F.col("base") + F.col("i")).alias("doc_index"), F.when(is_closed, F.try_element_at("ids", F.col("i") + 1)).alias("doc_id"), "n_tokens", is_closed.alias("closed"))


def count_tokens(blocks: DataFrame, eod: int, width: str = "<u2") -> DataFrame:
    return stitch(scan_blocks(blocks, eod, width))
