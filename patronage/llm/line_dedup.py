"""Repeated lines across documents, answered by keep bitmaps.

Line hashes are range-partitioned and sorted by hash, document (largest first) and
position; one pass over each sorted partition streams the groups: the first document
keeps its lines, the others lose theirs once enough documents are seen. What comes
back is a compressed bitmap per document that loses lines, not text. A hash with more
than 1/256 of all lines is not sorted: its document count and survivor come from an
aggregate and are broadcast (at most 255 rows).

Defined cases: a null or empty text is one empty line. Rows that share an identifier
are one document and count once; each text of theirs loses its own lines (a bitmap belongs to an
identifier and a text's hash, ``mark``). A row without an identifier counts for nothing
and keeps all lines. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import durable
from .common import hot_keys

#: What is stripped at both ends of a line to get its key.
BLANKS = b" \t\n\x0b\x0c\r"
LEAST_CHARS, LEAST_DOCS = 20, 3


def text_mark(text: str) -> Column:
    """Tells the texts of one identifier apart."""
    return F.xxhash64(text).alias("mark")


def line_keys(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc, mark, pos, key (hash of the line's key) of every line that is long enough."""
    kind = docs.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owner, pos, keys = [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                for n, line in enumerate((text or "").encode().split(b"\n")):
                    # bytes methods change ASCII letters only; UTF-8 has at least a byte per code point
                    if len(line) >= least_chars:
                        key = line.strip(BLANKS).lower()
                        if len(key) >= least_chars and (key.isascii() or len(key.decode()) >= least_chars):
                            owner.append(i)
                            pos.append(n)
                            keys.append(hashlib.blake2b(key, digest_size=16).digest())
            docs_of = b.column(0).take(pa.array(owner, pa.int64()))
            marks = b.column(2).take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays([docs_of, marks, pa.array(pos, pa.int32()), pa.array(keys, pa.binary())], ["doc", "mark", "pos", "key"])

    return docs.select("doc", "text", text_mark("text")).mapInArrow(run, f"doc {kind}, mark long, pos int, key binary")


def dropped(rows: Iterable[tuple], least_docs: int = LEAST_DOCS) -> Iterator[tuple]:
    """(doc, mark, pos) of the lines that go, from (key, doc, mark, pos) sorted by key, then doc descending."""
    key, first, last, seen, waiting = None, None, None, 0, []
    for k, doc, *line in rows:
        if k != key:
            key, first, last, seen, waiting = k, doc, doc, 1, []
        if doc != last:
            last, seen = doc, seen + 1
        if doc == first:
            continue
        if seen < least_docs:  # at most the lines of least_docs - 2 documents wait
            waiting.append((doc, *line))
        else:
            yield from waiting
            waiting = []
            yield doc, *line


def bitmap(positions: np.ndarray) -> bytes:
    """Compressed bits, 1 for a line that stays, up to the last line that goes."""
    keep = np.ones((int(positions.max()) // 8 + 1) * 8, bool)  # whole bytes; lines past the end are not there
    keep[positions] = False
    return zlib.compress(np.packbits(keep).tobytes())


def kept_lines(packed: bytes | None, lines: list[str]) -> list[str]:
    if packed is None:
        return lines
    keep = np.ones(len(lines), bool)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8))[: len(lines)]
    keep[: len(bits)] = bits
    return [x for x, k in zip(lines, keep.tolist(), strict=True) if k]


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """doc, mark, keep_bitmap for every text that loses a line. Bit i is line i; bits past the last dropped line are left out and mean keep."""
    given = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text")).where(F.col("doc").isNotNull())
    lines = durable(line_keys(given, least_chars))  # a few bytes per line, and read three times
    doc_type = given.schema["doc"].dataType.simpleString()
    hot = hot_keys(lines, "key").select(F.col("key").alias("hot"))
    marked = lines.join(F.broadcast(hot), lines["key"] == F.col("hot"), "left")
    rest = marked.where("hot IS NULL").select("key", "doc", "mark", "pos").repartitionByRange("key").sortWithinPartitions("key", F.desc("doc"), "mark", "pos")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                yield from zip(*[c.to_pylist() for c in b.columns], strict=True)

        out: list[tuple] = []
        for pair in dropped(rows(), least_docs):
            out.append(pair)
            if len(out) == 50_000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    def batch(out: list[tuple]) -> pa.RecordBatch:
        docs, marks, places = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(docs), pa.array(marks, pa.int64()), pa.array(places, pa.int32())], ["doc", "mark", "pos"])

    gone = rest.mapInArrow(stream, f"doc {doc_type}, mark long, pos int")
    often = marked.where("hot IS NOT NULL").select("hot", "doc", "mark", "pos")
    totals = often.groupBy("hot", "doc").agg(F.lit(1).alias("one")).groupBy("hot").agg(F.count("one").alias("n"), F.max("doc").alias("keeper"))
    totals = totals.where(F.col("n") >= least_docs).select(F.col("hot").alias("h"), "keeper")
    hot_gone = often.join(F.broadcast(totals), often["hot"] == F.col("h")).where("doc <> keeper").select("doc", "mark", "pos")

    @F.pandas_udf("binary")
    def pack(positions: pd.Series) -> pd.Series:
        return positions.map(bitmap)

    return gone.unionByName(hot_gone).groupBy("doc", "mark").agg(F.collect_set("pos").alias("pos")).select("doc", "mark", pack("pos").alias("keep_bitmap"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, n_lines, n_dropped, kept_text of every row of docs."""
    given = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text"))
    joined = given.withColumn("mark", text_mark("text")).join(bitmaps, ["doc", "mark"], "left").select("doc", "text", "keep_bitmap")
    doc_type = given.schema["doc"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, lost, kept = [], [], []
            for text, packed in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                lines = (text or "").split("\n")
                stay = kept_lines(packed, lines)
                total.append(len(lines))
                lost.append(len(lines) - len(stay))
                kept.append("\n".join(stay))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.string())], ["doc", "n_lines", "n_dropped", "kept_text"])

    return joined.mapInArrow(cut, f"doc {doc_type}, n_lines long, n_dropped long, kept_text string")
