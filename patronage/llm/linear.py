"""Bounded samples of labelled documents, and a sparse linear classifier over words.

The sample has at most ``bound`` documents of each class: those whose identifiers have
the smallest 60-bit hashes, so it is as large at any size of the table, whatever the
shares of the classes, and the same in every run. A document of the sample is an identifier; if
several rows share it, the text with the smallest hash stands for them.

The classifier is a softmax over the words a text holds, with a weight of each class in
the corpus in the loss and an L1 penalty that leaves few words with a weight. The fit looks at words
that pull harder than the penalty, solves for them, and goes on until no other does: the
result is that of a fit over all words, none is left out for their number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

PENALTY = 5e-4
#: Steps before the set of words is looked at anew, at first and later on (more and more).
FIRST, STEPS = 20, 100
CALM = 1e-4


def small_hash(*key: Column) -> Column:
    """Sixty bits, evenly spread: room to pick a few of any number of rows."""
    return F.shiftrightunsigned(F.xxhash64(*key, F.lit(11)), 4)


def smallest(rows: DataFrame, bound: int, once: bool = False) -> DataFrame:
    """At most ``bound`` rows of each label, those smallest by ``order`` (see small_hash), and weight: the label's rows for each one taken.

    Labels with more rows are first cut to about twice the bound by the value of their hashes, so
    no task sorts more than that of a label, however many rows it has. There are few labels.
    With ``once``, of rows equal in label and order one is taken.
    """
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    share = F.least(F.lit(1.0), F.lit(2.0 * bound) / F.col("size"))
    near = rows.join(F.broadcast(sizes), "label").where(F.col("order") < share * float(1 << 60))
    if once:
        near = near.dropDuplicates(["label", "order"])
    best = Window.partitionBy("label").orderBy("order")
    taken = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= bound)
    return taken.withColumn("weight", F.col("size") / F.least("size", F.lit(bound))).drop("rank", "size")


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """label, weight, text of at most ``bound`` documents a class; labels: id, label (a number). An identifier with several labels counts with the largest."""
    known = labels.select(labels[labels.columns[0]].alias("id"), labels[labels.columns[1]].cast("double").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    chosen = smallest(known.withColumn("order", small_hash(F.col("id"))), bound).drop("order")
    texts = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    met = texts.join(F.broadcast(chosen), "id")  # at most ``bound`` rows a class
    return met.groupBy("id", "label", "weight").agg(F.min_by("text", F.xxhash64("text")).alias("text")).drop("id")


def solve(rows: np.ndarray, columns: np.ndarray, dense: np.ndarray, labels: np.ndarray, weights: np.ndarray, n_words: int, n_classes: int, penalty: float = PENALTY) -> np.ndarray:
    """Weights (words and dense features and an intercept) x classes. rows, columns: which row holds which word."""
    n, share = len(labels), weights / weights.sum()
    goal = np.eye(n_classes)[labels]

    def gradient(w: np.ndarray, r: np.ndarray, c: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        z = np.zeros((n, n_classes)) if not len(r) else np.stack([np.bincount(r, w[c, k], n) for k in range(n_classes)], axis=1)
        z = z + dense @ w[size:-1] + w[-1]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        off = (e / e.sum(axis=1, keepdims=True) - goal) * share[:, None]
        return off, np.vstack([by_word(off, r, c, size), dense.T @ off, off.sum(axis=0)])

    def by_word(off: np.ndarray, r: np.ndarray, c: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(c, off[r, k], size) for k in range(n_classes)], axis=1)

    active = np.empty(0, np.int64)
    found = np.zeros((n_words + dense.shape[1] + 1, n_classes))
    start = (goal * share[:, None]).sum(axis=0)
    found[-1] = np.log(np.maximum(start, 1e-12))
    for turn in range(200):
        place = np.full(n_words, -1)
        place[active] = np.arange(len(active))
        mine = place[columns] >= 0
        r, c = rows[mine], place[columns[mine]]
        kept = np.concatenate([active, np.arange(n_words, len(found))])
        w = y = found[kept]
        # a feature's own step: what it meets in the rows that hold it bounds the curvature along it
        met = share * (np.bincount(r, minlength=n) + np.abs(dense).sum(axis=1) + 1)
        bend = np.concatenate([np.bincount(c, met[r], len(active)), np.abs(dense).T @ met, [met.sum()]])
        step, drive = (2 / np.maximum(bend, 1e-12))[:, None], 1.0
        cut = step * penalty
        cut[-1] = 0
        for _ in range(FIRST if turn < 4 else STEPS * (1 + turn // 8)):
            _, g = gradient(y, r, c, len(active))
            new = y - step * g
            new = np.sign(new) * np.maximum(np.abs(new) - cut, 0)
            if ((y - new) / step * (new - w)).sum() > 0:
                drive = 1.0
            ahead = (1 + np.sqrt(1 + 4 * drive * drive)) / 2
            y, moved, w, drive = new + (drive - 1) / ahead * (new - w), (np.abs(new - w) / step).max(), new, ahead
            if calm := moved < CALM:
                break
        found[kept] = w
        off, _ = gradient(w, r, c, len(active))
        pull = np.abs(by_word(off, rows, columns, n_words)).max(axis=1) if n_words else np.empty(0)
        used = found[:n_words].any(axis=1)
        more = np.flatnonzero(~used & (pull > penalty * (1 + 1e-3)))
        if calm and not len(np.setdiff1d(more, active)):
            break
        active = np.union1d(np.flatnonzero(used), more)
    return found


def fit_words(texts: Iterable[tuple[int, float, Iterable[str], Iterable[float]]], n_classes: int, n_dense: int = 0, penalty: float = PENALTY) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Weights of words with any, and of dense features and the intercept. texts: class, weight, words, dense features."""
    index: dict[str, int] = {}
    labels, weights, rows, columns, dense = [], [], [], [], []
    for at, (label, weight, words, more) in enumerate(texts):
        labels.append(label)
        weights.append(weight)
        mine = [index.setdefault(w, len(index)) for w in sorted(words)]
        rows.append(np.full(len(mine), at))
        columns.append(np.array(mine, np.int64))
        dense.append(list(more))
    if len(set(labels)) < 2:
        return {}, np.zeros((n_dense + 1, n_classes))
    x = np.array(dense, float).reshape(len(labels), n_dense)
    middle, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-12)  # dense features weigh by their spread, words by their presence
    found = solve(np.concatenate(rows), np.concatenate(columns), (x - middle) / spread, np.array(labels), np.array(weights), len(index), n_classes, penalty)
    found[len(index) : -1] /= spread[:, None]
    found[-1] -= middle @ found[len(index) : -1]
    return {w: found[i] for w, i in index.items() if found[i].any()}, found[len(index) :]


def fit_in_one_task(rows: DataFrame, n_classes: int, n_dense: int, penalty: float = PENALTY) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The same over a bounded table label, weight, words, dense; only weights come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = [r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True)]
        given.sort(key=lambda r: (r[0], r[2], r[3], r[1]))  # the order of rows does not matter
        words, rest = fit_words(((int(label), weight, has, more) for label, weight, has, more in given), n_classes, n_dense, penalty)
        names = sorted(words)
        values = [words[n].tolist() for n in names] + rest.tolist()
        yield pa.RecordBatch.from_arrays([pa.array([*names, *[None] * len(rest)], pa.string()), pa.array(range(len(values)), pa.int64()), pa.array(values, pa.list_(pa.float64()))], ["word", "at", "weights"])

    found = rows.select("label", "weight", "words", "dense").coalesce(1).mapInArrow(run, "word string, at long, weights array<double>").orderBy("at").collect()
    words = {r["word"]: np.array(r["weights"]) for r in found if r["word"] is not None}
    rest = [r["weights"] for r in found if r["word"] is None]
    return words, np.array(rest, float).reshape(-1, n_classes) if rest else np.zeros((n_dense + 1, n_classes))
