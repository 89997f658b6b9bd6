"""Document rates that bring sources of text, known only softly, to target weights.

A classifier fitted on a labelled table gives every document a posterior over domains.
Document i has n_i tokens and posterior p_i, so a rate r_i contributes r_i n_i p_i to
the domains. The rates minimise the least-squares distance of the expected domain
totals from the targets, plus a little of the distance from rate 1, over r >= 0:

    1/2 |G^(-1/2) (sum_i w_i r_i p_i - b)|^2 + ridge/2 sum_i w_i (r_i - 1)^2

with w_i the token share of a document, b the targets over all tokens and
G = sum_i w_i p_i p_i' the domains' Gram matrix, which makes a step of 1/(1 + ridge)
right for any data. Each step of the (accelerated) projected gradient is one pass in which a task
sends as many numbers as there are domains to the driver; a document's rate is recomputed
from the steps so far, so nothing is stored per step. Steps go on until they converge.

Defined cases: a null text counts as empty and has no tokens; its rate does not matter
to the totals and follows its posterior. Rows without an identifier or a label are not
learned from but get a rate. A document is an identifier and a text: texts that share an
identifier, or have none, each have their own rate and draw. Rows equal in both get equal
rates and draws, and each counts. Targets that
cannot be met are approached in the least-squares sense. An empty table gives no rows.
Other columns, whatever their names, do not take part.
"""

from __future__ import annotations

import dataclasses
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import durable
from . import linear
from .common import tidy

#: Bound on the labelled texts of each domain that the classifier is fitted on.
SAMPLE = 2048
RIDGE = 1e-3
#: Where steps that do not converge end, with a warning.
ROUNDS = 1000
#: Steps end when no domain's share of all tokens moves by more.
TOLERANCE = 1e-5
#: Characters that prose has none of.
MARKS = "%*&$#|!"
DOMAINS = ("plain", "good", "toxic")


def domain(quality: Column, toxic: Column) -> Column:
    """Place in DOMAINS of a row of the labelled table."""
    return F.when(toxic == 1, 2).when(quality == 1, 1).when(quality == 0, 0)


def described(text: str) -> tuple[int, set[str], tuple[float, float, float]]:
    """Number of words, the different words without marks, and three shares that tell prose from noise."""
    low = text.lower()
    n = len(low.split())
    for mark in MARKS + ".,;:?":
        low = low.replace(mark, " ")
    words = set(low.split())
    return n, words, (sum(map(text.count, MARKS)) / max(len(text), 1), len(words) / max(n, 1), len(text) / max(n, 1) / 100)


@dataclasses.dataclass(frozen=True)
class Classifier:
    """A linear model over the words of a text and its shares; ``words`` has those with a weight."""

    words: dict[str, np.ndarray]
    shares: np.ndarray  # shares x classes
    intercept: np.ndarray
    n_domains: int

    def posterior(self, words: set[str], shares: tuple[float, ...]) -> np.ndarray:
        out = np.zeros(self.n_domains)
        z = self.intercept + np.array(shares) @ self.shares
        for w in words & self.words.keys():
            z = z + self.words[w]
        e = np.exp(z - z.max())
        out[: len(z)] = e / e.sum()  # domains past the last one seen have none
        return out

    def posteriors(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """id, text_hash, n_tokens, posterior (one share per domain)."""
        given = docs.select(docs[id_col].alias("id"), text_hash(docs[text_col]).alias("text_hash"), docs[text_col].alias("text"))
        kind = given.schema["id"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                n, found = [], []
                for text in b.column(2).to_pylist():
                    tokens, words, shares = described(text or "")
                    n.append(tokens)
                    found.append(self.posterior(words, shares))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.float64()))], ["id", "text_hash", "n_tokens", "posterior"])

        return given.mapInArrow(tidy(run), f"id {kind}, text_hash binary, n_tokens long, posterior array<double>")


def fit_classifier(docs: DataFrame, labels: DataFrame, n_domains: int = len(DOMAINS), id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Classifier:
    """labels: id, domain (a place). Fitted on at most ``sample`` labelled documents of each domain."""
    texts = linear.labelled_sample(docs, labels, sample, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [described(t or "") for t in b.column(2).to_pylist()]
            columns = [pa.array([sorted(r[1]) for r in rows], pa.list_(pa.string())), pa.array([list(r[2]) for r in rows], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns], ["label", "weight", "words", "dense"])

    rows = durable(texts.select("label", "weight", "text").mapInArrow(tidy(run), "label double, weight double, words array<string>, dense array<double>"))
    words, rest = linear.fit_in_one_task(rows, n_domains, 3)
    return Classifier(words, rest[:3], rest[3], n_domains)


@dataclasses.dataclass(frozen=True)
class Steps:
    """The steps of the projected gradient so far: what each document needs to know its rate."""

    pulls: np.ndarray  # steps x domains: G^-1 (totals - targets)
    drives: tuple[float, ...]  # of each step, how far the next one starts ahead
    ridge: float

    def rates(self, posterior: np.ndarray, ahead: bool = False) -> np.ndarray:
        """The rates, or where the next step starts."""
        r = y = np.ones(len(posterior))
        eta = 1 / (1 + self.ridge)
        for pull, drive in zip(self.pulls, self.drives, strict=True):
            new = np.maximum(0.0, y - eta * (posterior @ pull + self.ridge * (y - 1)))
            y = new + drive * (new - r)
            r = new
        return y if ahead else r


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def fit_rates(weights: DataFrame, targets: list[float], ridge: float = RIDGE, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> Steps:
    """weights: n_tokens, posterior, in a table that is read once per step; targets: tokens per domain."""
    k = len(targets)
    gram = [F.sum(F.col("n_tokens") * F.col("posterior")[i] * F.col("posterior")[j]) for i in range(k) for j in range(k)]
    total, *cells = weights.agg(F.sum("n_tokens"), *gram).first()
    if not total:
        return Steps(np.empty((0, k)), (), ridge)
    g = np.array(cells).reshape(k, k) / total
    inverse = np.linalg.inv(g + 1e-9 * np.trace(g) * np.eye(k))
    goal = np.array(targets, float) / total
    steps, last, since, before = Steps(np.empty((0, k)), (), ridge), None, 0, np.inf
    given, names = weights.select("n_tokens", "posterior"), ", ".join(f"t{i} double" for i in range(k))
    for _ in range(rounds):

        def sums(batches: Iterator[pa.RecordBatch], steps: Steps = steps) -> Iterator[pa.RecordBatch]:
            found = np.zeros(k)
            for b in batches:
                p = _matrix(b.column(1), k)
                found += (steps.rates(p, ahead=True) * b.column(0).to_numpy()) @ p
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in found], [f"t{i}" for i in range(k)])

        parts = given.mapInArrow(sums, names).collect()  # as many numbers as there are domains from each task
        got = np.array(parts, float).reshape(-1, k).sum(axis=0) / total
        pull = inverse @ (got - goal)
        if last is not None and np.abs(got - last).max() < tolerance:
            return steps
        last = got
        off = float((got - goal) @ pull)
        since = since + 1 if off < before else 0  # what no longer comes nearer starts anew
        before = off
        steps = Steps(np.vstack([steps.pulls, pull]), (*steps.drives, since / (since + 3)), ridge)
    warnings.warn(f"rates still move after {rounds} steps", RuntimeWarning, stacklevel=2)
    return steps


def rates(weights: DataFrame, steps: Steps, n_domains: int) -> DataFrame:
    """The columns of weights, rate."""
    names = [*weights.columns, "rate"]
    at = weights.columns.index("posterior")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = steps.rates(_matrix(b.column(at), n_domains))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(r)], names)

    return weights.mapInArrow(run, StructType([*weights.schema.fields, StructField("rate", DoubleType())]))


def text_hash(text: Column) -> Column:
    """What tells the texts of one identifier apart; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def copies(rate: Column, *key: Column, seed: int = 0) -> Column:
    """Whole copies of a document whose expectation is its rate; the choice is a hash of what identifies it."""
    u = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + u).cast("int")


def mix(docs: DataFrame, labels: DataFrame, shares: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text_hash, n_tokens, posterior, rate, copies. shares: for each domain, its target as a multiple of its present expected tokens.

    labels has the columns id_col, quality, toxic.
    """
    known = labels.select(labels[id_col], domain(labels["quality"], labels["toxic"]).alias("domain"))
    classifier = fit_classifier(docs, known, len(DOMAINS), id_col, text_col)
    weights = durable(classifier.posteriors(docs, id_col, text_col))
    present = weights.agg(*[F.coalesce(F.sum(F.col("n_tokens") * F.col("posterior")[i]), F.lit(0.0)) for i in range(len(DOMAINS))]).first()
    steps = fit_rates(weights, [x * shares[name] for x, name in zip(present, DOMAINS, strict=True)])
    found = rates(weights, steps, len(DOMAINS))
    number = copies(F.col("rate"), F.col("id"), F.col("text_hash"))
    return found.select(F.col("id").alias(id_col), "text_hash", "n_tokens", "posterior", "rate", number.alias("copies"))


def apply_copies(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, each as often as its document's copies say, with their own columns."""
    keys = mixed[id_col].alias("_mixed_id"), mixed["text_hash"].alias("_mixed_hash")
    wanted = mixed.groupBy(*keys).agg(F.max("copies").alias("_copies"))  # equal for equal rows
    rows = docs.select(F.struct("*").alias("_row"), docs[id_col].alias("_id"), text_hash(docs[text_col]).alias("_hash"))
    joined = rows.join(wanted, F.col("_id").eqNullSafe(F.col("_mixed_id")) & (F.col("_hash") == F.col("_mixed_hash")))
    return joined.where("_copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")).select("_row.*")
