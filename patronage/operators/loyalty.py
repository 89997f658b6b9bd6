"""Hidden loyalty levels behind the observed purchase rhythm.

A hidden Markov model with three levels (L, N, H) over nine observable states.
Sequences are handled in pieces: what a piece does to the level probabilities is
a 3x3 matrix, matrices of consecutive pieces multiply, so a very long history is
worked on by many tasks and gives the same answer as in one go.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.ordering import segments
from ..session import durable
from .markov import KEYS, ORDER, transaction_states

HIDDEN = ("L", "N", "H")
# time since the last purchase (small, medium, large) x amount (less, same, more)
OBSERVABLE = tuple(t + a for t in "SML" for a in "LSM")
PIECE = 10_000
# Decoding copies a growing list at each step, so it works on shorter pieces.
DECODED_AT_ONCE = 256
# Observations that training handles at a time: what it holds of them stays below a few MB.
BLOCK_CODES = 1 << 17


class HiddenMarkov(NamedTuple):
    """Start, step and emission probabilities, rows in the order of ``hidden``, columns of ``emit`` in that of ``observable``."""

    start: tuple[float, ...]
    step: tuple[tuple[float, ...], ...]
    emit: tuple[tuple[float, ...], ...]
    hidden: tuple[str, ...] = HIDDEN
    observable: tuple[str, ...] = OBSERVABLE


def loyalty_observations(transactions: DataFrame, **thresholds) -> DataFrame:
    """The transaction states with the amount letters L (less), S (same), M (more)."""
    return transaction_states(transactions, amount_letters="LSM", **thresholds)


def _codes(state: Column, observable: Sequence[str]) -> Column:
    """Place of an observed state; a state the model does not know is an error."""
    place = F.array_position(F.array(*[F.lit(o) for o in observable]), state).cast("int")
    unknown = F.raise_error(F.concat(F.lit("unknown state "), F.coalesce(state, F.lit("null")))).cast("int")
    return F.when(place > 0, place - 1).otherwise(unknown)


def observation_pieces(
    observations: DataFrame, piece: int = PIECE, observable: Sequence[str] = OBSERVABLE
) -> DataFrame:
    """Observation numbers per customer in time order, in pieces."""
    return segments(
        observations,
        KEYS,
        ORDER,
        _codes(F.col("state"), observable),
        None,
        "obs",
        max_len=piece,
        position=F.col("step"),
    )


# ------------------------------------------------------------------- decoding


def _log(p: float) -> float:
    return math.log(p) if p > 0 else float("-inf")


def _argmax(values: Sequence[Column]) -> tuple[Column, Column]:
    """(largest value, its first index)."""
    best = F.greatest(*values)
    index = F.lit(len(values) - 1)
    for i in range(len(values) - 2, -1, -1):
        index = F.when(values[i] == best, F.lit(i)).otherwise(index)
    return best, index


def loyalty_states(
    observations: DataFrame, model: HiddenMarkov, piece: int = PIECE
) -> DataFrame:
    """The most likely level of every observation (Viterbi, in logs), per customer.

    A row has up to ``piece`` levels in time order and the position of the first of
    them. Decoding itself goes in shorter pieces, the largest that divide a row.

    Three steps: each piece is summed up by the best log-probability between every
    pair of levels; per customer these few matrices fix the level at the end of
    each piece; each piece is then decoded between its fixed ends.
    """
    size = len(model.hidden)
    span = range(size)
    short = next(d for d in range(min(piece, DECODED_AT_ONCE), 0, -1) if piece % d == 0)
    start = [F.lit(_log(p)) for p in model.start]
    step = [[F.lit(_log(p)) for p in row] for row in model.step]
    emit = [F.array(*[F.lit(_log(p)) for p in row]) for row in model.emit]

    pieces = observation_pieces(observations, short, model.observable)
    first = F.get("obs", F.lit(0))
    rest = F.slice("obs", F.lit(2), F.size("obs"))

    # 1. best log-probability from level i before the piece to level j at its end
    opening = F.array(
        *[
            F.when(F.col("segment") == 0, start[j]).otherwise(step[i][j]) + F.get(emit[j], first)
            for i in span
            for j in span
        ]
    )

    def extend(m: Column, o: Column) -> Column:
        return F.array(
            *[
                F.greatest(*[F.get(m, F.lit(i * size + k)) + step[k][j] for k in span])
                + F.get(emit[j], o)
                for i in span
                for j in span
            ]
        )

    through = pieces.select(*KEYS, "segment", F.aggregate(rest, opening, extend).alias("m"))

    # 2. levels at the ends of the pieces of one customer
    chain = through.groupBy(*KEYS).agg(
        F.array_sort(F.collect_list(F.struct("segment", "m"))).alias("c")
    )
    empty = F.array().cast("array<array<int>>")

    def forward(acc: Column, e: Column) -> Column:
        picks = [
            _argmax([F.get(acc["v"], F.lit(i)) + F.get(e["m"], F.lit(i * size + j)) for i in span])
            for j in span
        ]
        return F.struct(
            F.array(*[p[0] for p in picks]).alias("v"),
            F.array_append(acc["back"], F.array(*[p[1] for p in picks])).alias("back"),
        )

    # all rows of the first piece's matrix are equal, so any level may stand before it
    nothing = F.array(F.lit(0.0), *[F.lit(float("-inf"))] * (size - 1))
    scanned = chain.select(
        *KEYS,
        F.aggregate("c", F.struct(nothing.alias("v"), empty.alias("back")), forward).alias("s"),
    )
    end = _argmax([F.get("s.v", F.lit(j)) for j in span])[1]
    exits = F.aggregate(
        F.reverse("s.back"),
        F.array(end),
        lambda acc, b: F.array_append(acc, F.get(b, F.element_at(acc, -1))),
    )
    # reversed: level before piece 0 (of no account), exit of piece 0, exit of piece 1, ...
    entries = scanned.select(*KEYS, F.reverse(exits).alias("e"))
    ends = entries.select(
        *KEYS,
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("e") - 1),
                lambda k: F.struct(
                    (k - 1).alias("segment"),
                    F.get("e", k - 1).alias("entry"),
                    F.get("e", k).alias("exit"),
                ),
            )
        ).alias("x"),
    ).select(*KEYS, "x.*")

    # 3. decode each piece from its entry level to its exit level
    bounded = pieces.join(ends, [*KEYS, "segment"])
    from_entry = [
        F.get(F.array(*[step[i][j] for i in span]), F.col("entry")) for j in span
    ]
    opened = F.array(
        *[
            F.when(F.col("segment") == 0, start[j]).otherwise(from_entry[j]) + F.get(emit[j], first)
            for j in span
        ]
    )

    def advance(acc: Column, o: Column) -> Column:
        picks = [
            _argmax([F.get(acc["v"], F.lit(i)) + step[i][j] for i in span]) for j in span
        ]
        return F.struct(
            F.array(*[p[0] + F.get(emit[j], o) for j, p in zip(span, picks)]).alias("v"),
            F.array_append(acc["back"], F.array(*[p[1] for p in picks])).alias("back"),
        )

    decoded = bounded.select(
        *KEYS,
        "segment",
        "exit",
        F.aggregate(rest, F.struct(opened.alias("v"), empty.alias("back")), advance)["back"].alias(
            "back"
        ),
    )
    levels = F.reverse(
        F.aggregate(
            F.reverse("back"),
            F.array("exit"),
            lambda acc, b: F.array_append(acc, F.get(b, F.element_at(acc, -1))),
        )
    )
    names = F.array(*[F.lit(h) for h in model.hidden])
    named = decoded.select(*KEYS, "segment", F.transform(levels, lambda i: F.get(names, i)).alias("part"))
    row = F.floor(F.col("segment") * F.lit(short) / F.lit(piece)).cast("int")
    parts = F.array_sort(F.collect_list(F.struct("segment", "part")))
    joined = named.groupBy(*KEYS, row.alias("row")).agg(F.flatten(F.transform(parts, lambda p: p["part"])).alias("states"))
    return joined.select(
        *KEYS, F.col("row").alias("segment"), (F.col("row").cast("bigint") * piece).alias("first"), "states"
    )


def loyalty_trend(states: DataFrame, hidden: Sequence[str] = HIDDEN) -> DataFrame:
    """Slope of each customer's loyalty curve (0, 1, 2 for L, N, H per step); below 0 is downward.

    ``states`` says where in the history each row begins, so rows may be of any length.
    """
    level = F.array_position(F.array(*[F.lit(h) for h in hidden]), F.col("s")).cast("double") - 1
    steps = states.select(*KEYS, "first", F.posexplode("states").alias("p", "s")).select(
        *KEYS,
        (F.col("first") + F.col("p")).cast("double").alias("pos"),
        level.alias("level"),
    )
    fitted = steps.groupBy(*KEYS).agg(
        F.regr_slope("level", "pos").alias("slope"), F.count(F.lit(1)).alias("n")
    )
    # a level curve is not downward, even where its slope is off 0 by rounding noise
    falling = F.round("slope", 12) < 0
    return fitted.withColumn("downward", F.coalesce(falling, F.lit(False)))


# ------------------------------------------------------------------- training


def _by_length(obs: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal length as one matrix, with their row numbers."""
    lengths = obs.map(len).to_numpy()
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield rows, np.stack([np.asarray(obs.iat[r], dtype=np.int64) for r in rows])


def expected_counts(
    o: np.ndarray,
    weight: np.ndarray,
    before: np.ndarray,
    after: np.ndarray,
    is_first: bool,
    start: np.ndarray,
    step: np.ndarray,
    emit: np.ndarray,
) -> dict[str, np.ndarray]:
    """Forward-backward over pieces of one length, all at once.

    ``before`` is the level distribution at the end of the previous piece (not
    used for first pieces), ``after`` the backward message from the next piece.
    """
    rows, length = o.shape
    # levels by rows, so that every operation runs along the rows
    alpha = np.empty((length, start.size, rows))
    prior = np.broadcast_to(start[:, None], (start.size, rows)) if is_first else step.T @ before.T
    loglik = 0.0
    for t in range(length):
        raw = (prior if t == 0 else step.T @ alpha[t - 1]) * emit[:, o[:, t]]
        norm = raw.sum(axis=0)
        loglik += float(np.log(norm) @ weight)
        alpha[t] = raw / norm
    beta = after.T
    steps = np.zeros_like(step)
    emits = np.zeros_like(emit)
    starts = np.zeros_like(start)
    for t in range(length - 1, -1, -1):
        gamma = alpha[t] * beta
        gamma *= weight / gamma.sum(axis=0)
        for level in range(start.size):
            emits[level] += np.bincount(o[:, t], gamma[level], emit.shape[1])
        if t == 0 and is_first:
            starts += gamma.sum(axis=1)
            break
        source = alpha[t - 1] if t else before.T
        arriving = emit[:, o[:, t]] * beta
        # a row's pairs of levels sum up to its weight; only their sum over the rows is formed
        total = ((step.T @ source) * arriving).sum(axis=0)
        steps += step * ((source * (weight / total)) @ arriving.T)
        beta = step @ arriving
        beta /= beta.sum(axis=0)
    return {"start": starts, "step": steps, "emit": emits, "loglik": np.array([loglik])}


def _flat(parts: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([parts[k].ravel() for k in ("start", "step", "emit", "loglik")])


def _count_batches(model_arrays):
    start, step, emit = model_arrays
    size = start.size + step.size + emit.size + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for pdf in batches:
            for first in (True, False):
                part = pdf[(pdf["segment"] == 0) == first]
                if part.empty:
                    continue
                before = np.array(part["before"].tolist(), dtype=float)
                after = np.array(part["after"].tolist(), dtype=float)
                weight = part["weight"].to_numpy(dtype=float)
                for rows, o in _by_length(part["obs"]):
                    total += _flat(
                        expected_counts(
                            o, weight[rows], before[rows], after[rows], first, start, step, emit
                        )
                    )
        yield pd.DataFrame({"sums": [total]})

    return run


def _pack(kind: np.dtype):
    """Histories of one length as one row: their number, all codes step by step, and their weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            obs, weight = b.column(0), b.column(1).to_numpy()
            codes, ends = obs.flatten().to_numpy(), np.cumsum(obs.value_lengths().to_numpy())
            lengths = np.diff(ends, prepend=0)
            found = []
            for n in np.unique(lengths):
                rows = np.flatnonzero(lengths == n)
                for some in np.array_split(rows, -(-rows.size * int(n) // BLOCK_CODES)):
                    o = codes[(ends[some] - n) + np.arange(n)[:, None]]
                    found.append((int(n), o.astype(kind).tobytes(), weight[some]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found), (pa.int32(), pa.binary(), pa.list_(pa.float64())))], ["length", "codes", "weight"]
            )

    return run


def _count_blocks(model_arrays, kind: np.dtype):
    """The expected counts of packed whole histories."""
    start, step, emit = model_arrays
    size = start.size + step.size + emit.size + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            for length, codes, weight in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                o = np.frombuffer(codes.as_buffer(), kind).reshape(length, -1).T
                nothing = np.ones((o.shape[0], start.size))
                total += _flat(expected_counts(o, weight.values.to_numpy(), nothing, nothing, True, start, step, emit))
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["sums"])

    return run


def _piece_matrices(model_arrays):
    start, step, emit = model_arrays

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = np.empty((len(pdf), step.size))
            opening = (pdf["segment"] == 0).to_numpy()
            for rows, o in _by_length(pdf["obs"]):
                m = np.where(
                    opening[rows][:, None, None], start[None, None, :], step[None]
                ) * emit[:, o[:, 0]].T[:, None, :]
                for t in range(1, o.shape[1]):
                    m = (m @ step) * emit[:, o[:, t]].T[:, None, :]
                    m = m / m.sum(axis=(1, 2), keepdims=True)
                out[rows] = m.reshape(len(rows), -1)
            yield pd.DataFrame(
                {**{k: pdf[k] for k in KEYS}, "segment": pdf["segment"], "m": list(out)}
            )

    return run


def _messages(pdf: pd.DataFrame) -> pd.DataFrame:
    """Forward and backward messages between the pieces of one customer."""
    pdf = pdf.sort_values("segment")
    matrices = np.array(pdf["m"].tolist())
    size = int(round(matrices.shape[1] ** 0.5))
    matrices = matrices.reshape(-1, size, size)
    n = len(matrices)
    before = np.full((n, size), 1.0 / size)
    after = np.ones((n, size))
    for k in range(1, n):
        v = before[k - 1] @ matrices[k - 1]
        before[k] = v / v.sum()
    for k in range(n - 2, -1, -1):
        v = matrices[k + 1] @ after[k + 1]
        after[k] = v / v.sum()
    return pd.DataFrame(
        {**{k: pdf[k] for k in KEYS}, "segment": pdf["segment"], "before": list(before), "after": list(after)}
    )


def starting_model(
    seed: int = 11, hidden: Sequence[str] = HIDDEN, observable: Sequence[str] = OBSERVABLE
) -> HiddenMarkov:
    """A nearly even model, tilted by the seed so that the levels can part."""
    rng = np.random.default_rng(seed)

    def rows(n, m):
        p = 1.0 + 0.2 * rng.random((n, m))
        return tuple(map(tuple, p / p.sum(axis=1, keepdims=True)))

    h, o = len(hidden), len(observable)
    return HiddenMarkov(rows(1, h)[0], rows(h, h), rows(h, o), tuple(hidden), tuple(observable))


def _ordered(start, step, emit, hidden, observable) -> HiddenMarkov:
    """Name the levels by the amount they spend, least first, where the states tell amounts."""
    amounts = {"L": 0.0, "S": 1.0, "M": 2.0}
    rank = np.arange(len(hidden))
    if all(o[-1:] in amounts for o in observable):
        rank = np.argsort(emit @ np.array([amounts[o[-1]] for o in observable]), kind="stable")
    return HiddenMarkov(
        tuple(start[rank]),
        tuple(map(tuple, step[np.ix_(rank, rank)])),
        tuple(map(tuple, emit[rank])),
        tuple(hidden),
        tuple(observable),
    )


class Training(NamedTuple):
    model: HiddenMarkov
    loglik: list[float]


def hmm_train(
    observations: DataFrame,
    epsilon: float = 1e-4,
    max_iterations: int = 1000,
    seed: int = 11,
    piece: int = PIECE,
    start_model: HiddenMarkov | None = None,
    hidden: Sequence[str] = HIDDEN,
    observable: Sequence[str] = OBSERVABLE,
) -> Training:
    """Baum-Welch over all customers; stops when no probability moves by ``epsilon``.

    Equal histories are counted once with their weight, and packed by length once,
    so that a round does no work per row in Python. Per round the driver
    receives as many sums as the model has numbers from each task, which has 128 MB of packed histories. A start
    model brings its own alphabets.
    """
    model = start_model or starting_model(seed, hidden, observable)
    hidden, observable = model.hidden, model.observable
    pieces = durable(observation_pieces(observations, piece, observable))
    long_keys = durable(pieces.where("segment > 0").select(*KEYS).distinct())
    any_long = not long_keys.isEmpty()
    short = pieces.join(long_keys, KEYS, "left_anti") if any_long else pieces
    kind = np.min_scalar_type(len(observable) - 1)
    weighted = short.groupBy("obs").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    sorted_ = weighted.sortWithinPartitions(F.size("obs"))
    short = durable(sorted_.mapInArrow(_pack(kind), "length int, codes binary, weight array<double>"))
    long = durable(pieces.join(long_keys, KEYS, "left_semi")) if any_long else None

    arrays = tuple(np.array(p, dtype=float) for p in model[:3])
    history: list[float] = []
    for _ in range(max_iterations):
        work = short.mapInArrow(_count_blocks(arrays, kind), "sums array<double>")
        if long is not None:
            vector = "array<double>"
            keyed = "idsite bigint, user string, segment int"
            mats = long.select(*KEYS, "segment", "obs").mapInPandas(
                _piece_matrices(arrays), f"{keyed}, m {vector}"
            )
            mail = mats.groupBy(*KEYS).applyInPandas(
                _messages, f"{keyed}, before {vector}, after {vector}"
            )
            parts = long.join(mail, [*KEYS, "segment"]).select(
                "segment", "obs", F.lit(1.0).alias("weight"), "before", "after"
            )
            work = work.unionByName(parts.mapInPandas(_count_batches(arrays), "sums array<double>"))
        # a job of one stage: what a round costs beyond its arithmetic counts as often as there are rounds
        flat = np.sum([row["sums"] for row in work.collect()], axis=0)
        if not np.any(flat):
            raise ValueError("no observations to train on")
        cut = np.cumsum([a.size for a in arrays])
        history.append(float(flat[-1]))
        fresh = []
        for old, block in zip(arrays, np.split(flat[:-1], cut[:-1])):
            counts = block.reshape(old.shape)
            total = counts.sum(axis=-1, keepdims=True)
            fresh.append(np.where(total > 0, counts / np.where(total > 0, total, 1.0), old))
        moved = max(float(np.abs(a - b).max()) for a, b in zip(arrays, fresh))
        arrays = tuple(fresh)
        if moved < epsilon:
            break
    return Training(_ordered(*arrays, hidden, observable), history)


def model_table(spark: SparkSession, model: HiddenMarkov) -> DataFrame:
    """The model's numbers as rows (part, state, target, prob)."""
    rows = [("start", "", h, float(p)) for h, p in zip(model.hidden, model.start)]
    rows += [
        ("step", a, b, float(p))
        for a, line in zip(model.hidden, model.step)
        for b, p in zip(model.hidden, line)
    ]
    rows += [
        ("emit", a, b, float(p))
        for a, line in zip(model.hidden, model.emit)
        for b, p in zip(model.observable, line)
    ]
    return spark.createDataFrame(rows, "part string, state string, target string, prob double")
