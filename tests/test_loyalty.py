import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.operators import loyalty as h
from patronage.plans.settings import MODEL


def observations(spark, sequences):
    rows = [
        (1, f"c{c}", f"o{i}", i * 1000, h.OBSERVABLE[o], i, 0)
        for c, seq in enumerate(sequences)
        for i, o in enumerate(seq)
    ]
    return spark.createDataFrame(
        rows,
        "idsite bigint, user string, idorder string, timestamp bigint, state string, step bigint, slot bigint",
    )


def random_sequences(n, longest, seed):
    r = random.Random(seed)
    return [[r.randrange(9) for _ in range(r.randint(1, longest))] for _ in range(n)]


def log_probability(path, seq):
    total = math.log(MODEL.start[path[0]]) + math.log(MODEL.emit[path[0]][seq[0]])
    for a, b, o in zip(path, path[1:], seq[1:]):
        total += math.log(MODEL.step[a][b]) + math.log(MODEL.emit[b][o])
    return total


def decoded(spark, sequences, piece):
    rows = h.loyalty_states(observations(spark, sequences), MODEL, piece).collect()
    out = {}
    for r in sorted(rows, key=lambda r: r.segment):
        out.setdefault(r.user, []).extend(r.states)
    return [out[f"c{c}"] for c in range(len(sequences))]


@pytest.mark.parametrize("piece", [1, 2, 10_000])
def test_viterbi_equals_brute_force(spark, piece):
    sequences = random_sequences(25, 6, 3)
    for seq, states in zip(sequences, decoded(spark, sequences, piece)):
        best = max(itertools.product(range(3), repeat=len(seq)), key=lambda p: log_probability(p, seq))
        assert states == [h.HIDDEN[i] for i in best]


def test_long_history_in_pieces_equals_one_piece(spark):
    sequences = random_sequences(2, 1, 5) + [[random.Random(9).randrange(9) for _ in range(700)]]
    assert decoded(spark, sequences, 50) == decoded(spark, sequences, 10_000)


def test_training_improves_and_does_not_depend_on_pieces(spark):
    obs = observations(spark, random_sequences(40, 12, 7))
    whole = h.hmm_train(obs, max_iterations=6)
    assert all(b >= a - 1e-9 for a, b in zip(whole.loglik, whole.loglik[1:]))
    cut = h.hmm_train(obs, max_iterations=6, piece=4)
    assert np.allclose(whole.loglik, cut.loglik, rtol=1e-10)
    for a, b in zip(whole.model[:3], cut.model[:3]):
        assert np.allclose(a, b, atol=1e-8)
    for row in (whole.model.start, *whole.model.step, *whole.model.emit):
        assert sum(row) == pytest.approx(1.0)


def test_loglik_equals_sum_over_all_paths(spark):
    sequences = random_sequences(12, 5, 11)
    got = h.hmm_train(observations(spark, sequences), max_iterations=1, start_model=MODEL)
    want = sum(
        math.log(
            sum(
                math.exp(log_probability(p, seq))
                for p in itertools.product(range(3), repeat=len(seq))
            )
        )
        for seq in sequences
    )
    assert got.loglik[0] == pytest.approx(want, rel=1e-12)


def test_training_stops_at_epsilon(spark):
    obs = observations(spark, random_sequences(10, 8, 13))
    got = h.hmm_train(obs, epsilon=0.5, max_iterations=50)
    assert len(got.loglik) < 50


def test_levels_are_named_by_amount(spark):
    model = h.hmm_train(observations(spark, random_sequences(30, 10, 17)), max_iterations=4).model
    amount = [{"L": 0, "S": 1, "M": 2}[o[1]] for o in h.OBSERVABLE]
    means = [sum(p * a for p, a in zip(row, amount)) for row in model.emit]
    assert means == sorted(means)


def test_trend(spark):
    rows = [(1, "down", 0, ["H", "N", "L"]), (1, "flat", 0, ["L", "H", "L"]), (1, "one", 0, ["H"]),
            (1, "up", 0, ["L", "L", "N"]), (1, "up", 3, ["H"])]
    df = spark.createDataFrame(rows, "idsite bigint, user string, first bigint, states array<string>")
    got = {r.user: r for r in h.loyalty_trend(df).collect()}
    assert got["down"].downward and got["down"].slope == pytest.approx(-1)
    assert not got["flat"].downward and not got["one"].downward and got["one"].slope is None
    assert got["up"].n == 4 and got["up"].slope == pytest.approx(0.7)


def test_trend_does_not_depend_on_pieces(spark):
    obs = observations(spark, random_sequences(10, 30, 21))
    def slopes(piece):
        levels = h.loyalty_states(obs, MODEL, piece)
        return {r.user: (r.n, round(r.slope, 9) if r.slope is not None else None) for r in h.loyalty_trend(levels).collect()}
    assert slopes(2) == slopes(7) == slopes(10_000)


def test_unknown_states_are_errors(spark):
    df = observations(spark, [[0, 1]]).withColumn("state", F.lit("??"))
    with pytest.raises(Exception, match="unknown state"):
        h.loyalty_states(df, MODEL).collect()


def test_other_alphabets(spark):
    obs = observations(spark, [[0, 1, 0, 1, 2], [2, 2, 1, 0]] * 5)
    found = h.hmm_train(obs, max_iterations=3, hidden=("p", "q"), observable=h.OBSERVABLE[:3]).model
    assert found.hidden == ("p", "q") and len(found.emit) == 2 and len(found.emit[0]) == 3
    states = h.loyalty_states(obs, found).collect()
    assert {x for r in states for x in r.states} <= {"p", "q"} and all(r.first == 0 for r in states)
    assert h.model_table(spark, found).count() == 2 + 4 + 6


def test_a_round_is_one_job_of_one_stage_on_packed_histories(spark):
    obs = observations(spark, random_sequences(40, 12, 23))
    tracker = spark.sparkContext.statusTracker()

    def stages(rounds):
        spark.sparkContext.setJobGroup(f"rounds-{rounds}", "")
        try:
            h.hmm_train(obs, epsilon=0.0, max_iterations=rounds)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs = tracker.getJobIdsForGroup(f"rounds-{rounds}")
        return sum(len(tracker.getJobInfo(j).stageIds) for j in jobs)

    assert stages(6) - stages(2) == 4


def test_packing_keeps_every_history_and_its_weight(spark, monkeypatch):
    monkeypatch.setattr(h, "BLOCK_CODES", 7)
    rows = [([1, 2, 3], 2.0), ([4], 1.0), ([0, 8, 7], 5.0), ([6, 5, 4], 1.0), ([3], 4.0), ([2] * 20, 1.0)]
    kind = np.min_scalar_type(8)
    found = []
    for r in spark.createDataFrame(rows, "obs array<int>, weight double").mapInArrow(h._pack(kind), "length int, codes binary, weight array<double>").collect():
        o = np.frombuffer(bytes(r["codes"]), kind).reshape(r["length"], -1).T
        assert o.size <= 7 or len(o) == 1
        found += [(line.tolist(), w) for line, w in zip(o, r["weight"], strict=True)]
    assert sorted(found) == sorted(rows)
