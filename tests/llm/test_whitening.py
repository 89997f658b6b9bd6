"""Whitening against eigh of the dense covariance."""

import math

import numpy as np
import pytest

from patronage.llm import whitening
from patronage.llm.queries import REGISTRY

VECTORS = "vec_id long, embedding array<float>, d string, n int"


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], VECTORS)
    return whitening.whitened_rows(df, **options).collect()


def expected(vectors, k=8):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    z = np.array([[float(n * a - s) / n for a, s in zip(row, sums, strict=True)] for row in x])
    values, columns = np.linalg.eigh(z.T @ z / n)
    order = np.argsort(-values)[:k]
    deviation = [int(sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))) for row in x]
    return deviation, values[order] / values.sum(), z @ columns[:, order] / np.sqrt(values[order])


def check(got, ids, vectors, k=8, near=1e-8):
    deviation, explained, whitened = expected(vectors, k)
    assert len(got) == len(ids) * len(explained)
    table = {(r.vec_id, r.component): r for r in got}
    signs = [1 if table[ids[0], c + 1].whitened * whitened[0, c] > 0 else -1 for c in range(len(explained))]
    for row, i in enumerate(ids):
        for c in range(len(explained)):
            r = table[i, c + 1]
            assert r.n == len(ids) and int(r.deviation) == deviation[row]
            assert r.whitened == pytest.approx(signs[c] * whitened[row, c], abs=near)
            assert r.explained == pytest.approx(explained[c], rel=1e-9) and r.identity_error < 1e-6


def test_equals_dense_decomposition(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(300, 12)) * np.linspace(5, 0.01, 12) + 40).tolist()
    bad = [(900, None), (901, [math.nan] * 12), (902, [math.inf] + [0.0] * 11), (903, [None] + [0.0] * 11), (904, [])]
    check(found(spark, list(enumerate(vectors)) + bad), list(range(300)), vectors)


def test_narrow_directions_keep_their_accuracy(spark):
    """A tight pair of directions beside a wide one, and fewer dimensions than components asked for."""
    rng = np.random.default_rng(4)
    wide = rng.normal(size=(200, 1)) * 40
    vectors = np.hstack([wide, -wide, wide]) + rng.integers(-3, 4, (200, 3)) / 1024
    vectors = np.float32(vectors).tolist()
    check(found(spark, list(enumerate(vectors))), list(range(200)), vectors, near=1e-4)  # variances are nine digits apart


def test_factor_and_rotations():
    rng = np.random.default_rng(5)
    for d, rank in ((1, 1), (2, 2), (7, 3), (33, 33)):
        half = rng.normal(size=(d, rank))
        v = half @ half.T
        factor = whitening.pivoted_cholesky(v)
        assert factor.shape == (d, rank) and np.allclose(factor @ factor.T, v)
        values, columns = whitening.jacobi(factor)
        assert np.allclose(values, np.sort(np.linalg.eigvalsh(v))[::-1][:rank]) and np.allclose(columns.T @ columns, np.eye(rank), atol=1e-12)
        assert np.allclose(v @ columns, columns * values)
    pairs = [(min(a, b), max(a, b)) for x, y in whitening.rounds(7) for a, b in zip(x, y, strict=True)]
    assert sorted(pairs) == [(a, b) for a in range(7) for b in range(a + 1, 7)]


def test_vectors_without_variance_and_of_other_lengths(spark):
    assert found(spark, []) == [] and found(spark, [(1, [1.0, 2.0])]) == [] and found(spark, [(1, [1.0]), (2, [1.0])]) == []
    rows = [(i, [float(i), float(i * i)]) for i in range(6)] + [(i, [float(i)]) for i in range(6, 9)]
    got = found(spark, rows)
    check([r for r in got if r.vec_id < 6], list(range(6)), [v for _, v in rows[:6]])
    check([r for r in got if r.vec_id >= 6], list(range(6, 9)), [v for _, v in rows[6:]])


def test_null_and_repeated_identifiers(spark):
    rows = [(None, [0.0, 1.0]), (7, [2.0, 0.0]), (7, [2.0, 0.0]), (8, [1.0, 5.0])]
    got = found(spark, rows)
    assert len(got) == 8 and sum(r.vec_id is None for r in got) == 2 and {r.n for r in got} == {4}
    one = [r for r in got if r.vec_id == 7 and r.component == 1]
    assert len(one) == 2 and one[0].whitened == one[1].whitened


@pytest.mark.parametrize("n", [3, 10**7, 10**12])
def test_deviations_are_exact_at_any_size(n):
    rng = np.random.default_rng(n % 97)
    x = rng.integers(90_000, 110_000, (20, 5))
    sums = tuple(int(s) for s in rng.integers(99_000 * n, 101_000 * n, 5))
    model = whitening.Whitener(n, sums, np.empty(0), np.empty((5, 0)), 0.0)
    want = [sum((int(a) * n - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    assert [int(v) for v in model.deviations(x).to_pylist()] == want
    far = x * (10**6 if n < 10**9 else 1)  # the long way, where 38 digits hold it
    assert [int(v) for v in model.deviations(far[:2]).to_pylist()] == [sum((int(a) * n - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in far[:2]]


def test_entries_too_large_are_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        found(spark, [(1, [3e38]), (2, [0.0])])


def test_query(spark, small):
    got = REGISTRY["op11_whitening"](spark, small).collect()
    table = spark.read.parquet(f"{small}/embeddings.parquet").orderBy("vec_id").collect()
    check(got, [r.vec_id for r in table], [r.embedding for r in table])
