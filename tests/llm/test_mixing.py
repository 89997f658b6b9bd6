"""Rates against a dense solver, and the soft classifier on labels it has not seen."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import mixing
from patronage.llm.queries import REGISTRY, SHARES


def dense_rates(n, p, targets, ridge, rounds=20_000):
    w = n / n.sum()
    b = np.array(targets) / n.sum()
    inverse = np.linalg.inv((p * w[:, None]).T @ p)
    r = np.ones(len(n))
    for _ in range(rounds):
        r = np.maximum(0, r - (p @ (inverse @ ((w * r) @ p - b)) + ridge * (r - 1)) / (1 + ridge))
    return r


def as_weights(spark, n, p):
    rows = [(i, int(a), [float(x) for x in b]) for i, (a, b) in enumerate(zip(n, p, strict=True))]
    return spark.createDataFrame(rows, "id long, n_tokens long, posterior array<double>")


@pytest.mark.parametrize("shares", [[0.5, 1.25, 0.9], [0.0, 3.0, 0.1], [1.0, 1.0, 1.0]])
def test_rates_equal_a_dense_solver_and_are_optimal(spark, shares):
    rng = np.random.default_rng(4)
    n, p = rng.integers(0, 500, 300), rng.dirichlet([0.3, 0.4, 0.2], 300)
    targets = (n @ p) * np.array(shares)
    weights = as_weights(spark, n, p)
    steps = mixing.fit_rates(weights, targets.tolist(), rounds=400, tolerance=1e-12)
    got = np.array([r.rate for r in mixing.rates(weights, steps, 3).orderBy("id").collect()])
    want = dense_rates(n, p, targets, mixing.RIDGE)
    w, g = n / n.sum(), targets / n.sum()
    inverse = np.linalg.inv((p * w[:, None]).T @ p)

    def cost(r):
        off = (w * r) @ p - g
        return off @ inverse @ off / 2 + mixing.RIDGE / 2 * (w @ (r - 1) ** 2)

    assert (got >= 0).all() and cost(got) <= cost(want) * 1.001 + 1e-9
    if shares != [0.0, 3.0, 0.1]:
        assert np.allclose(got, want, atol=1e-4)
    if shares[0] == 0.5:  # within reach: the totals are met
        assert np.allclose((got * n) @ p, targets, rtol=0.02)


def test_copies_have_the_rate_as_their_mean(spark):
    df = spark.range(20_000).select("id", mixing.copies(F.lit(1.3), F.col("id")).alias("c"), mixing.copies(F.lit(0.0), F.col("id")).alias("z"))
    mean, least, most, zero = df.agg(F.avg("c"), F.min("c"), F.max("c"), F.max("z")).first()
    assert mean == pytest.approx(1.3, abs=0.02) and (least, most, zero) == (1, 2, 0)


def test_posteriors_of_unseen_labels(spark, small):
    sf = small.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    known = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", mixing.domain(F.col("quality"), F.col("toxic")).alias("domain"))
    found = mixing.fit_classifier(docs, known.where("doc_id % 4 <> 0")).posteriors(docs.join(known.where("doc_id % 4 = 0").select("doc_id"), "doc_id", "left_semi"))
    best = F.array_position("posterior", F.array_max("posterior")) - 1
    joined = found.join(known.withColumnRenamed("doc_id", "id"), "id")
    total, right = joined.agg(F.count("*"), F.count_if(best == F.col("domain"))).first()
    assert right >= 0.9 * total
    assert found.where(F.abs(F.aggregate("posterior", F.lit(0.0), lambda a, x: a + x) - 1) > 1e-9).isEmpty()


def test_nulls_empty_texts_and_odd_columns(spark):
    rows = [(1, "good words here", "x"), (2, None, "x"), (3, "", "x"), (None, "good words", "x"), (4, "%% ** ## bad", "x"), (4, "%% ** ## bad", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _copies string")
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (None, 1, 0), (9, None, None)], "doc_id long, quality int, toxic int")
    mixed = mixing.mix(docs, labels, {"plain": 1.0, "good": 1.0, "toxic": 1.0})
    got = mixed.collect()
    assert len(got) == len(rows) and all(r.rate >= 0 for r in got)
    assert {r.doc_id: r.n_tokens for r in got} == {1: 3, 2: 0, 3: 0, None: 2, 4: 4}
    one = mixed.withColumn("copies", F.when(F.col("doc_id") == 1, 2).otherwise(1))
    again = mixing.apply_copies(docs, one)
    assert again.columns == docs.columns and again.count() == len(rows) + 1
    assert mixing.mix(docs.limit(0), labels, {"plain": 1.0, "good": 1.0, "toxic": 1.0}).isEmpty()


def test_without_labels_every_domain_is_as_likely(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = mixing.mix(docs, labels, {"plain": 2.0, "good": 2.0, "toxic": 2.0}).first()
    assert found.posterior == pytest.approx([1 / 3] * 3) and found.rate == pytest.approx(2.0, rel=0.01)


def test_texts_that_share_an_identifier_take_their_own_decisions(spark):
    """A third without an identifier, a third with one in common, a third with their own; every domain in each."""
    texts = {"good": "calm river stones lie under clear water {}", "toxic": "%% ** ## $$ hate {}", "plain": "list item entry number {}"}
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else 1000 + i, texts[kind].format(i), kind) for kind in texts for i in range(300)]
    rows += [(None, None, "good"), (None, "", "good")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _mixed_id string")
    labelled = [(1000 + i, texts[kind].format(i), kind) for kind, start in (("good", 9000), ("toxic", 9300), ("plain", 9600)) for i in range(start, start + 100)]
    known = spark.createDataFrame([(i, int(kind == "good"), int(kind == "toxic")) for i, _, kind in labelled], "doc_id long, quality int, toxic int")
    every = docs.unionByName(spark.createDataFrame(labelled, docs.schema))
    mixed = mixing.mix(every, known, {"plain": 0.5, "good": 1.25, "toxic": 0.05})
    assert mixed.count() == every.count()
    again = mixing.apply_copies(every, mixed)
    seen = again.where("doc_id IS NULL OR doc_id = 7").groupBy("doc_id", "text", F.col("_mixed_id").alias("kind")).count().collect()
    assert sum(r["count"] for r in seen) > 0
    for ident in (None, 7):
        n = {kind: [r["count"] for r in seen if r.doc_id == ident and r.kind == kind and r.text] for kind in texts}
        assert len(n["good"]) == 100 and 110 <= sum(n["good"]) <= 140, "good ones stay and some are repeated"
        assert 30 <= len(n["plain"]) <= 70 and len(n["toxic"]) <= 20, "each takes a draw of its own"


def test_query_meets_a_dense_solver(spark, small):
    """The rates of the whole query are those of a dense solver on its posteriors, and copies follow them."""
    rows = REGISTRY["op3_mixing"](spark, small).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len((t or "").split()) for i, t in docs.items()}
    n, p = np.array([r.n_tokens for r in rows]), np.array([r.posterior for r in rows])
    assert np.allclose(p.sum(axis=1), 1)
    targets = (n @ p) * np.array([SHARES[d] for d in mixing.DOMAINS])
    got, want = np.array([r.rate for r in rows]), dense_rates(n, p, targets, mixing.RIDGE)
    assert np.abs((got * n) @ p - (want * n) @ p).max() < 0.005 * n.sum() and np.abs(got - want).mean() < 0.02
    assert all(np.floor(r.rate) <= r.copies <= np.floor(r.rate) + 1 for r in rows)


def test_labels_that_share_an_identifier_and_no_labels(spark):
    docs = spark.createDataFrame([(1, "good words"), (2, "bad words"), (None, "x"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 0, 1), (None, 1, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    assert mixing.mix(docs, labels, SHARES).count() == 4
    none = mixing.mix(docs, labels.where("false"), SHARES).collect()
    assert len(none) == 4 and all(r.rate >= 0 for r in none)
