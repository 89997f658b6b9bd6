"""Reading through the channel, the sparse classifier, and held-out accuracy."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.llm import linear, toxicity as tox
from patronage.llm.queries import REGISTRY

CLEAN = "the morning train left early and every garden by the river was green with rain under a quiet sky of silver".split()
BAD = ["idiot", "stupid", "moron", "worthless", "pathetic"]


def sentence(r, toxic):
    words = [r.choice(CLEAN) for _ in range(r.randrange(8, 20))]
    if toxic:
        words[r.randrange(len(words)) : 0] = r.choices(BAD, k=2)
    return " ".join(words).capitalize() + "."


def corpus(seed=1, n=300):
    r = random.Random(seed)
    return [(i, sentence(r, i % 5 == 0), int(i % 5 == 0)) for i in range(n)]


@pytest.fixture(scope="module")
def channel():
    return tox.Channel(tox.log_model(tox.gram_counts([t for _, t, _ in corpus()])))


@pytest.mark.parametrize(
    ("hidden", "meant"),
    [("1d10t", "idiot"), ("idiooot", "idiot"), ("st00pid", "stoopid"), ("m0r0n!", "moron"), ("i.d.i.o.t", "idiot"), ("p-a-t-h-e-t-i-c", "pathetic"), ("\"p@thet1c\",", "pathetic"), ("w0rthle$$", "worthless")],
)
def test_hidden_words_are_read(channel, hidden, meant):
    assert list(channel.words(hidden)) == ([meant] if meant != "stoopid" else list(channel.words("st00pid")))


def test_words_set_apart_in_a_text(channel):
    assert "idiot" in channel.read_text("you are an I D I O T indeed") and "moron" in channel.read_text("m 0 r o n")
    assert channel.read_text("a b") >= {"a", "b"} and channel.read_text("") == frozenset()
    assert "~" not in "".join(channel.read_text("rain"))
    assert channel.read_text("worthless") == {"worthless", "worth~", "worthl~", "worthle~"}


def test_plain_words_and_punctuation_stay(channel):
    assert list(channel.words("garden")) == ["garden"] and list(channel.words("green,")) == ["green"]
    assert list(channel.words("rain&&&")) == ["rain"] and list(channel.words("sky!!!")) == ["sky"]
    assert list(channel.words("2024")) == [] and list(channel.words("---")) == [] and list(channel.words("été")) == ["été"]


def test_viterbi_equals_all_readings(channel):
    """The best of all strings a lattice holds, scored one by one."""

    def score(text):
        total, state = 0.0, 0
        for c in text + " ":
            s = int(tox.symbols()[ord(c)])
            if s == 0 and state % tox.SYMBOLS == 0:
                continue
            total += float(channel.model[state * tox.SYMBOLS + s])
            state = (state * tox.SYMBOLS + s) % tox.SYMBOLS**3
        return total

    for part, spaced in (("1d10t", False), ("9ree66n", False), ("r41n", False), ("5k1e5", True), ("tr41n", True)):
        steps = channel.lattice(part, spaced)
        readings = [("".join(x for x, _ in way), sum(p for _, p in way)) for way in itertools.product(*steps)]
        best = max(score(text) - price for text, price in readings)
        found = channel.read(steps)
        assert any(abs(score(text) - price - best) < 1e-3 and text.strip() == found for text, price in readings)


def test_model_counts_pieces_alike(monkeypatch):
    texts = ["The rain, the rain!", "", "ÉTÉ  1 2 a", "x" * 50 + " yz" * 30]
    whole = tox.gram_counts(texts)
    words = "".join(c if c.isalpha() else " " for c in "\n".join(["", *texts, ""]).lower())
    plain = " " + " ".join(words.split()) + " "
    s = [int(tox.symbols()[ord(c)]) for c in plain]
    want = np.zeros_like(whole)
    for i in range(len(s) - 3):
        want[((s[i] * 28 + s[i + 1]) * 28 + s[i + 2]) * 28 + s[i + 3]] += 1
    assert (whole == want).all()
    monkeypatch.setattr(tox, "PIECE", 64)
    one = tox.gram_counts(["ab cd " * 100])
    monkeypatch.setattr(tox, "PIECE", 1 << 20)
    assert (one == tox.gram_counts(["ab cd " * 100])).all()
    assert np.allclose(np.exp(tox.log_model(whole)).reshape(-1, 28).sum(axis=1), 1, atol=1e-4)


def test_sparse_fit_is_optimal():
    """No weight can move for the better: the conditions of the minimum hold for every word."""
    r = np.random.default_rng(2)
    n, d = 400, 60
    x = r.random((n, d)) < 0.15
    labels = (x[:, 0] | x[:, 1] | (r.random(n) < 0.05)).astype(int)
    weights = np.where(labels == 1, 1.0, 3.0)
    rows, columns = np.nonzero(x)
    found = linear.solve(rows, columns, np.empty((n, 0)), labels, weights, d, 2, 0.01)
    z = x @ found[:-1] + found[-1]
    e = np.exp(z - z.max(axis=1, keepdims=True))
    off = (e / e.sum(axis=1, keepdims=True) - np.eye(2)[labels]) * (weights / weights.sum())[:, None]
    g = x.T @ off
    assert np.abs(off.sum(axis=0)).max() < 5e-4 and np.abs(g).max() < 0.0105
    used = found[:-1] != 0
    assert used[:2].any() and np.abs(g[used] + 0.01 * np.sign(found[:-1][used])).max() < 5e-4


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t, _ in rows], "doc_id long, text string, toxic string, score double")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows], "doc_id long, toxic int, quality int")
    return docs, labels


def test_held_out_documents_are_told_apart(spark):
    docs, labels = frames(spark, corpus())
    got = tox.score(docs, tox.fit(docs, labels)).join(labels, "doc_id").collect()
    assert len(got) == 300 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 30 and sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held)
    hidden = spark.createDataFrame([(1, "The garden by the river, you 1d10t and m0r0n, was green."), (2, "Every w o r t h l e s s morning, p4th3t1c train."), (3, "The garden by the river was green.")], "doc_id long, text string")
    assert [r.predicted for r in tox.score(hidden, tox.fit(docs, labels)).orderBy("doc_id").collect()] == [1, 1, 0]


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows = corpus()
    docs, labels = frames(spark, rows)
    other = labels.withColumn("toxic", F.when(tox.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = tox.fit(docs, labels), tox.fit(docs, other)
    assert a.weights == b.weights and a.intercept == b.intercept


def test_nulls_repeats_one_kind_and_nothing(spark):
    rows = [*corpus(n=60), (None, "The rain.", 1), (7, None, 0), (7, "", 1), (7, "", 1), (8, " \n", None)]
    docs, labels = frames(spark, rows)
    got = tox.score(docs, tox.fit(docs, labels)).collect()
    assert len(got) == len(rows) and all(r.held_out is not None and 0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 7 and r.score == min(x.score for x in got if x.doc_id == 7)}) == 1
    empty = docs.where("false")
    assert tox.score(empty, tox.fit(empty, labels)).collect() == []
    none = tox.score(docs, tox.fit(docs, labels.where("false"))).collect()
    assert {r.predicted for r in none} == {0}
    all_toxic = tox.score(docs, tox.fit(docs, labels.where("toxic = 1"))).collect()
    assert {r.predicted for r in all_toxic} == {1}


def test_very_long_texts(spark):
    text = "the rain " * 200_000 + "i d i o t " * 3 + "a " * 50_000
    docs, labels = frames(spark, corpus(n=60))
    one = spark.createDataFrame([(1, text), (2, "x" * 3_000_000), (3, "4" * 1_000_000 + "a")], "doc_id long, text string")
    assert len(tox.score(one, tox.fit(docs, labels)).collect()) == 3


@pytest.mark.parametrize("copies", [1, 3000])
def test_sample_is_bounded_whatever_one_identifier_holds(spark, copies):
    docs = spark.range(4000).select(F.when(F.col("id") < copies, 5).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 100 == 5).cast("int").alias("label"))
    got = linear.labelled_sample(docs, labels, 50).collect()
    by = {y: [r for r in got if r.label == y] for y in (0, 1)}
    assert len(by[0]) <= 50 and len(by[1]) <= 40
    assert copies > 1 or (len(by[0]) == 50 and len(by[1]) == 40 and math.isclose(by[0][0].weight, 3960 / 50) and by[1][0].weight == 1.0)


def test_query_on_its_table(spark, small):
    got = REGISTRY["op13_toxicity"](spark, small)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == spark.read.parquet(f"{small}/documents.parquet").count()
