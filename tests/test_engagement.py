"""Transactions, preferences and states on small hand-made inputs."""

import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage import schemas
from patronage.operators import markov, preferences, recommend, transactions as tx
from patronage.session import scratch

USER = bytes.fromhex("b65ce95de5c8e7ea")
BASKETS = {  # order -> (epoch ms, items)
    "A10000124": (1407986582000, [1, 2, 4, 5]),
    "A10000123": (1407931845000, [2, 3, 5]),
    "A10000125": (1407986689000, [1, 2, 4, 5]),
}


def item_rows(spark, baskets, deleted=()):
    rows = []
    for order, (ms, items) in baskets.items():
        t = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms)
        rows += [(1, USER, t, order, i, 1.0, 1.0, (order, i) in deleted) for i in items]
    return spark.createDataFrame(rows, schemas.CONVERSION_ITEM)


def test_baskets(spark):
    got = tx.order_baskets(item_rows(spark, BASKETS)).collect()
    assert {(r.user, r.idorder): (r.timestamp, r["items"]) for r in got} == {
        ("b65ce95de5c8e7ea", o): v for o, v in BASKETS.items()
    }


def test_order_with_only_deleted_items_disappears(spark):
    rows = item_rows(spark, BASKETS, {("A10000123", i) for i in (2, 3, 5)} | {("A10000124", 1)})
    got = {r.idorder: r["items"] for r in tx.order_baskets(rows).collect()}
    assert got == {"A10000124": [2, 4, 5], "A10000125": [1, 2, 4, 5]}


def test_same_order_id_of_two_customers_is_two_baskets(spark):
    one = item_rows(spark, {"X": (0, [1])})
    two = one.withColumn("idvisitor", F.unhex(F.lit("0A")))
    assert tx.order_baskets(one.unionByName(two)).count() == 2


def test_customer_sequence_is_ordered_by_time(spark):
    got = tx.customer_sequences(tx.order_baskets(item_rows(spark, BASKETS))).collect()
    assert [b.idorder for b in got[0].baskets] == ["A10000123", "A10000124", "A10000125"]


def test_long_sequences_are_cut_but_whole(spark):
    many = {f"o{i}": (i * 86_400_000 * 3, [i]) for i in range(25)}
    got = tx.customer_sequences(tx.order_baskets(item_rows(spark, many)), max_items=10).collect()
    assert sorted(len(r.baskets) for r in got) == [5, 10, 10]


def test_sequence_rows_are_bounded_in_items(spark):
    many = {f"o{i:02}": (i * 86_400_000, list(range(1 + i % 4))) for i in range(30)}
    got = tx.customer_sequences(tx.order_baskets(item_rows(spark, many)), max_items=8).orderBy("segment").collect()
    assert [b.idorder for r in got for b in r.baskets] == sorted(many)
    assert all(sum(len(b["items"]) for b in r.baskets) <= 8 + 4 for r in got) and len(got) > 5


def test_numbers_are_dense(spark):
    got = tx.numbered_baskets(tx.order_baskets(item_rows(spark, BASKETS))).collect()
    assert sorted(r.lno for r in got) == [0, 1, 2]


def test_preferences_of_one_customer(spark):
    lines = tx.basket_lines(item_rows(spark, BASKETS))
    assert preferences.user_totals(lines).first().total == 3
    supp = {r.item: r.supp for r in preferences.user_item_support(lines).collect()}
    assert supp == {1: 2, 2: 3, 3: 1, 4: 2, 5: 3}
    scores = preferences.preference_scores(lines).collect()
    assert {r["product"]: r.score for r in scores} == {str(i): 5 for i in supp}


def test_repeated_item_in_an_order_counts_once(spark):
    lines = tx.basket_lines(item_rows(spark, {"a": (0, [7, 7, 7]), "b": (5, [8])}))
    supp = {r.item: r.supp for r in preferences.user_item_support(lines).collect()}
    assert supp == {7: 1, 8: 1}


def test_a_weak_preference_scores_zero(spark):
    rows = [(1, "strong", "o0", 0, 9)]
    rows += [(1, "weak", f"w{i}", 0, 1 if i else 9) for i in range(40)]
    lines = spark.createDataFrame(rows, "idsite bigint, user string, idorder string, timestamp bigint, item bigint")
    scores = {(r.user, r["product"]): r.score for r in preferences.preference_scores(lines).collect()}
    assert scores[("1|weak", "9")] == 0 and scores[("1|strong", "9")] == 5


def test_bounds_keep_10_and_drop_20(spark):
    rows = [(f"u{n}", str(i), 1) for n in (9, 10, 19, 20) for i in range(n)]
    df = spark.createDataFrame(rows, "user string, product string, score int")
    kept = preferences.bounded_users(df).select("user").distinct().collect()
    assert sorted(r.user for r in kept) == ["u10", "u19"]


def test_json_documents_are_parts_by_rank(spark):
    rows = [("u", str(i), i % 6) for i in range(50)] + [("v", "1", 2)]
    df = spark.createDataFrame(rows, "user string, product string, score int")
    found = preferences.preferences_json(df, 20).orderBy("user", "part").collect()
    docs = [json.loads(r.json) for r in found]
    assert [(d["part"], d["parts"], len(d["items"])) for d in docs] == [(0, 3, 20), (1, 3, 20), (2, 3, 10), (0, 1, 1)]
    mine = [(d["product"], d["score"]) for doc in docs[:3] for d in doc["items"]]
    assert mine == sorted(((p, s) for u, p, s in rows if u == "u"), key=lambda x: (-x[1], x[0]))


DAY = 86_400_000


def transactions(spark, history):
    rows = [(1, "u", f"o{i}", int(d * DAY), float(r), 0.0) for i, (d, r) in enumerate(history)]
    return spark.createDataFrame(
        rows, "idsite bigint, user string, idorder string, timestamp bigint, "
        "revenue_subtotal double, revenue_discount double"
    )


def test_states(spark):
    t = transactions(spark, [(0, 100), (89, 50), (179, 45), (419, 49.5), (500, 200), (501, 0), (502, 5), (503, 5)])
    got = markov.transaction_states(t).orderBy("timestamp").collect()
    # 90 days are medium, 240 long; ratios of 0.9 and 1.1 are still equal; after zero revenue anything is greater
    assert [r.state for r in got] == ["SL", "ME", "LE", "SG", "SL", "SG", "SE"]
    assert [r.step for r in got] == list(range(7))
    assert got[5].ratio is None


def test_transitions_sum_to_one_and_horizon(spark):
    t = transactions(spark, [(0, 10), (10, 20), (20, 40), (30, 80), (130, 80), (140, 160)])
    st = markov.transaction_states(t)
    assert [r.state for r in st.orderBy("step").collect()] == ["SG", "SG", "SG", "ME", "SG"]
    probs = markov.transition_probs(markov.transition_counts(st))
    sums = probs.groupBy("state").agg(F.sum("prob").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in sums)
    ahead = markov.next_state(t, st).first()
    assert (ahead.state, ahead.next, ahead.basis) == ("SG", "SG", "own")
    assert ahead.prob == pytest.approx(2 / 3)
    plan = markov.purchase_horizon(t, st).first()
    assert plan.next_timestamp == 150 * DAY and plan.next_amount == pytest.approx(320)


def test_one_purchase_has_no_horizon(spark):
    t = transactions(spark, [(0, 10)]).withColumn("user", F.lit("single")).unionByName(
        transactions(spark, [(0, 1), (5, 2)])
    )
    st = markov.transaction_states(t)
    got = {r.user: r for r in markov.purchase_horizon(t, st).collect()}
    assert got["single"].next_timestamp is None and got["single"].next is None
    ahead = {r.user: r for r in markov.next_state(t, st).collect()}
    assert (ahead["single"].next, ahead["single"].basis) == ("SG", "start")
    assert ahead["u"].next is None  # nobody ever left this state


def test_request_pairs_are_positional(spark):
    got = recommend.request_pairs(spark, "a,b,c", "1,2").collect()
    assert [(r.user, r["product"]) for r in got] == [("a", "1"), ("b", "2")]


def test_training_parameters():
    got = recommend.training_parameters({"iter": "5", "lambda": "0.1", "site": "1"})
    assert got == {"iterations": 5, "regularization": 0.1}


def factors(spark):
    u = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0])], "user string, factors array<float>")
    p = spark.createDataFrame(
        [("x", [3.9, 1.0]), ("y", [-0.7, 4.0]), ("z", [1.0, 4.0])], "product string, factors array<float>"
    )
    return u, p


def test_predictions(spark):
    u, p = factors(spark)
    pairs = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("q", "x")], "user string, product string")
    got = recommend.predict_pairs(pairs, u, p).collect()
    assert [(r.user, r["product"], r.score) for r in got] == [("a", "x", 3), ("b", "x", 2), ("a", "y", 0)]


def test_top_n_ties_by_product(spark):
    u, p = factors(spark)
    got = recommend.recommend_top_n(u.where("user = 'b'"), 2, u, p).collect()
    assert [(r["product"], r.rating) for r in got] == [("y", 8.0), ("z", 8.0)]


def test_a_request_may_name_any_number_of_users(spark):
    u = spark.range(1_100).selectExpr("concat('u', id) AS user", "array(cast(id + 1 AS float), 0f) AS factors")
    _, p = factors(spark)
    got = recommend.recommend_top_n(u, 1, u, p).collect()
    assert {(r.user, r["product"]) for r in got} == {(f"u{i}", "x") for i in range(1_100)}
    assert recommend.recommend_top_n(u.limit(0), 1, u, p).isEmpty()


@pytest.mark.parametrize("rank", [3, 40])
def test_a_task_rates_a_bounded_number_of_pairs(spark, rank):
    """Two million ratings of a small input go to eight tasks, and each pair is rated once and right."""
    listed = "transform(sequence(1, {}), r -> cast((id * r + {}) % 17 / 8 - 1 AS {}))"
    u = spark.range(2_000).coalesce(1).selectExpr("concat('u', id) AS user", f"{listed.format(rank, 3, 'float')} AS factors")
    p = spark.range(1_000).coalesce(1).selectExpr("concat('p', id) AS product", f"{listed.format(rank, 5, 'double')} AS factors")
    rated = recommend._against_request(u, p, u)
    assert rated.rdd.getNumPartitions() == 8
    assert rated.groupBy().agg(F.count(F.lit(1)), F.count_distinct("user", "product")).first()[:] == (2_000_000, 2_000_000)
    uf, pf = ({r[0]: np.array(r[1]) for r in df.collect()} for df in (u, p))
    got = rated.where("user IN ('u0', 'u1', 'u1999')").collect()
    assert len(got) == 3_000 and all(r.rating == uf[r.user] @ pf[r["product"]] for r in got)
    short = recommend.predict_user_items(u.limit(0), p, u, p)
    assert short.columns == ["user", "product", "score", "rating"] and short.isEmpty()


def test_predictions_as_json_in_rating_order(spark):
    u, p = factors(spark)
    rated = recommend.predict_user_items(u, p, u, p)
    docs = {r.user: json.loads(r.json)["items"] for r in recommend.predictions_json(rated).collect()}
    assert [d["product"] for d in docs["a"]] == ["x", "z", "y"] and [d["product"] for d in docs["b"]] == ["y", "z", "x"]


def test_a_stored_model_gives_the_same_ratings(spark):
    rows = [(f"u{i}", str(j), (i * 7 + j) % 6) for i in range(12) for j in range(15) if (i + j) % 4]
    scores = spark.createDataFrame(rows, "user string, product string, score int")
    users, products = preferences.dictionary(scores, "user"), preferences.dictionary(scores, "product")
    ratings = preferences.rating_matrix(scores, users, products)
    fitted = recommend.Recommender(users, products, recommend.als_train(ratings, rank=3, iterations=4, partitions=2))
    assert recommend.solved_users(fitted, ratings).where("NOT solved").isEmpty()
    root = scratch(spark, "store")
    recommend.save_model(fitted, root, "m", 1)
    recommend.save_model(fitted, root, "m", 2)
    loaded = recommend.load_model(spark, root, "m")
    assert recommend.latest_models(spark, root).collect()[0].saved_at == 2
    pairs = scores.select("user", "product")
    before = recommend.predict_pairs(pairs, *recommend.factor_tables(fitted)).collect()
    assert recommend.predict_pairs(pairs, *recommend.factor_tables(loaded)).collect() == before


def test_an_order_in_segments_has_one_number(spark):
    got = tx.numbered_baskets(tx.order_baskets(item_rows(spark, BASKETS), max_items=2)).collect()
    assert {r.lno for r in got} == {0, 1, 2} and len(got) > 3


@pytest.mark.parametrize(("n", "block"), [(1, 4), (3, 7), (5, 1000)])
def test_everyone_gets_the_best_of_all_ratings(spark, n, block):
    """Ties, equal norms, zero and negative factors included; most ratings are not computed."""
    r = random.Random(n)
    users = [(f"u{i}", [r.choice([-1.0, 0.0, 0.5, 1.0, r.uniform(-2, 2)]) for _ in range(3)]) for i in range(70)] + [("zero", [0.0] * 3)]
    items = [(f"p{i}", [r.gauss(0, 1) * (10 if i < 12 else 0.1) for _ in range(3)]) for i in range(300)] + [(f"q{i}", [1.0, 1.0, 1.0]) for i in range(6)]
    u = spark.createDataFrame(users, "user string, factors array<double>")
    p = spark.createDataFrame(items, "product string, factors array<double>")
    waves = []
    got = recommend.recommend_everyone(n, u, p, block=block, waves=waves).collect()
    want = []
    for name, f in users:
        scored = sorted((-sum(a * b for a, b in zip(f, g, strict=True)), q) for q, g in items)[:n]
        want += [(name, q, pytest.approx(-s, abs=1e-9)) for s, q in scored]
    assert sorted((x.user, x["product"], x.rating) for x in got) == sorted(want, key=lambda w: w[:2])
    if block == 4:
        assert sum(w["rated"] for w in waves) < 0.5 * len(users) * len(items) and waves[-1]["users"] < waves[0]["users"]
    assert recommend.recommend_everyone(n, u.limit(0), p).isEmpty() and recommend.recommend_everyone(n, u, p.limit(0)).isEmpty()


def test_equal_factors_are_rated_once(spark):
    """Ten thousand users and products of six and five different factors, signed zeros among them."""
    kinds = [[0.0, 1.0], [-0.0, 1.0], [2.0, 1.0], [1.0, -1.0], [0.5, 0.5], [-1.0, 3.0]]
    listed = "array(" + ", ".join(f"array({x[0]}D, {x[1]}D)" for x in kinds) + ")"
    u = spark.range(10_000).selectExpr("concat('u', id) AS user", f"{listed}[id % 6] AS factors")
    p = spark.range(10_000).selectExpr("concat('p', id) AS product", f"{listed}[id % 5] AS factors")
    waves = []
    got = {}
    for r in recommend.recommend_everyone(3, u, p, waves=waves).collect():
        got.setdefault(r.user, []).append((r["product"], r.rating))
    assert len(got) == 10_000 and sum(w["rated"] for w in waves) <= 5 * 12
    for i in (0, 1, 3, 9_999):
        rated = sorted((-sum(a * b for a, b in zip(kinds[i % 6], kinds[j % 5], strict=True)), f"p{j}") for j in range(10_000))
        assert got[f"u{i}"] == [(q, -x) for x, q in rated[:3]]
    asked = recommend.recommend_top_n(u.where("user IN ('u0', 'u9999')"), 3, u, p).collect()
    assert sorted((r.user, r["product"], r.rating) for r in asked) == sorted((k, *x) for k in ("u0", "u9999") for x in got[k])


def test_a_dictionary_grows_at_its_end(spark):
    path = scratch(spark, "terms")
    def terms(*names):
        return spark.createDataFrame([(n,) for n in names], "user string")

    first = preferences.grown_dictionary(preferences.no_terms(spark), terms("b", "a", "a", "c"), "user", 1)
    preferences.store_terms(first, path, 1)
    second = preferences.grown_dictionary(preferences.stored_terms(spark, path), terms("z", "a", "y", "b", "x"), "user", 2)
    preferences.store_terms(second, path, 2)
    one = {r.term: r.idx for r in preferences.stored_terms(spark, path, 1).collect()}
    two = {r.term: r.idx for r in preferences.stored_terms(spark, path).collect()}
    assert sorted(one.values()) == [0, 1, 2] and sorted(two.values()) == list(range(6)) and one.items() <= two.items()
    again = preferences.grown_dictionary(preferences.stored_terms(spark, path, 1), terms("z", "a", "y", "b", "x"), "user", 2)
    preferences.store_terms(again, path, 2)  # a version that is written again replaces itself
    assert {r.term: r.idx for r in preferences.stored_terms(spark, path).collect()} == two
    same = preferences.grown_dictionary(preferences.stored_terms(spark, path), terms("a"), "user", 3)
    assert same.where("version = 3").isEmpty() and same.count() == 6


def fitted(spark):
    rows = [(f"u{i}", str(j), (i * 7 + j) % 6) for i in range(12) for j in range(15) if (i + j) % 4]
    scores = spark.createDataFrame(rows, "user string, product string, score int")
    users, products = preferences.dictionary(scores, "user"), preferences.dictionary(scores, "product")
    ratings = preferences.rating_matrix(scores, users, products)
    return scores, ratings, recommend.Recommender(users, products, recommend.als_train(ratings, rank=3, iterations=6, partitions=2))


def test_folded_in_users_get_the_factors_of_a_fit(spark):
    scores, _, model = fitted(spark)
    users, products = recommend.factor_tables(model)
    got = {r.user: r.factors for r in recommend.fold_in(scores.withColumnRenamed("score", "rating"), products, 3).collect()}
    want = {r.user: r.factors for r in users.collect()}
    assert got.keys() == want.keys() and all(got[u] == pytest.approx(want[u], abs=2e-4) for u in want)
    new = spark.createDataFrame([("n", "1", 5.0), ("n", "2", 0.0), ("n", "unknown", 3.0), ("m", "unknown", 1.0)], "user string, product string, rating double")
    assert [r.user for r in recommend.fold_in(new, products, 3).collect()] == ["n"]
    assert recommend.fold_in(new.limit(0), products, 3).isEmpty()


def test_a_wrong_factor_is_seen(spark):
    """The flag of a fit is false where a user's factors do not solve its equations."""
    _, ratings, model = fitted(spark)

    class Model:
        userFactors = model.model.userFactors.withColumn("features", F.when(F.col("id") == 0, F.transform("features", lambda x: x + 0.05)).otherwise(F.col("features")))
        itemFactors = model.model.itemFactors

    found = recommend.solved_users(recommend.Recommender(model.users, model.products, Model), ratings).collect()
    wrong = model.users.where("idx = 0").first().term
    assert {r.user for r in found if not r.solved} == {wrong}


def test_levels_are_set_by_the_data(spark):
    """Thirds of the rows, ties below, missing values without a level."""
    t = dt.datetime(2024, 1, 1, 9)
    rows = [(1, USER, t, f"o{i}", i, float(i), float(q), False) for i, q in enumerate([1, 1, 1, 1, 2, 2, 3, 4, 5])]
    rows.append((1, USER, t, "o9", 9, None, None, False))
    items = spark.createDataFrame(rows, schemas.CONVERSION_ITEM)
    places = spark.createDataFrame([(1, USER, "o0", "berlin"), (1, USER, "gone", "rome")], "idsite long, idvisitor binary, idorder string, location_country string")
    got = {(r.idorder, r.item) for r in tx.learned_categories(items, places).collect()}
    level = {o: i.split("=")[1] for o, i in got if i.startswith("quantity=")}
    assert level == {f"o{i}": x for i, x in enumerate(["low"] * 4 + ["mid", "mid", "high", "high", "high"])}
    assert {i for o, i in got if o == "o9"} == {"buys=9", "daytime=morning"} and {i for _, i in got if i.startswith("location")} == {"location=berlin"}
    revenue = [i.split("=")[1] for o, i in sorted(got) if i.startswith("revenue=")]
    assert revenue == ["low"] * 3 + ["mid"] * 3 + ["high"] * 3


@pytest.mark.parametrize("accuracy", [4, 100])
def test_edges_are_exact_whatever_the_sketch(spark, accuracy, monkeypatch):
    monkeypatch.setattr(tx, "PAGE", 7)
    r = random.Random(accuracy)
    rows = [(r.choice([1.0, 2.0, 2.0, 3.0]), r.gauss(0, 1), None) for _ in range(3_001)] + [(None, None, None)] * 50
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = tx.quantile_edges(df, ["a", "b", "c"], 3, accuracy).collect()
    a, b = (sorted(x[i] for x in rows if x[i] is not None) for i in (0, 1))
    # of 3001 rows, the 1001st and the 2001st are the first to hold a third and two
    assert [tuple(x) for x in got] == [([a[1000], a[2000]], [b[1000], b[2000]], None)]
