"""Rules, sequences and similarity against brute force."""

import itertools
import random
from collections import Counter, defaultdict

import pytest

from patronage import session
from patronage.operators import rules, similarity

SCHEMA = "idsite bigint, user string, idorder string, item bigint"


def baskets(n=120, items=8, seed=1):
    """A few items sit in most baskets."""
    r = random.Random(seed)
    out = {}
    for i in range(n):
        b = {x for x in range(items) if r.random() < (0.8 if x < 2 else 0.25)}
        if b:
            out[f"o{i}"] = b
    return out


def frame(spark, bs):
    rows = [(1, f"u{hash(o) % 7}", o, x) for o, b in bs.items() for x in b for _ in range(2)]
    return spark.createDataFrame(rows, SCHEMA)


def brute_itemsets(bs, needed):
    counts = Counter(
        s for b in bs.values() for n in range(1, len(b) + 1) for s in itertools.combinations(sorted(b), n)
    )
    return {s: c for s, c in counts.items() if c >= needed}


@pytest.mark.parametrize("support", [0.05, 0.1, 0.5])
def test_itemsets_and_rules(spark, support):
    bs = baskets()
    needed = -(-int(support * len(bs) * 1000) // 1000)
    want = brute_itemsets(bs, max(1, needed))
    found = rules.frequent_itemsets(frame(spark, bs), support)
    assert {tuple(r["items"]): r.support for r in found.collect()} == want
    got = {
        (tuple(r.antecedent), r.consequent): (r.support, round(r.confidence, 9))
        for r in rules.rules_of(found, 0.4).collect()
    }
    expected = {}
    for s, c in want.items():
        for x in s if len(s) > 1 else ():
            rest = tuple(i for i in s if i != x)
            if c / want[rest] >= 0.4:
                expected[rest, x] = (c, round(c / want[rest], 9))
    assert got == expected


def test_top_k_is_sorted_by_support(spark):
    got = rules.top_k_rules(frame(spark, baskets()), 5, 0.3).collect()
    assert len(got) == 5
    keys = [(-r.support, -r.confidence, r.antecedent, r.consequent) for r in got]
    assert keys == sorted(keys)


def test_top_k_has_no_support_floor(spark):
    """The only rules are held by one basket in two hundred."""
    bs = {f"b{i}": {i} for i in range(200)} | {"x": {1000, 1001}, "y": {1002, 1003, 1004}}
    found = rules.top_k_rules(frame(spark, bs), 8, 1.0).collect()
    assert len(found) == 8 and all(r.support == 1 and r.confidence == 1 for r in found)
    assert found == sorted(found, key=lambda r: (r.antecedent, r.consequent))
    assert len(rules.top_k_rules(frame(spark, bs), 100, 1.0).collect()) == 11


def test_also_bought(spark):
    bs = {"a": {1, 2}, "b": {1, 2, 3}, "c": {1, 2, 3}, "d": {4}}
    lines = frame(spark, bs)
    found = rules.association_rules(lines, 0.25, 0.6)
    got = {(r.idorder, r.item): r.confidence for r in rules.also_bought(found, lines).collect()}
    assert got == {("a", 3): pytest.approx(2 / 3)}


def occurrences(customers):
    return [
        (1, c, p, i) for c, seq in customers.items() for p, b in enumerate(seq) for i in b
    ]


def random_histories(n, items, longest, seed):
    r = random.Random(seed)
    return {
        f"c{k}": [
            {r.randrange(items) for _ in range(r.randint(1, 3))} for _ in range(r.randint(1, longest))
        ]
        for k in range(n)
    }


def contains(seq, pattern):
    at = 0
    for itemset in pattern:
        while at < len(seq) and not set(itemset) <= seq[at]:
            at += 1
        if at == len(seq):
            return False
        at += 1
    return True


def test_sequence_patterns_up_to_three_items(spark):
    hist = random_histories(30, 4, 5, 3)
    df = spark.createDataFrame(occurrences(hist), "idsite bigint, user string, pos bigint, item bigint")
    got = {
        tuple(tuple(e) for e in r.pattern): r.support
        for r in rules.sequence_patterns(df, 0.3, 3).collect()
    }
    sets = [s for n in (1, 2, 3) for s in itertools.combinations(range(4), n)]
    want = {}
    for n in (1, 2, 3):
        for pattern in itertools.product(sets, repeat=n):
            if sum(map(len, pattern)) <= 3:
                c = sum(contains(seq, pattern) for seq in hist.values())
                if c >= 9:
                    want[pattern] = c
    assert got == want


def test_sequence_patterns_grow_as_long_as_they_are_frequent(spark):
    hist = {f"c{i}": [{1}, {2, 3}, {4}, {1, 5}] for i in range(4)} | {"x": [{4}, {1}]}
    df = spark.createDataFrame(occurrences(hist), "idsite bigint, user string, pos bigint, item bigint")
    found = {tuple(tuple(e) for e in r.pattern): r.support for r in rules.sequence_patterns(df, 0.8).collect()}
    assert found[((1,), (2, 3), (4,), (1, 5))] == 4 and found[((4,), (1,))] == 5
    assert all(sum(contains(seq, p) for seq in hist.values()) == c for p, c in found.items())
    baskets_of = [((1,),), ((2,), (3,), (2, 3)), ((4,),), ((1,), (5,), (1, 5))]
    subs = {tuple(b for b in p if b) for p in itertools.product(*[((), *b) for b in baskets_of])} - {()}
    assert found.keys() == subs


def brute_similarity(hist):
    out = {}
    for a, b in itertools.permutations(hist, 2):
        x, y = hist[a], hist[b]
        s = sum(len(p & q) / len(p | q) for p, q in zip(x, y)) / max(len(x), len(y))
        if s > 0:
            out[a, b] = s
    return out


def crowd():
    """A third of the customers have the same history, another third share one item."""
    hist = {f"copy{i}": [{1}, {1, 2}] for i in range(15)}
    hist |= {f"near{i}": [{1, 100 + i}, {2, 200 + i}] for i in range(15)}
    hist |= random_histories(15, 6, 4, 5)
    return hist


def as_sequences(spark, hist):
    return spark.createDataFrame(
        occurrences(hist), "idsite bigint, user string, pos bigint, item bigint"
    )


@pytest.mark.parametrize("chunk_rows", [3, 100_000])
@pytest.mark.parametrize("threshold", [0.1, 0.34, 0.5, 0.8, 1.0])
def test_similarity_equals_brute_force(spark, threshold, chunk_rows):
    hist = crowd()
    seqs = as_sequences(spark, hist)
    heads = {r.cid[2:]: r.head[2:] for r in similarity.sequence_groups(seqs).collect()}
    groups = defaultdict(list)
    for c, seq in hist.items():
        groups[tuple(tuple(sorted(b)) for b in seq)].append(c)
    assert heads == {c: min(g) for g in groups.values() for c in g}
    want = {
        (a, b): round(s, 9)
        for (a, b), s in brute_similarity(hist).items()
        if a < b and s >= threshold - 1e-9 and heads[a] == a and heads[b] == b
    }
    got = similarity.similar_histories(seqs, threshold, chunk_rows).collect()
    assert {(r.a[2:], r.b[2:]): round(r.similarity, 9) for r in got} == want
    every = {
        (a, b): round(s, 9) for (a, b), s in brute_similarity(hist).items() if a < b and s >= threshold - 1e-9
    }
    found = similarity.customer_similarity(seqs, threshold, chunk_rows).collect()
    assert len(found) == len(every)
    assert {(r.a[2:], r.b[2:]): round(r.similarity, 9) for r in found} == every


def test_common_items_do_not_bring_histories_together(spark):
    """A hundred histories open alike and share nothing else: no pair is even looked at."""
    hist = {f"c{i}": [{1}, {1000 + i}] for i in range(100)}
    seqs = as_sequences(spark, hist)
    assert similarity.customer_similarity(seqs, 0.8).isEmpty()
    rows = similarity._promising(seqs, 100_000).collect()
    common = [r for r in rows if r["item"] == 1]
    assert len(common) == 100 and all(1 / r.n + r.after < 0.8 * r.len for r in common)


def test_top_k_similar(spark):
    hist = crowd()
    chosen = spark.createDataFrame([("1|copy3",), ("1|c1",)], "cid string")
    got = similarity.top_k_similar(as_sequences(spark, hist), chosen, 6).collect()
    everything = brute_similarity(hist)
    for me in ("copy3", "c1"):
        best = sorted(
            (-round(s, 9), f"1|{b}") for (a, b), s in everything.items() if a == me
        )[:6]
        mine = sorted((r.rank, -r.similarity, r.b) for r in got if r.a == f"1|{me}")
        assert [(s, b) for _, s, b in mine] == best


def brute_rules(bs, k, confidence):
    counts = brute_itemsets(bs, 1)
    found = []
    for s, c in counts.items():
        for x in s if len(s) > 1 else ():
            rest = tuple(i for i in s if i != x)
            if c / counts[rest] >= confidence:
                found.append((-c, -c / counts[rest], list(rest), x))
    return [(a, x, -c, -f) for c, f, a, x in sorted(found)[:k]]


@pytest.mark.parametrize(("seed", "confidence", "k", "batch"), [(3, 0.9, 12, 7), (4, 0.5, 40, 64), (5, 1.0, 25, 3), (6, 0.0, 200, 4096)])
def test_best_first_search_equals_all_rules(spark, seed, confidence, k, batch):
    """Whatever is expanded at a time, ties included."""
    bs = baskets(n=40, items=7, seed=seed)
    got = rules.top_k_rules(frame(spark, bs), k, confidence, batch=batch).collect()
    assert [(r.antecedent, r.consequent, r.support, pytest.approx(r.confidence)) for r in got] == brute_rules(bs, k, confidence)


def test_rules_of_one_basket_among_long_ones(spark):
    """The last of the best has one basket's support, and a basket of 60 items has 2 ** 60 itemsets."""
    r = random.Random(2)
    bs = {f"o{i}": set(r.sample(range(60), 58)) for i in range(3)} | {"p": set(range(60)), "q": {1, 100}, "s": {1, 100}}
    bs |= {f"t{i}": {200 + i, 300 + i} for i in range(4)}
    counts = Counter(x for b in bs.values() for x in b)
    got = rules.top_k_rules(frame(spark, bs).where("item >= 100 OR idorder IN ('p', 'q', 's')"), 12, 1.0).collect()
    assert len(got) == 12 and got[-1].support == 1 and got[0].support >= 2 and counts[1] >= 3
    assert (got[0].antecedent, got[0].consequent, got[0].support) == ([100], 1, 2)
    keys = [(-x.support, -x.confidence, x.antecedent, x.consequent) for x in got]
    assert keys == sorted(keys)
    # of the rest, the first in order: what holds in the long basket alone
    assert [(x.antecedent, x.consequent) for x in got[1:]] == [([0], c) for c in range(1, 12)]
    deep = rules.top_k_rules(frame(spark, {k: b for k, b in bs.items() if k < "q"}), 30, 1.0).collect()
    assert len(deep) == 30


@pytest.mark.parametrize("share", [0.05, 0.2, 0.4])
def test_rules_below_the_support_asked_for_do_not_count(spark, share):
    """Fewer than k, where fewer reach it."""
    bs = baskets(n=40, items=7, seed=3)
    got = rules.top_k_rules(frame(spark, bs), 500, 0.3, min_support=share).collect()
    want = [r for r in brute_rules(bs, 10_000, 0.3) if r[2] >= share * len(bs)][:500]
    assert [(r.antecedent, r.consequent, r.support, pytest.approx(r.confidence)) for r in got] == want
    assert share < 0.4 or len(want) < 500


@pytest.mark.parametrize("long", [1, 3, 1024])
def test_sequence_patterns_with_long_histories(spark, long):
    """Whoever counts as long, the patterns are the same."""
    hist = random_histories(24, 5, 4, 8) | {f"l{i}": [{j, (j * 3) % 5} for j in range(5)] * 3 for i in range(3)}
    df = spark.createDataFrame(occurrences(hist), "idsite bigint, user string, pos bigint, item bigint")
    found = {tuple(tuple(e) for e in r.pattern): r.support for r in rules.sequence_patterns(df, 0.25, 3, long=long).collect()}
    sets = [s for n in (1, 2, 3) for s in itertools.combinations(range(5), n)]
    want = {}
    for n in (1, 2, 3):
        for pattern in itertools.product(sets, repeat=n):
            if sum(map(len, pattern)) <= 3 and (c := sum(contains(seq, pattern) for seq in hist.values())) >= 7:
                want[pattern] = c
    assert found == want


def test_a_history_of_ten_thousand_frequent_items(spark):
    """Its fifty million pairs are never listed: it is asked for the pairs that others make frequent."""
    n = 10_000
    rows = spark.range(n).selectExpr("1L AS idsite", "'long' AS user", "id AS pos", "id AS item")
    twice = spark.range(2 * n).selectExpr("1L AS idsite", "concat('s', id % 5000, '-', id DIV 10000) AS user", "id % 2 + id DIV 5000 % 2 AS pos", "id % 10000 AS item")
    pairs = spark.createDataFrame([(1, f"p{i}", p, x) for i in range(3) for p, x in enumerate((17, 4711))], "idsite bigint, user string, pos bigint, item bigint")
    df = rows.unionByName(twice).unionByName(pairs)
    customers = df.select("user").distinct().count()
    found = {tuple(tuple(e) for e in r.pattern): r.support for r in rules.sequence_patterns(df, 3.5 / customers).collect()}
    assert found[(17,), (4711,)] == 4 and len(found) == 3


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.8])
def test_both_ways_to_similar_histories_agree(spark, monkeypatch, threshold):
    """Pairs scored at once where items are rare, and found by bounds where they are not."""
    seqs = as_sequences(spark, crowd())
    ways = []
    for few in (0, 10**9):
        monkeypatch.setattr(similarity, "FEW", few)
        ways.append(sorted((r.a, r.b, round(r.similarity, 9)) for r in similarity.similar_histories(seqs, threshold).collect()))
    assert ways[0] == ways[1]
    assert similarity.similar_histories(seqs.where("false"), threshold).isEmpty()


def test_sequence_patterns_store_nothing_per_customer_and_pattern(spark, monkeypatch):
    """Histories of up to 150 baskets, so bits go over several words, and few of each length."""
    r = random.Random(9)
    hist = {f"c{i}": [{r.randrange(6) for _ in range(r.randrange(1, 3))} for _ in range(r.choice([2, 64, 65, 150]))] for i in range(12)}
    hist |= {f"d{i}": [{5}] * 63 + [{0}, {1}, {2, 3}] for i in range(4)}
    df = spark.createDataFrame(occurrences(hist), "idsite bigint, user string, pos bigint, item bigint")
    stored = []
    monkeypatch.setattr(session, "WATCHERS", [lambda copy: stored.append(set(copy.columns))])
    found = {tuple(tuple(e) for e in x.pattern): x.support for x in rules.sequence_patterns(df, 0.5, 3).collect()}
    assert not any({"user", "pattern"} <= columns for columns in stored)
    sets = [s for n in (1, 2, 3) for s in itertools.combinations(range(6), n)]
    want = {}
    for n in (1, 2, 3):
        for pattern in itertools.product(sets, repeat=n):
            if sum(map(len, pattern)) <= 3 and (c := sum(contains(seq, pattern) for seq in hist.values())) >= 8:
                want[pattern] = c
    assert found == want
