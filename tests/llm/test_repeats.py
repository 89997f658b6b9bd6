"""Repeated byte strings and near duplicates against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest

from patronage.llm import near_dedup, suffix_dedup
from patronage.llm.shingles import multisets

SCHEMA = "doc_id long, text string"


def test_suffix_array_equals_sorting():
    r = random.Random(3)
    for _ in range(400):
        x = [r.randint(1, r.choice([1, 2, 3, 9])) for _ in range(r.randint(0, 60))] + [0]
        assert suffix_dedup.suffix_array(np.array(x)).tolist() == sorted(range(len(x)), key=lambda i: x[i:])


def test_smallest_docs_of_core_strings():
    r = random.Random(4)
    cores = [
        list({(bytes(r.choices(b"ab", k=r.randint(0, 7))), bytes(r.choices(b"ab", k=r.randint(0, 7)))): r.randint(0, 9) for _ in range(12)}.items())
        for _ in range(20)
    ]
    cores = [[(a, b, d) for (a, b), d in c if len(a) + len(b) >= 7] for c in cores]
    cores = [c for c in cores if c]
    for core, answers in zip(cores, suffix_dedup.smallest_docs(cores), strict=True):
        has = collections.defaultdict(list)
        for a, b, d in core:
            for u in range(max(0, 7 - len(b)), len(a) + 1):
                has[u, a[len(a) - u :], b[: 7 - u]].append(d)
        for (a, b, _), answer in zip(core, answers, strict=True):
            for u in range(8):
                fits = max(0, 7 - len(b)) <= u <= len(a)
                want = min(has[u, a[len(a) - u :], b[: 7 - u]]) if fits else np.iinfo(np.int64).max
                assert answer[u] == want


def brute_repeats(rows, length):
    seen, out = {}, []
    for doc in sorted({i for i, _ in rows if i is not None}):
        new = set()
        for i, t in rows:
            if i != doc:
                continue
            b = (t or "").encode()
            mark = bytearray(len(b))
            for p in range(len(b) - length + 1):
                if b[p : p + length] in seen:
                    mark[p : p + length] = b"\1" * length
                else:
                    new.add(b[p : p + length])
            kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
            runs = sum(1 for p, m in enumerate(mark) if m and (p == 0 or not mark[p - 1]))
            out.append((i, len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
        seen.update(dict.fromkeys(new, doc))
    out += [(None, len((t or "").encode()), 0, 0, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows if i is None]
    return sorted(out, key=str)


def found_repeats(spark, rows, **options):
    got = suffix_dedup.remove_repeats(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA + ", spans int"), **options)
    return sorted((tuple(r)[:5] for r in got.collect()), key=str)


def passages(r, n, alphabet):
    pool = ["".join(r.choices(alphabet, k=r.randint(10, 160))) for _ in range(12)]
    return [(i, "".join(r.choice(pool) if r.random() < 0.5 else "".join(r.choices(alphabet, k=r.randint(0, 40))) for _ in range(r.randint(0, 6)))) for i in range(n)]


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghij é", "thé quick 漢字"])
def test_repeats_equal_brute_force(spark, alphabet):
    r = random.Random(alphabet)
    rows = passages(r, 60, alphabet)
    rows += [(100, None), (101, ""), (102, "a" * 400), (103, "a" * 49), (104, "a" * 50), (105, "ab" * 300), (106, rows[3][1] * 3), (107, rows[3][1])]
    rows += [(None, rows[5][1]), (108, rows[5][1]), (109, rows[5][1]), (109, rows[5][1]), (110, rows[7][1] + "x"), (110, "y" + rows[7][1] + rows[8][1])]
    r.shuffle(rows)
    assert found_repeats(spark, rows) == brute_repeats(rows, 50)


def test_other_lengths_and_frequent_minimisers(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SAMPLE_ONE_IN", 1)
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", 40)  # what occurs more than 20 times is dealt by document
    r = random.Random(9)
    line = "the very same sentence stands in a great many of these documents."
    rows = [(i, "".join(r.choices("abcdef ", k=r.randint(0, 60))) + line + "".join(r.choices("abcdef ", k=r.randint(0, 60)))) for i in range(60)]
    assert found_repeats(spark, rows) == brute_repeats(rows, 50)
    assert found_repeats(spark, rows, length=30, gram=12, free=5) == brute_repeats(rows, 30)


def test_long_texts_go_piece_by_piece():
    r = random.Random(5)
    text = "".join(r.choices("abcd", k=5000)).encode()
    whole = [np.concatenate(x) for x in zip(*suffix_dedup.all_anchors([text], 50, 20), strict=True)]
    parts = [np.concatenate(x) for x in zip(*suffix_dedup.all_anchors([text], 50, 20, piece=333), strict=True)]
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts, strict=True))


def test_no_repeats_without_rows(spark):
    assert found_repeats(spark, []) == []


# ---------------------------------------------------------- near duplicates


def test_signatures_are_unbiased():
    r = random.Random(6)
    for n in (1, 3):
        a = [f"w{r.randrange(25)}" for _ in range(300)]
        b = [w if r.random() > 0.08 else "zz" for w in a]
        owner, value, count = multisets([" ".join(a), " ".join(b)], n)
        x, y = ({int(v): int(c) for v, c in zip(value[owner == i], count[owner == i], strict=True)} for i in (0, 1))
        true = sum(min(x.get(v, 0), y.get(v, 0)) for v in x | y) / sum(max(x.get(v, 0), y.get(v, 0)) for v in x | y)
        s = near_dedup.signatures(owner, value, count, 2, 4096)
        assert (s[0] == s[1]).mean() == pytest.approx(true, abs=0.03)


def counted(text, n=5):
    w = (text or "").lower().split()
    return collections.Counter([tuple(w)] if 0 < len(w) < n else [tuple(w[i : i + n]) for i in range(len(w) - n + 1)])


def brute_groups(rows, similarity=0.8):
    sets = [(i, counted(t)) for i, t in rows if i is not None]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            both = sum((sets[x][1] & sets[y][1]).values())
            if both and both >= similarity * (sum(sets[x][1].values()) + sum(sets[y][1].values()) - both):
                root[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        least[find(x)] = min(i, least.get(find(x), i))
    of = {frozenset(s.items()): least[find(x)] for x, (_, s) in enumerate(sets) if s}  # a row without an identifier follows its text
    unnamed = [(None, of.get(frozenset(counted(t).items()))) for i, t in rows if i is None]
    return sorted([(i, least[find(x)]) for x, (i, _) in enumerate(sets)] + unnamed, key=str)


def edited(r, words, share):
    return [w if r.random() > share else f"e{r.randrange(10**6)}" for w in words]


def families(seed, sizes):
    r = random.Random(seed)
    rows = []
    for size in sizes:
        words = [f"w{r.randrange(3000)}" for _ in range(r.randint(20, 120))]
        for _ in range(size):
            rows.append((len(rows), " ".join(edited(r, words, r.choice([0, 0.01, 0.02, 0.05])))))
    return rows


def found_groups(spark, rows):
    got = near_dedup.near_groups(spark.createDataFrame([(*r, "n") for r in rows], SCHEMA + ", node string"))
    return sorted(map(tuple, got.collect()), key=str)


def test_groups_equal_brute_force(spark):
    rows = families(7, [1] * 20 + [2] * 10 + [6] * 5 + [40])
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "One"), (905, "a b c d"), (906, "a b c e"), (None, rows[0][1])]
    rows += [(0, rows[0][1]), (907, rows[-10][1].upper()), (908, "a " * 3000), (909, "a " * 2900), (910, "a " * 100)]
    assert found_groups(spark, rows) == brute_groups(rows)


def test_a_large_group_of_copies_that_differ(spark, monkeypatch):
    """Copies near one text but not near each other; groups of at most 16 nodes at a time."""
    monkeypatch.setattr(near_dedup, "GROUP_NODES", 16)
    r = random.Random(8)
    words = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(edited(r, words, 0.025))) for i in range(150)] + [(500, " ".join(words))]
    assert found_groups(spark, rows) == brute_groups(rows)
    rows = rows[:-1]  # without the text in the middle
    assert found_groups(spark, rows) == brute_groups(rows)


def test_forest_joins_what_brute_force_links():
    texts = [t for _, t in families(10, [8, 5, 1, 1])]
    owner, value, count = multisets(texts)
    data = [value[owner == i].tobytes() + count[owner == i].astype(np.uint64).tobytes() for i in range(len(texts))]
    links = near_dedup.forest(data, [str(i).encode() for i in range(len(texts))], 0.8)
    root = list(range(len(texts)))
    for a, b in links:
        x, y = root[a], root[b]
        assert x != y
        root = [x if z == y else z for z in root]
    groups = {i: c for i, c in brute_groups(list(enumerate(texts)))}
    assert all((root[a] == root[b]) == (groups[a] == groups[b]) for a in groups for b in groups)


def test_one_of_each_group_stays_with_its_columns(spark):
    rows = [(1, "a b c d e f", "p"), (2, "A B C D E F", "q"), (3, "x", None), (None, "a b c d e f", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, class_id string")
    kept = near_dedup.keep_one(df)
    assert kept.columns == df.columns and sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], rows[2], rows[3]], key=str)
    assert near_dedup.near_groups(df.limit(0)).isEmpty() and near_dedup.keep_one(df.limit(0)).isEmpty()


def test_of_texts_that_share_an_identifier_each_is_its_own_document(spark):
    base = " ".join(f"word{i}" for i in range(60))
    rows = [(3, base), (7, "something else that nobody else has written"), (7, base + " extra"), (8, "x"), (8, "x"), (None, base), (None, base)]
    kept = near_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([rows[0], rows[1], rows[3], rows[5], rows[6]], key=str)
