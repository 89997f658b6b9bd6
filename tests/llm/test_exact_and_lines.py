"""Exact and line dedup against plain Python."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from patronage.llm import exact_dedup, line_dedup

SCHEMA = "doc_id long, text string"


def ascii_lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


TRICKY = [(1, "Abc"), (2, "aBC"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, "x" * 50_000), (8, "X" * 50_000), (9, "İ"), (10, "i̇"), (11, "K"), (12, "k")]


def expected_groups(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[ascii_lower(t or "")].append(i)
    return {
        i: (max(groups[ascii_lower(t or "")]), len(groups[ascii_lower(t or "")]), hashlib.sha256(ascii_lower(t or "").encode()).hexdigest())
        for i, t in rows
    }


@pytest.mark.parametrize("salts", [1, 64])
def test_groups_equal_brute_force(spark, salts):
    rows = TRICKY + [(100 + i, "Copy of one text") for i in range(400)] + [(1000 + i, f"own {i % 150}") for i in range(300)]
    random.Random(1).shuffle(rows)
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, SCHEMA), salts=salts).collect()
    want = expected_groups(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.keep_id, r.group_size, r.text_sha256) == want[r.doc_id] and r.kept == (r.doc_id == r.keep_id)


def test_repeated_rows_and_missing_identifiers(spark):
    rows = [(7, "a"), (7, "A"), (7, "a"), (3, "a"), (None, "a"), (None, "b"), (None, "B")]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, SCHEMA))
    assert got.where("kept").count() == 2
    assert [(r.doc_id, r.keep_id, r.group_size) for r in got.where("kept").orderBy("doc_id").collect()] == [(None, None, 2), (7, 7, 5)]
    assert exact_dedup.exact_groups(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_kept_rows_have_their_own_columns_whatever_they_are_called(spark):
    df = spark.createDataFrame([(1, "a", 5, "p"), (2, "A", None, "q")], "doc_id long, text string, keep_id int, _row string")
    assert [tuple(r) for r in exact_dedup.drop_copies(df).collect()] == [(2, "A", None, "q")]
    assert exact_dedup.drop_copies(df).columns == df.columns


def lines_left(rows, least_chars=20, least_docs=3):
    key = lambda line: ascii_lower(line.strip(" \t\n\x0b\x0c\r"))
    docs = collections.defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                docs[key(line)].add(i)
    keeper = {k: max(d) for k, d in docs.items() if len(k) >= least_chars and len(d) >= least_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or keeper.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def line_result(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return [tuple(r) for r in line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df)).collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_lines_equal_brute_force(spark):
    r = random.Random(2)
    pool = [f"a line that is long enough {i}" for i in range(12)] + ["short", "", "  \t", "ééééééééééééééééééé", "éééééééééééééééééééé"]
    vary = [str, str.upper, lambda s: f"  {s}\t", lambda s: s + "\r"]
    rows = [(i, "\n".join(r.choice(vary)(r.choice(pool)) for _ in range(r.randint(0, 9)))) for i in range(60)]
    rows += [(100 + i, "the one line that every document has\nown " + str(i)) for i in range(80)]
    rows += [(500, None), (501, ""), (None, pool[0] + "\n" + pool[1]), (502, "\n".join([pool[3]] * 3000)), (503, "\n\n" + pool[0] + "\n\n")]
    assert ordered(line_result(spark, rows)) == ordered(lines_left(rows))


def test_rows_that_share_an_identifier_are_one_document(spark):
    line = "exactly the same long line"
    rows = [(1, line), (1, line), (2, line)]
    assert ordered(line_result(spark, rows)) == [(1, 1, 0, line), (1, 1, 0, line), (2, 1, 0, line)]
    rows += [(3, line)]
    assert [r[3] for r in ordered(line_result(spark, rows))] == ["", "", "", line]


def test_lines_of_nothing(spark):
    assert line_result(spark, []) == []


def test_bitmap_round_trip():
    import numpy as np

    for n, gone in ((1, [0]), (9, [8]), (20, [0, 7, 8, 15])):
        packed = line_dedup.bitmap(np.array(gone))
        lines = [str(i) for i in range(n)]
        assert line_dedup.kept_lines(packed, lines) == [x for i, x in enumerate(lines) if i not in gone]
    assert line_dedup.kept_lines(None, ["a"]) == ["a"]


def test_hot_lines_are_not_sorted_in_one_task(spark):
    rows = spark.range(600).select(F.col("id").alias("doc_id"), F.lit("one line in all of the documents").alias("text"))
    kept = line_dedup.apply_bitmaps(rows, line_dedup.keep_bitmaps(rows))
    assert kept.where("n_dropped = 0").select("doc").collect()[0][0] == 599 and kept.where("n_dropped = 1").count() == 599


def test_texts_that_share_an_identifier_lose_their_own_lines(spark):
    only, often = "a unique line that stands only here", "a line that several documents hold"
    rows = [(7, only), (7, often), (8, often), (9, f"{only[:-1]}\n{often}"), (10, often)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df)).collect()
    assert sorted((r.doc, r.kept_text) for r in kept) == [(7, ""), (7, only), (8, ""), (9, only[:-1]), (10, often)]
