import random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from patronage.functions.ordering import dense_ids, positions, previous, segments


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, t bigint, id bigint, v double")


def hot_rows(n=300, seed=1):
    """One key holds a third of the rows; times repeat."""
    r = random.Random(seed)
    keys = ["hot"] * (n // 3) + [f"k{r.randrange(40)}" for _ in range(n - n // 3)]
    return [(k, r.randrange(0, 50), i, r.random()) for i, k in enumerate(keys)]


def slot():
    return F.floor(F.col("t") / F.lit(7))


def test_positions_equal_a_plain_window(spark):
    df = frame(spark, hot_rows())
    plain = df.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")) - 1)
    got = positions(df, ["k"], ["t", "id"], slot())
    assert sorted(map(tuple, got.select("k", "id", "pos").collect())) == sorted(
        map(tuple, plain.select("k", "id", "pos").collect())
    )


def test_previous_equals_a_plain_window(spark):
    df = frame(spark, hot_rows(seed=2))
    w = Window.partitionBy("k").orderBy("t", "id")
    plain = df.select("k", "id", F.lag("v").over(w), F.lag("t").over(w), F.row_number().over(w) - 1)
    got = previous(df, ["k"], ["t", "id"], {"pv": "v", "pt": "t"}, slot(), position="p", keep_slot="s")
    order = lambda rows: sorted(rows, key=lambda r: r[1])
    assert order(map(tuple, got.select("k", "id", "pv", "pt", "p").collect())) == order(
        map(tuple, plain.collect())
    )


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 30)), min_size=1, max_size=25),
    width=st.integers(1, 40),
)
def test_any_slot_width_gives_the_same_lag(spark, rows, width):
    data = [(k, t, i, float(i)) for i, (k, t) in enumerate(rows)]
    df = frame(spark, data)
    got = previous(df, ["k"], ["t", "id"], {"pid": "id"}, F.floor(F.col("t") / F.lit(width)))
    want = {}
    for k in "ab":
        mine = sorted((t, i) for kk, t, i, _ in data if kk == k)
        want |= {b[1]: a[1] for a, b in zip([(None, None)] + mine, mine)}
    assert {r.id: r.pid for r in got.collect()} == want


def test_segments_keep_every_row_in_order(spark):
    rows = hot_rows(seed=3)
    got = segments(frame(spark, rows), ["k"], ["t", "id"], F.col("id"), slot(), "ids", max_len=10)
    got = got.collect()
    assert max(len(r.ids) for r in got) <= 10
    for key in {r[0] for r in rows}:
        parts = sorted((r.segment, r.ids) for r in got if r.k == key)
        assert [s for s, _ in parts] == list(range(len(parts)))
        assert [i for _, ids in parts for i in ids] == [
            i for _, i in sorted((t, i) for k, t, i, _ in rows if k == key)
        ]


def test_dense_ids_have_no_gaps_and_do_not_depend_on_partitions(spark):
    terms = [(f"term{i}",) for i in range(500)]
    once = dense_ids(spark.createDataFrame(terms, "term string"), ["term"], "idx").collect()
    again = dense_ids(
        spark.createDataFrame(terms[::-1], "term string").repartition(7), ["term"], "idx"
    ).collect()
    assert sorted(r.idx for r in once) == list(range(500))
    assert {r.term: r.idx for r in once} == {r.term: r.idx for r in again}
