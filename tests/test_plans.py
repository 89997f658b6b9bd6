"""What the plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry
from patronage import session
from patronage.functions.ordering import dense_ids
from patronage.plans.queries import REGISTRY
from tests.conftest import SMALL

SQL = entry.oracle_sql()
# these act on their input while the plan is built (fits, durable copies, sinks)
LAZY = sorted(
    (set(SQL) & set(REGISTRY))
    - {"scan_piped_text", "sink_piped_text", "stream_source", "stream_sink_json", "visitor_counts_stream", "dictionary", "rating_matrix",
       "predict_pairs", "predict_user_items", "recommend_top_n", "next_state", "purchase_horizon",
       "frequent_itemsets", "top_k_rules", "also_bought", "multi_predicate_rules", "page_rules",
       "sequence_patterns", "customer_similarity", "close_customers", "similar_histories", "top_k_similar",
       "stream_sink_visitor_json", "als_train", "als_train_parts", "model_store", "geo_clusters", "cluster_pixels", "customer_segments", "part_itemsets"}
)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


OWN = sorted(set(SQL) & set(REGISTRY))


@pytest.mark.parametrize("name", OWN)
def test_no_cross_join_no_python(spark, name, monkeypatch):
    """Neither in the plan returned nor in those of the copies made on the way."""
    plans = []
    monkeypatch.setattr(session, "WATCHERS", [lambda df: plans.append(physical(df))])
    plans.append(physical(entry.queries()[name](spark, SMALL)))
    for plan in plans:
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas", "ArrowEval"):
            assert word not in plan


@pytest.mark.parametrize("name", LAZY)
def test_only_bucket_offsets_meet_in_one_task(spark, name):
    plan = physical(entry.queries()[name](spark, SMALL))
    single = len(re.findall(r"Exchange SinglePartition", plan))
    # numbering adds up one row per hash bucket; the colour scale needs one maximum
    assert single <= {"numbered_baskets": 1, "heat_share_colour": 1}.get(name, 0)


def test_pushdown_reaches_the_scan(spark):
    plan = physical(entry.queries()["filter_not_deleted"](spark, SMALL))
    assert "Not(EqualNullSafe(l_returnflag,R))" in plan
    columns = re.search(r"ReadSchema: struct<([^>]*l_orderkey[^>]*)>", plan).group(1)
    assert "l_tax" not in columns and "l_shipdate" not in columns


def test_dense_ids_put_buckets_not_rows_in_one_task(spark):
    plan = physical(dense_ids(spark.range(10).selectExpr("cast(id AS string) AS t"), ["t"], "n"))
    below = plan.split("Exchange SinglePartition")[1]
    assert "HashAggregate(keys=[_bucket" in below.split("Scan")[0]


def test_readers_share_one_exchange(spark):
    for name in ("order_baskets", "transaction_states", "preference_scores"):
        df = entry.queries()[name](spark, SMALL)
        df.collect()
        assert "ReusedExchange" in physical(df) or "BroadcastQueryStage" in physical(df)


def test_histories_are_made_once_for_all_that_read_them(spark):
    """What is left to do reads stored copies; the tables were read when these were made."""
    left = entry.queries()["customer_similarity"](spark, SMALL)
    assert left.inputFiles() and not [f for f in left.inputFiles() if f"{SMALL}/" in f]


def test_a_fit_of_segments_is_cut_by_rows(spark, monkeypatch):
    from pyspark.ml import Pipeline

    from patronage.operators import geo

    seen, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, data: seen.append(data) or fit(self, data))
    monkeypatch.setattr(geo, "SEGMENT_ROWS", 100)
    rows = spark.range(1_000).selectExpr("id % 24 AS hour", "id % 7 AS category").coalesce(1)
    geo.fit_segments(rows, ["hour"], ["category"], clusters=2)
    assert seen[0].rdd.getNumPartitions() == 10


def test_the_ratings_of_a_model_are_made_once(spark, monkeypatch):
    from patronage.operators import recommend
    from patronage.plans import queries

    seen = []
    monkeypatch.setattr(recommend, "als_train", lambda ratings, **_: seen.append(physical(ratings)))
    queries._trained(spark, SMALL)
    assert "Join" not in seen[0]


def test_factors_by_rule_need_no_scores(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(session, "WATCHERS", [lambda df: plans.append(physical(df))])
    plans.append(physical(entry.queries()["predict_user_items"](spark, SMALL)))
    assert plans and not [plan for plan in plans if "ln(" in plan]


def _lines_read(df):
    """Scans of order lines in the plan that ran, without those of an exchange that is used again."""
    final = physical(df).split("== Initial Plan ==")[0]
    return len(re.findall(r"FileScan parquet \[l_orderkey", final))


def test_scores_read_their_lines_once(spark):
    df = entry.queries()["preference_scores"](spark, SMALL)
    df.collect()
    assert _lines_read(df) == 1


@pytest.mark.parametrize("name", ["bounded_users", "als_train", "als_train_parts", "model_store"])
def test_a_fit_reads_the_lines_once(spark, monkeypatch, name):
    """Only the copy of all scores reads the tables; counting and choosing users reads the copy."""
    from patronage.operators import recommend

    class Stop(Exception):
        pass

    def stop(*_, **__):
        raise Stop

    copies = []
    monkeypatch.setattr(session, "WATCHERS", [copies.append])
    monkeypatch.setattr(recommend, "als_train", stop)
    try:
        copies.append(entry.queries()[name](spark, SMALL))
    except Stop:
        pass
    assert [any(f"{SMALL}/" in f for f in df.inputFiles()) for df in copies] == [True] + [False] * (len(copies) - 1)
    assert len(copies) > 1 and "LeftSemi" not in physical(copies[0]) and "LeftSemi" in physical(copies[1])
