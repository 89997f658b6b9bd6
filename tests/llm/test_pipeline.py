"""The pipeline, stage by stage, against brute force on a small table."""

import collections
import hashlib

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from patronage.llm.queries import REGISTRY, SQL, VOCABULARY
from patronage.session import durable
from tests.compare import compare, open_tables
from tests.llm.test_exact_and_lines import ascii_lower
from tests.llm.test_repeats import brute_groups, brute_repeats


@pytest.fixture(scope="module")
def stages(spark, small):
    """(name, rows before, result) of every stage."""
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        result = durable(stage(spark, docs, small))
        out.append((name, docs, result))
        docs = result
    return out


def test_all_but_the_last_return_documents(stages, spark, small):
    columns = spark.read.parquet(f"{small}/documents.parquet").columns
    assert len(stages) == 5 and all(result.columns == columns for _, _, result in stages[:-1])


def test_language_keeps_what_has_a_language(stages):
    _, before, after = stages[0]
    kept = {r.doc_id for r in after.collect()}
    gone = [r for r in before.collect() if r.doc_id not in kept]
    assert len(gone) <= 0.02 * before.count()
    assert all(any(c.isalpha() for c in r.text) for r in after.collect())


def test_exact_stage_keeps_the_largest_identifier(stages):
    _, before, after = stages[1]
    groups = collections.defaultdict(list)
    for r in before.collect():
        groups[ascii_lower(r.text)].append(r)
    want = sorted(max(g, key=lambda r: r.doc_id) for g in groups.values())
    assert sorted(after.collect()) == want


def test_near_stage_keeps_the_smallest_identifier(stages):
    _, before, after = stages[2]
    rows = before.collect()
    classes = dict(brute_groups([(r.doc_id, r.text) for r in rows]))
    assert sorted(after.collect()) == sorted(r for r in rows if classes[r.doc_id] == r.doc_id)


def test_mixing_repeats_rows_as_they_are(stages, spark, small):
    _, before, after = stages[3]
    rows = {r.doc_id: r for r in before.collect()}
    n = collections.Counter(r.doc_id for r in after.collect())
    assert set(after.collect()) <= set(rows.values()) and max(n.values()) <= 2
    labels = {r.doc_id: r for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    good = [i for i in rows if i in labels and labels[i].quality == 1 and not labels[i].toxic]
    assert good and all(n[i] >= 1 for i in good)


def test_tokens_equal_the_library(stages):
    _, before, after = stages[4]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = sorted((r.doc_id, tokenizer.encode(r.text, add_special_tokens=False).ids) for r in before.collect())
    assert sorted((r.doc_id, r.ids) for r in after.collect()) == want


def test_run_gives_the_last_stage(stages, spark, small):
    assert sorted(corpus_pipeline.run(spark, small).collect()) == sorted(stages[-1][2].collect())


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, small, name):
    problems, rows, *_ = compare(spark, open_tables(small), small, REGISTRY[name], SQL[name])
    assert not problems and rows


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_repeats_query_equals_brute_force(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in REGISTRY["op4_suffix_dedup"](spark, small).collect()), key=str) == brute_repeats(rows, 50)


def test_near_query_equals_brute_force(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, REGISTRY["op10_near_dedup"](spark, small).collect()), key=str) == brute_groups(rows)


def test_token_counts_query_equals_the_library(spark, small):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, len(tokenizer.encode(r.text, add_special_tokens=False).ids)) for r in rows)
    assert sorted(map(tuple, REGISTRY["op2_token_counts"](spark, small).collect())) == want


def test_secrets_query_equals_the_patterns(spark, small):
    import re

    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    kinds = [
        ("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 8),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
    ]
    for r in REGISTRY["op6_secrets"](spark, small).collect():
        spans = [(m.start(), k, m.end(), kind) for k, (kind, rule, fits) in enumerate(kinds) for m in rule.finditer(rows[r.doc_id]) if fits(m)]
        text = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x[3] == kind for x in spans) for kind, *_ in kinds)
