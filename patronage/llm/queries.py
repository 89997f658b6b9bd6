"""The queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import prepare
from . import bpe, conversations, exact_dedup, language, line_dedup, mixing, near_dedup, secrets, suffix_dedup, token_counts, topk, toxicity, whitening
from .common import LOWER, UPPER, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}
#: Where the vocabulary files are; the second is the same vocabulary as ranks.
VOCABULARY, RANKS = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_OF_DOCUMENT = 50256
#: Target of each domain as a multiple of its present tokens: good text is seen 1.25 times, so none of it is lost.
SHARES = {"plain": 0.5, "good": 1.25, "toxic": 0.05}


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), str(sf_dir).rstrip("/"))

    REGISTRY[fn.__name__] = run
    return run


@query
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


SQL["op1_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d"""


@query
def op2_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    blocks = token_counts.flat_blocks(docs, token_counts.bpe_tokens(RANKS), END_OF_DOCUMENT)
    return token_counts.count_tokens(blocks, END_OF_DOCUMENT).select("doc_id", "n_tokens")


@query
def op3_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), SHARES).drop("text_hash")


@query
def op4_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


@query
def op5_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op6_secrets(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op7_bpe(spark, sf_dir):
    return bpe.encode(table(spark, sf_dir, "documents"), VOCABULARY, with_ids=False)


@query
def op8_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return kept.select(F.col("doc").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


_BLANKS = "||".join(f"chr({c})" for c in line_dedup.BLANKS)
SQL["op8_line_dedup"] = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {_BLANKS}), '{UPPER}', '{LOWER}') AS key FROM l),
g AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.pos, k.line, keeper IS NOT NULL AND k.doc_id <> keeper AS gone FROM k LEFT JOIN g USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""


@query
def op9_exact_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


SQL["op9_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""


@query
def op10_near_dedup(spark, sf_dir):
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


@query
def op11_whitening(spark, sf_dir):
    """``deviation`` is null where it does not fit eight bytes; ``deviation_exact`` has it always."""
    rows = whitening.whitened_rows(table(spark, sf_dir, "embeddings"))
    return rows.withColumns({"deviation": F.col("deviation").try_cast("long"), "deviation_exact": F.col("deviation")})


@query
def op12_conversations(spark, sf_dir):
    given = table(spark, sf_dir, "conversations")
    found = conversations.audits(conversations.damage(given), given.select("conv_id"))
    return found.withColumnRenamed("conv", "conv_id")


def _repair_sql() -> str:
    """Row by row, the cheapest way to each state: cost c, edits a, text t; a row is taken after rows are put in before it."""

    def more(state: str, cost: str, edit: str, line: str) -> str:
        return f"struct_pack(c := {state}.c + {cost}, a := {state}.a || '{edit}', t := {state}.t || {line})"

    def best(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def put(state: str, role: str) -> str:
        return more(state, "3", "I", f"chr(10) || '{role}:'")

    before = best("s2", put("s0", "user"), put("s1", "user"))
    closed = f"s0, s1, {best('s2', put('s0', 'user'), put('s1', 'user'), put('s3', 'user'))} AS s2, {best('s3', put(before, 'assistant'))} AS s3"
    line = "chr(10) || o.role || ':' || o.text"

    def keep(state: str, initial: str) -> str:
        return f"CASE WHEN o.fine AND o.initial = '{initial}' THEN {more('w.' + state, 'o.broken', 'K', line)} END"

    def recast(state: str, role: str) -> str:
        recast_line = f"chr(10) || '{role}:' || o.text"
        return f"CASE WHEN o.fine THEN {more('w.' + state, '3 + o.broken', 'R', recast_line)} END"

    def drop(state: str) -> str:
        return more("w." + state, "4", "D", "''")

    step = ", ".join(
        best(drop(to), keep(to, ""), *(way for source in sources for way in (keep(source, initial), *([recast(source, role)] if role else [])))) + f" AS {to}"
        for to, sources, initial, role in (("s0", (), "", ""), ("s1", ("s0",), "s", ""), ("s2", ("s0", "s1", "s3"), "u", "user"), ("s3", ("s2",), "a", "assistant"))
    )
    never = "struct_pack(c := 1000000000000::BIGINT, a := '~', t := '')"
    return f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
h AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(key) + 1), lambda i: ascii(substr(key, i, 1))::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))),
  4294967295::BIGINT) % 20 AS kind FROM k),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE kind <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n, substr(role, 1, 1) AS initial,
  trim(text, {_BLANKS}) AS core FROM d),
f AS (SELECT *, core = '' AS blank, core <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS duplicate,
  lag(initial) OVER (PARTITION BY conv_id ORDER BY n) AS before, count(*) OVER (PARTITION BY conv_id) AS rows FROM n),
o AS MATERIALIZED (SELECT *, NOT blank AND NOT duplicate AS fine, NOT blank AND NOT duplicate AND right(core, 1) NOT IN ('.', '!', '?') AS truncated,
  CASE WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS broken FROM f),
v AS (SELECT DISTINCT conv_id, 0::BIGINT AS n, struct_pack(c := 0::BIGINT, a := '', t := '') AS s0, {never} AS s1, {never} AS s2, {never} AS s3 FROM o
  UNION ALL SELECT o.conv_id, o.n, {step} FROM (SELECT conv_id, n, {closed} FROM v) w JOIN o ON o.conv_id IS NOT DISTINCT FROM w.conv_id AND o.n = w.n + 1),
g AS (SELECT conv_id, n, {closed} FROM v),
r AS (SELECT conv_id, n, {best('s0', 's3')} AS best FROM g),
q AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
  count(*) FILTER (truncated) AS truncated, count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS rows FROM o GROUP BY conv_id)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM i.conv_id AND r.n = q.rows"""


SQL["op12_conversations"] = _repair_sql()


@query
def op13_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
