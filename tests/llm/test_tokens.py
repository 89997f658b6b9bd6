"""BPE and token counts against the tokenizers themselves."""

import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from patronage.llm import bpe, token_counts
from patronage.llm.queries import RANKS, VOCABULARY
from patronage.session import scratch

TEXTS = [
    None, "", " ", "   ", "\n\n\t x", "Hello  world's   end \n", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|", "naïve Éaux ß",
    "日本語のテキスト 混ぜる", "👩‍👩‍👧 emoji🙂", " x y　z​q", "\x1c\x1d \x85 ok", "'s 'S I'll we've 12345 ①²x", "x" * 30_000, "ab " * 20_000,
    "�", "힣՘ა ẞ", "don't--stop!!\r\n\r\n end  ",
]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(VOCABULARY)
    t.no_truncation()
    t.no_padding()
    return t


def test_ids_and_digests_equal_the_library(spark, tokenizer):
    rows = list(enumerate(TEXTS)) + [(0, None), (5, TEXTS[5])]
    got = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), VOCABULARY).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = tokenizer.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_decoding_is_the_reverse(spark):
    rows = list(enumerate(TEXTS))
    encoded = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), VOCABULARY)
    assert {r.doc_id: r.text for r in bpe.decode(encoded, VOCABULARY).collect()} == {i: t or "" for i, t in rows}
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in bpe.decode(nothing, VOCABULARY).collect()} == {1: None, 2: ""}


def test_no_rows(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string, ids string"), VOCABULARY).isEmpty()


def test_a_full_table_starts_anew(tokenizer):
    table = bpe.WordTable(VOCABULARY, most=8)
    for text in TEXTS[1:]:
        (ids, data), = table.look_up([text])
        assert ids == ",".join(map(str, tokenizer.encode(text, add_special_tokens=False).ids)) and data.decode() == text


def test_the_word_rule_on_every_settled_character(tokenizer):
    table = bpe.WordTable(VOCABULARY)
    points = [c for c in [*range(0x558), *range(0x2000, 0x208F)]]
    for c in map(chr, points):
        text = f"a{c}1 {c}{c}  {c}"
        assert [m.span() for m in table.rule.finditer(text)] == [s for _, s in tokenizer.pre_tokenizer.pre_tokenize_str(text)], hex(ord(c))


def test_idle_workers_hold_no_words(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('word', id, ' other', id * 7) AS text").repartition(8)
    assert bpe.encode(docs, VOCABULARY).count() == 400

    def held(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(bpe.word_table(VOCABULARY).ids)])], ["held"])

    table = bpe.word_table(VOCABULARY)
    assert {r.held for r in spark.range(0, 8, 1, 8).mapInArrow(held, "held long").collect()} == {len(table.added)}


def test_new_words_cost_little_more_than_the_library(tokenizer):
    r = random.Random(5)
    texts = [" ".join("".join(r.choices("etaoinshrdlucmfwypvbgkjqxz", k=r.randint(3, 12))) for _ in range(300)) for _ in range(60)]
    table = bpe.WordTable(VOCABULARY)

    def least(work):
        spent = []
        for _ in range(5):
            table.start()
            began = time.process_time()
            work()
            spent.append(time.process_time() - began)
        return min(spent)

    plain = least(lambda: [tokenizer.encode(t, add_special_tokens=False).ids for t in texts])
    assert least(lambda: list(table.look_up(texts))) < 3 * plain


# ------------------------------------------------------------- token counts


def lengths(flat, eod):
    """Tokens of each document of one flat file, and whether it is closed."""
    out, n = [], 0
    for t in flat:
        if t == eod:
            out.append((n, True))
            n = 0
        else:
            n += 1
    return out + [(n, False)] * bool(n)


@pytest.mark.parametrize("run", [1, 3, 1024])
def test_flat_files_of_all_shapes(spark, monkeypatch, run):
    monkeypatch.setattr(token_counts, "RUN", run)
    r = random.Random(run)
    files = {f"f{i}": [r.choice([0, 0, 1, 2, 3]) for _ in range(r.randint(0, 60))] for i in range(12)}
    files |= {"none": [1] * 40, "only": [0] * 15, "end": [1] * 20 + [0], "edge": ([1] * 6 + [0]) * 5}
    path = scratch(spark, "flat").removeprefix("file:")
    import os

    os.makedirs(path)
    for name, tokens in files.items():
        with open(f"{path}/{name}", "wb") as f:
            f.write(np.array(tokens, "<u2").tobytes())
    blocks = token_counts.read_flat_files(spark, path, block_tokens=7)
    got = token_counts.count_tokens(blocks, 0).orderBy("shard", "doc_index").collect()
    for name, tokens in files.items():
        mine = [x for x in got if x.shard.endswith(f"/{name}")]
        assert [(x.n_tokens, x.closed) for x in mine] == lengths(tokens, 0)
        assert [x.doc_index for x in mine] == list(range(len(mine)))


def test_counts_of_documents(spark, tokenizer):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, block string").repartition(3)
    blocks = token_counts.flat_blocks(docs, token_counts.bpe_tokens(RANKS), 50256, block_tokens=64)
    got = token_counts.count_tokens(blocks, 50256).collect()
    tokenizer.encode_special_tokens = True  # flat files hold the strings of special tokens as text
    want = sorted((i, len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    tokenizer.encode_special_tokens = False
    assert sorted((r.doc_id, r.n_tokens) for r in got) == want and all(r.closed for r in got)


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    blocks = token_counts.flat_blocks(docs, token_counts.bpe_tokens(RANKS), 50256)
    assert token_counts.count_tokens(blocks, 50256).isEmpty()
