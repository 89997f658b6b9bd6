"""Byte-level BPE by a table of distinct words.

Each task splits its texts into words by the tokenizer's own rule, encodes a word only
the first time it meets it, and puts ids back by position. Decoding is the reverse
join: ids to pieces. A word's entry holds its ids and, from those, its bytes.

The table is per task, not one for the corpus: words of open text do not repeat
enough across tasks for a shuffle of every task's distinct words to pay (see README).
It holds at most WORDS entries and starts anew when full, which changes no result, and
is given up with its task, as the worker may go on to steps that need the memory.

Defined cases: a null text counts as empty and has no ids. Equal rows give equal rows.
The strings of the tokenizer's added tokens are cut out of the text first, longest
first, as the tokenizer does. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import tidy

WORDS = 400_000
#: Texts that are worked on at a time; a matter of memory only.
TEXTS = 128
# Letters and numbers outside these ranges depend on the Unicode version; texts with such
# characters are split by the tokenizer's own splitter.
SETTLED = re.compile(r"[\u0000-\u0557\u2000-\u208e]*")


def settled(kind: str) -> str:
    """The settled characters of a Unicode category, as ranges for a pattern."""
    points = [i for i in [*range(0x558), *range(0x2000, 0x208F)] if regex.fullmatch(rf"\p{{{kind}}}", chr(i))]
    starts = [i for i in points if i - 1 not in points]
    ends = [i for i in points if i + 1 not in points]
    return "".join(rf"\u{a:04x}-\u{b:04x}" for a, b in zip(starts, ends, strict=True))


# fixed values: the word rule of the vocabulary, with white space as Unicode defines it
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTERS, NUMBERS = settled("L"), settled("N")
RULE = rf"'(?:[stmd]|re|ve|ll)| ?(?:[{LETTERS}]+|[{NUMBERS}]+|[^{SPACE}{LETTERS}{NUMBERS}]+)|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the pieces of a byte-level vocabulary: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class WordTable:
    """Words with their ids and pieces, filled as words turn up."""

    def __init__(self, path: str, most: int = WORDS):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.most = most
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        letters = byte_letters()
        self.pieces = [b""] * max(self.tokenizer.get_vocab_size(), 1 + max(added.values(), default=0))
        for piece, i in self.tokenizer.get_vocab().items():
            self.pieces[i] = piece.encode() if piece in added else bytes(letters[x] for x in piece)
        self.added = added
        self.cut = re.compile("(" + "|".join(re.escape(x) for x in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.rule = re.compile(RULE)
        self.numbers = [str(i) for i in range(len(self.pieces))]
        self.letters = {b: x for x, b in letters.items()}
        self.model = self.tokenizer.model
        self.start()

    def start(self) -> None:
        """Empty but for the added tokens."""
        self.ids = {x: str(i) for x, i in self.added.items()}
        self.bytes = {x: self.pieces[i] for x, i in self.added.items()}

    def words(self, text: str) -> list[str]:
        if SETTLED.fullmatch(text):
            return self.rule.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def split(self, text: str) -> list[str]:
        if not any(x in text for x in self.added):
            return self.words(text)
        return [w for part in self.cut.split(text) for w in ([part] if part in self.added else self.words(part))]

    def learn(self, words: set[str]) -> None:
        if len(self.ids) + len(words - self.ids.keys()) > self.most:
            self.start()
        numbers, letters, tokenize = self.numbers, self.letters, self.model.tokenize
        for w in words - self.ids.keys():
            # a word is what the splitter leaves whole, so its bytes go straight to the merges
            ids = [t.id for t in tokenize(w.encode().decode("latin-1").translate(letters))]
            self.ids[w] = ",".join([numbers[i] for i in ids])
            self.bytes[w] = self.decode(ids)

    def decode(self, ids: list[int]) -> bytes:
        pieces = self.pieces
        return b"".join([pieces[i] for i in ids])

    def look_up(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """For each text its decimal ids joined by commas, and the bytes they stand for."""
        split = [self.split(t) for t in texts]
        self.learn({w for words in split for w in words})
        ids, pieces = self.ids.__getitem__, self.bytes.__getitem__
        for words in split:
            yield ",".join(map(ids, words)), b"".join(map(pieces, words))


@functools.lru_cache(maxsize=1)
def word_table(path: str, most: int = WORDS) -> WordTable:
    return WordTable(path, most)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256, and the ids if asked for."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_table(path)
        words.start()  # a task that was broken off has left its words
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                b = whole.slice(at, TEXTS)
                n, digests, decoded, ids = [], [], [], []
                for text, data in words.look_up([t or "" for t in b.column(1).to_pylist()]):
                    n.append(text.count(",") + 1 if text else 0)
                    digests.append(hashlib.sha256(text.encode()).hexdigest())
                    decoded.append(hashlib.sha256(data.decode("utf-8", "replace").encode()).hexdigest())
                    if with_ids:
                        ids.append(np.fromstring(text, np.int32, sep=","))
                columns = [b.column(0), pa.array(n, pa.int64()), pa.array(digests), pa.array(decoded)] + [pa.array(ids, pa.list_(pa.int32()))] * with_ids
                yield pa.RecordBatch.from_arrays(columns, names)
        words.start()  # a worker that goes on to other work holds no words

    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(docs[id_col], docs[text_col]).mapInArrow(tidy(run), schema)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id, text. Null ids give a null text, an unknown id an error."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_table(path)
        for b in batches:
            texts = [None if ids is None else words.decode(ids).decode("utf-8", "replace") for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return encoded.select(encoded[id_col], encoded[ids_col]).mapInArrow(run, f"`{id_col}` {kind}, text string")
