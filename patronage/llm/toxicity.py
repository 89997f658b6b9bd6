"""Toxicity of texts, read through a noisy channel that undoes deliberate misspelling.

A writer who hides a word sends it through a channel: letters become look-alike digits
and signs (1d10t), are repeated (idiooot) or set apart (i d i o t, i.d.i.o.t). What was
meant is the likeliest reading: a lattice of the letters each character may stand for,
of shorter runs and of breaks left out, searched by Viterbi under a language model of four
characters, with a price for each change. The model's counts come from the words of every
document of the corpus. Words that show no sign of the channel have one reading and are taken as they are.

The words read, and their first letters, which inflected forms share, are what a sparse
linear classifier scores. It learns from a bounded sample of labelled documents (SAMPLE a
class) that are not held out, and knows nothing but the text.

Defined cases: null text counts as empty; an empty text gets the score of a text without
words. Rows without an identifier are scored but not learned from, and are not held out. An identifier with
several labels counts as toxic. With labels of one kind only, or none, every score is that kind's share (0
without labels). Runs of set-apart characters and texts may be of any length. Repeated rows get
equal scores. Other columns, whatever their names, do not take part; an empty table gives no rows.
"""

from __future__ import annotations

import dataclasses
import functools
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import durable
from . import linear
from .language import held_out

#: Bound on the labelled texts of each class that are learned from.
SAMPLE = 4096
#: Lengths of a word's beginnings that count beside it.
STEMS = (5, 6, 7)
#: Symbols of the language model: 0 a break, 1 to 26 the letters, 27 any other letter.
SYMBOLS, ORDER = 28, 4
OTHER = SYMBOLS - 1
#: Weight of the shorter context in a longer one's estimate, as a count.
BACKOFF = 4.0
#: Prices of the channel, in nats: a sign for a letter, a run made shorter, a break left out between single characters, a break kept.
SIGN, RUN, JOIN, KEEP = 1.0, 2.5, 0.3, 1.5
#: What the signs may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SIGNS = "".join(map(re.escape, LOOKS_LIKE))
#: Parts of a token between punctuation; signs that are punctuation as a rule do not count at a part's ends.
PART, EDGES = re.compile(rf"(?:[^\W_]|[{SIGNS}])+"), "!|+(@"
SPACED = re.compile(rf"(?:[^\W_]|[{SIGNS}])(?:[._\-*~,/](?:[^\W_]|[{SIGNS}])){{2,}}")
REPEATED = re.compile(r"([^\W\d_])\1\1|([^\W\d_])\2[^\W\d_]*?([^\W\d_])\3")
SINGLES = re.compile(r"(?:^|(?<=\s))\S(?:\s\S){2,}(?=\s|$)")
#: Code points that are counted at a time, and entries of a task's table of tokens; matters of memory only.
PIECE, MEMORY = 1 << 20, 1 << 18


def _symbols() -> np.ndarray:
    out = np.zeros(0x110000, np.int64)
    out[[i for i in range(0x110000) if chr(i).isalpha()]] = OTHER
    out[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return out


symbols = functools.lru_cache(maxsize=1)(_symbols)


def gram_counts(texts: list[str]) -> np.ndarray:
    """Counts of all runs of ORDER symbols; a run of other characters is one break, and breaks surround a text."""
    total = np.zeros(SYMBOLS**ORDER, np.int64)
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) <= PIECE):
            size += len(texts[upto])
            upto += 1
        joined = "\n".join(["", *texts[at:upto], ""]).lower()
        before = np.zeros(0, np.int64)
        for i in range(0, len(joined), PIECE):  # one very long text goes piece by piece
            s = symbols()[np.frombuffer(joined[i : i + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)]
            s = np.concatenate([before, s])
            s = s[np.append(True, (s[1:] > 0) | (s[:-1] > 0))]
            if len(s) >= ORDER:
                gram = functools.reduce(lambda g, k: g * SYMBOLS + s[k : len(s) - ORDER + 1 + k], range(1, ORDER), s[: len(s) - ORDER + 1])
                total += np.bincount(gram, minlength=len(total))
            before = s[-(ORDER - 1) :]
        at = upto
    return total


def count_grams(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The counts over every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**ORDER, np.int64)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                total += gram_counts([t for t in b.column(0).slice(i, 256).to_pylist() if t])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "n"])

    counted = docs.select(docs[text_col].alias("text")).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # at most SYMBOLS ** ORDER rows of two numbers
    total = np.zeros(SYMBOLS**ORDER, np.int64)
    total[found.column("gram").to_numpy()] = found.column("n").to_numpy()
    return total


def log_model(counts: np.ndarray) -> np.ndarray:
    """log P(next | three before), each context's estimate backed by the next shorter one's."""
    counts = counts.reshape((SYMBOLS,) * ORDER).astype(float)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for length in range(ORDER):
        c = counts.sum(axis=tuple(range(ORDER - 1 - length)))
        p = (c + BACKOFF * p) / (c.sum(axis=-1, keepdims=True) + BACKOFF)
    return np.log(p).astype(np.float32).reshape(-1)


class Channel:
    """Reads what was meant; ``model`` is the language model, flat; of the traits found only those in ``keep`` are told."""

    def __init__(self, model: np.ndarray, keep: dict[str, float] | None = None):
        self.model, self.keep = model, keep
        self.seen: dict[str, frozenset[str]] = {}

    def read(self, steps: list[list[tuple[str, float]]]) -> str:
        """The likeliest string, by Viterbi over the last three symbols. steps: at each place, what may have been meant and its price."""
        model, table = self.model, symbols()
        ways: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
        for options in [*steps, [(" ", 0.0)]]:
            after: dict[int, tuple[float, tuple]] = {}
            for state, (score, text) in ways.items():
                for meant, price in options:
                    now, to, whole = score - price, state, text
                    for c in meant:
                        s = int(table[ord(c)])
                        if s == 0 and to % SYMBOLS == 0:  # breaks do not follow one another
                            continue
                        now += float(model[to * SYMBOLS + s])
                        to = (to * SYMBOLS + s) % SYMBOLS ** (ORDER - 1)
                        whole = (whole, c)
                    if to not in after or now > after[to][0]:
                        after[to] = (now, whole)
            ways = after
        _, text = max(ways.values(), key=lambda w: w[0])
        out = []
        while text:
            text, c = text
            out.append(c)
        return "".join(reversed(out)).strip()

    def lattice(self, part: str, spaced: bool = False) -> list[list[tuple[str, float]]]:
        """What each run of one character may stand for; with ``spaced`` each character may begin a word."""
        steps = []
        for at, run in enumerate(re.finditer(r"(.)\1*", part, re.S)):
            c, n = run.group(1), len(run.group())
            letters = [(c, 0.0)] if c.isalpha() else [(x, SIGN) for x in LOOKS_LIKE.get(c, "")]
            if not letters:
                continue
            options = [(x * k, price + RUN * (k < n)) for x, price in letters for k in {1, min(n, 2)}]
            if spaced and at:
                options = [(b + x, p + price) for b, p in (("", JOIN), (" ", KEEP)) for x, price in options]
            steps.append(options)
        return steps

    def kept(self, words: Iterable[str]) -> frozenset[str]:
        """Words and their beginnings."""
        found = frozenset(t for w in words for t in (w, *(f"{w[:n]}~" for n in STEMS if n < len(w))))
        return found if self.keep is None else found & self.keep.keys()

    def traits(self, token: str) -> frozenset[str]:
        """The traits of the words meant by a token of lower-case text without white space."""
        known = self.seen.get(token)
        if known is None:
            if len(self.seen) >= MEMORY:
                self.seen.clear()
            known = self.seen[token] = self.kept(self.words(token))
        return known

    def words(self, token: str) -> Iterator[str]:
        if token.isalpha() and not REPEATED.search(token):
            yield token
            return
        apart = SPACED.fullmatch(token.strip(".,;:?\"'()[]"))
        if apart and any(map(str.isalpha, token)):
            yield from self.read(self.lattice(re.sub(r"[._\-*~,/]", "", apart.group()), True)).split()
            return
        for m in PART.finditer(token):
            part = m.group().strip(EDGES)
            bare = part.rstrip(part[-1:]) if part[-1:] in LOOKS_LIKE else part
            part = bare if len(part) - len(bare) > 2 else part  # a row of signs after a word is no ending
            if part.isalpha() and not REPEATED.search(part):
                yield part
            elif any(map(str.isalpha, part)):
                yield from self.read(self.lattice(part)).split()

    def read_text(self, text: str) -> frozenset[str]:
        """The traits of the words meant by a text."""
        low = text.lower()
        found = set().union(*map(self.traits, set(low.split())))
        for run in SINGLES.finditer(low):
            apart = "".join(c for c in run.group().split() if c.isalnum() or c in LOOKS_LIKE)
            found |= self.kept(self.read(self.lattice(apart, True)).split())
        return frozenset(found)


@dataclasses.dataclass(frozen=True)
class Model:
    counts: np.ndarray  # of the language model
    weights: dict[str, float]  # of traits
    intercept: float

    def score(self, traits: frozenset[str]) -> float:
        z = self.intercept + sum(self.weights[t] for t in sorted(traits))
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """labels has the columns id_col and toxic_col (0 or 1)."""
    counts = count_grams(docs, text_col)
    known = labels.select(labels[id_col], (labels[toxic_col] == 1).cast("int").alias("label")).where(~held_out(F.col(id_col)))
    chosen = linear.labelled_sample(docs, known, sample, id_col, text_col)
    logs = log_model(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel = Channel(logs)
        for b in batches:
            has = [sorted(channel.read_text(t)) for t in b.column(2).to_pylist()]
            none = pa.array([[]] * len(has), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(has, pa.list_(pa.string())), none], ["label", "weight", "words", "dense"])

    rows = durable(chosen.select("label", "weight", "text").mapInArrow(run, "label double, weight double, words array<string>, dense array<double>"))
    kinds = {r["label"] for r in rows.select("label").distinct().collect()}
    if len(kinds) < 2:
        return Model(counts, {}, 700.0 if kinds == {1.0} else -1000.0)
    words, rest = linear.fit_in_one_task(rows, 2, 0)
    return Model(counts, {w: float(x[1] - x[0]) for w, x in words.items()}, float(rest[-1, 1] - rest[-1, 0]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score (0 to 1), predicted (1 from a half on), of every row."""
    given = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    kind = given.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel = Channel(log_model(model.counts), model.weights)
        for b in batches:
            found = [model.score(channel.read_text(t or "")) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.float64())], ["_id", "score"])

    scored = given.mapInArrow(run, f"_id {kind}, score double")
    out = F.coalesce(held_out(F.col("_id")), F.lit(False)).alias("held_out")
    return scored.select(F.col("_id").alias(id_col), out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
