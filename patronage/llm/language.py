"""Language by the nearest of several centroids per language.

A text becomes a TF-IDF vector of its lower-cased letter 1-, 2- and 3-grams (runs of
other characters are one blank), hashed into DIMS places, with dampened counts and unit
length. Each language's training vectors are clustered into a few centroids by their
cosine; a text takes the language of the centroid with the largest cosine. A text whose
cosine lies below the model's floor, half of what nearly all training texts reach, is
rejected: it is far from every language known.

The model is fitted on a bounded sample of labelled texts (SAMPLE, in equal shares for the
languages, but at least LEAST of each; chosen by a hash of identifier and text). Prediction
uses the text alone and all of it.

Defined cases: a null text or one without letters is ``und`` with score 0, and rejected.
Rows without an identifier are predicted but not learned from (and not held out), nor are
null languages. Rows equal in identifier, text and language are learned from once.
Without any labelled text everything is ``und``. Ties go to the first language in
alphabetical order. Repeated rows give equal rows; other columns do not take part.
"""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from . import linear
from .common import tidy

DIMS = 2048
SAMPLE, LEAST = 4096, 64
CENTROIDS = 4
#: Code points that are put through the n-grams at a time; a matter of memory only.
PIECE = 1 << 20
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _count(texts: list[str], dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram counts and letters of texts that fit one piece."""
    codes = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), lengths)  # a text owns its characters and the break before it
    owner = np.append(owner, len(texts) - 1)
    letter = letters()[codes]
    n_letters = np.bincount(owner[letter], minlength=len(texts))
    keep = letter | np.append(True, letter[:-1])  # runs of other characters shrink to one blank
    c, owner = np.where(letter[keep], codes[keep], 0).astype(np.uint64), owner[keep]
    counts = np.zeros(len(texts) * dims, np.int64)
    gram = np.zeros(len(c), np.uint64)
    bits = np.uint64(64 - dims.bit_length() + 1)
    for n in (1, 2, 3):
        if len(c) < n:
            break
        gram = gram[: len(c) - n + 1] * np.uint64(0x110000) + c[n - 1 :]
        place = ((gram + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> bits).astype(np.int64)
        mine = (gram > 0) & (owner[: len(gram)] == owner[n - 1 :] if n > 1 else True)
        counts += np.bincount(owner[: len(gram)][mine] * dims + place[mine], minlength=len(counts))
    return counts.reshape(len(texts), dims), n_letters


def gram_counts(texts: list[str], dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """Gram counts (texts x dims) and the number of letters of each text."""
    counts, n_letters = np.zeros((len(texts), dims), np.int64), np.zeros(len(texts), np.int64)
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) <= PIECE) and upto - at < 256:
            size += len(texts[upto])
            upto += 1
        if size <= PIECE:
            counts[at:upto], n_letters[at:upto] = _count([t.lower() for t in texts[at:upto]], dims)
        else:  # one very long text, piece by piece
            for i in range(0, size, PIECE):
                c, n = _count([texts[at][i : i + PIECE].lower()], dims)
                counts[at] += c[0]
                n_letters[at] += n[0]
        at = upto
    return counts, n_letters


@dataclasses.dataclass(frozen=True)
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floor: float

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return unit(np.log1p(counts) * self.idf)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score, rejected."""
        counts, n_letters = gram_counts(texts, len(self.idf))
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosine = self.vectors(counts) @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = np.where(n_letters > 0, cosine[np.arange(len(texts)), best].clip(0, 1), 0.0)
        names = [self.languages[i] if n else UNKNOWN for i, n in zip(best, n_letters, strict=True)]
        return names, score, (n_letters == 0) | (score < self.floor)


def unit(x: np.ndarray) -> np.ndarray:
    return (x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)).astype(np.float32)


def cluster(vectors: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """Up to k unit centroids by cosine, started from the first vector and those farthest from all chosen."""
    chosen = [0]
    nearest = vectors @ vectors[0]
    while len(chosen) < min(k, len(vectors)) and nearest.min() < 1 - 1e-6:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centroids = vectors[chosen]
    for _ in range(rounds):
        own = (vectors @ centroids.T).argmax(axis=1)
        new = np.stack([unit(vectors[own == i].sum(axis=0)) if (own == i).any() else centroids[i] for i in range(len(centroids))])
        if np.allclose(new, centroids, atol=1e-6):
            break
        centroids = new
    return centroids


def fit_vectors(counts: np.ndarray, langs: list[str], k: int = CENTROIDS) -> Model:
    n = len(langs)
    idf = np.log((1 + n) / (1 + np.count_nonzero(counts, axis=0))) + 1
    vectors = np.log1p(counts, dtype=np.float32)
    vectors *= idf.astype(np.float32)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    names, parts, own = [], [], []
    langs = np.array(langs, object)
    for lang in sorted(set(langs)):
        mine = vectors[langs == lang]
        centroids = cluster(mine, k)
        names += [lang] * len(centroids)
        parts.append(centroids)
        own.append((mine @ centroids.T).max(axis=1))
    floor = 0.5 * float(np.quantile(np.concatenate(own), 0.001)) if own else 0.0
    return Model(names, np.concatenate(parts) if parts else np.empty((0, counts.shape[1]), np.float32), idf, floor)


def held_out(id_col: Column) -> Column:
    """Never null: a row without an identifier is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, k: int = CENTROIDS, dims: int = DIMS) -> Model:
    """Learn from at most ``sample`` labelled texts that are not held out, or LEAST of each language if that is more."""
    given = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[lang_col].alias("label"))
    labelled = given.where("id IS NOT NULL AND label IS NOT NULL AND text IS NOT NULL").where(~held_out(F.col("id")))
    keyed = labelled.select("label", linear.small_hash(F.col("id"), F.col("text")).alias("order"), F.col("id").cast("string"), "text")
    known = [r["label"] for r in labelled.select("label").distinct().collect()]  # languages are few
    share = max(sample // max(len(known), 1), LEAST)
    chosen = linear.smallest(keyed, share, once=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                counts, n_letters = gram_counts(part.column(1).to_pylist(), dims)
                rows = np.minimum(counts, 65535).astype("<u2")[n_letters > 0]
                langs = [x for x, m in zip(part.column(2).to_pylist(), n_letters, strict=True) if m]
                ids = [x for x, m in zip(part.column(0).to_pylist(), n_letters, strict=True) if m]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(langs, pa.string()), pa.array([r.tobytes() for r in rows], pa.binary())], ["id", "lang", "counts"])

    rows = chosen.select("id", "text", "label").mapInArrow(run, "id string, lang string, counts binary").collect()
    rows.sort(key=lambda r: (r["id"], r["lang"]))  # the order of partitions does not matter
    langs = [r["lang"] for r in rows]
    counts = np.empty((len(rows), dims), np.uint16)
    for i in range(len(rows)):
        counts[i] = np.frombuffer(rows[i]["counts"], "<u2")
        rows[i] = None  # the bytes are not kept beside the matrix
    return fit_vectors(counts, langs, k)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """id, lang_pred, score, rejected; with ``carry`` a struct _row of all columns in place of the id."""
    row = F.struct("*") if carry else docs[id_col]
    given = docs.select(row.alias("_row"), docs[text_col].alias("_text"))
    name = "_row" if carry else id_col
    fields = [StructField(name, given.schema["_row"].dataType), StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 128):
                b = whole.slice(i, 128)
                names, score, rejected = model.predict([t or "" for t in b.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names), pa.array(score, pa.float64()), pa.array(rejected)], [name, "lang_pred", "score", "rejected"])

    return given.mapInArrow(tidy(run), StructType(fields))
