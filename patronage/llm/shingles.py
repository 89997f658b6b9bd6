"""Hashed word shingles of texts, as multisets, in NumPy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)
#: Words that are hashed at a time; a matter of memory only.
PIECE = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def word_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial over a running sum, mixed with the length."""
    if not words:
        return np.empty(0, U)
    data = np.frombuffer("\n".join(words).encode("utf-8", "surrogatepass"), np.uint8)
    ends = np.append(np.flatnonzero(data == 10), len(data))
    starts = np.append(0, ends[:-1] + 1)
    with np.errstate(over="ignore"):
        inverse = pow(int(_BASE), -1, 1 << 64)
        sums = np.append(U(0), np.cumsum((data.astype(U) + U(1)) * _powers(len(data), int(_BASE)), dtype=U))
        plain = (sums[ends] - sums[starts]) * _powers(len(data) + 1, inverse)[starts]
        return mix(plain + (ends - starts).astype(U) * U(0xD1B54A32D192ED03))


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n."""
    out = np.zeros(len(hashes) - n + 1, U)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = mix(out * U(31) + hashes[i : i + len(out)])
    return out


def multisets(texts: list[str], n: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count), by text and hash. A text of 1 to n-1 words has one shingle, all of them; one without words has none.

    Words are what white space parts in the lower-cased text.
    """
    split = [t.lower().split() for t in texts]
    owners, values = [], []
    for i, words in enumerate(split):
        if 0 < len(words) < n:
            owners.append(np.array([i]))
            values.append(chained(word_hashes(words), len(words)) + U(len(words)))
    long = [i for i, words in enumerate(split) if len(words) >= n]
    flat = [w for i in long for w in split[i]]
    if flat:
        hashes = np.concatenate([word_hashes(flat[a : a + PIECE]) for a in range(0, len(flat), PIECE)])
        owner = np.repeat(np.array(long), [len(split[i]) for i in long])
        whole = owner[: len(owner) - n + 1] == owner[n - 1 :]
        owners.append(owner[: len(whole)][whole])
        values.append(chained(hashes, n)[whole])
    if not owners:
        return np.empty(0, np.int64), np.empty(0, U), np.empty(0, np.int64)
    owner, value = np.concatenate(owners), np.concatenate(values)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])))
    return owner[first], value[first], np.diff(np.append(first, len(owner)))


def slices(texts: list[str], chars: int = 1 << 21, most: int = 512) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many characters; a longer text is one range."""
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and upto - at < most and (upto == at or size + len(texts[upto]) <= chars):
            size += len(texts[upto])
            upto += 1
        yield at, upto
        at = upto
