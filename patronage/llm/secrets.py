"""Secrets in texts: three fixed patterns, and strings that a primed compressor finds new.

A candidate is a long string of key-like characters that starts soon after a sensitive
word; every one that does is measured, as a whole, and if it is not new the pieces that
follow sensitive words inside it are. It is
compressed by zstandard primed with an identifier dictionary and the surrounding text;
its marginal bytes, those beyond an empty frame, say how much of it is new. Names,
paths and words of the text come out short, keys do not compress: a candidate is
reported as ``novel`` if it costs at least NOVELTY of what random characters of its own
alphabet cost, unless a pattern has found it already. Its alphabet is the smallest of
ALPHABETS that holds its letters and digits, and the other characters it has. Letters
alone count as any other, so a long unknown word near a sensitive one is reported too.
Other candidates that copy a candidate do not prime it, so a key that stands twice after
sensitive words is reported twice; a copy with no sensitive word before it does.

Defined cases: a null text counts as empty and has no spans. Positions are code points,
ends exclusive. Repeated rows give equal rows, an empty table none. Texts of any length
are searched whole; other columns do not take part.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import string
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "novel")
# fixed patterns; letters of the first in either case, ASCII only
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 8, 16, 32

SENSITIVE = re.compile(r"passw|passphrase|pwd|secret|token|key|credential|auth|bearer|signature|private", re.IGNORECASE | re.ASCII)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Characters from a sensitive word to the start of a candidate, and of text on either side that prime the compressor.
REACH, AROUND = 48, 512
NOVELTY = 0.8
ALPHABETS = (
    string.digits, string.digits + "abcdef", string.digits + "ABCDEF", string.hexdigits, string.ascii_lowercase, string.ascii_uppercase,
    string.digits + string.ascii_lowercase, string.digits + string.ascii_uppercase, string.ascii_letters, string.digits + string.ascii_letters,
)
#: What may stand around a key or between its parts.
JOINTS = "+/_=-"
IDENTIFIERS = (
    "password passwd passphrase secret token api_key apikey access_key private_key public_key client_secret authorization bearer credential signature "
    "username localhost example placeholder changeme undefined null none true false return import function class public private static void string "
    "const config settings environment getenv process request response session cookie header content application json http https www com org net "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 00000000000000000000000000000000 xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx"
)
_HEX_BYTES = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three patterns, by start, then kind. Cheap tests come before the patterns."""
    found: list[tuple[int, int, str]] = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    if b"h" * HEX_CHARS in text.encode("utf-8", "replace").translate(_HEX_BYTES):
        found += [(*m.span(), "hex") for m in HEX.finditer(text) if len(m[0]) >= HEX_CHARS]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def marginal_bytes(candidate: str, around: str, identifiers: str = IDENTIFIERS) -> int:
    """Bytes that the candidate adds to a frame primed with the identifiers and its surroundings."""
    primer = zstandard.ZstdCompressionDict((identifiers + "\n" + around).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packer = zstandard.ZstdCompressor(level=3, dict_data=primer, write_content_size=False, write_checksum=False, write_dict_id=False)
    return len(packer.compress(candidate.encode())) - len(packer.compress(b""))


@functools.lru_cache(maxsize=4096)
def random_bytes(alphabet: str, n: int) -> int:
    """Marginal bytes of n random characters."""
    return marginal_bytes("".join(random.Random(n).choices(alphabet, k=n)), "")


def alphabet(candidate: str) -> str:
    """Sorted characters that a string like this is drawn from."""
    used = set(candidate)
    return "".join(sorted(set(next(a for a in ALPHABETS if used - set(JOINTS) <= set(a))) | used))


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) of every candidate, by start."""
    found, done = [], 0
    for word in SENSITIVE.finditer(text):
        done = max(word.end(), done)
        while m := CANDIDATE.search(text, done, max(done, word.end() + REACH + 16)):  # so it starts within reach
            done = CANDIDATE.match(text, m.start()).end()  # its true end, however long
            found.append((m.start(), done))
    return found


def surroundings(text: str, every: list[tuple[int, int]], i: int, start: int, end: int) -> str:
    """What stands before and after a piece of the i-th candidate, without the other candidates' copies of it."""
    low, high = max(0, start - AROUND), min(len(text), end + AROUND)
    own, core = text[start:end], text[start:end].strip(JOINTS)
    gone = [(start, end)]
    near = AROUND // 8  # more than there can be
    others = itertools.chain(itertools.takewhile(lambda x: x[1] > low, reversed(every[max(0, i - near) : i])), itertools.takewhile(lambda x: x[0] < high, every[i + 1 : i + 1 + near]))
    for a, b in others:
        other = text[a:b]
        if other.strip(JOINTS) in own:
            gone.append((a, b))
        elif core in other:
            gone += [(a + m.start(), a + m.end()) for m in re.finditer(re.escape(core), other)]
    parts, at = [], low
    for a, b in sorted(gone):
        parts.append(text[at : max(at, a)])
        at = max(at, b)
    return "\n".join([*parts, text[at:high]])


def novel_spans(text: str, taken: list[tuple[int, int, str]], least: float = NOVELTY) -> list[tuple[int, int, str]]:
    found, every = [], candidates(text)

    def novel(i: int, start: int, end: int) -> bool:
        candidate = text[start:end]
        return marginal_bytes(candidate, surroundings(text, every, i, start, end)) >= least * random_bytes(alphabet(candidate), end - start)

    for i, (start, end) in enumerate(every):
        if any(a < end and start < b for a, b, _ in taken):
            continue
        if novel(i, start, end):
            found.append((start, end, "novel"))
        else:
            words = [m.span() for m in SENSITIVE.finditer(text, start, end)]
            pieces = itertools.pairwise([*words, (end, end)])
            found += [(a, b, "novel") for (_, a), (b, _) in pieces if CANDIDATE.fullmatch(text, a, b) and novel(i, a, b)]
    return found


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_assign, n_access, n_hex, n_novel, base_sha256, spans."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                base = base_spans(text or "")
                every = sorted(base + novel_spans(text or "", base), key=lambda x: (x[0], KINDS.index(x[2])))
                kinds = [x[2] for x in every]
                rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])], names)

    return docs.select(docs[id_col], docs[text_col]).mapInArrow(run, f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string")
