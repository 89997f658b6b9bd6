"""Removal of byte strings that also start in a document with a smaller identifier.

Every string of LENGTH bytes has leading minimisers: the GRAM-byte pieces with its
smallest hash. Equal strings have equal minimisers at equal offsets, so occurrences of a
minimiser are grouped by its hash and only groups of several documents go on. Inside a
group, occurrences whose whole context (every string that can have the minimiser there)
is equal are settled by their smallest document. What is left, one document for each
distinct context of groups with several contexts, is compared by suffix arrays.

For that a context is cut into a few offset ranges. Within a range all strings share a
core around the minimiser; it becomes one letter, with up to FREE bytes on either side.
Strings with the same core meet in one task, and a suffix array over their
concatenation, built in linear time by suffix grouping, places equal strings side by
side. Ranges also bound a group: what meets differs in 2 * FREE bytes only.

``suffix_array`` follows the two phases of linear grouping construction. First, suffix
groups are processed from the largest to the smallest; each suffix's pointer to the
previous suffix of a smaller group is found along earlier pointers, and the suffixes
pointed to move, by how often they are pointed to, to new groups behind their old ones,
so that in the end a group shares its Lyndon prefix. Then the array is filled from the
front, each suffix found placing its predecessors at the heads of their groups. Nothing
is renamed or sorted again.

Minimisers travel many to a row, by ranges of their hash. Those that a sample shows to be
frequent are dealt by document and settled by an aggregate that is combined before its
shuffle; the sample only balances load. Texts travel compressed.

Defined cases: a null text counts as empty. Texts shorter than LENGTH bytes lose
nothing. Documents with equal identifiers do not remove each other's bytes, and rows
that share one are told apart by their text. A row without an identifier neither loses
nor removes bytes. An empty table gives no rows; other columns do not take part.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from ..session import durable
from .shingles import U, mix

LENGTH, GRAM, FREE = 50, 20, 7
#: Share of documents that are looked at for frequent minimisers, and how many of these are dealt by document.
SAMPLE_ONE_IN, MOST_FREQUENT = 64, 1 << 16
#: Rows in one bucket of minimisers (about), rows held before they are dealt, letters in one suffix array, bytes of text in one step; matters of memory only.
BUCKET_ROWS, HELD, ARRAY_LETTERS, PIECE = 1 << 17, 1 << 18, 1 << 15, 1 << 18
#: Bits of a minimiser's hash. More than one in a group only means that more contexts are compared.
KEY_BITS = 40
END, BREAK, LETTER, CORE = 0, 1, 2, 300
TAG_SHIFT, TAG_MASK = 40, (1 << 20) - 1


# ------------------------------------------------------------- suffix arrays


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffix array of a text whose last letter is its smallest and occurs once."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    ordered = text[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    sizes = np.diff(np.append(starts, n))
    group, at, size = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, np.int64)
    group[order], at[order], size[starts] = np.repeat(starts, sizes), np.arange(n), sizes
    sa, group, at, size = order.tolist(), group.tolist(), at.tolist(), size.tolist()
    previous = [-1] * n
    top = n
    while top:  # phase one: groups in descending order
        first = group[sa[top - 1]]
        pointed: dict[int, int] = {}
        for i in sorted(sa[first:top]) if top - first > 1 else (sa[first],):
            p = i - 1
            while p >= 0 and group[p] >= first:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        by_group: dict[int, list] = {}
        for p, times in pointed.items():
            if size[group[p]] > 1:
                by_group.setdefault(group[p], []).append((times, p))
        for old, moving in by_group.items():
            moving.sort(reverse=True)
            end = old + size[old]
            while moving and end > old:
                times, start = moving[0][0], end
                k = 0
                for k, (t, p) in enumerate(moving):
                    if t != times:
                        break
                    start -= 1
                    q, a = sa[start], at[p]
                    sa[a], at[q] = q, a
                    sa[start], at[p] = p, start
                else:
                    k += 1
                moving = moving[k:]
                for x in range(start, end):
                    group[sa[x]] = start
                size[start] = end - start
                end = start
            if end > old:
                size[old] = end - old
        top = first
    head = list(range(n))  # phase two: the next free place of each group
    out, placed = [-1] * n, bytearray(n)
    out[0], placed[n - 1] = n - 1, 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[head[g]] = j
            head[g] += 1
            placed[j] = 1
            j = previous[j]
    return np.array(out)


def _common(texts: list[bytes]) -> int:
    """Length of the longest common start."""
    low, high = min(texts), max(texts)
    return next((i for i, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), min(len(low), len(high)))


def smallest_docs(cores: list[list[tuple[bytes, bytes, int]]], free: int = FREE) -> list[list[np.ndarray]]:
    """For each core's distinct (left, right, doc), the smallest doc that has each of its strings.

    Entry u of an answer belongs to the string that takes u bytes of left, the core and
    free - u bytes of right; strings that do not fit have the largest integer. Bytes next
    to the core that all its strings share are one letter with it.
    """
    none = np.iinfo(np.int64).max
    letters, docs, starts, owner, taken, widths = [], [], [], [], [], []
    size, flat = 0, 0
    for c, strings in enumerate(cores):
        before = _common([s[0][::-1] for s in strings])
        after = _common([s[1] for s in strings])
        for left, right, doc in strings:
            edge = len(left) - before
            whole = np.frombuffer(left[:edge] + b"\0" + right[after:] + b"\0", np.uint8).astype(np.int64) + LETTER
            whole[edge], whole[-1] = CORE + c, BREAK
            letters.append(whole)
            use = np.arange(max(0, free - len(right)), min(free, len(left)) + 1)
            lead = np.maximum(use - before, 0)
            starts.append(size + edge - lead)
            widths.append(lead + 1 + np.maximum(free - use - after, 0))
            taken.append(use)
            owner.append(np.full(len(use), flat))
            docs.append(doc)
            size += len(whole)
            flat += 1
    text = np.concatenate([*letters, [END]])
    start, use, own, width = (np.concatenate(x) for x in (starts, taken, owner, widths))
    rank = np.empty(len(text), np.int64)
    rank[suffix_array(text)] = np.arange(len(text))
    order = np.lexsort((rank[start], use))  # equal strings take as much of left
    start, use, own, width = start[order], use[order], own[order], width[order]
    at = np.arange(free + 1)
    strings = np.where(at < width[:, None], np.append(text, np.zeros(free, np.int64))[start[:, None] + at], -1)
    new = np.append(True, (strings[1:] != strings[:-1]).any(axis=1) | (use[1:] != use[:-1]))
    least = np.minimum.reduceat(np.array(docs)[own], np.flatnonzero(new))[np.cumsum(new) - 1]
    answers = np.full((flat, free + 1), none)
    answers[own, use] = least
    rows = iter(answers)
    return [[next(rows) for _ in strings] for strings in cores]


# ---------------------------------------------------------------- minimisers


def _rolled(symbols: np.ndarray, lengths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Hashes of all pieces of the given lengths, from pieces of half the length and less."""
    found: dict[int, np.ndarray] = {}
    with np.errstate(over="ignore"):
        power, size, parts = symbols, 1, {x: None for x in lengths}
        while True:
            for x in lengths:
                if x & size:
                    parts[x] = (power, size) if parts[x] is None else _paired(*parts[x], power, size)
            if size * 2 > max(lengths):
                break
            power, size = _paired(power, size, power, size)
        for x in lengths:
            found[x] = parts[x][0]
    return found


def _paired(left: np.ndarray, a: int, right: np.ndarray, b: int) -> tuple[np.ndarray, int]:
    n = min(len(left), len(right) - a)
    out = left[:n] * U(0x9E3779B97F4A7C15)
    out += right[a : a + n]
    out ^= out >> U(29)
    out *= U(0xBF58476D1CE4E5B9)
    return out, a + b


def _slid(values: np.ndarray, width: int, best) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return best(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, position, hash, context hash) of every piece that is a leading minimiser of some string. Ties are all taken."""
    slack = length - gram
    sizes = np.array([len(t) for t in texts])
    pad = bytes(length)
    # a break of zeros follows each text; letters are one and up
    raw = np.frombuffer(pad + b"".join(t + pad for t in texts), np.uint8)
    begin = length + np.append(0, np.cumsum(sizes + length)[:-1])
    owner = np.full(len(raw), -1)
    for i, (b, s) in enumerate(zip(begin, sizes, strict=True)):
        owner[b : b + s] = i
    symbols = raw.astype(U)
    symbols[owner >= 0] += U(1)
    rolled = _rolled(symbols, (gram, 2 * slack + gram))
    grams = rolled[gram]
    valid = np.zeros(len(raw), bool)
    for b, s in zip(begin, sizes, strict=True):
        valid[b : b + max(0, s - length + 1)] = True
    least = _slid(grams, slack + 1, np.minimum)
    least = np.where(valid[: len(least)], least, U(0))
    # a piece is a minimiser if one of the strings that can lead with it has its hash as the least
    reach = np.concatenate([np.zeros(slack, U), least, np.zeros(len(grams) - len(least), U)])
    most = _slid(reach, slack + 1, np.maximum)[: len(grams)]
    at = np.flatnonzero((most == grams) & (owner[: len(grams)] >= 0) & (most > 0))
    return owner[at], at - begin[owner[at]], mix(grams[at]).view(np.int64), mix(rolled[2 * slack + gram][at - slack]).view(np.int64)


def tag(text: bytes) -> int:
    """Tells apart the texts of rows that share an identifier; rides above the position."""
    return (zlib.crc32(text) & TAG_MASK) << TAG_SHIFT


def all_anchors(texts: list[bytes], length: int, gram: int, piece: int = PIECE) -> Iterator[tuple[np.ndarray, ...]]:
    """``anchors`` of any number of texts of any length, in steps of bounded memory."""
    margin = 2 * length  # shows the strings and contexts of every position of a piece
    at = 0
    while at < len(texts):
        upto, size = at + 1, len(texts[at])
        while upto < len(texts) and size + len(texts[upto]) <= piece:
            size += len(texts[upto])
            upto += 1
        if size <= piece:
            owner, pos, anchor, ctx = anchors(texts[at:upto], length, gram)
            yield owner + at, pos, anchor, ctx
        else:
            for a in range(0, size, piece):
                low = max(0, a - margin)
                owner, pos, anchor, ctx = anchors([texts[at][low : a + piece + margin]], length, gram)
                mine = (pos + low >= a) & (pos + low < a + piece)
                yield owner[mine] + at, pos[mine] + low, anchor[mine], ctx[mine]
        at = upto


def _tables(docs: DataFrame, length: int, gram: int, tagged: bool, make, schema: str) -> DataFrame:
    """``make`` turns the anchors of some documents, as (key, context, doc, pos) arrays of bounded length, into batches. docs: doc, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            texts = [t.encode() for t in b.column(1).to_pylist()]
            tags = np.array([tag(t) if tagged else 0 for t in texts], np.int64)
            for owner, pos, anchor, ctx in all_anchors(texts, length, gram):
                held.append((anchor.view(U) >> U(64 - KEY_BITS), ctx, ids[owner], pos | tags[owner]))
                size += len(pos)
                if size >= HELD:
                    yield from make(*[np.concatenate(x) for x in zip(*held, strict=True)])
                    held, size = [], 0
        if size:
            yield from make(*[np.concatenate(x) for x in zip(*held, strict=True)])

    return docs.where(F.octet_length("text") >= length).select("doc", "text").mapInArrow(run, schema)


def planes(column: np.ndarray) -> bytes:
    """The bytes of integers, first all lowest ones, and so on: high bytes, mostly equal, then compress away."""
    return np.ascontiguousarray(column.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unplaned(data: memoryview) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _blobs(named: DataFrame, length: int, gram: int, tagged: bool, n_buckets: int, frequent: np.ndarray) -> DataFrame:
    """bucket, data: anchors by ranges of their key, many in one row. Frequent ones go to buckets past n_buckets, by document."""

    def make(key, ctx, doc, pos):
        often = np.isin(key, frequent)
        bucket = np.where(often, U(n_buckets) + mix(doc.view(U)) % U(n_buckets), key * U(n_buckets) >> U(KEY_BITS))
        order = np.argsort(bucket << U(KEY_BITS) | key, kind="stable")
        bucket, key, ctx, doc, pos = (x[order] for x in (bucket, key, ctx, doc, pos))
        edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket)).tolist()
        for at in range(0, len(edges) - 1, 256):
            ranges_of = list(zip(edges[at : at + 256], edges[at + 1 : at + 257], strict=False))
            data = [planes(np.diff(key[a:b].view(np.int64), prepend=0)) + planes(ctx[a:b]) + planes(doc[a:b]) + planes(pos[a:b]) for a, b in ranges_of]
            yield pa.RecordBatch.from_arrays([pa.array([int(bucket[a]) for a, _ in ranges_of], pa.int32()), pa.array(data, pa.binary())], ["bucket", "data"])

    return _tables(named, length, gram, tagged, make, "bucket int, data binary")


REMOVED, KEPT, FREQUENT = 0, 1, 2


def settle(key: np.ndarray, ctx: np.ndarray, doc: np.ndarray, often: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(rows, kinds) of the occurrences that matter among whole groups of anchors, or among parts of frequent ones.

    REMOVED: a smaller document has the same context. KEPT: the context's smallest
    document, in a group with other contexts. FREQUENT: the smallest of a part.
    """
    order = np.lexsort((doc, ctx, key))
    key, ctx, doc = key[order], ctx[order], doc[order]
    new = np.append(True, key[1:] != key[:-1])
    starts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    new_ctx = new | np.append(True, ctx[1:] != ctx[:-1])
    ctx_least = doc[np.flatnonzero(new_ctx)][np.cumsum(new_ctx) - 1]
    if often:
        return order, np.where(doc > ctx_least, REMOVED, FREQUENT)
    shared = np.minimum.reduceat(doc, starts) < np.maximum.reduceat(doc, starts)
    several = np.add.reduceat(new_ctx.astype(np.int64), starts) > 1
    kind = np.where(doc > ctx_least, REMOVED, KEPT)
    use = shared[group] & ((kind == REMOVED) | several[group])
    return order[use], kind[use]


def _settled(blobs: DataFrame, n_buckets: int) -> DataFrame:
    """doc, pos, kind, anchor, ctx; the last two only of frequent ones, which are not settled here. blobs: sorted by bucket, a bucket in one partition."""

    def batch(doc, pos, kind, key=None, ctx=None):
        sides = [pa.nulls(len(doc), pa.int64()) if x is None else pa.array(x) for x in (key, ctx)]
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(pos), pa.array(kind, pa.int32()), *sides], ["doc", "pos", "kind", "anchor", "ctx"])

    def solved(bucket: int, data: list) -> Iterator[pa.RecordBatch]:
        parts = []
        for buffer in data:
            quarter = len(buffer) // 4
            key, ctx, doc, pos = (unplaned(buffer[i * quarter : (i + 1) * quarter]) for i in range(4))
            parts.append((np.cumsum(key), ctx, doc, pos))
        key, ctx, doc, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
        often = bucket >= n_buckets
        rows, kind = settle(key, ctx, doc, often)
        for at in range(0, len(rows), 50_000):
            r, k = rows[at : at + 50_000], kind[at : at + 50_000]
            yield batch(doc[r], pos[r], k, *((key[r], ctx[r]) if often else ()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, data = None, []
        for b in batches:
            for name, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if name != bucket and data:
                    yield from solved(bucket, data)
                    data = []
                bucket = name
                data.append(memoryview(value))
        if data:
            yield from solved(bucket, data)

    return blobs.mapInArrow(run, "doc long, pos long, kind int, anchor long, ctx long")


# ------------------------------------------------------------------- strings


def ranges(length: int = LENGTH, gram: int = GRAM, free: int = FREE) -> list[int]:
    """Lower ends of the offset ranges, each of free + 1 offsets, that cover 0 ... length - gram."""
    slack = length - gram
    return [*range(0, slack - free, free + 1), slack - free]


def core_strings(text: bytes, pos: int, length: int = LENGTH, gram: int = GRAM, free: int = FREE) -> Iterator[tuple[bytes, bytes, bytes, int]]:
    """(hash of the core, left, right, start of the core) for each offset range that has a string."""
    slack = length - gram
    for low in ranges(length, gram, free):
        high = low + free
        a, b = pos - low, pos + gram + slack - high
        if a < 0 or b > len(text):
            continue
        left, right = text[max(0, a - free) : a], text[b : b + free]
        if len(left) + len(right) >= free:
            yield hashlib.blake2b(text[a:b], digest_size=16, salt=low.to_bytes(2, "little")).digest(), left, right, a


def merged(spans: np.ndarray) -> np.ndarray:
    """Disjoint, ascending spans (rows of start, end) that cover the same; touching ones are joined."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    ends = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > ends[:-1])
    first = np.flatnonzero(new)
    return np.column_stack([spans[first, 0], ends[np.append(first[1:] - 1, len(spans) - 1)]])


def cut(text: bytes, spans: np.ndarray) -> bytes:
    """What is left of a text without disjoint ascending spans."""
    edges = [0, *spans.ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _core_rows(found: DataFrame, length: int, gram: int, free: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, version, packed, kept in zip(*[c.to_pylist() for c in b.columns], strict=True):
                data = zstandard.decompress(packed)
                out += [(*row, doc, version) for p in kept for row in core_strings(data, p, length, gram, free)]
            columns = zip(*out, strict=True) if out else [()] * 6
            kinds = [pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["core", "left", "right", "at", "doc", "version"])

    return found.where("size(kept) > 0").select("doc", "version", "packed", "kept").mapInArrow(run, "core binary, left binary, right binary, at long, doc long, version long")


def _compared(rows: DataFrame, length: int, free: int) -> DataFrame:
    """doc, version, start, end of removed strings. rows: sorted by core, left, right, doc, a core in one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        cores: list[dict] = []
        letters = 0

        def solve() -> None:
            nonlocal cores, letters
            cores = [c for c in cores if len(c) > 1 and len({v[0] for v in c.values()}) > 1]
            if cores:
                answers = smallest_docs([[(*k, v[0]) for k, v in c.items()] for c in cores], free)
                for c, answer in zip(cores, answers, strict=True):
                    for (doc, places), least in zip(c.values(), answer, strict=True):
                        gone = np.flatnonzero(least < doc).tolist()
                        out.extend((doc, version, at - u, at - u + length) for at, version in places for u in gone)
            cores, letters = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal out
            done, out = out, []
            columns = zip(*done, strict=True) if done else [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "version", "start", "end"])

        core = None
        for b in batches:
            for key, left, right, at, doc, version in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if key != core:
                    if letters > ARRAY_LETTERS:
                        solve()
                    core = key
                    cores.append({})
                strings = cores[-1]
                if (left, right) not in strings:
                    strings[left, right] = (doc, [(at, version)])
                    letters += len(left) + len(right) + 2
                elif strings[left, right][0] == doc:
                    strings[left, right][1].append((at, version))
                else:  # a smaller document has the whole of it
                    use = range(max(0, free - len(right)), min(free, len(left)) + 1)
                    out.append((doc, version, at - use[-1], at - use[0] + length))
                if len(out) > 50_000:
                    yield flush()
        solve()
        yield flush()

    return rows.mapInArrow(run, "doc long, version long, start long, end long")


# ------------------------------------------------------------------ operator


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, free: int = FREE) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed bytes as little-endian pairs of start and end)."""
    if length - gram < free:
        raise ValueError("the free bytes must fit between the minimiser's and the string's length")
    kind = docs.schema[id_col].dataType
    given = docs.select(docs[id_col].cast("long").alias("doc"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    named = given.where("doc IS NOT NULL")
    tagged = not named.groupBy("doc").count().where("count > 1").isEmpty()
    n_buckets, frequent = _plan(named, length, gram)
    blobs = _blobs(named, length, gram, tagged, n_buckets, frequent)
    settled = durable(_settled(blobs.repartition("bucket").sortWithinPartitions("bucket"), n_buckets))
    hot = settled.where(F.col("kind") == FREQUENT).select("anchor", "ctx", "doc", "pos")
    first = hot.groupBy("anchor", "ctx").agg(F.min("doc").alias("least"))
    hot = hot.join(first, ["anchor", "ctx"]).select("doc", "pos", F.when(F.col("doc") > F.col("least"), REMOVED).otherwise(KEPT).alias("kind"))
    mine = settled.where(F.col("kind") != FREQUENT).select("doc", "pos", "kind").unionByName(hot)
    # a long holds a position and its kind; a document's own rows are as many as its text is long
    lists = mine.groupBy("doc").agg(F.collect_list(F.col("pos") * 2 + F.col("kind")).alias("marks"))
    found = durable(_met(_packed(given).join(lists, "doc", "left").select("doc", "version", "packed", "marks"), length, gram))
    cores = _core_rows(found, length, gram, free)
    more = _compared(cores.repartition("core").sortWithinPartitions("core", "left", "right", "doc"), length, free)
    more = more.groupBy("doc", "version").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    open_ = found.where("packed IS NOT NULL").join(more, ["doc", "version"], "left").select("doc", "packed", "spans", "starts", "ends")
    closed = found.where("packed IS NULL").select("doc", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), "kept_sha256", "spans")
    return closed.unionByName(_finished(open_)).select(F.col("doc").cast(kind).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


def _plan(named: DataFrame, length: int, gram: int) -> tuple[int, np.ndarray]:
    """Number of buckets, and the keys that would fill half a bucket alone, by a sample that grows with the corpus."""

    def make(key, ctx, doc, pos):
        keys, n = np.unique(key.view(np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["key", "n"])

    some = named.where(F.pmod(F.xxhash64("doc"), F.lit(SAMPLE_ONE_IN)) == 0)
    counts = durable(_tables(some, length, gram, False, make, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")))
    rows = (counts.agg(F.sum("n")).first()[0] or 0) * SAMPLE_ONE_IN
    often = counts.where(F.col("n") * SAMPLE_ONE_IN > BUCKET_ROWS // 2).orderBy(F.desc("n"), "key").limit(MOST_FREQUENT).select("key").collect()
    return max(64, min(rows // BUCKET_ROWS, 1 << 23)), np.array([r[0] for r in often], np.int64).view(U)


def _packed(given: DataFrame) -> DataFrame:
    """doc, version, packed: the texts compressed before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for b in batches:
            packed = [packer.compress(t.encode()) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(packed, pa.binary())], ["doc", "version", "packed"])

    return given.select("doc", F.xxhash64("text").alias("version"), "text").mapInArrow(run, "doc long, version long, packed binary")


def _met(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """doc, version, packed, n_bytes, kept_sha256, spans, kept: the text only of documents with marks, the digest only of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, version, packed, marks in zip(*[c.to_pylist() for c in b.columns], strict=True):
                data = zstandard.decompress(packed)
                m = np.array(marks or [], np.int64)
                tags = m >> TAG_SHIFT + 1
                m = m[(tags == 0) | (tags == tag(data) >> TAG_SHIFT)] & (1 << TAG_SHIFT + 1) - 1
                if not len(m):
                    out.append((doc, version, None, len(data), hashlib.sha256(data).hexdigest(), b"", []))
                    continue
                pos = m[m % 2 == REMOVED] // 2
                spans = merged(np.column_stack([np.maximum(pos - (length - gram), 0), np.minimum(pos + length, len(data))]))
                out.append((doc, version, packed, len(data), None, spans.astype("<i8").tobytes(), np.sort(m[m % 2 == KEPT] // 2)))
            columns = zip(*out, strict=True) if out else [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc", "version", "packed", "n_bytes", "kept_sha256", "spans", "kept"])

    return rows.mapInArrow(run, "doc long, version long, packed binary, n_bytes long, kept_sha256 string, spans binary, kept array<long>")


def _finished(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, packed, spans, starts, ends in zip(*[c.to_pylist() for c in b.columns], strict=True):
                data = zstandard.decompress(packed)
                own = np.frombuffer(spans, "<i8").reshape(-1, 2)
                every = merged(np.concatenate([own, np.column_stack([starts, ends])]) if starts else own)
                kept = cut(data, every)
                out.append((doc, len(data), len(data) - len(kept), len(every), hashlib.sha256(kept).hexdigest(), every.astype("<i8").tobytes()))
            columns = zip(*out, strict=True) if out else [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return rows.mapInArrow(run, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans binary")
