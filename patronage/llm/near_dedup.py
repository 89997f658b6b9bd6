"""Near-duplicate groups by BagMinHash signatures of word-shingle multisets.

A text is the multiset of its five-word shingles; the similarity is weighted Jaccard.
Each shingle is a Poisson process over the registers. Its weight axis is cut into the
intervals (0,1], (1,2], (2,4], (4,8], ...; an interval of length L sends points at rate
L, each point falls on one unit of the interval, and only units within the shingle's
count are taken. So texts share every point of the weight they share and no other, and
a register's first point agrees with a probability equal to the similarity. Points come
in order of time, and a text stops once its slowest register is ahead of them.

Texts with the same multiset are one node. Nodes that agree in one band of registers
are candidates. A bucket is never paired out: its most central node leads it and each
member is verified against the leader by the exact multiset overlap. A link that this
does not show is between members of which one has no link to the leader; if the other
has, the first must still overlap the leader by 2 * similarity - 1 (distances add up).
These few go to a task as a bounded group, which finds all their overlaps from the
shingles that two of them share and returns no more links than join its components.
Groups are the connected components of all links.

Defined cases: a null text counts as empty. Texts without words are groups of their own.
Rows that share an identifier share a group only if their texts do. A null identifier
never leads a group. Repeated rows are in one group. An empty table gives no rows; other
columns do not take part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import durable
from .common import tidy
from .shingles import U, mix, multisets, slices

REGISTERS, BANDS, ROWS = 128, 25, 5  # a pair at 0.8 shares no band with a chance of 5e-5
SIMILARITY = 0.8
#: Bounds on a block of nodes that are compared in one task, and what counts as an element that few of them hold.
GROUP_NODES, GROUP_SHINGLES, RARE = 1024, 1 << 20, 12


def signatures(owner: np.ndarray, value: np.ndarray, count: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """(n, registers) of the first points; a text without shingles keeps the largest value.

    A point is its time (upper 32 bits, as a float's bits) and a hash that names it.
    """
    levels = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64) + 1  # intervals that the count reaches
    which = np.repeat(np.arange(len(owner)), levels)
    level = np.arange(len(which)) - np.repeat(np.cumsum(levels) - levels, levels)
    below = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)  # lower end of the interval
    length = np.where(level > 0, np.maximum(below, 1), 1)
    text, most = owner[which], count[which] - below
    with np.errstate(over="ignore"):
        state = mix(value[which] + level.astype(U) * U(0xA0761D6478BD642F))
    time = np.zeros(len(which))
    first = np.full(n * registers, np.iinfo(U).max, U)
    step = U(0)
    while len(state):
        with np.errstate(over="ignore"):
            step += U(0x9E3779B97F4A7C15)
            a = mix(state + step)
            b = mix(a ^ U(0x5851F42D4C957F2D))
        time = time - np.log((a >> U(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / length
        register = (b >> U(40)).astype(np.int64) % registers
        unit = ((b & U(0xFFFFFF)).astype(np.float64) * 2.0**-24 * length).astype(np.int64)
        taken = unit < most
        point = (time.astype(np.float32).view(np.uint32).astype(U) << U(32)) | (a & U(0xFFFFFFFF))
        np.minimum.at(first, text[taken] * registers + register[taken], point[taken])
        slowest = (first.reshape(n, registers).max(axis=1) >> U(32)).astype(np.uint32)
        on = time.astype(np.float32).view(np.uint32) < slowest[text]
        state, time, text, most, length = state[on], time[on], text[on], most[on], length[on]
    return first.reshape(n, registers)


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(n, bands) hashes of the registers of each band."""
    out = np.zeros((len(signature), bands), U)
    with np.errstate(over="ignore"):
        out += np.arange(bands, dtype=U)
        for r in range(rows):
            out = mix(out * U(31) + signature[:, r : bands * rows : rows])
    return out


def _fingerprints(owner, value, count, n) -> np.ndarray:
    """(n, 2): two sums over the multiset; equal multisets have equal ones."""
    out = np.zeros((n, 2), U)
    with np.errstate(over="ignore"):
        x = mix(value + mix(count.astype(U)))
        np.add.at(out[:, 0], owner, x)
        np.add.at(out[:, 1], owner, mix(x ^ U(0xE7037ED1A0B428DB)))
    return out


def sign(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, node (null without words), size, bands."""
    given = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = given.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = [t or "" for t in whole.column(1).to_pylist()]
            for i, j in slices(texts):
                n = j - i
                owner, value, count = multisets(texts[i:j])
                prints = _fingerprints(owner, value, count, n)
                sizes = np.bincount(owner, count, n).astype(np.int64)
                bands = band_keys(signatures(owner, value, count, n)).view(np.int64)
                nodes = [p.tobytes() if s else None for p, s in zip(prints, sizes, strict=True)]
                yield pa.RecordBatch.from_arrays([whole.column(0).slice(i, n), pa.array(nodes, pa.binary()), pa.array(sizes), pa.array(list(bands), pa.list_(pa.int64()))], ["id", "node", "size", "bands"])

    return given.mapInArrow(tidy(run), f"id {kind}, node binary, size long, bands array<long>")


def shingle_table(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """node, data (hashes in order, then counts) of the wanted nodes; wanted: id, node."""
    given = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(wanted, "id").select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts, wanted_nodes = [t or "" for t in whole.column(1).to_pylist()], whole.column(0).to_pylist()
            for i, j in slices(texts):
                owner, value, count = multisets(texts[i:j])
                prints = _fingerprints(owner, value, count, j - i)
                ends = np.searchsorted(owner, np.arange(j - i + 1))
                nodes, data = [], []
                for k in range(j - i):
                    if prints[k].tobytes() == wanted_nodes[i + k]:  # else another text under the same identifier
                        a, b = ends[k], ends[k + 1]
                        nodes.append(wanted_nodes[i + k])
                        data.append(value[a:b].tobytes() + count[a:b].astype(U).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(data, pa.binary())], ["node", "data"])

    return given.mapInArrow(tidy(run), "node binary, data binary").dropDuplicates(["node"])


def overlap(a: bytes, b: bytes) -> tuple[int, int]:
    """Sizes of the intersection and the union of two multisets."""
    x, y = np.frombuffer(a, U), np.frombuffer(b, U)
    xv, xc, yv, yc = x[: len(x) // 2], x[len(x) // 2 :], y[: len(y) // 2], y[len(y) // 2 :]
    at = np.minimum(np.searchsorted(yv, xv), len(yv) - 1)
    both = int(np.minimum(xc, yc[at])[yv[at] == xv].sum())
    return both, int(xc.sum() + yc.sum()) - both


def verify(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """a, b, similarity of every pair of nodes."""
    left = shingles.select(F.col("node").alias("a"), F.col("data").alias("da"))
    right = shingles.select(F.col("node").alias("b"), F.col("data").alias("db"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "da", "db")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [overlap(x, y) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([i / u for i, u in found], pa.float64())], ["a", "b", "similarity"])

    return joined.mapInArrow(tidy(run), "a binary, b binary, similarity double")


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of its component, for every node of edges (a, b). Labels move along edges and then jump to their own label."""
    both = durable(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select("node", F.least("node", "label").alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        better = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jumped = better.join(better.select(F.col("node").alias("label"), F.col("label").alias("further")), "label", "left")
        new = durable(jumped.select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")))
        labels = new.select("node", "label")
        if new.where("old <> label").isEmpty():
            return labels


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """id, class_id (the smallest identifier of the group; the row's own if it is alone)."""
    signed = durable(sign(docs, id_col, text_col))
    nodes = signed.where("node IS NOT NULL AND id IS NOT NULL")
    heads = durable(nodes.groupBy("node").agg(F.min("id").alias("head"), F.first("size").alias("size"), F.first("bands").alias("bands")))
    entries = heads.select("node", "size", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    opened = durable(entries.join(shared, "bucket").select("bucket", "node", "size", "n"))
    head = heads.select("node", "head")
    found = head
    if not opened.isEmpty():
        labels = _labels(docs, head, opened, id_col, text_col, similarity)
        of = labels.join(head, "node").groupBy("label").agg(F.min("head").alias("class"))
        found = head.join(labels.join(of, "label").select("node", "class"), "node", "left").select("node", F.coalesce("class", "head").alias("head"))
    every = signed.select("id", "node").join(found, "node", "left")
    own = F.coalesce(F.col("head"), F.col("id"))
    return every.select(F.col("id").alias(id_col), own.alias("class_id"))


def _labels(docs, head, opened, id_col, text_col, similarity):
    """node, label of every node that has a link."""
    wanted = opened.select("node").distinct().join(head.select("node", F.col("head").alias("id")), "node")
    shingles = durable(shingle_table(docs, wanted, id_col, text_col))
    stars = _stars(opened, shingles, similarity)
    linked = F.col("similarity") >= similarity - 1e-12
    links = durable(stars.where(linked).select("a", "b").distinct())
    labels = components(links)
    groups = _groups(opened, stars, labels, similarity)
    more = durable(_compared(groups, shingles, similarity))
    return labels if more.isEmpty() else components(links.unionByName(more))


def _stars(opened: DataFrame, shingles: DataFrame, similarity: float) -> DataFrame:
    """bucket, a (its leader), b (a member), similarity (null if certainly under 2 * similarity - 1)."""
    weight = opened.groupBy("node").agg(F.sum("n").alias("w"))
    best = F.max(F.struct("w", "node", "size")).alias("m")  # the most central: it shares buckets with most nodes
    leaders = opened.join(weight, "node").groupBy("bucket").agg(best).select("bucket", F.col("m.node").alias("a"), F.col("m.size").alias("sa"))
    met = opened.select("bucket", F.col("node").alias("b"), F.col("size").alias("sb")).join(leaders, "bucket").where("a <> b")
    met = durable(met.select("bucket", "a", "b", "sa", "sb"))
    near = F.least("sa", "sb") >= (2 * similarity - 1) * F.greatest("sa", "sb")  # sizes alone bound the overlap
    scores = verify(met.where(near).select("a", "b").distinct(), shingles)
    return durable(met.select("bucket", "a", "b").join(scores, ["a", "b"], "left"))


def _groups(opened: DataFrame, stars: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    """group, node, label: the nodes of a bucket that may still have links its leader does not show.

    Members without a link to the leader, and those with one if any of the former came
    near it. Buckets of one component are left out, as are all but one of those with the
    same nodes. A large group is cut in blocks and every two blocks are a group.
    """
    rest = F.coalesce("similarity", F.lit(0.0))
    apart = rest < similarity - 1e-12
    near = F.max(apart & (rest >= 2 * similarity - 1 - 1e-9)).alias("near")
    buckets = stars.groupBy("bucket").agg(near, F.max(apart).alias("any")).where("any").select("bucket", "near")
    nodes = stars.join(buckets, "bucket").where(apart | F.col("near")).select("bucket", F.col("b").alias("node"))
    named = nodes.join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
    named = named.join(opened.select("bucket", "node", "size"), ["bucket", "node"])
    mark = F.xxhash64("node")
    kept = durable(named.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("size").alias("total"),
        F.bit_xor(mark).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
        F.min("label").alias("l"),
        F.max("label").alias("h"),
    ).where("n > 1 AND l <> h").groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket"), F.first("total").alias("total")))
    blocks = F.ceil(F.greatest(F.col("n") / GROUP_NODES, F.col("total") / GROUP_SHINGLES)).cast("int")
    cut = named.join(kept.select("bucket", blocks.alias("k")), "bucket").withColumn("i", F.pmod(mark, F.col("k")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda j: F.struct(F.least("i", j).alias("low"), F.greatest("i", j).alias("high")))
    # a block alone is compared in each of its pairs, so it needs no group of its own unless it is the only one
    dealt = cut.select("bucket", "node", "label", F.explode(F.filter(pairs, lambda p: (p["low"] < p["high"]) | (F.col("k") == 1))).alias("p"))
    return dealt.select(F.struct("bucket", "p.low", "p.high").alias("group"), "node", "label")


def forest(data: list[bytes], labels: list[bytes], similarity: float) -> list[tuple[int, int]]:
    """Links that join the components of some multisets: exact overlaps of all of them, by the elements that at least two have."""
    n = len(data)
    owners, elements = [], []
    sizes = np.zeros(n)
    for i, d in enumerate(data):
        x = np.frombuffer(d, U)
        value, count = x[: len(x) // 2], x[len(x) // 2 :].astype(np.int64)
        copy = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)  # a count is so many elements
        with np.errstate(over="ignore"):
            elements.append(mix(np.repeat(value, count) + copy.astype(U) * U(0xA0761D6478BD642F)))
        owners.append(np.full(len(copy), i))
        sizes[i] = len(copy)
    owner, element = np.concatenate(owners), np.concatenate(elements)
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], element[order]
    starts = np.flatnonzero(np.append(True, element[1:] != element[:-1]))
    held = np.diff(np.append(starts, len(element)))
    both = np.zeros(n * n)
    for d in range(2, RARE + 1):
        rows = owner[starts[held == d][:, None] + np.arange(d)]
        for p in range(d):
            for q in range(p + 1, d):
                both += np.bincount(rows[:, p] * n + rows[:, q], minlength=n * n) if len(rows) else 0
    both = both.reshape(n, n)
    often = np.flatnonzero(held > RARE)
    for at in range(0, len(often), 4096):
        some = often[at : at + 4096]
        column = np.repeat(np.arange(len(some)), held[some])
        row = owner[np.concatenate([np.arange(starts[k], starts[k] + held[k]) for k in some])]
        m = np.zeros((n, len(some)), np.float32)
        m[row, column] = 1
        both += np.triu(m @ m.T, 1)
    either = sizes[:, None] + sizes[None, :] - both
    root = {x: x for x in labels}

    def find(x: bytes) -> bytes:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for i, j in zip(*np.nonzero(both >= (similarity - 1e-12) * either), strict=True):
        a, b = find(labels[i]), find(labels[j])
        if a != b:
            root[a] = b
            links.append((int(i), int(j)))
    return links


def _compared(groups: DataFrame, shingles: DataFrame, similarity: float) -> DataFrame:
    """a, b: links that join components within the groups."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("node")
        nodes = t.column("node").to_pylist()
        links = forest(t.column("data").to_pylist(), t.column("label").to_pylist(), similarity)
        return pa.table([pa.array([nodes[i] for i, _ in links], pa.binary()), pa.array([nodes[j] for _, j in links], pa.binary())], ["a", "b"])

    return groups.join(shingles, "node").select("group", "node", "label", "data").groupBy("group").applyInArrow(run, "a binary, b binary")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One document of each group, with its own columns: the one with the smallest identifier.

    A document is an identifier and a text, so texts that share an identifier are told apart (the smaller
    hash goes first), and of rows equal in both one stays. Rows without an identifier all stay.
    """
    key = F.struct(docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("text"))
    rows = docs.select(key.alias("key"), docs[text_col].alias("text"), F.struct("*").alias("_row"))
    known = rows.where("key.id IS NOT NULL")
    classes = near_groups(known.select("key", "text"), "key", "text", similarity).where("key = class_id")
    heads = classes.groupBy(F.col("key").alias("head")).agg(F.count(F.lit(1)).alias("n"))
    kept = known.join(heads, F.col("key") == F.col("head")).select("key", "_row", "n")
    once = kept.where("n = 1").unionByName(kept.where("n > 1").dropDuplicates(["key"]))
    return once.select("_row").unionByName(rows.where("key.id IS NULL").select("_row")).select("_row.*")
