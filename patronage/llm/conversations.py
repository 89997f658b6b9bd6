"""Conversations brought back into shape by the cheapest edits, with an auction algorithm.

A repaired conversation's role initials are ``(s?(ua)+)?``: nothing, or user and assistant
in turns after at most one system row. A row is kept (0) or gets another role (3), which
adds 3 if its text breaks off, or is deleted (4), as blank and repeated rows must be; empty
rows can be put in anywhere (3 each). With the four states of that pattern, rows and
states form a lattice whose cheapest path from the first column to the last is the repair.

The auction algorithm finds it. Every node has a price, never more than its own cheapest
way to the end; a path grows from the origin along arcs that its last node's price pays
for exactly, the first letter first; where no arc does, that node's price rises to the
least that would and the path steps back. When it arrives, the arcs that prices pay for
exactly are those of cheapest paths, and the path is the first of these in the alphabet.
The prices of the four nodes of a lattice's left side are then exact, and are what the lattice to its left pays at its end.

Rows are dealt by ranges of conversation and order, so a conversation may lie in many
tasks. Each cuts what it holds into pieces of at most PIECE rows and sends, for a piece, the
costs from its four states of entry to its four of exit. One scan over the pieces of a
conversation, from the right, gives every piece what its exits cost; the pieces are then
traced apart, for each state of entry. A last pass in order picks the entries and takes
texts row by row, as a digest over a conversation is made in order; it holds one piece
and the audit, never the conversation.

Defined cases: a null role or text counts as one space; rows of a null conversation are one
conversation. Rows go by turn, nulls first, then by role and a hash of the text; rows equal
in all of these are repeats of each other. A role's initial is its first character; other
initials than s, u, a cannot be kept; an empty role has none and can be kept anywhere.
Very long conversations and texts need no special care. Columns other than the four do not
take part. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
#: Rows of a piece, and of the lattices within one that the auction works on.
PIECE, LATTICE = 4096, 16
DELETE, REROLE, INSERT, BROKEN = 4, 3, 3, 3
#: How states go on: before anything, after system, after user, after assistant.
GO = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: What it costs to end a conversation in a state, and the rows that are put in.
END, TAIL = (0, 2 * INSERT, INSERT, 0), ("", "UA", "A", "")
NEVER = 1 << 60
INITIALS, FAULTS = "suaoe", ("", "truncated", "blank", "duplicate")  # o: another one, e: an empty role
#: Edits as they are noted: rows put in (U, A), kept, deleted, given another role (u, a); and as they are shown.
NOTED, SHOWN = "UAKDua", "IIKDRR"
KEYS = ["conv", "turn", "role", "hash"]
PIECES = "turn long, role string, hash binary, place long, part long, codes string"
ROLES = {"U": "user", "A": "assistant", "u": "user", "a": "assistant"}


def code(initial: int, fault: int) -> str:
    return chr(ord("A") + len(FAULTS) * initial + fault)


def decoded(c: str) -> tuple[str, int]:
    initial, fault = divmod(ord(c) - ord("A"), len(FAULTS))
    return INITIALS[initial], fault


@functools.lru_cache(maxsize=None)
def arcs(c: str) -> tuple[tuple[tuple[str, int, int], ...], ...]:
    """For each state, the arcs out of the node before a row: edit, cost, distance to the node it leads to."""
    initial, fault = decoded(c)
    broken = BROKEN * (fault == 1)
    out = []
    for q, go in enumerate(GO):
        found = [("D", DELETE, 4)]
        found += [(r.upper(), INSERT, go[r] - q) for r in "ua" if r in go]
        if fault < 2:
            if initial == "e" or initial in go:
                found.append(("K", broken, 4 + (0 if initial == "e" else go[initial] - q)))
            found += [(r, REROLE + broken, 4 + go[r] - q) for r in "ua" if r in go]
        out.append(tuple(sorted(found, key=lambda a: SHOWN[NOTED.index(a[0])])))
    return tuple(out)


def reaches(codes: str, q: int, ends: tuple[int, ...]) -> bool:
    """Whether some end that can be paid is reached from state q before the rows of codes."""
    states = {q}
    for c in codes:
        now, after = list(states), set()
        while now:
            p = now.pop()
            for edit, _, step in arcs(c)[p]:
                to = (p + step) % 4
                if edit not in "UA":
                    after.add(to)
                elif to not in states:
                    states.add(to)
                    now.append(to)
        states = after
    return any(ends[s] < NEVER for s in states)


@functools.lru_cache(maxsize=1 << 16)
def auction(codes: str, ends: tuple[int, ...]) -> tuple[tuple[int, str, int], ...]:
    """For each state of entry: cost, edits (of the rows, joined by |) and state of exit, when the exits cost ``ends``."""
    n = len(codes)
    prices = [0] * (4 * n) + list(ends)
    out = []
    for origin in range(4):
        if not reaches(codes, origin, ends):
            out.append((NEVER, "", origin))
            continue
        path, edits = [origin], []
        while path[-1] < 4 * n:
            node = path[-1]
            least, pick, to = NEVER, "", -1
            for edit, cost, step in arcs(codes[node // 4])[node % 4]:
                if cost + prices[node + step] < least:
                    least, pick, to = cost + prices[node + step], edit, node + step
            if prices[node] < least:
                prices[node] = least
                if len(path) > 1:
                    path.pop()
                    edits.pop()
            else:
                path.append(to)
                edits.append(pick)
        parts, now = [], ""
        for a, b, edit in zip(path, path[1:], edits, strict=False):
            now += edit
            if b // 4 > a // 4:
                parts.append(now)
                now = ""
        out.append((prices[origin], "|".join(parts), path[-1] % 4))
    return tuple(out)


def settled(codes: str, ends: tuple[int, ...]) -> tuple[tuple[int, str, int], ...]:
    """The same, whatever the exits cost: what all of them cost at least does not matter to the edits."""
    low = min(ends)
    return tuple((cost + low if cost < NEVER else cost, edits, q) for cost, edits, q in auction(codes, tuple(x - low if x < NEVER else x for x in ends)))


def lattices(codes: str) -> list[str]:
    return [codes[i : i + LATTICE] for i in range(0, len(codes), LATTICE)]


@functools.lru_cache(maxsize=1 << 14)
def crossing(codes: str) -> tuple[int, ...]:
    """Costs from each state of entry (4 places each) to each of exit."""
    one = [tuple(0 if q == e else NEVER for q in range(4)) for e in range(4)]
    for part in reversed(lattices(codes)):
        one = [tuple(cost for cost, _, _ in settled(part, ends)) if min(ends) < NEVER else ends for ends in one]
    return tuple(one[e][q] for q in range(4) for e in range(4))


def traced(codes: str, ends: tuple[int, ...]) -> list[tuple[str, int]]:
    """Edits (of the rows, joined by |) and state of exit from each state of entry."""
    solved = []
    for part in reversed(lattices(codes)):
        solved.append(settled(part, ends))
        ends = tuple(cost for cost, _, _ in solved[-1])
    found = []
    for q in range(4):
        parts = []
        for answer in reversed(solved):
            _, edits, q = answer[q]
            parts.append(edits)
        found.append(("|".join(parts), q))
    return found


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, turn, role, text of what is left when a checksum of conversation and turn drops, empties, strips, repeats or recasts rows."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(rows[c].cast("string"), space) for c in (conv_col, turn_col)])
    given = rows.select(rows[conv_col].alias("conv"), rows[turn_col].cast("long").alias("turn"), F.coalesce(rows[role_col], space).alias("role"), F.coalesce(rows[text_col], space).alias("text"), (F.crc32(key) % 20).alias("kind"))
    kind = F.col("kind")
    done = given.where(kind != 0).select(
        "conv", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return done.drop("copy")


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("hash", F.unhex(F.sha2("text", 256)))


def _codes(rows: DataFrame) -> DataFrame:
    """conv, turn, role, hash, n: each kind of row of a turn once; code: of its first; again: of further ones."""
    core = F.btrim("text", F.lit(BLANKS))
    fault = F.when(core == "", 2).when(F.right(core, F.lit(1)).isin(*ENDS), 0).otherwise(1)
    once = _hashed(rows).withColumn("fault", fault).groupBy("conv", "turn", "role", "hash").agg(F.min("fault").alias("fault"), F.count(F.lit(1)).alias("n"))
    first = once.groupBy(F.col("conv").alias("_conv"), F.col("role").alias("_role"), F.col("hash").alias("_hash")).agg(F.max(F.isnull("turn")).alias("_null"), F.min("turn").alias("_low"))
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("hash") == F.col("_hash"))
    met = once.join(first, same)
    head = F.left("role", F.lit(1))
    initial = F.when(head == "", 4).when(head == "s", 0).when(head == "u", 1).when(head == "a", 2).otherwise(3)

    def char(f: Column) -> Column:
        return F.char(F.lit(ord("A")) + initial * len(FAULTS) + f)

    again = F.when(F.col("fault") == 2, 2).otherwise(3)
    new = F.when(F.col("_null"), F.isnull("turn")).otherwise(F.col("turn") == F.col("_low"))
    code = F.when(new, F.col("fault")).otherwise(again)
    return met.select(*KEYS, "n", char(code).alias("code"), char(again).alias("again"))


def _table(schema: str, conv: pa.DataType, rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows as batches; the first column is the conversation, whatever its type."""
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    fields = pa.schema([("conv", conv), *((n, types[t]) for n, t in (c.split() for c in schema.split(", ")))])
    some: list[tuple] = []
    for row in rows:
        some.append(row)
        if len(some) == 1024:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), fields, strict=True)], schema=fields)
            some = []
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), fields, strict=True)], schema=fields)


def _in_order(df: DataFrame, schema: str, run: Callable[[Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """What ``run`` makes of a partition's rows, taken in order and never held at once."""

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = next(given, None)
        if head is not None:
            rows = (r for b in itertools.chain([head], given) for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
            yield from _table(schema, head.schema.field("conv").type, run(rows))

    return df.mapInArrow(batches, f"conv {df.schema['conv'].dataType.simpleString()}, {schema}")


def pieces(rows: DataFrame) -> DataFrame:
    """conv, turn, role, hash of a piece's first row; place and part, the order of pieces; codes; costs (see crossing)."""
    ranged = _codes(rows).repartitionByRange(*KEYS).sortWithinPartitions(*KEYS).withColumn("place", F.monotonically_increasing_id())

    def cut(given: Iterator[tuple]) -> Iterator[tuple]:
        head: list = []
        codes: list[str] = []

        def done() -> tuple:
            text = "".join(codes)
            return (*head, text, crossing(text))

        for conv, turn, role, digest, n, first, again, place in given:
            if codes and (head[0] != conv or len(codes) == PIECE):
                yield done()
                codes = []
            if not codes:
                head = [conv, turn, role, digest, place, 0]
            codes.append(first)
            for _ in range(n - 1):
                if len(codes) == PIECE:
                    yield done()
                    codes, head = [], [conv, turn, role, digest, place, head[5] + 1 if head[4] == place else 1]
                codes.append(again)
        if codes:
            yield done()

    return _in_order(ranged, f"{PIECES}, costs array<long>", cut)


def edits(rows: DataFrame) -> DataFrame:
    """The pieces with their edits and state of exit for each state of entry; total is the cost from a piece's first row on."""

    def paid(given: Iterator[tuple]) -> Iterator[tuple]:
        conv, ends = None, None
        for row in given:
            if ends is None or row[0] != conv:
                conv, ends = row[0], END
            costs = row[-1]
            yield (*row[:-1], ends, left := [min(min(costs[4 * q + e] + ends[e] for e in range(4)), NEVER) for q in range(4)])
            ends = left

    def trace(given: Iterator[tuple]) -> Iterator[tuple]:
        for *row, ends, left in given:
            found = traced(row[-1], tuple(ends))
            yield (*row, left[0], [e for e, _ in found], [q for _, q in found])

    backwards = pieces(rows).repartition("conv").sortWithinPartitions("conv", F.desc("place"), F.desc("part"))
    known = _in_order(backwards, f"{PIECES}, ends array<long>, left array<long>", paid)
    return _in_order(known.repartition("place", "part"), f"{PIECES}, total long, edits array<string>, exits array<long>", trace)


def _walk(given: Iterator[tuple]) -> Iterator[tuple]:
    """Pieces and rows of a partition in order: (conv, edit, turn, role, text) of each edit, and (conv, None, figures) after each conversation."""
    conv, q, figures, waiting = None, 0, None, deque()

    def end() -> Iterator[tuple]:
        for edit in TAIL[q]:
            yield conv, "I", None, ROLES[edit], ""
        yield conv, None, figures

    for c, kind, turn, role, text, codes, total, found, exits in given:
        if figures is None or c != conv:
            if figures is not None:
                yield from end()
            conv, q, waiting = c, 0, deque()
            figures = {"low": None, "high": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": None, "last": None}
        if kind == 0:
            if figures["cost"] is None:
                figures["cost"] = total
            waiting.extend(found[q].split("|"))
            q = exits[q]
            for initial, fault in map(decoded, codes):
                if fault:
                    figures[FAULTS[fault]] += 1
                if figures["last"] is not None and figures["last"] + initial not in ("su", "ua", "au"):
                    figures["illegal"] += 1
                figures["last"] = initial
        elif kind == 1:
            if turn is not None and turn != figures["high"]:
                figures["low"] = turn if figures["low"] is None else figures["low"]
                figures["high"] = turn
                figures["turns"] += 1
            for edit in waiting.popleft():
                shown = SHOWN[NOTED.index(edit)]
                yield (conv, shown, None, ROLES[edit], "") if shown == "I" else (conv, shown, turn, ROLES.get(edit, role), text)
    if figures is not None:
        yield from end()


def _ordered(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Every conversation's pieces, each before the first of its rows, and rows, in order."""
    unused = [F.lit(None).cast(t).alias(n) for n, t in (("codes", "string"), ("total", "long"), ("edits", "array<string>"), ("exits", "array<long>"))]
    none = F.lit(None)
    both = edits(rows).select(*KEYS, F.lit(0).alias("kind"), "place", "part", none.cast("string").alias("text"), "codes", "total", "edits", "exits")
    both = both.unionByName(_hashed(rows).select(*KEYS, F.lit(1).alias("kind"), none.cast("long").alias("place"), none.cast("long").alias("part"), "text", *unused))
    if ids is not None:
        given = ids.select(ids[ids.columns[0]].alias("conv")).distinct()
        both = both.unionByName(given.select("conv", *[none.cast(t).alias(n) for n, t in (("turn", "long"), ("role", "string"), ("hash", "binary"))], F.lit(2).alias("kind"), none.cast("long").alias("place"), none.cast("long").alias("part"), none.cast("string").alias("text"), *unused))
    ordered = both.repartition("conv").sortWithinPartitions(*KEYS, "kind", "place", "part")
    return ordered.select("conv", "kind", "turn", "role", "text", "codes", "total", "edits", "exits")


def repair(rows: DataFrame) -> DataFrame:
    """conv, place, edit (K, R or I), turn, role, text: the rows of every conversation after repair. rows: conv, turn, role, text."""

    def run(given: Iterator[tuple]) -> Iterator[tuple]:
        place = 0
        for conv, edit, *rest in _walk(given):
            if edit is None:
                place = 0
            elif edit != "D":
                yield (conv, place, edit, *rest)
                place += 1

    return _in_order(_ordered(rows, None), "place long, edit string, turn long, role string, text string", run)


def audits(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: what is wrong with it, and its cheapest repair as letters and digest.

    rows: conv, turn, role, text. Conversations of ``ids`` that have no rows get one, too.
    """

    def run(given: Iterator[tuple]) -> Iterator[tuple]:
        shown, digest, begun = [], hashlib.sha256(), False
        for conv, edit, *rest in _walk(given):
            if edit is None:
                f = rest[0]
                gaps = f["high"] - f["low"] + 1 - f["turns"] if f["turns"] else 0
                yield conv, gaps, f["blank"], f["duplicate"], f["truncated"], f["illegal"], f["cost"] or 0, "".join(shown), digest.hexdigest()
                shown, digest, begun = [], hashlib.sha256(), False
                continue
            shown.append(edit)
            if edit != "D":
                digest.update(f"{chr(10) if begun else ''}{rest[1]}:{rest[2]}".encode("utf-8", "surrogatepass"))
                begun = True

    schema = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return _in_order(_ordered(rows, ids), schema, run)
