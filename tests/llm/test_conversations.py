"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import duckdb
import pytest

from patronage.llm import conversations as cv
from patronage.llm.queries import REGISTRY, SQL

ROWS = "conv_id long, turn long, role string, text string, conv string, hash int"
SHAPE = re.compile(r"(s?(ua)+)?")


def legal(done, whole):
    """Whether role initials can (whole: do) make up a repaired conversation."""
    return bool(SHAPE.fullmatch(done)) if whole else any(SHAPE.fullmatch(done + rest) for rest in ("", "a", "ua"))


def brute(rows):
    """Cheapest edits of (role, text, fault), first in the alphabet, by best-first search over edit strings."""
    queue, met = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, initials, lines = heapq.heappop(queue)
        if (at, initials[-2:]) in met:  # what may follow depends on no more
            continue
        met.add((at, initials[-2:]))
        if at == len(rows) and legal(initials, True):
            return cost, audit, list(lines)
        ways = [("I", 3, r, "", 0) for r in ("user", "assistant")]
        if at < len(rows):
            role, text, fault = rows[at]
            broken = 3 * (fault == "truncated")
            ways.append(("D", 4, None, None, 1))
            if fault not in ("blank", "duplicate"):
                ways.append(("K", broken, role, text, 1))
                ways += [("R", 3 + broken, r, text, 1) for r in ("user", "assistant")]
        for edit, extra, role, text, step in ways:
            now = initials if role is None else initials + role[:1]
            if legal(now, False):
                heapq.heappush(queue, (cost + extra, audit + edit, at + step, now, lines if role is None else (*lines, (role, text))))


def audited(table):
    """What the contract asks of a conversation's rows (turn, role, text) in order."""
    seen, rows, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in table:
        core = text.strip(cv.BLANKS)
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "" if core[-1] in ".!?" else "truncated"
        seen.add((role, text))
        rows.append((role, text, fault))
        if fault:
            counts[fault] += 1
    turns = [t for t, _, _ in table if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(table))
    cost, audit, lines = brute(rows)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return gaps, *counts.values(), illegal, cost, audit, digest


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def random_rows(seed, convs=60):
    r = random.Random(seed)
    roles = ["system", "user", "assistant", "assistant", "user", "tool", "", "User", None]
    texts = ["Yes.", "No!", "Why? ", "and then", "", " \n", "Wait.\t", None, "ö.", "a longer text that breaks off"]
    out = []
    for conv in range(convs):
        for turn in range(r.randrange(1, 8)):
            shown = None if r.random() < 0.05 else turn + (r.random() < 0.1)
            out += [(conv if conv else None, shown, r.choice(roles[: r.choice([3, 5, 9])]), r.choice(texts))] * r.choice([1, 1, 1, 2])
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS)


def found(spark, rows):
    given = frame(spark, rows)
    got = cv.audits(cv.damage(given), given.select("conv_id")).collect()
    assert len({r["conv"] for r in got}) == len(got)
    return {r["conv"]: tuple(r)[1:] for r in got}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_search_over_all_edits(spark, seed):
    rows = random_rows(seed)
    left = damaged(rows)
    want = {conv: audited(in_order([r[1:] for r in left if r[0] == conv])) for conv in {r[0] for r in rows}}
    assert found(spark, rows) == want


def test_nothing_and_nothing_left(spark):
    assert found(spark, []) == {}
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert found(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_the_path_is_the_first_of_the_cheapest():
    """Every short conversation of every kind of row, each as one lattice and in lattices of two rows."""
    kinds = [cv.code(i, f) for i in range(4) for f in (0, 1, 3)]
    r = random.Random(7)
    some = [c for n in (0, 1, 2, 3) for c in itertools.product(kinds, repeat=n)]
    for codes in ["".join(c) for c in r.sample(some, 400)]:
        rows = [({"s": "system", "u": "user", "a": "assistant", "o": "tool"}[i], "x", cv.FAULTS[f]) for i, f in map(cv.decoded, codes)]
        ends, chain = cv.END, []
        for at in range(len(codes) - len(codes) % 2, -1, -2):
            chain.append(cv.settled(codes[at : at + 2], ends))
            ends = tuple(cost for cost, _, _ in chain[-1])
        cost, audit, _ = brute(rows)
        (whole, q), step, parts = cv.traced(codes, cv.END)[0], 0, []
        for solved in reversed(chain):
            _, text, step = solved[step]
            parts.append(text)
        for text, last in ((whole, q), ("".join(parts), step)):
            assert (text.replace("|", "") + cv.TAIL[last]).translate(str.maketrans(cv.NOTED, cv.SHOWN)) == audit
        assert ends[0] == cost == min(a + b for a, b in zip(cv.crossing(codes)[:4], cv.END, strict=True))


def test_long_conversations_in_pieces(spark, monkeypatch):
    """Pieces of a few rows, dealt to many tasks, give what one piece gives."""
    r = random.Random(5)
    rows = [(1, t, r.choice(["user", "assistant"]), f"{t}." if r.random() < 0.7 else r.choice(["", f"{t}", "again."])) for t in range(3000)]
    rows += [(c, t, "user", f"{t}.") for c in range(2, 12) for t in range(4)]
    whole = found(spark, rows)
    monkeypatch.setattr(cv, "PIECE", 7)
    assert found(spark, rows) == whole
    lengths = [len(c["codes"]) for c in cv.pieces(cv.damage(frame(spark, rows))).collect()]
    assert max(lengths) <= 7 and sum(lengths) == len(damaged(rows))
    assert len(whole[1][6]) >= 2800


def test_a_row_repeated_very_often(spark):
    """Equal rows are one row until the last pass."""
    turn = next(i for i in range(1000) if zlib.crc32(f"1:{i}".encode()) % 20 > 4)
    n = 9000
    got = found(spark, [(1, turn, "user", "Hi.")] * n)[1]
    assert got[1:6] == (0, n - 1, 0, n - 1, 4 * (n - 1) + 3) and sorted(got[6]) == sorted("D" * (n - 1) + "KI")
    assert cv._codes(cv.damage(frame(spark, [(1, turn, "user", "Hi.")] * n))).count() == 1


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Well."), (1, 2, "assistant", "Yes."), (2, 0, "assistant", "No.")]
    got = [tuple(r) for r in cv.repair(frame(spark, rows).select("conv_id", "turn", "role", "text").withColumnRenamed("conv_id", "conv")).orderBy("conv", "place").collect()]
    for conv in (1, 2):
        roles = "".join(r[4][0] for r in got if r[0] == conv)
        assert SHAPE.fullmatch(roles) and [r[1] for r in got if r[0] == conv] == list(range(len(roles)))
    assert [r[2] for r in got if r[0] == 2] in (["I", "K"], [])


def test_query_equals_sql(spark, small):
    got = REGISTRY["op12_conversations"](spark, small)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{small}/conversations.parquet'")
    names = got.columns
    want = con.execute(f"SELECT {', '.join(names)} FROM ({SQL['op12_conversations']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_sql_equals_search(spark, tmp_path):
    """The SQL is held against the same search, nulls and ties included."""
    rows = random_rows(9, 25)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations(conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = {r[0]: r[1:] for r in con.execute(SQL["op12_conversations"]).fetchall()}
    left = damaged(rows)
    assert got == {conv: audited(in_order([r[1:] for r in left if r[0] == conv])) for conv in {r[0] for r in rows}}
