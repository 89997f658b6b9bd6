"""Frequent itemsets, association rules and frequent sequences.

Input throughout: long-form baskets, one row per (basket keys, item).
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from ..session import durable

ORDER_KEYS = ("idsite", "user", "idorder")
#: Rules that are expanded in one scan of the baskets.
EXPANDED = 4096
#: What the support of items is divided by to get the floor, and the floor to get the next: a search stays near the
#: best whatever its floor, which only says what items it looks at.
FLOOR = 64
#: Words of 64 baskets that a task holds at a time when it counts the extensions of patterns.
WORDS = 1 << 21
#: Occurrences of a history beyond which it is not one row, and different items beyond which its pairs are not listed but asked for.
LONG = 1024


def frequent_itemsets(
    lines: DataFrame, min_support: float, keys: Sequence[str] = ORDER_KEYS, partitions: int | None = None
) -> DataFrame:
    """Itemsets in at least ``min_support`` of all baskets, with their basket counts.

    Items too rare for any itemset are removed first, so a basket row holds at
    most (mean basket size / min_support) items whatever the basket's length.
    """
    unique = durable(lines.select(*keys, "item").distinct())
    baskets = unique.select(*keys).distinct().count()
    needed = max(1, math.ceil(min_support * baskets - 1e-9))
    return _itemsets(unique, needed, keys, partitions)


def _itemsets(unique: DataFrame, needed: int, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Itemsets in at least ``needed`` baskets; ``unique`` has each basket's items once."""
    common = (
        unique.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= needed)
    )
    kept = durable(
        unique.join(common.select("item"), "item", "left_semi")
        .groupBy(*keys)
        .agg(F.collect_list("item").alias("items"))
        .select("items")
    )
    rows = kept.count()
    # the smallest share that Spark rounds up to exactly ``needed`` baskets
    share = min(1.0, (needed - 0.5) / max(rows, 1))
    growth = FPGrowth(itemsCol="items", minSupport=share)
    if partitions is not None:
        growth.setNumPartitions(partitions)
    found = growth.fit(kept).freqItemsets
    return durable(
        found.select(F.array_sort("items").alias("items"), F.col("freq").alias("support"))
    )


def rules_of(itemsets: DataFrame, min_confidence: float) -> DataFrame:
    """Rules with one consequent item, from itemsets closed under subsets."""
    split = itemsets.where(F.size("items") > 1).select(
        "support", "items", F.explode("items").alias("consequent")
    )
    split = split.select(
        "support",
        "consequent",
        F.filter("items", lambda i: i != F.col("consequent")).alias("antecedent"),
    )
    base = itemsets.select(F.col("items").alias("antecedent"), F.col("support").alias("base"))
    return (
        split.join(base, "antecedent")
        .select(
            "antecedent", "consequent", "support", (F.col("support") / F.col("base")).alias("confidence")
        )
        .where(F.col("confidence") >= min_confidence)
    )


def association_rules(
    lines: DataFrame,
    min_support: float,
    min_confidence: float,
    keys: Sequence[str] = ORDER_KEYS,
) -> DataFrame:
    return rules_of(frequent_itemsets(lines, min_support, keys), min_confidence)


def top_k_rules(
    lines: DataFrame,
    k: int = 10,
    min_confidence: float = 0.8,
    keys: Sequence[str] = ORDER_KEYS,
    batch: int = EXPANDED,
    min_support: float = 0.0,
) -> DataFrame:
    """The ``k`` rules with most support among the confident ones, whatever that support is.

    Rules grow from single consequents by one item of the antecedent at a time, those with
    most support first (see ``_best_rules``). Items below a floor stay out at first; it
    is lowered until ``k`` rules are found above it or one basket is enough. With ``min_support``,
    a share of all baskets, rules below it do not count, so there may be fewer than ``k``. Equal
    support goes by confidence, then by antecedent and consequent.
    """
    unique = durable(lines.select(*keys, "item").distinct())
    needed = max(1, math.ceil(min_support * unique.select(*keys).distinct().count() - 1e-9)) if min_support else 1
    counts = durable(unique.groupBy("item").agg(F.count(F.lit(1)).alias("support")))
    # a rule needs two items, so the second most frequent one bounds its support
    top = min((r["support"] for r in counts.orderBy(F.desc("support")).limit(2).collect()), default=1)
    floor = max(needed, -(-top // FLOOR))
    while True:
        common = counts.where(F.col("support") >= floor)
        kept = unique.join(common.select("item"), "item", "left_semi").groupBy(*keys).agg(F.collect_list("item").alias("items"))
        best = _best_rules(durable(kept.select("items")), common, floor, k, min_confidence, batch)
        if floor == needed or len(best) == k:
            item = lines.schema["item"].dataType.simpleString()
            return lines.sparkSession.createDataFrame(best, f"antecedent array<{item}>, consequent {item}, support long, confidence double")
        floor = max(needed, floor // FLOOR)


def _best_rules(
    baskets: DataFrame, common: DataFrame, floor: int, k: int, min_confidence: float, batch: int
) -> list[tuple]:
    """Best-first search: the best ``k`` rules with a support of at least ``floor``.

    A rule X -> c grows into X + y -> c with y above all of X, so every rule has one
    way to it, and support only falls on the way. Of the rules met, ``batch`` with
    most support are expanded at a time, in one scan of the baskets that counts both X + y
    and X + y + c. Once ``k`` are confident, the last one's support is the bound
    below which nothing is expanded; at the bound itself, if that one's confidence is 1,
    only what can still come before it in order. What is met stays in tables; a
    table's rows up to its cut are expanded, so nothing is written again.
    """
    names = ["support", "antecedent", "consequent"]
    item = common.schema["item"].dataType.simpleString()
    roots = common.select("support", F.array().cast(f"array<{item}>").alias("antecedent"), F.col("item").alias("consequent"))
    tables: list[tuple[DataFrame, tuple | None]] = [(roots, None)]
    best: list[tuple] = []
    bound = floor

    def place(row) -> tuple:
        return (-row["support"], list(row["antecedent"]), row["consequent"])

    def beyond(cut: tuple) -> Column:
        support, x, c = -cut[0], F.array(*map(F.lit, cut[1])).cast(f"array<{item}>"), F.lit(cut[2])
        after = (F.col("antecedent") > x) | ((F.col("antecedent") == x) & (F.col("consequent") > c))
        return (F.col("support") < support) | ((F.col("support") == support) & after)

    while True:
        open_rules = functools.reduce(
            DataFrame.unionByName, [t.select(*names) if cut is None else t.select(*names).where(beyond(cut)) for t, cut in tables]
        ).where(F.col("support") >= bound)
        if len(best) == k and best[-1][3] == 1.0:
            last = F.array(*map(F.lit, best[-1][0])).cast(f"array<{item}>")
            open_rules = open_rules.where((F.col("support") > bound) | (F.col("antecedent") < last))
        chosen = open_rules.orderBy(F.desc("support"), "antecedent", "consequent").limit(batch).collect()
        if not chosen:
            return best
        cut = place(chosen[-1])
        tables = [(t, cut if c is None else max(c, cut)) for t, c in tables]
        grown = durable(_expanded(baskets, chosen, item, bound))
        tables.append((grown, None))
        met = grown.where(F.col("confidence") >= min_confidence).orderBy(F.desc("support"), F.desc("confidence"), "antecedent", "consequent").limit(k).collect()
        best += [(list(r["antecedent"]), r["consequent"], r["support"], r["confidence"]) for r in met]
        best = sorted(best, key=lambda r: (-r[2], -r[3], r[0], r[1]))[:k]
        if len(best) == k:
            bound = max(bound, best[-1][2])


def _expanded(baskets: DataFrame, rules: list, item: str, bound: int) -> DataFrame:
    """antecedent, consequent, support, confidence of the rules with one more item, in at least ``bound`` baskets.

    A task keeps, for each batch of baskets, the list of baskets of every item; lists
    are intersected along antecedents that share their beginning, and what the
    baskets left hold is counted at once for every item.
    """
    asked = [(tuple(r["antecedent"]), r["consequent"]) for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(0)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            words = lists.flatten()
            items = pc.unique(words).sort()
            codes = pc.index_in(words, items).to_numpy(zero_copy_only=False)
            place = {x: i for i, x in enumerate(items.to_pylist())}
            starts = np.cumsum(lengths) - lengths
            owner = np.repeat(np.arange(len(lengths)), lengths)
            by_item = np.argsort(codes, kind="stable")
            edges = np.searchsorted(codes[by_item], np.arange(len(items) + 1))
            everywhere = np.ones(len(lengths), bool)

            @functools.cache
            def holders(x: tuple) -> np.ndarray:
                if not x:
                    return everywhere
                mine = np.zeros(len(lengths), bool)
                if x[-1] in place:
                    at = place[x[-1]]
                    mine[owner[by_item[edges[at] : edges[at + 1]]]] = True
                return holders(x[:-1]) & mine

            def held(rows: np.ndarray) -> np.ndarray:
                """How many of these baskets hold each item."""
                n = lengths[rows]
                at = np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                return np.bincount(codes[at], minlength=len(items))

            with_x: dict[tuple, np.ndarray] = {}
            found = []
            for i, (x, c) in enumerate(asked):
                if x not in with_x:
                    with_x[x] = held(np.flatnonzero(holders(x)))
                n_x = with_x[x]
                first = place.get(x[-1], len(items)) + 1 if x else 0
                some = first + np.flatnonzero(n_x[first:])
                if c in place:
                    some = some[some != place[c]]
                if not len(some):
                    continue
                n_xc = held(np.flatnonzero(holders(x) & holders((c,))))[some]
                found.append((np.full(len(some), i), some, n_x[some], n_xc))
            if found:
                rule, some, n_x, n_xc = map(np.concatenate, zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(rule), items.take(pa.array(some)), pa.array(n_x), pa.array(n_xc)], ["rule", "item", "base", "support"])

    counted = baskets.mapInArrow(run, f"rule long, item {item}, base long, support long").groupBy("rule", "item").agg(F.sum("base").alias("base"), F.sum("support").alias("support"))
    about = baskets.sparkSession.createDataFrame(
        [(i, list(x), c) for i, (x, c) in enumerate(asked)], f"rule long, antecedent array<{item}>, consequent {item}"
    )
    return (
        counted.where(F.col("support") >= bound)
        .join(F.broadcast(about), "rule")  # as many rows as were chosen
        .select(F.array_append("antecedent", F.col("item")).alias("antecedent"), "consequent", "support", (F.col("support") / F.col("base")).alias("confidence"))
    )


def also_bought(
    rules: DataFrame, lines: DataFrame, keys: Sequence[str] = ORDER_KEYS
) -> DataFrame:
    """For each basket, items it lacks that some rule's antecedent calls for.

    A rule applies when the basket holds its whole antecedent; an item keeps the
    confidence of its best rule. A basket row carries only items that occur in some
    rule, so its length is bounded by the rules, and it meets a rule once, through
    the item of the antecedent that the fewest baskets hold.
    """
    rules = durable(rules.select("antecedent", "consequent", "confidence"))
    words = rules.select(
        F.explode(F.array_append("antecedent", F.col("consequent"))).alias("item")
    ).distinct()
    kept = lines.select(*keys, "item").join(words, "item", "left_semi")
    held = kept.groupBy(*keys).agg(F.collect_set("item").alias("held"))
    counts = kept.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    asked = rules.select("*", F.explode("antecedent").alias("item")).join(counts, "item")
    rarest = F.min(F.struct("n", "item"))["item"].alias("item")
    starts = asked.groupBy("antecedent", "consequent", "confidence").agg(rarest)
    applies = (F.size(F.array_except("antecedent", "held")) == 0) & ~F.array_contains(
        "held", F.col("consequent")
    )
    return (
        held.withColumn("item", F.explode("held"))
        .join(starts, "item")
        .where(applies)
        .groupBy(*keys, F.col("consequent").alias("item"))
        .agg(F.max("confidence").alias("confidence"))
    )


def sequence_patterns(
    occurrences: DataFrame,
    min_support: float,
    max_length: int | None = None,
    keys: Sequence[str] = ("idsite", "user"),
    long: int = LONG,
) -> DataFrame:
    """Frequent patterns (lists of itemsets) in customers' ordered baskets.

    ``occurrences`` has one row per customer, ``pos`` and ``item``. A pattern of n
    items grows by one item, in a later basket or in its last one, until no pattern
    is frequent or has ``max_length`` items. A pattern only grows by what a frequent
    pair allows: the last item before the new one, in the same way, must be frequent.

    Nothing is stored per customer and pattern: a history of up to ``long`` occurrences is a row of bits per
    item, and every level counts the extensions of its patterns in scans of these (see ``_extended``). Longer
    ones are not put in one row; they grow by joins (see ``_grown``), and both counts are added up.
    """
    keys = list(keys)
    occ = durable(occurrences.select(*keys, "pos", "item"))
    customers = occ.select(*keys).distinct().count()
    needed = max(1, math.ceil(min_support * customers - 1e-9))
    spans = durable(occ.groupBy(*keys, "item").agg(F.min("pos").alias("first"), F.max("pos").alias("latest")))
    items = durable(spans.groupBy("item").agg(F.count(F.lit(1)).alias("support")).where(F.col("support") >= needed))
    single = F.array(F.array("item"))
    found = items.select(single.alias("pattern"), "support")
    result = found
    occ = durable(occ.join(items.select("item"), "item", "left_semi").dropna(subset=[*keys, "pos"]))
    spans = durable(spans.join(items.select("item"), "item", "left_semi"))
    later, along = (durable(p) for p in _frequent_pairs(occ, spans, needed, keys, long))
    allowed = [{r["last"]: r["items"] for r in p.groupBy("last").agg(F.array_sort(F.collect_list("item")).alias("items")).collect()} for p in (later, along)]
    sizes = durable(occ.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    many = sizes.where(F.col("n") > long).select(*keys)
    apart = not many.isEmpty()
    short = occ.join(many, keys, "left_anti") if apart else occ
    rows = F.array_sort(F.collect_list(F.struct("pos", "item"))).alias("h")
    histories = durable(short.groupBy(*keys).agg(rows).select(F.col("h.pos").alias("pos"), F.col("h.item").alias("item")))
    ends = None
    if apart:
        occ, spans = (durable(x.join(many, keys, "left_semi")) for x in (occ, spans))
        ends = occ.select(*keys, "pos", single.alias("pattern"), F.col("item").alias("last"))
    length = 2
    while max_length is None or length <= max_length:
        batches = max(1, -(-found.count() // EXPANDED))
        batch_of = F.pmod(F.xxhash64("pattern"), F.lit(batches))
        counted = []
        for i in range(batches):
            asked = [r["pattern"] for r in found.where(batch_of == i).select("pattern").collect()]
            if asked:
                some = _extended(histories, asked, allowed, 1 if apart else needed)
                counted.append(durable(some) if batches > 1 else some)
        once = functools.reduce(DataFrame.unionByName, counted)
        if apart:
            longer, wider = _grown(ends, occ, spans, later, along, keys)
            # a customer has a pattern once in longer, in wider at several places
            met = longer.select("pattern", *keys).unionByName(wider.select("pattern", *keys).distinct())
            once = once.unionByName(met.groupBy("pattern").agg(F.count(F.lit(1)).alias("support"))).groupBy("pattern").agg(F.sum("support").alias("support"))
        found = durable(once.where(F.col("support") >= needed))
        if found.isEmpty():
            break
        result = result.unionByName(found)
        if apart:
            kept = found.select("pattern")
            places = longer.join(kept, "pattern", "left_semi").join(occ, [*keys, "item"]).where(F.col("pos") > F.col("_end"))
            columns = [*keys, "pos", "pattern", F.col("item").alias("last")]
            ends = durable(places.select(*columns).unionByName(wider.join(kept, "pattern", "left_semi").select(*columns)))
        length += 1
    return result


def _grown(ends: DataFrame, occ: DataFrame, spans: DataFrame, later: DataFrame, along: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Patterns that long histories hold with one item more, in a later basket and in the last one."""
    # a customer's first end of a pattern leaves most room for what comes later
    first_end = ends.groupBy(*keys, "pattern", "last").agg(F.min("pos").alias("_end")).join(later, "last")
    longer = (
        first_end.join(spans.drop("first"), [*keys, "item"])
        .where(F.col("latest") > F.col("_end"))
        .select(*keys, "item", "_end", _longer(F.col("pattern"), F.col("item")).alias("pattern"))
    )
    wider = ends.join(along, "last").join(occ, [*keys, "pos", "item"]).select(
        *keys, "pos", _wider(F.col("pattern"), F.col("item")).alias("pattern"), "item"
    )
    return longer, wider


def _longer(pattern: Column, item: Column) -> Column:
    return F.concat(pattern, F.array(F.array(item)))


def _wider(pattern: Column, item: Column) -> Column:
    return F.concat(F.slice(pattern, F.lit(1), F.size(pattern) - 1), F.array(F.concat(F.element_at(pattern, -1), F.array(item))))


def _extended(histories: DataFrame, patterns: list, allowed: list[dict], least: int) -> DataFrame:
    """pattern, support: the patterns with one more item, in at least ``least`` histories.

    A task keeps, for some histories at a time, a bit for every basket that holds an item, in words of 64.
    The bits where a pattern ends follow from those of the pattern before its last item, and only
    histories that hold it go on; patterns are taken in order, so only one path of them is kept.
    """
    item = histories.schema["item"].dataType.elementType.simpleString()
    paths = sorted((tuple((int(j > 0), x) for e in p for j, x in enumerate(e)), i) for i, p in enumerate(patterns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = b.column(0).value_lengths().to_numpy(zero_copy_only=False)
            pos = b.column(0).flatten().to_numpy()
            words = b.column(1).flatten()
            items = pc.unique(words)
            codes = pc.index_in(words, items).to_numpy(zero_copy_only=False)
            place = {x: i for i, x in enumerate(items.to_pylist())}
            owner = np.repeat(np.arange(len(lengths)), lengths)
            # baskets of a history, from 0; its occurrences come by position
            fresh = np.ones(len(pos), bool)
            fresh[1:] = (owner[1:] != owner[:-1]) | (pos[1:] != pos[:-1])
            basket = np.cumsum(fresh) - 1
            first = np.zeros(len(lengths), np.int64)
            first[owner[::-1]] = basket[::-1]
            basket -= first[owner]
            wide = np.zeros(len(lengths), np.int64)
            np.maximum.at(wide, owner, basket // 64 + 1)
            sums: dict[tuple, int] = {}
            order = np.argsort(wide, kind="stable")
            at = 0
            while at < len(order):
                size = WORDS // max(1, len(items))
                taken = order[at : at + max(1, size // int(wide[order[at]]))]
                # histories of like length go together
                taken = taken[wide[taken] <= 2 * wide[taken[0]]]
                at += len(taken)
                row = np.full(len(lengths), -1)
                row[taken] = np.arange(len(taken))
                mine = row[owner] >= 0
                bits = np.zeros((len(items), len(taken), int(wide[taken].max())), np.uint64)
                np.bitwise_or.at(bits, (codes[mine], row[owner[mine]], basket[mine] // 64), np.uint64(1) << (basket[mine] % 64).astype(np.uint64))
                count(bits, place, sums)
            if sums:
                rule, kind, code = (np.array(x) for x in zip(*sums, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rule), pa.array(kind), items.take(pa.array(code)), pa.array(list(sums.values()), pa.int64())], ["rule", "kind", "item", "n"]
                )

    def after(x: np.ndarray) -> np.ndarray:
        """All bits beyond the first of each row."""
        beyond = ~(x ^ (x - np.uint64(1)))
        if x.shape[1] > 1:
            passed = np.logical_or.accumulate(x != 0, axis=1)
            beyond[:, 1:][passed[:, :-1]] = ~np.uint64(0)
        return beyond

    def count(bits: np.ndarray, place: dict, sums: dict[tuple, int]) -> None:
        codes = [{last: np.array([place[x] for x in more if x in place], np.int64) for last, more in pairs.items() if last in place} for pairs in allowed]
        none = np.zeros(0, np.int64)
        path: list[tuple] = []  # steps of the pattern at hand: step, rows that hold it, where it ends there
        for steps, rule in paths:
            shared = 0
            while shared < min(len(path), len(steps)) and path[shared][0] == steps[shared]:
                shared += 1
            del path[shared:]
            for step in steps[shared:]:
                kind, x = step
                if x not in place:
                    rows, ends = none, bits[0, :0]
                elif not path:
                    rows, ends = np.arange(bits.shape[1]), bits[place[x]]
                else:
                    rows, ends = path[-1][1:]
                    ends = (ends if kind else after(ends)) & bits[place[x]][rows]
                held = ends.any(axis=1)
                path.append((step, rows[held], ends[held]))
            _, rows, ends = path[-1]
            if not len(rows):
                continue
            for kind, from_here in ((0, after(ends)), (1, ends)):
                more = codes[kind].get(steps[-1][1], none)
                step = max(1, WORDS // from_here.size)
                for some in (more[i : i + step] for i in range(0, len(more), step)):
                    n = (bits[some[:, None], rows] & from_here).any(axis=2).sum(axis=1)
                    for code, held in zip(some[n > 0].tolist(), n[n > 0].tolist(), strict=True):
                        sums[rule, kind, code] = sums.get((rule, kind, code), 0) + held

    counted = histories.mapInArrow(run, f"rule long, kind long, item {item}, n long").groupBy("rule", "kind", "item").agg(F.sum("n").alias("support"))
    about = histories.sparkSession.createDataFrame([(i, p) for i, p in enumerate(patterns)], f"rule long, pattern array<array<{item}>>")
    grown = F.when(F.col("kind") == 0, _longer(F.col("pattern"), F.col("item"))).otherwise(_wider(F.col("pattern"), F.col("item")))
    return counted.where(F.col("support") >= least).join(F.broadcast(about), "rule").select(grown.alias("pattern"), "support")


def _frequent_pairs(
    occ: DataFrame, spans: DataFrame, needed: int, keys: list[str], long: int
) -> tuple[DataFrame, DataFrame]:
    """(last, item) of the frequent pairs, an item in a later basket and a larger one in the same basket.

    Fewer than ``needed`` customers have long histories (more than ``long`` items, which
    is raised until that holds), so a frequent pair is also found among the others, and
    as often as what the long ones cannot make up for. All pairs are listed for the
    others alone; a long history is asked for those candidates only.
    """
    sizes = durable(spans.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    while (n_long := sizes.where(F.col("n") > long).count()) >= needed:
        long *= 2
    who = sizes.where(F.col("n") > long).select(*keys)
    left, right = F.col("item").alias("last"), F.col("item")

    def later(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
        return a.join(b.drop("first"), on).where(F.col("latest") > F.col("first")).select("last", right)

    def along(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
        return a.join(b, on).where(right > F.col("last")).select(*keys, "last", right).distinct().select("last", right)

    def counted(pairs: DataFrame, least: int) -> DataFrame:
        return pairs.groupBy("last", "item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)

    out = []
    for table, pairs, on, columns in ((spans, later, keys, [*keys, "first"]), (occ, along, [*keys, "pos"], [*keys, "pos"])):
        if not n_long:
            out.append(counted(pairs(table.select(*columns, left), table, on), needed).select("last", "item"))
            continue
        some = table.join(who, keys, "left_anti")
        candidates = durable(counted(pairs(some.select(*columns, left), some, on), max(1, needed - n_long)))
        rest = table.join(who, keys, "left_semi")
        asked = rest.select(*columns, left).join(candidates.select("last", "item"), "last")
        more = counted(pairs(asked, rest, [*on, "item"]), 1)
        both = candidates.unionByName(more).groupBy("last", "item").agg(F.sum("n").alias("n"))
        out.append(both.where(F.col("n") >= needed).select("last", "item"))
    return out[0], out[1]
