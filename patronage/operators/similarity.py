"""Similarity of customers by what they bought, order by order.

The similarity of two customers is the sum, over order positions, of the Jaccard
overlap of their baskets there, divided by the longer history's length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import customer_key
from ..functions.ordering import known, positions
from ..session import durable
from .transactions import slot_of

KEYS = ["idsite", "user"]
# Pairs of histories on a shared item that are listed for each row of the table before any bound pays.
FEW = 32


def sequence_lines(lines: DataFrame) -> DataFrame:
    """Basket lines with the position of their order in the customer's history.

    One row per customer, position and item; the operators below rely on that.
    """
    order = [*KEYS, "idorder"]
    bought = known(lines, [*order, "timestamp"]).groupBy(*order, "item").agg(F.min("timestamp").alias("timestamp"))
    orders = bought.groupBy(*order).agg(F.min("timestamp").alias("timestamp"))
    placed = positions(orders, KEYS, ["timestamp", "idorder"], slot_of("timestamp"))
    # the time stays in, so that both readers of ``bought`` want the same columns
    return bought.join(placed.select(*order, "pos"), order).select(*KEYS, "pos", "item", "timestamp")


def _rows(sequences: DataFrame) -> DataFrame:
    return sequences.select(
        customer_key(F.col("idsite"), F.col("user")).alias("cid"), "pos", "item"
    )


def _profile(rows: DataFrame) -> DataFrame:
    """(cid, pos, item) with basket size ``n`` and history length ``len``."""
    sizes = rows.groupBy("cid", "pos").agg(F.count(F.lit(1)).alias("n"))
    lengths = rows.groupBy("cid").agg((F.max("pos") + 1).alias("len"))
    return rows.join(sizes, ["cid", "pos"]).join(lengths, "cid")


_MARKS = ["f1", "f2", "f3", "f4"]


def _prints(rows: DataFrame) -> DataFrame:
    """Per customer, marks that tell histories apart, and the history's length.

    The marks are three independent 64-bit sums over the rows and their number, so
    no history is gathered in one place.
    """
    return rows.groupBy("cid").agg(
        F.bit_xor(F.xxhash64("pos", "item")).alias("f1"),
        F.bit_xor(F.xxhash64(F.lit(1), "pos", "item")).alias("f2"),
        F.bit_xor(F.xxhash64(F.lit(2), "item", "pos")).alias("f3"),
        F.count(F.lit(1)).alias("f4"),
        (F.max("pos") + 1).alias("len"),
    )


def sequence_groups(sequences: DataFrame) -> DataFrame:
    """Customers with exactly the same history, each with one representative."""
    return _groups(_prints(_rows(sequences)))


def _groups(prints: DataFrame) -> DataFrame:
    heads = prints.groupBy(*_MARKS).agg(
        F.min("cid").alias("head"), F.count(F.lit(1)).alias("copies")
    )
    return prints.join(heads, _MARKS).select("cid", "head", "copies")


def _scored(pairs: DataFrame) -> DataFrame:
    """Similarity from (a, b, len_a, len_b, pos, n_a, n_b) rows, one per shared item.

    Rows are placed by pair once, which serves both counts.
    """
    overlap = pairs.repartition("a", "b").groupBy("a", "b", "len_a", "len_b", "pos", "n_a", "n_b").agg(
        F.count(F.lit(1)).alias("o")
    )
    jaccard = F.col("o") / (F.col("n_a") + F.col("n_b") - F.col("o"))
    return (
        overlap.groupBy("a", "b", "len_a", "len_b")
        .agg(F.sum(jaccard).alias("s"))
        .select("a", "b", (F.col("s") / F.greatest("len_a", "len_b")).alias("similarity"))
    )


def _side(rows: DataFrame, tag: str, *names: str) -> DataFrame:
    return rows.select(
        F.col("cid").alias(tag),
        "pos",
        "item",
        F.col("n").alias(f"n_{tag}"),
        F.col("len").alias(f"len_{tag}"),
        *names,
    )


def _distinct(prints: DataFrame) -> DataFrame:
    """The smallest customer, length and size of each distinct history, and a number for it."""
    same = [F.min("cid").alias("cid"), F.first("len").alias("len")]
    return durable(prints.groupBy(*_MARKS).agg(*same).select("cid", "len", "f4", F.monotonically_increasing_id().alias("id")))


def _promising(sequences: DataFrame, chunk_rows: int) -> DataFrame:
    every = durable(_rows(sequences))
    return _bounded(every, _distinct(_prints(every)), chunk_rows)


def _bounded(every: DataFrame, heads: DataFrame, chunk_rows: int) -> DataFrame:
    """Rows of distinct histories, with what each history can still share from there on.

    Take two histories with similarity t and the rarest item they share. All they
    share comes at or after it in the common order by rarity, so from there on each
    must still be able to reach t times its length. With k items of the same basket
    and k_q of basket q at or after it, and a partner basket of size s, at most

        min(k, s) / (n + s - min(k, s)) + sum over other q of k_q / n_q

    can be reached (``k`` and, for the sum, ``after``). Rows that fall short cannot be
    that item; very common items of a history fall out first. A very long history is bounded in
    chunks, where the other chunks count in full: it keeps more rows than needed,
    never fewer.
    """
    heads = heads.select("cid", "len", F.ceil(F.col("f4") / F.lit(chunk_rows)).alias("chunks"))
    spread = every.groupBy("pos", "item").agg(F.count(F.lit(1)).alias("f"))
    chunk = Window.partitionBy("cid", "_chunk")
    basket = Window.partitionBy("cid", "_chunk", "pos")
    rarity = [F.desc("f"), F.desc("pos"), F.desc("item")]  # from the end of the order back
    here = F.sum(F.lit(1.0) / F.col("n"))
    rows = (
        every.join(spread, ["pos", "item"])
        .join(heads, "cid")
        .join(every.groupBy("cid", "pos").agg(F.count(F.lit(1)).alias("n")), ["cid", "pos"])
        .withColumn("_chunk", F.pmod(F.xxhash64("pos", "item"), F.col("chunks")))
        .withColumn("_k", F.row_number().over(basket.orderBy(*rarity)))
        .withColumn("_after", here.over(chunk.orderBy(*rarity)))
        .withColumn("_outside", F.col("len") - here.over(chunk))
        .withColumn("k", F.col("_k") + F.col("n") - F.count(F.lit(1)).over(basket))
        .withColumn("after", F.col("_after") - F.col("_k") / F.col("n") + F.col("_outside"))
    )
    return durable(rows.select("cid", "pos", "item", "n", "len", "k", "after"))


def customer_similarity(
    sequences: DataFrame, min_similarity: float = 0.5, chunk_rows: int = 100_000
) -> DataFrame:
    """All pairs of customers with at least the given similarity, equal histories included.

    Pairs of histories are found once and then named for every customer who has them,
    so the answer is as large as the question makes it. ``similar_histories`` with
    ``sequence_groups`` says the same in fewer rows where many histories are equal.
    """
    every = durable(_rows(sequences))
    prints = durable(_prints(every))
    shared = durable(_groups(prints).where(F.col("copies") > 1).select("head", F.col("cid").alias("member")))
    heads = _similar(every, prints, min_similarity, chunk_rows)

    def members(pairs: DataFrame, side: str) -> DataFrame:
        """One row per customer in place of the head; a history of one customer stays as it is."""
        of = shared.select(F.col("head").alias(side), F.col("member").alias("_m"))
        return pairs.join(of, side, "left").withColumn(side, F.coalesce("_m", side)).drop("_m")

    between = members(members(heads, "a"), "b")
    other = shared.select("head", F.col("member").alias("other"))
    within = shared.join(other, "head").where(F.col("member") < F.col("other"))
    equal = within.select(F.col("member").alias("a"), F.col("other").alias("b"), F.lit(1.0).alias("similarity"))
    return between.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity").unionByName(equal)


def similar_histories(
    sequences: DataFrame, min_similarity: float = 0.5, chunk_rows: int = 100_000
) -> DataFrame:
    """All pairs of distinct histories with at least the given similarity.

    Customers with the same history are one row here (see ``sequence_groups`` for
    who they are), so a crowd of copies costs no pairs. Where items are rare, so that
    those who share one are at most ``FEW`` pairs for each row, these pairs are
    scored at once. Otherwise histories meet only on items rare enough to matter (see
    ``_bounded``) and in baskets of sizes that fit; every pair found is then
    scored in full. Both ways are exact.
    """
    every = durable(_rows(sequences))
    return _similar(every, _prints(every), min_similarity, chunk_rows)


def _similar(every: DataFrame, prints: DataFrame, min_similarity: float, chunk_rows: int) -> DataFrame:
    t = float(min_similarity)
    if not 0 < t <= 1:
        raise ValueError("min_similarity must be above 0 and at most 1")
    slack = 1e-9
    heads = _distinct(prints)
    # histories meet by number; only pairs that are similar get their names
    mine = every.join(heads.select("cid", "id", "len"), "cid").select(F.col("id").alias("cid"), "pos", "item", "len")
    shared = mine.groupBy("pos", "item").agg(F.count(F.lit(1)).cast("double").alias("f"))
    total = shared.agg(F.sum("f").alias("rows"), F.sum(F.col("f") * (F.col("f") - 1) / 2).alias("pairs")).first()
    if (total["pairs"] or 0) <= FEW * (total["rows"] or 0):
        sized = durable(mine.join(mine.groupBy("cid", "pos").agg(F.count(F.lit(1)).alias("n")), ["cid", "pos"]))
        met = _side(sized, "a").join(_side(sized, "b"), ["pos", "item"]).where(
            (F.col("a") < F.col("b")) & (F.least("len_a", "len_b") >= F.greatest("len_a", "len_b") * t - slack)
        )
        found = _scored(met).where(F.col("similarity") >= t - slack)
        for side in ("a", "b"):
            found = found.join(heads.select(F.col("id").alias(side), F.col("cid").alias(f"_{side}")), side)
        return found.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"), "similarity")
    rows = _bounded(every, heads, chunk_rows)

    # partner baskets by size class (1, 2, 3-4, 5-8, ...), of those that occur at all
    size_class = F.ceil(F.log2(F.col("n").cast("double"))).cast("int")
    rows = rows.withColumn("c", size_class)
    classes = rows.select("c").distinct().agg(F.array_sort(F.collect_list("c")).alias("v"))
    least = F.when(F.col("p") == 0, F.lit(1)).otherwise(F.pow(F.lit(2), F.col("p") - 1) + 1)
    best = F.greatest(least, F.least("k", F.pow(F.lit(2), F.col("p"))))  # the fittest size
    tokens = (
        rows.withColumn("_classes", classes.scalar())
        .withColumn("p", F.explode("_classes"))
        .withColumn("_best", best)
        .where(
            F.least(F.col("k"), F.col("_best")) / (F.col("n") + F.col("_best") - F.least("k", "_best"))
            + F.col("after")
            + slack
            >= F.col("len") * t
        )
    )

    def side(tag: str, mine: str, other: str) -> DataFrame:
        return tokens.select(
            F.col("cid").alias(tag),
            "pos",
            "item",
            F.col("c").alias(mine),
            F.col("p").alias(other),
            *[F.col(c).alias(f"{c}_{tag}") for c in ("n", "k", "len", "after")],
        )

    needed = F.greatest("len_a", "len_b") * t - slack
    union = F.col("n_a") + F.col("n_b")

    def reaches(tag: str, other: str):
        shared = F.least(F.col(f"k_{tag}"), F.col(f"n_{other}"))
        return shared / (union - shared) + F.col(f"after_{tag}") >= needed

    candidates = (
        side("a", "c1", "c2")
        .join(side("b", "c2", "c1"), ["pos", "item", "c1", "c2"])
        .where(
            (F.col("a") < F.col("b"))
            & (F.least("len_a", "len_b") >= needed)
            & reaches("a", "b")
            & reaches("b", "a")
        )
        .select("a", "b")
        .distinct()
    )
    found = _scored(
        candidates.join(_side(rows, "a"), "a").join(_side(rows, "b"), ["b", "pos", "item"])
    )
    return found.where(F.col("similarity") >= t - slack)


def top_k_similar(sequences: DataFrame, selected: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` customers most similar to each selected one (column ``cid``).

    Only the selected customers' rows meet the others, so the work grows with the
    table and not with its square.
    """
    rows = durable(_profile(durable(_rows(sequences))))
    mine = _side(rows.join(selected.select("cid").distinct(), "cid", "left_semi"), "a")
    pairs = mine.join(_side(rows, "b"), ["pos", "item"]).where(F.col("a") != F.col("b"))
    best = Window.partitionBy("a").orderBy(F.desc("similarity"), "b")
    # equal up to rounding noise counts as a tie, decided by the customer key
    scored = _scored(pairs).withColumn("similarity", F.round("similarity", 9))
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
