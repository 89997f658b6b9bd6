"""Purchase rhythm as states, their transitions, and the next likely purchase.

A transaction's state is two letters: days since the previous transaction and
revenue compared with it. The thresholds are parameters; the defaults split the
days near their terciles and call revenue within ten percent equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ordering import MAX_SEGMENT, previous, segments
from ..session import durable
from .transactions import DAY, slot_of

KEYS = ["idsite", "user"]
ORDER = ["timestamp", "idorder"]
DAYS = (90, 240)
RATIOS = (0.9, 1.1)


def _letter(x: Column, bounds: tuple[float, float], letters: str, closed: bool) -> Column:
    low, high = bounds
    middle = x <= high if closed else x < high
    return F.when(x < low, letters[0]).when(middle, letters[1]).otherwise(letters[2])


def transaction_states(
    transactions: DataFrame,
    days: tuple[float, float] = DAYS,
    ratios: tuple[float, float] = RATIOS,
    time_letters: str = "SML",
    amount_letters: str = "LEG",
) -> DataFrame:
    """A state for every transaction but a customer's first.

    After a transaction without revenue any revenue counts as greater, and none
    as equal; the ratio itself stays null. ``step`` counts a customer's states from
    0; ``slot`` is the time slot by which the rows are placed, and lets later steps
    along the history do without another shuffle.
    """
    seen = previous(
        transactions.select(*KEYS, *ORDER, "revenue_subtotal"),
        KEYS,
        ORDER,
        {"prev_timestamp": "timestamp", "prev_revenue": "revenue_subtotal"},
        slot_of("timestamp"),
        position="_pos",
        keep_slot="slot",
    ).where(F.col("prev_timestamp").isNotNull())
    gap = F.col("timestamp") - F.col("prev_timestamp")
    ratio = F.when(
        F.col("prev_revenue") != 0, F.col("revenue_subtotal") / F.col("prev_revenue")
    )
    amount = F.when(F.col("ratio").isNotNull(), _letter(F.col("ratio"), ratios, amount_letters, True))
    amount = amount.when(F.col("revenue_subtotal") > 0, amount_letters[2]).otherwise(
        amount_letters[1]
    )
    time = _letter(F.col("gap") / F.lit(float(DAY)), days, time_letters, False)
    return (
        seen.withColumn("gap", gap)
        .withColumn("ratio", ratio)
        .select(
            *KEYS,
            *ORDER,
            "revenue_subtotal",
            "gap",
            "ratio",
            F.concat(time, amount).alias("state"),
            (F.col("_pos") - 1).alias("step"),
            "slot",
        )
    )


def state_sequences(states: DataFrame, max_states: int = MAX_SEGMENT) -> DataFrame:
    """States per customer in time order."""
    return segments(
        states,
        KEYS,
        ORDER,
        F.col("state"),
        None,
        "states",
        max_len=max_states,
        position=F.col("step"),
    )


def _steps(states: DataFrame) -> DataFrame:
    """States with the state before them (null for a customer's first)."""
    return previous(states, KEYS, ORDER, {"from_state": "state"}, "slot")


def transition_counts(states: DataFrame) -> DataFrame:
    """How often each customer went from one state to the next."""
    pairs = _steps(states.select(*KEYS, *ORDER, "state", "slot")).where(F.col("from_state").isNotNull())
    return pairs.groupBy(
        *KEYS, F.col("from_state").alias("state"), F.col("state").alias("next")
    ).agg(F.count(F.lit(1)).alias("n"))


def rhythm(states: DataFrame) -> DataFrame:
    """All that predictions need, in one pass: a row per customer and state pair.

    At most 90 rows per customer, however long the history. The copy is durable,
    as every later step reads it.
    """
    steps = _steps(states.select(*KEYS, *ORDER, "state", "gap", "ratio", "slot"))
    return durable(
        steps.groupBy(*KEYS, F.col("from_state").alias("state"), F.col("state").alias("next")).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("gap").alias("gaps"),
            F.sum("ratio").alias("ratios"),
            F.count("ratio").alias("rated"),
            F.max(F.struct(*ORDER)).alias("last"),
        )
    )


def transition_probs(counts: DataFrame, scale: float = 1.0) -> DataFrame:
    """Counts as shares of all steps out of the same state, times ``scale``."""
    totals = counts.groupBy(*KEYS, "state").agg(F.sum("n").alias("total"))
    return counts.join(totals, [*KEYS, "state"]).select(
        *KEYS, "state", "next", "n", (F.lit(float(scale)) * F.col("n") / F.col("total")).alias("prob")
    )


def _best(counts: DataFrame, keys: list[str], label: str) -> DataFrame:
    """The most frequent ``next`` per key (ties: alphabetical) and its share."""
    top = F.min(F.struct((-F.col("n")).alias("k"), F.col("next").alias("next")))
    return (
        counts.groupBy(*keys)
        .agg(top.alias("top"), F.sum("n").alias("total"))
        .select(
            *keys,
            F.col("top.next").alias(f"{label}_next"),
            (-F.col("top.k") / F.col("total")).alias(f"{label}_prob"),
        )
    )


def _next(customers: DataFrame, known: DataFrame) -> DataFrame:
    counts = known.where(F.col("state").isNotNull())
    own = _best(counts, [*KEYS, "state"], "own")
    by_site = counts.groupBy("idsite", "state", "next").agg(F.sum("n").alias("n"))
    site = _best(by_site, ["idsite", "state"], "site")
    common = _best(
        known.groupBy("idsite", "next").agg(F.sum("n").alias("n")), ["idsite"], "start"
    )
    last = known.groupBy(*KEYS).agg(F.max_by("next", "last").alias("state"))
    fresh = F.col("state").isNull()
    return (
        customers.join(last, KEYS, "left")
        .join(own, [*KEYS, "state"], "left")
        .join(site, ["idsite", "state"], "left")
        .join(common, ["idsite"], "left")
        .withColumn("next", F.coalesce("own_next", "site_next", F.when(fresh, F.col("start_next"))))
        .withColumn("prob", F.coalesce("own_prob", "site_prob", F.when(fresh, F.col("start_prob"))))
        .withColumn(
            "basis",
            F.when(F.col("own_next").isNotNull(), "own")
            .when(F.col("site_next").isNotNull(), "site")
            .when(fresh, "start"),
        )
        .drop("own_next", "own_prob", "site_next", "site_prob", "start_next", "start_prob")
    )


def next_state(transactions: DataFrame, states: DataFrame) -> DataFrame:
    """The most probable next state of every customer.

    ``basis`` tells where the probability comes from: the customer's own steps
    out of the current state, the steps of the whole site out of it, or, for a
    customer without any state, how common each state is on the site.
    """
    customers = transactions.select(*KEYS).distinct()
    return _next(customers, rhythm(states)).select(*KEYS, "state", "next", "prob", "basis")


def _of_kind(kind: str) -> Column:
    return F.substring("next", 1 if kind == "time" else 2, 1)


def _site_means(known: DataFrame, kind: str, total: str, n: str) -> DataFrame:
    """Mean gap or ratio of a site's states with the same time or amount letter."""
    mean = F.when(F.sum(n) > 0, F.sum(F.col(total).cast("double")) / F.sum(n))
    return known.groupBy("idsite", _of_kind(kind).alias(f"{kind}_letter")).agg(mean.alias(f"site_{kind}"))


def purchase_horizon(
    transactions: DataFrame, states: DataFrame, time_letters: str = "SML", amount_letters: str = "LEG"
) -> DataFrame:
    """Likely time and amount of each customer's next purchase.

    Time: last purchase plus the mean gap of the predicted time letter. Amount:
    last revenue times the mean ratio of the predicted amount letter. Means are
    the customer's own where there are any, else the site's. Customers with a
    single transaction get nulls.

    A customer's own means are looked up in one row that holds the sums by letter,
    at most three of each kind.
    """
    known = rhythm(states)
    last = transactions.groupBy(*KEYS).agg(
        F.max_by(F.struct("timestamp", "revenue_subtotal"), F.struct(*ORDER)).alias("l")
    )
    sums = [
        F.sum(F.when(_of_kind(kind) == letter, F.col(c)).cast("double")).alias(f"{kind}_{letter}_{c}")
        for kind, letters, columns in (("time", time_letters, ("gaps", "n")), ("amount", amount_letters, ("ratios", "rated")))
        for letter in letters
        for c in columns
    ]
    own = known.groupBy(*KEYS).agg(*sums)

    def mine(kind: str, letters: str, total: str, n: str) -> Column:
        picks = [(F.col(f"{kind}_letter") == x, F.col(f"{kind}_{x}_{total}") / F.col(f"{kind}_{x}_{n}"), F.col(f"{kind}_{x}_{n}") > 0) for x in letters]
        return F.coalesce(*[F.when(is_it & some, mean) for is_it, mean, some in picks], F.col(f"site_{kind}"))

    sure = F.col("state").isNotNull() & F.col("next").isNotNull()
    ahead = _next(last, known).withColumns({f"{k}_letter": F.when(sure, _of_kind(k)) for k in ("time", "amount")})
    joined = (
        ahead.join(own, KEYS, "left")
        .join(_site_means(known, "time", "gaps", "n"), ["idsite", "time_letter"], "left")
        .join(_site_means(known, "amount", "ratios", "rated"), ["idsite", "amount_letter"], "left")
    )
    gap, ratio = mine("time", time_letters, "gaps", "n"), mine("amount", amount_letters, "ratios", "rated")
    return joined.select(
        *KEYS,
        F.when(F.col("state").isNotNull(), F.col("next")).alias("next"),
        (F.col("l.timestamp") + F.floor(gap + F.lit(0.5))).alias("next_timestamp"),
        (F.col("l.revenue_subtotal") * ratio).alias("next_amount"),
    )
