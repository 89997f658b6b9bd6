"""Order inside a group when the group may hold a large share of all rows.

``Window.partitionBy(key)`` puts a whole key into one task. The helpers here
cut each key into slots that rise with the order (usually a time slot), do the
window work inside (key, slot), and carry only one small row per slot across
the key. The answer is the same as that of the plain window.

The carried table holds one row per occupied slot, so one key contributes at
most time range / slot width rows to a task, whatever its row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .columns import spread

MAX_SEGMENT = 100_000


def known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that have all the given columns.

    This is the filter a join infers for one of its sides. Stated up front it is
    part of every reader's plan, so readers of the same rows plan the same exchange
    and Spark runs it once.
    """
    for name in columns:
        df = df.where(F.col(name).isNotNull())
    return df


def _slotted(df: DataFrame, keys: Sequence[str], slot: Column | str) -> DataFrame:
    """Rows with their slot; rows without a key or a slot have no place and are left out.

    A slot given by name is a column an earlier step kept: its rows are already
    placed by key and slot, and Spark does not shuffle them again.

    The filter is what the join below would infer for one of its sides. With it
    on both, the two readers of these rows plan the same exchange and share it.
    """
    rows = df.withColumn("_slot", F.col(slot) if isinstance(slot, str) else slot)
    return known(rows, [*keys, "_slot"])


def positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slot: Column,
    name: str = "pos",
    weight: Column | None = None,
) -> DataFrame:
    """Add the zero-based position of each row inside its key, or the weight of the rows before it."""
    inside = Window.partitionBy(*keys, "_slot").orderBy(*order)
    before = (
        Window.partitionBy(*keys)
        .orderBy("_slot")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    one = F.lit(1) if weight is None else weight
    rank = F.row_number().over(inside) if weight is None else F.sum(one).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    ranked = _slotted(df, keys, slot).withColumn("_one", one).withColumn("_rank", rank)
    offsets = (
        ranked.groupBy(*keys, "_slot")
        .agg(F.max("_rank").cast("bigint").alias("_n"))
        .select(*keys, "_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        ranked.join(offsets, [*keys, "_slot"])
        .withColumn(name, F.col("_before") + F.col("_rank") - F.col("_one"))
        .drop("_slot", "_rank", "_before", "_one")
    )


def previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, str],
    slot: Column | str,
    position: str | None = None,
    keep_slot: str | None = None,
) -> DataFrame:
    """Add columns of the preceding row of the same key; null on the first row.

    ``values`` maps the new column name to the source column. ``order`` must
    identify a row inside its key. ``position`` also adds the zero-based position,
    which comes out of the same steps; ``keep_slot`` keeps the slot for later use.
    """
    inside = Window.partitionBy(*keys, "_slot").orderBy(*order)
    across = Window.partitionBy(*keys).orderBy("_slot")
    ranked = _slotted(df, keys, slot).withColumn("_rank", F.row_number().over(inside))
    last = ranked.groupBy(*keys, "_slot").agg(
        F.max("_rank").cast("bigint").alias("_n"),
        *[F.max_by(src, "_rank").alias(f"_last_{dst}") for dst, src in values.items()],
    )
    total = F.sum("_n").over(across.rowsBetween(Window.unboundedPreceding, -1))
    edges = last.select(
        *keys,
        "_slot",
        F.coalesce(total, F.lit(0)).alias("_before"),
        *[F.lag(f"_last_{dst}").over(across).alias(f"_edge_{dst}") for dst in values],
    )
    near = ranked.select(
        "*", *[F.lag(src).over(inside).alias(f"_near_{dst}") for dst, src in values.items()]
    )

    def chosen(dst: str) -> Column:
        pick = F.when(F.col("_rank") == 1, F.col(f"_edge_{dst}")).otherwise(F.col(f"_near_{dst}"))
        return pick.alias(dst)

    extra = []
    if position is not None:
        extra.append((F.col("_before") + F.col("_rank") - 1).alias(position))
    if keep_slot is not None and keep_slot not in df.columns:
        extra.append(F.col("_slot").alias(keep_slot))
    joined = near.join(edges, [*keys, "_slot"])
    return joined.select(*df.columns, *[chosen(dst) for dst in values], *extra)


def segments(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    slot: Column | None,
    name: str,
    extra: Sequence[Column] = (),
    max_len: int = MAX_SEGMENT,
    position: Column | None = None,
) -> DataFrame:
    """Ordered arrays per key, cut into consecutive pieces of ``max_len`` entries.

    A key with at most ``max_len`` rows gives one row with ``segment`` 0; longer
    keys give several, in order, so that no row outgrows a task. Where the rows
    already know their ``position`` it is taken from there.
    """
    if position is None:
        placed = positions(df, keys, order, slot, "_pos")
    else:
        placed = df.withColumn("_pos", position)
    placed = placed.withColumn("_value", value)
    pieces = placed.withColumn("segment", F.floor(F.col("_pos") / F.lit(max_len)).cast("int"))
    pieces = pieces.where(F.col("segment").isNotNull())  # always so; stated for exchange reuse
    listed = F.array_sort(F.collect_list(F.struct("_pos", "_value")))
    return pieces.groupBy(*keys, "segment").agg(
        *extra, F.transform(listed, lambda e: e["_value"]).alias(name)
    )


def dense_ids(df: DataFrame, by: Sequence[str], name: str, digits: int = 3) -> DataFrame:
    """Gap-free numbers 0..n-1 for rows that are unique on ``by``.

    Rows fall into 16**digits even hash buckets; a number is the rank inside the
    bucket plus the size of all buckets before it. The global step sees one row
    per bucket (4,096 by default), never the data.
    """
    term = F.concat_ws("|", *[F.col(c).cast("string") for c in by])
    hashed = df.withColumn("_bucket", spread(term, digits))
    inside = Window.partitionBy("_bucket").orderBy(*by)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    return (
        hashed.withColumn("_rank", F.row_number().over(inside))
        .join(starts, "_bucket")
        .withColumn(name, F.col("_start") + F.col("_rank") - 1)
        .drop("_bucket", "_rank", "_start")
    )
