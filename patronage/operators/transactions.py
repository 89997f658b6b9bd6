"""Orders, baskets, visit paths and customer sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import (
    daytime,
    epoch_millis,
    quantity_level,
    visitor_hex,
)
from ..functions.ordering import MAX_SEGMENT, dense_ids, known, positions, segments
from ..session import durable
from ..sources.scans import filter_not_deleted, filter_orders, scan_conversion_item

DAY = 86_400_000  # milliseconds
# Slot width for ordering inside a key. A minute spreads even one customer's busy
# day over many tasks, and years of minutes are still few rows to add up per key.
SLOT = 60_000
# Different values that one step of the search for a quantile looks at.
PAGE = 10_000


def slot_of(ts: str, width: int = SLOT):
    return F.floor(F.col(ts) / F.lit(width))


def order_transactions(conversions: DataFrame) -> DataFrame:
    """One row per shop order with its revenue."""
    return filter_orders(conversions).select(
        "idsite",
        visitor_hex(F.col("idvisitor")).alias("user"),
        "idorder",
        epoch_millis(F.col("server_time")).alias("timestamp"),
        "revenue_subtotal",
        "revenue_discount",
    )


def order_locations(conversions: DataFrame) -> DataFrame:
    """One row per conversion with its place; goals other than orders included."""
    return conversions.select(
        "idsite",
        visitor_hex(F.col("idvisitor")).alias("user"),
        "idorder",
        epoch_millis(F.col("server_time")).alias("timestamp"),
        F.col("location_latitude").alias("lat"),
        F.col("location_longitude").alias("lon"),
    )


def basket_lines(items: DataFrame) -> DataFrame:
    """Bought items in long form: one row per item of an order, deleted ones left out.

    The operators downstream (preferences, rules, sequences, similarity) work on
    these rows and never need a whole basket in one place.
    """
    return filter_not_deleted(items).select(
        "idsite",
        visitor_hex(F.col("idvisitor")).alias("user"),
        "idorder",
        epoch_millis(F.col("server_time")).alias("timestamp"),
        F.col("idaction_sku").alias("item"),
    )


def order_baskets(items: DataFrame, max_items: int = MAX_SEGMENT) -> DataFrame:
    """Items per order in time order, ties by item.

    An order of up to ``max_items`` items is one row with ``segment`` 0.
    """
    return segments(
        basket_lines(items),
        ["idsite", "user", "idorder"],
        ["timestamp", "item"],
        F.col("item"),
        slot_of("timestamp"),
        "items",
        extra=[F.min("timestamp").alias("timestamp")],
        max_len=max_items,
    )


def source_baskets(
    items: DataFrame, site: int, start: str, end: str, max_items: int = MAX_SEGMENT
) -> DataFrame:
    """Baskets of one site inside an open time window."""
    return order_baskets(scan_conversion_item(items, site, start, end), max_items)


def visit_paths(actions: DataFrame, max_pages: int = MAX_SEGMENT) -> DataFrame:
    """Pages per visit in time order, ties by page."""
    pages = actions.select(
        "idsite",
        visitor_hex(F.col("idvisitor")).alias("user"),
        "idvisit",
        epoch_millis(F.col("server_time")).alias("timestamp"),
        F.col("idaction_url").alias("page"),
    )
    return segments(
        pages,
        ["idsite", "user", "idvisit"],
        ["timestamp", "page"],
        F.col("page"),
        slot_of("timestamp"),
        "pages",
        extra=[F.min("timestamp").alias("timestamp")],
        max_len=max_pages,
    )


def customer_sequences(baskets: DataFrame, max_items: int = MAX_SEGMENT) -> DataFrame:
    """Baskets per customer in time order, ties by order id.

    A row begins with the first basket that has ``max_items`` items or a multiple of
    them before it, so it holds at most that many items and one basket more.
    """
    keys, order = ["idsite", "user"], ["timestamp", "idorder", "part"]
    parts = baskets.withColumnRenamed("segment", "part")
    placed = positions(parts, keys, order, slot_of("timestamp"), "_items_before", F.size("items").cast("bigint"))
    whole = F.struct("timestamp", "idorder", "items")
    return segments(
        placed, keys, order, whole, None, "baskets", max_len=max_items, position=F.col("_items_before")
    )


def numbered_baskets(baskets: DataFrame) -> DataFrame:
    """Baskets with a gap-free line number instead of site, customer and order.

    An order has one number; one that is cut into segments has a row for each.
    """
    order = ["idorder", "idsite", "user"]
    keyed = known(baskets.select(*order, "segment", "items"), order)
    numbers = dense_ids(keyed.where(F.col("segment") == 0).select(*order), order, "lno")
    return keyed.join(numbers, order).select("lno", "segment", "items")


def quantile_edges(values: DataFrame, columns: Sequence[str], levels: int = 3, accuracy: int = 10_000) -> DataFrame:
    """One row: for each column the values at which its next level begins, at equal shares of the rows; exact.

    An edge is the first value that, with those below it, holds its share. Sketches that every task makes
    and that merge bracket it, and only the rows in the bracket (some rows / ``accuracy``) are
    counted by value. Nulls do not count; a column without values has null edges.
    """
    kept = durable(values.select(*columns))
    rows = kept.agg(*[F.count(c).alias(c) for c in columns]).first()
    edges = {c: [_value_at(kept.select(F.col(c).alias("x")), rows[c], -(-rows[c] * i // levels), accuracy) for i in range(1, levels)] if rows[c] else None for c in columns}
    types = ", ".join(f"`{c}` array<{kept.schema[c].dataType.simpleString()}>" for c in columns)
    return values.sparkSession.createDataFrame([tuple(edges[c] for c in columns)], types)


def _value_at(values: DataFrame, n: int, rank: int, accuracy: int):
    """The value of this rank (from 1) among the ``n`` that are not null."""
    values, share = values.dropna(), 2 / accuracy
    while True:
        around = [max(0.0, rank / n - share), min(1.0, rank / n + share)]
        low, high = values.agg(F.percentile_approx("x", around, accuracy)).first()[0]
        inside = F.col("x").between(F.lit(low), F.lit(high))
        below, within = values.agg(F.count_if(F.col("x") < F.lit(low)), F.count_if(inside)).first()
        if below < rank <= below + within:
            break
        share *= 2  # at the latest a bracket of all values holds it
    counted = values.where(inside).groupBy("x").agg(F.count(F.lit(1)).alias("n")).orderBy("x")
    while True:
        # a page of values at a time, however many the bracket has
        for row in counted.limit(PAGE).collect():
            below += row["n"]
            if below >= rank:
                return row["x"]
        counted = counted.where(F.col("x") > F.lit(row["x"]))


def learned_categories(items: DataFrame, conversions: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """As ``categorical_items``, with levels of quantity and of revenue that the data set.

    An item's quantity and revenue are low, mid or high by thirds of all rows (see ``quantile_edges``);
    those without a value have no such item.
    """
    bought = filter_not_deleted(items).withColumn("revenue", F.col("price"))
    edges = durable(quantile_edges(bought, ["quantity", "revenue"], 3, accuracy))
    keys = ["idsite", "user", "idorder"]
    user = visitor_hex(F.col("idvisitor")).alias("user")

    def level(column: str) -> Column:
        first, second = (edges.select(F.col(column)[i]).scalar() for i in (0, 1))
        name = F.when(F.col(column) <= first, "low").when(F.col(column) <= second, "mid").when(F.col(column).isNotNull(), "high")
        return F.concat(F.lit(f"{column}="), name)

    found = F.array(
        F.concat(F.lit("buys="), F.col("idaction_sku").cast("string")), F.concat(F.lit("daytime="), daytime(F.col("server_time"))), level("quantity"), level("revenue")
    )
    from_items = bought.select("idsite", user, "idorder", F.explode(found).alias("item")).where(F.col("item").isNotNull()).distinct()
    places = conversions.select("idsite", user, "idorder", F.concat(F.lit("location="), F.col("location_country")).alias("item"))
    return from_items.unionByName(places.join(from_items.select(*keys).distinct(), keys, "left_semi").distinct())


def categorical_items(items: DataFrame, conversions: DataFrame) -> DataFrame:
    """Long-form baskets whose items also carry place, time of day and quantity.

    Items become text such as ``buys=4``, ``daytime=night``, ``location=berlin``
    and ``quantity=low``; each appears once per order.
    """
    bought = filter_not_deleted(items).select(
        "idsite",
        visitor_hex(F.col("idvisitor")).alias("user"),
        "idorder",
        F.concat(F.lit("buys="), F.col("idaction_sku").cast("string")).alias("buys"),
        F.concat(F.lit("daytime="), daytime(F.col("server_time"))).alias("daytime"),
        F.concat(F.lit("quantity="), quantity_level(F.col("quantity"))).alias("quantity"),
    )
    keys = ["idsite", "user", "idorder"]
    from_items = bought.select(
        *keys, F.explode(F.array("buys", "daytime", "quantity")).alias("item")
    ).distinct()
    places = conversions.select(
        "idsite",
        visitor_hex(F.col("idvisitor")).alias("user"),
        "idorder",
        F.concat(F.lit("location="), F.col("location_country")).alias("item"),
    )
    from_places = places.join(from_items.select(*keys).distinct(), keys, "left_semi").distinct()
    return from_items.unionByName(from_places)
