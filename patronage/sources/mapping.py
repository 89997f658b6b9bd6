"""The tracking tables as views over the given order and event tables.

Only the columns a caller asks for bring in their joins, so a plan that needs
no revenue never reads order lines, and one that needs no country never reads
the customer table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.columns import visitor_bytes, visitor_hex

LINE_COLUMNS = {"items", "revenue_discount", "revenue_tax"}
PLACE_COLUMNS = {"location_country", "location_region", "location_city"}
TOPIC = "publisher"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _site(key: Column) -> Column:
    return F.lit(1).cast("bigint") + key % 3


def _ordered_at() -> Column:
    """Order dates carry no hour, so the order key gives one."""
    return F.col("o_orderdate") + F.make_dt_interval(hours=((F.col("o_orderkey") * 7) % 24).cast("int"))


def log_conversion(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = ()
) -> DataFrame:
    names = list(columns) or schemas.CONVERSION.fieldNames()
    key = F.col("o_custkey")
    base = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        _site(key).alias("idsite"),
        visitor_bytes(key).alias("idvisitor"),
        _ordered_at().alias("server_time"),
        (((key * 7919) % 18000) / F.lit(100.0) - F.lit(90.0)).alias("location_latitude"),
        (((key * 104729) % 36000) / F.lit(100.0) - F.lit(180.0)).alias("location_longitude"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("idgoal"),
        F.col("o_orderkey").cast("string").alias("idorder"),
        F.col("o_totalprice").alias("revenue"),
        F.col("o_totalprice").alias("revenue_subtotal"),
        F.lit(0.0).alias("revenue_shipping"),
    )
    if LINE_COLUMNS & set(names):
        price = F.col("l_extendedprice")
        lines = (
            table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(
                F.count(F.lit(1)).cast("int").alias("_items"),
                F.round(F.sum(price * F.col("l_discount")), 4).alias("revenue_discount"),
                F.round(F.sum(price * F.col("l_tax")), 4).alias("revenue_tax"),
            )
        )
        base = base.join(lines, "o_orderkey", "left").withColumn(
            "items", F.coalesce("_items", F.lit(0))
        )
    if PLACE_COLUMNS & set(names):
        places = (
            table(spark, sf_dir, "nation")
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", "n_name", "r_name")
        )
        homes = (
            table(spark, sf_dir, "customer")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("o_custkey"),
                F.col("n_name").alias("location_country"),
                F.col("r_name").alias("location_region"),
                F.concat_ws("-", "n_name", "c_mktsegment").alias("location_city"),
            )
        )
        base = base.join(homes, "o_custkey", "left")
    return base.select(*names)


def log_conversion_item(
    spark: SparkSession, sf_dir: str, sku: str = "part"
) -> DataFrame:
    """Order lines; the item id is the part, or its brand number."""
    key = F.col("o_custkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_extendedprice",
        "l_quantity",
        "l_returnflag",
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    item = F.col("l_partkey")
    if sku == "brand":
        brands = table(spark, sf_dir, "part").select(
            "p_partkey", F.regexp_replace("p_brand", "^Brand#", "").cast("bigint").alias("brand")
        )
        joined = joined.join(brands, F.col("l_partkey") == F.col("p_partkey"))
        item = F.col("brand")
    return joined.select(
        _site(key).alias("idsite"),
        visitor_bytes(key).alias("idvisitor"),
        (
            _ordered_at()
            + F.make_dt_interval(secs=F.col("l_linenumber").cast("decimal(18,6)"))
        ).alias("server_time"),
        F.col("o_orderkey").cast("string").alias("idorder"),
        item.alias("idaction_sku"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_returnflag").eqNullSafe("R").alias("deleted"),
    )


def _page(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("bigint")


def log_link_visit_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        _site(key).alias("idsite"),
        visitor_bytes(key).alias("idvisitor"),
        F.col("ts").alias("server_time"),
        (key * 100 + F.dayofmonth("ts")).alias("idvisit"),
        _page(F.col("props")).alias("idaction_url"),
    )


def click_messages(events: DataFrame) -> DataFrame:
    """Raw events as a message feed: JSON ``value`` and its arrival ``timestamp``."""
    key = F.col("user_id")
    data = F.create_map(
        F.lit("idsite"),
        _site(key).cast("string"),
        F.lit("_id"),
        visitor_hex(visitor_bytes(key)),
        F.lit("url"),
        F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), _page(F.col("props")).cast("string")),
    )
    return events.select(
        F.to_json(F.struct(F.lit(TOPIC).alias("topic"), data.alias("data"))).alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_messages(table(spark, sf_dir, "events"))
