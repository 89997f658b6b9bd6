"""Implicit preferences from purchase frequency, and their numeric form.

Input throughout: basket lines, one row per (idsite, user, idorder, item).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import customer_key, half_up
from ..functions.ordering import dense_ids, positions
from ..session import durable


def _lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("item").isNotNull()).select(
        customer_key(F.col("idsite"), F.col("user")).alias("cid"), "idorder", "item"
    )


def user_totals(lines: DataFrame) -> DataFrame:
    """Orders per customer."""
    orders = _lines(lines).select("cid", "idorder").distinct()
    return orders.groupBy("cid").agg(F.count(F.lit(1)).alias("total"))


def user_item_support(lines: DataFrame) -> DataFrame:
    """Orders of a customer that contain the item; repeats inside an order count once."""
    return (
        _lines(lines)
        .distinct()
        .groupBy("cid", "item")
        .agg(F.count(F.lit(1)).alias("supp"))
    )


def user_item_pref(lines: DataFrame) -> DataFrame:
    """ln(1 + share of the customer's orders that contain the item).

    Totals and supports come out of one pass: every order also counts as an item
    of its own (null), whose support is the customer's total. The item is read from an
    aggregate, as a filter on the key itself would be moved below the counting, and each of its
    readers would count for itself. A customer with a large
    share of all items is joined, not gathered, so that the join can be split.
    """
    marked = _lines(lines).select(
        "cid", "idorder", F.explode(F.array(F.col("item"), F.lit(None))).alias("_key")
    )
    counted = (
        marked.distinct()
        .groupBy("cid", "_key")
        .agg(F.count(F.lit(1)).alias("supp"), F.max("_key").alias("item"))
        .drop("_key")
    )
    total = counted.groupBy("cid").agg(F.sum(F.when(F.col("item").isNull(), F.col("supp"))).alias("total"))
    share = F.col("supp") / F.col("total")
    return (
        counted.where(F.col("item").isNotNull())
        .join(total, "cid")
        .select("cid", "item", F.log(F.lit(1.0) + share).alias("pref"))
    )


def item_max_pref(prefs: DataFrame) -> DataFrame:
    return prefs.groupBy("item").agg(F.max("pref").alias("mpref"))


def preference_scores(lines: DataFrame) -> DataFrame:
    """Scores 0..5: a customer's preference relative to the strongest for that item."""
    prefs = user_item_pref(lines)
    return prefs.join(item_max_pref(prefs), "item").select(
        F.col("cid").alias("user"),
        F.col("item").cast("string").alias("product"),
        half_up(F.lit(5.0) * (F.col("pref") / F.col("mpref"))).alias("score"),
    )


def bounded_users(scores: DataFrame, minprefs: int = 10, maxprefs: int = 20) -> DataFrame:
    """Scores of users with ``minprefs`` <= number of scores < ``maxprefs``."""
    kept = (
        scores.groupBy("user")
        .agg(F.count(F.lit(1)).alias("n"))
        .where((F.col("n") >= minprefs) & (F.col("n") < maxprefs))
        .select("user")
    )
    return scores.join(kept, "user", "left_semi")


def dictionary(scores: DataFrame, column: str) -> DataFrame:
    """Distinct terms of a column with dense numbers, the same in every run."""
    terms = scores.select(F.col(column).alias("term")).distinct()
    return dense_ids(terms, ["term"], "idx").select("term", F.col("idx").cast("int").alias("idx"))


def grown_dictionary(known: DataFrame, scores: DataFrame, column: str, version: int) -> DataFrame:
    """A dictionary (term, idx, version) with the terms it lacks added at its end.

    Known terms keep their numbers, so models fitted on an earlier version stay valid. New ones
    get the numbers after the last, dense and the same in every run, and this version's
    number. Only rows of the new version need to be stored (see ``store_terms``).
    """
    terms = scores.select(F.col(column).alias("term")).distinct()
    fresh = durable(dense_ids(terms.join(known.select("term"), "term", "left_anti"), ["term"], "idx"))
    after = known.agg(F.coalesce(F.max("idx") + 1, F.lit(0))).scalar()
    added = fresh.select("term", (F.col("idx") + after).cast("int").alias("idx"), F.lit(version).alias("version"))
    return known.select("term", "idx", "version").unionByName(added)


def no_terms(spark: SparkSession) -> DataFrame:
    """The dictionary before its first version."""
    return spark.createDataFrame([], "term string, idx int, version int")


def store_terms(grown: DataFrame, path: str, version: int) -> None:
    """Write what a version added; writing it again replaces it."""
    grown.where(F.col("version") == version).select("term", "idx").write.mode("overwrite").parquet(f"{path}/version={version}")


def stored_terms(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The dictionary as of a version (the latest without one); a file scan of the versions up to it."""
    found = spark.read.schema("term string, idx int, version int").parquet(path)
    return found if version is None else found.where(F.col("version") <= version)


def rating_matrix(scores: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Scores with both terms replaced by their numbers."""
    u = users.select(F.col("term").alias("user"), F.col("idx").alias("uid"))
    p = products.select(F.col("term").alias("product"), F.col("idx").alias("pid"))
    return (
        scores.join(u, "user")
        .join(p, "product")
        .select("uid", "pid", F.col("score").cast("double").alias("rating"))
    )


def preferences_json(scores: DataFrame, part_size: int = 10_000) -> DataFrame:
    """Preference lists as JSON documents, best first, in parts of ``part_size`` preferences.

    Every document names its part and the number of parts. Ties go by product.
    """
    if part_size < 1:
        raise ValueError("part_size must be at least 1")
    counted = scores.groupBy("user").agg(F.count(F.lit(1)).alias("_n"))
    placed = positions(scores.withColumn("_worse", -F.col("score")), ["user"], ["product"], F.col("_worse"), "_pos")
    entry = F.struct("_pos", F.struct("user", "product", "score").alias("e"))
    listed = F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["e"])
    return (
        placed.withColumn("part", F.floor(F.col("_pos") / part_size).cast("int"))
        .join(counted, "user")
        .groupBy("user", "part", F.ceil(F.col("_n") / part_size).cast("int").alias("parts"))
        .agg(listed.alias("items"))
        .select("user", "part", F.to_json(F.struct("part", "parts", "items")).alias("json"))
    )
