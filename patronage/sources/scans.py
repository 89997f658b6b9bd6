"""Relational scans of the tracking tables, and field selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.columns import in_open_interval


def jdbc_options(
    url: str,
    table: str,
    *,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str = "server_time",
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 64,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a parallel JDBC scan, cut on ``partition_column``.

    The bounds only set the stride of the cuts; no row outside them is lost.
    Without both bounds the scan is a single connection.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    for key, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[key] = value
    if lower is not None and upper is not None:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": lower,
            "upperBound": upper,
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A database table; filters and columns below are pushed into its SQL.

    The scan is cut on ``partition_column`` between ``lower`` and ``upper``, such as
    the time window that the scan above asks for. Without them it would be one
    connection whatever the table's size, which must be asked for by ``partitions=1``.
    """
    bounded = options.get("lower") is not None and options.get("upper") is not None
    if not bounded and options.get("partitions") != 1:
        raise ValueError("a parallel scan needs lower and upper bounds; partitions=1 reads through one connection")
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def project_fields(df: DataFrame, fields: Sequence[str] = ()) -> DataFrame:
    """Keep the named columns; no names means all of them."""
    return df.select(*fields) if fields else df


def scan_log(
    table: DataFrame,
    first_site: int,
    last_site: int | None = None,
    start: str | None = None,
    end: str | None = None,
    fields: Sequence[str] = (),
) -> DataFrame:
    """Rows of a site range inside an open time window."""
    last = first_site if last_site is None else last_site
    kept = table.where(
        F.col("idsite").between(first_site, last)
        & in_open_interval(F.col("server_time"), start, end)
    )
    return project_fields(kept, fields)


def _scan(kind, schema, table, site, start, end):
    rows = schemas.conform(table, schema).dropna(subset=schemas.REQUIRED[kind])
    return scan_log(rows, site, site, start, end, schema.fieldNames())


def scan_conversion(table: DataFrame, site: int, start: str, end: str) -> DataFrame:
    return _scan("conversion", schemas.CONVERSION, table, site, start, end)


def scan_conversion_item(table: DataFrame, site: int, start: str, end: str) -> DataFrame:
    return _scan("conversion_item", schemas.CONVERSION_ITEM, table, site, start, end)


def scan_visit_action(table: DataFrame, site: int, start: str, end: str) -> DataFrame:
    return _scan("visit_action", schemas.VISIT_ACTION, table, site, start, end)


def dropped_rows(table: DataFrame, kind: str) -> DataFrame:
    """How many rows the key check of a scan drops, per missing column."""
    return table.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in schemas.REQUIRED[kind]]
    )


def filter_orders(conversions: DataFrame) -> DataFrame:
    """Conversions that are shop orders; one without a goal counts as an order."""
    return conversions.where(F.coalesce("idgoal", F.lit(0)) == 0)


def filter_not_deleted(items: DataFrame) -> DataFrame:
    """Items that stand; one without the flag was not deleted."""
    return items.where(F.col("deleted").isNull() | ~F.col("deleted"))  # a form that reaches the scan
