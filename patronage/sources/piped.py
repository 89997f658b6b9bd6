"""Piped text at the edges: ``a|b|c`` lines in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def piped_line(columns: Sequence[str]):
    """One text line from columns; a missing value is an empty field."""
    return F.concat_ws(
        "|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    )


def write_piped(df: DataFrame, path: str, columns: Sequence[str] = ()) -> None:
    names = list(columns) or df.columns
    df.select(piped_line(names).alias("value")).write.mode("overwrite").text(path)


def read_piped(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.csv(path, schema=schema, sep="|")


def pick_fields(lines: DataFrame, fields: Mapping[str, tuple[int, str]]) -> DataFrame:
    """Fields of text lines by position: ``{"lat": (4, "double"), ...}``.

    Unreadable values become null, as a bad line must not end the job.
    """
    parts = F.split(F.col("value"), r"\|")
    return lines.select(
        *[
            F.get(parts, F.lit(position)).try_cast(kind).alias(name)
            for name, (position, kind) in fields.items()
        ]
    )
