"""Scalar rules shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def visitor_bytes(key: Column) -> Column:
    """An integer key as 8 big-endian bytes."""
    return F.unhex(F.lpad(F.hex(key), 16, "0"))


def visitor_hex(idvisitor: Column) -> Column:
    """Visitor bytes as an unsigned number in lower-case hex, no leading zeros."""
    digits = F.ltrim(F.lower(F.hex(idvisitor)), F.lit("0"))
    return F.when(digits == "", F.lit("0")).otherwise(digits)


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def in_open_interval(ts: Column, start: str | None, end: str | None) -> Column:
    """Both ends excluded; bounds are dates (midnight) or timestamps as text."""
    keep = F.lit(True)
    if start is not None:
        keep = keep & (ts > F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        keep = keep & (ts < F.lit(end).cast("timestamp_ntz"))
    return keep


def half_up(x: Column) -> Column:
    """Nearest integer, halves towards plus infinity."""
    return F.floor(x + F.lit(0.5)).cast("int")


def customer_key(idsite: Column, user: Column) -> Column:
    return F.concat_ws("|", idsite.cast("string"), user)


def pageview(data: Column) -> list[Column]:
    return [
        data["idsite"].alias("site"),
        data["_id"].alias("visitor"),
        data["url"].alias("pageurl"),
    ]


def daytime(ts: Column) -> Column:
    """Six-hour parts of the day."""
    hour = F.hour(ts)
    return (
        F.when(hour < 6, "night")
        .when(hour < 12, "morning")
        .when(hour < 18, "afternoon")
        .otherwise("evening")
    )


def quantity_level(quantity: Column, low: float = 17, high: float = 34) -> Column:
    return F.when(quantity < low, "low").when(quantity < high, "mid").otherwise("high")


def spread(term: Column, digits: int = 3) -> Column:
    """An even, reproducible bucket label: the first hex digits of the MD5."""
    return F.substring(F.md5(term), 1, digits)


def to_pixel(lat: Column, lon: Column, width: int, height: int) -> tuple[Column, Column]:
    """Equirectangular projection of degrees to pixels, truncated toward zero."""
    x = (F.lit(float(width)) * (F.lit(0.5) + lon / F.lit(360.0))).cast("int")
    y = (F.lit(float(height)) * (F.lit(0.5) - lat / F.lit(180.0))).cast("int")
    return x, y

