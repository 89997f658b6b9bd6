import datetime as dt

from pyspark.sql import functions as F

from patronage.functions import columns as c
from patronage.sources import scans


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_visitor_hex_has_no_leading_zeros(spark):
    rows = [(bytes(8),), (bytes([0, 0, 0, 10]),), (bytes.fromhex("b65ce95de5c8e7ea"),), (b"\xff" * 8,)]
    df = spark.createDataFrame(rows, "b binary").select(c.visitor_hex(F.col("b")).alias("x"))
    assert [r.x for r in df.collect()] == [format(int.from_bytes(b, "big"), "x") for (b,) in rows]


def test_visitor_bytes_round_trip(spark):
    df = spark.createDataFrame([(0,), (1,), (255,), (2**40 + 3,)], "k bigint")
    got = df.select("k", c.visitor_hex(c.visitor_bytes(F.col("k"))).alias("x")).collect()
    assert all(r.x == format(r.k, "x") for r in got)


def test_epoch_millis_cuts_microseconds(spark):
    ts = dt.datetime(2014, 8, 14, 3, 23, 2, 1999)
    df = spark.createDataFrame([(ts,)], "t timestamp_ntz").select(c.epoch_millis(F.col("t")).alias("x"))
    assert df.first().x == 1407986582001


def test_interval_is_open_on_both_ends(spark):
    days = [dt.datetime(2020, 1, d, h) for d, h in ((1, 0), (1, 1), (2, 0), (2, 23), (3, 0))]
    df = spark.createDataFrame([(d, 1) for d in days], "server_time timestamp_ntz, idsite bigint")
    kept = scans.scan_log(df, 1, start="2020-01-01", end="2020-01-03").collect()
    assert sorted(r.server_time for r in kept) == days[1:4]


def test_half_up(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (2.4999,), (-0.5,)], "x double")
    assert [r.x for r in df.select(c.half_up(F.col("x")).alias("x")).collect()] == [1, 2, 3, 2, 0]


def test_daytime_and_quantity(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 23]
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, h),) for h in hours], "t timestamp_ntz")
    got = [r.x for r in df.select(c.daytime(F.col("t")).alias("x")).collect()]
    assert got == ["night"] * 2 + ["morning"] * 2 + ["afternoon"] * 2 + ["evening"] * 2
    q = spark.createDataFrame([(1.0,), (17.0,), (33.0,), (34.0,)], "q double")
    assert [r.x for r in q.select(c.quantity_level(F.col("q")).alias("x")).collect()] == [
        "low", "mid", "mid", "high",
    ]


def test_pixels_at_the_edges(spark):
    df = spark.createDataFrame(
        [(90.0, -180.0), (-90.0, 180.0), (0.0, 0.0), (89.9, 179.9)], "lat double, lon double"
    )
    x, y = c.to_pixel(F.col("lat"), F.col("lon"), 360, 180)
    got = [(r.x, r.y) for r in df.select(x.alias("x"), y.alias("y")).collect()]
    assert got == [(0, 0), (360, 180), (180, 90), (359, 0)]
