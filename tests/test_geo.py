import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.operators import convolution, geo

W, H = 20, 12


def pixels(spark, n=60, seed=1):
    r = random.Random(seed)
    rows = [(0, 0, 0, r.randrange(W + 1), r.randrange(H + 1)) for _ in range(n)] + [(0, 0, 0, 5, 5)] * 30
    return rows, spark.createDataFrame(rows, "cluster int, cx int, cy int, x int, y int")


def brute(rows, x, y, reach):
    heat = 0.0
    for *_, px, py in rows:
        if reach is None or (abs(px - x) < reach and abs(py - y) < reach):
            d = (px - x) ** 2 + (py - y) ** 2
            heat += 1.0 / d if d else 1.0
    return heat


@pytest.mark.parametrize("width", [W, 4])
def test_pixel_heat(spark, width):
    rows, df = pixels(spark)
    got = {(r.x, r.y): r.heat for r in geo.pixel_heat(df, width, H).collect()}
    assert set(got) == {(x, y) for x in range(width) for y in range(H)}
    if width == 4:  # no reach at all
        assert set(got.values()) == {0.0}
        return
    for (x, y), heat in got.items():
        assert heat == pytest.approx(brute(rows, x, y, W // 5), abs=1e-9)


def test_heat_does_not_depend_on_row_order(spark):
    rows, df = pixels(spark)
    again = spark.createDataFrame(rows[::-1], df.schema).repartition(5)
    a = {(r.x, r.y): round(r.heat, 9) for r in geo.pixel_heat(df, W, H).collect()}
    assert a == {(r.x, r.y): round(r.heat, 9) for r in geo.pixel_heat(again, W, H).collect()}


def test_point_heat(spark):
    rows, df = pixels(spark)
    occupied = {(r[3], r[4]) for r in rows}
    for r in geo.point_heat(df, W, H).collect():
        want = brute(rows, r.x, r.y, None) if (r.x, r.y) in occupied else 0.0
        assert r.heat == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("block", [64, 3])
def test_transforms_equal_sums_over_pairs(spark, monkeypatch, block):
    """Both ways give the same heat, borders and points outside the image included."""
    rows, df = pixels(spark)
    beyond = spark.createDataFrame([(0, 0, 0, W + 1, 3), (0, 0, 0, 4, -1), (0, 0, 0, None, 2)], df.schema)
    df = df.unionByName(beyond)
    pairs = [{(r.x, r.y): r.heat for r in heat(df, W, H).collect()} for heat in (geo.pixel_heat, geo.point_heat)]
    monkeypatch.setattr(geo, "PAIRS", 0)
    monkeypatch.setattr(convolution, "BLOCK", block)
    for heat, want in zip((geo.pixel_heat, geo.point_heat), pairs, strict=True):
        got = {(r.x, r.y): r.heat for r in heat(df, W, H).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
        assert all(got[k] == 0 for k in want if want[k] == 0)
    assert {r.heat for r in geo.pixel_heat(df.where("false"), W, H).collect()} == {0.0}
    assert {r.heat for r in geo.pixel_heat(df, 4, H).collect()} == {0.0}


def test_lengths_have_small_factors():
    plain = sorted(2**a * 3**b * 5**c for a in range(14) for b in range(9) for c in range(6))
    assert all(convolution.fast_length(n) == next(x for x in plain if x >= n) for n in range(1, 5000))


def test_heat_of_a_large_image(spark):
    """Every pixel of a 4K image from 200,000 points, checked at some pixels."""
    width, height = 3840, 2160
    df = spark.range(200_000).selectExpr(f"cast(pmod(hash(id), {width}) AS int) AS x", f"cast(pmod(hash(id, 7), {height}) AS int) AS y")
    begin = time.time()
    heat = geo.pixel_heat(df, width, height).where("x % 700 = 3 AND y % 500 = 7").collect()
    assert time.time() - begin < 300 and len(heat) == 6 * 5
    points = np.array(df.collect())
    for r in heat:
        d = np.abs(points - [r.x, r.y])
        d = d[(d < width // 5).all(axis=1)].astype(float)
        square = (d * d).sum(axis=1)
        assert r.heat == pytest.approx((1 / np.where(square == 0, 1, square)).sum(), rel=1e-9)


def test_colours(spark):
    weights = [0.0, 0.1, 0.25, 0.4, 0.5, 0.6, 0.75, 0.9, 1.0, 5.0, 1e12]
    df = spark.createDataFrame([(i, 0, w) for i, w in enumerate(weights)], "x int, y int, heat double")
    got = [(r.r, r.g, r.b, r.a) for r in geo.heat_colour(df, 1.0).orderBy("x").collect()]

    def clip(v):
        return max(0, min(255, int(v)))

    want = []
    for w in weights:
        if w < 0.25:
            c = (0, 0, clip(255 * w / 0.25))
        elif w < 0.5:
            c = (0, clip(255 * (w - 0.25) / 0.25), clip(255 * (0.5 - w) / 0.25))
        elif w < 0.75:
            c = (clip(255 * (0.75 - w) / 0.25), 255, 0)
        else:
            c = (clip(255 * (w - 0.75) / 0.25), clip(255 * (1.0 - w) / 0.25), 0)
        want.append((*c, 200))
    assert got == want


def test_clusters_find_separate_places(spark):
    r = random.Random(2)
    spots = [(-60.0, -100.0), (0.0, 20.0), (50.0, 120.0)]
    rows = [(a + r.random(), b + r.random()) for a, b in spots for _ in range(40)]
    df = spark.createDataFrame(rows + [rows[0]] * 100, "lat double, lon double")
    got = geo.geo_clusters(df, 3, 50).collect()
    assert len(got) == 220
    by = {}
    for c in got:
        by.setdefault(c.cluster, set()).add(min(range(3), key=lambda i: abs(spots[i][1] - c.lon)))
    assert sorted(map(len, by.values())) == [1, 1, 1]
    again = geo.fit_centers(df.repartition(7), 3, 50)
    assert sum(again, ()) == pytest.approx(sum(geo.fit_centers(df, 3, 50), ()))


def test_centres_are_the_means_of_their_points_however_slowly_they_settle(spark):
    """On an even line centres pass on what is left of the start from one to the next, for hundreds of rounds."""
    df = spark.range(20_000).selectExpr("0.0D AS lat", "id * 0.009D - 90 AS lon")
    found = geo.geo_clusters(df, 80).groupBy("clon").agg(F.avg("lon").alias("mean")).collect()
    assert len(found) == 80 and max(abs(r.clon - r["mean"]) for r in found) < 0.01


def test_equal_distance_takes_the_first_centre(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "lat double, lon double")
    assert geo.assign_clusters(df, [(1.0, 0.0), (-1.0, 0.0)]).first().cluster == 0


def test_segments_need_complete_rows(spark):
    rows = [(float(i % 2) * 100 + i * 0.01, float(i % 2)) for i in range(40)] + [(None, 1.0)]
    df = spark.createDataFrame(rows, "revenue double, hour double")
    got = geo.customer_segments(df, ["revenue", "hour"], clusters=2).collect()
    assert len(got) == 40
    assert len({(r.hour, r.cluster) for r in got}) == 2


def test_a_wrong_centre_is_seen(spark):
    """The flag of a fit is false for rows that are nearer to another centre than to their own."""
    df = spark.createDataFrame([(float(x), float(x % 3)) for x in [1, 2, 3, 100, 101, 102]], "a double, b double")
    model, rows = geo.fit_segments(df, ["a", "b"], clusters=2)
    assert geo.at_nearest_center(model, rows).where("NOT nearest").isEmpty()

    class Turned:
        """The same clusters, with the centres the other way round."""

        def transform(self, rows):
            return model.transform(rows)

        class Stage:
            @staticmethod
            def clusterCenters():
                return model.stages[-1].clusterCenters()[::-1]

        stages = [Stage]

    assert geo.at_nearest_center(Turned(), rows).where("nearest").isEmpty()
