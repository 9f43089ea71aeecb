"""Nearest points in crowded places and polygons by cells, against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from siteweave.operators import geo


def metres(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    return 2 * 6_371_000 * math.asin(math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2))


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_in_crowds_is_brute_force(spark, k):
    rng = random.Random(4)
    spots = [(3.45, -76.53), (60.0, 10.0), (-10.0, 179.99995), (89.9999, 5.0)]
    at = lambda spread: (lambda s: (min(90.0, s[0] + rng.uniform(-spread, spread)), (s[1] + rng.uniform(-spread, spread) + 180) % 360 - 180))(rng.choice(spots))
    right = [(j, *at(rng.choice([1e-3, 1e-5, 0.0]))) for j in range(900)]
    left = [(i, *at(rng.choice([1e-3, 1e-5, 0.0]))) for i in range(120)] + [(900, None, 1.0), (901, 3.45, None)]
    want = {}
    for i, a, b in left[:120]:
        near = sorted((metres(a, b, c, d), j) for j, c, d in right if metres(a, b, c, d) <= 90)
        want[i] = [round(d, 6) for d, _ in near[:k]]
    one, two = spark.createDataFrame(left, "i int, lat double, lon double"), spark.createDataFrame([*right, (999, None, 2.0)], "j int, rlat double, rlon double")
    got = {}
    for r in geo.nearest(one, two, "i", 90.0, "j", k).orderBy("i", "near_rank").collect():
        got.setdefault(r["i"], []).append(round(r["dist_m"], 6))
    assert got == {i: d for i, d in want.items() if d} and len(got) > 90


def test_nearest_in_one_crowded_cell_compares_few(spark, monkeypatch):
    """20,000 points within the radius of 1,000 places: 20 million pairs, of which a few for each place are looked at."""
    right = spark.createDataFrame([(j, 3.45 + (j * 7919 % 20011) / 20011 * 6e-4, -76.53 + (j * 104729 % 19997) / 19997 * 6e-4) for j in range(20_000)], "j long, rlat double, rlon double")
    left = spark.createDataFrame([(i, 3.45 + (i * 31 % 1009) / 1009 * 6e-4, -76.53 + (i * 17 % 997) / 997 * 6e-4) for i in range(1_000)], "i long, lat double, lon double")
    kept, keep = [], geo.written
    monkeypatch.setattr(geo, "written", lambda df, what: kept.append((what, keep(df, what))) or kept[-1][1])
    got = geo.nearest(left, right, "i", 90.0, "j", 2)
    assert got.count() == 2_000
    last = [d for what, d in kept if what == "near"][-1]
    assert last.agg(F.sum("_n")).head()[0] < 1_000 * 1_000  # points in the cells that remain


def test_few_cells_are_moved_on_the_way_down(spark, monkeypatch):
    right = spark.createDataFrame([(j, 3.45 + (j * 7919 % 20011) / 20011 * 6e-4, -76.53 + (j * 104729 % 19997) / 19997 * 6e-4) for j in range(20_000)], "j long, rlat double, rlon double")
    left = spark.createDataFrame([(i, 3.45 + (i * 31 % 1009) / 1009 * 6e-4, -76.53 + (i * 17 % 997) / 997 * 6e-4) for i in range(500)], "i long, lat double, lon double")
    near, keep = [], geo.written
    monkeypatch.setattr(geo, "written", lambda df, what: near.append(keep(df, what)) or near[-1] if what == "near" else keep(df, what))
    assert geo.nearest(left, right, "i", 90.0, "j", 2).count() == 1_000
    assert sum(d.count() for d in near[:-1]) < 500 * 3 * (len(near) - 1)  # by the cells' corners alone, about ten for each place


def test_containing_is_brute_force(spark):
    rng = random.Random(8)

    def star(x, y, r, n):
        return [(x + r * rng.uniform(0.3, 1) * math.cos(2 * math.pi * k / n), y + r * rng.uniform(0.3, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]

    shapes = [(0, [star(-76.5, 3.4, 5.0, 60), star(-76.5, 3.4, 1.0, 9)]), (1, [star(-76.5, 3.4, 0.01, 12)]), (2, [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]]), (3, [[(5.0, 5.0), (5.0, 5.0)]]), (4, [])]
    polygons = spark.createDataFrame([(p, [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for p, rings in shapes], "pos long, rings array<array<struct<x:double,y:double>>>")
    points = [(k, *c) for k, c in enumerate([(3.4 + rng.uniform(-6, 6), -76.5 + rng.uniform(-6, 6)) for _ in range(400)] + [(3.4 + rng.uniform(-0.01, 0.01), -76.5 + rng.uniform(-0.01, 0.01)) for _ in range(200)] + [(rng.choice([0.0, 10.0, 5.0, 2.5]), rng.choice([0.0, 10.0, 5.0, 7.5])) for _ in range(40)] + [(None, 1.0)])]
    pts = spark.createDataFrame(points, "id int, lat double, lon double")
    for test in (geo.covered, lambda rings, x, y: geo.in_ring(rings[0], x, y)):
        every = pts.crossJoin(polygons.where("size(rings) > 0")).where(test(F.col("rings"), F.col("lon"), F.col("lat"))).groupBy("id").agg(F.min("pos").alias("pos"))
        got = geo.containing(pts, polygons, "id", test).select("id", "pos")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, every.collect())) and got.count() > 150
    cells = {r["pos"]: r["count"] for r in geo.polygon_cells(polygons, geo.covered).groupBy("pos").count().collect()}
    assert cells[2] < 1_000 and cells[0] < 2_500 and 4 not in cells  # 10 degrees wide: a million cells of 0.01 degree
