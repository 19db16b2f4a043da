import random
from datetime import datetime

import numpy as np

import pytest

from wayfare.operators import stations


@pytest.mark.parametrize("seed, span", [(1, 0.2), (2, 0.01), (3, 3.0)])
def test_near_matches_equal_the_nested_loop(spark, seed, span):
    """Clusters tighter and wider than the radius, negative coordinates, repeated places."""
    rng = random.Random(seed)
    radius = 0.05

    def place():
        return (rng.uniform(-span, span), rng.uniform(-span, span))

    seekers = [place() for _ in range(150)] + [(0.0, 0.0)] * 5
    targets = [(f"N{i:03d}", *place()) for i in range(150)] + [("A", 0.0, 0.0), ("B", 0.0, 0.0), ("C", radius, 0.0)]
    left = spark.createDataFrame(seekers, "latitude double, longtitude double")
    right = spark.createDataFrame(targets, "new_id string, new_latitude double, new_longtitude double")
    expected = {}
    for lat, lng in seekers:
        near = [t for t in targets if abs(lat - t[1]) < radius and abs(lng - t[2]) < radius]
        if near:
            expected[(lat, lng)] = min(near)
    got = {(r[0], r[1]): tuple(r)[2:] for r in stations.near_matches(left, right, radius).collect()}
    assert got == expected


def test_near_matches_at_a_real_coordinate(spark):
    left = spark.createDataFrame([(40.7, -73.9)], "latitude double, longtitude double")
    rows = [("far", 40.7 + 0.000006, -73.9), ("near", 40.7 + 0.000004, -73.9 - 0.000004)]
    right = spark.createDataFrame(rows, "new_id string, new_latitude double, new_longtitude double")
    assert [r["new_id"] for r in stations.near_matches(left, right).collect()] == ["near"]


def test_a_hot_cell_is_one_row(spark):
    """Most stations of both sides within one cell: no pairs of them are built."""
    n = 3000
    left = spark.range(n).selectExpr("id * 1e-9 AS latitude", "0.0D AS longtitude")
    right = spark.range(n).selectExpr(
        "concat('N', lpad(id, 5, '0')) AS new_id", "id * 1e-9 AS new_latitude", "0.0D AS new_longtitude"
    )
    got = stations.near_matches(left, right, radius=0.05)
    assert got.count() == n and {r["new_id"] for r in got.collect()} == {"N00000"}


def test_earliest_sighting_wins(spark):
    t = datetime
    rows = [
        (t(2020, 7, 1, 9), 1, "late", 1.0, 1.0, 2, "B", 2.0, 2.0),
        (t(2020, 7, 1, 8), 3, "C", 3.0, 3.0, 1, "early", 1.5, 1.5),
        (t(2020, 7, 1, 7), 4, "start", 4.0, 4.0, 4, "end", 4.0, 4.0),
    ]
    rides = spark.createDataFrame(
        rows, "at timestamp, a int, an string, ay double, ax double, b int, bn string, by double, bx double"
    )
    dims = stations.station_dimension(rides, ["a", "an", "ay", "ax"], ["b", "bn", "by", "bx"], "at")
    names = {r["id"]: (r["name"], r["latitude"]) for r in dims.collect()}
    assert names == {1: ("early", 1.5), 2: ("B", 2.0), 3: ("C", 3.0), 4: ("start", 4.0)}


def _ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


ZONES = [
    (5, _ring((0, 0), (4, 0), (4, 4), (0, 4))),
    (5, _ring((1, 1), (2, 1), (2, 2), (1, 2))),  # a hole
    (7, _ring((6, 0), (10, 0), (8, 2), (10, 4), (6, 4))),  # not convex
    (9, _ring((3, 3), (7, 3), (7, 7), (3, 7), (3, 3))),  # closed, overlaps 5 and 7
]


def test_zones_with_holes_and_overlaps(spark):
    zones = spark.createDataFrame(ZONES, "zone_id int, ring array<struct<x:double,y:double>>")
    points = [
        ("hole", 1.5, 1.5, None),
        ("ring", 0.5, 0.5, 5),
        ("notch", 9.5, 2.0, None),
        ("arm", 9.0, 0.5, 7),
        ("lowest", 3.5, 3.5, 5),
        ("second", 6.5, 3.5, 7),
        ("only", 5.0, 5.0, 9),
        ("outside", 50.0, 50.0, None),
        ("negative", -0.5, 1.0, None),
    ]
    df = spark.createDataFrame(points, "name string, x double, y double, expected int")
    for cell in (0.7, 3.0, 100.0):
        rows = stations.with_zone(df, zones, "x", "y", cell=cell).collect()
        assert len(rows) == len(points)
        assert [r["name"] for r in rows if r["zone_id"] != r["expected"]] == []


def test_shared_edges_belong_to_one_zone(spark):
    squares = [(1, _ring((0, 0), (1, 0), (1, 1), (0, 1))), (2, _ring((1, 0), (2, 0), (2, 1), (1, 1)))]
    zones = spark.createDataFrame(squares, "zone_id int, ring array<struct<x:double,y:double>>")
    df = spark.createDataFrame([(1.0, 0.5), (0.0, 0.5), (2.0, 0.5), (0.5, 0.0), (0.5, 1.0)], "x double, y double")
    got = [r["zone_id"] for r in stations.with_zone(df, zones, "x", "y", cell=0.4).collect()]
    # Left and lower edges belong to a zone, right and upper ones do not.
    assert got == [2, 1, None, 1, None]


def test_station_zones_drops_stations_outside(spark):
    zones = spark.createDataFrame(ZONES[:1], "zone_id int, ring array<struct<x:double,y:double>>")
    rides = spark.createDataFrame(
        [(datetime(2020, 7, 1), 1, "in", 1.0, 1.0, 2, "out", 90.0, 90.0)],
        "at timestamp, a int, an string, ay double, ax double, b int, bn string, by double, bx double",
    )
    got = stations.station_zones(rides, zones, ["a", "an", "ay", "ax"], ["b", "bn", "by", "bx"], "at")
    assert [(r["id"], r["Taxi area code"]) for r in got.collect()] == [(1, 5)]


def test_match_by_name_then_by_place(spark):
    old = spark.createDataFrame(
        [(1, "A", 1.0, 1.0), (2, "B", 2.0, 2.0), (3, "C", 3.0, 3.0), (4, "A", 9.0, 9.0)],
        "id int, name string, latitude double, longtitude double",
    )
    new = spark.createDataFrame(
        [("N9", "A", 1.1, 1.1), ("N1", "A", 1.2, 1.2), ("N2", "renamed", 2.000001, 2.0)],
        "new_id string, name string, new_latitude double, new_longtitude double",
    )
    matched = {r["id"]: r["new_id"] for r in stations.match_stations(old, new).collect()}
    assert matched == {1: "N1", 4: "N1", 2: "N2"}


def _plain_zone(zones, x, y):
    """The lowest zone whose edges a ray to the right of the point crosses oddly."""
    odd = {}
    for zone, ring in zones:
        points = [(p["x"], p["y"]) for p in ring]
        for (ax, ay), (bx, by) in zip(points, points[1:] + points[:1]):
            if (ay > y) != (by > y) and x < ax + (y - ay) / (by - ay) * (bx - ax):
                odd[zone] = not odd.get(zone, False)
    return min((zone for zone, held in odd.items() if held), default=None)


_POINTS = "x double, y double"
_RINGS = "zone_id int, ring array<struct<x:double,y:double>>"


def _agrees(spark, zones, points, **settings):
    df = spark.createDataFrame(points, _POINTS)
    found = stations.with_zone(df, spark.createDataFrame(zones, _RINGS), "x", "y", **settings).collect()
    assert len(found) == len(points)
    wrong = [tuple(r) for r in found if r["zone_id"] != _plain_zone(zones, r["x"], r["y"])]
    assert wrong == []
    return found


@pytest.mark.parametrize("seed, most", [(1, 64), (2, 3), (4, 6)])
def test_random_rings_equal_all_edges(spark, seed, most):
    """Rings that cross themselves and each other, on and off the lines of the grid; points on their
    edges and corners too. Few edges are allowed in a cell, so that cells are split several times."""
    rng = random.Random(seed)

    def number():
        return rng.choice([rng.uniform(-2, 2), rng.randrange(-8, 9) / 4, rng.randrange(-6, 7) * 0.3])

    zones = [(k % 5, _ring(*[(number(), number()) for _ in range(rng.randrange(1, 14))])) for k in range(9)]
    corners = [(p["x"], p["y"]) for _, ring in zones for p in ring]
    points = [(number(), number()) for _ in range(400)] + corners
    points += [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for a, b in zip(corners, corners[1:])]
    _agrees(spark, zones, points, cell=0.3, most=most)


def test_odd_rings_and_points(spark):
    zones = [(1, _ring((0, 0))), (1, []), (2, _ring((0, 0), (0, 0), (0, 0))), (3, _ring((0, 0), (1, 1)))]
    zones += [(4, _ring((0, 0), (2, 0), (2, 2), (0, 2))), (4, _ring((0, 0), (2, 0), (2, 2), (0, 2)))]
    found = _agrees(spark, zones, [(0.5, 0.5), (0.0, 0.0), (1.5, 0.2)], cell=0.5)
    assert {r["zone_id"] for r in found} == {None}
    nothing = spark.createDataFrame([(None, 1.0), (1.0, None)], _POINTS)
    square = spark.createDataFrame([(1, _ring((0, 0), (2, 0), (2, 2), (0, 2))), (2, None)], _RINGS)
    assert [r["zone_id"] for r in stations.with_zone(nothing, square, "x", "y").collect()] == [None, None]
    empty = spark.createDataFrame([], _RINGS)
    assert [r["zone_id"] for r in stations.with_zone(nothing, empty, "x", "y").collect()] == [None, None]


def test_a_ring_of_many_points(spark):
    """A star of 100,000 points: most edges lie in a few cells, which are split."""
    n = 100_000
    angles = np.linspace(0, 2 * np.pi, n, endpoint=False)
    reach = np.where(np.arange(n) % 2 == 0, 1.0, 0.99)
    xs, ys = reach * np.cos(angles), reach * np.sin(angles)
    zones = spark.createDataFrame([(1, [(float(x), float(y)) for x, y in zip(xs, ys)])], _RINGS)
    rng = np.random.default_rng(3)
    places = rng.uniform(-1.05, 1.05, (60, 2)).tolist()
    places += [(0.995 * np.cos(t), 0.995 * np.sin(t)) for t in rng.uniform(0, 7, 300)]
    places = [(float(x), float(y)) for x, y in places]
    found = stations.with_zone(spark.createDataFrame(places, _POINTS), zones, "x", "y", cell=0.1).collect()
    ends = np.roll(xs, -1), np.roll(ys, -1)
    for r in found:
        spans = (ys > r["y"]) != (ends[1] > r["y"])
        at = xs[spans] + (r["y"] - ys[spans]) / (ends[1][spans] - ys[spans]) * (ends[0][spans] - xs[spans])
        assert (r["zone_id"] == 1) == (np.count_nonzero(r["x"] < at) % 2 == 1)
    assert len({r["zone_id"] for r in found}) == 2


def test_rings_of_any_size(spark, monkeypatch):
    """What was refused once: the edges are more bytes than a side that may be broadcast."""
    monkeypatch.setattr("wayfare.operators.sides.BROADCAST_LIMIT", 100)
    monkeypatch.setattr(stations.bounded_side, "__defaults__", (100,))
    rng = random.Random(8)
    zones = [(k, _ring(*[(rng.uniform(0, 3), rng.uniform(0, 3)) for _ in range(40)])) for k in range(6)]
    _agrees(spark, zones, [(rng.uniform(0, 3), rng.uniform(0, 3)) for _ in range(300)], cell=0.25, most=8)


@pytest.mark.parametrize("seed, most", [(1, 0), (2, 2), (3, 0)])
def test_crowded_rims_equal_the_nested_loop(spark, seed, most):
    """Points on and off a lattice whose step divides the radius, so that many lie just out of reach."""
    rng = random.Random(seed)
    radius = 0.3

    def number():
        return rng.choice([rng.uniform(0, 1.5), rng.randrange(0, 31) * 0.05, rng.randrange(-15, 16) * 0.1])

    seekers = [(number(), number()) for _ in range(150)]
    targets = [(f"N{rng.randrange(999):03d}", number(), number()) for _ in range(rng.choice([30, 250]))]
    left = spark.createDataFrame(seekers, "latitude double, longtitude double")
    right = spark.createDataFrame(targets, "new_id string, new_latitude double, new_longtitude double")
    expected = {}
    for lat, lng in seekers:
        near = [t for t in targets if abs(lat - t[1]) < radius and abs(lng - t[2]) < radius]
        if near:
            expected[(lat, lng)] = min(near)
    got = {(r[0], r[1]): tuple(r)[2:] for r in stations.near_matches(left, right, radius, most=most).collect()}
    assert got == expected


@pytest.mark.parametrize("dx, dy", [(2.4, 0.0), (-2.4, 2.4)])
def test_many_points_in_a_rim_cell_of_many_others(spark, dx, dy):
    """20,000 seekers of one cell and 20,000 points of one rim cell: 400 million pairs are not built."""
    n, radius = 20_000, 1.0
    width = radius / stations.CELLS_PER_RADIUS
    rng = np.random.default_rng(7)
    seekers = rng.uniform(0, 0.8, (n, 2)) * width
    points = (rng.uniform(0, 0.8, (n, 2)) + np.floor([dx, dy]) + 0.1) * width
    left = spark.createDataFrame(seekers.tolist(), "latitude double, longtitude double")
    right = spark.createDataFrame(
        [(k, *p) for k, p in enumerate(points.tolist())], "new_id int, new_latitude double, new_longtitude double"
    )
    got = {(r[0], r[1]): r["new_id"] for r in stations.near_matches(left, right, radius).collect()}
    for x, y in seekers[:400]:
        near = (np.abs(points[:, 0] - x) < radius) & (np.abs(points[:, 1] - y) < radius)
        assert got.get((x, y)) == (int(np.flatnonzero(near)[0]) if near.any() else None)


@pytest.mark.parametrize("parts", [1, 7])
def test_running_totals_equal_a_window(spark, parts):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from wayfare.operators.running import with_running

    rng = random.Random(parts)
    rows = [(rng.choice("aaaab"), k, rng.choice([None, rng.randrange(50)])) for k in range(500)]
    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(parts)
    got = with_running(df, ["g"], ["k"], {"total": F.col("v")}, {"low": F.col("v")})
    line = Window.partitionBy("g").orderBy("k")
    expected = df.withColumns({"total": F.coalesce(F.sum("v").over(line), F.lit(0)), "low": F.min("v").over(line)})
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert with_running(df.filter("false"), ["g"], ["k"], {"total": F.col("v")}).collect() == []


def test_furthest_number_within_a_radius():
    rng = np.random.default_rng(1)
    for radius in (0.05, 0.000005, 1.0, 3e9):
        starts = np.concatenate([rng.normal(size=200), [0.0, -0.0, radius, -radius, 2 * radius, 1e9, -74.0]])
        ends = stations.furthest_within(starts, radius)
        assert (np.abs(starts - ends) < radius).all()
        assert not (np.abs(starts - np.nextafter(ends, np.inf)) < radius).any()
