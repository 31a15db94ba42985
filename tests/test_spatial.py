import itertools
import math
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from loamframe.functions import geometry as g
from loamframe.functions import grid
from loamframe.functions.topology import RELATIONS
from plain_relations import parse, relate
from loamframe.operators import cells, spatial
from loamframe.sources import spatial_table

SQUARE = "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0))"
HOLED = "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 3, 3 3, 3 1, 1 1))"
ELL = "POLYGON((0 0, 4 0, 4 2, 2 2, 2 4, 0 4, 0 0))"
MULTI = "MULTIPOLYGON(((0 0, 1 0, 1 1, 0 1, 0 0)), ((3 3, 4 3, 4 4, 3 4, 3 3)))"


@pytest.mark.parametrize(
    "text, kind",
    [
        (SQUARE, "POLYGON"), (HOLED, "POLYGON"), (MULTI, "MULTIPOLYGON"), ("point (1 -2.5e1)", "POINT"), ("POINT (1 2 3)", "POINT"),
        ("LINESTRING (0 0, 1 1)", "LINESTRING"), ("MULTIPOINT (1 1, 2 2)", "MULTIPOINT"), ("MULTIPOINT ((1 1), (2 2))", "MULTIPOINT"),
        ("MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))", "MULTILINESTRING"),
        ("", None), (None, None), ("null", None), ("POLYGON((0 0, 1 0, 1 1))", None), ("POLYGON((0 0, 1 0, 1 1, 0 1))", None),
        ("POLYGON((0 0, 1 x, 1 1, 0 0))", None), ("POLYGON((0 0, 1 0, 1 1, 0 0)", None), ("POLYGON((0 0, 1 0, 1 1, 0 0)(0 0, 1 0, 1 1, 0 0))", None),
        ("POLYGON(0 0, 1 0, 1 1, 0 0)", None), ("POINT (1)", None), ("POINT (1 2, 3 4)", None), ("CIRCLE (1 2)", None), ("POINT (1d 2)", None),
    ],
)
def test_outlines(spark, text, kind):
    rows = g.with_shape(spark.createDataFrame([(text,)], "wkt string"), "wkt").select("_kind").collect()
    assert [r[0] for r in rows] == ([kind] if kind else [])


def test_long_outline(spark):
    n = 4_000
    ring = [(math.cos(2 * math.pi * i / n), math.sin(2 * math.pi * i / n)) for i in range(n)]
    wkt = "POLYGON((" + ", ".join(f"{x} {y}" for x, y in ring + ring[:1]) + "))"
    polys = spark.createDataFrame([(1, wkt)], "polygonkey int, wkt string")
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 0.8, 0.8)], "point_id int, lon double, lat double")
    assert [r["point_id"] for r in spatial.point_in_polygon_join(points, polys, ["polygonkey"]).collect()] == [1]


def test_points_in_polygons(spark):
    shapes = {"square": SQUARE, "holed": HOLED, "ell": ELL, "multi": MULTI, "bad": "POLYGON((0 0, 1 0))", "huge": "POLYGON((-179 -89, 179 -89, 179 89, -179 89, -179 -89))"}
    polys = spark.createDataFrame(list(shapes.items()), "name string, wkt string")
    points = [(0, 0.5, 0.5), (1, 2.0, 2.0), (2, 3.5, 3.5), (3, 9.0, 9.0), (4, 4.0, 2.0), (5, 0.0, 0.0), (6, 1.0, 2.0), (7, None, 1.0)]
    df = spark.createDataFrame(points, "point_id int, lon double, lat double")
    found = lambda boundary: {n: sorted(r["point_id"] for r in rows if r["name"] == n) for rows in [spatial.point_in_polygon_join(df, polys, ["name"], boundary).collect()] for n in shapes}
    assert found(False) == {"square": [0, 1, 2, 6], "holed": [0, 2], "ell": [0, 6], "multi": [0, 2], "bad": [], "huge": [0, 1, 2, 3, 4, 5, 6]}
    assert found(True) == {"square": [0, 1, 2, 4, 5, 6], "holed": [0, 2, 4, 5, 6], "ell": [0, 1, 4, 5, 6], "multi": [0, 2, 5], "bad": [], "huge": [0, 1, 2, 3, 4, 5, 6]}


CASES = {  # shape a against SQUARE: relations that hold
    "equal": (SQUARE, {"intersects", "contains", "within"}),
    "inside": ("POLYGON((1 1, 2 1, 2 2, 1 2, 1 1))", {"intersects", "within"}),
    "inside, sharing an edge": ("POLYGON((0 1, 2 1, 2 2, 0 2, 0 1))", {"intersects", "within"}),
    "around": ("POLYGON((-1 -1, 5 -1, 5 5, -1 5, -1 -1))", {"intersects", "contains"}),
    "overlapping": ("POLYGON((2 2, 6 2, 6 6, 2 6, 2 2))", {"intersects", "overlaps"}),
    "edge": ("POLYGON((4 0, 6 0, 6 4, 4 4, 4 0))", {"intersects", "touches"}),
    "corner": ("POLYGON((4 4, 6 4, 5 6, 4 4))", {"intersects", "touches"}),
    "apart": ("POLYGON((9 9, 10 9, 10 10, 9 9))", set()),
    "in its hole": (HOLED, {"intersects", "within"}),
    "line across": ("LINESTRING(-1 2, 5 2)", {"intersects", "crosses"}),
    "line inside": ("LINESTRING(1 1, 2 3)", {"intersects", "within"}),
    "line along the edge": ("LINESTRING(0 0, 4 0)", {"intersects", "touches"}),
    "point inside": ("POINT(2 2)", {"intersects", "within"}),
    "point on the edge": ("POINT(4 2)", {"intersects", "touches"}),
    "points in and out": ("MULTIPOINT(2 2, 9 9)", {"intersects", "crosses"}),
}


@pytest.mark.parametrize("name", CASES)
def test_relations(name):
    wkt, expected = CASES[name]
    assert {r for r in RELATIONS if relate(parse(wkt), parse(SQUARE), r)} == expected
    mirrored = {"contains": "within", "within": "contains"}
    assert {mirrored.get(r, r) for r in RELATIONS if relate(parse(SQUARE), parse(wkt), r)} == expected


def test_relations_of_lines_and_holes():
    holds = lambda a, b: {r for r in RELATIONS if relate(parse(a), parse(b), r)}
    assert holds("LINESTRING(0 0, 2 2)", "LINESTRING(0 2, 2 0)") == {"intersects", "crosses"}
    assert holds("LINESTRING(0 0, 2 0)", "LINESTRING(1 0, 3 0)") == {"intersects", "overlaps"}
    assert holds("LINESTRING(0 0, 1 0)", "LINESTRING(1 0, 2 5)") == {"intersects", "touches"}
    assert holds("POLYGON((1 1, 3 1, 3 3, 1 3, 1 1))", HOLED) == {"intersects", "touches"}
    assert holds("POLYGON((1.5 1.5, 2 1.5, 2 2, 1.5 1.5))", HOLED) == set()


def test_spatial_filter_and_query(spark):
    polys = spark.createDataFrame([(n, w) for n, (w, _) in CASES.items()] + [("bad", "POLYGON((1 1))")], "name string, wkt string")
    for relation in RELATIONS:
        found = {r["name"] for r in spatial.spatial_filter(polys, SQUARE, relation).collect()}
        assert found == {n for n, (_, holds) in CASES.items() if relation in holds}, relation
    assert spatial.spatial_filter(polys, SQUARE, "no such relation").count() == spatial.spatial_filter(polys, SQUARE).count()
    with pytest.raises(ValueError):
        spatial.spatial_query(polys, SQUARE, "mapunit")


def test_box_on_columns_agrees_with_exact_relation(spark):
    random.seed(3)
    shapes = [(i, f"POLYGON(({x} {y}, {x + w} {y}, {x + w} {y + h}, {x} {y}))") for i in range(300) for x, y, w, h in [(random.randint(-8, 8), random.randint(-8, 8), random.randint(1, 9), random.randint(1, 9))]]
    polys = spark.createDataFrame(shapes, "polygonkey int, wkt string")
    box = (-1.0, -2.0, 3.0, 2.0)
    found = {r["polygonkey"] for r in spatial.polygons_in_bbox(polys, box).collect()}
    target = parse(spatial.box_wkt(box))
    assert found == {i for i, w in shapes if relate(parse(w), target, "intersects")}


def test_area_of_a_degree_cell(spark):
    polys = spark.createDataFrame([(1, "POLYGON((0 0, 1 0, 1 1, 0 1, 0 0))"), (2, "POLYGON((0 0, 0 1, 1 1, 1 0, 0 0), (0.25 0.25, 0.75 0.25, 0.75 0.75, 0.25 0.75, 0.25 0.25))")], "polygonkey int, wkt string")
    size = {r["polygonkey"]: r for r in spatial.polygon_area_length(polys).collect()}
    assert size[1]["shape_area"] == pytest.approx(12308.78e6, rel=1e-4)  # one degree cell of the ellipsoid at the equator
    assert size[2]["shape_area"] == pytest.approx(size[1]["shape_area"] * 0.75, rel=1e-4)
    assert size[1]["shape_length"] == pytest.approx(4 * 111.2e3, rel=0.006)


def test_detect_geometry():
    assert spatial.detect_geometry(["a", "MUPOLYGONGEO", "geometry"]) == ("MUPOLYGONGEO", "EPSG:4326")
    assert spatial.detect_geometry(["geometry", "mulineproj"]) == ("geometry", "EPSG:4326")
    assert spatial.detect_geometry(["mulineproj"]) == ("mulineproj", "EPSG:3857")
    assert spatial.detect_geometry(["a"]) == ("", "EPSG:4326")


def haversine(a, b):
    (la, lo), (lb, lp) = (map(math.radians, a), map(math.radians, b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6371 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


@pytest.mark.parametrize("max_km, k", [(100, 10), (800, 3), (30, 1), (5000, 2)])
def test_nearest_against_brute_force(spark, max_km, k):
    random.seed(max_km)
    anywhere = lambda: (random.uniform(-90, 90), random.uniform(-180, 180))
    crowd = lambda: (45 + random.uniform(-0.3, 0.3), 179.9 + random.uniform(-0.3, 0.0999))
    corners = [(89.9, 10.0), (89.9, -170.0), (-89.99, 0.0), (90.0, 0.0), (0.0, 180.0), (0.0, -180.0), (45.0, -179.95)]
    # A third of the stations in one crowd, a third on one spot.
    where = [anywhere() for _ in range(200)] + [crowd() for _ in range(200)] + [(45.0, 179.9)] * 200 + corners
    stations = [(f"s{i:04d}", *p) for i, p in enumerate(where)]
    sites = [(i, *p) for i, p in enumerate([anywhere() for _ in range(60)] + [crowd() for _ in range(60)] + corners)]
    a = spark.createDataFrame(sites, "site_id int, latitude double, longitude double")
    b = spark.createDataFrame(stations, "station_triplet string, latitude double, longitude double").withColumn("network_code", F.lit("X"))
    found = {}
    for r in spatial.nearest_stations(a, b, max_km, k, ["X"]).collect():
        found.setdefault(r["site_id"], {})[r["rank"]] = (round(r["distance_km"], 6), r["station_triplet"])
    for site, *at in sites:
        best = sorted((haversine(at, p), s) for s, *p in stations)
        expected = [round(d, 6) for d, _ in itertools.islice((x for x in best if x[0] <= max_km), k)]
        mine = [found.get(site, {})[i][0] for i in sorted(found.get(site, {}))]
        assert mine == pytest.approx(expected, abs=1e-5), site


def test_two_stations_ascending(spark):
    stations = spark.createDataFrame([("1001:CA:SCAN", 37.0, -120.0), ("1002:CA:SCAN", 38.0, -121.0)], "station_triplet string, latitude double, longitude double")
    sites = spark.createDataFrame([(1, 37.5, -120.5), (2, 95.0, 0.0)], "site_id int, latitude double, longitude double")
    rows = spatial.nearest_stations(sites, stations, 100).orderBy("rank").collect()
    assert len(rows) == 2 and rows[0]["distance_km"] <= rows[1]["distance_km"]


def test_sites_on_one_spot_are_searched_for_once(spark):
    spot, apart = (40.0, -100.0), (40.5, -100.0)
    sites = [(n, *spot) for n in range(300)] + [(7, *apart), (1000, *apart), (None, *apart), (1001, None, 1.0)]
    stations = [(f"s{n}", 40.0 + n / 100, -100.0, "X") for n in range(60)]
    a = spark.createDataFrame(sites, "site_id int, latitude double, longitude double").coalesce(1)
    b = spark.createDataFrame(stations, "station_triplet string, latitude double, longitude double, network_code string").coalesce(1)
    near = spatial.nearest_stations(a, b, 100, 2)
    # The pairs are dealt over all tasks, however few the sites came in.
    assert "REPARTITION_BY_NUM" in near._jdf.queryExecution().executedPlan().toString()
    found = {}
    for r in near.collect():
        found.setdefault(r["site_id"], []).append((r["rank"], r["station_triplet"], r["latitude"]))
    assert len(found) == 302
    assert sorted(found[3]) == [(1, "s0", 40.0), (2, "s1", 40.0)]
    # One site at two spots has one ranking.
    assert [r[0] for r in sorted(found[7])] == [1, 2] and {r[1] for r in found[7]} == {"s0", "s50"}
    assert {r[1] for r in found[1000]} == {"s50", "s49"} or {r[1] for r in found[1000]} == {"s50", "s51"}
    assert sorted(found[None]) == sorted(found[1000])


def test_bound_on_the_distance_within_a_cell(spark):
    """It holds for all corners of a cell and is hardly more than its diagonal."""
    for size in (5.0, 60.0, 900.0):
        for at in (-89.0, -45.3, 0.0, 30.2, 62.0, 89.5):
            row = spark.range(1).select(F.lit(at).alias("lat"), F.lit(size).alias("size"))
            band = grid.band(F.col("lat"), F.col("size"))
            n = grid.band_cells(band, F.col("size"))
            b, n, bound = row.select(band, n, grid.cell_span_km(band, n, F.col("size"))).first()
            height = size / grid.KM_PER_DEGREE
            edges = [max(-90.0, b * height - 90), min(90.0, (b + 1) * height - 90)]
            far = max(haversine((p, 0.0), (q, min(180.0, 360.0 / n))) for p in edges for q in edges)
            assert far <= bound
            assert abs(at) > 70 or size > 100 or bound <= 1.6 * size


def test_relations_agree_with_a_plain_version(spark):
    rng = random.Random(8)
    at = lambda: f"{rng.randrange(7)} {rng.randrange(7)}"

    def shape():
        kind = rng.randrange(4)
        if kind == 0:
            return f"POINT({at()})"
        if kind == 1:
            return "LINESTRING(" + ", ".join(at() for _ in range(rng.randint(2, 4))) + ")"
        if kind == 2:
            return f"MULTIPOINT({at()}, {at()})"
        x, y, w, h = rng.randrange(5), rng.randrange(5), rng.randint(1, 3), rng.randint(1, 3)
        return f"POLYGON(({x} {y}, {x + w} {y}, {x + w} {y + h}, {x} {y + h}, {x} {y}))"

    shapes = [(n, shape()) for n in range(60)]
    frame = spark.createDataFrame(shapes, "n long, wkt string").coalesce(1)
    for query in ["POLYGON((1 1, 5 1, 5 5, 1 5, 1 1), (2 2, 4 2, 4 4, 2 4, 2 2))", "LINESTRING(0 0, 3 3, 6 0)", "POINT(3 3)", "MULTIPOINT(1 2, 5 5)"]:
        found = {(r["n"], x) for r in spatial.spatial_relations(frame, query).collect() for x in r["relations"]}
        assert found == {(n, x) for n, text in shapes for x in RELATIONS if relate(parse(text), parse(query), x)}, query


def _star(rng, x, y, n, size):
    points = [(x + size * (0.3 + rng.random()) * math.cos(2 * math.pi * i / n), y + size * (0.3 + rng.random()) * math.sin(2 * math.pi * i / n)) for i in range(n)]
    return "POLYGON((" + ", ".join(f"{a!r} {b!r}" for a, b in points + points[:1]) + "))"


def _holds(wkt, x, y):
    """Even-odd rule over all rings, in plain Python."""
    odd = False
    for ring in g.read_outline(wkt)[1]:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


def _distance(wkt, x, y):
    best = math.inf
    for ring in g.read_outline(wkt)[1]:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            d = (x2 - x1) ** 2 + (y2 - y1) ** 2
            t = max(0, min(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / d)) if d else 0
            best = min(best, math.hypot(x - x1 - t * (x2 - x1), y - y1 - t * (y2 - y1)))
    return best


def test_cells_of_long_outlines_agree_with_brute_force(spark):
    rng = random.Random(4)
    shapes = [(0, _star(rng, 0, 0, 700, 60)), (1, _star(rng, 10, 20, 5, 100)), (2, _star(rng, 40, 40, 300, 0.5)), (3, HOLED), (4, "POLYGON((-170 -80, 170 -80, 170 80, -170 80, -170 -80))")]
    points = [(i, rng.uniform(-120, 120), rng.uniform(-80, 80)) for i in range(600)] + [(600 + i, 40 + rng.uniform(-1, 1), 40 + rng.uniform(-1, 1)) for i in range(300)]
    points += [(900 + i, float(x), float(y)) for i, (x, y) in enumerate(itertools.product(range(-1, 6), range(-1, 6)))]
    polys = spark.createDataFrame(shapes, "key int, wkt string")
    where = spark.createDataFrame(points, "point_id int, lon double, lat double")
    made = cells.polygon_cells(g.with_shape(polys, "wkt"), ["key"])
    assert made.agg(F.max(F.size("_edges"))).first()[0] <= cells.MOST_EDGES
    assert made.where("key = 4 and size(_edges) = 0").count() > 100  # cells that are inside as a whole
    found = {(r["point_id"], r["key"]) for r in spatial.point_in_polygon_join(where, polys, ["key"], boundary=True).collect()}
    on = {(p, k) for p, x, y in points for k, w in shapes if _distance(w, x, y) == 0}
    assert found == {(p, k) for p, x, y in points for k, w in shapes if _holds(w, x, y)} | on
    strict = {(r["point_id"], r["key"]) for r in spatial.point_in_polygon_join(where, polys, ["key"]).collect()}
    assert strict == found - on
    for distance in (0.4, 7.0):
        near = {(r["point_id"], r["key"]) for r in spatial.polys_within_distance(where, polys, distance, ["key"]).collect()}
        assert near == {(p, k) for p, x, y in points for k, w in shapes if _holds(w, x, y) or _distance(w, x, y) <= distance}, distance


def test_cells_in_metres_and_of_no_table(spark):
    polys = spark.createDataFrame([(1, "POLYGON((0 0, 4000000 0, 4000000 3000000, 0 3000000, 0 0))"), (2, None)], "key int, wkt string")
    where = spark.createDataFrame([(1, 5.0, 5.0), (2, 3999999.0, 2999999.0), (3, -1.0, 5.0), (4, None, 5.0)], "point_id int, lon double, lat double")
    assert {r["point_id"] for r in spatial.point_in_polygon_join(where, polys, ["key"]).collect()} == {1, 2}
    assert cells.polygon_cells(g.with_shape(polys, "wkt"), ["key"]).count() < 3000
    assert spatial.point_in_polygon_join(where, polys.limit(0), ["key"]).count() == 0
    assert spatial.point_in_polygon_join(where.limit(0), polys, ["key"]).count() == 0


def test_crowded_cell_is_split(spark):
    polys = spark.createDataFrame([(k, SQUARE) for k in range(40)], "key int, wkt string")
    where = spark.range(20_000).selectExpr("id AS point_id", "IF(id % 3 = 0, 1.5D, id % 9) AS lon", "IF(id % 3 = 0, 1.5D, id % 7) AS lat")
    inside = where.where("lon > 0 and lon < 4 and lat > 0 and lat < 4").count()
    assert spatial.point_in_polygon_join(where, polys, ["key"]).count() == 40 * inside


def test_points_of_one_spot_are_tested_once(spark, monkeypatch):
    """The pairs to test do not grow with the points at a spot; all points get their rows."""
    tested, look_up = [], cells.look_up

    def counted(points, *rest):
        tested.append(points.count())
        return look_up(points, *rest)

    monkeypatch.setattr(cells, "look_up", counted)
    polys = spark.createDataFrame([(1, 10, SQUARE), (2, 20, HOLED), (3, 10, ELL)], "polygonkey int, mukey int, wkt string")
    spots = [(0.5, 0.5), (2.0, 2.0), (3.5, 3.5), (4.1, 2.0), (-0.0, 0.0), (0.0, -0.0), (9.0, 9.0)]
    where = [(7 * n + i, *spot) for n in range(50) for i, spot in enumerate(spots)]
    points = spark.createDataFrame(where + [(0, 3.5, 3.5), (None, 0.5, 0.5), (None, 2.0, 2.0), (999, None, 0.5)], "point_id int, lon double, lat double")
    inside = {0: {1, 2, 3}, 1: {1}, 2: {1, 2}, 3: set(), 4: set(), 5: set(), 6: set()}
    touching = {0: {1, 2, 3}, 1: {1, 3}, 2: {1, 2}, 3: set(), 4: {1, 2, 3}, 5: {1, 2, 3}, 6: set()}
    for boundary, expected in ((False, inside), (True, touching)):
        rows = spatial.point_in_polygon_join(points, polys, ["polygonkey"], boundary).collect()
        assert [r.asDict().keys() for r in rows[:1]] == [{"point_id": 0, "lon": 0, "lat": 0, "polygonkey": 0}.keys()]
        both = sorted([(7 * n + i, k) for n in range(50) for i in range(7) for k in expected[i]] + [(0, k) for k in expected[2]])
        assert sorted((r["point_id"], r["polygonkey"]) for r in rows if r["point_id"] is not None) == both
        assert sum(r["point_id"] is None for r in rows) == len(expected[0]) + len(expected[1])
    near = spatial.polys_within_distance(points, polys, 0.2, ["polygonkey"]).where("point_id is not null")
    assert near.groupBy((F.col("point_id") % 7).alias("i")).count().where("i = 3").first()["count"] == 150
    areas = {r["point_id"]: r["n_polygons"] for r in spatial.region_area(points, polys, 0.2, ["point_id"]).collect()}
    assert areas[7] == 3 and areas[0] == 5 and areas[10] == 3 and 999 not in areas and 6 not in areas
    units = spark.createDataFrame([(10, "a"), (20, "b"), (30, "c")], "mukey int, muname string")
    links, hit = spatial.mapunits_at_points(points, polys, units)
    pairs = sorted(links.where("point_id is not null").collect())
    assert len(pairs) == len(set(pairs)) and {k for p, k in pairs if p == 0} == {10, 20} and [k for p, k in pairs if p == 8] == [10]
    assert sorted(r["mukey"] for r in links.where("point_id is null").collect()) == [10, 20]
    assert {r["mukey"] for r in hit.collect()} == {10, 20}
    assert set(tested) == {6}  # both zeros are one spot


def test_spatial_table_skips_what_lies_elsewhere(spark, tmp_path):
    rng = random.Random(6)
    shapes = [(i, f"POLYGON(({x} {y}, {x + 1} {y}, {x + 1} {y + 1}, {x} {y}))") for i in range(4000) for x, y in [(rng.randrange(-170, 170), rng.randrange(-80, 80))]]
    df = spark.createDataFrame(shapes + [(-1, "POLYGON((1"), (-2, None)], "polygonkey int, wkt string")
    path = str(tmp_path / "shapes")
    spatial_table.write_spatial_table(df, "wkt", path)
    table = spark.read.parquet(path)
    assert table.count() == len(shapes) and set(g.SHAPE_COLUMNS) <= set(table.columns)
    found = spatial.polygons_in_bbox(table, (10.5, 10.5, 30.5, 30.5))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("]")[0]
    assert all(f"({c}," in pushed for c in ("_xmin", "_xmax", "_ymin", "_ymax")) and "Generate" not in plan
    assert {r["polygonkey"] for r in found.collect()} == {r["polygonkey"] for r in spatial.polygons_in_bbox(df, (10.5, 10.5, 30.5, 30.5)).collect()}
    # Files cover little each: most have nothing to do with a small box.
    boxes = table.groupBy(F.input_file_name()).agg(F.min("_xmin"), F.max("_xmax"), F.min("_ymin"), F.max("_ymax")).collect()
    assert sum(b[1] <= 30.5 and b[2] >= 10.5 and b[3] <= 30.5 and b[4] >= 10.5 for b in boxes) <= len(boxes) / 2
    spatial_table.write_spatial_table(df.limit(0), "wkt", str(tmp_path / "none"))
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0


def test_map_units_at_points_are_nested_once(spark):
    square = lambda x: f"POLYGON(({x} 0, {x + 1} 0, {x + 1} 1, {x} 1, {x} 0))"
    polys = spark.createDataFrame([("u1", square(0)), ("u2", square(1)), ("u3", square(5)), ("u1", square(8))], "mukey string, wkt string")
    points = spark.createDataFrame([(n, 0.1 + n / 100, 0.5) for n in range(20)] + [(90, 1.0, 0.5), (91, 3.0, 3.0), (92, 8.5, 0.5)], "point_id int, lon double, lat double")
    mapunit = spark.createDataFrame([("u1", "one"), ("u2", "two"), ("u3", "three")], "mukey string, muname string")
    component = spark.createDataFrame([("c1", "u1", "A", 60, "Yes"), ("c2", "u1", "B", 40, "No"), ("c3", "u3", "C", 9, "Yes")], "cokey string, mukey string, compname string, comppct_r int, majcompflag string")
    links, units = spatial.mapunits_at_points(points, polys, mapunit, component)
    assert sorted(map(tuple, links.collect())) == sorted([(n, "u1") for n in range(20)] + [(90, "u1"), (90, "u2"), (92, "u1")])
    assert sorted(((x["mukey"], x["component_key"]) for x in units.collect()), key=str) == [("u1", "c1"), ("u1", "c2"), ("u2", None)]


def test_plain_points_take_the_short_way(spark):
    """points in the usual spelling are read without the steps for outlines, with the same result."""
    plain = ["POINT (1 2)", "point(-1.5 +2.25)", " Point ( 10.125 -49 ) "]
    other = ["POINT (1 2 3)", "POINT (1e3 2)", "POINT (.5 2.)", "POINT  (1  2)", "POINT (1)", "POINT (1 2, 3 4)", "POINT (1 2))", "POINT ((1 2))", "MULTIPOINT (1 2)", "SPOINT (1 2)", "", None]
    df = spark.createDataFrame([(t,) for t in plain + other], "wkt string")
    short = {r["wkt"]: r["s"] for r in df.select("wkt", g._plain_point(F.col("wkt")).alias("s")).collect()}
    assert [t for t in plain + other if short[t]] == plain
    whole = {r["wkt"]: r for r in g.with_shape(df, "wkt").collect()}
    general = {r["wkt"]: r["r"] for r in df.select("wkt", g.parse_rings(F.col("wkt")).alias("r")).collect()}
    assert {t: r["_rings"] for t, r in whole.items()} == {t: r for t, r in general.items() if r}
    for t in plain:
        (p,), box = general[t][0], whole[t]
        assert (box["_kind"], box["_xmin"], box["_ymin"], box["_xmax"], box["_ymax"]) == ("POINT", p["x"], p["y"], p["x"], p["y"])


def top_join(df) -> str:
    """The join next to the result, as it ran."""
    df.collect()
    return next(line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line)


@pytest.mark.parametrize("together", [1024, 3])
def test_pairs_of_points_and_polygons_are_not_dealt(spark, monkeypatch, together):
    """a spot's points are taken apart where they meet a polygon; the join
    with the cells comes last, so pairs are not shuffled, and no row holds a whole spot."""
    monkeypatch.setattr(spatial, "TOGETHER", together)
    polys = spark.createDataFrame([(n, 10 + n % 2, shape) for n, shape in enumerate([SQUARE, HOLED, ELL, SQUARE])], "polygonkey int, mukey int, wkt string")
    spots = [(0.5, 0.5), (2.0, 2.0), (9.0, 9.0), (-0.0, 0.0)]
    points = spark.createDataFrame([(n, *spots[0 if n < 40 else n % 4]) for n in range(60)] + [(0, 0.5, 0.5), (None, 2.0, 2.0), (61, None, 1.0)], "point_id int, lon double, lat double")
    sizes, look_up = [], cells.look_up

    def seen(found, *rest):
        sizes.extend(r[0] for r in found.select(F.size("_points")).collect())
        return look_up(found, *rest)

    monkeypatch.setattr(cells, "look_up", seen)
    for run in (
        lambda p: spatial.point_in_polygon_join(p, polys, ["polygonkey"]), lambda p: spatial.point_in_polygon_join(p, polys, ["polygonkey"], boundary=True),
        lambda p: spatial.polys_within_distance(p, polys, 0.2, ["polygonkey"]),
    ):
        rows = run(points)
        assert "_cx" in top_join(rows) and rows.columns == ["point_id", "lon", "lat", "polygonkey"]
        one = {(r["lon"], r["lat"]): set() for r in points.collect()}
        for r in run(points.select(F.lit(1).alias("point_id"), "lon", "lat").distinct()).collect():
            one[(r["lon"], r["lat"])].add(r["polygonkey"])
        expected = [(p["point_id"], p["lon"], p["lat"], k) for p in points.collect() for k in one[(p["lon"], p["lat"])]]
        assert sorted(map(str, rows.collect())) == sorted(str(Row(point_id=a, lon=b, lat=c, polygonkey=d)) for a, b, c, d in expected) and expected
    assert sum(sizes) >= 3 * 62 and max(sizes) <= (62 if together == 1024 else 12)


def test_unit_rows_go_with_the_cells(spark, monkeypatch):
    """rows of units join points where these meet a polygon, not by a join of links."""
    monkeypatch.setattr(spatial, "TOGETHER", 2)
    square = lambda x: f"POLYGON(({x} 0, {x + 1} 0, {x + 1} 1, {x} 1, {x} 0))"
    plain = [("u1", square(0)), ("u2", square(1)), ("u3", square(5)), ("u4", square(0.5))]
    still = [(n, 0.1 + n % 3 / 4, 0.5) for n in range(20)] + [(90, 1.0, 0.5), (91, 3.0, 3.0), (92, 5.5, 0.5), (93, None, 0.5), (94, -0.0, 0.0)]
    rows = spark.createDataFrame([(f"u{n % 3 + 1}", n) for n in range(12)] + [("u4", None), (None, 7), ("u9", 8)], "mukey string, value int")
    frame = lambda polys, points: (spark.createDataFrame(points, "point_id int, lon double, lat double"), spark.createDataFrame(polys, "mukey string, wkt string"))
    several = [*plain, ("u1", square(0.25)), ("u3", square(8)), (None, square(0))]
    moving = [*still, (90, 1.0, 0.5), (90, 0.5, 0.5), (None, 0.5, 0.5), (None, 5.5, 0.5)]
    for polys, points in ((plain, still), (several, moving)):
        where, shapes = frame(polys, points)
        found = spatial.unit_rows_at_points(where, shapes, rows)
        links = spatial.mapunits_at_points(where, shapes, rows.select("mukey").distinct())[0]
        pairs = links.collect()
        plainly = {(r["point_id"], r["mukey"]) for r in spatial.point_in_polygon_join(where, shapes, ["mukey"], boundary=True).collect()}
        assert len(pairs) == len(plainly) and set(map(tuple, pairs)) == plainly
        expected = [(p, k, v) for p, k in plainly for u, v in rows.collect() if k is not None and u == k]
        assert found.columns == ["point_id", "mukey", "value"] and sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
        if polys is plain and points is still:
            assert "_cx" in top_join(found)
    where, shapes = frame(several, moving)
    mapunit = spark.createDataFrame([(f"u{n}", f"s{n}", f"n{n}") for n in range(1, 5)], "mukey string, musym string, muname string")
    component = spark.createDataFrame([(n, f"u{n % 4 + 1}", "c", 10.0 * n, "Yes" if n % 3 else "No") for n in range(12)], "cokey int, mukey string, compname string, comppct_r double, majcompflag string")
    horizon = spark.createDataFrame([(n % 12, n, "A", 1.0 * n, 2.0 * n, 1.0, 2.0, 3.0) for n in range(40)], "cokey int, chkey int, hzname string, hzdept_r double, hzdepb_r double, sandtotal_r double, silttotal_r double, claytotal_r double")
    found = spatial.components_at_points(where, shapes, mapunit, component, horizon)
    hits = spatial.point_in_polygon_join(where, shapes, ["mukey"])
    expected = hits.join(mapunit.join(component.where("majcompflag = 'Yes'").drop("majcompflag"), "mukey").join(horizon, "cokey"), "mukey").select(*found.columns)
    assert "_cx" in top_join(found) and found.columns[:4] == ["mukey", "point_id", "lon", "lat"]
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
