"""Spatial queries over polygons, points and survey areas."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from loamframe.functions import geometry as g
from loamframe.functions.topology import RELATIONS
from loamframe.operators import aggregates as agg
from loamframe.operators import spatial
from loamframe.operators.profiles import nest_mapunits
from loamframe.plans.registry import query, r6

# --- check SQL: outlines as edge tables, straight from the text ------------------------
EDGES = """rings AS (SELECT polygonkey, mukey, unnest(regexp_extract_all(mupolygongeo, '\\(([^()]+)\\)', 1)) AS ring FROM mupolygon),
    numbered AS (SELECT polygonkey, mukey, ring, row_number() OVER () AS ring_id FROM rings),
    pts AS (SELECT polygonkey, mukey, ring_id, unnest(string_split(ring, ',')) AS p, unnest(range(len(string_split(ring, ',')))) AS i FROM numbered),
    xy AS (SELECT polygonkey, mukey, ring_id, i, CAST(split_part(trim(p), ' ', 1) AS DOUBLE) AS x, CAST(split_part(trim(p), ' ', 2) AS DOUBLE) AS y FROM pts),
    edges AS (SELECT polygonkey, mukey, ring_id, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM xy WINDOW w AS (PARTITION BY ring_id ORDER BY i)),
    segs AS (SELECT * FROM edges WHERE x2 IS NOT NULL),
    boxes AS (SELECT polygonkey, mukey, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax FROM xy GROUP BY ALL)"""
_SIDE = "((x2 - x1) * (lat - y1) - (y2 - y1) * (lon - x1))"
_ON = f"({_SIDE} = 0 AND lon BETWEEN least(x1, x2) AND greatest(x1, x2) AND lat BETWEEN least(y1, y2) AND greatest(y1, y2))"
_RAY = "((y1 > lat) <> (y2 > lat) AND lon < x1 + (lat - y1) * (x2 - x1) / nullif(y2 - y1, 0))"
# Brute force: every point against every polygon whose box holds it.
HITS = f"""{EDGES},
    near AS (SELECT point_id, lon, lat, polygonkey FROM points JOIN boxes ON lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax),
    hits AS (SELECT point_id, lon, lat, segs.polygonkey, any_value(segs.mukey) AS mukey, bool_or({_ON}) AS on_edge, count(*) FILTER ({_RAY}) % 2 = 1 AS inside
      FROM near JOIN segs ON near.polygonkey = segs.polygonkey GROUP BY point_id, lon, lat, segs.polygonkey)"""

# Every supplied outline is a union of axis-parallel rectangles in units of its side.
_X, _Y, _S = "(-120 + CAST(c_custkey % 389 AS DOUBLE) / 4)", "(30 + CAST(c_custkey * 7 % 211 AS DOUBLE) / 4)", "(CAST(1 + c_custkey % 4 AS DOUBLE) / 2)"
_RECTS = {0: [(0, 0, 1, 1)], 1: [(0, 0, 1, 0.5), (0, 0.5, 0.5, 1)], 2: [(0, 0, 1, 0.25), (0, 0.75, 1, 1), (0, 0.25, 0.25, 0.75), (0.75, 0.25, 1, 0.75)]}


def rectangles(column: str = "c_custkey") -> str:
    parts = [
        f"SELECT {column} AS polygonkey, c_mktsegment AS musym, c_nationkey, {_X} + {_S} * {a} AS xa, {_Y} + {_S} * {b} AS ya, {_X} + {_S} * {c} AS xb, {_Y} + {_S} * {d} AS yb "
        f"FROM customer WHERE c_custkey % 3 = {kind}"
        for kind, rects in _RECTS.items()
        for a, b, c, d in rects
    ]
    return "rects AS (" + " UNION ALL ".join(parts) + ")"


BOX = (-110.0, 40.0, -80.0, 60.0)
_TOUCH = "xa <= {2} AND xb >= {0} AND ya <= {3} AND yb >= {1}"
_IN_BOX = _TOUCH.format(*BOX)


def overlap(box) -> str:
    x0, y0, x1, y1 = box
    return f"greatest(0, least(xb, {x1}) - greatest(xa, {x0})) * greatest(0, least(yb, {y1}) - greatest(ya, {y0}))"


@query("E1_contains_point", "points mupolygon", f"WITH {HITS} SELECT point_id, polygonkey, mukey FROM hits WHERE inside AND NOT on_edge")
def _(t):
    found = spatial.point_in_polygon_join(t.points, t.shapes("mupolygon"), ["polygonkey", "mukey"], wkt="mupolygongeo")
    return found.select("point_id", "polygonkey", "mukey")


@query("E1_intersects_point", "points mupolygon", f"WITH {HITS} SELECT point_id, polygonkey, mukey FROM hits WHERE inside OR on_edge")
def _(t):
    found = spatial.point_in_polygon_join(t.points, t.shapes("mupolygon"), ["polygonkey", "mukey"], boundary=True, wkt="mupolygongeo")
    return found.select("point_id", "polygonkey", "mukey")


@query(
    "E2_components_at_points", "points mupolygon mapunit component chorizon",
    f"""WITH {HITS} SELECT p.point_id, m.muname, c.cokey, c.comppct_r, h.chkey, h.hzdept_r FROM hits p JOIN mapunit m ON p.mukey = m.mukey
    JOIN component c ON m.mukey = c.mukey JOIN chorizon h ON c.cokey = h.cokey WHERE inside AND NOT on_edge AND c.majcompflag = 'Yes'""",
)
def _(t):
    what = ["muname", "cokey", "comppct_r", "chkey", "hzdept_r"]
    return spatial.components_at_points(t.points, t.shapes("mupolygon"), t.mapunit, t.component, t.chorizon, what=what, wkt="mupolygongeo").select("point_id", *what)


@query(
    "F1_mapunits_at_points", "points mupolygon mapunit component chorizon",
    f"""WITH {HITS}, found AS (SELECT DISTINCT point_id, mukey FROM hits WHERE inside OR on_edge),
    h AS (SELECT cokey, count(*) AS n, max(hzdepb_r) AS deepest FROM chorizon GROUP BY cokey)
    SELECT f.point_id, m.mukey, m.muname, c.cokey AS component_key, c.compname AS component_name, CAST(coalesce(h.n, 0) AS BIGINT) AS n_horizons, h.deepest
    FROM found f JOIN mapunit m ON f.mukey = m.mukey LEFT JOIN component c ON m.mukey = c.mukey LEFT JOIN h ON c.cokey = h.cokey""",
)
def _(t):
    below = nest_mapunits(t.mapunit.select("mukey", "muname"), t.component, t.chorizon)
    below = below.groupBy("mukey", "muname", "component_key", "component_name").agg(
        F.count("horizon_key").alias("n_horizons"), F.max("bottom_depth").alias("deepest")
    )
    rows = spatial.unit_rows_at_points(t.points, t.shapes("mupolygon"), below, wkt="mupolygongeo")
    return rows.select("point_id", "mukey", "muname", "component_key", "component_name", "n_horizons", "deepest")


@query(
    "E3_polygons_in_bbox", "mapunit",
    f"WITH {rectangles()} SELECT DISTINCT polygonkey, m.musym, m.muname FROM rects r JOIN mapunit m ON r.polygonkey = m.mukey WHERE {_IN_BOX}",
)
def _(t):
    return spatial.polygons_in_bbox(t.shapes("mupolygon"), BOX, t.mapunit, "mupolygongeo").select("polygonkey", "musym", "muname")


SMALL = (-100.0, 50.0, -98.5, 51.5)


def _relation_sql() -> str:
    area = (SMALL[2] - SMALL[0]) * (SMALL[3] - SMALL[1])
    shared = (
        f"a AS (SELECT polygonkey, sum((xb - xa) * (yb - ya)) AS own, sum({overlap(SMALL)}) AS common, "
        f"bool_or({_TOUCH.format(*SMALL)}) AS meet FROM rects GROUP BY polygonkey)"
    )
    tests = {
        "intersects": "meet", "contains": f"common = {area}", "within": "common = own", "touches": "meet AND common = 0", "crosses": "false",
        "overlaps": f"common > 0 AND common < own AND common < {area}",
    }
    parts = [f"SELECT '{r}' AS relation, polygonkey FROM a WHERE {test}" for r, test in tests.items()]
    return f"WITH {rectangles()}, {shared} " + " UNION ALL ".join(parts)


def _all_relations(shapes, target, key: str, wkt: str, chosen=RELATIONS):
    found = spatial.spatial_relations(shapes, target, wkt).select(F.explode("relations").alias("relation"), key)
    return found.where(F.col("relation").isin(*chosen))


@query("E4_spatial_filter", "", _relation_sql())
def _(t):
    return _all_relations(t.shapes("mupolygon"), SMALL, "polygonkey", "mupolygongeo")


def _by_relation(source: str, key: str, tests: dict[str, str]) -> str:
    return f"WITH {source} " + " UNION ALL ".join(f"SELECT '{r}' AS relation, {key} FROM a WHERE {test}" for r, test in tests.items())


_X0, _Y0, _X1, _Y1 = SMALL
_MET = f"y BETWEEN {_Y0} AND {_Y1} AND xa <= {_X1} AND xb >= {_X0}"
_THROUGH = f"y > {_Y0} AND y < {_Y1} AND xa < {_X1} AND xb > {_X0}"
LINES_SQL = _by_relation(
    "a AS (SELECT linekey, CAST(split_part(split_part(mulinegeo, '(', 2), ' ', 1) AS DOUBLE) AS xa, CAST(split_part(split_part(mulinegeo, ', ', 2), ' ', 1) AS DOUBLE) AS xb, "
    "CAST(rtrim(split_part(split_part(mulinegeo, ', ', 2), ' ', 2), ')') AS DOUBLE) AS y FROM muline)", "linekey",
    {
        "intersects": _MET, "contains": "false", "within": f"{_THROUGH} AND xa >= {_X0} AND xb <= {_X1}", "touches": f"{_MET} AND NOT ({_THROUGH})",
        "crosses": f"{_THROUGH} AND NOT (xa >= {_X0} AND xb <= {_X1})", "overlaps": "false",
    },
)


@query("E4_lines", "muline", LINES_SQL)
def _(t):
    return _all_relations(t.shapes("muline", "mulinegeo"), SMALL, "linekey", "mulinegeo")


_CLOSED = f"x BETWEEN {_X0} AND {_X1} AND y BETWEEN {_Y0} AND {_Y1}"
_OPEN = f"x > {_X0} AND x < {_X1} AND y > {_Y0} AND y < {_Y1}"
POINTS_SQL = _by_relation(
    "a AS (SELECT pointkey, CAST(split_part(split_part(mupointgeo, '(', 2), ' ', 1) AS DOUBLE) AS x, "
    "CAST(rtrim(split_part(split_part(mupointgeo, '(', 2), ' ', 2), ')') AS DOUBLE) AS y FROM mupoint)", "pointkey",
    {"intersects": _CLOSED, "within": _OPEN, "touches": f"{_CLOSED} AND NOT ({_OPEN})", "crosses": "false"},
)


@query("E4_points", "mupoint", POINTS_SQL)
def _(t):
    return _all_relations(t.shapes("mupoint", "mupointgeo"), SMALL, "pointkey", "mupointgeo", ["intersects", "within", "touches", "crosses"])


# A level line off the grid of the outlines: it never runs along an edge.
RIVER = (-110.0, 50.0625, -95.5, 50.0625)
RIVER_SQL = _by_relation(
    f"{rectangles()}, a AS (SELECT polygonkey, sum(CASE WHEN ya < {RIVER[1]} AND yb > {RIVER[1]} THEN greatest(0, least(xb, {RIVER[2]}) - greatest(xa, {RIVER[0]})) ELSE 0 END) AS common, "
    f"bool_or(ya < {RIVER[1]} AND yb > {RIVER[1]} AND xa <= {RIVER[2]} AND xb >= {RIVER[0]}) AS meet FROM rects GROUP BY polygonkey)", "polygonkey",
    {"intersects": "meet", "crosses": f"common > 0 AND common < {RIVER[2] - RIVER[0]}", "touches": "meet AND common = 0", "contains": f"common = {RIVER[2] - RIVER[0]}"},
)


@query("E4_line_query", "", RIVER_SQL)
def _(t):
    river = "LINESTRING({} {}, {} {})".format(*RIVER)
    return _all_relations(t.shapes("mupolygon"), river, "polygonkey", "mupolygongeo", ["intersects", "crosses", "touches", "contains"])


@query(
    "E5_spatial_query", "mapunit legend",
    f"""WITH {rectangles()} SELECT DISTINCT m.mukey, m.musym, m.muname, m.mukind, l.areasymbol, l.areaname FROM rects r
    JOIN mapunit m ON r.polygonkey = m.mukey JOIN legend l ON m.lkey = l.lkey WHERE {_IN_BOX}""",
)
def _(t):
    return spatial.spatial_query(t.shapes("mupolygon"), {"xmin": BOX[0], "ymin": BOX[1], "xmax": BOX[2], "ymax": BOX[3]}, mapunit=t.mapunit, legend=t.legend)


@query(
    "E5_spatial_outlines", "mupolygon",
    f"""WITH {rectangles()} SELECT polygonkey, areasymbol, mupolygongeo AS geometry FROM mupolygon
    WHERE polygonkey IN (SELECT polygonkey FROM rects WHERE {_IN_BOX})""",
)
def _(t):
    return spatial.spatial_query(t.shapes("mupolygon"), BOX, return_type="spatial", what=["polygonkey", "areasymbol"])


_AREA_TOUCH = "x0 <= -80 AND x0 + 20 >= -110 AND y0 <= 60 AND y0 + 10 >= 40"


@query(
    "E6_survey_areas_intersecting", "sapolygon",
    f"""WITH a AS (SELECT areasymbol, spatialversion, lkey, -120 + lkey % 5 * 20 AS x0, 30 + lkey // 5 * 10 AS y0 FROM sapolygon)
    SELECT DISTINCT areasymbol, spatialversion, lkey FROM a WHERE {_AREA_TOUCH}""",
)
def _(t):
    return spatial.survey_areas_intersecting(t.sapolygon, BOX)


@query("E7_survey_area_boundaries", "sapolygon", "SELECT areasymbol, areaname, sapolygongeo AS geometry FROM sapolygon")
def _(t):
    return spatial.survey_area_boundaries(t.sapolygon)


@query("E7_list_survey_areas", "legend", "SELECT areasymbol, areaname, saversion, saverest FROM legend")
def _(t):
    return spatial.list_survey_areas(t.legend)


_E = g.ECCENTRICITY
_Q = f"((1 - {_E * _E!r}) * (sin(radians({{0}})) / (1 - {_E * _E!r} * pow(sin(radians({{0}})), 2)) + atanh({_E!r} * sin(radians({{0}}))) / {_E!r}))"
_Q_POLE = (1 - _E * _E) * (1 / (1 - _E * _E) + math.atanh(_E) / _E)
_HAVERSINE = "(pow(sin((radians(y2) - radians(y1)) / 2), 2) + cos(radians(y1)) * cos(radians(y2)) * pow(sin((radians(x2) - radians(x1)) / 2), 2))"
# Supplied outlines have at most one hole, the second ring.
SIZES = f"""ring_sizes AS (SELECT polygonkey, ring_id, abs(sum(radians(x2 - x1) * ({_Q.format('y1')} + {_Q.format('y2')}) / {_Q_POLE!r} / 2)) * pow({g.AUTHALIC_RADIUS_M}, 2) AS area,
      sum(2 * {g.MEAN_RADIUS_M} * atan2(sqrt({_HAVERSINE}), sqrt(1 - {_HAVERSINE}))) AS length FROM segs GROUP BY ALL),
    sizes AS (SELECT polygonkey, max(area) - coalesce(sum(area) - max(area), 0) AS shape_area, sum(length) AS shape_length FROM ring_sizes GROUP BY polygonkey)"""


@query(
    "E8_polygon_area_length", "mupolygon",
    f"WITH {EDGES}, {SIZES} SELECT polygonkey, round(shape_area / 1e6, 3) AS area_km2, round(shape_length / 1e3, 4) AS length_km FROM sizes",
)
def _(t):
    sized = spatial.polygon_area_length(t.shapes("mupolygon"), "mupolygongeo")
    return sized.select("polygonkey", r6(F.col("shape_area") / 1e6, 3).alias("area_km2"), r6(F.col("shape_length") / 1e3, 4).alias("length_km"))


REACH = 0.3
_T = "greatest(0, least(1, coalesce(((lon - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / nullif(pow(x2 - x1, 2) + pow(y2 - y1, 2), 0), 0)))"
_SEGMENT = f"sqrt(pow(lon - x1 - {_T} * (x2 - x1), 2) + pow(lat - y1 - {_T} * (y2 - y1), 2))"
WITHIN = f"""{EDGES},
    near AS (SELECT point_id, lon, lat, polygonkey FROM points JOIN boxes ON lon BETWEEN xmin - {REACH} AND xmax + {REACH} AND lat BETWEEN ymin - {REACH} AND ymax + {REACH}),
    hits AS (SELECT point_id, segs.polygonkey, min({_SEGMENT}) <= {REACH} OR count(*) FILTER ({_RAY}) % 2 = 1 AS close
      FROM near JOIN segs ON near.polygonkey = segs.polygonkey GROUP BY point_id, segs.polygonkey)"""


@query("E10_polys_within_distance", "points mupolygon", f"WITH {WITHIN} SELECT point_id, polygonkey FROM hits WHERE close")
def _(t):
    return spatial.polys_within_distance(t.points, t.shapes("mupolygon"), REACH, ["polygonkey"], wkt="mupolygongeo").select("point_id", "polygonkey")


@query(
    "E9_region_area", "points mupolygon",
    f"""WITH {WITHIN}, {SIZES} SELECT point_id, count(*) AS n_polygons, round(sum(shape_area) / 1e6, 2) AS area_km2 FROM hits JOIN sizes USING (polygonkey)
    WHERE close GROUP BY point_id""",
)
def _(t):
    total = spatial.region_area(t.points, t.shapes("mupolygon"), REACH, ["point_id"], wkt="mupolygongeo")
    return total.select("point_id", "n_polygons", r6(F.col("total_area") / 1e6, 2).alias("area_km2"))


@query(
    "E11_drop_invalid_geometry", "mupolygon",
    """SELECT polygonkey, 'EPSG:4326' AS crs, CASE WHEN spatialversion = 1 AND polygonkey % 5 = 4 THEN 'POINT' ELSE 'POLYGON' END AS geometry_type
    FROM mupolygon WHERE polygonkey % 5 NOT IN (0, 1, 2)""",
)
def _(t):
    key = F.col("polygonkey") % 5
    broken = (
        F.when(key == 0, "null").when(key == 1, "POLYGON ((0 0, 1 0, 1 1))").when(key == 2, "POLYGON ((0 0, 1 x, 1 1, 0 0))")
        .when(key == 4, "POINT (1.5 -2e1)").otherwise(F.col("mupolygongeo"))
    )
    mixed = t.mupolygon.withColumns({"mupolygongeo": broken, "mupolygonproj": F.lit("POINT (0 0)")})
    return spatial.drop_invalid_geometry(mixed).select("polygonkey", "crs", "geometry_type")


WATERSHED = "POLYGON((-115 35, -95 35, -95 45, -105 45, -105 55, -115 55, -115 35))"
_SHED = f"({_TOUCH.format(-115, 35, -95, 45)} OR {_TOUCH.format(-115, 45, -105, 55)})"


@query(
    "E13_watershed_units", "",
    f"""WITH {rectangles()} SELECT musym, count(DISTINCT polygonkey) AS n FROM rects WHERE {_SHED} GROUP BY musym ORDER BY n DESC, musym LIMIT 5""",
)
def _(t):
    return spatial.watershed_units(t.shapes("mupolygon"), WATERSHED, 5, "mupolygongeo")


REGIONS = {"west": (-120.0, 30.0, -100.0, 50.0), "middle": (-105.0, 35.0, -85.0, 55.0), "north": (-120.0, 60.0, -30.0, 80.0)}


@query(
    "D2_distinct_units_by_region", "",
    f"WITH {rectangles()} "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS region, count(DISTINCT polygonkey) AS n_polygons, count(DISTINCT musym) AS n_symbols FROM rects WHERE {_TOUCH.format(*b)}"
        for n, b in REGIONS.items()
    ),
)
def _(t):
    return agg.count_regions(spatial.distinct_units_by_region(t.shapes("mupolygon"), REGIONS, t.mapunit, "mupolygongeo"))
