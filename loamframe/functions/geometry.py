"""Well-known text and planar predicates as column expressions.

A shape is parsed once into ``rings``: an array of coordinate lists. Several
polygons with holes are simply all their rings, since inside/outside follows
the even-odd rule.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RING = "array<struct<x:double,y:double>>"
# Authalic sphere of the WGS84 ellipsoid and its first eccentricity.
AUTHALIC_RADIUS_M = 6371007.181
MEAN_RADIUS_M = 6371008.8
ECCENTRICITY = 0.0818191908426215

# Nesting of each kind once coordinates are gone: R is a coordinate list, P a
# polygon. Checked in steps, since one pattern over a long outline would recurse.
_SHAPES = {
    "POINT": "R", "LINESTRING": "R", "MULTIPOINT": "(R)", "POLYGON": "(R)", "MULTILINESTRING": "(R)", "MULTIPOLYGON": "(P)",
}


def _well_formed(wkt: Column, kind: Column) -> Column:
    body = F.regexp_extract(wkt, r"(?s)^\s*[A-Za-z]+\s*(\(.*\))\s*$", 1)
    skeleton = F.translate(body, "0123456789.+-eE \t\r\n", "")
    lists = F.regexp_replace(skeleton, r"\(,*\)", "R")
    polygons = F.when(kind == "MULTIPOLYGON", F.regexp_replace(lists, r"\(R[R,]*\)", "P")).otherwise(lists)
    # Members are separated by single commas.
    shape = F.regexp_replace(F.regexp_replace(polygons, ",(?=[RP])", ""), "([RP])[RP]*", "$1")
    apart = ~lists.contains("(,") & ~lists.contains("RR") & ~polygons.contains("PP")
    known = F.create_map(*[F.lit(x) for pair in _SHAPES.items() for x in pair])
    single_point = (kind == "MULTIPOINT") & (shape == "R")
    return F.coalesce((shape == F.try_element_at(known, kind)) | single_point, F.lit(False)) & apart & ((kind != "POINT") | ~body.contains(","))


def wkt_kind(wkt: Column) -> Column:
    """POINT, POLYGON, ... in upper case ("" when there is no such word)."""
    return F.upper(F.regexp_extract(wkt, r"^\s*([A-Za-z]+)", 1))


def parse_rings(wkt: Column) -> Column:
    """All coordinate lists of a shape, null for malformed or blank text."""

    def point(text: Column) -> Column:
        parts = F.split(F.btrim(text, F.lit(" \t\r\n")), r"\s+")
        number = lambda i: F.get(parts, F.lit(i)).try_cast("double")
        return F.when(
            F.size(parts).between(2, 3) & number(0).isNotNull() & number(1).isNotNull(),
            F.struct(number(0).alias("x"), number(1).alias("y")),
        )

    lists = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1))
    rings = F.transform(lists, lambda text: F.transform(F.split(text, ","), point))
    complete = lambda parsed: F.forall(parsed, lambda ring: F.forall(ring, lambda p: p.isNotNull()))
    return F.when(_well_formed(wkt, wkt_kind(wkt)), F.get(F.filter(F.array(rings), complete), F.lit(0)))


def valid_polygon(rings: Column) -> Column:
    """Every ring has four or more finite points and ends where it starts."""

    def good(ring: Column) -> Column:
        first, last = F.get(ring, F.lit(0)), F.element_at(ring, -1)
        finite = F.forall(ring, lambda p: (F.abs(p["x"]) < 1e300) & (F.abs(p["y"]) < 1e300))
        return (F.size(ring) >= 4) & (first["x"] == last["x"]) & (first["y"] == last["y"]) & finite

    return F.coalesce((F.size(rings) > 0) & F.forall(rings, good), F.lit(False))


# A point in plain decimals, its coordinates one space apart.
_PLAIN_POINT = r"^\s*[Pp][Oo][Ii][Nn][Tt]\s*\([ \t\r\n]*([-+]?[0-9]+(?:\.[0-9]+)? [-+]?[0-9]+(?:\.[0-9]+)?)[ \t\r\n]*\)\s*$"


def _plain_point(wkt: Column) -> Column:
    """The shape of a point in the usual spelling as an array of one, empty for any other text."""

    def shape(said: Column) -> Column:
        x, y = (F.substring_index(said, " ", n).try_cast("double") for n in (1, -1))
        box = F.struct(x.alias("xmin"), y.alias("ymin"), x.alias("xmax"), y.alias("ymax"))
        return F.struct(F.array(F.array(F.struct(x.alias("x"), y.alias("y")))).alias("_rings"), box.alias("_box"))

    return F.transform(F.filter(F.array(F.regexp_extract(wkt, _PLAIN_POINT, 1)), lambda said: said != ""), shape)


# What a parsed outline adds to its row; a spatial table has these already.
SHAPE_COLUMNS = ["_kind", "_rings", "_xmin", "_ymin", "_xmax", "_ymax"]


def with_shape(df: DataFrame, wkt: str, polygons_only: bool = False) -> DataFrame:
    """Rows with a usable outline: adds ``SHAPE_COLUMNS``.

    Parsed once per row, or not at all where the columns are there (a table of
    ``spatial_table.write_spatial_table``); malformed text and invalid polygons
    drop out.
    """
    if not set(SHAPE_COLUMNS) <= set(df.columns):
        text = F.col(wkt)
        polygon = wkt_kind(text).contains("POLYGON")
        usable = lambda rings: rings.isNotNull() & (~polygon | valid_polygon(rings))
        shape = lambda rings: F.struct(rings.alias("_rings"), bounding_box(rings).alias("_box"))
        good_outline = F.transform(F.filter(F.array(parse_rings(text)), usable), shape)
        # Most points are spelt plainly and need none of the steps for outlines.
        good = F.transform(F.array(_plain_point(text)), lambda point: F.when(F.size(point) > 0, point).otherwise(good_outline))[0]
        columns = df.columns
        df = df.select("*", F.explode(good).alias("_shape")).select(
            *columns, wkt_kind(text).alias("_kind"), "_shape._rings", *[F.col(f"_shape._box.{c[1:]}").alias(c) for c in SHAPE_COLUMNS[2:]]
        )
    return df.where(F.col("_kind").contains("POLYGON")) if polygons_only else df


def bounding_box(rings: Column) -> Column:
    """struct(xmin, ymin, xmax, ymax)."""
    points = F.flatten(rings)
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax")
    )


def edges(rings: Column) -> Column:
    """All consecutive point pairs as array<struct<x1,y1,x2,y2>>."""

    def pairs(ring: Column) -> Column:
        ahead = F.slice(ring, 2, F.size(ring))
        return F.filter(
            F.zip_with(
                ring, ahead,
                lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")),
            ),
            lambda e: e["x2"].isNotNull(),
        )

    return F.flatten(F.transform(rings, pairs))


def _side(e: Column, x: Column, y: Column) -> Column:
    """Positive, zero or negative: on which side of the edge a point lies."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])


def inside_even_odd(edge_list: Column, x: Column, y: Column) -> Column:
    """Even-odd ray test; says nothing certain about points on the boundary."""

    def crosses(e: Column) -> Column:
        # The edge is cut by the ray to the right when the point is left of it.
        upward = e["y2"] > e["y1"]
        return ((e["y1"] > y) != (e["y2"] > y)) & ((_side(e, x, y) > 0) == upward)

    return F.size(F.filter(edge_list, crosses)) % 2 == 1


def on_boundary(edge_list: Column, x: Column, y: Column) -> Column:
    return F.exists(
        edge_list,
        lambda e: (_side(e, x, y) == 0)
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])),
    )


def point_in_polygon(edge_list: Column, x: Column, y: Column, boundary: bool) -> Column:
    """Containment with the boundary counted in (``True``) or out."""
    inside, touching = inside_even_odd(edge_list, x, y), on_boundary(edge_list, x, y)
    return (inside | touching) if boundary else (inside & ~touching)


def polygon_meets_box(edge_list: Column, xmin: float, ymin: float, xmax: float, ymax: float) -> Column:
    """Polygon and closed box share a point."""
    corners = [(F.lit(x), F.lit(y)) for x in (float(xmin), float(xmax)) for y in (float(ymin), float(ymax))]

    def edge_meets(e: Column) -> Column:
        near = (
            (F.least(e["x1"], e["x2"]) <= xmax) & (F.greatest(e["x1"], e["x2"]) >= xmin)
            & (F.least(e["y1"], e["y2"]) <= ymax) & (F.greatest(e["y1"], e["y2"]) >= ymin)
        )
        sides = [_side(e, x, y) for x, y in corners]
        return near & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)

    return F.exists(edge_list, edge_meets) | inside_even_odd(edge_list, *corners[0])


def read_outline(wkt: str) -> tuple[str, list[list[tuple[float, float]]]]:
    """(kind in upper case, coordinate lists) of one text, in plain Python."""
    kind = re.match(r"\s*([A-Za-z]+)", wkt)
    lists = [[tuple(float(v) for v in p.split()[:2]) for p in part.split(",")] for part in re.findall(r"\(([^()]+)\)", wkt)]
    if not kind or not lists or any(len(p) != 2 for ring in lists for p in ring):
        raise ValueError(f"not an outline: {wkt[:80]!r}")
    return kind[1].upper(), lists


POINTS, EDGES = "array<struct<x:double,y:double>>", "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def constant_shape(wkt: str) -> Column:
    """The shape of a given text, to be compared with a column of shapes, as a
    literal struct(kind, dim, points, edges, ends); ``ends`` are those of open lines."""
    kind, rings = read_outline(wkt)
    dim = 2 if "POLYGON" in kind else 1 if "LINE" in kind else 0
    point = lambda p: {"x": p[0], "y": p[1]}
    edge = lambda p, q: {"x1": p[0], "y1": p[1], "x2": q[0], "y2": q[1]}
    said = {
        "kind": kind, "dim": dim, "points": [point(p) for r in rings for p in r],
        "edges": [edge(p, q) for r in rings for p, q in zip(r, r[1:])] if dim else [],
        "ends": [point(p) for r in rings if r[0] != r[-1] for p in (r[0], r[-1])] if dim == 1 else [],
    }
    return F.from_json(F.lit(json.dumps(said)), f"struct<kind:string,dim:int,points:{POINTS},edges:{EDGES},ends:{POINTS}>")


def _lines(kind: Column, edge_list: Column) -> Column:
    """No edges for points, whatever their list looks like."""
    return F.when(kind.contains("POINT"), F.filter(edge_list, lambda e: F.lit(False))).otherwise(edge_list)


def shapes_meet(kind: Column, rings: Column, edge_list: Column, other: Column) -> Column:
    """Two closed shapes (points, lines or polygons) share a point.

    Either two edges meet, or a point of one lies in the other. ``other`` comes
    from :func:`constant_shape`.
    """
    mine = _lines(kind, edge_list)

    def edges_meet(a: Column, b: Column) -> Column:
        near = (
            (F.least(a["x1"], a["x2"]) <= F.greatest(b["x1"], b["x2"])) & (F.greatest(a["x1"], a["x2"]) >= F.least(b["x1"], b["x2"]))
            & (F.least(a["y1"], a["y2"]) <= F.greatest(b["y1"], b["y2"])) & (F.greatest(a["y1"], a["y2"]) >= F.least(b["y1"], b["y2"]))
        )
        apart = lambda e, f: F.signum(_side(e, f["x1"], f["y1"])) * F.signum(_side(e, f["x2"], f["y2"])) > 0
        return near & ~apart(a, b) & ~apart(b, a)

    def holds(of: Column, points: Column, lines: Column, p: Column) -> Column:
        inside = of.contains("POLYGON") & inside_even_odd(lines, p["x"], p["y"])
        same = of.contains("POINT") & F.exists(points, lambda q: (q["x"] == p["x"]) & (q["y"] == p["y"]))
        return inside | on_boundary(lines, p["x"], p["y"]) | same

    points = F.flatten(rings)
    return (
        F.exists(mine, lambda a: F.exists(other["edges"], lambda b: edges_meet(a, b)))
        | F.exists(points, lambda p: holds(other["kind"], other["points"], other["edges"], p))
        | F.exists(other["points"], lambda p: holds(kind, points, mine, p))
    )


def edge_distance(e: Column, x: Column, y: Column) -> Column:
    """Planar distance from a point to an edge."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    along = F.coalesce(F.try_divide((x - e["x1"]) * dx + (y - e["y1"]) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    return F.hypot(x - e["x1"] - t * dx, y - e["y1"] - t * dy)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float) -> Column:
    """Great-circle distance in the unit of ``radius``."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2.0) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2.0)
    return 2.0 * radius * F.atan2(F.sqrt(a), F.sqrt(1.0 - a))


def authalic_sine(lat_degrees: Column) -> Column:
    """Sine of the authalic latitude: on it, sphere and ellipsoid areas agree."""
    e = ECCENTRICITY

    def q(sine: Column) -> Column:
        return (1 - e * e) * (sine / (1 - e * e * sine * sine) + F.atanh(e * sine) / e)

    return q(F.sin(F.radians(lat_degrees))) / q(F.lit(1.0))


def ring_area_m2(ring_edges: Column) -> Column:
    """Signed area between the ring's edges and the equator (authalic sphere).

    Edges are taken as straight in longitude and sine of authalic latitude
    (the cylindrical equal-area map), the usual small-edge approximation.
    """
    parts = F.transform(
        ring_edges,
        lambda e: F.radians(e["x2"] - e["x1"]) * (authalic_sine(e["y1"]) + authalic_sine(e["y2"])) / 2.0,
    )
    return F.aggregate(parts, F.lit(0.0), lambda total, part: total + part) * (-(AUTHALIC_RADIUS_M**2))


def polygon_area_m2(rings: Column) -> Column:
    """Area of outer rings less their holes, whatever the winding.

    Rings are told apart by nesting: the first one and every ring not inside an
    earlier one is an outer ring. Single polygons need only the first ring.
    """
    areas = F.transform(rings, lambda r: F.abs(ring_area_m2(edges(F.array(r)))))

    def is_hole(ring: Column, i: Column) -> Column:
        first = ring[0]
        others = F.filter(rings, lambda r, j: j != i)
        depth = F.size(F.filter(others, lambda r: inside_even_odd(edges(F.array(r)), first["x"], first["y"])))
        return depth % 2 == 1

    signs = F.transform(rings, lambda r, i: F.when(is_hole(r, i), -1.0).otherwise(1.0))
    return F.aggregate(F.zip_with(areas, signs, lambda a, s: a * s), F.lit(0.0), lambda total, part: total + part)


def perimeter_m(edge_list: Column) -> Column:
    lengths = F.transform(edge_list, lambda e: haversine_km(e["y1"], e["x1"], e["y2"], e["x2"], MEAN_RADIUS_M))
    return F.aggregate(lengths, F.lit(0.0), lambda total, part: total + part)
