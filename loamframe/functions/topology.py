"""Relations between shapes as column expressions.

The edges of both shapes are cut where they meet; places on and beside the
pieces, each inside, outside or on the boundary of either shape, tell whether
the interiors meet and whether one shape has a part outside the other. The six
relations follow from these facts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamframe.functions import geometry as g

RELATIONS = ["intersects", "contains", "within", "touches", "crosses", "overlaps"]
EPS = 1e-12


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once."""
    return F.transform(F.array(value), then)[0]


def dimension(kind: Column) -> Column:
    """0 for points, 1 for lines, 2 for polygons."""
    return F.when(kind.contains("POLYGON"), 2).when(kind.contains("LINE"), 1).otherwise(0)


def shape(kind: Column, rings: Column) -> Column:
    """struct(dim, points, edges, ends): ``ends`` are where open lines end."""
    dim = dimension(kind)
    ends = F.flatten(
        F.transform(
            F.filter(rings, lambda r: (r[0]["x"] != F.element_at(r, -1)["x"]) | (r[0]["y"] != F.element_at(r, -1)["y"])),
            lambda r: F.array(r[0], F.element_at(r, -1)),
        )
    )
    none = lambda items: F.filter(items, lambda e: F.lit(False))
    edges = g.edges(rings)
    return F.struct(
        dim.alias("dim"), F.flatten(rings).alias("points"), F.when(dim == 0, none(edges)).otherwise(edges).alias("edges"),
        F.when(dim == 1, ends).otherwise(none(ends)).alias("ends"),
    )


def _near(e: Column, x: Column, y: Column) -> Column:
    """The point lies on the edge, up to rounding."""
    dx, dy, rx, ry = e["x2"] - e["x1"], e["y2"] - e["y1"], x - e["x1"], y - e["y1"]
    square, dot, cross = dx * dx + dy * dy, rx * dx + ry * dy, dx * ry - dy * rx
    scale = F.sqrt(square) * (1 + F.greatest(F.abs(x), F.abs(y)))
    at_point = (F.abs(rx) <= EPS) & (F.abs(ry) <= EPS)
    return F.when(square > 0, (F.abs(cross) <= EPS * scale) & (dot >= -EPS) & (dot <= square + EPS)).otherwise(at_point)


def _same(p: Column, x: Column, y: Column) -> Column:
    return (F.abs(p["x"] - x) <= EPS) & (F.abs(p["y"] - y) <= EPS)


def locate(s: Column, x: Column, y: Column) -> Column:
    """1 in the interior, 0 on the boundary, -1 outside the shape."""
    on = F.exists(s["edges"], lambda e: _near(e, x, y))
    # Where an even number of lines end, the point is interior.
    at_end = F.size(F.filter(s["ends"], lambda p: _same(p, x, y))) % 2 == 1
    return (
        F.when(s["dim"] == 0, F.when(F.exists(s["points"], lambda p: _same(p, x, y)), 1).otherwise(-1))
        .when(s["dim"] == 1, F.when(~on, -1).when(at_end, 0).otherwise(1))
        .when(on, 0)
        .when(g.inside_even_odd(s["edges"], x, y), 1)
        .otherwise(-1)
    )


def _cuts(e: Column, other: Column) -> Column:
    """Where along an edge (between 0 and 1) it meets the other shape's edges."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    square = dx * dx + dy * dy
    beside = (
        lambda f: (F.least(f["x1"], f["x2"]) <= F.greatest(e["x1"], e["x2"]) + EPS) & (F.greatest(f["x1"], f["x2"]) >= F.least(e["x1"], e["x2"]) - EPS)
        & (F.least(f["y1"], f["y2"]) <= F.greatest(e["y1"], e["y2"]) + EPS) & (F.greatest(f["y1"], f["y2"]) >= F.least(e["y1"], e["y2"]) - EPS)
    )

    def meets(f: Column) -> Column:
        fx, fy, wx, wy = f["x2"] - f["x1"], f["y2"] - f["y1"], f["x1"] - e["x1"], f["y1"] - e["y1"]
        det = dx * fy - dy * fx
        t, u = F.try_divide(wx * fy - wy * fx, det), F.try_divide(wx * dy - wy * dx, det)

        def along(x: Column, y: Column) -> Column:
            straight = F.abs(dx * (y - e["y1"]) - dy * (x - e["x1"])) <= EPS * (1 + F.sqrt(square))
            return F.when((det == 0) & straight, F.try_divide((x - e["x1"]) * dx + (y - e["y1"]) * dy, square))

        crossing = F.when((u >= -EPS) & (u <= 1 + EPS), t)
        return F.array(crossing, along(f["x1"], f["y1"]), along(f["x2"], f["y2"]))

    found = F.flatten(F.transform(F.filter(other["edges"], beside), meets))
    return F.filter(found, lambda t: t.isNotNull() & (t > 0) & (t < 1))


def _probes(s: Column, other: Column) -> Column:
    """Points that stand for all parts of a shape once its edges are cut at the
    other's: array<struct(x, y, middle)>. Of points these are themselves, of lines
    the middle and the ends of every piece, of polygons a place on either side
    of every piece (each face of the two outlines lies beside one)."""
    at = lambda x, y, middle: F.struct(x.alias("x"), y.alias("y"), F.lit(middle).alias("middle"))

    def of_piece(e: Column, a: Column, b: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        x, y = lambda t: e["x1"] + t * dx, lambda t: e["y1"] + t * dy
        half, off = (a + b) / 2, (b - a) * 1e-6
        sides = F.array(at(x(half) - dy * off, y(half) + dx * off, False), at(x(half) + dy * off, y(half) - dx * off, False))
        line = F.array(at(x(half), y(half), True), at(x(a), y(a), False), at(x(b), y(b), False))
        return F.when(s["dim"] == 2, sides).otherwise(line)

    def of_edge(e: Column) -> Column:
        stops = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), _cuts(e, other))))
        return F.flatten(let(stops, lambda ts: F.zip_with(F.slice(ts, F.lit(1), F.size(ts) - 1), F.slice(ts, F.lit(2), F.size(ts) - 1), lambda a, b: of_piece(e, a, b))))

    real = F.filter(s["edges"], lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))
    return F.when(s["dim"] == 0, F.transform(s["points"], lambda p: at(p["x"], p["y"], True))).otherwise(F.flatten(F.transform(real, of_edge)))


def facts(a: Column, b: Column) -> Column:
    """struct(both, only_a, only_b, along) of two shapes that share a point.

    One comes from :func:`shape`, the other from there or from
    ``geometry.constant_shape``. Every probe of both shapes lies in the interior,
    on the boundary or outside of each: the interiors meet if one is inside both,
    a part of one lies outside the other if one is inside the first only (a shape
    of lower dimension never covers the other), and two lines share a stretch if
    a piece's middle is on both. Of points and a shape of higher dimension the
    points' own places say it all.
    """
    points = lambda s, other: (s["dim"] == 0) & (other["dim"] > 0)
    probes = F.when(points(a, b), _probes(a, b)).when(points(b, a), _probes(b, a)).otherwise(F.concat(_probes(a, b), _probes(b, a)))
    places = F.transform(
        probes, lambda p: F.struct(p["middle"], locate(a, p["x"], p["y"]).alias("a"), locate(b, p["x"], p["y"]).alias("b"))
    )

    def found(ps: Column) -> Column:
        return F.struct(
            F.exists(ps, lambda p: (p["a"] == 1) & (p["b"] == 1)).alias("both"),
            ((a["dim"] > b["dim"]) | F.exists(ps, lambda p: (p["a"] == 1) & (p["b"] == -1))).alias("only_a"),
            ((a["dim"] < b["dim"]) | F.exists(ps, lambda p: (p["a"] == -1) & (p["b"] == 1))).alias("only_b"),
            F.exists(ps, lambda p: p["middle"] & (p["a"] == 1) & (p["b"] == 1)).alias("along"),
            a["dim"].alias("a"), b["dim"].alias("b"),
        )

    return let(places, found)


def holds(f: Column, relation: str) -> Column:
    """Does ``a`` stand in ``relation`` to ``b``, given their :func:`facts`?"""
    same, lower = f["a"] == f["b"], f["a"] < f["b"]
    return {
        "intersects": F.lit(True),
        "contains": f["both"] & ~f["only_b"],
        "within": f["both"] & ~f["only_a"],
        "touches": ~f["both"],
        "overlaps": same & ((f["a"] != 1) | f["along"]) & f["both"] & f["only_a"] & f["only_b"],
        "crosses": F.when(same, (f["a"] == 1) & f["both"] & ~f["along"]).otherwise(f["both"] & F.when(lower, f["only_a"]).otherwise(f["only_b"])),
    }[relation]
