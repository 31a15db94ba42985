"""A plain numpy version of the relations between shapes, for comparison in tests."""

from __future__ import annotations

import re

import numpy as np

RELATIONS = ["intersects", "contains", "within", "touches", "crosses", "overlaps"]
_EPS = 1e-12


def parse(wkt: str) -> tuple[int, list[np.ndarray]]:
    """(dimension 0, 1 or 2, coordinate lists)."""
    kind = re.match(r"\s*([A-Za-z]+)", wkt).group(1).upper()
    lists = [
        np.array([[float(v) for v in p.split()[:2]] for p in text.split(",")])
        for text in re.findall(r"\(([^()]+)\)", wkt)
    ]
    dimension = 2 if "POLYGON" in kind else 1 if "LINE" in kind else 0
    if dimension == 0:
        lists = [np.vstack(lists)]
    return dimension, lists


def _segments(lists: list[np.ndarray]) -> np.ndarray:
    return np.vstack([np.hstack([c[:-1], c[1:]]) for c in lists])


def _locate(dimension: int, lists: list[np.ndarray], points: np.ndarray) -> np.ndarray:
    """1 interior, 0 boundary, -1 exterior, for each point."""
    if dimension == 0:
        hit = (np.abs(points[:, None, :] - lists[0][None]) <= _EPS).all(2).any(1)
        return np.where(hit, 1, -1)
    s = _segments(lists)
    d = s[:, 2:] - s[:, :2]
    rel = points[:, None, :] - s[None, :, :2]
    cross = d[:, 0] * rel[..., 1] - d[:, 1] * rel[..., 0]
    dot = (rel * d).sum(2)
    square = (d * d).sum(1)
    scale = np.sqrt(square) * (1 + np.abs(points).max(1, initial=0))[:, None]
    # An edge between equal points is that point.
    long = (square > 0) | (np.abs(rel) <= _EPS).all(2)
    on = ((np.abs(cross) <= _EPS * scale) & (dot >= -_EPS) & (dot <= square + _EPS) & long).any(1)
    if dimension == 1:
        ends = np.vstack([c[[0, -1]] for c in lists if not np.allclose(c[0], c[-1])] or [np.empty((0, 2))])
        # A point that closes an even number of line ends is interior.
        at_end = (np.abs(points[:, None, :] - ends[None]) <= _EPS).all(2).sum(1) % 2 == 1
        return np.where(on, np.where(at_end, 0, 1), -1)
    spans = (s[None, :, 1] > points[:, None, 1]) != (s[None, :, 3] > points[:, None, 1])
    left = (cross > 0) == (d[:, 1] > 0)
    inside = (spans & left).sum(1) % 2 == 1
    return np.where(on, 0, np.where(inside, 1, -1))


def _pieces(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Segments ``a`` cut at every meeting with segments ``b``."""
    out = []
    e = b[:, 2:] - b[:, :2]
    for seg in a:
        p, d = seg[:2], seg[2:] - seg[:2]
        det = d[0] * e[:, 1] - d[1] * e[:, 0]
        w = b[:, :2] - p
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (w[:, 0] * e[:, 1] - w[:, 1] * e[:, 0]) / det
            u = (w[:, 0] * d[1] - w[:, 1] * d[0]) / det
        cuts = list(t[(det != 0) & (t > 0) & (t < 1) & (u >= -_EPS) & (u <= 1 + _EPS)])
        square = float(d @ d)
        if square:
            parallel = det == 0
            for q in np.vstack([b[parallel, :2], b[parallel, 2:]]):
                at = float((q - p) @ d) / square
                if 0 < at < 1 and abs(d[0] * (q - p)[1] - d[1] * (q - p)[0]) <= _EPS * (1 + np.sqrt(square)):
                    cuts.append(at)
            stops = np.unique(np.concatenate([[0.0], cuts, [1.0]]))
            out.append(np.hstack([p + stops[:-1, None] * d, p + stops[1:, None] * d]))
    return np.vstack(out) if out else np.empty((0, 4))


def _parts(shape, other) -> tuple[np.ndarray, np.ndarray]:
    """(pieces of the shape's lines, where their midpoints lie in the other)."""
    lines = _segments(shape[1])
    pieces = _pieces(lines, _segments(other[1])) if other[0] > 0 else lines
    return pieces, _locate(*other, (pieces[:, :2] + pieces[:, 2:]) / 2)


def _same_side(a, b, pieces: np.ndarray) -> np.ndarray:
    """For pieces shared by two polygon boundaries: are the interiors on one side?"""
    d = pieces[:, 2:] - pieces[:, :2]
    length = np.sqrt((d * d).sum(1, keepdims=True))
    left = (pieces[:, :2] + pieces[:, 2:]) / 2 + np.hstack([-d[:, 1:], d[:, :1]]) / length * length.min(initial=1.0) * 1e-6
    return (_locate(*a, left) == 1) == (_locate(*b, left) == 1)


def _facts(a, b) -> dict[str, bool]:
    """For shapes that meet: do interiors meet (ii), is some interior of a
    outside b (ie), some of b outside a (ei)?"""
    if a[0] == 0:
        at = _locate(*b, a[1][0])
        ei = b[0] > 0 or (_locate(*a, b[1][0]) == -1).any()
        return dict(ii=bool((at == 1).any()), ie=bool((at == -1).any()), ei=bool(ei))
    if a[0] > b[0]:
        f = _facts(b, a)
        return dict(ii=f["ii"], ie=f["ei"], ei=f["ie"])
    pa, ina = _parts(a, b)
    if a[0] == 1 and b[0] == 2:
        return dict(ii=bool((ina == 1).any()), ie=bool((ina == -1).any()), ei=True)
    pb, inb = _parts(b, a)
    if a[0] == 1:
        corners = np.vstack([pa[:, :2], pa[:, 2:]])
        inner = (_locate(*a, corners) == 1) & (_locate(*b, corners) == 1)
        return dict(ii=bool((ina >= 0).any() or inner.any()), ie=bool((ina == -1).any()), ei=bool((inb == -1).any()))
    shared = pa[ina == 0]
    same = _same_side(a, b, shared) if len(shared) else np.array([], bool)
    return dict(
        ii=bool((ina == 1).any() or (inb == 1).any() or same.any()),
        ie=bool((ina == -1).any() or (inb == 1).any() or (~same).any()),
        ei=bool((inb == -1).any() or (ina == 1).any() or (~same).any()),
    )


def _meets(a, b) -> bool:
    """Do the closed shapes share a point? (No cutting needed for that.)"""
    if a[0] == 0:
        return bool((_locate(*b, a[1][0]) >= 0).any())
    if b[0] == 0:
        return _meets(b, a)
    s, t = _segments(a[1]), _segments(b[1])
    side = lambda p, q, r: (q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0])
    p, q, u, v = s[:, None, :2], s[:, None, 2:], t[None, :, :2], t[None, :, 2:]
    near = (np.minimum(p, q) <= np.maximum(u, v)).all(2) & (np.maximum(p, q) >= np.minimum(u, v)).all(2)
    if (near & (side(p, q, u) * side(p, q, v) <= 0) & (side(u, v, p) * side(u, v, q) <= 0)).any():
        return True
    starts = lambda shape: np.vstack([c[:1] for c in shape[1]])
    return bool((_locate(*b, starts(a)) >= 0).any() or (_locate(*a, starts(b)) >= 0).any())


def relate(a, b, relation: str) -> bool:
    """Does ``a`` stand in ``relation`` to ``b``? Shapes come from ``parse``."""
    if not _meets(a, b):
        return False
    if relation == "intersects":
        return True
    f = _facts(a, b)
    if relation == "contains":
        return f["ii"] and not f["ei"]
    if relation == "within":
        return f["ii"] and not f["ie"]
    if relation == "touches":
        return not f["ii"]
    if relation == "overlaps":
        if a[0] != b[0]:
            return False
        if a[0] == 1 and not (_parts(a, b)[1] >= 0).any():
            return False
        return f["ii"] and f["ie"] and f["ei"]
    if relation == "crosses":
        if a[0] == b[0] == 1:
            return f["ii"] and not (_parts(a, b)[1] >= 0).any()
        if a[0] == b[0]:
            return False
        return f["ii"] and (f["ie"] if a[0] < b[0] else f["ei"])
    raise ValueError(f"unknown relation {relation!r}")
