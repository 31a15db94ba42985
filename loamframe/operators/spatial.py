"""Spatial lookups on polygons, lines, points and stations."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamframe.constants import EARTH_RADIUS_KM, GEOGRAPHIC_COLUMNS, GEOMETRY_COLUMNS, PROJECTED_COLUMNS
from loamframe.functions import geometry as g
from loamframe.functions import grid, topology
from loamframe.operators import cells
from loamframe.operators.profiles import nest_mapunits
from loamframe.operators.aggregates import top_k_units
from loamframe.session import scratch_path, shuffles_removed

Box = tuple[float, float, float, float]
TOGETHER = 1024  # rows of one spot or unit that travel as one


def box_wkt(box: Mapping[str, float] | Box) -> str:
    if isinstance(box, Mapping):
        box = (box["xmin"], box["ymin"], box["xmax"], box["ymax"])
    x0, y0, x1, y1 = box
    return f"POLYGON(({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"


def _in_box(x0: float, y0: float, x1: float, y1: float) -> Column:
    """Boxes that share a point: plain columns, so a spatial table skips row groups."""
    return (F.col("_xmin") <= x1) & (F.col("_xmax") >= x0) & (F.col("_ymin") <= y1) & (F.col("_ymax") >= y0)


def _meets_box(x0: float, y0: float, x1: float, y1: float) -> Column:
    return topology.let(g.edges(F.col("_rings")), lambda e: g.polygon_meets_box(e, x0, y0, x1, y1))


def _spots(points: DataFrame, lon: str, lat: str) -> DataFrame:
    """Every place with a point, once, however many points lie there."""
    return points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()).select(lon, lat).distinct()


def _at_spots(points: DataFrame, hits: DataFrame, keep: Sequence[str], lon: str, lat: str) -> DataFrame:
    """All points with what was found at their spots; sorted on both sides, so
    all tasks share the rows, however few files the points came in."""
    return points.join(hits.select(lon, lat, *keep).hint("merge"), [lon, lat]).select(*points.columns, *keep)


def _gathered(rows: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """``by`` and, as arrays of structs, the rows with its values.

    An array has about TOGETHER rows at most: only values with more rows are
    dealt over several arrays, so no task needs all rows of one value.
    """
    many = rows.groupBy(*by).count().where(F.col("count") > TOGETHER).select(*by, F.ceil(F.col("count") / TOGETHER).alias("_parts"))
    part = F.coalesce(F.pmod("_at", "_parts"), F.lit(0)).alias("_part")
    dealt = rows.withColumn("_at", F.monotonically_increasing_id()).join(many, list(by), "left")
    return dealt.groupBy(*by, part).agg(F.collect_list(F.struct(*rows.columns)).alias(name)).drop("_part")


def _at_points(points: DataFrame, made: DataFrame, holds: Column, keep: Sequence[str], lon: str, lat: str, rows: str | None = None) -> DataFrame:
    """All points with ``keep`` of each polygon whose cells (``made``) hold them.

    The points of a spot go to the cells together, are tested once and are
    taken apart where they meet a polygon; so do the structs of the polygon's
    array ``rows``. Pairs are the result and are never dealt: what is shuffled
    are points and cells, however many pairs they make.
    """
    spots = _gathered(points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()), [lon, lat], "_points")
    met = cells.look_up(spots, made, lon, lat).where(holds).select(F.explode("_points").alias("_point"), *keep, *([rows] if rows else []))
    if rows:
        met = met.select("_point", *keep, F.explode(rows).alias("_row"))
    return met.select("_point.*", *keep, *(["_row.*"] if rows else []))


def _holding(polys: DataFrame, keep: Sequence[str], boundary: bool = False, lon: str = "lon", lat: str = "lat", wkt: str = "wkt") -> tuple[DataFrame, Column]:
    """(cells of the polygons, whether a looked-up cell's polygon holds the point)."""
    inside, touching = cells.inside(lon, lat), g.on_boundary(F.col("_edges"), F.col(lon), F.col(lat))
    return cells.polygon_cells(g.with_shape(polys, wkt, polygons_only=True), keep), (inside | touching) if boundary else (inside & ~touching)


def point_in_polygon_join(
    points: DataFrame, polys: DataFrame, keep: Sequence[str], boundary: bool = False, lon: str = "lon", lat: str = "lat", wkt: str = "wkt"
) -> DataFrame:
    """Points with the ``keep`` columns of each polygon that holds them.

    ``boundary=False`` is "contains" (points on the outline do not count),
    ``boundary=True`` is "intersects". ``polys`` has outlines as text or comes
    from a spatial table. Spots of points meet the cells of polygons, with a
    cell's edges only, and are tested once for all points there; points without
    coordinates drop out.
    """
    return _at_points(points, *_holding(polys, keep, boundary, lon, lat, wkt), keep, lon, lat)


def _with_rows(made: DataFrame, rows: DataFrame) -> DataFrame:
    """Cells with the ``rows`` of their units as an array ``_rows``; cells without any drop out.

    The rows are written first: they are counted and gathered, but made once.
    """
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "unit_rows")
    with shuffles_removed(spark):
        rows.where(F.col("mukey").isNotNull()).write.parquet(path)
    return made.join(_gathered(spark.read.parquet(path), ["mukey"], "_rows").hint("merge"), "mukey")


def components_at_points(
    points: DataFrame, polys: DataFrame, mapunit: DataFrame, component: DataFrame, horizon: DataFrame,
    ordered: bool = False, what: Sequence[str] | None = None, **names,
) -> DataFrame:
    """Major components and their horizons at each point.

    ``what`` names the columns of units, components and horizons that are
    wanted; by default all. They go to the points with the polygons' cells.
    """
    major = component.where(F.col("majcompflag") == "Yes").select("cokey", "mukey", "compname", "comppct_r")
    columns = ["chkey", "hzname", "hzdept_r", "hzdepb_r", "sandtotal_r", "silttotal_r", "claytotal_r"]
    below = (
        mapunit.select("mukey", "musym", "muname")
        .join(major, "mukey")
        .join(horizon.select("cokey", *columns), "cokey")
    )
    order = ["comppct_r", "hzdept_r", "chkey"] if ordered else []
    below = below.select("mukey", *[c for c in below.columns if c != "mukey" and (what is None or c in what or c in order)])
    made, held = _holding(polys, ["mukey"], **names)
    joined = _at_points(points, _with_rows(made, below), held, [], names.get("lon", "lon"), names.get("lat", "lat"), "_rows")
    joined = joined.select("mukey", *points.columns, *below.columns[1:])
    return joined.orderBy(F.desc("comppct_r"), "hzdept_r", "chkey") if ordered else joined


def mapunits_at_points(
    points: DataFrame, polys: DataFrame, mapunit: DataFrame, component: DataFrame | None = None, horizon: DataFrame | None = None,
    key: str = "point_id", component_columns: Sequence[str] = (), horizon_columns: Sequence[str] = (), **names,
) -> tuple[DataFrame, DataFrame]:
    """The map units under each point, and those units with all below them.

    The first result is (point key, mukey), the second has the rows of
    ``nest_mapunits`` for the units that hold a point, each unit once however
    many points it holds. A point on an outline belongs to the units on both
    sides; points outside all polygons have no row.
    """
    lon, lat = names.get("lon", "lon"), names.get("lat", "lat")
    links = _unit_links(points, polys, None, key, **names)
    made, held = _holding(polys, ["mukey"], True, **names)
    hit = cells.look_up(_spots(points, lon, lat), made, lon, lat).where(held).select("mukey").distinct()
    units = nest_mapunits(mapunit.join(hit, "mukey", "left_semi"), component, horizon, component_columns, horizon_columns)
    return links, units


def unit_rows_at_points(points: DataFrame, polys: DataFrame, rows: DataFrame, key: str = "point_id", **names) -> DataFrame:
    """The ``rows`` (by mukey) of the map units under each point: the point key and
    all their columns, as a join of the links of ``mapunits_at_points`` with them
    gives, but put together where a point meets a polygon: links are never dealt."""
    return _unit_links(points, polys, rows, key, **names)


def _unit_links(points: DataFrame, polys: DataFrame, rows: DataFrame | None, key: str, lon: str = "lon", lat: str = "lat", wkt: str = "wkt") -> DataFrame:
    """Distinct (point key, mukey), or the point key with the ``rows`` of its units.

    A key at one spot meets a unit of one polygon once. Only units of several
    polygons and keys at several spots are made distinct.
    """
    located = points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull()).select(key, lon, lat)
    ends = located.groupBy(F.col(key).alias("_key")).agg(*[f(c).alias(f"_{n}_{c}") for c in (lon, lat) for n, f in (("least", F.min), ("most", F.max))])
    still = reduce(lambda a, b: a & b, [F.col(f"_least_{c}") == F.col(f"_most_{c}") for c in (lon, lat)])
    single = ends.where(still).select(F.col("_key").alias(key), *[F.col(f"_least_{c}").alias(c) for c in (lon, lat)])
    of_several = polys.groupBy("mukey").count().where((F.col("count") > 1) | F.col("mukey").isNull()).select("mukey")
    moving, several = ends.where(~still).select("_key"), of_several.withColumnRenamed("mukey", "_unit")
    is_several = F.col("mukey").eqNullSafe(F.col("_unit"))
    any_moving, any_several = not moving.isEmpty(), not of_several.isEmpty()
    made, held = _holding(polys, ["mukey"], True, lon, lat, wkt)
    alone = made.join(several.hint("merge"), is_several, "left_anti") if any_several else made
    if rows is None:
        found = _at_points(single, alone, held, ["mukey"], lon, lat).select(key, "mukey")
    else:
        found = _at_points(single, _with_rows(alone, rows), held, [], lon, lat, "_rows").select(key, *rows.columns)
    if not any_moving and not any_several:
        return found
    spark, path = points.sparkSession, scratch_path(points.sparkSession, "units_at")
    hits = cells.look_up(_spots(points, lon, lat), made, lon, lat).where(held).select(lon, lat, "mukey").distinct()
    with shuffles_removed(spark):
        (hits if any_moving else hits.join(several, is_several, "left_semi")).write.parquet(path)
    units_at = spark.read.parquet(path)
    moved = located.join(moving, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    link = lambda places, units: _at_spots(places, units, ["mukey"], lon, lat).select(key, "mukey")
    links = link(single, units_at.join(several, is_several, "left_semi")).unionByName(link(moved, units_at).distinct())
    return found.unionByName(links if rows is None else links.join(rows, "mukey").select(key, *rows.columns))


def polygons_in_bbox(polys: DataFrame, box: Box, mapunit: DataFrame | None = None, wkt: str = "wkt") -> DataFrame:
    """Polygons that share a point with a box, with map-unit attributes."""
    box = tuple(float(v) for v in box)
    found = g.with_shape(polys, wkt, polygons_only=True).where(_in_box(*box)).where(_meets_box(*box)).drop(*g.SHAPE_COLUMNS)
    if mapunit is None:
        return found
    return found.join(mapunit.select("mukey", *[c for c in ("musym", "muname") if c not in polys.columns]), "mukey")


def distinct_units_by_region(polys: DataFrame, regions: Mapping[str, Box], mapunit: DataFrame, wkt: str = "wkt") -> DataFrame:
    """(region, polygonkey, mukey, musym) of every polygon in each named box."""
    boxes = {name: tuple(float(v) for v in box) for name, box in regions.items()}
    # One pass over the polygons for all regions; a polygon in none is not read further.
    near = reduce(lambda a, b: a | b, [_in_box(*box) for box in boxes.values()])
    hits = F.array_compact(F.array(*[F.when(_in_box(*box) & _meets_box(*box), F.lit(name)) for name, box in boxes.items()]))
    return (
        g.with_shape(polys, wkt, polygons_only=True).where(near)
        .select("polygonkey", "mukey", F.explode(hits).alias("region"))
        .join(mapunit.select("mukey", "musym"), "mukey")
    )


def spatial_filter(shapes: DataFrame, query: str | Mapping[str, float] | Box, relation: str = "intersects", wkt: str = "wkt") -> DataFrame:
    """Shapes for which ``shape.relation(query)`` holds.

    Unknown relations mean intersects. A box test on plain columns comes first,
    then the test for a common point, then the relation; all are column
    expressions on the shape's own row.
    """
    relation = relation if relation in topology.RELATIONS else "intersects"
    found, target, box = _meeting(shapes, query, wkt)
    if relation == "contains":
        found = found.where((F.col("_xmin") <= box[0]) & (F.col("_xmax") >= box[2]) & (F.col("_ymin") <= box[1]) & (F.col("_ymax") >= box[3]))
    elif relation == "within":
        found = found.where((F.col("_xmin") >= box[0]) & (F.col("_xmax") <= box[2]) & (F.col("_ymin") >= box[1]) & (F.col("_ymax") <= box[3]))
    if relation != "intersects":
        found = found.where(_facts(target, lambda f: topology.holds(f, relation)))
    return found.drop(*g.SHAPE_COLUMNS)


def spatial_relations(shapes: DataFrame, query: str | Mapping[str, float] | Box, wkt: str = "wkt") -> DataFrame:
    """Shapes that share a point with ``query``, with all ``relations`` that hold
    (array<string>, in the order of ``topology.RELATIONS``), worked out together."""
    found, target, _ = _meeting(shapes, query, wkt)
    names = lambda f: F.array_compact(F.array(*[F.when(topology.holds(f, r), F.lit(r)) for r in topology.RELATIONS]))
    return found.withColumn("relations", _facts(target, names)).drop(*g.SHAPE_COLUMNS)


def _meeting(shapes: DataFrame, query: str | Mapping[str, float] | Box, wkt: str) -> tuple[DataFrame, Column, Box]:
    """(shapes that share a point with the query, the query as a literal, its box)."""
    text = query if isinstance(query, str) else box_wkt(query)
    corners = [p for ring in g.read_outline(text)[1] for p in ring]
    xs, ys = [p[0] for p in corners], [p[1] for p in corners]
    box, target = (min(xs), min(ys), max(xs), max(ys)), g.constant_shape(text)
    kind, rings = F.col("_kind"), F.col("_rings")
    meets = topology.let(g.edges(rings), lambda e: g.shapes_meet(kind, rings, e, target))
    return g.with_shape(shapes, wkt).where(_in_box(*box)).where(meets), target, box


def _facts(target: Column, then: Callable[[Column], Column]) -> Column:
    return topology.let(topology.shape(F.col("_kind"), F.col("_rings")), lambda s: topology.let(topology.facts(s, target), then))


# Default columns of each spatial table and whether map-unit names are joined.
_DEFAULTS = {
    "mupolygon": (["mukey", "musym", "muname", "mukind", "areasymbol", "areaname"], True),
    "sapolygon": (["areasymbol", "spatialversion", "lkey"], False),
    "mupoint": (["mukey", "musym", "muname"], True),
    "muline": (["mukey", "musym", "muname"], True),
    "featpoint": (["featkey", "featsym"], False),
    "featline": (["featkey", "featsym"], False),
}


def spatial_query(
    shapes: DataFrame,
    query: str | Mapping[str, float] | Box,
    table: str = "mupolygon",
    return_type: str = "tabular",
    relation: str = "intersects",
    what: Sequence[str] | None = None,
    mapunit: DataFrame | None = None,
    legend: DataFrame | None = None,
) -> DataFrame:
    """Attributes ("tabular") or attributes and outlines ("spatial") by location.

    Tabular results with the default columns are distinct: the keys are made
    distinct before the attributes are joined.
    """
    if table not in _DEFAULTS:
        raise ValueError(f"table {table!r} has no geometry; use one of {sorted(_DEFAULTS)}")
    shape = GEOMETRY_COLUMNS[table]
    defaults, needs_unit = _DEFAULTS[table]
    columns = list(what or defaults)
    found = spatial_filter(shapes, query, relation, shape)
    distinct = return_type == "tabular" and what is None
    if distinct:
        found = found.select("mukey" if needs_unit else F.struct(*columns).alias("s")).distinct()
        found = found if needs_unit else found.select("s.*")
    if needs_unit and mapunit is not None:
        names = mapunit.select("mukey", "lkey", *[c for c in ("musym", "muname", "mukind") if c in mapunit.columns])
        found = found.drop("lkey", "musym", "muname", "mukind").join(names, "mukey")
        if legend is not None and ({"areasymbol", "areaname"} & set(columns)):
            found = found.drop("areasymbol", "areaname").join(legend.select("lkey", "areasymbol", "areaname"), "lkey")
    marks = ("geometry", "wkt", "geom", "shape")
    if return_type == "spatial" and not any(m in c.lower() for c in columns for m in marks):
        return found.select(*columns, F.col(shape).alias("geometry"))
    return found.select(*columns)


def survey_areas_intersecting(shapes: DataFrame, query: str | Mapping[str, float] | Box) -> DataFrame:
    """Distinct survey areas whose outline meets a shape."""
    return spatial_query(shapes, query, "sapolygon")


def survey_area_boundaries(sapolygon: DataFrame) -> DataFrame:
    return sapolygon.select("areasymbol", "areaname", F.col("sapolygongeo").alias("geometry"))


def list_survey_areas(catalog: DataFrame, table: str = "sacatalog") -> DataFrame:
    """The catalogue (or legend) list by symbol."""
    columns = ["areasymbol", "areaname", "saversion", "saverest"] if table == "sacatalog" else ["lkey", "areasymbol", "areaname", "saversion"]
    return catalog.select(*columns).orderBy("areasymbol")


def polygon_area_length(polys: DataFrame, wkt: str = "wkt") -> DataFrame:
    """Area (m2, equal-area) and perimeter (m) per polygon."""
    rings = F.col("_rings")
    return g.with_shape(polys, wkt, polygons_only=True).withColumns(
        {"shape_area": g.polygon_area_m2(rings), "shape_length": g.perimeter_m(g.edges(rings))}
    ).drop(*g.SHAPE_COLUMNS)


def _nearby(polys: DataFrame, distance: float, keep: Sequence[str], lon: str = "lon", lat: str = "lat", wkt: str = "wkt") -> tuple[DataFrame, Column]:
    """(cells of the polygons with all near them, whether a looked-up cell's polygon is near the point)."""
    near = F.exists("_edges", lambda e: g.edge_distance(e, F.col(lon), F.col(lat)) <= distance)
    return cells.polygon_cells(g.with_shape(polys, wkt, polygons_only=True), keep, float(distance)), cells.inside(lon, lat) | near


def polys_within_distance(
    points: DataFrame, polys: DataFrame, distance: float, keep: Sequence[str], lon: str = "lon", lat: str = "lat", wkt: str = "wkt"
) -> DataFrame:
    """Polygons that meet a buffer of ``distance`` degrees around each point.

    A spot with points meets the cell it lies in, which has all edges within the
    distance of any of its places and no others.
    """
    return _at_points(points, *_nearby(polys, distance, keep, lon, lat, wkt), keep, lon, lat)


def region_area(points: DataFrame, polys: DataFrame, distance: float, by: Sequence[str], key: str = "polygonkey", **names) -> DataFrame:
    """Total equal-area size of the polygons near each point."""
    sized = g.with_shape(polys, names.get("wkt", "wkt"), polygons_only=True).withColumn("shape_area", g.polygon_area_m2(F.col("_rings")))
    lon, lat = names.get("lon", "lon"), names.get("lat", "lat")
    made, near = _nearby(sized, distance, [key, "shape_area"], **names)
    hits = cells.look_up(_spots(points, lon, lat), made, lon, lat).where(near).select(lon, lat, key, "shape_area")
    # Added up per spot first: points of one spot share the sums.
    sums = hits.groupBy(lon, lat).agg(F.count(F.lit(1)).alias("_n"), F.sum("shape_area").alias("_area"))
    found = _at_spots(points, sums, ["_n", "_area"], lon, lat)
    return found.groupBy(*by).agg(F.sum("_n").alias("n_polygons"), F.sum("_area").alias("total_area"))


def watershed_units(polys: DataFrame, query: str, k: int = 5, wkt: str = "wkt") -> DataFrame:
    """The most frequent units among the polygons that meet a shape."""
    return top_k_units(spatial_filter(polys, query, "intersects", wkt), k)


def detect_geometry(columns: Sequence[str]) -> tuple[str, str]:
    """(geometry column, reference system); ("", "EPSG:4326") without any."""
    lower = {c.lower(): c for c in columns}
    for names, system in ((GEOGRAPHIC_COLUMNS, "EPSG:4326"), (["geometry"], "EPSG:4326"), (PROJECTED_COLUMNS, "EPSG:3857")):
        for name in names:
            if name in lower:
                return lower[name], system
    return "", "EPSG:4326"


def drop_invalid_geometry(df: DataFrame, column: str | None = None, crs: str | None = None) -> DataFrame:
    """Rows with a usable shape as ``geometry``, its ``crs`` and ``geometry_type``."""
    if column is None:
        column, detected = detect_geometry(df.columns)
        if not column:
            raise ValueError(f"no geometry column among {df.columns}")
        crs = crs or detected
    shaped = g.with_shape(df, column).drop(*g.SHAPE_COLUMNS[1:])
    return shaped.withColumns({"geometry": F.col(column), "crs": F.lit(crs or "EPSG:4326")}).withColumnRenamed("_kind", "geometry_type")


_GRIDS, _STEP = 12, 1.5  # search grids, each finer than the one before by the step


def nearest_stations(
    sites: DataFrame,
    stations: DataFrame,
    max_km: float = 50.0,
    k: int = 10,
    networks: Sequence[str] = (),
    site_id: str = "site_id",
    station_id: str = "station_triplet",
) -> DataFrame:
    """The ``k`` stations within ``max_km`` of each site, nearest first.

    Both sides carry ``latitude`` and ``longitude``. Stations at one spot count
    only with their first ``k`` ids, and sites at one spot are searched for once.
    Where a site's own cell already holds ``k`` stations, a smaller radius is
    certain to suffice, so crowded places are searched on a finer grid and do
    not produce all their pairs.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    spot, cell = ["latitude", "longitude"], ["grid", "band", "cell"]
    valid = lat.between(-90, 90) & lon.between(-180, 180)
    wanted = stations.where(F.col("network_code").isin(*networks)) if networks else stations
    spots = (
        wanted.where(valid)
        .select(station_id, *spot)
        .withColumn("_rank", F.row_number().over(Window.partitionBy(*spot).orderBy(station_id)))
        .where(F.col("_rank") <= k)
        .drop("_rank")
    )
    radii = [max_km / _STEP**i for i in range(_GRIDS)]
    size = F.element_at(F.array(*[F.lit(float(r)) for r in radii]), F.col("grid") + 1)
    on_all_grids = lambda df: on_grid(df.withColumn("grid", F.explode(F.sequence(F.lit(0), F.lit(_GRIDS - 1)))))

    def on_grid(df: DataFrame) -> DataFrame:
        b = grid.band(lat, size)
        return df.withColumns({"band": b, "cell": grid.band_cell(lon, grid.band_cells(b, size))})

    placed = on_all_grids(spots)
    span = grid.cell_span_km(F.col("band"), grid.band_cells(F.col("band"), size), size)
    crowded = placed.groupBy(*cell).count().where(F.col("count") >= k).select(*cell, span.alias("_span"))
    reached = (
        on_all_grids(sites.where(valid).select(*spot).distinct())
        .join(crowded, cell, "left")
        .groupBy(*spot)
        .agg(F.least(F.lit(float(max_km)), F.min("_span")).alias("_radius"))
    )
    finest = sum(((F.col("_radius") <= r).cast("int") for r in radii[1:]), F.lit(0))
    # A fixed number of parts: a short list of sites has as many pairs to test as a long one may have.
    seeking = (
        reached.withColumn("grid", finest)
        .withColumn("_at", F.explode(grid.search_cells(lat, lon, size, F.col("_radius"))))
        .select(*spot, "grid", "_at.band", "_at.cell")
        .repartition(int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cell)
    )
    targets = placed.withColumnsRenamed({"latitude": "station_latitude", "longitude": "station_longitude"})
    distance = g.haversine_km(lat, lon, F.col("station_latitude"), F.col("station_longitude"), EARTH_RADIUS_KM)

    def first_k(df: DataFrame, by: Sequence[str]) -> DataFrame:
        nearest = Window.partitionBy(*by).orderBy("distance_km", station_id)
        return df.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)

    found = seeking.join(targets.hint("merge"), cell).withColumn("distance_km", distance).where(F.col("distance_km") <= max_km)
    of_spot = first_k(found, spot).select(*spot, station_id, "distance_km")
    # Ranked again by site: rows of one site may lie at several spots.
    return first_k(sites.join(of_spot, spot), [site_id]).select(*sites.columns, station_id, "distance_km", "rank")
