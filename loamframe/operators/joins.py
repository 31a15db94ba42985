"""Joins down the survey hierarchy: legend, map unit, component, horizon.

Results are unordered unless ``ordered=True``: the global sort of a whole
survey is one more full shuffle and rarely needed downstream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamframe.constants import COLUMN_SETS

_WATER = ["chkey", "hzname", "hzdept_r", "hzdepb_r", "claytotal_r", "silttotal_r", "sandtotal_r", "awc_r", "ksat_r", "om_r"]


def join_tables(left: DataFrame, right: DataFrame, on: Column | str | list[str], how: str = "inner") -> DataFrame:
    """Inner, left, right or full join on any condition; Spark picks the strategy."""
    if how.lower() not in {"inner", "left", "right", "full"}:
        raise ValueError(f"join type {how!r}")
    return left.join(right, on, how.lower())


def _in_areas(legend: DataFrame, areas: DataFrame | str | list[str] | None) -> DataFrame:
    """Legends of the wanted areas (a table with ``areasymbol`` or symbols)."""
    if areas is None:
        return legend
    if isinstance(areas, DataFrame):
        return legend.join(areas.select("areasymbol").distinct(), "areasymbol", "left_semi")
    return legend.where(F.col("areasymbol").isin([areas] if isinstance(areas, str) else list(areas)))


def _sorted(df: DataFrame, ordered: bool, *keys: Column | str) -> DataFrame:
    return df.orderBy(*keys) if ordered else df


def mapunits_by_area(mapunit: DataFrame, legend: DataFrame, areas=None, ordered: bool = False) -> DataFrame:
    """Map units with their area symbol and name; by symbol."""
    joined = mapunit.join(_in_areas(legend, areas), "lkey")
    return _sorted(joined.select(*COLUMN_SETS["mapunit_basic"], "areasymbol", "areaname"), ordered, "musym", "mukey")


def components_by_area(component: DataFrame, mapunit: DataFrame, legend: DataFrame, areas=None, ordered: bool = False) -> DataFrame:
    """Components with map unit and area; by symbol, percent descending."""
    units = mapunit.join(_in_areas(legend, areas), "lkey").select("mukey", "musym", "muname", "areasymbol")
    joined = component.join(units, "mukey")
    return _sorted(
        joined.select(*COLUMN_SETS["component_basic"], "mukey", "musym", "muname", "areasymbol"),
        ordered, "musym", F.desc("comppct_r"), "cokey",
    )


def component_horizons_by_area(
    horizon: DataFrame, component: DataFrame, mapunit: DataFrame, legend: DataFrame, areas=None, ordered: bool = False
) -> DataFrame:
    """Horizons of major components; by symbol, percent descending, top depth."""
    units = mapunit.join(_in_areas(legend, areas), "lkey").select("mukey", "musym", "muname")
    major = component.where(F.col("majcompflag") == "Yes").select("cokey", "mukey", "compname", "comppct_r")
    joined = horizon.select("cokey", *COLUMN_SETS["chorizon_texture"]).join(major.join(units, "mukey"), "cokey")
    return _sorted(
        joined.select("mukey", "musym", "muname", "cokey", "compname", "comppct_r", *COLUMN_SETS["chorizon_texture"]),
        ordered, "musym", F.desc("comppct_r"), "hzdept_r", "chkey",
    )


def water_properties(
    horizon: DataFrame, component: DataFrame, mapunit: DataFrame, legend: DataFrame, areas=None, ordered: bool = False
) -> DataFrame:
    """Horizon water properties with component and map unit; by component, top."""
    units = mapunit.join(_in_areas(legend, areas), "lkey").select("mukey", "muname", "areasymbol")
    parents = component.select("cokey", "mukey", "compname", "comppct_r").join(units, "mukey")
    joined = horizon.select("cokey", *_WATER).join(parents, "cokey")
    return _sorted(
        joined.select("mukey", "muname", "areasymbol", "cokey", "compname", "comppct_r", *_WATER),
        ordered, "cokey", "hzdept_r", "chkey",
    )


def water_table_by_mapunit(mapunit: DataFrame, muaggatt: DataFrame, legend: DataFrame, areas=None) -> DataFrame:
    """Map units with their aggregated water-table attributes, if any."""
    units = mapunit.join(_in_areas(legend, areas), "lkey").select("mukey", "muname", "areasymbol")
    return units.join(muaggatt, "mukey", "left")


def water_table_by_month(
    component: DataFrame, comonth: DataFrame, mapunit: DataFrame, legend: DataFrame, areas=None, ordered: bool = False
) -> DataFrame:
    """Component-month water-table depths; components without months stay."""
    units = mapunit.join(_in_areas(legend, areas), "lkey").select("mukey", "muname", "areasymbol")
    parents = component.select("cokey", "mukey", "compname", "comppct_r").join(units, "mukey")
    joined = parents.join(comonth, "cokey", "left")
    columns = ["mukey", "muname", "areasymbol", "cokey", "compname", "comppct_r", *[c for c in comonth.columns if c != "cokey"]]
    return _sorted(joined.select(*columns), ordered, "cokey", "month")


def mukeys_by_area(mapunit: DataFrame, legend: DataFrame, areas=None) -> DataFrame:
    """Map-unit keys of the areas, as a table to join with."""
    return mapunit.join(_in_areas(legend, areas), "lkey").select("mukey", "areasymbol")


def cokeys_by_mukey(component: DataFrame, mukeys: DataFrame, major_only: bool = True) -> DataFrame:
    """Component keys of the map units, by default of major components only."""
    rows = component.where(F.col("majcompflag") == "Yes") if major_only else component
    return rows.join(mukeys.select("mukey").distinct(), "mukey", "left_semi").select("cokey", "mukey")


def top_clay_horizons(
    horizon: DataFrame, component: DataFrame, mapunit: DataFrame, legend: DataFrame, areas=None, min_clay: float = 40.0, n: int = 50
) -> DataFrame:
    """The ``n`` most clayey horizons of major components above ``min_clay``."""
    rows = component_horizons_by_area(horizon.where(F.col("claytotal_r") > min_clay), component, mapunit, legend, areas)
    return order_limit(
        rows.select("mukey", "muname", "compname", "hzname", "claytotal_r", "chkey"), [F.desc("claytotal_r"), "chkey"], n
    )


def order_limit(df: DataFrame, keys: list[Column | str], n: int = 0) -> DataFrame:
    """Ordered rows, the first ``n`` of them; 0 means all.

    With a limit Spark keeps the best ``n`` per task and merges those.
    """
    ordered = df.orderBy(*keys)
    return ordered.limit(n) if n else ordered
