"""Laboratory pedons and layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamframe.constants import (
    LAB_FRACTION_TABLES,
    LAB_LABSAMPNUM_TABLES,
    LAB_LAYER_KEY_TABLES,
    LAB_PEDON_TABLES,
    LAB_PREP_TABLES,
    LAYER_TYPES,
    PREP_CODES,
    SIZE_FRACTIONS,
)
from loamframe.operators.selection import Keys, filter_bbox_points, filter_ci_in


def _join_key(table: str) -> str:
    if table in LAB_LAYER_KEY_TABLES:
        return "layer_key"
    if table in LAB_LABSAMPNUM_TABLES:
        return "labsampnum"
    if table in LAB_PEDON_TABLES:
        return "pedon_key"
    raise ValueError(f"unknown property table: {table!r}")


def lab_layers(layers: DataFrame, properties: Mapping[str, DataFrame]) -> DataFrame:
    """Layers with their property tables, each column prefixed by its table."""
    out = layers
    for table, df in properties.items():
        key = _join_key(table)
        prefixed = df.select(F.col(key).alias(f"_{table}_key"), *[F.col(c).alias(f"{table}.{c}") for c in df.columns if c != key])
        out = out.join(prefixed, out[key] == prefixed[f"_{table}_key"], "left").drop(f"_{table}_key")
    return out


def _codes(values: Sequence[str], allowed: Sequence[str], what: str) -> list[str]:
    wrong = [v for v in values if v not in allowed]
    if wrong:
        raise ValueError(f"invalid {what}: {wrong}")
    return list(values)


def filter_lab_codes(
    rows: DataFrame,
    tables: Sequence[str],
    prep_codes: Sequence[str] = ("S", ""),
    size_fractions: Sequence[str] = ("<2 mm", ""),
    layer_types: Sequence[str] = (),
) -> DataFrame:
    """Keep joined layers whose codes are allowed in every table that has them.

    Works on the output of :func:`lab_layers`. A layer without a match has null
    codes, which count as '', so it stays exactly when '' is allowed.
    """

    def allowed(table: str, column: str, codes: list[str]) -> Column:
        return F.coalesce(F.col(f"`{table}.{column}`"), F.lit("")).isin(*codes)

    out = rows
    if layer_types:
        out = out.where(F.col("layer_type").isin(*_codes(layer_types, LAYER_TYPES, "layer type")))
    if prep_codes:
        codes = _codes(prep_codes, PREP_CODES, "preparation code")
        for table in tables:
            if table in LAB_PREP_TABLES:
                out = out.where(allowed(table, "prep_code", codes))
    if size_fractions:
        codes = _codes(size_fractions, SIZE_FRACTIONS, "size fraction")
        for table in tables:
            if table in LAB_FRACTION_TABLES:
                out = out.where(allowed(table, "analyzed_size_frac", codes))
    return out


def pedon_with_related(pedons: DataFrame, related: Mapping[str, DataFrame]) -> DataFrame:
    """Pedons with any number of tables keyed by pedon, columns prefixed."""
    out = pedons
    for table, df in related.items():
        prefixed = df.select(F.col("pedon_key").alias("_key"), *[F.col(c).alias(f"{table}.{c}") for c in df.columns if c != "pedon_key"])
        out = out.join(prefixed, out["pedon_key"] == prefixed["_key"], "left").drop("_key")
    return out


def lab_query(
    sites: DataFrame,
    layers: DataFrame,
    properties: Mapping[str, DataFrame],
    keys: Keys | None = None,
    what: str = "pedon_key",
    where: Column | str | None = None,
    by: str = "pedon_key",
    **codes,
) -> DataFrame:
    """Layers of the sites picked by keys (any case) or by a predicate.

    The site keys never leave the cluster: the second stage is a semi-join.
    """
    if keys is not None and where is not None:
        raise ValueError("give either keys or a predicate")
    if keys is None and where is None:
        chosen = sites.where(F.lit(False))
    else:
        chosen = filter_ci_in(sites, what, keys) if keys is not None else sites.where(where)
    picked = layers.join(chosen.select(F.col("pedon_key").alias(by)).distinct(), by, "left_semi")
    return filter_lab_codes(lab_layers(picked, properties), list(properties), **codes)


def pedon_horizons(layers: DataFrame, properties: Mapping[str, DataFrame], keys: DataFrame | None = None) -> DataFrame:
    """Horizon-type layers with properties, optionally of given pedons."""
    rows = layers.where(F.col("layer_type") == "horizon")
    if keys is not None:
        rows = rows.join(keys.select("pedon_key").distinct(), "pedon_key", "left_semi")
    return lab_layers(rows, properties)


def sites_in_bbox(sites: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    return filter_bbox_points(sites, "latitude_decimal_degrees", "longitude_decimal_degrees", box)


def pedon_site_and_horizons(
    sites: DataFrame, layers: DataFrame, properties: Mapping[str, DataFrame], box: tuple[float, float, float, float], output: str = "site"
):
    """Sites in a box ("site"), with their horizons apart ("combined") or joined
    to one row per horizon ("profile")."""
    inside = sites_in_bbox(sites, box)
    if output == "site":
        return inside
    horizons = pedon_horizons(layers, properties, inside)
    if output == "combined":
        return {"site": inside, "horizons": horizons}
    if output == "profile":
        from loamframe.operators.profiles import build_profiles

        return build_profiles(horizons, inside, columns=("pedon_key", "layer_key", "hzn_top", "hzn_bot"))
    raise ValueError(f"output {output!r}")


def pedon_by_id(sites: DataFrame, ids: DataFrame) -> DataFrame:
    """Sites by pedon key; ids without such a key are tried as user ids."""
    wanted = ids.select(F.col(ids.columns[0]).alias("wanted")).distinct()
    by_key = wanted.join(sites, wanted["wanted"] == sites["pedon_key"])
    rest = wanted.join(sites.select("pedon_key"), F.col("wanted") == F.col("pedon_key"), "left_anti")
    by_user = rest.join(sites, rest["wanted"] == sites["upedonid"])
    return by_key.unionByName(by_user)
