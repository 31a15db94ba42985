"""Projection and filters over the survey, laboratory and station tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamframe.constants import (
    COLUMN_SETS,
    GEOMETRY_COLUMNS,
    KEY_FIELDS,
    PRESETS,
    PROFILE_FALLBACKS,
    RESULT_FALLBACKS,
    SCHEMAS,
    TABLE_KEYS,
)
from loamframe.functions.conversion import is_missing, plain_number

Keys = DataFrame | Iterable | int | str


def select_set(df: DataFrame, name: str, extra: Sequence[str] = ()) -> DataFrame:
    """One of the named column sets, plus further columns."""
    return df.select(*COLUMN_SETS[name], *extra)


def _processed(column: Column, kind: str) -> Column:
    text = column.cast("string")
    value = {
        "key": lambda: F.coalesce(text, F.lit("")),
        "text": lambda: F.when(is_missing(text), "").otherwise(text),
        "opt_text": lambda: F.when(~is_missing(text), text),
        "opt_double": lambda: plain_number(text),
        "opt_long": lambda: plain_number(text).try_cast("long"),
        "yes_flag": lambda: F.coalesce(F.lower(text) == "yes", F.lit(False)),
    }
    return value[kind]()


def project_schema(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Processed columns under their field names; the rest as ``extra_fields``.

    Requested columns the table lacks are ignored; columns the schema does not
    know, or that have no field of their own, go into the string map.
    """
    schema = SCHEMAS[table]
    wanted = [c for c in (columns or list(schema)) if c in df.columns]
    fields, extras = [], []
    for name in wanted:
        kind, field, _ = schema.get(name, (None, None, False))
        value = _processed(F.col(name), kind) if kind else F.col(name)
        if field:
            fields.append(value.alias(field))
        else:
            extras += [F.lit(name), value.cast("string")]
    empty = F.lit(None).cast("map<string,string>")
    extra = F.create_map(*extras) if extras else F.coalesce(empty, F.from_json(F.lit("{}"), "map<string,string>"))
    return df.select(*fields, extra.alias("extra_fields"))


def where_all(df: DataFrame, *conditions: Column | str) -> DataFrame:
    """Rows that satisfy every condition."""
    return reduce(lambda out, c: out.where(c), conditions, df)


def _key_table(df: DataFrame, column: str, keys: DataFrame | list) -> DataFrame:
    """Distinct keys as a one-column DataFrame named ``column``."""
    kind = df.schema[column].dataType
    if not isinstance(keys, DataFrame):
        # An Arrow table becomes a local relation, whose size Spark knows.
        keys = df.sparkSession.createDataFrame(pa.table({column: pa.array([str(k) for k in keys], pa.string())}))
    return keys.select(F.col(keys.columns[0]).try_cast(kind).alias(column)).distinct()


def keep_keys(df: DataFrame, column: str, keys: Keys) -> DataFrame:
    """Rows whose ``column`` is among the keys.

    Keys become a table and a semi-join, which Spark broadcasts only when its
    measured size is small.
    """
    if isinstance(keys, (int, str)):
        keys = [keys]
    if not isinstance(keys, DataFrame):
        keys = list(keys)
        if not keys:
            return df.where(F.lit(False))
    return df.join(_key_table(df, column, keys), column, "left_semi")


def fetch_by_keys(
    df: DataFrame,
    keys: Keys,
    table: str,
    key_column: str | None = None,
    columns: Sequence[str] | None = None,
    include_geometry: bool = False,
) -> DataFrame:
    """Rows whose key is in ``keys`` (a table or a plain list of keys).

    A semi-join: each row comes back once however often its key is listed, and
    Spark broadcasts the keys only when they are measured to be small.
    """
    column = key_column or TABLE_KEYS.get(table)
    if column is None:
        raise ValueError(f"unknown table {table!r}: name its key column (known: {sorted(TABLE_KEYS)})")
    if not isinstance(keys, (DataFrame, int, str)):
        keys = list(keys)
        if not keys:
            raise ValueError("no keys given")
    found = keep_keys(df, column, keys)
    if columns is None:
        return found
    geometry = GEOMETRY_COLUMNS.get(table)
    shape = [F.col(geometry).alias("geometry")] if include_geometry and geometry else []
    return found.select(*columns, *shape)


def fetch_preset(df: DataFrame, keys: Keys, preset: str) -> DataFrame:
    """Bulk lookup with one of the nine presets; absent columns are skipped."""
    table, key, columns = PRESETS[preset]
    if columns is not None:
        return fetch_by_keys(df, keys, table, key, [c for c in columns if c in df.columns])
    geometry = GEOMETRY_COLUMNS[table]
    return fetch_by_keys(df, keys, table, key).withColumnRenamed(geometry, "geometry")


def filter_by_keys_multi(
    df: DataFrame,
    table: str,
    primary: Keys | None = None,
    secondary: Keys | None = None,
    tertiary: Keys | None = None,
) -> DataFrame:
    """AND of up to three value lists; an empty list matches nothing."""
    out = df
    for field, values in zip(KEY_FIELDS[table], (primary, secondary, tertiary)):
        if values is not None and field is not None:
            out = keep_keys(out, field, values)
    return out


def filter_ci_in(df: DataFrame, column: str, values: Keys) -> DataFrame:
    """Case-insensitive membership."""
    keyed = df.withColumn("_lower", F.lower(F.col(column).cast("string")))
    if isinstance(values, DataFrame):
        lowered = values.select(F.lower(F.col(values.columns[0]).cast("string")))
    else:
        lowered = [str(v).lower() for v in ([values] if isinstance(values, (int, str)) else values)]
    return keep_keys(keyed, "_lower", lowered).drop("_lower")


def filter_bbox_points(df: DataFrame, lat: str, lon: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Points in an inclusive (xmin, ymin, xmax, ymax) box; null never matches."""
    xmin, ymin, xmax, ymax = box
    return df.where(F.col(lat).between(ymin, ymax) & F.col(lon).between(xmin, xmax))


def _wildcard(column: Column, patterns: Iterable[str]) -> Column:
    """Anchored match against any of the ``*`` patterns (one regular expression)."""
    parts = [".*".join(re.escape(piece) for piece in p.split("*")) for p in patterns]
    return column.rlike("^(?:" + "|".join(parts) + ")$")


def filter_stations(
    df: DataFrame,
    triplets: Sequence[str] = (),
    networks: Sequence[str] = (),
    states: Sequence[str] = (),
    names: Sequence[str] = (),
    counties: Sequence[str] = (),
    hucs: Sequence[str] = (),
    dcos: Sequence[str] = (),
    elements: Sequence[str] = (),
    durations: Sequence[str] = (),
    sensors: DataFrame | None = None,
    active_only: bool = True,
    as_of: str | None = None,
) -> DataFrame:
    """Stations by wildcard lists; lists are alternatives, filters combine.

    A state alone means ``*:state:*`` (second slot of the triplet). ``elements``
    and ``durations`` look at the ``sensors`` table. Active means no end date,
    or one after ``as_of`` when given.
    """
    patterns = list(triplets)
    if networks and states:
        patterns += [f"*:{s}:{n}" for n in networks for s in states]
    else:
        patterns += [f"*:*:{n}" for n in networks] + [f"*:{s}:*" for s in states]
    wanted = [("station_triplet", patterns), ("name", names), ("county", counties), ("huc", hucs), ("dco_code", dcos)]
    out = df
    for column, values in wanted:
        if values:
            out = out.where(_wildcard(F.col(column), values))
    if active_only:
        ended = F.col("end_date").try_cast("date")
        open_ended = ended.isNull()
        out = out.where(open_ended | (ended > F.lit(as_of).cast("date")) if as_of else open_ended)
    if elements or durations:
        if sensors is None:
            raise ValueError("element and duration filters need the sensor table")
        code = F.concat_ws(":", "element_code", F.coalesce(F.col("height_depth").cast("string"), F.lit("")), F.col("ordinal"))
        hits = sensors
        if elements:
            hits = hits.where(_wildcard(code, elements) | F.col("element_code").isin(*elements))
        if durations:
            hits = hits.where(F.col("duration").isin(*durations))
        out = out.join(hits.select("station_triplet").distinct(), "station_triplet", "left_semi")
    return out


def filter_active(df: DataFrame, removal: str = "removal_date") -> DataFrame:
    """Stations that were never removed."""
    return df.where(F.col(removal).isNull())


def filter_major_components(df: DataFrame) -> DataFrame:
    return df.where(F.col("majcompflag") == "Yes")


def filter_date_range(df: DataFrame, ts: str, start: str | None = None, end: str | None = None, as_of: str | None = None) -> DataFrame:
    """Inclusive days; without dates the 30 days up to ``as_of``.

    The bounds are literals on the raw column, so they reach the scan.
    """
    if start is None or end is None:
        if as_of is None:
            raise ValueError("give start and end, or as_of")
        last = date.fromisoformat(end or as_of)
        first = date.fromisoformat(start) if start else last - timedelta(days=30)
    else:
        first, last = date.fromisoformat(start), date.fromisoformat(end)
    kind = df.schema[ts].dataType
    upper = last + timedelta(days=1)
    return df.where((F.col(ts) >= F.lit(first.isoformat()).cast(kind)) & (F.col(ts) < F.lit(upper.isoformat()).cast(kind)))


def match_columns(
    available: Sequence[str], wanted: Sequence[str], fallbacks: Mapping[str, Sequence[str]] | None = None, loose: bool = True
) -> dict[str, str]:
    """wanted -> present column name.

    Exact, then listed fallback; with ``loose`` also ignoring case, then where
    one name contains the other (result sets). Profiles use ``loose=False``.
    """
    known = {**(RESULT_FALLBACKS if loose else PROFILE_FALLBACKS), **(fallbacks or {})}
    found = {}
    for name in wanted:
        candidates = [c for c in [name, *known.get(name, ())] if c in available]
        if loose:
            low = name.lower()
            candidates += [c for c in available if c.lower() == low]
            candidates += [c for c in available if low in c.lower() or c.lower() in low]
        if candidates:
            found[name] = candidates[0]
    return found


def harmonize_columns(
    dfs: Sequence[DataFrame], wanted: Sequence[str], fallbacks: Mapping[str, Sequence[str]] | None = None, loose: bool = True
) -> DataFrame:
    """Bag union of tables with differing headers under the ``wanted`` names."""
    renamed = []
    for df in dfs:
        match = match_columns(df.columns, wanted, fallbacks, loose)
        renamed.append(df.select(*[F.col(f"`{source}`").alias(name) for name, source in match.items()]))
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), renamed)
    return merged.select(*[F.col(c) if c in merged.columns else F.lit(None).cast("string").alias(c) for c in wanted])


def fill_missing(df: DataFrame, required: Sequence[str], fallback: Mapping[str, object]) -> DataFrame:
    """Blank values replaced; ``missing_fields`` lists what is still missing."""
    blank = {c: (F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")) if c in df.columns else F.lit(True) for c in required}
    still = F.array_compact(F.array(*[F.when(blank[c], F.lit(c)) for c in required if c not in fallback]).cast("array<string>"))
    filled = {}
    for c in required:
        if c in fallback:
            value = F.lit(fallback[c])
            filled[c] = F.when(blank[c], value.cast(df.schema[c].dataType)).otherwise(F.col(c)) if c in df.columns else value
    return df.withColumn("missing_fields", still).withColumns(filled)
