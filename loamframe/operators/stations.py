"""Stations, their sensors and their time series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamframe.constants import (
    ELEMENT_OF,
    HEIGHT_DEPTH_PROPERTIES,
    PROPERTIES,
    SECOND_NETWORK_VARIABLES,
)
from loamframe.functions import readings as r
from loamframe.functions.periods import period_end, period_start
from loamframe.functions.quantiles import exact_median
from loamframe.functions.rows import compute_once, join_on_keys
from loamframe.operators.aggregates import soil_summary, water_table_summary
from loamframe.operators.selection import filter_date_range
from loamframe.operators.spatial import nearest_stations
from loamframe.session import scratch_path

SERIES = ["station_triplet", "element_code"]


def _literal_map(pairs: Sequence[tuple[str, str]]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs for x in pair])


def element_property(code: Column) -> Column:
    """Property of an element code, else ``unknown_<code>`` (a constant lookup)."""
    by_code = _literal_map([(c, name) for name, c, _ in PROPERTIES])
    return F.coalesce(F.try_element_at(by_code, code), F.concat(F.lit("unknown_"), code))


def property_unit(name: Column) -> Column:
    return F.coalesce(F.try_element_at(_literal_map([(n, unit) for n, _, unit in PROPERTIES]), name), F.lit(""))


def element_to_property(sensors: DataFrame, units: DataFrame | None = None) -> DataFrame:
    """Sensors with ``property_name`` and ``unit``.

    ``units`` is the element reference list (code, unit) and wins over the
    static units where it has one.
    """
    named = sensors.withColumn("property_name", element_property(F.col("element_code")))
    static = property_unit(F.col("property_name"))
    if units is None:
        return named.withColumn("unit", static)
    listed = units.groupBy("code").agg(F.min("unit").alias("_unit"))
    joined = named.join(listed, named["element_code"] == listed["code"], "left")
    return joined.withColumn("unit", F.coalesce(F.nullif("_unit", F.lit("")), static)).drop("code", "_unit")


def sensor_depths(sensors: DataFrame, property_name: str, ordered: bool = False) -> DataFrame:
    """Depths of one property's sensors; most negative (deepest) first."""
    if property_name not in HEIGHT_DEPTH_PROPERTIES:
        raise ValueError(f"{property_name!r} has no height or depth")
    depth = F.coalesce("height_depth", F.lit(0))
    ordinal = F.coalesce("ordinal", F.lit(1))
    rows = sensors.where(F.col("element_code") == ELEMENT_OF[property_name]).select(
        "station_triplet",
        depth.alias("height_depth_inches"),
        ordinal.alias("ordinal"),
        F.concat_ws(":", "element_code", depth, ordinal).alias("element_string"),
        *[c for c in ("begin_date", "end_date", "data_precision") if c in sensors.columns],
    )
    return rows.orderBy("station_triplet", "height_depth_inches", "ordinal") if ordered else rows


def sensor_inventory(sensors: DataFrame) -> DataFrame:
    """The sensors of every station and property, one row each."""
    columns = {
        "height_depth_inches": F.col("height_depth"), "ordinal": F.coalesce("ordinal", F.lit(1)), "element_code": F.col("element_code"),
        "begin_date": F.col("begin_date"), "end_date": F.col("end_date"), "data_precision": F.col("data_precision"),
        "stored_unit_code": F.col("stored_unit_code"), "original_unit_code": F.col("original_unit_code"),
        "derived_data": F.coalesce("derived_data", F.lit(False)),
    }
    return sensors.select(
        "station_triplet", element_property(F.col("element_code")).alias("property_name"), *[c.alias(n) for n, c in columns.items()]
    )


def available_properties(sensors: DataFrame) -> DataFrame:
    """Measured properties per station with code, unit, description and number of sensors."""
    name = F.col("property_name")
    unknown = name.startswith("unknown_")
    code = F.coalesce(F.try_element_at(_literal_map([(n, c) for n, c, _ in PROPERTIES]), name), F.replace(name, F.lit("unknown_"), F.lit("")))
    found = sensor_inventory(sensors).groupBy("station_triplet", "property_name").agg(F.count(F.lit(1)).alias("n_sensors"))
    return found.select(
        "station_triplet", "property_name",
        code.alias("element_code"),
        F.when(unknown, "").otherwise(property_unit(name)).alias("unit"),
        F.when(unknown, F.concat(F.lit("Unknown element "), code)).otherwise(F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))).alias("description"),
        "n_sensors",
    )


FLAG_COLUMNS = ["qc_flag", "qa_flag", "orig_qc_flag"]
POINT_COLUMNS = ["qc_flag", "qa_flag", "orig_value", "orig_qc_flag", "average", "median"]


def property_near_parts(
    sites: DataFrame,
    stations: DataFrame,
    sensors: DataFrame,
    readings: DataFrame,
    property_name: str,
    start: str,
    end: str,
    depth: int | None = None,
    max_km: float = 50.0,
    networks: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """The nearest station of every site, and the series of those stations.

    The first result has a row per site, with what is known of its station and
    its sensor; the second has a row per reading, once for each station and not
    for each site. A reading keeps its flags, its value before editing and the
    station's offset from UTC, as far as the tables have them. Sites without a
    station in reach have no row; sites whose station has no readings keep one
    with ``n_data_points`` 0.
    """
    near = nearest_stations(sites, stations, max_km, 1, networks)
    about = [c for c in ("name", "latitude", "longitude", "network_code", "elevation", "data_time_zone") if c in stations.columns]
    known = stations.select("station_triplet", *[F.col(c).alias(f"station_{c}") for c in about]).dropDuplicates(["station_triplet"])
    links = near.select("site_id", "station_triplet", F.round("distance_km", 2).alias("distance_km")).join(known, "station_triplet", "left")
    wanted = links.select("station_triplet").distinct()
    series = station_property_readings(sensors, readings.join(wanted, "station_triplet", "left_semi"), property_name, start, end, depth, POINT_COLUMNS)
    if "data_time_zone" in about:
        offsets = known.select("station_triplet", F.col("station_data_time_zone").alias("station_timezone_offset_hours"))
        series = series.join(offsets, "station_triplet", "left")
    sizes = series.groupBy("station_triplet").agg(F.min("element_string").alias("element_string"), F.count(F.lit(1)).alias("n_data_points"))
    links = links.join(sizes, "station_triplet", "left").withColumn("n_data_points", F.coalesce("n_data_points", F.lit(0)))
    return links, series


def property_near(
    sites: DataFrame,
    stations: DataFrame,
    sensors: DataFrame,
    readings: DataFrame,
    property_name: str,
    start: str,
    end: str,
    depth: int | None = None,
    max_km: float = 50.0,
    networks: Sequence[str] = (),
) -> DataFrame:
    """Non-null readings of the nearest station for every site, in one table.

    A series appears once for each of its sites; ``property_near_parts`` keeps
    sites and series apart.
    """
    near = nearest_stations(sites, stations, max_km, 1, networks).select("site_id", "station_triplet", F.round("distance_km", 2).alias("distance_km"))
    series = station_property_readings(sensors, readings, property_name, start, end, depth)
    return near.join(series, "station_triplet")


def station_property_readings(
    sensors: DataFrame, readings: DataFrame, property_name: str, start: str, end: str, depth: int | None = None, extra: Sequence[str] = ()
) -> DataFrame:
    """Readings of one property from one sensor per station.

    The sensor is the one at ``depth``, or the one with the lowest height/depth
    value (the deepest). Where none is listed, and for properties without a
    depth, it is the lowest ordinal that has readings, then the lowest depth,
    under the plain code. Columns named in ``extra`` stay where ``readings`` has
    them; with flag columns among them, ``flags`` lists those that are set.
    """
    code = ELEMENT_OF[property_name]
    element = r.parse_element(F.col("element_code"))
    rows = (
        filter_date_range(readings, "ts", start, end)
        .where(F.col("element_code").startswith(code) & F.col("value").isNotNull())
        .withColumn("_e", element)
        .where(F.col("_e.base_code") == code)
    )
    if property_name not in HEIGHT_DEPTH_PROPERTIES:
        chosen = _one_sensor(rows).withColumn("element_string", F.lit(code))
    elif depth is not None:
        chosen = rows.where((F.col("_e.depth_inches") == depth) & (F.col("_e.ordinal") == 1)).withColumn(
            "element_string", F.lit(f"{code}:{depth}:1")
        )
    else:
        deepest = Window.partitionBy("station_triplet").orderBy("height_depth_inches", "_ordinal")
        first = (
            sensor_depths(sensors, property_name)
            .select("station_triplet", "height_depth_inches", F.col("ordinal").alias("_ordinal"), "element_string")
            .withColumn("_rank", F.row_number().over(deepest))
            .where("_rank = 1")
            .drop("_rank")
        )
        same = (F.col("_e.depth_inches") == F.col("height_depth_inches")) & (F.col("_e.ordinal") == F.col("_ordinal"))
        listed = rows.join(first, "station_triplet").where(same).drop("height_depth_inches", "_ordinal")
        unlisted = _one_sensor(rows.join(first, "station_triplet", "left_anti")).withColumn("element_string", F.lit(code))
        chosen = listed.unionByName(unlisted)
    more = [c for c in extra if c in readings.columns]
    flags = [r.qc_flags(*[F.col(c) for c in FLAG_COLUMNS]).alias("flags")] if set(FLAG_COLUMNS) <= set(more) else []
    return chosen.select("station_triplet", "element_string", "ts", "value", *more, *flags, property_unit(F.lit(property_name)).alias("unit"))


def station_property_totals(
    sensors: DataFrame, readings: DataFrame, properties: Sequence[str], start: str, end: str
) -> DataFrame:
    """(station_triplet, property_name, n, total) of several properties in one
    scan of the readings, each from the sensor ``station_property_readings``
    takes without a depth.

    Readings are added up per sensor before they are shuffled; the choice is
    made among the sums of a station's sensors.
    """
    codes = {ELEMENT_OF[name]: name for name in properties}
    element = F.col("_e.base_code")
    rows = (
        filter_date_range(readings, "ts", start, end)
        .where(reduce(or_, [F.col("element_code").startswith(code) for code in codes]) & F.col("value").isNotNull())
        .withColumn("_e", r.parse_element(F.col("element_code")))
        .where(element.isin(*codes))
    )
    keys = ["station_triplet", "property_name"]
    name = F.try_element_at(_literal_map(list(codes.items())), element).alias("property_name")
    sums = rows.groupBy("station_triplet", name, F.coalesce("_e.ordinal", F.lit(1)).alias("ordinal"), F.col("_e.depth_inches").alias("depth")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")
    )
    deep = {ELEMENT_OF[p]: p for p in properties if p in HEIGHT_DEPTH_PROPERTIES}
    if deep:
        sensor = F.struct(F.coalesce("height_depth", F.lit(0)).alias("depth"), F.coalesce("ordinal", F.lit(1)).alias("ordinal"))
        property_of = F.try_element_at(_literal_map(list(deep.items())), F.col("element_code")).alias("property_name")
        listed = sensors.where(F.col("element_code").isin(*deep)).groupBy("station_triplet", property_of).agg(F.min(sensor).alias("_listed"))
        sums = sums.join(listed, keys, "left")
    else:
        sums = sums.withColumn("_listed", F.lit(None).cast("struct<depth:int,ordinal:int>"))
    taken = F.col("_listed").isNull() | ((F.col("depth") == F.col("_listed.depth")) & (F.col("ordinal") == F.col("_listed.ordinal")))
    first = F.min(F.when(taken, F.struct("ordinal", "depth", "n", "total"))).alias("_first")
    return sums.groupBy(*keys).agg(first).where("_first IS NOT NULL").select(*keys, "_first.n", "_first.total")


def _one_sensor(rows: DataFrame) -> DataFrame:
    """Readings of one sensor per station: lowest ordinal, then lowest depth."""
    sensor = F.struct(F.coalesce("_e.ordinal", F.lit(1)).alias("ordinal"), F.col("_e.depth_inches").alias("depth"))
    marked = rows.withColumn("_sensor", sensor)
    first = marked.groupBy("station_triplet").agg(F.min("_sensor").alias("_first"))
    return marked.join(first, "station_triplet").where(F.col("_sensor").eqNullSafe(F.col("_first"))).drop("_sensor", "_first")


def moisture_profile(sites, stations, sensors, readings, start, end, max_km=50.0, network="SCAN") -> DataFrame:
    """Soil moisture of the nearest station of one network."""
    return property_near(sites, stations, sensors, readings, "soil_moisture", start, end, None, max_km, [network])


def temperature_profile(sites, stations, sensors, readings, start, end, max_km=50.0, network="SCAN") -> DataFrame:
    """Soil temperature of the nearest station of one network."""
    return property_near(sites, stations, sensors, readings, "soil_temp", start, end, None, max_km, [network])


def precipitation(sites, stations, sensors, readings, start, end, max_km=50.0) -> DataFrame:
    """Precipitation of the nearest station of any network."""
    return property_near(sites, stations, sensors, readings, "precipitation", start, end, None, max_km)


def moisture_by_depth(readings: DataFrame, depths: Sequence[int] | None = None) -> DataFrame:
    """Soil-moisture series in long form with the sensor depth."""
    rows = readings.where(F.col("element_code").startswith("SMS:")).withColumn("_e", r.parse_element(F.col("element_code")))
    if depths is not None:
        rows = rows.where(F.col("_e.depth_inches").isin(*depths))
    return rows.select("station_triplet", F.col("_e.depth_inches").alias("depth_inches"), "ts", "value").where("value IS NOT NULL")


def recommended_depths(clay: Column) -> Column:
    """Sensor depths (inches) to look at for a clay content."""
    deep = lambda *d: F.array(*[F.lit(x) for x in d])
    return F.when(clay < 20, deep(-2, -4)).when(clay < 35, deep(-2, -4, -8)).when(clay.isNotNull(), deep(-2, -4, -8, -16, -20))


def water_stress(awc: Column, moisture_pct: Column) -> Column:
    """Stress level of a moisture (percent) against awc in in/in."""
    available = awc * 100
    return (
        F.when(moisture_pct >= available * 0.75, "optimal")
        .when(moisture_pct >= available * 0.5, "moderate")
        .when(moisture_pct >= available * 0.25, "mild_stress")
        .when(moisture_pct.isNotNull() & available.isNotNull(), "severe_stress")
    )


def normalize_elements(df: DataFrame, code: str = "element_code", depth_cm: str = "depth_cm", ordinal: str = "ordinal") -> DataFrame:
    """Adds the BASE:depth:ordinal string, inches, and the parsed-back parts."""
    out = df.withColumn("element_string", r.element_string(F.col(code), F.col(depth_cm), F.col(ordinal)))
    return out.withColumn("depth_inches", r.cm_to_inches(F.col(depth_cm))).withColumn("parsed", r.parse_element(F.col("element_string")))


def unify_networks(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both networks' readings in one schema, each with its own element codes."""
    columns = [*SERIES, "ts", "value", "qc_flag", "qa_flag"]
    other = second.select(
        F.col("station_id").alias("station_triplet"), r.base_code(F.col("variable")).alias("element_code"), "ts", "value", "qc_flag", "qa_flag"
    )
    return first.select(*columns, F.lit(1).alias("network")).unionByName(other.withColumn("network", F.lit(2)))


def aggregate_period(
    readings: DataFrame, duration: str, period_ref: str = "START", tendency: str = "AVERAGE", keys: Sequence[str] = SERIES
) -> DataFrame:
    """Mean and/or exact median per period ("AVERAGE", "MEDIAN" or "ALL")."""
    rows = readings.where("value IS NOT NULL").withColumn("period", period_start(F.col("ts"), duration))
    by = [*keys, "period"]
    out = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *([F.avg("value").alias("average")] if tendency in ("AVERAGE", "ALL") else [])
    )
    if tendency in ("MEDIAN", "ALL"):
        out = join_on_keys(out, exact_median(rows, by, "value"), by)
    if period_ref == "END":
        out = out.withColumn("period", period_end(F.col("period"), duration))
    return out


def period_means(readings: DataFrame, durations: Sequence[str], period_ref: str = "START", keys: Sequence[str] = SERIES) -> DataFrame:
    """Mean per period of several durations, in one pass over the readings."""
    starts = [F.struct(F.lit(d).alias("duration"), period_start(F.col("ts"), d).alias("period")) for d in durations]
    rows = readings.where("value IS NOT NULL").select(*keys, "value", F.explode(F.array(*starts)).alias("_p"))
    out = rows.groupBy(*keys, F.col("_p.duration").alias("duration"), F.col("_p.period").alias("period")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("average")
    )
    if period_ref == "END":
        ends = [F.when(F.col("duration") == d, period_end(F.col("period"), d)) for d in durations]
        out = out.withColumn("period", F.coalesce(*ends))
    return out


def upsert_readings(base: DataFrame, changes: DataFrame) -> DataFrame:
    """Latest version per (station, element, time); changes win ties."""
    both = base.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)))
    order = Window.partitionBy(*SERIES, "ts").orderBy(F.desc_nulls_last("updated_at"), F.desc("_new"), F.desc("value"))
    return both.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank", "_new")


def changed_since(readings: DataFrame, since: str) -> DataFrame:
    """Only values inserted or updated on or after a day."""
    return readings.where(F.col("updated_at") >= F.lit(since).cast(readings.schema["updated_at"].dataType))


def drop_suspect(readings: DataFrame, keep_suspect: bool = False, original_values: bool = True, suspect: Sequence[str] = ("S",)) -> DataFrame:
    """Without suspect values (by QC or QA flag) unless asked for."""
    out = readings
    if not keep_suspect:
        flagged = F.coalesce(F.col("qc_flag").isin(*suspect), F.lit(False)) | F.coalesce(F.col("qa_flag").isin(*suspect), F.lit(False))
        out = out.where(~flagged)
    return out if original_values else out.drop("orig_value", "orig_qc_flag")


def station_series(requests: DataFrame, readings: DataFrame, duration: str = "DAILY") -> DataFrame:
    """Mean series for a table of requests (request_id, station, element, start, end).

    Only readings of the series and days asked for are added up, per day and, for
    periods longer than that, per period with a list of its days. A request takes
    whole periods as they are and cuts its broken first and last period from that
    list, so it meets one row per period and nothing is gathered per request.
    Periods are met by year: a short request does not
    meet a long series. Requests without both dates, or that end before they
    start, have no rows; ``request_id`` names one request.
    """
    period = period_start(F.col("ts"), duration)
    valid = requests.where("start_date <= end_date").select("request_id", *SERIES, "start_date", "end_date")
    rows = _asked_for(valid, readings.where("value IS NOT NULL"))
    sums = [F.sum("value").alias("_sum"), F.count(F.lit(1)).alias("_n")]
    by_year = valid.withColumn("_year", F.explode(F.sequence(F.year("start_date"), F.year("end_date"))))
    kept = ["request_id", *SERIES, "period", "_sum", "_n"]
    if duration in ("HOURLY", "DAILY"):
        fine = _written(rows.groupBy(*SERIES, period.alias("period")).agg(*sums), "periods").withColumn("_year", F.year("period"))
        inside = F.to_date("period").between(F.col("start_date"), F.col("end_date"))
        found = by_year.join(fine, [*SERIES, "_year"]).where(inside).select(*kept)
        return found.select("request_id", *SERIES, "period", F.col("_n").alias("n"), (F.col("_sum") / F.col("_n")).alias("average"))
    days = rows.groupBy(*SERIES, F.to_date("ts").alias("ts")).agg(*sums).withColumn("period", period)
    # A period has at most 366 days: a broken one is cut from them in its request's own row.
    listed = F.array_sort(F.collect_list(F.struct("ts", "_sum", "_n"))).alias("_days")
    by_period = _written(days.groupBy(*SERIES, "period").agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"), listed), "periods")
    periods = by_period.drop("_days").withColumn("_year", F.year("period"))
    last_day = lambda start: F.to_date(period_end(start, duration))
    whole = by_year.join(periods, [*SERIES, "_year"]).where((F.to_date("period") >= F.col("start_date")) & (last_day(F.col("period")) <= F.col("end_date")))
    ends = F.array_distinct(F.array(*[period_start(F.col(c).cast("timestamp_ntz"), duration) for c in ("start_date", "end_date")]))
    broken = valid.withColumn("period", F.explode(ends)).where(
        (F.to_date("period") < F.col("start_date")) | (last_day(F.col("period")) > F.col("end_date"))
    )
    inside = F.filter("_days", lambda d: d["ts"].between(F.col("start_date"), F.col("end_date")))
    added = F.aggregate(
        inside, F.struct(F.lit(0.0).alias("_sum"), F.lit(0).cast("long").alias("_n")),
        lambda t, d: F.struct((t["_sum"] + d["_sum"]).alias("_sum"), (t["_n"] + d["_n"]).alias("_n")),
    )
    part = compute_once(broken.join(by_period.select(*SERIES, "period", "_days"), [*SERIES, "period"]), "_part", added)
    edges = part.where("_part._n > 0").select("request_id", *SERIES, "period", "_part._sum", "_part._n")
    found = whole.select(*kept).unionByName(edges)
    return found.select("request_id", *SERIES, "period", F.col("_n").alias("n"), (F.col("_sum") / F.col("_n")).alias("average"))


def _asked_for(requests: DataFrame, readings: DataFrame) -> DataFrame:
    """Readings of the series that requests name, between their first and last day."""
    asked = _written(requests.groupBy(*SERIES).agg(F.min("start_date").alias("_from"), F.max("end_date").alias("_to")), "asked")
    return readings.join(asked, SERIES).where(F.to_date("ts").between(F.col("_from"), F.col("_to"))).drop("_from", "_to")


def _written(df: DataFrame, name: str) -> DataFrame:
    """A step of its own: worked out once, and Spark knows its size, so it sends a
    short table to the other side of a join and never the reverse."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def second_network_variables(stations: DataFrame) -> DataFrame:
    """The four variables each second-network station may carry."""
    return stations.select(
        "station_id", F.explode(F.array(*[F.lit(v) for v in SECOND_NETWORK_VARIABLES])).alias("variable")
    ).withColumn("element_code", r.base_code(F.col("variable")))


def soil_climate_join(
    sites: DataFrame, water: DataFrame, water_table: DataFrame, stations: DataFrame, sensors: DataFrame, readings: DataFrame,
    start: str, end: str, max_km: float = 50.0, network: str = "SCAN",
) -> DataFrame:
    """Per site: soil summary of its area and the nearest stations' measurements.

    ``sites`` has site_id, latitude, longitude and areasymbol. Readings are
    scanned once for all properties and summed up per station before they meet
    the sites.
    """
    out = sites.join(soil_summary(water, ["areasymbol"]), "areasymbol", "left").join(
        water_table_summary(water_table, ["areasymbol"]), "areasymbol", "left"
    )
    measured = {"moisture": "soil_moisture", "precip": "precipitation", "temp": "soil_temp"}
    totals = station_property_totals(sensors, readings, list(measured.values()), start, end).groupBy("station_triplet").agg(
        *[F.max(F.when(F.col("property_name") == p, F.col(c))).alias(f"{name}_{c}") for name, p in measured.items() for c in ("n", "total")]
    )
    for names, networks in ((["moisture", "temp"], [network]), (["precip"], [])):
        near = nearest_stations(sites.select("site_id", "latitude", "longitude"), stations, max_km, 1, networks)
        found = near.select("site_id", "station_triplet", "distance_km").join(totals, "station_triplet", "left")
        columns = [
            column
            for name in names
            for column in (
                F.col("station_triplet").alias(f"{name}_station"), F.col("distance_km").alias(f"{name}_km"),
                F.coalesce(f"{name}_n", F.lit(0)).alias(f"{name}_n"), F.col(f"{name}_total"),
            )
        ]
        out = out.join(found.select("site_id", *columns), "site_id", "left")
    return out
