"""Landed JSON feeds of the station networks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamframe.constants import REFERENCE_LISTS, SECOND_NETWORK_VARIABLES
from loamframe.functions.conversion import plain_number
from loamframe.functions.rows import compute_once
from loamframe.functions.readings import base_code, local_to_utc, parse_station_time, qc_flags

STATION = """array<struct<stationTriplet string, name string, latitude string, longitude string,
    elevation double, networkCode string, state string, county string, stationId string, dcoCode string,
    huc string, dataTimeZone int, beginDate string, endDate string,
    stationElements array<struct<elementCode string, heightDepth int, ordinal int, beginDate string,
        endDate string, dataPrecision int, storedUnitCode string, originalUnitCode string,
        derivedData boolean, durationName string>>>>"""

SERIES = """array<struct<stationTriplet string, error string, data array<struct<
    stationElement struct<elementCode string, heightDepth int, ordinal int>,
    values array<struct<date string, value double, qcFlag string, qaFlag string, origValue double,
        origQcFlag string, average double, median double, month int, monthPart string, year int,
        collectionDate string>>>>>>"""

SECOND_STATIONS = """struct<sensors array<struct<sid string, name string, project string, sso string,
    wgs84_latitude string, wgs84_longitude string, elevation_m string, state string, county string,
    huc string, installation_date string, removal_date string>>>"""

_RECORDS = "array<struct<date_time string, sensor_value string, qc_flag string, qa_flag string>>"
SECOND_READINGS = "struct<" + ", ".join(f"{v} {_RECORDS}" for v in SECOND_NETWORK_VARIABLES) + ">"

FORECASTS = """array<struct<stationTriplet string, forecastPointName string, data array<struct<
    elementCode string, forecastPeriod array<string>, publicationDate string, unitCode string,
    forecastValues map<string, double>>>>>"""


def _coordinate(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(0.0)).otherwise(plain_number(text))


def _stations(df: DataFrame, body: str, keep: list[str]) -> DataFrame:
    return (
        compute_once(df, "_feed", F.from_json(body, STATION))
        .select(*keep, F.explode_outer("_feed").alias("s"))
        .withColumn("latitude", _coordinate(F.col("s.latitude")))
        .withColumn("longitude", _coordinate(F.col("s.longitude")))
        .withColumn("_good", F.col("s").isNotNull() & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    )


def ingest_station_json(df: DataFrame, body: str) -> DataFrame:
    """Station table: missing name "Unknown", missing coordinates 0.0."""
    return _stations(df, body, []).where("_good").select(
        F.coalesce("s.stationTriplet", F.lit("")).alias("station_triplet"),
        F.coalesce("s.name", F.lit("Unknown")).alias("name"),
        "latitude",
        "longitude",
        F.col("s.elevation").alias("elevation"),
        F.coalesce("s.networkCode", F.lit("UNKNOWN")).alias("network_code"),
        F.col("s.state").alias("state"),
        F.col("s.county").alias("county"),
        F.col("s.huc").alias("huc"),
        F.col("s.dcoCode").alias("dco_code"),
        F.col("s.dataTimeZone").alias("data_time_zone"),
        F.col("s.beginDate").alias("begin_date"),
        F.col("s.endDate").alias("end_date"),
        F.col("s.stationElements").alias("station_elements"),
    )


def rejected_stations(df: DataFrame, body: str, keep: list[str]) -> DataFrame:
    """Records left out of the station table: not JSON, or a bad coordinate."""
    return _stations(df, body, keep).where("NOT _good").select(*keep, F.col("s.stationTriplet").alias("station_triplet"))


def sensor_table(stations: DataFrame) -> DataFrame:
    """One row per sensor of stations that carry their nested elements."""
    return stations.select("station_triplet", F.explode("station_elements").alias("e")).select(
        "station_triplet",
        F.col("e.elementCode").alias("element_code"),
        F.col("e.heightDepth").alias("height_depth"),
        F.coalesce("e.ordinal", F.lit(1)).alias("ordinal"),
        F.col("e.beginDate").alias("begin_date"),
        F.col("e.endDate").alias("end_date"),
        F.col("e.dataPrecision").alias("data_precision"),
        F.col("e.storedUnitCode").alias("stored_unit_code"),
        F.col("e.originalUnitCode").alias("original_unit_code"),
        F.coalesce("e.derivedData", F.lit(False)).alias("derived_data"),
        F.col("e.durationName").alias("duration"),
    )


def _failed(feed: Column) -> Column:
    """A station with data that also reports an error fails its whole batch."""
    return feed.isNull() | F.exists(feed, lambda s: s["error"].isNotNull() & (F.size(s["data"]) > 0))


def parse_series(df: DataFrame, body: str) -> DataFrame:
    """The parsed feed as ``_feed``; the two readers below reuse it."""
    return df if "_feed" in df.columns else compute_once(df, "_feed", F.from_json(body, SERIES))


def rejected_series(df: DataFrame, body: str, keep: list[str]) -> DataFrame:
    """Batches that are not JSON or report an error."""
    feed = parse_series(df, body)
    return feed.where(_failed(F.col("_feed"))).select(
        *keep, F.array_compact(F.transform("_feed", lambda s: s["error"])).alias("errors")
    )


def ingest_series_json(df: DataFrame, body: str, stations: DataFrame | None = None) -> DataFrame:
    """One row per value of the nested station -> element -> value feed.

    Rows without a date or with an unreadable one are left out. With
    ``stations`` the time-zone offset is applied to hourly local times.
    """
    feed = parse_series(df, body).where(~F.coalesce(_failed(F.col("_feed")), F.lit(True)))
    element = F.col("d.stationElement")
    values = (
        feed.select(F.explode("_feed").alias("s"))
        .select("s.stationTriplet", F.explode("s.data").alias("d"))
        .select(
            F.col("stationTriplet").alias("station_triplet"),
            F.when(
                element["elementCode"] != "",
                F.concat_ws(
                    ":",
                    element["elementCode"],
                    F.coalesce(element["heightDepth"], F.lit(0)),
                    F.coalesce(element["ordinal"], F.lit(1)),
                ),
            ).alias("element_code"),
            F.explode("d.values").alias("v"),
        )
    )
    if stations is None:
        placed = values.withColumn("data_time_zone", F.lit(None).cast("int"))
    else:
        placed = values.join(stations.select("station_triplet", "data_time_zone"), "station_triplet", "left")
    return (
        compute_once(placed, "ts", parse_station_time(F.col("v.date")))
        .where(F.col("ts").isNotNull())
        .select(
            "station_triplet",
            "element_code",
            "ts",
            F.when(F.col("v.date").contains(" ") & ~F.col("v.date").contains("T"), local_to_utc(F.col("ts"), F.col("data_time_zone")))
            .otherwise(F.col("ts"))
            .alias("ts_utc"),
            F.col("v.value").alias("value"),
            qc_flags(F.col("v.qcFlag"), F.col("v.qaFlag"), F.col("v.origQcFlag")).alias("flags"),
            F.col("v.qcFlag").alias("qc_flag"),
            F.col("v.qaFlag").alias("qa_flag"),
            F.col("v.origQcFlag").alias("orig_qc_flag"),
            F.col("v.origValue").alias("orig_value"),
            F.col("v.average").alias("average"),
            F.col("v.median").alias("median"),
            F.col("v.month").alias("month"),
            F.col("v.monthPart").alias("month_part"),
            F.col("v.year").alias("year"),
            F.col("v.collectionDate").alias("collection_date"),
            F.col("data_time_zone").alias("station_offset"),
        )
    )


def ingest_second_stations(df: DataFrame, body: str, order: str) -> DataFrame:
    """Stations of the second network: the first sensor row per site id."""
    date = lambda c: F.coalesce(
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd")), F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss")),
    ).cast("timestamp_ntz")
    feed = compute_once(df, "_feed", F.from_json(body, SECOND_STATIONS)["sensors"])
    sensors = feed.select(order, F.posexplode("_feed").alias("_pos", "s"))
    first = F.row_number().over(Window.partitionBy("station_id").orderBy(order, "_pos"))
    return (
        sensors.where("s.sid <> ''")
        .withColumn("station_id", F.col("s.sid"))
        .withColumn("_rank", first)
        .where("_rank = 1")
        .select(
            "station_id",
            F.coalesce("s.name", F.lit("Unknown")).alias("station_name"),
            F.coalesce("s.project", F.lit("")).alias("project_code"),
            F.col("s.sso").alias("sso_code"),
            _coordinate(F.col("s.wgs84_latitude")).alias("latitude"),
            _coordinate(F.col("s.wgs84_longitude")).alias("longitude"),
            plain_number(F.col("s.elevation_m")).try_cast("int").alias("elevation_m"),
            F.col("s.state").alias("state"),
            F.col("s.county").alias("county"),
            F.col("s.huc").alias("huc"),
            date(F.col("s.installation_date")).alias("installation_date"),
            date(F.col("s.removal_date")).alias("removal_date"),
        )
    )


def ingest_second_readings(df: DataFrame, body: str, station_id: str) -> DataFrame:
    """Points of the four variables, each labelled with its own element code."""
    feed = compute_once(df, "f", F.from_json(body, SECOND_READINGS)).select(F.col(station_id).alias("station_id"), "f")
    groups = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"f.{v}").alias("records")) for v in SECOND_NETWORK_VARIABLES])
    return (
        feed.select("station_id", F.explode(groups).alias("g"))
        .select("station_id", "g.variable", F.explode("g.records").alias("r"))
        .transform(compute_once, "ts", parse_station_time(F.col("r.date_time")))
        .where(F.col("ts").isNotNull())
        .select(
            "station_id",
            "variable",
            base_code(F.col("variable")).alias("element_code"),
            "ts",
            plain_number(F.col("r.sensor_value")).alias("value"),
            F.col("r.qc_flag").alias("qc_flag"),
            F.col("r.qa_flag").alias("qa_flag"),
        )
    )


def flatten_reference_lists(df: DataFrame, body: str) -> DataFrame:
    """The ten lookup lists as one table (list_name, code, name, attributes)."""
    schema = "struct<" + ", ".join(f"{n} array<map<string, string>>" for n in REFERENCE_LISTS) + ">"
    lists = F.array(*[F.struct(F.lit(n).alias("list_name"), F.col(f"f.{n}").alias("entries")) for n in REFERENCE_LISTS])
    return (
        compute_once(df, "f", F.from_json(body, schema))
        .select(F.inline(lists))
        .select("list_name", F.explode("entries").alias("attributes"))
        .select("list_name", F.col("attributes")["code"].alias("code"), F.col("attributes")["name"].alias("name"), "attributes")
    )


def flatten_forecasts(
    df: DataFrame,
    body: str,
    elements: list[str] | None = None,
    published_from: str | None = None,
    published_to: str | None = None,
    probabilities: list[int] | None = None,
    periods: list[str] | None = None,
) -> DataFrame:
    """Forecast values in long form with the feed's own filters.

    ``periods`` keeps forecasts whose period starts or ends on one of the days.
    """
    rows = (
        compute_once(df, "_feed", F.from_json(body, FORECASTS))
        .select(F.explode("_feed").alias("s"))
        .select("s.stationTriplet", "s.forecastPointName", F.explode("s.data").alias("d"))
        .select(
            F.col("stationTriplet").alias("station_triplet"),
            F.col("forecastPointName").alias("forecast_point_name"),
            F.col("d.elementCode").alias("element_code"),
            F.get("d.forecastPeriod", F.lit(0)).alias("period_start"),
            F.get("d.forecastPeriod", F.lit(1)).alias("period_end"),
            F.col("d.publicationDate").try_cast("date").alias("publication_date"),
            F.col("d.unitCode").alias("unit_code"),
            F.explode("d.forecastValues").alias("_p", "value"),
        )
        .withColumn("exceedance_probability", F.col("_p").try_cast("int"))
        .drop("_p")
    )
    if elements:
        rows = rows.where(F.col("element_code").isin(*elements))
    if published_from:
        rows = rows.where(F.col("publication_date") >= F.lit(published_from).cast("date"))
    if published_to:
        rows = rows.where(F.col("publication_date") <= F.lit(published_to).cast("date"))
    if probabilities:
        rows = rows.where(F.col("exceedance_probability").isin(*probabilities))
    if periods:
        rows = rows.where(F.col("period_start").isin(*periods) | F.col("period_end").isin(*periods))
    return rows
