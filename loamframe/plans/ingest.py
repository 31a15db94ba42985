"""Queries over sources, feeds, metadata documents and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamframe.functions import conversion
from loamframe.operators import quality
from loamframe.plans.registry import query, r6, rounded
from loamframe.session import scratch_path
from loamframe.sources import feeds, payloads, survey_xml, tables

# Check SQL of the conversions, on a text column ``raw``.
_NULL = "(raw IS NULL OR lower(raw) IN ('', 'null', 'none'))"
_NUMBER = r"'\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*'"
_FLOAT = f"CASE WHEN regexp_full_match({{0}}, {_NUMBER}) THEN TRY_CAST(trim({{0}}) AS DOUBLE) END"
_AS_INT = (
    f"CASE WHEN NOT {_NULL} THEN CAST(trunc(coalesce({_FLOAT.format('raw')}, "
    r"TRY_CAST(regexp_extract(raw, '[-+]?[0-9]*\.?[0-9]+') AS DOUBLE))) AS BIGINT) END"
)
_CLEAN = "regexp_replace(raw, '[$, ]', '', 'g')"
_AS_FLOAT = f"CASE WHEN NOT {_NULL} THEN coalesce({_FLOAT.format('raw')}, {_FLOAT.format(_CLEAN)}) END"
_AS_BOOL = (
    "CASE WHEN lower(trim(raw)) IN ('true', '1', 'yes', 't', 'y', 'on') THEN true "
    "WHEN lower(trim(raw)) IN ('false', '0', 'no', 'f', 'n', 'off') THEN false END"
)
_AS_TIME = (
    "TRY_STRPTIME(raw, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%d', '%m/%d/%Y', '%m/%d/%Y %H:%M:%S', '%Y/%m/%d', '%d-%m-%Y', "
    "'%d/%m/%Y', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%dT%H:%M:%SZ', '%Y-%m-%dT%H:%M:%S.%fZ'])"
)


# --- A: tables ---------------------------------------------------------------------
@query("A1_read_table", "", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(t):
    return tables.read_table(t.spark, t.sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")


_GOOD_PAYLOAD = "NOT (o_orderkey % 23 = 0 OR o_orderkey % 29 = 0 OR o_orderkey % 31 = 0 OR o_orderkey % 37 = 0)"


@query(
    "A2_flatten_payloads", "",
    f"""SELECT o_orderkey AS payload_id, 0 AS row_no, o_orderpriority AS musym, o_custkey AS mukey, o_totalprice AS pct,
      o_orderstatus = 'F' AS flag, CAST(o_orderdate AS TIMESTAMP) AS obsdate FROM orders WHERE {_GOOD_PAYLOAD}
    UNION ALL SELECT o_orderkey, 1, 'short', o_orderkey, NULL, NULL, NULL FROM orders WHERE {_GOOD_PAYLOAD}
    UNION ALL SELECT o_orderkey, 2, 'long', 7, NULL, true, NULL FROM orders WHERE {_GOOD_PAYLOAD} AND o_orderkey % 2 = 0""",
)
def _(t):
    columns = {"musym": "varchar", "mukey": "bigint", "pct": "float", "flag": "bit", "obsdate": "datetime"}
    return payloads.flatten_payloads(t.payloads, "body", columns, ["payload_id"])


@query(
    "A2_payload_status", "",
    """SELECT o_orderkey AS payload_id, CASE WHEN o_orderkey % 23 = 0 THEN 'empty' WHEN o_orderkey % 29 = 0 OR o_orderkey % 31 = 0 THEN 'rejected' ELSE 'ok' END AS status
    FROM orders""",
)
def _(t):
    return payloads.payload_status(t.payloads, "body").select("payload_id", "status")


@query(
    "A3_union_batches", "mapunit muaggatt",
    "SELECT mukey, muname FROM mapunit UNION ALL SELECT mukey, flodfreqdcd FROM muaggatt UNION ALL SELECT mukey, muname FROM mapunit",
)
def _(t):
    first = t.mapunit.select("mukey", "muname")
    return tables.union_batches([first, t.muaggatt.select("mukey", F.col("flodfreqdcd").alias("muname")), first])


@query(
    "A4_dedup_keep_first", "component",
    """SELECT mukey, cokey, compname FROM (SELECT *, row_number() OVER (PARTITION BY mukey ORDER BY comppct_r, cokey) AS rn FROM component) WHERE rn = 1""",
)
def _(t):
    return tables.dedup_keep_first(t.component, ["mukey"], ["comppct_r", "cokey"]).select("mukey", "cokey", "compname")


@query(
    "A5_convert_types", "raw_values",
    f"""SELECT id, {_AS_INT} AS as_int, {_AS_FLOAT} AS as_float, {_AS_BOOL} AS as_bool,
    CASE WHEN {_NULL} THEN '' ELSE trim(raw) END AS as_text, {_AS_TIME} AS as_time FROM raw_values""",
)
def _(t):
    kinds = {"as_int": "int", "as_float": "money", "as_bool": "bit", "as_text": "varchar", "as_time": "datetime2"}
    wide = t.raw_values.select("id", *[F.col("raw").alias(c) for c in kinds])
    return tables.convert_types(wide, kinds)


@query(
    "A6_quarantine", "raw_values",
    f"""SELECT id, 'as_int' AS column_name, raw AS value FROM raw_values WHERE NOT {_NULL} AND ({_AS_INT}) IS NULL
    UNION ALL SELECT id, 'as_float', raw FROM raw_values WHERE NOT {_NULL} AND ({_AS_FLOAT}) IS NULL
    UNION ALL SELECT id, 'as_bool', raw FROM raw_values WHERE NOT {_NULL} AND ({_AS_BOOL}) IS NULL""",
)
def _(t):
    kinds = {"as_int": "int", "as_float": "float", "as_bool": "bit"}
    wide = t.raw_values.select("id", *[F.col("raw").alias(c) for c in kinds])
    bad = tables.quarantine(wide, kinds)[1]
    return bad.select("id", F.explode("errors").alias("e")).select("id", F.col("e.column").alias("column_name"), F.col("e.value").alias("value"))


@query(
    "A7_infer_types", "mupolygon",
    """SELECT 'polygonkey' AS column_name, CASE WHEN max(polygonkey) >= 2147483648 THEN 'bigint' ELSE 'int' END AS sql_type FROM mupolygon
    UNION ALL SELECT 'areasymbol', CASE WHEN bool_and(regexp_matches(areasymbol, '^(POINT|POLYGON)')) THEN 'geometry' ELSE 'varchar' END FROM mupolygon
    UNION ALL SELECT 'mupolygongeo', CASE WHEN bool_and(regexp_matches(mupolygongeo, '^(POINT|POLYGON)')) THEN 'geometry' ELSE 'varchar' END FROM mupolygon
    UNION ALL SELECT 'share', 'float' UNION ALL SELECT 'is_first', 'bit' UNION ALL SELECT 'nothing', 'object'""",
)
def _(t):
    return tables.infer_types(
        t.mupolygon.select(
            "polygonkey", "areasymbol", "mupolygongeo", (F.col("polygonkey") / 2).alias("share"),
            (F.col("polygonkey") == 0).alias("is_first"), F.lit(None).cast("string").alias("nothing"),
        )
    )


@query(
    "A8_register_views", "component mapunit legend",
    """SELECT areaname, musym, count(*) AS n, max(comppct_r) AS largest FROM component c JOIN mapunit m ON c.mukey = m.mukey
    JOIN legend l ON m.lkey = l.lkey GROUP BY areaname, musym""",
)
def _(t):
    tables.register_views({"lf_component": t.component, "lf_mapunit": t.mapunit, "lf_legend": t.legend})
    return t.spark.sql(
        """SELECT areaname, musym, count(*) AS n, max(comppct_r) AS largest FROM lf_component c JOIN lf_mapunit m ON c.mukey = m.mukey
        JOIN lf_legend l ON m.lkey = l.lkey GROUP BY areaname, musym"""
    )


@query(
    "A9_flatten_reference_lists", "",
    """SELECT 'elements' AS list_name, concat('E', p_partkey) AS code, p_name AS name, 'inch' AS unit FROM part
    UNION ALL SELECT 'units', concat('U', p_size), p_type, NULL FROM part UNION ALL SELECT 'networks', 'SCAN', 'Soil', NULL FROM part
    UNION ALL SELECT 'networks', 'SNTL', NULL, NULL FROM part""",
)
def _(t):
    return feeds.flatten_reference_lists(t.reference_feed, "body").select(
        "list_name", "code", "name", F.col("attributes")["englishUnitCode"].alias("unit")
    )


@query("A10_write_table", "mapunit legend", "SELECT mukey, musym, muacres, areasymbol FROM mapunit JOIN legend USING (lkey)")
def _(t):
    path = scratch_path(t.spark, "mapunit")
    rows = t.mapunit.join(t.legend.select("lkey", "areasymbol"), "lkey").select("mukey", "musym", "muacres", "areasymbol")
    tables.write_table(rows, path, partition_by=["areasymbol"])
    return t.spark.read.schema(rows.schema).parquet(path)


_STATION = "concat(CAST(s_suppkey AS VARCHAR), ':S', CAST(s_suppkey % 25 AS VARCHAR), ':', CASE s_suppkey % 4 WHEN 0 THEN 'SCAN' WHEN 1 THEN 'SNTL' WHEN 2 THEN 'SNOW' ELSE 'COOP' END)"


@query(
    "A11_ingest_station_json", "",
    f"""SELECT {_STATION} AS station_triplet, CASE WHEN s_suppkey % 9 = 0 THEN 'Unknown' ELSE s_name END AS name,
    CASE WHEN s_suppkey % 11 = 0 THEN 0.0 ELSE 25 + CAST(s_suppkey * 37 % 2400 AS DOUBLE) / 100 END AS latitude,
    -125 + CAST(s_suppkey * 73 % 5800 AS DOUBLE) / 100 AS longitude, s_acctbal AS elevation, 'SCAN' AS network_code, -8 AS data_time_zone,
    2 AS n_sensors FROM supplier WHERE s_suppkey % 7 <> 0""",
)
def _(t):
    stations = feeds.ingest_station_json(t.station_feed, "body")
    return stations.select(
        "station_triplet", "name", "latitude", "longitude", "elevation", "network_code", "data_time_zone", F.size("station_elements").alias("n_sensors")
    )


@query("A11_rejected_stations", "", f"SELECT s_suppkey AS feed_id, {_STATION} AS station_triplet FROM supplier WHERE s_suppkey % 7 = 0")
def _(t):
    return feeds.rejected_stations(t.station_feed, "body", ["feed_id"])


@query(
    "A11_sensor_table", "",
    f"""SELECT {_STATION} AS station_triplet, element_code, height_depth, 1 AS ordinal, begin_date FROM supplier,
    (VALUES ('SMS', -2, '2000-01-01'), ('PREC', NULL, NULL)) e(element_code, height_depth, begin_date) WHERE s_suppkey % 7 <> 0""",
)
def _(t):
    sensors = feeds.sensor_table(feeds.ingest_station_json(t.station_feed, "body"))
    return sensors.select("station_triplet", "element_code", "height_depth", "ordinal", "begin_date")


_EVENT_STATION = _STATION.replace("s_suppkey", "user_id")
_GOOD_SERIES = "event_id % 41 <> 0 AND event_id % 43 <> 0"


@query(
    "A12_ingest_series_json", "stations",
    f"""WITH v AS (
      SELECT {_EVENT_STATION} AS station_triplet, 'SMS:-2:1' AS element_code, date_trunc('minute', ts) AS ts, value, 'QC:V' AS flags, true AS hourly FROM events WHERE {_GOOD_SERIES}
      UNION ALL SELECT {_EVENT_STATION}, 'SMS:-2:1', date_trunc('day', ts), NULL, 'QA:P', false FROM events WHERE {_GOOD_SERIES}
      UNION ALL SELECT {_EVENT_STATION}, 'PREC:0:1', date_trunc('day', ts) + INTERVAL 12 HOUR, value, '', false FROM events WHERE {_GOOD_SERIES})
    SELECT v.station_triplet, element_code, CAST(ts AS TIMESTAMP) AS ts, CAST(CASE WHEN hourly AND data_time_zone IS NOT NULL
      THEN ts - to_hours(data_time_zone) ELSE ts END AS TIMESTAMP) AS ts_utc, value, flags FROM v LEFT JOIN stations s ON v.station_triplet = s.station_triplet""",
)
def _(t):
    series = feeds.ingest_series_json(t.series_feed, "body", t.stations)
    return series.select("station_triplet", "element_code", "ts", "ts_utc", "value", F.array_join("flags", ",").alias("flags"))


@query(
    "A13_ingest_second_readings", "",
    """SELECT concat('SITE_', user_id) AS station_id, 'soiltemp' AS variable, 'STO' AS element_code, CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts, value, 'V' AS qc_flag FROM events
    UNION ALL SELECT concat('SITE_', user_id), 'soilVWC', 'SMS', CAST(date_trunc('day', ts) AS TIMESTAMP), NULL, NULL FROM events
    UNION ALL SELECT concat('SITE_', user_id), 'waterlevel', 'WL', CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 6 HOUR, CAST(user_id AS DOUBLE), NULL FROM events""",
)
def _(t):
    return feeds.ingest_second_readings(t.second_readings, "body", "station_id").drop("qa_flag")


@query(
    "A13_ingest_second_stations", "",
    """WITH s AS (SELECT s_suppkey, 0 AS pos, concat('SITE_', s_suppkey % 60) AS station_id, s_name AS station_name, concat('P', s_nationkey % 4) AS project_code,
        '2-SON' AS sso_code, 38.5 AS latitude, -120.5 AS longitude, CAST(floor(s_acctbal) AS INT) AS elevation_m, s_acctbal < 1000 AS removed FROM supplier
      UNION ALL SELECT s_suppkey, 1, concat('SITE_', s_suppkey % 7), 'again', '', NULL, 0.0, 0.0, NULL, false FROM supplier)
    SELECT station_id, station_name, project_code, sso_code, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, elevation_m, removed
    FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY s_suppkey, pos) AS rn FROM s) WHERE rn = 1""",
)
def _(t):
    stations = feeds.ingest_second_stations(t.second_stations, "body", "feed_id")
    return stations.select(
        "station_id", "station_name", "project_code", "sso_code", "latitude", "longitude", "elevation_m", F.col("removal_date").isNotNull().alias("removed")
    )


@query(
    "A16_flatten_forecasts", "",
    """WITH f AS (SELECT c_custkey, c_name, 'SRVO' AS element_code, '04-01' AS period_start, '07-31' AS period_end,
        CAST(concat('2024-0', 1 + c_custkey % 6, '-01') AS DATE) AS publication_date, unnest([10, 50, 90]) AS exceedance_probability,
        unnest([c_acctbal, 5.5, 1.5]) AS value FROM customer
      UNION ALL SELECT c_custkey, c_name, 'RESC', '03-01', '07-31', DATE '2024-02-01', 50, 2.5 FROM customer)
    SELECT c_name AS forecast_point_name, element_code, period_start, period_end, publication_date, exceedance_probability, value FROM f
    WHERE publication_date BETWEEN DATE '2024-02-01' AND DATE '2024-05-01' AND exceedance_probability IN (10, 50)""",
)
def _(t):
    rows = feeds.flatten_forecasts(
        t.forecast_feed, "body", ["SRVO", "RESC"], "2024-02-01", "2024-05-01", [10, 50], ["07-31"]
    )
    return rows.select("forecast_point_name", "element_code", "period_start", "period_end", "publication_date", "exceedance_probability", "value")


# --- A14, A15, B14, B15, D8: survey metadata -----------------------------------------
_TRIM = "trim({0}, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_DOCS = f"""docs AS (SELECT doc_id, concat('A', doc_id) AS areasymbol, doc_id % 17 <> 0 AS is_valid, concat('Survey of ', source) AS title,
    CASE doc_id % 3 WHEN 0 THEN concat(2005 + doc_id % 20, lpad(CAST(1 + doc_id % 12 AS VARCHAR), 2, '0'), '15')
      WHEN 1 THEN concat(2005 + doc_id % 20, '-', lpad(CAST(1 + doc_id % 12 AS VARCHAR), 2, '0'), '-15') ELSE 'unknown' END AS publication_date,
    CASE WHEN doc_id % 3 < 2 THEN make_date(2005 + doc_id % 20, 1 + doc_id % 12, 15) END AS published,
    concat('Publisher ', lang) AS publisher, CASE doc_id % 4 WHEN 0 THEN 24000 WHEN 1 THEN 12000 END AS scale_denominator,
    -120.0 + doc_id % 50 AS west, -119.0 + doc_id % 50 AS east, 31.0 + doc_id % 15 AS north, CASE WHEN doc_id % 11 <> 0 THEN 30.0 + doc_id % 15 END AS south,
    source, lang, CASE WHEN doc_id % 5 = 0 THEN 0 ELSE 1 END AS n_place, CASE WHEN doc_id % 2 = 0 THEN 'soil@example.org' END AS contact_email,
    CASE WHEN doc_id % 7 = 0 THEN 2 ELSE 1 END AS n_steps,
    length({_TRIM.format("replace(translate(text, '<>&', '   '), chr(13) || chr(10), chr(10))")}) AS abstract_length FROM documents)"""


def _metadata(t):
    return survey_xml.ingest_survey_xml(t.survey_xml, "fgdcmetadata", ["doc_id", "areasymbol"])


@query(
    "A14_ingest_survey_xml", "",
    f"""WITH {_DOCS} SELECT areasymbol, is_valid, CASE WHEN is_valid THEN title END AS title, CASE WHEN is_valid THEN publication_date END AS publication_date,
    CASE WHEN is_valid THEN published END AS published, CASE WHEN is_valid THEN publisher END AS publisher,
    CASE WHEN is_valid THEN 'Survey office' END AS origin, CAST(CASE WHEN is_valid THEN scale_denominator END AS BIGINT) AS scale_denominator,
    CAST(CASE WHEN is_valid THEN west END AS DOUBLE) AS west, CAST(CASE WHEN is_valid THEN south END AS DOUBLE) AS south,
    CASE WHEN is_valid THEN concat('Soil|', source, '|', lang, CASE WHEN n_place = 1 THEN '|County' ELSE '' END) ELSE '' END AS keywords,
    CASE WHEN is_valid THEN n_steps ELSE 0 END AS n_steps FROM docs""",
)
def _(t):
    box = F.col("bounding_box")
    good = F.col("is_valid")
    return _metadata(t).select(
        "areasymbol", "is_valid", F.when(good, F.col("title")).alias("title"), "publication_date", "published", "publisher", "origin", "scale_denominator",
        box["west"].alias("west"), box["south"].alias("south"), F.array_join("keywords", "|").alias("keywords"), F.size("process_steps").alias("n_steps"),
    )


@query(
    "A15_metadata_summary", "",
    f"""WITH {_DOCS} SELECT areasymbol, CASE WHEN is_valid THEN title END AS title, CASE WHEN is_valid THEN publisher END AS publisher,
    CASE WHEN is_valid THEN 3 + n_place END AS keywords_count, CASE WHEN is_valid THEN contact_email END AS contact_email,
    CASE WHEN is_valid THEN abstract_length END AS abstract_length, CASE WHEN NOT is_valid THEN 'Failed to parse metadata' END AS error FROM docs""",
)
def _(t):
    return survey_xml.metadata_summary(_metadata(t), ["areasymbol"]).drop("publication_date", "bounding_box")


@query(
    "B14_search_keywords", "",
    f"""WITH {_DOCS} SELECT areasymbol, 'any' AS mode FROM docs WHERE is_valid AND (lower(source) IN ('src3', 'src8') OR lang = 'de')
    UNION ALL SELECT areasymbol, 'all' FROM docs WHERE is_valid AND n_place = 1 AND lang = 'en'""",
)
def _(t):
    searches = {"any": survey_xml.has_keywords(["SRC3", "src8", "DE"]), "all": survey_xml.has_keywords(["soil", "COUNTY", "en"], True)}
    return survey_xml.search_keyword_sets(_metadata(t), searches, "mode").select("areasymbol", "mode")


@query(
    "B15_filter_bbox_overlap", "",
    f"WITH {_DOCS} SELECT areasymbol FROM docs WHERE is_valid AND west < -90 AND east > -110 AND south < 40 AND north > 33",
)
def _(t):
    return survey_xml.filter_bbox_overlap(_metadata(t), -110, 33, -90, 40).select("areasymbol")


@query(
    "D8_metadata_statistics", "",
    f"""WITH {_DOCS} SELECT count(*) AS "count", CAST(floor(avg(scale_denominator)) AS BIGINT) AS avg_scale, count(DISTINCT publisher) AS n_publishers,
    count(*) FILTER (date_diff('day', published, DATE '2024-06-30') / 365.25 < 10) AS recent_surveys, count(contact_email) AS has_contact,
    round(avg(3 + n_place), 1) AS avg_keywords FROM docs WHERE is_valid""",
)
def _(t):
    return survey_xml.metadata_statistics(_metadata(t), "2024-06-30")


@query("D8_metadata_publishers", "", f"WITH {_DOCS} SELECT DISTINCT publisher FROM docs WHERE is_valid")
def _(t):
    return survey_xml.metadata_publishers(_metadata(t))


# --- L: custom converters --------------------------------------------------------------
@query(
    "L1_register_converter", "raw_values",
    "SELECT id, CASE WHEN length(raw) > 0 THEN length(raw) END AS n_chars, lower(raw) AS folded FROM raw_values",
)
def _(t):
    conversion.register_converter("text length", "int", lambda c: F.nullif(F.length(c), F.lit(0)))
    conversion.register_converter("folded text", "string", F.lower)
    try:
        wide = t.raw_values.select("id", F.col("raw").alias("n_chars"), F.col("raw").alias("folded"))
        return tables.convert_types(wide, {"n_chars": "text length", "folded": "folded text"})
    finally:
        conversion.unregister_converter("text length")
        conversion.unregister_converter("folded text")


# --- M: quality -----------------------------------------------------------------------
_COMPONENT_NULLS = "count(*) FILTER (lower(taxclname) = 'null') + count(*) FILTER (drainagecl IS NULL)"


@query(
    "M1_profile_quality", "component",
    f"""WITH q AS (SELECT count(*) AS n_rows, {_COMPONENT_NULLS} AS n_nulls FROM component),
    c AS (SELECT n_rows, n_nulls, 7 AS n_columns, 1 - n_nulls / (n_rows * 7) AS completeness FROM q)
    SELECT n_rows, n_nulls, n_columns, round(completeness, 6) AS completeness, CASE WHEN completeness < 0.8 THEN 1 ELSE 0 END AS n_errors,
    CASE WHEN completeness >= 0.8 AND completeness < 0.95 THEN 1 ELSE 0 END AS n_warnings,
    CAST(round(1 - 0.2 * CASE WHEN completeness < 0.8 THEN 1 ELSE 0 END - 0.05 * CASE WHEN completeness >= 0.8 AND completeness < 0.95 THEN 1 ELSE 0 END, 6) AS DOUBLE) AS score FROM c""",
)
def _(t):
    report = quality.profile_quality(t.component)
    return report.select(
        "n_rows", "n_nulls", "n_columns", r6(F.col("completeness")).alias("completeness"), F.size("errors").alias("n_errors"),
        F.size("warnings").alias("n_warnings"), r6(F.col("score")).alias("score"),
    )


# Rows 0, 1 (short, 2 values) and, for even keys, 2 (long, 6 values of which 2 are missing).
_PROFILE = f"""p AS (SELECT o_orderkey AS payload_id, CASE WHEN o_orderkey % 37 = 0 THEN 0 WHEN o_orderkey % 2 = 0 THEN 3 ELSE 2 END AS n_rows,
      CASE WHEN o_orderkey % 37 <> 0 AND o_orderkey % 2 = 0 THEN 2 ELSE 0 END AS n_nulls,
      CASE WHEN o_orderkey % 37 = 0 THEN 0 WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END AS ragged_rows,
      CASE WHEN o_orderkey % 37 = 0 THEN 0.0 WHEN o_orderkey % 2 = 0 THEN 1 - 2 / 13 ELSE 1.0 END AS completeness
    FROM orders WHERE NOT (o_orderkey % 23 = 0 OR o_orderkey % 29 = 0 OR o_orderkey % 31 = 0)),
    s AS (SELECT *, 0 AS n_errors, CASE WHEN n_rows = 0 THEN 1 WHEN n_rows = 3 THEN 2 ELSE 1 END AS n_warnings FROM p)"""


@query(
    "M1_profile_payloads", "",
    f"""WITH {_PROFILE} SELECT payload_id, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_nulls AS BIGINT) AS n_nulls, CAST(ragged_rows AS BIGINT) AS ragged_rows,
    CAST(round(completeness, 6) AS DOUBLE) AS completeness, n_errors, n_warnings, CAST(round(1 - 0.05 * n_warnings, 6) AS DOUBLE) AS score FROM s""",
)
def _(t):
    report = quality.profile_payloads(t.payloads, "body", ["payload_id"])
    return report.select(
        "payload_id", "n_rows", "n_nulls", "ragged_rows", r6(F.col("completeness")).alias("completeness"),
        F.size("errors").alias("n_errors"), F.size("warnings").alias("n_warnings"), r6(F.col("score")).alias("score"),
    )


@query(
    "M2_validate_entity", "mapunit lab_sites",
    """SELECT 'mapunit' AS kind, 0 AS n_errors, 0 AS n_warnings, 1.0 AS score UNION ALL
    SELECT 'pedon', 1, 1 + CASE WHEN count(*) FILTER (latitude_decimal_degrees IS NULL) / (count(*) * 6) > 0.05 THEN 1 ELSE 0 END,
    CAST(round(1 - 0.2 - 0.05 * (1 + CASE WHEN count(*) FILTER (latitude_decimal_degrees IS NULL) / (count(*) * 6) > 0.05 THEN 1 ELSE 0 END), 6) AS DOUBLE) FROM lab_sites""",
)
def _(t):
    shown = lambda df, kind: df.select(
        F.lit(kind).alias("kind"), F.size("errors").alias("n_errors"), F.size("warnings").alias("n_warnings"), r6(F.col("score")).alias("score")
    )
    sites = t.lab_sites.withColumnRenamed("upedonid", "pedon_id")
    return shown(quality.validate_entity(t.mapunit, "mapunit"), "mapunit").unionByName(shown(quality.validate_entity(sites, "pedon"), "pedon"))


@query(
    "M3_validate_ranges", "depth_texts",
    """WITH c AS (SELECT count(*) AS n_rows, count(*) FILTER (hzdept_r = 'unknown') AS type_violations,
      count(*) FILTER (TRY_CAST(hzdept_r AS DOUBLE) < 0) + count(*) FILTER (TRY_CAST(hzdepb_r AS DOUBLE) < 0) AS range_violations FROM depth_texts)
    SELECT n_rows, type_violations, range_violations, round((type_violations + range_violations) / (n_rows * 3), 6) AS violation_rate FROM c""",
)
def _(t):
    report = quality.validate_ranges(t.depth_texts, {"cokey": "bigint", "hzdept_r": "float", "hzdepb_r": "float"})
    return rounded(report.select("n_rows", "type_violations", "range_violations", "violation_rate"), "violation_rate")


_DEPTHS = "d AS (SELECT cokey, TRY_CAST(hzdept_r AS DOUBLE) AS t, TRY_CAST(hzdepb_r AS DOUBLE) AS b FROM depth_texts)"


@query(
    "M4_validate_depths", "depth_texts",
    f"""WITH {_DEPTHS}, g AS (SELECT cokey, count(*) AS n_horizons, count(*) FILTER (t IS NULL OR b IS NULL OR t < 0 OR b < 0 OR t >= b) AS n_invalid,
      count(*) FILTER (t > 240 OR b > 240) AS u FROM d GROUP BY cokey)
    SELECT cokey, n_horizons, n_invalid, CASE WHEN n_invalid > 0 THEN u ELSE 0 END AS n_unreasonable, n_invalid = 0 AS is_valid FROM g""",
)
def _(t):
    return quality.validate_depths(t.depth_texts, by=["cokey"])


@query(
    "M5_profile_report", "depth_texts",
    f"""WITH {_DEPTHS} SELECT count(*) AS n_rows, 3 AS n_columns, false AS columns_valid, 'chkey' AS missing_columns,
    count(*) FILTER (t IS NULL OR b IS NULL OR t < 0 OR b < 0 OR t >= b) AS n_invalid, count(*) FILTER (t IS NOT NULL AND b IS NOT NULL) AS horizons_with_valid_depths,
    min(t) AS top_depth_min, max(b) AS bottom_depth_max, round(avg(t), 6) AS top_depth_mean, round(avg(b), 6) AS bottom_depth_mean FROM d""",
)
def _(t):
    report = quality.profile_report(t.depth_texts, ("cokey", "chkey", "hzdept_r", "hzdepb_r"))
    return rounded(
        report.withColumn("missing_columns", F.array_join("missing_columns", ",")).select(
            "n_rows", "n_columns", "columns_valid", "missing_columns", "n_invalid", "horizons_with_valid_depths", "top_depth_min",
            "bottom_depth_max", "top_depth_mean", "bottom_depth_mean",
        ),
        "top_depth_mean", "bottom_depth_mean",
    )


@query(
    "M6_merge_quality", "",
    f"""WITH {_PROFILE} SELECT payload_id % 10 AS batch_group, count(*) AS n_batches, CAST(round(avg(1 - 0.05 * n_warnings), 6) AS DOUBLE) AS mean_score,
    CAST(sum(n_errors) AS BIGINT) AS n_errors, CAST(sum(n_warnings) AS BIGINT) AS n_warnings FROM s GROUP BY ALL""",
)
def _(t):
    reports = quality.profile_payloads(t.payloads, "body", ["payload_id"]).withColumn("batch_group", F.col("payload_id") % 10)
    return rounded(quality.merge_quality(reports, ["batch_group"])[0], "mean_score")


@query(
    "M6_merged_messages", "",
    f"""WITH {_PROFILE} SELECT 'warning' AS kind, 'no data rows' AS message, count(*) AS n FROM s WHERE n_rows = 0
    UNION ALL SELECT 'warning', 'rows with inconsistent lengths', count(*) FROM s WHERE ragged_rows > 0
    UNION ALL SELECT 'warning', 'completeness moderate', count(*) FROM s WHERE n_rows = 3""",
)
def _(t):
    return quality.merge_quality(quality.profile_payloads(t.payloads, "body", ["payload_id"]))[1]


@query(
    "M7_check_row_integrity", "",
    f"""WITH {_PROFILE} SELECT payload_id, CAST(n_rows AS BIGINT) AS n_rows, CAST(CASE WHEN n_rows > 0 THEN 1 ELSE 0 END AS BIGINT) AS short_rows,
    CAST(CASE WHEN n_rows = 3 THEN 1 ELSE 0 END AS BIGINT) AS long_rows FROM s""",
)
def _(t):
    return payloads.check_row_integrity(t.payloads, "body", ["payload_id"])


