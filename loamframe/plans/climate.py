"""Queries over stations, sensors and readings, also as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamframe.constants import DURATIONS, PROPERTIES
from loamframe.functions import readings as r
from loamframe.operators import aggregates as agg
from loamframe.operators import coverage, joins, selection, stations
from loamframe.operators.spatial import nearest_stations
from loamframe.plans.datasets import logical
from loamframe.plans.registry import query, r6, rounded
from loamframe.session import scratch_path
from loamframe.sources import feeds
from loamframe.streaming import readings as streams

SERIES = ["station_triplet", "element_code"]
FROM, TO = "2024-01-03", "2024-01-25"
_BETWEEN = "ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-26'"


def distance_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * "
        f"pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))"
    )
    return f"2 * 6371 * atan2(sqrt({a}), sqrt(1 - {a}))"


_DISTANCE = distance_sql("s.latitude", "s.longitude", "t.latitude", "t.longitude")


def near_sql(name: str, max_km: float, k: int, network: str = "") -> str:
    """Common table expression: ranked stations within reach of each site."""
    where = f"AND t.network_code = '{network}'" if network else ""
    return f"""{name} AS (SELECT * FROM (SELECT site_id, station_triplet, d AS distance_km,
      row_number() OVER (PARTITION BY site_id ORDER BY d, station_triplet) AS rank
      FROM (SELECT s.site_id, t.station_triplet, {_DISTANCE} AS d FROM sites s, stations t WHERE true {where}) WHERE d <= {max_km}) WHERE rank <= {k})"""


_PROPERTY = "CASE element_code " + " ".join(f"WHEN '{c}' THEN '{n}'" for n, c, _ in PROPERTIES) + " ELSE concat('unknown_', element_code) END"
_UNIT = "CASE element_code " + " ".join(f"WHEN '{c}' THEN '{u}'" for _, c, u in PROPERTIES) + " ELSE '' END"


# --- B: station filters -------------------------------------------------------------
@query(
    "B9_filter_stations", "stations sensors",
    """SELECT station_triplet, name FROM stations WHERE (station_triplet LIKE '%:%:SCAN' OR station_triplet LIKE '%:%:SNTL' OR station_triplet LIKE '1%:%:%')
    AND name LIKE '%0%' AND county LIKE 'County 1%' AND huc LIKE '%1%' AND end_date IS NULL
    AND station_triplet IN (SELECT station_triplet FROM sensors WHERE element_code = 'SMS' AND height_depth = -2 AND duration IN ('DAILY', 'HOURLY'))""",
)
def _(t):
    return selection.filter_stations(
        t.stations, triplets=["1*:*:*"], networks=["SCAN", "SNTL"], names=["*0*"], counties=["County 1*"], hucs=["*1*"],
        elements=["SMS:-2:*"], durations=["DAILY", "HOURLY"], sensors=t.sensors,
    ).select("station_triplet", "name")


@query("B10_filter_active", "stations", "SELECT station_triplet FROM stations WHERE removal_date IS NULL")
def _(t):
    return selection.filter_active(t.stations).select("station_triplet")


@query("B13_filter_date_range", "readings", f"SELECT station_triplet, element_code, ts, value FROM readings WHERE {_BETWEEN}")
def _(t):
    return selection.filter_date_range(t.readings, "ts", FROM, TO).select("station_triplet", "element_code", "ts", "value")


# --- C15, D11, G6, G7: sensors --------------------------------------------------------
@query(
    "C15_element_to_property", "sensors",
    f"""SELECT station_triplet, element_code, ordinal, {_PROPERTY} AS property_name, CASE WHEN element_code = 'SMS' THEN 'vol' ELSE {_UNIT} END AS unit FROM sensors""",
)
def _(t):
    units = t.sensors.groupBy(F.col("element_code").alias("code")).agg(F.max(F.when(F.col("element_code") == "SMS", "vol").otherwise("")).alias("unit"))
    return stations.element_to_property(t.sensors, units).select("station_triplet", "element_code", "ordinal", "property_name", "unit")


@query(
    "D11_sensor_inventory", "sensors",
    f"""SELECT station_triplet, {_PROPERTY} AS property_name, element_code, height_depth AS height_depth_inches, coalesce(ordinal, 1) AS ordinal, data_precision FROM sensors""",
)
def _(t):
    return stations.sensor_inventory(t.sensors).select("station_triplet", "property_name", "element_code", "height_depth_inches", "ordinal", "data_precision")


@query(
    "G6_sensor_depths", "sensors",
    """SELECT station_triplet, height_depth AS height_depth_inches, ordinal, concat('SMS:', height_depth, ':', ordinal) AS element_string, data_precision
    FROM sensors WHERE element_code = 'SMS'""",
)
def _(t):
    return stations.sensor_depths(t.sensors, "soil_moisture").drop("begin_date", "end_date")


@query(
    "G7_available_properties", "sensors",
    f"""SELECT DISTINCT station_triplet, {_PROPERTY} AS property_name, element_code, {_UNIT} AS unit,
    CASE element_code WHEN 'SMS' THEN 'Soil Moisture' WHEN 'STO' THEN 'Soil Temp' WHEN 'PREC' THEN 'Precipitation' WHEN 'TOBS' THEN 'Air Temp'
      ELSE concat('Unknown element ', element_code) END AS description, count(*) OVER (PARTITION BY station_triplet, element_code) AS n_sensors FROM sensors""",
)
def _(t):
    return stations.available_properties(t.sensors)


# --- D: station summaries ---------------------------------------------------------------
@query(
    "D9_precip_total", "readings",
    """SELECT station_triplet, round(sum(value) FILTER (value <> 0), 6) AS total, count(value) AS n_observations FROM readings
    WHERE element_code = 'PREC:0:1' AND value IS NOT NULL GROUP BY station_triplet""",
)
def _(t):
    return rounded(agg.precip_total(t.readings.where("element_code = 'PREC:0:1'"), ["station_triplet"]), "total")


@query(
    "D9_precip_from_gauge", "readings",
    """WITH d AS (SELECT station_triplet, CAST(ts AS DATE) AS day, max_by(value, ts) AS v, count(*) AS n FROM readings
      WHERE element_code = 'PREC:0:1' AND value IS NOT NULL GROUP BY ALL),
    r AS (SELECT station_triplet, n, v - lag(v) OVER (PARTITION BY station_triplet ORDER BY day) AS rise FROM d)
    SELECT station_triplet, round(sum(rise) FILTER (rise > 0), 6) AS total, CAST(sum(n) AS BIGINT) AS n_observations FROM r GROUP BY station_triplet""",
)
def _(t):
    rows = t.readings.where("element_code = 'PREC:0:1'")
    return rounded(agg.precip_total(rows, ["station_triplet"], accumulated=True), "total")


@query(
    "D10_stations_by_group", "stations",
    """SELECT network_code, count(*) AS station_count, min_by(dco_code, station_triplet) AS dco_code, min_by(state, station_triplet) AS state
    FROM stations GROUP BY network_code""",
)
def _(t):
    return agg.stations_by_group(t.stations, "network_code", ["dco_code", "state"], "station_triplet")


VARIABLES = {"soil_moisture": ["SMS", "SMV"], "soil_temperature": ["STO", "STV"], "precipitation": ["PREC", "PRCP"]}
_AVAILABILITY = """d AS (SELECT DISTINCT station_triplet, element_code, CAST(ts AS DATE) AS day,
      CASE WHEN element_code IN ('SMS', 'SMV') THEN 'soil_moisture' WHEN element_code IN ('STO', 'STV') THEN 'soil_temperature' ELSE 'precipitation' END AS variable
      FROM long_readings WHERE value IS NOT NULL AND element_code <> 'TOBS' AND year(ts) BETWEEN 1996 AND 2000),
    e AS (SELECT station_triplet, variable, element_code, count(*) AS days, count(DISTINCT year(day)) AS years FROM d GROUP BY ALL),
    v AS (SELECT station_triplet, variable, arg_min(element_code, (-days, element_code)) AS element_used, CAST(sum(days) AS BIGINT) AS total_days_with_data,
      CAST(365 * sum(years) AS BIGINT) AS total_days_possible FROM e GROUP BY ALL)"""


@query(
    "D12_availability_by_year", "long_readings",
    f"WITH {_AVAILABILITY} SELECT *, round(total_days_with_data / total_days_possible * 100, 1) AS data_percentage FROM v",
)
def _(t):
    return coverage.availability_by_year(t.long_readings, VARIABLES, 1996, 2000)


@query(
    "D13_availability_by_network", "long_readings stations",
    f"""WITH {_AVAILABILITY} SELECT network_code, variable, count(*) AS stations_with_data, round(avg(total_days_with_data), 6) AS mean_days,
    max(total_days_with_data) AS max_days FROM v JOIN stations USING (station_triplet) GROUP BY ALL""",
)
def _(t):
    found = coverage.availability_by_year(t.long_readings, VARIABLES, 1996, 2000)
    return rounded(coverage.availability_by_network(found, t.stations), "mean_days")


@query(
    "D14_availability_probe", "long_readings",
    """WITH m AS (SELECT station_triplet, element_code, date_trunc('month', ts) AS period, avg(value) AS v FROM long_readings
      WHERE value IS NOT NULL AND ts >= TIMESTAMP '1996-01-01' AND ts < TIMESTAMP '1998-07-01' GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (PARTITION BY station_triplet, element_code ORDER BY period) AS rn FROM m)
    SELECT station_triplet, element_code, count(*) AS data_points, true AS has_data,
    string_agg(strftime(period, '%Y-%m'), ',' ORDER BY period) FILTER (rn <= 5) AS sample_periods, round(sum(v) FILTER (rn <= 5), 6) AS sample_sum FROM k GROUP BY ALL""",
)
def _(t):
    probe = coverage.availability_probe(t.long_readings, "1996-01-01", "1998-06-30")
    return probe.select(
        *SERIES, "data_points", "has_data",
        F.array_join(F.transform("sample_values", lambda s: F.date_format(s["period"], "yyyy-MM")), ",").alias("sample_periods"),
        r6(F.aggregate("sample_values", F.lit(0.0), lambda a, s: a + s["value"])).alias("sample_sum"),
    )


_COVERAGE = """d AS (SELECT station_triplet, element_code, CAST(ts AS DATE) AS day, count(*) AS n FROM long_readings WHERE value IS NOT NULL GROUP BY ALL),
    g AS (SELECT *, date_diff('day', lag(day) OVER (PARTITION BY station_triplet, element_code ORDER BY day), day) - 1 AS gap FROM d),
    c AS (SELECT station_triplet, element_code, min(day) AS date_start, max(day) AS date_end, count(*) AS coverage_days, CAST(sum(n) AS BIGINT) AS total_records,
      date_diff('day', min(day), max(day)) + 1 AS expected_records, count(*) FILTER (gap > 7) AS gap_count, max(gap) FILTER (gap > 0) AS largest_gap_days,
      avg(gap) FILTER (gap > 0) AS mean_gap_days FROM g GROUP BY ALL)"""


@query(
    "D15_series_coverage", "long_readings",
    f"""WITH {_COVERAGE} SELECT station_triplet, element_code, date_start, date_end, coverage_days, total_records, expected_records, gap_count, largest_gap_days,
    round(mean_gap_days, 6) AS mean_gap_days, round(total_records / expected_records * 100, 6) AS completeness_percent FROM c""",
)
def _(t):
    return rounded(coverage.series_coverage(t.long_readings), "mean_gap_days", "completeness_percent")


@query(
    "D16_station_status", "readings sensors stations",
    f"""WITH {_COVERAGE.replace("FROM long_readings", "FROM readings")},
    p AS (SELECT station_triplet, count(*) AS total_sensors, count(*) FILTER (date_diff('day', date_end, DATE '2024-02-20') <= 30) AS active_sensors,
      min(date_diff('day', date_end, DATE '2024-02-20')) AS idle, avg(coverage_days / expected_records * 100) AS complete,
      avg((1 - coalesce(largest_gap_days, 0) / expected_records) * 100) FILTER (expected_records IS NOT NULL) AS steady
      FROM (SELECT station_triplet, concat(element_code, ':', coalesce(height_depth, 0), ':', ordinal) AS element_code FROM sensors)
      LEFT JOIN c USING (station_triplet, element_code) GROUP BY station_triplet),
    s AS (SELECT station_triplet, CASE WHEN removal_date IS NOT NULL THEN 'removed' WHEN idle IS NULL THEN 'unknown' WHEN active_sensors = total_sensors THEN 'active'
        WHEN active_sensors = 0 THEN 'inactive' ELSE 'partial' END AS overall_status, coalesce(total_sensors, 0) AS total_sensors,
      coalesce(active_sensors, 0) AS active_sensors, idle AS days_since_last_data,
      CASE WHEN idle IS NULL THEN 0 ELSE 100 * (1 - least(greatest(idle, 0), 30) / 30) END AS recency, coalesce(complete, 0) AS complete, coalesce(steady, 0) AS steady
      FROM stations LEFT JOIN p USING (station_triplet))
    SELECT station_triplet, overall_status, total_sensors, active_sensors, days_since_last_data, round(recency, 6) AS recency_score,
    round(0.3 * recency + 0.5 * complete + 0.2 * steady, 6) AS data_quality_score FROM s""",
)
def _(t):
    status = coverage.station_status(t.readings, t.sensors, t.stations, "2024-02-20")
    return rounded(
        status.select("station_triplet", "overall_status", "total_sensors", "active_sensors", "days_since_last_data", "recency_score", "data_quality_score"),
        "recency_score", "data_quality_score",
    )


# --- E12 and what builds on it --------------------------------------------------------
@query(
    "E12_nearest_stations", "sites stations",
    f"WITH {near_sql('near', 250, 10)} SELECT site_id, station_triplet, round(distance_km, 6) AS distance_km, CAST(rank AS INT) AS rank FROM near",
)
def _(t):
    near = nearest_stations(t.sites, t.stations, 250, 10)
    return rounded(near.select("site_id", "station_triplet", "distance_km", "rank"), "distance_km")


_NEAR_SERIES = """SELECT n.site_id, n.station_triplet, round(n.distance_km, 2) AS distance_km, r.ts, r.value FROM near n JOIN readings r
    ON n.station_triplet = r.station_triplet WHERE r.element_code = '{0}' AND r.value IS NOT NULL AND r.""" + _BETWEEN.replace(" ts", " r.ts")
_NEAR_COLUMNS = ["site_id", "station_triplet", "distance_km", "ts", "value"]


@query("G4_property_near", "sites stations readings", f"WITH {near_sql('near', 150, 1)} {_NEAR_SERIES.format('STO:-4:1')}")
def _(t):
    return stations.property_near(t.sites, t.stations, t.sensors, t.readings, "soil_temp", FROM, TO, depth=-4, max_km=150).select(*_NEAR_COLUMNS)


_STO_SERIES = "r.element_code = 'STO:-4:1' AND r.value IS NOT NULL AND r." + _BETWEEN.replace(" ts", " r.ts")


@query(
    "G4_property_points", "sites stations readings",
    f"""WITH {near_sql('near', 150, 1)} SELECT r.station_triplet, r.ts, r.value, r.qc_flag, r.qa_flag, r.orig_value,
    concat_ws(',', CASE WHEN qc_flag <> '' THEN concat('QC:', qc_flag) END, CASE WHEN qa_flag <> '' THEN concat('QA:', qa_flag) END,
      CASE WHEN orig_qc_flag <> '' THEN concat('ORIG_QC:', orig_qc_flag) END) AS flags, t.data_time_zone AS station_timezone_offset_hours
    FROM readings r JOIN stations t ON r.station_triplet = t.station_triplet
    WHERE r.station_triplet IN (SELECT station_triplet FROM near) AND {_STO_SERIES}""",
)
def _(t):
    _, series = stations.property_near_parts(t.sites, t.stations, t.sensors, t.readings, "soil_temp", FROM, TO, depth=-4, max_km=150)
    return series.select(
        "station_triplet", "ts", "value", "qc_flag", "qa_flag", "orig_value", F.array_join("flags", ",").alias("flags"), "station_timezone_offset_hours"
    )


@query(
    "G4_site_stations", "sites stations readings",
    f"""WITH {near_sql('near', 150, 1)}, c AS (SELECT r.station_triplet, count(*) AS n FROM readings r WHERE {_STO_SERIES} GROUP BY r.station_triplet)
    SELECT n.site_id, n.station_triplet, round(n.distance_km, 2) AS distance_km, t.name AS station_name, t.network_code AS station_network_code,
    t.elevation AS station_elevation, coalesce(c.n, 0) AS n_data_points
    FROM near n JOIN stations t ON n.station_triplet = t.station_triplet LEFT JOIN c ON n.station_triplet = c.station_triplet""",
)
def _(t):
    links, _ = stations.property_near_parts(t.sites, t.stations, t.sensors, t.readings, "soil_temp", FROM, TO, depth=-4, max_km=150)
    return links.select("site_id", "station_triplet", "distance_km", "station_name", "station_network_code", "station_elevation", "n_data_points")


@query("G15_moisture_profile", "sites stations readings", f"WITH {near_sql('near', 300, 1, 'SCAN')} {_NEAR_SERIES.format('SMS:-20:1')}")
def _(t):
    return stations.moisture_profile(t.sites, t.stations, t.sensors, t.readings, FROM, TO, 300).select(*_NEAR_COLUMNS)


@query("G15_temperature_profile", "sites stations readings", f"WITH {near_sql('near', 300, 1, 'SCAN')} {_NEAR_SERIES.format('STO:-4:1')}")
def _(t):
    return stations.temperature_profile(t.sites, t.stations, t.sensors, t.readings, FROM, TO, 300).select(*_NEAR_COLUMNS)


@query("G15_precipitation", "sites stations readings", f"WITH {near_sql('near', 150, 1)} {_NEAR_SERIES.format('PREC:0:1')}")
def _(t):
    return stations.precipitation(t.sites, t.stations, t.sensors, t.readings, FROM, TO, 150).select(*_NEAR_COLUMNS)


_TOTALS = """SELECT station_triplet, count(*) AS n, sum(value) AS total FROM readings WHERE element_code = '{0}' AND value IS NOT NULL AND {1} GROUP BY station_triplet"""


@query(
    "C16_soil_climate_join", "sites stations readings chorizon component mapunit legend muaggatt",
    f"""WITH {near_sql('scan', 300, 1, 'SCAN')}, {near_sql('anyone', 300, 1)},
    soil AS (SELECT areasymbol, count(*) AS n_horizons, avg(awc_r) AS avg_awc FROM chorizon JOIN component USING (cokey) JOIN mapunit USING (mukey) JOIN legend USING (lkey) GROUP BY areasymbol),
    wt AS (SELECT areasymbol, avg(wtdepannmin) / 12 AS min_depth_ft FROM mapunit JOIN legend USING (lkey) LEFT JOIN muaggatt USING (mukey) GROUP BY areasymbol),
    sms AS ({_TOTALS.format('SMS:-20:1', _BETWEEN)}), prec AS ({_TOTALS.format('PREC:0:1', _BETWEEN)}), sto AS ({_TOTALS.format('STO:-4:1', _BETWEEN)})
    SELECT s.site_id, s.areasymbol, soil.n_horizons, round(soil.avg_awc, 6) AS avg_awc, round(wt.min_depth_ft, 6) AS min_depth_ft,
    scan.station_triplet AS moisture_station, round(scan.distance_km, 4) AS moisture_km, CASE WHEN scan.site_id IS NOT NULL THEN coalesce(sms.n, 0) END AS moisture_n,
    round(prec.total, 4) AS precip_total, CASE WHEN scan.site_id IS NOT NULL THEN coalesce(sto.n, 0) END AS temp_n
    FROM sites s LEFT JOIN soil ON s.areasymbol = soil.areasymbol LEFT JOIN wt ON s.areasymbol = wt.areasymbol
    LEFT JOIN scan ON s.site_id = scan.site_id LEFT JOIN anyone ON s.site_id = anyone.site_id
    LEFT JOIN sms ON scan.station_triplet = sms.station_triplet LEFT JOIN sto ON scan.station_triplet = sto.station_triplet
    LEFT JOIN prec ON anyone.station_triplet = prec.station_triplet""",
)
def _(t):
    water = joins.water_properties(t.chorizon, t.component, t.mapunit, t.legend)
    table = joins.water_table_by_mapunit(t.mapunit, t.muaggatt, t.legend)
    out = stations.soil_climate_join(t.sites, water, table, t.stations, t.sensors, t.readings, FROM, TO, 300)
    return out.select(
        "site_id", "areasymbol", "n_horizons", r6(F.col("avg_awc")).alias("avg_awc"), r6(F.col("min_depth_ft")).alias("min_depth_ft"), "moisture_station",
        r6(F.col("moisture_km"), 4).alias("moisture_km"), "moisture_n", r6(F.col("precip_total"), 4).alias("precip_total"), "temp_n",
    )


# --- G: readings ----------------------------------------------------------------------
@query(
    "G1_parse_station_time", "",
    """SELECT event_id, 'iso' AS kind, CAST(date_trunc('second', ts) AS TIMESTAMP) AS parsed FROM events
    UNION ALL SELECT event_id, 'offset', CAST(date_trunc('second', ts) AS TIMESTAMP) + INTERVAL 6 HOUR FROM events
    UNION ALL SELECT event_id, 'minute', CAST(date_trunc('minute', ts) AS TIMESTAMP) FROM events
    UNION ALL SELECT event_id, 'day', CAST(date_trunc('day', ts) AS TIMESTAMP) FROM events UNION ALL SELECT event_id, 'bad', NULL FROM events""",
)
def _(t):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    iso = F.replace(text, F.lit(" "), F.lit("T"))
    forms = {"iso": F.concat(iso, F.lit("Z")), "offset": F.concat(iso, F.lit("-06:00")), "minute": F.substring(text, 1, 16), "day": F.substring(text, 1, 10), "bad": F.concat(text, F.lit("?"))}
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("text")) for k, v in forms.items()])
    return t.raw("events").select("event_id", F.inline(pairs)).select("event_id", "kind", r.parse_station_time(F.col("text")).alias("parsed"))


@query(
    "G2_apply_station_offset", "readings stations",
    """SELECT r.station_triplet, r.element_code, r.ts, CASE WHEN s.data_time_zone IS NULL THEN r.ts ELSE r.ts - to_hours(s.data_time_zone) END AS ts_utc
    FROM readings r LEFT JOIN stations s ON r.station_triplet = s.station_triplet""",
)
def _(t):
    zoned = t.readings.join(t.stations.select("station_triplet", "data_time_zone"), "station_triplet", "left")
    return zoned.select("station_triplet", "element_code", "ts", r.local_to_utc(F.col("ts"), F.col("data_time_zone")).alias("ts_utc"))


@query(
    "G3_qc_flags", "readings",
    """SELECT station_triplet, element_code, ts, concat_ws(',', CASE WHEN qc_flag <> '' THEN concat('QC:', qc_flag) END,
    CASE WHEN qa_flag <> '' THEN concat('QA:', qa_flag) END, CASE WHEN orig_qc_flag <> '' THEN concat('ORIG_QC:', orig_qc_flag) END) AS flags FROM readings""",
)
def _(t):
    flags = r.qc_flags(F.col("qc_flag"), F.col("qa_flag"), F.col("orig_qc_flag"))
    return t.readings.select(*SERIES, "ts", F.array_join(flags, ",").alias("flags"))


@query(
    "G5_moisture_by_depth", "readings",
    """SELECT station_triplet, CAST(split_part(element_code, ':', 2) AS INT) AS depth_inches, count(*) AS n, round(avg(value), 6) AS mean_value FROM readings
    WHERE element_code LIKE 'SMS:%' AND split_part(element_code, ':', 2) IN ('-2', '-20', '-40') AND value IS NOT NULL GROUP BY ALL""",
)
def _(t):
    rows = stations.moisture_by_depth(t.readings, [-2, -20, -40])
    return rounded(rows.groupBy("station_triplet", "depth_inches").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value")), "mean_value")


_STRESS = "CASE WHEN claytotal_r >= awc_r * 100 * 0.75 THEN 'optimal' WHEN claytotal_r >= awc_r * 100 * 0.5 THEN 'moderate' WHEN claytotal_r >= awc_r * 100 * 0.25 THEN 'mild_stress' ELSE 'severe_stress' END"


@query("G8_water_stress", "chorizon", f"SELECT chkey, {_STRESS} AS stress_level FROM chorizon")
def _(t):
    return t.chorizon.select("chkey", stations.water_stress(F.col("awc_r"), F.col("claytotal_r")).alias("stress_level"))


@query(
    "G9_recommended_depths", "chorizon",
    "SELECT chkey, CASE WHEN claytotal_r < 20 THEN '-2,-4' WHEN claytotal_r < 35 THEN '-2,-4,-8' ELSE '-2,-4,-8,-16,-20' END AS depths FROM chorizon",
)
def _(t):
    return t.chorizon.select("chkey", F.array_join(stations.recommended_depths(F.col("claytotal_r")), ",").alias("depths"))


@query(
    "G10_normalize_elements", "chorizon",
    """WITH e AS (SELECT chkey, CASE WHEN awc_r > 0.05 THEN hzdepb_r + 0.37 END AS cm FROM chorizon),
    s AS (SELECT *, CAST(round_even(cm / 2.54, 0) AS INT) AS inches FROM e)
    SELECT chkey, CASE WHEN cm IS NULL THEN 'SMS::1' ELSE concat('SMS:', -inches, ':1') END AS element_string, round(cm / 2.54, 6) AS depth_inches,
    'SMS' AS base_code, -inches AS parsed_depth, 1 AS parsed_ordinal FROM s""",
)
def _(t):
    rows = t.chorizon.select(
        "chkey", F.lit("SMS").alias("element_code"), F.when(F.col("awc_r") > 0.05, F.col("hzdepb_r") + 0.37).alias("depth_cm"), F.lit(1).alias("ordinal")
    )
    return stations.normalize_elements(rows).select(
        "chkey", "element_string", r6(F.col("depth_inches")).alias("depth_inches"), F.col("parsed.base_code").alias("base_code"),
        F.col("parsed.depth_inches").alias("parsed_depth"), F.col("parsed.ordinal").alias("parsed_ordinal"),
    )


@query(
    "G11_unify_networks", "readings",
    """SELECT network, element_code, count(*) AS n, count(value) AS n_values FROM (SELECT 1 AS network, element_code, value FROM readings
    UNION ALL SELECT 2, 'STO', value FROM events UNION ALL SELECT 2, 'SMS', NULL FROM events UNION ALL SELECT 2, 'WL', user_id FROM events) GROUP BY ALL""",
)
def _(t):
    second = feeds.ingest_second_readings(t.second_readings, "body", "station_id")
    both = stations.unify_networks(t.readings, second)
    return both.groupBy("network", "element_code").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values"))


@query(
    "G12_aggregate_period", "long_readings",
    """SELECT station_triplet, element_code, CAST(make_date(CAST(year(ts) AS INT) - CASE WHEN month(ts) < 10 THEN 1 ELSE 0 END, 10, 1) AS TIMESTAMP) AS period,
    count(*) AS n, round(avg(value), 6) AS average, median(value) AS median FROM long_readings WHERE value IS NOT NULL GROUP BY ALL""",
)
def _(t):
    return rounded(stations.aggregate_period(t.long_readings, "WATER_YEAR", tendency="ALL"), "average")


_ENDS = {
    "HOURLY": ("date_trunc('hour', ts)", "date_trunc('hour', ts) + INTERVAL 1 HOUR"),
    "DAILY": ("date_trunc('day', ts)", "date_trunc('day', ts)"),
    "SEMIMONTHLY": (
        "date_trunc('month', ts) + CASE WHEN day(ts) < 16 THEN INTERVAL 0 DAY ELSE INTERVAL 15 DAY END",
        "CASE WHEN day(ts) < 16 THEN date_trunc('month', ts) + INTERVAL 14 DAY ELSE CAST(last_day(ts) AS TIMESTAMP) END",
    ),
    "MONTHLY": ("date_trunc('month', ts)", "CAST(last_day(ts) AS TIMESTAMP)"),
    "CALENDAR_YEAR": ("date_trunc('year', ts)", "date_trunc('year', ts) + INTERVAL 1 YEAR - INTERVAL 1 DAY"),
    "WATER_YEAR": (
        "date_trunc('year', ts + INTERVAL 3 MONTH) - INTERVAL 3 MONTH",
        "date_trunc('year', ts + INTERVAL 3 MONTH) + INTERVAL 9 MONTH - INTERVAL 1 DAY",
    ),
    "SEASONAL": (
        "date_trunc('quarter', date_trunc('month', ts) + INTERVAL 1 MONTH) - INTERVAL 1 MONTH",
        "date_trunc('quarter', date_trunc('month', ts) + INTERVAL 1 MONTH) + INTERVAL 2 MONTH - INTERVAL 1 DAY",
    ),
}


@query(
    "G12_period_labels", "readings long_readings",
    "WITH all_readings AS (SELECT ts, value FROM readings UNION ALL SELECT ts, value FROM long_readings) "
    + " UNION ALL ".join(
        f"SELECT '{d}' AS duration, CAST({e} AS TIMESTAMP) AS period, count(*) AS n, round(avg(value), 6) AS average FROM all_readings WHERE value IS NOT NULL GROUP BY ALL"
        for d, (_, e) in _ENDS.items()
    ),
)
def _(t):
    both = t.readings.select("ts", "value").unionByName(t.long_readings.select("ts", "value"))
    return rounded(stations.period_means(both, DURATIONS, "END", keys=[]), "average")


_VERSIONS = """v AS (SELECT station_triplet, element_code, date_trunc('day', ts) AS ts, value, updated_at, 0 AS new FROM readings
      UNION ALL SELECT station_triplet, element_code, date_trunc('day', ts), value + 1000, updated_at + INTERVAL 30 MINUTE, 1 FROM readings WHERE qc_flag = 'S')"""


def _versions(t):
    daily = t.readings.select(*SERIES, F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts"), "value", "updated_at", "qc_flag")
    changes = daily.where("qc_flag = 'S'").withColumns({"value": F.col("value") + 1000, "updated_at": F.col("updated_at") + F.expr("INTERVAL '30' MINUTE")})
    return daily.drop("qc_flag"), changes.drop("qc_flag")


_LATEST = """SELECT station_triplet, element_code, CAST(ts AS TIMESTAMP) AS ts, value, updated_at FROM (SELECT *, row_number() OVER
    (PARTITION BY station_triplet, element_code, ts ORDER BY updated_at DESC NULLS LAST, new DESC, value DESC NULLS LAST) AS rn FROM v) WHERE rn = 1"""


@query("G13_upsert_readings", "readings", f"WITH {_VERSIONS} {_LATEST}")
def _(t):
    return stations.upsert_readings(*_versions(t)).select(*SERIES, "ts", "value", "updated_at")


@query(
    "G13_changed_since", "readings",
    "SELECT station_triplet, element_code, ts, value FROM readings WHERE updated_at >= TIMESTAMP '2024-01-20'",
)
def _(t):
    return stations.changed_since(t.readings, "2024-01-20").select(*SERIES, "ts", "value")


@query(
    "G14_drop_suspect", "readings",
    "SELECT station_triplet, element_code, ts, value FROM readings WHERE coalesce(qc_flag, '') <> 'S' AND coalesce(qa_flag, '') <> 'S'",
)
def _(t):
    return stations.drop_suspect(t.readings, original_values=False).select(*SERIES, "ts", "value")


@query(
    "G16_station_series", "requests readings",
    """SELECT q.request_id, q.station_triplet, q.element_code, date_trunc('day', r.ts) AS period, count(*) AS n, round(avg(r.value), 6) AS average
    FROM requests q JOIN readings r ON q.station_triplet = r.station_triplet AND q.element_code = r.element_code
    WHERE r.value IS NOT NULL AND CAST(r.ts AS DATE) BETWEEN q.start_date AND q.end_date GROUP BY ALL""",
)
def _(t):
    return rounded(stations.station_series(t.requests, t.readings), "average")


_LONG_REQUESTS = """SELECT request_id, station_triplet, CASE WHEN request_id % 2 = 0 THEN 'SMS' ELSE 'STO' END AS element_code,
    DATE '1993-03-10' + CAST(request_id % 300 AS INT) AS start_date, DATE '1993-03-10' + CAST(request_id % 300 + request_id % 900 AS INT) AS end_date"""


def _long_series(t, duration: str):
    wanted = t.requests.selectExpr(
        "request_id", "station_triplet", "CASE WHEN request_id % 2 = 0 THEN 'SMS' ELSE 'STO' END AS element_code",
        "date_add(DATE '1993-03-10', CAST(request_id % 300 AS INT)) AS start_date",
        "date_add(DATE '1993-03-10', CAST(request_id % 300 + request_id % 900 AS INT)) AS end_date",
    )
    return rounded(stations.station_series(wanted, t.long_readings, duration), "average")


def _long_series_sql(period: str) -> str:
    return f"""SELECT q.request_id, q.station_triplet, q.element_code, CAST({period} AS TIMESTAMP) AS period, count(*) AS n, round(avg(r.value), 6) AS average
    FROM ({_LONG_REQUESTS} FROM requests) q JOIN long_readings r ON q.station_triplet = r.station_triplet AND q.element_code = r.element_code
    WHERE r.value IS NOT NULL AND CAST(r.ts AS DATE) BETWEEN q.start_date AND q.end_date GROUP BY ALL"""


@query("G16_monthly_series", "requests long_readings", _long_series_sql("date_trunc('month', r.ts)"))
def _(t):
    return _long_series(t, "MONTHLY")


@query(
    "G16_water_year_series", "requests long_readings",
    _long_series_sql("make_date(CAST(year(r.ts) - CASE WHEN month(r.ts) < 10 THEN 1 ELSE 0 END AS INT), 10, 1)"),
)
def _(t):
    return _long_series(t, "WATER_YEAR")


@query(
    "G16_second_network_variables", "",
    """SELECT DISTINCT concat('SITE_', user_id) AS station_id, unnest(['soiltemp', 'soilVWC', 'airtemp', 'waterlevel']) AS variable,
    unnest(['STO', 'SMS', 'TOBS', 'WL']) AS element_code FROM events""",
)
def _(t):
    return stations.second_network_variables(t.second_readings.select("station_id").distinct())


# --- S: streams. The supplied Parquet is read as a stream that ends when it is used up ---
def _stream(t, name: str, source: str = "events"):
    # A one-letter glob: streaming sources take a single file only by pattern.
    path = t.path(source).replace(f"/{source}.", f"/{source[:-1]}[{source[-1]}].")
    return logical(t.spark.readStream.schema(t.raw(source).schema).parquet(path), name)


@query(
    "S1_stream_ingest", "",
    """SELECT element_code, count(*) AS n, count(value) AS n_values, 'rows' AS sink FROM (
      SELECT 'SMS:-2:1' AS element_code, value FROM events WHERE event_id % 41 <> 0 AND event_id % 43 <> 0
      UNION ALL SELECT 'SMS:-2:1', NULL FROM events WHERE event_id % 41 <> 0 AND event_id % 43 <> 0
      UNION ALL SELECT 'PREC:0:1', value FROM events WHERE event_id % 41 <> 0 AND event_id % 43 <> 0) GROUP BY ALL
    UNION ALL SELECT NULL, count(*), 0, 'rejects' FROM events WHERE event_id % 41 = 0 OR event_id % 43 = 0""",
)
def _(t):
    root = scratch_path(t.spark, "ingest")
    streams.start_ingest(_stream(t, "series_feed"), "body", ["feed_id"], f"{root}/rows", f"{root}/rejects", f"{root}/state").awaitTermination()
    rows = streams.read_ingested(t.spark, f"{root}/rows").groupBy("element_code").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values"))
    bad = streams.read_ingested(t.spark, f"{root}/rejects", f"{root}/rows-ledger").agg(F.count(F.lit(1)).alias("n")).select(F.lit(None).cast("string").alias("element_code"), "n", F.lit(0).cast("long").alias("n_values"))
    return rows.withColumn("sink", F.lit("rows")).unionByName(bad.withColumn("sink", F.lit("rejects")))


@query(
    "S2_stream_period", "readings",
    """WITH w AS (SELECT station_triplet, element_code, date_trunc('day', ts) AS period, count(*) AS n, round(avg(value), 6) AS average FROM readings
      WHERE value IS NOT NULL GROUP BY ALL)
    SELECT station_triplet, element_code, CAST(period AS TIMESTAMP) AS period, n, average FROM w
    WHERE period + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM readings WHERE value IS NOT NULL)""",
)
def _(t):
    root = scratch_path(t.spark, "periods")
    streams.start_period_means(_stream(t, "readings"), "DAILY", f"{root}/rows", f"{root}/state").awaitTermination()
    return rounded(t.spark.read.parquet(f"{root}/rows"), "average")


@query("S3_published_merge", "readings", f"WITH {_VERSIONS} {_LATEST}")
def _(t):
    """The batch form: base and changes as two batches of a log, merged one after the other."""
    root = scratch_path(t.spark, "merge")
    for number, part in enumerate(_versions(t)):
        part.write.parquet(f"{root}/log/batch={number}")
        streams.merge_changes(t.spark, f"{root}/log", f"{root}/base", f"{root}/versions")
    return streams.read_merged(t.spark, f"{root}/base", f"{root}/versions").select(*SERIES, "ts", "value", "updated_at")


@query("S3_stream_upsert", "readings", f"WITH {_VERSIONS} {_LATEST}")
def _(t):
    root = scratch_path(t.spark, "upsert")
    base, _ = _versions(t)
    stream = _stream(t, "readings").select(*SERIES, F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts"), "value", "updated_at", "qc_flag").where("qc_flag = 'S'")
    changes = stream.withColumns({"value": F.col("value") + 1000, "updated_at": F.col("updated_at") + F.expr("INTERVAL '30' MINUTE")}).drop("qc_flag")
    streams.start_upsert(changes, f"{root}/log", f"{root}/state", delay="1 day").awaitTermination()
    return streams.current_readings(t.spark, f"{root}/log", base).select(*SERIES, "ts", "value", "updated_at")
