import datetime as dt
import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

from loamframe.functions import periods, readings as r
from loamframe.functions.quantiles import exact_median
from loamframe.operators import coverage, selection, stations
from loamframe.sources import feeds, survey_xml

D = dt.datetime


def test_exact_median(spark):
    random.seed(1)
    rows = [("hot", random.choice([1.0, 1.0, 2.5, random.random() * 100])) for _ in range(20_000)]
    rows += [("same", 7.0)] * 5000 + [("even", v) for v in (1.0, 2.0, 3.0, 10.0)] + [("one", 4.0), ("one", None)]
    found = {x["k"]: x["m"] for x in exact_median(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", "m").collect()}
    for key in ("hot", "same", "even", "one"):
        assert found[key] == statistics.median(v for k, v in rows if k == key and v is not None)


@pytest.mark.parametrize(
    "duration, start, end",
    [
        ("HOURLY", D(2024, 2, 29, 13), D(2024, 2, 29, 14)), ("DAILY", D(2024, 2, 29), D(2024, 2, 29)), ("SEMIMONTHLY", D(2024, 2, 16), D(2024, 2, 29)),
        ("MONTHLY", D(2024, 2, 1), D(2024, 2, 29)), ("CALENDAR_YEAR", D(2024, 1, 1), D(2024, 12, 31)), ("WATER_YEAR", D(2023, 10, 1), D(2024, 9, 30)),
        ("SEASONAL", D(2023, 12, 1), D(2024, 2, 29)),
    ],
)
def test_periods(spark, duration, start, end):
    df = spark.createDataFrame([(D(2024, 2, 29, 13, 45),)], "ts timestamp_ntz").select(periods.period_start(F.col("ts"), duration).alias("s"))
    row = df.select("s", periods.period_end(F.col("s"), duration).alias("e")).first()
    assert (row["s"], row["e"]) == (start, end)


def test_element_codes(spark):
    df = spark.createDataFrame([("SMS", 5.08), ("STO", 10.16), ("PREC", None), ("SMS", 6.35), ("SMS", -5.08)], "element_code string, depth_cm double").withColumn("ordinal", F.lit(1))
    rows = stations.normalize_elements(df).collect()
    assert [x["element_string"] for x in rows] == ["SMS:-2:1", "STO:-4:1", "PREC::1", "SMS:-2:1", "SMS:-2:1"]
    assert [tuple(x["parsed"]) for x in rows][:3] == [("SMS", -2, 1), ("STO", -4, 1), ("PREC", None, 1)]
    odd = spark.createDataFrame([("SMS",), ("a:b",), ("A:x:y",)], "c string").select(r.parse_element(F.col("c")).alias("p"))
    assert [tuple(x["p"]) for x in odd.collect()] == [("SMS", None, 1), ("a:b", None, 1), ("A", None, 1)]
    names = spark.createDataFrame([("soiltemp",), ("SOILVWC",), ("airtemp",), ("waterlevel",), ("wind",)], "v string").select(r.base_code(F.col("v")).alias("c"))
    assert [x["c"] for x in names.collect()] == ["STO", "SMS", "TOBS", "WL", "UNKNOWN"]


def test_times_and_offsets(spark):
    texts = ["2023-01-01T12:00:00Z", "2023-01-01T12:00:00-08:00", "2024-12-01 12:00", "2023-01-01", "later", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(r.parse_station_time(F.col("t")).alias("ts"))
    assert [x["ts"] for x in df.collect()] == [D(2023, 1, 1, 12), D(2023, 1, 1, 20), D(2024, 12, 1, 12), D(2023, 1, 1), None, None]
    utc = spark.createDataFrame([(D(2024, 12, 1, 12), -8), (D(2024, 12, 1, 12), None)], "ts timestamp_ntz, z int").select(r.local_to_utc(F.col("ts"), F.col("z")).alias("u"))
    assert [x["u"] for x in utc.collect()] == [D(2024, 12, 1, 20), D(2024, 12, 1, 12)]


STATIONS = [("1234:UT:SNTL", "Salt Lake", 40.0, -110.0, None), ("1001:CA:SCAN", "A Lake", 37.0, -120.0, None), ("1002:CA:SNTL", "B", 38.0, -121.0, "2001-01-01")]


def test_station_filters(spark):
    df = spark.createDataFrame(STATIONS, "station_triplet string, name string, latitude double, longitude double, end_date string")
    ids = lambda **k: sorted(x["station_triplet"] for x in selection.filter_stations(df, **k).collect())
    assert ids(states=["CA"], active_only=False) == ["1001:CA:SCAN", "1002:CA:SNTL"]
    assert ids(states=["CA"]) == ["1001:CA:SCAN"]
    assert ids(networks=["SNTL"], states=["CA", "UT"], active_only=False) == ["1002:CA:SNTL", "1234:UT:SNTL"]
    assert ids(triplets=["10*:*:*"], names=["*Lake"]) == ["1001:CA:SCAN"]
    assert ids(triplets=["1001.CA.SCAN"]) == []
    assert ids(as_of="2000-01-01") == ["1001:CA:SCAN", "1002:CA:SNTL", "1234:UT:SNTL"]
    with pytest.raises(ValueError):
        selection.filter_stations(df, elements=["SMS:*"])
    with pytest.raises(ValueError):
        selection.filter_date_range(df.withColumn("ts", F.current_timestamp()), "ts")


def test_stress_and_depths(spark):
    df = spark.createDataFrame([(0.2, 15.0), (0.2, 10.0), (0.2, 5.0), (0.2, 4.9), (None, 1.0)], "awc double, m double")
    assert [x[0] for x in df.select(stations.water_stress(F.col("awc"), F.col("m"))).collect()] == ["optimal", "moderate", "mild_stress", "severe_stress", None]
    clay = spark.createDataFrame([(19.9,), (20.0,), (35.0,), (None,)], "c double")
    assert [x[0] for x in clay.select(stations.recommended_depths(F.col("c"))).collect()] == [[-2, -4], [-2, -4, -8], [-2, -4, -8, -16, -20], None]


def test_deepest_sensor_comes_first(spark):
    sensors = spark.createDataFrame([("a", "SMS", -2, 1), ("a", "SMS", -20, 1), ("a", "SMS", -20, 2), ("a", "STO", -4, 1)], "station_triplet string, element_code string, height_depth int, ordinal int")
    rows = stations.sensor_depths(sensors, "soil_moisture", ordered=True).collect()
    assert [x["element_string"] for x in rows] == ["SMS:-20:1", "SMS:-20:2", "SMS:-2:1"]
    with pytest.raises(ValueError):
        stations.sensor_depths(sensors, "precipitation")
    data = spark.createDataFrame([("a", e, D(2024, 1, d), v) for e, d, v in [("SMS:-20:1", 2, 5.0), ("SMS:-20:1", 1, None), ("SMS:-2:1", 2, 9.0), ("SMS", 2, 1.0)]] + [("b", "SMS", D(2024, 1, 1), 3.0)],
                                 "station_triplet string, element_code string, ts timestamp_ntz, value double")
    picked = stations.station_property_readings(sensors, data, "soil_moisture", "2024-01-01", "2024-01-31").collect()
    assert sorted((x["station_triplet"], x["element_string"], x["value"]) for x in picked) == [("a", "SMS:-20:1", 5.0), ("b", "SMS", 3.0)]
    shallow = stations.station_property_readings(sensors, data, "soil_moisture", "2024-01-01", "2024-01-31", depth=-2).collect()
    assert [x["value"] for x in shallow] == [9.0]


def test_upsert_latest_wins(spark):
    schema = "station_triplet string, element_code string, ts timestamp_ntz, value double, updated_at timestamp_ntz"
    base = spark.createDataFrame([("a", "E", D(2024, 1, 1), 1.0, D(2024, 1, 2)), ("a", "E", D(2024, 1, 2), 2.0, None)], schema)
    changes = spark.createDataFrame([("a", "E", D(2024, 1, 1), 9.0, D(2024, 1, 2)), ("a", "E", D(2024, 1, 2), 8.0, D(2024, 1, 1)), ("b", "E", D(2024, 1, 1), 7.0, None)], schema)
    assert sorted(x["value"] for x in stations.upsert_readings(base, changes).collect()) == [7.0, 8.0, 9.0]


def test_coverage_gaps_and_status(spark):
    days = [1, 2, 3, 12, 14]
    data = spark.createDataFrame([("a", "SMS:-2:1", D(2024, 1, d), 1.0) for d in days] + [("a", "SMS:-2:1", D(2024, 1, 20), None)], "station_triplet string, element_code string, ts timestamp_ntz, value double")
    row = coverage.series_coverage(data).first()
    assert (row["coverage_days"], row["expected_records"], row["gap_count"], row["largest_gap_days"], row["mean_gap_days"]) == (5, 14, 1, 8, 4.5)
    sensors = spark.createDataFrame([("a", "SMS", -2, 1), ("a", "SMS", -4, 1), ("b", "SMS", -2, 1)], "station_triplet string, element_code string, height_depth int, ordinal int")
    named = spark.createDataFrame([("a", None), ("b", None), ("c", dt.date(2020, 1, 1))], "station_triplet string, removal_date date")
    status = {x["station_triplet"]: x for x in coverage.station_status(data, sensors, named, "2024-01-24").collect()}
    assert {k: v["overall_status"] for k, v in status.items()} == {"a": "partial", "b": "unknown", "c": "removed"}
    assert status["a"]["recency_score"] == pytest.approx(100 * (1 - 10 / 30)) and status["c"]["total_sensors"] == 0


def test_feeds(spark):
    body = [
        {"stationTriplet": "1:CA:SCAN", "latitude": "37.5", "longitude": -120.5, "stationElements": [{"elementCode": "SMS", "heightDepth": -2}]},
        {"stationTriplet": "2:CA:SCAN", "name": "x", "latitude": "12abc"},
    ]
    df = spark.createDataFrame([(1, json.dumps(body)), (2, "no json")], "feed_id int, body string")
    row = feeds.ingest_station_json(df, "body").collect()
    assert [(x["station_triplet"], x["name"], x["latitude"], x["network_code"]) for x in row] == [("1:CA:SCAN", "Unknown", 37.5, "UNKNOWN")]
    assert sorted((x["feed_id"], x["station_triplet"]) for x in feeds.rejected_stations(df, "body", ["feed_id"]).collect()) == [(1, "2:CA:SCAN"), (2, None)]
    sensors = feeds.sensor_table(feeds.ingest_station_json(df, "body")).first()
    assert (sensors["height_depth"], sensors["ordinal"], sensors["derived_data"]) == (-2, 1, False)


FULL = """<?xml version="1.0"?><metadata><idinfo><citation><citeinfo><origin>Office</origin><pubdate>{date}</pubdate><title> Test Survey
</title><geoform>map 1:24000</geoform><pubinfo><publish>NRCS</publish></pubinfo></citeinfo></citation>
<descript><abstract>About &amp; around</abstract><purpose>P</purpose></descript>
<spdom><bounding><westbc>-120.5</westbc><eastbc>-119.5</eastbc><northbc>38.5</northbc><southbc>37.5</southbc></bounding></spdom>
<keywords><theme><themekey>soil</themekey><themekey>agriculture</themekey></theme><place><placekey>California</placekey><placekey>Test County</placekey></place></keywords>
</idinfo><dataqual><lineage><procstep><procdesc>One</procdesc><procdate>2020</procdate></procstep><procstep><procdesc>Two</procdesc></procstep></lineage></dataqual></metadata>"""


def test_survey_xml(spark):
    docs = [("a", FULL.format(date="20230315")), ("b", FULL.format(date="2023-03-15")), ("c", "<metadata><idinfo><citation><citeinfo><title>Only</title></citeinfo></citation></idinfo></metadata>"), ("d", "Not XML"), ("e", None)]
    found = survey_xml.ingest_survey_xml(spark.createDataFrame(docs, "areasymbol string, xml string"), "xml", ["areasymbol"])
    rows = {x["areasymbol"]: x for x in found.collect()}
    a = rows["a"]
    assert (a["title"], a["abstract"], a["scale_denominator"], a["publisher"]) == ("Test Survey", "About & around", 24000, "NRCS")
    assert a["published"] == rows["b"]["published"] == dt.date(2023, 3, 15)
    assert (len(a["keywords"]), a["theme_keywords"], a["place_keywords"]) == (4, ["soil", "agriculture"], ["California", "Test County"])
    assert tuple(a["bounding_box"]) == (-120.5, -119.5, 38.5, 37.5)
    assert [tuple(s) for s in a["process_steps"]] == [("One", "2020", None), ("Two", None, None)]
    assert rows["c"]["title"] == "Only" and rows["c"]["keywords"] == [] and rows["c"]["is_valid"]
    assert not rows["d"]["is_valid"] and not rows["e"]["is_valid"]
    summary = {x["areasymbol"]: x for x in survey_xml.metadata_summary(found, ["areasymbol"]).collect()}
    assert summary["a"]["keywords_count"] == 4 and summary["d"]["error"] == "Failed to parse metadata" and summary["c"]["abstract_length"] == 0
    ids = lambda df: sorted(x["areasymbol"] for x in df.collect())
    assert ids(survey_xml.search_keywords(found, ["SOIL", "x"])) == ["a", "b"]
    assert ids(survey_xml.search_keywords(found, ["soil", "x"], True)) == []
    assert ids(survey_xml.filter_bbox_overlap(found, -120, 38, -110, 40)) == ["a", "b"]
    assert ids(survey_xml.filter_bbox_overlap(found, -119.5, 38, -110, 40)) == []
    stats = survey_xml.metadata_statistics(found, "2024-01-01").first()
    assert (stats["count"], stats["avg_scale"], stats["n_publishers"], stats["recent_surveys"], stats["has_contact"], stats["avg_keywords"]) == (3, 24000, 1, 2, 0, 2.7)


def test_null_keys_keep_their_groups(spark):
    rows = spark.sql("SELECT * FROM VALUES ('s', 'A', TIMESTAMP'2024-01-01', 1.0D), ('s', NULL, TIMESTAMP'2024-01-01', 3.0D) t(station_triplet, element_code, ts, value)")
    for tendency in ("AVERAGE", "MEDIAN", "ALL"):
        assert stations.aggregate_period(rows, "MONTHLY", tendency=tendency).count() == 2
    assert coverage.availability_probe(rows, "2023-12-01", "2024-02-01").count() == 2


def test_one_sensor_where_none_is_listed(spark):
    rows = spark.sql(
        "SELECT 's' AS station_triplet, code AS element_code, TIMESTAMP'2024-01-01' AS ts, v AS value FROM VALUES "
        "('SMS:-2:1', 1.0D), ('SMS:-40:1', 2.0D), ('SMS:-80:2', 3.0D), ('PREC:0:1', 4.0D), ('PREC:0:2', 5.0D) t(code, v)"
    )
    none = spark.createDataFrame([], "station_triplet string, element_code string, height_depth int, ordinal int")
    find = lambda name: [r["value"] for r in stations.station_property_readings(none, rows, name, "2023-12-01", "2024-02-01").collect()]
    assert find("soil_moisture") == [2.0] and find("precipitation") == [4.0]


@pytest.mark.parametrize("duration", ["DAILY", "SEMIMONTHLY", "MONTHLY", "SEASONAL", "WATER_YEAR", "CALENDAR_YEAR"])
def test_station_series_of_whole_and_broken_periods(spark, duration):
    data = [("a", "E", D(2022, 12, 20) + dt.timedelta(hours=19 * n), None if n % 11 == 0 else float(n)) for n in range(900)]
    ranges = [(1, "2023-01-01", "2023-12-31"), (2, "2023-02-10", "2023-02-20"), (3, "2023-01-16", "2024-03-02"), (4, "2022-01-01", "2030-01-01"),
              (5, "2023-05-05", "2023-05-05"), (6, "2023-06-02", "2023-06-01"), (7, None, "2023-06-01"), (8, "2023-09-30", "2023-10-01"), (9, "2023-02-01", "2023-02-28")]
    day = lambda text: text and dt.date.fromisoformat(text)
    readings = spark.createDataFrame(data, "station_triplet string, element_code string, ts timestamp_ntz, value double")
    requests = spark.createDataFrame([(i, "a", "E", day(x), day(y)) for i, x, y in ranges], "request_id int, station_triplet string, element_code string, start_date date, end_date date")
    plain = (
        requests.join(readings.where("value IS NOT NULL"), ["station_triplet", "element_code"])
        .where(F.to_date("ts").between(F.col("start_date"), F.col("end_date")))
        .groupBy("request_id", periods.period_start(F.col("ts"), duration).alias("period")).agg(F.count("value").alias("n"), F.avg("value").alias("average"))
    )
    found = stations.station_series(requests, readings, duration)
    listed = lambda df: sorted((x["request_id"], x["period"], x["n"], round(x["average"], 9)) for x in df.collect())
    assert listed(found) == listed(plain) and len(listed(found)) > 5


def test_station_series_gathers_nothing_per_request(spark):
    """F16: broken periods are cut in the request's own row, and only what is asked for is added up."""
    data = [(s, "E", D(2023, 1, d), float(d)) for s in ("a", "b") for d in range(1, 29)]
    readings = spark.createDataFrame(data, "station_triplet string, element_code string, ts timestamp_ntz, value double")
    requests = spark.createDataFrame([(n, "a", "E", dt.date(2023, 1, 3), dt.date(2023, 1, 3 + n)) for n in range(5)], "request_id int, station_triplet string, element_code string, start_date date, end_date date")
    found = stations.station_series(requests, readings, "MONTHLY")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate" in line and "request_id" in line]
    assert sorted((x["request_id"], x["n"], x["average"]) for x in found.collect()) == [(n, n + 1, 3 + n / 2) for n in range(5)]
    assert stations._asked_for(requests, readings).agg(F.min("station_triplet"), F.max("station_triplet"), F.count("*")).first()[:] == ("a", "a", 5)


def test_property_totals_choose_the_sensor_of_the_readings(spark):
    codes = ["SMS:-2:1", "SMS:-20:1", "SMS:-20:2", "SMS", "SMSX:-2:1", "STO:-4:1", "STO::2", "PREC:0:1", "PREC:0:2", "odd:1"]
    rows = [(f"s{s}", codes[(s * 7 + n * 3) % len(codes)], D(2024, 1, 1 + n % 28), None if n % 5 == 0 else float(n)) for s in range(12) for n in range(2 + s)]
    data = spark.createDataFrame(rows, "station_triplet string, element_code string, ts timestamp_ntz, value double")
    listed = [(f"s{s}", c, d, o) for s in range(0, 12, 2) for c, d, o in [("SMS", -2, 1), ("SMS", -20, None), ("STO", -4 - s % 4, 1), ("PREC", None, 1)]]
    sensors = spark.createDataFrame(listed, "station_triplet string, element_code string, height_depth int, ordinal int")
    names = ["soil_moisture", "soil_temp", "precipitation"]
    got = {tuple(x) for x in stations.station_property_totals(sensors, data, names, "2024-01-01", "2024-01-20").collect()}
    expected = set()
    for name in names:
        series = stations.station_property_readings(sensors, data, name, "2024-01-01", "2024-01-20")
        expected |= {(x["station_triplet"], name, x["n"], x["total"]) for x in series.groupBy("station_triplet").agg(F.count("value").alias("n"), F.sum("value").alias("total")).collect()}
    assert got == expected and len(got) > 10
    assert stations.station_property_totals(sensors, data, ["precipitation"], "2024-01-01", "2024-01-20").count() == sum(x[1] == "precipitation" for x in got)


def test_series_near_sites_keep_flags_and_are_not_repeated(spark):
    sites = spark.createDataFrame([(n, 40.0, -100.0 + n / 100) for n in range(5)] + [(9, 0.0, 0.0)], "site_id int, latitude double, longitude double")
    known = spark.createDataFrame([("a", 40.0, -100.0, "SCAN", -6, "A"), ("b", 45.0, -100.0, "SCAN", -7, "B")], "station_triplet string, latitude double, longitude double, network_code string, data_time_zone int, name string")
    data = spark.createDataFrame(
        [("a", "PREC:0:1", D(2024, 1, 1), 1.0, "V", "", 7.0, "E"), ("a", "PREC:0:1", D(2024, 1, 2), None, None, None, None, None), ("a", "PREC:0:1", D(2024, 1, 3), 2.0, None, "S", None, None), ("b", "PREC:0:1", D(2024, 1, 1), 5.0, None, None, None, None)],
        "station_triplet string, element_code string, ts timestamp_ntz, value double, qc_flag string, qa_flag string, orig_value double, orig_qc_flag string")
    none = spark.createDataFrame([], "station_triplet string, element_code string, height_depth int, ordinal int")
    links, series = stations.property_near_parts(sites, known, none, data, "precipitation", "2024-01-01", "2024-01-31")
    assert sorted((x["site_id"], x["station_triplet"], x["station_name"], x["n_data_points"]) for x in links.collect()) == [(n, "a", "A", 2) for n in range(5)]
    points = sorted(series.collect(), key=lambda x: x["ts"])
    assert [(x["value"], x["flags"], x["orig_value"], x["station_timezone_offset_hours"]) for x in points] == [(1.0, ["QC:V", "ORIG_QC:E"], 7.0, -6), (2.0, ["QA:S"], None, -6)]
    bare = stations.property_near_parts(sites, known.drop("data_time_zone", "name"), none, data.drop("qc_flag", "orig_value"), "precipitation", "2024-01-01", "2024-01-31")[1]
    assert bare.columns == ["station_triplet", "element_string", "ts", "value", "qa_flag", "orig_qc_flag", "unit"] and bare.count() == 2


def test_climate_join_scans_readings_once(spark, tmp_path):
    data = spark.createDataFrame([("a", "PREC:0:1", D(2024, 1, 1), 1.0)], "station_triplet string, element_code string, ts timestamp_ntz, value double")
    data.write.parquet(str(tmp_path / "readings_once"))
    sensors = spark.createDataFrame([("a", "SMS", -2, 1)], "station_triplet string, element_code string, height_depth int, ordinal int")
    totals = stations.station_property_totals(sensors, spark.read.parquet(str(tmp_path / "readings_once")), ["soil_moisture", "soil_temp", "precipitation"], "2024-01-01", "2024-01-31")
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ts#") and plan.count("Relation [") == 1
