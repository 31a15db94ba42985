"""Logical survey, laboratory and station tables over the supplied Parquet.

Each logical table is a projection of one supplied table, written once as SQL
expressions that Spark and DuckDB both understand, so the checks run on the
same rows. Keys become coordinates, texts or JSON by plain arithmetic.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamframe.session import checkpoint_root, configure, scratch_path
from loamframe.sources.spatial_table import write_spatial_table


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _concat(*parts: str) -> str:
    return "concat(" + ", ".join(parts) + ")"


def _triplet(key: str) -> str:
    network = f"CASE {key} % 4 WHEN 0 THEN 'SCAN' WHEN 1 THEN 'SNTL' WHEN 2 THEN 'SNOW' ELSE 'COOP' END"
    return _concat(_text(key), "':S'", _text(f"{key} % 25"), "':'", network)


def _at(base: str, offset: str) -> str:
    """Coordinate text; all values are multiples of 1/8, exact in binary."""
    return _text(f"{base} + {offset}")


_X = "-120 + CAST(c_custkey % 389 AS DOUBLE) / 4"
_Y = "30 + CAST(c_custkey * 7 % 211 AS DOUBLE) / 4"
_S = "CAST(1 + c_custkey % 4 AS DOUBLE) / 2"


def _ring(points: list[tuple[float, float]]) -> str:
    parts = ["'('"]
    for i, (a, b) in enumerate(points):
        parts += ([] if i == 0 else ["', '"]) + [_at(_X, f"{_S} * {a}"), "' '", _at(_Y, f"{_S} * {b}")]
    return ", ".join(parts + ["')'"])


_SQUARE = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
_ELL = [(0, 0), (1, 0), (1, 0.5), (0.5, 0.5), (0.5, 1), (0, 1), (0, 0)]
_HOLE = [(0.25, 0.25), (0.25, 0.75), (0.75, 0.75), (0.75, 0.25), (0.25, 0.25)]
_WKT = (
    "CASE c_custkey % 3 "
    f"WHEN 0 THEN concat('POLYGON (', {_ring(_SQUARE)}, ')') "
    f"WHEN 1 THEN concat('POLYGON (', {_ring(_ELL)}, ')') "
    f"ELSE concat('POLYGON (', {_ring(_SQUARE)}, ', ', {_ring(_HOLE)}, ')') END"
)
_LX, _LY = "-102 + CAST(s_suppkey * 13 % 37 AS DOUBLE) / 8", "49.5 + CAST(s_suppkey * 7 % 19 AS DOUBLE) / 8"
_SX, _SY = "(-120 + n_nationkey % 5 * 20)", "(30 + CAST(floor(n_nationkey / 5) AS INT) * 10)"
_AREA_WKT = _concat(
    "'POLYGON (('", _text(_SX), "' '", _text(_SY), "', '", _text(f"{_SX} + 20"), "' '", _text(_SY), "', '", _text(f"{_SX} + 20"),
    "' '", _text(f"{_SY} + 10"), "', '", _text(_SX), "' '", _text(f"{_SY} + 10"), "', '", _text(_SX), "' '", _text(_SY), "'))'",
)


def _tag(name: str, value: str) -> str:
    return f"'<{name}>', {value}, '</{name}>'"


_XML = (
    "CASE WHEN doc_id % 17 = 0 THEN concat('<metadata><idinfo>', source) ELSE concat('<metadata><idinfo><citation><citeinfo>', "
    + ", ".join(
        [
            _tag("origin", "'Survey office'"),
            "CASE WHEN doc_id % 3 = 0 THEN concat('<pubdate>', CAST(2005 + doc_id % 20 AS STRING), lpad(CAST(1 + doc_id % 12 AS STRING), 2, '0'), '15</pubdate>') "
            "WHEN doc_id % 3 = 1 THEN concat('<pubdate>', CAST(2005 + doc_id % 20 AS STRING), '-', lpad(CAST(1 + doc_id % 12 AS STRING), 2, '0'), '-15</pubdate>') "
            "ELSE '<pubdate>unknown</pubdate>' END",
            _tag("title", "concat('Survey of ', source)"),
            "CASE WHEN doc_id % 4 = 0 THEN '<geoform>digital map 1:24000</geoform>' WHEN doc_id % 4 = 1 THEN '<geoform>map 1:12000</geoform>' ELSE '' END",
            "'<pubinfo>'", _tag("publish", "concat('Publisher ', lang)"), "'</pubinfo></citeinfo></citation>'",
            "'<descript>'", _tag("abstract", "translate(text, '<>&', '   ')"), "'</descript>'",
            "'<spdom><bounding>'",
            _tag("westbc", "CAST(-120 + doc_id % 50 AS STRING)"), _tag("eastbc", "CAST(-119 + doc_id % 50 AS STRING)"),
            _tag("northbc", "CAST(31 + doc_id % 15 AS STRING)"),
            "CASE WHEN doc_id % 11 = 0 THEN '' ELSE concat('<southbc>', CAST(30 + doc_id % 15 AS STRING), '</southbc>') END",
            "'</bounding></spdom><keywords><theme><themekey>Soil</themekey>'", _tag("themekey", "source"),
            "'</theme><theme>'", _tag("themekey", "lang"), "'</theme>'",
            "CASE WHEN doc_id % 5 = 0 THEN '' ELSE '<place><placekey>County</placekey></place>' END", "'</keywords>'",
            "CASE WHEN doc_id % 2 = 0 THEN '<ptcontac><cntinfo><cntemail>soil@example.org</cntemail></cntinfo></ptcontac>' ELSE '' END",
            "'</idinfo><dataqual><lineage><procstep><procdesc>Mapped</procdesc><procdate>'", "CAST(2000 + doc_id % 20 AS STRING)",
            "'</procdate></procstep>'",
            "CASE WHEN doc_id % 7 = 0 THEN '<procstep><procdesc>Checked</procdesc><srcused>Field</srcused></procstep>' ELSE '' END",
            "'</lineage></dataqual></metadata>'",
        ]
    )
    + ") END"
)

_TYPES = ", ".join(f'"ColumnOrdinal={i},DataTypeName={t}"' for i, t in enumerate(["varchar", "bigint", "float", "bit", "datetime"]))
_PAYLOAD = (
    "CASE WHEN o_orderkey % 23 = 0 THEN '{}' WHEN o_orderkey % 29 = 0 THEN 'not json' "
    "WHEN o_orderkey % 31 = 0 THEN '{\"Rows\":[]}' "
    f"WHEN o_orderkey % 37 = 0 THEN '{{\"Table\":[[\"musym\",\"mukey\",\"pct\",\"flag\",\"obsdate\"],[{_TYPES}]]}}' "
    f"ELSE concat('{{\"Table\":[[\"musym\",\"mukey\",\"pct\",\"flag\",\"obsdate\"],[{_TYPES}],[\"', o_orderpriority, '\",\"', "
    "CAST(o_custkey AS STRING), '\",\"', CAST(o_totalprice AS STRING), '\",\"', CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END, "
    "'\",\"', CAST(o_orderdate AS STRING), '\"],[\"short\",\"', CAST(o_orderkey AS STRING), '\"]', "
    "CASE WHEN o_orderkey % 2 = 0 THEN ',[\"long\",\"7\",null,\"yes\",\"\",\"cut\"]' ELSE '' END, ']}') END"
)

_STATION_FEED = _concat(
    "'[{\"stationTriplet\":\"'", _triplet("s_suppkey"), "'\",'",
    "CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE concat('\"name\":\"', s_name, '\",') END",
    "CASE WHEN s_suppkey % 7 = 0 THEN '\"latitude\":\"bad\",' WHEN s_suppkey % 11 = 0 THEN '' ELSE concat('\"latitude\":', CAST(25 + CAST(s_suppkey * 37 % 2400 AS DOUBLE) / 100 AS STRING), ',') END",
    "'\"longitude\":'", _text("-125 + CAST(s_suppkey * 73 % 5800 AS DOUBLE) / 100"),
    "',\"elevation\":'", _text("s_acctbal"), "',\"networkCode\":\"SCAN\",\"dataTimeZone\":-8,\"stationElements\":[{\"elementCode\":\"SMS\",\"heightDepth\":-2,\"ordinal\":1,\"beginDate\":\"2000-01-01\"},{\"elementCode\":\"PREC\"}]}]'",
)

_SERIES_FEED = (
    "CASE WHEN event_id % 41 = 0 THEN '[{\"stationTriplet\":\"x\",\"error\":\"no such station\",\"data\":[{\"values\":[]}]}]' "
    "WHEN event_id % 43 = 0 THEN 'oops' ELSE "
    + _concat(
        "'[{\"stationTriplet\":\"'", _triplet("user_id"),
        "'\",\"data\":[{\"stationElement\":{\"elementCode\":\"SMS\",\"heightDepth\":-2,\"ordinal\":1},\"values\":[{\"date\":\"'",
        "substr(CAST(ts AS STRING), 1, 16)", "'\",\"value\":'", _text("value"),
        "',\"qcFlag\":\"V\"},{\"date\":\"'", "substr(CAST(ts AS STRING), 1, 10)",
        "'\",\"value\":null,\"qcFlag\":\"\",\"qaFlag\":\"P\"},{\"date\":\"\",\"value\":1},{\"date\":\"later\",\"value\":2}]},{\"stationElement\":{\"elementCode\":\"PREC\"},\"values\":[{\"date\":\"'",
        "concat(substr(CAST(ts AS STRING), 1, 10), 'T12:00:00Z')", "'\",\"value\":'", _text("value"), "'}]}]}]'",
    )
    + " END"
)

_SECOND_STATIONS = _concat(
    "'{\"sensors\":[{\"sid\":\"SITE_'", _text("s_suppkey % 60"), "'\",\"name\":\"'", "s_name", "'\",\"project\":\"P'", _text("s_nationkey % 4"),
    "'\",\"sso\":\"2-SON\",\"wgs84_latitude\":\"38.5\",\"wgs84_longitude\":-120.5,\"elevation_m\":'", _text("CAST(floor(s_acctbal) AS INT)"),
    "',\"state\":\"S'", _text("s_nationkey"), "'\",\"installation_date\":\"2010-05-01\"'",
    "CASE WHEN s_acctbal < 1000 THEN ',\"removal_date\":\"2020-05-01\"' ELSE '' END",
    "'},{\"sid\":\"SITE_'", _text("s_suppkey % 7"), "'\",\"name\":\"again\"},{\"sid\":\"\"}]}'",
)
_SECOND_READINGS = _concat(
    "'{\"soiltemp\":[{\"date_time\":\"'", "substr(CAST(ts AS STRING), 1, 19)", "'\",\"sensor_value\":\"'", _text("value"),
    "'\",\"qc_flag\":\"V\"}],\"soilVWC\":[{\"date_time\":\"'", "substr(CAST(ts AS STRING), 1, 10)",
    "'\",\"sensor_value\":\"bad\"},{\"date_time\":\"never\",\"sensor_value\":1}],\"waterlevel\":[{\"date_time\":\"'",
    "concat(substr(CAST(ts AS STRING), 1, 10), 'T06:00:00')", "'\",\"sensor_value\":'", _text("user_id"), "'}]}'",
)
_FORECASTS = _concat(
    "'[{\"stationTriplet\":\"'", _triplet("c_custkey"), "'\",\"forecastPointName\":\"'", "c_name",
    "'\",\"data\":[{\"elementCode\":\"SRVO\",\"forecastPeriod\":[\"04-01\",\"07-31\"],\"publicationDate\":\"2024-0'", _text("1 + c_custkey % 6"),
    "'-01\",\"unitCode\":\"kac_ft\",\"forecastValues\":{\"10\":'", _text("c_acctbal"), "',\"50\":5.5,\"90\":1.5}},{\"elementCode\":\"RESC\",\"forecastPeriod\":[\"03-01\",\"07-31\"],\"publicationDate\":\"2024-02-01\",\"unitCode\":\"kac_ft\",\"forecastValues\":{\"50\":2.5}}]}]'",
)
_REFERENCE = _concat(
    "'{\"elements\":[{\"code\":\"E'", _text("p_partkey"), "'\",\"name\":\"'", "p_name", "'\",\"englishUnitCode\":\"inch\"}],\"units\":[{\"code\":\"U'",
    _text("p_size"), "'\",\"name\":\"'", "p_type", "'\"}],\"networks\":[{\"code\":\"SCAN\",\"name\":\"Soil\"},{\"code\":\"SNTL\"}]}'",
)

_RAW = (
    "CASE o_orderkey % 14 WHEN 0 THEN CAST(o_custkey AS STRING) WHEN 1 THEN CAST(o_totalprice AS STRING) "
    "WHEN 2 THEN concat('$', CAST(o_custkey AS STRING), ',234.50') WHEN 3 THEN concat(CAST(o_custkey AS STRING), 'abc') "
    "WHEN 4 THEN 'yes' WHEN 5 THEN 'OFF' WHEN 6 THEN 'None' WHEN 7 THEN '' WHEN 8 THEN 'nan' "
    "WHEN 9 THEN substr(CAST(o_orderdate AS STRING), 1, 10) WHEN 10 THEN concat(substr(CAST(o_orderdate AS STRING), 1, 10), 'T10:30:00Z') "
    "WHEN 11 THEN concat(substr(CAST(o_orderdate AS STRING), 6, 2), '/', substr(CAST(o_orderdate AS STRING), 9, 2), '/', substr(CAST(o_orderdate AS STRING), 1, 4)) "
    "WHEN 12 THEN NULL ELSE concat('-', CAST(o_totalprice AS STRING)) END"
)

_ELEMENT = "CASE p_partkey % 7 WHEN 0 THEN 'SMS' WHEN 1 THEN 'SMS' WHEN 2 THEN 'SMS' WHEN 3 THEN 'STO' WHEN 4 THEN 'PREC' WHEN 5 THEN 'TOBS' ELSE 'ZDUM' END"
_DEPTH = "CAST(CASE p_partkey % 7 WHEN 0 THEN -2 WHEN 1 THEN -20 WHEN 2 THEN -8 WHEN 3 THEN -4 WHEN 5 THEN 48 ELSE NULL END AS INT)"
_READING_ELEMENT = "CASE event_type WHEN 'click' THEN 'SMS:-2:1' WHEN 'view' THEN 'SMS:-20:1' WHEN 'error' THEN 'STO:-4:1' WHEN 'purchase' THEN 'PREC:0:1' ELSE 'TOBS:48:1' END"

# logical table -> (supplied table, {column: expression})
LOGICAL: dict[str, tuple[str, dict[str, str]]] = {
    "legend": ("nation", {
        "lkey": "CAST(n_nationkey AS BIGINT)", "areasymbol": "n_name", "areaname": "concat('Area ', n_name)",
        "saversion": "CAST(n_regionkey AS BIGINT)", "saverest": "concat('2024-0', CAST(n_regionkey + 1 AS STRING), '-01')",
    }),
    "mapunit": ("customer", {
        "mukey": "c_custkey", "lkey": "CAST(c_nationkey AS BIGINT)", "musym": "c_mktsegment", "muname": "c_name",
        "mukind": "CASE WHEN c_acctbal < 3000 THEN 'Complex' ELSE 'Consociation' END", "muacres": "c_acctbal",
    }),
    "component": ("orders", {
        "cokey": "o_orderkey", "mukey": "o_custkey", "compname": "o_orderpriority", "comppct_r": "o_totalprice",
        "majcompflag": "CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END",
        "taxclname": "CASE WHEN o_orderstatus = 'O' THEN 'null' ELSE o_orderpriority END",
        "drainagecl": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END",
    }),
    "chorizon": ("lineitem", {
        "chkey": "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING), '-', CAST(l_extendedprice AS STRING))",
        "cokey": "l_orderkey", "hzname": "concat(l_returnflag, l_linestatus)",
        "hzdept_r": "CAST((l_linenumber - 1) * 10 AS DOUBLE)", "hzdepb_r": "CAST(l_linenumber * 10 AS DOUBLE)",
        "claytotal_r": "l_quantity", "claytotal_l": "l_quantity - 1", "claytotal_h": "l_quantity + 1",
        "sandtotal_r": "l_quantity / 2", "silttotal_r": "100 - l_quantity * 1.5",
        "om_r": "CASE WHEN l_tax > 0 THEN l_tax * 100 ELSE NULL END", "awc_r": "l_discount",
        "ksat_r": "l_extendedprice / 1000", "ph1to1h2o_r": "4 + l_tax * 50",
    }),
    "muaggatt": ("supplier", {
        "mukey": "s_suppkey", "wtdepannmin": "s_acctbal", "wtdepannmax": "s_acctbal + 100",
        "flodfreqdcd": "CASE WHEN s_acctbal < 5000 THEN 'None' ELSE 'Rare' END",
    }),
    "comonth": ("lineitem", {
        "cokey": "l_orderkey", "month": "CAST(month(l_shipdate) AS INT)", "wtdepannmin": "l_quantity",
        "wtdepannmax": "l_quantity + 50", "flodfreqcl": "l_returnflag",
    }),
    "mupolygon": ("customer", {
        "polygonkey": "c_custkey", "mukey": "c_custkey", "areasymbol": "concat('NATION_', CAST(c_nationkey AS STRING))",
        "musym": "c_mktsegment", "spatialversion": "CAST(1 AS BIGINT)", "mupolygongeo": _WKT,
    }),
    "sapolygon": ("nation", {
        "sapolygonkey": "CAST(n_nationkey AS BIGINT)", "areasymbol": "n_name", "areaname": "concat('Area ', n_name)",
        "spatialversion": "CAST(2 AS BIGINT)", "lkey": "CAST(n_nationkey AS BIGINT)", "sapolygongeo": _AREA_WKT,
    }),
    "muline": ("supplier", {
        "linekey": "s_suppkey", "mulinegeo": _concat(
            "'LINESTRING ('", _at(_LX, "0"), "' '", _at(_LY, "0"), "', '", _at(_LX, "CAST(1 + s_suppkey % 3 AS DOUBLE) / 2"), "' '", _at(_LY, "0"), "')'"),
    }),
    "mupoint": ("orders", {
        "pointkey": "o_orderkey", "mupointgeo": _concat(
            "'POINT ('", _text("-101 + CAST(o_orderkey * 13 % 31 AS DOUBLE) / 8"), "' '", _text("49 + CAST(o_orderkey * 17 % 29 AS DOUBLE) / 8"), "')'"),
    }),
    "points": ("orders", {
        "point_id": "o_orderkey", "lon": "-120 + CAST(o_orderkey * 13 % 779 AS DOUBLE) / 8",
        "lat": "30 + CAST(o_orderkey * 17 % 423 AS DOUBLE) / 8",
    }),
    "lab_sites": ("customer", {
        "pedon_key": "CAST(c_custkey AS STRING)", "upedonid": "concat('85P', CAST(c_custkey AS STRING))",
        "latitude_decimal_degrees": "CASE WHEN c_acctbal < 0 THEN NULL ELSE 25 + CAST(c_custkey * 41 % 2400 AS DOUBLE) / 100 END",
        "longitude_decimal_degrees": "-125 + CAST(c_custkey * 59 % 5800 AS DOUBLE) / 100",
        "corr_name": "c_mktsegment", "samp_name": "c_name",
    }),
    "lab_layer": ("orders", {
        "layer_key": "CAST(o_orderkey AS STRING)", "pedon_key": "CAST(o_custkey AS STRING)", "labsampnum": "concat('L', CAST(o_orderkey AS STRING))",
        "layer_sequence": "o_orderkey % 7",
        "layer_type": "CASE o_orderstatus WHEN 'F' THEN 'horizon' WHEN 'O' THEN 'layer' ELSE 'reporting layer' END",
        "hzn_top": "CAST(o_orderkey % 7 * 10 AS DOUBLE)", "hzn_bot": "CAST(o_orderkey % 7 * 10 + 10 AS DOUBLE)", "hzn_desgn": "o_orderpriority",
        "total_carbon_ncs": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey % 50 AS DOUBLE) / 10 END",
        "organic_carbon_walkley_black": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 30 AS DOUBLE) / 10 END",
        "caco3_lt_2_mm": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 40 AS DOUBLE) END",
    }),
    "lab_physical_properties": ("lineitem", {
        "labsampnum": "concat('L', CAST(l_orderkey AS STRING))",
        "prep_code": "CASE l_returnflag WHEN 'A' THEN 'S' WHEN 'N' THEN NULL ELSE 'GP' END",
        "clay_total": "l_quantity", "sand_total": "l_quantity / 2",
    }),
    "lab_chemical_properties": ("part", {
        "labsampnum": "concat('L', CAST(p_partkey AS STRING))", "prep_code": "CASE WHEN p_size < 25 THEN 'S' ELSE 'GP' END",
        "ph_h2o": "CAST(p_size AS DOUBLE) / 10",
    }),
    "lab_mineralogy_glass_count": ("customer", {
        "labsampnum": "concat('L', CAST(c_custkey AS STRING))", "prep_code": "'S'",
        "analyzed_size_frac": "CASE WHEN c_acctbal < 2000 THEN '<2 mm' WHEN c_acctbal < 4000 THEN NULL ELSE '0.02-0.05 mm' END",
        "glass_count": "c_acctbal",
    }),
    "lab_rosetta_key": ("supplier", {"layer_key": "CAST(s_suppkey AS STRING)", "theta_r": "s_acctbal / 10000"}),
    "stations": ("supplier", {
        "station_triplet": _triplet("s_suppkey"), "name": "s_name", "latitude": "25 + CAST(s_suppkey * 37 % 2400 AS DOUBLE) / 100",
        "longitude": "-125 + CAST(s_suppkey * 73 % 5800 AS DOUBLE) / 100", "elevation": "s_acctbal",
        "network_code": "CASE s_suppkey % 4 WHEN 0 THEN 'SCAN' WHEN 1 THEN 'SNTL' WHEN 2 THEN 'SNOW' ELSE 'COOP' END",
        "state": "concat('S', CAST(s_suppkey % 25 AS STRING))", "county": "concat('County ', CAST(s_nationkey AS STRING))",
        "huc": "lpad(CAST(s_suppkey * 7919 % 1000000 AS STRING), 6, '0')", "dco_code": "concat('D', CAST(s_nationkey % 5 AS STRING))",
        "data_time_zone": "CAST(-8 + s_suppkey % 4 AS INT)", "begin_date": "'2000-01-01'",
        "end_date": "CASE WHEN s_acctbal < 1000 THEN '2020-01-01' ELSE NULL END",
        "removal_date": "CASE WHEN s_acctbal < 1000 THEN DATE '2020-01-01' ELSE NULL END",
    }),
    "sensors": ("part", {
        "station_triplet": _triplet("CAST(floor(p_partkey / 20) AS BIGINT)"), "element_code": _ELEMENT, "height_depth": _DEPTH,
        "ordinal": "CAST(floor(p_partkey % 20 / 7) AS INT) + 1", "begin_date": "'2000-01-01'",
        "end_date": "CASE WHEN p_size < 10 THEN '2020-01-01' ELSE NULL END", "data_precision": "p_size % 3",
        "stored_unit_code": "'pct'", "original_unit_code": "CASE WHEN p_size % 2 = 0 THEN 'pct' ELSE NULL END",
        "derived_data": "p_size > 40", "duration": "CASE WHEN p_size % 2 = 0 THEN 'DAILY' ELSE 'HOURLY' END",
    }),
    "readings": ("events", {
        "station_triplet": _triplet("user_id"), "element_code": _READING_ELEMENT, "ts": "ts",
        "value": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END",
        "qc_flag": "CASE WHEN event_id % 10 = 0 THEN 'S' WHEN event_id % 3 = 0 THEN '' ELSE 'V' END",
        "qa_flag": "CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'S' ELSE 'P' END",
        "orig_qc_flag": "CASE WHEN event_id % 5 = 0 THEN 'E' ELSE NULL END", "orig_value": "value",
        "updated_at": "ts + INTERVAL '1' HOUR",
    }),
    # Daily-like series over several years, for the yearly operators.
    "long_readings": ("lineitem", {
        "station_triplet": _triplet("l_suppkey"),
        "element_code": "CASE l_linenumber WHEN 1 THEN 'SMS' WHEN 2 THEN 'SMV' WHEN 3 THEN 'STO' WHEN 4 THEN 'STV' WHEN 5 THEN 'PREC' WHEN 6 THEN 'PRCP' ELSE 'TOBS' END",
        "ts": "l_shipdate", "value": "CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity END",
    }),
    "sites": ("customer", {
        "site_id": "c_custkey", "latitude": "25 + CAST(c_custkey * 41 % 2400 AS DOUBLE) / 100",
        "longitude": "-125 + CAST(c_custkey * 59 % 5800 AS DOUBLE) / 100", "areasymbol": "concat('NATION_', CAST(c_nationkey AS STRING))",
    }),
    "requests": ("customer", {
        "request_id": "c_custkey", "station_triplet": _triplet("c_custkey % 100"), "element_code": "CASE WHEN c_acctbal < 5000 THEN 'SMS:-2:1' ELSE 'PREC:0:1' END",
        "start_date": "DATE '2024-01-05'", "end_date": "CASE WHEN c_acctbal < 2000 THEN DATE '2024-01-10' ELSE DATE '2024-01-20' END",
    }),
    "raw_values": ("orders", {"id": "o_orderkey", "raw": _RAW}),
    "payloads": ("orders", {"payload_id": "o_orderkey", "body": _PAYLOAD}),
    "station_feed": ("supplier", {"feed_id": "s_suppkey", "body": _STATION_FEED}),
    "series_feed": ("events", {"feed_id": "event_id", "body": _SERIES_FEED}),
    "second_stations": ("supplier", {"feed_id": "s_suppkey", "body": _SECOND_STATIONS}),
    "second_readings": ("events", {"station_id": "concat('SITE_', CAST(user_id AS STRING))", "body": _SECOND_READINGS}),
    "forecast_feed": ("customer", {"feed_id": "c_custkey", "body": _FORECASTS}),
    "reference_feed": ("part", {"feed_id": "p_partkey", "body": _REFERENCE}),
    "survey_xml": ("documents", {"doc_id": "doc_id", "areasymbol": "concat('A', CAST(doc_id AS STRING))", "fgdcmetadata": _XML}),
    "depth_texts": ("lineitem", {
        "cokey": "l_orderkey",
        "hzdept_r": "CASE WHEN l_linenumber = 7 THEN 'unknown' WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN '-5' ELSE CAST((l_linenumber - 1) * 10 AS STRING) END",
        "hzdepb_r": "CASE WHEN l_quantity = 50 THEN NULL WHEN l_quantity = 49 THEN '300' ELSE CAST(l_linenumber * 10 AS STRING) END",
    }),
}


_WRITTEN: dict[tuple, str] = {}  # spatial tables of this process


class Tables:
    """Logical tables by attribute; supplied tables through ``raw``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return os.path.join(self.sf_dir, f"{name}.parquet")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def shapes(self, name: str, wkt: str = "mupolygongeo") -> DataFrame:
        """A logical table as a spatial table, written once per session and source.

        The source's files, their sizes and times say whether it is the same.
        """
        meta = [F.col(f"_metadata.{c}").cast("string") for c in ("file_path", "file_size", "file_modification_time")]
        seen = self.raw(LOGICAL[name][0]).select(F.xxhash64(*meta).alias("h")).distinct().agg(F.sum(F.col("h").cast("decimal(20,0)"))).first()[0]
        key = (self.spark.sparkContext.applicationId, checkpoint_root(self.spark), name, wkt, str(seen))
        if key not in _WRITTEN:
            path = scratch_path(self.spark, name)
            write_spatial_table(getattr(self, name), wkt, path)
            _WRITTEN[key] = path
        return self.spark.read.parquet(_WRITTEN[key])

    def __getattr__(self, name: str) -> DataFrame:
        if name not in LOGICAL:
            raise AttributeError(name)
        return logical(self.raw(LOGICAL[name][0]), name)


def logical(source: DataFrame, name: str) -> DataFrame:
    """A logical table over (a batch or a stream of) its supplied table."""
    return source.selectExpr(*[f"{expr} AS {column}" for column, expr in LOGICAL[name][1].items()])


def with_tables(names: str, body: str) -> str:
    """Check SQL: the logical tables as common table expressions, then ``body``."""
    ctes = []
    for name in names.split():
        source, columns = LOGICAL[name]
        ctes.append(f"{name} AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {source})")
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
