"""Every table below must equal the published survey, laboratory
and station vocabularies for results to match, so they are stated plainly."""

# --- key column per survey table -------------------------------------------
TABLE_KEYS = {
    "legend": "lkey",
    "mapunit": "mukey",
    "component": "cokey",
    "chorizon": "chkey",
    "chfrags": "chfragkey",
    "chtexturegrp": "chtgkey",
    "chtexture": "chtkey",
    "mupolygon": "mukey",
    "sapolygon": "areasymbol",
    "mupoint": "mukey",
    "muline": "mukey",
    "featpoint": "featkey",
    "featline": "featkey",
    "cointerp": "cokey",
    "chinterp": "chkey",
    "copmgrp": "copmgrpkey",
    "corestrictions": "reskeyid",
    "sacatalog": "areasymbol",
    "laoverlap": "lkey",
    "legendtext": "lkey",
}

# --- geometry column per spatial table --------------------------------------
GEOMETRY_COLUMNS = {
    "mupolygon": "mupolygongeo",
    "sapolygon": "sapolygongeo",
    "mupoint": "mupointgeo",
    "muline": "mulinegeo",
    "featpoint": "featpointgeo",
    "featline": "featlinegeo",
}
PROJECTED_COLUMNS = [
    "mupolygonproj", "mupointproj", "mulineproj", "sapolygonproj", "featpointproj", "featlineproj",
]
GEOGRAPHIC_COLUMNS = [
    "mupolygongeo", "mupointgeo", "mulinegeo", "sapolygongeo", "featpointgeo", "featlinegeo",
]

# --- three filter fields per table (primary, secondary, tertiary) -----------
KEY_FIELDS = {
    "mapunit": ("mukey", "musym", "muname"),
    "component": ("cokey", "mukey", "compname"),
    "chorizon": ("chkey", "cokey", "hzname"),
    "legend": ("lkey", "areasymbol", None),
}

# --- named column sets -------------------------------------------------------
_HORIZON = ["chkey", "hzname", "hzdept_r", "hzdepb_r"]
_TEXTURE = ["sandtotal_r", "silttotal_r", "claytotal_r"]
_CHEMICAL = ["ph1to1h2o_r", "om_r", "caco3_r", "gypsum_r", "sar_r", "cec7_r", "ecec_r"]
_PHYSICAL = ["dbthirdbar_r", "dbovendry_r", "ksat_r", "awc_r", "wfifteenbar_r", "wthirdbar_r", "wtenthbar_r"]
_LAYER = ["layer_key", "layer_sequence", "hzn_top", "hzn_bot", "hzn_desgn"]
_LAYER_TEXTURE = ["sand_total", "silt_total", "clay_total", "texture_lab"]
_LAYER_CHEMICAL = ["ph_h2o", "organic_carbon_walkley_black", "total_carbon_ncs", "caco3_lt_2_mm"]
_LAYER_PHYSICAL = [
    "bulk_density_third_bar", "le_third_fifteen_lt2_mm", "water_retention_third_bar", "water_retention_15_bar",
]
_LAYER_CALCULATED = [
    "estimated_om", "estimated_c_tot", "estimated_n_tot", "estimated_sand", "estimated_silt", "estimated_clay",
]
_LAYER_ROSETTA = ["theta_r", "theta_s", "alpha", "npar", "ksat", "ksat_class"]
_MAPUNIT = ["mukey", "musym", "muname", "mukind", "muacres"]
_COMPONENT = ["cokey", "compname", "comppct_r", "majcompflag"]
_LEGEND = ["lkey", "areasymbol", "areaname", "saversion"]
_PEDON = ["pedon_key", "upedonid", "latitude_decimal_degrees", "longitude_decimal_degrees"]
_PEDON_SITE = _PEDON + ["samp_name", "corr_name", "site_key", "usiteid", "site_obsdate"]
COLUMN_SETS = {
    "mapunit_basic": _MAPUNIT,
    "mapunit_detailed": _MAPUNIT
    + ["mustatus", "muhelcl", "muwathelcl", "muwndhelcl", "interpfocus", "invesintens"],
    "mapunit_spatial": ["mukey", "musym", "muname", "geometry"],
    "component_basic": _COMPONENT,
    "component_detailed": _COMPONENT
    + [
        "compkind", "localphase", "drainagecl", "geomdesc", "taxclname", "taxorder", "taxsuborder",
        "taxgrtgroup", "taxsubgrp", "taxpartsize", "taxpartsizemod", "taxceactcl", "taxreaction",
        "taxtempcl", "taxmoistscl", "tempregime", "taxminalogy", "taxother",
    ],
    "chorizon_basic": _HORIZON,
    "chorizon_texture": _HORIZON + _TEXTURE,
    "chorizon_chemical": _HORIZON + _CHEMICAL,
    "chorizon_physical": _HORIZON + _PHYSICAL,
    "chorizon_detailed": _HORIZON + _TEXTURE + _CHEMICAL + _PHYSICAL,
    "legend_basic": _LEGEND,
    "legend_detailed": _LEGEND + ["mlraoffice", "projectscale", "cordate", "saverest"],
    "pedon_basic": _PEDON,
    "pedon_site": _PEDON_SITE,
    "pedon_detailed": _PEDON_SITE + ["descname", "taxonname", "taxclname", "pedlabsampnum", "pedoniid"],
    "lab_layer_basic": _LAYER,
    "lab_layer_texture": _LAYER + _LAYER_TEXTURE,
    "lab_layer_chemical": _LAYER + _LAYER_CHEMICAL,
    "lab_layer_physical": _LAYER + _LAYER_PHYSICAL,
    "lab_layer_calculations": _LAYER_CALCULATED,
    "lab_layer_rosetta": _LAYER_ROSETTA,
    "lab_layer_detailed": _LAYER + _LAYER_TEXTURE + _LAYER_CHEMICAL + _LAYER_PHYSICAL
    + _LAYER_CALCULATED + _LAYER_ROSETTA,
}

# --- bulk lookup presets: table, key column, columns (None = all + geometry) --
# The horizon presets list no "texture" column: the horizon table has none.
PRESETS = {
    "mapunit": ("mapunit", "mukey", ["mukey", "muname", "mustatus", "muacres", "mucomppct_r"]),
    "component": ("component", "mukey", ["cokey", "mukey", "compname", "comppct_r", "majcompflag"]),
    "component_detailed": (
        "component", "mukey",
        ["cokey", "mukey", "compname", "comppct_r", "majcompflag", "taxclname", "hydgrp"],
    ),
    "chorizon": ("chorizon", "cokey", ["chkey", "cokey", "hzname", "hzdept_r", "hzdepb_r"]),
    "chorizon_detailed": (
        "chorizon", "cokey",
        ["chkey", "cokey", "hzname", "hzdept_r", "hzdepb_r", "claytotal_r", "sandtotal_r",
         "silttotal_r", "om_r", "ph1to1h2o_r"],
    ),
    "mupolygon": ("mupolygon", "mukey", None),
    "sapolygon": ("sapolygon", "areasymbol", None),
    "cointerp": ("cointerp", "cokey", ["cokey", "cointerpiid", "interpname", "interphr"]),
    "chinterp": ("chinterp", "chkey", ["chkey", "chinterpiid", "interpname", "interphr"]),
}

# --- table schemas: column -> (kind, output field or None for extras, required)
# Kinds: key and text become "" when null; opt_* stay null; yes_flag is a bool.
SCHEMAS = {
    "mapunit": {
        "mukey": ("key", "map_unit_key", True),
        "muname": ("text", "map_unit_name", False),
        "musym": ("opt_text", "map_unit_symbol", False),
        "lkey": ("key", "survey_area_symbol", False),
        "areaname": ("text", "survey_area_name", False),
    },
    "component": {
        "cokey": ("key", "component_key", True),
        "compname": ("text", "component_name", False),
        "comppct_r": ("opt_double", "component_percentage", False),
        "majcompflag": ("yes_flag", "is_major_component", False),
        "taxclname": ("opt_text", "taxonomic_class", False),
        "drainagecl": ("opt_text", "drainage_class", False),
        "localphase": ("opt_text", "local_phase", False),
        "hydricrating": ("opt_text", "hydric_rating", False),
        "compkind": ("opt_text", "component_kind", False),
    },
    "chorizon": {
        "chkey": ("key", "horizon_key", True),
        "hzname": ("text", "horizon_name", False),
        "hzdept_r": ("opt_double", "top_depth", False),
        "hzdepb_r": ("opt_double", "bottom_depth", False),
        "claytotal_r": ("opt_double", None, False),
        "sandtotal_r": ("opt_double", None, False),
        "om_r": ("opt_double", None, False),
        "ph1to1h2o_r": ("opt_double", None, False),
    },
    "pedon": {
        "pedon_key": ("key", "pedon_key", True),
        "upedonid": ("key", "pedon_id", True),
        "corr_name": ("opt_text", "taxonname", False),
        "latitude_decimal_degrees": ("opt_double", "latitude", False),
        "longitude_decimal_degrees": ("opt_double", "longitude", False),
        "taxonname": ("opt_text", "taxclname", False),
    },
    "pedon_horizon": {
        "pedon_key": ("key", "pedon_key", True),
        "layer_key": ("key", "layer_key", True),
        "layer_sequence": ("opt_long", "layer_sequence", False),
        "hzn_desgn": ("text", "horizon_name", False),
        "hzn_top": ("opt_double", "top_depth", False),
        "hzn_bot": ("opt_double", "bottom_depth", False),
        "sand_total": ("opt_double", "sand_total", False),
        "silt_total": ("opt_double", "silt_total", False),
        "clay_total": ("opt_double", "clay_total", False),
        "texture_lab": ("opt_text", "texture_lab", False),
        "ph_h2o": ("opt_double", "ph_h2o", False),
        "total_carbon_ncs": ("opt_double", None, False),
        "organic_carbon_walkley_black": ("opt_double", None, False),
        "organic_carbon": ("opt_double", "organic_carbon", False),
        "caco3_lt_2_mm": ("opt_double", "calcium_carbonate", False),
        "bulk_density_third_bar": ("opt_double", "bulk_density_third_bar", False),
        "le_third_fifteen_lt2_mm": ("opt_double", "le_third_fifteen_lt2_mm", False),
        "water_retention_third_bar": ("opt_double", "water_content_third_bar", False),
        "water_retention_15_bar": ("opt_double", "water_content_fifteen_bar", False),
    },
    "mupolygon": {
        "mukey": ("key", "map_unit_key", True),
        "musym": ("opt_text", "map_unit_symbol", False),
        "areasymbol": ("key", "area_symbol", False),
        "spatialversion": ("opt_long", "spatial_version", False),
    },
    "horizon_property": {
        "property_name": ("text", "property_name", True),
        "rv": ("opt_double", "rv", False),
        "low": ("opt_double", "low", False),
        "high": ("opt_double", "high", False),
        "unit": ("text", "unit", False),
    },
}

# --- representative, low and high column and unit of the nested properties ----
HORIZON_PROPERTIES = [
    ("clay", "claytotal_r", "claytotal_l", "claytotal_h", "%"),
    ("sand", "sandtotal_r", "sandtotal_l", "sandtotal_h", "%"),
    ("organic_matter", "om_r", "om_l", "om_h", "%"),
    ("ph", "ph1to1h2o_r", "ph1to1h2o_l", "ph1to1h2o_h", "pH"),
]
CARBONATE_CARBON = 0.12  # share of carbon in calcium carbonate, by weight

# --- SQL type names -> conversion family --------------------------------------
SQL_TYPES = {
    "int": "int", "integer": "int", "bigint": "int", "smallint": "int", "tinyint": "int",
    "bit": "bool",
    "float": "float", "real": "float", "double": "float", "decimal": "float", "numeric": "float",
    "money": "float", "smallmoney": "float",
    "varchar": "string", "nvarchar": "string", "char": "string", "nchar": "string", "text": "string",
    "ntext": "string", "uniqueidentifier": "string", "xml": "string", "time": "string",
    "datetime": "datetime", "datetime2": "datetime", "smalldatetime": "datetime", "date": "datetime",
    "timestamp": "datetime",
    "geometry": "string", "geography": "string",
    "varbinary": "bytes", "binary": "bytes", "image": "bytes",
}
TRUE_WORDS = ["true", "1", "yes", "t", "y", "on"]
FALSE_WORDS = ["false", "0", "no", "f", "n", "off"]
NULL_WORDS = ["", "null", "none"]
DATETIME_FORMATS = [
    "yyyy-M-d H:m:s",
    "yyyy-M-d H:m:s.SSSSSS",
    "yyyy-M-d",
    "M/d/yyyy",
    "M/d/yyyy H:m:s",
    "yyyy/M/d",
    "d-M-yyyy",
    "d/M/yyyy",
    "yyyy-M-d'T'H:m:s",
    "yyyy-M-d'T'H:m:s'Z'",
    "yyyy-M-d'T'H:m:s.SSSSSS'Z'",
]
WKT_PREFIXES = [
    "POINT", "POLYGON", "MULTIPOLYGON", "LINESTRING", "GEOMETRYCOLLECTION", "MULTIPOINT", "MULTILINESTRING",
]

# --- fallback headers: result sets, and soil profiles -------------------------
RESULT_FALLBACKS = {
    "cokey": ["compkey", "component_key", "site_key", "siteid"],
    "chkey": ["horizon_key", "hzkey", "horizon_id", "hzid"],
    "hzdept_r": ["top_depth", "depth_top", "hz_top", "top"],
    "hzdepb_r": ["bottom_depth", "depth_bottom", "hz_bottom", "bottom"],
    "latitude": ["lat", "y", "northing"],
    "longitude": ["lon", "lng", "x", "easting"],
    "mukey": ["mapunit_key", "mu_key"],
    "musym": ["mapunit_symbol", "symbol"],
    "muname": ["mapunit_name", "name"],
}
PROFILE_FALLBACKS = {
    "cokey": ["compkey", "component_key", "site_key", "component_id"],
    "chkey": ["horizon_key", "hzkey", "horizon_id", "layer_id"],
    "hzdept_r": ["top_depth", "depth_top", "hz_top", "depth_from", "top_cm"],
    "hzdepb_r": ["bottom_depth", "depth_bottom", "hz_bottom", "depth_to", "bottom_cm"],
    "pedon_id": ["pedon_key", "site_id", "profile_id"],
    "hzname": ["horizon_name", "layer_name"],
}
# preset: site id, horizon id, top, bottom
PROFILE_PRESETS = {
    "standard": ("cokey", "chkey", "hzdept_r", "hzdepb_r"),
    "lab_pedon": ("pedon_id", "hzname", "hzdept_r", "hzdepb_r"),
    "pedon_site": ("pedon_id", "pedon_key_horizon", "hzdept_r", "hzdepb_r"),
    "mapunit_component": ("mukey", "cokey", "hzdept_r", "hzdepb_r"),
}
MAX_DEPTH = {"in": 240.0, "cm": 600.0}

# --- quality rules -----------------------------------------------------------------
REQUIRED_COLUMNS = {
    "mapunit": ["mukey", "musym", "muname"],
    "pedon": ["pedon_id", "site_id"],
}
OPTIONAL_COLUMNS = {"mapunit": [], "pedon": ["latitude", "longitude", "x", "y"]}
LATITUDE_NAMES = ["latitude", "lat"]
LONGITUDE_NAMES = ["longitude", "lon", "lng"]
DEPTH_NAMES = ["hzdept_r", "hzdepb_r"]

# --- laboratory tables ------------------------------------------------------------
LAB_LABSAMPNUM_TABLES = [
    "lab_physical_properties",
    "lab_chemical_properties",
    "lab_calculations_including_estimates_and_default_values",
    "lab_major_and_trace_elements_and_oxides",
    "lab_mir",
    "lab_mineralogy_glass_count",
    "lab_mineralogy_glass_count_and_optical_properties",
    "lab_xray_and_thermal",
    "lab_xrd_and_thermal",
]
LAB_LAYER_KEY_TABLES = ["lab_rosetta_key"]
LAB_PEDON_TABLES = ["lab_combine_nasis_ncss", "lab_pedon"]
LAB_PREP_TABLES = [
    "lab_physical_properties",
    "lab_chemical_properties",
    "lab_calculations_including_estimates_and_default_values",
    "lab_major_and_trace_elements_and_oxides",
    "lab_xray_and_thermal",
    "lab_xrd_and_thermal",
    "lab_mineralogy_glass_count",
    "lab_mineralogy_glass_count_and_optical_properties",
]
LAB_FRACTION_TABLES = [
    "lab_mineralogy_glass_count",
    "lab_mineralogy_glass_count_and_optical_properties",
    "lab_xray_and_thermal",
    "lab_xrd_and_thermal",
]
PREP_CODES = ["", "F", "GP", "HM", "HM_SK", "M", "N", "S"]
SIZE_FRACTIONS = [
    "", "<0.002 mm", "0.02-0.05 mm", "0.05-0.1 mm", "0.1-0.25 mm", "0.25-0.5 mm", "0.5-1 mm", "1-2 mm",
    "0.02-2 mm", "0.05-2 mm", "<2 mm",
]
LAYER_TYPES = ["horizon", "layer", "reporting layer"]

# --- survey metadata: output field -> path below the <metadata> root ---------------
METADATA_TEXT_FIELDS = {
    "title": "idinfo.citation.citeinfo.title",
    "publication_date": "idinfo.citation.citeinfo.pubdate",
    "publisher": "idinfo.citation.citeinfo.pubinfo.publish",
    "publish_place": "idinfo.citation.citeinfo.pubinfo.pubplace",
    "origin": "idinfo.citation.citeinfo.origin",
    "abstract": "idinfo.descript.abstract",
    "purpose": "idinfo.descript.purpose",
    "online_link": "idinfo.citation.citeinfo.onlink",
    "access_constraints": "idinfo.accconst",
    "use_constraints": "idinfo.useconst",
    "contact_organization": "idinfo.ptcontac.cntinfo.cntorgp.cntorg",
    "contact_person": "idinfo.ptcontac.cntinfo.cntorgp.cntper",
    "contact_position": "idinfo.ptcontac.cntinfo.cntpos",
    "contact_email": "idinfo.ptcontac.cntinfo.cntemail",
    "contact_phone": "idinfo.ptcontac.cntinfo.cntvoice",
    "attribute_accuracy": "dataqual.attracc.attraccr",
    "logical_consistency": "dataqual.logic",
    "completeness": "dataqual.complete",
    "horizontal_accuracy": "dataqual.posacc.horizpa.horizpar",
    "map_form": "idinfo.citation.citeinfo.geoform",
    "coordinate_system": "spref.horizsys.geograph.geogunit",
    "datum": "spref.horizsys.geodetic.horizdn",
    "ellipsoid": "spref.horizsys.geodetic.ellips",
}
METADATA_BOUNDS = {
    "west": "idinfo.spdom.bounding.westbc",
    "east": "idinfo.spdom.bounding.eastbc",
    "north": "idinfo.spdom.bounding.northbc",
    "south": "idinfo.spdom.bounding.southbc",
}

# --- station networks --------------------------------------------------------------
REFERENCE_LISTS = [
    "dcos", "durations", "elements", "forecastPeriods", "functions", "instruments", "networks",
    "physicalElements", "states", "units",
]
DURATIONS = ["HOURLY", "DAILY", "SEMIMONTHLY", "MONTHLY", "CALENDAR_YEAR", "WATER_YEAR", "SEASONAL"]
SECOND_NETWORK_VARIABLES = ["soiltemp", "soilVWC", "airtemp", "waterlevel"]
SECOND_NETWORK_CODES = {
    "soiltemp": "STO", "soilvwc": "SMS", "soilvmc": "SMS", "airtemp": "TOBS", "waterlevel": "WL",
}
EARTH_RADIUS_KM = 6371.0

# property, element code, unit
PROPERTIES = [
    ("soil_moisture", "SMS", "pct"),
    ("soil_temp", "STO", "degF"),
    ("precipitation", "PREC", "inch"),
    ("air_temp", "TOBS", "degF"),
    ("snow_water_equivalent", "WTEQ", "inch"),
    ("snow_depth", "SNWD", "inch"),
    ("wind_speed", "WSPD", "mph"),
    ("wind_direction", "WDIR", "degrees"),
    ("relative_humidity", "RHUM", "%"),
    ("solar_radiation", "SRAD", "watt/m2"),
    ("battery", "BATT", "volt"),
    ("dew_point_temp", "DPTP", "degF"),
    ("real_dielectric_constant", "RDC", "unitless"),
    ("salinity", "SAL", "gram/l"),
    ("snow_density", "SNDN", "kg/m3"),
    ("snow_temp", "STEMP", "degF"),
    ("barometric_pressure", "PRES", "kPa"),
    ("photosynthetic_radiation", "PARV", "watt/m2"),
    ("stream_stage", "SRMO", "ft"),
    ("stream_discharge", "SRDOX", "cfs"),
    ("evaporation", "EVAP", "inch"),
    ("fuel_moisture", "FUEL", "pct"),
    ("net_solar_radiation", "NTRDV", "watt/m2"),
    ("vapor_pressure", "SVPV", "kPa"),
    ("precipitation_increment", "PRCP", "inch"),
    ("vapor_pressure_partial", "PVPV", "kPa"),
    ("relative_humidity_enclosure", "RHENC", "pct"),
    ("precipitation_month_to_date", "PRCPMTD", "inch"),
    ("relative_humidity_min", "RHUMN", "pct"),
    ("relative_humidity_max", "RHUMX", "pct"),
    ("soil_moisture_min", "SMN", "pct"),
    ("soil_moisture_avg", "SMV", "pct"),
    ("soil_moisture_max", "SMX", "pct"),
    ("solar_radiation_total", "SRADT", "watt/m2"),
    ("solar_radiation_avg", "SRADV", "watt/m2"),
    ("soil_temp_min", "STN", "degF"),
    ("soil_temp_avg", "STV", "degF"),
    ("soil_temp_max", "STX", "degF"),
    ("air_temp_avg", "TAVG", "degF"),
    ("air_temp_max", "TMAX", "degF"),
    ("air_temp_min", "TMIN", "degF"),
    ("wind_direction_avg", "WDIRV", "degrees"),
    ("wind_speed_avg", "WSPDV", "mph"),
    ("wind_speed_max", "WSPDX", "mph"),
    ("precipitation_increment_snow_adjusted", "PRCPSA", "in"),
    ("snow_rain_ratio", "SNRR", "unitless"),
    ("snow_water_equivalent_maximum", "WTEQX", "in"),
]
HEIGHT_DEPTH_PROPERTIES = [
    "soil_moisture", "soil_temp", "air_temp", "wind_speed", "wind_direction", "relative_humidity",
    "solar_radiation",
]
ELEMENT_OF = {name: code for name, code, _ in PROPERTIES}
