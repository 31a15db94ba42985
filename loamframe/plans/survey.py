"""Queries over the survey hierarchy, laboratory tables and soil profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamframe.operators import aggregates as agg
from loamframe.operators import joins, lab, profiles, selection
from loamframe.plans.registry import query, r6, rounded

AREAS = ["NATION_1", "NATION_7", "NATION_12", "NATION_20"]
_AREAS = "('NATION_1', 'NATION_7', 'NATION_12', 'NATION_20')"
_MISSING = "('', 'null', 'none')"


# --- B: projection and filters -------------------------------------------------
@query(
    "B1_select_set", "chorizon",
    "SELECT chkey, hzname, hzdept_r, hzdepb_r, sandtotal_r, silttotal_r, claytotal_r, cokey FROM chorizon",
)
def _(t):
    return selection.select_set(t.chorizon, "chorizon_texture", ["cokey"])


@query(
    "B2_project_schema", "component",
    f"""SELECT CAST(cokey AS VARCHAR) AS component_key, compname AS component_name, comppct_r AS component_percentage,
    majcompflag = 'Yes' AS is_major_component, CASE WHEN lower(taxclname) NOT IN {_MISSING} THEN taxclname END AS taxonomic_class,
    drainagecl AS drainage_class, CAST(mukey AS VARCHAR) AS extra_mukey FROM component""",
)
def _(t):
    wanted = ["cokey", "compname", "comppct_r", "majcompflag", "taxclname", "drainagecl", "localphase", "mukey"]
    return (
        selection.project_schema(t.component, "component", wanted)
        .withColumn("extra_mukey", F.col("extra_fields")["mukey"])
        .drop("extra_fields")
    )


@query(
    "B3_where_all", "component",
    """SELECT cokey, mukey, compname, comppct_r FROM component WHERE majcompflag = 'Yes' AND comppct_r BETWEEN 100000 AND 300000
    AND compname LIKE '%I%' AND drainagecl IN ('F', 'O')""",
)
def _(t):
    return selection.where_all(
        t.component, F.col("majcompflag") == "Yes", F.col("comppct_r").between(100000, 300000),
        F.col("compname").like("%I%"), F.col("drainagecl").isin("F", "O"),
    ).select("cokey", "mukey", "compname", "comppct_r")


@query(
    "B4_fetch_by_keys", "mupolygon muaggatt",
    """SELECT mukey, areasymbol, mupolygongeo AS geometry FROM mupolygon WHERE mukey IN (SELECT mukey FROM muaggatt)""",
)
def _(t):
    return selection.fetch_by_keys(t.mupolygon, t.muaggatt.select("mukey"), "mupolygon", columns=["mukey", "areasymbol"], include_geometry=True)


@query(
    "B5_fetch_preset", "chorizon component",
    """SELECT chkey, cokey, hzname, hzdept_r, hzdepb_r, claytotal_r, sandtotal_r, silttotal_r, om_r, ph1to1h2o_r FROM chorizon
    WHERE cokey IN (SELECT cokey FROM component WHERE majcompflag = 'Yes')""",
)
def _(t):
    major = selection.filter_major_components(t.component).select("cokey")
    return selection.fetch_preset(t.chorizon, major, "chorizon_detailed")


@query(
    "B6_filter_by_keys_multi", "component mapunit",
    """SELECT cokey, mukey, compname FROM component WHERE mukey IN (SELECT mukey FROM mapunit WHERE mukind = 'Complex')
    AND compname IN ('1-URGENT', '2-HIGH')""",
)
def _(t):
    units = t.mapunit.where(F.col("mukind") == "Complex").select("mukey")
    return selection.filter_by_keys_multi(t.component, "component", None, units, ["1-URGENT", "2-HIGH"]).select("cokey", "mukey", "compname")


@query(
    "B7_filter_ci_in", "lab_sites lab_layer",
    "SELECT pedon_key, upedonid FROM lab_sites WHERE lower(upedonid) IN (SELECT lower(concat('85p', pedon_key)) FROM lab_layer)",
)
def _(t):
    ids = t.lab_layer.select(F.concat(F.lit("85p"), "pedon_key").alias("id"))
    return selection.filter_ci_in(t.lab_sites, "upedonid", ids).select("pedon_key", "upedonid")


@query(
    "B8_filter_bbox_points", "lab_sites",
    """SELECT pedon_key, upedonid FROM lab_sites WHERE latitude_decimal_degrees BETWEEN 30 AND 40
    AND longitude_decimal_degrees BETWEEN -120.5 AND -90""",
)
def _(t):
    return lab.sites_in_bbox(t.lab_sites, (-120.5, 30, -90, 40)).select("pedon_key", "upedonid")


@query("B12_filter_major_components", "component", "SELECT cokey, mukey FROM component WHERE majcompflag = 'Yes'")
def _(t):
    return selection.filter_major_components(t.component).select("cokey", "mukey")


@query(
    "B11_filter_lab_codes", "lab_layer lab_chemical_properties lab_mineralogy_glass_count",
    """SELECT l.layer_key, c.ph_h2o, g.glass_count FROM lab_layer l LEFT JOIN lab_chemical_properties c ON l.labsampnum = c.labsampnum
    LEFT JOIN lab_mineralogy_glass_count g ON l.labsampnum = g.labsampnum
    WHERE l.layer_type IN ('horizon', 'layer') AND coalesce(c.prep_code, '') IN ('S', '') AND coalesce(g.prep_code, '') IN ('S', '')
    AND coalesce(g.analyzed_size_frac, '') IN ('<2 mm', '')""",
)
def _(t):
    tables = {"lab_chemical_properties": t.lab_chemical_properties, "lab_mineralogy_glass_count": t.lab_mineralogy_glass_count}
    rows = lab.filter_lab_codes(lab.lab_layers(t.lab_layer, tables), list(tables), layer_types=["horizon", "layer"])
    return rows.select(
        "layer_key", F.col("`lab_chemical_properties.ph_h2o`").alias("ph_h2o"), F.col("`lab_mineralogy_glass_count.glass_count`").alias("glass_count")
    )


@query(
    "B16_harmonize_columns", "mapunit muaggatt lab_sites",
    """SELECT CAST(mukey AS VARCHAR) AS mukey, muname, CAST(NULL AS DOUBLE) AS latitude FROM mapunit UNION ALL
    SELECT CAST(mukey AS VARCHAR), flodfreqdcd, NULL FROM muaggatt UNION ALL
    SELECT pedon_key, samp_name, latitude_decimal_degrees FROM lab_sites""",
)
def _(t):
    first = t.mapunit.select(F.col("mukey").cast("string").alias("MUKEY"), "muname")
    second = t.muaggatt.select(F.col("mukey").cast("string").alias("mu_key"), F.col("flodfreqdcd").alias("mapunit_name"))
    third = t.lab_sites.select(F.col("pedon_key").alias("mapunit_key"), F.col("samp_name").alias("name"), F.col("latitude_decimal_degrees").alias("lat"))
    return selection.harmonize_columns([first, second, third], ["mukey", "muname", "latitude"])


@query(
    "B17_fill_missing", "component",
    """SELECT cokey, coalesce(drainagecl, 'unknown') AS drainagecl, CASE WHEN majcompflag IS NULL THEN 1 ELSE 0 END + 1 AS n_missing
    FROM component""",
)
def _(t):
    filled = selection.fill_missing(t.component, ["drainagecl", "majcompflag", "hydricrating"], {"drainagecl": "unknown"})
    return filled.select("cokey", "drainagecl", F.size("missing_fields").alias("n_missing"))


# --- C: joins ------------------------------------------------------------------
@query(
    "C1_join_tables", "mapunit muaggatt",
    """SELECT m.mukey, a.mukey AS other_key, m.muname, a.flodfreqdcd FROM mapunit m FULL JOIN muaggatt a
    ON m.mukey = a.mukey AND a.wtdepannmin < m.muacres""",
)
def _(t):
    m, a = t.mapunit.alias("m"), t.muaggatt.alias("a")
    on = (F.col("m.mukey") == F.col("a.mukey")) & (F.col("a.wtdepannmin") < F.col("m.muacres"))
    return joins.join_tables(m, a, on, "full").select("m.mukey", F.col("a.mukey").alias("other_key"), "m.muname", "a.flodfreqdcd")


@query(
    "C2_mapunits_by_area", "mapunit legend",
    f"""SELECT mukey, musym, muname, mukind, muacres, areasymbol, areaname FROM mapunit JOIN legend USING (lkey) WHERE areasymbol IN {_AREAS}""",
)
def _(t):
    return joins.mapunits_by_area(t.mapunit, t.legend, AREAS)


@query(
    "C3_components_by_area", "component mapunit legend",
    """SELECT cokey, compname, comppct_r, majcompflag, mukey, musym, muname, areasymbol FROM component JOIN mapunit USING (mukey)
    JOIN legend USING (lkey)""",
)
def _(t):
    return joins.components_by_area(t.component, t.mapunit, t.legend)


_FLAGSHIP = """SELECT m.mukey, m.musym, m.muname, c.cokey, c.compname, c.comppct_r, h.chkey, h.hzname, h.hzdept_r, h.hzdepb_r,
    h.sandtotal_r, h.silttotal_r, h.claytotal_r FROM chorizon h JOIN component c ON h.cokey = c.cokey JOIN mapunit m ON c.mukey = m.mukey
    JOIN legend l ON m.lkey = l.lkey WHERE c.majcompflag = 'Yes'"""


@query("C4_component_horizons_by_area", "chorizon component mapunit legend", _FLAGSHIP)
def component_horizons(t):
    return joins.component_horizons_by_area(t.chorizon, t.component, t.mapunit, t.legend)


@query(
    "C5_water_properties", "chorizon component mapunit legend",
    f"""SELECT mukey, muname, areasymbol, cokey, compname, comppct_r, chkey, hzname, hzdept_r, hzdepb_r, claytotal_r, silttotal_r,
    sandtotal_r, awc_r, ksat_r, om_r FROM chorizon JOIN component USING (cokey) JOIN mapunit USING (mukey) JOIN legend USING (lkey)
    WHERE areasymbol IN {_AREAS}""",
)
def _(t):
    return joins.water_properties(t.chorizon, t.component, t.mapunit, t.legend, AREAS)


@query(
    "C6_water_table_by_mapunit", "mapunit muaggatt legend",
    """SELECT mukey, muname, areasymbol, wtdepannmin, wtdepannmax, flodfreqdcd FROM mapunit JOIN legend USING (lkey) LEFT JOIN muaggatt USING (mukey)""",
)
def _(t):
    return joins.water_table_by_mapunit(t.mapunit, t.muaggatt, t.legend)


@query(
    "C7_water_table_by_month", "component comonth mapunit legend",
    f"""SELECT mukey, muname, areasymbol, cokey, compname, comppct_r, month, wtdepannmin, wtdepannmax, flodfreqcl FROM component
    JOIN mapunit USING (mukey) JOIN legend USING (lkey) LEFT JOIN comonth USING (cokey) WHERE areasymbol IN {_AREAS}""",
)
def _(t):
    return joins.water_table_by_month(t.component, t.comonth, t.mapunit, t.legend, AREAS)


@query(
    "C8_lab_layers", "lab_layer lab_physical_properties lab_rosetta_key",
    """SELECT l.pedon_key, l.layer_key, p.prep_code, p.clay_total, r.theta_r FROM lab_layer l
    LEFT JOIN lab_physical_properties p ON l.labsampnum = p.labsampnum LEFT JOIN lab_rosetta_key r ON l.layer_key = r.layer_key""",
)
def _(t):
    tables = {"lab_physical_properties": t.lab_physical_properties, "lab_rosetta_key": t.lab_rosetta_key}
    return lab.lab_layers(t.lab_layer, tables).select(
        "pedon_key", "layer_key", F.col("`lab_physical_properties.prep_code`").alias("prep_code"),
        F.col("`lab_physical_properties.clay_total`").alias("clay_total"), F.col("`lab_rosetta_key.theta_r`").alias("theta_r"),
    )


@query(
    "C9_pedon_with_related", "lab_sites lab_layer",
    "SELECT s.pedon_key, s.upedonid, l.layer_key, l.hzn_desgn FROM lab_sites s LEFT JOIN lab_layer l ON s.pedon_key = l.pedon_key",
)
def _(t):
    return lab.pedon_with_related(t.lab_sites, {"lab_layer": t.lab_layer}).select(
        "pedon_key", "upedonid", F.col("`lab_layer.layer_key`").alias("layer_key"), F.col("`lab_layer.hzn_desgn`").alias("hzn_desgn")
    )


@query(
    "C10_lab_query", "lab_sites lab_layer lab_chemical_properties",
    """SELECT l.pedon_key, l.layer_key, c.ph_h2o FROM lab_layer l LEFT JOIN lab_chemical_properties c ON l.labsampnum = c.labsampnum
    WHERE l.pedon_key IN (SELECT pedon_key FROM lab_sites WHERE corr_name IN ('FURNITURE', 'MACHINERY') AND latitude_decimal_degrees > 35)
    AND l.layer_type = 'horizon' AND coalesce(c.prep_code, '') IN ('S', '')""",
)
def _(t):
    where = F.col("corr_name").isin("FURNITURE", "MACHINERY") & (F.col("latitude_decimal_degrees") > 35)
    rows = lab.lab_query(
        t.lab_sites, t.lab_layer, {"lab_chemical_properties": t.lab_chemical_properties}, where=where, layer_types=["horizon"]
    )
    return rows.select("pedon_key", "layer_key", F.col("`lab_chemical_properties.ph_h2o`").alias("ph_h2o"))


@query(
    "C11_cokeys_by_mukey", "component mapunit legend",
    f"""SELECT cokey, mukey FROM component WHERE majcompflag = 'Yes' AND mukey IN
    (SELECT mukey FROM mapunit JOIN legend USING (lkey) WHERE areasymbol IN {_AREAS})""",
)
def _(t):
    return joins.cokeys_by_mukey(t.component, joins.mukeys_by_area(t.mapunit, t.legend, AREAS))


@query(
    "C12_pedon_horizons", "lab_layer lab_physical_properties",
    """SELECT l.pedon_key, l.layer_key, l.layer_sequence, l.hzn_top, l.hzn_bot, p.clay_total FROM lab_layer l
    LEFT JOIN lab_physical_properties p ON l.labsampnum = p.labsampnum WHERE l.layer_type = 'horizon'""",
)
def _(t):
    return lab.pedon_horizons(t.lab_layer, {"lab_physical_properties": t.lab_physical_properties}).select(
        "pedon_key", "layer_key", "layer_sequence", "hzn_top", "hzn_bot", F.col("`lab_physical_properties.clay_total`").alias("clay_total")
    )


@query(
    "C13_pedon_site_and_horizons", "lab_sites lab_layer lab_chemical_properties",
    """SELECT l.pedon_key, s.upedonid, l.layer_key, l.hzn_top, l.hzn_bot, c.ph_h2o, NOT (l.hzn_top >= 0 AND l.hzn_top < l.hzn_bot) AS depth_invalid
    FROM lab_layer l JOIN lab_sites s ON l.pedon_key = s.pedon_key LEFT JOIN lab_chemical_properties c ON l.labsampnum = c.labsampnum
    WHERE l.layer_type = 'horizon' AND s.latitude_decimal_degrees BETWEEN 28 AND 44 AND s.longitude_decimal_degrees BETWEEN -120 AND -80""",
)
def _(t):
    rows = lab.pedon_site_and_horizons(
        t.lab_sites, t.lab_layer, {"lab_chemical_properties": t.lab_chemical_properties}, (-120, 28, -80, 44), "profile"
    )
    return rows.select(
        "pedon_key", "upedonid", "layer_key", "hzn_top", "hzn_bot", F.col("`lab_chemical_properties.ph_h2o`").alias("ph_h2o"), "depth_invalid"
    )


@query(
    "C14_pedon_by_id", "lab_sites lab_layer",
    """WITH ids AS (SELECT DISTINCT CASE WHEN layer_sequence < 3 THEN pedon_key ELSE concat('85P', pedon_key) END AS wanted FROM lab_layer)
    SELECT wanted, pedon_key, upedonid FROM ids JOIN lab_sites ON wanted = pedon_key UNION ALL
    SELECT wanted, pedon_key, upedonid FROM ids JOIN lab_sites ON wanted = upedonid WHERE wanted NOT IN (SELECT pedon_key FROM lab_sites)""",
)
def _(t):
    ids = t.lab_layer.select(F.when(F.col("layer_sequence") < 3, F.col("pedon_key")).otherwise(F.concat(F.lit("85P"), "pedon_key")).alias("id"))
    return lab.pedon_by_id(t.lab_sites, ids).select("wanted", "pedon_key", "upedonid")


# --- D: aggregation over the survey ----------------------------------------------
@query(
    "D1_count_by", "component mapunit legend",
    "SELECT areasymbol, majcompflag, count(*) AS n FROM component JOIN mapunit USING (mukey) JOIN legend USING (lkey) GROUP BY ALL",
)
def _(t):
    return agg.count_by(joins.components_by_area(t.component, t.mapunit, t.legend), ["areasymbol", "majcompflag"])


@query("D3_top_k_units", "mupolygon", "SELECT musym, count(*) AS n FROM mupolygon GROUP BY musym ORDER BY n DESC, musym LIMIT 3")
def _(t):
    return agg.top_k_units(t.mupolygon, 3)


_WATER_JOIN = "chorizon JOIN component USING (cokey) JOIN mapunit USING (mukey) JOIN legend USING (lkey)"


@query(
    "D4_soil_summary", "chorizon component mapunit legend",
    f"""SELECT areasymbol, count(*) AS n_horizons, count(DISTINCT cokey) AS n_components, round(avg(awc_r), 6) AS avg_awc,
    round(avg(ksat_r), 6) AS avg_ksat, round(avg(om_r), 6) AS avg_organic_matter, round(avg(claytotal_r), 6) AS avg_clay_pct,
    round(avg(silttotal_r), 6) AS avg_silt_pct, round(avg(sandtotal_r), 6) AS avg_sand_pct, round(min(hzdept_r) / 12, 6) AS shallow_ft,
    round(max(hzdepb_r) / 12, 6) AS deep_ft FROM {_WATER_JOIN} GROUP BY areasymbol""",
)
def _(t):
    water = joins.water_properties(t.chorizon, t.component, t.mapunit, t.legend)
    out = agg.soil_summary(water, ["areasymbol"])
    return rounded(out, *[c for c in out.columns if c not in ("areasymbol", "n_horizons", "n_components")])


@query(
    "D5_water_table_summary", "mapunit muaggatt legend",
    """SELECT areasymbol, round(avg(wtdepannmin) / 12, 6) AS min_depth_ft, round(avg(wtdepannmax) / 12, 6) AS max_depth_ft
    FROM mapunit JOIN legend USING (lkey) LEFT JOIN muaggatt USING (mukey) GROUP BY areasymbol""",
)
def _(t):
    rows = joins.water_table_by_mapunit(t.mapunit, t.muaggatt, t.legend)
    return rounded(agg.water_table_summary(rows, ["areasymbol"]), "min_depth_ft", "max_depth_ft")


@query(
    "D6_depth_statistics", "depth_texts",
    """WITH d AS (SELECT TRY_CAST(hzdept_r AS DOUBLE) AS t, TRY_CAST(hzdepb_r AS DOUBLE) AS b FROM depth_texts)
    SELECT count(*) AS total_horizons, count(*) FILTER (t IS NOT NULL AND b IS NOT NULL) AS horizons_with_valid_depths,
    min(t) AS top_depth_min, max(t) AS top_depth_max, round(avg(t), 6) AS top_depth_mean, min(b) AS bottom_depth_min,
    max(b) AS bottom_depth_max, round(avg(b), 6) AS bottom_depth_mean FROM d""",
)
def _(t):
    return rounded(agg.depth_statistics(t.depth_texts), "top_depth_mean", "bottom_depth_mean")


@query("D7_area_totals", "mapunit legend", "SELECT areasymbol, round(sum(muacres), 4) AS total_acres FROM mapunit JOIN legend USING (lkey) GROUP BY areasymbol")
def _(t):
    return rounded(agg.area_totals(joins.mapunits_by_area(t.mapunit, t.legend), ["areasymbol"]), "total_acres", places=4)


@query(
    "D17_texture_moments", "chorizon component",
    """SELECT compname, round(avg(claytotal_r), 6) AS clay_mean, round(stddev_samp(claytotal_r), 6) AS clay_std,
    round(avg(sandtotal_r), 6) AS sand_mean, round(avg(om_r), 6) AS om_mean FROM chorizon JOIN component USING (cokey) GROUP BY compname""",
)
def _(t):
    rows = t.chorizon.join(t.component.select("cokey", "compname"), "cokey")
    return rounded(agg.texture_moments(rows, ["compname"]), "clay_mean", "clay_std", "sand_mean", "om_mean")


# --- F: profiles -------------------------------------------------------------------
@query(
    "F1_nest_mapunits", "mapunit component chorizon",
    """WITH h AS (SELECT cokey, count(*) AS n, sum(1 + CASE WHEN claytotal_r IS NULL THEN 0 ELSE 1 END + CASE WHEN om_r IS NULL THEN 0 ELSE 1 END + 1) AS p,
      max(hzdepb_r) AS deepest FROM chorizon GROUP BY cokey)
    SELECT m.mukey, m.muname, c.cokey AS component_key, c.compname AS component_name, CAST(coalesce(h.n, 0) AS BIGINT) AS n_horizons,
    CAST(coalesce(h.p, 0) AS BIGINT) AS n_properties, h.deepest
    FROM mapunit m LEFT JOIN component c ON m.mukey = c.mukey LEFT JOIN h ON c.cokey = h.cokey""",
)
def _(t):
    nested = profiles.nest_mapunits(t.mapunit.select("mukey", "muname"), t.component, t.chorizon)
    return nested.groupBy("mukey", "muname", "component_key", "component_name").agg(
        F.count("horizon_key").alias("n_horizons"),
        F.coalesce(F.sum(F.size("properties")), F.lit(0)).alias("n_properties"),
        F.max("bottom_depth").alias("deepest"),
    )


@query(
    "F2_horizon_properties", "chorizon",
    """SELECT chkey, 'clay' AS property_name, claytotal_l AS low, claytotal_r AS rv, claytotal_h AS high, '%' AS unit FROM chorizon WHERE claytotal_r IS NOT NULL
    UNION ALL SELECT chkey, 'sand', NULL, sandtotal_r, NULL, '%' FROM chorizon WHERE sandtotal_r IS NOT NULL
    UNION ALL SELECT chkey, 'organic_matter', NULL, om_r, NULL, '%' FROM chorizon WHERE om_r IS NOT NULL
    UNION ALL SELECT chkey, 'ph', NULL, ph1to1h2o_r, NULL, 'pH' FROM chorizon WHERE ph1to1h2o_r IS NOT NULL""",
)
def _(t):
    return profiles.horizon_properties_long(t.chorizon, ["chkey"])


@query(
    "F3_nest_pedons", "lab_sites lab_layer",
    """SELECT s.pedon_key, s.upedonid, l.layer_key, l.hzn_top AS top_depth, l.hzn_bot AS bottom_depth, CAST(l.total_carbon_ncs AS DOUBLE) AS total_carbon
    FROM lab_sites s LEFT JOIN lab_layer l ON s.pedon_key = l.pedon_key""",
)
def _(t):
    nested = profiles.nest_pedons(t.lab_sites, t.lab_layer, extra=["total_carbon_ncs"])
    return nested.select(
        "pedon_key", "upedonid", "layer_key", "top_depth", "bottom_depth", F.get("extra_fields", F.lit(0))["value"].cast("double").alias("total_carbon")
    )


@query(
    "F4_organic_carbon", "lab_layer",
    """SELECT layer_key, round(CASE WHEN total_carbon_ncs IS NOT NULL THEN CASE WHEN caco3_lt_2_mm > 0 THEN greatest(0, total_carbon_ncs - caco3_lt_2_mm * 0.12)
    ELSE total_carbon_ncs END ELSE organic_carbon_walkley_black END, 6) AS organic_carbon,
    coalesce(total_carbon_ncs, organic_carbon_walkley_black) AS without_carbonate FROM lab_layer""",
)
def _(t):
    columns = [F.col(c) for c in ("total_carbon_ncs", "organic_carbon_walkley_black", "caco3_lt_2_mm")]
    return t.lab_layer.select(
        "layer_key", r6(profiles.organic_carbon(*columns)).alias("organic_carbon"), profiles.organic_carbon(*columns, False).alias("without_carbonate")
    )


@query(
    "F5_horizon_at_depth", "chorizon",
    """WITH d AS (SELECT * FROM (VALUES (0.0), (12.5), (30.0), (65.0)) v(depth)),
    hit AS (SELECT h.cokey, CAST(d.depth AS DOUBLE) AS depth, h.chkey, h.hzname, h.claytotal_r,
      row_number() OVER (PARTITION BY h.cokey, d.depth ORDER BY h.hzdept_r, h.chkey) AS rn
      FROM chorizon h JOIN d ON h.hzdept_r <= d.depth AND d.depth < h.hzdepb_r)
    SELECT cokey, depth, chkey, hzname, claytotal_r FROM hit WHERE rn = 1""",
)
def _(t):
    return profiles.horizon_at_depth(t.chorizon, [0, 12.5, 30, 65]).select("cokey", "depth", "chkey", "hzname", "claytotal_r")


@query(
    "F6_profile_depth", "component chorizon",
    "SELECT c.cokey, coalesce(max(h.hzdepb_r), 0) AS profile_depth FROM component c LEFT JOIN chorizon h ON c.cokey = h.cokey GROUP BY c.cokey",
)
def _(t):
    return profiles.profile_depth(t.component.select("cokey"), t.chorizon)


@query(
    "F7_build_profiles", "chorizon component",
    """SELECT h.chkey, h.cokey, h.hzdept_r, h.hzdepb_r, c.compname, false AS depth_invalid, h.hzdepb_r > 240 AS depth_unreasonable
    FROM chorizon h LEFT JOIN component c ON h.cokey = c.cokey""",
)
def _(t):
    horizon = t.chorizon.select(F.col("chkey").alias("horizon_id"), F.col("cokey").alias("compkey"), F.col("hzdept_r").alias("depth_top"), "hzdepb_r")
    return profiles.build_profiles(horizon, t.component.select("cokey", "compname")).select(
        "chkey", "cokey", "hzdept_r", "hzdepb_r", "compname", "depth_invalid", "depth_unreasonable"
    )


@query(
    "F8_depth_weighted_mean", "chorizon",
    """WITH o AS (SELECT cokey, om_r, greatest(0, least(hzdepb_r, 45) - greatest(hzdept_r, 5)) AS w FROM chorizon)
    SELECT cokey, round(sum(om_r * w) / nullif(sum(w) FILTER (om_r IS NOT NULL), 0), 6) AS om_r_mean FROM o GROUP BY cokey""",
)
def _(t):
    return rounded(profiles.depth_weighted_mean(t.chorizon, "om_r", 5, 45), "om_r_mean")


@query(
    "F9_top_clay_horizons", "chorizon component mapunit legend",
    """SELECT mukey, muname, compname, hzname, claytotal_r, chkey FROM chorizon JOIN component USING (cokey) JOIN mapunit USING (mukey)
    JOIN legend USING (lkey) WHERE claytotal_r > 40 AND majcompflag = 'Yes' ORDER BY claytotal_r DESC, chkey LIMIT 50""",
)
def _(t):
    return joins.top_clay_horizons(t.chorizon, t.component, t.mapunit, t.legend)


@query("H1_order_limit", "component", "SELECT cokey, compname, comppct_r FROM component ORDER BY comppct_r DESC, compname, cokey LIMIT 100")
def _(t):
    return joins.order_limit(t.component.select("cokey", "compname", "comppct_r"), [F.desc("comppct_r"), "compname", "cokey"], 100)
