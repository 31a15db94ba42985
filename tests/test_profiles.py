import pytest
from pyspark.sql import functions as F

from loamframe.operators import lab, profiles, quality, selection
from loamframe.operators.aggregates import depth_statistics

HORIZONS = [(1, 101, 0.0, 10.0, 25.0), (2, 101, 10.0, 30.0, 30.0), (3, 102, 0.0, 20.0, 15.0), (4, 102, 20.0, 50.0, 20.0)]


@pytest.fixture
def horizon(spark):
    return spark.createDataFrame(HORIZONS, "chkey long, cokey long, hzdept_r double, hzdepb_r double, claytotal_r double")


@pytest.fixture
def component(spark):
    rows = [(101, 1, "CompA", "Yes", 60.0), (102, 1, "CompB", "Yes", 30.0), (103, 2, "CompC", "Yes", 90.0), (104, 2, "CompD", "No", 5.0)]
    return spark.createDataFrame(rows, "cokey long, mukey long, compname string, majcompflag string, comppct_r double")


def test_depth_lookups(spark, horizon, component):
    at = {(r["cokey"], r["depth"]): r["chkey"] for r in profiles.horizon_at_depth(horizon, [10, 30]).collect()}
    assert at == {(101, 10.0): 2, (102, 10.0): 3, (102, 30.0): 4}
    depth = {r["cokey"]: r["profile_depth"] for r in profiles.profile_depth(component, horizon).collect()}
    assert depth == {101: 30.0, 102: 50.0, 103: 0.0, 104: 0.0}
    mean = {r[0]: r[1] for r in profiles.depth_weighted_mean(horizon, "claytotal_r", 0, 30).collect()}
    assert mean[101] == pytest.approx(28.333333, abs=1e-6) and mean[102] == pytest.approx(16.666667, abs=1e-6)
    open_ended = horizon.withColumn("hzdepb_r", F.when(F.col("chkey") != 4, F.col("hzdepb_r")))
    mean = {r[0]: r[1] for r in profiles.depth_weighted_mean(open_ended, "claytotal_r", 0, 30).collect()}
    assert mean[102] == 15.0


@pytest.mark.parametrize(
    "rows, invalid, unreasonable",
    [
        ([("0", "10"), ("10", "30"), ("0", "20"), ("20", "50")], 0, 0),
        ([("30", "10"), ("10", "30")], 1, 0),
        ([("0", "10"), (None, "30")], 1, 0),
        ([("0", "10"), ("invalid", "30")], 1, 0),
        ([("-10", "0"), ("10", "30")], 1, 0),
        ([("10", "10")], 1, 0),
        ([("0", "300")], 0, 0),
        ([("0", "300"), ("5", "1")], 1, 1),
    ],
)
def test_depth_checks(spark, rows, invalid, unreasonable):
    df = spark.createDataFrame(rows, "hzdept_r string, hzdepb_r string")
    row = quality.validate_depths(df).first()
    assert (row["n_invalid"], row["n_unreasonable"], row["is_valid"]) == (invalid, unreasonable, invalid == 0)


def test_depth_statistics_counts_rows_with_both(spark):
    df = spark.createDataFrame([("0", "10"), (None, "30"), ("x", None)], "hzdept_r string, hzdepb_r string")
    row = depth_statistics(df).first()
    assert (row["total_horizons"], row["horizons_with_valid_depths"], row["top_depth_min"], row["bottom_depth_max"]) == (3, 1, 0.0, 30.0)


def test_nested_map_units(spark, horizon, component):
    units = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "mukey long, muname string")
    stray = horizon.withColumn("hzname", F.lit("A")).unionByName(spark.createDataFrame([(9, 999, 0.0, 1.0, 1.0, "Z")], "chkey long, cokey long, hzdept_r double, hzdepb_r double, claytotal_r double, hzname string"))
    rows = profiles.nest_mapunits(units, component, stray, ["compname"], ["claytotal_r"]).collect()
    found = sorted((r["mukey"], r["component_key"] or 0, r["horizon_key"] or 0) for r in rows)
    assert found == [(1, 101, 1), (1, 101, 2), (1, 102, 3), (1, 102, 4), (2, 103, 0), (2, 104, 0), (3, 0, 0)]
    assert {r["horizon_claytotal_r"] for r in rows if r["component_key"] == 101} == {25.0, 30.0}
    assert profiles.nest_mapunits(units, component).count() == 5 and profiles.nest_mapunits(units).count() == 3


def test_hot_component_keeps_its_grain(spark, component):
    n = 100_000
    layers = spark.range(n).select(
        F.col("id").alias("chkey"), F.when(F.col("id") % 3 == 0, 102).otherwise(101).alias("cokey"), F.lit("A").alias("hzname"),
        F.lit(0.0).alias("hzdept_r"), F.lit(1.0).alias("hzdepb_r"), F.lit(5.0).alias("claytotal_r"),
    )
    units = spark.createDataFrame([(1, "A")], "mukey long, muname string")
    nested = profiles.nest_mapunits(units, component, layers).groupBy("component_key").count().collect()
    hot = (n + 2) // 3
    assert {r["component_key"]: r["count"] for r in nested} == {101: n - hot, 102: hot}


def test_properties_only_where_known(spark, horizon):
    rows = profiles.horizon_properties_long(horizon.withColumn("om_r", F.lit(None).cast("double")), ["chkey"]).collect()
    assert {(r["chkey"], r["property_name"], r["rv"], r["low"], r["unit"]) for r in rows} == {(k, "clay", c, None, "%") for k, _, _, _, c in HORIZONS}


def test_organic_carbon(spark):
    cases = [(2.0, 1.5, 10.0, 0.8, 2.0), (1.0, None, 20.0, 0.0, 1.0), (None, 1.5, 10.0, 1.5, 1.5), (None, None, None, None, None)]
    df = spark.createDataFrame(cases, "t double, w double, c double, ours double, plain double")
    args = [F.col(c) for c in "twc"]
    for r in df.select("ours", "plain", profiles.organic_carbon(*args).alias("a"), profiles.organic_carbon(*args, False).alias("b")).collect():
        assert r["a"] == (None if r["ours"] is None else pytest.approx(r["ours"])) and r["b"] == r["plain"]


def test_presets_and_missing_columns(spark, horizon):
    other = horizon.withColumnsRenamed({"cokey": "compkey", "hzdept_r": "top_cm"})
    assert profiles.build_profiles(other).columns[:3] == ["chkey", "cokey", "hzdept_r"]
    with pytest.raises(ValueError, match="hzdepb_r"):
        profiles.build_profiles(horizon.drop("hzdepb_r"))


def test_key_lookups(spark, component):
    assert selection.fetch_by_keys(component, [101, "102", 101], "component").count() == 2
    assert selection.fetch_by_keys(component, 101, "component").count() == 1
    many = [str(k) for k in range(100, 2000)]
    assert selection.fetch_by_keys(component, many, "component").count() == 4
    keys = spark.createDataFrame([(1,), (1,), (7,)], "k long")
    assert selection.fetch_by_keys(component, keys, "component", "mukey").count() == 2
    with pytest.raises(ValueError):
        selection.fetch_by_keys(component, [], "component")
    with pytest.raises(ValueError):
        selection.fetch_by_keys(component, [1], "no such table")
    assert selection.filter_by_keys_multi(component, "component", []).count() == 0
    assert selection.filter_by_keys_multi(component, "component").count() == 4
    assert selection.filter_by_keys_multi(component, "component", [101, 103], [1]).count() == 1
    assert selection.filter_ci_in(component, "compname", ["COMPA", "compd"]).count() == 2


@pytest.fixture
def laboratory(spark):
    sites = spark.createDataFrame([("1", "85P0234", "A", 40.0, -100.0), ("2", "40A3306", "B", None, -100.0), ("3", "1", "C", 10.0, 0.0)],
                                  "pedon_key string, upedonid string, corr_name string, latitude_decimal_degrees double, longitude_decimal_degrees double")
    layers = spark.createDataFrame([("a", "1", "L1", 1, "horizon", 0.0, 10.0), ("b", "1", "L2", 2, "horizon", 10.0, 20.0), ("c", "2", "L3", 1, "layer", 0.0, 5.0)],
                                   "layer_key string, pedon_key string, labsampnum string, layer_sequence int, layer_type string, hzn_top double, hzn_bot double")
    physical = spark.createDataFrame([("L1", "S", 20.0), ("L1", "GP", 21.0), ("L3", None, 22.0)], "labsampnum string, prep_code string, clay_total double")
    return sites, layers, {"lab_physical_properties": physical}


def test_lab_codes(spark, laboratory):
    sites, layers, tables = laboratory
    keys = lambda df: sorted(r["layer_key"] for r in df.collect())
    assert keys(lab.lab_query(sites, layers, tables, where="true")) == ["a", "b", "c"]
    assert keys(lab.lab_query(sites, layers, tables, where="true", prep_codes=["S"])) == ["a"]
    assert keys(lab.lab_query(sites, layers, tables, keys=["85p0234"], what="upedonid")) == ["a", "b"]
    assert keys(lab.lab_query(sites, layers, tables)) == []
    with pytest.raises(ValueError):
        lab.lab_query(sites, layers, tables, keys=["1"], where="true")
    with pytest.raises(ValueError):
        lab.lab_query(sites, layers, tables, where="true", prep_codes=["??"])
    assert keys(lab.pedon_horizons(layers, tables, sites)) == ["a", "a", "b"]


def test_pedons(spark, laboratory):
    sites, layers, tables = laboratory
    ids = spark.createDataFrame([("1",), ("40A3306",), ("none",)], "id string")
    assert sorted((r["wanted"], r["pedon_key"]) for r in lab.pedon_by_id(sites, ids).collect()) == [("1", "1"), ("40A3306", "2")]
    assert lab.sites_in_bbox(sites, (-100, 40, -90, 50)).count() == 1
    assert set(lab.pedon_site_and_horizons(sites, layers, tables, (-101, 39, -99, 41), "combined")) == {"site", "horizons"}
    nested = {r["pedon_key"]: r["n"] for r in profiles.nest_pedons(sites, layers, ["labsampnum"]).groupBy("pedon_key").agg(F.count("layer_key").alias("n")).collect()}
    assert nested == {"1": 2, "2": 1, "3": 0}


def test_unknown_property_table(spark):
    layers = spark.createDataFrame([("1", "a")], "pedon_key string, labsampnum string")
    with pytest.raises(ValueError, match="lab_phisical"):
        lab.lab_layers(layers, {"lab_phisical": layers})
