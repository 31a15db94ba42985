import json

from loamframe.operators import quality
from loamframe.sources import payloads

HEAD = [["areasymbol", "mukey", "pct"], ["DataTypeName=varchar", "DataTypeName=int", "DataTypeName=float"]]


def frame(spark, bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "payload_id int, body string")


def body(*rows, head=HEAD):
    return json.dumps({"Table": head + list(rows)})


def test_flatten_status_and_integrity(spark):
    swapped = [["mukey", "areasymbol", "pct"], HEAD[1]]
    df = frame(spark, [
        body(["IA109", "1", "2.5"], ["IA110", 2, None]), body(), "{}", "not json", '{"Rows": []}',
        body(["IA111", "3"], ["IA112", "x", "1", "cut"]), body(["4", "IA113", ""], head=swapped), '{"Table": []}',
    ])
    status = {r[0]: r["status"] for r in payloads.payload_status(df, "body").collect()}
    assert status == {0: "ok", 1: "ok", 2: "empty", 3: "rejected", 4: "rejected", 5: "ok", 6: "ok", 7: "rejected"}
    types = payloads.payload_types(df, "body")
    assert types == {"areasymbol": "varchar", "mukey": "int", "pct": "float"}
    rows = {(r[0], r[1]): tuple(r)[2:] for r in payloads.flatten_payloads(df, "body", types, ["payload_id"]).collect()}
    assert rows == {
        (0, 0): ("IA109", 1, 2.5), (0, 1): ("IA110", 2, None), (5, 0): ("IA111", 3, None), (5, 1): ("IA112", None, 1.0), (6, 0): ("IA113", 4, None),
    }
    counts = {r[0]: tuple(r)[1:] for r in payloads.check_row_integrity(df, "body", ["payload_id"]).collect()}
    assert counts == {0: (2, 0, 0), 1: (0, 0, 0), 5: (2, 1, 1), 6: (1, 0, 0)}


def test_profile_of_payloads(spark):
    twice = [["a", "a"], ["DataTypeName=varchar", "DataTypeName=widget"]]
    df = frame(spark, [body(["x", "1", "2"]), body([None, "", "none"]), body(["1", "2"], head=twice)])
    found = {r[0]: r for r in quality.profile_payloads(df, "body", ["payload_id"]).collect()}
    assert found[0]["score"] == 1.0 and found[0]["errors"] == []
    assert found[1]["completeness"] == 0.0 and found[1]["errors"] == ["completeness too low"] and abs(found[1]["score"] - 0.8) < 1e-9
    assert found[2]["warnings"] == ["duplicate column names", "unknown type widget"] and abs(found[2]["score"] - 0.9) < 1e-9


def test_entity_and_range_checks(spark):
    df = spark.createDataFrame([(1, "", "Clay"), (2, "B", "null")], "mukey int, musym string, muname string")
    row = quality.validate_entity(df, "mapunit").first()
    assert sorted(row["warnings"]) == ["1 mapunit records have empty muname", "1 mapunit records have empty musym"]
    assert row["errors"] == ["completeness too low"] and abs(row["score"] - 0.7) < 1e-9
    pedon = quality.validate_entity(spark.createDataFrame([("p",)], "pedon_id string"), "pedon").first()
    assert pedon["errors"] == ["missing required pedon columns: site_id"] and len(pedon["warnings"]) == 1
    bad = spark.createDataFrame([(95.0, -200.0, -1.0), (45.0, 10.0, 5.0)], "lat double, lon double, hzdept_r double")
    found = quality.validate_ranges(bad, {"lat": "float", "lon": "float", "hzdept_r": "float"}).first()
    assert (found["type_violations"], found["range_violations"], found["errors"]) == (0, 3, ["violation rate too high"])
    empty = quality.profile_quality(bad.where("false")).first()
    assert empty["n_rows"] == 0 and empty["warnings"] == ["no data rows"]


def test_merge(spark):
    reports = spark.createDataFrame([(1, 1.0, [], ["w"]), (1, 0.5, ["e"], ["w"])], "g int, score double, errors array<string>, warnings array<string>")
    summary, messages = quality.merge_quality(reports, ["g"])
    assert summary.first()["mean_score"] == 0.75
    assert sorted(map(tuple, messages.collect())) == [(1, "error", "e", 1), (1, "warning", "w", 2)]
