import datetime as dt

import pytest
from pyspark.sql import functions as F

from loamframe.operators import stations
from loamframe.session import scratch_path
from loamframe.streaming import readings as streams

D = dt.datetime
SCHEMA = "station_triplet string, element_code string, ts timestamp_ntz, value double, updated_at timestamp_ntz"


def land(spark, folder, *batches):
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/f{number}")
    return f"{folder}/*"


def stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def row(day, value, updated=1, hour=0):
    return ("a", "E", D(2024, 1, day, hour), value, D(2024, 1, updated))


def test_upsert_equals_batch_and_survives_repeats(spark):
    root = scratch_path(spark, "upsert-test")
    first, second = [row(1, 1.0), row(2, 2.0)], [row(1, 5.0, updated=3), row(3, 3.0)]
    path = land(spark, f"{root}/in", first, second)
    streams.start_upsert(stream(spark, path), f"{root}/log", f"{root}/state").awaitTermination()
    current = streams.current_readings(spark, f"{root}/log")
    batch = stations.upsert_readings(spark.createDataFrame(first, SCHEMA), spark.createDataFrame(second, SCHEMA))
    pairs = lambda df: sorted((x["ts"], x["value"]) for x in df.collect())
    assert pairs(current) == pairs(batch) == [(D(2024, 1, 1), 5.0), (D(2024, 1, 2), 2.0), (D(2024, 1, 3), 3.0)]
    # A lost checkpoint repeats every batch into the same folders.
    streams.start_upsert(stream(spark, path), f"{root}/log", f"{root}/state2").awaitTermination()
    assert pairs(streams.current_readings(spark, f"{root}/log")) == pairs(batch)


def test_exact_repeats_are_dropped(spark):
    root = scratch_path(spark, "repeat-test")
    path = land(spark, f"{root}/in", [row(1, 1.0), row(1, 1.0)], [row(1, 1.0)])
    streams.start_upsert(stream(spark, path), f"{root}/log", f"{root}/state", delay="2 days").awaitTermination()
    assert spark.read.parquet(f"{root}/log").count() == 1


def test_period_means_match_batch_where_finished(spark):
    root = scratch_path(spark, "period-test")
    rows = [row(d, float(d + h), hour=h) for d in range(1, 9) for h in (1, 13)]
    path = land(spark, f"{root}/in", rows)
    streams.start_period_means(stream(spark, path), "DAILY", f"{root}/out", f"{root}/state", delay="1 day").awaitTermination()
    out = {x["period"]: (x["n"], x["average"]) for x in spark.read.parquet(f"{root}/out").collect()}
    batch = {x["period"]: (x["n"], x["average"]) for x in stations.aggregate_period(spark.createDataFrame(rows, SCHEMA), "DAILY").collect()}
    assert out == {k: v for k, v in batch.items() if k <= D(2024, 1, 6)}


def test_late_rows_are_dropped(spark):
    root = scratch_path(spark, "late-test")
    land(spark, f"{root}/in", [row(1, 1.0), row(9, 9.0)])
    feed = stream(spark, f"{root}/in/*")
    streams.start_period_means(feed, "DAILY", f"{root}/out", f"{root}/state", delay="1 day").awaitTermination()
    spark.createDataFrame([row(1, 100.0), row(12, 1.0)], SCHEMA).coalesce(1).write.parquet(f"{root}/in/f9")
    streams.start_period_means(stream(spark, f"{root}/in/*"), "DAILY", f"{root}/out", f"{root}/state", delay="1 day").awaitTermination()
    out = {x["period"]: x["average"] for x in spark.read.parquet(f"{root}/out").collect()}
    assert out == {D(2024, 1, 1): 1.0, D(2024, 1, 9): 9.0}


def test_batch_form_has_the_same_columns(spark):
    df = spark.createDataFrame([row(1, 1.0), row(1, None)], SCHEMA)
    found = streams.period_means(df, "HOURLY").first()
    assert (found["period"], found["n"], found["average"]) == (D(2024, 1, 1), 1, 1.0)
    with pytest.raises(KeyError):
        streams.period_means(df, "WATER_YEAR")


FEED = "feed_id long, body string"


def body(day, hour="05:00"):
    value = '{"date": "2024-01-%02d %s", "value": 1.0}' % (day, hour)
    return '[{"stationTriplet": "a", "data": [{"stationElement": {"elementCode": "TOBS", "heightDepth": 0, "ordinal": 1}, "values": [%s]}]}]' % value


def test_ingest_applies_the_station_offset_and_outlives_its_checkpoint(spark):
    root = scratch_path(spark, "ingest-test")
    for n in (1, 2, 3):
        spark.createDataFrame([(n, body(n))], FEED).coalesce(1).write.mode("append").json(f"{root}/in")
    places = spark.createDataFrame([("a", -8)], "station_triplet string, data_time_zone int")
    run = lambda state, files: streams.stream_ingest(
        spark, f"{root}/in", FEED, "body", ["feed_id"], f"{root}/rows", f"{root}/bad", f"{root}/{state}", "json", files, True, places
    ).awaitTermination()
    run("state", 1)
    once = streams.read_ingested(spark, f"{root}/rows").collect()
    assert sorted(r["ts_utc"] for r in once) == [D(2024, 1, d, 13) for d in (1, 2, 3)]
    run("state2", None)  # the checkpoint is lost and all files come in one batch
    assert streams.read_ingested(spark, f"{root}/rows").count() == 3
    spark.createDataFrame([(4, body(4)), (5, "oops")], FEED).coalesce(1).write.mode("append").json(f"{root}/in")
    run("state3", 2)  # lost again: only the new file is read
    assert streams.read_ingested(spark, f"{root}/rows").count() == 4
    assert streams.read_ingested(spark, f"{root}/bad", f"{root}/rows-ledger").count() == 1
    assert spark.read.parquet(f"{root}/rows-ledger").count() == 4


def test_rows_of_one_file_are_shared_by_all_tasks(spark):
    """a batch of one file was one task's work."""
    root = scratch_path(spark, "one-file")
    spark.createDataFrame([(n, body(1 + n % 28)) for n in range(400)] + [(999, "oops")], FEED).coalesce(1).write.json(f"{root}/in")
    run = lambda state: streams.stream_ingest(spark, f"{root}/in", FEED, "body", ["feed_id"], f"{root}/rows", f"{root}/bad", f"{root}/{state}").awaitTermination()
    run("state")
    rows = streams.read_ingested(spark, f"{root}/rows")
    written = spark.read.parquet(f"{root}/rows").select(F.input_file_name()).distinct().count()
    assert rows.count() == 400 and written > 4
    run("state2")  # a lost checkpoint: the file is recorded
    assert streams.read_ingested(spark, f"{root}/rows").count() == 400
    assert streams.read_ingested(spark, f"{root}/bad", f"{root}/rows-ledger").count() == 1


def test_ingestion_lost_half_way(spark, monkeypatch):
    root = scratch_path(spark, "half-test")
    for n in (1, 2, 3):
        spark.createDataFrame([(n, body(n))], FEED).coalesce(1).write.mode("append").json(f"{root}/in")
    run = lambda state, files: streams.stream_ingest(
        spark, f"{root}/in", FEED, "body", ["feed_id"], f"{root}/rows", f"{root}/bad", f"{root}/{state}", "json", files
    ).awaitTermination()
    written = streams.publish

    def fails_at(n):
        calls = iter(range(100))

        def publish(rows, path):
            if next(calls) == n:
                raise RuntimeError("lost")
            written(rows, path)

        monkeypatch.setattr(streams, "publish", publish)

    count = lambda: streams.read_ingested(spark, f"{root}/rows").count()
    fails_at(1)  # the second batch is written but not recorded
    with pytest.raises(Exception):
        run("state", 1)
    assert count() == 1
    monkeypatch.setattr(streams, "publish", written)
    run("state", 1)
    assert count() == 3
    fails_at(1)  # a new run, lost in its catch-up, hides nothing
    with pytest.raises(Exception):
        run("state2", 1)
    assert count() == 3
    monkeypatch.setattr(streams, "publish", written)
    run("state2", 1)
    assert count() == 3


def test_merged_log_equals_the_whole_log(spark):
    root = scratch_path(spark, "merge-test")
    path = land(spark, f"{root}/in", [row(1, 1.0), row(2, 2.0)], [row(1, 5.0, updated=3), row(3, 3.0)])
    streams.start_upsert(stream(spark, path), f"{root}/log", f"{root}/state").awaitTermination()
    pairs = lambda df: sorted((x["ts"], x["value"]) for x in df.collect())
    whole = pairs(streams.current_readings(spark, f"{root}/log"))
    assert streams.merged_upto(spark, f"{root}/done") == -1
    last = streams.merge_changes(spark, f"{root}/log", f"{root}/base", f"{root}/done")
    base = streams.read_merged(spark, f"{root}/base", f"{root}/done")
    assert pairs(base) == whole and streams.merged_upto(spark, f"{root}/done") == last
    assert streams.merge_changes(spark, f"{root}/log", f"{root}/base", f"{root}/done") == last
    later = spark.createDataFrame([row(2, 9.0, updated=5), row(8, 8.0)], SCHEMA)
    later.write.parquet(f"{root}/log/batch={last + 1}")
    expected = pairs(streams.current_readings(spark, f"{root}/log"))
    assert pairs(streams.current_readings(spark, f"{root}/log", base.drop("day"), last)) == expected
    streams.merge_changes(spark, f"{root}/log", f"{root}/base", f"{root}/done")
    assert pairs(streams.read_merged(spark, f"{root}/base", f"{root}/done")) == expected
    assert pairs(base) == whole  # a reader of the old version is not disturbed


def test_merge_lost_before_it_is_published(spark, monkeypatch):
    root = scratch_path(spark, "lost-merge")
    paths = [f"{root}/{n}" for n in ("log", "base", "done")]
    pairs = lambda df: sorted((x["ts"], x["value"]) for x in df.collect())
    spark.createDataFrame([row(1, 1.0), row(2, 2.0)], SCHEMA).write.parquet(f"{root}/log/batch=0")
    assert streams.read_merged(spark, *paths[1:]) is None
    assert streams.merge_changes(spark, *paths) == 0
    spark.createDataFrame([row(1, 5.0, updated=3), row(3, 3.0)], SCHEMA).write.parquet(f"{root}/log/batch=1")
    before = pairs(streams.read_merged(spark, *paths[1:]))
    written = streams.publish

    def lost(rows, path):
        raise RuntimeError("lost")

    monkeypatch.setattr(streams, "publish", lost)
    with pytest.raises(RuntimeError):
        streams.merge_changes(spark, *paths)
    assert pairs(streams.read_merged(spark, *paths[1:])) == before and streams.merged_upto(spark, paths[2]) == 0
    monkeypatch.setattr(streams, "publish", written)
    assert streams.merge_changes(spark, *paths) == 1
    assert pairs(streams.read_merged(spark, *paths[1:])) == [(D(2024, 1, 1), 5.0), (D(2024, 1, 2), 2.0), (D(2024, 1, 3), 3.0)]
