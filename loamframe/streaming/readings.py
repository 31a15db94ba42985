"""Streaming forms of ingestion, period means and upsert."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loamframe.operators.stations import SERIES, upsert_readings
from loamframe.sources.feeds import ingest_series_json, parse_series, rejected_series


def _stream(spark: SparkSession, path: str, schema, fmt: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


LEDGER = "file string, run string, batch long"


def start_ingest(
    feed: DataFrame, body: str, keep: list[str], out: str, rejects: str, checkpoint: str, once: bool = True, stations: DataFrame | None = None,
    ledger: str | None = None, source: str = "_metadata.file_path",
) -> StreamingQuery:
    """Landed series batches -> one row per value, bad batches apart.

    Each micro-batch overwrites its own folder below the run of its checkpoint;
    only then do its source files enter the ledger (``out`` + "-ledger" unless
    named), in one small write. :func:`read_ingested` reads what the ledger
    names, so a batch lost half-way is unseen until it is repeated, and a
    repeated one leaves no duplicates. A lost checkpoint starts a new run, which
    leaves out the files that any run has recorded: readers never see fewer rows
    than before. ``source`` names a row's file. With ``stations`` the time-zone
    offset is applied to hourly local times.
    """
    book = ledger or f"{out}-ledger"

    def store(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        run = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        known = read_or_empty(session, book, LEDGER)
        if not known.where((F.col("run") == run) & (F.col("batch") == number)).isEmpty():
            return
        # Only the batch's own files that are recorded already go to all tasks. Rows are dealt
        # by number: a file is a key that many rows share, and one task may read all of it.
        arrived = batch.select("_source").distinct()
        recorded = known.select(F.col("file").alias("_source")).join(F.broadcast(arrived), "_source", "left_semi").distinct()
        new = batch.join(F.broadcast(recorded), "_source", "left_anti").withColumn("_row", F.monotonically_increasing_id())
        dealt = new.repartition(int(session.conf.get("spark.sql.shuffle.partitions")), "_row")
        parsed = parse_series(dealt, body).select(*keep, "_source", "_feed").persist()
        ingest_series_json(parsed, body, stations).write.mode("overwrite").parquet(f"{out}/run={run}/batch={number}")
        rejected_series(parsed, body, keep).write.mode("overwrite").parquet(f"{rejects}/run={run}/batch={number}")
        files = parsed.select(F.col("_source").alias("file")).distinct()
        publish(files.select("file", F.lit(run).alias("run"), F.lit(number).cast("long").alias("batch")), book)
        parsed.unpersist()

    named = feed.select("*", F.col(source).alias("_source"))
    return _start(named.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint), once)


def publish(rows: DataFrame, path: str) -> None:
    """Adds rows to a ledger as one file: all of them or none."""
    rows.coalesce(1).write.mode("append").parquet(path)


def stream_ingest(
    spark: SparkSession, path: str, schema, body: str, keep: list[str], out: str, rejects: str, checkpoint: str,
    fmt: str = "json", files_per_trigger: int | None = None, once: bool = True, stations: DataFrame | None = None, ledger: str | None = None,
) -> StreamingQuery:
    """:func:`start_ingest` over the files landing in a folder."""
    return start_ingest(_stream(spark, path, schema, fmt, files_per_trigger), body, keep, out, rejects, checkpoint, once, stations, ledger)


def read_ingested(spark: SparkSession, out: str, ledger: str | None = None) -> DataFrame:
    """What the batches in the ledger have written, of all runs.

    For the rejects name the ledger of the rows.
    """
    done = read_or_empty(spark, ledger or f"{out}-ledger", LEDGER).select("run", "batch").distinct()
    rows = spark.read.option("basePath", out).parquet(out).withColumn("batch", F.col("batch").cast("long"))
    return rows.join(done, ["run", "batch"], "left_semi").drop("run", "batch")


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet folder, or no rows before its first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _start(writer, once: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


def period_means(readings: DataFrame, duration: str, delay: str = "1 day") -> DataFrame:
    """Mean per series and hour or day of a stream, once the watermark passed.

    Rows later than ``delay`` are dropped. A batch DataFrame gives the same
    columns without the dropping.
    """
    width = {"HOURLY": "1 hour", "DAILY": "1 day"}[duration]
    rows = readings.where("value IS NOT NULL").withColumn("ts", F.col("ts").cast("timestamp"))
    return (
        rows.withWatermark("ts", delay)
        .groupBy(*SERIES, F.window("ts", width).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("average"))
        .select(*SERIES, F.col("w.start").cast("timestamp_ntz").alias("period"), "n", "average")
    )


def start_period_means(readings: DataFrame, duration: str, out: str, checkpoint: str, delay: str = "1 day", once: bool = True) -> StreamingQuery:
    """Append finished periods to a Parquet folder."""
    writer = period_means(readings, duration, delay).writeStream.outputMode("append").format("parquet")
    return _start(writer.option("path", out).option("checkpointLocation", checkpoint), once)


def start_upsert(changes: DataFrame, log: str, checkpoint: str, delay: str | None = None, once: bool = True) -> StreamingQuery:
    """Append changes to a log, from which :func:`current_readings` reads.

    Writing costs only the batch itself, however large the table is. Each batch
    owns one folder and overwrites it when repeated. With ``delay`` exact
    repeats within that time are dropped first.
    """
    rows = changes
    if delay:
        rows = rows.withColumn("_seen", F.col("updated_at").cast("timestamp")).withWatermark("_seen", delay)
        rows = rows.dropDuplicatesWithinWatermark([*SERIES, "ts", "updated_at"]).drop("_seen")

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={number}")

    return _start(rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint), once)


def current_readings(spark: SparkSession, log: str, base: DataFrame | None = None, after: int = -1) -> DataFrame:
    """Latest version of every reading in the change log (and a base table).

    Batches up to ``after`` are left unread: they are in the base already.
    """
    changes = spark.read.option("basePath", log).parquet(log).where(F.col("batch") > after).drop("batch")
    return upsert_readings(base if base is not None else changes.limit(0), changes)


VERSIONS = "day date, version long"


def merge_changes(spark: SparkSession, log: str, base: str, state: str) -> int:
    """Merges the log's new batches into a base table kept by day and version.

    Only the days that changed are read, and they are written to a new version's
    folder; nothing that readers use is touched. One small write to ``state``
    then names the new version of these days, and :func:`read_merged` resolves
    it: a merge lost before that leaves the old table whole and is simply
    repeated. The version is the last batch merged; it is returned, for
    :func:`current_readings`.
    """
    done = merged_upto(spark, state)
    changes = spark.read.option("basePath", log).parquet(log).where(F.col("batch") > done)
    last = changes.agg(F.max("batch")).first()[0]
    if last is None:
        return done
    changes = changes.where(F.col("batch") <= last).drop("batch").withColumn("day", F.to_date("ts"))
    days = changes.select("day").distinct()
    old = read_merged(spark, base, state)
    touched = old.join(days, "day", "left_semi").select(*changes.columns) if old is not None else changes.limit(0)
    merged = upsert_readings(touched, changes)
    merged.repartition("day", F.pmod(F.xxhash64(*SERIES), F.lit(8))).write.mode("overwrite").partitionBy("day").parquet(f"{base}/version={int(last)}")
    # The row without a day marks the batch as merged even if no row has a time.
    named = days.where("day IS NOT NULL").unionByName(spark.createDataFrame([(None,)], "day date")).withColumn("version", F.lit(int(last)).cast("long"))
    publish(named, state)
    return int(last)


def read_merged(spark: SparkSession, base: str, state: str) -> DataFrame | None:
    """The base table with its ``day``: of every day the version published last.
    Readings without a time belong to no day and are left out.

    None before the first merge.
    """
    versions = read_or_empty(spark, state, VERSIONS)
    if versions.isEmpty():
        return None
    valid = versions.where("day IS NOT NULL").groupBy("day").agg(F.max("version").alias("version"))
    rows = spark.read.option("basePath", base).parquet(base)
    rows = rows.withColumns({"version": F.col("version").cast("long"), "day": F.col("day").cast("date")})
    return rows.join(valid, ["day", "version"], "left_semi").drop("version")


def merged_upto(spark: SparkSession, state: str) -> int:
    """The last batch that a merge has published, -1 before the first."""
    found = read_or_empty(spark, state, VERSIONS).agg(F.max("version")).first()[0]
    return -1 if found is None else int(found)
