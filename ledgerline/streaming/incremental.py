"""Structured Streaming forms of the loaders.

* T1 - incremental bronze: new raw lines arrive as files in a landing folder;
  each micro-batch is parsed, hashed, deduplicated and anti-joined against
  bronze, then appended; its quarantined rows are appended the same way.
  Every step works from the whole batch and is repeat-safe, so a replay after
  a failure (between any two steps) completes the missing steps and changes
  nothing else: the at-least-once ``foreachBatch`` contract gives
  exactly-once table contents.
* T2 - incremental silver: silver is partitioned by event day (arrival time
  follows event time, so a batch concerns a few recent days).  A micro-batch
  finds the days where its event ids live now (a scan of just the id and day
  columns), re-ranks its valid rows together with the stored rows of those
  days and of its own days (latest arrival wins), and overwrites only those
  day partitions (dynamic partition overwrite); a day left without rows is
  cleared.  The merged rows are stored first, so the write never reads
  the partitions it replaces.  ``dropDuplicatesWithinWatermark`` is not used:
  it keeps the first arrival, the rule keeps the latest.
* T3 - daily event facts, two ways.  Exact: the same micro-batch that
  upserts silver recomputes F1 for just the days it touched (silver is
  partitioned by day, so only those partitions are read) and replaces those
  days of the daily table; the result equals the batch F1 at every point.
  Windowed: an event-time 1-day window with a 6-hour watermark, where data
  later than the tolerance is dropped; exact distinct counts are not
  supported in streaming aggregation, so DAU is ``approx_count_distinct``.
  What the window drops or counts by another arrival than the latest goes to
  a late table, and the days of its rows are recomputed from silver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import strip

from ledgerline.functions.time import lateness_sec
from ledgerline.operators import bronze as B
from ledgerline.operators import marts as M
from ledgerline.operators import silver as S
from ledgerline.sources.files import relative_name
from ledgerline.session import checkpoint_dir
from ledgerline.sources.sinks import append_by, remove_folder, stored, table_exists

RAW_LINE_SCHEMA = T.StructType([T.StructField("source_file", T.StringType()),
                                T.StructField("value", T.StringType())])
# Fixed value of the streaming jobs.
LATE_TOLERANCE = "6 hours"


def landing_stream(spark: SparkSession, path: str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw ``(source_file, value)`` lines landed as Parquet files.  A
    micro-batch takes at most ``max_files_per_trigger`` new files (default:
    one per core of the cluster)."""
    if max_files_per_trigger is None:
        max_files_per_trigger = max(1, spark.sparkContext.defaultParallelism)
    return (spark.readStream.schema(RAW_LINE_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(path))


def jsonl_stream(spark: SparkSession, root: str, glob: str = "*.jsonl", max_files: int = 1000) -> DataFrame:
    """Raw lines of JSONL feed files as they arrive: ``(source_file, value)``;
    ``source_file`` is ``<folder>/<file name>``; blank lines skipped."""
    lines = spark.readStream.option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files).text(root)
    return lines.select(
        relative_name(F.col("_metadata.file_path")).alias("source_file"),
        "value").where(strip(F.col("value")) != "")


class BronzeSilverSink:
    """``foreachBatch`` handler doing T1 (bronze append) and T2 (silver upsert)."""

    def __init__(self, bronze_path: str, silver_path: str, quarantine_path: str,
                 ingestion_ts: str = B.DEFAULT_INGESTION_TS, mode: str = "failfast",
                 daily_path: str | None = None):
        self.bronze_path = bronze_path
        self.silver_path = silver_path
        self.quarantine_path = quarantine_path
        self.daily_path = daily_path
        self.ingestion_ts = ingestion_ts
        self.mode = mode
        self.scratch: str | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        self.scratch = f"{checkpoint_dir(spark)}/ledgerline-stream/batch-{uuid.uuid4().hex}"
        try:
            self.load(spark, batch, batch_id)
        finally:
            remove_folder(spark, self.scratch)
            self.scratch = None

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """A micro-batch's rows stored in the shared folder until its end, so that later
        steps read their columns alone."""
        return stored(df, f"{self.scratch or scratch_base(df.sparkSession, 'kept')}/{name}-{uuid.uuid4().hex}")

    def load(self, spark: SparkSession, batch: DataFrame, batch_id: int) -> None:
        # Every step works from the whole (deduplicated) batch and is
        # repeat-safe on its own, so a replay after a failure between steps
        # completes the missing ones and changes nothing else.
        fresh = B.parse_event_lines(batch, self.ingestion_ts, self.mode) \
            .dropDuplicates(["row_hash"])
        fresh = self.keep(fresh, "batch")
        files = B.batch_files(fresh)
        self.append_bronze(spark, fresh, files)
        # silver follows what bronze kept: a line landed again has its first load's stamp
        keys = fresh.select("source_file", "row_hash")
        kept = (B.of_files(spark.read.parquet(self.bronze_path), files).join(keys, ["source_file", "row_hash"], "left_semi")
                .select(*fresh.columns)) if table_exists(spark, self.bronze_path) else fresh
        kept = self.keep(kept, "kept")
        self.append_quarantine(spark, kept, files)
        self.correct(spark, S.valid_events(kept), batch_id)
        self.upsert_silver(spark, S.valid_events(kept))

    def correct(self, spark: SparkSession, valid: DataFrame, batch_id: int) -> None:
        """Hook before the silver upsert of a batch."""

    def append_bronze(self, spark: SparkSession, fresh: DataFrame,
                      files: list[str] | None = None) -> None:
        # bronze and quarantine are partitioned by source file: the repeat checks read only
        # the partitions of the batch's own files
        files = B.batch_files(fresh) if files is None else files
        existing = spark.read.parquet(self.bronze_path) if table_exists(spark, self.bronze_path) else None
        append_by(B.append_new(fresh, existing, files), self.bronze_path, "source_file")

    def append_quarantine(self, spark: SparkSession, fresh: DataFrame,
                          files: list[str] | None = None) -> None:
        files = B.batch_files(fresh) if files is None else files
        q = S.events_quarantine(fresh)
        if table_exists(spark, self.quarantine_path):
            stored = B.of_files(spark.read.parquet(self.quarantine_path), files) \
                .select("source_file", "bronze_row_hash")
            q = q.join(stored, ["source_file", "bronze_row_hash"], "left_anti")
        append_by(q, self.quarantine_path, "source_file")

    def upsert_silver(self, spark: SparkSession, valid: DataFrame) -> None:
        day = F.to_date(F.col("event_ts"))
        batch_days = valid.select(day.alias("event_day"))
        rows = valid.select(*B.BRONZE_EVENT_COLUMNS)
        stored_exists = table_exists(spark, self.silver_path)
        if stored_exists:
            current = spark.read.parquet(self.silver_path)
            ids = valid.select("event_id").distinct()
            homes = current.select("event_id", "event_day").join(ids, "event_id", "left_semi") \
                .select("event_day")
            batch_days = batch_days.unionByName(homes)
        # one row per calendar day at most
        touched = sorted(r[0] for r in batch_days.distinct().collect())
        if not touched:
            return
        if stored_exists:
            stored = (current.where(F.col("event_day").isin(touched))
                      .select(*[F.col("bronze_row_hash").alias("row_hash") if c == "row_hash"
                                else F.col(c) for c in B.BRONZE_EVENT_COLUMNS]))
            rows = rows.unionByName(stored)
        merged = self.keep(S.silver_events(rows).withColumn("event_day", day), "merged")
        (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_day").parquet(self.silver_path))
        kept = {r[0] for r in merged.select("event_day").distinct().collect()}
        for d in touched:
            if d not in kept:       # all of the day's events moved to another day
                _remove_partition(spark, self.silver_path, f"event_day={d.isoformat()}")
        if self.daily_path:
            self.refresh_daily(spark, touched, kept)

    def refresh_daily(self, spark: SparkSession, touched: list, kept: set) -> None:
        """Exact F1 for the touched days, from those silver partitions only."""
        days = spark.read.parquet(self.silver_path).where(F.col("event_day").isin(touched))
        daily = M.fct_events_daily(days)
        (daily.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date_day").parquet(self.daily_path))
        for d in touched:
            if d not in kept:
                _remove_partition(spark, self.daily_path, f"date_day={d.isoformat()}")


def _remove_partition(spark: SparkSession, table: str, partition: str) -> None:
    """Delete one partition folder of a path-based table (Hadoop FileSystem)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{table.rstrip('/')}/{partition}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


class LateSink(BronzeSilverSink):
    """The same handler, with a table of the rows that a window with a watermark may miss
    or count otherwise than silver: rows older than the newest event so far less the
    tolerance (no watermark is ahead of that), and all copies of an id that comes again.
    Each batch has folders of its own, so a replay writes the same rows again."""

    def __init__(self, *args, late_path: str, tolerance: str = LATE_TOLERANCE, **options):
        super().__init__(*args, **options)
        self.late_path, self.tolerance = late_path, tolerance

    def correct(self, spark: SparkSession, valid: DataFrame, batch_id: int) -> None:
        (valid.agg(F.max("event_ts").alias("newest")).write.mode("overwrite")
         .parquet(f"{self.late_path}_newest/batch={batch_id}"))
        newest = spark.read.parquet(f"{self.late_path}_newest").agg(F.max("newest").alias("newest")).first()["newest"]
        day = F.to_date("event_ts").alias("event_day")
        copies = valid.select("event_id", day, "row_hash")
        if table_exists(spark, self.silver_path):
            stored = spark.read.parquet(self.silver_path).select("event_id", "event_day", F.col("bronze_row_hash").alias("row_hash"))
            copies = copies.unionByName(stored.join(copies.select("event_id"), "event_id", "left_semi"))
        copies = copies.distinct()
        again = copies.groupBy("event_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("event_id")
        old = valid.where(F.col("event_ts") < F.lit(newest) - F.expr(f"INTERVAL {self.tolerance}"))
        late = copies.join(again, "event_id", "left_semi").unionByName(old.select("event_id", day, "row_hash")).distinct()
        late.write.mode("overwrite").parquet(f"{self.late_path}/batch={batch_id}")


def run_bronze_silver(spark: SparkSession, source: DataFrame, base: str,
                      ingestion_ts: str = B.DEFAULT_INGESTION_TS) -> dict[str, str]:
    """Run T1 + T2 (+ exact T3) over everything available in ``source``
    (availableNow) and return the table paths."""
    paths = {"bronze": f"{base}/bronze_events", "silver": f"{base}/silver_events",
             "quarantine": f"{base}/silver_events_quarantine",
             "daily": f"{base}/fct_events_daily", "checkpoint": f"{base}/_chk_bs"}
    sink = BronzeSilverSink(paths["bronze"], paths["silver"], paths["quarantine"], ingestion_ts,
                            daily_path=paths["daily"])
    q = (source.writeStream.foreachBatch(sink)
         .option("checkpointLocation", paths["checkpoint"])
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return paths


def events_daily_stream(source: DataFrame, ingestion_ts: str = B.DEFAULT_INGESTION_TS,
                        tolerance: str = LATE_TOLERANCE) -> DataFrame:
    """Streaming daily facts from raw lines: valid events, repeats of an
    ``event_id`` within the tolerance dropped, 1-day event-time windows."""
    ev = S.valid_events(B.parse_event_lines(source, ingestion_ts))
    ev = ev.withColumn("is_late", lateness_sec(F.col("received_ts"), F.col("event_ts")) > 0)
    ev = ev.withWatermark("event_ts", tolerance).dropDuplicatesWithinWatermark(["event_id"])
    return (ev.groupBy(F.window("event_ts", "1 day").alias("w"))
            .agg(F.count(F.lit(1)).alias("events"),
                 F.approx_count_distinct("user_id").alias("dau_approx"),
                 F.count_if("is_late").alias("late_events"))
            .select(F.to_date(F.col("w.start")).alias("date_day"), "events", "dau_approx",
                    "late_events"))


def run_events_daily(spark: SparkSession, source: DataFrame, base: str) -> str:
    """Run T3 (availableNow, update mode); each batch upserts the days it
    updated into a table partitioned by day."""
    out = f"{base}/events_daily_stream"

    def upsert(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date_day").parquet(out))

    q = (events_daily_stream(source).writeStream.outputMode("update").foreachBatch(upsert)
         .option("checkpointLocation", f"{base}/_chk_daily").trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def run_events_daily_corrected(spark: SparkSession, source: DataFrame, base: str,
                               ingestion_ts: str = B.DEFAULT_INGESTION_TS) -> DataFrame:
    """T3 (windowed) with the late table: days of late rows from silver (their DAU exact),
    the others as the window counted them."""
    windowed = spark.read.schema("date_day date, events long, dau_approx long, late_events long") \
        .parquet(run_events_daily(spark, source, base))
    sink = LateSink(f"{base}/bronze_events", f"{base}/silver_events", f"{base}/silver_events_quarantine",
                    ingestion_ts, late_path=f"{base}/late_events")
    q = (source.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/_chk_late")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    days = spark.read.parquet(sink.late_path).select("event_day").distinct()
    silver = spark.read.parquet(sink.silver_path).join(days, "event_day", "left_semi")
    return (windowed.join(days, windowed["date_day"] == days["event_day"], "left_anti")
            .unionByName(M.fct_events_daily(silver).withColumnRenamed("dau", "dau_approx")))


def scratch_base(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming run under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/ledgerline-stream/{name}-{uuid.uuid4().hex}"


def land(lines: DataFrame, path: str) -> None:
    """Append raw lines to a landing folder (one or more new files)."""
    lines.select("source_file", "value").write.mode("append").parquet(path)
