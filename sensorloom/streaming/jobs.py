"""Incremental forms of the hourly batch: ingest with last-wins, early dedupe, hourly aggregate."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorloom.operators.relational import require
from sensorloom.operators.windows import last_wins
from sensorloom.sources.tables import Lake

LATE = "2 hours"


def read_stream(spark: SparkSession, path: str, schema, format: str = "parquet", files_per_batch: int = 1000, **options) -> DataFrame:
    """Files of a folder or glob as a stream, schema given. A batch takes at most ``files_per_batch`` files, the first one too."""
    options = {"maxFilesPerTrigger": files_per_batch, **options}
    return spark.readStream.schema(schema).options(**options).format(format).load(path)


def hourly_stream(sdf: DataFrame, keys: Sequence[str], ts: str, value: str, late: str = LATE) -> DataFrame:
    """Count and mean per key and hour; an hour is emitted once the watermark has passed its end."""
    at = sdf.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", late)
    return (
        at.groupBy(F.window("_at", "1 hour").alias("_w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))
        .select(*keys, F.col("_w.start").cast("timestamp_ntz").alias("hour"), "n", "mean")
    )


def dedupe_stream(sdf: DataFrame, keys: Sequence[str], ts: str, late: str = LATE) -> DataFrame:
    """First row to arrive per key and hour; repeats within the watermark are dropped.

    For last-wins use :func:`last_of_hour` or :func:`ingest_stream`.
    """
    at = sdf.withColumn("_at", F.col(ts).cast("timestamp"))
    at = at.withColumn("hour", F.date_trunc("hour", "_at")).withWatermark("_at", late)
    kept = at.dropDuplicatesWithinWatermark([*keys, "hour"])
    return kept.withColumn("hour", F.col("hour").cast("timestamp_ntz")).drop("_at")


def last_of_hour(sdf: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], columns: Sequence[str], late: str = LATE) -> DataFrame:
    """One row per key and hour, the last by ``order``, once the watermark has passed the hour's end: ``keys``, ``hour`` and ``columns``.

    Nulls in ``order`` come before all values. Rows that come later than ``late`` are left out, also those of an hour that is still open;
    of those in time the last wins, in whichever order they come. Rows are therefore first grouped by their own time, which the
    watermark judges row by row, then by hour. The state holds the rows of the last ``late`` and one row (``order`` and ``columns``) per open hour.
    """
    held = {c: f"v{i}" for i, c in enumerate(dict.fromkeys([*order, *columns]))}
    at = require(sdf, ts).withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", late)
    row = F.struct(*[F.col(c).alias(v) for c, v in held.items()])  # compared field by field, ``order`` first
    timed = at.groupBy("_at", *keys).agg(F.max(row).alias("_row"))
    # hours of the session's time zone, which may be apart from UTC by half an hour
    apart = sdf.sparkSession.sql("SELECT pmod(unix_seconds(date_trunc('hour', timestamp'2020-01-01 00:00:00')), 3600)").first()[0]
    hours = timed.groupBy(F.window("_at", "1 hour", startTime=f"{apart} seconds").alias("_w"), *keys).agg(F.max("_row").alias("_row"))
    start = F.col("_w.start").cast("timestamp_ntz").alias("hour")
    return hours.select(*keys, start, *[F.col("_row")[held[c]].alias(c) for c in columns])


@contextmanager
def value_state(spark: SparkSession) -> Iterator[None]:
    """Within it, streams keep their state in RocksDB, out of the heap."""
    name, provider = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name)
    spark.conf.set(name, provider)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def start_available(sdf: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything now available to a Parquet folder, then stop."""
    return (
        sdf.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def ingest_stream(
    sdf: DataFrame, lake: Lake, name: str, keys: Sequence[str], ts: str, order: Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Land a stream in bronze and keep silver at one row per key and hour, the last in ``order`` winning.

    Each batch first replaces its own bronze partitions (day and batch number), then rebuilds the silver days
    it touched from bronze. Both writes give the same result when a failed batch is run again. Rows without a
    time are left out.
    """
    bronze, silver = lake.path("bronze", name), lake.path("silver", name)

    def land(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = require(batch, ts).withColumns({"date": F.to_date(ts), "batch": F.lit(number)}).persist()
        try:
            _replace_partitions(rows, bronze, ["date", "batch"])
            days = [r["date"] for r in rows.select("date").distinct().collect()]  # one value per touched day
        finally:
            rows.unpersist()
        if not days:
            return
        # only the folders of the touched days are listed and read
        folders = [f"{bronze}/date={day}" for day in days]
        landed = spark.read.schema(rows.schema).option("basePath", bronze).parquet(*folders)
        hourly = landed.withColumn("hour", F.date_trunc("hour", ts).cast("timestamp_ntz"))
        newest = last_wins(hourly, [*keys, "hour"], ["batch", *order]).drop("batch")
        _replace_partitions(newest, silver, ["date"])

    return (
        sdf.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
