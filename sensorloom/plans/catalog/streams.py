"""Structured Streaming jobs run to completion over the event files."""

from pyspark.sql import Window, functions as F

from sensorloom.plans.catalog.registry import near, near_sql, query, table
from sensorloom.session import new_path, settle
from sensorloom.sources.tables import Lake
from sensorloom.streaming import jobs


def _stream(spark, sf):
    return jobs.read_stream(spark, f"{sf}/event[s].parquet", table(spark, sf, "events").schema)


def _result(spark, sdf, path=None):
    path = path or new_path(spark, "stream")
    jobs.start_available(sdf, path, f"{path}_state").awaitTermination()
    return spark.read.schema(sdf.schema).parquet(path)


@query(
    "K3",
    f"""
    SELECT user_id, date_trunc('hour', ts) AS hour, count(*) AS n, {near_sql("avg(value)")} AS mean
    FROM events GROUP BY 1, 2
    HAVING date_trunc('hour', min(ts)) + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 2 HOUR
    """,
)
def hourly_stream(spark, sf):
    """Closed hours of the event stream: those that end before the watermark."""
    hourly = jobs.hourly_stream(_stream(spark, sf), ["user_id"], "ts", "value")
    return _result(spark, hourly).withColumn("mean", near(F.col("mean")))


@query(
    "K2",
    """
    SELECT user_id, date_trunc('hour', ts) AS hour, min(event_id) AS event_id FROM events
    GROUP BY user_id, date_trunc('hour', ts)
    """,
)
def deduped_stream(spark, sf):
    """The first event of each user and hour to arrive. The first events of all hours arrive before the rest, each lot in one
    run of the job; repeats that come within the watermark are known, later ones are too late."""
    df = table(spark, sf, "events")
    turn = F.row_number().over(Window.partitionBy("user_id", F.date_trunc("hour", "ts")).orderBy("event_id"))
    path = new_path(spark, "arrivals")
    dealt = settle(df.withColumn("_turn", turn))
    for first in (True, False):
        dealt.filter((F.col("_turn") == 1) == first).drop("_turn").write.parquet(f"{path}/{'first' if first else 'rest'}")
        sdf = jobs.read_stream(spark, f"{path}/*", df.schema)
        out = _result(spark, jobs.dedupe_stream(sdf, ["user_id"], "ts").select("user_id", "hour", "event_id"), f"{path}_out")
    return out


#: Runs of the job in which the events of :func:`last_events` arrive.
_ARRIVALS = 2


@query(
    "K2 D13",
    """
    SELECT user_id, hour, event_id, value FROM (
      SELECT user_id, date_trunc('hour', ts) AS hour, event_id, value,
             row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id DESC) AS rn FROM events)
    WHERE rn = 1 AND hour + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 2 HOUR
    """,
)
def last_events(spark, sf):
    """The last event of each user and hour, out of state, once its hour is closed. Events arrive up to 110 minutes late, in several
    runs of the job, each of many files; state and watermark go from run to run."""
    df = table(spark, sf, "events")
    path = new_path(spark, "arrivals")
    arrival = F.unix_seconds(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(6600))
    dealt = settle(df.withColumn("_arrival", arrival))
    begin, end = dealt.agg(F.min("_arrival"), F.max("_arrival")).first()
    lot = F.least(F.floor((F.col("_arrival") - begin) * _ARRIVALS / max(end - begin, 1)), F.lit(_ARRIVALS - 1)) if end is not None else F.lit(0)
    for i in range(_ARRIVALS):
        dealt.filter(lot == i).drop("_arrival").write.parquet(f"{path}/{i}")
        sdf = jobs.read_stream(spark, f"{path}/*", df.schema)
        with jobs.value_state(spark):
            out = _result(spark, jobs.last_of_hour(sdf, ["user_id"], "ts", ["event_id"], ["event_id", "value"]), f"{path}_out")
    return out


@query(
    "K1 A7 A12 D13",
    """
    SELECT user_id, hour, event_id, value FROM (
      SELECT user_id, date_trunc('hour', ts) AS hour, event_id, value,
             row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def ingested_stream(spark, sf):
    """Events landed in bronze and kept in silver at one row per user and hour."""
    path = new_path(spark, "lake")
    lake = Lake(path)
    jobs.ingest_stream(_stream(spark, sf), lake, "events", ["user_id"], "ts", ["event_id"], f"{path}_state").awaitTermination()
    return spark.read.parquet(lake.path("silver", "events")).select("user_id", "hour", "event_id", "value")
