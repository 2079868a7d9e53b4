"""Streams against the batch result."""

from datetime import datetime

from pyspark.sql import functions as F

from sensorloom.operators.windows import last_wins
from sensorloom.sources.tables import Lake
from sensorloom.streaming import jobs

SCHEMA = "k int, ts timestamp_ntz, seq int, v double"


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def at(h, m=0, d=1):
    return datetime(2026, 3, d, h, m)


def test_ingest_keeps_the_last_of_each_hour(spark, tmp_path):
    src, lake = str(tmp_path / "src"), Lake(str(tmp_path / "lake"))

    def run():
        sdf = jobs.read_stream(spark, src, SCHEMA)
        jobs.ingest_stream(sdf, lake, "m", ["k"], "ts", ["seq"], str(tmp_path / "state")).awaitTermination()
        rows = spark.read.parquet(lake.path("silver", "m")).select("k", "hour", "seq", "v")
        return sorted(map(tuple, rows.collect()))

    write(spark, src, [(1, at(5, 1), 1, 1.0), (1, at(5, 9), 2, 2.0), (1, at(7), 3, 3.0), (2, at(5, d=2), 4, 4.0), (9, None, 5, 5.0)])
    assert run() == [(1, at(5), 2, 2.0), (1, at(7), 3, 3.0), (2, at(5, d=2), 4, 4.0)]
    write(spark, src, [(1, at(5, 2), 1, 9.0), (3, at(6), 6, 6.0)])  # a late repeat wins: it came last
    expected = [(1, at(5), 1, 9.0), (1, at(7), 3, 3.0), (2, at(5, d=2), 4, 4.0), (3, at(6), 6, 6.0)]
    assert run() == expected
    assert run() == expected  # nothing new


def test_hourly_emits_closed_hours_and_drops_late_rows(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")

    def run():
        sdf = jobs.hourly_stream(jobs.read_stream(spark, src, SCHEMA), ["k"], "ts", "v")
        jobs.start_available(sdf, out, str(tmp_path / "state")).awaitTermination()
        return sorted(map(tuple, spark.read.schema(sdf.schema).parquet(out).collect()))

    write(spark, src, [(1, at(5, 1), 1, 1.0), (1, at(5, 30), 2, 2.0), (1, at(9), 3, 3.0)])
    assert run() == [(1, at(5), 2, 1.5)]  # watermark 07:00
    write(spark, src, [(1, at(5, 40), 4, 50.0), (1, at(12, 1), 5, 5.0)])
    assert run() == [(1, at(5), 2, 1.5), (1, at(9), 1, 3.0)]


def test_dedupe_keeps_one_row_per_hour(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    sdf = jobs.dedupe_stream(jobs.read_stream(spark, f"{sf}/event[s].parquet", events.schema), ["user_id"], "ts")
    out = str(tmp_path / "out")
    jobs.start_available(sdf, out, str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(out)
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    assert got.count() == got.select("user_id", "hour").distinct().count()
    assert got.select("user_id", "hour").distinct().count() == events.select("user_id", hour).distinct().count()
    assert got.join(events, "event_id", "left_anti").count() == 0
    assert last_wins(events.withColumn("hour", hour), ["user_id", "hour"], ["event_id"]).count() == got.count()


def test_last_of_hour_out_of_state(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")

    def run():
        sdf = jobs.last_of_hour(jobs.read_stream(spark, src, SCHEMA), ["k"], "ts", ["seq"], ["seq", "v"])
        with jobs.value_state(spark):
            jobs.start_available(sdf, out, str(tmp_path / "state")).awaitTermination()
        rows = [tuple(r) for r in spark.read.schema(sdf.schema).parquet(out).collect()]
        assert len(rows) == len(set(rows))
        return set(rows)

    # the last by number wins, not the last by time or arrival; the watermark comes to 07:00
    first = [(1, at(5, 1), 3, 1.0), (1, at(5, 30), 2, 2.0), (2, at(5), 1, None), (1, at(7, 10), 9, 9.0), (1, at(9), 4, 3.0), (None, at(5), 5, 5.0), (3, None, 1, 1.0)]
    write(spark, src, first)
    closed = {(1, at(5), 3, 1.0), (2, at(5), 1, None), (None, at(5), 5, 5.0)}
    assert run() == closed
    # too late for 05:00; 07:00 is still open and keeps its row, 08:00 gets one late but in time
    write(spark, src, [(1, at(5, 40), 7, 50.0), (1, at(7, 50), 8, 8.0), (1, at(8, 20), 6, 6.0), (1, at(12, 1), 10, 10.0)])
    closed |= {(1, at(7), 9, 9.0), (1, at(8), 6, 6.0), (1, at(9), 4, 3.0)}
    assert run() == closed
    assert run() == closed  # nothing new


def test_last_of_hour_keeps_values_as_they_are(spark, tmp_path):
    """Whole numbers beyond 2^53 beside nulls, NaN, text with quotes; and a row later than the watermark whose hour is still open."""
    schema, src, out = "k string, ts timestamp_ntz, seq long, n long, v double", str(tmp_path / "src"), str(tmp_path / "out")

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        sdf = jobs.last_of_hour(jobs.read_stream(spark, src, schema), ["k"], "ts", ["seq"], ["seq", "n", "v"])
        with jobs.value_state(spark):
            jobs.start_available(sdf, out, str(tmp_path / "state")).awaitTermination()
        return {(r["k"], r["hour"].hour): (r["seq"], r["n"], str(r["v"])) for r in spark.read.schema(sdf.schema).parquet(out).collect()}

    big = 2**53 + 1
    first = [("a", at(5, 1), big, big, float("nan")), ("a", at(5, 2), None, 1, 1.0), ('"', at(5), big - 1, None, 2.0), ("a", at(7, 20), 1, 1, 1.0)]
    closed = {("a", 5): (big, big, "nan"), ('"', 5): (big - 1, None, "2.0")}
    assert run([*first, ("z", at(9, 15), 1, 1, 1.0)]) == closed  # watermark 07:15
    last = run([("a", at(7, 10), 9, 9, 9.0), ("a", at(7, 16), 2, 2, 2.0), ("z", at(12), 1, 1, 1.0)])
    assert last == closed | {("a", 7): (2, 2, "2.0"), ("z", 9): (1, 1, "1.0")}
