"""Star schema, table sinks, zones and checks on hand-made rows."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from sensorloom.operators import aggregates as agg, quality, relational as rel
from sensorloom.plans import star
from sensorloom.plans.reference_data import POLLUTANTS
from sensorloom.sources import tables

H = datetime(2026, 3, 2, 10)


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


@pytest.fixture(scope="module")
def silver(spark):
    air = "ville_id int, collecte_le timestamp_ntz, aqi_global double, polluant_dominant string, " + ", ".join(
        f"{c} double" for c in ("pm25", "pm10", "no2", "o3", "co", "so2", "temperature", "humidite", "pression", "vent")
    ) + ", station_nom string, station_url string, station_timezone string"

    def measure(city, ts, aqi, name):
        return (city, ts, aqi, "pm25", *[float(i) for i in range(10)], name, f"u/{name}", None)

    weather = "ville_id int, collecte_le timestamp_ntz, " + ", ".join(
        f"{c} {'string' if c.startswith('condition') else 'double'}" for c in star.FACT_WEATHER
    )
    pollution = "ville_id int, collecte_le timestamp_ntz, aqi_owm int, " + ", ".join(
        f"{c} double" for c in list(star.FACT_POLLUTION.values())[1:]
    )
    texts = len([c for c in star.FACT_WEATHER if c.startswith("condition")])

    def sky(city, minute, value):
        return (city, H.replace(minute=minute), *[value] * (len(star.FACT_WEATHER) - texts), *["x"] * texts)

    def smoke(city, minute, value):
        return (city, H.replace(minute=minute), int(value), *[value] * (len(star.FACT_POLLUTION) - 1))

    return {
        "mesure_air_aqicn": frame(
            spark, air, measure(1, H.replace(minute=5), 50.0, "a"), measure(1, H.replace(hour=12), 60.0, "b"),
            measure(2, H, 70.0, "c"), measure(2, None, 80.0, "d"), measure(None, H, 1.0, "e"), measure(4, H, 1.0, "f"),
        ),
        "mesure_meteo": frame(spark, weather, sky(1, 10, 1.0), sky(1, 50, 2.0), sky(3, 0, 3.0)),
        "mesure_pollution_owm": frame(spark, pollution, smoke(1, 0, 1.0), smoke(1, 1, 2.0), smoke(1, 59, 3.0)),
        "ville": frame(
            spark, "id int, nom string, slug_aqicn string, latitude double, longitude double, actif boolean",
            (1, "Un", "un", 1.0, 1.0, True), (2, "Deux", "deux", 2.0, 2.0, True), (3, "Trois", "trois", 3.0, 3.0, True),
            (4, "Quatre", "quatre", 4.0, 4.0, False), (5, "Cinq", "cinq", 5.0, 5.0, None),
        ),
    }


def test_star_tables(spark, silver, tmp_path):
    star.build_star(spark, silver, str(tmp_path / "gold"))
    built = {n: spark.read.parquet(str(tmp_path / "gold" / n)) for n in ("dim_time", "dim_city", "dim_station", "dim_pollutant", "fact_air_quality")}
    fact = built["fact_air_quality"]
    assert len(fact.columns) == 36
    assert fact.filter("city_id = 1 AND hour(datetime_utc) = 10").count() == 6  # 2 weather x 3 pollution rows
    assert fact.count() == 6 + 1 + 2 + 1  # without the measurement that has no city
    assert {r["city_id"] for r in built["dim_city"].collect()} == {1, 2, 3}
    stations = {r["station_id"]: r for r in built["dim_station"].collect()}
    assert set(stations) == {1, 2, 3}
    assert stations[1]["station_nom_aqicn"] == "b"
    assert stations[2]["station_nom_aqicn"] == "d"  # no time sorts first
    assert stations[3]["station_url"] is None
    times = built["dim_time"].orderBy("datetime_utc").collect()
    assert len(times) == 3 and times[0]["jour_semaine"] == "Monday   " and times[0]["semaine"] == 10
    assert times[0]["date"] == date(2026, 3, 2)
    assert sorted(map(tuple, built["dim_pollutant"].collect())) == sorted(POLLUTANTS)


def test_star_in_a_database(spark, silver):
    star.build_star(spark, silver, "gold_test")
    star.build_star(spark, silver, "gold_test")  # replaced, not appended
    assert spark.table("gold_test.dim_city").count() == 3


def test_literal_relation_keeps_rows_in_place(spark):
    rows = [(i, f"n{i}", None if i % 2 else float(i)) for i in range(30)]
    df = tables.literal_relation(spark, rows, "a int, b string, c double")
    assert sorted(map(tuple, df.collect())) == rows
    assert df.dtypes == [("a", "int"), ("b", "string"), ("c", "double")]


def test_truncate_append_keeps_the_declared_schema(spark):
    schema = "a int, b double, at timestamp_ntz"
    for n in (3, 2):
        tables.truncate_append(spark.range(n).select(F.lit(H).alias("at"), F.col("id").alias("a"), F.col("id").alias("b")), "refill_test.t", schema)
    got = spark.table("refill_test.t")
    assert got.dtypes == [("a", "int"), ("b", "double"), ("at", "timestamp_ntz")] and got.count() == 2


def test_audit_columns(spark):
    df = tables.with_audit(spark.range(10).toDF("x"), ["x"], datetime(2026, 1, 1, tzinfo=timezone.utc))
    rows = df.orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(1, 11)) and {r["cree_le"] for r in rows} == {datetime(2026, 1, 1)}


def test_zones_partitions_and_sizes(spark, tmp_path):
    lake = tables.Lake(f"{tmp_path}/")
    path = lake.path("silver", "m")
    with pytest.raises(ValueError):
        lake.path("copper", "m")
    day = lambda d, v: frame(spark, "ts timestamp_ntz, v int", (datetime(2026, 3, d, 5), v))
    tables.write_partitioned(rel.stack(day(1, 1), day(2, 2)), path, "ts")
    tables.write_partitioned(day(2, 3), path, "ts")
    assert sorted(r["v"] for r in tables.read_table(spark, path, ["v"]).collect()) == [1, 3]
    size = tables.file_stats(spark, path).first()
    assert size["files"] == 2 and size["bytes"] > 0


def test_checks(spark):
    ids = frame(spark, "id int", (1,), (None,))
    assert quality.check_not_null(ids, "id").count() == 1
    assert quality.check_unique(rel.stack(ids, frame(spark, "id int", (None,))), "id").count() == 0
    report = {(r["check"], r["column"]): (r["failures"], r["passed"]) for r in quality.run_checks(ids, [("unique", "id"), ("not_null", "id")]).collect()}
    assert report == {("unique", "id"): (0, True), ("not_null", "id"): (1, False)}
    with pytest.raises(ValueError):
        quality.run_checks(ids, [("positive", "id")])
    assert rel.where_eq(ids, "id", 1).count() == 1


def test_small_aggregates(spark):
    df = frame(spark, "k string, v double", ("a", 1.0), ("a", float("nan")), ("a", None), ("b", None))
    assert {r["k"]: r["v"] for r in agg.mean_by(df, ["k"], ["v"]).collect()} == {"a": 1.0, "b": None}
    assert agg.min_rows_per(df, ["k"], 2).count() == 3
    assert rel.min_rows(df, 4) and not rel.min_rows(df, 5)
    assert agg.expected_rows(date(2026, 3, 1), date(2026, 5, 30), 30) == 65_520
    assert rel.drop_if_present(df, "k", "nothing").columns == ["v"]
    assert agg.distinct_count(df, "k", exact=False).first()[0] == 2


def test_top_groups_ties_go_to_the_smaller_key(spark):
    df = frame(spark, "k string, v int", ("c", 1), ("b", 1), ("a", None), ("d", 1), ("d", 1))
    assert [tuple(r) for r in rel.top_groups(df, "k", "v", 2).collect()] == [("d", 2), ("b", 1)]


def test_coverage_of_requested_days(spark):
    rows = [(1, datetime(2026, 3, 1, h)) for h in range(24)] + [(1, datetime(2026, 3, 9)), (2, datetime(2026, 3, 2, 5)), (3, datetime(2026, 4, 1))]
    df = frame(spark, "c int, ts timestamp_ntz", *rows)
    asked = frame(spark, "c int", (1,), (2,), (3,), (4,))
    got = agg.coverage(df, ["c"], "ts", first=date(2026, 3, 1), last=date(2026, 3, 2), entities=asked).collect()
    assert {r["c"]: (r["expected"], r["actual"]) for r in got} == {1: (48, 24), 2: (48, 1), 3: (48, 0), 4: (48, 0)}
    own = {r["c"]: (r["expected"], r["actual"]) for r in agg.coverage(df, ["c"], "ts").collect()}
    assert own == {1: (9 * 24, 25), 2: (24, 1), 3: (24, 1)}


def test_newest_document_of_a_city(spark, tmp_path):
    import os

    from sensorloom.sources.feeds import read_metadata_feed

    for folder, idx, at in (("9", 1, 1_700_000_000), ("10", 2, 1_700_000_500)):
        os.makedirs(tmp_path / folder)
        (tmp_path / folder / "1.json").write_text('{"status": "ok", "data": {"idx": %d}}' % idx)
        os.utime(tmp_path / folder / "1.json", (at, at))
    cities = frame(spark, "id int, nom string", (1, "Un"))
    got = read_metadata_feed(spark, f"{tmp_path}/*", "ville_id", cities, "id", "nom").collect()
    assert [r["station_idx"] for r in got] == [2]
