"""Feeds from files to the delimited history."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from sensorloom.plans import history
from sensorloom.plans.reference_data import HISTORY_COLUMNS
from sensorloom.sources.delimited import read_csv
from sensorloom.sources.feeds import read_array_feed, read_metadata_feed, read_record_feed
from sensorloom.sources.tables import literal_relation

T0 = 1_772_323_200  # 2026-03-01 00:00:00 UTC
AT = datetime(2026, 6, 1, 12, 0, 0, tzinfo=timezone.utc)


def record(dt, aqi=None, **parts):
    out = {"components": parts}
    if dt is not None:
        out["dt"] = dt
    if aqi is not None:
        out["main"] = {"aqi": aqi}
    return out


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    files = {
        "pollution/1.json": {
            "list": [
                record(T0 + 300, 1, pm2_5=1.0, pm10=2.0),
                record(T0 + 3000, 2, pm2_5=12.346, pm10=9999.0, co=900.0, no2=10.0),  # same hour, later wins
                record(0, 3, pm2_5=5.0),
                record(None, 3, pm2_5=5.0),
                record(T0 + 3600, 9),
                record(T0 + 7200, 5, o3=12.0, so2=2000.0),
            ]
        },
        "pollution/2.json": {"list": [record(T0, 3, no2=0.125)]},
        "pollution/3.json": {"message": "no data"},
        "weather/1.json": {
            "hourly": {
                "time": ["2026-03-01T00:00", "2026-03-01T01:00", "2026-03-01 02:00:00", "2026-03-01T09:00"],
                "temperature_2m": [0, -60.0],
                "relative_humidity_2m": [100, 100.01, 50, 50],
                "surface_pressure": [1013.255, 869.9, None, 1000],
                "wind_speed_10m": [1.5, 2.5, 3.5, 4.5, 5.5],
            }
        },
        "weather/3.json": {"hourly": {"time": ["2026-03-01T00:00"], "temperature_2m": [3.0]}},
        "station/1.json": {
            "status": "ok",
            "data": {
                "idx": 77,
                "city": {"url": "http://x/1"},
                "attributions": [{"name": 'Réseau "A"', "url": "http://a"}, {"url": "http://b"}],
            },
        },
        "station/2.json": {"status": "error", "data": "unknown station"},
    }
    for name, doc in files.items():
        path = root / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(json.dumps(doc, ensure_ascii=False, indent=1), encoding="utf-8")
    return str(root)


@pytest.fixture(scope="module")
def built(spark, landed):
    return history.build_history(spark, landed, AT).persist()


def test_record_feed(spark, landed):
    rows = read_record_feed(spark, f"{landed}/pollution", "ville_id").orderBy("ville_id", "pos").collect()
    assert [(r["ville_id"], r["pos"], r["dt"]) for r in rows] == [
        (1, 0, T0 + 300), (1, 1, T0 + 3000), (1, 4, T0 + 3600), (1, 5, T0 + 7200), (2, 0, T0),
    ]


def test_array_feed_pads_and_cuts(spark, landed):
    rows = read_array_feed(spark, f"{landed}/weather", "ville_id").filter("ville_id = 1").orderBy("pos").collect()
    assert [r["t"] for r in rows] == [0.0, -60.0, None, None]
    assert [r["w"] for r in rows] == [1.5, 2.5, 3.5, 4.5]
    assert rows[2]["time"] == datetime(2026, 3, 1, 2)


def test_metadata_feed(spark, landed):
    cities = literal_relation(spark, [(1, "Un"), (2, "Deux"), (9, "Neuf")], "id int, nom string")
    got = {r["ville_id"]: r for r in read_metadata_feed(spark, f"{landed}/station", "ville_id", cities, "id", "nom").collect()}
    assert got[1]["station_nom"] == "Un" and got[1]["station_idx"] == 77 and got[1]["station_timezone"] == ""
    assert got[1]["attributions"] == '[{"nom": "Réseau \\"A\\"", "url": "http://a"}, {"nom": "", "url": "http://b"}]'
    for missing in (2, 9):
        assert all(v is None for c, v in got[missing].asDict().items() if c != "ville_id")


def test_history_rows(built):
    assert built.columns == HISTORY_COLUMNS
    rows = built.orderBy("id").collect()
    assert [(r["id"], r["ville_id"], r["mesure_le"].hour) for r in rows] == [(1, 1, 0), (2, 1, 1), (3, 1, 2), (4, 2, 0)]
    first, second, third, other = rows
    assert (first["aqi_global"], first["pm25"], first["pm10"], first["co"]) == (75, 12.35, None, 900.0)
    assert first["polluant_dominant"] == "pm10"  # decided before validation
    assert (first["temperature"], first["humidite"], first["pression"], first["vent"]) == (0.0, 100.0, round(1013.255, 2), 1.5)
    assert (second["aqi_global"], second["pm25"], second["polluant_dominant"]) == (None, None, "pm25")
    assert (second["temperature"], second["humidite"], second["pression"]) == (-60.0, None, None)
    assert (third["aqi_global"], third["o3"], third["so2"], third["polluant_dominant"]) == (200, 12.0, None, "so2")
    assert (third["temperature"], third["vent"]) == (None, 3.5)
    assert (other["no2"], other["temperature"], other["station_nom"], other["station_idx"]) == (0.12, None, "", None)
    assert first["collecte_le"] == "2026-06-01 12:00:00" and first["station_nom"] == "Paris"


def test_history_report(built):
    rows = history.history_report(built).orderBy("ville_id").collect()
    assert [(r["n"], r["present"], r["pct"]) for r in rows] == [(3, 2, 67), (1, 0, 0)]
    assert rows[0]["last"] == datetime(2026, 3, 1, 2)


def test_delimited_history(spark, built, tmp_path):
    path = str(tmp_path / "history")
    history.write_history(built.orderBy("id").coalesce(1), path)
    (part,) = [p for p in (tmp_path / "history").iterdir() if p.suffix == ".csv"]
    raw = part.read_bytes()
    assert raw.startswith(b"\xef\xbb\xbfid;ville_id;collecte_le;") and raw.endswith(b"\r\n")
    lines = raw.decode("utf-8-sig").split("\r\n")
    assert lines[1].startswith("1;1;2026-06-01 12:00:00;2026-03-01 00:00:00;;75;12.35;;10;;900;;0;100;")
    schema = ", ".join(f"`{c}` {'string' if t == 'timestamp_ntz' else t}" for c, t in built.dtypes)
    back = read_csv(spark, path, schema, ts=["mesure_le"])
    texts = ["station_timezone", "station_nom", "station_url", "attributions"]
    assert sorted(map(tuple, back.fillna("", texts).collect()), key=lambda r: r[0]) == sorted(
        map(tuple, built.collect()), key=lambda r: r[0]
    )
