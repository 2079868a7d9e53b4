"""Scalar expressions against values worked out by hand or by Python."""

import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensorloom.functions import time as ft, values as fv
from sensorloom.plans.reference_data import DOMINANCE, INDEX_SCALE, RANGES


def one(spark, expr, **columns):
    """Value of an expression over one row of literals."""
    df = spark.range(1).select(*[F.lit(v).alias(c) for c, v in columns.items()]) if columns else spark.range(1)
    return df.select(expr).first()[0]


def test_rounding_is_python_round(spark):
    rng = random.Random(7)
    values = [2.675, 0.125, 0.375, 1.005, 1.015, 0.285, -2.675, -0.125, -0.001, 0.0, 12.0, 1e15, -7.5, 1e300]
    values += [rng.uniform(-1000, 1000) for _ in range(20_000)] + [i * 0.005 for i in range(-10_000, 10_000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in fv.round_columns(df, {"x": 2}).collect()]
    assert got == [round(v, 2) for v in values]
    assert not any(math.copysign(1, v) < 0 for v in got if v == 0)
    got = [r[0] for r in fv.round_columns(df, {"x": 4}).collect()]
    assert got == [round(v, 4) for v in values]


@pytest.mark.parametrize(
    "kind, text, expected",
    [
        ("t", "abc", None), ("t", "NaN", None), ("t", "nan", None), ("h", "100", 100.0), ("h", "100.01", None),
        ("t", "0", 0.0), ("pm10", "9999", None), ("w", "12.346", 12.35), ("p", " 1_013.25 ", 1013.25),
        ("t", "12d", None), ("t", "0x10", None), ("t", "inf", None), ("t", "1e1", 10.0), ("t", "", None),
        ("t", None, None), ("t", "1__0", None), ("t", "+.5", 0.5), ("t", "5.", 5.0), ("t", "1e999", None),
    ],
)
def test_clean_text(spark, kind, text, expected):
    df = spark.createDataFrame([(text,)], "x string")
    assert fv.clean_columns(df, {"x": RANGES[kind]}, text=True).first()[0] == expected


def test_clean_numbers(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (-60.0,), (60.01,), (float("inf"),), (-0.001,)], "x double")
    assert [r[0] for r in fv.clean_columns(df, {"x": RANGES["t"]}).collect()] == [None, None, -60.0, None, None, 0.0]


def test_unknown_kind_is_not_checked(spark):
    df = spark.createDataFrame([(1e6,)], "x double")
    assert fv.clean_columns(df, {"x": (None, None)}).first()[0] == 1e6


def test_number_text(spark):
    df = spark.createDataFrame([(12.0,), (12.35,), (-0.5,), (100.0,), (100.1,), (None,), (12345678.25,), (48.8566,), (0.001,), (1e37,)], "x double")
    got = [r[0] for r in df.select(fv.number_text(F.col("x"))).collect()]
    assert got == ["12", "12.35", "-0.5", "100", "100.1", None, "1.234567825E7", "48.8566", "0.001", "1.0E37"]


@pytest.mark.parametrize(
    "parts, expected",
    [
        ({}, "pm25"),
        ({"co": 900.0, "no2": 10.0}, "no2"),
        ({"co": 1100.0, "no2": 10.0}, "co"),
        ({"pm10": 9999.0}, "pm10"),
        ({"pm10": 5.0, "no2": 5.0, "o3": 5.0}, "pm10"),
    ],
)
def test_dominant(spark, parts, expected):
    given = {n: F.lit(parts.get(n)).cast("double") for n in DOMINANCE}
    compared = {n: fv.scale(fv.zero_if_missing(given[n]), f) for n, (_, f) in DOMINANCE.items()}
    assert one(spark, fv.argmax_name(compared)) == expected


def test_codes_and_labels(spark):
    got = [one(spark, fv.map_code(F.lit(c).cast("int"), INDEX_SCALE)) for c in (1, 2, 3, 4, 5, 9, None)]
    assert got == [25, 75, 100, 150, 200, None, None]
    assert one(spark, fv.map_label(F.lit(7), {0: "a"}, "Groupe ")) == "Groupe 7"
    assert one(spark, fv.label_if(F.lit(2) <= F.lit(2), "a", "b")) == "a"
    assert one(spark, fv.clamp_min(F.lit(-0.4), 0)) == 0.0
    assert one(spark, fv.relative_residual(F.lit(0.0), F.lit(3.0))) is None


def test_times(spark):
    at = datetime(2027, 1, 1, 13, 59, 59)
    assert one(spark, ft.iso_week(F.lit(at))) == 53
    assert one(spark, ft.weekday_name(F.lit(datetime(2026, 3, 2)))) == "Monday   "
    assert one(spark, ft.weekday0(F.lit(datetime(2026, 3, 2)))) == 0
    assert one(spark, ft.epoch_to_ts(F.lit(1_772_323_200))) == datetime(2026, 3, 1)
    assert one(spark, ft.iso_ts(F.lit("2026-03-01T05:00"))) == datetime(2026, 3, 1, 5)
    assert one(spark, ft.iso_ts(F.lit("2026-03-01 05:00:00"))) == datetime(2026, 3, 1, 5)
    assert one(spark, ft.iso_ts(F.lit("soon"))) is None
    assert one(spark, ft.hour_text(F.lit(at))) == "2027-01-01 13:00:00"
    start, stop, days = ft.day_bounds(F.lit("2026-03-01"), F.lit("2026-05-30"))
    row = spark.range(1).select(start, stop, days).first()
    assert tuple(row) == (1_772_323_200, 1_772_323_200 + 91 * 86400 - 1, 91)


def test_struct_array_json_matches_python(spark):
    import json

    sources = [{"name": 'Air "Île"', "url": "http://a/b"}, {"name": None, "url": "c\\d"}]
    df = spark.createDataFrame([(sources,), ([],), (None,)], "a array<struct<name: string, url: string>>")
    got = [r[0] for r in df.select(fv.struct_array_json(F.col("a"), {"name": "nom", "url": "url"})).collect()]
    expected = json.dumps([{"nom": s["name"] or "", "url": s["url"]} for s in sources], ensure_ascii=False)
    assert got == [expected, "", ""]
