"""Physical plans: shuffles, pushdown, broadcast."""

import re

from conftest import plan_of
from pyspark.sql import functions as F

from sensorloom.functions import time as ft
from sensorloom.operators import skew
from sensorloom.operators.features import ts_features
from sensorloom.operators.joins import bucket_left_join, join_dim
from sensorloom.operators.relational import top_groups
from sensorloom.operators.windows import latest_per_key
from sensorloom.plans import catalog
from sensorloom.sources.tables import literal_relation, read_table


def read(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def exchanges(plan):
    return len(re.findall(r"Exchange hashpartitioning", plan))


def test_features_take_one_shuffle(spark, sf):
    plan = plan_of(ts_features(read(spark, sf, "events"), "user_id", "ts", "value", ["event_id"]))
    assert exchanges(plan) == 1 and plan.count("Sort [") == 1
    assert "props" not in plan


def test_feeds_shuffle_the_base_once(spark, sf):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = read(spark, sf, "events").select("event_id", "user_id", "ts")
        feed = base.withColumnRenamed("event_id", "v")
        plan = plan_of(bucket_left_join(base, {"a": feed, "b": feed}, ["user_id"], "ts", "ts"))
        assert exchanges(plan) == 3  # base, feed, feed
        dims = read(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
        assert "BroadcastHashJoin" not in plan_of(join_dim(base, dims, "user_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_small_dimensions_are_broadcast(spark, sf):
    lines = read(spark, sf, "lineitem").select("l_suppkey", "l_quantity")
    dims = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    assert "BroadcastHashJoin" in plan_of(join_dim(lines, dims, "l_suppkey"))
    names = literal_relation(spark, [("view", 1)], "event_type string, n int")
    assert "BroadcastHashJoin" in plan_of(join_dim(read(spark, sf, "events"), names, "event_type"))


def test_latest_row_is_limited_before_the_shuffle(spark, sf):
    plan = plan_of(latest_per_key(read(spark, sf, "events"), ["user_id"], "ts", ["event_id"]))
    assert "row_number(), 1, Partial" in plan


def test_scan_is_pruned_and_filtered(spark, sf):
    df = read_table(spark, f"{sf}/lineitem.parquet", ["l_orderkey"], "l_discount > 0.05D")
    plan = plan_of(df)
    assert "GreaterThan(l_discount,0.05)" in plan and "ReadSchema: struct<l_orderkey:bigint,l_discount:double>" in plan


def test_time_cut_reaches_the_scan(spark, sf):
    df = read(spark, sf, "events").select("ts", "value")
    edge = ft.from_micros(F.floor(F.lit(1_705_000_000_000_000.5)))
    assert "LessThanOrEqual(ts," in plan_of(df.filter(F.col("ts") <= edge))


def test_top_groups_is_a_bounded_heap(spark, sf):
    assert "TakeOrderedAndProject" in plan_of(top_groups(read(spark, sf, "orders"), "o_custkey", "o_totalprice", 5))


def test_size_checks(spark, sf):
    lines = read(spark, sf, "lineitem")
    assert 0 < skew.estimated_bytes(lines.select("l_tax")) < skew.estimated_bytes(lines)
    twice = lines.join(lines.withColumnRenamed("l_tax", "x"), "l_orderkey")
    assert skew.fits_broadcast(lines) and not skew.fits_broadcast(twice)
    assert skew._bytes("10MB") == 10 << 20 and skew._bytes("10485760b") == 10 << 20 and skew._bytes("-1") == -1


def test_no_row_at_a_time_python(spark, sf):
    for name in catalog.oracles():
        if not name.endswith("_stream"):
            plan = plan_of(catalog.queries()[name](spark, sf))
            assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan, name
