"""Tables: pruned scans, literal relations, replace and refill sinks, audit columns, zones."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sensorloom.operators.windows import sequential_id

ZONES = ("bronze", "silver", "gold")


class Lake:
    """Paths of a three-zone layout under one root."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def path(self, zone: str, name: str) -> str:
        if zone not in ZONES:
            raise ValueError(f"unknown zone {zone!r}")
        return f"{self.root}/{zone}/{name}"


def read_table(
    spark: SparkSession, source: str, columns: Sequence[str] | None = None, predicate: str | Column | None = None
) -> DataFrame:
    """A catalog table, or a Parquet path (anything with a ``/``), pruned and filtered in the scan."""
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    if predicate is not None:
        df = df.filter(predicate)
    return df if columns is None else df.select(*columns)


def literal_relation(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small fixed relation given in code, as SQL ``VALUES``: its size is known to the planner."""
    fields = T.StructType.fromDDL(schema).fields
    # named markers: positional ones are not bound in order within VALUES
    args = {f"v{i}_{j}": v for i, row in enumerate(rows) for j, v in enumerate(row)}
    lines = [f"({', '.join(f':v{i}_{j}' for j in range(len(fields)))})" for i in range(len(rows))]
    values = spark.sql(f"SELECT * FROM VALUES {', '.join(lines)}", args=args).toDF(*[f.name for f in fields])
    return values.select(*[F.col(f.name).cast(f.dataType) for f in fields])


def replace_table(df: DataFrame, name: str) -> None:
    """Replace a table, or a Parquet path, with the rows of ``df``."""
    writer = df.write.mode("overwrite")
    writer.parquet(name) if "/" in name else writer.saveAsTable(name, format="parquet")


def truncate_append(df: DataFrame, name: str, schema: str) -> None:
    """Create ``database.table`` with a declared schema if absent, then refill it.

    The declared columns stay; ``df`` is matched by name and cast.
    """
    spark = df.sparkSession
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet")
    target = spark.table(name).schema
    df.select(*[F.col(f.name).cast(f.dataType) for f in target]).write.insertInto(name, overwrite=True)


def with_audit(df: DataFrame, order: Sequence[str], at: datetime, time_name: str = "cree_le") -> DataFrame:
    """Row id from 1 in the given total order, and one load time for the whole run."""
    utc = at.astimezone(timezone.utc).replace(tzinfo=None)
    return sequential_id(df, order).withColumn(time_name, F.lit(utc).cast("timestamp_ntz"))


def write_partitioned(df: DataFrame, path: str, ts: str, day: str = "date") -> None:
    """Write by day, replacing only the days present in ``df``."""
    (
        df.withColumn(day, F.to_date(ts))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def file_stats(spark: SparkSession, path: str, format: str = "binaryFile") -> DataFrame:
    """Number of files and total bytes under a path; only file metadata is read."""
    files = spark.read.format(format).option("recursiveFileLookup", True).load(path)
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
