"""Delimited text: ``;`` separated, UTF-8 with byte-order mark, CRLF, missing values empty."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.functions import values as fv

SEPARATOR = ";"


def read_csv(spark: SparkSession, path: str, schema: str, ts: Sequence[str] = (), **options) -> DataFrame:
    """Read with an explicit schema; columns named in ``ts`` are text in the file and become timestamps."""
    options = {"sep": SEPARATOR, "header": True, "escape": '"', "enforceSchema": True, **options}
    df = spark.read.schema(schema).csv(path, **options)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ts})


def write_csv(df: DataFrame, path: str, columns: Sequence[str], mark: bool = True, mode: str = "errorifexists") -> None:
    """Write the columns in order, one part file per partition, each with its header.

    Numbers are written exactly, whole ones without a decimal point, times as ``yyyy-MM-dd HH:mm:ss``. The byte-order mark
    is part of the first header name, so every file starts with it.
    """
    types = dict(df.dtypes)

    def text(c: str):
        if types[c] in ("double", "float"):
            return fv.number_text(F.col(c)).alias(c)
        return F.col(c)

    out = df.select(*[text(c) for c in columns])
    if mark:
        out = out.withColumnRenamed(columns[0], "﻿" + columns[0])
    times = {"timestampFormat": "yyyy-MM-dd HH:mm:ss", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    out.write.mode(mode).options(**times).csv(
        path, sep=SEPARATOR, header=True, escape='"', emptyValue="", lineSep="\r\n"
    )
