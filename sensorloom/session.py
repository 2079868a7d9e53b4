"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def local_session(cores: int | str = "*", app: str = "sensorloom", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine. On a cluster, bring your own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may go without the setting; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="sensorloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame, **options: str) -> DataFrame:
    """Write a frame to the shared folder, with ``options`` of the parquet writer, and return the written table.

    Cuts the lineage, survives the loss of executors, and later passes read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/sensorloom-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._settled = (spark, path)
    return out


def discard(*settled: DataFrame) -> None:
    """Delete frames written by :func:`settle` that nothing will read again, before :func:`release` does."""
    for df in settled:
        if df._settled in _written:
            _written.remove(df._settled)
            _delete(*df._settled)


def new_path(spark: SparkSession, name: str) -> str:
    """Fresh path in the shared folder, removed by :func:`release`."""
    path = f"{shared_folder(spark).rstrip('/')}/sensorloom-{uuid.uuid4().hex}/{name}"
    _written.append((spark, path.rsplit("/", 1)[0]))
    return path


def release() -> int:
    """Delete what this application settled; call it when the results are written."""
    count = 0
    while _written:
        _delete(*_written.pop())
        count += 1
    return count


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
