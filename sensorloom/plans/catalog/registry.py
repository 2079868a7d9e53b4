"""Registration of queries and the small helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}
_covers: dict[str, list[str]] = {}


def query(covers: str, sql: str | None = None):
    """Register a query under its function name. ``covers`` lists the operators of the survey it shows."""

    def register(run: Query) -> Query:
        _queries[run.__name__] = run
        _covers[run.__name__] = covers.split()
        if sql is not None:
            _oracles[run.__name__] = sql
        return run

    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracles() -> dict[str, str]:
    return dict(_oracles)


def coverage() -> dict[str, list[str]]:
    """Survey operator to the queries that show it."""
    out: dict[str, list[str]] = {}
    for name, ids in _covers.items():
        for i in ids:
            out.setdefault(i, []).append(name)
    return out


# schemas of the test tables in use; reading with a schema saves the pass over the file footers
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the number inside their JSON properties as column ``k``."""
    return table(spark, sf, "events").withColumn("k", F.from_json("props", "k int")["k"])


# events with k, for use in a FROM clause
EVENTS = "(SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)"


# Rounding step for comparison across engines. Means of decimals often fall on a half, where the last bit of a
# sum decides; the step is moved a little off the half so that both engines land on the same side.
_STEP = 0.513


def near(c: Column, digits: int = 6) -> Column:
    """Rounded for comparison across engines."""
    scale = F.lit(float(10**digits))
    size = F.floor(F.abs(c) * scale + F.lit(_STEP)).cast("double") / scale
    return F.when((c < 0) & (size > 0), -size).otherwise(size)


def near_sql(x: str, digits: int = 6) -> str:
    """The arithmetic of :func:`near` as SQL."""
    size = f"floor(abs({x}) * 1e{digits} + {_STEP}::DOUBLE) / 1e{digits}"
    return f"(CASE WHEN ({x}) < 0 AND {size} > 0 THEN -({size}) ELSE {size} END)"


def exact_sql(x: str, digits: int = 2) -> str:
    """Correctly rounded decimal of the exact binary value; minus zero becomes zero."""
    text = f"CAST(printf('%.{digits}f', CAST({x} AS DOUBLE)) AS DOUBLE)"
    return f"(CASE WHEN {text} = 0 THEN 0.0::DOUBLE ELSE {text} END)"
