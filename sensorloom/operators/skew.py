"""Size checks and hot-group handling shared by the joins and windows.

A group is *hot* when it has too many rows for one task, whatever share of the table that is. Hot groups are found by
counting: rows per hash bucket first, which is summed on the map side, then the exact groups of the buckets over the limit
alone. They travel as a table of at most rows / limit entries that is joined like any other. It only
chooses the plan; the result is exact either way.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from sensorloom.operators.relational import require
from sensorloom.session import discard, settle

HOT_ROWS = 5_000_000  # rows that make a group hot
SHARE_ROWS = 2_000_000  # rows of a hot group that go to one join task
BLOCK_ROWS = 1_000_000  # rows of a hot series that go to one window task
BLOCK_TICKS = 24 * 7  # steps of a clock that go to one window task, for a hot series

_BUCKETS = 65_536  # hash buckets of the first count


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's own size estimate of a frame, or None where it is not to be had."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except (AttributeError, TypeError):
        return None


def _bytes(text: str) -> int:
    """``10485760``, ``10485760b``, ``10MB`` as a byte count."""
    text = text.strip().lower().removesuffix("b")
    factor = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1:], 1)
    return int(text.rstrip("kmg")) * factor


def fits_broadcast(df: DataFrame) -> bool:
    """True when the estimate is within ``spark.sql.autoBroadcastJoinThreshold``."""
    size = estimated_bytes(df)
    limit = _bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    return size is not None and size <= limit


def group_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """Hash of the key columns that does not depend on the integer width."""
    whole = {"tinyint", "smallint", "int", "bigint"}
    types = dict(df.dtypes)
    return F.xxhash64(*[F.col(k).cast("bigint") if types[k] in whole else F.col(k) for k in keys])


#: Hot groups: a table of key hash ``_h`` and ``_rows``, the same as a dict, or nothing.
Hot = DataFrame | dict | None


def hot_groups(df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS) -> DataFrame | None:
    """Key hash and rows of the groups with at least ``min_rows`` rows; None if there are none.

    One pass counts rows by bucket. Only where a bucket reaches the limit is there a second one, over the rows of such
    buckets. A bucket over the limit need not hold a hot group, so the second pass decides.
    """
    hashed = df.select(group_hash(df, keys).alias("_h"))
    bucket = F.pmod("_h", F.lit(_BUCKETS)).alias("_b")
    full = hashed.groupBy(bucket).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") >= min_rows).select("_b").collect()
    if not full:
        return None
    # at most _BUCKETS numbers
    inside = hashed if len(full) > _BUCKETS // 2 else hashed.filter(F.pmod("_h", F.lit(_BUCKETS)).isin([r["_b"] for r in full]))
    found = settle(inside.groupBy("_h").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") >= min_rows))
    return None if found.isEmpty() else found


def _hot_table(df: DataFrame, hot: Hot) -> DataFrame | None:
    if isinstance(hot, dict):
        return df.sparkSession.createDataFrame(list(hot.items()), "_h long, _rows long") if hot else None
    return hot


def _with_shares(df: DataFrame, on: Sequence[str], hot: DataFrame, share_rows: int) -> DataFrame:
    """Append ``_shares``, the number of shares the row's group is split into; null if the group is not hot."""
    shares = hot.select("_h", F.ceil(F.col("_rows") / share_rows).cast("int").alias("_shares"))
    return df.withColumn("_h", group_hash(df, on)).join(shares, "_h", "left").drop("_h")


def _row_hash(df: DataFrame) -> Column:
    """Hash of a row and its input partition: the same on every retry of a task (unlike ``rand``), and
    different for copies of a row in different partitions.
    """
    usable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*usable, F.spark_partition_id())


def deal(df: DataFrame, on: Sequence[str], hot: Hot, name: str, share_rows: int = SHARE_ROWS) -> DataFrame:
    """Number the share each row of a hot group belongs to; other rows belong to share 0."""
    tagged = _with_shares(df.withColumn("_row", _row_hash(df)), on, _hot_table(df, hot), share_rows)
    return tagged.withColumn(name, F.pmod("_row", F.coalesce("_shares", F.lit(1))).cast("int")).drop("_row", "_shares")


def copy(df: DataFrame, on: Sequence[str], hot: Hot, name: str, share_rows: int = SHARE_ROWS, flag: str | None = None) -> DataFrame:
    """Copy each row of a hot group to every share of the group; ``flag`` tells whether the group is hot."""
    tagged = _with_shares(df, on, _hot_table(df, hot), share_rows)
    if flag:
        tagged = tagged.withColumn(flag, F.col("_shares").isNotNull())
    return tagged.withColumn(name, F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1))).drop("_shares")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    hot_left: Hot = None,
    hot_right: Hot = None,
    share_rows: int = SHARE_ROWS,
) -> DataFrame:
    """Equi-join (``inner``, ``left``, ``left_semi``, ``left_anti``) that splits hot groups.

    Spark splits skewed partitions of both sides of an inner join, and of the left side of the others, by itself. What it cannot
    split is a hot group on the right of a left join; that is looked for when ``hot_right`` is not given and the right side
    is beyond the broadcast threshold. Rows of a hot right group are dealt to shares of ``share_rows`` rows and the
    matching left rows copied to each share; with ``hot_left`` given, the other way round as well.
    """
    on = list(on)
    existence = how in ("left_semi", "left_anti")
    right = right.select(*on).distinct() if existence else require(right, *on)
    if existence:
        hot_right = None
    elif hot_right is None and how == "left" and not fits_broadcast(right):
        hot_right = hot_groups(right, on)
    hot_left, hot_right = _hot_table(left, hot_left), _hot_table(right, hot_right)
    if hot_left is None and hot_right is None:
        return left.join(right, on, how)

    lhs, rhs, keys = left, right, list(on)
    if hot_left is not None:
        lhs, rhs = deal(lhs, on, hot_left, "_deal_l", share_rows), copy(rhs, on, hot_left, "_deal_l", share_rows)
        keys.append("_deal_l")
    if hot_right is not None:
        lhs, rhs = copy(lhs, on, hot_right, "_deal_r", share_rows, "_split"), deal(rhs, on, hot_right, "_deal_r", share_rows)
        keys.append("_deal_r")
    if how != "left" or hot_right is None:
        return lhs.join(rhs, keys, how).drop("_deal_l", "_deal_r", "_split")
    # a copied left row meets its partners in some shares only; every group in hot_right has partners,
    # so the shares without one are dropped and no left row is lost
    joined = lhs.join(rhs.withColumn("_met", F.lit(True)), keys, how)
    return joined.filter(~F.col("_split") | F.col("_met")).drop("_deal_l", "_deal_r", "_met", "_split")


def with_position(df: DataFrame, order: Sequence[str | Column], name: str = "_pos") -> DataFrame:
    """Global row position from 0 in the given total order, without a single-task sort.

    The input is computed once, and written: range borders come from a sample, which would compute it again. The
    written rows are range-partitioned, sorted and numbered within their partition, written, and shifted by the row counts of
    the partitions before (one row per partition). The input partition is a last sort column, so that many rows with an
    equal order are split as well.
    """
    held = settle(df.withColumn("_from", F.spark_partition_id()))
    numbered = settle(
        held.repartitionByRange(*order, "_from")
        .sortWithinPartitions(*order, "_from")
        .drop("_from")
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    discard(held)
    part, local = F.shiftright("_mid", 33), F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per range partition
        .withColumn(name, F.col("_before") + local)
        .drop("_part", "_mid", "_before")
    )


def over_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lookback: int,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
    hot: Hot = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Apply window columns that look back at most ``lookback`` rows within a series.

    Ordinary series take one shuffle by key. A hot series is cut into blocks of ``block_rows`` consecutive
    rows; each block also receives the last ``lookback`` rows before it, which are dropped afterwards.
    """
    hot = hot_groups(df, keys) if hot is None else _hot_table(df, hot)
    plain = Window.partitionBy(*keys).orderBy(*order)
    if hot is None:
        return add(df, plain)
    if block_rows < max(lookback, 1):
        raise ValueError("a block must hold at least the rows looked back on")
    hashed = df.withColumn("_h", group_hash(df, keys))
    ranked = with_position(hashed.join(hot.select("_h"), "_h", "left_semi").drop("_h"), [*keys, *order])
    block = F.floor(F.col("_pos") / F.lit(block_rows))
    lends = (F.col("_pos") % block_rows >= block_rows - lookback) & F.lit(lookback > 0)
    own = F.struct(block.alias("block"), F.lit(False).alias("lent"))
    next_one = F.struct((block + 1).alias("block"), F.lit(True).alias("lent"))
    spread = ranked.withColumn("_at", F.explode(F.when(lends, F.array(own, next_one)).otherwise(F.array(own))))
    blocks = Window.partitionBy(*keys, "_at.block").orderBy("_pos")
    split = add(spread, blocks).filter(~F.col("_at.lent")).drop("_at", "_pos")
    return add(hashed.join(hot.select("_h"), "_h", "left_anti").drop("_h"), plain).unionByName(split)


def over_clock(
    df: DataFrame,
    keys: Sequence[str],
    tick: Column,
    lookback: int,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
    hot: Hot = None,
    block_ticks: int = BLOCK_TICKS,
) -> DataFrame:
    """Apply RANGE window columns that look back at most ``lookback`` steps of a clock within a series.

    ``tick`` numbers the steps; ``add`` finds it as ``_tick``, by which the window is ordered. Ordinary series take one shuffle by key. A
    hot series is cut at fixed steps of the clock, not by rows, so no row needs a number first: each block of ``block_ticks``
    steps also receives the rows of the ``lookback`` steps before it, which are dropped afterwards.
    """
    if block_ticks < max(lookback, 1):
        raise ValueError("a block must be at least as long as the steps looked back on")
    hot = hot_groups(df, keys) if hot is None else _hot_table(df, hot)
    ticked = df.withColumn("_tick", tick)
    plain = Window.partitionBy(*keys).orderBy("_tick")
    if hot is None:
        return add(ticked, plain).drop("_tick")
    hashed = ticked.withColumn("_h", group_hash(df, keys))
    large = hashed.join(hot.select("_h"), "_h", "left_semi").drop("_h")
    into = F.pmod("_tick", F.lit(block_ticks))
    block = F.expr(f"(_tick - pmod(_tick, {block_ticks})) div {block_ticks}")
    lends = F.coalesce((into >= block_ticks - lookback) & F.lit(lookback > 0), F.lit(False))
    own = F.struct(block.alias("block"), F.lit(False).alias("lent"))
    next_one = F.struct((block + 1).alias("block"), F.lit(True).alias("lent"))
    spread = large.withColumn("_at", F.explode(F.when(lends, F.array(own, next_one)).otherwise(F.array(own))))
    blocks = Window.partitionBy(*keys, "_at.block").orderBy("_tick")
    split = add(spread, blocks).filter(~F.col("_at.lent")).drop("_at", "_tick")
    return add(hashed.join(hot.select("_h"), "_h", "left_anti").drop("_h"), plain).drop("_tick").unionByName(split)
