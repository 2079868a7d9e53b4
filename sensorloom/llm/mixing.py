"""Mixing sources to target weights: capped water-filling and seeded repetitions, in DataFrame functions only.

Targets: the mix shares ``share`` times all sizes among the sources by weight. A source whose share exceeds
``max_epochs`` times its size is clamped there and its excess goes to the others by weight, until none is above. Sources
clamp in the order of cap / weight, so the level at which filling stops follows from two running sums over the sources.

Documents: target / size = whole + fraction. Every document is taken ``whole`` times. For the fraction, the documents of
a source are ordered by a seeded MD5 of their key and taken until the remaining words are used up; the document at the
cut gives its first words only. To find the cut without ordering a whole source in one task, sizes are summed by
hash bucket (as many buckets as the square root of the rows), the running sums over buckets name the one bucket that holds the cut, and
only the documents of that bucket are ordered.

Defined results: null text has size 0; null source is a source of its own, last in order; sources of size 0 have target 0;
equal rows are ordered by size and a row digest and, if wholly equal, share the same interval order arbitrarily.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

#: Fixed value: a word is a run of characters other than space and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"
_HEX = 8


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[int], share_percent: int, max_epochs: int) -> DataFrame:
    """``source``, ``source_size``, ``target`` of every source of ``sizes`` (source, size)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    total = Window.partitionBy()
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("_place", F.row_number().over(by_name) - 1)
        .withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("_place") % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("_cap", F.col("source_size") * max_epochs)
        .withColumn("_wanted", F.sum("source_size").over(total) * share_percent)
    )
    # filling order: smallest cap per weight first; sums of what is clamped before, and of the weights from here on
    filling = Window.orderBy(F.col("_cap") / F.col("_weight"), "_place")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("_wanted") - 100 * F.coalesce(F.sum("_cap").over(before), F.lit(0))) / (100.0 * F.sum("_weight").over(onward))
    sources = sources.withColumn("_level", level).withColumn("_free", F.col("_level") * F.col("_weight") <= F.col("_cap"))
    stop = F.min(F.when(F.col("_free"), F.struct(F.col("_cap") / F.col("_weight"), F.col("_place"), F.col("_level")))).over(total)
    target = F.least(F.col("_cap").cast("double"), F.coalesce(stop["_level"] * F.col("_weight"), F.col("_cap").cast("double")))
    return sources.select("source", "source_size", F.greatest(F.lit(0.0), target).alias("target"))


def mix(
    docs: DataFrame,
    weights: list[int],
    share_percent: int = 150,
    max_epochs: int = 2,
    seed: str = "mix",
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Per document: key, ``size``, ``source_size``, ``target``, ``taken``, ``whole`` and ``partial`` words of the mix.

    ``taken`` = ``whole`` * ``size`` + ``partial``. Reruns agree: the order depends on the seed and the row alone.
    """
    spread = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    rows = settle(
        docs.select(
            F.col(key).alias(key),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            spread.alias("_order"),
        )
    )
    targets = settle(source_targets(rows, weights, share_percent, max_epochs))
    targets = targets.withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    targets = targets.withColumn("_rest", F.floor(F.col("target") - F.col("_whole") * F.col("source_size")).cast("long"))

    buckets = math.isqrt(rows.count()) + 1
    bucket = F.pmod(F.conv(F.substring("_order", 1, _HEX), 16, 10).cast("long") * buckets / F.lit(float(16**_HEX)), F.lit(buckets)).cast("long")
    rows = rows.withColumn("_bucket", bucket)
    filled = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_filled"))
    running = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    filled = filled.withColumn("_begin", F.coalesce(F.sum("_filled").over(running), F.lit(0)))
    same = F.col("f.source").eqNullSafe(F.col("t.source"))
    cut = (
        filled.alias("f")
        .join(targets.alias("t"), same)
        .where((F.col("_begin") <= F.col("_rest")) & (F.col("_rest") < F.col("_begin") + F.col("_filled")))
        .select(F.col("f.source").alias("source"), F.col("_bucket").alias("_cut"), (F.col("_rest") - F.col("_begin")).alias("_left"))
    )
    plan = (
        targets.alias("t")
        .join(cut.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left")
        .select("t.*", F.coalesce(F.col("c._cut"), F.lit(1 << 62)).alias("_cut"), F.coalesce(F.col("c._left"), F.lit(0)).alias("_left"))
    )
    # sources without a cut take the rest from no bucket, or, if the rest is their whole size, from every bucket
    joined = rows.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
    joined = joined.select("r.*", "p.source_size", "p.target", "p._whole", "p._rest", "p._cut", "p._left")
    inside = joined.where(F.col("_bucket") == F.col("_cut"))
    order = Window.partitionBy("source").orderBy("_order", F.col(key), "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("size").over(order), F.lit(0))
    partial_inside = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_left") - ahead))
    partial_outside = F.when((F.col("_bucket") < F.col("_cut")) & (F.col("_rest") > 0), F.col("size")).otherwise(0)
    chosen = inside.withColumn("partial", partial_inside.cast("long")).unionByName(
        joined.where(F.col("_bucket") != F.col("_cut")).withColumn("partial", partial_outside.cast("long"))
    )
    taken = F.col("_whole") * F.col("size") + F.col("partial")
    return chosen.select(
        key, "size", "source_size", "target", taken.cast("long").alias("taken"), F.col("_whole").cast("long").alias("whole"), "partial"
    )
