"""Merkle manifest of a table: leaves, subroots per group, one root, and for every row the proof that leads to the root.

H is the lowercase hex SHA-256 of its inputs concatenated, digests as hex text. A leaf is H of the row's columns, each as ``-`` if
null, else its length in UTF-8 bytes, ``:`` and its value. In a group the leaves ascend by the key (null first, ties by leaf). While several
nodes remain, every ``fanout`` consecutive ones (the last run: fewer, even one) become their H. What remains is the group's
subroot, and the subroots, ordered by group (null first, UTF-8 bytewise), lead to the root in the same way.

Per level the siblings come from lag and lead columns at fixed offsets, masked by the slot in the run and the run's length, and
the row of a first child hashes its parent. Node j of level l sits in the row of its first leaf, ``fanout``**l rows from the
next. As runs never cross multiples of ``fanout``**``levels``, the windows are partitioned by blocks of that many leaves, so a group with a third of all
rows is many small partitions. The roots of the blocks are the leaves of the next climb, until each group has one. The
levels of one climb are windows over one shuffle and one sort.

Places come from a range partitioning by group and key, and from the counts of the partitions before, not from a window over a group.

Defined results: an empty table has no rows (and no root); a lone leaf is its own subroot, and a lone subroot the root; repeated rows
are leaves of their own with equal digests; nulls are hashed as ``-``; clashing extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, settle


def digest_of(*values: Column) -> Column:
    """H of text columns."""
    return F.sha2(F.concat(*[v.cast("string") for v in values]), 256)


def leaf(*columns: Column) -> Column:
    """Leaf digest of a row's columns."""
    texts = [c.cast("string") for c in columns]
    return digest_of(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` (with ``grp``; written) with ``pos``, the place in the group by ``order``, and ``n``, the group's rows. Equal rows are told apart by ``tie``."""
    by = [F.col("grp"), *order, F.col("tie")]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    # the place in a partition is what the id counts from the partition's first
    ranged = settle(ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    counts = ranged.groupBy("grp", "part").agg(F.count("*").alias("_c"), F.min("at").alias("_first"))
    before = Window.partitionBy("grp").orderBy("part")
    whole = Window.partitionBy("grp")
    counts = counts.select(
        F.col("grp").alias("_grp"), F.col("part").alias("_part"), F.sum("_c").over(whole).alias("n"),
        (F.sum("_c").over(before) - F.col("_c") - F.col("_first")).alias("_shift"),
    )
    joined = ranged.join(counts, (F.col("grp") == F.col("_grp")) & (F.col("part") == F.col("_part")))
    return joined.withColumn("pos", F.col("at") + F.col("_shift")).drop("_grp", "_part", "_shift", "part", "at", "tie")


def _climbed(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``nodes`` (grp, pos, n, h) with ``block``, ``top`` (the block's root, in the row of its first node) and ``steps``, the siblings up to it."""
    w = Window.partitionBy("grp", "block").orderBy("pos")
    out = nodes.withColumn("block", F.floor(F.col("pos") / F.lit(fanout**levels)).cast("long")).withColumn("_h", F.col("h"))
    for level in range(levels):
        span = fanout**level
        place, nodes_here = F.expr(f"pos div {span}"), F.expr(f"(n + {span - 1}) div {span}")
        slot = place % fanout
        run = F.least(F.lit(fanout), nodes_here - (place - slot))
        others = {f"_lag{o}": F.lag("_h", o * span).over(w) for o in range(1, fanout)}
        others |= {f"_lead{o}": F.lead("_h", o * span).over(w) for o in range(1, fanout)}
        out = out.withColumns(others)
        left = F.concat(F.lit(""), *[F.when(slot >= o, F.col(f"_lag{o}")).otherwise("") for o in reversed(range(1, fanout))])
        right = F.concat(F.lit(""), *[F.when(slot + o < run, F.col(f"_lead{o}")).otherwise("") for o in range(1, fanout)])
        several = nodes_here > 1
        first = F.col("pos") % span == 0
        out = out.withColumns(
            {
                f"_step{level}": F.when(first & several, F.struct(left.alias("left"), right.alias("right"))),
                "_h": F.when(F.col("pos") % (span * fanout) == 0, F.when(several, digest_of(F.col("_h"), right)).otherwise(F.col("_h"))),
            }
        ).drop(*others)
    # the rows below a first child take its siblings
    near = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = [F.last(f"_step{level}", ignorenulls=True).over(near).alias(f"_step{level}") for level in range(levels)]
    kept = [c for c in out.columns if not c.startswith("_step")]
    out = out.select(*kept, *steps)
    steps = F.filter(F.array(*[f"_step{level}" for level in range(levels)]), lambda x: x.isNotNull())
    return out.select(*[c for c in kept if c != "_h"], F.col("_h").alias("top"), steps.alias("steps"))


def _block_roots(climbed: DataFrame, size: int) -> DataFrame:
    """The roots of the blocks as the nodes of the next climb."""
    return climbed.where(F.col("pos") % size == 0).select("grp", F.col("block").alias("pos"), F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("top").alias("h"))


def _proved(nodes: DataFrame, fanout: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """``nodes`` (grp, pos, n, h, ...; written) with ``steps`` up to their group's root, and the roots (grp, root)."""
    size = fanout**levels
    climbed = _climbed(nodes, fanout, levels)
    roots = settle(_block_roots(climbed, size))
    if roots.where("n > 1").isEmpty():
        return climbed.drop("block", "top"), roots.select("grp", F.col("h").alias("root"))
    # block roots know their own way up; the nodes below append it to theirs
    upper, tops = _proved(roots, fanout, levels)
    upper = settle(upper.select("grp", F.col("pos").alias("block"), F.col("steps").alias("_upper")))
    return climbed.join(upper, ["grp", "block"]).withColumn("steps", F.concat("steps", "_upper")).drop("block", "top", "_upper"), tops


def fold(start: Column, steps: Column) -> Column:
    """The root that a leaf leads to with the siblings of ``steps``."""
    return F.aggregate(steps, start, lambda h, x: digest_of(x["left"], h, x["right"]))


def proof_digest(steps: Column) -> Column:
    """H of all siblings, level by level, left to right."""
    return F.sha2(F.aggregate(steps, F.lit(""), lambda s, x: F.concat(s, x["left"], x["right"])), 256)


def manifest(
    docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), key: str = "doc_id", group: str = "lang",
    extra: dict[str, Column] | None = None, fanout: int = 2, levels: int = 12,
) -> DataFrame:
    """Per row of ``docs``: ``key``, ``leaf``, ``subroot``, ``root``, ``steps`` (array of left and right siblings up to the root), and the ``extra`` columns.

    ``levels`` levels are climbed per shuffle, in blocks of ``fanout`` ** ``levels`` nodes. Extra columns are computed while the
    rows are read, and must not be named like the others.
    """
    extra = extra or {}
    # digests leave the scan, texts do not; a null group is '' and sorts first, others keep their order behind '='
    named = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    thin = docs.select(F.col(key).alias("key"), named.alias("grp"), leaf(*[F.col(c) for c in columns]).alias("h"), *[v.alias(k) for k, v in extra.items()])
    thin = settle(thin.withColumn("tie", F.monotonically_increasing_id()))
    placed = settle(_placed(thin, [F.col("key").asc_nulls_first(), F.col("h")]))
    discard(thin)
    climbed = _climbed(placed, fanout, levels)
    blocks, subroots = _proved(settle(_block_roots(climbed, fanout**levels)), fanout, levels)
    # the subroots of all groups are the leaves of the last tree
    last = settle(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("h"), F.lit(0).alias("tie")))
    last, top = _proved(settle(_placed(last, [F.col("name")])), fanout, levels)
    last = last.join(top, "grp").select(F.col("name").alias("grp"), F.col("h").alias("subroot"), F.col("steps").alias("_last"), "root")
    way = blocks.join(last, "grp").select("grp", F.col("pos").alias("block"), "subroot", "root", F.concat("steps", "_last").alias("_way"))
    # rows meet the way of their block, not of their group, where the windows have put them already
    joined = climbed.join(settle(way), ["grp", "block"])
    return joined.select(F.col("key").alias(key), F.col("h").alias("leaf"), "subroot", "root", F.concat("steps", "_way").alias("steps"), *extra)


def verify(proved: DataFrame, leaf_column: str = "leaf") -> DataFrame:
    """Append ``proof_sha256``, ``folded_root`` from the leaf in ``leaf_column``, and ``verified``."""
    out = proved.withColumn("proof_sha256", proof_digest(F.col("steps"))).withColumn("folded_root", fold(F.col(leaf_column), F.col("steps")))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
