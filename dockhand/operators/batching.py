"""Fixed-size batches (A1) and ordered export layout (A3)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockhand.session import cut_lineage

_LOCAL_BITS = 33  # monotonically_increasing_id: partition index << 33 | row in partition


def global_row_index(df: DataFrame, order_by: Sequence[str | Column],
                     num_partitions: int | None = None) -> DataFrame:
    """0-based position of every row in ``order_by`` order, without one-task windows.

    1. range-partition and sort within partitions (Spark samples the bounds);
       ``monotonically_increasing_id`` gives (partition, local position);
    2. write that once to the shared folder: the counts and the rows come from
       the same copy, whatever Spark would reuse or recompute;
    3. prefix sums of the rows per partition (one small row each, a broadcast
       whose size is bounded by the partition count) give the offsets.

    Ties in ``order_by`` are broken by the other columns, so the numbering
    is stable and a hot value is split across range partitions instead of
    piling up in one task.
    """
    from dockhand.operators.keyed import tie_breakers
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = {o for o in order_by if isinstance(o, str)}
    # the other columns break ties: the order becomes total (stable numbering)
    # and a value shared by a third of the rows still spreads over many ranges
    cols = [F.col(f"`{o}`") if isinstance(o, str) else o for o in order_by] + tie_breakers(
        df, [c for c in df.columns if c not in named])
    ranged = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols).withColumn("__mid", F.monotonically_increasing_id())
    ranged = cut_lineage(ranged.withColumn("__part", F.shiftright(F.col("__mid"), _LOCAL_BITS)).withColumn(
        "__local", F.col("__mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))).drop("__mid"))
    counts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__cnt"))
    offsets = counts.select(
        "__part",
        (F.sum("__cnt").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
         ).alias("__off"))
    out = ranged.join(F.broadcast(offsets), "__part", "left")
    return out.withColumn("row_index", F.coalesce(F.col("__off"), F.lit(0)) + F.col("__local")).drop(
        "__part", "__local", "__off")


def fixed_size_batches(df: DataFrame, size: int, order_by: Sequence[str | Column],
                       num_partitions: int | None = None) -> DataFrame:
    """A1: consecutive groups of ``size`` rows in ``order_by`` order.

    Adds ``batch_id`` (0-based) and ``batch_row`` (0-based position inside the
    batch); every batch has ``size`` rows except possibly the last.
    """
    if size < 1:
        raise ValueError("batch size must be >= 1")
    idx = global_row_index(df, order_by, num_partitions)
    return (idx.withColumn("batch_id", F.floor(F.col("row_index") / F.lit(size)).cast("bigint"))
            .withColumn("batch_row", (F.col("row_index") % F.lit(size)).cast("bigint")))


def ordered_layout(df: DataFrame, order_by: Sequence[str | Column], total: bool = True,
                   num_partitions: int | None = None) -> DataFrame:
    """A3: order rows before a write.

    ``total``: a global order across files (range partition + local sort);
    otherwise only within each output file (no shuffle).
    """
    from dockhand.operators.keyed import tie_breakers
    cols = [F.col(f"`{o}`") if isinstance(o, str) else o for o in order_by]
    if total:
        n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        named = {o for o in order_by if isinstance(o, str)}
        # tie-breakers keep a hot order value from landing in one range
        ranged = cols + tie_breakers(df, [c for c in df.columns if c not in named])
        return df.repartitionByRange(n, *ranged).sortWithinPartitions(*ranged)
    return df.sortWithinPartitions(*cols)
