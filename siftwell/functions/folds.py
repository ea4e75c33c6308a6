"""Ordered folds and windows that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from siftwell.plans.session import cut


def capped(amount: Column, cap: Column, keys: Sequence[str], *order: Column | str) -> Column:
    """What a greedy pass in the given order may still take of ``cap`` within each group.

    Running sums, both cut at the cap: the difference is what the row adds.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    upto = F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.least(cap, upto) - F.least(cap, upto - amount)


def ranked(df: DataFrame, *order: Column | str, rank: str = "rank", partitions: int | None = None) -> DataFrame:
    """Dense global row numbers without a single-partition window.

    Rows are range-partitioned by the order, numbered within their partition,
    and shifted by the number of rows in the partitions before. Only counts by
    partition are gathered, one row for each.
    """
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    # The row number within a partition: monotonically_increasing_id counts rows in its low 33 bits.
    placed = placed.withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    placed = cut(placed)  # the bounds are sampled: both uses below must see the same partitions
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    return placed.join(F.broadcast(before), "__part").withColumn(rank, (F.col("__at") + F.col("__before") + 1).cast("long")).drop("__part", "__at", "__before")


def top(df: DataFrame, n: int, *order: Column | str, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows in the given order with their row number; a top-k, not a full sort."""
    head = df.orderBy(*order).limit(n)
    return head.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("long"))


#: Neighbouring ranks that a task of a check over a ranking holds.
BLOCK_ROWS = 100_000


def in_blocks(ranked: DataFrame, rank: str = "rank", before: int = 0, after: int = 0, rows: int = BLOCK_ROWS) -> DataFrame:
    """A table ranked from 1 in blocks of ``rows`` neighbours: each with the ``before`` ranks ahead of it and the ``after`` behind it.

    ``block`` tells the block and ``own`` whether a row is its or a neighbour's
    copy, so that a window by block sees all it needs and no window has to hold
    the ranking.
    """
    if rows < max(before, after):
        raise ValueError("a block must hold the neighbours of the next one")
    at = F.col(rank) - 1
    block, inside = F.floor(at / rows), at % rows
    copy = lambda n, own: F.struct((block + n).alias("block"), F.lit(own).alias("own"))
    copies = F.array(copy(0, True), F.when((inside < after) & (block > 0), copy(-1, False)), F.when(inside >= rows - before, copy(1, False)))
    return ranked.select("*", F.explode(F.array_compact(copies)).alias("__copy")).select("*", "__copy.*").drop("__copy")


def in_block(rank: str = "rank", *ties: str) -> WindowSpec:
    """The window over a block's rows by rank; ``ties`` order those that share one, alike in a block and in its neighbours' copies."""
    return Window.partitionBy("block").orderBy(rank, *ties)
