"""Most frequent values with bounded memory, exactly.

Each task keeps a summary of at most ``CAPACITY`` values a group (Misra and
Gries: where a new value finds no room, all counts go down by one). Summaries
are added up and cut to ``CAPACITY`` again by what the next count is. Every value
with over n / (CAPACITY + 1) of a group's n rows is then among those kept, and
only these are counted exactly. Where the least of the counts asked for doesn't
exceed that share, a value that was lost could matter: such groups are counted
whole. What is shuffled follows tasks and capacity, not the number of values.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.plans.session import cut

#: Values that a summary holds.
CAPACITY = 1024


def summarize(counts: dict[str, int], value: str, capacity: int) -> None:
    """Count one more ``value`` in a summary of at most ``capacity`` values."""
    if value in counts:
        counts[value] += 1
    elif len(counts) < capacity:
        counts[value] = 1
    else:
        for v in [v for v, n in counts.items() if n == 1]:
            del counts[v]
        for v in counts:
            counts[v] -= 1


def summaries(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(grp, value, kept): the summaries of all tasks, of (grp, value) rows without nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, int]] = {}
        for b in batches:
            for group, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                summarize(held.setdefault(group, {}), value, capacity)
        for group, counts in held.items():
            if counts:
                yield pa.RecordBatch.from_arrays([pa.array([group] * len(counts)), pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], names=["grp", "value", "kept"])

    return rows.select("grp", "value").mapInArrow(run, "grp string, value string, kept long")


def candidates(rows: DataFrame, groups: list[str], capacity: int = CAPACITY) -> DataFrame:
    """(grp, value): at most ``capacity`` values a group, all with over n / (capacity + 1) rows among them."""
    added = cut(summaries(rows, capacity).groupBy("grp", "value").agg(F.sum("kept").alias("kept")))
    best = None
    for g in groups:  # a top-k each: no task gets all summaries of a group
        own = added.where(F.col("grp") == g).orderBy(F.desc("kept"), "value").limit(capacity + 1)
        best = own if best is None else best.unionByName(own)
    found: dict[str, list] = {}
    for r in best.collect():  # at most capacity + 1 rows a group
        found.setdefault(r["grp"], []).append((r["kept"], r["value"]))
    held = []
    for g, rows_ in found.items():
        next_ = min(rows_)[0] if len(rows_) > capacity else 0
        held += [(g, v) for n, v in rows_ if n > next_]
    return rows.sparkSession.createDataFrame(held, "grp string, value string")


def most_frequent(rows: DataFrame, groups: list[str], k: int, order: Column, capacity: int = CAPACITY) -> DataFrame:
    """(grp, value, n, place) of the ``k`` most frequent values of each of ``groups``.

    ``rows`` has grp, value and what ``order`` names: of values with equal
    counts the one whose least ``order`` comes first wins. The result is exact.
    """
    spark = rows.sparkSession
    rows = rows.where(F.col("grp").isin(*groups))
    counted = lambda some: some.groupBy("grp", "value").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    # At most ``capacity`` values a group and as many groups as are named; so many rows come back, too.
    exact = counted(rows.join(F.broadcast(candidates(rows, groups, capacity)), ["grp", "value"], "left_semi")).collect()
    sizes = {r["grp"]: r["n"] for r in rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}
    told, unsure = [], []
    for g in groups:
        own = sorted((r for r in exact if r["grp"] == g), key=lambda r: (-r["n"], r["first"]))
        # All values are there, or none that is missing can reach the last place.
        if sum(r["n"] for r in own) == sizes.get(g, 0) or (len(own) >= k and own[k - 1]["n"] > sizes[g] / (capacity + 1)):
            told += [(g, r["value"], r["n"], place) for place, r in enumerate(own[:k], 1)]
        else:
            unsure.append(g)
    found = spark.createDataFrame(told, "grp string, value string, n long, place int")
    if not unsure:
        return found
    place = F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("n"), "first"))
    whole = counted(rows.where(F.col("grp").isin(*unsure))).withColumn("place", place).where(F.col("place") <= k)
    return found.unionByName(whole.drop("first"))
