"""The stages over arriving files: the batch plans, unchanged, under Structured Streaming.

From parsing to the final score no stage needs another row, so all of them run
as they are. Two things need what came before:

* An id counts once. ``records`` drops an id that comes again within a
  watermark; ``first_scores`` keeps keyed state instead, however late it comes:
  the first record of an id is scored, each later one is told with its number.
* The best rows so far (``keep_top``): a table of at most ``limit`` rows that
  each micro-batch's own best are merged into. As the first record of an id
  counts, a row's score never changes, and merging a batch again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from siftwell.config import Config
from siftwell.functions import columns as C
from siftwell.operators import evidence, normalize, scoring
from siftwell.plans.session import prepare
from siftwell.sources import candidates, sinks

#: The state store that keyed processors need.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def lines(spark: SparkSession, folder: str, files_per_batch: int = 16) -> DataFrame:
    """Text lines of a folder as they arrive; a stream numbers no lines, so ``row_num`` is null."""
    text = prepare(spark).readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return text.select(F.col("_metadata.file_path").alias("file"), F.lit(None).cast("long").alias("row_num"), F.col("value").alias("line"), F.current_timestamp().alias("arrived"))


def records(spark: SparkSession, folder: str, watermark: str = "1 hour") -> DataFrame:
    """Valid records, each id once within the watermark."""
    parsed = candidates.parse(lines(spark, folder).withWatermark("arrived", watermark), "arrived")
    return parsed.where(candidates.is_valid()).dropDuplicatesWithinWatermark(["candidate_id"])


def ledger_items(spark: SparkSession, folder: str, config: Config) -> DataFrame:
    """Uncapped evidence rows of arriving records; caps and summaries are batch work over what this writes."""
    ref = C.date_lit(config.reference_date)
    flat = normalize.normalized(records(spark, folder), ref, with_hash=False)
    return evidence.items(flat, config, ref)


def scores(spark: SparkSession, folder: str, config: Config) -> DataFrame:
    """The score breakdown of every valid record that arrives, repeated ids included: as in a batch, all within its row."""
    ref = C.date_lit(config.reference_date)
    parsed = candidates.parse(lines(spark, folder)).where(candidates.is_valid())
    return scoring.scored(normalize.normalized(parsed, ref, with_hash=False), config, ref)


class Copies(StatefulProcessor):
    """Numbers the rows of a key over all micro-batches; a key's state is one number."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "n long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n = self.seen.get()[0] if self.seen.exists() else 0
        for b in rows:
            yield b.assign(copy=range(n + 1, n + 1 + len(b)))
            n += len(b)
        self.seen.update((n,))

    def close(self) -> None:
        pass


def numbered(stream: DataFrame, key: str = "candidate_id") -> DataFrame:
    """``stream`` with ``copy``: 1 for the first row of its key ever, 2 for the second, and so on."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    out = StructType([*stream.schema.fields, StructField("copy", LongType())])
    return stream.groupBy(key).transformWithStateInPandas(Copies(), out, "Append", "None")


def first_scores(spark: SparkSession, folder: str, config: Config) -> DataFrame:
    """Scores with ``copy``: rows with 1 are the ranking's, further ones are repeated ids."""
    return numbered(scores(spark, folder, config))


def keep_top(path: str, limit: int = 100) -> Callable[[DataFrame, int], None]:
    """A micro-batch's ``process``: merges its best first copies into the table of the best rows so far, with their ranks."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.where("copy = 1").drop("copy")
        fs = spark._jvm.org.apache.hadoop.fs.Path(path)
        if fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs):
            known = spark.read.parquet(path).drop("rank")
            new = new.join(F.broadcast(known.select("candidate_id")), "candidate_id", "left_anti").select(known.columns).unionByName(known)  # at most ``limit`` ids
        sinks.write_table(scoring.rank_top(new, limit), path, ["candidate_id", "rank"])

    return merge


def write(stream: DataFrame, path: str, checkpoint: str, process: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Append a stream to a table, or hand each micro-batch to ``process``; the checkpoint makes it exactly once."""
    out = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return out.foreachBatch(process).start() if process else out.format("parquet").outputMode("append").start(path)
